"""Imputation and encoding learned on the fit rows only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.reshape import long_form
from meterflow.operators.ranks import exact_quantiles


def _numeric_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return long_form(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns, "feature", "value")


def _text_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = [F.when(F.col(c).cast("string") != "", F.col(c).cast("string")).alias(c) for c in columns]
    return long_form(df.select(*texts), columns, "feature", "category").filter(F.col("category").isNotNull())


def _listed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per name, also for those without any value."""
    return df.sparkSession.createDataFrame([(n,) for n in names], "feature string")


def fit_medians(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per numeric predictor; 0 for a predictor without values."""
    found = exact_quantiles(_numeric_cells(train, columns), ["feature"], "value", {"median": 0.5})
    return _listed(train, columns).join(found, "feature", "left").select(
        "feature", F.coalesce("median", F.lit(0.0)).alias("median")
    )


def fit_modes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent category per predictor; the smallest one when tied."""
    counts = _text_cells(train, columns).groupBy("feature", "category").agg(F.count("*").alias("n"))
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("n"), "category")).alias("best"))
    return best.select("feature", F.col("best.category").alias("mode"), (-F.col("best.n")).alias("n"))


def vocabulary(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct categories of each predictor on the fit rows."""
    return _text_cells(train, columns).groupBy("feature", "category").agg(F.count("*").alias("n"))


def impute(df: DataFrame, medians: Mapping[str, float], modes: Mapping[str, str]) -> DataFrame:
    """Fill missing predictors with the learned values; the map has one entry per predictor."""
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in medians.items()}
    texts = {
        c: F.coalesce(F.when(F.col(c).cast("string") != "", F.col(c).cast("string")), F.lit(m))
        for c, m in modes.items()
    }
    return df.withColumns({**numbers, **texts})


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 column per known category; a category not seen on the fit rows is all zeros."""
    return df.withColumns(
        {
            f"{c}={value}": F.coalesce(F.col(c).cast("string") == value, F.lit(False)).cast("int")
            for c, values in categories.items()
            for value in values
        }
    )


def preprocessing_audit(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], stage: str) -> DataFrame:
    """What a fit on these rows learns: medians and vocabularies, with the rows they come from."""
    rows = train.agg(F.count("*")).scalar()
    medians = fit_medians(train, numeric).select(
        "feature", F.lit("numeric median").alias("statistic"), F.col("median").alias("value"), F.lit("").alias("category")
    )
    words = vocabulary(train, categorical).select(
        "feature", F.lit("category vocabulary").alias("statistic"), F.lit(None).cast("double").alias("value"), "category"
    )
    return medians.unionByName(words).withColumns({"stage": F.lit(stage), "fit_rows": rows})
