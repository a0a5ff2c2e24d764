"""Reference predictions without a fitted model, and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def persistence(df: DataFrame) -> DataFrame:
    """Next month equals this month."""
    return df.withColumn("prediction", F.col("current_consumption"))


def majority_row(train: DataFrame, label: str = "target") -> DataFrame:
    """Most frequent class (the smaller one when tied) and share of class 1, one row."""
    return train.agg(
        F.when(F.count_if(F.col(label) == 1) > F.count_if(F.col(label) == 0), 1).otherwise(0).alias("majority_class"),
        F.avg(F.col(label).cast("double")).alias("prevalence"),
    )


def majority(train: DataFrame, df: DataFrame, label: str = "target") -> DataFrame:
    """The majority class and its prevalence of `train` on every row of `df`."""
    row = majority_row(train, label).select(F.struct("majority_class", "prevalence")).scalar()
    return df.withColumns(
        {"predicted_class": row.getField("majority_class"), "probability": row.getField("prevalence")}
    )


def balanced_weights(train: DataFrame, label: str = "target") -> DataFrame:
    """Weight n / (2 n_class), so that both classes weigh the same in total."""
    row = train.agg(
        F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("one"), F.count_if(F.col(label) == 0).alias("zero")
    ).select(F.struct("n", "one", "zero")).scalar()
    members = F.when(F.col(label) == 1, row.getField("one")).otherwise(row.getField("zero"))
    return train.withColumn("weight", F.try_divide(row.getField("n").cast("double"), 2.0 * members))
