"""Chronological partitions: by target month, never shuffled."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow import schema
from meterflow.operators.ranks import exact_quantiles

Bounds = Mapping[str, tuple[int, int]]
LABELLED = ["TRAIN", "VALIDATION", "FINAL_TEST"]


def partition_name(target_ord: Column, bounds: Bounds) -> Column:
    """The window that holds a target month, NULL outside all of them."""
    name = F.lit(None).cast("string")
    for partition, (first, last) in bounds.items():
        name = F.when(target_ord.between(first, last), partition).otherwise(name)
    return name


def windowed(df: DataFrame, bounds: Bounds, targets: Mapping[str, str] = schema.TARGETS) -> DataFrame:
    """One row per module and feature row inside a window, before the label filter."""
    modules = F.array(
        *[
            F.struct(F.lit(m).alias("module"), F.col(t).cast("double").alias("target"))
            for m, t in targets.items()
        ]
    )
    return (
        df.withColumn("partition", partition_name(F.col("target_ord"), bounds))
        .filter(F.col("partition").isNotNull())
        .withColumn("_module", F.explode(modules))
        .select("_module.module", "partition", "_module.target", *df.columns)
    )


def chronological_split(df: DataFrame, bounds: Bounds, targets: Mapping[str, str] = schema.TARGETS) -> DataFrame:
    """Labelled rows of each window, and all rows of the future window."""
    rows = windowed(df, bounds, targets)
    return rows.filter((F.col("partition") == "FUTURE") | F.col("target").isNotNull())


def module_rows(df: DataFrame, bounds: Bounds, module: str) -> DataFrame:
    """The split of one module only."""
    return chronological_split(df, bounds, {module: schema.TARGETS[module]})


def labelled_history(split: DataFrame) -> DataFrame:
    """Everything with a known label, for the final refit."""
    return split.filter(F.col("partition").isin(LABELLED))


def split_summary(rows: DataFrame, bounds: Bounds) -> DataFrame:
    """Window, sizes, span and target distribution per module and partition.

    `rows` is the output of `windowed`, so that rows without a label are counted as excluded.
    """
    kept = (F.col("partition") == "FUTURE") | F.col("target").isNotNull()
    summary = rows.groupBy("module", "partition").agg(
        F.count("*").alias("rows_before_target_filter"),
        F.count_if(kept).alias("n_rows"),
        F.count_distinct(F.when(kept, F.col("consumer_no"))).alias("unique_consumers"),
        F.min(F.when(kept, F.col("target_ord"))).alias("min_target_ord"),
        F.max(F.when(kept, F.col("target_ord"))).alias("max_target_ord"),
        F.count_if(~kept).alias("excluded_target_unavailable"),
        F.count("target").alias("known_targets"),
        F.avg("target").alias("mean"),
        F.stddev_samp("target").alias("sd"),
        F.min("target").alias("minimum"),
        F.max("target").alias("maximum"),
        F.count_if(kept & F.col("target").isNull()).alias("missing_targets_retained"),
        F.count_if(F.col("target") == 0).alias("_zero"),
        F.count_if(F.col("target") == 1).alias("_one"),
    )
    measured = rows.filter(F.col("module") == "consumption")
    quartiles = exact_quantiles(
        measured, ["module", "partition"], "target", {"q1": 0.25, "median": 0.5, "q3": 0.75}
    )
    label = (F.col("module") != "consumption") & (F.col("partition") != "FUTURE")

    def bound(i):
        value = F.lit(None).cast("int")
        for partition, span in bounds.items():
            value = F.when(F.col("partition") == partition, span[i]).otherwise(value)
        return value

    return summary.join(quartiles, ["module", "partition"], "left").select(
        "module", "partition",
        bound(0).alias("window_start"), bound(1).alias("window_end"),
        "rows_before_target_filter", "n_rows", "unique_consumers", "min_target_ord", "max_target_ord",
        "excluded_target_unavailable", "known_targets",
        F.when(F.col("module") == "consumption", F.col("mean")).alias("mean"),
        F.when(F.col("module") == "consumption", F.col("sd")).alias("sd"),
        F.when(F.col("module") == "consumption", F.col("minimum")).alias("minimum"),
        F.when(F.col("module") == "consumption", F.col("maximum")).alias("maximum"),
        "q1", "median", "q3", "missing_targets_retained",
        F.when(label, F.try_divide(100.0 * F.col("_zero"), F.col("known_targets").cast("double"))).alias("class_0_percent"),
        F.when(label, F.col("_zero")).alias("class_0"),
        F.when(label, F.col("_one")).alias("class_1"),
        F.when(label, F.try_divide(F.lit(100.0) * F.col("_one"), F.col("known_targets"))).alias("class_1_percent"),
    )


def partition_disjointness(split: DataFrame, bounds: Bounds) -> DataFrame:
    """Per module: months in two partitions, months outside their window, windows out of order."""
    first = F.lit(None).cast("int")
    last = F.lit(None).cast("int")
    for partition, (lo, hi) in bounds.items():
        first = F.when(F.col("partition") == partition, lo).otherwise(first)
        last = F.when(F.col("partition") == partition, hi).otherwise(last)
    months = split.groupBy("module", "target_ord").agg(
        F.count_distinct("partition").alias("_partitions"),
        F.count_if(~F.col("target_ord").between(first, last)).alias("_outside"),
    )
    spans = split.groupBy("module").agg(
        *[
            agg(F.when(F.col("partition") == p, F.col("target_ord"))).alias(f"_{p}_{side}")
            for p in bounds
            for side, agg in (("lo", F.min), ("hi", F.max))
        ],
        F.count_if((F.col("partition") == "FUTURE") & F.col("target").isNotNull()).alias("labelled_future_rows"),
    )
    names = list(bounds)
    disorder = sum(
        (F.coalesce((F.col(f"_{a}_hi") >= F.col(f"_{b}_lo")).cast("int"), F.lit(0)) for a, b in zip(names, names[1:])),
        F.lit(0),
    )
    checked = months.groupBy("module").agg(
        F.count("*").alias("target_months"),
        F.count_if(F.col("_partitions") > 1).alias("shared_months"),
        F.sum("_outside").alias("rows_outside_window"),
    )
    return checked.join(
        spans.select("module", disorder.cast("bigint").alias("windows_out_of_order"), "labelled_future_rows"), "module"
    )
