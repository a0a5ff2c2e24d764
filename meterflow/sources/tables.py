"""Typed tables between stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_panel(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Named columns of a stored panel; only they are read. A missing name is an error."""
    panel = spark.read.parquet(path)
    missing = sorted(set(columns) - set(panel.columns))
    if missing:
        raise ValueError(f"missing columns {missing}")
    return panel.select(*columns)


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", partition: str = "ord", mode: str = "errorifexists") -> None:
    """Store a panel by period.

    The rebalance gathers the rows of a period, so that not every task writes a file for every
    period, and splits a period that is too large for one task.
    """
    writer = df.hint("rebalance", partition).write.mode(mode).partitionBy(partition)
    if fmt == "csv":
        writer = writer.option("header", True).option("dateFormat", "yyyy-MM-dd")
    writer.format(fmt).save(path)


def write_partitions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder per module and partition, large ones written by several tasks."""
    df.hint("rebalance", "module", "partition").write.mode(mode).partitionBy("module", "partition").parquet(path)


def write_once(df: DataFrame, path: str) -> None:
    """Store evidence that must not be replaced: fails when the path exists."""
    df.write.mode("errorifexists").parquet(path)


def required_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each required name with its presence, type and number of filled rows."""
    types = dict(df.dtypes)
    filled = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(n).alias(f"_n{i}") for i, n in enumerate(names) if n in types],
    )
    return filled.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("name"),
                        F.lit(n in types).alias("present"),
                        F.lit(types.get(n)).alias("type"),
                        (F.col(f"_n{i}") if n in types else F.lit(0).cast("bigint")).alias("filled_rows"),
                    )
                    for i, n in enumerate(names)
                ]
            )
        )
    )


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Return `df`, or stop and name what is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df
