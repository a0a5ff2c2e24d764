"""Calendar-exact history on a consumer-month panel.

A panel has one row per (consumer, ordinal). Months may be absent, so history is addressed by
the ordinal, never by row position. Rows of one consumer are at most the months of the
calendar, which bounds every per-consumer window.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "consumer_no"
ORD = "ord"


def exactly(column: str | Column, months_back: int, key: str = KEY, ord: str = ORD) -> Column:
    """Value exactly `months_back` periods earlier (negative: later), NULL when that period is absent.

    All lags of a panel share one sort per consumer: same keys and order, different frames.
    """
    frame = Window.partitionBy(key).orderBy(ord).rangeBetween(-months_back, -months_back)
    return F.max(column).over(frame)


def calendar_lag(df: DataFrame, columns: Mapping[str, tuple[str, int]], key: str = KEY, ord: str = ORD) -> DataFrame:
    """Add {output: (input, months back)} columns in one pass. Needs unique (key, ord)."""
    return df.withColumns({out: exactly(col, k, key, ord) for out, (col, k) in columns.items()})


def calendar_lag_by_join(df: DataFrame, column: str, months_back: int, out: str, key: str = KEY, ord: str = ORD) -> DataFrame:
    """The same value from an equi-join on the shifted ordinal: the independent check."""
    earlier = df.select(F.col(key), (F.col(ord) + months_back).cast("int").alias(ord), F.col(column).alias(out))
    return df.join(earlier, [key, ord], "left")


def verify_calendar_lags(df: DataFrame, outputs: Mapping[str, tuple[str, int]], key: str = KEY, ord: str = ORD) -> DataFrame:
    """Rows checked and mismatches per output column, looked up in each consumer's months.

    The panel is read and shuffled once: the months of a consumer, at most those of the calendar, become a map
    from the ordinal to the source values, in which every offset of every row is looked up. No window and no
    sort is shared with what is checked. Values are compared null-safe and counted, nothing is collected.
    A row without key or ordinal has no history: its outputs have to be null. Repeated keys are refused.
    """
    sources = sorted({column for column, _ in outputs.values()})
    known = F.col(key).isNotNull() & F.col(ord).isNotNull()
    # Rows without key are counted before the shuffle, so that they form no group of unbounded size.
    consumers = df.groupBy(key).agg(
        F.collect_list(F.when(known, F.struct(F.col(ord).cast("int").alias("at"), F.struct(*sources).alias("values"), F.struct(*outputs).alias("found")))).alias("_months"),
        F.count_if(~known).alias("_unknown"),
        *[F.count_if(~known & F.col(out).isNotNull()).alias(f"_unknown_{out}") for out in outputs],
    )
    by_month = F.map_from_arrays(F.col("_months.at"), F.col("_months.values"))
    rows = consumers.withColumn("_by_month", by_month).select(
        "_by_month", "_unknown", *[f"_unknown_{out}" for out in outputs], F.posexplode_outer("_months").alias("_place", "_row")
    )
    rows = rows.withColumns(
        {f"_at_{k}": F.element_at("_by_month", F.col("_row.at") - k) for k in sorted({k for _, k in outputs.values()})}
    )
    # Counts of rows without key or ordinal stand beside the first of the consumer's rows.
    first = F.coalesce("_place", F.lit(0)) == 0
    present = F.col("_row").isNotNull()
    checked = F.coalesce(F.count_if(present) + F.sum(F.when(first, F.col("_unknown"))), F.lit(0))
    counted = rows.agg(
        checked.alias("_rows"),
        *[
            F.coalesce(
                F.count_if(present & ~F.col("_row.found").getField(out).eqNullSafe(F.col(f"_at_{k}").getField(column)))
                + F.sum(F.when(first, F.col(f"_unknown_{out}"))),
                F.lit(0),
            ).alias(out)
            for out, (column, k) in outputs.items()
        ],
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(out).alias("output"),
                        F.col("_rows").alias("rows_checked"),
                        F.col(out).alias("mismatches"),
                    )
                    for out in outputs
                ]
            )
        )
    )


def require_unique_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Return `df` after checking that no key repeats (runs a job)."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).count()
    if repeated:
        raise ValueError(f"repeated keys {keys}: history joins would multiply rows")
    return df


def internal_gaps(df: DataFrame, key: str = KEY, ord: str = ORD) -> DataFrame:
    """Observed months, span and absent months inside the span, per consumer."""
    return (
        df.groupBy(key)
        .agg(
            F.min(ord).alias("first_ord"),
            F.max(ord).alias("last_ord"),
            F.count("*").alias("observed_months"),
        )
        .withColumn(
            "missing_months", F.col("last_ord") - F.col("first_ord") + 1 - F.col("observed_months")
        )
    )
