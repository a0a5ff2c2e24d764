"""Running totals and exact quantiles that no single task has to hold.

A window without partition keys, or with one hot key, would sort the whole group in one
task. Here equal values are first merged (a value that fills a third of the rows becomes one
row), the merged rows are range-partitioned, and each range adds the total of the ranges
before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.session import materialize


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    measures: Sequence[str],
    descending: bool = False,
) -> DataFrame:
    """Add `<m>_before` (sum over earlier rows) and `<m>_total` (sum over the group).

    `df` holds one row per (`by`, `order`), without missing keys. The range-partitioned rows
    are written out because both the range totals and the rows must see the same ranges.
    """
    by = list(by)
    direction = F.col(order).desc() if descending else F.col(order).asc()
    ranged = df.repartitionByRange(*by, direction).withColumn("_range", F.spark_partition_id())
    stored = materialize(ranged, "ranges")

    # At most one row per range and group boundary.
    range_totals = stored.groupBy(*by, "_range").agg(*[F.sum(m).alias(m) for m in measures])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = range_totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_{m}_offset") for m in measures],
        *[F.sum(m).over(group).alias(f"{m}_total") for m in measures],
    )
    inside = (
        Window.partitionBy(*by, "_range")
        .orderBy(direction)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        stored.join(offsets, [*by, "_range"])
        .select(
            *df.columns,
            *[
                (F.col(f"_{m}_offset") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(
                    f"{m}_before"
                )
                for m in measures
            ],
            *[f"{m}_total" for m in measures],
        )
    )


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, quantiles: dict[str, float]
) -> DataFrame:
    """Linearly interpolated quantiles of `value` per group, one output column per quantile.

    For groups that can grow with the data. A group bounded by the calendar (one consumer's
    months) is cheaper with the built-in `percentile`.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    ranked = running_totals(counts, by, value, ["n"])
    first, after = F.col("n_before"), F.col("n_before") + F.col("n")

    def at(position):
        return F.max(F.when((first <= position) & (position < after), F.col(value)))

    pieces = []
    for name, q in quantiles.items():
        position = F.lit(float(q)) * (F.col("n_total") - 1)
        pieces += [
            at(F.floor(position)).alias(f"_lo_{name}"),
            at(F.ceil(position)).alias(f"_hi_{name}"),
            F.max(position - F.floor(position)).alias(f"_part_{name}"),
        ]
    grouped = ranked.groupBy(*by).agg(*pieces)
    return grouped.select(
        *by,
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_part_{name}")
            ).alias(name)
            for name in quantiles
        ],
    )
