"""Features kept up to date month by month, from a small state per consumer instead of the history.

The state holds, for each consumer, the months that a lag can still reach, and count, mean and centred squares of all valid consumptions. A month that arrives is
joined with the state once: that gives its features, the targets of the month before, and the next state. Nothing older is read. Each month is
written to folders of its own and counts once its entry in the list of periods is there, which is written last; so a run that breaks off is
repeated whole, and a month that arrives again changes nothing.

    features/ord=t   targets/ord=t (written when t+1 arrives)   state/ord=t (of the last two months)   periods/ord=t
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators.calendar import KEY, ORD
from meterflow.operators.features import (
    HISTORY,
    NEXT,
    anomaly_label,
    asof_columns,
    derived_history,
    history_columns,
    rule_z,
)
from meterflow.operators.models import input_fingerprint
from meterflow.session import delete, materialize
from meterflow.sources.tables import write_panel

#: The longest look back; a month further back than this is dropped from the state.
REACH = max(k for _, k in HISTORY.values())
KEPT = sorted({column for column, _ in HISTORY.values()})
_PERIODS = "period int, n_rows long, n_consumers long, digest string"


def periods(spark: SparkSession, home: str) -> DataFrame:
    """The months that are complete: (period, n_rows, n_consumers, digest)."""
    try:
        return spark.read.schema(_PERIODS).parquet(f"{home}/periods/*")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    return spark.createDataFrame([], _PERIODS)


def _month(ord: Column) -> Column:
    return F.struct(ord.alias(ORD), *[F.col(c).cast("double").alias(c) for c in KEPT])


def state_of(rows: DataFrame, until: int) -> DataFrame:
    """The state after month `until`, from all rows up to it: used once, to begin."""
    value = F.col("current_consumption")
    recent = F.sort_array(F.collect_list(F.when(F.col(ORD) > until - REACH, _month(F.col(ORD)))))
    n = F.count(value)
    return rows.where(F.col(ORD) <= until).groupBy(KEY).agg(
        n.alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"), (F.coalesce(F.var_pop(value), F.lit(0.0)) * n).alias("squares"), recent.alias("recent")
    )


def _with_history(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The columns that look back, from the state before the rows' month."""

    def exactly(column: str, back: int) -> Column:
        found = F.filter("recent", lambda m: m[ORD] == F.col(ORD) - back)
        return F.try_element_at(found, F.lit(1))[column]

    n = F.coalesce("n", F.lit(0))
    df = rows.join(state, KEY, "left").withColumns(
        {
            **{out: exactly(column, back) for out, (column, back) in HISTORY.items()},
            "prior_count": n.cast("long"),
            "prior_mean": F.when(n > 0, F.col("mean")),
            "prior_std": F.when(n > 1, F.sqrt(F.col("squares") / (n - 1))),
        }
    )
    return derived_history(df.drop(*[c for c in state.columns if c != KEY]))


def next_state(state: DataFrame, rows: DataFrame, ord: int) -> DataFrame:
    """The state after month `ord`; a consumer without a row keeps its numbers and loses what is out of reach."""
    arrived = rows.select(KEY, F.lit(True).alias("here"), F.array(_month(F.col(ORD))).alias("now"), F.col("current_consumption").alias("x"))
    n, mean, squares = (F.coalesce(c, F.lit(0)) for c in ("n", "mean", "squares"))
    counts = F.col("x").isNotNull()
    moved = mean + (F.col("x") - mean) / (n + 1)
    kind = state.schema["recent"].dataType
    empty = F.array().cast(kind)
    kept = F.filter(F.coalesce("recent", empty), lambda m: m[ORD] > ord - REACH)
    return state.join(arrived, KEY, "full").select(
        KEY,
        F.when(counts, n + 1).otherwise(n).cast("long").alias("n"),
        F.when(counts, moved).otherwise(mean).cast("double").alias("mean"),
        F.when(counts, squares + (F.col("x") - mean) * (F.col("x") - moved)).otherwise(squares).cast("double").alias("squares"),
        F.concat(kept, F.coalesce(F.col("now").cast(kind), empty)).alias("recent"),
    )


def _commit(rows: DataFrame, home: str, ord: int, digest: str) -> None:
    entry = rows.agg(F.lit(ord).alias("period"), F.count("*").alias("n_rows"), F.count_distinct(KEY).alias("n_consumers"), F.lit(digest).alias("digest"))
    entry.coalesce(1).write.mode("overwrite").parquet(f"{home}/periods/ord={ord}")


def _write_targets(rows: DataFrame, home: str, ord: int) -> None:
    """What month `ord` says of the month before."""
    names = {source: out for out, (source, _) in NEXT.items()}
    rows.select(KEY, *[F.col(source).alias(out) for source, out in names.items()]).write.mode("overwrite").parquet(f"{home}/targets/ord={ord - 1}")


def begin(panel: DataFrame, home: str) -> int:
    """Store features, targets and state of a whole typed panel, and return its last month. Refuses a folder that has months already."""
    spark = panel.sparkSession
    if not periods(spark, home).isEmpty():
        raise ValueError(f"{home} has been begun")
    rows = materialize(anomaly_label(rule_z(history_columns(asof_columns(panel)))), "begun")
    last = rows.agg(F.max(ORD)).first()[0]
    if last is None:
        raise ValueError("an empty panel has no month to begin with")
    write_panel(rows, f"{home}/features", partition=ORD, mode="overwrite")
    names = {source: out for out, (source, _) in NEXT.items()}
    targets = rows.select(KEY, (F.col(ORD) - 1).alias(ORD), *[F.col(source).alias(out) for source, out in names.items()])
    write_panel(targets, f"{home}/targets", partition=ORD, mode="overwrite")
    state_of(rows, last).write.mode("overwrite").parquet(f"{home}/state/ord={last}")
    _commit(rows, home, last, "")
    return last


def advance(rows: DataFrame, home: str) -> bool:
    """Take in the next month's typed rows; False where that month is complete already, from the same rows.

    Rows of several months, a repeated consumer, a month that does not follow the last one, and other rows for a complete month are refused.
    """
    spark = rows.sparkSession
    rows = materialize(asof_columns(rows), "arrived")
    seen = rows.agg(F.min(ORD).alias("first"), F.max(ORD).alias("ord"), F.count("*").alias("n"), F.count_distinct(KEY).alias("keys")).first()
    if not seen.n or seen.first != seen.ord or seen.keys != seen.n:
        raise ValueError("a month has one row a consumer, and all rows are of that month")
    ord, known = seen.ord, periods(spark, home)
    last = known.agg(F.max("period")).first()[0]
    if last is None or ord > last + 1:
        raise ValueError(f"month {ord} does not follow {last}")
    digest = input_fingerprint(rows)
    if ord <= last:
        if known.where((F.col("period") == ord) & (F.col("digest") == digest)).isEmpty():
            raise ValueError(f"month {ord} is complete and had other rows")
        return False
    state = spark.read.parquet(f"{home}/state/ord={last}")
    features = materialize(anomaly_label(rule_z(_with_history(rows, state))), "featured")
    features.drop(ORD).write.mode("overwrite").parquet(f"{home}/features/ord={ord}")
    _write_targets(features, home, ord)
    next_state(state, rows, ord).write.mode("overwrite").parquet(f"{home}/state/ord={ord}")
    _commit(rows, home, ord, digest)
    delete(spark, f"{home}/state/ord={last - 1}")
    return True


def maintained(spark: SparkSession, home: str) -> DataFrame:
    """The feature table: what `build_features` gives of all months taken in."""
    last = periods(spark, home).agg(F.max("period")).scalar()
    features = spark.read.parquet(f"{home}/features").where(F.col(ORD) <= last)
    targets = spark.read.parquet(f"{home}/targets").where(F.col(ORD) < last)
    return features.join(targets, [KEY, ORD], "left")
