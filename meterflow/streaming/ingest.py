"""Arrival of later periods: a file stream that checks each batch before it is stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterflow.session import materialize

_LOG = "batch_id long, period int, n_rows long"


def arrivals(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, period, n_rows) of every batch that is stored: one small file a batch, beside the history."""
    try:
        return spark.read.schema(_LOG).parquet(f"{out}.arrivals/*")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    return spark.createDataFrame([], _LOG)


def append_periods(
    batch: DataFrame, batch_id: int, out: str, key: str = "consumer_no", ord: str = "ord",
    then: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Check a batch against the list of stored periods, then append it.

    The batch is stored first and read from there; the history itself is not read. A repeated (key, period)
    inside the batch, a period that is already stored, or a period that
    does not continue the history stops the stream before anything is written. A batch that is
    replayed after a lost driver is compared with the list without itself and replaces its
    own period folders. `then` gets the rows of each period in order, once they are stored, and again with a replay.
    """
    spark = batch.sparkSession
    rows = materialize(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), "batch")
    counts = rows.groupBy(key, ord).agg(F.count("*").alias("n")).groupBy(ord).agg(F.max("n").alias("most"), F.sum("n").alias("n_rows"))
    found = counts.orderBy(ord).collect()
    if any(r.most > 1 for r in found):
        raise ValueError("repeated key in arriving periods")
    arriving = [r[ord] for r in found]
    if not arriving:
        return
    latest = arrivals(spark, out).filter(F.col("batch_id") != batch_id).agg(F.max("period")).first()[0]
    first = arriving[0] if latest is None else latest + 1
    if arriving != list(range(first, first + len(arriving))):
        raise ValueError(f"arriving periods {arriving} do not continue the history at {first}")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(ord)
        .parquet(out)
    )
    log = spark.createDataFrame([(batch_id, r[ord], r.n_rows) for r in found], _LOG)
    log.coalesce(1).write.mode("overwrite").parquet(f"{out}.arrivals/batch={batch_id}")
    for period in arriving if then else []:
        then(rows.filter(F.col(ord) == period).drop("batch_id"), period)


def ingest_new(
    spark: SparkSession, landing: str, out: str, checkpoint: str, schema: StructType,
    key: str = "consumer_no", ord: str = "ord", then: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Process everything that has landed since the last call, then stop."""
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(landing)
    query = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: append_periods(batch, batch_id, out, key, ord, then))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def history_summary(panel: DataFrame, key: str = "consumer_no", ord: str = "ord") -> DataFrame:
    """Rows and consumers per stored period, with the next period to predict."""
    latest = panel.agg(F.max(ord)).scalar()
    return panel.groupBy(ord).agg(
        F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_consumers")
    ).withColumn("next_period", (latest + 1).cast("int"))
