"""Operators of a training-data pipeline over documents, conversations and embeddings."""

import os

from pyspark.sql import SparkSession


def for_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import the package from where the driver has it, whatever their working folder, and bound what they hold.

    On a cluster whose machines don't see that folder, ship the packages with --py-files as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    # Documents are long rows: Spark's 10,000 of them at a time would fill the workers' memory.
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark
