"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
_SCRATCH: set[str] = set()
_RECORD: ContextVar[list[str] | None] = ContextVar("recorded", default=None)


def build_session(app: str = "meterflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; sizing stays with the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    A local session without the setting gets one temporary folder of its own. A cluster
    session without it is refused: a machine-local folder would be lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="meterflow-")
    return _LOCAL_SCRATCH[context.applicationId]


def scratch_root(spark: SparkSession) -> str:
    """The application's own folder below the shared one; it is deleted when the application ends."""
    context = spark.sparkContext
    root = f"{shared_dir(spark)}/meterflow/{context.applicationId}"
    if root not in _SCRATCH:
        path = context._jvm.org.apache.hadoop.fs.Path(root)
        system = path.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _SCRATCH.add(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path for an intermediate table of this application."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if (record := _RECORD.get()) is not None:
        record.append(path)
    return path


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """The scratch paths that are handed out inside the block, for `delete` once what reads them has been written."""
    paths: list[str] = []
    token = _RECORD.set(paths)
    try:
        yield paths
    finally:
        _RECORD.reset(token)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own, if it is there."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing `df` to the shared folder and reading it back.

    Used where a plan reads one intermediate twice and both reads must see the same
    rows (partition numbers of a range shuffle, scores of a fitted model). The written
    table survives executor loss, unlike a cache.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
