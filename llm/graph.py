"""Connected components of an edge table, without any key's edges meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.session import materialize


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node that each end of an edge can reach.

    Alternates the two star operations of Kiveris and others (2014): every round first hangs each node's
    larger neighbours, then its smaller ones, on the smallest of them. Rounds grow with the logarithm of the
    number of nodes. Minima are combined before the shuffle, joins can be split when skewed, and each round
    is a table in the shared folder. Edges with a null end and loops are ignored; without edges the result is empty.
    """
    u, v = F.col(left), F.col(right)
    now = materialize(
        edges.where(u.isNotNull() & v.isNotNull() & (u != v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges"
    )
    seen = _fingerprint(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
        before, seen = seen, _fingerprint(now)
        if before == seen:
            break
    return now.groupBy("u").agg(F.min("v").alias("v")).unionByName(now.select(F.col("v").alias("u"), "v").distinct()).select(
        F.col("u").alias("node"), F.col("v").alias("component")
    )
