"""Streams of sorted rows as whole groups, and what tasks do with the links they find in one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_groups(batches: Iterator[pa.RecordBatch], key: str = "group") -> Iterator[pa.Table]:
    """Tables of whole groups: rows of a group stand together, but may go on in the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(key)
        last = group[-1].as_py()
        same = np.asarray(group.to_numpy(zero_copy_only=False) == last)
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if held and (cut or held[0].column(key)[-1].as_py() != last):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each row's component, for rows 0 .. n-1 with links (i, j)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if (root == before).all():
            return root


def in_blocks(rows: DataFrame, member: str, keys: list[str], seed: int) -> DataFrame:
    """Deal the rows of large groups out in pairs of blocks: every two rows of a group meet in one `group` of the result.

    `blocks` says into how many blocks a row's group is cut. `two` marks groups of two different blocks, in which rows of different `block`
    are to be compared; in the others all rows are.
    """
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), member), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return rows.withColumn("group", F.concat_ws(":", *keys, low, high)).withColumn("two", low != high).drop("other", "blocks")
