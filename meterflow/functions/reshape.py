"""Small reshaping helpers shared by the profile operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_form(
    df: DataFrame, columns: Sequence[str], name: str, value: str, keep: Sequence[str] = ()
) -> DataFrame:
    """(keep..., name, value) rows, one per input row and column."""
    return df.unpivot(list(keep), list(columns), name, value)


def one_row_to_long(row: DataFrame, key: str, entries: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per entry: {entry: {output column: expression}}."""
    structs = [
        F.struct(F.lit(entry).alias(key), *[c.alias(out) for out, c in outputs.items()])
        for entry, outputs in entries.items()
    ]
    return row.select(F.inline(F.array(*structs)))


def scalar_row(df: DataFrame, *columns: str) -> Column:
    """A one-row frame as a struct value: a scalar subquery instead of a cross join."""
    return df.select(F.struct(*columns)).scalar()
