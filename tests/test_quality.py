"""Duplicates with one hot key, parsing rules, and checks on hand-made rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterflow.functions import scalars
from meterflow.operators import quality


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows shares one key, in two variants and many copies."""
    rows = [("hot", 1, "a" if i % 3 else "b") for i in range(300)]
    rows += [(f"k{i % 250}", i % 4, "a") for i in range(600)]
    return spark.createDataFrame(rows, "k string, p int, v string").repartition(8), rows


def test_duplicate_keys(hot):
    df, rows = hot
    counts = {k: n for k, n in Counter((k, p) for k, p, _ in rows).items() if n > 1}
    want = Counter()
    for (_, p), n in counts.items():
        want[p] += n
    assert {r.p: r.member_rows for r in quality.duplicate_keys(df, ["k", "p"], ["p"]).collect()} == dict(want)


def test_conflicts_keep_every_variant(hot):
    df, rows = hot
    got = {(r.k, r.p, r.v): r.copies for r in quality.conflicting_duplicates(df, ["k", "p"]).collect()}
    assert got == {("hot", 1, "a"): 200, ("hot", 1, "b"): 100}
    assert quality.drop_exact_duplicates(df).count() == len(set(rows))


NUMBERS = {
    "12": 12.0, " -3.5 ": -3.5, "1e3": 1000.0, ".5": 0.5, "7.": 7.0, "+4": 4.0, "inf": float("inf"), "-Infinity": float("-inf"),
    "": None, " ": None, "12d": None, "12f": None, "1_000": None, "1,000": None, "nan": None, "NA": None, "0x10": None, "--1": None,
}


def test_numbers(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    assert {r.t: r.v for r in df.select("t", scalars.to_number(F.col("t")).alias("v")).collect()} == NUMBERS


def test_days(spark):
    texts = ["2025-02-28", "2025-02-30", "2025-3-1", " 2025-03-01", "2025-03-01 00:00", "", "2024-02-29"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [str(r.d) if r.d else None for r in df.select(scalars.to_day(F.col("t")).alias("d")).collect()]
    assert got == ["2025-02-28", None, None, None, None, None, "2024-02-29"]


def test_indian_digits(spark):
    values = [0.0, 0.5, 1.5, 2.5, 999.0, 1000.0, 123456.0, 1234567.89, -98765432.1, 0.05, 0.25, 0.35, 100000000.0, 2.675]

    def expected(v, d):
        whole, _, fraction = f"{abs(v):.{d}f}".partition(".")
        head, tail = whole[:-3], whole[-3:]
        groups = [tail]
        while head:
            groups.insert(0, head[-2:])
            head = head[:-2]
        return ("-" if v < 0 else "") + ",".join(groups) + ("." + fraction if d else "")

    df = spark.createDataFrame([(v,) for v in values], "v double")
    for d in (0, 1, 2):
        got = [r[0] for r in df.select(scalars.format_indian(F.col("v"), d)).collect()]
        assert got == [expected(v, d) for v in values]
    none = spark.range(1).select(scalars.format_indian(F.lit(None).cast("double"))).first()[0]
    assert none == "Not available"


def test_empty_columns_are_dropped_only_when_blank(spark):
    df = spark.createDataFrame([(1, "", " "), (2, "  ", "x")], "id int, a string, b string")
    assert quality.drop_empty_columns(df, ["a", "b"]).columns == ["id", "b"]


def test_audit_sections_literal(spark):
    rows = [("a", "1", 1.0), (" A", "NA", 2.0), ("", "x", float("inf")), ("b", "?", 3.0), ("a", "", 100.0), (None, "4", None)]
    df = spark.createDataFrame(rows, "kind string, amount string, v double")
    parts = [quality.missing_section(df.select("kind", "amount"), ["amount"]), quality.disguised_section(df, ["amount"]),
             quality.category_section(df, ["kind"]), quality.measure_section(df, ["v"])]
    found = {(r.section, r.column_name, r.finding, r.value): r for r in quality.audit_table(*parts).collect()}

    def n(*key):
        return found[(*key, "")[:4]].n

    assert n("missing", "amount", "literal_blank") == 1 and n("missing", "amount", "missing_after_typing") == 4
    assert n("disguised_missing", "amount", "NA") == 1 and n("disguised_missing", "amount", "[blank/whitespace]") == 1
    assert n("categorical", "kind", "category_frequency", "a") == 2 and n("categorical", "kind", "category_frequency", "[missing]") == 2
    assert n("categorical", "kind", "unique_categories") == 3 and n("categorical", "kind", "blank_missing") == 2
    assert n("categorical", "kind", "normalization_collision_groups") == 1
    described = {f: r.measure for (s, _, f, _), r in found.items() if s in ("descriptive", "outlier")}
    assert (described["n"], described["minimum"], described["median"], described["maximum"]) == (4, 1.0, 2.5, 100.0)
    assert (described["q1"], described["q3"], described["iqr"]) == (1.75, 27.25, 25.5)
    outside = found["outlier", "v", "potential_outliers", ""]
    assert (outside.n, outside.denominator, outside.percent) == (1, 4, 25.0)
    empty = quality.audit_table(quality.category_section(df.limit(0), ["kind"]), quality.disguised_section(df.limit(0), ["amount"]))
    assert empty.count() == 0
