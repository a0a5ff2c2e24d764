import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from meterflow.functions import pvalues
from meterflow.operators import association


def test_tails_against_closed_forms():
    assert pvalues.chi_square_tail(3.0, 2) == pytest.approx(math.exp(-1.5), rel=1e-12)
    assert pvalues.chi_square_tail(40.0, 4) == pytest.approx(math.exp(-20) * 21, rel=1e-10)
    assert pvalues.chi_square_tail(1.0, 1) == pytest.approx(math.erfc(math.sqrt(0.5)), rel=1e-12)
    # One degree of freedom: the angle of the tangent; two: a closed form in r.
    for r in (0.1, -0.5, 0.99):
        t = abs(r) / math.sqrt(1 - r * r)
        assert pvalues.correlation_tail(r, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-10)
        assert pvalues.correlation_tail(r, 2) == pytest.approx(1 - abs(r), rel=1e-10)


def test_tails_at_many_degrees_of_freedom():
    """Cube roots of chi-square values, and correlations, are close to normal at 1e10 degrees of freedom."""
    n, normal = 1e10, lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    for z in (-3, -1, 0, 0.5, 1, 2, 3, 5):
        x = n + z * math.sqrt(2 * n)
        root = ((x / n) ** (1 / 3) - 1 + 2 / (9 * n)) / math.sqrt(2 / (9 * n))
        assert pvalues.chi_square_tail(x, n) == pytest.approx(normal(root), abs=1e-8)
        assert pvalues.correlation_tail(z / math.sqrt(n + z * z), n) == pytest.approx(2 * normal(abs(z)), abs=1e-8)


def test_tails_do_not_return_unfinished_values(monkeypatch):
    monkeypatch.setattr(pvalues, "_MOST_TERMS", 3)
    with pytest.raises(ArithmeticError):
        pvalues.chi_square_tail(2100.0, 2000)
    with pytest.raises(ArithmeticError):
        pvalues.correlation_tail(0.05, 900)



def table(spark, cells):
    return spark.createDataFrame([(a, b) for (a, b), n in cells.items() for _ in range(n)], "a string, b string")


def test_chi_square_matches_library(spark):
    df = table(spark, {("x", "N"): 30, ("x", "Y"): 20, ("y", "N"): 12, ("y", "Y"): 33})
    row = association.chi_square_test(association.crosstab_counts(df, "a", "b"), "a", "b").first()
    coded = df.select((F.col("a") == "x").cast("double").alias("f"), (F.col("b") == "Y").cast("double").alias("label"))
    other = ChiSquareTest.test(VectorAssembler(inputCols=["f"], outputCol="features").transform(coded), "features", "label").first()
    assert row.status == "performed" and row.degrees_of_freedom == 1
    assert row.statistic == pytest.approx(other.statistics[0]) and row.p_value == pytest.approx(other.pValues[0])


def test_sparse_or_degenerate_tables_are_skipped(spark):
    sparse = table(spark, {("x", "N"): 3, ("x", "Y"): 1, ("y", "N"): 2, ("y", "Y"): 1})
    row = association.chi_square_test(association.crosstab_counts(sparse, "a", "b"), "a", "b").first()
    assert row.status == "skipped" and row.statistic is None and row.p_value is None and row.degrees_of_freedom == 1
    flat = table(spark, {("x", "N"): 30, ("y", "N"): 30})
    row = association.chi_square_test(association.crosstab_counts(flat, "a", "b"), "a", "b").first()
    assert row.status == "skipped" and row.degrees_of_freedom is None


def test_occurring_pairs_give_the_result_of_the_filled_table(spark):
    counts = {(a, b): (7 * i + 3 * j) % 11 * 9 for i, a in enumerate("pqrst") for j, b in enumerate("xyz")}
    df = table(spark, counts)
    pairs = association.observed_pairs(df, "a", "b")
    cells = association.expected_counts(association.crosstab_counts(df, "a", "b"), "a", "b").collect()
    assert pairs.count() < len(cells) == 15
    row = association.chi_square_test(pairs, "a", "b").first()
    assert row.statistic == pytest.approx(sum((c.observed - c.expected) ** 2 / c.expected for c in cells), rel=1e-12)
    assert row.minimum_expected == min(c.expected for c in cells)
    assert row.percent_expected_below_5 == 100.0 * sum(c.expected < 5 for c in cells) / 15
    filled = association.chi_square_test(association.crosstab_counts(df, "a", "b"), "a", "b").first()
    assert filled.status == row.status == "performed" and filled.degrees_of_freedom == row.degrees_of_freedom == 8
    assert filled.statistic == pytest.approx(row.statistic, rel=1e-12)


def test_limits_of_expected_counts_are_exact(spark):
    """Expected counts of exactly 5 are not below 5; totals of several sizes agree with the cells."""
    df = table(spark, {("p", "x"): 5, ("p", "y"): 5, ("q", "x"): 5, ("q", "y"): 5})
    assert association.chi_square_test(association.observed_pairs(df, "a", "b"), "a", "b").first().percent_expected_below_5 == 0
    df = table(spark, {("p", "x"): 49, ("p", "y"): 1, ("q", "x"): 49, ("q", "y"): 9, ("r", "x"): 392})
    cells = association.expected_counts(association.crosstab_counts(df, "a", "b"), "a", "b").collect()
    row = association.chi_square_test(association.observed_pairs(df, "a", "b"), "a", "b").first()
    assert row.percent_expected_below_5 == 100.0 * sum(c.expected < 5 for c in cells) / 6


def test_many_sparse_categories_build_no_grid(spark):
    """100,000 x 1,000 labels: pairs and margins only, against the sums in numpy."""
    a, b = F.pmod(F.col("id") * 7919, F.lit(100_000)), F.pmod(F.xxhash64("id"), F.lit(1_000))
    df = spark.range(400_000).select(a.cast("string").alias("a"), F.when(F.col("id") % 3 == 0, 0).otherwise(b).alias("b"))
    pairs = association.observed_pairs(df, "a", "b")
    test = association.chi_square_test(pairs, "a", "b")
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    row, cells = test.first(), pairs.toPandas()
    rows, columns = cells.groupby("a")["observed"].sum().to_numpy(), cells.groupby("b")["observed"].sum().to_numpy()
    below = sum(np.searchsorted(np.sort(columns), -(-5 * 400_000 // r)) for r in rows)
    assert row.sample_size == 400_000 and row.degrees_of_freedom == (len(rows) - 1) * (len(columns) - 1)
    assert (len(rows), len(columns)) == (100_000, 1_000) and row.status == "skipped"
    assert row.percent_expected_below_5 == pytest.approx(100 * below / (len(rows) * len(columns)))
    assert row.minimum_expected == pytest.approx(rows.min() * columns.min() / 400_000)


def test_no_rows_or_only_nulls(spark):
    for rows in ([], [(None, "x"), ("p", None)]):
        df = spark.createDataFrame(rows, "a string, b string")
        row = association.chi_square_test(association.observed_pairs(df, "a", "b"), "a", "b").first()
        assert row.sample_size == 0 and row.status == "skipped" and row.statistic is None
        assert association.crosstab_counts(df, "a", "b").count() == 0


def test_filled_blocks_hold_every_pair(spark, monkeypatch):
    monkeypatch.setattr(association, "FILL_BLOCK", 3)
    df = spark.range(40).select(F.concat(F.lit("a"), F.col("id") % 4).alias("a"), F.concat(F.lit("b"), F.col("id")).alias("b"))
    cells = association.crosstab_counts(df, "a", "b")
    assert cells.count() == 160 and cells.distinct().count() == 160 and cells.agg(F.sum("observed")).first()[0] == 40


def test_stable_consumers_count_missing_as_a_value(spark):
    rows = [(1, "a"), (1, "a"), (2, "a"), (2, None), (3, "b"), (3, "a"), (4, "z")]
    found = {
        r.consumer_no: r
        for r in association.stable_consumers(spark.createDataFrame(rows, "consumer_no int, c string"), {"c": ["a", "b"]}).collect()
    }
    assert found[1].included and not found[2].included and found[2].changing_c
    assert found[3].changing_c and found[4].invalid and not found[4].changing_c


def test_pearson_needs_variation(spark):
    rows = [(i, 1.0, float(i)) for i in range(5)]
    row = association.pearson_test(spark.createDataFrame(rows, "consumer_no int, x double, y double"), "x", "y").first()
    assert row.status == "skipped" and row.r is None and row.p_value is None


def test_four_digits(spark):
    values = [0.99964, 12.5, 1234567.0, -0.000123456, 0.0, 9999.6, 100.0, 4120.5, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(association.four_digits(F.col("v"))).collect()]
    assert got == [f"{v:.4g}" for v in values]


def test_four_digits_of_very_small_and_large_values(spark):
    values = [1.0671e-222, -3.5e-100, 2.25e150, 9.9996e99, 9.9996e-101]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(association.four_digits(F.col("v"))).collect()]
    assert got == ["1.067e-222", "-3.5e-100", "2.25e+150", "1e+100", "1e-100"]
