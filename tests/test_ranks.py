"""Distributed running totals and quantiles against brute force, with one hot value and group."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.operators import metrics
from meterflow.operators.ranks import exact_quantiles, running_totals

TIED = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.3), (0, 0.1)]


def skewed(spark, n=5000):
    """A third of the rows is one value of one group."""
    rng = np.random.default_rng(7)
    rows = [("hot", 0.0)] * (n // 3) + [("hot" if i % 2 else "cold", float(v)) for i, v in enumerate(rng.normal(size=n).round(2))]
    return spark.createDataFrame(rows, "g string, v double").repartition(8), rows


def test_quantiles(spark):
    df, rows = skewed(spark)
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", {"q1": 0.25, "m": 0.5, "q9": 0.9}).collect()}
    for g in ("hot", "cold"):
        values = [v for h, v in rows if h == g]
        assert [got[g].q1, got[g].m, got[g].q9] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.9])))


def test_running_totals_without_groups(spark):
    counts = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"), F.lit(2).alias("n"))
    rows = running_totals(counts, [], "v", ["n"]).collect()
    assert len(rows) == 1000 and all(r.n_before == 2 * r.v and r.n_total == 2000 for r in rows)


def test_tied_scores(spark):
    df = spark.createDataFrame(TIED, "y int, p double")
    row = metrics.ranking_metrics(df, "y", "p").first()
    assert row.ROC_AUC == pytest.approx(7 / 9) and row.AP == pytest.approx(1 / 3 + 2 / 9 + 1 / 5)
    points = sorted({(r.fpr, r.tpr) for r in metrics.roc_points(df, "y", "p").collect()})
    assert [x for x, _ in points] == pytest.approx([0, 0, 1 / 3, 2 / 3, 1])
    assert [y for _, y in points] == pytest.approx([0, 1 / 3, 2 / 3, 1, 1])


def test_class_metrics(spark):
    df = spark.createDataFrame(TIED, "y int, p double").withColumn("label", (F.col("p") > 0.5).cast("int"))
    row = metrics.classification_metrics(df, "y", "label").first()
    cells = [row[f"true_{a}_predicted_{b}"] for a in (0, 1) for b in (0, 1)]
    assert cells == [2, 1, 1, 2] and row.Accuracy == pytest.approx(4 / 6)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, p double")
    assert metrics.ranking_metrics(df, "y", "p").first().ROC_AUC is None


def test_no_single_task_sort(spark):
    """The rank windows are keyed by range, so no stage sorts all rows in one task."""
    df = spark.createDataFrame(TIED, "y int, p double")
    plan = metrics.ranking_metrics(df, "y", "p")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "_range" in plan
