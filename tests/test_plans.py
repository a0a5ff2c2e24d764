"""Raw files to next-month predictions on a small made-up utility."""

import random

import pytest
from pyspark.sql import functions as F

from meterflow import schema
from meterflow.operators import models, quality
from meterflow.plans import history, module_run

FIRST, MONTHS, CONSUMERS = 2023 * 12 + 3, 24, 40


def extract_line(consumer, ordinal, rng):
    year, month = ordinal // 12, ordinal % 12 + 1
    use = 100 + 5 * consumer + rng.randint(-20, 20)
    paid = rng.random() < 0.7
    values = dict.fromkeys(schema.EXTRACT_HEADER, "")
    values |= {
        "MONTH": str(month), "YEAR": str(year), "CONSUMER_NO": f"C{consumer:04d}", "CONNECTION_DATE": "2020-01-01",
        "CONTRACT_LOAD": str(1 + consumer % 5), "TARRIF": ["RGPU", "NRGP", "LTMD"][consumer % 3], "METER_STATUS": "OK",
        "CONSUMPTION_UNIT": str(use), "BILL_AMOUNT": str(use * 7), "PAYMENT_AMOUNT": str(use * 6) if paid else "",
        "PAYMENT_DATE": f"{year}-{month:02d}-20" if paid else "", "BILL_DATE": f"{year}-{month:02d}-05",
        "DUE_DATE": f"{year}-{month:02d}-25", "CLOSING_ARREARS": str(rng.randint(0, 500)), "SOLAR_CONSUMER": "N", "PHASE": "1",
    }
    return "|".join(values[n] for n in schema.EXTRACT_HEADER) + "|"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    rng = random.Random(5)
    folder = tmp_path_factory.mktemp("raw")
    for ordinal in range(FIRST, FIRST + MONTHS):
        lines = ["|".join(schema.EXTRACT_HEADER) + "|"] + [extract_line(c, ordinal, rng) for c in range(CONSUMERS)]
        (folder / f"512LDG{ordinal % 12 + 1}{ordinal // 12}.txt").write_text("\n".join(lines) + "\n")
    return history.load_extracts(spark, str(folder), str(tmp_path_factory.mktemp("text") / "panel"))


@pytest.fixture(scope="module")
def table(raw, tmp_path_factory):
    return history.feature_table(history.clean(raw), str(tmp_path_factory.mktemp("features") / "table"))


def test_audit_of_a_clean_history(raw):
    cleaned = history.clean(raw)
    assert "_trailing" not in cleaned.columns and raw.count() == cleaned.count() == MONTHS * CONSUMERS
    audit = history.audit(raw, cleaned, FIRST, FIRST + MONTHS - 1)
    status = quality.quality_status(audit, history.BLOCKERS).first()
    assert status.status == "completed" and status.blocking_records == 0
    sections = {r.section: r.n for r in audit.groupBy("section").agg(F.count("*").alias("n")).collect()}
    assert {"missing", "categorical", "descriptive", "outlier", "coverage", "duplicates", "conversion", "logical"} <= set(sections)
    assert sections["descriptive"] == 8 * 5 and sections["outlier"] == 4 * 5
    wider = history.audit(raw, cleaned, FIRST - 1, FIRST + MONTHS - 1)
    assert quality.quality_status(wider, history.BLOCKERS).first().status == "manual_review_required"


def test_feature_checks_hold(table):
    assert table.count() == MONTHS * CONSUMERS
    history.require_no_violations(history.feature_checks(table))
    assert table.filter("consumption_lag1 is null").count() == CONSUMERS


BOUNDS = history.bounds_after(FIRST + 15, FIRST + 19, FIRST + MONTHS - 1, FIRST + 1)


def test_consumption_module(spark, table, tmp_path):
    result = module_run.run_module(table, "consumption", BOUNDS, str(tmp_path / "c"), models.linear_ladder())
    assert result.predictions.count() == CONSUMERS
    rows = {r.configuration: r for r in result.final_test.collect()}
    assert set(rows) == {result.selected, "Persistence"}
    assert rows[result.selected].sample_count == rows["Persistence"].sample_count == 4 * CONSUMERS
    assert rows[result.selected].RMSE < rows["Persistence"].RMSE
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        module_run.run_module(table, "consumption", BOUNDS, str(tmp_path / "c"), models.linear_ladder())


def test_anomaly_module_with_named_choice(spark, table, tmp_path):
    grid = models.tree_classifier("anomaly", [3])
    result = module_run.run_module(table, "anomaly", BOUNDS, str(tmp_path / "a"), grid, choice="DT-1-balanced")
    assert result.selected == "DT-1-balanced"
    rows = {r.configuration: r.position for r in result.comparison.collect()}
    assert set(rows) == {"TRAIN-majority", "DT-1", "DT-1-balanced"} and rows["TRAIN-majority"] is None
    scored = result.predictions.agg(F.count("*").alias("n"), F.min("probability").alias("lo"), F.max("probability").alias("hi")).first()
    assert scored.n == CONSUMERS and 0 <= scored.lo <= scored.hi <= 1
    assert {r.configuration for r in result.final_test.collect()} == {"DT-1-balanced", "TRAIN-majority"}


def test_a_rival_gates_the_anomaly_choice(table, tmp_path):
    grid = models.tree_classifier("anomaly", [3])
    with pytest.raises(ValueError, match="gates"):  # never better than itself
        module_run.run_module(table, "anomaly", BOUNDS, str(tmp_path / "g"), grid, choice="DT-1-balanced", rival="DT-1-balanced")
    with pytest.raises(ValueError, match="no configuration"):
        module_run.run_module(table, "anomaly", BOUNDS, str(tmp_path / "h"), grid, choice="DT-1", rival="DT-9")
