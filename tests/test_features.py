"""Hand-made panels: gap months, payment cases, perturbations."""

import pytest
from pyspark.sql import functions as F

from meterflow import schema
from meterflow.operators import calendar, features

COLUMNS = (
    "consumer_no period consumption_unit bill_amount payment_amount payment_date due_date "
    "connection_date contract_load closing_arrears tarrif solar_consumer"
).split()


def row(consumer="example", period="2025-03", consumption="20", payment="50", paid="2025-04-01", due="2025-04-05", bill="100"):
    return (consumer, period, consumption, bill, payment, paid, due, "2025-01-01", "2", "10", "RGPU", "N")


GAPS = [
    row(period="2025-01", consumption="10", paid="2025-06-01", due="2025-06-10"),
    row(period="2025-03", consumption="20"),
    row(period="2025-04", consumption="30", paid="2025-06-01", due="2025-06-10"),
    row(period="2025-05", consumption="40", paid="2025-06-01", due="2025-06-10"),
]


def build(spark, rows):
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))
    return features.build_features(features.typed_panel(raw))


def by_month(spark, rows):
    return {r.ord % 12 + 1: r for r in build(spark, rows).collect()}


def test_gap_months(spark):
    months = by_month(spark, GAPS)
    january, march, april, may = (months[m] for m in (1, 3, 4, 5))
    assert january.consumption_next is None and march.consumption_next == 30
    assert march.consumption_lag1 is None and march.consumption_lag2 == 10 and march.consumption_lag3 is None
    assert march.recent_mean_3 is None and april.recent_std_3 is None
    assert april.consumption_lag1 == 20 and april.consumption_lag2 is None and april.consumption_lag3 == 10
    assert april.payment_ratio_lag1 is None
    assert may.consumption_lag3 is None and may.recent_mean_3 == 30 and may.recent_std_3 == 10
    assert (may.prior_count, may.prior_mean, may.prior_std) == (3, 20, 10)
    assert may.rule_z_current == 2 and may.anomaly_current == 0


def predictors(rows):
    names = sorted(set(schema.CONSUMPTION_PREDICTORS + schema.REVENUE_PREDICTORS))
    return {m: tuple(r[n] for n in names) for m, r in rows.items()}


def test_later_consumption_changes_no_earlier_predictor(spark):
    changed = [*GAPS[:3], row(period="2025-05", consumption="99999", paid="2025-06-01", due="2025-06-10")]
    before, after = by_month(spark, GAPS), by_month(spark, changed)
    for month in (1, 3, 4):
        assert predictors(before)[month] == predictors(after)[month]
    assert after[5].prior_mean == 20


def test_unobserved_payments_change_no_predictor(spark):
    changed = [tuple("99999" if i == 4 else v for i, v in enumerate(r)) for r in GAPS]
    assert predictors(by_month(spark, GAPS)) == predictors(by_month(spark, changed))


def test_constant_series_has_no_score(spark):
    flat = [tuple("10" if i == 2 else v for i, v in enumerate(r)) for r in GAPS]
    may = by_month(spark, flat)[5]
    assert may.prior_std == 0 and may.rule_z_current is None and may.anomaly_current is None


# consumer, payment, paid on, due -> ratio at cutoff, delay, ratio at due date, at risk
CASES = {
    "zero": ("0", "2025-03-20", "2025-03-25", 0, -5, 0, 1),
    "missing": ("", "2025-03-20", "2025-03-25", None, -5, None, None),
    "invalid": ("bad", "2025-03-20", "2025-03-25", None, -5, None, None),
    "absent": ("99", "", "2025-03-25", None, None, 0, 1),
    "late": ("99", "2025-04-01", "2025-03-25", None, None, 0, 1),
    "future_on_time": ("99", "2025-04-01", "2025-04-05", None, None, 0.99, 0),
    "cutoff_boundary": ("50", "2025-03-31", "2025-03-31", 0.5, 0, 0.5, 0),
    "threshold": ("50", "2025-03-20", "2025-03-25", 0.5, -5, 0.5, 0),
    "invalid_due": ("50", "2025-03-20", "bad", 0.5, None, None, None),
    "unreadable_date": ("50", "20-03-2025", "2025-03-25", None, None, None, None),
}


def test_payment_cases(spark):
    rows = [row(name, payment=c[0], paid=c[1], due=c[2]) for name, c in CASES.items()]
    rows += [row("no_bill", paid="2025-03-20", due="2025-03-25", bill="0")]
    found = {r.consumer_no: r for r in build(spark, rows).collect()}
    for name, case in CASES.items():
        r = found[name]
        got = (r.payment_ratio_current, r.payment_delay_current, r.payment_ratio_outcome, r.at_risk_current)
        assert got == case[3:], name
    assert found["no_bill"].payment_ratio_current is None and found["no_bill"].at_risk_current is None


def test_checks_find_a_wrong_lag_and_a_wrong_label(spark):
    built = build(spark, GAPS)
    broken = built.withColumn("consumption_lag2", F.col("consumption_lag2") + 1).withColumn(
        "at_risk_current", 1 - F.col("at_risk_current")
    )
    lags = {r.output: r.mismatches for r in calendar.verify_calendar_lags(broken, features.HISTORY).collect()}
    assert lags["consumption_lag2"] == 2 and lags["consumption_lag1"] == 0
    rules = {r.check_name: r.violations for r in features.feature_rule_checks(broken).collect()}
    assert rules["at_risk_threshold"] == 4 and rules["tenure_not_negative"] == 0


def test_lag_check_equals_a_check_by_joins(spark):
    """Gaps, rows without key or ordinal, planted errors, forward and backward offsets."""
    rows = [(c, o, (c * 31 + o * 7) % 13) for c in range(40) for o in range(100, 130) if (c * o) % 5]
    panel = spark.createDataFrame(rows, "consumer_no int, ord int, v int")
    lagged = calendar.calendar_lag(panel, {"back": ("v", 1), "year": ("v", 12), "next": ("v", -1)})
    wrong = lagged.withColumn("year", F.when(F.col("ord") % 9 == 0, F.coalesce("year", F.lit(0)) + 1).otherwise(F.col("year")))
    outputs = {"back": ("v", 1), "year": ("v", 12), "next": ("v", -1)}
    found = {r.output: r for r in calendar.verify_calendar_lags(wrong, outputs).collect()}
    for out, (column, k) in outputs.items():
        joined = calendar.calendar_lag_by_join(wrong, column, k, "joined")
        assert found[out].mismatches == joined.filter(~F.col("joined").eqNullSafe(F.col(out))).count()
        assert found[out].rows_checked == len(rows)
    assert found["year"].mismatches == sum(o % 9 == 0 for _, o, _ in rows) and found["back"].mismatches == 0
    plan = calendar.verify_calendar_lags(wrong, outputs)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan ExistingRDD") == 1
    odd = spark.createDataFrame([(None, 5, 1, None), (None, 6, 1, 1), (1, None, 2, 2), (1, 5, 3, None)], "consumer_no int, ord int, v int, back int")
    row = calendar.verify_calendar_lags(odd, {"back": ("v", 1)}).first()
    assert (row.rows_checked, row.mismatches) == (4, 2)
    assert calendar.verify_calendar_lags(odd.limit(0), {"back": ("v", 1)}).first().rows_checked == 0


def test_window_and_join_agree(spark):
    panel = build(spark, GAPS).select("consumer_no", "ord", "current_consumption", "consumption_lag2")
    joined = calendar.calendar_lag_by_join(panel, "current_consumption", 2, "joined")
    assert joined.filter(~F.col("joined").eqNullSafe(F.col("consumption_lag2"))).count() == 0


def test_repeated_key_is_refused(spark):
    raw = spark.createDataFrame([row(), row()], ", ".join(f"{c} string" for c in COLUMNS))
    with pytest.raises(ValueError):
        calendar.require_unique_keys(features.typed_panel(raw), ["consumer_no", "ord"])


def test_leakage_guard():
    for names in schema.PREDICTORS.values():
        assert features.leakage_guard(names) == []
    assert features.leakage_guard(["prior_mean", "current_consumption", "at_risk_next"]) == ["at_risk_next", "prior_mean"]


@pytest.mark.parametrize("level", [1e6, 1e9])
def test_prior_statistics_of_large_values(spark, level):
    """Correct rows near a large level count as correct, a planted error is counted."""
    rows = [("a", 24000 + k, level + (k * 7) % 5) for k in range(40)] + [("b", 24000 + k, None if k == 3 else level * k) for k in range(12)]
    panel = spark.createDataFrame(rows, "consumer_no string, ord int, current_consumption double")
    found = features.prior_stats(panel)
    assert tuple(features.prior_stats_check(found).first()) == (52, 0, 0, 0)
    wrong = found.withColumn("prior_mean", F.when((F.col("ord") == 24020) & (F.col("consumer_no") == "a"), F.col("prior_mean") * 1.01).otherwise(F.col("prior_mean")))
    assert features.prior_stats_check(wrong).first().mean_mismatches == 1


def test_prior_stats_check_where_earlier_months_are_alike(spark):
    # Equal or nearly equal months far from the consumer's mean: their deviation must not drown in the rounding of larger squares.
    values = [0.1, 0.1, 0.1, 9e8, 3e8] + [7e8] * 20
    far = [5e8 + 0.3, 5e8 + 0.3, 5e8 + 0.3, 0.7, None, 0.9, 3.0]
    rows = [(c, 24000 + k, v) for c, series in (("a", values), ("b", far), ("c", [None, 2.5])) for k, v in enumerate(series)]
    found = features.prior_stats(spark.createDataFrame(rows, "consumer_no string, ord int, current_consumption double"))
    assert tuple(features.prior_stats_check(found).first()) == (34, 0, 0, 0)
    here = (F.col("ord") == 24003) & (F.col("consumer_no") == "b")
    wrong = found.withColumn("prior_std", F.when(here, F.lit(1e-3)).otherwise(F.col("prior_std")))
    assert features.prior_stats_check(wrong).first().std_mismatches == 1


def test_white_space_of_any_kind_is_blank(spark):
    paid = ["", "\t", "\xa0 \n", "2025-04-01"]
    found = build(spark, [row(consumer=str(k), paid=p, payment="0") for k, p in enumerate(paid)]).orderBy("consumer_no").collect()
    assert [r.payment_blank for r in found] == [True, True, True, False]
    assert [r.at_risk_current for r in found[:3]] == [1, 1, 1]
