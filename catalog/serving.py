"""Prediction tables, dashboard totals and consumer views, on rule predictions for the next month."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import P1, SPLITS, query
from catalog.features import built
from meterflow.operators import evaluate, serving, splits
from meterflow.session import materialize
from meterflow.sources import bindings

# Next-month rule predictions; a consumer without a rule's inputs lacks that prediction.
PREDICTIONS = (
    SPLITS
    + """,
fu AS (SELECT * FROM sp WHERE "partition" = 'FUTURE' AND module = 'consumption'),
pa AS (SELECT consumer_no, target_ord, coalesce(recent_mean_3, current_consumption) AS prediction FROM fu WHERE recent_mean_3 IS NOT NULL),
pb AS (SELECT consumer_no, target_ord, CAST(q > 0.5 AS INT) AS predicted_class, q AS probability
  FROM (SELECT consumer_no, target_ord, 1 - least(1, coalesce(payment_ratio_current, 0)) AS q FROM fu WHERE payment_ratio_current IS NOT NULL)),
pc AS (SELECT consumer_no, target_ord, CAST(q > 0.3 AS INT) AS predicted_class, q AS probability
  FROM (SELECT consumer_no, target_ord, coalesce(recent_std_3 / (recent_std_3 + recent_mean_3), 0) AS q FROM fu WHERE recent_std_3 IS NOT NULL))
"""
)
SERVED = (
    PREDICTIONS
    + """,
sv AS (SELECT coalesce(pa.consumer_no, pb.consumer_no, pc.consumer_no) AS consumer_no, coalesce(pa.target_ord, pb.target_ord, pc.target_ord) AS target_ord,
  pa.prediction AS predicted_consumption, pb.predicted_class AS revenue_risk_class, pb.probability AS revenue_risk_probability,
  pc.predicted_class AS anomaly_class, pc.probability AS anomaly_probability, pa.prediction IS NOT NULL AS has_consumption_prediction,
  pb.predicted_class IS NOT NULL AS has_revenue_prediction, pc.predicted_class IS NOT NULL AS has_anomaly_prediction,
  CASE pb.predicted_class WHEN 1 THEN 'Risk' WHEN 0 THEN 'No Risk' END AS revenue_risk, CASE pc.predicted_class WHEN 1 THEN 'Unusual' WHEN 0 THEN 'Normal' END AS unusual_consumption
  FROM pa FULL JOIN pb ON pb.consumer_no = pa.consumer_no FULL JOIN pc ON pc.consumer_no = coalesce(pa.consumer_no, pb.consumer_no)),
att AS (SELECT consumer_no, tarrif, contract_load, solar_consumer FROM p1 WHERE ord = (SELECT max(ord) FROM p1)),
sa AS (SELECT sv.*, tarrif, contract_load, solar_consumer FROM sv LEFT JOIN att ON att.consumer_no = sv.consumer_no)
"""
)


def future(spark, folder):
    rows = splits.module_rows(built(spark, folder), bindings.P1_BOUNDS, "consumption")
    needed = ["consumer_no", "target_ord", "recent_mean_3", "recent_std_3", "current_consumption", "payment_ratio_current"]
    return materialize(rows.filter("partition = 'FUTURE'").select(*needed), "future")


def rule_predictions(rows):
    """(consumption, revenue, anomaly) for the rows to be scored."""
    keys = ["consumer_no", "target_ord"]
    a = rows.filter("recent_mean_3 IS NOT NULL").select(*keys, F.coalesce("recent_mean_3", "current_consumption").alias("prediction"))
    paid = F.least(F.lit(1.0), F.coalesce("payment_ratio_current", F.lit(0.0)))
    b = rows.filter("payment_ratio_current IS NOT NULL").select(*keys, (F.lit(1.0) - paid).alias("probability"))
    spread = F.coalesce(F.try_divide(F.col("recent_std_3"), F.col("recent_std_3") + F.col("recent_mean_3")), F.lit(0.0))
    c = rows.filter("recent_std_3 IS NOT NULL").select(*keys, spread.alias("probability"))
    return (
        a,
        b.withColumn("predicted_class", (F.col("probability") > 0.5).cast("int")),
        c.withColumn("predicted_class", (F.col("probability") > 0.3).cast("int")),
    )


def predictions(spark, folder):
    return rule_predictions(future(spark, folder))


_P = ["predicted_consumption", "revenue_risk_probability", "anomaly_probability"]


@query("consolidate_predictions", f"""WITH {PREDICTIONS} SELECT coalesce(pa.consumer_no, pb.consumer_no, pc.consumer_no) AS consumer_no, coalesce(pa.target_ord, pb.target_ord, pc.target_ord) AS target_ord,
  pa.prediction AS predicted_consumption, pb.predicted_class AS predicted_revenue_risk_class, pb.probability AS revenue_class_1_probability,
  pc.predicted_class AS predicted_anomaly_class, pc.probability AS anomaly_class_1_probability, pa.prediction IS NOT NULL AS has_consumption_prediction,
  pb.predicted_class IS NOT NULL AS has_revenue_prediction, pc.predicted_class IS NOT NULL AS has_anomaly_prediction
FROM pa FULL JOIN pb ON pb.consumer_no = pa.consumer_no AND pb.target_ord = pa.target_ord
FULL JOIN pc ON pc.consumer_no = coalesce(pa.consumer_no, pb.consumer_no) AND pc.target_ord = coalesce(pa.target_ord, pb.target_ord)""",
    ["predicted_consumption", "revenue_class_1_probability", "anomaly_class_1_probability"])
def consolidate_predictions(spark, folder):
    return serving.consolidate_predictions(*predictions(spark, folder))


@query("serving_predictions", f"WITH {SERVED} SELECT * FROM sv", _P)
def serving_predictions(spark, folder):
    return serving.serving_predictions(*predictions(spark, folder))


@query("latest_attributes", f"""WITH {P1} SELECT consumer_no, tarrif, contract_load, solar_consumer FROM p1 WHERE ord = (SELECT max(ord) FROM p1)""")
def latest_attributes(spark, folder):
    return serving.latest_attributes(bindings.supplier_months(spark, folder), ["tarrif", "contract_load", "solar_consumer"])


def served(spark, folder):
    attributes = serving.latest_attributes(
        bindings.supplier_months(spark, folder), ["tarrif", "contract_load", "solar_consumer"]
    )
    return serving.predictions_with_attributes(serving.serving_predictions(*predictions(spark, folder)), attributes)


@query("predictions_with_attributes", f"WITH {SERVED} SELECT * FROM sa", _P)
def predictions_with_attributes(spark, folder):
    return served(spark, folder)


@query("search_filter", f"""WITH {SERVED} SELECT consumer_no, revenue_risk, unusual_consumption, tarrif FROM sa
WHERE CAST(consumer_no AS VARCHAR) LIKE '%1%' AND revenue_risk = 'Risk' AND unusual_consumption = 'Normal' AND tarrif = 'ASIA'
UNION ALL SELECT consumer_no, revenue_risk, unusual_consumption, tarrif FROM sa WHERE CAST(consumer_no AS VARCHAR) LIKE '%2%'""")
def search_filter(spark, folder):
    rows = served(spark, folder).select("consumer_no", "revenue_risk", "unusual_consumption", "tarrif")
    narrow = serving.search_filter(rows, " 1 ", "Risk", "Normal", "ASIA")
    return narrow.unionByName(serving.search_filter(rows, "2"))


@query("prediction_kpis", f"""WITH {SERVED} SELECT count(DISTINCT consumer_no) AS consumers, sum(predicted_consumption) AS predicted_consumption,
  count(*) FILTER (revenue_risk_class = 1) AS revenue_risk, 100.0 * count(*) FILTER (revenue_risk_class = 1) / CAST(count(revenue_risk_class) AS DOUBLE) AS revenue_risk_percent,
  count(*) FILTER (anomaly_class = 1) AS unusual, 100.0 * count(*) FILTER (anomaly_class = 1) / CAST(count(anomaly_class) AS DOUBLE) AS unusual_percent FROM sv""",
    ["predicted_consumption", "revenue_risk_percent", "unusual_percent"])
def prediction_kpis(spark, folder):
    return serving.prediction_kpis(serving.serving_predictions(*predictions(spark, folder)))


@query("prediction_coverage", f"""WITH {PREDICTIONS} SELECT 'consumption' AS module, count(prediction) AS predictions, count(*) FILTER (isfinite(prediction)) AS finite_predictions, count(DISTINCT consumer_no) AS unique_consumers,
  min(target_ord) AS target_ord, count(DISTINCT target_ord) AS target_periods,
  count(*) FILTER (prediction < 0) AS negative_predictions, min(prediction) AS minimum, max(prediction) AS maximum, CAST(NULL AS BIGINT) AS predicted_class_0, CAST(NULL AS BIGINT) AS predicted_class_1,
  (SELECT count(*) FROM fu) AS future_rows, 100.0 * count(prediction) / CAST((SELECT count(*) FROM fu) AS DOUBLE) AS coverage_percent FROM pa
UNION ALL SELECT 'revenue', count(probability), count(*) FILTER (isfinite(probability)), count(DISTINCT consumer_no), min(target_ord), count(DISTINCT target_ord), count(*) FILTER (probability < 0), min(probability), max(probability),
  count(*) FILTER (predicted_class = 0), count(*) FILTER (predicted_class = 1), (SELECT count(*) FROM fu), 100.0 * count(probability) / CAST((SELECT count(*) FROM fu) AS DOUBLE) FROM pb""",
    ["minimum", "maximum", "coverage_percent"])
def prediction_coverage(spark, folder):
    rows = future(spark, folder)
    a, b, _ = rule_predictions(rows)
    first = evaluate.prediction_coverage(a, rows, "prediction").withColumn("module", F.lit("consumption"))
    second = evaluate.prediction_coverage(b, rows, "probability", "predicted_class").withColumn("module", F.lit("revenue"))
    return second.unionByName(first, allowMissingColumns=True)


@query("prediction_audit", f"""WITH {PREDICTIONS}, bad AS (SELECT consumer_no, target_ord, CASE WHEN consumer_no % 13 = 0 THEN 2 ELSE predicted_class END AS predicted_class,
  CASE WHEN consumer_no % 17 = 0 THEN NULL WHEN consumer_no % 19 = 0 THEN 1.5 ELSE probability END AS probability FROM pb
  UNION ALL SELECT consumer_no, target_ord, predicted_class, probability FROM pb WHERE consumer_no % 23 = 1)
SELECT 'consumption' AS module, count(*) AS n_rows, count(DISTINCT consumer_no) AS unique_consumers, CAST(0 AS BIGINT) AS wrong_period, CAST(0 AS BIGINT) AS missing_predictions,
  CAST(0 AS BIGINT) AS nonfinite_predictions, CAST(NULL AS BIGINT) AS unknown_class_labels, CAST(NULL AS BIGINT) AS missing_probabilities, CAST(NULL AS BIGINT) AS probabilities_outside_0_1,
  count(DISTINCT consumer_no) AS unique_keys, (SELECT count(*) FROM pa) AS expected_consumers, CAST(0 AS BIGINT) AS duplicate_key_rows, 'PASS' AS status FROM pa
UNION ALL SELECT 'revenue', count(*), count(DISTINCT consumer_no), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), count(*) FILTER (predicted_class NOT IN (0, 1)),
  count(*) FILTER (probability IS NULL), count(*) FILTER (NOT coalesce(probability BETWEEN 0 AND 1, false)), count(DISTINCT consumer_no), (SELECT count(*) FROM fu), count(*) - count(DISTINCT consumer_no), 'FAIL' FROM bad""")
def prediction_audit(spark, folder):
    """The consumption set is clean; the revenue set has repeated keys, bad classes and bad probabilities."""
    rows = future(spark, folder)
    a, b, _ = rule_predictions(rows)
    k = F.col("consumer_no")
    broken = b.select(
        "consumer_no", "target_ord",
        F.when(k % 13 == 0, 2).otherwise(F.col("predicted_class")).alias("predicted_class"),
        F.when(k % 19 == 0, F.when(k % 17 != 0, 1.5)).when(k % 17 != 0, F.col("probability")).alias("probability"),
    ).unionByName(b.filter("consumer_no % 23 = 1"))
    clean = evaluate.prediction_audit(a, "prediction", 24023, a.agg(F.count("*")).scalar())
    dirty = evaluate.prediction_audit(
        broken, "predicted_class", 24023, rows.agg(F.count("*")).scalar(), "predicted_class", "probability"
    )
    return dirty.withColumn("module", F.lit("revenue")).unionByName(
        clean.withColumn("module", F.lit("consumption")), allowMissingColumns=True
    )


# Financial year 1998-1999 holds ordinals 23979..23990.
_FY = "ord BETWEEN 23979 AND 23990"


@query("period_kpis", f"""WITH {P1}, s AS (SELECT * FROM p1 WHERE {_FY}) SELECT count(DISTINCT consumer_no) AS consumers, sum(consumption_unit) AS total_consumption, sum(bill_amount) AS total_bill,
  sum(payment_amount) AS total_payment, sum(closing_arrears) FILTER (ord = (SELECT max(ord) FROM s)) AS closing_arrears_period_end,
  sum(consumption_unit) / count(DISTINCT consumer_no) AS consumption_per_consumer FROM s""",
    ["total_bill", "total_payment", "closing_arrears_period_end", "consumption_per_consumer"], 5)
def period_kpis(spark, folder):
    return serving.period_kpis(serving.select_periods(bindings.supplier_months(spark, folder), "1998-1999"))


_TOTALS = """sum(consumption_unit) AS total_consumption, sum(bill_amount) AS bill_amount, coalesce(sum(payment_amount), 0) AS payment_amount,
  sum(closing_arrears) AS closing_arrears, count(DISTINCT consumer_no) AS consumers"""
_MONEY = ["bill_amount", "payment_amount", "closing_arrears"]


@query("monthly_trend", f"WITH {P1} SELECT ord, {_TOTALS} FROM p1 WHERE {_FY} GROUP BY ord", _MONEY, 5)
def monthly_trend(spark, folder):
    return serving.monthly_trend(serving.select_periods(bindings.supplier_months(spark, folder), "1998-1999"))


@query("tariff_rollup", f"""WITH {P1} SELECT CASE WHEN consumer_no % 9 = 0 THEN 'Missing' ELSE tarrif END AS tarrif, {_TOTALS}, avg(consumption_unit) AS average_consumption
FROM p1 WHERE ord % 12 = 4 GROUP BY 1""", [*_MONEY, "average_consumption"], 5)
def tariff_rollup(spark, folder):
    rows = serving.select_periods(bindings.supplier_months(spark, folder), month=5)
    return serving.tariff_rollup(rows.withColumn("tarrif", F.when(F.col("consumer_no") % 9 != 0, F.col("tarrif"))))


@query("melt_series", f"""WITH {P1} SELECT consumer_no, ord, 'bill_amount' AS series, bill_amount AS amount FROM p1 UNION ALL SELECT consumer_no, ord, 'payment_amount', payment_amount FROM p1""")
def melt_series(spark, folder):
    return serving.melt_series(bindings.supplier_months(spark, folder), ["consumer_no", "ord"], ["bill_amount", "payment_amount"])


def served_view(spark, folder):
    """Panel and predictions, each stored once for the views that read them together."""
    return bindings.supplier_months(spark, folder), serving.serving_predictions(*predictions(spark, folder))


@query("consumer_360", f"""WITH {SERVED}, r AS (SELECT *, row_number() OVER (PARTITION BY consumer_no ORDER BY ord DESC) AS i FROM p1),
h AS (SELECT consumer_no, max(ord) AS latest_ord, max(consumption_unit) FILTER (i = 1) AS last_actual, avg(consumption_unit) AS mean, quantile_cont(consumption_unit, 0.5) AS median,
  min(consumption_unit) AS minimum, max(consumption_unit) AS maximum, max(consumption_unit) FILTER (i = 1) AS latest, avg(consumption_unit) FILTER (i <= 3) AS recent_average,
  CASE WHEN count(*) >= 2 THEN max(consumption_unit) FILTER (i = 1) - max(consumption_unit) FILTER (i = least(3, n)) END AS recent_trend
  FROM (SELECT *, count(*) OVER (PARTITION BY consumer_no) AS n FROM r) GROUP BY consumer_no)
SELECT h.*, predicted_consumption, predicted_consumption - last_actual AS change, CASE WHEN last_actual <> 0 THEN 100.0 * (predicted_consumption - last_actual) / last_actual END AS change_percent
FROM h LEFT JOIN sv ON sv.consumer_no = h.consumer_no""", ["mean", "median", "recent_average", "predicted_consumption", "change", "change_percent"])
def consumer_360(spark, folder):
    return serving.consumer_360(*served_view(spark, folder))


@query("actual_plus_prediction", f"""WITH {SERVED}, l AS (SELECT consumer_no, max(ord) AS ord FROM p1 GROUP BY 1)
SELECT consumer_no, ord, consumption_unit AS value, 'Historical Actual' AS series FROM p1
UNION ALL SELECT p1.consumer_no, p1.ord, consumption_unit, 'Prediction' FROM p1 JOIN l ON l.consumer_no = p1.consumer_no AND l.ord = p1.ord
  WHERE p1.consumer_no IN (SELECT consumer_no FROM sv WHERE predicted_consumption IS NOT NULL)
UNION ALL SELECT consumer_no, target_ord, predicted_consumption, 'Prediction' FROM sv WHERE predicted_consumption IS NOT NULL""", ["value"])
def actual_plus_prediction(spark, folder):
    return serving.actual_plus_prediction(*served_view(spark, folder))
