"""Panel, feature and label queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import FEATURES, P1, P2, P3, query
from meterflow import schema
from meterflow.functions import scalars
from meterflow.operators import calendar, features
from meterflow.session import materialize, scratch_path
from meterflow.sources import bindings
from meterflow.streaming import ingest, maintained

KEYS = ["consumer_no", "ord"]


def p1(spark, folder):
    return bindings.supplier_months(spark, folder)


def built(spark, folder):
    return features.build_features(p1(spark, folder))


def panel(spark, folder):
    """P1 stored, for queries that read it more than once."""
    return materialize(p1(spark, folder), "panel")


def feature_table(spark, folder):
    """The features stored, as the stages of a pipeline hand them over."""
    return materialize(built(spark, folder), "features")


def _fx(columns: str) -> str:
    return f"WITH {FEATURES} SELECT consumer_no, ord, {columns} FROM fx"


@query(
    "consumption_features",
    f"""WITH {FEATURES}
SELECT ord, count(*) AS n_consumers, count(consumption_lag1) AS n_lag1, count(rule_z_current) AS n_scored,
       sum(CAST(coalesce(anomaly_current, 0) AS BIGINT))::BIGINT AS n_anomalies,
       sum(CAST(coalesce(at_risk_current, 0) AS BIGINT))::BIGINT AS n_at_risk,
       avg(prior_mean) AS mean_prior_mean, max(abs(rule_z_current)) AS max_abs_z,
       sum(consumption_next) AS next_consumption, avg(payment_ratio_mean3) AS mean_ratio3
FROM fx GROUP BY ord""",
    floats=["mean_prior_mean", "max_abs_z", "mean_ratio3"],
    digits=5,
)
def consumption_features(spark, folder):
    """Flagship: lineitem -> panel -> features -> labels -> targets, summarised per month."""
    return built(spark, folder).groupBy("ord").agg(
        F.count("*").alias("n_consumers"),
        F.count("consumption_lag1").alias("n_lag1"),
        F.count("rule_z_current").alias("n_scored"),
        F.sum(F.coalesce("anomaly_current", F.lit(0))).alias("n_anomalies"),
        F.sum(F.coalesce("at_risk_current", F.lit(0))).alias("n_at_risk"),
        F.avg("prior_mean").alias("mean_prior_mean"),
        F.max(F.abs("rule_z_current")).alias("max_abs_z"),
        F.sum("consumption_next").alias("next_consumption"),
        F.avg("payment_ratio_mean3").alias("mean_ratio3"),
    )


@query("calendar_lag", f"""WITH {P1}
SELECT a.consumer_no, a.ord, b.bill_amount AS bill_lag1, c.bill_amount AS bill_lag12, d.bill_amount AS bill_lead1
FROM p1 a LEFT JOIN p1 b ON b.consumer_no = a.consumer_no AND b.ord = a.ord - 1
LEFT JOIN p1 c ON c.consumer_no = a.consumer_no AND c.ord = a.ord - 12
LEFT JOIN p1 d ON d.consumer_no = a.consumer_no AND d.ord = a.ord + 1""")
def calendar_lag(spark, folder):
    lagged = calendar.calendar_lag(
        p1(spark, folder),
        {"bill_lag1": ("bill_amount", 1), "bill_lag12": ("bill_amount", 12), "bill_lead1": ("bill_amount", -1)},
    )
    return lagged.select(*KEYS, "bill_lag1", "bill_lag12", "bill_lead1")


@query("calendar_lag_sparse", f"""WITH {P2}
SELECT a.consumer_no, a.ord, b.bill_amount AS bill_lag1, c.bill_amount AS bill_lag2
FROM p2 a LEFT JOIN p2 b ON b.consumer_no = a.consumer_no AND b.ord = a.ord - 1
LEFT JOIN p2 c ON c.consumer_no = a.consumer_no AND c.ord = a.ord - 2""")
def calendar_lag_sparse(spark, folder):
    lagged = calendar.calendar_lag(
        bindings.customer_months(spark, folder),
        {"bill_lag1": ("bill_amount", 1), "bill_lag2": ("bill_amount", 2)},
    )
    return lagged.select(*KEYS, "bill_lag1", "bill_lag2")


@query("calendar_lag_daily", f"""WITH {P3}
SELECT a.consumer_no, a.ord, b.consumption_unit AS value_lag1, c.consumption_unit AS value_lag7
FROM p3 a LEFT JOIN p3 b ON b.consumer_no = a.consumer_no AND b.ord = a.ord - 1
LEFT JOIN p3 c ON c.consumer_no = a.consumer_no AND c.ord = a.ord - 7""")
def calendar_lag_daily(spark, folder):
    lagged = calendar.calendar_lag(
        bindings.user_days(spark, folder),
        {"value_lag1": ("consumption_unit", 1), "value_lag7": ("consumption_unit", 7)},
    )
    return lagged.select(*KEYS, "value_lag1", "value_lag7")


_OUTPUTS = {**features.HISTORY, **features.NEXT}


@query("verify_calendar_lags", f"""WITH {P1}
SELECT o.output, (SELECT count(*) FROM p1) AS rows_checked, CAST(0 AS BIGINT) AS mismatches
FROM (VALUES {", ".join(f"('{o}')" for o in _OUTPUTS)}) o(output)""")
def verify_calendar_lags(spark, folder):
    return calendar.verify_calendar_lags(feature_table(spark, folder), _OUTPUTS)


@query("internal_gaps", f"""WITH {P2}
SELECT consumer_no, min(ord) AS first_ord, max(ord) AS last_ord, count(*) AS observed_months,
       max(ord) - min(ord) + 1 - count(*) AS missing_months
FROM p2 GROUP BY consumer_no""")
def internal_gaps(spark, folder):
    return calendar.internal_gaps(bindings.customer_months(spark, folder))


@query("cutoff_and_target", _fx("feature_cutoff_date, target_ord, target_month"))
def cutoff_and_target(spark, folder):
    df = features.cutoff_and_target(p1(spark, folder))
    return df.select(*KEYS, "feature_cutoff_date", "target_ord", "target_month")


@query("valid_measures", f"""WITH {P1}, odd AS (
SELECT consumer_no, ord,
  CASE WHEN ord % 7 = 0 THEN -consumption_unit WHEN ord % 11 = 0 THEN CAST('inf' AS DOUBLE) ELSE consumption_unit END AS c,
  CASE WHEN ord % 5 = 0 THEN CAST('nan' AS DOUBLE) ELSE closing_arrears END AS a FROM p1)
SELECT consumer_no, ord, CASE WHEN isfinite(c) AND c >= 0 THEN c END AS current_consumption,
       CASE WHEN isfinite(a) THEN a END AS arrears_current FROM odd""")
def valid_measures(spark, folder):
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    odd = p1(spark, folder).withColumns(
        {
            "consumption_unit": F.when(F.col("ord") % 7 == 0, -F.col("consumption_unit"))
            .when(F.col("ord") % 11 == 0, inf)
            .otherwise(F.col("consumption_unit")),
            "closing_arrears": F.when(F.col("ord") % 5 == 0, nan).otherwise(F.col("closing_arrears")),
        }
    )
    return features.valid_measures(odd).select(*KEYS, "current_consumption", "arrears_current")


@query("payment_ratio_asof", _fx("payment_observed_by_cutoff, payment_ratio_current"), ["payment_ratio_current"])
def payment_ratio_asof(spark, folder):
    df = features.payment_ratio_asof(p1(spark, folder))
    return df.select(*KEYS, "payment_observed_by_cutoff", "payment_ratio_current")


@query("payment_delay_asof", _fx("payment_delay_current"))
def payment_delay_asof(spark, folder):
    return features.payment_delay_asof(p1(spark, folder)).select(*KEYS, "payment_delay_current")


@query("payment_ratio_outcome", _fx("payment_ratio_outcome"), ["payment_ratio_outcome"])
def payment_ratio_outcome(spark, folder):
    return features.payment_ratio_outcome(p1(spark, folder)).select(*KEYS, "payment_ratio_outcome")


@query("at_risk_label", _fx("at_risk_current"))
def at_risk_label(spark, folder):
    df = features.at_risk_label(features.payment_ratio_outcome(p1(spark, folder)))
    return df.select(*KEYS, "at_risk_current")


@query("tenure_months", f"""WITH {P1}, moved AS (
SELECT consumer_no, ord, CASE WHEN consumer_no % 3 = 0 THEN connection_ord + 30 ELSE connection_ord END AS c FROM p1)
SELECT consumer_no, ord, ord < c AS negative_tenure_flag,
       CAST(CASE WHEN ord >= c THEN ord - c END AS INT) AS tenure_months FROM moved""")
def tenure_months(spark, folder):
    moved = p1(spark, folder).withColumn(
        "connection_date",
        F.when(F.col("consumer_no") % 3 == 0, F.add_months("connection_date", 30)).otherwise(
            F.col("connection_date")
        ),
    )
    return features.tenure_months(moved).select(*KEYS, "negative_tenure_flag", "tenure_months")


@query("consumption_lags", _fx("consumption_lag1, consumption_lag2, consumption_lag3"))
def consumption_lags(spark, folder):
    df = features.consumption_lags(features.valid_measures(p1(spark, folder)))
    return df.select(*KEYS, "consumption_lag1", "consumption_lag2", "consumption_lag3")


@query("same_month_last_year", _fx("same_month_last_year"))
def same_month_last_year(spark, folder):
    df = features.same_month_last_year(features.valid_measures(p1(spark, folder)))
    return df.select(*KEYS, "same_month_last_year")


@query("recent_window_3", _fx("recent_mean_3, recent_std_3, consumption_trend_3"), ["recent_mean_3", "recent_std_3"])
def recent_window_3(spark, folder):
    lagged = features.consumption_lags(features.valid_measures(p1(spark, folder)))
    df = features.recent_window_3(lagged)
    return df.select(*KEYS, "recent_mean_3", "recent_std_3", "consumption_trend_3")


_RATIOS = ["payment_ratio_lag1", "payment_ratio_lag2_audit", "payment_ratio_mean3"]


@query("payment_history", _fx(", ".join(_RATIOS)), _RATIOS)
def payment_history(spark, folder):
    df = features.payment_history(features.payment_ratio_asof(p1(spark, folder)))
    return df.select(*KEYS, *_RATIOS)


@query("arrears_trend", _fx("arrears_current, arrears_lag1, arrears_trend"), ["arrears_trend"])
def arrears_trend(spark, folder):
    df = features.arrears_trend(features.valid_measures(p1(spark, folder)))
    return df.select(*KEYS, "arrears_current", "arrears_lag1", "arrears_trend")


@query("prior_stats", _fx("prior_count, prior_mean, prior_std"), ["prior_mean", "prior_std"])
def prior_stats(spark, folder):
    df = features.prior_stats(features.valid_measures(p1(spark, folder)))
    return df.select(*KEYS, "prior_count", "prior_mean", "prior_std")


@query("rule_z", _fx("rule_z_current"), ["rule_z_current"])
def rule_z(spark, folder):
    df = features.rule_z(features.prior_stats(features.valid_measures(p1(spark, folder))))
    return df.select(*KEYS, "rule_z_current")


@query("anomaly_label", _fx("anomaly_current"))
def anomaly_label(spark, folder):
    scored = features.rule_z(features.prior_stats(features.valid_measures(p1(spark, folder))))
    return features.anomaly_label(scored).select(*KEYS, "anomaly_current")


@query("next_targets", _fx("consumption_next, at_risk_next, anomaly_next"))
def next_targets(spark, folder):
    return built(spark, folder).select(*KEYS, *features.NEXT)


@query("prior_stats_check", f"""WITH {P1}
SELECT count(*) AS rows_checked, CAST(0 AS BIGINT) AS count_mismatches, CAST(0 AS BIGINT) AS mean_mismatches,
       CAST(0 AS BIGINT) AS std_mismatches FROM p1""")
def prior_stats_check(spark, folder):
    return features.prior_stats_check(
        features.prior_stats(features.valid_measures(p1(spark, folder)))
    )


_RULES = [
    "cutoff_observation", "unobserved_payment_hidden", "ratio_recomputed", "unpaid_by_due_is_zero",
    "at_risk_threshold", "tenure_not_negative", "first_month_has_no_history", "complete_mean_3",
    "trend_3", "arrears_trend", "anomaly_needs_history", "anomaly_threshold",
]


@query("feature_rule_checks", f"""WITH {P1}
SELECT r.check_name, (SELECT count(*) FROM p1) AS rows_checked, CAST(0 AS BIGINT) AS violations
FROM (VALUES {", ".join(f"('{r}')" for r in _RULES)}) r(check_name)""")
def feature_rule_checks(spark, folder):
    return features.feature_rule_checks(built(spark, folder))


_FULL = """feature_cutoff_date target_ord target_month current_consumption arrears_current bill_amount
contract_load payment_observed_by_cutoff payment_ratio_current payment_delay_current
payment_ratio_outcome at_risk_current tenure_months negative_tenure_flag consumption_lag1
consumption_lag2 consumption_lag3 same_month_last_year payment_ratio_lag1 payment_ratio_lag2_audit
arrears_lag1 recent_mean_3 recent_std_3 consumption_trend_3 payment_ratio_mean3 arrears_trend
prior_count prior_mean prior_std rule_z_current anomaly_current consumption_next at_risk_next
anomaly_next tarrif solar_consumer""".split()


@query(
    "build_features",
    _fx(", ".join(_FULL)),
    ["payment_ratio_current", "payment_ratio_outcome", "recent_mean_3", "recent_std_3", *_RATIOS,
     "arrears_trend", "prior_mean", "prior_std", "rule_z_current"],
)
def build_features(spark, folder):
    return built(spark, folder).select(*KEYS, *_FULL)


@query("leakage_guard", f"""WITH {P1}
SELECT m.module, m.n_predictors, CAST(0 AS BIGINT) AS n_forbidden, (SELECT count(*) FROM p1) AS n_rows
FROM (VALUES ('consumption', CAST(12 AS BIGINT)), ('revenue', CAST(12 AS BIGINT)), ('anomaly', CAST(12 AS BIGINT))) m(module, n_predictors)""")
def leakage_guard(spark, folder):
    """The guard on the predictors found in the built table, with the rows they cover."""
    table = built(spark, folder)
    found = {
        module: [c for c in names if c in table.columns] for module, names in schema.PREDICTORS.items()
    }
    rows = table.agg(F.count("*").alias("n_rows"))
    return rows.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(module).alias("module"),
                        F.lit(len(names)).cast("bigint").alias("n_predictors"),
                        F.lit(len(features.leakage_guard(names))).cast("bigint").alias("n_forbidden"),
                        "n_rows",
                    )
                    for module, names in found.items()
                ]
            )
        )
    )


@query("normalize_period", """WITH t AS (
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m')
  WHEN 1 THEN strftime(last_day(CAST(o_orderdate AS DATE)), '%Y-%m-%d')
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN strftime(o_orderdate, '%Y/%m') ELSE '' END AS period,
  CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, period,
  CASE WHEN o_orderkey % 5 = 0 THEN 'month'
       WHEN o_orderkey % 5 = 1 OR (o_orderkey % 5 = 2 AND d = last_day(d)) THEN 'month_end' ELSE 'invalid' END AS kind,
  CASE WHEN o_orderkey % 5 IN (0, 1) OR (o_orderkey % 5 = 2 AND d = last_day(d))
       THEN CAST(year(d) * 12 + month(d) - 1 AS INT) END AS ord FROM t""")
def normalize_period(spark, folder):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    text = (
        F.when(key % 5 == 0, F.date_format(day, "yyyy-MM"))
        .when(key % 5 == 1, F.date_format(F.last_day(day), "yyyy-MM-dd"))
        .when(key % 5 == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 5 == 3, F.date_format(day, "yyyy/MM"))
        .otherwise("")
    )
    return (
        bindings.table(spark, folder, "orders")
        .select("o_orderkey", text.alias("period"))
        .withColumns(
            {"kind": scalars.period_kind(F.col("period")), "ord": scalars.normalize_period(F.col("period"))}
        )
    )


@query("financial_year", """SELECT o_orderkey,
  CASE WHEN month(o_orderdate) >= 4 THEN CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) + 1 AS VARCHAR)
       ELSE CAST(year(o_orderdate) - 1 AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR) END AS financial_year
FROM orders""")
def financial_year(spark, folder):
    return bindings.table(spark, folder, "orders").select(
        "o_orderkey", scalars.financial_year(F.col("o_orderdate").cast("date")).alias("financial_year")
    )


_INDIAN = """CASE WHEN v IS NULL THEN 'Not available' ELSE
  (CASE WHEN v < 0 THEN '-' ELSE '' END) ||
  (CASE WHEN length(w{0}) > 3 THEN ltrim(reverse(regexp_replace(reverse(w{0}[:-4]), '(..)', '\\1,', 'g')), ',') || ',' || w{0}[-3:] ELSE w{0} END)
  || f{0} END AS text_{0}"""


@query("format_indian", f"""WITH v AS (
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN -o_totalprice
       WHEN o_orderkey % 7 = 0 THEN o_totalprice * 1000 WHEN o_orderkey % 5 = 0 THEN o_totalprice / 1000
       WHEN o_orderkey % 11 = 0 THEN floor(o_totalprice) + 0.5 ELSE o_totalprice END AS v FROM orders),
t AS (SELECT *, printf('%.0f', abs(v)) AS w0, '' AS f0, split_part(printf('%.1f', abs(v)), '.', 1) AS w1,
      '.' || split_part(printf('%.1f', abs(v)), '.', 2) AS f1 FROM v)
SELECT o_orderkey, {_INDIAN.format(0)}, {_INDIAN.format(1)} FROM t""")
def format_indian(spark, folder):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    value = (
        F.when(key % 9 == 0, F.lit(None).cast("double"))
        .when(key % 4 == 0, -price)
        .when(key % 7 == 0, price * 1000)
        .when(key % 5 == 0, price / 1000)
        .when(key % 11 == 0, F.floor(price) + 0.5)
        .otherwise(price)
    )
    return bindings.table(spark, folder, "orders").select(
        "o_orderkey",
        scalars.format_indian(value, 0).alias("text_0"),
        scalars.format_indian(value, 1).alias("text_1"),
    )


_LOOK_BACK = [*features.HISTORY, "prior_count", "prior_mean", "prior_std", "recent_mean_3", "recent_std_3", "payment_ratio_mean3", "arrears_trend", "rule_z_current", "anomaly_current", *features.NEXT]


@query("maintained_features", _fx(", ".join(_LOOK_BACK)), ["prior_mean", "prior_std", "recent_mean_3", "recent_std_3", "payment_ratio_mean3", "arrears_trend", "rule_z_current", "payment_ratio_lag1", "payment_ratio_lag2_audit"], 5)
def maintained_features(spark, folder):
    """All months but the last three begin the table, these arrive as a stream: what it holds then is what a rebuild gives."""
    rows = panel(spark, folder)
    last = rows.agg(F.max("ord")).first()[0]
    home, landing, out, state = (scratch_path(spark, n) for n in ("maintained", "landing", "history", "state"))
    maintained.begin(rows.where(F.col("ord") <= last - 3), home)
    for ord in range(last - 2, last + 1):
        rows.where(F.col("ord") == ord).write.mode("append").parquet(landing)
        ingest.ingest_new(spark, landing, out, state, rows.schema, then=lambda month, _: maintained.advance(month, home))
    return maintained.maintained(spark, home).select(*KEYS, *_LOOK_BACK)
