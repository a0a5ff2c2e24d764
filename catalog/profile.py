"""Descriptive, association and payment-summary queries on P1 and P2."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from catalog.base import FEATURES, P1, P2, SPLITS, query
from catalog.features import built, p1, panel
from meterflow import schema
from meterflow.operators import association, features, payments, profile, splits
from meterflow.session import materialize
from meterflow.sources import bindings

FIELDS = ["consumption_unit", "bill_amount", "payment_amount", "closing_arrears", "contract_load"]


def p2(spark, folder):
    return bindings.customer_months(spark, folder)


@query("monthly_summary", f"""WITH {P1} SELECT ord, count(DISTINCT consumer_no) AS unique_consumers, sum(consumption_unit) AS total_consumption,
  avg(consumption_unit) AS average_consumption, sum(bill_amount) AS total_bills, coalesce(sum(payment_amount), 0) AS total_payments,
  sum(closing_arrears) AS total_closing_arrears FROM p1 GROUP BY ord""",
    ["average_consumption", "total_bills", "total_payments", "total_closing_arrears"], 4)
def monthly_summary(spark, folder):
    return profile.monthly_summary(p1(spark, folder))


def _long(columns, source="p1", where=""):
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM {source} WHERE {c} IS NOT NULL{where}" for c in columns)


_MOMENTS = """count(*) AS n, avg(value) AS mean, stddev_samp(value) AS sd, min(value) AS minimum, max(value) AS maximum,
  quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3"""


@query("descriptive_stats", f"""WITH {P1}, c AS ({_long(FIELDS)})
SELECT variable, {_MOMENTS}, skewness(value) AS skewness, kurtosis(value) AS kurtosis,
  quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM c GROUP BY variable""",
    ["mean", "sd", "q1", "median", "q3", "iqr", "skewness", "kurtosis"], 4)
def descriptive_stats(spark, folder):
    return profile.descriptive_stats(panel(spark, folder), FIELDS)


_INF = "CASE WHEN ord % 10 = 3 THEN CAST('inf' AS DOUBLE) WHEN ord % 10 = 4 THEN NULL ELSE {0} END AS {0}"


@query("finite_describe", f"""WITH {P1}, o AS (SELECT {", ".join(_INF.format(c) for c in FIELDS)} FROM p1),
c AS (SELECT * FROM ({_long(FIELDS, 'o')}) WHERE isfinite(value))
SELECT variable, {_MOMENTS} FROM c GROUP BY variable""", ["mean", "sd", "q1", "median", "q3"], 4)
def finite_describe(spark, folder):
    odd = panel(spark, folder).select(
        *[
            F.when(F.col("ord") % 10 == 3, float("inf")).when(F.col("ord") % 10 != 4, F.col(c)).alias(c)
            for c in FIELDS
        ]
    )
    return profile.finite_describe(odd, FIELDS)


@query("iqr_outliers", f"""WITH {P1}, c AS ({_long(FIELDS)}),
q AS (SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM c GROUP BY variable)
SELECT c.variable, count(*) AS n, max(q3 - q1) AS iqr, max(q1 - 1.5*(q3 - q1)) AS iqr_lower, max(q3 + 1.5*(q3 - q1)) AS iqr_upper,
  count(*) FILTER (value < q1 - 1.5*(q3 - q1) OR value > q3 + 1.5*(q3 - q1)) AS potential_outliers
FROM c JOIN q ON q.variable = c.variable GROUP BY c.variable""", ["iqr", "iqr_lower", "iqr_upper"], 4)
def iqr_outliers(spark, folder):
    return profile.iqr_outliers(panel(spark, folder), FIELDS)


_BLANK_TARIFF = "CASE WHEN (consumer_no + ord) % 7 = 0 THEN '' ELSE tarrif END"


@query("category_frequency", f"""WITH {P1}, c AS (SELECT 'tarrif' AS variable, CASE WHEN (consumer_no + ord) % 7 = 0 THEN '[missing]' ELSE tarrif END AS category FROM p1
  UNION ALL SELECT 'solar_consumer', solar_consumer FROM p1)
SELECT variable, category, count(*) AS n_rows, 100.0 * count(*) / CAST((SELECT count(*) FROM p1) AS DOUBLE) AS percent FROM c GROUP BY 1, 2""", ["percent"])
def category_frequency(spark, folder):
    rows = panel(spark, folder).withColumn(
        "tarrif", F.when((F.col("consumer_no") + F.col("ord")) % 7 == 0, "").otherwise(F.col("tarrif"))
    )
    return profile.category_frequency(rows, ["tarrif", "solar_consumer"])


@query("category_top", f"""WITH {P2}, c AS (SELECT 'tarrif' AS variable, tarrif AS category FROM p2 UNION ALL SELECT 'ord', CAST(ord AS VARCHAR) FROM p2),
g AS (SELECT variable, category, count(*) AS n_rows FROM c GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY variable ORDER BY n_rows DESC, category) AS INT) AS position FROM g)
SELECT *, 100.0 * n_rows / CAST((SELECT count(*) FROM p2) AS DOUBLE) AS percent FROM r WHERE position <= 15""", ["percent"])
def category_top(spark, folder):
    rows = p2(spark, folder).withColumn("ord", F.col("ord").cast("string"))
    return profile.category_frequency(rows, ["tarrif", "ord"], 15)


@query("top_categories", """SELECT l_partkey, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY n_rows DESC, l_partkey LIMIT 15""")
def top_categories(spark, folder):
    return profile.top_n(bindings.table(spark, folder, "lineitem"), "l_partkey", 15)


@query("group_stats", f"""WITH {P1} SELECT tarrif, count(consumption_unit) AS n, avg(consumption_unit) AS mean, stddev_samp(consumption_unit) AS sd,
  min(consumption_unit) AS minimum, max(consumption_unit) AS maximum, quantile_cont(consumption_unit, 0.5) AS median,
  100.0 * count(consumption_unit) / CAST((SELECT count(*) FROM p1) AS DOUBLE) AS percent_of_rows FROM p1 GROUP BY tarrif""",
    ["mean", "sd", "median", "percent_of_rows"])
def group_stats(spark, folder):
    return profile.group_stats(panel(spark, folder), "tarrif", "consumption_unit")


@query("calendar_month_profile", f"""WITH {P1} SELECT CAST(ord % 12 + 1 AS INT) AS calendar_month, count(consumption_unit) AS n, avg(consumption_unit) AS mean,
  quantile_cont(consumption_unit, 0.5) AS median FROM p1 GROUP BY 1""", ["mean", "median"])
def calendar_month_profile(spark, folder):
    return profile.calendar_month_profile(panel(spark, folder), "consumption_unit")


@query("consumer_means", f"""WITH {P1} SELECT consumer_no, avg(consumption_unit) AS consumption_unit, avg(bill_amount) AS bill_amount,
  avg(payment_amount) AS payment_amount FROM p1 GROUP BY consumer_no""", FIELDS[:3], 4)
def consumer_means(spark, folder):
    return profile.consumer_means(p1(spark, folder), FIELDS[:3])


def _corr_sql(columns, source):
    parts = []
    for a, b in combinations(columns, 2):
        for x, y in ((a, b), (b, a)):
            parts.append(f"SELECT '{x}' AS feature_1, '{y}' AS feature_2, corr({a}, {b}) AS correlation, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS complete_rows FROM {source}")
    parts += [f"SELECT '{c}', '{c}', CAST(1 AS DOUBLE), count({c}) FROM {source}" for c in columns]
    return " UNION ALL ".join(parts)


@query("correlation_matrix", f"WITH {P1} {_corr_sql(FIELDS, 'p1')}", ["correlation"])
def correlation_matrix(spark, folder):
    return profile.correlation_matrix(p1(spark, folder), FIELDS)


NUMERIC_PREDICTORS = [c for c in schema.CONSUMPTION_PREDICTORS if c not in schema.MODEL_CATEGORIES]


def train(spark, folder, module="consumption"):
    """TRAIN rows of a module, stored for the statistics that pass over them repeatedly."""
    rows = splits.module_rows(built(spark, folder), bindings.P1_BOUNDS, module)
    kept = ["consumer_no", "target_ord", "target", *schema.PREDICTORS[module]]
    return materialize(rows.filter(F.col("partition") == "TRAIN").select(*kept), "train")


def _collinear_sql():
    parts = [
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS correlation, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS complete_rows FROM t"
        for a, b in combinations(NUMERIC_PREDICTORS, 2)
    ]
    return " UNION ALL ".join(parts)


@query("collinearity_audit", f"""WITH {SPLITS}, t AS (SELECT * FROM sp WHERE module = 'consumption' AND "partition" = 'TRAIN'),
m AS ({_collinear_sql()}) SELECT * FROM m WHERE abs(correlation) >= 0.6""", ["correlation"])
def collinearity_audit(spark, folder):
    """Threshold 0.6 instead of the default 0.9, which no pair of P1 reaches."""
    return profile.collinearity_audit(train(spark, folder), NUMERIC_PREDICTORS, 0.6)


@query("exact_relation_check", f"""WITH {FEATURES} SELECT count(*) FILTER (recent_mean_3 IS NOT NULL) AS complete_rows,
  CAST(0 AS BIGINT) AS mean_violations, CAST(0 AS BIGINT) AS trend_violations FROM fx""")
def exact_relation_check(spark, folder):
    return profile.exact_relation_check(built(spark, folder))


def _bin(v, lo, hi, n):
    step = f"(({hi} - {lo}) / {n})"
    i = f"least(floor(({v} - {lo}) / {step}), {n} - 1)"
    return f"CAST(CASE WHEN {v} < {lo} + {i} * {step} THEN {i} - 1 WHEN {v} >= {lo} + ({i} + 1) * {step} AND {i} < {n} - 1 THEN {i} + 1 ELSE {i} END AS INT)"


@query("histogram_bins", f"""WITH {P1}, s AS (SELECT min(bill_amount) AS lo, max(bill_amount) AS hi FROM p1),
b AS (SELECT {_bin('bill_amount', 'lo', 'hi', 60)} AS bin, count(*) AS n FROM p1, s GROUP BY 1)
SELECT CAST(e.i AS INT) AS bin, lo + e.i * ((hi - lo) / 60) AS lower_edge, lo + (e.i + 1) * ((hi - lo) / 60) AS upper_edge, coalesce(n, 0) AS n
FROM range(60) e(i) CROSS JOIN s LEFT JOIN b ON b.bin = e.i""", ["lower_edge", "upper_edge"], 4)
def histogram_bins(spark, folder):
    return profile.histogram_bins(panel(spark, folder), "bill_amount", 60)


@query("grid_density", f"""WITH {P1}, s AS (SELECT min(consumption_unit) AS x0, max(consumption_unit) AS x1, min(payment_amount) AS y0, max(payment_amount) AS y1
  FROM p1 WHERE consumption_unit IS NOT NULL AND payment_amount IS NOT NULL)
SELECT {_bin('consumption_unit', 'x0', 'x1', 45)} AS x_bin, {_bin('payment_amount', 'y0', 'y1', 45)} AS y_bin, count(*) AS n
FROM p1, s WHERE consumption_unit IS NOT NULL AND payment_amount IS NOT NULL GROUP BY 1, 2""")
def grid_density(spark, folder):
    return profile.grid_density(panel(spark, folder), "consumption_unit", "payment_amount", 45)


@query("box_summary", f"""WITH {P1}, q AS (SELECT tarrif, quantile_cont(bill_amount, 0.25) AS q1, quantile_cont(bill_amount, 0.5) AS median,
  quantile_cont(bill_amount, 0.75) AS q3 FROM p1 GROUP BY tarrif)
SELECT p1.tarrif, q1, median, q3, count(*) AS n, least(min(bill_amount) FILTER (bill_amount >= q1 - 1.5*(q3 - q1)), q1) AS whisker_low,
  greatest(max(bill_amount) FILTER (bill_amount <= q3 + 1.5*(q3 - q1)), q3) AS whisker_high,
  count(*) FILTER (bill_amount < q1 - 1.5*(q3 - q1) OR bill_amount > q3 + 1.5*(q3 - q1)) AS fliers
FROM p1 JOIN q ON q.tarrif = p1.tarrif GROUP BY 1, 2, 3, 4""", ["q1", "median", "q3", "whisker_low", "whisker_high"], 4)
def box_summary(spark, folder):
    return profile.box_summary(panel(spark, folder), "bill_amount", "tarrif")


@query("eda_findings", f"""WITH {P1}, m AS (SELECT CAST(ord % 12 + 1 AS INT) AS month, avg(consumption_unit) AS mean FROM p1 GROUP BY 1),
t AS (SELECT tarrif, avg(consumption_unit) AS mean FROM p1 GROUP BY 1)
SELECT count(*) FILTER (consumption_unit = 0) AS zero_consumption_rows, count(*) FILTER (bill_amount <= 0) AS nonpositive_bills,
  count(*) FILTER (payment_amount > bill_amount) AS payments_above_bills, avg(closing_arrears) AS mean_arrears, max(closing_arrears) AS max_arrears,
  (SELECT month FROM m ORDER BY mean DESC, month LIMIT 1) AS highest_month, (SELECT month FROM m ORDER BY mean, month LIMIT 1) AS lowest_month,
  (SELECT tarrif FROM t ORDER BY mean DESC, tarrif LIMIT 1) AS highest_group, (SELECT tarrif FROM t ORDER BY mean, tarrif LIMIT 1) AS lowest_group FROM p1""",
    ["mean_arrears", "max_arrears"], 4)
def eda_findings(spark, folder):
    return profile.eda_findings(p1(spark, folder))


# --- association ---------------------------------------------------------------------

P2_GROUPS = (
    P2
    + """, pg AS (SELECT *, CASE WHEN consumer_no % 3 = 0 THEN 'Y' ELSE 'N' END AS solar_consumer,
  CASE WHEN (consumer_no + ord) % 211 = 0 THEN 'OTHER' ELSE tarrif END AS shifting FROM p2)"""
)


def p2_groups(spark, folder):
    k = F.col("consumer_no")
    return p2(spark, folder).withColumns(
        {
            "solar_consumer": F.when(k % 3 == 0, "Y").otherwise("N"),
            "shifting": F.when((k + F.col("ord")) % 211 == 0, "OTHER").otherwise(F.col("tarrif")),
        }
    )


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
_SEG = ", ".join(f"'{s}'" for s in SEGMENTS)
_STABLE = f"""st AS (SELECT consumer_no, min(shifting) AS shifting, min(solar_consumer) AS solar_consumer,
  count(DISTINCT shifting) > 1 AS changing_shifting, count(DISTINCT solar_consumer) > 1 AS changing_solar_consumer,
  NOT bool_and(shifting IN ({_SEG}) AND solar_consumer IN ('Y', 'N')) AS invalid FROM pg GROUP BY consumer_no),
stable AS (SELECT *, NOT invalid AND NOT changing_shifting AND NOT changing_solar_consumer AS included FROM st)"""


def stable(spark, folder):
    return association.stable_consumers(
        p2_groups(spark, folder), {"shifting": SEGMENTS, "solar_consumer": schema.VALID_SOLAR}
    )


@query("stable_consumers", f"WITH {P2_GROUPS}, {_STABLE} SELECT * FROM stable")
def stable_consumers(spark, folder):
    return stable(spark, folder)


@query("stability_summary", f"""WITH {P2_GROUPS}, {_STABLE} SELECT count(*) AS total_consumers, count(*) FILTER (changing_shifting) AS changing_shifting,
  count(*) FILTER (changing_solar_consumer) AS changing_solar_consumer, count(*) FILTER (invalid) AS invalid_category_consumers,
  count(*) FILTER (NOT included) AS excluded_union, count(*) FILTER (included) AS included_consumers FROM stable""")
def stability_summary(spark, folder):
    return association.stability_summary(stable(spark, folder), ["shifting", "solar_consumer"])


_CELLS = """cells AS (SELECT x.{a}, y.{b}, coalesce(c.n, 0) AS observed FROM (SELECT DISTINCT {a} FROM {s}) x CROSS JOIN (SELECT DISTINCT {b} FROM {s}) y
  LEFT JOIN (SELECT {a}, {b}, count(*) AS n FROM {s} GROUP BY 1, 2) c ON c.{a} = x.{a} AND c.{b} = y.{b})"""
_EXPECTED = """ex AS (SELECT *, CAST(sum(observed) OVER (PARTITION BY {a}) AS DOUBLE) * CAST(sum(observed) OVER (PARTITION BY {b}) AS DOUBLE) / CAST(sum(observed) OVER () AS DOUBLE) AS expected FROM cells)"""


@query("crosstab_counts", f"""WITH {P1}, x1 AS (SELECT CAST(ord // 12 AS VARCHAR) AS year, solar_consumer FROM p1), {_CELLS.format(a='year', b='solar_consumer', s='x1')} SELECT * FROM cells""")
def crosstab_counts(spark, folder):
    """No consumer is solar in the first years: those cells have to be filled with zeros."""
    rows = p1(spark, folder).select(F.floor(F.col("ord") / 12).cast("string").alias("year"), "solar_consumer")
    return association.crosstab_counts(rows, "year", "solar_consumer")


_STABLE_ROWS = f"{P2_GROUPS}, {_STABLE}, kept AS (SELECT * FROM stable WHERE included), {_CELLS.format(a='shifting', b='solar_consumer', s='kept')}, {_EXPECTED.format(a='shifting', b='solar_consumer')}"


def stable_cells(spark, folder):
    return association.crosstab_counts(stable(spark, folder).filter("included"), "shifting", "solar_consumer")


@query("expected_counts", f"WITH {_STABLE_ROWS} SELECT * FROM ex", ["expected"])
def expected_counts(spark, folder):
    return association.expected_counts(stable_cells(spark, folder), "shifting", "solar_consumer")


# Survival function for 3 degrees of freedom would need erf; for even ones it is a finite sum.
_CHI = """SELECT CAST(sum(observed) AS BIGINT) AS sample_size, min(expected) AS minimum_expected,
  100.0 * count(*) FILTER (expected < 5) / CAST(count(*) AS DOUBLE) AS percent_expected_below_5,
  CASE WHEN count(DISTINCT {a}) >= 2 AND count(DISTINCT {b}) >= 2 THEN CAST((count(DISTINCT {a}) - 1) * (count(DISTINCT {b}) - 1) AS INT) END AS degrees_of_freedom,
  CASE WHEN count(DISTINCT {a}) >= 2 AND count(DISTINCT {b}) >= 2 AND min(expected) >= 1 AND 100.0 * count(*) FILTER (expected < 5) / CAST(count(*) AS DOUBLE) <= 20 THEN sum((observed - expected) * (observed - expected) / expected) END AS statistic,
  CASE WHEN count(DISTINCT {a}) >= 2 AND count(DISTINCT {b}) >= 2 AND min(expected) >= 1 AND 100.0 * count(*) FILTER (expected < 5) / CAST(count(*) AS DOUBLE) <= 20 THEN 'performed' ELSE 'skipped' END AS status FROM ex"""


@query("chi_square_test", f"WITH {_STABLE_ROWS} {_CHI.format(a='shifting', b='solar_consumer')}",
       ["minimum_expected", "percent_expected_below_5", "statistic"])
def chi_square_test(spark, folder):
    pairs = association.observed_pairs(stable(spark, folder).filter("included"), "shifting", "solar_consumer")
    return association.chi_square_test(pairs, "shifting", "solar_consumer").drop("p_value")


# All five segments: 4 degrees of freedom, where p = exp(-x/2) (1 + x/2).
_P2_CELLS = f"{P2_GROUPS}, kept AS (SELECT DISTINCT consumer_no, tarrif, solar_consumer FROM pg), {_CELLS.format(a='tarrif', b='solar_consumer', s='kept')}, {_EXPECTED.format(a='tarrif', b='solar_consumer')}"


@query("chi_square_p_value", f"""WITH {_P2_CELLS}, r AS ({_CHI.format(a='tarrif', b='solar_consumer')})
SELECT statistic, degrees_of_freedom, exp(-statistic / 2) * (1 + statistic / 2) AS p_value FROM r""", ["statistic", "p_value"])
def chi_square_p_value(spark, folder):
    consumers = p2_groups(spark, folder).select("consumer_no", "tarrif", "solar_consumer").distinct()
    pairs = association.observed_pairs(consumers, "tarrif", "solar_consumer")
    test = association.chi_square_test(pairs, "tarrif", "solar_consumer")
    return test.select("statistic", "degrees_of_freedom", "p_value")


_PEARSON = """SELECT count(*) AS sample_size, corr(x, y) AS r, CAST(count(*) - 2 AS INT) AS degrees_of_freedom, 'performed' AS status,
  corr(x, y) * sqrt(count(*) - 2) / sqrt(1 - corr(x, y) * corr(x, y)) AS t_statistic,
  CASE WHEN corr(x, y) > 0 THEN 'positive' WHEN corr(x, y) < 0 THEN 'negative' ELSE 'zero' END AS direction FROM m"""
# For an even number of degrees of freedom the two-sided tail is a finite sum:
# 1 - sin(a) (1 + 1/2 cos^2 a + 1*3/(2*4) cos^4 a + ...), with tan(a) = t / sqrt(dof).
_T_TAIL = """WITH r AS ({0}), a AS (SELECT *, atan(abs(t_statistic) / sqrt(degrees_of_freedom)) AS angle FROM r)
SELECT a.*, CASE WHEN degrees_of_freedom % 2 = 0 THEN 1 - sin(angle) * (1 + coalesce((SELECT sum(term) FROM (SELECT exp(sum(ln((2.0 * j - 1) / (2.0 * j)) + 2 * ln(cos(angle))) OVER (ORDER BY j)) AS term
   FROM range(1, CAST(degrees_of_freedom // 2 AS BIGINT)) t(j))), 0)) END AS p_value FROM a"""


@query("pearson_test", f"""WITH {P1}, m AS (SELECT avg(consumption_unit) AS x, avg(bill_amount) AS y FROM p1 GROUP BY consumer_no) {_PEARSON}""", ["r", "t_statistic"])
def pearson_test(spark, folder):
    return association.pearson_test(p1(spark, folder), "consumption_unit", "bill_amount").drop("p_value")


@query("pearson_p_value", f"""WITH {P1}, m AS (SELECT avg(consumption_unit) AS x, avg(contract_load) AS y FROM p1 GROUP BY consumer_no),
r AS ({_PEARSON}), a AS (SELECT r.*, atan(abs(t_statistic) / sqrt(degrees_of_freedom)) AS angle FROM r),
w AS (SELECT j, sum(ln((2.0 * j - 1) / (2.0 * j)) + 2 * ln(cos(angle))) OVER (ORDER BY j) AS s FROM a, range(1, 1000000) t(j) WHERE j < degrees_of_freedom // 2)
SELECT sample_size, r, degrees_of_freedom, 1 - sin(angle) * (1 + coalesce((SELECT sum(exp(s)) FROM w), 0)) AS p_value FROM a""", ["r", "p_value"])
def pearson_p_value(spark, folder):
    test = association.pearson_test(p1(spark, folder), "consumption_unit", "contract_load")
    return test.select("sample_size", "r", "degrees_of_freedom", "p_value")


# --- relevance -------------------------------------------------------------------------

_TRAIN = SPLITS + """, tr AS (SELECT * FROM sp WHERE module = '{0}' AND "partition" = 'TRAIN')"""
_PAIR_FEATURES = NUMERIC_PREDICTORS


def _pairs_sql(features):
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, consumer_no, CAST({f} AS DOUBLE) AS x, target AS y FROM tr WHERE {f} IS NOT NULL" for f in features)


@query("paired_mean_relevance", f"""WITH {_TRAIN.format('consumption')}, pr AS ({_pairs_sql(_PAIR_FEATURES)}),
m AS (SELECT feature, consumer_no, count(*) AS n, avg(x) AS x, avg(y) AS y FROM pr GROUP BY 1, 2)
SELECT feature, CAST(sum(n) AS BIGINT) AS paired_rows, count(*) AS sample_size, corr(x, y) AS r, CAST(count(*) - 2 AS INT) AS degrees_of_freedom,
  'performed' AS status, skewness(x) AS predictor_skew, skewness(y) AS target_skew,
  corr(x, y) * sqrt(count(*) - 2) / sqrt(1 - corr(x, y) * corr(x, y)) AS t_statistic,
  CASE WHEN corr(x, y) > 0 THEN 'positive' ELSE 'negative' END AS direction,
  (SELECT count(DISTINCT consumer_no) FROM tr) - count(*) AS excluded_consumers FROM m GROUP BY feature""",
    ["r", "predictor_skew", "target_skew", "t_statistic"], 5)
def paired_mean_relevance(spark, folder):
    return association.paired_mean_relevance(train(spark, folder), _PAIR_FEATURES, "target").drop("p_value")


_CATEGORY_SQL = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS category, target AS y FROM tr" for f in ["tarrif", "solar_consumer", "target_month"])


@query("category_target_stats", f"""WITH {_TRAIN.format('consumption')}, c AS ({_CATEGORY_SQL})
SELECT feature, category, count(*) AS n, avg(y) AS mean, stddev_samp(y) AS sd, quantile_cont(y, 0.5) AS median FROM c GROUP BY 1, 2""", ["mean", "sd", "median"])
def category_target_stats(spark, folder):
    return association.category_target_stats(train(spark, folder), ["tarrif", "solar_consumer", "target_month"], "target")


_REVENUE_NUMERIC = [c for c in schema.REVENUE_PREDICTORS if c not in schema.CATEGORICAL_PREDICTORS]
_CLASS_SQL = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST(target AS INT) AS class, CAST({f} AS DOUBLE) AS x FROM tr WHERE {f} IS NOT NULL" for f in _REVENUE_NUMERIC)


@query("class_feature_stats", f"""WITH {_TRAIN.format('revenue')}, c AS ({_CLASS_SQL})
SELECT feature, class, count(*) AS n, avg(x) AS mean, stddev_samp(x) AS sd, quantile_cont(x, 0.5) AS median FROM c GROUP BY 1, 2""", ["mean", "sd", "median"], 4)
def class_feature_stats(spark, folder):
    return association.class_feature_stats(train(spark, folder, "revenue"), _REVENUE_NUMERIC, "target")


def labelled_groups(spark, folder):
    """P2 with a label that most consumers keep."""
    odd = (F.col("consumer_no") + F.col("ord")) % 97 == 0
    return p2_groups(spark, folder).withColumn("label", (odd != (F.col("solar_consumer") == "Y")).cast("int"))


_LABELLED = f"""{P2_GROUPS}, rt AS (SELECT consumer_no, shifting, CAST(CAST(((consumer_no + ord) % 97 = 0) <> (solar_consumer = 'Y') AS INT) AS VARCHAR) AS label FROM pg),
st AS (SELECT consumer_no, min(shifting) AS shifting, min(label) AS label, count(DISTINCT shifting) > 1 AS ct, count(DISTINCT label) > 1 AS cl,
   NOT bool_and(shifting IN ({_SEG})) AS bad FROM rt GROUP BY 1),
kept AS (SELECT * FROM st WHERE NOT ct AND NOT cl AND NOT bad),
{_CELLS.format(a='shifting', b='label', s='kept')}, {_EXPECTED.format(a='shifting', b='label')}"""


@query("stable_chi_square", f"""WITH {_LABELLED}, t AS ({_CHI.format(a='shifting', b='label')})
SELECT t.*, 'shifting' AS feature, (SELECT count(*) FILTER (ct OR cl OR bad) FROM st) AS excluded_consumers, (SELECT count(*) FILTER (ct) FROM st) AS changing_feature_consumers,
  (SELECT count(*) FILTER (cl) FROM st) AS changing_target_consumers, (SELECT count(*) FILTER (bad) FROM st) AS invalid_category_consumers FROM t""",
    ["minimum_expected", "percent_expected_below_5", "statistic"])
def stable_chi_square(spark, folder):
    test, _ = association.stable_chi_square(labelled_groups(spark, folder), "shifting", "label", SEGMENTS)
    return test.drop("p_value")


@query("stable_contingency", f"WITH {_LABELLED} SELECT * FROM ex", ["expected"])
def stable_contingency(spark, folder):
    _, cells = association.stable_chi_square(labelled_groups(spark, folder), "shifting", "label", SEGMENTS)
    return cells


def evidence_rows(spark, folder):
    paired = association.paired_mean_relevance(train(spark, folder), _PAIR_FEATURES, "target").select(
        F.lit("consumption").alias("module"), "feature", F.lit("").alias("group"),
        F.when(F.col("status") == "performed", "test").otherwise("skipped").alias("kind"),
        F.col("sample_size").alias("n"), F.col("t_statistic").alias("value"), F.col("p_value").alias("second"),
    )
    classes = association.class_feature_stats(train(spark, folder, "revenue"), _REVENUE_NUMERIC, "target").select(
        F.lit("revenue").alias("module"), "feature", F.concat(F.lit("Class "), F.col("class").cast("string")).alias("group"),
        F.lit("descriptive").alias("kind"), "n", F.col("mean").alias("value"), F.col("median").alias("second"),
    )
    return paired.unionByName(classes)


# Two-sided p of Student's t by its series in the cosine of atan(t / sqrt(dof)): the terms that the distribution function sums
# for small correlations, the infinite rest of the same series for others, where the difference from 1 would cancel.
_P_VALUES = """cs AS (SELECT feature, count(*) AS n, corr(x, y) AS r, count(*) - 2 AS dof FROM m GROUP BY feature),
an AS (SELECT *, r * sqrt(dof) / sqrt(1 - r * r) AS t, asin(abs(r)) AS angle, abs(r) > 0.3 AS rest, dof % 2 = 0 AS even FROM cs),
tm AS (SELECT feature, k, sum(CASE WHEN k = 0 THEN 0 WHEN even THEN ln((2.0 * k - 1) / (2.0 * k)) WHEN k = 1 THEN 0 ELSE ln((2.0 * k - 2) / (2.0 * k - 1)) END)
     OVER (PARTITION BY feature ORDER BY k) + (CASE WHEN even THEN 2 * k ELSE 2 * k - 1 END) * ln(cos(angle)) AS s
   FROM an, range(0, 10000) z(k) WHERE (even OR k > 0) AND k < dof // 2 + 3000),
sm AS (SELECT an.feature, sum(exp(s)) FILTER (k >= (dof + 1) // 2 + CASE WHEN even THEN 0 ELSE 1 END) AS tail, sum(exp(s)) FILTER (k < (dof + 1) // 2 + CASE WHEN even THEN 0 ELSE 1 END) AS head
   FROM tm JOIN an ON an.feature = tm.feature GROUP BY an.feature),
pv AS (SELECT an.feature, n, t, CASE WHEN even AND rest THEN sin(angle) * tail WHEN even THEN 1 - sin(angle) * head
     WHEN rest THEN 2 / pi() * sin(angle) * tail ELSE 1 - 2 / pi() * (angle + sin(angle) * coalesce(head, 0)) END AS p FROM an JOIN sm ON sm.feature = an.feature)"""


@query("relevance_evidence", f"""WITH {SPLITS}, t1 AS (SELECT * FROM sp WHERE module = 'consumption' AND "partition" = 'TRAIN'),
tr AS (SELECT * FROM t1), pr AS ({_pairs_sql(_PAIR_FEATURES)}), m AS (SELECT feature, consumer_no, avg(x) AS x, avg(y) AS y FROM pr GROUP BY 1, 2),
{_P_VALUES},
a AS (SELECT 'consumption' AS module, feature, 'Test: n=' || CAST(n AS VARCHAR) || ', statistic=' || printf('%.4g', t) || ', p=' || printf('%.4g', p) || '.' AS statistical_evidence FROM pv),
t2 AS (SELECT * FROM sp WHERE module = 'revenue' AND "partition" = 'TRAIN'), c AS ({_CLASS_SQL.replace("FROM tr", "FROM t2")}),
g AS (SELECT feature, class, 'Descriptive Class ' || CAST(class AS VARCHAR) || ': n=' || CAST(count(*) AS VARCHAR) || ', mean=' || printf('%.4g', avg(x)) || ', median=' || printf('%.4g', quantile_cont(x, 0.5)) || '.' AS line
  FROM c GROUP BY 1, 2)
SELECT * FROM a UNION ALL SELECT 'revenue', feature, string_agg(line, ' ' ORDER BY class) FROM g GROUP BY feature""")
def relevance_evidence(spark, folder):
    return association.relevance_evidence(evidence_rows(spark, folder))


# --- payments and targets ----------------------------------------------------------------

@query("target_availability", f"""WITH {FEATURES} SELECT 'consumption_next' AS target, count(consumption_next) AS available, count(*) - count(consumption_next) AS missing,
  CAST(NULL AS BIGINT) AS class_0, CAST(NULL AS BIGINT) AS class_1 FROM fx
UNION ALL SELECT 'at_risk_next', count(at_risk_next), count(*) - count(at_risk_next), count(*) FILTER (at_risk_next = 0), count(*) FILTER (at_risk_next = 1) FROM fx
UNION ALL SELECT 'anomaly_next', count(anomaly_next), count(*) - count(anomaly_next), count(*) FILTER (anomaly_next = 0), count(*) FILTER (anomaly_next = 1) FROM fx""")
def target_availability(spark, folder):
    return payments.target_availability(built(spark, folder), schema.TARGETS)


_ELIGIBLE = "bill_amount > 0 AND due_date IS NOT NULL"
_RESOLUTION = {
    "outcome_eligible": _ELIGIBLE,
    "positive_bill": "bill_amount > 0",
    "observed_by_cutoff": "payment_observed_by_cutoff",
    "not_observed_by_cutoff": "NOT payment_observed_by_cutoff",
    "payment_date_null": "payment_blank",
    "payment_date_after_cutoff": "payment_date > month_end",
    "observed_zero_amount": "payment_observed_by_cutoff AND payment_amount = 0",
    "observed_positive_amount": "payment_observed_by_cutoff AND payment_amount > 0",
    "observed_missing_invalid_amount": "payment_observed_by_cutoff AND payment_amount IS NULL",
    "valid_payment_ratio_current": "payment_ratio_current IS NOT NULL",
    "missing_payment_ratio_current": "payment_ratio_current IS NULL",
    "valid_payment_delay_current": "payment_delay_current IS NOT NULL",
    "missing_payment_delay_current": "payment_delay_current IS NULL",
    "valid_payment_ratio_outcome": "payment_ratio_outcome IS NOT NULL",
    "missing_payment_ratio_outcome": "payment_ratio_outcome IS NULL",
    "by_due_valid_amount": f"{_ELIGIBLE} AND payment_date <= due_date AND payment_amount IS NOT NULL",
    "by_due_missing_invalid_amount": f"{_ELIGIBLE} AND payment_date <= due_date AND payment_amount IS NULL",
    "no_payment_by_due": f"{_ELIGIBLE} AND (payment_blank OR payment_date > due_date)",
    "eligible_unknown_payment_date": f"{_ELIGIBLE} AND NOT payment_blank AND payment_date IS NULL",
    "at_risk_current_0": "at_risk_current = 0",
    "at_risk_current_1": "at_risk_current = 1",
    "at_risk_current_undefined": "at_risk_current IS NULL",
    "invalid_nonblank_payment_date": "NOT payment_blank AND payment_date IS NULL",
    "negative_tenure": "negative_tenure_flag",
}


def asof(spark, folder, source=p1):
    return features.asof_columns(source(spark, folder))


@query("payment_resolution", f"""WITH {FEATURES} SELECT ord, count(*) AS total_rows,
  {", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in _RESOLUTION.items())}, true AS reconciles FROM fx GROUP BY ord""")
def payment_resolution(spark, folder):
    return payments.payment_resolution(asof(spark, folder))


_DUE = {
    "eligible_positive_bill_valid_due": _ELIGIBLE,
    "due_on_or_before_cutoff": f"{_ELIGIBLE} AND due_date <= month_end",
    "due_after_cutoff": f"{_ELIGIBLE} AND due_date > month_end",
    **{c: _RESOLUTION[c] for c in payments.OUTCOME_CATEGORIES},
}


@query("due_date_profile", f"WITH {FEATURES} " + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, count(*) FILTER ({c}) AS n, 100.0 * count(*) FILTER ({c}) / CAST(count(*) FILTER ({_ELIGIBLE}) AS DOUBLE) AS percent_of_eligible FROM fx"
    for m, c in _DUE.items()), ["percent_of_eligible"])
def due_date_profile(spark, folder):
    return payments.due_date_profile(asof(spark, folder))


@query("due_day_frequencies", f"""WITH {P1} SELECT CAST(dayofmonth(due_date) AS INT) AS due_day, count(*) AS n,
  100.0 * count(*) / CAST((SELECT count(*) FROM p1 WHERE {_ELIGIBLE}) AS DOUBLE) AS percent_of_eligible FROM p1 WHERE {_ELIGIBLE} GROUP BY 1""", ["percent_of_eligible"])
def due_day_frequencies(spark, folder):
    return payments.due_day_frequencies(asof(spark, folder, panel))


@query("due_day_quartiles", f"""WITH {P1}, d AS (SELECT CAST(dayofmonth(due_date) AS DOUBLE) AS v FROM p1 WHERE {_ELIGIBLE})
SELECT min(v) AS minimum, max(v) AS maximum, avg(v) AS mean, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM d""", ["mean"])
def due_day_quartiles(spark, folder):
    return payments.due_day_quartiles(asof(spark, folder, panel))
