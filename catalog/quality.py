"""Data-quality queries on dirty text and on a panel with known defects."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import F3, P1, query, strip_sql
from meterflow import schema
from meterflow.functions.scalars import NUMBER_PATTERN, is_blank, to_day, to_number
from meterflow.operators import quality
from meterflow.session import materialize
from meterflow.sources import bindings

class _Number(str):
    """A number's SQL, to be formatted with the column."""

    def format(self, c):
        text = strip_sql(c)
        return f"CASE WHEN regexp_matches({text}, '{NUMBER_PATTERN}') THEN TRY_CAST({text} AS DOUBLE) END"


_NUMBER = _Number()
_DAY = r"CASE WHEN regexp_matches({0}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN TRY_CAST({0} AS DATE) END"


@query("duplicate_keys", """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
SELECT l_linenumber, count(*) AS repeated_keys, CAST(sum(n) AS BIGINT) AS member_rows FROM k GROUP BY l_linenumber""")
def duplicate_keys(spark, folder):
    return quality.duplicate_keys(
        bindings.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_linenumber"]
    )


@query("drop_exact_duplicates", "SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_quantity FROM lineitem")
def drop_exact_duplicates(spark, folder):
    line = bindings.table(spark, folder, "lineitem")
    return quality.drop_exact_duplicates(
        line.select("l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")
    )


@query("conflicting_duplicates", """WITH v AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, count(*) AS copies
  FROM lineitem GROUP BY 1, 2, 3, 4)
SELECT * FROM v WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM v GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def conflicting_duplicates(spark, folder):
    line = bindings.table(spark, folder, "lineitem")
    return quality.conflicting_duplicates(
        line.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"), ["l_orderkey", "l_linenumber"]
    )


_NA = ", ".join(f"'{v}'" for v in schema.CONVENTIONAL_NA)


def _profile_sql(column: str, typed: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(*) AS n_rows, count(*) FILTER ({column} IN ({_NA})) AS conventional_missing,
  100.0 * count(*) FILTER ({column} IN ({_NA})) / CAST(count(*) AS DOUBLE) AS conventional_percent,
  count(*) FILTER ({strip_sql(column)} = '') AS blank_rows, count(*) FILTER ({typed} IS NULL) AS typed_missing FROM f3"""


@query(
    "missing_profile",
    f"WITH {F3} " + " UNION ALL ".join([
        _profile_sql("amount_txt", _NUMBER.format("amount_txt")),
        _profile_sql("date_txt", _DAY.format("date_txt")),
        _profile_sql("category_txt", "category_txt"),
    ]),
    ["conventional_percent"],
)
def missing_profile(spark, folder):
    text = bindings.dirty_orders(spark, folder).drop("o_orderkey")
    return quality.missing_profile(text, ["amount_txt"], ["date_txt"])


_TOK = ", ".join(f"'{v}'" for v in schema.MISSING_TOKENS)


@query("disguised_missing", f"""WITH {F3}, c AS (
  SELECT 'amount_txt' AS column_name, amount_txt AS original_value FROM f3 UNION ALL SELECT 'date_txt', date_txt FROM f3
  UNION ALL SELECT 'category_txt', category_txt FROM f3),
n AS (SELECT *, upper({strip_sql('original_value')}) AS norm FROM c)
SELECT column_name, original_value, CASE WHEN norm = '' THEN '[blank/whitespace]' WHEN norm IN ({_TOK}) THEN norm ELSE '[other candidate]' END AS label,
  count(*) AS n FROM n
WHERE norm IN ({_TOK}) OR regexp_matches(norm, '^[?.*_-]+$') OR norm LIKE 'UNKNOWN%' OR norm LIKE 'MISSING%' OR norm LIKE 'NOT AVAILABLE%'
GROUP BY 1, 2, 3""")
def disguised_missing(spark, folder):
    return quality.disguised_missing(
        bindings.dirty_orders(spark, folder), ["amount_txt", "date_txt", "category_txt"]
    )


@query("artifact_profile", f"""WITH t AS (SELECT CASE WHEN o_orderkey % 1000 = 7 THEN 'x' || CAST(o_custkey % 3 AS VARCHAR) WHEN o_orderkey % 2 = 0 THEN chr(9) || ' ' ELSE '' END AS a FROM orders)
SELECT count(*) AS total_rows, count(*) FILTER ({strip_sql('a')} = '') AS blank_rows, count(*) FILTER ({strip_sql('a')} <> '') AS nonblank_rows,
  count(DISTINCT CASE WHEN {strip_sql('a')} <> '' THEN a END) AS distinct_nonblank, count(*) FILTER ({strip_sql('a')} <> '') = 0 AS droppable FROM t""")
def artifact_profile(spark, folder):
    key = F.col("o_orderkey")
    rows = bindings.table(spark, folder, "orders").select(
        F.when(key % 1000 == 7, F.concat(F.lit("x"), (F.col("o_custkey") % 3).cast("string")))
        .when(key % 2 == 0, "\t ")
        .otherwise("")
        .alias("_trailing")
    )
    return quality.artifact_profile(rows, "_trailing")


@query("to_number", f"""WITH {F3} SELECT o_orderkey, CASE WHEN isinf({_NUMBER.format('amount_txt')}) THEN NULL ELSE {_NUMBER.format('amount_txt')} END AS amount,
  CASE WHEN {strip_sql('amount_txt')} = '' THEN 'blank' WHEN {_NUMBER.format('amount_txt')} IS NULL THEN 'failed'
       WHEN isinf({_NUMBER.format('amount_txt')}) THEN 'nonfinite' ELSE 'number' END AS kind FROM f3""")
def to_number_(spark, folder):
    value = to_number(F.col("amount_txt"))
    infinite = F.abs(value) == float("inf")
    return bindings.dirty_orders(spark, folder).select(
        "o_orderkey",
        F.when(~infinite, value).alias("amount"),
        F.when(is_blank(F.col("amount_txt")), "blank")
        .when(value.isNull(), "failed")
        .when(infinite, "nonfinite")
        .otherwise("number")
        .alias("kind"),
    )


@query("to_day", f"WITH {F3} SELECT o_orderkey, date_txt, {_DAY.format('date_txt')} AS day FROM f3")
def to_day_(spark, folder):
    return bindings.dirty_orders(spark, folder).select(
        "o_orderkey", "date_txt", to_day(F.col("date_txt")).alias("day")
    )


@query("conversion_counts", f"""WITH {F3} SELECT 'amount_txt' AS column_name, count(*) AS values_before, count(*) FILTER ({strip_sql('amount_txt')} <> '') AS nonblank_before,
  count(*) FILTER ({strip_sql('amount_txt')} = '') AS blank_to_missing, count(*) FILTER ({strip_sql('amount_txt')} <> '' AND {_NUMBER.format('amount_txt')} IS NULL) AS failures FROM f3
UNION ALL SELECT 'date_txt', count(*), count(*) FILTER ({strip_sql('date_txt')} <> ''), count(*) FILTER ({strip_sql('date_txt')} = ''),
  count(*) FILTER ({strip_sql('date_txt')} <> '' AND {_DAY.format('date_txt')} IS NULL) FROM f3""")
def conversion_counts(spark, folder):
    return quality.conversion_counts(bindings.dirty_orders(spark, folder), ["amount_txt"], ["date_txt"])


@query("conversion_failures", f"""WITH {F3} SELECT o_orderkey, 'amount_txt' AS column_name, amount_txt AS original_value FROM f3
WHERE {strip_sql('amount_txt')} <> '' AND {_NUMBER.format('amount_txt')} IS NULL
UNION ALL SELECT o_orderkey, 'date_txt', date_txt FROM f3 WHERE {strip_sql('date_txt')} <> '' AND {_DAY.format('date_txt')} IS NULL""")
def conversion_failures(spark, folder):
    return quality.conversion_failures(
        bindings.dirty_orders(spark, folder), ["o_orderkey"], ["amount_txt"], ["date_txt"]
    )


@query("period_domain", """WITH t AS (
  SELECT CASE WHEN o_orderkey % 23 = 0 THEN '2024-13' WHEN o_orderkey % 29 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m') END AS period,
    CASE WHEN o_orderkey % 7 = 0 THEN CAST(month(o_orderdate) AS DOUBLE) + 0.5 WHEN o_orderkey % 11 = 0 THEN CAST(0 AS DOUBLE) WHEN o_orderkey % 13 = 0 THEN NULL
         WHEN o_orderkey % 5 = 0 THEN CAST(month(o_orderdate) % 12 + 1 AS DOUBLE) ELSE CAST(month(o_orderdate) AS DOUBLE) END AS m,
    CASE WHEN o_orderkey % 9 = 0 THEN CAST(1990 AS DOUBLE) ELSE CAST(year(o_orderdate) AS DOUBLE) END AS y FROM orders),
p AS (SELECT *, CASE WHEN regexp_matches(period, '^[0-9]{4}-(0[1-9]|1[0-2])$') THEN CAST(period[1:4] AS INT) END AS py,
    CASE WHEN regexp_matches(period, '^[0-9]{4}-(0[1-9]|1[0-2])$') THEN CAST(period[6:7] AS INT) END AS pm FROM t),
g AS (SELECT count(*) AS d, count(*) FILTER (py IS NULL) AS a,
    count(*) FILTER (NOT coalesce(m BETWEEN 1 AND 12 AND m % 1 = 0, false)) AS b, count(*) FILTER (NOT coalesce(y BETWEEN 1995 AND 2001 AND y % 1 = 0, false)) AS c,
    count(*) FILTER (m <> pm) AS e, count(*) FILTER (y <> py) AS f FROM p)
SELECT x.finding, x.n, d AS denominator FROM g, LATERAL (VALUES ('invalid_or_missing_period', a), ('invalid_month', b), ('invalid_year', c),
  ('month_period_mismatch', e), ('year_period_mismatch', f)) x(finding, n)""")
def period_domain(spark, folder):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    month, year = F.month(day).cast("double"), F.year(day).cast("double")
    rows = bindings.table(spark, folder, "orders").select(
        F.when(key % 23 == 0, "2024-13").when(key % 29 == 0, "").otherwise(F.date_format(day, "yyyy-MM")).alias("period"),
        F.when(key % 7 == 0, month + 0.5)
        .when(key % 11 == 0, F.lit(0.0))
        .when(key % 13 == 0, F.lit(None).cast("double"))
        .when(key % 5 == 0, (F.month(day) % 12 + 1).cast("double"))
        .otherwise(month)
        .alias("month"),
        F.when(key % 9 == 0, F.lit(1990.0)).otherwise(year).alias("year"),
    )
    return quality.period_domain(rows, 1995, 2001)


# P1 with zero, negative and non-finite measures and with dates out of order.
ODD = (
    P1
    + """,
odd AS (SELECT consumer_no, ord, tarrif, solar_consumer, due_date, payment_date,
  CASE WHEN ord % 7 = 0 THEN CAST(0 AS DOUBLE) WHEN ord % 13 = 0 THEN -consumption_unit ELSE consumption_unit END AS consumption_unit,
  CASE WHEN (consumer_no + ord) % 9 = 0 THEN CAST(0 AS DOUBLE) WHEN (consumer_no + ord) % 17 = 0 THEN -bill_amount ELSE bill_amount END AS bill_amount,
  CASE WHEN ord % 19 = 0 THEN CAST('inf' AS DOUBLE) ELSE payment_amount END AS payment_amount,
  CASE WHEN consumer_no % 6 = 0 THEN CAST(0 AS DOUBLE) WHEN consumer_no % 25 = 1 THEN -contract_load ELSE contract_load END AS contract_load,
  CAST(CAST(month_end AS DATE) - CAST((consumer_no * 3 + ord) % 40 AS INT) AS DATE) AS bill_date,
  CAST(CAST(month_end AS DATE) - CAST((consumer_no * 5 + ord) % 70 AS INT) AS DATE) AS prev_bill_date,
  CAST(make_date(CAST(connection_ord // 12 AS INT), CAST(connection_ord % 12 + 1 AS INT), 1) + CAST(CASE WHEN consumer_no % 4 = 0 THEN 400 ELSE 0 END AS INT) AS DATE) AS connection_date
  FROM p1)
"""
)


def odd_panel(spark, folder):
    k, o = F.col("consumer_no"), F.col("ord")
    panel = bindings.supplier_months(spark, folder)
    return panel.select(
        "consumer_no", "ord", "tarrif", "solar_consumer", "due_date", "payment_date",
        F.when(o % 7 == 0, F.lit(0.0)).when(o % 13 == 0, -F.col("consumption_unit")).otherwise(F.col("consumption_unit")).alias("consumption_unit"),
        F.when((k + o) % 9 == 0, F.lit(0.0)).when((k + o) % 17 == 0, -F.col("bill_amount")).otherwise(F.col("bill_amount")).alias("bill_amount"),
        F.when(o % 19 == 0, F.lit(float("inf"))).otherwise(F.col("payment_amount")).alias("payment_amount"),
        F.when(k % 6 == 0, F.lit(0.0)).when(k % 25 == 1, -F.col("contract_load")).otherwise(F.col("contract_load")).alias("contract_load"),
        F.date_sub("month_end", ((k * 3 + o) % 40).cast("int")).alias("bill_date"),
        F.date_sub("month_end", ((k * 5 + o) % 70).cast("int")).alias("prev_bill_date"),
        F.date_add("connection_date", F.when(k % 4 == 0, 400).otherwise(0)).alias("connection_date"),
    )


def _flags_sql(conditions: dict[str, str], source: str = "odd") -> str:
    counts = ", ".join(f"count(*) FILTER ({c}) AS c{i}" for i, c in enumerate(conditions.values()))
    values = ", ".join(f"('{name}', c{i})" for i, name in enumerate(conditions))
    return f"g AS (SELECT count(*) AS d, {counts} FROM {source}) SELECT x.finding, x.n, d AS denominator FROM g, LATERAL (VALUES {values}) x(finding, n)"


@query("before_connection", f"WITH {ODD}, " + _flags_sql({
    "record_before_connection_month": "ord < year(connection_date)*12 + month(connection_date) - 1"}))
def before_connection(spark, folder):
    return quality.before_connection(odd_panel(spark, folder))


_SIGNED = ["consumption_unit", "bill_amount", "payment_amount", "contract_load"]
_QUANTITIES = ["consumption_unit", "contract_load"]


@query("sign_and_finite_checks", f"WITH {ODD} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{"quantity" if c in _QUANTITIES else "amount"}' AS kind, count(*) FILTER (NOT isfinite({c})) AS nonfinite,
    count(*) FILTER ({c} < 0) AS negative, count(*) AS denominator FROM odd""" for c in _SIGNED))
def sign_and_finite_checks(spark, folder):
    return quality.sign_checks(odd_panel(spark, folder), _SIGNED, _QUANTITIES)


_ZERO = {
    "nonpositive_bill": "bill_amount <= 0",
    "zero_consumption": "consumption_unit = 0",
    "zero_contract_load": "contract_load = 0",
}


@query("zero_flags", f"WITH {ODD}, " + _flags_sql(_ZERO))
def zero_flags(spark, folder):
    return quality.zero_flags(odd_panel(spark, folder))


_PAIRS = [
    ("due_date", "bill_date"), ("bill_date", "prev_bill_date"), ("bill_date", "connection_date"),
    ("payment_date", "bill_date"), ("payment_date", "due_date"), ("due_date", "connection_date"),
]


@query("date_order_checks", f"WITH {ODD}, " + _flags_sql({f"{a}_before_{b}": f"{a} < {b}" for a, b in _PAIRS}))
def date_order_checks(spark, folder):
    return quality.date_order_checks(odd_panel(spark, folder), _PAIRS)


_CONTEXT = {
    "zero_consumption_with_positive_bill": "consumption_unit = 0 AND bill_amount > 0",
    "zero_consumption_with_nonpositive_bill": "consumption_unit = 0 AND bill_amount <= 0",
    "nonpositive_bill_with_positive_consumption": "bill_amount <= 0 AND consumption_unit > 0",
    "nonpositive_bill_with_payment": "bill_amount <= 0 AND payment_amount > 0",
    "negative_bill": "bill_amount < 0",
    "zero_bill": "bill_amount = 0",
}


@query("billing_context", f"WITH {ODD}, " + _flags_sql(_CONTEXT))
def billing_context(spark, folder):
    return quality.billing_context(odd_panel(spark, folder))


@query("review_rows", f"""WITH {ODD} SELECT consumer_no, ord, consumption_unit, contract_load, bill_date, connection_date FROM odd
WHERE consumption_unit < 0 OR contract_load < 0 OR bill_date < connection_date""")
def review_rows(spark, folder):
    rows = quality.review_rows(odd_panel(spark, folder), _QUANTITIES)
    return rows.select("consumer_no", "ord", "consumption_unit", "contract_load", "bill_date", "connection_date")


@query("category_collisions", f"""WITH {F3}, s AS (SELECT DISTINCT 'category_txt' AS column_name, category_txt AS spelling FROM f3)
SELECT column_name, upper({strip_sql('spelling')}) AS normal, count(*) AS n_spellings, min(spelling) AS first_spelling, max(spelling) AS last_spelling
FROM s GROUP BY 1, 2 HAVING count(*) > 1""")
def category_collisions(spark, folder):
    return quality.category_collisions(bindings.dirty_orders(spark, folder), ["category_txt"])


def audit(spark, folder, panel=None):
    panel = odd_panel(spark, folder) if panel is None else panel
    dirty = bindings.dirty_orders(spark, folder)
    duplicates = quality.duplicate_keys(
        bindings.table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "k"), ["k", "l_linenumber"], []
    ).select(F.lit("duplicate_key_rows").alias("finding"), F.coalesce("member_rows", F.lit(0)).alias("n"), F.lit(None).cast("bigint").alias("denominator"))
    failures = quality.conversion_counts(dirty, ["amount_txt"], ["date_txt"]).select(
        "column_name", F.lit("nonblank_conversion_failures").alias("finding"), F.col("failures").alias("n"), F.col("values_before").alias("denominator")
    )
    signs = quality.sign_checks(panel, _SIGNED, _QUANTITIES).select(
        "column_name", F.lit("negative_value").alias("finding"), F.col("negative").alias("n"), "denominator"
    )
    return quality.audit_table(
        quality.audit_part(duplicates, "duplicates"),
        quality.audit_part(failures, "conversion", F.col("column_name")),
        quality.audit_part(signs, "logical", F.col("column_name")),
        quality.audit_part(quality.logical_flags(panel, _PAIRS), "logical"),
    )


def _findings(section: str, conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '' AS column_name, '{name}' AS finding, count(*) FILTER ({c}) AS n, count(*) AS denominator FROM odd"
        for name, c in conditions.items()
    )


AUDIT = (
    f"{ODD}, {F3}, dup AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1), a0 AS ("
    + " UNION ALL ".join([
        "SELECT 'duplicates' AS section, '' AS column_name, 'duplicate_key_rows' AS finding, CAST(coalesce(sum(n), 0) AS BIGINT) AS n, CAST(NULL AS BIGINT) AS denominator FROM dup",
        f"SELECT 'conversion', 'amount_txt', 'nonblank_conversion_failures', count(*) FILTER ({strip_sql('amount_txt')} <> '' AND {_NUMBER.format('amount_txt')} IS NULL), count(*) FROM f3",
        f"SELECT 'conversion', 'date_txt', 'nonblank_conversion_failures', count(*) FILTER ({strip_sql('date_txt')} <> '' AND {_DAY.format('date_txt')} IS NULL), count(*) FROM f3",
        *[f"SELECT 'logical', '{c}', 'negative_value', count(*) FILTER ({c} < 0), count(*) FROM odd" for c in _SIGNED],
        _findings("logical", _ZERO),
        _findings("logical", _CONTEXT),
        _findings("logical", {f"{a}_before_{b}": f"{a} < {b}" for a, b in _PAIRS}),
    ])
    + "), audit AS (SELECT *, '' AS value, CAST(NULL AS DOUBLE) AS measure, 100.0 * n / CAST(denominator AS DOUBLE) AS percent FROM a0)"
)


_TEXTS = {"amount_txt": _NUMBER.format("amount_txt"), "date_txt": _DAY.format("date_txt"), "category_txt": "category_txt"}
_GROUPS = ["tarrif", "solar_consumer"]
_DESCRIBED = {
    "n": "count({c})", "mean": "avg({c})", "sd": "stddev_samp({c})", "minimum": "min({c})", "q1": "quantile_cont({c}, 0.25)",
    "median": "quantile_cont({c}, 0.5)", "q3": "quantile_cont({c}, 0.75)", "maximum": "max({c})",
}
_NO_COUNT = "CAST(NULL AS BIGINT) AS n, CAST(NULL AS BIGINT) AS denominator, '' AS value"
_SECTIONS = (
    "ms AS (" + " UNION ALL ".join(_profile_sql(c, t) for c, t in _TEXTS.items()) + "), "
    + "dn AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, upper({strip_sql(c)}) AS norm FROM f3" for c in _TEXTS) + f"""),
ds AS (SELECT column_name, CASE WHEN norm = '' THEN '[blank/whitespace]' WHEN norm IN ({_TOK}) THEN norm ELSE '[other candidate]' END AS finding, count(*) AS n FROM dn
  WHERE norm IN ({_TOK}) OR regexp_matches(norm, '^[?.*_-]+$') OR norm LIKE 'UNKNOWN%' OR norm LIKE 'MISSING%' OR norm LIKE 'NOT AVAILABLE%' GROUP BY 1, 2), """
    + "cf AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, coalesce(nullif({c}, ''), '[missing]') AS category, count(*) AS n FROM odd GROUP BY 2" for c in _GROUPS) + "), "
    + "sp AS (SELECT column_name, category = '[missing]' AS gone, upper(trim(category)) AS normal, count(*) AS s, sum(n) AS n FROM cf GROUP BY 1, 2, 3), "
    + "de AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, " + ", ".join(f"CAST({e.format(c=c)} AS DOUBLE) AS {k}" for k, e in _DESCRIBED.items()) + f" FROM odd WHERE isfinite({c})" for c in _SIGNED
    ) + "), fe AS (SELECT column_name, n, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS iqr_lower, q3 + 1.5 * (q3 - q1) AS iqr_upper FROM de)"
)
_COUNT = "CAST(NULL AS DOUBLE) AS measure"
_SECTION_ROWS = " UNION ALL ".join([
    *[f"SELECT 'missing' AS section, column_name, '{f}' AS finding, {c} AS n, n_rows AS denominator, '' AS value, {_COUNT} FROM ms"
      for f, c in (("standard_missing", "conventional_missing"), ("literal_blank", "blank_rows"), ("missing_after_typing", "typed_missing"))],
    f"SELECT 'disguised_missing', column_name, finding, n, (SELECT count(*) FROM f3), '', {_COUNT} FROM ds",
    f"SELECT 'categorical', column_name, 'category_frequency', n, (SELECT count(*) FROM odd), category, {_COUNT} FROM cf",
    *[f"SELECT 'categorical', column_name, '{f}', CAST({e} AS BIGINT), (SELECT count(*) FROM odd), '', {_COUNT} FROM sp GROUP BY column_name"
      for f, e in (("unique_categories", "coalesce(sum(s) FILTER (NOT gone), 0)"), ("blank_missing", "coalesce(sum(n) FILTER (gone), 0)"),
                   ("normalization_collision_groups", "count(*) FILTER (s > 1)"))],
    *[f"SELECT 'descriptive', column_name, '{f}', {_NO_COUNT}, {f} FROM de" for f in _DESCRIBED],
    *[f"SELECT 'outlier', column_name, '{f}', {_NO_COUNT}, {f} FROM fe" for f in ("iqr", "iqr_lower", "iqr_upper")],
    *[f"SELECT 'outlier', '{c}', 'potential_outliers', count(*) FILTER (isfinite({c}) AND NOT {c} BETWEEN iqr_lower AND iqr_upper), count(*) FILTER (isfinite({c})), '', {_COUNT} "
      f"FROM odd JOIN fe ON fe.column_name = '{c}'" for c in _SIGNED],
])


@query("audit_table", f"WITH {AUDIT}, {_SECTIONS}, a1 AS ({_SECTION_ROWS}) SELECT * FROM audit UNION ALL BY NAME SELECT *, 100.0 * n / CAST(denominator AS DOUBLE) AS percent FROM a1",
       ["percent", "measure"], 5)
def audit_table(spark, folder):
    """Every section of the audit. The panel is stored, as the sections read it several times."""
    texts = bindings.dirty_orders(spark, folder).drop("o_orderkey")
    panel = materialize(odd_panel(spark, folder), "panel")
    return audit(spark, folder, panel).drop("percent").transform(
        quality.audit_table,
        quality.missing_section(texts, ["amount_txt"], ["date_txt"]),
        quality.disguised_section(texts, list(_TEXTS)),
        quality.category_section(panel, _GROUPS),
        quality.measure_section(panel, _SIGNED),
    )


@query("quality_status", f"""WITH {AUDIT}, b AS (SELECT *, finding IN ('duplicate_key_rows', 'nonblank_conversion_failures') AND n > 0 AS hit FROM audit)
SELECT count(*) AS findings, count(*) FILTER (hit) AS blocking_findings, CAST(coalesce(sum(n) FILTER (hit), 0) AS BIGINT) AS blocking_records,
  CASE WHEN count(*) FILTER (hit) > 0 THEN 'manual_review_required' ELSE 'completed' END AS status FROM b""")
def quality_status(spark, folder):
    return quality.quality_status(
        audit(spark, folder), ["duplicate_key_rows", "nonblank_conversion_failures"]
    )


@query("panel_shape", f"""WITH {P1} SELECT count(*) AS total_rows, CAST(14 AS INT) AS total_columns, CAST(7 AS INT) AS numeric_columns,
  CAST(4 AS INT) AS date_columns, CAST(2 AS INT) AS text_columns, count(DISTINCT consumer_no) AS unique_consumers,
  min(ord) AS first_ord, max(ord) AS last_ord, count(DISTINCT ord) AS total_periods FROM p1""")
def panel_shape(spark, folder):
    return quality.panel_shape(bindings.supplier_months(spark, folder))
