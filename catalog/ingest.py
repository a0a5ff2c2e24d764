"""Reading, coverage, writing and arrival queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import P1, P2, P3, query
from meterflow.functions.scalars import month_ordinal, month_start
from meterflow.session import scratch_path
from meterflow.sources import bindings, extracts, tables
from meterflow.streaming import ingest

ORDER_FIELDS = ["ORDER_NO", "CONSUMER_NO", "STATUS", "AMOUNT", "ORDER_DATE", "PRIORITY"]
_ORDER_ORD = "CAST(year(o_orderdate)*12 + month(o_orderdate) - 1 AS INT)"


def order_text(spark, folder):
    """Orders as the text fields of an extract."""
    day = F.col("o_orderdate").cast("date")
    return bindings.table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("ORDER_NO"),
        F.col("o_custkey").cast("string").alias("CONSUMER_NO"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("STATUS"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("AMOUNT"),
        day.cast("string").alias("ORDER_DATE"),
        F.when(F.col("o_orderkey") % 10 == 0, "NA").otherwise(F.col("o_orderpriority")).alias("PRIORITY"),
        month_ordinal(day).alias("ord"),
    )


@query("read_extract", """SELECT CAST(o_orderkey AS VARCHAR) AS "ORDER_NO", CAST(o_custkey AS VARCHAR) AS "CONSUMER_NO",
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS "STATUS",
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS "AMOUNT", CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "ORDER_DATE",
  CASE WHEN o_orderkey % 10 = 0 THEN 'NA' ELSE o_orderpriority END AS "PRIORITY", '' AS _trailing FROM orders""")
def read_extract(spark, folder):
    path = scratch_path(spark, "extract")
    extracts.write_extract(order_text(spark, folder), path, ORDER_FIELDS)
    return extracts.read_extract(spark, path, ORDER_FIELDS).drop("_source_file")


_NAMES = f"""SELECT DISTINCT CASE WHEN o_orderkey % 41 = 0 THEN '512LDG13' || CAST(year(o_orderdate) AS VARCHAR) || '.txt'
  WHEN o_orderkey % 43 = 0 THEN '512LDG' || CAST(month(o_orderdate) AS VARCHAR) || CAST(year(o_orderdate) AS VARCHAR) || '.csv'
  WHEN o_orderkey % 47 = 0 THEN 'notes' || CAST(month(o_orderdate) AS VARCHAR) || '.txt'
  WHEN o_orderkey % 2 = 0 THEN '512ldg' || CAST(month(o_orderdate) AS VARCHAR) || CAST(year(o_orderdate) AS VARCHAR) || '.TXT'
  ELSE '512LDG' || CAST(month(o_orderdate) AS VARCHAR) || CAST(year(o_orderdate) AS VARCHAR) || '.txt' END AS file_name
FROM orders"""


@query("discover_periods", f"""WITH n AS ({_NAMES}), s AS (
SELECT file_name, CASE WHEN regexp_matches(file_name, '^512LDG(1[0-2]|[1-9])(\\d{{4}})\\.txt$', 'i') THEN 'ok'
   WHEN lower(file_name) LIKE '%.txt' THEN 'unexpected_name' ELSE 'not_txt' END AS status,
   regexp_extract(file_name, '^512LDG(1[0-2]|[1-9])(\\d{{4}})\\.txt$', 1, 'i') AS m,
   regexp_extract(file_name, '^512LDG(1[0-2]|[1-9])(\\d{{4}})\\.txt$', 2, 'i') AS y FROM n)
SELECT file_name, status, CASE WHEN status = 'ok' THEN CAST(CAST(y AS INT)*12 + CAST(m AS INT) - 1 AS INT) END AS ord,
  CASE WHEN status = 'ok' THEN y || '-' || lpad(m, 2, '0') END AS period FROM s""")
def discover_periods(spark, folder):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    month, year = F.month(day).cast("string"), F.year(day).cast("string")
    name = (
        F.when(key % 41 == 0, F.concat(F.lit("512LDG13"), year, F.lit(".txt")))
        .when(key % 43 == 0, F.concat(F.lit("512LDG"), month, year, F.lit(".csv")))
        .when(key % 47 == 0, F.concat(F.lit("notes"), month, F.lit(".txt")))
        .when(key % 2 == 0, F.concat(F.lit("512ldg"), month, year, F.lit(".TXT")))
        .otherwise(F.concat(F.lit("512LDG"), month, year, F.lit(".txt")))
    )
    names = bindings.table(spark, folder, "orders").select(name.alias("file_name")).distinct()
    return extracts.discover_periods(names)


@query("period_coverage", f"""WITH r AS (
  SELECT DISTINCT {_ORDER_ORD} AS ord, CASE WHEN {_ORDER_ORD} % 3 = 0 THEN o_orderpriority ELSE '' END AS file FROM orders),
o AS (SELECT ord, count(*) AS n FROM r GROUP BY ord),
e AS (SELECT CAST(i AS INT) AS ord FROM range(23945, 24031) t(i)),
j AS (SELECT coalesce(e.ord, o.ord) AS ord, coalesce(o.n, 0) AS n_records, e.ord IS NOT NULL AS wanted FROM e FULL JOIN o ON o.ord = e.ord)
SELECT ord, lpad(CAST(ord // 12 AS VARCHAR), 4, '0') || '-' || lpad(CAST(ord % 12 + 1 AS VARCHAR), 2, '0') AS period, n_records,
  CASE WHEN n_records = 0 THEN 'missing' WHEN NOT wanted THEN 'extra' WHEN n_records > 1 THEN 'duplicate' ELSE 'ok' END AS status
FROM j""")
def period_coverage(spark, folder):
    """One record per month, and one per priority in every third month; the expected span begins and ends later than the orders."""
    month = month_ordinal(F.col("o_orderdate").cast("date"))
    file = F.when(month % 3 == 0, F.col("o_orderpriority")).otherwise("")
    records = bindings.table(spark, folder, "orders").select(month.alias("ord"), file.alias("file")).distinct()
    return extracts.period_coverage(records, 23945, 24030)


@query("period_agreement", f"""WITH t AS (SELECT {_ORDER_ORD} AS ord,
  CASE WHEN o_orderkey % 13 = 0 THEN 'x' WHEN o_orderkey % 13 = 1 THEN '' WHEN o_orderkey % 13 = 2 THEN CAST(month(o_orderdate) % 12 + 1 AS VARCHAR)
       ELSE CAST(month(o_orderdate) AS VARCHAR) END AS m,
  CASE WHEN o_orderkey % 17 = 0 THEN CAST(year(o_orderdate) - 1 AS VARCHAR) ELSE CAST(year(o_orderdate) AS VARCHAR) END AS y FROM orders)
SELECT ord, count(*) AS n_rows,
  count(*) FILTER (NOT coalesce(TRY_CAST(m AS INT) = ord % 12 + 1 AND TRY_CAST(y AS INT) = ord // 12, false)) AS wrong_period_rows
FROM t GROUP BY ord""")
def period_agreement(spark, folder):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    rows = bindings.table(spark, folder, "orders").select(
        month_ordinal(day).alias("ord"),
        F.when(key % 13 == 0, "x")
        .when(key % 13 == 1, "")
        .when(key % 13 == 2, (F.month(day) % 12 + 1).cast("string"))
        .otherwise(F.month(day).cast("string"))
        .alias("MONTH"),
        F.when(key % 17 == 0, (F.year(day) - 1).cast("string")).otherwise(F.year(day).cast("string")).alias("YEAR"),
    )
    return extracts.period_agreement(rows)


@query("key_and_artifact_check", """SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey % 17 = 0) AS blank_keys,
  count(*) FILTER (o_orderkey % 19 = 0) AS artifact_values FROM orders""")
def key_and_artifact_check(spark, folder):
    key = F.col("o_orderkey")
    rows = bindings.table(spark, folder, "orders").select(
        F.when(key % 17 == 0, "  ").otherwise(F.col("o_custkey").cast("string")).alias("CONSUMER_NO"),
        F.when(key % 19 == 0, "x").otherwise("").alias("_trailing"),
    )
    return extracts.key_and_artifact_check(rows, "CONSUMER_NO")


@query("file_counts", f"""SELECT {_ORDER_ORD} AS ord, count(*) AS row_count, CAST(6 AS INT) AS column_count,
  count(DISTINCT o_custkey) AS unique_consumers FROM orders GROUP BY 1""")
def file_counts(spark, folder):
    return extracts.file_counts(order_text(spark, folder), ["ord"], "CONSUMER_NO", len(ORDER_FIELDS))


@query("monthly_counts", f"""SELECT {_ORDER_ORD} AS ord, count(*) AS row_count, count(DISTINCT o_custkey) AS unique_consumers
FROM orders GROUP BY 1""")
def monthly_counts(spark, folder):
    rows = order_text(spark, folder)
    return rows.groupBy("ord").agg(
        F.count("*").alias("row_count"), F.count_distinct("CONSUMER_NO").alias("unique_consumers")
    )


@query("combine_periods", f"""SELECT CAST(o_orderkey AS VARCHAR) AS "ORDER_NO", CAST(o_custkey AS VARCHAR) AS "CONSUMER_NO", {_ORDER_ORD} AS ord FROM orders""")
def combine_periods(spark, folder):
    rows = order_text(spark, folder).select("ORDER_NO", "CONSUMER_NO", "ord")
    quarters = [rows.filter(F.col("ord") % 4 == q) for q in range(4)]
    return extracts.combine_periods(*quarters, ordered_by=["CONSUMER_NO", "ord"])


def _copies(spark, folder):
    """Two copies of a text extract per month; the second one is damaged in known months."""
    lines = order_text(spark, folder).select(
        "ord", F.col("ORDER_NO").cast("bigint").alias("id"), F.concat_ws("|", *ORDER_FIELDS, F.lit("")).alias("line")
    )
    first, second = scratch_path(spark, "copy"), scratch_path(spark, "copy")
    whole = lines.repartition("ord")
    whole.sortWithinPartitions("ord", "id").select("ord", "line").write.partitionBy("ord").text(first)
    damaged = whole.filter((F.col("ord") % 5 != 2) & ~((F.col("ord") % 5 == 0) & (F.col("id") % 50 == 0)))
    order = F.when(F.col("ord") % 5 == 1, -F.col("id")).otherwise(F.col("id"))
    damaged.sortWithinPartitions("ord", order).select("ord", "line").write.partitionBy("ord").text(second)
    return first, second


@query("extract_fingerprint", f"""WITH t AS (SELECT {_ORDER_ORD} AS ord, o_orderkey AS id FROM orders),
a AS (SELECT ord, count(*) AS n, count(*) FILTER (id % 50 <> 0) AS kept FROM t GROUP BY ord)
SELECT CAST(ord AS VARCHAR) AS file_name, n AS first_lines,
  CASE ord % 5 WHEN 2 THEN NULL WHEN 0 THEN kept ELSE n END AS second_lines,
  CASE WHEN ord % 5 = 2 THEN 'only_first' WHEN ord % 5 = 0 AND kept < n THEN 'different'
       WHEN ord % 5 = 1 AND n > 1 THEN 'different' ELSE 'identical' END AS status FROM a""")
def extract_fingerprint(spark, folder):
    first, second = _copies(spark, folder)
    return extracts.extract_fingerprint(spark, first, second, r"/ord=([^/]+)/")


@query("chronology_check", f"""WITH {P2}, t AS (
  SELECT consumer_no, ord, CASE WHEN (consumer_no + ord) % 97 = 0 THEN NULL WHEN consumer_no % 10 = 0 THEN 23940 + consumer_no % 30
    WHEN consumer_no % 11 = 0 THEN 23900 + ord % 2 ELSE 23930 END AS c FROM p2),
g AS (SELECT consumer_no, count(*) AS n, count(*) FILTER (c IS NULL) AS u, count(*) FILTER (ord < c) AS b,
        min(ord) AS f, min(c) AS lo, max(c) AS hi FROM t GROUP BY consumer_no)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_consumers, CAST(sum(u) AS BIGINT) AS unverifiable_rows,
  CAST(sum(b) AS BIGINT) AS rows_before_connection, count(*) FILTER (f < lo) AS first_seen_before_connection,
  count(*) FILTER (lo <> hi) AS inconsistent_consumers, count(*) FILTER (f > (SELECT min(ord) FROM p2)) AS late_joiners FROM g""")
def chronology_check(spark, folder):
    return extracts.chronology_check(connected_customers(spark, folder))


def connected_customers(spark, folder):
    """P2 with connection dates that are partly unknown, late or inconsistent."""
    k, o = F.col("consumer_no"), F.col("ord")
    connection = (
        F.when((k + o) % 97 == 0, F.lit(None).cast("int"))
        .when(k % 10 == 0, 23940 + k % 30)
        .when(k % 11 == 0, 23900 + o % 2)
        .otherwise(23930)
    )
    return bindings.customer_months(spark, folder).withColumn("connection_date", month_start(connection))


_PERIOD = "lpad(CAST({0} // 12 AS VARCHAR), 4, '0') || '-' || lpad(CAST({0} % 12 + 1 AS VARCHAR), 2, '0')"


@query("loading_summary", f"""WITH {P1}, g AS (SELECT consumer_no, min(ord) AS f FROM p1 GROUP BY 1),
s AS (SELECT min(ord) AS lo, max(ord) AS hi, count(*) AS n, count(DISTINCT ord) AS np FROM p1)
SELECT 'passed' AS status, np AS file_count, n AS total_rows, (SELECT count(*) FROM g) AS unique_consumers,
  {_PERIOD.format('lo')} AS first_actual_month, {_PERIOD.format('hi')} AS latest_actual_month,
  {_PERIOD.format('(hi + 1)')} AS next_prediction_month, CAST(0 AS BIGINT) AS duplicate_consumer_month_rows,
  (SELECT count(*) FROM g WHERE f > lo) AS late_joiner_consumers, CAST(0 AS BIGINT) AS unverifiable_connection_date_rows,
  CAST(0 AS BIGINT) AS inconsistent_connection_date_consumers, CAST(0 AS BIGINT) AS rows_before_connection,
  (SELECT CAST(to_json(list({{'period': {_PERIOD.format('ord')}, 'rows': rows, 'consumers': consumers}} ORDER BY ord)) AS VARCHAR)
   FROM (SELECT ord, count(*) AS rows, count(DISTINCT consumer_no) AS consumers FROM p1 GROUP BY ord)) AS files FROM s""")
def loading_summary(spark, folder):
    return extracts.loading_summary(bindings.supplier_months(spark, folder))


@query("incremental_periods", f"""WITH {P3} SELECT ord, count(*) AS n_rows, count(DISTINCT consumer_no) AS n_consumers,
  CAST((SELECT max(ord) FROM p3) + 1 AS INT) AS next_period, CAST(CASE WHEN ord < 19743 THEN 0 ELSE 1 END AS BIGINT) AS batch_id
FROM p3 GROUP BY ord""")
def incremental_periods(spark, folder):
    """Days of P3 land in two steps; the stored history must equal the batch result."""
    panel = bindings.user_days(spark, folder)
    landing, out, state = (scratch_path(spark, n) for n in ("landing", "history", "state"))
    for arriving in (panel.filter("ord < 19743"), panel.filter("ord >= 19743")):
        arriving.write.mode("append").parquet(landing)
        ingest.ingest_new(spark, landing, out, state, panel.schema)
    history = spark.read.parquet(out)
    batches = history.groupBy("ord").agg(F.max("batch_id").alias("batch_id"))
    return ingest.history_summary(history).join(batches, "ord")


@query("read_projection", f"WITH {P1} SELECT consumer_no, ord, tarrif, bill_amount FROM p1")
def read_projection(spark, folder):
    path = scratch_path(spark, "panel")
    tables.write_panel(bindings.supplier_months(spark, folder), path)
    return tables.read_panel(spark, path, ["consumer_no", "ord", "tarrif", "bill_amount"])


@query("write_panel", f"""WITH {P1} SELECT consumer_no, ord, consumption_unit, bill_amount, payment_date, due_date, tarrif FROM p1""")
def write_panel(spark, folder):
    path = scratch_path(spark, "panel-csv")
    columns = ["consumer_no", "ord", "consumption_unit", "bill_amount", "payment_date", "due_date", "tarrif"]
    panel = bindings.supplier_months(spark, folder).select(*columns)
    tables.write_panel(panel, path, "csv")
    return spark.read.schema(panel.schema).option("header", True).csv(path).select(*columns)


@query("write_once", f"WITH {P1} SELECT count(*) AS n_rows, true AS second_write_refused FROM p1")
def write_once(spark, folder):
    path = scratch_path(spark, "evidence")
    evidence = bindings.supplier_months(spark, folder)
    tables.write_once(evidence, path)
    try:
        tables.write_once(evidence, path)
        refused = False
    except Exception as error:
        refused = "ALREADY_EXISTS" in str(error)
    return spark.read.parquet(path).agg(F.count("*").alias("n_rows"), F.lit(refused).alias("second_write_refused"))


@query("required_columns", """SELECT n.name, n.name IN ('o_orderkey', 'o_custkey', 'o_totalprice') AS present, n.type,
  CASE WHEN n.type IS NULL THEN 0 ELSE (SELECT count(*) FROM orders) END AS filled_rows
FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_totalprice', 'double'), ('due_date', NULL)) n(name, type)""")
def required_columns(spark, folder):
    return tables.required_columns(
        bindings.table(spark, folder, "orders"), ["o_orderkey", "o_custkey", "o_totalprice", "due_date"]
    )
