"""Registration of queries with their SQL twins, and the SQL shared by several twins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.scalars import WHITE


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    group: str


REGISTRY: dict[str, Entry] = {}


def strip_sql(c: str) -> str:
    return f"trim({c}, '{WHITE}')"


def query(name: str, sql: str | None = None, floats: Sequence[str] = (), digits: int = 6):
    """Register a query. Columns in `floats` are rounded alike on both sides."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(spark, folder)
            return df.withColumns({c: F.round(F.col(c), digits) for c in floats}) if floats else df

        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        text = sql.strip() if sql else None
        if text and floats:
            rounded = ", ".join(f"round({c}, {digits}) AS {c}" for c in floats)
            text = f"SELECT * REPLACE ({rounded}) FROM (\n{text}\n)"
        REGISTRY[name] = Entry(run, text, fn.__module__.rsplit(".", 1)[-1])
        return fn

    return register


# P1 as SQL. `last_day` needs dates, `ord` is year * 12 + month - 1.
P1 = """
p1_line AS (
  SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS d, l_quantity AS q,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS dc,
         CAST(l_tax AS DECIMAL(4,2)) AS tx, l_linestatus AS st, l_returnflag AS rf
  FROM lineitem),
p1_month AS (
  SELECT k, CAST(year(d)*12 + month(d) - 1 AS INT) AS ord, max(last_day(d)) AS month_end,
         sum(q) AS consumption_unit, CAST(sum(p) AS DOUBLE) AS bill_amount,
         CAST(sum(CASE WHEN st='F' THEN p*(1-dc) END) AS DOUBLE) AS payment_amount,
         max(CASE WHEN st='F' THEN d END) AS last_paid,
         CAST(sum(CASE WHEN rf='R' THEN p*tx ELSE 0 END) AS DOUBLE) AS closing_arrears
  FROM p1_line GROUP BY k, CAST(year(d)*12 + month(d) - 1 AS INT)),
p1 AS (
  SELECT m.k AS consumer_no, m.ord, consumption_unit, bill_amount, payment_amount,
         CAST(last_paid + CAST(m.k % 9 AS INT) AS DATE) AS payment_date,
         CAST(month_end + CAST((m.k + m.ord) % 30 - 12 AS INT) AS DATE) AS due_date,
         closing_arrears, abs(s.s_acctbal) AS contract_load, r.r_name AS tarrif,
         CASE WHEN m.k % 10 = 0 AND m.ord >= 23978 THEN 'Y' ELSE 'N' END AS solar_consumer, month_end,
         last_paid IS NULL AS payment_blank,
         CAST(min(m.ord) OVER (PARTITION BY m.k) - m.k % 24 AS INT) AS connection_ord
  FROM p1_month m JOIN supplier s ON s.s_suppkey = m.k
  JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey)
"""

P2 = """
p2 AS (
  SELECT o_custkey AS consumer_no,
         CAST(year(o_orderdate)*12 + month(o_orderdate) - 1 AS INT) AS ord,
         CAST(count(*) AS DOUBLE) AS consumption_unit,
         CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS bill_amount,
         max(c_mktsegment) AS tarrif
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
"""

P3 = """
p3 AS (
  SELECT user_id AS consumer_no,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INT) AS ord,
         CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS consumption_unit
  FROM events GROUP BY 1, 2)
"""

F3 = """
f3 AS (
  SELECT o_orderkey,
    CASE o_orderkey % 11 WHEN 0 THEN '' WHEN 1 THEN 'NA' WHEN 2 THEN 'bad'
         WHEN 3 THEN CASE o_orderkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN chr(9) || chr(10) ELSE chr(160) || ' ' END
         WHEN 4 THEN '?' WHEN 5 THEN '12d' WHEN 6 THEN 'inf' WHEN 7 THEN '-1' WHEN 8 THEN chr(160) || '75.5' || chr(10)
         ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount_txt,
    CASE o_orderkey % 7 WHEN 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN chr(9) ELSE '' END WHEN 1 THEN '2025-02-30' WHEN 2 THEN '2025-3-1' WHEN 3 THEN 'UNKNOWN X'
         ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_txt,
    CASE o_orderkey % 5 WHEN 0 THEN lower(o_orderpriority) WHEN 1 THEN ' ' || o_orderpriority WHEN 2 THEN o_orderpriority || chr(9) || chr(160)
         ELSE o_orderpriority END AS category_txt
  FROM orders)
"""

# Features and labels of P1, written with joins on the calendar where the Spark side uses windows.
FEATURES = (
    P1
    + """,
fx_asof AS (
  SELECT p1.*,
    month_end AS feature_cutoff_date,
    CAST(ord + 1 AS INT) AS target_ord,
    CAST((ord + 1) % 12 + 1 AS INT) AS target_month,
    CASE WHEN isfinite(consumption_unit) AND consumption_unit >= 0 THEN consumption_unit END AS current_consumption,
    CASE WHEN isfinite(closing_arrears) THEN closing_arrears END AS arrears_current,
    coalesce(payment_date <= month_end, false) AS payment_observed_by_cutoff,
    CASE WHEN payment_date <= month_end AND bill_amount > 0 THEN payment_amount / bill_amount END AS payment_ratio_current,
    CASE WHEN payment_date <= month_end THEN CAST(date_diff('day', due_date, payment_date) AS INT) END AS payment_delay_current,
    CASE WHEN NOT bill_amount > 0 OR due_date IS NULL THEN NULL
         WHEN payment_blank OR payment_date > due_date THEN CAST(0 AS DOUBLE)
         WHEN payment_date <= due_date THEN payment_amount / bill_amount END AS payment_ratio_outcome,
    CASE WHEN ord >= connection_ord THEN CAST(ord - connection_ord AS INT) END AS tenure_months,
    coalesce(ord < connection_ord, false) AS negative_tenure_flag
  FROM p1),
fx_label AS (
  SELECT *, CASE WHEN payment_ratio_outcome IS NOT NULL THEN CAST(payment_ratio_outcome < 0.5 AS INT) END AS at_risk_current
  FROM fx_asof),
fx_hist AS (
  SELECT f.*,
    l1.current_consumption AS consumption_lag1, l2.current_consumption AS consumption_lag2,
    l3.current_consumption AS consumption_lag3, l11.current_consumption AS same_month_last_year,
    l1.payment_ratio_current AS payment_ratio_lag1, l2.payment_ratio_current AS payment_ratio_lag2_audit,
    l1.arrears_current AS arrears_lag1,
    count(f.current_consumption) OVER w AS prior_count,
    avg(f.current_consumption) OVER w AS prior_mean,
    stddev_samp(f.current_consumption) OVER w AS prior_std
  FROM fx_label f
  LEFT JOIN fx_label l1 ON l1.consumer_no = f.consumer_no AND l1.ord = f.ord - 1
  LEFT JOIN fx_label l2 ON l2.consumer_no = f.consumer_no AND l2.ord = f.ord - 2
  LEFT JOIN fx_label l3 ON l3.consumer_no = f.consumer_no AND l3.ord = f.ord - 3
  LEFT JOIN fx_label l11 ON l11.consumer_no = f.consumer_no AND l11.ord = f.ord - 11
  WINDOW w AS (PARTITION BY f.consumer_no ORDER BY f.ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fx_z AS (
  SELECT *,
    (current_consumption + consumption_lag1 + consumption_lag2) / 3 AS recent_mean_3,
    sqrt((pow(current_consumption - (current_consumption + consumption_lag1 + consumption_lag2) / 3, 2)
        + pow(consumption_lag1 - (current_consumption + consumption_lag1 + consumption_lag2) / 3, 2)
        + pow(consumption_lag2 - (current_consumption + consumption_lag1 + consumption_lag2) / 3, 2)) / 2) AS recent_std_3,
    current_consumption - consumption_lag2 AS consumption_trend_3,
    (payment_ratio_current + payment_ratio_lag1 + payment_ratio_lag2_audit) / 3 AS payment_ratio_mean3,
    arrears_current - arrears_lag1 AS arrears_trend,
    CASE WHEN prior_count >= 3 AND prior_std > 0 THEN (current_consumption - prior_mean) / prior_std END AS rule_z_current
  FROM fx_hist),
fx_anomaly AS (
  SELECT *, CASE WHEN rule_z_current IS NOT NULL THEN CAST(abs(rule_z_current) > 2.5 AS INT) END AS anomaly_current
  FROM fx_z),
fx AS (
  SELECT a.*, n.current_consumption AS consumption_next, n.at_risk_current AS at_risk_next,
         n.anomaly_current AS anomaly_next
  FROM fx_anomaly a LEFT JOIN fx_anomaly n ON n.consumer_no = a.consumer_no AND n.ord = a.ord + 1)
"""
)

# Module x partition rows with one target column.
SPLITS = (
    FEATURES
    + """,
sp_long AS (
  SELECT 'consumption' AS module, consumption_next AS target, fx.* FROM fx
  UNION ALL SELECT 'revenue', CAST(at_risk_next AS DOUBLE), fx.* FROM fx
  UNION ALL SELECT 'anomaly', CAST(anomaly_next AS DOUBLE), fx.* FROM fx),
sp_window AS (
  SELECT CASE WHEN target_ord BETWEEN 23941 AND 24005 THEN 'TRAIN'
              WHEN target_ord BETWEEN 24006 AND 24014 THEN 'VALIDATION'
              WHEN target_ord BETWEEN 24015 AND 24022 THEN 'FINAL_TEST'
              WHEN target_ord = 24023 THEN 'FUTURE' END AS "partition", *
  FROM sp_long),
sp AS (
  SELECT * FROM sp_window
  WHERE "partition" = 'FUTURE' OR ("partition" IS NOT NULL AND target IS NOT NULL))
"""
)
