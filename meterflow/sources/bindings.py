"""The star-schema test tables seen as billing panels.

P1: supplier x month from lineitem (dense). P2: customer x month from orders (sparse).
P3: user x day from events. `dirty_orders`: orders as unchecked text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.functions.scalars import month_ordinal, month_start

# Windows of P1 target months (ordinals) per partition.
P1_BOUNDS = {
    "TRAIN": (23941, 24005),
    "VALIDATION": (24006, 24014),
    "FINAL_TEST": (24015, 24022),
    "FUTURE": (24023, 24023),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def supplier_months(spark: SparkSession, folder: str) -> DataFrame:
    """P1. Money is summed as decimal, so that the result does not depend on row order."""
    line = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("k"),
        F.col("l_shipdate").cast("date").alias("d"),
        F.col("l_quantity").alias("q"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("p"),
        F.col("l_discount").cast("decimal(4,2)").alias("dc"),
        F.col("l_tax").cast("decimal(4,2)").alias("tx"),
        (F.col("l_linestatus") == "F").alias("paid"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    one = F.lit(1).cast("decimal(1,0)")
    months = line.groupBy("k", month_ordinal(F.col("d")).alias("ord")).agg(
        F.sum("q").alias("consumption_unit"),
        F.sum("p").cast("double").alias("bill_amount"),
        F.sum(F.when(F.col("paid"), F.col("p") * (one - F.col("dc")))).cast("double").alias("payment_amount"),
        F.max(F.when(F.col("paid"), F.col("d"))).alias("last_paid"),
        F.sum(F.when(F.col("returned"), F.col("p") * F.col("tx")).otherwise(F.lit(0).cast("decimal(17,4)")))
        .cast("double")
        .alias("closing_arrears"),
    )
    regions = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .select("s_suppkey", F.abs("s_acctbal").alias("contract_load"), F.col("r_name").alias("tarrif"))
    )
    last_day = F.last_day(month_start(F.col("ord")))
    first_month = F.min("ord").over(Window.partitionBy("consumer_no"))
    return (
        months.join(regions, F.col("s_suppkey") == F.col("k"))
        .select(
            F.col("k").alias("consumer_no"),
            "ord",
            "consumption_unit",
            "bill_amount",
            "payment_amount",
            F.date_add("last_paid", (F.col("k") % 9).cast("int")).alias("payment_date"),
            F.date_add(last_day, ((F.col("k") + F.col("ord")) % 30 - 12).cast("int")).alias("due_date"),
            "closing_arrears",
            "contract_load",
            "tarrif",
            F.when((F.col("k") % 10 == 0) & (F.col("ord") >= 23978), "Y").otherwise("N").alias("solar_consumer"),
            last_day.alias("month_end"),
        )
        .withColumn("payment_blank", F.col("payment_date").isNull())
        .withColumn(
            "connection_date", month_start((first_month - F.col("consumer_no") % 24).cast("int"))
        )
    )


def customer_months(spark: SparkSession, folder: str) -> DataFrame:
    """P2: most calendar neighbours are absent."""
    months = (
        table(spark, folder, "orders")
        .groupBy(
            F.col("o_custkey").alias("consumer_no"),
            month_ordinal(F.col("o_orderdate").cast("date")).alias("ord"),
        )
        .agg(
            F.count("*").cast("double").alias("consumption_unit"),
            F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("bill_amount"),
        )
    )
    segments = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("consumer_no"), F.col("c_mktsegment").alias("tarrif")
    )
    return months.join(segments, "consumer_no")


def user_days(spark: SparkSession, folder: str) -> DataFrame:
    """P3: the panel at day grain, `ord` counts days since 1970-01-01."""
    return (
        table(spark, folder, "events")
        .select("user_id", "value", F.col("ts").cast("date").alias("day"))
        .groupBy(
            F.col("user_id").alias("consumer_no"),
            F.datediff("day", F.lit("1970-01-01").cast("date")).alias("ord"),
        )
        .agg(F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("consumption_unit"))
    )


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text with blanks, white space of several kinds, tokens, malformed numbers and malformed dates."""
    key = F.col("o_orderkey")
    blank = F.when(key % 3 == 0, " ").when(key % 3 == 1, "\t\n").otherwise("\xa0 ")
    bad_amounts = ["", "NA", "bad", blank, "?", "12d", "inf", "-1", "\xa075.5\n"]
    amount = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    for rest, text in reversed(list(enumerate(bad_amounts))):
        amount = F.when(key % 11 == rest, text).otherwise(amount)
    day = F.col("o_orderdate").cast("date").cast("string")
    for rest, text in reversed(list(enumerate([F.when(key % 2 == 0, "\t").otherwise(""), "2025-02-30", "2025-3-1", "UNKNOWN X"]))):
        day = F.when(key % 7 == rest, text).otherwise(day)
    priority = F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        amount.alias("amount_txt"),
        day.alias("date_txt"),
        F.when(key % 5 == 0, F.lower(priority))
        .when(key % 5 == 1, F.concat(F.lit(" "), priority))
        .when(key % 5 == 2, F.concat(priority, F.lit("\t\xa0")))
        .otherwise(priority)
        .alias("category_txt"),
    )
