"""Consolidated predictions, dashboard totals and consumer-level views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.reshape import long_form
from meterflow.functions.scalars import financial_year_start, month_number

KEYS = ["consumer_no", "target_ord"]


def consolidate_predictions(consumption: DataFrame, revenue: DataFrame, anomaly: DataFrame) -> DataFrame:
    """The three prediction sets side by side per (consumer, target period), with presence flags."""
    a = consumption.select(*KEYS, F.col("prediction").alias("predicted_consumption"))
    b = revenue.select(
        *KEYS, F.col("predicted_class").alias("predicted_revenue_risk_class"), F.col("probability").alias("revenue_class_1_probability")
    )
    c = anomaly.select(
        *KEYS, F.col("predicted_class").alias("predicted_anomaly_class"), F.col("probability").alias("anomaly_class_1_probability")
    )
    return (
        a.join(b, KEYS, "full")
        .join(c, KEYS, "full")
        .withColumns(
            {
                "has_consumption_prediction": F.col("predicted_consumption").isNotNull(),
                "has_revenue_prediction": F.col("predicted_revenue_risk_class").isNotNull(),
                "has_anomaly_prediction": F.col("predicted_anomaly_class").isNotNull(),
            }
        )
    )


def serving_predictions(consumption: DataFrame, revenue: DataFrame, anomaly: DataFrame) -> DataFrame:
    """One row per consumer with readable classes; a class without its probability is absent."""
    a = consumption.select("consumer_no", F.col("target_ord").alias("_t1"), F.col("prediction").alias("predicted_consumption"))
    b = revenue.select(
        "consumer_no", F.col("target_ord").alias("_t2"), F.col("predicted_class").alias("revenue_risk_class"),
        F.col("probability").alias("revenue_risk_probability"),
    )
    c = anomaly.select(
        "consumer_no", F.col("target_ord").alias("_t3"), F.col("predicted_class").alias("anomaly_class"),
        F.col("probability").alias("anomaly_probability"),
    )

    def named(column: str, one: str, zero: str) -> Column:
        return F.when(F.col(column) == 1, one).when(F.col(column) == 0, zero)

    return (
        a.join(b, "consumer_no", "full")
        .join(c, "consumer_no", "full")
        .withColumns(
            {
                "target_ord": F.coalesce("_t1", "_t2", "_t3"),
                "has_consumption_prediction": F.col("predicted_consumption").isNotNull(),
                "has_revenue_prediction": F.col("revenue_risk_class").isNotNull() & F.col("revenue_risk_probability").isNotNull(),
                "has_anomaly_prediction": F.col("anomaly_class").isNotNull() & F.col("anomaly_probability").isNotNull(),
                "revenue_risk": named("revenue_risk_class", "Risk", "No Risk"),
                "unusual_consumption": named("anomaly_class", "Unusual", "Normal"),
            }
        )
        .drop("_t1", "_t2", "_t3")
    )


def latest_attributes(panel: DataFrame, columns: Sequence[str], key: str = "consumer_no", ord: str = "ord") -> DataFrame:
    """Attributes from the rows of the latest period, one per consumer."""
    latest = panel.agg(F.max(ord)).scalar()
    return panel.filter(F.col(ord) == latest).select(key, *columns).dropDuplicates([key])


def predictions_with_attributes(predictions: DataFrame, attributes: DataFrame, key: str = "consumer_no") -> DataFrame:
    return predictions.join(attributes, key, "left")


def search_filter(
    predictions: DataFrame, text: str | None = None, risk: str | None = None,
    unusual: str | None = None, tariff: str | None = None,
) -> DataFrame:
    """Literal, case-blind part of the consumer number, and optional exact filters."""
    if text:
        needle = F.lower(F.lit(text.strip()))
        predictions = predictions.filter(F.contains(F.lower(F.col("consumer_no").cast("string")), needle))
    for column, wanted in (("revenue_risk", risk), ("unusual_consumption", unusual), ("tarrif", tariff)):
        if wanted is not None:
            predictions = predictions.filter(F.col(column) == wanted)
    return predictions


def prediction_kpis(predictions: DataFrame) -> DataFrame:
    """Consumers, predicted total and class-1 counts with their share of the valid predictions."""
    def share(column: str) -> Column:
        return F.try_divide(F.lit(100.0) * F.count_if(F.col(column) == 1), F.count(column))

    return predictions.agg(
        F.count_distinct("consumer_no").alias("consumers"),
        F.sum("predicted_consumption").alias("predicted_consumption"),
        F.count_if(F.col("revenue_risk_class") == 1).alias("revenue_risk"),
        share("revenue_risk_class").alias("revenue_risk_percent"),
        F.count_if(F.col("anomaly_class") == 1).alias("unusual"),
        share("anomaly_class").alias("unusual_percent"),
    )


# --- history totals -------------------------------------------------------------------

def select_periods(panel: DataFrame, year: str | None = None, month: int | None = None, ord: str = "ord") -> DataFrame:
    """Rows of a financial year (2025-2026) and optionally one month of it.

    The year is a range of periods, which prunes the folders of a stored panel.
    """
    if year is not None:
        first = financial_year_start(year)
        panel = panel.filter(F.col(ord).between(first, first + 11))
    if month is not None:
        panel = panel.filter(month_number(F.col(ord)) == month)
    return panel


def period_kpis(panel: DataFrame, ord: str = "ord") -> DataFrame:
    """Totals of a selection; arrears are a balance, so only the last period's count."""
    last = panel.agg(F.max(ord)).scalar()
    return panel.agg(
        F.count_distinct("consumer_no").alias("consumers"),
        F.sum("consumption_unit").alias("total_consumption"),
        F.sum("bill_amount").alias("total_bill"),
        F.sum("payment_amount").alias("total_payment"),
        F.sum(F.when(F.col(ord) == last, F.col("closing_arrears"))).alias("closing_arrears_period_end"),
    ).withColumn("consumption_per_consumer", F.try_divide("total_consumption", F.col("consumers")))


def _totals() -> list[Column]:
    return [
        F.coalesce(F.sum("consumption_unit"), F.lit(0.0)).alias("total_consumption"),
        F.coalesce(F.sum("bill_amount"), F.lit(0.0)).alias("bill_amount"),
        F.coalesce(F.sum("payment_amount"), F.lit(0.0)).alias("payment_amount"),
        F.coalesce(F.sum("closing_arrears"), F.lit(0.0)).alias("closing_arrears"),
        F.count_distinct("consumer_no").alias("consumers"),
    ]


def monthly_trend(panel: DataFrame, ord: str = "ord") -> DataFrame:
    return panel.groupBy(ord).agg(*_totals())


def tariff_rollup(panel: DataFrame) -> DataFrame:
    """Totals per tariff, rows without one as 'Missing'."""
    return panel.groupBy(F.coalesce("tarrif", F.lit("Missing")).alias("tarrif")).agg(
        *_totals(), F.avg("consumption_unit").alias("average_consumption")
    )


def melt_series(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return long_form(df, columns, "series", "amount", ids)


# --- one consumer at a time, for all consumers -----------------------------------------

def consumer_360(panel: DataFrame, predictions: DataFrame, key: str = "consumer_no", ord: str = "ord") -> DataFrame:
    """History summary of every consumer next to the prediction.

    A consumer has at most the months of the calendar, so its median and its last three
    values are taken inside one aggregate without a second shuffle.
    """
    value = F.col("consumption_unit")
    latest = F.max(ord)
    recent = F.slice(F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct(ord, value))), False), 1, 3)
    history = panel.groupBy(key).agg(
        latest.alias("latest_ord"),
        F.max_by(value, ord).alias("last_actual"),
        F.avg(value).alias("mean"),
        F.median(value).alias("median"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
        recent.alias("_recent"),
    )
    picked = F.col("_recent")
    n = F.size(picked)
    total = F.aggregate(picked, F.lit(0.0), lambda acc, x: acc + x["consumption_unit"])
    change = F.col("predicted_consumption") - F.col("last_actual")
    return (
        history.withColumns(
            {
                "latest": F.when(n >= 1, F.get(picked, F.lit(0))["consumption_unit"]),
                "recent_average": F.when(n >= 1, F.try_divide(total, n)),
                "recent_trend": F.when(
                    n >= 2,
                    F.get(picked, F.lit(0))["consumption_unit"] - F.get(picked, n - 1)["consumption_unit"],
                ),
            }
        )
        .join(predictions.select(key, "predicted_consumption"), key, "left")
        .withColumns(
            {
                "change": change,
                "change_percent": F.when(F.col("last_actual") != 0, F.try_divide(F.lit(100.0) * change, F.col("last_actual"))),
            }
        )
        .drop("_recent")
    )


def actual_plus_prediction(panel: DataFrame, predictions: DataFrame, key: str = "consumer_no", ord: str = "ord") -> DataFrame:
    """History points, and a bridge from the last one to the prediction, as two named series."""
    actual = panel.select(key, ord, F.col("consumption_unit").alias("value"), F.lit("Historical Actual").alias("series"))
    predicted = predictions.filter(F.col("predicted_consumption").isNotNull())
    last = panel.groupBy(key).agg(F.max(ord).alias(ord), F.max_by("consumption_unit", ord).alias("value"))
    start = last.join(predicted.select(key), key, "left_semi")
    end = predicted.select(key, F.col("target_ord").alias(ord), F.col("predicted_consumption").alias("value"))
    bridge = start.unionByName(end).withColumn("series", F.lit("Prediction"))
    return actual.unionByName(bridge)
