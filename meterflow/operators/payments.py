"""Payment observability and outcome summaries of a featured panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.reshape import one_row_to_long
from meterflow.functions.scalars import flag, is_finite
from meterflow.operators.ranks import exact_quantiles

OUTCOME_CATEGORIES = [
    "by_due_valid_amount", "by_due_missing_invalid_amount", "no_payment_by_due",
    "eligible_unknown_payment_date",
]


def _conditions():
    bill, amount = F.col("bill_amount"), F.col("payment_amount")
    paid_on, due = F.col("payment_date"), F.col("due_date")
    blank = flag(F.col("payment_blank"))
    observed = F.col("payment_observed_by_cutoff")
    valid_amount = flag(is_finite(amount))
    eligible = flag((bill > 0) & is_finite(bill)) & due.isNotNull()
    by_due = flag(paid_on <= due)
    no_payment = due.isNotNull() & (blank | flag(paid_on > due))
    unknown = ~blank & paid_on.isNull()
    at_risk = F.col("at_risk_current")
    return {
        "outcome_eligible": eligible,
        "positive_bill": flag(bill > 0),
        "observed_by_cutoff": observed,
        "not_observed_by_cutoff": ~observed,
        "payment_date_null": blank,
        "payment_date_after_cutoff": flag(paid_on > F.col("month_end")),
        "observed_zero_amount": observed & flag(amount == 0),
        "observed_positive_amount": observed & flag(amount > 0),
        "observed_missing_invalid_amount": observed & ~valid_amount,
        "valid_payment_ratio_current": F.col("payment_ratio_current").isNotNull(),
        "missing_payment_ratio_current": F.col("payment_ratio_current").isNull(),
        "valid_payment_delay_current": F.col("payment_delay_current").isNotNull(),
        "missing_payment_delay_current": F.col("payment_delay_current").isNull(),
        "valid_payment_ratio_outcome": F.col("payment_ratio_outcome").isNotNull(),
        "missing_payment_ratio_outcome": F.col("payment_ratio_outcome").isNull(),
        "by_due_valid_amount": eligible & by_due & valid_amount,
        "by_due_missing_invalid_amount": eligible & by_due & ~valid_amount,
        "no_payment_by_due": eligible & no_payment,
        "eligible_unknown_payment_date": eligible & unknown,
        "at_risk_current_0": flag(at_risk == 0),
        "at_risk_current_1": flag(at_risk == 1),
        "at_risk_current_undefined": at_risk.isNull(),
        "invalid_nonblank_payment_date": unknown,
        "negative_tenure": F.col("negative_tenure_flag"),
    }


def payment_resolution(df: DataFrame, ord: str = "ord") -> DataFrame:
    """Monthly counts of payment states; the outcome categories must add up to the eligible rows."""
    conditions = _conditions()
    monthly = df.groupBy(ord).agg(
        F.count("*").alias("total_rows"), *[F.count_if(c).alias(name) for name, c in conditions.items()]
    )
    parts = sum((F.col(c) for c in OUTCOME_CATEGORIES[1:]), F.col(OUTCOME_CATEGORIES[0]))
    return monthly.withColumn("reconciles", parts == F.col("outcome_eligible"))


def due_date_profile(df: DataFrame) -> DataFrame:
    """Eligible bills by due date against month end, and by outcome: (metric, n, percent)."""
    conditions = _conditions()
    eligible = conditions["outcome_eligible"]
    late = F.col("due_date") > F.col("month_end")
    metrics = {
        "eligible_positive_bill_valid_due": eligible,
        "due_on_or_before_cutoff": eligible & ~late,
        "due_after_cutoff": eligible & late,
        **{c: conditions[c] for c in OUTCOME_CATEGORIES},
    }
    row = df.agg(*[F.count_if(c).alias(name) for name, c in metrics.items()])
    total = F.col("eligible_positive_bill_valid_due")
    return one_row_to_long(
        row,
        "metric",
        {m: {"n": F.col(m), "percent_of_eligible": F.try_divide(F.lit(100.0) * F.col(m), total)} for m in metrics},
    )


def due_day_frequencies(df: DataFrame) -> DataFrame:
    """Eligible bills by day of the month their payment is due."""
    eligible = df.filter(_conditions()["outcome_eligible"])
    total = eligible.agg(F.count("*")).scalar()
    return (
        eligible.groupBy(F.dayofmonth("due_date").alias("due_day"))
        .agg(F.count("*").alias("n"))
        .withColumn("percent_of_eligible", F.lit(100.0) * F.col("n") / total)
    )


def due_day_quartiles(df: DataFrame) -> DataFrame:
    """Extremes, quartiles and mean of the due day, from the 31 daily counts at most."""
    days = df.filter(_conditions()["outcome_eligible"]).select(
        F.dayofmonth("due_date").cast("double").alias("value")
    )
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = exact_quantiles(days, [], "value", names).select(F.struct(*names)).scalar()
    return days.agg(
        F.min("value").alias("minimum"), F.max("value").alias("maximum"), F.avg("value").alias("mean")
    ).withColumns({name: quartiles.getField(name) for name in names})


def target_availability(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """Available and missing rows per target, with class counts for the labels."""
    row = df.agg(
        F.count("*").alias("_rows"),
        *[
            F.struct(
                F.count(t).alias("known"),
                F.count_if(F.col(t) == 0).alias("zero"),
                F.count_if(F.col(t) == 1).alias("one"),
            ).alias(f"_p_{t}")
            for t in targets.values()
        ],
    )
    labels = {t for m, t in targets.items() if m != "consumption"}
    none = F.lit(None).cast("bigint")
    return one_row_to_long(
        row,
        "target",
        {
            t: {
                "available": F.col(f"_p_{t}.known"),
                "missing": F.col("_rows") - F.col(f"_p_{t}.known"),
                "class_0": F.col(f"_p_{t}.zero") if t in labels else none,
                "class_1": F.col(f"_p_{t}.one") if t in labels else none,
            }
            for t in targets.values()
        },
    )
