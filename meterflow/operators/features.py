"""Leakage-safe predictors, rule labels and next-month targets.

Every step takes the typed panel (see `typed_panel`) or the output of an earlier step.
`build_features` chains them; the per-consumer steps share one shuffle by consumer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow import schema
from meterflow.functions.scalars import (
    finite,
    flag,
    is_blank,
    is_finite,
    month_end,
    month_number,
    month_ordinal,
    period_ordinal,
    to_day,
    to_number,
)
from meterflow.operators.calendar import KEY, ORD, calendar_lag, exactly

HISTORY = {
    "consumption_lag1": ("current_consumption", 1),
    "consumption_lag2": ("current_consumption", 2),
    "consumption_lag3": ("current_consumption", 3),
    "same_month_last_year": ("current_consumption", 11),
    "payment_ratio_lag1": ("payment_ratio_current", 1),
    "payment_ratio_lag2_audit": ("payment_ratio_current", 2),
    "arrears_lag1": ("arrears_current", 1),
}
NEXT = {
    "consumption_next": ("current_consumption", -1),
    "at_risk_next": ("at_risk_current", -1),
    "anomaly_next": ("anomaly_current", -1),
}


def typed_panel(raw: DataFrame) -> DataFrame:
    """Typed working columns from text fields; the blank test keeps the original payment date."""
    text = {c.lower(): F.col(c) for c in raw.columns}
    numbers = ["consumption_unit", "bill_amount", "payment_amount", "closing_arrears", "contract_load"]
    days = ["payment_date", "due_date", "connection_date"]
    ordinal = period_ordinal(text["period"])
    return raw.select(
        text["consumer_no"].alias(KEY),
        ordinal.alias(ORD),
        month_end(ordinal).alias("month_end"),
        *[to_number(text[c]).alias(c) for c in numbers],
        *[to_day(text[c]).alias(c) for c in days],
        is_blank(text["payment_date"]).alias("payment_blank"),
        text["tarrif"].alias("tarrif"),
        text["solar_consumer"].alias("solar_consumer"),
    )


def cutoff_and_target(df: DataFrame) -> DataFrame:
    """Month-end cutoff, the target month t+1 and its month of the year."""
    target = F.col(ORD) + 1
    return df.withColumns(
        {
            "feature_cutoff_date": month_end(F.col(ORD)),
            "target_ord": target.cast("int"),
            "target_month": month_number(target),
        }
    )


def valid_measures(df: DataFrame) -> DataFrame:
    """Finite measures; a consumption must also not be negative."""
    consumption = finite(F.col("consumption_unit"))
    return df.withColumns(
        {
            "current_consumption": F.when(consumption >= 0, consumption),
            "arrears_current": finite(F.col("closing_arrears")),
            "bill_amount": finite(F.col("bill_amount")),
            "contract_load": finite(F.col("contract_load")),
        }
    )


def _amount_over_bill():
    ratio = F.try_divide(F.col("payment_amount"), F.col("bill_amount"))
    usable = (F.col("bill_amount") > 0) & is_finite(F.col("payment_amount")) & is_finite(F.col("bill_amount"))
    return F.when(usable, finite(ratio))


def payment_ratio_asof(df: DataFrame) -> DataFrame:
    """Paid share of the bill, from payments dated by the month's own end only."""
    observed = flag(F.col("payment_date") <= F.col("month_end"))
    return df.withColumns(
        {
            "payment_observed_by_cutoff": observed,
            "payment_ratio_current": F.when(observed, _amount_over_bill()),
        }
    )


def payment_delay_asof(df: DataFrame) -> DataFrame:
    """Days from due date to an observed payment; early payments are negative."""
    observed = flag(F.col("payment_date") <= F.col("month_end"))
    return df.withColumn(
        "payment_delay_current", F.when(observed, F.datediff("payment_date", "due_date"))
    )


def payment_ratio_outcome(df: DataFrame) -> DataFrame:
    """Share paid by the due date: 0 without a payment by then, NULL when it cannot be known."""
    due, paid_on = F.col("due_date"), F.col("payment_date")
    judged = (F.col("bill_amount") > 0) & is_finite(F.col("bill_amount")) & due.isNotNull()
    return df.withColumn(
        "payment_ratio_outcome",
        F.when(
            judged,
            F.when(flag(F.col("payment_blank")) | (paid_on > due), F.lit(0.0)).when(
                paid_on <= due, _amount_over_bill()
            ),
        ),
    )


def at_risk_label(df: DataFrame, threshold: float = schema.AT_RISK_RATIO) -> DataFrame:
    """1 when less than `threshold` was paid by the due date; exactly the threshold is 0."""
    return df.withColumn(
        "at_risk_current", (F.col("payment_ratio_outcome") < F.lit(float(threshold))).cast("int")
    )


def tenure_months(df: DataFrame) -> DataFrame:
    """Calendar months since connection; a negative tenure is flagged and dropped."""
    tenure = F.col(ORD) - month_ordinal(F.col("connection_date"))
    return df.withColumns(
        {
            "negative_tenure_flag": flag(tenure < 0),
            "tenure_months": F.when(tenure >= 0, tenure).cast("int"),
        }
    )


def asof_columns(df: DataFrame) -> DataFrame:
    """All row-local columns: no shuffle."""
    for step in (
        cutoff_and_target,
        valid_measures,
        payment_ratio_asof,
        payment_delay_asof,
        payment_ratio_outcome,
        at_risk_label,
        tenure_months,
    ):
        df = step(df)
    return df


def consumption_lags(df: DataFrame) -> DataFrame:
    return calendar_lag(df, {k: v for k, v in HISTORY.items() if k.startswith("consumption_lag")})


def same_month_last_year(df: DataFrame) -> DataFrame:
    """Target month minus twelve is t-11."""
    return calendar_lag(df, {"same_month_last_year": HISTORY["same_month_last_year"]})


def recent_window_3(df: DataFrame) -> DataFrame:
    """Mean, sample deviation and trend over t, t-1, t-2; missing unless all three are there.

    Plain arithmetic, because an aggregate over a frame would skip the missing months.
    """
    months = [F.col("current_consumption"), F.col("consumption_lag1"), F.col("consumption_lag2")]
    mean = (months[0] + months[1] + months[2]) / 3
    squares = [(m - mean) * (m - mean) for m in months]
    return df.withColumns(
        {
            "recent_mean_3": mean,
            "recent_std_3": F.sqrt((squares[0] + squares[1] + squares[2]) / 2),
            "consumption_trend_3": months[0] - months[2],
        }
    )


def payment_history(df: DataFrame) -> DataFrame:
    """Earlier ratios as they stood at their own month end, and the complete mean of three."""
    df = calendar_lag(df, {k: v for k, v in HISTORY.items() if k.startswith("payment_ratio")})
    return _payment_mean(df)


def _payment_mean(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "payment_ratio_mean3",
        (F.col("payment_ratio_current") + F.col("payment_ratio_lag1") + F.col("payment_ratio_lag2_audit")) / 3,
    )


def arrears_trend(df: DataFrame) -> DataFrame:
    df = calendar_lag(df, {"arrears_lag1": HISTORY["arrears_lag1"]})
    return df.withColumn("arrears_trend", F.col("arrears_current") - F.col("arrears_lag1"))


def _strictly_earlier():
    return Window.partitionBy(KEY).orderBy(ORD).rowsBetween(Window.unboundedPreceding, -1)


def prior_stats(df: DataFrame) -> DataFrame:
    """Count, mean and sample deviation of all earlier valid months of the consumer."""
    value, earlier = F.col("current_consumption"), _strictly_earlier()
    return df.withColumns(
        {
            "prior_count": F.count(value).over(earlier),
            "prior_mean": F.avg(value).over(earlier),
            "prior_std": F.stddev_samp(value).over(earlier),
        }
    )


def rule_z(df: DataFrame, min_history: int = schema.ANOMALY_MIN_HISTORY) -> DataFrame:
    """Distance from the consumer's own past in deviations, when there is enough of a past."""
    eligible = (F.col("prior_count") >= min_history) & (F.col("prior_std") > 0)
    z = (F.col("current_consumption") - F.col("prior_mean")) / F.col("prior_std")
    return df.withColumn("rule_z_current", F.when(eligible & is_finite(F.col("prior_std")), finite(z)))


def anomaly_label(df: DataFrame, threshold: float = schema.ANOMALY_Z) -> DataFrame:
    return df.withColumn(
        "anomaly_current", (F.abs("rule_z_current") > F.lit(float(threshold))).cast("int")
    )


def next_targets(df: DataFrame) -> DataFrame:
    """The value and both labels of exactly the next month."""
    return calendar_lag(df, NEXT)


def history_columns(df: DataFrame) -> DataFrame:
    """All columns that look back: every window shares the keys and order of one sort."""
    value, earlier = F.col("current_consumption"), _strictly_earlier()
    df = df.withColumns(
        {
            **{out: exactly(col, k) for out, (col, k) in HISTORY.items()},
            "prior_count": F.count(value).over(earlier),
            "prior_mean": F.avg(value).over(earlier),
            "prior_std": F.stddev_samp(value).over(earlier),
        }
    )
    return derived_history(df)


def derived_history(df: DataFrame) -> DataFrame:
    """What follows from the lags of a row alone."""
    df = _payment_mean(recent_window_3(df))
    return df.withColumn("arrears_trend", F.col("arrears_current") - F.col("arrears_lag1"))


def build_features(panel: DataFrame) -> DataFrame:
    """Typed panel -> predictors, rule labels and targets, one row per supplied month."""
    return next_targets(anomaly_label(rule_z(history_columns(asof_columns(panel)))))


def prior_stats_check(df: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Recompute the prior statistics of every row another way and count differences.

    Running statistics that include the current month, taken from the row before: linear in the rows, and independent of the
    frame that excludes it. The values are taken from the consumer's mean. A month adds its distance from the mean before it times
    that from the mean after it to the centred squares: no term is negative, so nothing cancels where the earlier months are alike.
    """
    whole = Window.partitionBy(KEY)
    in_order = whole.orderBy(ORD)
    until_now = in_order.rowsBetween(Window.unboundedPreceding, 0)
    centred = df.withColumn("_c", F.coalesce(F.avg("current_consumption").over(whole), F.lit(0.0)))
    value = F.col("current_consumption") - F.col("_c")
    now = centred.withColumns({"_n_now": F.count(value).over(until_now), "_mean_now": F.avg(value).over(until_now)})
    before = now.withColumns({"_n": F.lag("_n_now", 1, 0).over(in_order), "_mean": F.lag("_mean_now").over(in_order)})
    squares = before.withColumn("_q_now", F.sum((value - F.col("_mean")) * (value - F.col("_mean_now"))).over(until_now))
    sums = squares.withColumn("_q", F.coalesce(F.lag("_q_now").over(in_order), F.lit(0.0)))
    n = F.col("_n")
    mean = F.when(n > 0, F.col("_mean") + F.col("_c"))
    std = F.when(n > 1, F.sqrt(F.try_divide(F.col("_q"), n - 1)))

    def differs(actual, expected):
        close = F.abs(F.col(actual) - expected) <= tolerance * (1 + F.abs(expected))
        return ~F.coalesce(close, F.col(actual).isNull() & expected.isNull())

    return sums.agg(
        F.count("*").alias("rows_checked"),
        F.count_if(F.col("prior_count") != n).alias("count_mismatches"),
        F.count_if(differs("prior_mean", mean)).alias("mean_mismatches"),
        F.count_if(differs("prior_std", std)).alias("std_mismatches"),
    )


def feature_rule_checks(df: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Violations of the construction rules over all rows: (check_name, rows_checked, violations)."""
    c = F.col

    def apart(actual, expected):
        close = F.abs(actual - expected) <= tolerance * (1 + F.abs(expected))
        return ~F.coalesce(close, actual.isNull() & expected.isNull())

    observed = flag(c("payment_date") <= c("month_end"))
    judged = flag((c("bill_amount") > 0) & c("due_date").isNotNull())
    unpaid = judged & flag(c("payment_blank") | (c("payment_date") > c("due_date")))
    first = c("_first_ord") == c(ORD)
    look_back = [c(x) for x in HISTORY if x != "payment_ratio_lag2_audit"]
    violations = {
        "cutoff_observation": c("payment_observed_by_cutoff") != observed,
        "unobserved_payment_hidden": ~observed
        & (c("payment_ratio_current").isNotNull() | c("payment_delay_current").isNotNull()),
        "ratio_recomputed": apart(
            c("payment_ratio_current"),
            F.when(observed & flag(c("bill_amount") > 0), F.try_divide(c("payment_amount"), c("bill_amount"))),
        ),
        "unpaid_by_due_is_zero": unpaid & ~flag((c("payment_ratio_outcome") == 0) & (c("at_risk_current") == 1)),
        "at_risk_threshold": ~c("at_risk_current").eqNullSafe(
            (c("payment_ratio_outcome") < F.lit(schema.AT_RISK_RATIO)).cast("int")
        ),
        "tenure_not_negative": flag(c("tenure_months") < 0),
        "first_month_has_no_history": first
        & (F.coalesce(*[x.cast("double") for x in look_back]).isNotNull() | (c("prior_count") != 0)),
        "complete_mean_3": apart(
            c("recent_mean_3"), (c("current_consumption") + c("consumption_lag1") + c("consumption_lag2")) / 3
        ),
        "trend_3": apart(c("consumption_trend_3"), c("current_consumption") - c("consumption_lag2")),
        "arrears_trend": apart(c("arrears_trend"), c("arrears_current") - c("arrears_lag1")),
        "anomaly_needs_history": flag((c("prior_count") < 3) | c("prior_std").isNull() | (c("prior_std") <= 0))
        & (c("rule_z_current").isNotNull() | c("anomaly_current").isNotNull()),
        "anomaly_threshold": ~c("anomaly_current").eqNullSafe(
            (F.abs("rule_z_current") > F.lit(schema.ANOMALY_Z)).cast("int")
        ),
    }
    row = df.withColumn("_first_ord", F.min(ORD).over(Window.partitionBy(KEY))).agg(
        F.count("*").alias("_rows"), *[F.count_if(bad).alias(name) for name, bad in violations.items()]
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check_name"),
                        c("_rows").alias("rows_checked"),
                        c(name).alias("violations"),
                    )
                    for name in violations
                ]
            )
        )
    )


def leakage_guard(columns: list[str], extra_forbidden: list[str] = ()) -> list[str]:
    """The predictors that must not be used: targets, identifiers and label-only columns."""
    forbidden = {KEY, *schema.TARGETS.values(), *schema.LABEL_ONLY, *extra_forbidden}
    return sorted(forbidden.intersection(columns))
