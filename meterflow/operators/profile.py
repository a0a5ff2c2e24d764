"""Descriptive statistics of a panel: moments, quantiles, bins and group summaries."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.reshape import long_form, one_row_to_long
from meterflow.functions.scalars import is_finite, month_number
from meterflow.operators.ranks import exact_quantiles
from meterflow.session import materialize

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def skew_g1(value: str) -> Column:
    """Bias-corrected skewness; missing below three values."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis_g2(value: str) -> Column:
    """Bias-corrected excess kurtosis; missing below four values."""
    n = F.count(value).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6))


def pearson_r(x: Column | str, y: Column | str) -> Column:
    """Coefficient over complete pairs, NULL where one side is constant (`corr` fails there)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def _cells(df: DataFrame, columns: Sequence[str], finite_only: bool = False) -> DataFrame:
    cells = long_form(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns, "variable", "value")
    return cells.filter(is_finite(F.col("value")) if finite_only else F.col("value").isNotNull())


def monthly_summary(df: DataFrame, ord: str = "ord") -> DataFrame:
    """Consumers and totals per period; a period of missing values totals zero."""
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0.0))

    return df.groupBy(ord).agg(
        F.count_distinct("consumer_no").alias("unique_consumers"),
        total("consumption_unit").alias("total_consumption"),
        F.avg("consumption_unit").alias("average_consumption"),
        total("bill_amount").alias("total_bills"),
        total("payment_amount").alias("total_payments"),
        total("closing_arrears").alias("total_closing_arrears"),
    )


def descriptive_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments and exact quartiles of each column, one row per column."""
    cells = _cells(df, columns)
    moments = cells.groupBy("variable").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"),
        F.min("value").alias("minimum"),
        F.max("value").alias("maximum"),
        skew_g1("value").alias("skewness"),
        kurtosis_g2("value").alias("kurtosis"),
    )
    quartiles = exact_quantiles(cells, ["variable"], "value", QUARTILES)
    return moments.join(quartiles, "variable").withColumn("iqr", F.col("q3") - F.col("q1"))


def finite_describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of the finite values."""
    cells = _cells(df, columns, finite_only=True)
    moments = cells.groupBy("variable").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"),
        F.min("value").alias("minimum"),
        F.max("value").alias("maximum"),
    )
    return moments.join(exact_quantiles(cells, ["variable"], "value", QUARTILES), "variable")


def iqr_outliers(df: DataFrame, columns: Sequence[str], k: float = 1.5, quartiles: DataFrame | None = None) -> DataFrame:
    """Fences at k interquartile ranges and the finite values beyond them; rows stay.

    The quartiles, one row per column, come to the driver and return as constants of one
    aggregate, so that the rows need no join. Known `quartiles` (variable, q1, q3) are not computed again.
    """
    if quartiles is None:
        quartiles = exact_quantiles(_cells(df, columns, finite_only=True), ["variable"], "value", QUARTILES)
    found = {row.variable: row for row in quartiles.collect()}
    entries, counts = {}, []
    for c in columns:
        value, row = F.col(c), found.get(c)
        counts.append(F.count_if(is_finite(value)).alias(f"_n_{c}"))
        if row is None:
            entries[c] = dict.fromkeys(("iqr", "iqr_lower", "iqr_upper"), F.lit(None).cast("double"))
            counts.append(F.lit(0).cast("bigint").alias(f"_out_{c}"))
        else:
            spread = row.q3 - row.q1
            low, high = row.q1 - k * spread, row.q3 + k * spread
            entries[c] = {"iqr": F.lit(spread), "iqr_lower": F.lit(low), "iqr_upper": F.lit(high)}
            counts.append(F.count_if(is_finite(value) & ~value.between(low, high)).alias(f"_out_{c}"))
        entries[c] |= {"n": F.col(f"_n_{c}"), "potential_outliers": F.col(f"_out_{c}")}
    return one_row_to_long(df.agg(*counts), "variable", entries)


def category_frequency(df: DataFrame, columns: Sequence[str], n: int | None = None) -> DataFrame:
    """Rows and share of each category; optionally the n largest per column."""
    total = df.agg(F.count("*")).scalar()
    cells = long_form(df, columns, "variable", "category")
    named = F.when(F.col("category").isNull() | (F.col("category") == ""), "[missing]").otherwise(F.col("category"))
    counts = cells.groupBy("variable", named.alias("category")).agg(F.count("*").alias("n_rows"))
    if n is not None:
        rank = F.row_number().over(
            Window.partitionBy("variable").orderBy(F.col("n_rows").desc(), "category")
        )
        counts = counts.withColumn("position", rank).filter(F.col("position") <= n)
    return counts.withColumn("percent", F.lit(100.0) * F.col("n_rows") / total)


def top_n(df: DataFrame, by: str, n: int = 15) -> DataFrame:
    """The n most frequent values of a column."""
    counts = df.groupBy(by).agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.col("n_rows").desc(), by).limit(n)


def group_stats(df: DataFrame, by: str, column: str) -> DataFrame:
    """Distribution of a measure per category, with the category's share of all rows."""
    total = df.agg(F.count("*")).scalar()
    present = df.filter(F.col(by).isNotNull())
    stats = present.groupBy(by).agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("sd"),
        F.min(column).alias("minimum"),
        F.max(column).alias("maximum"),
    )
    medians = exact_quantiles(present, [by], column, {"median": 0.5})
    return stats.join(medians, by, "left").withColumn("percent_of_rows", F.lit(100.0) * F.col("n") / total)


def calendar_month_profile(df: DataFrame, column: str, ord: str = "ord") -> DataFrame:
    """Count, mean and exact median by month of the year, years pooled."""
    months = df.withColumn("calendar_month", month_number(F.col(ord)))
    stats = months.groupBy("calendar_month").agg(F.count(column).alias("n"), F.avg(column).alias("mean"))
    return stats.join(exact_quantiles(months, ["calendar_month"], column, {"median": 0.5}), "calendar_month", "left")


def consumer_means(df: DataFrame, columns: Sequence[str], key: str = "consumer_no") -> DataFrame:
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in columns])


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson coefficients over the complete rows of each pair, long and symmetric. One pass."""
    def complete(a, b):
        return F.col(a).isNotNull() & F.col(b).isNotNull()

    pairs = list(combinations(columns, 2))
    row = df.agg(
        *[
            F.struct(
                pearson_r(F.when(complete(a, b), F.col(a)), F.when(complete(a, b), F.col(b))).alias("r"),
                F.count_if(complete(a, b)).alias("n"),
            ).alias(f"_p_{a}__{b}")
            for a, b in pairs
        ],
        *[
            F.struct(
                F.when(F.min(c) < F.max(c), F.lit(1.0)).alias("r"), F.count(c).alias("n")
            ).alias(f"_p_{c}__{c}")
            for c in columns
        ],
    )
    entries = [(a, b, f"_p_{a}__{b}") for a, b in pairs]
    entries += [(b, a, p) for a, b, p in entries] + [(c, c, f"_p_{c}__{c}") for c in columns]
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("feature_1"),
                        F.lit(b).alias("feature_2"),
                        F.col(f"{p}.r").alias("correlation"),
                        F.col(f"{p}.n").alias("complete_rows"),
                    )
                    for a, b, p in entries
                ]
            )
        )
    )


def collinearity_audit(df: DataFrame, columns: Sequence[str], threshold: float = 0.90) -> DataFrame:
    """Pairs whose correlation reaches the threshold in size."""
    listed = {c: i for i, c in enumerate(columns)}
    order = F.create_map(*[x for c, i in listed.items() for x in (F.lit(c), F.lit(i))])
    return correlation_matrix(df, columns).filter(
        (order[F.col("feature_1")] < order[F.col("feature_2")])
        & (F.abs("correlation") >= F.lit(float(threshold)))
    )


def exact_relation_check(df: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Complete rows on which the mean and trend of three months do not hold."""
    a, b, c = (F.col(x) for x in ("current_consumption", "consumption_lag1", "consumption_lag2"))
    mean, trend = F.col("recent_mean_3"), F.col("consumption_trend_3")
    complete = a.isNotNull() & b.isNotNull() & c.isNotNull() & mean.isNotNull() & trend.isNotNull()
    return df.agg(
        F.count_if(complete).alias("complete_rows"),
        F.count_if(complete & (F.abs(mean - (a + b + c) / 3) > tolerance * (1 + F.abs(mean)))).alias("mean_violations"),
        F.count_if(complete & (F.abs(trend - (a - c)) > tolerance * (1 + F.abs(trend)))).alias("trend_violations"),
    )


def _equal_width(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Zero-based bin of equal width; the top edge belongs to the last bin."""
    step = (high - low) / bins
    i = F.least(F.floor(F.try_divide(value - low, step)), F.lit(bins - 1))
    i = F.when(value < low + i * step, i - 1).when(
        (value >= low + (i + 1) * step) & (i < bins - 1), i + 1
    ).otherwise(i)
    return F.coalesce(i, F.lit(0)).cast("int")


def histogram_bins(df: DataFrame, column: str, bins: int = 60) -> DataFrame:
    """Counts of all values in equal-width bins, empty bins included."""
    values = df.filter(F.col(column).isNotNull())
    span = values.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).select(F.struct("lo", "hi")).scalar()
    low, high = span.getField("lo"), span.getField("hi")
    counts = values.groupBy(_equal_width(F.col(column), low, high, bins).alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    step = (high - low) / bins
    return every.join(counts, "bin", "left").select(
        "bin",
        (low + F.col("bin") * step).alias("lower_edge"),
        (low + (F.col("bin") + 1) * step).alias("upper_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def grid_density(df: DataFrame, x: str, y: str, n: int = 45) -> DataFrame:
    """Complete pairs counted on an n by n grid; empty cells are left out."""
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    span = pairs.agg(
        F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")
    ).select(F.struct("x0", "x1", "y0", "y1")).scalar()
    return pairs.groupBy(
        _equal_width(F.col(x), span.getField("x0"), span.getField("x1"), n).alias("x_bin"),
        _equal_width(F.col(y), span.getField("y0"), span.getField("y1"), n).alias("y_bin"),
    ).agg(F.count("*").alias("n"))


def box_summary(df: DataFrame, column: str, by: str, k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers clamped to the data and values beyond them, per category.

    The quartiles are stored first: their real size then decides whether they are broadcast to
    the values or joined by key with the skew handling of the runtime planner.
    """
    values = df.filter(F.col(by).isNotNull() & F.col(column).isNotNull()).select(by, F.col(column).alias("_v"))
    quartiles = materialize(exact_quantiles(values, [by], "_v", QUARTILES), "quartiles")
    v, spread = F.col("_v"), F.lit(float(k)) * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - spread, F.col("q3") + spread
    return (
        values.join(quartiles, by)
        .groupBy(by, *QUARTILES)
        .agg(
            F.count("*").alias("n"),
            F.min(F.when(v >= low, v)).alias("_lo"),
            F.max(F.when(v <= high, v)).alias("_hi"),
            F.count_if((v < low) | (v > high)).alias("fliers"),
        )
        .select(
            by, "n", *QUARTILES,
            F.least("_lo", "q1").alias("whisker_low"),
            F.greatest("_hi", "q3").alias("whisker_high"),
            "fliers",
        )
    )


def eda_findings(df: DataFrame, by: str = "tarrif") -> DataFrame:
    """Extremes by month and category, and counts of notable rows, as one row.

    The panel is read once: sums and counts by month of the year and category are stored, all else comes from them.
    """
    consumption, arrears = F.col("consumption_unit"), F.col("closing_arrears")
    cube = materialize(
        df.groupBy(month_number(F.col("ord")).alias("month"), F.col(by).alias("category")).agg(
            F.sum(consumption.cast("double")).alias("used"),
            F.count(consumption).alias("n_used"),
            F.sum(arrears.cast("double")).alias("arrears"),
            F.count(arrears).alias("n_arrears"),
            F.max(arrears).alias("max_arrears"),
            F.count_if(consumption == 0).alias("zero"),
            F.count_if(F.col("bill_amount") <= 0).alias("nonpositive"),
            F.count_if(F.col("payment_amount") > F.col("bill_amount")).alias("above"),
        ),
        "findings",
    )

    def extreme(name: str) -> Column:
        groups = cube.groupBy(name).agg(F.try_divide(F.sum("used"), F.sum("n_used")).alias("mean"))
        picked = groups.agg(
            F.min(F.struct(-F.col("mean"), F.col(name))).getField(name).alias("highest"),
            F.min(F.struct(F.col("mean"), F.col(name))).getField(name).alias("lowest"),
        )
        return picked.select(F.struct("highest", "lowest")).scalar()

    month, group = extreme("month"), extreme("category")
    return cube.agg(
        F.coalesce(F.sum("zero"), F.lit(0)).alias("zero_consumption_rows"),
        F.coalesce(F.sum("nonpositive"), F.lit(0)).alias("nonpositive_bills"),
        F.coalesce(F.sum("above"), F.lit(0)).alias("payments_above_bills"),
        F.try_divide(F.sum("arrears"), F.sum("n_arrears")).alias("mean_arrears"),
        F.max("max_arrears").alias("max_arrears"),
    ).withColumns(
        {
            "highest_month": month.getField("highest"),
            "lowest_month": month.getField("lowest"),
            "highest_group": group.getField("highest"),
            "lowest_group": group.getField("lowest"),
        }
    )
