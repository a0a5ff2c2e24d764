"""Consumer-level association: contingency tables, gated chi-square, Pearson on means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.pvalues import chi_square_p, correlation_p
from meterflow.functions.reshape import long_form
from meterflow.operators.profile import consumer_means, pearson_r, skew_g1
from meterflow.operators.ranks import exact_quantiles
from meterflow.session import materialize


# --- contingency --------------------------------------------------------------------

#: Labels of one side that a row label meets at once when a table is filled with zeros.
FILL_BLOCK = 4096


def observed_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows per pair of categories that occurs; rows with a null in either are left out. Stored once."""
    known = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return materialize(known.groupBy(a, b).agg(F.count("*").alias("observed")), "pairs")


def filled_cells(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Every pair of a label of `a` and a label of `b`, zero where it does not occur.

    For output only, as it has all rows times all columns; the tests work on the pairs that occur.
    Labels of `b` are dealt into blocks, and each label of `a` meets block by block.
    """
    blocks = pairs.agg(F.greatest(F.ceil(F.count_distinct(b) / FILL_BLOCK), F.lit(1))).scalar()
    columns = pairs.select(b).distinct().withColumn("_block", F.pmod(F.xxhash64(b), blocks))
    rows = pairs.select(a).distinct().withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return rows.join(columns, "_block").join(pairs, [a, b], "left").select(
        a, b, F.coalesce("observed", F.lit(0)).alias("observed")
    )


def crosstab_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows per pair of categories, pairs that do not occur filled with zero."""
    return filled_cells(observed_pairs(df, a, b), a, b)


def expected_counts(cells: DataFrame, a: str, b: str) -> DataFrame:
    """Row total x column total / grand total for each cell."""
    total = cells.agg(F.sum("observed")).scalar()
    row_total = F.sum("observed").over(Window.partitionBy(a))
    column_total = F.sum("observed").over(Window.partitionBy(b))
    return cells.withColumn(
        "expected", row_total.cast("double") * column_total.cast("double") / total
    )


def _margin_facts(rows: DataFrame, columns: DataFrame, total: Column) -> DataFrame:
    """One row from the margins alone: labels of each side, least totals, cells expected below 5.

    A cell is below 5 where its column total is below 5 x total / row total. Equal totals are merged, and a
    running count of columns over the sorted totals is read at each row's limit. The window has no keys, but
    k different totals add up to k (k + 1) / 2 rows at least: 10^12 rows have fewer than 1.5 million of them.
    """
    limit = F.call_function("div", F.lit(5) * total + F.col("_row") - 1, F.col("_row"))
    merged_rows = rows.groupBy("_row").agg(F.count("*").alias("n_rows"))
    merged_columns = columns.groupBy("_column").agg(F.count("*").alias("n_columns"))
    none = F.lit(None).cast("long")
    at_limits = merged_rows.select(limit.alias("at"), "n_rows", F.lit(0).alias("n_columns"), "_row", none.alias("_column"))
    at_totals = merged_columns.select(F.col("_column").alias("at"), F.lit(0).alias("n_rows"), "n_columns", none.alias("_row"), "_column")
    steps = at_limits.unionByName(at_totals).groupBy("at").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_columns").alias("n_columns"),
        F.min("_row").alias("_row"), F.min("_column").alias("_column"),
    )
    before = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return steps.withColumn("_before", F.coalesce(F.sum("n_columns").over(before), F.lit(0))).agg(
        F.sum("n_rows").alias("n_a"),
        F.sum("n_columns").alias("n_b"),
        F.min("_row").alias("least_row"),
        F.min("_column").alias("least_column"),
        F.sum(F.col("n_rows") * F.col("_before")).alias("below_5"),
    )


def chi_square_test(cells: DataFrame, a: str, b: str) -> DataFrame:
    """Test of independence on a contingency table, without continuity correction.

    `cells` may leave out pairs that do not occur, and cells without rows are not read: a cell without rows
    adds its expected count to the statistic, and those of all such cells are the total less the expected
    counts of the others. So the work grows with the pairs that occur, not with rows times columns.

    Performed only on 2x2 or larger tables whose expected counts are at least 1 everywhere and
    below 5 in at most a fifth of the cells; else the row says skipped and has no statistic.
    """
    occurring = cells.filter("observed > 0")
    rows = occurring.groupBy(a).agg(F.sum("observed").alias("_row"))
    columns = occurring.groupBy(b).agg(F.sum("observed").alias("_column"))
    total = rows.agg(F.sum("_row")).scalar()
    facts = _margin_facts(rows, columns, total).select(F.struct("*")).scalar()
    expected = F.col("_row").cast("double") * F.col("_column").cast("double") / total
    deviation = F.col("observed") - F.col("_expected")
    sums = occurring.join(rows, a).join(columns, b).withColumn("_expected", expected).agg(
        F.coalesce(F.sum("observed"), F.lit(0)).alias("sample_size"),
        F.sum(deviation * deviation / F.col("_expected")).alias("_occurring"),
        F.sum("_expected").alias("_expected"),
    )
    row = sums.select(
        "*",
        facts.getField("n_a").alias("n_a"),
        facts.getField("n_b").alias("n_b"),
        F.try_divide(
            facts.getField("least_row").cast("double") * facts.getField("least_column").cast("double"), F.col("sample_size")
        ).alias("minimum_expected"),
        F.try_divide(
            F.lit(100.0) * facts.getField("below_5"), facts.getField("n_a") * facts.getField("n_b")
        ).alias("percent_expected_below_5"),
    )
    shaped = (F.col("n_a") >= 2) & (F.col("n_b") >= 2)
    suitable = shaped & (F.col("minimum_expected") >= 1) & (F.col("percent_expected_below_5") <= 20)
    statistic = F.col("_occurring") + F.col("sample_size") - F.col("_expected")
    return row.select(
        "sample_size",
        "minimum_expected",
        "percent_expected_below_5",
        F.when(shaped, (F.col("n_a") - 1) * (F.col("n_b") - 1)).cast("int").alias("degrees_of_freedom"),
        F.when(suitable, F.greatest(statistic, F.lit(0.0))).alias("statistic"),
        F.when(suitable, "performed").otherwise("skipped").alias("status"),
    ).withColumn("p_value", chi_square_p("statistic", F.col("degrees_of_freedom").cast("double")))


def stable_consumers(
    df: DataFrame, allowed: Mapping[str, Sequence[str] | None], key: str = "consumer_no"
) -> DataFrame:
    """Per consumer: each category's value, whether it ever changes, and whether all are allowed.

    A missing value counts as a value of its own. `None` allows every value that is present.
    """
    aggregates: list[Column] = []
    for c, values in allowed.items():
        valid = F.col(c).isin(list(values)) if values is not None else F.col(c).isNotNull()
        aggregates += [
            F.min(c).alias(c),
            ((F.min(c) != F.max(c)) | ((F.count(c) > 0) & (F.count(c) < F.count("*")))).alias(f"_chg_{c}"),
            F.bool_and(F.coalesce(valid, F.lit(False))).alias(f"_ok_{c}"),
        ]
    changed = {c: F.coalesce(F.col(f"_chg_{c}"), F.lit(False)) for c in allowed}
    consumers = df.groupBy(key).agg(*aggregates)
    all_valid, any_change = F.lit(True), F.lit(False)
    for c in allowed:
        all_valid, any_change = all_valid & F.col(f"_ok_{c}"), any_change | changed[c]
    return consumers.select(
        key,
        *allowed,
        *[flag.alias(f"changing_{c}") for c, flag in changed.items()],
        (~all_valid).alias("invalid"),
        (all_valid & ~any_change).alias("included"),
    )


def stability_summary(consumers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: consumers, exclusions by reason and consumers kept."""
    return consumers.agg(
        F.count("*").alias("total_consumers"),
        *[F.count_if(F.col(f"changing_{c}")).alias(f"changing_{c}") for c in columns],
        F.count_if("invalid").alias("invalid_category_consumers"),
        F.count_if(~F.col("included")).alias("excluded_union"),
        F.count_if("included").alias("included_consumers"),
    )


def stable_chi_square(
    train: DataFrame, feature: str, label: str, allowed: Sequence[str] | None, key: str = "consumer_no"
) -> tuple[DataFrame, DataFrame]:
    """(test row, contingency cells) over consumers whose feature and label never change."""
    typed = train.select(key, F.col(feature).cast("string").alias(feature), F.col(label).cast("string").alias(label))
    consumers = stable_consumers(typed, {feature: allowed, label: None}, key)
    pairs = observed_pairs(consumers.filter("included"), feature, label)
    summary = stability_summary(consumers, [feature, label]).select(
        F.struct("excluded_union", f"changing_{feature}", f"changing_{label}", "invalid_category_consumers")
    ).scalar()
    test = chi_square_test(pairs, feature, label).withColumns(
        {
            "feature": F.lit(feature),
            "excluded_consumers": summary.getField("excluded_union"),
            "changing_feature_consumers": summary.getField(f"changing_{feature}"),
            "changing_target_consumers": summary.getField(f"changing_{label}"),
            "invalid_category_consumers": summary.getField("invalid_category_consumers"),
        }
    )
    return test, expected_counts(filled_cells(pairs, feature, label), feature, label)


# --- correlation of consumer means ---------------------------------------------------

def _pearson_columns(x: str, y: str) -> list[Column]:
    varied = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y)) & (F.count("*") >= 3)
    return [
        F.count("*").alias("sample_size"),
        F.when(varied, pearson_r(x, y)).alias("r"),
        F.when(varied, (F.count("*") - 2)).cast("int").alias("degrees_of_freedom"),
        F.when(varied, "performed").otherwise("skipped").alias("status"),
    ]


def _with_test(row: DataFrame) -> DataFrame:
    r, dof = F.col("r"), F.col("degrees_of_freedom").cast("double")
    return row.withColumns(
        {
            "t_statistic": F.try_divide(r * F.sqrt(dof), F.sqrt(F.lit(1.0) - r * r)),
            "direction": F.when(r > 0, "positive").when(r < 0, "negative").when(r == 0, "zero"),
            "p_value": correlation_p("r", dof),
        }
    )


def pearson_test(df: DataFrame, x: str, y: str, key: str = "consumer_no") -> DataFrame:
    """Two-sided test on one mean per consumer; skipped without three varied consumers."""
    means = consumer_means(df, [x, y], key).dropna(subset=[x, y])
    return _with_test(means.agg(*_pearson_columns(x, y)))


def paired_mean_relevance(
    train: DataFrame, features: Sequence[str], target: str, key: str = "consumer_no"
) -> DataFrame:
    """The test for every predictor at once, over the rows complete in predictor and target."""
    y = F.col(target).cast("double")

    def pair(feature: str) -> Column:
        x = F.col(feature).cast("double")
        both = x.isNotNull() & y.isNotNull()
        return F.struct(
            F.count_if(both).alias("n"), F.avg(F.when(both, x)).alias("x"), F.avg(F.when(both, y)).alias("y")
        ).alias(feature)

    # One wide aggregate per consumer; only its rows are turned into one row per predictor.
    consumers = train.groupBy(key).agg(*[pair(f) for f in features])
    means = long_form(consumers, features, "feature", "_pair").select(
        "feature", F.col("_pair.n").alias("_rows"), F.col("_pair.x").alias("_x"), F.col("_pair.y").alias("_y")
    )
    present = means.filter("_rows > 0")
    tested = present.groupBy("feature").agg(
        F.sum("_rows").alias("paired_rows"),
        *_pearson_columns("_x", "_y"),
        skew_g1("_x").alias("predictor_skew"),
        skew_g1("_y").alias("target_skew"),
    )
    total = train.agg(F.count_distinct(key)).scalar()
    return _with_test(tested).withColumn("excluded_consumers", total - F.col("sample_size"))


# --- distributions by category or class ----------------------------------------------

def _grouped(cells: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    stats = cells.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")
    )
    return stats.join(exact_quantiles(cells, by, value, {"median": 0.5}), list(by), "left")


def category_target_stats(train: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Target distribution per category of each predictor; blanks are a category."""
    rows = train.select(
        F.col(target).cast("double").alias("_y"),
        *[
            F.when(F.col(f).isNull() | (F.col(f).cast("string") == ""), "[missing]")
            .otherwise(F.col(f).cast("string"))
            .alias(f)
            for f in features
        ],
    )
    return _grouped(long_form(rows, features, "feature", "category", ["_y"]), ["feature", "category"], "_y")


def class_feature_stats(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Distribution of each numeric predictor per class, missing predictors left out."""
    rows = train.filter(F.col(label).isNotNull()).select(
        F.col(label).cast("int").alias("class"), *[F.col(f).cast("double").alias(f) for f in features]
    )
    cells = long_form(rows, features, "feature", "_x", ["class"]).dropna(subset=["_x"])
    return _grouped(cells, ["feature", "class"], "_x")


def four_digits(value: Column) -> Column:
    """Four significant digits as text: 0.9996, 12.5, 1.235e+06."""
    size = F.abs(value)
    power = F.floor(F.log10(size))
    power = F.when(F.round(size / F.pow(F.lit(10.0), power), 3) >= 10, power + 1).otherwise(power)

    def trimmed(text: Column) -> Column:
        return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)

    plain = F.when(power == -4, F.format_string("%.7f", F.bround(value, 7)))
    for p in range(-3, 4):
        plain = plain.when(power == p, F.format_string(f"%.{3 - p}f", F.bround(value, 3 - p)))
    mantissa = trimmed(F.format_string("%.3f", F.bround(value / F.pow(F.lit(10.0), power), 3)))
    exponent = F.concat(
        F.when(power < 0, "e-").otherwise("e+"), F.format_string("%02d", F.abs(power))
    )
    return F.when(size == 0, "0").when(
        (power >= -4) & (power < 4), trimmed(plain)
    ).otherwise(F.concat(mantissa, exponent))


def relevance_evidence(results: DataFrame) -> DataFrame:
    """One text per (module, feature) from (module, feature, group, kind, n, value, second) rows.

    kind is 'test', 'skipped' or 'descriptive'. A feature has at most its categories as rows.
    """
    n = F.col("n").cast("string")
    line = (
        F.when(
            F.col("kind") == "test",
            F.concat(F.lit("Test: n="), n, F.lit(", statistic="), four_digits(F.col("value")), F.lit(", p="), four_digits(F.col("second")), F.lit(".")),
        )
        .when(F.col("kind") == "skipped", F.concat(F.lit("Skipped: n="), n, F.lit(".")))
        .otherwise(
            F.concat(
                F.lit("Descriptive "), F.col("group"), F.lit(": n="), n, F.lit(", mean="),
                four_digits(F.col("value")), F.lit(", median="), four_digits(F.col("second")), F.lit("."),
            )
        )
    )
    listed = F.sort_array(F.collect_list(F.struct("group", line.alias("line"))))
    return results.groupBy("module", "feature").agg(
        F.array_join(F.transform(listed, lambda x: x["line"]), " ").alias("statistical_evidence")
    )
