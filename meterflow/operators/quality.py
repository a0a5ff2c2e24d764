"""Cleaning checks: they count and flag, and never change or drop a record on their own."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow import schema
from meterflow.functions.reshape import long_form, one_row_to_long
from meterflow.functions.scalars import (
    flag,
    is_blank,
    is_finite,
    month_ordinal,
    period_ordinal,
    stripped,
    to_day,
    to_number,
)
from meterflow.operators.profile import category_frequency, finite_describe, iqr_outliers
from meterflow.session import materialize

AUDIT_COLUMNS = ["section", "column_name", "finding", "n", "denominator", "value", "measure"]


# --- duplicates ---------------------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Members of repeated keys, counted per `by` (part of the key).

    Two aggregates with map-side combine: a key that holds a third of the rows is one
    partial count per task.
    """
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.groupBy(*by).agg(
        F.count("*").alias("repeated_keys"), F.sum("n").alias("member_rows")
    )


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of records that agree in every column."""
    return df.dropDuplicates()


def conflicting_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every variant of a key with more than one distinct record, and how often it occurs.

    Exact copies are merged before the keys are compared, so copies never travel.
    """
    variants = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    conflicted = variants.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys)
    return variants.join(conflicted, list(keys), "left_semi")


# --- missing and disguised values ---------------------------------------------------

def missing_profile(df: DataFrame, numeric: Sequence[str] = (), days: Sequence[str] = ()) -> DataFrame:
    """Per text column: conventional missing, blank, and missing once typed. One pass."""
    def typed(c: str) -> Column:
        if c in numeric:
            return to_number(F.col(c))
        return to_day(F.col(c)) if c in days else F.col(c)

    row = df.agg(
        F.count("*").alias("_rows"),
        *[
            F.struct(
                F.count_if(F.col(c).isNull() | F.col(c).isin(schema.CONVENTIONAL_NA)).alias("na"),
                F.count_if(is_blank(F.col(c))).alias("blank"),
                F.count_if(typed(c).isNull()).alias("typed"),
            ).alias(f"_p_{c}")
            for c in df.columns
        ],
    )
    share = F.lit(100.0) / F.col("_rows")
    return one_row_to_long(
        row,
        "column_name",
        {
            c: {
                "n_rows": F.col("_rows"),
                "conventional_missing": F.col(f"_p_{c}.na"),
                "conventional_percent": F.col(f"_p_{c}.na") * share,
                "blank_rows": F.col(f"_p_{c}.blank"),
                "typed_missing": F.col(f"_p_{c}.typed"),
            }
            for c in df.columns
        },
    )


def disguised_missing(df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = tuple(schema.MISSING_TOKENS)) -> DataFrame:
    """Candidate stand-ins for a missing value per column and original value. Reported only.

    Candidates are filtered before the shuffle, so identifiers never reach it.
    """
    cells = long_form(df, columns, "column_name", "original_value")
    norm = F.upper(stripped(F.col("original_value")))
    other = norm.rlike(r"^[?\-.*_]+$") | reduce(
        Column.__or__, [norm.startswith(p) for p in schema.MISSING_PREFIXES]
    )
    label = (
        F.when(norm == "", "[blank/whitespace]")
        .when(norm.isin(list(tokens)), norm)
        .otherwise("[other candidate]")
    )
    return (
        cells.filter(norm.isin(list(tokens)) | other)
        .groupBy("column_name", "original_value", label.alias("label"))
        .agg(F.count("*").alias("n"))
    )


def artifact_profile(df: DataFrame, column: str) -> DataFrame:
    """Content of a column that should be empty."""
    blank = is_blank(F.col(column))
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(blank).alias("blank_rows"),
        F.count_if(~blank).alias("nonblank_rows"),
        F.count_distinct(F.when(~blank, F.col(column))).alias("distinct_nonblank"),
    ).withColumn("droppable", F.col("nonblank_rows") == 0)


def drop_empty_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop those of `columns` that hold nothing but blanks (runs one job)."""
    filled = df.agg(*[F.count_if(~is_blank(F.col(c))).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if filled[c] == 0])


# --- typing -------------------------------------------------------------------------

def conversion_counts(df: DataFrame, numeric: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Per column to be typed: filled values, blanks, and filled values that fail."""
    parsed = {**{c: to_number(F.col(c)) for c in numeric}, **{c: to_day(F.col(c)) for c in days}}
    row = df.agg(
        F.count("*").alias("_rows"),
        *[
            F.struct(
                F.count_if(is_blank(F.col(c))).alias("blank"),
                F.count_if(~is_blank(F.col(c)) & v.isNull()).alias("failed"),
            ).alias(f"_p_{c}")
            for c, v in parsed.items()
        ],
    )
    return one_row_to_long(
        row,
        "column_name",
        {
            c: {
                "values_before": F.col("_rows"),
                "nonblank_before": F.col("_rows") - F.col(f"_p_{c}.blank"),
                "blank_to_missing": F.col(f"_p_{c}.blank"),
                "failures": F.col(f"_p_{c}.failed"),
            }
            for c in parsed
        },
    )


def conversion_failures(df: DataFrame, row_id: Sequence[str], numeric: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Filled values that do not parse: (row id..., column, original value)."""
    cells = long_form(df, [*numeric, *days], "column_name", "original_value", row_id)
    value = F.col("original_value")
    number = F.col("column_name").isin(list(numeric))
    failed = F.when(number, to_number(value).isNull()).otherwise(to_day(value).isNull())
    return cells.filter(~is_blank(value) & failed)


def typed_columns(df: DataFrame, numeric: Sequence[str], days: Sequence[str]) -> DataFrame:
    """The table with named text columns as numbers and dates; the rest stays text."""
    return df.withColumns(
        {**{c: to_number(F.col(c)) for c in numeric}, **{c: to_day(F.col(c)) for c in days}}
    )


# --- logical checks -----------------------------------------------------------------

def count_flags(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """(finding, n, denominator) for any number of conditions in one pass."""
    row = df.agg(F.count("*").alias("_rows"), *[F.count_if(f).alias(name) for name, f in flags.items()])
    return one_row_to_long(
        row,
        "finding",
        {name: {"n": F.col(name), "denominator": F.col("_rows")} for name in flags},
    )


def period_domain(df: DataFrame, year_from: int, year_to: int, period: str = "period", month: str = "month", year: str = "year") -> DataFrame:
    """PERIOD, MONTH and YEAR: malformed, out of range, or in disagreement."""
    ordinal = period_ordinal(F.col(period))
    m, y = F.col(month), F.col(year)

    def outside(c, lo, hi):
        return ~flag(c.between(lo, hi) & (F.pmod(c, F.lit(1.0)) == 0))

    return count_flags(
        df,
        {
            "invalid_or_missing_period": ordinal.isNull(),
            "invalid_month": outside(m, 1, 12),
            "invalid_year": outside(y, year_from, year_to),
            "month_period_mismatch": m != F.pmod(ordinal, F.lit(12)) + 1,
            "year_period_mismatch": y != F.floor(ordinal / 12),
        },
    )


def before_connection(df: DataFrame, ord: str = "ord", connection: str = "connection_date") -> DataFrame:
    """Rows dated before the month their consumer was connected."""
    return count_flags(
        df, {"record_before_connection_month": F.col(ord) < month_ordinal(F.col(connection))}
    )


def sign_checks(df: DataFrame, numeric: Sequence[str], nonnegative: Sequence[str]) -> DataFrame:
    """Non-finite and negative values; a negative amount is reviewed apart from a quantity."""
    row = df.agg(
        F.count("*").alias("_rows"),
        *[
            F.struct(
                F.count_if(~is_finite(F.col(c))).alias("odd"), F.count_if(F.col(c) < 0).alias("neg")
            ).alias(f"_p_{c}")
            for c in numeric
        ],
    )
    return one_row_to_long(
        row,
        "column_name",
        {
            c: {
                "kind": F.lit("quantity" if c in nonnegative else "amount"),
                "nonfinite": F.col(f"_p_{c}.odd"),
                "negative": F.col(f"_p_{c}.neg"),
                "denominator": F.col("_rows"),
            }
            for c in numeric
        },
    )


def zero_conditions() -> dict[str, Column]:
    return {
        "nonpositive_bill": F.col("bill_amount") <= 0,
        "zero_consumption": F.col("consumption_unit") == 0,
        "zero_contract_load": F.col("contract_load") == 0,
    }


def date_order_conditions(pairs: Sequence[tuple[str, str]]) -> dict[str, Column]:
    return {f"{later}_before_{earlier}": F.col(later) < F.col(earlier) for later, earlier in pairs}


def billing_conditions() -> dict[str, Column]:
    """How zero use, bills and payments occur together."""
    use, bill, paid = F.col("consumption_unit"), F.col("bill_amount"), F.col("payment_amount")
    return {
        "zero_consumption_with_positive_bill": (use == 0) & (bill > 0),
        "zero_consumption_with_nonpositive_bill": (use == 0) & (bill <= 0),
        "nonpositive_bill_with_positive_consumption": (bill <= 0) & (use > 0),
        "nonpositive_bill_with_payment": (bill <= 0) & (paid > 0),
        "negative_bill": bill < 0,
        "zero_bill": bill == 0,
    }


def zero_flags(df: DataFrame) -> DataFrame:
    return count_flags(df, zero_conditions())


def date_order_checks(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(later, earlier) pairs whose later date comes first."""
    return count_flags(df, date_order_conditions(pairs))


def billing_context(df: DataFrame) -> DataFrame:
    return count_flags(df, billing_conditions())


def logical_flags(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Zero, context and date-order findings together, from one pass over the panel."""
    return count_flags(df, {**zero_conditions(), **billing_conditions(), **date_order_conditions(pairs)})


def review_rows(df: DataFrame, nonnegative: Sequence[str], bill_date: str = "bill_date", connection: str = "connection_date") -> DataFrame:
    """Rows with a negative physical quantity or a bill dated before the connection."""
    wrong = [F.col(c) < 0 for c in nonnegative] + [F.col(bill_date) < F.col(connection)]
    return df.filter(reduce(Column.__or__, [flag(w) for w in wrong]))


def category_collisions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spellings that become equal after trimming and upper-casing."""
    spellings = long_form(df, columns, "column_name", "spelling").distinct()
    return (
        spellings.groupBy("column_name", F.upper(stripped(F.col("spelling"))).alias("normal"))
        .agg(
            F.count("*").alias("n_spellings"),
            F.min("spelling").alias("first_spelling"),
            F.max("spelling").alias("last_spelling"),
        )
        .filter("n_spellings > 1")
    )


def panel_shape(df: DataFrame, key: str = "consumer_no", ord: str = "ord") -> DataFrame:
    """Rows, columns by kind, distinct consumers and the observed span."""
    kinds = [t for _, t in df.dtypes]
    numeric = sum(t.startswith(("int", "bigint", "double", "float", "decimal", "smallint")) for t in kinds)
    return df.agg(
        F.count("*").alias("total_rows"),
        F.lit(len(kinds)).alias("total_columns"),
        F.lit(numeric).alias("numeric_columns"),
        F.lit(kinds.count("date")).alias("date_columns"),
        F.lit(kinds.count("string")).alias("text_columns"),
        F.count_distinct(key).alias("unique_consumers"),
        F.min(ord).alias("first_ord"),
        F.max(ord).alias("last_ord"),
        F.count_distinct(ord).alias("total_periods"),
    )


# --- audit --------------------------------------------------------------------------

def audit_part(
    df: DataFrame, section: str, column: Column | str | None = None, value: Column | None = None, measure: Column | None = None
) -> DataFrame:
    """A (finding, n, denominator) result as rows of the long audit table."""
    name = F.lit(column) if isinstance(column, str) or column is None else column
    return df.select(
        F.lit(section).alias("section"),
        F.coalesce(name, F.lit("")).alias("column_name"),
        F.col("finding"),
        F.col("n").cast("bigint").alias("n"),
        F.col("denominator").cast("bigint").alias("denominator"),
        (value if value is not None else F.lit("")).alias("value"),
        (measure if measure is not None else F.lit(None)).cast("double").alias("measure"),
    )


def _by_finding(df: DataFrame, column: str, counts: dict[str, str], denominator: str) -> DataFrame:
    """A row for each count of a wide result."""
    entries = [F.struct(F.lit(k).alias("finding"), F.col(v).cast("bigint").alias("n")) for k, v in counts.items()]
    return df.select(F.col(column).alias("column_name"), F.col(denominator).alias("denominator"), F.inline(F.array(*entries)))


def missing_section(df: DataFrame, numeric: Sequence[str] = (), days: Sequence[str] = ()) -> DataFrame:
    """Missing before and after typing, for every column of text."""
    counts = {"standard_missing": "conventional_missing", "literal_blank": "blank_rows", "missing_after_typing": "typed_missing"}
    return audit_part(_by_finding(missing_profile(df, numeric, days), "column_name", counts, "n_rows"), "missing", F.col("column_name"))


def disguised_section(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stand-ins for a missing value, a row for each label; original values stay out of the table."""
    total = df.agg(F.count("*")).scalar()
    found = disguised_missing(df, columns).groupBy("column_name", F.col("label").alias("finding")).agg(F.sum("n").alias("n"))
    return audit_part(found.withColumn("denominator", total), "disguised_missing", F.col("column_name"))


def category_section(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of each category, how many there are, missing rows and spellings that differ by case or white space alone.

    The frequencies are stored, the rest is counted from them.
    """
    total = df.agg(F.count("*")).scalar()
    known = materialize(category_frequency(df, columns).select("variable", "category", "n_rows"), "categories")
    rows = known.select(
        "variable", "category", F.lit("category_frequency").alias("finding"), F.col("n_rows").alias("n"), total.alias("denominator")
    )
    missing = F.col("category") == "[missing]"
    spellings = known.groupBy("variable", missing.alias("missing"), F.upper(stripped(F.col("category"))).alias("normal")).agg(
        F.count("*").alias("spellings"), F.sum("n_rows").alias("rows")
    )
    summary = spellings.groupBy("variable").agg(
        F.coalesce(F.sum(F.when(~F.col("missing"), F.col("spellings"))), F.lit(0)).alias("unique"),
        F.coalesce(F.sum(F.when(F.col("missing"), F.col("rows"))), F.lit(0)).alias("missing"),
        F.count_if(F.col("spellings") > 1).alias("collisions"),
        F.sum("rows").alias("rows"),
    )
    counts = {"unique_categories": "unique", "blank_missing": "missing", "normalization_collision_groups": "collisions"}
    return audit_part(rows, "categorical", F.col("variable"), F.col("category")).unionByName(
        audit_part(_by_finding(summary, "variable", counts, "rows"), "categorical", F.col("column_name"))
    )


def measure_section(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Description of the finite values, fences at 1.5 interquartile ranges and the values beyond them."""
    described = materialize(finite_describe(df, columns), "described")
    fences = iqr_outliers(df, columns, quartiles=described)

    def measures(source: DataFrame, names: Sequence[str], section: str) -> DataFrame:
        entries = [F.struct(F.lit(c).alias("finding"), F.col(c).cast("double").alias("m")) for c in names]
        long = source.select("variable", F.inline(F.array(*entries))).withColumns({"n": F.lit(None), "denominator": F.lit(None)})
        return audit_part(long, section, F.col("variable"), measure=F.col("m"))

    outside = _by_finding(fences, "variable", {"potential_outliers": "potential_outliers"}, "n")
    return (
        measures(described, ["n", "mean", "sd", "minimum", "q1", "median", "q3", "maximum"], "descriptive")
        .unionByName(measures(fences, ["iqr", "iqr_lower", "iqr_upper"], "outlier"))
        .unionByName(audit_part(outside, "outlier", F.col("column_name")))
    )


def audit_table(*parts: DataFrame) -> DataFrame:
    """All findings in one long table, with the percentage where there is a denominator."""
    return reduce(DataFrame.unionByName, parts).withColumn(
        "percent", F.try_divide(F.lit(100.0) * F.col("n"), F.col("denominator"))
    )


def quality_status(audit: DataFrame, blockers: Sequence[str]) -> DataFrame:
    """One row: findings that block, their records, and the overall status."""
    blocking = F.col("finding").isin(list(blockers)) & (F.col("n") > 0)
    return audit.agg(
        F.count("*").alias("findings"),
        F.count_if(blocking).alias("blocking_findings"),
        F.coalesce(F.sum(F.when(blocking, F.col("n"))), F.lit(0)).alias("blocking_records"),
    ).withColumn(
        "status",
        F.when(F.col("blocking_findings") > 0, "manual_review_required").otherwise("completed"),
    )
