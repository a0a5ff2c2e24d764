"""Raw extracts -> checked, cleaned and typed panel -> features, with parquet between the stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow import schema
from meterflow.functions.scalars import flag, is_blank
from meterflow.operators import calendar, features, quality
from meterflow.sources import extracts, tables


def load_extracts(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """Read every extract, stop on structural errors, store the text panel by period."""
    rows = extracts.require_valid_extract(extracts.load_history(spark, folder))
    tables.write_panel(rows, out)
    return spark.read.schema(rows.schema).parquet(out)


def audit(raw: DataFrame, cleaned: DataFrame, first: int, last: int) -> DataFrame:
    """All findings of the cleaning stage as one long table.

    Frequencies and descriptions are stored when this is called; the rest runs with the table.
    """
    keys = ["CONSUMER_NO", "ord"]
    none = F.lit(None).cast("bigint")

    def found(df: DataFrame, finding: str, n: str) -> DataFrame:
        total = F.coalesce(F.sum(n), F.lit(0))
        return df.agg(total.alias("n")).select(F.lit(finding).alias("finding"), "n", none.alias("denominator"))

    typed = quality.typed_columns(cleaned, schema.NUMERIC_FIELDS, schema.DATE_FIELDS)
    texts = list(dict.fromkeys([*schema.NUMERIC_FIELDS, *schema.DATE_FIELDS, *schema.CATEGORY_FIELDS]))
    conversions = quality.conversion_counts(cleaned, schema.NUMERIC_FIELDS, schema.DATE_FIELDS).select(
        "column_name", F.lit("nonblank_conversion_failures").alias("finding"), F.col("failures").alias("n"),
        F.col("values_before").alias("denominator"),
    )
    signs = quality.sign_checks(typed, schema.NUMERIC_FIELDS, schema.NONNEGATIVE_FIELDS)
    coverage = extracts.period_coverage(cleaned.select("ord").distinct(), first, last).filter("status <> 'ok'")
    blank = quality.count_flags(cleaned, {"missing_consumer_identifier": is_blank(F.col("CONSUMER_NO"))})
    return quality.audit_table(
        quality.audit_part(found(coverage.withColumn("one", F.lit(1)), "uncovered_periods", "one"), "coverage"),
        quality.audit_part(found(quality.duplicate_keys(raw, keys, []), "duplicate_key_rows", "member_rows"), "duplicates"),
        quality.audit_part(found(quality.conflicting_duplicates(raw, keys), "conflicting_duplicate_rows", "copies"), "duplicates"),
        quality.audit_part(conversions, "conversion", F.col("column_name")),
        quality.audit_part(
            signs.select("column_name", F.lit("nonfinite_numeric").alias("finding"), F.col("nonfinite").alias("n"), "denominator"),
            "logical", F.col("column_name"),
        ),
        quality.audit_part(
            signs.select(
                "column_name", F.concat(F.lit("negative_"), F.col("kind")).alias("finding"), F.col("negative").alias("n"), "denominator"
            ),
            "logical", F.col("column_name"),
        ),
        quality.audit_part(blank, "logical"),
        quality.audit_part(quality.logical_flags(typed, schema.DATE_ORDER_PAIRS), "logical"),
        quality.missing_section(cleaned.select(*texts), schema.NUMERIC_FIELDS, schema.DATE_FIELDS),
        quality.disguised_section(cleaned, texts),
        quality.category_section(cleaned, schema.CATEGORY_FIELDS),
        quality.measure_section(typed, schema.DESCRIBED_FIELDS),
    )


BLOCKERS = [
    "uncovered_periods", "conflicting_duplicate_rows", "nonblank_conversion_failures", "missing_consumer_identifier",
]


def clean(raw: DataFrame) -> DataFrame:
    """Exact repeats merged and the empty trailing field dropped; nothing else is changed."""
    kept = quality.drop_exact_duplicates(tables.require_columns(raw, ["CONSUMER_NO", "PERIOD"]))
    return quality.drop_empty_columns(kept, [extracts.ARTIFACT]) if extracts.ARTIFACT in raw.columns else kept


def feature_table(cleaned: DataFrame, out: str) -> DataFrame:
    """Typed panel -> features, stored by period after the key check."""
    panel = calendar.require_unique_keys(features.typed_panel(cleaned), [calendar.KEY, calendar.ORD])
    table = features.build_features(panel)
    tables.write_panel(table, out)
    return cleaned.sparkSession.read.schema(table.schema).parquet(out)


def feature_checks(table: DataFrame) -> DataFrame:
    """Lag verification and rule checks in one (check_name, rows_checked, violations) table."""
    lags = calendar.verify_calendar_lags(table, {**features.HISTORY, **features.NEXT})
    named = lags.select(
        F.concat(F.col("output"), F.lit("_exact_calendar_join")).alias("check_name"), "rows_checked",
        F.col("mismatches").alias("violations"),
    )
    return named.unionByName(features.feature_rule_checks(table))


def require_no_violations(checks: DataFrame) -> None:
    bad = checks.filter(flag(F.col("violations") > 0)).collect()
    if bad:
        raise ValueError("feature checks: " + ", ".join(f"{r.check_name} {r.violations}" for r in bad))


def bounds_after(train_end: int, validation_end: int, test_end: int, first: int) -> Mapping[str, tuple[int, int]]:
    """Consecutive windows of target months, and the month after the last one."""
    return {
        "TRAIN": (first, train_end),
        "VALIDATION": (train_end + 1, validation_end),
        "FINAL_TEST": (validation_end + 1, test_end),
        "FUTURE": (test_end + 1, test_end + 1),
    }


def columns_of(module: str) -> Sequence[str]:
    """Columns a module reads from the stored features."""
    return ["consumer_no", "ord", "target_ord", schema.TARGETS[module], *schema.PREDICTORS[module]]
