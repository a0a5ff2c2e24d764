"""Model comparison, ranking, selection and consolidated result tables.

These tables have one row per configuration and stage: their size does not grow with the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLASS_METRICS = ["Accuracy", "ROC_AUC", "AP", "Precision_0", "Recall_0", "F1_0", "Precision_1", "Recall_1", "F1_1"]
REGRESSION_METRICS = ["MAE", "RMSE", "R2"]
#: Metrics of which the consolidated table shows VALIDATION minus TRAIN.
GAP_METRICS = [*REGRESSION_METRICS, "Accuracy", "ROC_AUC", "AP", "F1_0", "F1_1"]

# Ranking rules: (metric, descending), most important first; the listed order breaks ties.
RANK_AUC = [("VALIDATION_ROC_AUC", True), ("VALIDATION_F1_1", True), ("VALIDATION_F1_0", True), ("overfit_gap", False)]
RANK_F1 = [
    ("VALIDATION_F1_1", True), ("VALIDATION_Recall_1", True), ("VALIDATION_Precision_1", True),
    ("VALIDATION_AP", True), ("VALIDATION_ROC_AUC", True), ("overfit_gap", False),
]
RANK_RMSE = [("VALIDATION_RMSE", False), ("VALIDATION_MAE", False)]


def comparison_table(metrics: DataFrame, keys: Sequence[str], names: Sequence[str], stages: Sequence[str] = ("TRAIN", "VALIDATION")) -> DataFrame:
    """One row per configuration with the metrics of each stage side by side."""
    return (
        metrics.groupBy(*keys)
        .pivot("stage", list(stages))
        .agg(*[F.first(n).alias(n) for n in names])
    )


def metric_gaps(comparison: DataFrame, names: Sequence[str]) -> DataFrame:
    """VALIDATION minus TRAIN of each metric."""
    return comparison.withColumns(
        {f"VALIDATION_minus_TRAIN_{n}": F.col(f"VALIDATION_{n}") - F.col(f"TRAIN_{n}") for n in names}
    )


def rank_models(
    comparison: DataFrame, rule: Sequence[tuple[str, bool]], gap_metric: str | None = None,
    by: Sequence[str] = (), tie: str = "pos",
) -> DataFrame:
    """Position of each configuration under a ranking rule, first is best."""
    if gap_metric:
        gap = F.col(f"TRAIN_{gap_metric}") - F.col(f"VALIDATION_{gap_metric}")
        comparison = comparison.withColumn("overfit_gap", F.greatest(gap, F.lit(0.0)))
    order = [F.col(c).desc() if down else F.col(c).asc() for c, down in rule]
    window = Window.partitionBy(*by or [F.lit(0)]).orderBy(*order, tie)
    return comparison.withColumn("position", F.row_number().over(window))


def best_by_metric(comparison: DataFrame, metric: str, by: Sequence[str]) -> DataFrame:
    """The configuration with the lowest metric in each family; the first name when tied."""
    return comparison.groupBy(*by).agg(F.min(F.struct(metric, "configuration")).alias("b")).select(
        *by, F.col("b.configuration").alias("configuration"), F.col(f"b.{metric}").alias(metric)
    )


def ordered_selection(comparison: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows of the named configurations, numbered in the order of the names."""
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("configuration"))
    return comparison.withColumn("listed", order.cast("int")).filter("listed > 0").orderBy("listed")


def weight_effect(comparison: DataFrame, names: Sequence[str] = CLASS_METRICS, by: Sequence[str] = ("module",)) -> DataFrame:
    """Each configuration against its balanced clone on VALIDATION."""
    clones = comparison.select(
        *by,
        F.regexp_replace("configuration", "-balanced$", "").alias("unweighted_configuration"),
        F.col("configuration").alias("balanced_configuration"),
        *[F.col(f"VALIDATION_{n}").alias(f"balanced_{n}") for n in names],
    ).filter(F.col("balanced_configuration").endswith("-balanced"))
    parents = comparison.select(
        *by,
        F.col("configuration").alias("unweighted_configuration"),
        *[F.col(f"VALIDATION_{n}").alias(f"unweighted_{n}") for n in names],
    )
    return parents.join(clones, [*by, "unweighted_configuration"]).withColumns(
        {f"balanced_minus_unweighted_{n}": F.col(f"balanced_{n}") - F.col(f"unweighted_{n}") for n in names}
    )


def selection_record(
    ranked: DataFrame, primary: str, gates: Mapping[str, Column], choice: str | None = None,
    baseline: float | None = None,
) -> DataFrame:
    """The chosen row with its gates.

    Without `choice` the first position is taken and recorded as 'rank'; a named choice is
    recorded as 'named' next to the position it has. The record is marked as frozen only when
    every gate holds.
    """
    chosen = ranked.filter(F.col("configuration") == choice) if choice else ranked.filter("position = 1")
    passed = reduce(lambda a, b: a & b, [F.coalesce(g, F.lit(False)) for g in gates.values()], F.lit(True))
    improvement = F.col(primary) - F.lit(baseline) if baseline is not None else F.lit(None).cast("double")
    return chosen.withColumns(
        {
            "policy": F.lit("named" if choice else "rank"),
            "primary_metric": F.lit(primary),
            "improvement_over_baseline": improvement,
            **{name: F.coalesce(g, F.lit(False)) for name, g in gates.items()},
            "frozen_before_final_test": passed,
        }
    )


def close_to_rival(rival: DataFrame, metric: str, recall: str, margin: float = 0.02, gap: str = "overfit_gap") -> dict[str, Column]:
    """Gates against one rival row: close enough, stronger recall, smaller overfit gap."""
    other = rival.select(F.struct(F.col(metric).alias("metric"), F.col(recall).alias("recall"), F.col(gap).alias("gap"))).scalar()
    return {
        "gate_close_to_top": other.getField("metric") - F.col(metric) <= margin,
        "gate_stronger_recall": F.col(recall) > other.getField("recall"),
        "gate_smaller_gap": F.col(gap) < other.getField("gap"),
    }


def predicted_counts(metrics: DataFrame) -> DataFrame:
    """Predicted rows per class: as saved, or summed from the confusion counts."""
    return metrics.withColumns(
        {
            f"predicted_class_{k}_count": F.coalesce(
                F.col(f"predicted_class_{k}"),
                F.col(f"true_0_predicted_{k}") + F.col(f"true_1_predicted_{k}"),
            )
            for k in (0, 1)
        }
    )


def final_test_gate(final: DataFrame, expected: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Per module: does FINAL_TEST hold exactly the selected model and its baseline, on equal rows?"""
    pairs = final.sparkSession.createDataFrame(
        [(m, s, b) for m, (s, b) in expected.items()], "module string, selected string, baseline string"
    )
    named = F.col("configuration").isin(F.col("selected"), F.col("baseline"))
    return (
        final.join(pairs, "module")
        .groupBy("module", "selected", "baseline")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(named).alias("named_rows"),
            F.count_distinct("configuration").alias("configurations"),
            F.count_if(F.col("stage") != "FINAL_TEST").alias("other_stage_rows"),
            F.min("sample_count").alias("least_sample"),
            F.max("sample_count").alias("most_sample"),
        )
        .withColumn(
            "status",
            F.when(
                (F.col("n_rows") == 2) & (F.col("named_rows") == 2) & (F.col("configurations") == 2)
                & (F.col("other_stage_rows") == 0) & (F.col("least_sample") == F.col("most_sample")),
                "PASS",
            ).otherwise("FAIL"),
        )
    )


def with_roles(metrics: DataFrame, roles: DataFrame) -> DataFrame:
    """Keep configurations that play a role, with all their roles in one text."""
    listed = roles.groupBy("module", "configuration").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("rank", "role"))).getField("role"), "; ").alias("model_role"),
        F.bool_or(F.col("role") == "official selected model").alias("selected_model"),
        F.bool_or(F.col("role") == "baseline").alias("baseline"),
    )
    return metrics.join(listed, ["module", "configuration"])


def final_metrics(
    regression: DataFrame, classification: DataFrame, roles: DataFrame, reasons: Mapping[str, str] | None = None
) -> DataFrame:
    """Regression and classification results of the configurations with a role, in one table.

    VALIDATION rows carry what they differ by from the TRAIN row of the same configuration (null without one), rows of
    the selected model the reason of their module. Metrics that a kind of model does not have are null.
    """
    both = regression.unionByName(predicted_counts(classification), allowMissingColumns=True)
    # A configuration has a row for each stage, so its window holds three.
    stages = Window.partitionBy("module", "configuration")
    reason = F.lit(None).cast("string")
    for module, text in (reasons or {}).items():
        reason = F.when(F.col("module") == module, text).otherwise(reason)

    def gap(name: str) -> Column:
        train = F.max(F.when(F.col("stage") == "TRAIN", F.col(name))).over(stages)
        return F.when(F.col("stage") == "VALIDATION", F.col(name) - train)

    return with_roles(both, roles).withColumns(
        {
            **{f"actual_class_{k}_count": F.col(f"class_{k}_count") for k in (0, 1)},
            **{f"VALIDATION_minus_TRAIN_{n}": gap(n) for n in GAP_METRICS},
            "selection_reason": F.when(F.col("selected_model"), F.coalesce(reason, F.lit(""))).otherwise(""),
            "metric_source": F.when(F.col("stage") == "FINAL_TEST", "held-out final test before the refit").otherwise("model comparison"),
        }
    )


def _listed_metrics(by_module: Mapping[str, Sequence[str]], separator: str) -> Column:
    """The module's metrics as text, six digits each; those without a value are left out."""
    text = F.lit(None).cast("string")
    for module, names in by_module.items():
        values = [F.when(F.col(n).isNotNull(), F.format_string(f"{n}=%.6f", F.col(n))) for n in names]
        text = F.when(F.col("module") == module, F.concat_ws(separator, *values)).otherwise(text)
    return text


def final_comparison(
    metrics: DataFrame, primary: Mapping[str, str], secondary: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Per module: baseline, selected model, its primary metric and the secondary ones on validation and final test, and why."""
    measure = F.lit(None).cast("double")
    name = F.lit(None).cast("string")
    for module, metric in primary.items():
        measure = F.when(F.col("module") == module, F.col(metric)).otherwise(measure)
        name = F.when(F.col("module") == module, metric).otherwise(name)
    selected, base = F.col("selected_model"), F.col("baseline")

    def at(who: Column, stage: str, column: str = "_value") -> Column:
        return F.max(F.when(who & (F.col("stage") == stage), F.col(column)))

    def named(role: str) -> Column:
        return F.max(F.when(F.col("model_role").contains(role), F.col("configuration")))

    texts = {"_listed": _listed_metrics(secondary or {}, "; "), "_in_line": _listed_metrics(secondary or {}, ", ")}
    return (
        metrics.withColumns({"_value": measure, "primary_metric": name, **texts})
        .groupBy("module", "primary_metric")
        .agg(
            F.max(F.when(base, F.col("configuration"))).alias("baseline"),
            named("best first family").alias("best_first_family"),
            named("best second family").alias("best_second_family"),
            F.max(F.when(selected, F.col("configuration"))).alias("selected"),
            at(selected, "VALIDATION").alias("selected_validation"),
            at(selected, "VALIDATION", "_listed").alias("selected_validation_secondary"),
            at(selected, "FINAL_TEST").alias("selected_final_test"),
            at(base, "FINAL_TEST").alias("baseline_final_test"),
            F.concat(
                F.lit("selected "), at(selected, "FINAL_TEST", "_in_line"), F.lit("; baseline "), at(base, "FINAL_TEST", "_in_line")
            ).alias("final_test_secondary"),
            F.max(F.when(selected, F.col("selection_reason"))).alias("selection_reason"),
        )
    )


def model_card_rows(comparison: DataFrame, lower_is_better: Sequence[str] = ("RMSE", "MAE")) -> DataFrame:
    """Short texts per module: metric values and the improvement over the baseline."""
    gain = F.when(
        F.col("primary_metric").isin(list(lower_is_better)),
        F.col("baseline_final_test") - F.col("selected_final_test"),
    ).otherwise(F.col("selected_final_test") - F.col("baseline_final_test"))
    return comparison.select(
        "module",
        "selected",
        F.format_string("%s %.4f", "primary_metric", "selected_validation").alias("validation_text"),
        F.format_string("%s %.4f", "primary_metric", "selected_final_test").alias("final_test_text"),
        F.format_string("%s %s %.4f; improvement %.4f", "baseline", "primary_metric", "baseline_final_test", gain).alias("baseline_text"),
    )


# --- next-period predictions ----------------------------------------------------------

def prediction_coverage(predictions: DataFrame, future: DataFrame, value: str, class_column: str | None = None) -> DataFrame:
    """Predictions against the consumers to be scored, with extremes and class counts."""
    expected = future.agg(F.count("*")).scalar()
    v = F.col(value)
    extra = (
        [F.count_if(F.col(class_column) == k).alias(f"predicted_class_{k}") for k in (0, 1)] if class_column else []
    )
    return predictions.agg(
        F.count(v).alias("predictions"),
        F.count_if(~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))).alias("finite_predictions"),
        F.count_distinct("consumer_no").alias("unique_consumers"),
        F.min("target_ord").alias("target_ord"),
        F.count_distinct("target_ord").alias("target_periods"),
        F.count_if(v < 0).alias("negative_predictions"),
        F.min(v).alias("minimum"),
        F.max(v).alias("maximum"),
        *extra,
    ).withColumns({"future_rows": expected, "coverage_percent": F.lit(100.0) * F.col("predictions") / expected})


def prediction_audit(
    predictions: DataFrame, value: str, target_ord: int, expected_consumers: Column,
    class_column: str | None = None, probability: str | None = None,
) -> DataFrame:
    """Keys, period, missing and non-finite values, classes and probabilities -> PASS or FAIL."""
    v = F.col(value).cast("double")
    finite = F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    keys = predictions.groupBy("consumer_no", "target_ord").agg(F.count("*").alias("n"))
    distinct_keys = keys.agg(F.count("*")).scalar()
    checks = {
        "wrong_period": F.count_if(~F.col("target_ord").eqNullSafe(F.lit(target_ord))),
        "missing_predictions": F.count_if(v.isNull()),
        "nonfinite_predictions": F.count_if(~finite),
    }
    if class_column and probability:
        p = F.col(probability)
        checks |= {
            "unknown_class_labels": F.count_if(~F.coalesce(F.col(class_column).isin(0, 1), F.lit(False))),
            "missing_probabilities": F.count_if(p.isNull()),
            "probabilities_outside_0_1": F.count_if(~F.coalesce(p.between(0, 1) & ~F.isnan(p), F.lit(False))),
        }
    row = predictions.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("consumer_no").alias("unique_consumers"),
        *[c.alias(name) for name, c in checks.items()],
    ).withColumns(
        {"unique_keys": distinct_keys, "expected_consumers": expected_consumers}
    ).withColumn("duplicate_key_rows", F.col("n_rows") - F.col("unique_keys"))
    clean = reduce(lambda a, b: a & b, [F.col(name) == 0 for name in [*checks, "duplicate_key_rows"]])
    complete = (F.col("n_rows") == F.col("expected_consumers")) & (F.col("unique_consumers") == F.col("expected_consumers"))
    return row.withColumn("status", F.when(clean & complete, "PASS").otherwise("FAIL"))
