"""One prediction module from stored features to next-month predictions.

Compare on TRAIN and VALIDATION, rank, choose, freeze, evaluate once on FINAL_TEST, refit on all
labelled rows, score the next month. Tables with evidence are written once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow import schema
from meterflow.operators import baselines, evaluate, metrics, models, splits
from meterflow.sources import tables


@dataclass(frozen=True)
class ModuleResult:
    comparison: DataFrame
    selected: str
    final_test: DataFrame
    predictions: DataFrame


def candidates(module: str) -> Sequence[models.Configuration]:
    """The full grid of a module, simplest first."""
    if module == "consumption":
        return [*models.linear_ladder(), *models.forest_regression()]
    return [*models.tree_classifier(module), *models.forest_classifier(module)]


#: Ranking rule of each module, and the metric whose gap counts in it.
RULES = {"consumption": (evaluate.RANK_RMSE, None), "revenue": (evaluate.RANK_AUC, "ROC_AUC"), "anomaly": (evaluate.RANK_F1, "F1_1")}


def run_module(
    features: DataFrame, module: str, bounds: Mapping[str, tuple[int, int]], out: str,
    grid: Sequence[models.Configuration] | None = None, choice: str | None = None,
    rival: str | None = None,
) -> ModuleResult:
    """Run a module and write its split, comparison, selection, evidence, models and predictions below `out`.

    `choice` names a configuration; without it the first ranked one is taken. In the anomaly module a `rival`
    gates the choice: its F1 may be 0.02 lower at most, its recall has to be higher and its overfit gap smaller.
    """
    spark, classify = features.sparkSession, module != "consumption"
    split = splits.module_rows(features, bounds, module)
    kept = ["module", "partition", "consumer_no", "target_ord", "target", *schema.PREDICTORS[module]]
    tables.write_partitions(split.select(*dict.fromkeys(kept)), f"{out}/split")
    stored = spark.read.parquet(f"{out}/split")
    parts = {p: stored.filter(F.col("partition") == p) for p in bounds}

    store = models.FitStore(spark, f"{out}/fits")
    table, grid = models.full_comparison(grid or candidates(module), parts["TRAIN"], parts["VALIDATION"], classify, *RULES[module], store)
    table.write.mode("errorifexists").parquet(f"{out}/comparison")
    ranked = spark.read.parquet(f"{out}/comparison")

    primary = {"consumption": "VALIDATION_RMSE", "revenue": "VALIDATION_ROC_AUC", "anomaly": "VALIDATION_F1_1"}[module]
    gates = {}
    if module == "revenue":
        gates = {
            "gate_auc": F.col("VALIDATION_ROC_AUC") > 0.5,
            "gate_both_classes": (F.col("VALIDATION_Recall_0") > 0) & (F.col("VALIDATION_Recall_1") > 0),
        }
    if module == "anomaly" and rival is not None:
        if not ranked.filter(F.col("configuration") == rival).count():
            raise ValueError(f"{module}: no configuration {rival} to compare the choice with")
        gates = evaluate.close_to_rival(ranked.filter(F.col("configuration") == rival), "VALIDATION_F1_1", "VALIDATION_Recall_1")
    record = evaluate.selection_record(ranked, primary, gates, choice)
    tables.write_once(record, f"{out}/selection")
    selection = spark.read.parquet(f"{out}/selection").select("configuration", "frozen_before_final_test").first()
    if selection is None or not selection.frozen_before_final_test:
        raise ValueError(f"{module}: the selected configuration does not pass its gates")
    chosen = next(c for c in grid if c.name == selection.configuration)

    frozen, refitted = models.freeze_and_refit(chosen, parts["TRAIN"], splits.labelled_history(stored), f"{out}/models")
    test = frozen.prepare(parts["FINAL_TEST"])
    if classify:
        scored = models.score_classes(frozen.model, test).withColumnsRenamed(
            {"predicted_class": "selected_class", "probability": "selected_probability"}
        )
        evidence = baselines.majority(parts["TRAIN"], scored).select(
            "consumer_no", "target_ord", F.col("target").alias("actual_class"), "selected_class", "selected_probability",
            F.col("predicted_class").alias("baseline_class"), F.col("probability").alias("baseline_probability"),
        )
    else:
        scored = models.score_regression(frozen.model, test)
        evidence = scored.select(
            "consumer_no", "target_ord", F.col("target").alias("actual_consumption"),
            F.col("prediction").alias("selected_prediction"), F.col("current_consumption").alias("baseline_prediction"),
            (F.col("target") - F.col("prediction")).alias("residual_actual_minus_predicted"),
        )
    tables.write_once(evidence, f"{out}/final_test")
    final = _final_metrics(spark.read.parquet(f"{out}/final_test"), chosen.name, classify)

    tables.write_once(models.score_next_period(refitted, parts["FUTURE"], classify), f"{out}/predictions")
    return ModuleResult(ranked, chosen.name, final, spark.read.parquet(f"{out}/predictions"))


def _final_metrics(evidence: DataFrame, name: str, classify: bool) -> DataFrame:
    """Metrics of the selected model and its baseline on the same held-out rows."""
    base = "TRAIN-majority" if classify else "Persistence"
    if classify:
        pairs = [(name, "selected"), (base, "baseline")]
        options = [
            F.struct(F.lit(n).alias("configuration"), F.col(f"{p}_class").alias("label"), F.col(f"{p}_probability").alias("score"))
            for n, p in pairs
        ]
        rows = evidence.select("actual_class", F.inline(F.array(*options)))
        return metrics.scored_metrics(rows, "actual_class", "label", "score", ["configuration"])
    options = [
        F.struct(F.lit(n).alias("configuration"), F.col(f"{p}_prediction").alias("prediction"))
        for n, p in [(name, "selected"), (base, "baseline")]
    ]
    rows = evidence.select("actual_consumption", F.inline(F.array(*options)))
    return metrics.regression_metrics(rows, "actual_consumption", "prediction", ["configuration"])
