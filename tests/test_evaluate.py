import pytest

from meterflow.operators import evaluate, metrics
from meterflow.session import materialize

NUMBERS = "MAE double, RMSE double, R2 double"
CLASSES = (
    "Accuracy double, ROC_AUC double, AP double, F1_0 double, F1_1 double, class_0_count long, class_1_count long, "
    "predicted_class_0 long, predicted_class_1 long, " + ", ".join(f"true_{a}_predicted_{b} long" for a in (0, 1) for b in (0, 1))
)
KEYS = "module string, configuration string, stage string, "
ROLES = [("use", "P", 1, "baseline"), ("use", "M", 2, "best first family"), ("use", "M", 3, "official selected model"), ("risk", "T", 1, "official selected model")]


@pytest.fixture
def consolidated(spark):
    numbers = [("use", "M", "TRAIN", 1.0, 2.0, 0.5), ("use", "M", "VALIDATION", 1.5, 1.0, None), ("use", "M", "FINAL_TEST", 3.0, 4.0, 0.25),
               ("use", "P", "VALIDATION", 9.0, 9.0, 0.0), ("use", "P", "FINAL_TEST", 8.0, 8.0, None), ("use", "unlisted", "TRAIN", 0.0, 0.0, 0.0)]
    classes = [("risk", "T", "TRAIN", 0.75, None, 0.5, 0.5, 0.5, 6, 2, None, None, 4, 2, 1, 1), ("risk", "T", "VALIDATION", 0.5, 0.5, 0.25, 0.75, 0.25, 3, 1, 2, 2, 0, 0, 0, 0)]
    roles = spark.createDataFrame(ROLES, "module string, configuration string, rank int, role string")
    return evaluate.final_metrics(
        spark.createDataFrame(numbers, KEYS + NUMBERS), spark.createDataFrame(classes, KEYS + CLASSES), roles, {"use": "least error"}
    )


def test_final_metrics_gaps_counts_and_reasons(consolidated):
    rows = {(r.configuration, r.stage): r for r in consolidated.collect()}
    assert len(rows) == 7
    chosen = rows["M", "VALIDATION"]
    assert (chosen.VALIDATION_minus_TRAIN_MAE, chosen.VALIDATION_minus_TRAIN_RMSE, chosen.VALIDATION_minus_TRAIN_R2) == (0.5, -1.0, None)
    assert chosen.model_role == "best first family; official selected model" and chosen.selection_reason == "least error"
    assert rows["P", "VALIDATION"].VALIDATION_minus_TRAIN_MAE is None and rows["P", "VALIDATION"].selection_reason == ""
    assert rows["M", "FINAL_TEST"].VALIDATION_minus_TRAIN_MAE is None
    assert rows["M", "FINAL_TEST"].metric_source.startswith("held-out") and chosen.metric_source == "model comparison"
    risk = rows["T", "VALIDATION"]
    assert (risk.actual_class_0_count, risk.actual_class_1_count, risk.predicted_class_0_count) == (3, 1, 2)
    assert (risk.VALIDATION_minus_TRAIN_Accuracy, risk.VALIDATION_minus_TRAIN_ROC_AUC, risk.VALIDATION_minus_TRAIN_F1_0) == (-0.25, None, 0.25)
    assert rows["T", "TRAIN"].predicted_class_0_count == 5 and risk.selection_reason == "" and risk.MAE is None


def test_final_comparison_texts(consolidated):
    rows = {r.module: r for r in evaluate.final_comparison(consolidated, {"use": "RMSE", "risk": "AP"}, {"use": ["MAE", "R2"]}).collect()}
    use = rows["use"]
    assert (use.baseline, use.selected, use.selected_validation, use.selected_final_test, use.baseline_final_test) == ("P", "M", 1.0, 4.0, 8.0)
    assert use.selected_validation_secondary == "MAE=1.500000"  # R2 has no value there
    assert use.final_test_secondary == "selected MAE=3.000000, R2=0.250000; baseline MAE=8.000000"
    assert use.selection_reason == "least error"
    assert rows["risk"].selected_validation == 0.25 and rows["risk"].final_test_secondary is None and rows["risk"].baseline is None


def test_scores_are_read_once_for_all_metrics(spark):
    """Both kinds of metrics and the points come from the merged scores: nothing that is left to run reads the rows again."""
    rows = [("a", 1, 1, 0.9), ("a", 0, 1, 0.9), ("a", 1, 0, 0.4), ("a", 0, 0, 0.1), ("b", 1, 1, 0.7), ("b", 0, 0, 0.7)]
    scored = materialize(spark.createDataFrame(rows, "g string, y int, label int, p double"), "scored")
    found = metrics.scored_metrics(scored, "y", "label", "p", ["g"])
    points = metrics.roc_points(scored, "y", "p", ["g"])
    read = set(scored.inputFiles())
    assert not read & set(found.inputFiles()) and not read & set(points.inputFiles())
    a, b = found.orderBy("g").collect()
    assert (a.sample_count, a.true_1_predicted_0, a.true_0_predicted_1, a.Accuracy, a.ROC_AUC) == (4, 1, 1, 0.5, 0.625)
    assert (b.sample_count, b.ROC_AUC, b.AP, b.Recall_0) == (2, 0.5, 0.5, 1.0)
    assert points.where("p is null").count() == 2 and points.count() == 6
