from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import models as wired
from meterflow import schema
from meterflow.operators import families, models, prepare
from meterflow.operators.baselines import balanced_weights
from meterflow.operators.families import FitStore, levels
from meterflow.plans.module_run import RULES
from meterflow.session import materialize


@pytest.fixture(scope="module")
def consumption(spark, folder):
    return wired.rows(spark, folder, "consumption")


@pytest.fixture(scope="module")
def revenue(spark, folder):
    return wired.rows(spark, folder, "revenue")


def test_least_squares_matches_numpy(spark, consumption):
    parts, _ = consumption
    fitted = models.fit_pipeline(models.linear_ladder()[0], parts["TRAIN"])
    rows = prepare.impute(parts["TRAIN"], fitted.preprocessing.medians, {}).toPandas()
    names = schema.LINEAR_LADDER["MLR-1"]
    design = np.column_stack([rows[names].to_numpy(float), np.ones(len(rows))])
    best, *_ = np.linalg.lstsq(design, rows.target.to_numpy(float), rcond=None)
    assert list(fitted.model.coefficients) + [fitted.model.intercept] == pytest.approx(list(best), rel=1e-6)


def test_full_ladder_beats_nothing_less(spark, consumption):
    """Nested predictors: the TRAIN error cannot grow."""
    parts, _ = consumption
    metrics, _ = models.compare_models(models.linear_ladder(), parts["TRAIN"], parts["VALIDATION"], False)
    rows = models.comparison(metrics, False).orderBy("pos").collect()
    errors = [r.TRAIN_RMSE for r in rows]
    assert len(errors) == 4 and all(a >= b - 1e-6 for a, b in zip(errors, errors[1:]))


def test_preprocessing_sees_fit_rows_only(spark, consumption):
    parts, _ = consumption
    learned = models.fit_preprocessing(parts["TRAIN"], schema.CONSUMPTION_PREDICTORS)
    frame = parts["TRAIN"].select("consumption_lag3", "tarrif").toPandas()
    assert learned.medians["consumption_lag3"] == pytest.approx(frame.consumption_lag3.median())
    counts = frame.tarrif.value_counts()
    assert learned.modes["tarrif"] == sorted(counts[counts == counts.max()].index)[0]


def test_unseen_category_encodes_to_zeros(spark, consumption):
    parts, _ = consumption
    learned = models.fit_preprocessing(parts["TRAIN"], schema.CONSUMPTION_PREDICTORS)
    odd = learned.transform(parts["TRAIN"].limit(1).withColumn("tarrif", F.lit("NEW"))).first()
    assert odd.tarrif_hot.numNonzeros() == 0


def test_pipeline_survives_saving(spark, revenue, tmp_path):
    parts, _ = revenue
    config = models.balanced_clone(models.tree_classifier("revenue")[0])
    fitted = models.fit_pipeline(config, parts["TRAIN"])
    fitted.save(str(tmp_path / "p"))
    again = models.FittedPipeline.load(spark, str(tmp_path / "p"), config.name, config.features)

    def scores(p):
        rows = models.score_classes(p.model, p.prepare(parts["FINAL_TEST"])).select("consumer_no", "target_ord", "probability")
        return sorted(map(tuple, rows.collect()))

    assert scores(fitted) == scores(again)
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        fitted.save(str(tmp_path / "p"))


def test_small_forest_is_repeatable(spark, revenue):
    parts, _ = revenue
    grid = models.forest_classifier("revenue", [(5, 3)])

    def run():
        metrics, _ = models.compare_models(grid, parts["TRAIN"], parts["VALIDATION"], True)
        return [tuple(r) for r in metrics.select("stage", "ROC_AUC", "AP", "F1_1").orderBy("stage").collect()]

    first = run()
    assert first == run() and dict((r[0], r[1]) for r in first)["TRAIN"] > 0.5


def test_grids():
    assert [c.name for c in models.forest_regression()] == ["RF-1", "RF-2", "RF-3", "RF-4"]
    assert models.forest_regression()[3].estimator.getMaxDepth() == models.FULL_DEPTH
    assert len(models.tree_classifier("anomaly")) == 4
    clone = models.balanced_clone(models.tree_classifier("anomaly")[2])
    assert clone.estimator.getWeightCol() == "weight" and clone.estimator.getMaxDepth() == 8


def test_settings_rows_and_missing_values_decide_what_is_fitted(spark, consumption, tmp_path):
    parts, _ = consumption
    train, validation, path = parts["TRAIN"].limit(400), parts["VALIDATION"].limit(100), str(tmp_path / "r")
    train = materialize(train, "some")
    grid = [*models.linear_ladder()[:2], *models.forest_regression([(3, 2), (3, 4)])]
    changed = [grid[0], replace(grid[1], estimator=grid[1].estimator.copy({grid[1].estimator.regParam: 0.5})), *grid[2:]]
    deeper = [*grid[:3], *models.forest_regression([(3, 2), (3, 5)])[1:]]
    made = lambda grid, rows=train: models.resume_comparison(path, grid, rows, validation, False)[1]
    assert made(grid) == ["MLR-1", "MLR-2", "RF-2", "RF-1"] and made(grid) == []
    assert made(changed) == ["MLR-2"] and made(deeper) == ["RF-2", "RF-1"]
    # A column that only the larger predictor sets read.
    assert made(grid, train.withColumn("contract_load", F.col("contract_load") + 1)) == ["RF-2", "RF-1"]
    rows = [(1, None, 5.0), (2, 5.0, None)]
    a = spark.createDataFrame(rows, "k long, x double, y double")
    b = spark.createDataFrame([(1, 5.0, None), (2, None, 5.0)], "k long, x double, y double")
    assert models.input_fingerprint(a) != models.input_fingerprint(b)


def test_a_broken_run_goes_on_where_it_ended(spark, consumption, tmp_path, monkeypatch):
    parts, _ = consumption
    grid, path, fitted = models.linear_ladder(), str(tmp_path / "r"), []
    fit = models.fit_estimator

    def breaks(config, *rest):
        if config.name == "MLR-4" and fitted.count("MLR-4") == 0:
            fitted.append("MLR-4")
            raise RuntimeError("executor lost")
        fitted.append(config.name)
        return fit(config, *rest)

    monkeypatch.setattr(models, "fit_estimator", breaks)
    with pytest.raises(RuntimeError):
        models.resume_comparison(path, grid, parts["TRAIN"], parts["VALIDATION"], False)
    table, made = models.resume_comparison(path, grid, parts["TRAIN"], parts["VALIDATION"], False)
    assert fitted == ["MLR-1", "MLR-2", "MLR-3", "MLR-4", "MLR-4"] and made == ["MLR-4"] and table.count() == 4


def scores(model, rows, classify):
    value = vector_to_array(F.col("probability")) if classify else F.col("prediction")
    return [r.v for r in model.transform(rows).orderBy("consumer_no", "target_ord").select(value.alias("v")).collect()]


@pytest.mark.parametrize("module, kind", [("revenue", "tree"), ("revenue", "balanced"), ("consumption", "forest")])
def test_cuts_are_the_fits_of_their_depth(spark, request, tmp_path, module, kind):
    """A tree, a weighted tree and a forest that looks at all features: cut at 3 and 5, against fits of that depth."""
    parts, _ = request.getfixturevalue(module)
    grid = models.forest_regression([(4, 3), (4, 5), (4, None)]) if kind == "forest" else models.tree_classifier(module, [3, 5, None])
    if kind == "balanced":
        grid = [models.balanced_clone(c) for c in grid]
    assert [[c.name for c in f] for f in models.families(grid)] == [[c.name for c in reversed(grid)]]
    train = balanced_weights(parts["TRAIN"]) if module == "revenue" else parts["TRAIN"]
    preprocessing = models.fit_preprocessing(train, grid[0].features)
    inputs = models.model_inputs(preprocessing, train)
    store = FitStore(spark, str(tmp_path / "fits"))
    fitted = models.fit_all(grid, preprocessing, inputs, parts["TRAIN"], store)
    ready = materialize(preprocessing.assemble(inputs, grid[0].features), "ready")
    assert len(store.made) == 3
    for config in grid[:2]:
        own, cut = models.fit_estimator(config, preprocessing, inputs), fitted[config.name]
        size = lambda m: m.totalNumNodes if kind == "forest" else (m.numNodes, m.depth)
        assert size(own) == size(cut) and cut.getMaxDepth() == config.estimator.getMaxDepth()
        np.testing.assert_allclose(scores(cut, ready, module == "revenue"), scores(own, ready, module == "revenue"), rtol=1e-9, atol=1e-12)
        assert cut.featureImportances.toArray() == pytest.approx(own.featureImportances.toArray(), abs=1e-9)


def test_cuts_of_drawn_features_are_forests_of_their_depth(spark, revenue):
    parts, _ = revenue
    grid = models.forest_classifier("revenue", [(6, 2), (6, 6)])
    metrics, fitted = models.compare_models(grid, parts["TRAIN"], parts["VALIDATION"], True)
    assert {t.depth <= 2 for t in fitted["RF-1"].trees} == {True} and max(t.depth for t in fitted["RF-2"].trees) == 6
    assert metrics.count() == 4 and len(fitted["RF-1"].trees) == 6


def test_cut_of_one_tree():
    # 0 -> (1 -> (2, 3), 4 -> (5 -> (6, 7), 8)); at depth 2 the leaves under 4 predict the same, so 4 becomes one.
    nodes = pd.DataFrame({"treeID": 0, "id": range(9), "prediction": [0.0, 0, 0, 1, 1, 1, 1, 0, 1], "leftChild": [1, 2, -1, -1, 5, 6, -1, -1, -1], "rightChild": [4, 3, -1, -1, 8, 7, -1, -1, -1]})
    assert levels(nodes.leftChild.to_numpy(), nodes.rightChild.to_numpy()).tolist() == [0, 1, 2, 2, 1, 2, 3, 3, 2]
    assert families._cut(2)(nodes).values.tolist() == [[0, 0, 0, 1, 4], [0, 1, 1, 2, 3], [0, 2, 2, -1, -1], [0, 3, 3, -1, -1], [0, 4, 4, -1, -1]]
    assert families._cut(9)(nodes).new_id.tolist() == list(range(9)) and families._cut(0)(nodes).id.tolist() == [0]


def test_full_comparison(spark, revenue):
    parts, _ = revenue
    grid = [*models.tree_classifier("revenue", [2, 4]), *models.forest_classifier("revenue", [(3, 2), (3, 3)])]
    table, configs = models.full_comparison(grid, parts["TRAIN"], parts["VALIDATION"], True, *RULES["revenue"])
    rows = {r.configuration: r for r in table.collect()}
    assert len(rows) == 7 == len(configs) + 1 and rows["TRAIN-majority"].position is None and rows["TRAIN-majority"].features == "None"
    assert sorted(r.position for r in rows.values() if r.position) == [1, 2, 3, 4, 5, 6]
    clones = [r for r in rows.values() if r.class_weight == "balanced"]
    assert sorted(r.algorithm for r in clones) == ["Decision Tree", "Random Forest"]
    for clone in clones:
        parent = rows[clone.configuration.removesuffix("-balanced")]
        rivals = [r for r in rows.values() if r.algorithm == clone.algorithm and r.class_weight == "None"]
        assert parent.position == min(r.position for r in rivals) and parent.hyperparameters == clone.hyperparameters
    assert "maxDepth=4" in rows["DT-2"].hyperparameters and rows["RF-1"].features == "; ".join(schema.PREDICTORS["revenue"])
    majority = parts["VALIDATION"].where("target = 0").count() / parts["VALIDATION"].count()
    assert rows["TRAIN-majority"].VALIDATION_Accuracy in (pytest.approx(majority), pytest.approx(1 - majority))


def test_forests_do_not_depend_on_the_cluster(spark, consumption):
    """The same rows in other partitions give the same trees."""
    parts, _ = consumption
    config = models.forest_regression([(5, 4)])[0]
    importances = [models.fit_pipeline(config, parts["TRAIN"].repartition(n)).model.featureImportances.toArray().tolist() for n in (3, 11)]
    assert importances[0] == pytest.approx(importances[1], abs=1e-12)


def test_rows_are_dealt_for_fits_alone(spark, consumption):
    """Scoring neither shuffles nor sorts the stored rows."""
    parts, _ = consumption
    preprocessing = models.fit_preprocessing(parts["TRAIN"], schema.LINEAR_LADDER["MLR-1"])
    inputs = models.model_inputs(preprocessing, parts["TRAIN"])
    plan = inputs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    dealt = models.dealt(inputs)
    assert dealt.rdd.getNumPartitions() == models.LEAST_PARTITIONS and dealt.count() == parts["TRAIN"].count()


def test_class_positions(spark):
    class Fitted:
        numClasses = 2

    assert models.class_position(Fitted) == 1 and models.class_position(Fitted, ["1", "0"], "1") == 0
    with pytest.raises(ValueError):
        models.class_position(Fitted, label=2)


def test_registered_queries_fit_the_whole_grid(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(wired, "measured", lambda spark, folder, module, configs: asked.extend((module, c.name) for c in configs))
    monkeypatch.setattr(wired, "value_facts", lambda *_: None)
    monkeypatch.setattr(wired, "by_module", lambda run: [run(m) for m in wired.CLASSIFIED])

    class Facts:
        def __getattr__(self, _):
            return lambda *_: self

    monkeypatch.setattr(wired, "class_facts", lambda _: Facts())
    names = lambda kind, n, modules: [(m, f"{kind}-{i + 1}") for m in modules for i in range(n)]
    wired.forest_regression(None, None), wired.forest_regression_200(None, None)
    assert asked == names("RF", len(schema.FOREST_GRID), ["consumption"])
    asked.clear()
    wired.forest_classifier(None, None)
    assert asked == names("RF", len(schema.FOREST_GRID), wired.CLASSIFIED)
