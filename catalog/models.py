"""Queries that fit models on P1. What SQL can state of a fit is returned: keys, actuals, counts, settings, ranges and orders that hold for any
right fit, and the numbers of the baselines. The operators return all metrics and predictions; tests hold them against plain versions."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog.base import SPLITS, query
from catalog.features import built
from meterflow import schema
from meterflow.operators import evaluate, models, splits
from meterflow.plans import module_run
from meterflow.session import materialize, scratch_path
from meterflow.sources.bindings import P1_BOUNDS

CLASSIFIED = ("revenue", "anomaly")


def rows(spark, folder, module):
    """The split of one module, stored for the fits that read it repeatedly."""
    needed = ["partition", "consumer_no", "target_ord", "target", *schema.PREDICTORS[module]]
    split = splits.module_rows(built(spark, folder), P1_BOUNDS, module).select(*needed)
    stored = materialize(split, "module")
    parts = {p: stored.filter(F.col("partition") == p) for p in P1_BOUNDS}
    return parts, splits.labelled_history(stored)


STAGES = """ "partition" IN ('TRAIN', 'VALIDATION')"""


def named(names):
    """The configurations of a grid as a SQL table."""
    return f"g(configuration) AS (VALUES {', '.join(f"('{n}')" for n in names)})"


def measured(spark, folder, module, configs):
    """Metrics of every stage of the fitted configurations."""
    parts, _ = rows(spark, folder, module)
    return models.compare_models(configs, parts["TRAIN"], parts["VALIDATION"], module != "consumption")[0]


def by_module(run):
    """The tables of the classified modules, one below the other."""
    return reduce(DataFrame.unionByName, [run(module).withColumn("module", F.lit(module)) for module in CLASSIFIED])


def class_facts(metrics):
    """Rows and classes behind the metrics of each stage, and whether these are what any fit has to give."""
    inside = reduce(lambda a, b: a & b, [F.coalesce(F.col(n).between(0, 1), F.lit(False)) for n in evaluate.CLASS_METRICS])
    return metrics.select(
        "pos", "stage", "configuration", "algorithm", "sample_count", "class_0_count", "class_1_count", "Accuracy",
        inside.alias("metrics_in_range"), F.when(F.col("stage") == "TRAIN", F.col("ROC_AUC") >= 0.5).alias("ranks_train"),
    )


def class_facts_sql(names, algorithm):
    return f"""WITH {SPLITS}, {named(names)}
SELECT module, "partition" AS stage, configuration, '{algorithm}' AS algorithm, count(*) AS sample_count, count(*) FILTER (target = 0) AS class_0_count,
  count(*) FILTER (target = 1) AS class_1_count, TRUE AS metrics_in_range, CASE WHEN "partition" = 'TRAIN' THEN TRUE END AS ranks_train
FROM sp CROSS JOIN g WHERE module <> 'consumption' AND {STAGES} GROUP BY module, "partition", configuration"""


def value_facts(metrics, chain):
    """Rows of each stage, and whether errors are finite, beat the mean on TRAIN, and do not grow along each chain of configurations there."""
    before = Window.partitionBy("stage", chain).orderBy("pos")
    train = F.col("stage") == "TRAIN"
    return metrics.select(
        "stage", "configuration", "algorithm", "sample_count", (F.col("RMSE") >= F.col("MAE") - 1e-9).alias("errors_in_order"),
        F.when(train, F.col("R2").between(0, 1)).alias("beats_mean"),
        F.when(train, F.col("RMSE") <= F.coalesce(F.lag("RMSE").over(before), F.col("RMSE")) * (1 + 1e-9)).alias("not_above_smaller"),
    )


def value_facts_sql(names, algorithm):
    return f"""WITH {SPLITS}, {named(names)}
SELECT "partition" AS stage, configuration, '{algorithm}' AS algorithm, count(*) AS sample_count, TRUE AS errors_in_order,
  CASE WHEN "partition" = 'TRAIN' THEN TRUE END AS beats_mean, CASE WHEN "partition" = 'TRAIN' THEN TRUE END AS not_above_smaller
FROM sp CROSS JOIN g WHERE module = 'consumption' AND {STAGES} GROUP BY "partition", configuration"""


@query("linear_ladder", value_facts_sql(schema.LINEAR_LADDER, "Multiple Linear Regression"))
def linear_ladder(spark, folder):
    """Nested predictor sets: the TRAIN error cannot grow."""
    return value_facts(measured(spark, folder, "consumption", models.linear_ladder()), F.lit(1))


def forests(spark, folder, trees):
    grid = [c for c in models.forest_regression() if c.estimator.getNumTrees() == trees]
    return value_facts(measured(spark, folder, "consumption", grid), F.lit(1))


@query("forest_regression", value_facts_sql(["RF-1", "RF-2"], "Random Forest Regressor"))
def forest_regression(spark, folder):
    """The forests of 100 trees; those of 200 are a query of their own, so that each ends by itself."""
    return forests(spark, folder, 100)


@query("forest_regression_200", value_facts_sql(["RF-3", "RF-4"], "Random Forest Regressor"))
def forest_regression_200(spark, folder):
    return forests(spark, folder, 200)


@query("tree_classifier", f"""SELECT *, CASE WHEN stage = 'TRAIN' THEN TRUE END AS not_below_smaller FROM ({class_facts_sql([f"DT-{i + 1}" for i in range(len(schema.TREE_DEPTHS))], "Decision Tree")})""")
def tree_classifier(spark, folder):
    """All depths for both modules, cut from one tree: on TRAIN a deeper one is never less right."""

    def run(module):
        facts = class_facts(measured(spark, folder, module, models.tree_classifier(module)))
        before = F.lag("Accuracy").over(Window.partitionBy("stage").orderBy("pos"))
        grown = F.when(F.col("stage") == "TRAIN", F.col("Accuracy") >= F.coalesce(before, F.col("Accuracy")))
        return facts.withColumn("not_below_smaller", grown).drop("pos", "Accuracy")

    return by_module(run)


@query("forest_classifier", class_facts_sql([f"RF-{i + 1}" for i in range(len(schema.FOREST_GRID))], "Random Forest"))
def forest_classifier(spark, folder):
    """The whole grid for both modules."""
    return by_module(lambda module: class_facts(measured(spark, folder, module, models.forest_classifier(module))).drop("pos", "Accuracy"))


def compared(spark, folder, module):
    parts, _ = rows(spark, folder, module)
    rule, gap = module_run.RULES[module]
    table, _ = models.full_comparison(module_run.candidates(module), parts["TRAIN"], parts["VALIDATION"], module != "consumption", rule, gap)
    return materialize(table, "comparison")


def comparison_facts(table, metrics, baseline):
    """What a full comparison holds of each algorithm and weighting, beside the baseline's number on VALIDATION."""
    plain = table.where("class_weight = 'None' and position is not null")
    leaders = plain.groupBy("algorithm").agg(F.min_by("configuration", "position").alias("leader"))
    known = reduce(lambda a, b: a & b, [F.col(f"{s}_{n}").isNotNull() for n in metrics for s in ("TRAIN", "VALIDATION", "VALIDATION_minus_TRAIN")])
    clone_of_leader = F.when(F.col("class_weight") == "balanced", F.col("configuration") == F.concat("leader", F.lit("-balanced")))
    return table.join(leaders, "algorithm", "left").groupBy("algorithm", "class_weight").agg(
        F.count("*").alias("configurations"), F.count("position").alias("ranked"), F.count_distinct("hyperparameters", "features").alias("settings"),
        F.bool_and(known).alias("all_metrics"), F.bool_and(clone_of_leader).alias("clones_of_leaders"),
        F.first(table.where("position is null").select(baseline).scalar()).alias("baseline_on_validation"),
    )


def class_comparison_sql(module):
    return f"""WITH {SPLITS}, m AS (SELECT CASE WHEN count(*) FILTER (target = 1) > count(*) FILTER (target = 0) THEN 1 ELSE 0 END AS c FROM sp WHERE module = '{module}' AND "partition" = 'TRAIN'),
b AS (SELECT count(*) FILTER (target = c) / CAST(count(*) AS DOUBLE) AS baseline_on_validation FROM sp CROSS JOIN m WHERE module = '{module}' AND "partition" = 'VALIDATION'),
g(algorithm, class_weight, configurations, ranked, settings, clones_of_leaders) AS (VALUES ('Constant baseline', 'None', 1, 0, 1, NULL), ('Decision Tree', 'None', 4, 4, 4, NULL),
  ('Random Forest', 'None', 4, 4, 4, NULL), ('Decision Tree', 'balanced', 1, 1, 1, TRUE), ('Random Forest', 'balanced', 1, 1, 1, TRUE))
SELECT algorithm, class_weight, CAST(configurations AS BIGINT) AS configurations, CAST(ranked AS BIGINT) AS ranked, CAST(settings AS BIGINT) AS settings, TRUE AS all_metrics, clones_of_leaders, baseline_on_validation FROM g CROSS JOIN b"""


@query("compare_models", class_comparison_sql("revenue"), ["baseline_on_validation"])
def compare_models(spark, folder):
    """Baseline, the whole grid and one balanced clone of each algorithm's leader, for the revenue module."""
    return comparison_facts(compared(spark, folder, "revenue"), evaluate.CLASS_METRICS, "VALIDATION_Accuracy")


@query("compare_models_anomaly", class_comparison_sql("anomaly"), ["baseline_on_validation"])
def compare_models_anomaly(spark, folder):
    return comparison_facts(compared(spark, folder, "anomaly"), evaluate.CLASS_METRICS, "VALIDATION_Accuracy")


@query("compare_models_consumption", f"""WITH {SPLITS}, b AS (SELECT sqrt(avg(pow(target - current_consumption, 2))) AS baseline_on_validation FROM sp WHERE module = 'consumption' AND "partition" = 'VALIDATION'),
g(algorithm, configurations, ranked, settings) AS (VALUES ('Persistence baseline', 1, 0, 1), ('Multiple Linear Regression', 4, 4, 4), ('Random Forest Regressor', 4, 4, 4))
SELECT algorithm, 'None' AS class_weight, CAST(configurations AS BIGINT) AS configurations, CAST(ranked AS BIGINT) AS ranked, CAST(settings AS BIGINT) AS settings, TRUE AS all_metrics,
  CAST(NULL AS BOOLEAN) AS clones_of_leaders, baseline_on_validation FROM g CROSS JOIN b""", ["baseline_on_validation"])
def compare_models_consumption(spark, folder):
    return comparison_facts(compared(spark, folder, "consumption"), evaluate.REGRESSION_METRICS, "VALIDATION_RMSE")


@query("resume_comparison", f"""SELECT * FROM (VALUES ('first', 'MLR-1, MLR-2, MLR-3, MLR-4', {len(schema.LINEAR_LADDER)}::BIGINT), ('again', '', 4::BIGINT), ('other settings of one', 'MLR-2', 4::BIGINT), ('one more', 'MLR-5', 5::BIGINT)) t(run, fitted, configurations)""")
def resume_comparison(spark, folder):
    """What each run fits: all, nothing again, the one with other settings, the one that is new."""
    parts, _ = rows(spark, folder, "consumption")
    path = scratch_path(spark, "comparison")
    grid = models.linear_ladder()
    changed = [replace(c, estimator=c.estimator.copy({c.estimator.regParam: 0.1})) if c.name == "MLR-2" else c for c in grid]
    more = [*grid, replace(grid[0], name="MLR-5", features=grid[0].features[:2])]
    out = []
    for run, configs in (("first", grid), ("again", grid), ("other settings of one", changed), ("one more", more)):
        table, made = models.resume_comparison(path, configs, parts["TRAIN"], parts["VALIDATION"], False)
        out.append((run, ", ".join(made), table.count()))
    return spark.createDataFrame(out, "run string, fitted string, configurations long")


@query("fit_pipeline", f"""WITH {SPLITS} SELECT consumer_no, target_ord, target, TRUE AS predicted FROM sp WHERE module = 'consumption' AND "partition" = 'FINAL_TEST'""")
def fit_pipeline(spark, folder):
    """The largest linear model, learned on TRAIN, predicts a finite value for every held-out row."""
    parts, _ = rows(spark, folder, "consumption")
    fitted = models.fit_pipeline(models.linear_ladder()[-1], parts["TRAIN"])
    scored = fitted.transform(parts["FINAL_TEST"])
    return scored.select("consumer_no", "target_ord", "target", (F.abs("prediction") < float("inf")).alias("predicted"))


@query("score_classes", f"""WITH {SPLITS} SELECT consumer_no, target_ord, target, TRUE AS in_range, TRUE AS class_follows FROM sp WHERE module = 'revenue' AND "partition" = 'FINAL_TEST'""")
def score_classes(spark, folder):
    parts, _ = rows(spark, folder, "revenue")
    fitted = models.fit_pipeline(models.tree_classifier("revenue")[1], parts["TRAIN"])
    scored = models.score_classes(fitted.model, fitted.prepare(parts["FINAL_TEST"]))
    p = F.col("probability")
    return scored.select("consumer_no", "target_ord", "target", p.between(0, 1).alias("in_range"), (F.col("predicted_class") == (p > 0.5).cast("int")).alias("class_follows"))


def refitted(spark, folder, module, config):
    parts, labelled = rows(spark, folder, module)
    frozen, refit = models.freeze_and_refit(config, parts["TRAIN"], labelled, scratch_path(spark, "models"))
    return parts, labelled, frozen, refit


@query("freeze_and_refit", f"""WITH {SPLITS}, n AS (SELECT count(*) FILTER ("partition" = 'TRAIN') AS frozen_rows, count(*) AS refit_rows FROM sp WHERE module = 'consumption' AND "partition" <> 'FUTURE')
SELECT feature, frozen_rows, refit_rows, TRUE AS frozen_optimal, TRUE AS refit_optimal FROM (VALUES {", ".join(f"('{f}')" for f in schema.LINEAR_LADDER["MLR-1"])}) f(feature) CROSS JOIN n""")
def freeze_and_refit(spark, folder):
    """Each fit leaves residuals on its own rows that are at right angles to every predictor, as only the least squares do."""
    parts, labelled, frozen, refit = refitted(spark, folder, "consumption", models.linear_ladder()[0])
    names = list(schema.LINEAR_LADDER["MLR-1"])

    def angles(pipeline, df, label):
        scored = pipeline.transform(df).withColumn("residual", F.col("target") - F.col("prediction"))
        flat = [F.struct(F.lit(c).alias("feature"), (F.abs(F.sum(F.col(c) * F.col("residual"))) <= 1e-6 * F.sqrt(F.sum(F.col(c) ** 2) * F.sum(F.col("residual") ** 2))).alias(f"{label}_optimal")) for c in names]
        return scored.agg(F.count("*").alias(f"{label}_rows"), F.array(*flat).alias("f")).select(f"{label}_rows", F.inline("f"))

    return angles(frozen, parts["TRAIN"], "frozen").join(angles(refit, labelled, "refit"), "feature")


@query("score_next_period", f"""WITH {SPLITS} SELECT consumer_no, target_ord, TRUE AS in_range FROM sp WHERE module = 'anomaly' AND "partition" = 'FUTURE'""")
def score_next_period(spark, folder):
    parts, _, _, refit = refitted(spark, folder, "anomaly", models.balanced_clone(models.tree_classifier("anomaly")[2]))
    scored = models.score_next_period(refit, parts["FUTURE"], True)
    return scored.select("consumer_no", "target_ord", (F.col("probability").between(0, 1) & F.col("predicted_class").isin(0, 1)).alias("in_range"))


@query("top_importances", f"""SELECT CAST(n AS INT) AS position, TRUE AS in_range, TRUE AS not_above_before, TRUE AS known FROM range(1, 16) t(n)""")
def top_importances(spark, folder):
    """The fifteen most important entries of the feature vector: in order, shares, and each of a predictor of the module."""
    parts, _ = rows(spark, folder, "revenue")
    fitted = models.fit_pipeline(models.forest_classifier("revenue")[0], parts["TRAIN"])
    order = Window.orderBy(F.col("importance").desc(), "encoded_feature")
    known = reduce(lambda a, b: a | b, [F.col("encoded_feature").startswith(c) for c in schema.PREDICTORS["revenue"]])
    return models.top_importances(fitted, parts["TRAIN"], 15).select(
        F.row_number().over(order).alias("position"), F.col("importance").between(0, 1).alias("in_range"),
        (F.col("importance") <= F.coalesce(F.lag("importance").over(order), F.lit(1.0))).alias("not_above_before"), known.alias("known"),
    )


@query("probability_audit", f"""WITH {SPLITS} SELECT "partition" AS stage, 'DT-1' AS configuration, CAST(2 AS INT) AS classes, CAST(1 AS INT) AS class_1_column,
  count(*) AS n_rows, CAST(0 AS BIGINT) AS invalid_probabilities FROM sp WHERE module = 'anomaly' AND "partition" <> 'FUTURE' GROUP BY 1""")
def probability_audit(spark, folder):
    """Classes, class-1 position and probability range of each scored stage."""
    parts, _ = rows(spark, folder, "anomaly")
    fitted = models.fit_pipeline(models.tree_classifier("anomaly")[0], parts["TRAIN"])
    ((name, classes, position),) = models.probability_audit({fitted.name: fitted.model})
    labelled = parts["TRAIN"].unionByName(parts["VALIDATION"]).unionByName(parts["FINAL_TEST"])
    scored = models.score_classes(fitted.model, fitted.prepare(labelled))
    p = F.col("probability")
    return scored.groupBy(F.col("partition").alias("stage")).agg(
        F.lit(name).alias("configuration"),
        F.lit(classes).alias("classes"),
        F.lit(position).alias("class_1_column"),
        F.count("*").alias("n_rows"),
        F.count_if(~F.coalesce(p.between(0, 1), F.lit(False))).alias("invalid_probabilities"),
    )
