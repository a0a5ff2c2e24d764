"""Fitting, comparing, freezing and scoring with pyspark.ml.

Preprocessing is learned on the fit rows and travels with the model. Fitted vectors are stored
once per fit population, so that a grid of estimators reads them instead of rebuilding them.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow import schema
from meterflow.operators.baselines import balanced_weights, majority, persistence
from meterflow.operators.evaluate import CLASS_METRICS, REGRESSION_METRICS, comparison_table, metric_gaps, rank_models
from meterflow.operators.families import FitStore, node_table, write_cut, write_nodes
from meterflow.operators.growth import DEEPER, GROUP_ROWS, LEAF_ROWS, TOP_DEPTH, GrownModel, graft, grow_out, leaf_table, write_whole
from meterflow.operators.metrics import regression_metrics, scored_metrics
from meterflow.operators.prepare import fit_medians, fit_modes, impute
from meterflow.session import materialize, scratch_path

# Trees grown out stop at the deepest level the library supports.
FULL_DEPTH = 30
# Bootstrap samples are drawn by partition of the fit rows. So many rows make a partition, and there are so many at least: the number
# follows the fit rows alone, never the cluster or how a table is laid out.
FIT_ROWS, LEAST_PARTITIONS = 1 << 19, 12
# Nodes that all trees of a deeper fit may have, should every leaf that can be split be split to the last level.
NODES = 1 << 19


@dataclass(frozen=True)
class Configuration:
    """One entry of a comparison: a name, its family, its predictors and an unfitted estimator."""

    name: str
    algorithm: str
    features: tuple[str, ...]
    estimator: Estimator
    balanced: bool = False


def linear_ladder() -> list[Configuration]:
    """Least squares on four nested predictor sets."""
    return [
        Configuration(name, "Multiple Linear Regression", tuple(features), LinearRegression(regParam=0.0, solver="normal"))
        for name, features in schema.LINEAR_LADDER.items()
    ]


def _tree_settings(depth: int | None) -> dict:
    # With the nodes of rows kept beside them no pass sends the trees grown so far; the lineage is cut at every tenth pass.
    return {"maxDepth": depth or FULL_DEPTH, "seed": schema.MODEL_SEED, "maxMemoryInMB": 512, "cacheNodeIds": True, "checkpointInterval": 10}


def forest_regression(grid: Sequence[tuple[int, int | None]] = tuple(schema.FOREST_GRID)) -> list[Configuration]:
    return [
        Configuration(
            f"RF-{i}", "Random Forest Regressor", tuple(schema.CONSUMPTION_PREDICTORS),
            RandomForestRegressor(numTrees=trees, featureSubsetStrategy="all", **_tree_settings(depth)),
        )
        for i, (trees, depth) in enumerate(grid, start=1)
    ]


def tree_classifier(module: str, depths: Sequence[int | None] = tuple(schema.TREE_DEPTHS)) -> list[Configuration]:
    return [
        Configuration(
            f"DT-{i}", "Decision Tree", tuple(schema.PREDICTORS[module]),
            DecisionTreeClassifier(impurity="gini", **_tree_settings(depth)),
        )
        for i, depth in enumerate(depths, start=1)
    ]


def forest_classifier(module: str, grid: Sequence[tuple[int, int | None]] = tuple(schema.FOREST_GRID)) -> list[Configuration]:
    return [
        Configuration(
            f"RF-{i}", "Random Forest", tuple(schema.PREDICTORS[module]),
            RandomForestClassifier(numTrees=trees, featureSubsetStrategy="sqrt", impurity="gini", **_tree_settings(depth)),
        )
        for i, (trees, depth) in enumerate(grid, start=1)
    ]


def balanced_clone(config: Configuration) -> Configuration:
    """The same configuration with class weights, nothing else changed."""
    return Configuration(
        f"{config.name}-balanced", config.algorithm, config.features,
        config.estimator.copy({config.estimator.weightCol: "weight"}), balanced=True,
    )


def split_columns(features: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) predictors; the target month counts as a category."""
    categorical = [f for f in features if f in schema.MODEL_CATEGORIES]
    return [f for f in features if f not in categorical], categorical


@dataclass(frozen=True)
class Preprocessing:
    """Medians, modes and encoders as learned from one fit population."""

    medians: dict[str, float]
    modes: dict[str, str]
    encoders: PipelineModel | None

    def transform(self, df: DataFrame) -> DataFrame:
        """Imputed predictors, and an indicator vector `<name>_hot` for each category."""
        filled = impute(df, self.medians, self.modes)
        return self.encoders.transform(filled) if self.encoders else filled

    def columns(self, features: Sequence[str] | None = None) -> list[str]:
        """Model inputs of the given predictors, numeric ones first."""
        wanted = [*self.medians, *self.modes] if features is None else features
        return [f for f in wanted if f in self.medians] + [f"{f}_hot" for f in wanted if f in self.modes]

    def assemble(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        """Add the feature vector to transformed rows."""
        return VectorAssembler(inputCols=self.columns(features), outputCol="features").transform(df)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        learned = json.dumps({"medians": self.medians, "modes": self.modes})
        spark.createDataFrame([(learned,)], "learned string").coalesce(1).write.parquet(f"{path}/learned")
        if self.encoders:
            self.encoders.write().save(f"{path}/encoders")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Preprocessing:
        learned = json.loads(spark.read.parquet(f"{path}/learned").first().learned)
        encoders = PipelineModel.load(f"{path}/encoders") if learned["modes"] else None
        return Preprocessing(learned["medians"], learned["modes"], encoders)


def fit_preprocessing(train: DataFrame, features: Sequence[str]) -> Preprocessing:
    """Learn the imputation and encoding of the predictors from `train` alone.

    What comes to the driver has one entry per predictor. An unseen category encodes to zeros:
    the indexer keeps a last bucket for it, and the encoder drops the last bucket.
    """
    numeric, categorical = split_columns(features)
    medians = {r.feature: r.median for r in fit_medians(train, numeric).collect()}
    medians = {f: medians[f] for f in numeric}
    modes = {r.feature: r.mode for r in fit_modes(train, categorical).collect()} if categorical else {}
    modes = {f: modes[f] for f in categorical if f in modes}
    if not modes:
        return Preprocessing(medians, modes, None)
    indexed, hot = [f"{c}_index" for c in modes], [f"{c}_hot" for c in modes]
    stages = [
        StringIndexer(inputCols=list(modes), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
    ]
    return Preprocessing(medians, modes, Pipeline(stages=stages).fit(impute(train, medians, modes)))


@dataclass(frozen=True)
class FittedPipeline:
    """Preprocessing and model fitted on the same rows."""

    name: str
    features: tuple[str, ...]
    preprocessing: Preprocessing
    model: object

    def prepare(self, df: DataFrame) -> DataFrame:
        return self.preprocessing.assemble(self.preprocessing.transform(df), self.features)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.prepare(df))

    def save(self, path: str) -> None:
        """Refuses to overwrite a saved pipeline."""
        self.preprocessing.save(path)
        PipelineModel([self.model]).write().save(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str, name: str, features: Sequence[str]) -> FittedPipeline:
        model = PipelineModel.load(f"{path}/model").stages[0]
        return FittedPipeline(name, tuple(features), Preprocessing.load(spark, path), model)


_KEPT = ["consumer_no", "target_ord", "target"]


def model_inputs(preprocessing: Preprocessing, df: DataFrame) -> DataFrame:
    """Keys, target, weight when present, and the prepared predictors, stored once."""
    kept = [c for c in [*_KEPT, "partition", "weight"] if c in df.columns]
    return materialize(preprocessing.transform(df).select(*kept, *preprocessing.columns()), "inputs")


def dealt(inputs: DataFrame) -> DataFrame:
    """Rows go to their partition by key and stand in its order: the same rows give the same fit on any cluster."""
    parts = max(LEAST_PARTITIONS, -(-inputs.count() // FIT_ROWS))
    return inputs.repartition(parts, "consumer_no", "target_ord").sortWithinPartitions("consumer_no", "target_ord")


def fit_estimator(config: Configuration, preprocessing: Preprocessing, inputs: DataFrame):
    """Only a fit deals its rows by key; scores are the same in any order, so they read the stored rows as they lie."""
    if drawn_features(config, 1) is None:
        estimator = config.estimator.copy({config.estimator.labelCol: "target"})
        return estimator.fit(preprocessing.assemble(dealt(inputs), config.features))
    spark = inputs.sparkSession
    path = scratch_path(spark, "fit")
    write_grown(config, preprocessing, inputs, path)
    return FitStore(spark, path).load(path)


#: Stops and draws that `grow_out` follows.
_GROWN = {"minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "subsamplingRate": 1.0, "bootstrap": True}


def drawn_features(config: Configuration, of: int) -> int | None:
    """Features looked at in each node, for a tree or forest whose lower levels are grown apart; None for every other estimator."""
    estimator = config.estimator
    if _depth(config) <= TOP_DEPTH or any(estimator.hasParam(p) and estimator.getOrDefault(p) != v for p, v in _GROWN.items()):
        return None
    if estimator.getOrDefault("impurity") not in ("gini", "variance"):
        return None
    drawn = {"all": of, "sqrt": math.ceil(math.sqrt(of))}
    return drawn.get(estimator.getOrDefault("featureSubsetStrategy")) if estimator.hasParam("featureSubsetStrategy") else of


def upper_levels(path: str) -> str:
    """Where the fit of the upper levels of the grown model at `path` lies."""
    return f"{path}_top"


def fit_upper(config: Configuration, preprocessing: Preprocessing, inputs: DataFrame, path: str):
    """Fit and keep the upper levels of the grown model at `path`, deeper as long as a leaf has too many rows for one task.

    The whole model is fitted deeper while it has at most `NODES` nodes, which a fit holds on the driver; after that the large leaves alone.
    """
    spark, rows, source, full = inputs.sparkSession, preprocessing.assemble(dealt(inputs), config.features), upper_levels(path), _depth(config)
    trees = config.estimator.getNumTrees() if config.estimator.hasParam("numTrees") else 1
    # Where leaves of the first levels would be too large anyway, they are not tried.
    depth = min(full, TOP_DEPTH + (DEEPER if inputs.count() > LEAF_ROWS << TOP_DEPTH - 2 and trees << TOP_DEPTH + DEEPER + 1 <= NODES else 0))
    estimator = config.estimator.copy({config.estimator.labelCol: "target"})
    top, grafts, known = None, 0, 0
    while True:
        if not grafts:
            top = estimator.copy({estimator.maxDepth: depth}).fit(rows)
            top.write().overwrite().save(source)
        nodes = node_table(spark, source)
        many = nodes.where(f"rawCount > {LEAF_ROWS}").select("treeID", F.col("id").alias("root"))
        large = materialize(leaf_table(nodes, full).where("room > 0").join(many, ["treeID", "root"]), "large")
        count, open_leaves = nodes.count(), leaf_table(nodes, full).where("room > 0").count()
        # Rows that no bin tells apart stay together, however deep the fit.
        if large.isEmpty() or depth == full or count == known:
            return top
        known, depth = count, min(full, depth + DEEPER)
        if not grafts and count + (open_leaves << DEEPER + 1) <= NODES:
            continue
        # A model that reads its own files can't be written over them.
        grafts += 1
        before, source = source, f"{upper_levels(path)}_{grafts}"
        graft(top, before, large, depth, rows, estimator, source)
        write_nodes(spark, source, node_table(spark, source), depth, upper_levels(path))
        top = FitStore(spark, path).load(source)


def write_tables(config: Configuration, preprocessing: Preprocessing, inputs: DataFrame, path: str):
    """Fit the upper levels, which are returned, and write what grows below them."""
    top = fit_upper(config, preprocessing, inputs, path)
    ready = preprocessing.assemble(inputs, config.features)
    grow_out(top, upper_levels(path), _depth(config), ready, ["consumer_no", "target_ord"], config.estimator.getSeed(), drawn_features(config, top.numFeatures), path)
    return top


def write_grown(config: Configuration, preprocessing: Preprocessing, inputs: DataFrame, path: str) -> None:
    """Write the model of `config` grown out."""
    top = write_tables(config, preprocessing, inputs, path)
    write_whole(inputs.sparkSession, top, upper_levels(path), _depth(config), path)


def fit_pipeline(config: Configuration, train: DataFrame) -> FittedPipeline:
    """Learn everything, preprocessing and model, on `train`."""
    rows = balanced_weights(train) if config.balanced else train
    preprocessing = fit_preprocessing(rows, config.features)
    model = fit_estimator(config, preprocessing, model_inputs(preprocessing, rows))
    return FittedPipeline(config.name, config.features, preprocessing, model)


def score_regression(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def class_position(model, labels: Sequence | None = None, label=1) -> int:
    """Where the probability of `label` stands: among the names of an indexed label, else at its own number."""
    position = list(labels).index(label) if labels is not None else int(label)
    if not 0 <= position < model.numClasses:
        raise ValueError(f"the model knows {model.numClasses} classes and not class {label}")
    return position


def label_names(df: DataFrame, column: str = "target") -> list | None:
    """The label names in a column's metadata, where an indexer left some."""
    return df.schema[column].metadata.get("ml_attr", {}).get("vals") if column in df.columns else None


def score_classes(model, df: DataFrame) -> DataFrame:
    """Class-1 probability and the most likely class; an exact tie is class 0. A probability outside 0 to 1 stops the job."""
    p = vector_to_array(F.col("probability"))[class_position(model, label_names(df))]
    valid = F.when(p.between(0, 1), p).otherwise(F.raise_error(F.lit("class probability outside 0 to 1")).cast("double"))
    scored = model.transform(df).withColumn("probability", valid)
    return scored.withColumn("predicted_class", (F.col("probability") > 0.5).cast("int"))


def families(configs: Sequence[Configuration]) -> list[list[Configuration]]:
    """Configurations that differ in name and depth alone, the deepest first; every other one is a family by itself."""
    found: dict[str, list[Configuration]] = {}
    for config in configs:
        found.setdefault(configuration_key(config, but=("maxDepth",)), []).append(config)
    return [sorted(f, key=_depth, reverse=True) for f in found.values()]


def _depth(config: Configuration) -> int:
    return config.estimator.getMaxDepth() if config.estimator.hasParam("maxDepth") else 0


def fit_all(configs: Sequence[Configuration], preprocessing: Preprocessing, fit_rows: DataFrame, train: DataFrame, store: FitStore) -> dict[str, object]:
    """The fitted model of each configuration, by name. A family is fitted once, at its greatest depth, and cut at the others.
    Of a model grown out, the levels that were fitted are cut for the depths they hold.

    `store` keeps every model under its settings and the digest of the columns of `train` that it learns from.
    """
    digests, fitted = {}, {}
    for family in families(configs):
        deepest = family[0]
        if deepest.features not in digests:
            digests[deepest.features] = input_fingerprint(train.select(*_KEPT, *deepest.features))
        grown = drawn_features(deepest, 1) is not None
        parts = [configuration_key(deepest), FIT_ROWS, LEAST_PARTITIONS, digests[deepest.features], *([TOP_DEPTH, GROUP_ROWS, LEAF_ROWS] if grown else [])]

        def write(path: str) -> None:
            if grown:  # noqa: B023
                write_tables(deepest, preprocessing, fit_rows, path)  # noqa: B023
            else:
                fit_estimator(deepest, preprocessing, fit_rows).write().overwrite().save(path)  # noqa: B023

        source = store.keep(parts, deepest.name, write)
        for config in family:
            depth, path, whole = _depth(config), source, _depth(config) == _depth(deepest)
            cut = not whole and (not grown or depth <= TOP_DEPTH)
            if not whole:
                cut_from = upper_levels(source) if grown else source
                write_it = (lambda path: write_cut(store.spark, cut_from, depth, path)) if cut else lambda path: None  # noqa: B023
                path = store.keep([*parts, depth], config.name, write_it)
            fitted[config.name] = grown_model(store, source, _depth(deepest), path, depth) if grown and not cut else store.load(path)
    return {c.name: fitted[c.name] for c in configs}


def grown_model(store: FitStore, source: str, full: int, path: str, depth: int) -> GrownModel:
    """The model whose tables are beside `source`, or its cut at `depth`, that scores by them. Its node table is written to `path` when it is first asked for."""
    spark, upper = store.spark, upper_levels(source)

    def load(wanted: str):
        if not store.finished(f"{source}_whole"):
            write_whole(spark, store.load(upper), upper, full, source)
            spark.createDataFrame([("whole",)], "value string").coalesce(1).write.mode("overwrite").text(f"{source}_whole/done")
        if depth < full and not store.finished(f"{wanted}_whole"):
            write_cut(spark, source, depth, wanted, join=False)
            spark.createDataFrame([("cut",)], "value string").coalesce(1).write.mode("overwrite").text(f"{wanted}_whole/done")
        return store.load(wanted)

    return GrownModel(load, store.load(upper), path, source, depth)


def compare_models(
    configs: Sequence[Configuration], train: DataFrame, validation: DataFrame, classify: bool, store: FitStore | None = None
) -> tuple[DataFrame, dict[str, object]]:
    """(metrics per configuration and stage, fitted models by name).

    The predictors of all configurations are prepared and stored once: medians, modes and
    vocabularies are learned per column, so a smaller predictor set learns the same ones. The
    loop over the bounded grid runs on the driver; each fit and each scoring is a Spark job.
    All metrics come from one aggregate over the stored scores.
    """
    store = store or FitStore(train.sparkSession, scratch_path(train.sparkSession, "fits"))
    features = list(dict.fromkeys(f for c in configs for f in c.features))
    preprocessing = fit_preprocessing(train, features)
    weighted = balanced_weights(train) if classify else train
    fit_rows = model_inputs(preprocessing, weighted.withColumn("partition", F.lit("TRAIN")))
    other = model_inputs(preprocessing, validation.withColumn("partition", F.lit("VALIDATION")))
    both = fit_rows.drop("weight").unionByName(other)
    fitted, scored = fit_all(configs, preprocessing, fit_rows, train, store), []
    for pos, config in enumerate(configs, start=1):
        model = fitted[config.name]
        ready = preprocessing.assemble(both, config.features)
        out = score_classes(model, ready) if classify else score_regression(model, ready)
        scored.append(
            materialize(
                out.select(
                    F.lit(pos).alias("pos"),
                    F.lit(config.name).alias("configuration"),
                    F.lit(config.algorithm).alias("algorithm"),
                    F.col("partition").alias("stage"),
                    "target",
                    *(["probability", "predicted_class"] if classify else ["prediction"]),
                ),
                "scores",
            )
        )
    return stage_metrics(reduce(DataFrame.unionByName, scored), classify), fitted


def stage_metrics(rows: DataFrame, classify: bool) -> DataFrame:
    """Metrics of scored rows for each configuration and stage."""
    group = ["pos", "configuration", "algorithm", "stage"]
    if classify:
        return scored_metrics(rows, "target", "predicted_class", "probability", group)
    return regression_metrics(rows, "target", "prediction", group)


def baseline_metrics(train: DataFrame, validation: DataFrame, classify: bool) -> DataFrame:
    """Metrics of the prediction that needs no fit: the majority of TRAIN, or this month's value."""
    both = train.withColumn("stage", F.lit("TRAIN")).unionByName(validation.withColumn("stage", F.lit("VALIDATION")))
    scored = majority(train, both) if classify else persistence(both)
    name, algorithm = ("TRAIN-majority", "Constant baseline") if classify else ("Persistence", "Persistence baseline")
    return stage_metrics(scored.withColumns({"pos": F.lit(0), "configuration": F.lit(name), "algorithm": F.lit(algorithm)}), classify)


def settings_table(spark: SparkSession, configs: Sequence[Configuration]) -> DataFrame:
    """(configuration, class_weight, hyperparameters, features) of each configuration; hyperparameters are those set to fit it."""

    def described(config: Configuration) -> str:
        chosen = {p.name: v for p, v in config.estimator.extractParamMap().items() if config.estimator.isSet(p) and p.name != "weightCol"}
        return "; ".join(f"{k}={v}" for k, v in sorted(chosen.items()))

    rows = [(c.name, "balanced" if c.balanced else "None", described(c), "; ".join(c.features)) for c in configs]
    return spark.createDataFrame(rows, "configuration string, class_weight string, hyperparameters string, features string")


def full_comparison(
    configs: Sequence[Configuration], train: DataFrame, validation: DataFrame, classify: bool, rule: Sequence[tuple[str, bool]], gap: str | None = None, store: FitStore | None = None
) -> tuple[DataFrame, list[Configuration]]:
    """(the table of a module, its configurations): baseline, grid, and for classes one balanced clone of the best of each family of algorithms.

    A row has the settings, the metrics of both stages, the gaps between them, and its position under `rule`; the baseline has none.
    """
    spark = train.sparkSession
    store = store or FitStore(spark, scratch_path(spark, "fits"))
    grid = list(configs)
    metrics = materialize(compare_models(grid, train, validation, classify, store)[0], "metrics")
    if classify:
        ranked = rank_models(comparison(metrics, True), rule, gap)
        leaders = {r.c for r in ranked.groupBy("algorithm").agg(F.min_by("configuration", "position").alias("c")).collect()}
        clones = [balanced_clone(c) for c in grid if c.name in leaders]
        more = materialize(compare_models(clones, train, validation, True, store)[0], "metrics")
        metrics = metrics.unionByName(more.withColumn("pos", F.col("pos") + len(grid)))
        grid += clones
    ranked = rank_models(comparison(metrics, classify), rule, gap)
    baseline = comparison(baseline_metrics(train, validation, classify), classify)
    table = ranked.unionByName(baseline, allowMissingColumns=True).join(settings_table(spark, grid), "configuration", "left")
    no_fit = F.col("pos") == 0
    used = "None" if classify else "current_consumption"
    return table.withColumns({"hyperparameters": F.when(no_fit, "None").otherwise(F.col("hyperparameters")), "class_weight": F.coalesce("class_weight", F.lit("None")), "features": F.when(no_fit, used).otherwise(F.col("features"))}), grid


def comparison(metrics: DataFrame, classify: bool) -> DataFrame:
    """One row per configuration with both stages and the gaps between them."""
    names = CLASS_METRICS if classify else REGRESSION_METRICS
    return metric_gaps(comparison_table(metrics, ["pos", "configuration", "algorithm"], names), names)


def probability_audit(models: dict[str, object]) -> list[tuple[str, int, int]]:
    """(configuration, classes, position of class 1) from the fitted models."""
    return [(name, model.numClasses, class_position(model)) for name, model in models.items()]


def vector_names(df: DataFrame) -> list[str]:
    """Names of the entries of the feature vector, from its column metadata."""
    attributes = df.schema["features"].metadata["ml_attr"]["attrs"]
    listed = [a for group in attributes.values() for a in group]
    return [a["name"] for a in sorted(listed, key=lambda a: a["idx"])]


def top_importances(pipeline: FittedPipeline, df: DataFrame, n: int = 15) -> DataFrame:
    """The n features with the largest importance; one entry per vector position."""
    names = vector_names(pipeline.prepare(df))
    values = pipeline.model.featureImportances.toArray().tolist()
    table = df.sparkSession.createDataFrame(list(zip(names, values)), "encoded_feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "encoded_feature").limit(n)


def input_fingerprint(df: DataFrame) -> str:
    """Content hash of a table, independent of row order: count and two sums of row hashes.

    The hash skips missing values, so where they stand is hashed as well.
    """
    columns = sorted(df.columns)
    missing = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    row = df.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(missing, *columns).cast("decimal(38,0)")).alias("a"),
        F.sum(F.xxhash64(F.lit(1), missing, *columns).cast("decimal(38,0)")).alias("b"),
    ).first()
    return f"{row.n}:{row.a}:{row.b}"


def configuration_key(config: Configuration, but: Sequence[str] = ()) -> str:
    """Everything that decides a fit: class, every parameter but those named in `but`, predictors and weights. The name does not."""
    estimator = config.estimator
    settings = {p.name: str(v) for p, v in estimator.extractParamMap().items() if p.name not in but}
    return json.dumps([config.algorithm, type(estimator).__name__, settings, list(config.features), config.balanced], sort_keys=True)


def resume_comparison(
    path: str, configs: Sequence[Configuration], train: DataFrame, validation: DataFrame, classify: bool
) -> tuple[DataFrame, list[str]]:
    """(the comparison kept under `path`, the names of the models that had to be made for it).

    The table is reused while the inputs and the grid are the same. Every model is stored by itself as soon as it is fitted, so a run that broke off goes on
    with the next one, and other settings, weights or rows refit only what they touch.
    """
    spark = train.sparkSession
    known = [[c.name, configuration_key(c)] for c in configs]
    store = FitStore(spark, f"{path}/fits")
    home = f"{path}/tables/{store.home([known, classify, FIT_ROWS, LEAST_PARTITIONS, TOP_DEPTH, input_fingerprint(train), input_fingerprint(validation)]).rsplit('/', 1)[-1]}"
    if not store.finished(home):
        metrics, _ = compare_models(configs, train, validation, classify, store)
        comparison(metrics, classify).write.mode("overwrite").parquet(f"{home}/comparison")
        # Written last: its presence says that the table is complete.
        spark.createDataFrame([("comparison",)], "value string").coalesce(1).write.mode("overwrite").text(f"{home}/done")
    return spark.read.parquet(f"{home}/comparison"), store.made


def freeze_and_refit(config: Configuration, train: DataFrame, labelled: DataFrame, path: str) -> tuple[FittedPipeline, FittedPipeline]:
    """Save the pipeline fitted on TRAIN, then refit the same settings on all labelled rows."""
    frozen = fit_pipeline(config, train)
    frozen.save(f"{path}/frozen")
    refitted = fit_pipeline(config, labelled)
    before = {p.name: v for p, v in frozen.model.extractParamMap().items()}
    after = {p.name: v for p, v in refitted.model.extractParamMap().items()}
    if before != after:
        raise AssertionError("the refit changed a parameter")
    refitted.save(f"{path}/refit")
    return frozen, refitted


def score_next_period(pipeline: FittedPipeline, future: DataFrame, classify: bool) -> DataFrame:
    """One prediction per consumer of the next period."""
    rows, keys = pipeline.prepare(future), ["consumer_no", "target_ord"]
    if classify:
        return score_classes(pipeline.model, rows).select(*keys, "predicted_class", "probability")
    return score_regression(pipeline.model, rows).select(*keys, "prediction")
