"""Split, preparation, baseline, metric and evaluation queries.

The comparison tables come from rule scores on P1, which both engines can compute; the fitted
models are in catalog.models.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import SPLITS, query
from catalog.features import built
from meterflow import schema
from meterflow.operators import baselines, evaluate, metrics, prepare, splits
from meterflow.session import materialize, scratch_path
from meterflow.sources import tables
from meterflow.sources.bindings import P1_BOUNDS

NUMERIC = [c for c in schema.CONSUMPTION_PREDICTORS if c not in schema.MODEL_CATEGORIES]
CATEGORIES = schema.MODEL_CATEGORIES


def split(spark, folder):
    return splits.chronological_split(built(spark, folder), P1_BOUNDS)


def stored_split(spark, folder, *columns):
    """The split of all modules, stored for queries that read it more than once."""
    kept = ["module", "partition", "consumer_no", "ord", "target_ord", "target", *columns]
    return materialize(split(spark, folder).select(*kept), "splits")


def module(spark, folder, name):
    return splits.module_rows(built(spark, folder), P1_BOUNDS, name)


# --- splits ----------------------------------------------------------------------------

@query("chronological_split", f"""WITH {SPLITS} SELECT module, "partition", consumer_no, ord, target_ord, target FROM sp""")
def chronological_split(spark, folder):
    return split(spark, folder).select("module", "partition", "consumer_no", "ord", "target_ord", "target")


@query("split_summary", f"""WITH {SPLITS}, w AS (SELECT *, "partition" = 'FUTURE' OR target IS NOT NULL AS kept FROM sp_window WHERE "partition" IS NOT NULL)
SELECT module, "partition", CAST(CASE "partition" WHEN 'TRAIN' THEN 23941 WHEN 'VALIDATION' THEN 24006 WHEN 'FINAL_TEST' THEN 24015 ELSE 24023 END AS INT) AS window_start,
  CAST(CASE "partition" WHEN 'TRAIN' THEN 24005 WHEN 'VALIDATION' THEN 24014 WHEN 'FINAL_TEST' THEN 24022 ELSE 24023 END AS INT) AS window_end,
  count(*) AS rows_before_target_filter, count(*) FILTER (kept) AS n_rows, count(DISTINCT consumer_no) FILTER (kept) AS unique_consumers,
  min(target_ord) FILTER (kept) AS min_target_ord, max(target_ord) FILTER (kept) AS max_target_ord, count(*) FILTER (NOT kept) AS excluded_target_unavailable,
  count(target) AS known_targets, CASE WHEN module = 'consumption' THEN avg(target) END AS mean, CASE WHEN module = 'consumption' THEN stddev_samp(target) END AS sd,
  CASE WHEN module = 'consumption' THEN quantile_cont(target, 0.25) END AS q1, CASE WHEN module = 'consumption' THEN quantile_cont(target, 0.5) END AS median,
  CASE WHEN module = 'consumption' THEN quantile_cont(target, 0.75) END AS q3,
  CASE WHEN module = 'consumption' THEN min(target) END AS minimum, CASE WHEN module = 'consumption' THEN max(target) END AS maximum,
  count(*) FILTER (kept AND target IS NULL) AS missing_targets_retained,
  CASE WHEN module <> 'consumption' AND "partition" <> 'FUTURE' THEN 100.0 * count(*) FILTER (target = 0) / CAST(count(target) AS DOUBLE) END AS class_0_percent,
  CASE WHEN module <> 'consumption' AND "partition" <> 'FUTURE' THEN count(*) FILTER (target = 0) END AS class_0,
  CASE WHEN module <> 'consumption' AND "partition" <> 'FUTURE' THEN count(*) FILTER (target = 1) END AS class_1,
  CASE WHEN module <> 'consumption' AND "partition" <> 'FUTURE' THEN 100.0 * count(*) FILTER (target = 1) / CAST(count(target) AS DOUBLE) END AS class_1_percent
FROM w GROUP BY module, "partition" """, ["mean", "sd", "q1", "median", "q3", "class_0_percent", "class_1_percent"])
def split_summary(spark, folder):
    rows = splits.windowed(built(spark, folder), P1_BOUNDS).select("module", "partition", "target", "target_ord", "consumer_no")
    return splits.split_summary(materialize(rows, "windows"), P1_BOUNDS)


@query("partition_disjointness", f"""WITH {SPLITS} SELECT module, count(DISTINCT target_ord) AS target_months, CAST(0 AS BIGINT) AS shared_months,
  CAST(0 AS BIGINT) AS rows_outside_window, CAST(0 AS BIGINT) AS windows_out_of_order, CAST(0 AS BIGINT) AS labelled_future_rows FROM sp GROUP BY module""")
def partition_disjointness(spark, folder):
    return splits.partition_disjointness(stored_split(spark, folder), P1_BOUNDS)


@query("labelled_history", f"""WITH {SPLITS} SELECT module, consumer_no, target_ord, target FROM sp WHERE "partition" <> 'FUTURE'""")
def labelled_history(spark, folder):
    return splits.labelled_history(split(spark, folder)).select("module", "consumer_no", "target_ord", "target")


@query("write_partitions", f"""WITH {SPLITS} SELECT module, "partition", count(*) AS n_rows, CAST(sum(target) AS BIGINT) AS target_total FROM sp GROUP BY 1, 2""")
def write_partitions(spark, folder):
    path = scratch_path(spark, "splits")
    tables.write_partitions(split(spark, folder), path)
    return spark.read.parquet(path).groupBy("module", "partition").agg(
        F.count("*").alias("n_rows"), F.sum("target").cast("bigint").alias("target_total")
    )


# --- preparation -------------------------------------------------------------------------

_TR = """{0}, tr AS (SELECT * FROM sp WHERE module = '{1}' AND "partition" = 'TRAIN')"""
TRAIN_SQL = _TR.format(SPLITS, "consumption")


def fit_rows(spark, folder, name="consumption"):
    """TRAIN rows of a module, stored for the fits that pass over them repeatedly."""
    rows = module(spark, folder, name).filter(F.col("partition") == "TRAIN")
    return materialize(rows.select("consumer_no", "target_ord", "target", *schema.PREDICTORS[name]), "train")


_MEDIANS = " UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0) AS median FROM tr" for c in NUMERIC)


@query("median_imputer", f"WITH {TRAIN_SQL} {_MEDIANS}", ["median"])
def median_imputer(spark, folder):
    return prepare.fit_medians(fit_rows(spark, folder), NUMERIC)


_CATS = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category FROM tr" for c in CATEGORIES)


@query("mode_imputer", f"""WITH {TRAIN_SQL}, c AS ({_CATS}), g AS (SELECT feature, category, count(*) AS n FROM c GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, category) AS i FROM g) SELECT feature, category AS mode, n FROM r WHERE i = 1""")
def mode_imputer(spark, folder):
    return prepare.fit_modes(fit_rows(spark, folder), CATEGORIES)


_HOT = {"tarrif": ["AFRICA", "AMERICA", "ASIA", "EUROPE"], "solar_consumer": ["N", "Y"]}


@query("one_hot", f"""WITH {SPLITS} SELECT consumer_no, ord, {", ".join(f"CAST({c} = '{v}' AS INT) AS \"{c}={v}\"" for c, vs in _HOT.items() for v in vs)}
FROM sp WHERE module = 'consumption'""")
def one_hot(spark, folder):
    """One region is left out of the vocabulary: its rows must be all zeros."""
    encoded = prepare.one_hot(module(spark, folder, "consumption"), _HOT)
    return encoded.select("consumer_no", "ord", *[f"`{c}={v}`" for c, vs in _HOT.items() for v in vs])


@query("preprocessing_audit", f"""WITH {TRAIN_SQL}, c AS ({_CATS})
SELECT feature, 'numeric median' AS statistic, median AS value, '' AS category, 'TRAIN_ONLY' AS stage, (SELECT count(*) FROM tr) AS fit_rows FROM ({_MEDIANS})
UNION ALL SELECT DISTINCT feature, 'category vocabulary', CAST(NULL AS DOUBLE), category, 'TRAIN_ONLY', (SELECT count(*) FROM tr) FROM c""", ["value"])
def preprocessing_audit(spark, folder):
    return prepare.preprocessing_audit(fit_rows(spark, folder), NUMERIC, CATEGORIES, "TRAIN_ONLY")


# --- baselines -----------------------------------------------------------------------------

@query("persistence_baseline", f"""WITH {SPLITS} SELECT "partition", consumer_no, target_ord, target, current_consumption AS prediction FROM sp WHERE module = 'consumption'""")
def persistence_baseline(spark, folder):
    rows = baselines.persistence(module(spark, folder, "consumption"))
    return rows.select("partition", "consumer_no", "target_ord", "target", "prediction")


@query("majority_baseline", f"""WITH {SPLITS}, m AS (SELECT module AS name, CAST(CASE WHEN count(*) FILTER (target = 1) > count(*) FILTER (target = 0) THEN 1 ELSE 0 END AS INT) AS predicted_class, avg(target) AS probability
  FROM sp WHERE "partition" = 'TRAIN' AND module <> 'consumption' GROUP BY module)
SELECT module, "partition", consumer_no, target_ord, target, predicted_class, probability FROM sp JOIN m ON m.name = sp.module""", ["probability"])
def majority_baseline(spark, folder):
    rows = stored_split(spark, folder)
    parts = []
    for name in ("revenue", "anomaly"):
        own = rows.filter(F.col("module") == name)
        parts.append(baselines.majority(own.filter(F.col("partition") == "TRAIN"), own))
    return reduce(DataFrame.unionByName, parts).select("module", "partition", "consumer_no", "target_ord", "target", "predicted_class", "probability")


@query("balanced_weights", f"""WITH {_TR.format(SPLITS, "revenue")}, c AS (SELECT target AS t, count(*) AS n FROM tr GROUP BY target)
SELECT consumer_no, target_ord, target, (SELECT count(*) FROM tr) / (2.0 * n) AS weight FROM tr JOIN c ON c.t = tr.target""", ["weight"])
def balanced_weights(spark, folder):
    rows = baselines.balanced_weights(fit_rows(spark, folder, "revenue"))
    return rows.select("consumer_no", "target_ord", "target", "weight")


# --- rule scores -----------------------------------------------------------------------------

RULES = [
    (1, "PAY-1", "Payment rule"),
    (2, "PAY-2", "Payment rule"),
    (3, "USE-1", "Use rule"),
    (4, "USE-2", "Use rule"),
]
# Scores of the rules above as text that both engines read.
_RULE_SQL = {
    "PAY-1": "1 - least(1, coalesce(payment_ratio_current, 0))",
    "PAY-2": "1 - least(1, coalesce(payment_ratio_mean3, payment_ratio_current, 0))",
    "USE-1": "coalesce(current_consumption / (current_consumption + prior_mean), CAST(0.5 AS DOUBLE))",
    "USE-2": "coalesce(recent_std_3 / (recent_std_3 + recent_mean_3), CAST(0 AS DOUBLE))",
}
SCORED = (
    SPLITS
    + f""",
rules AS (SELECT module, "partition" AS stage, consumer_no, ord, target_ord, CAST(target AS INT) AS y, CAST(x.pos AS INT) AS pos, x.configuration, x.algorithm, x.p
  FROM sp, LATERAL (VALUES {", ".join(f"({i}, '{n}', '{f}', {_RULE_SQL[n]})" for i, n, f in RULES)}) x(pos, configuration, algorithm, p)
  WHERE module <> 'consumption' AND "partition" <> 'FUTURE'),
prev AS (SELECT module, avg(target) AS prev, CAST(CASE WHEN avg(target) > 0.5 THEN 1 ELSE 0 END AS INT) AS majority
  FROM sp WHERE "partition" = 'TRAIN' AND module <> 'consumption' GROUP BY module),
sc AS (
  SELECT module, stage, consumer_no, ord, target_ord, y, pos, configuration, algorithm, p, CAST(p > 0.5 AS INT) AS label FROM rules
  UNION ALL SELECT r.module, stage, consumer_no, ord, target_ord, y, pos + 10, configuration || '-balanced', algorithm,
    (p / prev) / (p / prev + (1 - p) / (1 - prev)), CAST((p / prev) / (p / prev + (1 - p) / (1 - prev)) > 0.5 AS INT) FROM rules r JOIN prev ON prev.module = r.module
  UNION ALL SELECT sp.module, "partition", consumer_no, ord, target_ord, CAST(target AS INT), CAST(0 AS INT), 'TRAIN-majority', 'Constant baseline', prev, majority
    FROM sp JOIN prev ON prev.module = sp.module WHERE "partition" <> 'FUTURE')
"""
)
GROUP = ["module", "stage", "pos", "configuration", "algorithm"]
POSITION, RULE = ["module", "stage", "pos"], ["module", "stage", "configuration"]


_SCORED_COLUMNS = ["payment_ratio_current", "payment_ratio_mean3", "current_consumption", "prior_mean", "recent_std_3", "recent_mean_3"]


RULE_NAMES = {0: ("TRAIN-majority", "Constant baseline")} | {i + k: (n + end, f) for i, n, f in RULES for k, end in ((0, ""), (10, "-balanced"))}


def with_names(df):
    """The names of the rules at their positions: no row is grouped, sorted or stored by a text that follows from a number."""
    named = [F.create_map(*[F.lit(x) for pos, names in RULE_NAMES.items() for x in (pos, names[k])]) for k in (0, 1)]
    return df.withColumns({"configuration": named[0][F.col("pos")], "algorithm": named[1][F.col("pos")]})


def scored_rules(spark, folder):
    return with_names(scored_positions(spark, folder))


def scored_positions(spark, folder, names=("revenue", "anomaly"), stored=None):
    """Rule scores, balanced scores and the majority baseline of the labelled rows, by the positions of the rules.

    The split is stored once, because each module reads it for its baseline and its scores.
    """
    stored = stored_split(spark, folder, *_SCORED_COLUMNS) if stored is None else stored
    every = splits.labelled_history(stored)
    parts = []
    for name in names:
        rows = every.filter(F.col("module") == name)
        base = baselines.majority_row(rows.filter(F.col("partition") == "TRAIN")).select(
            F.struct("majority_class", "prevalence")
        ).scalar()
        prevalence = base.getField("prevalence")
        scores = [(i, F.expr(_RULE_SQL[n]).cast("double")) for i, n, _ in RULES]

        def balanced(p):
            one, zero = p / prevalence, (1 - p) / (1 - prevalence)
            return one / (one + zero)

        options = [F.struct(F.lit(i).alias("pos"), p.alias("p")) for i, p in scores]
        options += [F.struct(F.lit(i + 10).alias("pos"), balanced(p).alias("p")) for i, p in scores]
        keys = ["module", F.col("partition").alias("stage"), "consumer_no", "ord", "target_ord", F.col("target").cast("int").alias("y")]
        ruled = rows.select(*keys, F.inline(F.array(*options))).withColumn("label", (F.col("p") > 0.5).cast("int"))
        baseline = rows.select(*keys, F.lit(0).alias("pos"), prevalence.alias("p"), base.getField("majority_class").alias("label"))
        parts.append(ruled.unionByName(baseline))
    return reduce(DataFrame.unionByName, parts)


_DIV = "coalesce(CAST({0} AS DOUBLE) / nullif({1}, 0), 0)"
CLASS_SQL = (
    SCORED
    + f""",
cc AS (SELECT module, stage, pos, configuration, algorithm, count(*) AS sample_count,
  count(*) FILTER (y = 0 AND label = 0) AS true_0_predicted_0, count(*) FILTER (y = 0 AND label = 1) AS true_0_predicted_1,
  count(*) FILTER (y = 1 AND label = 0) AS true_1_predicted_0, count(*) FILTER (y = 1 AND label = 1) AS true_1_predicted_1
  FROM sc GROUP BY ALL),
cm AS (SELECT *, {_DIV.format('true_0_predicted_0 + true_1_predicted_1', 'sample_count')} AS "Accuracy",
  true_0_predicted_0 + true_0_predicted_1 AS class_0_count, true_1_predicted_0 + true_1_predicted_1 AS class_1_count,
  100.0 * (true_0_predicted_0 + true_0_predicted_1) / CAST(sample_count AS DOUBLE) AS class_0_percent,
  100.0 * (true_1_predicted_0 + true_1_predicted_1) / CAST(sample_count AS DOUBLE) AS class_1_percent,
  true_0_predicted_0 + true_1_predicted_0 AS predicted_class_0, true_0_predicted_1 + true_1_predicted_1 AS predicted_class_1,
  {_DIV.format('true_0_predicted_0', '(true_0_predicted_0 + true_1_predicted_0)')} AS "Precision_0",
  {_DIV.format('true_1_predicted_1', '(true_0_predicted_1 + true_1_predicted_1)')} AS "Precision_1",
  {_DIV.format('true_0_predicted_0', '(true_0_predicted_0 + true_0_predicted_1)')} AS "Recall_0",
  {_DIV.format('true_1_predicted_1', '(true_1_predicted_0 + true_1_predicted_1)')} AS "Recall_1",
  {_DIV.format('2 * true_0_predicted_0', '(2 * true_0_predicted_0 + true_0_predicted_1 + true_1_predicted_0)')} AS "F1_0",
  {_DIV.format('2 * true_1_predicted_1', '(2 * true_1_predicted_1 + true_0_predicted_1 + true_1_predicted_0)')} AS "F1_1" FROM cc)
"""
)
RANK_SQL = (
    CLASS_SQL
    + """,
st AS (SELECT module, stage, pos, configuration, algorithm, p, CAST(count(*) FILTER (y = 1) AS DOUBLE) AS a, CAST(count(*) FILTER (y = 0) AS DOUBLE) AS b FROM sc GROUP BY ALL),
cu AS (SELECT *, sum(a) OVER w AS tp, sum(b) OVER w AS fp, sum(a) OVER g AS np, sum(b) OVER g AS nn FROM st
  WINDOW w AS (PARTITION BY module, stage, configuration ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), g AS (PARTITION BY module, stage, configuration)),
rk AS (SELECT module, stage, configuration, sum(a * (nn - fp + b / 2)) / (max(np) * max(nn)) AS "ROC_AUC", sum(a * tp / (tp + fp)) / max(np) AS "AP" FROM cu GROUP BY ALL),
am AS (SELECT cm.*, "ROC_AUC", "AP" FROM cm JOIN rk ON rk.module = cm.module AND rk.stage = cm.stage AND rk.configuration = cm.configuration)
"""
)
_CM_FLOATS = ["Accuracy", "class_0_percent", "class_1_percent", "Precision_0", "Precision_1", "Recall_0", "Recall_1", "F1_0", "F1_1"]


@query("classification_metrics", f"WITH {CLASS_SQL} SELECT * FROM cm", _CM_FLOATS)
def classification_metrics(spark, folder):
    return metrics.classification_metrics(scored_rules(spark, folder), "y", "label", GROUP)


@query("roc_auc", f"""WITH {RANK_SQL} SELECT module, stage, configuration, "ROC_AUC" FROM rk""", ["ROC_AUC"])
def roc_auc(spark, folder):
    return with_names(metrics.roc_auc(scored_positions(spark, folder), "y", "p", POSITION)).select(*RULE, "ROC_AUC")


@query("average_precision", f"""WITH {RANK_SQL} SELECT module, stage, configuration, "AP" FROM rk""", ["AP"])
def average_precision(spark, folder):
    return with_names(metrics.average_precision(scored_positions(spark, folder), "y", "p", POSITION)).select(*RULE, "AP")


@query("roc_points", f"""WITH {RANK_SQL} SELECT module, stage, configuration, p, fp / nn AS fpr, tp / np AS tpr FROM cu
UNION ALL SELECT DISTINCT module, stage, configuration, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM cu""", ["p", "fpr", "tpr"], 9)
def roc_points(spark, folder):
    return with_names(metrics.roc_points(scored_positions(spark, folder), "y", "p", POSITION)).select(*RULE, "p", "fpr", "tpr")


@query("confusion_matrix", f"""WITH {SCORED}
SELECT module, stage, configuration, CAST(a AS INT) AS actual, CAST(b AS INT) AS predicted, count(*) FILTER (y = a AND label = b) AS n
FROM sc, range(2) x(a), range(2) z(b) GROUP BY ALL""")
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(scored_rules(spark, folder), "y", "label", ["module", "stage", "configuration"])


@query("class_distribution", f"""WITH {SPLITS}, l AS (SELECT module, "partition", target FROM sp WHERE module <> 'consumption' AND target IS NOT NULL),
g AS (SELECT module, "partition", count(*) AS d, count(*) FILTER (target = 0) AS z, count(*) FILTER (target = 1) AS o FROM l GROUP BY 1, 2)
SELECT module, "partition", CAST(0 AS INT) AS class, z AS n, 100.0 * z / CAST(d AS DOUBLE) AS percent FROM g
UNION ALL SELECT module, "partition", 1, o, 100.0 * o / CAST(d AS DOUBLE) FROM g""", ["percent"])
def class_distribution(spark, folder):
    labelled = splits.labelled_history(split(spark, folder)).filter("module <> 'consumption'")
    return metrics.class_distribution(labelled, ["module", "partition"], "target")


# --- regression rules ---------------------------------------------------------------------------

FORECASTS = [
    (0, "Persistence", "Persistence baseline", "current_consumption"),
    (1, "LAG-1", "Lag rule", "coalesce(consumption_lag1, current_consumption)"),
    (2, "LAG-11", "Lag rule", "coalesce(same_month_last_year, current_consumption)"),
    (3, "MEAN-3", "Mean rule", "coalesce(recent_mean_3, current_consumption)"),
    (4, "MEAN-ALL", "Mean rule", "coalesce(prior_mean, current_consumption)"),
]
FORECAST_CTES = f""",
fc AS (SELECT module, "partition" AS stage, consumer_no, target_ord, target AS y, CAST(x.pos AS INT) AS pos, x.configuration, x.algorithm, x.p
  FROM sp, LATERAL (VALUES {", ".join(f"({i}, '{n}', '{f}', {e})" for i, n, f, e in FORECASTS)}) x(pos, configuration, algorithm, p)
  WHERE module = 'consumption' AND "partition" <> 'FUTURE'),
rm AS (SELECT module, stage, pos, configuration, algorithm, count(*) AS sample_count, avg(abs(y - p)) AS "MAE", sqrt(avg((y - p) * (y - p))) AS "RMSE",
  1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)) AS "R2" FROM fc GROUP BY ALL)
"""
FORECAST_SQL = SPLITS + FORECAST_CTES


_FORECAST_COLUMNS = ["current_consumption", "consumption_lag1", "same_month_last_year", "recent_mean_3", "prior_mean"]


def forecasts(spark, folder, stored=None):
    rows = module(spark, folder, "consumption") if stored is None else stored.filter("module = 'consumption'")
    rows = splits.labelled_history(rows)
    options = [
        F.struct(F.lit(i).alias("pos"), F.lit(n).alias("configuration"), F.lit(f).alias("algorithm"), F.expr(e).alias("p"))
        for i, n, f, e in FORECASTS
    ]
    return rows.select(
        "module", F.col("partition").alias("stage"), "consumer_no", "target_ord", F.col("target").alias("y"), F.inline(F.array(*options))
    )


@query("regression_metrics", f"WITH {FORECAST_SQL} SELECT * FROM rm", ["MAE", "RMSE", "R2"])
def regression_metrics(spark, folder):
    return metrics.regression_metrics(forecasts(spark, folder), "y", "p", GROUP)


def _wide_sql(source: str, names: list[str], keys: str = "module, pos, configuration, algorithm") -> str:
    columns = ", ".join(f"max(\"{n}\") FILTER (stage = '{s}') AS \"{s}_{n}\"" for s in ("TRAIN", "VALIDATION") for n in names)
    return f"SELECT {keys}, {columns} FROM {source} WHERE stage IN ('TRAIN', 'VALIDATION') GROUP BY {keys}"


KEYS = ["module", "pos", "configuration", "algorithm"]
_R_WIDE = _wide_sql("rm", evaluate.REGRESSION_METRICS)
_C_WIDE = _wide_sql("am", evaluate.CLASS_METRICS)


def regression_comparison(spark, folder):
    long = metrics.regression_metrics(forecasts(spark, folder), "y", "p", GROUP)
    return evaluate.comparison_table(long, KEYS, evaluate.REGRESSION_METRICS)


def class_metrics_long(spark, folder, stored=None, names=("revenue", "anomaly")):
    """Both kinds of metrics, a row for each rule and stage: stored, because comparisons read them more than once."""
    scored = scored_positions(spark, folder, names, stored)
    return materialize(with_names(metrics.scored_metrics(scored, "y", "label", "p", POSITION)), "metrics")


def class_comparison(spark, folder, names=("revenue", "anomaly")):
    long = class_metrics_long(spark, folder, names=names)
    return evaluate.comparison_table(long, KEYS, evaluate.CLASS_METRICS)


def _staged(names):
    return [f"{s}_{n}" for s in ("TRAIN", "VALIDATION") for n in names]


@query("rank_models_rmse", f"""WITH {FORECAST_SQL}, w AS ({_R_WIDE})
SELECT *, CAST(row_number() OVER (ORDER BY "VALIDATION_RMSE", "VALIDATION_MAE", pos) AS INT) AS position FROM w WHERE configuration <> 'Persistence'""", _staged(evaluate.REGRESSION_METRICS))
def rank_models_rmse(spark, folder):
    candidates = regression_comparison(spark, folder).filter("configuration <> 'Persistence'")
    return evaluate.rank_models(candidates, evaluate.RANK_RMSE)


RANKED_AUC = f"""ra AS (SELECT *, greatest("TRAIN_ROC_AUC" - "VALIDATION_ROC_AUC", 0) AS overfit_gap FROM w WHERE configuration <> 'TRAIN-majority' AND module = 'revenue'),
rr AS (SELECT *, CAST(row_number() OVER (ORDER BY "VALIDATION_ROC_AUC" DESC, "VALIDATION_F1_1" DESC, "VALIDATION_F1_0" DESC, overfit_gap, pos) AS INT) AS position FROM ra)"""
RANKED_F1 = f"""fa AS (SELECT *, greatest("TRAIN_F1_1" - "VALIDATION_F1_1", 0) AS overfit_gap FROM w WHERE configuration <> 'TRAIN-majority' AND module = 'anomaly'),
fr AS (SELECT *, CAST(row_number() OVER (ORDER BY "VALIDATION_F1_1" DESC, "VALIDATION_Recall_1" DESC, "VALIDATION_Precision_1" DESC, "VALIDATION_AP" DESC, "VALIDATION_ROC_AUC" DESC, overfit_gap, pos) AS INT) AS position FROM fa)"""


def ranked(spark, folder, name, comparison=None):
    comparison = class_comparison(spark, folder, [name]) if comparison is None else comparison.filter(F.col("module") == name)
    candidates = comparison.filter("configuration <> 'TRAIN-majority'")
    rule, gap = (evaluate.RANK_AUC, "ROC_AUC") if name == "revenue" else (evaluate.RANK_F1, "F1_1")
    return evaluate.rank_models(candidates, rule, gap)


_C_FLOATS = [*_staged(evaluate.CLASS_METRICS), "overfit_gap"]


@query("rank_models_auc", f"WITH {RANK_SQL}, w AS ({_C_WIDE}), {RANKED_AUC} SELECT * FROM rr", _C_FLOATS)
def rank_models_auc(spark, folder):
    return ranked(spark, folder, "revenue")


@query("rank_models_f1", f"WITH {RANK_SQL}, w AS ({_C_WIDE}), {RANKED_F1} SELECT * FROM fr", _C_FLOATS)
def rank_models_f1(spark, folder):
    return ranked(spark, folder, "anomaly")


@query("change_columns", f"""WITH {FORECAST_SQL}, w AS ({_R_WIDE}) SELECT *, {", ".join(f'"VALIDATION_{n}" - "TRAIN_{n}" AS "VALIDATION_minus_TRAIN_{n}"' for n in evaluate.REGRESSION_METRICS)} FROM w""",
    [*_staged(evaluate.REGRESSION_METRICS), *[f"VALIDATION_minus_TRAIN_{n}" for n in evaluate.REGRESSION_METRICS]])
def change_columns(spark, folder):
    return evaluate.metric_gaps(regression_comparison(spark, folder), evaluate.REGRESSION_METRICS)


@query("best_by_metric", f"""WITH {FORECAST_SQL}, w AS ({_R_WIDE}), r AS (SELECT *, row_number() OVER (PARTITION BY algorithm ORDER BY "VALIDATION_RMSE", configuration) AS i FROM w)
SELECT algorithm, configuration, "VALIDATION_RMSE" FROM r WHERE i = 1""", ["VALIDATION_RMSE"])
def best_by_metric(spark, folder):
    return evaluate.best_by_metric(regression_comparison(spark, folder), "VALIDATION_RMSE", ["algorithm"])


@query("ordered_selection", f"""WITH {FORECAST_SQL}, w AS ({_R_WIDE}) SELECT w.*, CAST(o.listed AS INT) AS listed FROM w JOIN (VALUES ('MEAN-3', 1), ('Persistence', 2), ('LAG-1', 3)) o(c, listed) ON o.c = configuration""", _staged(evaluate.REGRESSION_METRICS))
def ordered_selection(spark, folder):
    return evaluate.ordered_selection(regression_comparison(spark, folder), ["MEAN-3", "Persistence", "LAG-1"])


_WE = evaluate.CLASS_METRICS


@query("weight_effect", f"""WITH {RANK_SQL}, w AS ({_C_WIDE}) SELECT a.module, a.configuration AS unweighted_configuration, b.configuration AS balanced_configuration,
  {", ".join(f'a."VALIDATION_{n}" AS "unweighted_{n}", b."VALIDATION_{n}" AS "balanced_{n}", b."VALIDATION_{n}" - a."VALIDATION_{n}" AS "balanced_minus_unweighted_{n}"' for n in _WE)}
FROM w a JOIN w b ON b.module = a.module AND b.configuration = a.configuration || '-balanced'""",
    [f"{p}_{n}" for p in ("unweighted", "balanced", "balanced_minus_unweighted") for n in _WE])
def weight_effect(spark, folder):
    return evaluate.weight_effect(class_comparison(spark, folder))


_SEL = ["module", "configuration", "position", "policy", "primary_metric", "improvement_over_baseline", "frozen_before_final_test"]


@query("selection_record", f"""WITH {RANK_SQL}, w AS ({_C_WIDE}), {RANKED_AUC}, {RANKED_F1},
a AS (SELECT *, "VALIDATION_ROC_AUC" > 0.5 AS gate_auc, "VALIDATION_Recall_0" > 0 AND "VALIDATION_Recall_1" > 0 AS gate_both_classes FROM rr WHERE position = 1),
t AS (SELECT * FROM fr WHERE position = 1),
b AS (SELECT fr.*, t."VALIDATION_F1_1" - fr."VALIDATION_F1_1" <= 0.02 AS g1, fr."VALIDATION_Recall_1" > t."VALIDATION_Recall_1" AS g2, fr.overfit_gap < t.overfit_gap AS g3
   FROM fr, t WHERE fr.configuration = 'USE-1-balanced')
SELECT module, configuration, position, 'rank' AS policy, 'VALIDATION_ROC_AUC' AS primary_metric, "VALIDATION_ROC_AUC" - 0.5 AS improvement_over_baseline,
  gate_auc AND gate_both_classes AS frozen_before_final_test FROM a
UNION ALL SELECT module, configuration, position, 'named', 'VALIDATION_F1_1', CAST(NULL AS DOUBLE), g1 AND g2 AND g3 FROM b""", ["improvement_over_baseline"])
def selection_record(spark, folder):
    both = class_comparison(spark, folder)
    revenue = ranked(spark, folder, "revenue", both)
    by_rank = evaluate.selection_record(
        revenue,
        "VALIDATION_ROC_AUC",
        {
            "gate_auc": F.col("VALIDATION_ROC_AUC") > 0.5,
            "gate_both_classes": (F.col("VALIDATION_Recall_0") > 0) & (F.col("VALIDATION_Recall_1") > 0),
        },
        baseline=0.5,
    )
    anomaly = materialize(ranked(spark, folder, "anomaly", both), "ranked")
    named = evaluate.selection_record(
        anomaly,
        "VALIDATION_F1_1",
        evaluate.close_to_rival(anomaly.filter("position = 1"), "VALIDATION_F1_1", "VALIDATION_Recall_1"),
        choice="USE-1-balanced",
    )
    return by_rank.select(*_SEL).unionByName(named.select(*_SEL))


@query("final_test_rows", f"""WITH {SCORED} SELECT s.module, s.consumer_no, s.target_ord, s.y AS actual_class, s.label AS predicted_class, s.p AS class_1_probability,
  b.label AS baseline_class, b.p AS baseline_class_1_probability FROM sc s JOIN sc b ON b.module = s.module AND b.consumer_no = s.consumer_no AND b.ord = s.ord AND b.stage = s.stage
WHERE s.stage = 'FINAL_TEST' AND s.configuration = 'PAY-2' AND b.configuration = 'TRAIN-majority'""", ["class_1_probability", "baseline_class_1_probability"])
def final_test_rows(spark, folder):
    """Frozen rule and baseline on the same held-out rows, from one pass over the scores."""
    rows = scored_rules(spark, folder).filter("stage = 'FINAL_TEST' AND configuration IN ('PAY-2', 'TRAIN-majority')")
    base = F.col("configuration") == "TRAIN-majority"
    return rows.groupBy("module", "consumer_no", "target_ord").agg(
        F.max("y").alias("actual_class"),
        F.max(F.when(~base, F.col("label"))).alias("predicted_class"),
        F.max(F.when(~base, F.col("p"))).alias("class_1_probability"),
        F.max(F.when(base, F.col("label"))).alias("baseline_class"),
        F.max(F.when(base, F.col("p"))).alias("baseline_class_1_probability"),
    )


@query("final_test_residuals", f"""WITH {FORECAST_SQL} SELECT s.consumer_no, s.target_ord, s.y AS actual_consumption, s.p AS selected_prediction, b.p AS baseline_prediction, s.y - s.p AS residual_actual_minus_predicted
FROM fc s JOIN fc b ON b.consumer_no = s.consumer_no AND b.target_ord = s.target_ord WHERE s.stage = 'FINAL_TEST' AND s.configuration = 'MEAN-3' AND b.configuration = 'Persistence'""",
    ["selected_prediction", "residual_actual_minus_predicted"])
def final_test_residuals(spark, folder):
    rows = module(spark, folder, "consumption").filter(F.col("partition") == "FINAL_TEST")
    chosen = F.coalesce("recent_mean_3", "current_consumption")
    return rows.select(
        "consumer_no", "target_ord", F.col("target").alias("actual_consumption"), chosen.alias("selected_prediction"),
        F.col("current_consumption").alias("baseline_prediction"), (F.col("target") - chosen).alias("residual_actual_minus_predicted"),
    )


EXPECTED = {"revenue": ("PAY-2", "TRAIN-majority"), "anomaly": ("USE-1-balanced", "TRAIN-majority")}


def final_rows(spark, folder):
    long = metrics.classification_metrics(scored_rules(spark, folder), "y", "label", GROUP)
    return long.filter(
        "stage = 'FINAL_TEST' AND (configuration = 'TRAIN-majority' OR (module = 'revenue' AND configuration = 'PAY-2') OR (module = 'anomaly' AND configuration IN ('USE-1', 'USE-1-balanced')))"
    )


@query("final_test_gate", f"""WITH {CLASS_SQL}, f AS (SELECT * FROM cm WHERE stage = 'FINAL_TEST' AND (configuration = 'TRAIN-majority' OR (module = 'revenue' AND configuration = 'PAY-2') OR (module = 'anomaly' AND configuration IN ('USE-1', 'USE-1-balanced')))),
j AS (SELECT f.*, e.selected, e.baseline FROM f JOIN (VALUES ('revenue', 'PAY-2', 'TRAIN-majority'), ('anomaly', 'USE-1-balanced', 'TRAIN-majority')) e(m, selected, baseline) ON e.m = f.module)
SELECT module, selected, baseline, count(*) AS n_rows, count(*) FILTER (configuration IN (selected, baseline)) AS named_rows, count(DISTINCT configuration) AS configurations,
  CAST(0 AS BIGINT) AS other_stage_rows, min(sample_count) AS least_sample, max(sample_count) AS most_sample,
  CASE WHEN count(*) = 2 AND min(sample_count) = max(sample_count) THEN 'PASS' ELSE 'FAIL' END AS status FROM j GROUP BY 1, 2, 3""")
def final_test_gate(spark, folder):
    """The anomaly table holds one configuration too many, so its gate must fail."""
    return evaluate.final_test_gate(final_rows(spark, folder), EXPECTED)


@query("predicted_counts", f"""WITH {CLASS_SQL} SELECT module, stage, configuration, predicted_class_0 AS predicted_class_0_count, predicted_class_1 AS predicted_class_1_count FROM cm""")
def predicted_counts(spark, folder):
    """Every second configuration has lost its saved counts."""
    long = metrics.classification_metrics(scored_rules(spark, folder), "y", "label", GROUP)
    lost = F.col("pos") % 2 == 0
    partly = long.withColumns({f"predicted_class_{k}": F.when(~lost, F.col(f"predicted_class_{k}")) for k in (0, 1)})
    return evaluate.predicted_counts(partly).select("module", "stage", "configuration", "predicted_class_0_count", "predicted_class_1_count")


ROLES = [
    ("consumption", "Persistence", 1, "baseline"),
    ("consumption", "LAG-11", 2, "best first family"),
    ("consumption", "MEAN-ALL", 3, "best second family"),
    ("consumption", "MEAN-ALL", 4, "official selected model"),
    ("revenue", "TRAIN-majority", 1, "baseline"),
    ("revenue", "PAY-2", 2, "best first family"),
    ("revenue", "USE-1", 3, "best second family"),
    ("revenue", "PAY-2-balanced", 4, "official selected model"),
    ("anomaly", "TRAIN-majority", 1, "baseline"),
    ("anomaly", "PAY-1", 2, "best first family"),
    ("anomaly", "USE-1", 3, "best second family"),
    ("anomaly", "USE-1-balanced", 4, "official selected model"),
]
REASONS = {
    "consumption": "lowest RMSE on VALIDATION",
    "revenue": "highest ROC_AUC with support for both classes",
    "anomaly": "close to the highest F1_1, with more recall and a smaller gap",
}
_REASONS_SQL = " ".join(f"WHEN '{m}' THEN '{t}'" for m, t in REASONS.items())
_GAPS_SQL = ", ".join(
    f"""CASE WHEN x.stage = 'VALIDATION' THEN "{n}" - max("{n}") FILTER (x.stage = 'TRAIN') OVER (PARTITION BY x.module, x.configuration) END AS "VALIDATION_minus_TRAIN_{n}\""""
    for n in evaluate.GAP_METRICS
)
_ROLES_SQL = ", ".join(f"('{m}', '{c}', {r}, '{t}')" for m, c, r, t in ROLES)
FINAL_SQL = (
    RANK_SQL
    + FORECAST_CTES
    + f""",
ro AS (SELECT * FROM (VALUES {_ROLES_SQL}) r(module, configuration, rank, role)),
rl AS (SELECT module, configuration, string_agg(role, '; ' ORDER BY rank) AS model_role, bool_or(role = 'official selected model') AS selected_model, bool_or(role = 'baseline') AS baseline FROM ro GROUP BY 1, 2),
fm AS (SELECT x.module, x.configuration, x.algorithm, x.stage, model_role, selected_model, baseline, sample_count, "MAE", "RMSE", "R2", "Accuracy", "Precision_0", "Recall_0", "F1_0", "Precision_1", "Recall_1", "F1_1", "ROC_AUC", "AP", predicted_class_0_count, predicted_class_1_count,
    actual_class_0_count, actual_class_1_count, {_GAPS_SQL},
    CASE WHEN selected_model THEN CASE x.module {_REASONS_SQL} END ELSE '' END AS selection_reason,
    CASE WHEN x.stage = 'FINAL_TEST' THEN 'held-out final test before the refit' ELSE 'model comparison' END AS metric_source
  FROM (SELECT module, configuration, algorithm, stage, sample_count, "MAE", "RMSE", "R2", NULL AS "Accuracy", NULL AS "Precision_0", NULL AS "Recall_0", NULL AS "F1_0", NULL AS "Precision_1", NULL AS "Recall_1", NULL AS "F1_1", NULL AS "ROC_AUC", NULL AS "AP",
          CAST(NULL AS BIGINT) AS predicted_class_0_count, CAST(NULL AS BIGINT) AS predicted_class_1_count, CAST(NULL AS BIGINT) AS actual_class_0_count, CAST(NULL AS BIGINT) AS actual_class_1_count FROM rm
        UNION ALL SELECT module, configuration, algorithm, stage, sample_count, NULL, NULL, NULL, "Accuracy", "Precision_0", "Recall_0", "F1_0", "Precision_1", "Recall_1", "F1_1", "ROC_AUC", "AP", predicted_class_0, predicted_class_1, class_0_count, class_1_count FROM am) x
  JOIN rl ON rl.module = x.module AND rl.configuration = x.configuration)
"""
)
_FM = ["module", "configuration", "algorithm", "stage", "model_role", "selected_model", "baseline", "sample_count", "MAE", "RMSE", "R2", "Accuracy", "Precision_0", "Recall_0", "F1_0", "Precision_1", "Recall_1", "F1_1", "ROC_AUC", "AP", "predicted_class_0_count", "predicted_class_1_count"]
_GAPS = [f"VALIDATION_minus_TRAIN_{n}" for n in evaluate.GAP_METRICS]
_FM += ["actual_class_0_count", "actual_class_1_count", *_GAPS, "selection_reason", "metric_source"]
_FM_FLOATS = [*_GAPS, "MAE", "RMSE", "R2", "Accuracy", "Precision_0", "Recall_0", "F1_0", "Precision_1", "Recall_1", "F1_1", "ROC_AUC", "AP"]
_PRIMARY = {"consumption": "RMSE", "revenue": "ROC_AUC", "anomaly": "F1_1"}
_SECONDARY = {"consumption": ["MAE", "R2"], "revenue": ["F1_1", "F1_0", "AP"], "anomaly": ["Recall_1", "Precision_1", "AP", "ROC_AUC"]}


def _secondary_sql(separator):
    listed = {m: ", ".join(f"""printf('{n}=%.6f', "{n}")""" for n in names) for m, names in _SECONDARY.items()}
    return "CASE module " + " ".join(f"WHEN '{m}' THEN concat_ws('{separator}', {t})" for m, t in listed.items()) + " END"


def consolidated(spark, folder):
    roles = spark.createDataFrame(ROLES, "module string, configuration string, rank int, role string")
    stored = stored_split(spark, folder, *dict.fromkeys(_SCORED_COLUMNS + _FORECAST_COLUMNS))
    regression = metrics.regression_metrics(forecasts(spark, folder, stored), "y", "p", GROUP)
    return evaluate.final_metrics(regression, class_metrics_long(spark, folder, stored), roles, REASONS).select(*_FM)


@query("final_metrics", f"WITH {FINAL_SQL} SELECT * FROM fm", _FM_FLOATS)
def final_metrics(spark, folder):
    return consolidated(spark, folder)


COMPARISON_SQL = (
    FINAL_SQL
    + f""",
v AS (SELECT *, {_secondary_sql('; ')} AS listed, {_secondary_sql(', ')} AS in_line, CASE module WHEN 'consumption' THEN "RMSE" WHEN 'revenue' THEN "ROC_AUC" ELSE "F1_1" END AS val,
  CASE module WHEN 'consumption' THEN 'RMSE' WHEN 'revenue' THEN 'ROC_AUC' ELSE 'F1_1' END AS primary_metric FROM fm),
fcmp AS (SELECT module, primary_metric, max(configuration) FILTER (fm_base) AS baseline, max(configuration) FILTER (model_role LIKE '%best first family%') AS best_first_family,
  max(configuration) FILTER (model_role LIKE '%best second family%') AS best_second_family, max(configuration) FILTER (selected_model) AS selected,
  max(val) FILTER (selected_model AND stage = 'VALIDATION') AS selected_validation, max(val) FILTER (selected_model AND stage = 'FINAL_TEST') AS selected_final_test,
  max(val) FILTER (fm_base AND stage = 'FINAL_TEST') AS baseline_final_test,
  max(listed) FILTER (selected_model AND stage = 'VALIDATION') AS selected_validation_secondary,
  'selected ' || max(in_line) FILTER (selected_model AND stage = 'FINAL_TEST') || '; baseline ' || max(in_line) FILTER (fm_base AND stage = 'FINAL_TEST') AS final_test_secondary,
  max(selection_reason) FILTER (selected_model) AS selection_reason FROM (SELECT * EXCLUDE (baseline), baseline AS fm_base FROM v) GROUP BY 1, 2)
"""
)
_VALUES = ["selected_validation", "selected_final_test", "baseline_final_test"]


@query("final_comparison", f"WITH {COMPARISON_SQL} SELECT * FROM fcmp", _VALUES)
def final_comparison(spark, folder):
    return evaluate.final_comparison(consolidated(spark, folder), _PRIMARY, _SECONDARY)


@query("model_card_rows", f"""WITH {COMPARISON_SQL}, g AS (SELECT *, CASE WHEN primary_metric = 'RMSE' THEN baseline_final_test - selected_final_test ELSE selected_final_test - baseline_final_test END AS gain FROM fcmp)
SELECT module, selected, printf('%s %.4f', primary_metric, selected_validation) AS validation_text, printf('%s %.4f', primary_metric, selected_final_test) AS final_test_text,
  printf('%s %s %.4f; improvement %.4f', baseline, primary_metric, baseline_final_test, gain) AS baseline_text FROM g""")
def model_card_rows(spark, folder):
    return evaluate.model_card_rows(evaluate.final_comparison(consolidated(spark, folder), _PRIMARY, _SECONDARY))
