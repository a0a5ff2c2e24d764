"""Regression, classification and ranking metrics per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.operators.ranks import running_totals


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """n, MAE, RMSE and R2; R2 is missing where the actual values do not vary."""
    error = F.col(actual) - F.col(predicted)
    squares = F.sum(error * error)
    n = F.count("*")
    return df.groupBy(*by).agg(
        n.alias("sample_count"),
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.try_divide(squares, n)).alias("RMSE"),
        (F.lit(1.0) - F.try_divide(squares, n * F.var_pop(actual))).alias("R2"),
    )


def _cells(actual: str, predicted: str) -> dict[str, Column]:
    y, p = F.col(actual), F.col(predicted)
    cells = {f"true_{a}_predicted_{b}": F.count_if((y == a) & (p == b)) for a in (0, 1) for b in (0, 1)}
    return {"sample_count": F.count("*"), **cells}


def _class_columns() -> dict[str, Column]:
    """What follows from the counts of `_cells`."""
    cell = {(a, b): F.col(f"true_{a}_predicted_{b}") for a in (0, 1) for b in (0, 1)}
    out = {"Accuracy": _ratio(cell[0, 0] + cell[1, 1], F.col("sample_count"))}
    for k in (0, 1):
        hit, support, chosen = cell[k, k], cell[k, 0] + cell[k, 1], cell[0, k] + cell[1, k]
        out |= {
            f"class_{k}_count": support,
            f"class_{k}_percent": F.lit(100.0) * _ratio(support, F.col("sample_count")),
            f"predicted_class_{k}": chosen,
            f"Precision_{k}": _ratio(hit, chosen),
            f"Recall_{k}": _ratio(hit, support),
            f"F1_{k}": _ratio(2 * hit, support + chosen),
        }
    return out


def classification_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and precision, recall, F1, support and confusion counts of both classes."""
    counts = df.groupBy(*by).agg(*[c.alias(name) for name, c in _cells(actual, predicted).items()])
    return counts.withColumns(_class_columns())


def _score_steps(df: DataFrame, actual: str, score: str, by: Sequence[str], more: Mapping[str, Column] | None = None) -> DataFrame:
    """Per distinct score, from the highest: its positives and negatives and all above them, and aggregates `more` of its rows."""
    y = F.col(actual)
    others = [c.alias(name) for name, c in (more or {}).items()]
    steps = df.groupBy(*by, score).agg(F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"), *others)
    return running_totals(steps, by, score, ["_pos", "_neg"], descending=True)


def _ranking() -> list[Column]:
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    negatives_below = (F.col("_neg_total") - F.col("_neg_before") - F.col("_neg")).cast("double")
    found = (F.col("_pos_before") + F.col("_pos")).cast("double")
    listed = found + (F.col("_neg_before") + F.col("_neg")).cast("double")
    p, n = F.max("_pos_total").cast("double"), F.max("_neg_total").cast("double")
    return [
        F.try_divide(F.sum(pos * (negatives_below + neg / 2)), p * n).alias("ROC_AUC"),
        F.try_divide(F.sum(pos * F.coalesce(F.try_divide(found, listed), F.lit(0.0))), p).alias("AP"),
    ]


def ranking_metrics(df: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Tie-aware area under ROC and average precision, from one pass over the distinct scores."""
    return _score_steps(df, actual, score, by).groupBy(*by).agg(*_ranking())


def roc_auc(df: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, actual, score, by).select(*by, "ROC_AUC")


def average_precision(df: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, actual, score, by).select(*by, "AP")


def roc_points(df: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at each distinct score; the origin has no score."""
    steps = _score_steps(df, actual, score, by)
    points = steps.select(
        *by,
        score,
        F.try_divide((F.col("_neg_before") + F.col("_neg")).cast("double"), F.col("_neg_total").cast("double")).alias("fpr"),
        F.try_divide((F.col("_pos_before") + F.col("_pos")).cast("double"), F.col("_pos_total").cast("double")).alias("tpr"),
    )
    # The groups are taken from the stored steps, so that the scores are made once.
    origin = steps.select(*by).distinct() if by else df.sparkSession.range(1).select()
    origin = origin.select(*by, F.lit(None).cast("double").alias(score), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def confusion_matrix(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Both classes on both axes per group, cells without rows as zero."""
    cells = classification_metrics(df, actual, predicted, by)
    return cells.select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("actual"),
                        F.lit(b).alias("predicted"),
                        F.col(f"true_{a}_predicted_{b}").alias("n"),
                    )
                    for a in (0, 1)
                    for b in (0, 1)
                ]
            )
        )
    )


def class_distribution(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """Rows and share of each class per group, absent classes as zero."""
    row = df.filter(F.col(label).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(label) == k).alias(f"_{k}") for k in (0, 1)]
    )
    return row.select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("class"),
                        F.col(f"_{k}").alias("n"),
                        (F.lit(100.0) * _ratio(F.col(f"_{k}"), F.col("_n"))).alias("percent"),
                    )
                    for k in (0, 1)
                ]
            )
        ),
    )


def scored_metrics(df: DataFrame, actual: str, predicted: str, score: str, by: Sequence[str]) -> DataFrame:
    """Class and ranking metrics of scored rows side by side, one row per group: one pass over the rows merges equal scores with their
    confusion counts, and all else is sums of those."""
    cells = _cells(actual, predicted)
    steps = _score_steps(df, actual, score, by, cells)
    found = steps.groupBy(*by).agg(*[F.sum(c).alias(c) for c in cells], *_ranking())
    return found.withColumns(_class_columns())
