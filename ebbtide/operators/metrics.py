"""Weighted evaluation of binary scores as tables, optionally per group (fold, iteration, split).

Scores are first summed per distinct score and class; every later step works on that table, so tied
or hot scores are single rows and nothing is ordered in one task (see :mod:`.ranking`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.ranking import running_sums

EPSILON = 1e-15
# The twelve metrics in output order, twenty thresholds, inner edges of ten score bins.
METRICS = [
    "accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1", "false_positive_rate",
    "false_negative_rate", "average_precision", "mcc", "fowlkes_mallows_index", "auc",
]
THRESHOLDS = [0.05 + 0.05 * i for i in range(20)]
BIN_EDGES = [0.1 * i for i in range(1, 10)]


def confusion(
    df: DataFrame, label: str, predicted: str, weight: str, by: list[str] | None = None
) -> DataFrame:
    """Weighted ``tn, fp, fn, tp``; labels and predictions are booleans."""
    y, guess, w = F.col(label), F.col(predicted), F.col(weight)

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, w).otherwise(0.0))

    return df.groupBy(*(by or [])).agg(
        total(~y & ~guess).alias("tn"),
        total(~y & guess).alias("fp"),
        total(y & ~guess).alias("fn"),
        total(y & guess).alias("tp"),
    )


def normalised_confusion(matrix: DataFrame) -> DataFrame:
    """The four cells as shares of all weight."""
    cells = ["tn", "fp", "fn", "tp"]
    total = sum((F.col(c) for c in cells), F.lit(0.0))
    return matrix.withColumns({c: F.try_divide(F.col(c), total) for c in cells})


def confusion_metrics(matrix: DataFrame) -> DataFrame:
    """Adds the ten metrics that depend on the confusion matrix only."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall, specificity = F.col("precision"), F.col("recall"), F.col("specificity")
    return (
        matrix.withColumns(
            {
                "precision": tp / (tp + fp + EPSILON),
                "recall": tp / (tp + fn + EPSILON),
                "specificity": tn / (tn + fp + EPSILON),
                "accuracy": (tp + tn) / (tp + tn + fp + fn + EPSILON),
                "false_positive_rate": fp / (fp + tn + EPSILON),
                "false_negative_rate": fn / (fn + tp + EPSILON),
                "mcc": (tp * tn - fp * fn)
                / (F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) + EPSILON),
                "fowlkes_mallows_index": tp / (F.sqrt((tp + fp) * (tp + fn)) + EPSILON),
            }
        )
        .withColumns(
            {
                "balanced_accuracy": (recall + specificity) / 2,
                "f1": 2 * precision * recall / (precision + recall + EPSILON),
            }
        )
    )


def score_steps(
    df: DataFrame, label: str, score: str, weight: str, by: list[str] | None = None
) -> DataFrame:
    """Per distinct score, from high to low: weight of positives and negatives at it (``step_tp``,
    ``step_fp``) and at or above it (``tp``, ``fp``)."""
    by = by or []
    y, w = F.col(label), F.col(weight)
    steps = df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.when(y, w).otherwise(0.0)).alias("step_tp"),
        F.sum(F.when(y, 0.0).otherwise(w)).alias("step_fp"),
    )
    return running_sums(steps, "score", {"tp": "step_tp", "fp": "step_fp"}, by, descending=True)


def _with_totals(steps: DataFrame, by: list[str]) -> DataFrame:
    """Total positive and negative weight beside every step; one row per group is joined."""
    totals = steps.groupBy(*by).agg(F.sum("step_tp").alias("positives"), F.sum("step_fp").alias("negatives"))
    if by:
        return steps.join(totals, by)
    total = totals.select(F.struct("positives", "negatives").alias("totals")).scalar()
    return steps.withColumn("totals", total).select("*", "totals.*").drop("totals")


def roc_points(
    df: DataFrame, label: str, score: str, weight: str, by: list[str] | None = None
) -> DataFrame:
    by = by or []
    return _with_totals(score_steps(df, label, score, weight, by), by).select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide("fp", "negatives").alias("false_positive_rate"),
        F.try_divide("tp", "positives").alias("true_positive_rate"),
    )


def precision_recall_points(
    df: DataFrame, label: str, score: str, weight: str, by: list[str] | None = None
) -> DataFrame:
    by = by or []
    return _with_totals(score_steps(df, label, score, weight, by), by).select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "positives").alias("recall"),
    )


def ranking_metrics(
    df: DataFrame, label: str, score: str, weight: str, by: list[str] | None = None
) -> DataFrame:
    """``auc`` (area under the ROC curve, ties joined by straight lines) and ``average_precision``
    (precision summed over recall steps, not a trapezoid)."""
    by = by or []
    steps = score_steps(df, label, score, weight, by)
    area = F.sum(F.col("step_fp") * (F.col("tp") - F.col("step_tp") / 2))
    precision = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    positives, negatives = F.sum("step_tp"), F.sum("step_fp")
    return steps.groupBy(*by).agg(
        F.try_divide(area, positives * negatives).alias("auc"),
        F.try_divide(F.sum(F.col("step_tp") * precision), positives).alias("average_precision"),
    )


def evaluate(
    df: DataFrame, label: str, predicted: str, score: str, weight: str, by: list[str] | None = None
) -> DataFrame:
    """One row of the twelve metrics per group, not rounded."""
    by = by or []
    cells = confusion_metrics(confusion(df, label, predicted, weight, by))
    ranked = ranking_metrics(df, label, score, weight, by)
    if by:
        joined = cells.join(ranked, by)
    else:
        pair = ranked.select(F.struct("auc", "average_precision").alias("ranked")).scalar()
        joined = cells.withColumn("ranked", pair).select("*", "ranked.*").drop("ranked")
    return joined.select(*by, *METRICS)


def metric_rows(metrics: DataFrame, by: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """``metric, value`` rows instead of columns, rounded if ``digits`` is given."""
    rows = metrics.unpivot(by or [], METRICS, "metric", "value")
    return rows.withColumn("value", F.round("value", digits)) if digits is not None else rows


def fold_summary(rows: DataFrame) -> DataFrame:
    """Mean and population deviation of every metric over the folds."""
    return rows.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def calibration_points(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Mean score and share of positives in ten equal-width bins, unweighted; an edge belongs to the
    bin below it and empty bins are absent."""
    index = sum((F.when(F.col(score) > edge, 1).otherwise(0) for edge in BIN_EDGES), F.lit(0))
    return df.groupBy(*(by or []), index.alias("bin")).agg(
        F.avg(score).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("positive_share"),
        F.count(F.lit(1)).alias("bin_rows"),
    )


def threshold_grid(
    df: DataFrame,
    label: str,
    score: str,
    weight: str,
    by: list[str] | None = None,
    thresholds: list[float] = THRESHOLDS,
) -> DataFrame:
    """Weighted F1 when every score above a threshold counts as positive.

    One pass: each row is filed under the number of thresholds below its score, and the few resulting
    cells answer for all thresholds.
    """
    by = by or []
    passed = sum((F.when(F.col(score) > t, 1).otherwise(0) for t in thresholds), F.lit(0))
    y, w = F.col(label), F.col(weight)
    cells = df.groupBy(*by, passed.alias("_passed")).agg(
        F.sum(F.when(y, w).otherwise(0.0)).alias("_positive"),
        F.sum(F.when(y, 0.0).otherwise(w)).alias("_negative"),
    )
    entries = [
        F.struct(
            F.lit(t).alias("threshold"),
            F.sum(F.when(F.col("_passed") > i, F.col("_positive")).otherwise(0.0)).alias("tp"),
            F.sum(F.when(F.col("_passed") > i, F.col("_negative")).otherwise(0.0)).alias("fp"),
            F.sum(F.when(F.col("_passed") > i, 0.0).otherwise(F.col("_positive"))).alias("fn"),
        )
        for i, t in enumerate(thresholds)
    ]
    counted = cells.groupBy(*by).agg(F.array(*entries).alias("_grid")).select(*by, F.inline("_grid"))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return counted.select(*by, "threshold", f1.alias("f1"))


def best_threshold(grid: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The threshold of the highest F1, the lowest one among equals."""
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("_negated")))
    return (
        grid.groupBy(*(by or []))
        .agg(best.alias("_best"))
        .select(*(by or []), (-F.col("_best._negated")).alias("threshold"), F.col("_best.f1").alias("f1"))
    )
