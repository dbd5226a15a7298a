"""Weighted evaluation against brute force over pairs and thresholds."""

from __future__ import annotations

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import metrics as m
from ebbtide.plans.scoring import decide, with_message

SCHEMA = "churned boolean, p double, w double"


def tied_rows(seed: int, n: int = 300):
    draw = random.Random(seed)
    return [(draw.random() < 0.4, draw.randrange(0, 12) / 12, draw.choice([0.5, 1.0, 3.0])) for _ in range(n)]


def auc_by_pairs(rows):
    good = total = 0.0
    for (y, p, w), (z, q, v) in product(rows, rows):
        if y and not z:
            total += w * v
            good += w * v * (1.0 if p > q else 0.5 if p == q else 0.0)
    return good / total


def average_precision_by_steps(rows):
    positives = sum(w for y, _, w in rows if y)
    result, before = 0.0, 0.0
    for t in sorted({p for _, p, _ in rows}, reverse=True):
        tp = sum(w for y, p, w in rows if y and p >= t)
        all_ = sum(w for _, p, w in rows if p >= t)
        result += (tp - before) / positives * tp / all_
        before = tp
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_ranking_metrics_with_ties(spark, seed):
    rows = tied_rows(seed)
    found = m.ranking_metrics(spark.createDataFrame(rows, SCHEMA), "churned", "p", "w").first()
    assert found.auc == pytest.approx(auc_by_pairs(rows))
    assert found.average_precision == pytest.approx(average_precision_by_steps(rows))


def test_groups_equal_separate_runs(spark):
    parts = {g: tied_rows(g, 120) for g in (1, 2, 3)}
    frame = spark.createDataFrame(
        [(g, *r) for g, rows in parts.items() for r in rows], "g int, " + SCHEMA
    ).withColumn("guess", F.col("p") > 0.5)
    together = {r.g: r.asDict() for r in m.evaluate(frame, "churned", "guess", "p", "w", ["g"]).collect()}
    for g in parts:
        alone = m.evaluate(frame.where(F.col("g") == g), "churned", "guess", "p", "w").first().asDict()
        assert {k: together[g][k] for k in alone} == pytest.approx(alone)
    grid = m.threshold_grid(frame, "churned", "p", "w", ["g"])
    assert m.best_threshold(grid, ["g"]).count() == 3


def test_confusion_adds_up_and_normalises(spark):
    rows = tied_rows(5)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("guess", F.col("p") > 0.3)
    cells = m.confusion(frame, "churned", "guess", "w")
    assert sum(cells.first()) == pytest.approx(sum(w for _, _, w in rows))
    assert sum(m.normalised_confusion(cells).first()) == pytest.approx(1)


def test_metrics_of_a_one_sided_guess(spark):
    frame = spark.createDataFrame([(True, 0.9, 1.0), (False, 0.8, 1.0)], SCHEMA).withColumn("guess", F.lit(False))
    row = m.evaluate(frame, "churned", "guess", "p", "w").first()
    assert (row.precision, row.recall, row.f1, row.mcc) == (0, 0, 0, 0)
    assert row.specificity == pytest.approx(1) and row.accuracy == pytest.approx(0.5)


def test_one_class_only_has_no_auc(spark):
    frame = spark.createDataFrame([(True, 0.9, 1.0), (True, 0.8, 1.0)], SCHEMA)
    assert m.ranking_metrics(frame, "churned", "p", "w").first().auc is None


def test_bin_edges_belong_to_the_bin_below(spark):
    frame = spark.createDataFrame([(True, p, 1.0) for p in (0.0, 0.1, 0.2, 0.2000001, 1.0)], SCHEMA)
    found = {r.bin: r.bin_rows for r in m.calibration_points(frame, "churned", "p").collect()}
    assert found == {0: 2, 1: 1, 2: 1, 9: 1}


def test_threshold_grid_and_first_best(spark):
    rows = tied_rows(9)
    grid = {r.threshold: r.f1 for r in m.threshold_grid(spark.createDataFrame(rows, SCHEMA), "churned", "p", "w").collect()}
    assert len(grid) == 20
    for t, f1 in grid.items():
        tp = sum(w for y, p, w in rows if y and p > t)
        fp = sum(w for y, p, w in rows if not y and p > t)
        fn = sum(w for y, p, w in rows if y and p <= t)
        assert f1 == pytest.approx(2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0)
    best = m.best_threshold(m.threshold_grid(spark.createDataFrame(rows, SCHEMA), "churned", "p", "w")).first()
    assert best.f1 == max(grid.values())
    assert best.threshold == min(t for t, f in grid.items() if f == max(grid.values()))


def test_curves_have_one_point_per_score(spark):
    frame = spark.createDataFrame(tied_rows(3), SCHEMA)
    roc = m.roc_points(frame, "churned", "p", "w").orderBy("threshold").collect()
    assert len(roc) == frame.select("p").distinct().count()
    assert roc[0].false_positive_rate == pytest.approx(1) and roc[0].true_positive_rate == pytest.approx(1)
    points = m.precision_recall_points(frame, "churned", "p", "w").orderBy("threshold").collect()
    assert points[0].recall == pytest.approx(1)


def test_rows_rounding_and_summary(spark):
    frame = spark.createDataFrame(tied_rows(3), SCHEMA).withColumn("guess", F.col("p") > 0.5)
    table = m.evaluate(frame, "churned", "guess", "p", "w")
    rows = {r.metric: r.value for r in m.metric_rows(table, digits=3).collect()}
    assert list(rows) == m.METRICS and all(round(v, 3) == v for v in rows.values())
    folds = spark.createDataFrame([("f1", 1.0), ("f1", 3.0)], "metric string, value double")
    summary = m.fold_summary(folds).first()
    assert (summary["mean"], summary["std"]) == (2.0, 1.0)


def test_decisions_are_strict_and_report_the_predicted_class(spark):
    frame = spark.createDataFrame([(1, 0.5), (2, 0.75)], "ID bigint, churn_probability double")
    found = {r.ID: (r.prediction, r.predicted_class_probability, r.message) for r in with_message(decide(frame)).collect()}
    assert found[1] == (False, 0.5, "prediction for user 1 is False with probability of: 0.500")
    assert found[2] == (True, 0.75, "prediction for user 2 is True with probability of: 0.750")
