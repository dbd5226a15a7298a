"""Exact quantiles, running sums, rank cuts and splits against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators.isotonic import isotonic_blocks, pooled
from ebbtide.operators.quantiles import exact_quantiles
from ebbtide.operators.ranking import dense_ranks, edges_below, rank_cuts, running_sums, with_bucket
from ebbtide.operators.splits import (
    stratified_folds,
    stratified_split,
    three_way_split,
    with_balanced_weights,
)


def groups_with_ties(seed: int) -> dict[str, list[float | None]]:
    draw = random.Random(seed)
    return {
        "hot": [float(draw.randrange(0, 40)) for _ in range(3000)],
        "fine": [draw.gauss(0, 1000) for _ in range(2000)],
        "mostly-zero": [0.0] * 900 + [draw.random() for _ in range(100)],
        "even": [1.0, 2.0, 4.0, 8.0],
        "one": [3.5],
        "nulls": [None, None, 5.0, 7.0],
    }


@pytest.mark.parametrize("whole", [1_000_000, 50], ids=["ranked-whole", "bracketed"])
@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles(spark, whole, seed):
    data = groups_with_ties(seed)
    rows = [(k, v) for k, values in data.items() for v in values]
    random.Random(seed).shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, v double")
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.99]
    found = exact_quantiles(frame, ["k"], "v", probabilities, len(rows), whole_group_rows=whole, accuracy=200)
    answers = {r.k: r.quantiles for r in found.collect()}
    for k, values in data.items():
        expected = np.percentile([v for v in values if v is not None], [100 * p for p in probabilities])
        assert answers[k] == pytest.approx(list(expected), abs=1e-9), k


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_running_sums(spark, descending, buckets):
    draw = random.Random(buckets)
    data = {g: {draw.randrange(0, 5000): draw.randrange(1, 9) for _ in range(200)} for g in ("a", "b")}
    frame = spark.createDataFrame([(g, v, w) for g, d in data.items() for v, w in d.items()], "g string, v int, w int")
    found = running_sums(frame, "v", {"until": "w"}, ["g"], descending, buckets)
    got = {(r.g, r.v): r.until for r in found.collect()}
    for g, d in data.items():
        order = sorted(d, reverse=descending)
        assert [got[g, v] for v in order] == list(accumulate(d[v] for v in order))


def test_buckets_follow_the_rows(spark):
    frame = spark.range(20_000).selectExpr("cast(id * 7919 % 20000 as int) as v")
    for least, rows in ((4, 100_000), (4, 500), (64, 500), (1, 20)):
        sizes = [r["count"] for r in with_bucket(frame, "v", least, rows).groupBy("_bucket").count().collect()]
        wanted = max(least, 20_000 / rows)
        assert wanted <= len(sizes) <= 2 * wanted + 1 and max(sizes) <= 3 * 20_000 / wanted


@pytest.mark.parametrize("kind", ["int", "string", "double"])
def test_edges_below_are_all_that_are_less(spark, kind):
    draw = random.Random(1)
    for size in (0, 1, 2, 3, 15, 16, 17, 300):
        edges = sorted(draw.sample(range(1000), size))
        values = [None, -1, 1001, *edges[:40], *[draw.randrange(1000) for _ in range(40)]]
        frame = spark.createDataFrame([(edges, v) for v in values], "e array<int>, v int")
        if kind != "int":  # strings of one length are ordered as their numbers
            write = (lambda c: F.format_string("%05d", c + 1)) if kind == "string" else (lambda c: c.cast("double"))
            frame = frame.select(F.transform("e", write).alias("e"), F.when(F.col("v").isNotNull(), write(F.col("v"))).alias("w"), "v")
        got = frame.select("v", edges_below(F.col("e"), F.col("v" if kind == "int" else "w")).alias("n")).collect()
        assert [r.n for r in got] == [0 if r.v is None else sum(e < r.v for e in edges) for r in got]


def test_quantiles_of_hot_groups_need_no_window_of_a_group(spark):
    frame = spark.range(5000).selectExpr("'hot' as k", "cast(id * id % 4999 as double) as v")
    found = exact_quantiles(frame, ["k"], "v", [0.5], 5000, whole_group_rows=50, accuracy=100)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_until" in line]
    assert windows and all("_bucket" in line for line in windows)


@pytest.mark.parametrize("shape", ["noise", "falling", "rising", "waves", "one heavy at the end"])
def test_pooling_by_ranges_is_pooling_in_order(spark, shape):
    draw = np.random.default_rng(4)
    x = np.arange(700.0)
    means = {
        "noise": draw.random(700), "falling": 1 - x / 700, "rising": x / 700, "waves": np.sin(x / 20) + x / 400,
        "one heavy at the end": np.where(x < 699, x / 700, -50.0),
    }[shape]
    weights = np.where(x < 699, draw.integers(1, 4, 700), 500.0)
    order = draw.permutation(700)
    frame = spark.createDataFrame([(float(x[i]), float(means[i]), float(weights[i])) for i in order], "x double, y double, w double")
    found = sorted(map(tuple, isotonic_blocks(frame, "x", "y", "w", buckets=20, range_rows=40).collect()))
    want = [(float(a), float(b), m, w) for a, b, m, w in pooled(means.tolist(), weights.tolist())]
    assert [r[:2] for r in found] == [r[:2] for r in want]
    assert np.allclose([r[2:] for r in found], [r[2:] for r in want])
    assert isotonic_blocks(frame.where("false"), "x", "y", "w").count() == 0


def test_dense_ranks_of_strings(spark):
    words = [f"w{i % 37:02d}" for i in range(400)] + [None]
    found = dense_ranks(spark.createDataFrame([(w,) for w in words], "v string"), "v", "rank", buckets=5)
    assert {r.v: r["rank"] for r in found.collect()} == {w: i for i, w in enumerate(sorted(set(words) - {None}))}


def test_rank_cuts(spark):
    values = {True: list(range(0, 900, 3)), False: list(range(5000, 4000, -7))}
    frame = spark.createDataFrame([(c, v) for c, vs in values.items() for v in vs], "c boolean, v int")
    asked = [(True, 0, 1), (True, 1, 150), (False, 0, 143), (False, 1, 143)]
    found = rank_cuts(frame, "c", "v", spark.createDataFrame(asked, "c boolean, cut int, rank int"), buckets=7)
    got = {(r.c, r.cut): r.v for r in found.collect()}
    assert got == {(c, cut): sorted(values[c])[rank - 1] for c, cut, rank in asked}


def labelled(spark, n=1003, every=7):
    rows = [(i * 13 % n, i % every == 0) for i in range(n)]
    return spark.createDataFrame(rows, "ID bigint, churned boolean"), dict(rows)


def test_split_sizes_and_shares(spark):
    frame, labels = labelled(spark)
    found = stratified_split(frame, "churned", "ID").collect()
    counts = Counter((r.split, r.churned) for r in found)
    assert len({r.ID for r in found}) == len(labels)
    assert counts["test", True] + counts["test", False] == 201
    positives = sum(labels.values())
    assert abs(counts["test", True] - positives * 201 / len(labels)) < 1
    assert {(r.ID, r.split) for r in found} == {
        (r.ID, r.split) for r in stratified_split(frame.repartition(7), "churned", "ID").collect()
    }
    other = {(r.ID, r.split) for r in stratified_split(frame, "churned", "ID", seed=43).collect()}
    assert other != {(r.ID, r.split) for r in found}


def test_three_way_sizes(spark):
    frame, labels = labelled(spark)
    counts = Counter(r.split for r in three_way_split(frame, "churned", "ID", 0.1, 0.2).collect())
    assert counts == {"valid": 101, "test": 201, "train": 701}
    with pytest.raises(ValueError):
        three_way_split(frame, "churned", "ID", 0.6, 0.6)


def folds_by_hand(labels: dict[int, bool], n: int) -> dict[int, int]:
    keys = sorted(labels)
    classes = list(dict.fromkeys(labels[k] for k in keys))
    in_class_order = sorted((classes.index(labels[k]) for k in keys))
    result = {}
    for number, value in enumerate(classes):
        sizes = [sum(1 for c in in_class_order[i::n] if c == number) for i in range(n)]
        members = iter(k for k in keys if labels[k] == value)
        for fold, size in enumerate(sizes):
            for _ in range(size):
                result[next(members)] = fold
    return result


@pytest.mark.parametrize("n,rows,every", [(5, 1003, 7), (5, 23, 9), (3, 100, 2)])
def test_folds(spark, n, rows, every):
    frame, labels = labelled(spark, rows, every)
    found = {r.ID: r.fold for r in stratified_folds(frame, "churned", "ID", n).collect()}
    assert found == folds_by_hand(labels, n)


def test_weights_balance_the_classes(spark):
    frame, labels = labelled(spark)
    grouped = frame.withColumn("fold", F.col("ID") % 3)
    for by in ([], ["fold"]):
        sums = defaultdict(float)
        for r in with_balanced_weights(grouped, "churned", by).collect():
            sums[(r.fold if by else 0, r.churned)] += r.weight
        groups = {g for g, _ in sums}
        assert sum(sums.values()) == pytest.approx(len(labels))
        assert all(sums[g, True] == pytest.approx(sums[g, False]) for g in groups)


def test_splits_want_a_boolean_label(spark):
    frame = spark.createDataFrame([(1, 1)], "ID bigint, churned int")
    with pytest.raises(TypeError):
        stratified_split(frame, "churned", "ID")


def test_rows_without_a_label_stay_without_part_and_weight(spark):
    rows = [(i, None if i % 5 == 0 else i % 3 == 0, None if i % 7 == 0 else i % 2) for i in range(200)]
    frame = spark.createDataFrame(rows, "ID bigint, churned boolean, part int")
    unlabelled = {i for i, y, _ in rows if y is None}
    known = frame.where("churned IS NOT NULL")
    jobs = {
        "split": lambda f: stratified_split(f, "churned", "ID"),
        "three": lambda f: three_way_split(f, "churned", "ID", part="three"),
        "fold": lambda f: stratified_folds(f, "churned", "ID"),
        "weight": lambda f: with_balanced_weights(f, "churned"),
    }
    for column, job in jobs.items():
        found = {r.ID: r[column] for r in job(frame).collect()}
        assert len(found) == 200 and {i for i, v in found.items() if v is None} == unlabelled
        assert {i: v for i, v in found.items() if v is not None} == {r.ID: r[column] for r in job(known).collect()}
    grouped = {r.ID: r.weight for r in with_balanced_weights(frame, "churned", ["part"]).collect()}
    for part in (None, 0, 1):
        inside = [(i, y) for i, y, p in rows if p == part and y is not None]
        sizes = Counter(y for _, y in inside)
        assert all(grouped[i] == pytest.approx(len(inside) / (2 * sizes[y])) for i, y in inside)


def test_parts_and_weights_join_no_wide_rows(spark):
    """Each scan reads cuts and class weights as values; a null label or key has its place as before."""
    frame = spark.createDataFrame([(None if i == 5 else i, None if i == 7 else i % 3 == 0) for i in range(90)], "ID long, churned boolean")
    parted = stratified_split(frame, "churned", "ID")
    weighted = with_balanced_weights(parted, "churned", ["split"])
    assert "Join" not in weighted._jdf.queryExecution().optimizedPlan().toString()
    rows = weighted.collect()
    assert [r.split for r in rows if r.churned is None] == [r.weight for r in rows if r.churned is None] == [None]
    assert sum(r.split == "train" for r in rows) == 71 and sum(r.split == "test" for r in rows) == 18
    for part, size in (("train", 71), ("test", 18)):
        assert sum(r.weight for r in rows if r.split == part) == pytest.approx(size)
