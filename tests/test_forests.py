from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import functions as F

from ebbtide.operators import forests, models


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(3000, 12))
    x[:, 4] = np.round(x[:, 4])
    y = x[:, 0] + x[:, 1] * x[:, 2] + x[:, 4] + draw.normal(size=3000) / 2 > 0.7
    frame = pd.DataFrame(x, columns=[f"x{i}" for i in range(12)]).assign(label=y.astype(float), weight=np.where(y, 1.7, 0.7))
    made = VectorAssembler(inputCols=[f"x{i}" for i in range(12)], outputCol="features").transform(spark.createDataFrame(frame))
    return made.select(F.monotonically_increasing_id().alias("ID"), "features", "label", "weight").repartition(3).cache()


def probabilities(model, rows):
    return np.array([r.probability[1] for r in model.transform(rows).orderBy("ID").select("probability").collect()])


def test_forests_of_numbers_are_like_those_of_spark(vectors, monkeypatch):
    """Whatever the number of rows that a task may have and that are sent at a time. Nodes stay in written tables."""
    train, valid = vectors.where("ID % 3 > 0").cache(), vectors.where("ID % 3 = 0").cache()
    area = BinaryClassificationEvaluator().evaluate
    plain = RandomForestClassifier(weightCol="weight", numTrees=20, maxDepth=30, featureSubsetStrategy="sqrt", seed=42).fit(train)
    for piece, wave in ((1 << 18, 1 << 30), (300, 100_000)):
        monkeypatch.setattr(forests, "PIECE_ROWS", piece)
        monkeypatch.setattr(forests, "WAVE_BYTES", wave)
        model = models.random_forest(20, 30).fit(train)
        assert isinstance(model, forests.ForestModel) and len(model.tops) == 20
        assert (len(model.pieces) > 1) == (piece == 300) and (max(len(t["feature"]) for t in model.tops) > 1) == (piece == 300)
        assert model.totalNumNodes == pytest.approx(plain.totalNumNodes, rel=0.1)
        assert area(model.transform(valid)) == pytest.approx(area(plain.transform(valid)), abs=0.03)
        assert np.allclose(model.featureImportances.toArray(), plain.featureImportances.toArray(), atol=0.06)
        assert model.featureImportances.toArray().sum() == pytest.approx(1)


def test_a_grown_forest_is_saved_as_one_of_spark(vectors, tmp_path, monkeypatch):
    monkeypatch.setattr(forests, "PIECE_ROWS", 500)
    monkeypatch.setattr(forests, "SHIP_BYTES", 10_000)  # so that trees are sent in several pieces
    model = models.random_forest(8, 12).fit(vectors)
    model.save(str(tmp_path / "forest"))
    again = RandomForestClassificationModel.load(str(tmp_path / "forest"))
    assert again.totalNumNodes == model.totalNumNodes and again.getNumTrees == 8 and again.getMaxDepth() == 12
    assert np.allclose(probabilities(model, vectors), probabilities(again, vectors))
    assert np.allclose(model.featureImportances.toArray(), again.featureImportances.toArray())
    ours, theirs = (m.transform(vectors).orderBy("ID").select("prediction", "rawPrediction").collect() for m in (model, again))
    assert [r.prediction for r in ours] == [r.prediction for r in theirs]
    assert np.allclose([r.rawPrediction.toArray() for r in ours], [r.rawPrediction.toArray() for r in theirs])


def test_parts_of_a_tree_do_not_change_it(vectors, monkeypatch):
    """One feature and no bootstrap leave nothing to draw."""
    one = VectorSlicer(inputCol="features", outputCol="first", indices=[0]).transform(vectors)
    one = one.select("ID", F.col("first").alias("features"), "label", "weight")
    found = []
    for piece in (1 << 18, 200):
        monkeypatch.setattr(forests, "PIECE_ROWS", piece)
        found.append(models.random_forest(1, 6).setBootstrap(False).fit(one))
    assert found[0].totalNumNodes == found[1].totalNumNodes > 1
    assert np.allclose(probabilities(found[0], one), probabilities(found[1], one))


def test_rows_that_come_twice_and_leaf_sizes(vectors):
    twice = vectors.unionByName(vectors)
    model = models.random_forest(5, 30, min_rows=40).fit(twice)
    assert model.totalNumNodes < models.random_forest(5, 30).fit(twice).totalNumNodes
    for part in model.pieces:
        for row in part.collect():
            assert np.frombuffer(row.counts, np.int64).min() >= 40


def test_split_points_part_the_weight_evenly():
    assert list(forests.split_points(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4), 32)) == [1.5, 2.5]
    assert len(forests.split_points(np.array([2.0, 2.0]), np.ones(2), 32)) == 0
    cuts = forests.split_points(np.arange(1000.0), np.ones(1000), 4)
    assert list(cuts) == [249.5, 499.5, 749.5]
    heavy = forests.split_points(np.arange(100.0), np.where(np.arange(100) == 50, 1000.0, 1.0), 8)
    assert {49.5, 50.5} & set(heavy)


def test_leaves_that_predict_the_same_are_merged():
    tree = {
        "feature": np.array([0, 1, -1, -1, -1], np.int16), "bin": np.zeros(5, np.uint8), "left_child": np.array([1, 3, -1, -1, -1], np.int32),
        "weights": np.array([10.0, 6, 4, 3, 3]), "positives": np.array([4.0, 1, 3, 0, 1]), "gains": np.array([0.2, 0.1, 0, 0, 0]), "counts": np.array([10, 6, 4, 3, 3]),
    }
    merged = forests.merged_leaves(tree)
    assert list(merged["feature"]) == [0, -1, -1] and list(merged["left_child"]) == [1, -1, -1] and list(merged["weights"]) == [10, 6, 4]
    tree["positives"][2] = 1
    assert len(forests.merged_leaves(tree)["feature"]) == 1


def test_categories_and_more_classes_are_left_to_spark(vectors):
    three = vectors.withColumn("label", (F.col("ID") % 3).cast("double"))
    assert isinstance(models.random_forest(2, 3).fit(three), RandomForestClassificationModel)


def test_features_are_drawn_in_the_order_of_a_reservoir():
    """The first of equal gains wins, so another order would favour other features than Spark does."""
    drawn = forests._drawn_features(np.random.default_rng(1), 20_000, 40, 6)
    assert all(len(set(row)) == 6 for row in drawn)
    assert np.allclose(np.bincount(drawn.ravel(), minlength=40) / 20_000, 6 / 40, atol=0.015)
    rows, places = np.nonzero(drawn < 6)
    assert (drawn[rows, places] == places).all()
    for place in range(6):
        assert np.allclose(np.bincount(drawn[:, place], minlength=40)[6:] / 20_000, 1 / 40, atol=0.008)
