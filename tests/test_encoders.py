from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ebbtide.functions import columns as cols
from ebbtide.operators import correlation, encoders
from ebbtide.operators.attributes import clean_attributes


def letters(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "ID int, c string")


def test_unseen_and_null_categories(spark):
    fitted, later = letters(spark, ["c", "a", "b", "a"]), letters(spark, ["a", "b", "zz", None])
    made = encoders.one_hot_columns(encoders.one_hot_labels(fitted, ["c"]))
    assert list(made) == ["c_b", "c_c"]
    rows = later.select("ID", *[col.alias(n) for n, col in made.items()]).orderBy("ID").collect()
    assert [(r.c_b, r.c_c) for r in rows] == [(0, 0), (1, 0), (0, 0), (0, 0)]
    coded = encoders.ordinal_encode(later, "c", encoders.ordinal_labels(fitted, "c")).orderBy("ID").collect()
    assert [r.c for r in coded] == [0, 1, -1, None]
    nan = encoders.ordinal_encode(later, "c", encoders.ordinal_labels(fitted, "c"), float("nan")).orderBy("ID").collect()
    assert math.isnan(nan[2].c) and nan[3].c is None


def test_routing_at_the_limit(spark):
    frame = spark.createDataFrame([(str(i % 5), str(i % 6), None) for i in range(30)], "five string, six string, none string")
    assert encoders.route_columns(frame) == (["five", "none"], ["six"])


def test_constant_column_has_scale_one(spark):
    frame = spark.createDataFrame([(5.0, float(i)) for i in range(9)], "same double, x double")
    assert encoders.standard_scale(frame, ["same"])["same"] == (5.0, 1.0)
    assert encoders.robust_scale(frame, ["same"])["same"] == (5.0, 1.0)
    assert encoders.standard_scale(frame, ["x"])["x"] == pytest.approx((4.0, np.std(range(9))))
    assert encoders.robust_scale(frame, ["x"])["x"] == (4.0, 4.0)


def mixed(spark, n=60):
    draw = random.Random(3)
    rows = [(i, f"k{draw.randrange(0, 9)}", draw.choice("xyz"), i % 2 == 0, draw.random() * 10) for i in range(n)]
    return spark.createDataFrame(rows, "ID bigint, many string, few string, flag boolean, x double")


def test_encoder_in_a_saved_pipeline(spark, tmp_path):
    frame = mixed(spark)
    model = Pipeline(stages=[encoders.ColumnEncoder(excluded=["ID"], nullCode=-2.0)]).fit(frame)
    model.write().save(str(tmp_path / "m"))
    unseen = spark.createDataFrame([(100, "zz", "q", True, 1.0), (101, None, None, False, 2.0)], frame.schema)
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert all(str(tmp_path) in f for f in loaded.stages[0].labels.inputFiles())  # not where fitting kept its tables
    after = loaded.transform(frame.union(unseen)).toPandas().set_index("ID")
    assert list(after.columns) == ["few_y", "few_z", "many", "x", "flag"]
    assert after.loc[100, "many"] == -1 and after.loc[101, "many"] == -2
    assert after.loc[100, ["few_y", "few_z"]].sum() == 0
    before = frame.toPandas().set_index("ID")
    order = {v: i for i, v in enumerate(sorted(before.many.unique()))}
    assert (after.loc[before.index, "many"] == before.many.map(order)).all()
    q1, q2, q3 = np.percentile(before.x, [25, 50, 75])
    assert np.allclose(after.loc[before.index, "x"], (before.x - q2) / (q3 - q1))
    assert model.stages[0].source_of("few_y") == "few" and model.stages[0].source_of("x") == "x"


def test_many_labels_are_saved_with_the_model(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"v{i:04d}") for i in range(700)], "ID bigint, many string")
    model = Pipeline(stages=[encoders.ColumnEncoder(excluded=["ID"])]).fit(frame)
    model.write().save(str(tmp_path / "m"))
    codes = PipelineModel.load(str(tmp_path / "m")).transform(frame).collect()
    assert len(codes) == 700 and all(r.many == r.ID for r in codes)


def test_a_missing_value_is_a_category_where_fitting_saw_one(spark):
    frame = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "x")], "ID bigint, gaps string, full string")
    model = encoders.ColumnEncoder(excluded=["ID"]).fit(frame)
    asked = spark.createDataFrame([(1, "b", "y"), (2, None, None), (3, "zz", "q")], frame.schema)
    found = model.transform(asked).orderBy("ID").drop("ID")
    assert found.columns == ["gaps_b", "gaps_None", "full_y"]
    assert [tuple(r) for r in found.collect()] == [(1, 0, 1), (0, 1, 0), (0, 0, 0)]
    assert model.source_of("gaps_None") == "gaps"


def test_correlations_take_complete_pairs(spark):
    draw = np.random.default_rng(6)
    data = pd.DataFrame({c: draw.normal(size=120) for c in "abc"}) + 1e6
    data["c"] += data["a"]
    holes = data.mask(draw.random(data.shape) < 0.3)
    holes["none"] = np.nan
    holes["churned"] = [None if draw.random() < 0.2 else bool(x > 1e6) for x in data["a"]]
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in holes.itertuples(index=False)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, none double, churned boolean")
    want = holes[["a", "b", "c"]].corr()
    pairs = correlation.correlation_pairs(frame, ["a", "b", "c", "none"], lower_triangle=False).collect()
    assert len(pairs) == 16
    for r in pairs:
        if "none" in (r.feature, r.other):
            assert r.correlation is None
        else:
            assert r.correlation == pytest.approx(want.loc[r.feature, r.other], abs=1e-6)
    target = holes["churned"].astype("float")
    for r in correlation.correlation_with_target(frame, ["a", "b", "none"], "churned").collect():
        assert r.correlation is None if r.feature == "none" else r.correlation == pytest.approx(holes[r.feature].corr(target), abs=1e-6)


def test_correlations(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=200)
    data = {"a": x, "b": 2 * x + draw.normal(size=200), "c": np.ones(200), "churned": x > 0}
    frame = spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values())], list(data))
    pairs = {(r.feature, r.other): r.correlation for r in correlation.correlation_pairs(frame, ["a", "b", "c"]).collect()}
    assert set(pairs) == {("b", "a"), ("c", "a"), ("c", "b")}
    assert pairs["b", "a"] == pytest.approx(np.corrcoef(data["a"], data["b"])[0, 1])
    assert pairs["c", "a"] is None
    ranked = correlation.ranked_by_correlation(correlation.correlation_with_target(frame, ["a", "b", "c"], "churned")).collect()
    assert [r.feature for r in ranked][2] == "c" and ranked[2].correlation is None
    assert ranked[0].correlation >= ranked[1].correlation
    assert len(correlation.correlation_pairs(frame, ["a", "b"], lower_triangle=False).collect()) == 4


def test_selectors_casts_and_cleaning(spark):
    frame = mixed(spark, 3).withColumn("day", F.lit("2024-01-01").cast("date"))
    assert cols.string_columns(frame) == ["many", "few"] and cols.numeric_columns(frame) == ["ID", "x"]
    assert dict(cols.doubles_to_floats(frame).dtypes)["x"] == "float"
    holes = spark.createDataFrame([(None, None, None, None)], "i int, d double, s string, b boolean")
    assert tuple(cols.fill_numeric_nulls(holes).first()) == (0, 0.0, None, None)
    assert cols.drop_by_suffix(frame, ("y", "w")).columns == ["ID", "flag", "x"]
    noise = cols.with_noise(spark.range(2000), seed=1).agg(F.avg("noise"), F.stddev("noise")).first()
    assert abs(noise[0]) < 0.1 and abs(noise[1] - 1) < 0.1
    people = spark.createDataFrame([(1, None, "NL", None, "F", True)], "ID int, mobile_device string, country string, preferred_language string, gender string, is_company boolean")
    assert tuple(clean_attributes(people).first()) == (1, "unknown", "nl", None, "f", True)


def test_quartiles_of_many_columns_are_exact(spark, monkeypatch):
    """Also of values that differ in their last bits, come often, or are not numbers; no value is moved by itself."""
    from ebbtide.operators import quantiles

    monkeypatch.setattr(quantiles, "exact_quantiles", None)
    draw = np.random.default_rng(8)
    n = 1001
    data = pd.DataFrame({
        "close": 1 + draw.integers(0, 50, n) * 2.0**-52, "sign": draw.normal(size=n), "hot": np.where(draw.random(n) < 0.9, 0.0, draw.normal(size=n)),
        "zeros": np.where(draw.random(n) < 0.5, -0.0, 0.0), "large": draw.normal(size=n) * 1e300, "holes": np.where(draw.random(n) < 0.3, np.nan, draw.random(n)),
        "one": [float("inf")] + [7.0] * (n - 1),
    })
    frame = spark.createDataFrame(data).repartition(5).withColumn("none", F.lit(None).cast("double")).withColumn("whole", F.lit(2**53 + 2).cast("bigint"))
    frame = frame.withColumn("holes", F.when(F.col("sign") > 0.5, None).otherwise(F.col("holes"))).withColumn("single", F.col("sign").cast("float"))
    names = frame.columns
    found = {r.column: list(r.quantiles) for r in encoders.column_quartiles(frame, names).collect()}
    assert set(found) == set(names) - {"none"}
    table = frame.toPandas()
    for name, quartiles in found.items():
        assert quartiles == pytest.approx(np.nanquantile(table[name].astype(float), [0.25, 0.5, 0.75]), rel=1e-15, abs=0), name
    assert encoders.column_quartiles(frame.limit(0), names).count() == 0
    assert encoders.robust_scale(frame, ["none", "whole"]) == {"none": (0.0, 1.0), "whole": (float(2**53 + 2), 1.0)}
