from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import attribution, models
from ebbtide.operators.metrics import ranking_metrics
from ebbtide.plans import training
from ebbtide.plans.scoring import load_model, score
from ebbtide.schemas import CHURNED, ID
from ebbtide.session import stage
from ebbtide.sources.runs import RunLog


@pytest.fixture(scope="module")
def rows(spark):
    """Churn depends on two columns; ``junk`` is noise and ``word`` a category of its own effect."""
    draw = np.random.default_rng(11)
    n = 600
    frame = pd.DataFrame({"ID": np.arange(n), "a": draw.normal(size=n), "b": draw.normal(size=n), "junk": draw.normal(size=n)})
    frame["word"] = draw.choice([f"w{i}" for i in range(7)], size=n)
    frame["kind"] = draw.choice(["p", "q"], size=n)
    logit = 2 * frame.a - frame.b + (frame.word == "w3") * 1.5 - 1
    frame["churned"] = draw.random(n) < 1 / (1 + np.exp(-logit))
    return stage(training.model_rows(spark.createDataFrame(frame)), "rows")


@pytest.fixture(scope="module")
def halves(rows):
    cut = F.col(ID) % 4 > 0
    return training.weighted_part(rows, cut), training.weighted_part(rows, ~cut)


def test_logistic_regression_is_the_penalised_optimum(spark, halves):
    """At the optimum of C * weighted loss + |w|^2 / 2 the gradient of every coefficient is zero."""
    train, _ = halves
    model = models.encoded_pipeline(train, models.logistic_regression(train), training.BOOKKEEPING)
    frame = models.assembled(model, train).toPandas()
    x = np.vstack([v.toArray() for v in frame["features"]])
    w = np.array(list(models.coefficients(model).values()))
    p = 1 / (1 + np.exp(-(x @ w + model.stages[-1].intercept)))
    residual = frame.weight.to_numpy() * (p - frame.label.to_numpy())
    assert np.abs(x.T @ residual + w).max() < 0.05
    assert abs(residual.sum()) < 0.05


def test_linear_attribution_is_the_mean_of_row_contributions(halves):
    train, valid = halves
    model = models.encoded_pipeline(train, models.logistic_regression(train), training.BOOKKEEPING)
    table = {r.feature: r.importance for r in training.linear_importances(model, train, valid).collect()}
    one, two = models.assembled(model, train), models.assembled(model, valid)
    rows = attribution.linear_contributions(one, two, models.coefficients(model), ID)
    means = {r.feature: r.mean_contribution for r in attribution.contribution_summary(rows).collect()}
    assert table == pytest.approx(means)


@pytest.fixture(scope="module")
def boosted(halves):
    return training.fit_boosting(*halves, rounds=12, depth=3, rate=0.3, patience=4)


def test_boosting_stops_at_the_best_round(boosted, halves):
    model, curve = boosted
    losses = [r.value for r in curve.where("split = 'valid'").orderBy("iteration").collect()]
    assert model.stages[-1].getNumTrees == models.best_round(losses, 4)
    assert curve.where("split = 'train'").count() == 12
    assert models.source_column(model, "word_index") == "word"


def test_a_fit_that_stops_early_gives_the_model_of_all_rounds(halves):
    """With a patience of one round it begins with four and goes on only while the loss falls."""
    model, curve = training.fit_boosting(*halves, rounds=60, depth=4, rate=1.0, patience=1)
    whole = models.native_category_pipeline(halves[0], models.boosting(60, 4, 1.0), training.BOOKKEEPING)
    losses = whole.stages[-1].evaluateEachIteration(models.assembled(whole, halves[1]))
    fitted, best = curve.where("split = 'valid'").count(), models.best_round(losses, 1)
    assert best < fitted < 60 and model.stages[-1].getNumTrees == best
    shown = [r.value for r in curve.where("split = 'valid'").orderBy("iteration").collect()]
    assert shown == pytest.approx(losses[:fitted], rel=1e-6)


def test_best_round_has_patience():
    losses = [5, 4, 4.5, 4.4, 4.3, 3.9, 6, 6, 6, 1]
    assert models.best_round(losses, patience=4) == 10
    assert models.best_round(losses, patience=3) == 2
    assert models.best_round([1.0]) == 1


def test_tree_contributions_give_the_margin(boosted, halves):
    model, _ = boosted
    rows = models.assembled(model, halves[1]).select(ID, "features")
    names = models.vector_features(model)
    found = attribution.tree_contributions(model.stages[-1], rows, names, ID).toPandas()
    assert set(found.feature) == set(names)
    totals = found.groupby(ID).contribution.sum() + found.groupby(ID).bias.first()
    p = model.stages[-1].transform(rows).select(ID, training.positive_probability().alias("p")).toPandas().set_index(ID).p
    assert np.allclose(totals.loc[p.index], np.log(p / (1 - p)) / 2)
    summary = attribution.contribution_summary(halves[0].sparkSession.createDataFrame(found)).toPandas().set_index("feature")
    assert summary.mean_abs_contribution.drop("a").max() < summary.mean_abs_contribution["a"]


def test_contributions_add_up_inside_the_tasks(boosted, halves):
    """Summary and dependence equal those of the rows, for boosting and for a forest of deep trees."""
    train, valid = halves
    forest = models.native_category_pipeline(train, models.random_forest(5, 30), training.BOOKKEEPING)
    for model in (boosted[0], forest):
        fitted, names = model.stages[-1], models.vector_features(model)
        rows = stage(models.assembled(model, valid).select(ID, "features").repartition(3), "vectors")
        found = stage(attribution.tree_contributions(fitted, rows, names, ID), "contributions")
        for slow, fast, key in (
            (attribution.contribution_summary(found), attribution.tree_contribution_summary(fitted, rows, names), ["feature"]),
            (attribution.dependence(found), attribution.tree_dependence(fitted, rows, names), ["feature", "bin"]),
        ):
            a, b = (x.toPandas().sort_values(key, ignore_index=True)[slow.columns] for x in (slow, fast))
            pd.testing.assert_frame_equal(a, b, check_dtype=False)
        assert attribution.tree_dependence(fitted, rows.limit(0), names).count() == 0
    p = forest.transform(valid).select(ID, training.positive_probability().alias("p")).toPandas().set_index(ID).p
    table = found.toPandas()
    totals = table.groupby(ID).contribution.sum() + table.groupby(ID).bias.first()
    assert np.allclose(totals.loc[p.index], p)


def test_ranking_curves_end_at_the_scores_of_the_model(boosted, halves):
    model, _ = boosted
    rows = {"valid": models.assembled(model, halves[1])}
    curves = models.ranking_curves(model.stages[-1], rows, CHURNED).toPandas()
    last = curves[curves.iteration == model.stages[-1].getNumTrees].set_index("metric").value
    scored = model.transform(halves[1]).withColumn("p", training.positive_probability())
    expected = ranking_metrics(scored, CHURNED, "p", "weight").first()
    assert last["auc"] == pytest.approx(expected.auc) and len(curves) == 2 * model.stages[-1].getNumTrees
    assert last["average_precision"] == pytest.approx(expected.average_precision)


def test_isotonic_calibration_is_monotone_and_ignores_row_order(spark, halves):
    draw = np.random.default_rng(2)
    p = np.round(draw.random(400), 2)
    frame = spark.createDataFrame(pd.DataFrame({"p": p, "y": draw.random(400) < p**2, "w": draw.choice([1.0, 2.0], 400)}))
    fitted = models.fit_isotonic(frame, "y", "p", "w")
    out = models.calibrate(frame, fitted, "p", "c").toPandas().sort_values("p")
    assert (out.c.diff().dropna() >= -1e-12).all()
    assert (out.w * out.c).sum() == pytest.approx((out.w * out.y).sum())


@pytest.mark.parametrize("same_split", [True, False])
def test_calibrated_training(rows, same_split):
    result = training.train_evaluate(rows, lambda t: models.random_forest(10, 4), calibrated=True, same_split=same_split)
    values = {r.metric: r.value for r in result.metrics.collect()}
    assert values["auc"] > 0.7 and 0 < result.threshold <= 1
    assert sum(r.bin_rows for r in result.extra["calibration_before"].collect()) == 120
    best = result.importances.first()
    assert best.feature == "a"


def test_elimination_drops_whole_columns_only(rows):
    result, dropped = training.eliminate(rows, lambda t: models.random_forest(10, 4), limit=0.04)
    assert "junk" in dropped or "kind" in dropped
    assert not {"a", "b"} & set(dropped)
    left = {models.source_column(result.model, f) for f in models.vector_features(result.model)}
    assert not left & set(dropped)


def test_noise_elimination_ends_without_the_noise(rows):
    result, kept, dropped = training.eliminate_by_noise(rows, rounds=5, depth=3, rate=0.3, patience=5)
    assert training.NOISE not in kept and "a" in kept and not set(kept) & set(dropped)
    assert result.metrics.count() == 12


def test_training_job_logs_every_run(spark, rows, tmp_path):
    path = str(tmp_path)
    rows.drop("label").withColumn("last_activity", F.current_date()).write.parquet(f"{path}/features")
    training.train(spark, f"{path}/features", f"{path}/log", folds=3, max_iter=20)
    log = RunLog(spark, f"{path}/log")
    runs = {r.name: r for r in log.read("runs").collect()}
    assert set(runs) == {"churn_logistic_regression", "split_1", "split_2", "split_3", "full_model"}
    assert runs["split_2"].parent_run_id == runs["churn_logistic_regression"].run_id
    metrics = log.read("metrics").groupBy("run_id").count().collect()
    assert sorted(r["count"] for r in metrics) == [13, 13, 13, 13, 24]
    by_fold = log.read("importances").groupBy("run_id").count().collect()
    assert len(by_fold) == 4 and {r["count"] for r in by_fold} == {by_fold[0]["count"]}
    assert "last_activity" not in runs["full_model"].parameters
    assert log.read("importances").count() > 0


def test_saved_model_scores_like_the_fitted_one(rows, halves, tmp_path):
    train, valid = halves
    model = models.encoded_pipeline(train, models.random_forest(5, 3), training.BOOKKEEPING)
    model.write().save(str(tmp_path / "model"))
    new = valid.drop(CHURNED, "label", "weight")
    ours = score(new, model, 0.4).toPandas().sort_values(ID, ignore_index=True)
    loaded = score(new, load_model(str(tmp_path / "model")), 0.4).toPandas().sort_values(ID, ignore_index=True)
    pd.testing.assert_frame_equal(ours, loaded)
    assert (ours.prediction == (ours.churn_probability > 0.4)).all()


def test_cross_validation_has_every_fold_and_metric(rows):
    values, summary = training.cross_validate(rows, lambda t: models.random_forest(5, 3), folds=3)
    assert values.count() == 36 and summary.count() == 12
    assert {r.fold for r in values.collect()} == {0, 1, 2}


def test_folds_keep_their_thresholds_and_importances(rows):
    """Fitted at the same time or one by one; the regression does not depend on the order of the rows."""
    def logistic(part):
        return models.logistic_regression(part, max_iter=50)

    apart, one = (training.fit_folds(rows, logistic, folds=3, with_importances=True, parallelism=n) for n in (3, 1))
    assert {r.fold for r in apart.thresholds.collect()} == {0, 1, 2}
    for part, key, value in (("importances", ["fold", "feature"], "importance"), ("thresholds", ["fold"], "threshold"), ("values", ["fold", "metric"], "value")):
        ours, theirs = (getattr(f, part).toPandas().set_index(key)[value].to_dict() for f in (apart, one))
        assert ours == pytest.approx(theirs, abs=1e-6)


class CountedFits:
    """Counts the fits of an encoder."""

    def __init__(self, fit):
        self.fit, self.calls = fit, 0

    def __call__(self, *args, **kwargs):
        self.calls += 1
        return self.fit(*args, **kwargs)


def test_elimination_encodes_once_and_logs_every_fit(spark, rows, tmp_path):
    fits, log = CountedFits(models.fit_column_encoder), RunLog(spark, str(tmp_path))
    result, dropped = training.eliminate(rows, lambda t: models.random_forest(10, 4), limit=0.04, encode=fits, calibrated=True, log=log)
    assert fits.calls == 1 and dropped
    names = [r.name for r in log.read("runs").collect()]
    assert names.count("elimination") == 1 and names.count("full_model") >= 2
    assert {r.stage for r in log.read("calibration").collect()} == {"before", "after"}
    short = rows.drop(*dropped).limit(50)
    assert result.model.transform(short).count() == 50


def test_elimination_gives_the_model_a_refit_gives(rows):
    """Slices of the vectors and a pipeline fitted anew on the columns that stay score alike."""
    for estimator in (lambda t: models.random_forest(1, 4).setBootstrap(False), lambda t: models.logistic_regression(t, max_iter=50)):
        result, dropped = training.eliminate(rows, estimator, limit=0.01)
        again = training.train_evaluate(rows.drop(*dropped), estimator, same_split=True)
        ours, theirs = ({r.metric: r.value for r in x.metrics.collect()} for x in (result, again))
        assert ours == pytest.approx(theirs, abs=1e-6)
        table, other = ({r.feature: r.importance for r in x.importances.collect()} for x in (result, again))
        assert table == pytest.approx(other, abs=1e-6)


def test_noise_elimination_logs_curves(spark, rows, tmp_path):
    log = RunLog(spark, str(tmp_path))
    result, kept, dropped = training.eliminate_by_noise(rows, rounds=4, depth=2, rate=0.3, patience=4, log=log)
    assert log.read("curves").where("split = 'valid'").count() >= 8
    assert result.model.transform(rows.drop(*dropped).limit(20)).count() == 20


def test_a_run_without_manifest_is_not_read(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    assert log.read("runs").count() == 0
    with pytest.raises(RuntimeError):
        with log.run("killed") as run_id:
            log.values(run_id, {"auc": 0.5})
            log.values(log.start("below", parent=run_id), {"auc": 0.6})
            raise RuntimeError
    assert log.read("runs").count() == 0 and log.read("metrics").count() == 0
    other = RunLog(spark, str(tmp_path))
    with other.run("whole") as run_id:
        other.values(run_id, {"auc": 0.7})
        assert other.read("metrics").count() == 0
    assert [(r.run_id, r.value) for r in log.read("metrics").collect()] == [(run_id, 0.7)]


def test_forests_keep_node_numbers(spark):
    """Otherwise every pass sends all deep trees to every task."""
    assert models.random_forest(2, 3).getCacheNodeIds()


def test_training_makes_no_second_copy_of_the_wide_rows(spark, monkeypatch):
    from ebbtide import session
    from ebbtide.operators import ranking, splits

    written = []

    def recorded(df, name):
        written.append((name, len(df.columns)))
        return session.stage(df, name)

    for module in (training, splits, ranking):
        monkeypatch.setattr(module, "stage", recorded)
    rows = spark.createDataFrame(
        [(i, i % 3 == 0, float(i % 3 == 0), float(i % 7), float(i % 5), float(i % 2)) for i in range(120)],
        "ID long, churned boolean, label double, a double, b double, c double",
    )
    training.train_evaluate(rows, models.logistic_regression)
    training.fit_folds(rows, models.logistic_regression, folds=2)
    assert {name for name, _ in written} >= {"cuts", "scores"}
    assert all(columns < len(rows.columns) for _, columns in written)


def test_what_looks_at_a_boosted_model_reads_its_written_vectors(halves):
    model, curve, train, valid = training.fit_boosting_on_vectors(*halves, rounds=3, depth=2, rate=0.3, patience=3)
    for written, part in ((train, halves[0]), (valid, halves[1])):
        assert all("/boosting-rows-" in file for file in written.inputFiles())
        made = {r[ID]: r.features for r in models.assembled(model, part).select(ID, "features").collect()}
        assert {r[ID]: r.features for r in written.collect()} == made
    assert curve.count() == 6


def test_noise_elimination_writes_no_wide_rows(rows, monkeypatch):
    """The noise is drawn when the vectors are written; each fit reads slices that are written."""
    written = []

    def recorded(df, name):
        written.append((name, len(df.columns)))
        return stage(df, name)

    for module in (training, models):
        monkeypatch.setattr(module, "stage", recorded)
    training.eliminate_by_noise(rows, rounds=3, depth=2, rate=0.3, patience=3)
    names = [name for name, _ in written]
    assert "noise-rows" not in names and names.count("encoded-rows") == 1 and names.count("boosting-rows") >= 4
