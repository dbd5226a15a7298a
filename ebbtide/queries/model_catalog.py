"""Queries that fit models. Fitting has no SQL form, so where it can be done the query returns
something SQL can still state: a closed form of the fit, or an identity the result must satisfy."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import attribution, models
from ebbtide.operators.splits import stratified_split
from ebbtide.plans import training
from ebbtide.plans.feature_table import scoring_table, training_table
from ebbtide.plans.scoring import Bundle, with_message
from ebbtide.operators.attributes import clean_attributes
from ebbtide.queries.catalog import (
    FOLDS,
    LABELS,
    METRIC_LIST,
    SCORED,
    SPLIT,
    _metric_values,
    inputs,
    labels,
    register,
    rounded,
    scored,
)
from ebbtide.queries import views_sql as sql
from ebbtide.schemas import CHURNED, ID
from ebbtide.session import stage, work_folder
from ebbtide.sources import retail_views as views
from ebbtide.sources.runs import RunLog

# Forests, regressions and folds have their full budgets. Boosting stops after PATIENCE rounds without gain; its most
# rounds are an argument of the job, set here to what a query can wait for.
TREES, TREE_DEPTH, ITERATIONS = 100, 30, 100
ROUNDS, ROUND_DEPTH, PATIENCE = 24, 5, 6


def rows_for_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(training.model_rows(training_table(*inputs(spark, sf_dir))), "model-rows")


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = stratified_split(rows_for_models(spark, sf_dir), CHURNED, ID)
    return (
        training.weighted_part(rows, F.col("split") == "train"),
        training.weighted_part(rows, F.col("split") == "test"),
    )


def logistic(train: DataFrame):
    return models.logistic_regression(train, max_iter=ITERATIONS)


def forest(train: DataFrame):
    return models.random_forest(TREES, TREE_DEPTH)


@register("logistic_regression_coefficients")
def logistic_coefficients(spark, sf_dir):
    train, _ = parts(spark, sf_dir)
    model = models.encoded_pipeline(train, logistic(train), training.BOOKKEEPING)
    return attribution.named_values(spark, models.coefficients(model), "coefficient")


@register("random_forest_importances")
def forest_importances(spark, sf_dir):
    train, _ = parts(spark, sf_dir)
    model = models.encoded_pipeline(train, forest(train), training.BOOKKEEPING)
    return attribution.importance_table(spark, models.importances(model))


def _boosted(train: DataFrame, valid: DataFrame):
    """Model, learning curves and the written vectors of both parts."""
    return training.fit_boosting_on_vectors(train, valid, ROUNDS, ROUND_DEPTH, 0.1, patience=PATIENCE)


@register("boosting_learning_curves")
def boosting_curves(spark, sf_dir):
    train, valid = parts(spark, sf_dir)
    return _boosted(train, valid)[1]


@register("boosting_ranking_curves")
def boosting_ranking_curves(spark, sf_dir):
    train, valid = parts(spark, sf_dir)
    model, _, train, valid = _boosted(train, valid)
    return models.ranking_curves(model.stages[-1], {"train": train, "valid": valid}, CHURNED)


@register("boosting_importances")
def boosting_importances(spark, sf_dir):
    train, valid = parts(spark, sf_dir)
    return attribution.importance_table(spark, models.importances(_boosted(train, valid)[0]))


# The users of the evaluation part that have features, each with a difference of nothing.
TEST_USERS = (
    f"{sql.INPUTS}, {sql.LABEL}, known AS (SELECT ID, churned FROM label WHERE ID IN (SELECT ID FROM counted)), "
    + SPLIT[len(LABELS) + 2 :].replace("FROM label", "FROM known")
)


@register("tree_contributions_add_up", f"{TEST_USERS} SELECT ID, CAST(0 AS DOUBLE) AS difference FROM parted WHERE split = 'test'")
def tree_contributions_add_up(spark, sf_dir):
    """Path contributions plus bias minus the raw margin of the model, per user of the test part."""
    train, valid = parts(spark, sf_dir)
    model, _, _, rows = _boosted(train, valid)
    margins = model.stages[-1].transform(rows).select(
        ID, (F.log(training.positive_probability() / (1 - training.positive_probability())) / 2).alias("margin")
    )
    contributions = attribution.tree_contributions(model.stages[-1], rows, models.vector_features(model), ID)
    totals = contributions.groupBy(ID).agg((F.sum("contribution") + F.max("bias")).alias("total"))
    joined = totals.join(margins, ID)
    return joined.select(ID, F.abs(F.round(F.col("total") - F.col("margin"), 6)).alias("difference"))


@register("tree_contribution_summary")
def tree_contribution_summary(spark, sf_dir):
    train, valid = parts(spark, sf_dir)
    model, _, _, rows = _boosted(train, valid)
    return attribution.tree_contribution_summary(model.stages[-1], rows, models.vector_features(model))


@register("tree_contribution_dependence")
def tree_contribution_dependence(spark, sf_dir):
    train, valid = parts(spark, sf_dir)
    model, _, _, rows = _boosted(train, valid)
    return attribution.tree_dependence(model.stages[-1], rows, models.vector_features(model))


# Isotonic regression has a closed form: the largest over all starts of the smallest mean over all ends.
ISOTONIC = f"""{SCORED},
points AS (SELECT p, sum(w) AS w, sum(w * CAST(churned AS DOUBLE)) AS wy, row_number() OVER (ORDER BY p) AS i
           FROM scored GROUP BY p),
sums AS (SELECT *, sum(w) OVER (ORDER BY i) AS cw, sum(wy) OVER (ORDER BY i) AS cwy FROM points),
means AS (SELECT a.i AS j, b.i AS k, (b.cwy - a.cwy + a.wy) / (b.cw - a.cw + a.w) AS mean
          FROM sums a JOIN sums b ON a.i <= b.i),
least AS (SELECT j, k, min(mean) OVER (PARTITION BY j ORDER BY k DESC) AS m FROM means),
fitted AS (SELECT k AS i, max(m) AS calibrated FROM least GROUP BY k)"""


@register("isotonic_calibration", f"{ISOTONIC} SELECT ID, round(calibrated, 6) AS calibrated FROM scored JOIN points USING (p) JOIN fitted USING (i)")
def isotonic_calibration(spark, sf_dir):
    rows = scored(spark, sf_dir)
    calibrator = models.fit_isotonic(rows, CHURNED, "p", "w")
    return rounded(models.calibrate(rows, calibrator, "p", "calibrated").select(ID, "calibrated"), ["calibrated"])


@register("calibrated_training_metrics")
def calibrated_training(spark, sf_dir):
    return training.train_evaluate(rows_for_models(spark, sf_dir), forest, calibrated=True).metrics


@register("calibration_before_and_after")
def calibration_before_and_after(spark, sf_dir):
    result = training.train_evaluate(rows_for_models(spark, sf_dir), forest, calibrated=True, same_split=True)
    before = result.extra["calibration_before"].withColumn("stage", F.lit("before"))
    return before.unionByName(result.extra["calibration"].withColumn("stage", F.lit("after")))


@register("linear_training_importances")
def linear_training(spark, sf_dir):
    return training.train_evaluate(rows_for_models(spark, sf_dir), logistic).importances


@register("cross_validation_summary")
def cross_validation(spark, sf_dir):
    return training.cross_validate(rows_for_models(spark, sf_dir), logistic)[1]


def _column_fates(spark: SparkSession, kept: list[str], dropped: list[str]) -> DataFrame:
    rows = [(c, "kept") for c in kept] + [(c, "dropped") for c in dropped]
    return spark.createDataFrame(rows, "feature string, fate string")


@register("elimination_by_importance")
def elimination(spark, sf_dir):
    rows = rows_for_models(spark, sf_dir)
    _, dropped = training.eliminate(rows, forest)
    kept = [c for c in rows.columns if c not in [*training.BOOKKEEPING, *dropped]]
    return _column_fates(spark, kept, dropped)


@register("elimination_by_noise")
def noise_elimination(spark, sf_dir):
    _, kept, dropped = training.eliminate_by_noise(
        rows_for_models(spark, sf_dir), rounds=ROUNDS, depth=ROUND_DEPTH, patience=PATIENCE
    )
    return _column_fates(spark, kept, dropped)


@register("training_run_log")
def training_run_log(spark, sf_dir):
    """The whole training job on a written feature table; the result is its metric log."""
    folder = f"{work_folder(spark)}/training-{uuid.uuid4().hex}"
    training_table(*inputs(spark, sf_dir)).write.parquet(f"{folder}/features")
    training.train(spark, f"{folder}/features", f"{folder}/log", max_iter=ITERATIONS)
    log = RunLog(spark, f"{folder}/log")
    return log.read("metrics").join(log.read("runs").select("run_id", "name"), "run_id").select("name", "metric", "value")


@register("batch_scoring_with_saved_model")
def batch_scoring(spark, sf_dir):
    rows = rows_for_models(spark, sf_dir)
    result = training.train_evaluate(rows, logistic, calibrated=True)
    path = f"{work_folder(spark)}/saved-{uuid.uuid4().hex}"
    Bundle(result.model, result.threshold, result.calibrator).save(path)
    return with_message(Bundle.load(path).score(scoring_table(*inputs(spark, sf_dir))))


# ---- fits with a closed form ------------------------------------------------------------------------
# On one column of two values every model is saturated: a leaf is the weighted share of churners in it and the
# coefficient of an unpenalised regression is the difference of the weighted log odds.


def company_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = clean_attributes(views.attributes(spark, sf_dir)).select(ID, "is_company")
    churn = labels(spark, sf_dir).select(ID, CHURNED, F.col(CHURNED).cast("double").alias(models.LABEL))
    return stage(churn.join(people, ID), "company-rows")


def company_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = stage(stratified_split(company_rows(spark, sf_dir), CHURNED, ID), "split-rows")
    return tuple(training.weighted_part(rows, F.col("split") == part) for part in ("train", "test"))


def stump(train: DataFrame):
    return models.random_forest(trees=1, depth=1).setBootstrap(False)


STUMPS = f"""{FOLDS}, {sql.ATTRIBUTES},
known AS (SELECT ID, churned, fold, is_company AS x FROM folded JOIN attributes USING (ID)),
others AS (SELECT k.fold, t.churned, t.x, count(*) AS n FROM (SELECT DISTINCT fold FROM known) k JOIN known t ON t.fold <> k.fold
           GROUP BY k.fold, t.churned, t.x),
weighted AS (SELECT fold, x, churned, n * CAST(sum(n) OVER (PARTITION BY fold) AS DOUBLE) / (2 * sum(n) OVER (PARTITION BY fold, churned)) AS w
             FROM others),
leaves AS (SELECT fold, x, sum(CASE WHEN churned THEN w ELSE 0 END) / sum(w) AS p FROM weighted GROUP BY fold, x),
scored AS (SELECT ID, churned, fold, p, CAST(count(*) OVER (PARTITION BY fold) AS DOUBLE) / (2 * count(*) OVER (PARTITION BY fold, churned)) AS fw
           FROM known JOIN leaves USING (fold, x)),
{_metric_values('fw', 'p', 'fold')},
found AS (SELECT fold, metric, v FROM values_ UNPIVOT (v FOR metric IN ({METRIC_LIST})))"""


@register("cross_validation_of_stumps", f"{STUMPS} SELECT fold, metric, round(v, 6) AS value FROM found")
def stump_folds(spark, sf_dir):
    return rounded(training.fit_folds(company_rows(spark, sf_dir), stump, threshold=0.5).values, ["value"], 6)


@register(
    "cross_validation_run_log",
    f"{STUMPS} SELECT concat('split_', fold + 1) AS name, metric, round(v, 6) AS value FROM found "
    "UNION ALL SELECT DISTINCT concat('split_', fold + 1), 'threshold', CAST(0.5 AS DOUBLE) FROM found "
    "UNION ALL SELECT 'stumps', concat(metric, '_mean'), round(avg(v), 6) FROM found GROUP BY metric "
    "UNION ALL SELECT 'stumps', concat(metric, '_std'), round(stddev_pop(v), 6) FROM found GROUP BY metric",
)
def stump_run_log(spark, sf_dir):
    log = RunLog(spark, f"{work_folder(spark)}/log-{uuid.uuid4().hex}")
    with log.run("stumps") as main:
        training.log_folds(log, main, training.fit_folds(company_rows(spark, sf_dir), stump, threshold=0.5), ["is_company"])
    named = log.read("metrics").join(log.read("runs").select("run_id", "name"), "run_id")
    return rounded(named.select("name", "metric", "value"), ["value"], 6)


ONE_SPLIT = f"""{SPLIT}, {sql.ATTRIBUTES},
known AS (SELECT ID, churned, split, is_company AS x FROM parted JOIN attributes USING (ID)),
cells AS (SELECT x, churned, count(*) AS n FROM known WHERE split = 'train' GROUP BY x, churned),
weighted AS (SELECT x, churned, n * CAST(sum(n) OVER () AS DOUBLE) / (2 * sum(n) OVER (PARTITION BY churned)) AS w FROM cells),
shares AS (SELECT x, sum(CASE WHEN churned THEN w ELSE 0 END) / sum(w) AS p FROM weighted GROUP BY x),
overall AS (SELECT sum(CASE WHEN churned THEN w ELSE 0 END) / sum(w) AS q FROM weighted),
credited AS (SELECT ID, x, 'is_company' AS feature, 2 * (p - q) AS contribution FROM known JOIN shares USING (x), overall WHERE split = 'test')"""


def one_split(spark: SparkSession, sf_dir: str) -> tuple:
    """One round of boosting fits the label as -1 and 1, so the margin of a leaf is twice its share less one. Returns
    the model, the rows of the test part with their vectors, and the features."""
    train, valid = company_parts(spark, sf_dir)
    model = models.encoded_pipeline(train, models.boosting(rounds=1, depth=1), training.BOOKKEEPING)
    return model.stages[-1], stage(models.assembled(model, valid).select(ID, "features"), "vectors"), models.vector_features(model)


@register("tree_contributions_of_one_split", f"{ONE_SPLIT} SELECT ID, feature, round(contribution, 6) AS contribution FROM credited")
def contributions_of_one_split(spark, sf_dir):
    found = attribution.tree_contributions(*one_split(spark, sf_dir), ID)
    return rounded(found.select("ID", "feature", "contribution"), ["contribution"], 6)


@register(
    "tree_contribution_summary_of_one_split",
    f"{ONE_SPLIT} SELECT feature, round(avg(contribution), 6) AS mean_contribution, round(avg(abs(contribution)), 6) AS "
    "mean_abs_contribution FROM credited GROUP BY feature",
)
def summary_of_one_split(spark, sf_dir):
    found = attribution.tree_contribution_summary(*one_split(spark, sf_dir))
    return rounded(found, ["mean_contribution", "mean_abs_contribution"], 6)


@register(
    "tree_contribution_dependence_of_one_split",
    f"{ONE_SPLIT} SELECT feature, CAST(CASE WHEN x THEN 9 ELSE 0 END AS BIGINT) AS bin, avg(CASE WHEN x THEN 1.0 ELSE 0.0 END) AS "
    "mean_value, round(avg(contribution), 6) AS mean_contribution, count(*) AS bin_rows FROM credited GROUP BY feature, x",
)
def dependence_of_one_split(spark, sf_dir):
    return rounded(attribution.tree_dependence(*one_split(spark, sf_dir)), ["mean_value", "mean_contribution"], 6)


@register(
    "logistic_regression_of_one_column",
    f"{ONE_SPLIT} SELECT 'is_company' AS feature, round(sum(CASE WHEN x THEN 1 ELSE -1 END * ln(p / (1 - p))), 4) AS coefficient FROM shares",
)
def logistic_of_one_column(spark, sf_dir):
    train, _ = company_parts(spark, sf_dir)
    free = models.logistic_regression(train, inverse_strength=1e12, max_iter=200).setTol(1e-12)
    model = models.encoded_pipeline(train, free, training.BOOKKEEPING)
    return rounded(attribution.named_values(spark, models.coefficients(model), "coefficient"), ["coefficient"], 4)
