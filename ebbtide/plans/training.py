"""Training jobs: hold-out training with or without calibration, cross-validation, elimination.

The driver only loops over fits. Rows stay distributed; per fit the driver sees a threshold, twelve
metrics and one importance per feature. Every job can write a run log.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.columns import doubles_to_floats, with_noise
from ebbtide.operators import metrics as m
from ebbtide.operators.attribution import importance_table, linear_attribution
from ebbtide.operators.encoders import feature_output_columns
from ebbtide.operators.models import (
    FEATURES,
    LABEL,
    WEIGHT,
    EncodedRows,
    assembled,
    best_round,
    boosting,
    calibrate,
    coefficients,
    encode_once,
    encoded_pipeline,
    first_rounds,
    fit_category_indexer,
    fit_column_encoder,
    fit_isotonic,
    importances,
    learning_curve,
    logistic_regression,
    source_of,
)
from ebbtide.operators.splits import (
    stratified_folds,
    stratified_split,
    three_way_split,
    with_balanced_weights,
)
from ebbtide.plans.scoring import positive_probability
from ebbtide.schemas import CHURNED, ID
from ebbtide.session import stage
from ebbtide.sources.readers import read_features
from ebbtide.sources.runs import RunLog

PROBABILITY = "churn_probability"
NOISE = "noise"
LEAST_IMPORTANCE = 1e-4
# Names older feature tables may hold; dropped where present.
NOT_FEATURES = ["last_activity", "days_since_last_activity"]
BOOKKEEPING = [ID, CHURNED, LABEL, WEIGHT, "split", "fold"]

Estimator = Callable[[DataFrame], object]
PipelineFit = Callable[[DataFrame, object, list[str]], PipelineModel]


@dataclass
class Training:
    model: PipelineModel
    threshold: float
    metrics: DataFrame
    importances: DataFrame
    scored: DataFrame
    calibrator: object | None = None
    extra: dict = field(default_factory=dict)


def model_rows(features: DataFrame) -> DataFrame:
    """Feature table as model input: single precision and a numeric label."""
    return doubles_to_floats(features.drop(*NOT_FEATURES)).withColumn(LABEL, F.col(CHURNED).cast("double"))


def weighted_part(rows: DataFrame, condition) -> DataFrame:
    return with_balanced_weights(rows.where(condition), CHURNED, weight=WEIGHT)


def _scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    scored = model.transform(rows).withColumn(PROBABILITY, positive_probability())
    return stage(scored.select(ID, CHURNED, WEIGHT, PROBABILITY), "scores")


def pick_threshold(scored: DataFrame) -> float:
    return m.best_threshold(m.threshold_grid(scored, CHURNED, PROBABILITY, WEIGHT)).first()["threshold"]


def evaluate_scores(scored: DataFrame, threshold: float) -> DataFrame:
    decided = scored.withColumn("prediction", F.col(PROBABILITY) > threshold)
    return m.metric_rows(m.evaluate(decided, CHURNED, "prediction", PROBABILITY, WEIGHT))


def linear_importances(model: PipelineModel, train: DataFrame, valid: DataFrame) -> DataFrame:
    return linear_attribution(assembled(model, train), assembled(model, valid), coefficients(model)).orderBy(
        "importance"
    )


def model_importances(model: PipelineModel, train: DataFrame, valid: DataFrame) -> DataFrame:
    if hasattr(model.stages[-1], "featureImportances"):
        return importance_table(train.sparkSession, importances(model))
    return linear_importances(model, train, valid)


def train_evaluate(
    rows: DataFrame,
    estimator: Estimator,
    calibrated: bool = False,
    same_split: bool = False,
    threshold: float | None = None,
    fit: PipelineFit = encoded_pipeline,
    seed: int = 42,
) -> Training:
    """Fit on 80 %, evaluate on 20 %. Calibration takes a part of its own (10 % of all) out of the
    training rows unless ``same_split`` asks to calibrate on the evaluation rows. Without a given
    threshold the one of best F1 on the evaluation rows is used. ``rows`` are scanned several times, so they are best
    a written table."""
    apart = calibrated and not same_split
    if "split" not in rows.columns:
        rows = (
            three_way_split(rows, CHURNED, ID, valid_size=0.1, test_size=0.2, seed=seed)
            if apart
            else stratified_split(rows, CHURNED, ID, seed=seed)
        )
    train = weighted_part(rows, F.col("split") == "train")
    valid = weighted_part(rows, F.col("split") == "test")
    model = fit(train, estimator(train), BOOKKEEPING)
    scored = _scores(model, valid)
    base = None
    if calibrated:
        base = _scores(model, weighted_part(rows, F.col("split") == "valid")) if apart else scored
    return _judged(model, scored, base, model_importances(model, train, valid), threshold)


def _judged(
    model: PipelineModel, scored: DataFrame, base: DataFrame | None, table: DataFrame, threshold: float | None = None
) -> Training:
    """Calibrated by the scores of ``base`` where there are any, with a threshold and metrics."""
    extra, calibrator = {}, None
    if base is not None:
        extra["calibration_before"] = m.calibration_points(scored, CHURNED, PROBABILITY)
        extra["threshold_uncalibrated"] = pick_threshold(scored)
        calibrator = fit_isotonic(base, CHURNED, PROBABILITY, WEIGHT)
        scored = stage(calibrate(scored, calibrator, PROBABILITY, PROBABILITY), "scores")
    extra["calibration"] = m.calibration_points(scored, CHURNED, PROBABILITY)
    chosen = pick_threshold(scored) if threshold is None else threshold
    return Training(model, chosen, evaluate_scores(scored, chosen), table, scored, calibrator, extra)


def log_training(log: RunLog, run_id: str, result: Training) -> None:
    """Metrics, thresholds, importances, calibration points and, where there is one, the learning curve."""
    log.metrics(run_id, result.metrics)
    values = {"threshold": result.threshold}
    if "threshold_uncalibrated" in result.extra:
        values["threshold_uncalibrated"] = result.extra["threshold_uncalibrated"]
        log.calibration(run_id, result.extra["calibration_before"], "before")
    log.values(run_id, values)
    log.importances(run_id, result.importances)
    log.calibration(run_id, result.extra["calibration"], "after")
    if "learning_curve" in result.extra:
        log.curves(run_id, result.extra["learning_curve"])


def logged_training(log: RunLog, name: str, rows: DataFrame, estimator: Estimator, parent: str | None = None, **options) -> Training:
    """:func:`train_evaluate` as a run of the log."""
    columns = [c for c in rows.columns if c not in BOOKKEEPING]
    with log.run(name, {"columns": columns, "num_columns": len(columns)}, parent) as run_id:
        result = train_evaluate(rows, estimator, **options)
        log_training(log, run_id, result)
    return result


@dataclass
class Folds:
    """``fold, metric, value`` rows, their mean and deviation per metric, ``fold, threshold`` and, where asked for,
    ``fold, feature, importance``."""

    values: DataFrame
    summary: DataFrame
    thresholds: DataFrame
    importances: DataFrame | None = None


def fit_folds(
    rows: DataFrame,
    estimator: Estimator,
    folds: int = 5,
    threshold: float | None = None,
    fit: PipelineFit = encoded_pipeline,
    with_importances: bool = False,
    parallelism: int = 2,
) -> Folds:
    """Cross-validation. The encoder is fitted inside every fold; ``parallelism`` folds are fitted at a time, each in
    a scheduler pool of its own, and all are evaluated by one grouped job. ``rows`` are scanned several times, so they
    are best a written table."""
    folded = stratified_folds(rows, CHURNED, ID, folds)
    spark = rows.sparkSession

    def one(k: int) -> tuple[DataFrame, DataFrame | None]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{k}")
        train = weighted_part(folded, F.col("fold") != k)
        valid = weighted_part(folded, F.col("fold") == k)
        model = fit(train, estimator(train), BOOKKEEPING)
        scored = _scores(model, valid).withColumn("fold", F.lit(k))
        if not with_importances:
            return scored, None
        return scored, stage(model_importances(model, train, valid).withColumn("fold", F.lit(k)), "fold-importances")

    with ThreadPool(max(1, min(parallelism, folds))) as pool:
        parts, tables = zip(*pool.map(inheritable_thread_target(spark)(one), range(folds), chunksize=1))
    scored = reduce(DataFrame.unionByName, parts)
    if threshold is None:
        best = m.best_threshold(m.threshold_grid(scored, CHURNED, PROBABILITY, WEIGHT, ["fold"]), ["fold"])
        thresholds = stage(best.select("fold", "threshold"), "fold-thresholds")
    else:
        thresholds = spark.range(folds).select(F.col("id").cast("int").alias("fold"), F.lit(float(threshold)).alias("threshold"))
    decided = scored.join(F.broadcast(thresholds), "fold").withColumn(  # one row per fold
        "prediction", F.col(PROBABILITY) > F.col("threshold")
    )
    values = stage(
        m.metric_rows(m.evaluate(decided, CHURNED, "prediction", PROBABILITY, WEIGHT, ["fold"]), ["fold"]),
        "fold-metrics",
    )
    found = reduce(DataFrame.unionByName, tables) if with_importances else None
    return Folds(values, m.fold_summary(values), thresholds, found)


def cross_validate(rows: DataFrame, estimator: Estimator, folds: int = 5, **options) -> tuple[DataFrame, DataFrame]:
    """``fold, metric, value`` rows and their mean and deviation per metric."""
    found = fit_folds(rows, estimator, folds, **options)
    return found.values, found.summary


def log_folds(log: RunLog, run_id: str, found: Folds, columns: list[str]) -> None:
    """One run for each fold below ``run_id``, which gets mean and deviation of every metric."""
    for row in found.thresholds.orderBy("fold").collect():
        one = log.start(f"split_{row['fold'] + 1}", {"columns": columns}, parent=run_id)
        log.metrics(one, found.values.where(F.col("fold") == row["fold"]))
        log.values(one, {"threshold": row["threshold"]})
        if found.importances is not None:
            log.importances(one, found.importances.where(F.col("fold") == row["fold"]))
    for statistic in ("mean", "std"):
        log.metrics(
            run_id,
            found.summary.select(F.concat("metric", F.lit(f"_{statistic}")).alias("metric"), F.col(statistic).alias("value")),
        )


def weak_columns(importances: DataFrame, limit: float, columns: list[str], source: Callable[[str], str]) -> list[str]:
    """Columns all of whose encoded features have an importance of at most ``limit``; ``source`` names the column
    behind a feature."""
    best: dict[str, float] = {}
    for row in importances.collect():
        column = source(row["feature"])
        best[column] = max(best.get(column, float("-inf")), row["importance"])
    return [c for c in columns if c in best and best[c] <= limit]


def slice_importances(fitted: Model, features: list[str], train: DataFrame, valid: DataFrame) -> DataFrame:
    """``feature, importance`` of a model fitted on vectors of ``features``: impurity for trees, else the mean
    contribution over the validation rows, from the two vectors of means."""
    spark = train.sparkSession
    if hasattr(fitted, "featureImportances"):
        return importance_table(spark, dict(zip(features, map(float, fitted.featureImportances.toArray()))))
    at_train, at_valid = (part.select(Summarizer.mean(F.col(FEATURES))).first()[0].toArray() for part in (train, valid))
    found = fitted.coefficients.toArray() * (at_valid - at_train)
    return importance_table(spark, dict(zip(features, map(float, found))))


def eliminate(
    rows: DataFrame,
    estimator: Estimator,
    limit: float = LEAST_IMPORTANCE,
    calibrated: bool = False,
    threshold: float | None = None,
    encode: Callable[[DataFrame, list[str]], Model] = fit_column_encoder,
    log: RunLog | None = None,
) -> tuple[Training, list[str]]:
    """Refit without the columns of least importance until none is left to drop; at least one column stays. The
    encoder is fitted once and every fit takes its part of the written vectors. With ``log`` each fit is evaluated
    and a run below one run of the whole job."""
    parted = with_balanced_weights(stratified_split(rows, CHURNED, ID), CHURNED, ["split"], WEIGHT)
    encoded = encode_once(parted, BOOKKEEPING, encode)
    kept = [c for c in rows.columns if c not in BOOKKEEPING]
    dropped: list[str] = []
    main = log.start("elimination", {"columns": kept}) if log else None
    while True:
        features = encoded.features_of(kept)
        train, valid = encoded.part("train", features), encoded.part("test", features)
        fitted = estimator(train).fit(train)
        table = slice_importances(fitted, features, train, valid)
        weak = weak_columns(table, limit, kept, partial(source_of, encoded.encoder))
        done = not weak or len(weak) == len(kept)
        if log or done:
            scored = _scores(fitted, valid)
            result = _judged(encoded.pipeline(fitted, features), scored, scored if calibrated else None, table, threshold)
        if log:
            log_training(log, log.start("full_model", {"columns": kept, "num_columns": len(kept)}, main), result)
        if done:
            if log:
                log.finish(main)
            return result, dropped
        dropped += weak
        kept = [c for c in kept if c not in weak]


def fit_boosting(
    train: DataFrame, valid: DataFrame, rounds: int, depth: int, rate: float, patience: int, max_bins: int = 64
) -> tuple[PipelineModel, DataFrame]:
    """Boosting with early stopping: the model of the trees up to the best round by the validation loss with
    ``patience``, and the learning curves of the rounds that were fitted. ``max_bins`` has to cover the column of most
    categories."""
    return fit_boosting_on_vectors(train, valid, rounds, depth, rate, patience, max_bins)[:2]


def fit_boosting_on_vectors(
    train: DataFrame, valid: DataFrame, rounds: int, depth: int, rate: float, patience: int, max_bins: int = 64
) -> tuple[PipelineModel, DataFrame, DataFrame, DataFrame]:
    """:func:`fit_boosting` and the written vectors of both parts, beside the columns that are no features. Categories
    are indexed and vectors made once; what looks at the model on the same rows reads them."""
    encoder = fit_category_indexer(train, BOOKKEEPING, max_bins)
    names = feature_output_columns(encoder.transform(train), BOOKKEEPING)
    assembler = VectorAssembler(inputCols=names, outputCol=FEATURES)

    def vectors(part: DataFrame) -> DataFrame:
        kept = [c for c in BOOKKEEPING if c in part.columns]
        return stage(assembler.transform(encoder.transform(part)).select(*kept, FEATURES), "boosting-rows")

    train, valid = vectors(train), vectors(valid)
    fitted, curve = boost(train, valid, rounds, depth, rate, patience, max_bins)
    return PipelineModel([encoder, assembler, fitted]), curve, train, valid


def boost(
    train: DataFrame, valid: DataFrame, rounds: int, depth: int, rate: float, patience: int, max_bins: int = 64
) -> tuple[Model, DataFrame]:
    """The same on rows that hold the vectors. Four times ``patience`` rounds are fitted, and while the validation loss
    has not gone that long without gain, twice as many, up to ``rounds``. The first trees of a longer fit are those of
    the shorter one, so the model is that of a fit of all rounds."""
    wanted = min(rounds, 4 * patience)
    while True:
        full = boosting(wanted, depth, rate, max_bins=max_bins).fit(train)
        curve = learning_curve(full, {"train": train, "valid": valid})
        losses = [r["value"] for r in curve.where("split = 'valid'").orderBy("iteration").collect()]
        best = best_round(losses, patience)
        if wanted == rounds or best + patience <= wanted:
            return (full if best == wanted else first_rounds(full, best)), curve
        wanted = min(rounds, 2 * wanted)


def eliminate_by_noise(
    rows: DataFrame,
    rounds: int = 1000,
    depth: int = 8,
    rate: float = 0.1,
    patience: int = 100,
    limit: float = LEAST_IMPORTANCE,
    same_split: bool = True,
    seed: int = 42,
    max_bins: int = 64,
    log: RunLog | None = None,
) -> tuple[Training, list[str], list[str]]:
    """Boosting again and again next to a noise column; what is not more important than the noise (or than ``limit``)
    goes, and at least one column stays. The last fit, without the noise, is calibrated. Categories are indexed once;
    the noise is drawn once, when the vectors are written, and each fit writes the slices it reads again and again.
    Returns the training, the kept and the dropped columns. With ``log`` every fit is a run."""
    if same_split:
        parted = stratified_split(rows, CHURNED, ID, seed=seed)
    else:
        parted = three_way_split(rows, CHURNED, ID, valid_size=0.1, test_size=0.2, seed=seed)
    parted = with_balanced_weights(with_noise(parted, NOISE, seed), CHURNED, ["split"], WEIGHT)
    encoded = encode_once(parted, BOOKKEEPING, partial(fit_category_indexer, max_bins=max_bins))
    boosted = {"rounds": rounds, "depth": depth, "rate": rate, "patience": patience, "max_bins": max_bins}
    columns = [c for c in rows.columns if c not in BOOKKEEPING]
    main = log.start("elimination_by_noise", {"columns": columns}) if log else None

    def fit(kept: list[str], judge: bool) -> tuple[DataFrame, Training | None]:
        features = encoded.features_of(kept)
        train, valid = (stage(encoded.part(name, features), "boosting-rows") for name in ("train", "test"))
        fitted, curve = boost(train, valid, **boosted)
        table = slice_importances(fitted, features, train, valid)
        if not judge and not log:
            return table, None
        scored = _scores(fitted, valid)
        base = scored if same_split else _scores(fitted, encoded.part("valid", features))
        result = _judged(encoded.pipeline(fitted, features), scored, base, table)
        result.extra["learning_curve"] = curve
        if log:
            log_training(log, log.start("full_model", {"columns": kept, "num_columns": len(kept)}, main), result)
        return table, result

    kept = columns
    while True:
        table, _ = fit([*kept, NOISE], judge=False)
        bar = max(limit, table.where(F.col("feature") == NOISE).first()["importance"])
        weak = weak_columns(table, bar, kept, partial(source_of, encoded.encoder))
        if not weak or len(weak) == len(kept):
            break
        kept = [c for c in kept if c not in weak]
    _, result = fit(kept, judge=True)
    if log:
        log.finish(main)
    return result, kept, [c for c in columns if c not in kept]


def train(
    spark: SparkSession, features_path: str, log_path: str, folds: int = 5, max_iter: int = 100
) -> Training:
    """The whole job: cross-validate a logistic regression on the written feature table, then train it
    on the hold-out split, logging every run."""
    rows = model_rows(read_features(spark, features_path))
    log = RunLog(spark, log_path)
    columns = [c for c in rows.columns if c not in BOOKKEEPING]

    def estimator(part: DataFrame):
        return logistic_regression(part, max_iter=max_iter)

    def standard(part: DataFrame, model, excluded: list[str]) -> PipelineModel:
        return encoded_pipeline(part, model, excluded, scaler="standard")

    with log.run("churn_logistic_regression", {"columns": columns}) as main:
        found = fit_folds(rows, estimator, folds, threshold=0.5, fit=standard, with_importances=True)
        log_folds(log, main, found, columns)
        return logged_training(log, "full_model", rows, estimator, main, threshold=0.5, fit=standard)
