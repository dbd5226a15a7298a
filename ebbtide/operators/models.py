"""Estimators with the settings of the churn models, calibration, importances and learning curves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
)
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.attribution import staged_scores
from ebbtide.operators.encoders import ColumnEncoder, feature_output_columns
from ebbtide.operators.forests import Forest
from ebbtide.operators.isotonic import isotonic_blocks
from ebbtide.operators.metrics import ranking_metrics
from ebbtide.session import stage

LABEL = "label"
WEIGHT = "weight"
FEATURES = "features"
ENCODED = "encoded"
# Boosting budget and regularisation strength.
BOOSTING_ROUNDS = 1000
BOOSTING_DEPTH = 8
BOOSTING_RATE = 0.1
PATIENCE = 100
INVERSE_REGULARISATION = 1.0


def logistic_regression(train: DataFrame, inverse_strength: float = INVERSE_REGULARISATION, max_iter: int = 100):
    """L2 with the penalty spread over the weight sum: Spark averages the loss, so 1 / (C * weight
    sum) gives the objective ``C * weighted loss + |w|^2 / 2``."""
    total = train.agg(F.sum(WEIGHT)).first()[0]
    return LogisticRegression(
        labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, standardization=False,
        regParam=1.0 / (inverse_strength * total), elasticNetParam=0.0, maxIter=max_iter,
    )


def random_forest(trees: int = 100, depth: int = 30, seed: int = 42, min_rows: int = 1):
    """Trees on numbers grow where their rows are (:mod:`.forests`). Where there are categories Spark grows them, and rows
    keep the numbers of their nodes (``cacheNodeIds``): without that every pass would send all deep trees to every task
    again."""
    return Forest(
        labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, numTrees=trees, maxDepth=depth,
        featureSubsetStrategy="sqrt", minInstancesPerNode=min_rows, seed=seed, cacheNodeIds=True,
    )


def boosting(rounds: int = BOOSTING_ROUNDS, depth: int = BOOSTING_DEPTH, rate: float = BOOSTING_RATE, seed: int = 42, max_bins: int = 64):
    """Level-wise boosting on the logistic loss. No validation stop is set: the round is chosen from
    the learning curve with patience (:func:`best_round`)."""
    return GBTClassifier(
        labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, maxIter=rounds, maxDepth=depth,
        stepSize=rate, minInstancesPerNode=20, maxBins=max_bins, seed=seed,
    )


def fit_column_encoder(train: DataFrame, excluded: list[str], scaler: str = "robust") -> Model:
    """A missing truth value is read as false."""
    return ColumnEncoder(scaler=scaler, excluded=excluded, nullCode=-2.0).fit(train)


def encoded_pipeline(train: DataFrame, estimator, excluded: list[str], scaler: str = "robust") -> PipelineModel:
    """Encoder, assembler and model fitted together, the encoder on the training rows only."""
    encoder = fit_column_encoder(train, excluded, scaler)
    return _finish(encoder, encoder.transform(train), estimator, excluded)


def fit_category_indexer(train: DataFrame, excluded: list[str], max_bins: int) -> Model:
    """String columns indexed as categories, which trees split as sets; numbers are left unscaled. ``maxBins`` also
    rules the splits of numbers, so it is never changed here: it has to cover the widest column."""
    strings = [f.name for f in train.schema if isinstance(f.dataType, T.StringType) and f.name not in excluded]
    indexed = [f"{c}_index" for c in strings]
    indexer = StringIndexer(inputCols=strings, outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep")
    encoder = indexer.fit(train)
    widest = max((len(labels) + 1 for labels in encoder.labelsArray), default=2)
    if max_bins < widest:
        raise ValueError(f"a column has {widest} categories; maxBins is {max_bins} and must not be less")
    return encoder


def native_category_pipeline(train: DataFrame, estimator, excluded: list[str]) -> PipelineModel:
    encoder = fit_category_indexer(train, excluded, estimator.getMaxBins())
    return _finish(encoder, encoder.transform(train), estimator, excluded)


@dataclass
class EncodedRows:
    """Split and weighted rows whose encoded features, of one fit of the encoder, are written as one vector.
    A fit on fewer columns slices the vector; nothing is encoded again."""

    encoder: Model
    names: list[str]
    rows: DataFrame

    def features_of(self, columns: list[str]) -> list[str]:
        return [f for f in self.names if source_of(self.encoder, f) in set(columns)]

    def part(self, split: str, features: list[str]) -> DataFrame:
        at = {f: i for i, f in enumerate(self.names)}
        slicer = VectorSlicer(inputCol=ENCODED, outputCol=FEATURES, indices=[at[f] for f in features])
        return slicer.transform(self.rows.where(F.col("split") == split)).drop(ENCODED)

    def pipeline(self, fitted: Model, features: list[str]) -> PipelineModel:
        """The model for rows of the feature table, which need only hold the columns behind ``features``."""
        kept = {source_of(self.encoder, f) for f in features}
        encoder = without_columns(self.encoder, [c for f in self.names if (c := source_of(self.encoder, f)) not in kept])
        assembler = VectorAssembler(inputCols=features, outputCol=FEATURES)
        return PipelineModel([encoder, assembler, fitted])


def encode_once(rows: DataFrame, excluded: list[str], fit: Callable[[DataFrame, list[str]], Model]) -> EncodedRows:
    """``rows`` carry ``split``; the encoder is fitted on the part called train."""
    encoder = fit(rows.where(F.col("split") == "train"), excluded)
    encoded = encoder.transform(rows)
    names = feature_output_columns(encoded, excluded)
    vectors = VectorAssembler(inputCols=names, outputCol=ENCODED).transform(encoded)
    return EncodedRows(encoder, names, stage(vectors.select(*[c for c in excluded if c in rows.columns], ENCODED), "encoded-rows"))


def without_columns(encoder: Model, columns: list[str]) -> Model:
    if hasattr(encoder, "without"):
        return encoder.without(columns)
    left = [(labels, i, o) for labels, i, o in zip(encoder.labelsArray, encoder.getInputCols(), encoder.getOutputCols()) if i not in columns]
    if not left:
        return PipelineModel([])
    arrays, inputs, outputs = map(list, zip(*left))
    return StringIndexerModel.from_arrays_of_labels([list(a) for a in arrays], inputs, outputs, "keep")


def _finish(encoder, encoded: DataFrame, estimator, excluded: list[str]) -> PipelineModel:
    inputs = feature_output_columns(encoded, excluded)
    assembler = VectorAssembler(inputCols=inputs, outputCol=FEATURES)
    fitted = estimator.fit(assembler.transform(encoded))
    return PipelineModel([encoder, assembler, fitted])


def assembled(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The rows with encoded columns and the feature vector, without the model's own columns."""
    for stage in model.stages[:-1]:
        df = stage.transform(df)
    return df


def vector_features(model: PipelineModel) -> list[str]:
    return model.stages[-2].getInputCols()


def source_column(model: PipelineModel, feature: str) -> str:
    """The column of the feature table behind an encoded feature."""
    return source_of(model.stages[0], feature)


def source_of(encoder: Model, feature: str) -> str:
    if hasattr(encoder, "source_of"):
        return encoder.source_of(feature)
    if not hasattr(encoder, "getOutputCols"):
        return feature
    indexed = dict(zip(encoder.getOutputCols(), encoder.getInputCols()))
    return indexed.get(feature, feature)


def importances(model: PipelineModel) -> dict[str, float]:
    """Impurity importances of a tree model (they add up to 1), by encoded feature."""
    return dict(zip(vector_features(model), map(float, model.stages[-1].featureImportances.toArray())))


def coefficients(model: PipelineModel) -> dict[str, float]:
    return dict(zip(vector_features(model), map(float, model.stages[-1].coefficients.toArray())))


def fit_isotonic(scored: DataFrame, label: str, probability: str, weight: str) -> IsotonicRegressionModel:
    """Isotonic calibration on scored rows. Rows of one score are merged beforehand, which leaves the
    fit unchanged and keeps a hot score from travelling row by row. Violators are pooled in parallel; the
    model is made of the two ends of each block that is left, so the driver gets the steps of the result."""
    w = F.col(weight)
    merged = scored.groupBy(F.col(probability).alias("raw_probability")).agg(
        (F.sum(w * F.col(label).cast("double")) / F.sum(w)).alias("_share"), F.sum(w).alias("_weight")
    )
    known = merged.where("raw_probability IS NOT NULL AND _share IS NOT NULL AND _weight > 0")
    ends = isotonic_blocks(known, "raw_probability", "_share", "_weight").select(
        F.explode(F.array_distinct(F.array("lo", "hi"))).alias("raw_probability"), F.col("mean").alias("_share"), F.col("weight").alias("_weight")
    )
    return IsotonicRegression(
        featuresCol="raw_probability", labelCol="_share", weightCol="_weight",
        predictionCol="calibrated_probability",
    ).fit(ends)


def calibrate(scored: DataFrame, calibrator: IsotonicRegressionModel, probability: str, output: str) -> DataFrame:
    renamed = scored.withColumn("raw_probability", F.col(probability))
    return calibrator.transform(renamed).withColumn(output, F.col("calibrated_probability")).drop(
        *[c for c in ("raw_probability", "calibrated_probability") if c != output]
    )


CURVE_SCHEMA = T.StructType(
    [
        T.StructField("iteration", T.IntegerType()),
        T.StructField("split", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def learning_curve(model: GBTClassificationModel, parts: dict[str, DataFrame]) -> DataFrame:
    """``iteration, split, value``: weighted log loss after every boosting round. ``parts`` maps a
    split name to its assembled rows."""
    spark = next(iter(parts.values())).sparkSession
    rows = [
        (i + 1, name, float(v))
        for name, part in parts.items()
        for i, v in enumerate(model.evaluateEachIteration(part))
    ]
    return spark.createDataFrame(rows, CURVE_SCHEMA)


def ranking_curves(model: GBTClassificationModel, parts: dict[str, DataFrame], label: str) -> DataFrame:
    """``iteration, split, metric, value``: weighted average precision and ROC area after every round.
    All rounds and splits are one grouped evaluation."""
    staged = None
    for name, part in parts.items():
        scores = staged_scores(model, part.select(label, WEIGHT, FEATURES), [label, WEIGHT]).withColumn("split", F.lit(name))
        staged = scores if staged is None else staged.unionByName(scores)
    by = ["iteration", "split"]
    found = ranking_metrics(staged, label, "score", WEIGHT, by)
    return found.unpivot(by, ["average_precision", "auc"], "metric", "value")


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees: what fitting that many rounds with the same seed would give."""
    gateway = model._java_obj
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    kind = sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees = SparkContext._gateway.new_array(kind, rounds)
    weights = SparkContext._gateway.new_array(sc._jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(gateway.trees()[:rounds], gateway.treeWeights()[:rounds])):
        trees[i], weights[i] = tree, weight
    uid = f"{model.uid}_{rounds}"
    short = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(uid, trees, weights, model.numFeatures, 2)
    gateway.copyValues(short, gateway.extractParamMap())
    return GBTClassificationModel(short)


def best_round(losses: list[float], patience: int = PATIENCE) -> int:
    """1-based round of the least loss before ``patience`` rounds without improvement."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1
