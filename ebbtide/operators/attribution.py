"""Why a model scores as it does: linear and tree contributions, importances, their summaries."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.columns import long_form
from ebbtide.operators.forests import ForestModel
from ebbtide.session import work_folder

WEIGHTS_SCHEMA = T.StructType(
    [T.StructField("feature", T.StringType()), T.StructField("value", T.DoubleType())]
)


def named_values(spark: SparkSession, values: dict[str, float], value: str) -> DataFrame:
    """A small ``feature, value`` table: coefficients or importances, one row per feature."""
    rows = [(k, float(v)) for k, v in values.items()]
    return spark.createDataFrame(rows, WEIGHTS_SCHEMA).withColumnRenamed("value", value)


def feature_means(df: DataFrame, columns: list[str], value: str) -> DataFrame:
    return long_form(df, columns, name="feature").groupBy("feature").agg(F.avg("value").alias(value))


def linear_attribution(train: DataFrame, valid: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``feature, importance``: mean signed contribution of each feature over the validation rows.

    For a linear model a row's contribution is weight * (value - training mean); its mean needs only
    the two column means, so no row-wise attribution is computed.
    """
    columns = list(weights)
    return (
        feature_means(train, columns, "train_mean")
        .join(feature_means(valid, columns, "valid_mean"), "feature")
        .join(named_values(train.sparkSession, weights, "weight"), "feature")
        .select("feature", (F.col("weight") * (F.col("valid_mean") - F.col("train_mean"))).alias("importance"))
    )


def linear_contributions(train: DataFrame, rows: DataFrame, weights: dict[str, float], key: str) -> DataFrame:
    """``key, feature, value, contribution`` of every row and feature."""
    columns = list(weights)
    means = train.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).alias("m"))
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).cast("double").alias("value"),
            (F.lit(float(weights[c])) * (F.col(c).cast("double") - F.col("_means")[c])).alias("contribution"),
        )
        for c in columns
    ]
    return rows.withColumn("_means", means.scalar()).select(key, F.inline(F.array(*entries)))


def contribution_summary(contributions: DataFrame) -> DataFrame:
    """Mean and mean absolute contribution per feature."""
    return contributions.groupBy("feature").agg(
        F.avg("contribution").alias("mean_contribution"),
        F.avg(F.abs("contribution")).alias("mean_abs_contribution"),
    )


def dependence(contributions: DataFrame, bins: int = 10) -> DataFrame:
    """Per feature and equal-width bin of its values: mean value, mean contribution, rows."""
    span = contributions.groupBy("feature").agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    place = F.try_divide((F.col("value") - F.col("_low")) * bins, F.col("_high") - F.col("_low"))
    index = F.coalesce(F.least(F.floor(place), F.lit(bins - 1)), F.lit(0))
    # One row per model feature.
    return (
        contributions.join(F.broadcast(span), "feature")
        .groupBy("feature", index.alias("bin"))
        .agg(
            F.avg("value").alias("mean_value"),
            F.avg("contribution").alias("mean_contribution"),
            F.count(F.lit(1)).alias("bin_rows"),
        )
    )


def importance_table(spark: SparkSession, values: dict[str, float], ascending: bool = False) -> DataFrame:
    table = named_values(spark, values, "importance")
    return table.orderBy(F.asc("importance") if ascending else F.desc("importance"), "feature")


def tree_nodes(model, spark: SparkSession) -> pd.DataFrame:
    """All nodes of a tree ensemble, one row each, read from the model's own parquet form. Their number
    is bounded by trees and depth, not by the data."""
    path = f"{work_folder(spark)}/model-{uuid.uuid4().hex}"
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.impurityStats").alias("stats"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("rule"),
        F.col("nodeData.split.numCategories").alias("categories"),
    )
    return nodes.toPandas().sort_values(["tree", "node"])


class _Tree:
    """One tree as arrays, for walking many rows down at once. A node's value is its mean, or with ``shares`` the
    share of the second class in it."""

    def __init__(self, nodes: pd.DataFrame, shares: bool = False):
        self.value = nodes["prediction"].to_numpy(float)
        if shares:
            self.value = np.array([stats[1] / sum(stats) for stats in nodes["stats"]])
        self.left = nodes["left"].to_numpy(int)
        self.right = nodes["right"].to_numpy(int)
        self.feature = nodes["feature"].to_numpy(int)
        self.categorical = nodes["categories"].to_numpy(int) >= 0
        self.rule = [np.asarray(r, float) for r in nodes["rule"]]
        self.threshold = np.array([r[0] if len(r) else np.nan for r in self.rule])

    def step(self, x: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The child each of ``rows`` moves to from its node in ``at``."""
        node = at[rows]
        seen = x[rows, self.feature[node]]
        go_left = seen <= self.threshold[node]
        for n in np.unique(node[self.categorical[node]]):
            here = node == n
            go_left[here] = np.isin(seen[here], self.rule[n])
        return np.where(go_left, self.left[node], self.right[node])

    def leaf_values(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), int), np.arange(len(x))
        while len(rows := rows[self.left[at[rows]] >= 0]):
            at[rows] = self.step(x, at, rows)
        return self.value[at]

    def add_contributions(self, x: np.ndarray, weight: float, out: np.ndarray) -> None:
        """Every step from a node to its child credits the change of the node mean to the feature
        the node splits on."""
        at, rows = np.zeros(len(x), int), np.arange(len(x))
        while len(rows := rows[self.left[at[rows]] >= 0]):
            node, child = at[rows], self.step(x, at, rows)
            np.add.at(out, (rows, self.feature[node]), weight * (self.value[child] - self.value[node]))
            at[rows] = child


def _shipped_trees(model, spark: SparkSession):
    """Trees and their weights as a broadcast variable, and the margin before any split: of a boosted model the raw
    margin, of a forest the probability, which is the mean share of its trees."""
    shares = isinstance(model, (RandomForestClassificationModel, ForestModel))
    trees = [_Tree(part, shares) for _, part in tree_nodes(model, spark).groupby("tree")]
    weights = [w / len(trees) if shares else w for w in model.treeWeights]
    bias = float(sum(w * t.value[0] for w, t in zip(weights, trees)))
    return spark.sparkContext.broadcast((trees, weights)), bias


def _matrix(batch: pd.DataFrame) -> np.ndarray:
    return np.vstack(batch["_x"].to_numpy()) if len(batch) else np.zeros((0, 1))


def staged_scores(model, rows: DataFrame, keep: list[str], vector: str = "features") -> DataFrame:
    """``keep..., iteration, score``: the probability of every row after each boosting round."""
    shipped, _ = _shipped_trees(model, rows.sparkSession)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, scales = shipped.value
        for batch in batches:
            x = _matrix(batch)
            margins = np.cumsum([w * t.leaf_values(x) for t, w in zip(forest, scales)], axis=0)
            yield batch[keep].assign(_p=list(1 / (1 + np.exp(-2 * margins.T))))

    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("_p", T.ArrayType(T.DoubleType()))])
    return (
        rows.select(*keep, vector_to_array(vector).alias("_x"))
        .mapInPandas(walk, schema)
        .select(*keep, F.posexplode("_p").alias("iteration", "score"))
        .withColumn("iteration", F.col("iteration") + 1)
    )


def tree_contributions(
    model, scored: DataFrame, features: list[str], key: str, vector: str = "features"
) -> DataFrame:
    """``key, feature, value, contribution, bias``: path contributions of a boosted ensemble or a forest.

    Over the features of a row the contributions plus the bias give the margin of the model (a forest's probability). The
    rows stay in their partitions; the executors get the flattened trees once.
    """
    shipped, bias = _shipped_trees(model, scored.sparkSession)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, scales = shipped.value
        for batch in batches:
            x = _matrix(batch)
            out = np.zeros(x.shape)
            for tree, scale in zip(forest, scales):
                tree.add_contributions(x, scale, out)
            yield pd.DataFrame({key: batch[key], "_x": list(x), "_c": list(out)})

    schema = T.StructType(
        [
            scored.schema[key],
            T.StructField("_x", T.ArrayType(T.DoubleType())),
            T.StructField("_c", T.ArrayType(T.DoubleType())),
        ]
    )
    names = F.array(*[F.lit(f) for f in features])
    return (
        scored.select(key, vector_to_array(vector).alias("_x"))
        .mapInPandas(explain, schema)
        .select(key, F.inline(F.arrays_zip(names.alias("feature"), F.col("_x").alias("value"), F.col("_c").alias("contribution"))))
        .toDF(key, "feature", "value", "contribution")
        .withColumn("bias", F.lit(bias))
    )


CELLS_SCHEMA = "feature bigint, bin bigint, rows bigint, value double, contribution double, magnitude double"


def _contribution_cells(
    model, rows: DataFrame, width: int, vector: str, low: np.ndarray, high: np.ndarray, bins: int
) -> DataFrame:
    """Sums per feature and equal-width bin of its values, added up inside each task: what is shuffled follows the
    tasks, features and bins, not the rows."""
    shipped, _ = _shipped_trees(model, rows.sparkSession)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, scales = shipped.value
        span = np.where(high > low, high - low, np.inf)
        total = np.zeros((4, width, bins))
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch)
            out = np.zeros(x.shape)
            for tree, scale in zip(forest, scales):
                tree.add_contributions(x, scale, out)
            at = np.minimum(np.nan_to_num((x - low) * bins / span), bins - 1).astype(int)
            for f in range(width):
                for i, part in enumerate((None, x[:, f], out[:, f], np.abs(out[:, f]))):
                    total[i, f] += np.bincount(at[:, f], weights=part, minlength=bins)
        f, b = np.nonzero(total[0])
        count, value, contribution, magnitude = total[:, f, b]
        yield pd.DataFrame(
            {"feature": f, "bin": b, "rows": count.astype("int64"), "value": value, "contribution": contribution, "magnitude": magnitude}
        )

    return rows.select(vector_to_array(vector).alias("_x")).mapInPandas(add_up, CELLS_SCHEMA)


def tree_contribution_summary(model, rows: DataFrame, features: list[str], vector: str = "features") -> DataFrame:
    """:func:`contribution_summary` of :func:`tree_contributions`, without a row for each row and feature."""
    nowhere = np.zeros(len(features))
    cells = _contribution_cells(model, rows, len(features), vector, nowhere, nowhere, 1)
    names = F.array(*[F.lit(f) for f in features])
    return cells.groupBy(F.get(names, "feature").alias("feature")).agg(
        (F.sum("contribution") / F.sum("rows")).alias("mean_contribution"),
        (F.sum("magnitude") / F.sum("rows")).alias("mean_abs_contribution"),
    )


def tree_dependence(model, rows: DataFrame, features: list[str], bins: int = 10, vector: str = "features") -> DataFrame:
    """:func:`dependence` of :func:`tree_contributions`, without a row for each row and feature. The driver gets the
    least and the greatest value of each feature."""
    low = high = np.zeros(len(features))
    if not rows.isEmpty():
        ends = rows.select(Summarizer.min(F.col(vector)), Summarizer.max(F.col(vector))).first()
        low, high = ends[0].toArray(), ends[1].toArray()
    names = F.array(*[F.lit(f) for f in features])
    cells = _contribution_cells(model, rows, len(features), vector, low, high, bins)
    return cells.groupBy(F.get(names, "feature").alias("feature"), "bin").agg(
        (F.sum("value") / F.sum("rows")).alias("mean_value"),
        (F.sum("contribution") / F.sum("rows")).alias("mean_contribution"),
        F.sum("rows").alias("bin_rows"),
    )
