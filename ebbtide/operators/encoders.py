"""Encoders and scalers: fitting is an aggregate job, transforming a projection or a join.

``ColumnEncoder`` fits all branches and is a Spark ML estimator, so it can stand in a ``Pipeline`` and
be saved with it. Output columns keep their names; one-hot columns are called ``column_value``.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.columns import long_form, numeric_columns, string_columns
from ebbtide.operators.quantiles import wide_quantiles
from ebbtide.operators.ranking import dense_ranks
from ebbtide.session import broadcast_if_small, stage

ONE_HOT_CATEGORIES = 5
MISSING = "None"  # names the indicator of missing values
UNKNOWN_CODE = -1.0
QUARTILES = [0.25, 0.5, 0.75]
LABELS_SCHEMA = "column string, label string, code float"


def category_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, categories``: distinct non-null values of every string column.

    The values are counted as (column, value) groups, so partial aggregation shrinks a hot value to
    one row per task; no column's values meet in one task.
    """
    columns = columns if columns is not None else string_columns(df)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .groupBy("column", "value")
        .agg(F.count("value").alias("rows"))
        .groupBy("column")
        .agg(F.count("value").alias("categories"))
    )


def route_columns(df: DataFrame, columns: list[str] | None = None) -> tuple[list[str], list[str]]:
    """String columns for one-hot encoding (five categories or fewer) and for ordinal encoding."""
    columns = columns if columns is not None else string_columns(df)
    if not columns:
        return [], []
    counts = {r["column"]: r["categories"] for r in category_counts(df, columns).collect()}
    one_hot = [c for c in columns if counts.get(c, 0) <= ONE_HOT_CATEGORIES]
    return one_hot, [c for c in columns if c not in one_hot]


def one_hot_labels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted categories of each column, None last where a value is missing; only for columns routed to one-hot,
    hence few."""
    if not columns:
        return {}
    found = [F.array_sort(F.collect_set(c)).alias(c) for c in columns]
    gaps = [F.max(F.col(c).isNull()).alias(f"gap_{i}") for i, c in enumerate(columns)]
    row = df.agg(*found, *gaps).first()
    return {c: [*row[c], *([None] if row[f"gap_{i}"] else [])] for i, c in enumerate(columns)}


def one_hot_columns(labels: dict[str, list[str]]) -> dict[str, Column]:
    """Indicators of every category but the first. A missing value is a category where fitting saw one; categories
    it did not see give zeros."""
    return {
        f"{c}_{MISSING if value is None else value}": F.col(c).eqNullSafe(F.lit(value)).cast("float")
        for c, values in labels.items()
        for value in values[1:]
    }


def ordinal_labels(df: DataFrame, column: str) -> DataFrame:
    """``label, code``: position of every category in sorted order, found without a global window."""
    return dense_ranks(df.select(F.col(column).alias("label")), "label", "code").withColumn(
        "code", F.col("code").cast("float")
    )


def ordinal_encode(df: DataFrame, column: str, labels: DataFrame, unknown: float = UNKNOWN_CODE) -> DataFrame:
    """Replace ``column`` by its code: ``unknown`` for unseen values (may be NaN), null for null."""
    named = labels.select(F.col("label").alias(column), F.col("code").alias("_code"))
    code = F.when(F.col(column).isNull(), F.lit(None)).otherwise(F.coalesce("_code", F.lit(unknown).cast("float")))
    return (
        df.join(broadcast_if_small(named), column, "left")
        .withColumn(column, code)
        .select(*df.columns)
    )


def standard_scale(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Centre and scale per column: mean and population deviation, scale 1 for constants."""
    if not columns:
        return {}
    moments = long_form(df, columns).groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    fitted = {r["column"]: (r["mean"] or 0.0, r["std"] or 1.0) for r in moments.collect()}
    return {c: fitted.get(c, (0.0, 1.0)) for c in columns}


def column_quartiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, quantiles``: exact quartiles of every column, at any number of rows."""
    found = wide_quantiles(df, columns, QUARTILES)
    return df.sparkSession.createDataFrame([*found.items()], "column string, quantiles array<double>")


def robust_scale(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Centre and scale per column: median and interquartile range, scale 1 for a zero range."""
    if not columns:
        return {}
    quartiles = wide_quantiles(df, columns, QUARTILES)
    fitted = {}
    for c in columns:
        low, middle, high = quartiles.get(c, (0.0, 0.0, 0.0))
        fitted[c] = (middle, (high - low) or 1.0)
    return fitted


def scaled(column: str, centre: float, scale: float) -> Column:
    return (F.col(column) - F.lit(float(centre))) / F.lit(float(scale))


def scaled_sql(column: str, centre: float, scale: float) -> str:
    """The same as SQL text: one call per column to the JVM, which matters for wide tables."""
    return f"(CAST(`{column}` AS DOUBLE) - ({float(centre)!r}D)) / {float(scale)!r}D AS `{column}`"


class _EncoderParams(Params):
    scaler = Param(Params._dummy(), "scaler", "robust, standard or none", TypeConverters.toString)
    excluded = Param(Params._dummy(), "excluded", "columns left as they are", TypeConverters.toListString)
    unknown = Param(Params._dummy(), "unknown", "ordinal code of unseen values", TypeConverters.toFloat)
    nullCode = Param(Params._dummy(), "nullCode", "ordinal code of null, NaN keeps null", TypeConverters.toFloat)
    fitted = Param(Params._dummy(), "fitted", "what was learned, as JSON", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(scaler="robust", excluded=[], unknown=UNKNOWN_CODE, nullCode=float("nan"), fitted="{}")


class ColumnEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot for strings of few categories, ordinal codes for the others, a scaler for numbers;
    truth values lose their nulls (false), every other column passes through."""

    @keyword_only
    def __init__(self, *, scaler="robust", excluded=None, unknown=UNKNOWN_CODE, nullCode=float("nan")):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**given)

    def _fit(self, df: DataFrame) -> "ColumnEncoderModel":
        skip = set(self.getOrDefault("excluded"))
        strings = [c for c in string_columns(df) if c not in skip]
        numbers = [c for c in numeric_columns(df) if c not in skip]
        one_hot, ordinal = route_columns(df, strings)
        fit = {"robust": robust_scale, "standard": standard_scale, "none": lambda *_: {}}
        learned = {
            "one_hot": one_hot_labels(df, one_hot),
            "ordinal": ordinal,
            "scale": fit[self.getOrDefault("scaler")](df, numbers),
        }
        model = ColumnEncoderModel()
        self._copyValues(model)
        model.labels = stage(self._codes(df, ordinal), "labels")
        return model._set(fitted=json.dumps(learned))

    @staticmethod
    def _codes(df: DataFrame, columns: list[str]) -> DataFrame:
        """``column, label, code`` of all ordinal columns."""
        parts = [ordinal_labels(df, c).select(F.lit(c).alias("column"), "label", "code") for c in columns]
        return reduce(DataFrame.unionByName, parts, df.sparkSession.createDataFrame([], LABELS_SCHEMA))


class _EncoderWriter(DefaultParamsWriter):
    """Parameters, and the label table beside them."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.labels.write.parquet(f"{path}/labels")


class _EncoderReader(DefaultParamsReader):
    def load(self, path: str) -> "ColumnEncoderModel":
        model = super().load(path)
        model.labels = SparkSession.active().read.schema(LABELS_SCHEMA).parquet(f"{path}/labels")
        return model


class ColumnEncoderModel(Model, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """``labels`` holds the codes of all ordinal columns, whatever their number; it is saved with the model."""

    labels: DataFrame

    def write(self) -> _EncoderWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> _EncoderReader:
        return _EncoderReader(cls)

    def learned(self) -> dict:
        return json.loads(self.getOrDefault("fitted"))

    def without(self, columns: list[str]) -> "ColumnEncoderModel":
        """The same encoder for rows that lack ``columns``."""
        learned = self.learned()
        left = {k: [c for c in v if c not in columns] if isinstance(v, list) else {c: f for c, f in v.items() if c not in columns}
                for k, v in learned.items()}
        model = ColumnEncoderModel()
        self._copyValues(model)
        model.labels = self.labels.where(~F.col("column").isin(list(columns)))
        return model._set(fitted=json.dumps(left))

    def source_of(self, feature: str) -> str:
        """The input column an output column was made from."""
        for column, values in self.learned()["one_hot"].items():
            if feature in {f"{column}_{MISSING if v is None else v}" for v in values[1:]}:
                return column
        return feature

    def _transform(self, df: DataFrame) -> DataFrame:
        learned = self.learned()
        excluded = [c for c in self.getOrDefault("excluded") if c in df.columns]
        unknown, null_code = self.getOrDefault("unknown"), self.getOrDefault("nullCode")
        outputs: dict[str, Column] = dict(one_hot_columns(learned["one_hot"]))
        for column in learned["ordinal"]:
            df = ordinal_encode(df, column, self.labels.where(F.col("column") == column), unknown)
            keep_null = null_code != null_code
            outputs[column] = F.col(column) if keep_null else F.coalesce(column, F.lit(null_code).cast("float"))
        scales = [scaled_sql(c, *fit) for c, fit in learned["scale"].items()]
        handled = {*learned["one_hot"], *learned["ordinal"], *learned["scale"], *excluded}
        flags = {f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)}
        rest = [F.coalesce(c, F.lit(False)).alias(c) if c in flags else F.col(c) for c in df.columns if c not in handled]
        encoded = [col.alias(name) for name, col in outputs.items()]
        return df.select(*encoded, *map(F.expr, scales), *rest, *excluded)


def feature_output_columns(df: DataFrame, excluded: list[str]) -> list[str]:
    """Encoded columns usable in a vector: numbers and booleans."""
    usable = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema if f.name not in excluded and isinstance(f.dataType, usable)]
