"""Pearson correlations as tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIRS_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("other", T.StringType()),
        T.StructField("correlation", T.DoubleType()),
    ]
)


SUMS = ["n", "x", "y", "xx", "yy", "xy"]


def _pair_sums(n_columns: int, centres: list[float]):
    """Arrow batches of ``n_columns`` doubles to one row of sums per pair of columns (i >= j) and task, over the rows
    in which neither is missing; values are taken from ``centres``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), n_columns, n_columns))
        for batch in batches:
            values = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(n_columns)], axis=1)
            there = ~np.isnan(values)
            x = np.where(there, values - centres, 0.0)
            m = there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
        i, j = np.tril_indices(n_columns)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *(pa.array(t[i, j]) for t in total)], names=["i", "j", *SUMS])

    return run


def _target_sums(n_columns: int, centres: list[float]):
    """Arrow batches of ``n_columns`` doubles and the target behind them to one row of sums per column and task, over
    the rows in which neither is missing; values are taken from ``centres``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), n_columns))
        for batch in batches:
            values = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(n_columns + 1)], axis=1)
            both = ~np.isnan(values[:, :-1]) & ~np.isnan(values[:, -1:])
            x, y = (np.where(both, v, 0.0) for v in (values[:, :-1] - centres[:-1], values[:, -1:] - centres[-1]))
            total += np.stack([part.sum(axis=0) for part in (both.astype(float), x, y, x * x, y * y, x * y)])
        yield pa.RecordBatch.from_arrays([pa.array(range(n_columns), pa.int64()), *map(pa.array, total)], names=["i", *SUMS])

    return run


def _centred(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[float]]:
    """The columns as doubles, and the mean of each (0 where it has no value) from one row of aggregates."""
    doubles = df.select([F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    means = doubles.agg(*[F.avg(F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`"))) for c in columns]).first()
    return doubles, [m or 0.0 for m in means]


def _correlation() -> Column:
    """From the sums; null where either side is constant or has no value."""
    spread = (F.col("n") * F.col("xx") - F.col("x") * F.col("x")) * (F.col("n") * F.col("yy") - F.col("y") * F.col("y"))
    return F.when(spread > 0, (F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / F.sqrt(spread))


SUM_COLUMNS = ", ".join(f"{s} double" for s in SUMS)


def correlation_pairs(df: DataFrame, columns: list[str], lower_triangle: bool = True) -> DataFrame:
    """``feature, other, correlation`` for every pair of columns, each over the rows in which both have a value
    (null and NaN are none); null where a column is constant there.

    A task adds up its rows to one number per pair and sum, so what is shuffled follows the tasks, not the rows.
    ``lower_triangle`` gives each pair once and leaves out the diagonal.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], PAIRS_SCHEMA)
    doubles, centres = _centred(df, columns)
    partial = doubles.mapInArrow(_pair_sums(len(columns), centres), f"i bigint, j bigint, {SUM_COLUMNS}")
    sums = partial.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])
    names = F.array(*[F.lit(c) for c in columns])
    pairs = sums.select(F.get(names, "i").alias("feature"), F.get(names, "j").alias("other"), _correlation().alias("correlation"), (F.col("i") > F.col("j")).alias("below"))
    if lower_triangle:
        return pairs.where("below").drop("below")
    mirrored = pairs.where("below").select(F.col("other").alias("feature"), F.col("feature").alias("other"), "correlation")
    return pairs.drop("below").unionByName(mirrored)


def correlation_with_target(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """``feature, correlation`` with the target over the rows in which both have a value (null and NaN are none); null
    for a column without any. As above, a task adds up its rows."""
    names = F.array(*[F.lit(c) for c in columns])
    doubles, centres = _centred(df.withColumn("_target", F.col(target).cast("double")), [*columns, "_target"])
    partial = doubles.mapInArrow(_target_sums(len(columns), centres), f"i bigint, {SUM_COLUMNS}")
    sums = partial.groupBy("i").agg(*[F.sum(s).alias(s) for s in SUMS])
    return sums.select(F.get(names, "i").alias("feature"), _correlation().alias("correlation"))


def ranked_by_correlation(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc_nulls_last("correlation"), "feature")
