"""Weighted isotonic regression by pooling adjacent violators in parallel.

Neighbouring blocks whose means do not increase belong to one block of the solution, in whatever order they are
pooled. So blocks are pooled range by range of scores, each range in a task that holds a stack of blocks, and what is
left is pooled again with other range borders until no border has a violation. Nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.ranking import with_bucket
from ebbtide.session import release, stage

RANGE_ROWS = 500_000  # about how many blocks a task pools at a time
_COLUMNS = ["lo", "hi", "mean", "weight"]


def pooled(means: list[float], weights: list[float]) -> list[tuple[int, int, float, float]]:
    """(first, last, mean, weight) of the blocks of a sequence, by a stack of growing means."""
    stack: list[tuple[int, int, float, float]] = []
    for i, (mean, weight) in enumerate(zip(means, weights)):
        first = i
        while stack and stack[-1][2] >= mean:
            first, _, before, held = stack.pop()
            weight, mean = weight + held, (mean * weight + before * held) / (weight + held)
        stack.append((first, i, mean, weight))
    return stack


def _pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, lo, hi, mean, weight) sorted by key and lo to the pooled blocks of each key."""
    key, parts, out = None, [], []

    def close() -> None:
        lo, hi, means, weights = (np.concatenate([p[i] for p in parts]) for i in range(4))
        blocks = pooled(means.tolist(), weights.tolist())
        first, last = (np.array([b[i] for b in blocks], np.int64) for i in range(2))
        values = [pa.array([b[i] for b in blocks], pa.float64()) for i in (2, 3)]
        out.append(pa.RecordBatch.from_arrays([pa.array(np.full(len(blocks), key)), pa.array(lo[first]), pa.array(hi[last]), *values], names=["key", *_COLUMNS]))

    for batch in batches:
        keys = batch.column(0).to_numpy()
        columns = [batch.column(i).to_numpy() for i in range(1, 5)]
        borders = np.flatnonzero(np.diff(keys)) + 1
        for a, b in zip([0, *borders], [*borders, len(keys)]):
            if a == b:
                continue
            if parts and keys[a] != key:
                close()
                parts = []
            key = keys[a]
            parts.append([c[a:b] for c in columns])
        yield from out
        out.clear()
    if parts:
        close()
    yield from out


def isotonic_blocks(points: DataFrame, score: str, mean: str, weight: str, buckets: int = 1, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(lo, hi, mean, weight): the blocks of the increasing step function closest to ``mean`` at ``score``, one row of
    ``points`` for each score, ``weight`` positive; each block with the scores at its ends, in no order. There are ``buckets``
    ranges, or more where one would have over ``range_rows`` rows."""
    columns = [F.col(score).cast("double").alias("lo"), F.col(score).cast("double").alias("hi"), F.col(mean).cast("double").alias("mean"), F.col(weight).cast("double").alias("weight")]
    blocks, turn = stage(points.select(*columns), "blocks"), 0
    while True:
        # Two neighbouring ranges are pooled together, in every other round with the other neighbour.
        ranged = with_bucket(blocks, "lo", buckets, range_rows)
        key = F.floor((F.col("_bucket") + turn % 2) / 2).cast("bigint").alias("key")
        dealt = ranged.select(key, *_COLUMNS).repartition("key").sortWithinPartitions("key", "lo")
        found = stage(dealt.mapInArrow(_pool, "key bigint, lo double, hi double, mean double, weight double"), "pooled-blocks")
        release(blocks)
        release(ranged)
        blocks, turn = found.select(*_COLUMNS), turn + 1
        # Inside a range means increase, so one row of each tells whether its border holds a violation.
        ends = found.groupBy("key").agg(F.min("mean").alias("least"), F.max("mean").alias("most"))
        before = F.lag("most").over(Window.partitionBy(F.lit(0)).orderBy("key"))
        if ends.withColumn("before", before).where("before >= least").isEmpty():
            return blocks
