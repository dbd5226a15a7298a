"""Exact quantiles of groups of any size.

``percentile`` and ``median`` hold every distinct value of a group in one buffer, which a group with a
third of all rows would burst. Here a mergeable sketch first brackets each wanted quantile; then only
the values inside a bracket are counted one by one, all others being counted under the bracket edge
before them. The answer is exact: the sketch only decides which values may be lumped together. The
counts are added up by range buckets, so no group's values have to be ordered in one task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.ranking import running_sums
from ebbtide.session import broadcast_if_small, stage

# Groups up to this size are ranked whole; larger ones only inside their brackets.
WHOLE_GROUP_ROWS = 1_000_000


def sketch_accuracy(largest_group: int) -> int:
    """Finer sketches for very large groups, so that a bracket stays some millions of values."""
    return 10_000 if largest_group <= 2_500_000_000 else 100_000


def _brackets(
    values: DataFrame, by: list[str], value: str, probabilities: list[float], accuracy: int, whole: int
) -> DataFrame:
    slack = 2.0 / accuracy
    edges = [e for p in probabilities for e in (max(p - slack, 0.0), min(p + slack, 1.0))]
    sketched = values.groupBy(*by).agg(
        F.count(value).alias("_n"),
        F.percentile_approx(value, edges, accuracy).alias("_edges"),
        F.min(value).alias("_least"),
        F.max(value).alias("_most"),
    )
    every = F.col("_n") <= whole
    bounds = []
    for i in range(len(probabilities)):
        bounds += [
            F.when(every, F.col("_least")).otherwise(F.col("_edges")[2 * i]).alias(f"_low{i}"),
            F.when(every, F.col("_most")).otherwise(F.col("_edges")[2 * i + 1]).alias(f"_high{i}"),
        ]
    return sketched.select(*by, "_n", *bounds)


def _counted_in_brackets(
    known: DataFrame, by: list[str], value: str, probabilities: list[float], accuracy: int, whole: int
) -> DataFrame:
    """Rows per value inside a bracket; the others are counted at the bracket edge below them."""
    brackets = stage(_brackets(known, by, value, probabilities, accuracy, whole), "brackets")
    v, nothing = F.col(value), F.lit(float("-inf"))
    inside, edge = F.lit(False), nothing
    for i in range(len(probabilities)):
        inside = inside | v.between(F.col(f"_low{i}"), F.col(f"_high{i}"))
        edge = F.greatest(edge, F.when(F.col(f"_high{i}") <= v, F.col(f"_high{i}")).otherwise(nothing))
    return (
        known.join(broadcast_if_small(brackets), by)
        .groupBy(*by, "_n", F.when(inside, v).otherwise(edge).alias("_point"))
        .agg(F.count(F.lit(1)).alias("_count"))
    )


def exact_quantiles(
    values: DataFrame,
    by: list[str],
    value: str,
    probabilities: list[float],
    largest_group: int,
    whole_group_rows: int = WHOLE_GROUP_ROWS,
    accuracy: int | None = None,
) -> DataFrame:
    """``by..., quantiles`` with the linearly interpolated quantiles as an array in the order asked.

    ``values`` has one double ``value`` per row; nulls are ignored and all-null groups are absent.
    """
    known = values.where(F.col(value).isNotNull())
    if largest_group <= whole_group_rows:
        counted = known.groupBy(*by, F.col(value).alias("_point")).agg(F.count(F.lit(1)).alias("_count"))
        counted = counted.withColumn("_n", F.sum("_count").over(Window.partitionBy(*by)))
        upward = Window.partitionBy(*by).orderBy("_point").rowsBetween(Window.unboundedPreceding, 0)
        ranked = counted.withColumn("_until", F.sum("_count").over(upward))
    else:
        accuracy = accuracy or sketch_accuracy(largest_group)
        counted = _counted_in_brackets(known, by, value, probabilities, accuracy, whole_group_rows)
        ranked = running_sums(counted, "_point", {"_until": "_count"}, by)
    last = F.col("_n") - 1
    picks = []
    for i, p in enumerate(probabilities):
        position = last * F.lit(float(p))
        picks += [
            F.min(F.when(F.col("_until") > F.floor(position), F.col("_point"))).alias(f"_lower{i}"),
            F.min(F.when(F.col("_until") > F.ceil(position), F.col("_point"))).alias(f"_upper{i}"),
        ]
    interpolated = []
    for i, p in enumerate(probabilities):
        position = last * F.lit(float(p))
        low, high = F.col(f"_lower{i}"), F.col(f"_upper{i}")
        interpolated.append(low + (high - low) * (position - F.floor(position)))
    return (
        ranked.groupBy(*by, "_n")
        .agg(*picks)
        .select(*by, F.array(*interpolated).alias("quantiles"))
    )


# ---- quantiles of many columns -------------------------------------------------------------------------------------
# A double's bits, read as a number, have the order of the doubles. Each pass counts the values of a column by the next
# bits below those already known of a wanted rank, so that nothing but counts is moved; three passes are enough for single
# precision and small whole numbers, five for any double.

PASS_BITS = 13
_SIGN, _REST = np.uint64(1 << 63), np.int64((1 << 63) - 1)
COUNTED = "column int, prefix long, places binary, counts binary, every long, some long"
CHOSEN = "column int, target int, prefix long, rank long, n long, every long, some long"


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.int64)
    return (bits ^ ((bits >> 63) & _REST)).view(np.uint64) ^ _SIGN


def of_ordered_bits(key: int) -> float:
    bits = np.array([key], np.uint64) ^ _SIGN
    bits = bits.view(np.int64)
    return float((bits ^ ((bits >> 63) & _REST)).view(np.float64)[0])


def _count_bits(batches: Iterator[pa.RecordBatch], wanted: dict[int, list[int]], used: int, width: int) -> Iterator[pa.RecordBatch]:
    """Counts by the next ``width`` bits below each wanted prefix of ``used`` bits, added up in the task; ``every`` has the
    bits that all values of a prefix have, ``some`` those that any has."""
    held: dict[tuple[int, int], list] = {}
    mask, low = np.uint64((1 << width) - 1), np.uint64(64 - used - width)
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        for c, prefixes in wanted.items():
            own = values[:, c]
            keys = ordered_bits(own[~np.isnan(own)])
            for prefix in prefixes:
                inside = keys[(keys >> np.uint64(64 - used)) == np.uint64(prefix)] if used else keys
                if not len(inside):
                    continue
                counts = np.bincount(((inside >> low) & mask).astype(np.int64), minlength=1 << width)
                every, some = np.bitwise_and.reduce(inside), np.bitwise_or.reduce(inside)
                if (c, prefix) in held:
                    one = held[c, prefix]
                    one[0] += counts
                    one[1], one[2] = one[1] & every, one[2] | some
                else:
                    held[c, prefix] = [counts, every, some]
    for (c, prefix), (counts, every, some) in held.items():
        places = np.flatnonzero(counts)
        row = [c, prefix, places.astype(np.int32).tobytes(), counts[places].tobytes(), int(every.view(np.int64)), int(some.view(np.int64))]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=["column", "prefix", "places", "counts", "every", "some"])


def _choose_bits(table: pa.Table, wanted: dict[tuple[int, int], list[tuple[int, int]]] | None, probabilities: list[float], width: int) -> pa.Table:
    """For each rank wanted below the prefix: the longer prefix and the rank inside it."""
    c, prefix = table["column"][0].as_py(), table["prefix"][0].as_py()
    places = np.concatenate([np.frombuffer(x, np.int32) for x in table["places"].to_pylist()])
    counts = np.concatenate([np.frombuffer(x, np.int64) for x in table["counts"].to_pylist()])
    total = np.zeros(1 << width, np.int64)
    np.add.at(total, places, counts)
    until = np.cumsum(total)
    n = int(until[-1])
    if wanted is None:
        ranks = [(2 * i + j, int(end((n - 1) * p))) for i, p in enumerate(probabilities) for j, end in enumerate((floor, ceil))]
    else:
        ranks = wanted[c, prefix]
    found = [int(np.searchsorted(until, rank, side="right")) for _, rank in ranks]
    every = np.bitwise_and.reduce(table["every"].to_numpy())
    some = np.bitwise_or.reduce(table["some"].to_numpy())
    longer = np.array([(prefix << width) | b for b in found], np.uint64).view(np.int64)
    columns = {
        "column": pa.array([c] * len(ranks), pa.int32()), "target": pa.array([t for t, _ in ranks], pa.int32()), "prefix": pa.array(longer, pa.int64()),
        "rank": pa.array([rank - int(until[b] - total[b]) for (_, rank), b in zip(ranks, found)], pa.int64()), "n": pa.array([n] * len(ranks), pa.int64()),
        "every": pa.array([int(every)] * len(ranks), pa.int64()), "some": pa.array([int(some)] * len(ranks), pa.int64()),
    }
    return pa.table(columns)


def _chooser(ranks: dict | None, probabilities: list[float], width: int) -> Callable[[pa.Table], pa.Table]:
    return lambda table: _choose_bits(table, ranks, probabilities, width)


def wide_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list[float]]:
    """The linearly interpolated quantiles of every column that has a value; nulls and NaN are ignored. What tasks send is
    bounded by columns and quantiles, whatever the rows and values."""
    casts = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in columns)
    values = df.selectExpr(f"array({casts}) AS v")
    known: dict[tuple[int, int], float] = {}
    rows: dict[int, int] = {}
    used, wanted, ranks = 0, {c: [0] for c in range(len(columns))}, None
    while wanted:
        width = min(PASS_BITS, 64 - used)
        counted = values.mapInArrow(partial(_count_bits, wanted=wanted, used=used, width=width), COUNTED)
        chosen = counted.groupBy("column", "prefix").applyInArrow(_chooser(ranks, probabilities, width), CHOSEN)
        used += width
        left, ranks = 64 - used, defaultdict(list)
        for r in chosen.collect():
            prefix, every, some = (r[k] % (1 << 64) for k in ("prefix", "every", "some"))
            rows.setdefault(r["column"], r["n"])
            below = (1 << left) - 1
            if (every ^ some) & below:
                ranks[r["column"], prefix].append((r["target"], r["rank"]))
            else:
                known[r["column"], r["target"]] = of_ordered_bits((prefix << left) | (every & below))
        wanted = defaultdict(list)
        for c, prefix in ranks:
            wanted[c].append(prefix)
        wanted, ranks = dict(wanted), dict(ranks)
    found = {}
    for c, n in rows.items():
        found[columns[c]] = []
        for i, p in enumerate(probabilities):
            low, high, position = known[c, 2 * i], known[c, 2 * i + 1], (n - 1) * float(p)
            found[columns[c]].append(low + (high - low) * (position - floor(position)))
    return found
