"""Statistics of every user and horizon, by one pass over rows that lie sorted by user.

Spark partitions and sorts the rows; a task takes whole users out of its stream, some ten thousand rows at a time, and
computes the statistics of all of them with array operations. Nothing is copied per horizon, and no user has a buffer
of its own. Minimum, maximum and median follow Spark's order of doubles, in which NaN comes last.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

TASK_ROWS = 1 << 16  # about how many rows are computed at a time; one user's rows are never parted
_START, _AGE, _RANKED, _HOLIDAYS, _NUMBER = "_start", "_age", "_ranked", "_holidays", "_number"


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that hold each group whole, with the first rows of the groups, by the row numbers inside the groups. A
    group longer than ``rows`` is looked at once more each time it has doubled."""
    held, size, wanted = [], 0, rows

    def joined() -> tuple[pa.RecordBatch, np.ndarray]:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return whole, np.flatnonzero(whole.column(whole.schema.get_field_index(_NUMBER)).to_numpy() == 1)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < wanted:
            continue
        whole, first = joined()
        if len(first) > 1:
            yield whole.slice(0, first[-1]), first[:-1]
        held = [whole.slice(first[-1])]
        size = held[0].num_rows
        wanted = max(rows, 2 * size)
    if held:
        yield joined()


def _known(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Values and whether there is one."""
    known = pc.is_valid(column).to_numpy(zero_copy_only=False)
    values = pc.fill_null(column, 0) if column.null_count else column
    return values.to_numpy(zero_copy_only=False).astype(kind, copy=False), known


def _spread(values: np.ndarray, present: np.ndarray, groups: int, kind: pa.DataType) -> pa.Array:
    """A value for each of the ``present`` groups and null for the others."""
    out = np.zeros(groups, values.dtype)
    out[present] = values
    missing = np.ones(groups, bool)
    missing[present] = False
    return pa.array(out, mask=missing).cast(kind)


def _statistics(batches: Iterator[pa.RecordBatch], keys: int, measures: list[str], horizons: list[int], schema: pa.Schema, rows: int) -> Iterator[pa.RecordBatch]:
    kinds = {f.name: f.type for f in schema}
    for batch, first in _whole_groups(batches, rows):
        groups = len(first)
        group = np.repeat(np.arange(groups), np.diff([*first, batch.num_rows]))
        found = {schema.names[i]: batch.column(i).take(pa.array(first)) for i in range(keys)}
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        start, dated = _known(column[_START], np.int64)
        age, aged = _known(column[_AGE], np.int64)
        ranked = column[_RANKED].to_numpy(zero_copy_only=False)[first].astype(bool)
        spans = {0: np.ones(len(group), bool), **{days: aged & (age <= days) for days in horizons}}

        # The lifetime: weeks and days from the first to the last.
        counts = np.bincount(group[dated], minlength=groups)
        found["d0_num_of_active_weeks"] = pa.array(counts)
        present = np.flatnonzero(counts)
        at = (np.cumsum(counts) - counts)[present]
        days_of = start[dated]
        subscribed = np.maximum.reduceat(days_of, at) - np.minimum.reduceat(days_of, at) if len(at) else days_of[:0]
        found["d0_days_subscribed"] = _spread(subscribed, present, groups, pa.int32())
        holidays, listed = _known(column[_HOLIDAYS], np.int64)
        for days in horizons:
            some = spans[days] & listed
            counts = np.bincount(group[some], minlength=groups)
            present = np.flatnonzero(counts)
            at = (np.cumsum(counts) - counts)[present]
            total = np.add.reduceat(holidays[some], at) if len(at) else holidays[:0]
            found[f"d{days}_holidays"] = _spread(total, present, groups, pa.int64())

        for name in measures:
            whole = pa.types.is_integer(column[name].type)
            values, known = _known(column[name], np.int64 if whole else np.float64)
            # By user and value: of each horizon the ends and the middle of a user are then at known places.
            order = np.flatnonzero(known)
            order = order[np.lexsort((values[order], group[order]))]
            ordered, owner = values[order], group[order]
            for days, span in spans.items():
                inside = span[order]
                some = ordered[inside]
                counts = np.bincount(owner[inside], minlength=groups)
                present = np.flatnonzero(counts)
                n = counts[present]
                at = (np.cumsum(counts) - counts)[present]
                total = np.add.reduceat(some, at) if len(at) else some[:0]
                low, high = some[at + (n - 1) // 2], some[at + n // 2]
                middle = np.where(low == high, low, 0.5 * low + 0.5 * high).astype(np.float64)
                level = f"d{days}_{name}"
                found[f"{level}_average"] = _spread(total.astype(np.float64) / n, present, groups, pa.float64())
                found[f"{level}_min"] = _spread(some[at], present, groups, kinds[f"{level}_min"])
                found[f"{level}_max"] = _spread(some[at + n - 1], present, groups, kinds[f"{level}_max"])
                kept = ranked[present]
                found[f"{level}_median"] = _spread(middle[kept], present[kept], groups, pa.float64())
                found[f"{level}_sum"] = _spread(total, present, groups, kinds[f"{level}_sum"])
        yield pa.RecordBatch.from_arrays([found[f.name].cast(f.type) for f in schema], schema=schema)


def statistics_by_user(
    rows: DataFrame, keys: list[str], measures: list[str], start: str, last: str, holidays: str, ranked: Column, horizons: list[int],
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """One row for each combination of ``keys``, the first of which is the user: ``d0_...`` for all rows and ``d30_...``
    and so on for those at most so many days before ``last``. ``ranked`` says whether a user's medians are wanted; they
    are null otherwise. All rows of a user meet in one task."""
    measured = {f.name: f.dataType for f in rows.schema if f.name in measures}
    held = rows.select(
        *keys,
        F.datediff(start, F.lit("1970-01-01").cast("date")).alias(_START),
        F.datediff(last, start).alias(_AGE),
        F.coalesce(ranked, F.lit(False)).alias(_RANKED),
        F.col(holidays).cast("bigint").alias(_HOLIDAYS),
        *measures,
        # The window asks for whole users in a task, sorted; a plain repartition could be undone by a skew join.
        F.row_number().over(Window.partitionBy(*keys).orderBy(start)).alias(_NUMBER),
    )
    fields = [T.StructField(k, rows.schema[k].dataType) for k in keys]
    fields += [T.StructField("d0_num_of_active_weeks", T.LongType()), T.StructField("d0_days_subscribed", T.IntegerType())]
    fields += [T.StructField(f"d{days}_holidays", T.LongType()) for days in horizons]
    for days in [0, *horizons]:
        for name, kind in measured.items():
            total = T.LongType() if isinstance(kind, T.IntegralType) else T.DoubleType()
            of = {"average": T.DoubleType(), "min": kind, "max": kind, "median": T.DoubleType(), "sum": total}
            fields += [T.StructField(f"d{days}_{name}_{statistic}", k) for statistic, k in of.items()]
    schema = T.StructType(fields)
    compute = partial(_statistics, keys=len(keys), measures=list(measured), horizons=horizons, schema=to_arrow_schema(schema), rows=task_rows)
    return held.mapInArrow(compute, schema)
