"""Stratified splits and folds of exact size, and balanced class weights.

A row's part depends only on comparing its order value with a few cut values per class. The cuts are
found by :func:`rank_cuts`, so no class is ever sorted in one task, and the wide table itself is only
mapped, never shuffled.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.ranking import rank_cuts
from ebbtide.session import broadcast_if_small, stage

_ORDER = "_order"
FEW_WEIGHTS = 64  # so many class weights are looked up in one value, more are joined


def _require_boolean(df: DataFrame, label: str) -> None:
    """Class tables are broadcast; a boolean label bounds them to three rows."""
    if not isinstance(df.schema[label].dataType, T.BooleanType):
        raise TypeError(f"{label} must be boolean")


def shuffled_order(key: str, seed: int) -> Column:
    """A repeatable random order: digest of seed and key, then the key itself."""
    return F.struct(F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))).alias("digest"), F.col(key))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))


def _proportional(counts: DataFrame, label: str, rows: str, wanted: Column, out: str) -> DataFrame:
    """Share ``wanted`` rows out over the classes by size: whole parts first, what is left to the
    largest fractions."""
    every = Window.partitionBy(F.lit(0))
    share = F.col(rows) * wanted / F.sum(rows).over(every)
    ordered = every.orderBy(F.desc("_fraction"), F.asc(label))
    return (
        counts.withColumn("_share", share)
        .withColumn("_fraction", F.col("_share") - F.floor("_share"))
        .withColumn("_left", wanted - F.sum(F.floor("_share")).over(every))
        .withColumn(out, F.floor("_share") + F.when(F.row_number().over(ordered) <= F.col("_left"), 1).otherwise(0))
        .drop("_share", "_fraction", "_left")
    )


def _assign(df: DataFrame, label: str, order: Column, wanted: DataFrame, part: str) -> DataFrame:
    """``part`` = number of cuts lying before the row. ``wanted`` is ``(label, cut, rank)``; a cut at
    rank 0 lies before every row of its class. A row without a label has no part (null). The few cuts are
    written, so that the part is a comparison made anew by every scan and ``df`` needs no second copy; each scan reads
    the cuts of a class as one value, as a join would cost more than the rest of a scan of wide rows."""
    keyed = df.withColumn(_ORDER, order)
    found = rank_cuts(keyed.where(F.col(label).isNotNull()), label, _ORDER, wanted.where(F.col("rank") > 0))
    per_class = (
        wanted.join(found, [label, "cut"], "left")
        .groupBy(label)
        .agg(F.collect_list(_ORDER).alias("_cuts"), F.count_if(F.col("rank") <= 0).alias("_empty"))
    )
    written = stage(per_class, "cuts")
    yes, no = (written.where(F.col(label) == value).select(F.struct("_cuts", "_empty")).scalar() for value in (True, False))
    own = F.when(F.col(label), yes).otherwise(no)
    before = F.size(F.filter(F.col("_own")["_cuts"], lambda cut: cut < F.col(_ORDER))) + F.col("_own")["_empty"]
    passed = F.when(F.col(label).isNotNull(), before).cast("int")
    return keyed.withColumn("_own", own).select(*df.columns, passed.alias(part))


def stratified_split(
    df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42, part: str = "split"
) -> DataFrame:
    """Adds ``split`` = ``train`` or ``test``; sizes and class shares are those of a stratified
    random split, the rows are drawn by a digest of ``key``."""
    _require_boolean(df, label)
    total = F.sum("class_rows").over(Window.partitionBy(F.lit(0)))
    counts = class_counts(df, label).withColumn("_train", total - F.ceil(total * F.lit(test_size)))
    wanted = _proportional(counts, label, "class_rows", F.col("_train"), "rank").select(
        label, F.lit(0).alias("cut"), "rank"
    )
    assigned = _assign(df, label, shuffled_order(key, seed), wanted, part)
    return assigned.withColumn(part, F.when(F.col(part) == 0, "train").when(F.col(part) > 0, "test"))


def three_way_split(
    df: DataFrame,
    label: str,
    key: str,
    valid_size: float = 0.1,
    test_size: float = 0.1,
    seed: int = 42,
    part: str = "split",
) -> DataFrame:
    """Adds ``split`` = ``train``, ``valid`` or ``test``; both sizes are fractions of all rows."""
    if valid_size + test_size > 1:
        raise ValueError("validation and test size must not exceed 1 together")
    _require_boolean(df, label)
    total = F.sum("class_rows").over(Window.partitionBy(F.lit(0)))
    counts = (
        class_counts(df, label)
        .withColumn("_valid", F.ceil(total * F.lit(valid_size)))
        .withColumn("_test", F.ceil(total * F.lit(test_size)))
        .withColumn("_rest", total - F.col("_valid"))
        .withColumn("_train", F.col("_rest") - F.col("_test"))
    )
    kept = _proportional(counts, label, "class_rows", F.col("_rest"), "_kept")
    cuts = _proportional(kept, label, "_kept", F.col("_train"), "_first").select(
        label, F.posexplode(F.array("_first", "_kept")).alias("cut", "rank")
    )
    assigned = _assign(df, label, shuffled_order(key, seed), cuts, part)
    return assigned.withColumn(
        part, F.when(F.col(part) == 0, "train").when(F.col(part) == 1, "test").when(F.col(part) > 1, "valid")
    )


def stratified_folds(
    df: DataFrame, label: str, key: str, folds: int = 5, fold: str = "fold"
) -> DataFrame:
    """Adds ``fold`` 0 .. folds - 1: consecutive blocks by ``key`` inside each class.

    Block sizes come from dealing the rows, sorted by class, out to the folds in turn; classes are
    sorted by their first appearance in ``key`` order.
    """
    _require_boolean(df, label)
    counts = (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(key).alias("_first"))
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0))

    def dealt(upto: Column, index: Column) -> Column:
        """How many of the positions 0 .. upto - 1 fall to fold ``index``."""
        return F.floor((upto + folds - 1 - index) / folds)

    index = F.col("cut")
    wanted = (
        counts.withColumn("_start", start)
        .withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
        .withColumn("_size", dealt(F.col("_start") + F.col("_rows"), index) - dealt(F.col("_start"), index))
        .withColumn(
            "rank",
            F.sum("_size").over(
                Window.partitionBy(label).orderBy("cut").rowsBetween(Window.unboundedPreceding, 0)
            ),
        )
        .where(F.col("cut") < folds - 1)
        .select(label, "cut", "rank")
    )
    return _assign(df, label, F.col(key), wanted, fold)


def with_balanced_weights(
    df: DataFrame, label: str, by: list[str] | None = None, weight: str = "weight"
) -> DataFrame:
    """Adds rows / (classes * rows of the class), over all rows or inside each ``by`` group (split
    or fold). The table of weights has one row per class and group; it is written, and where it is short each scan reads
    it as one value instead of joining wide rows. A row without a label counts for nothing and has no weight (null); a null ``by`` value is a group."""
    by = by or []
    _require_boolean(df, label)
    inside = Window.partitionBy(*(by or [F.lit(0)]))
    counts = df.where(F.col(label).isNotNull()).groupBy(*by, label).agg(F.count(F.lit(1)).alias("_class_rows"))
    weights = counts.select(
        *by,
        label,
        (F.sum("_class_rows").over(inside) / (F.count(F.lit(1)).over(inside) * F.col("_class_rows"))).alias(weight),
    )
    named = {c: f"_of_{c}" for c in [*by, label]}
    weights = stage(weights.withColumnsRenamed(named), "class-weights")
    if weights.count() <= FEW_WEIGHTS:
        every = weights.agg(F.collect_list(F.struct(*named.values(), weight))).scalar()
        own = F.filter("_every", lambda entry: reduce(and_, [F.col(c).eqNullSafe(entry[n]) for c, n in named.items()]))
        return df.withColumn("_every", every).select(*df.columns, F.get(own, F.lit(0))[weight].alias(weight))
    weights = broadcast_if_small(weights)
    same = reduce(and_, [df[c].eqNullSafe(weights[n]) for c, n in named.items()])
    return df.join(weights, same, "left").select(*[df[c] for c in df.columns], weight)
