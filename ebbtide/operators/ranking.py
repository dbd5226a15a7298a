"""Running sums and rank cuts over a global order without a single-task window.

Edges sampled from the values cut the order into buckets, as many as the number of rows asks for. A
bucket is a pure function of the value, found by halving the sorted edges, so a lost executor
recomputes the same buckets. Windows run inside one bucket; only one total per bucket is ordered
globally. Any edges give right results, better ones only balance better.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import stage

BUCKETS = 256  # least number of buckets
BUCKET_ROWS = 1_000_000  # rows of a bucket from which on there are more of them
SAMPLE = 1 << 14  # values that edges are taken from, and so the most buckets
_BUCKET = "_bucket"
_EDGES = "_edges"


def sampled_edges(df: DataFrame, order: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> Column:
    """Sorted array of ``buckets`` values, or of one for every ``bucket_rows`` rows if that is more: evenly
    spaced values of a uniform sample of the distinct ones, which is made by one combining aggregate (from
    each of SAMPLE hash classes the value of least hash)."""
    spread = F.xxhash64(F.col(order))
    sample = (
        df.groupBy(F.pmod(spread, F.lit(SAMPLE)).alias("_class"))
        .agg(F.min_by(F.col(order), spread).alias("_value"), F.count(F.lit(1)).alias("_rows"))
        .agg(F.array_sort(F.collect_list("_value")).alias("_sample"), F.sum("_rows").alias("_rows"))
    )
    wanted = F.greatest(F.lit(buckets), F.ceil(F.col("_rows") / bucket_rows))
    apart = F.greatest(F.lit(1), F.floor(F.size("_sample") / wanted))
    spaced = F.filter("_sample", lambda value, i: (i + 1) % F.col("_apart") == 0)
    return sample.withColumn("_apart", apart).select(spaced.alias(_EDGES)).scalar()


def edges_below(edges: Column, value: Column) -> Column:
    """How many of the sorted ``edges`` are less than ``value``; 0 for a null. By halving, so in log time."""
    whole = F.struct(F.lit(0).alias("lo"), F.size(edges).alias("hi"))
    halvings = F.sequence(F.lit(0), F.ceil(F.log2(F.size(edges) + 1)).cast("int"))

    def half(span: Column, _: Column) -> Column:
        middle = F.floor((span["lo"] + span["hi"]) / 2).cast("int")
        less = (span["lo"] < span["hi"]) & (F.get(edges, middle) < value)
        more = (span["lo"] < span["hi"]) & ~F.coalesce(less, F.lit(False))
        return F.struct(
            F.when(less, middle + 1).otherwise(span["lo"]).alias("lo"), F.when(more, middle).otherwise(span["hi"]).alias("hi")
        )

    return F.aggregate(halvings, whole, half, lambda span: span["lo"])


def with_bucket(df: DataFrame, order: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with the number of its bucket, written once because bucket totals and rows are both
    derived from it."""
    edges = sampled_edges(df, order, buckets, bucket_rows)
    below = edges_below(F.col(_EDGES), F.col(order))
    return stage(df.withColumn(_EDGES, edges).withColumn(_BUCKET, below).drop(_EDGES), "buckets")


def running_sums(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    by: list[str] | None = None,
    descending: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``df`` plus, for every ``new: column`` of ``sums``, the sum of ``column`` up to and including
    the row in the given order. ``df`` holds each ``order`` value once per ``by`` group (aggregate
    before), so ties and hot values are single rows."""
    by = by or []
    keyed = with_bucket(df, order, buckets)

    def direction(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    inside = Window.partitionBy(*by, _BUCKET).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = keyed.withColumns({new: F.sum(old).over(inside) for new, old in sums.items()})
    totals = keyed.groupBy(*by, _BUCKET).agg(*[F.sum(old).alias(f"_total_{new}") for new, old in sums.items()])
    # At most SAMPLE + 1 rows per group are ordered here, whatever the size of the data.
    before = (
        Window.partitionBy(*(by or [F.lit(0)]))
        .orderBy(direction(_BUCKET))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *by,
        _BUCKET,
        *[F.coalesce(F.sum(f"_total_{new}").over(before), F.lit(0)).alias(f"_before_{new}") for new in sums],
    )
    return (
        local.join(offsets, [*by, _BUCKET])
        .withColumns({new: F.col(new) + F.col(f"_before_{new}") for new in sums})
        .drop(_BUCKET, *[f"_before_{new}" for new in sums])
    )


def dense_ranks(df: DataFrame, value: str, rank: str, buckets: int = BUCKETS) -> DataFrame:
    """Distinct non-null values with their 0-based position in sorted order."""
    distinct = df.select(value).where(F.col(value).isNotNull()).distinct().withColumn("_one", F.lit(1))
    ranked = running_sums(distinct, value, {rank: "_one"}, buckets=buckets)
    return ranked.select(value, (F.col(rank) - 1).alias(rank))


def rank_cuts(df: DataFrame, by: str, order: str, wanted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The ``order`` value standing at each wanted 1-based rank of its ``by`` group.

    ``wanted`` is ``(by, cut, rank)``; the result is ``(by, cut, order)``. Only rows of the buckets
    that contain a wanted rank are ever sorted.
    """
    keyed = with_bucket(df.select(by, order), order, buckets)
    upward = Window.partitionBy(by).orderBy(_BUCKET)
    counts = (
        keyed.groupBy(by, _BUCKET)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_until", F.sum("_rows").over(upward.rowsBetween(Window.unboundedPreceding, 0)))
    )
    hits = (
        wanted.join(counts, by)
        .where((F.col("rank") <= F.col("_until")) & (F.col("rank") > F.col("_until") - F.col("_rows")))
        .select(by, _BUCKET, "cut", (F.col("rank") - F.col("_until") + F.col("_rows")).alias("_place"))
    )
    touched = keyed.join(F.broadcast(hits.select(by, _BUCKET).distinct()), [by, _BUCKET], "left_semi")
    inside = Window.partitionBy(by, _BUCKET).orderBy(order)
    placed = touched.withColumn("_place", F.row_number().over(inside))
    return placed.join(F.broadcast(hits), [by, _BUCKET, "_place"]).select(by, "cut", order)
