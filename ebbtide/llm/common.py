"""Shared pieces of the corpus operators: batches, column checks and connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import stage

# Rows of whole texts that a task hands to Python at once.
TEXT_ROWS, TEXT_BYTES = "1000", str(16 << 20)

# Hashes of which a filter is sent to the tasks; of more, none is. It has 16 to 32 bits a hash.
FILTER_HASHES = 1 << 23


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Small Arrow batches, by rows and by bytes, so that long texts do not add up in a worker. Holds for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", TEXT_BYTES)


def hash_filter(hashes: DataFrame):
    """The hashes in column ``h`` as a table of bits, sent out, or None where there are more than FILTER_HASHES.

    Its size follows the number of hashes. What it lets through has to be joined; without it everything has."""
    n = hashes.count()
    if n > FILTER_HASHES:
        return None
    bits = 1 << max(16, (16 * n - 1).bit_length() if n else 0)
    bit = F.pmod(F.col("h"), F.lit(bits))
    words = (
        hashes.select(F.floor(bit / 64).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(h, {bits}L) % 64 as int))").alias("bits"))
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    table = np.zeros(bits // 64, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(table.view(np.uint8))


def passing(sent, hashes: np.ndarray) -> np.ndarray:
    """Which of ``hashes`` (unsigned) a sent filter lets through: all that are in it and a few more."""
    if sent is None:
        return np.ones(len(hashes), bool)
    table = sent.value
    bit = hashes % np.uint64(len(table) * 8)
    return table[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1


def sample_cut(df: DataFrame, digest, rows: int) -> int:
    """The value up to which ``digest`` (a 64-bit hash) of the rows of ``df`` has at most ``rows`` distinct values.

    Whatever the size of the input, and however often a value repeats, the bound holds, and something is drawn
    wherever there is something: the share of the hash range that is looked at follows the number of rows and widens
    until it holds enough values."""
    total, most = df.count(), (1 << 63) - 1
    if total <= rows:
        return most
    share = min(1.0, 2.0 * rows / total)
    while True:
        top = most if share >= 1 else int((2.0 * share - 1.0) * float(1 << 63))
        drawn = df.select(digest.alias("drawn")).where(F.col("drawn") <= top).distinct().orderBy("drawn").limit(rows)
        n, cut = drawn.agg(F.count("*"), F.max("drawn")).first()
        if n >= rows:
            return cut
        if share >= 1:
            return most
        share = min(1.0, share * 16)


def boxed(df: DataFrame) -> DataFrame:
    """``df`` as one column ``doc`` that holds the whole row, so that no name of its columns meets another."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"))


def width(spark: SparkSession) -> int:
    """Partitions for an explicit shuffle: as many as the session's own shuffles have."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b: bigint) as (id, component), component being the smallest id.

    Alternating large and small stars: every round is joins and aggregates on node ids and its links are written,
    so a node with very many links is split like any skewed join. Nodes without links have no row."""
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stage(
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(),
            "large-star",
        )
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(down, "a")
        small = stage(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(down.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct(),
            "small-star",
        )
        # Done when every node has one link and no link's target has a link of its own.
        open_nodes = small.groupBy("a").count().where("count > 1").select("a")
        chained = small.select(F.col("b").alias("a")).distinct().join(small.select("a"), "a", "left_semi")
        if open_nodes.union(chained).isEmpty():
            roots = small.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            return small.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
        edges = small
