"""Benchmark decontamination by winnowing.

Of every window of consecutive k-grams the smallest hash is a fingerprint, on both sides, so any shared span of
``span`` words holds at least one fingerprint chosen on both. Fingerprints meet in a join and each hit is extended
word by word; only runs of at least ``span`` equal words count. Items shorter than ``span`` words are one window
each and are looked up whole.

A bitmap of the items' fingerprints (of a fixed size, whatever the number of items) is sent to the tasks so that
only fingerprints that may occur in an item leave the scan of the documents. The join itself is exact."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import boxed, text_batches
from ebbtide.llm.text import ALNUM, gram_hashes, mix, utf8, word_hashes
from ebbtide.session import stage

BITMAP_BITS = 1 << 26
_WHOLE = np.uint64(0x5851F42D4C957F2D)  # keeps whole short items apart from k-grams

HITS = "array<struct<fp: bigint, at: int, size: int, gram: boolean, around: array<bigint>>>"


def _best(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The smallest or largest of each run of ``width`` neighbours."""
    out = values[: len(values) - width + 1].copy()
    for j in range(1, width):
        pick(out, values[j : j + len(out)], out=out)
    return out


def fingerprints(words: np.ndarray, k: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-grams that are smallest in some window; ties are all kept."""
    grams, width = gram_hashes(words, k), span - k + 1
    if len(grams) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = _best(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    chosen = np.flatnonzero(_best(np.concatenate([edge, least, edge]), width, np.maximum) == grams)
    return chosen, grams[chosen]


def _around(words: np.ndarray, at: np.ndarray, k: int, span: int, outside: int) -> np.ndarray:
    """Running hashes of the words left of each k-gram, outwards, then of those right of it."""
    reach = span - k
    padded = np.concatenate([np.full(reach, outside, np.uint64), words, np.full(reach, outside, np.uint64)])
    columns = []
    for step, start in ((-1, -1), (1, k)):
        running = np.zeros(len(at), np.uint64)
        for j in range(reach):
            running = mix(running ^ padded[at + reach + start + step * j])
            columns.append(running)
    return np.stack(columns, axis=1) if columns else np.zeros((len(at), 0), np.uint64)


def _hits(words: np.ndarray, k: int, span: int, whole: list[int], outside: int) -> tuple[np.ndarray, ...]:
    at, fps = fingerprints(words, k, span)
    sizes, is_gram = np.full(len(at), k), np.ones(len(at), bool)
    around = _around(words, at, k, span, outside)
    for length in whole:
        grams = gram_hashes(words, length) ^ _WHOLE
        at = np.concatenate([at, np.arange(len(grams))])
        fps, sizes = np.concatenate([fps, grams]), np.concatenate([sizes, np.full(len(grams), length)])
        is_gram = np.concatenate([is_gram, np.zeros(len(grams), bool)])
        around = np.concatenate([around, np.zeros((len(grams), around.shape[1]), np.uint64)])
    return fps, at, sizes, is_gram, around


def _scan(kind: str, k: int, span: int, whole: list[int], sent) -> callable:
    """Arrow batches (id, row, text, body) to (id, row, body, n_words, hits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value if sent is not None else None
        for batch in batches:
            n_words, ends, found = [], [0], []
            for raw in utf8(batch.column(2)):
                words = word_hashes(raw, ALNUM) if raw is not None else np.zeros(0, np.uint64)
                n_words.append(len(words))
                if kind == "item":
                    lengths = [len(words)] if 0 < len(words) < span else []
                    hits = _hits(words, k, span, lengths, outside=1)
                else:
                    hits = _hits(words, k, span, whole, outside=0)
                    keep = marked(bits, hits[0])
                    hits = tuple(part[keep] for part in hits)
                found.append(hits)
                ends.append(ends[-1] + len(hits[0]))
            fps, at, sizes, is_gram, around = (np.concatenate(parts) for parts in zip(*found)) if found else _hits(
                np.zeros(0, np.uint64), k, span, [], 0
            )
            width = around.shape[1]
            inner = pa.ListArray.from_arrays(
                pa.array(np.arange(len(fps) + 1) * width, pa.int32()), pa.array(around.ravel().view(np.int64))
            )
            struct = pa.StructArray.from_arrays(
                [pa.array(fps.view(np.int64)), pa.array(at, pa.int32()), pa.array(sizes, pa.int32()), pa.array(is_gram), inner],
                names=["fp", "at", "size", "gram", "around"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(3),
                    pa.array(n_words, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct),
                ],
                names=[batch.schema.names[0], "row", "body", "n_words", "hits"],
            )

    return run


def _scanned(table: DataFrame, id_col: str, kind: str, k: int, span: int, whole: list[int], sent) -> DataFrame:
    text_batches(table.sparkSession)
    rows = table.select(id_col, F.monotonically_increasing_id().alias("row"), "text", F.xxhash64("text").alias("body"))
    kept = f"`{id_col}` {dict(table.dtypes)[id_col]}, row bigint, body bigint, n_words bigint, hits {HITS}"
    return stage(rows.mapInArrow(_scan(kind, k, span, whole, sent), kept), f"{kind}-fingerprints")


def marked(bits: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    bit = fps % np.uint64(BITMAP_BITS)
    return bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1


def bitmap(fingerprints: DataFrame):
    """The hashes in column ``fp`` as bits, sent out; at most BITMAP_BITS / 64 rows reach the driver."""
    bit = F.pmod(F.col("fp"), F.lit(BITMAP_BITS))
    words = (
        fingerprints.select(F.floor(bit / 64).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(fp, {BITMAP_BITS}) % 64 as int))").alias("bits"))
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(BITMAP_BITS // 64, np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    return fingerprints.sparkSession.sparkContext.broadcast(bits.view(np.uint8))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", span: int = 10, k: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Each document with its number of words, and every hit run of words.

    Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z read as a-z. A run is hit where
    ``span`` consecutive words of an item occur, or a whole item of fewer words. Returns ``(documents, runs)``:
    documents (id, row, body, n_words), runs (row, item, lo, hi) with words counted from 0 and ``hi`` excluded.

    Null or empty texts have no words and no hits. An item without words matches nothing. Rows are told apart by
    ``row``, so repeated ids, repeated rows and null ids are documents of their own. Other columns are ignored."""
    items = _scanned(benchmark, item_col, "item", k, span, [], None)
    whole = [r[0] for r in items.where(f"n_words between 1 and {span - 1}").select("n_words").distinct().collect()]
    scanned = _scanned(docs, id_col, "document", k, span, sorted(whole), bitmap(items.select(F.explode("hits.fp").alias("fp"))))

    theirs = items.select(F.col(item_col).alias("item"), F.explode("hits").alias("h")).select(
        "item", "h.fp", F.col("h.around").alias("other")
    ).distinct()
    ours = scanned.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*")
    reach = span - k

    def equal(first: int):
        return sum((F.get("around", F.lit(first + j)) == F.get("other", F.lit(first + j))).cast("int") for j in range(reach))

    left, right = (equal(0), equal(reach)) if reach else (F.lit(0), F.lit(0))
    runs = (
        ours.join(theirs, "fp")
        .select("row", "item", "at", "size", F.when(F.col("gram"), left).otherwise(0).alias("l"), F.when(F.col("gram"), right).otherwise(0).alias("r"), "gram")
        .where(~F.col("gram") | (F.col("l") + F.col("r") + k >= span))
        .select("row", "item", (F.col("at") - F.col("l")).alias("lo"), (F.col("at") + F.col("size") + F.col("r")).alias("hi"))
        .distinct()
    )
    return scanned.select(id_col, "row", "body", "n_words"), stage(runs, "hit-runs")


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", span: int = 10, k: int = 5) -> DataFrame:
    """One row per document: words, hit words, items found and whether there are any. See :func:`contamination`.

    ``items_sha256`` is the digest of the comma-joined item ids in string order, of the empty string where none
    occurs. Items without an id mark words as hit but are not listed."""
    counted, runs = contamination(docs, benchmark, id_col, item_col, span, k)
    before = Window.partitionBy("row").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    hit = (
        runs.select("row", "lo", "hi")
        .distinct()
        .withColumn("seen", F.coalesce(F.max("hi").over(before), F.lit(0)))
        .groupBy("row")
        .agg(F.sum(F.greatest(F.lit(0), F.col("hi") - F.greatest("lo", "seen"))).alias("n_hit"))
    )
    items = runs.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    found = hit.join(items, "row")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(found, "row", "left").select(
        id_col,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", span: int = 10, k: int = 5) -> DataFrame:
    """``docs`` without the contaminated documents, with all columns. Rows are told apart by id and text."""
    counted, runs = contamination(docs, benchmark, id_col, item_col, span, k)
    hit = counted.join(runs.select("row").distinct(), "row", "left_semi").select(F.col(id_col).alias("hit_id"), F.col("body").alias("hit_body")).distinct()
    rows = boxed(docs).withColumn("body", F.xxhash64("doc.text"))
    same = F.col(f"doc.{id_col}").eqNullSafe(F.col("hit_id")) & (F.col("body") == F.col("hit_body"))
    return rows.join(hit, same, "left_anti").select("doc.*")
