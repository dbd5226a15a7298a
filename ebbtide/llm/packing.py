"""Packing of tokenized documents into training sequences by vector best fit.

A sequence has three capacities: tokens, pieces of documents, and attention cost (the sum of squared piece lengths).
Pieces differ only in their length, so the whole corpus is a histogram of at most ``tokens`` lengths; best fit runs
on that histogram, longest first, and moves all pieces of a length that go to like sequences in one step. Its plan
says which ranks of a length go to which sequences, and the ranks are found by Spark: pieces never meet in one
place."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import text_batches
from ebbtide.session import stage

END = 0  # the id that closes every document
SPECIAL = {"<|endoftext|>": 50256}
BUCKET_PIECES = 20_000  # pieces of one length that are ranked in one window, about

# Texts on which both libraries read the same word pattern; others go to the slower one.
_PLAIN = re.compile("[^\t\n\x20-\x7e¡-ɏ]")


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence, the weights of the three dimensions in a score and the score itself: ``norm`` takes
    the sequence with the least weighted norm of what stays free, ``dot`` the one with the largest weighted product
    of free capacity and demand."""

    tokens: int = 2048
    pieces: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    rule: str = "norm"


@dataclass
class Plan:
    """Ranks [r0, r1) of a length go to sequences b0, b0 + 1, ... at an offset."""

    length: list[int] = field(default_factory=list)
    r0: list[int] = field(default_factory=list)
    r1: list[int] = field(default_factory=list)
    b0: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    sequences: int = 0

    def add(self, length: int, r0: int, n: int, b0: int, offset: int) -> None:
        for name, value in (("length", length), ("r0", r0), ("r1", r0 + n), ("b0", b0), ("offset", offset)):
            getattr(self, name).append(value)


def plan_sequences(histogram: dict[int, int], limits: Limits) -> Plan:
    """Vector best fit, longest first, over classes of like sequences (same free capacities, consecutive numbers)."""
    caps = np.array([limits.tokens, limits.pieces, limits.cost], float)
    weights = np.array(limits.weights)
    free = np.zeros((1024, 3))
    count, first = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
    used, plan = 0, Plan()
    for length in sorted(histogram, reverse=True):
        demand = np.array([length, 1, length * length], float)
        if (demand > caps).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacities of a sequence")
        rank, left = 0, histogram[length]
        while left:
            fits = np.flatnonzero((count[:used] > 0) & (free[:used] >= demand).all(axis=1))
            if len(fits):
                if limits.rule == "norm":
                    score = -((weights * ((free[fits] - demand) / caps) ** 2).sum(axis=1))
                else:
                    score = (weights * (free[fits] / caps) * (demand / caps)).sum(axis=1)
                at = int(fits[np.argmax(score)])
                room, bins, b0 = free[at].copy(), int(count[at]), int(first[at])
            else:
                at, room, bins, b0 = -1, caps.copy(), left, plan.sequences
            each = int((room // demand).min())
            full = min(bins, left // each)
            rest = left - full * each if full < bins else 0
            rest = min(rest, each)
            for slot in range(each):
                n = full + (1 if slot < rest else 0)
                if n:
                    plan.add(length, rank, n, b0, int(limits.tokens - room[0]) + slot * length)
                    rank += n
            touched = full + (1 if rest else 0)
            left -= full * each + rest
            if at < 0:
                plan.sequences += touched
            else:
                count[at] -= touched
                first[at] += touched
            for n, start, held in ((full, b0, each), (1 if rest else 0, b0 + full, rest)):
                if n:
                    gone = np.flatnonzero(count[:used] == 0)
                    slot = int(gone[0]) if len(gone) else used
                    used = max(used, slot + 1)
                    if used > len(count):
                        free, count, first = (np.concatenate([x, np.zeros_like(x)]) for x in (free, count, first))
                    free[slot], count[slot], first[slot] = room - held * demand, n, start
    return plan


def vocabulary() -> tuple[str, str, str]:
    """Paths of the installed vocabulary for both libraries, and its word pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _pieces(tokenizer: str, ranks: str, pattern: str, size: int):
    """(doc_id, row, text) to the pieces of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(tokenizer)
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens=SPECIAL)

        def ids(text: str) -> np.ndarray:
            if _PLAIN.search(text):
                found = slow.encode(text, add_special_tokens=False).ids
            else:
                found = fast.encode(text, allowed_special="all")
            return np.array([*found, END], "<u4")

        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(2)):
                tokens = ids(text.as_py() or "")
                head = len(tokens) % size or min(size, len(tokens))
                cuts = [0, *range(head, len(tokens) + 1, size)]
                for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    at.append(i)
                    piece.append(j)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(tokens[a:b].tobytes()))
            taken = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(taken),
                    batch.column(1).take(taken),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ],
                names=["doc_id", "row", "piece", "start", "length", "ids_crc32"],
            )

    return run


def _placed(plan: Plan):
    order = np.lexsort((plan.r0, plan.length))
    length, r0, b0, offset = (np.array(getattr(plan, x), np.int64)[order] for x in ("length", "r0", "b0", "offset"))
    key = length * (1 << 44) + r0  # ranks stay below 2**44

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 6))
            step = np.searchsorted(key, lengths * (1 << 44) + ranks, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in (0, 2, 3, 4, 5)), pa.array(b0[step] + ranks - r0[step]), pa.array(offset[step])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def packed(
    docs: DataFrame, tokenizer: str, ranks: str, pattern: str, limits: Limits = Limits(), id_col: str = "doc_id"
) -> DataFrame:
    """The pieces of all documents and their places: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A document is its text's ids and the closing id; null and empty texts are the closing id alone. Documents of more
    than ``limits.tokens`` ids are cut from the end into pieces of that size, so the first may be shorter.
    ``tokenizer`` and ``ranks`` are paths of the same vocabulary for its two libraries, ``pattern`` its word pattern;
    texts with characters beyond Latin letters and plain white space are read by the first. Repeated rows, repeated
    ids and null ids are documents of their own. Equal lengths are placed in the order of a hash. Other columns are
    ignored; an empty table gives an empty result."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    pieces = stage(
        rows.mapInArrow(
            _pieces(tokenizer, ranks, pattern, limits.tokens),
            f"doc_id {kind}, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint",
        ),
        "pieces",
    )
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most limits.tokens rows
    plan = plan_sequences(histogram, limits)
    buckets = -(-max(histogram.values(), default=1) // BUCKET_PIECES)
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = bucketed.groupBy("length", "bucket").count().select(
        "length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("length", "bucket").orderBy("row", "piece")
    ranked = (
        bucketed.withColumn("n", F.row_number().over(inside))
        .join(bases, ["length", "bucket"])
        .select("doc_id", "row", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("n") - 1).alias("rank"))
    )
    return ranked.mapInArrow(
        _placed(plan),
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
