"""Removal of repeated passages by overlapping three-line windows.

A line is a line of the text, cut further after each sentence and, within one, after every ``LINE_WORDS`` words, so
that a passage of a few sentences has several lines even where the text has no line breaks. Every three consecutive
lines are hashed; a window that occurs before (in a document with a smaller id, or further up in the same one) covers
its three lines, and what is covered goes.

Lines depend on where a sentence begins, so a passage from the middle of one may have others than its first occurrence.
Therefore runs of ``RUN_WORDS`` words are hashed too, at places chosen by their content alone: any ``SPAN_WORDS`` equal
words hold an equal run, and the runs of a longer passage overlap. A run that occurs before covers its words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import boxed, hash_filter, passing, text_batches
from ebbtide.llm.text import SPACED, _spans, gram_hashes, mix, utf8, word_hashes
from ebbtide.llm.winnowing import fingerprints
from ebbtide.session import stage

LINE_WORDS = 16
SENTENCE_ENDS = b".!?"
WINDOW = 3  # lines of a window
SPAN_WORDS = 50
RUN_WORDS = 26  # of the runs that begin at 25 neighbouring words one is chosen, so chosen ones overlap
NO_ID = (1 << 63) - 1  # rows without an id come last

_ENDS = np.zeros(256, bool)
_ENDS[list(SENTENCE_ENDS)] = True
_FACTORS = mix(np.arange(1, 4097, dtype=np.uint64))


def line_ends(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each line the number of words up to its end, and the byte at which the next line begins."""
    starts, ends = _spans(raw, SPACED)
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(raw == 0x0A, out=breaks[1:])
    hard = np.ones(n, bool)
    hard[:-1] = breaks[starts[1:]] > breaks[ends[:-1]]
    marks = np.flatnonzero(hard | _ENDS[raw[ends - 1]])
    # Parts of a sentence are counted from its start, so equal sentences have equal lines wherever they stand.
    sentences = np.append(0, marks + 1)
    sizes = np.diff(sentences)
    parts = -(-sizes // LINE_WORDS)
    part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts) + 1
    words = np.repeat(sentences[:-1], parts) + np.minimum(part * LINE_WORDS, np.repeat(sizes, parts))
    return words, np.append(starts, len(raw))[words]


def window_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and hashes of the windows and of the chosen runs, and the number of lines.

    The place of a window is its first line, that of a run from word i is -1 - i."""
    words, _ = line_ends(raw)
    hashes = word_hashes(raw, SPACED)
    runs, chosen = fingerprints(hashes, RUN_WORDS, SPAN_WORDS)
    if len(words) < WINDOW:
        return -1 - runs, chosen, len(words)
    first = np.concatenate([[0], words[:-1]])
    place = np.arange(len(hashes)) - np.repeat(first, words - first)
    lines = mix(np.add.reduceat(hashes * _FACTORS[place], first))
    windows = gram_hashes(lines, WINDOW)
    return np.concatenate([np.arange(len(windows)), -1 - runs]), np.concatenate([windows, chosen]), len(words)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ord, body, text) to (ord, body, n_lines, windows: first occurrence of each in the text, again: later ones)."""

    def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
        ends = pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts) if parts else [], kind))

    for batch in batches:
        n_lines, places, hashes, again = [], [], [], []
        for raw in utf8(batch.column(2)):
            at, windows, n = window_hashes(raw if raw is not None else np.zeros(0, np.uint8))
            _, firsts = np.unique(windows, return_index=True)
            later = np.ones(len(at), bool)
            later[firsts] = False
            n_lines.append(n)
            places.append(at[~later])
            hashes.append(windows[~later].view(np.int64))
            again.append(at[later])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n_lines, pa.int64()), lists(places, pa.int32()), lists(hashes, pa.int64()), lists(again, pa.int32())],
            names=["ord", "body", "n_lines", "places", "windows", "again"],
        )


def _repeated(sent):
    """(ord, body, places, windows) to (ord, body, at, h) of the windows that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, windows = batch.column(2), batch.column(3)
            owner = np.repeat(np.arange(len(batch)), pa.compute.list_value_length(windows).to_numpy(zero_copy_only=False))
            hashes = windows.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            keep = np.flatnonzero(passing(sent, hashes))
            row = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), places.flatten().take(pa.array(keep)), pa.array(hashes[keep].view(np.int64))],
                names=["ord", "body", "at", "h"],
            )

    return run


def _without(text: str, cuts, least_words: int) -> tuple[str, int]:
    raw = np.frombuffer(text.encode(), np.uint8)
    words, _ = line_ends(raw)
    first = np.concatenate([[0], words[:-1]])
    cuts = np.asarray(cuts)
    edges = np.zeros(words[-1] + 1, np.int64)
    at, runs = np.sort(cuts[cuts >= 0]), -1 - cuts[cuts < 0]
    if len(at):
        # Windows that follow each other count together, so short lines go where enough of them are repeated.
        lead = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        last = np.append(lead[1:], len(at)) - 1
        enough = words[at[last] + WINDOW - 1] - first[at[lead]] >= least_words
        at = at[np.repeat(enough, last - lead + 1)]
    np.add.at(edges, np.concatenate([first[at], runs]), 1)
    np.add.at(edges, np.concatenate([words[at + WINDOW - 1], runs + RUN_WORDS]), -1)
    covered = np.cumsum(edges[:-1]) > 0
    starts = _spans(raw, SPACED)[0]
    starts[0] = 0
    change = np.flatnonzero(np.diff(covered, prepend=True))  # kept and covered stretches take turns, a kept one first
    places = np.append(starts[change], len(raw))
    kept = b"".join(raw[a:b].tobytes() for a, b in zip(places[:-1:2], places[1::2])).decode()
    return (kept.rstrip() if covered[-1] else kept), int(np.logical_and.reduceat(covered, first).sum())


def _rewritten(least_words: int):
    def run(texts: pd.Series, cuts: pd.Series) -> pd.DataFrame:
        rows = [(None, 0) if t is None or c is None else _without(t, c, least_words) for t, c in zip(texts, cuts)]
        return pd.DataFrame(rows, columns=["text", "n_removed"]).astype({"n_removed": "int64"})

    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", least_words: int = 1) -> DataFrame:
    """``docs`` with ``text`` freed of later occurrences of windows, plus n_lines and n_removed (replaced if present).

    Windows are compared by words, A-Z as a-z, whatever the white space between them. With ``least_words``, repeated
    windows that follow each other stay where they cover fewer words than that; by default all go. ``n_removed`` counts
    the lines of which nothing is left; a run may also take a part of a line. Texts under three lines, empty and null texts stay as they are. Rows with the same id are one
    document: none is a repeat of the other. Rows without an id come last and count as one document. Of what is kept,
    nothing changes; white space left at the end by a removed last line goes too."""
    text_batches(docs.sparkSession)
    clash = [c for c in docs.columns if c in ("n_lines", "n_removed")]
    docs = docs.drop(*clash)
    keyed = {"ord": F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)), "body": F.xxhash64("text")}
    scanned = stage(
        docs.select(*[e.alias(n) for n, e in keyed.items()], "text").mapInArrow(
            _scan, "ord bigint, body bigint, n_lines bigint, places array<int>, windows array<bigint>, again array<int>"
        ),
        "line-windows",
    )
    windows = scanned.select("ord", F.explode("windows").alias("h"))
    least, most = F.min("ord").alias("first"), F.max("ord").alias("last")
    repeated = stage(windows.groupBy("h").agg(least, most).where("first < last").select("h", "first"), "repeated-windows")
    # The filter keeps most of what is not repeated out of the shuffle; the join decides.
    sent = hash_filter(repeated.select("h"))
    each = scanned.select("ord", "body", "places", "windows").mapInArrow(_repeated(sent), "ord bigint, body bigint, at int, h bigint")
    later = each.join(repeated, "h").where("ord > first").select("ord", "body", "at")
    own = scanned.where(F.size("again") > 0).select("ord", "body", F.explode("again").alias("at"))
    cuts = later.union(own).groupBy("ord", "body").agg(F.collect_set("at").alias("cuts"))
    lines = scanned.where("n_lines > 0").select("ord", "body", "n_lines").distinct().join(cuts, ["ord", "body"], "left")
    rows = boxed(docs).select("doc", F.coalesce(F.col(f"doc.{id_col}").cast("bigint"), F.lit(NO_ID)).alias("ord"), F.xxhash64("doc.text").alias("body"))
    rewritten = F.pandas_udf(_rewritten(least_words), "text string, n_removed bigint")
    cut = F.col("cuts").isNotNull()
    new = rows.join(lines, ["ord", "body"], "left").withColumn("new", rewritten(F.when(cut, F.col("doc.text")), "cuts"))
    text = F.when(cut, F.col("new.text")).otherwise(F.col("doc.text"))
    return new.select(
        *[text.alias("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns],
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce("new.n_removed", F.lit(0)).alias("n_removed"),
    )
