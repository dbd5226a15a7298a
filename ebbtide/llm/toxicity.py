"""Toxicity by a factorization machine over hashed terms.

A term is a word or the beginning of a longer word, by 64-bit hash, so that forms of one stem share terms. Terms that
occur about as often in toxic as in other labelled texts are screened out, by a likelihood ratio over distinct labelled
texts and by how much they raise the share of toxic ones (which length alone, the lot of common words, hardly does). Of the rest every document has a set; its margin is a constant, a weight for each term, and for each pair of
terms the product of their factors: a pair such as an insult and the mention of a group can count for more, or less,
than the sum of both."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import sample_cut, text_batches
from ebbtide.llm.text import ALNUM, stem_hashes, utf8
from ebbtide.session import stage

PREFIXES = (4, 5, 6, 7)  # bytes; a prefix is a term of words that are longer
_FILTER_BITS = 20


@dataclass(frozen=True)
class Training:
    """Bounds and settings of what is fitted: labelled ids (a bound on what is sent to the tasks), documents that the
    machine learns from and terms it knows (bounds on what reaches the driver), least number of texts of a term, about
    how many terms may pass the likelihood ratio by chance, least odds of toxic with a term against all, length of a
    factor, passes, step and penalties of weights and of factors."""

    labelled_ids: int = 200_000
    sample_rows: int = 100_000
    terms: int = 50_000
    least_texts: int = 3
    by_chance: float = 30.0
    odds: float = 1.5
    factors: int = 8
    epochs: int = 12
    batch: int = 256
    rate: float = 0.15
    weight_decay: float = 1e-4
    factor_decay: float = 1e-3


@dataclass(frozen=True)
class Machine:
    """Sorted hashes of the known terms, the constant, a weight and a row of factors for each term."""

    terms: np.ndarray
    constant: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, owner: np.ndarray, index: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The margin of each of ``n`` documents that hold terms ``index`` (of document ``owner``), and factor sums."""
        sums, squares = np.zeros((n, self.factors.shape[1])), np.zeros((n, self.factors.shape[1]))
        np.add.at(sums, owner, self.factors[index])
        np.add.at(squares, owner, self.factors[index] ** 2)
        linear = np.bincount(owner, self.weights[index], n) if len(owner) else np.zeros(n)
        return self.constant + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def terms_of(raw: np.ndarray) -> np.ndarray:
    """Hashes of all words and prefixes of a text, repeated ones included."""
    return stem_hashes(raw, ALNUM, PREFIXES)


def fit_machine(terms: np.ndarray, rows: list[np.ndarray], toxic: np.ndarray, training: Training) -> Machine:
    """A machine for sorted ``terms`` from the term indices of each document and its label, by adaptive gradient steps
    over mini-batches in a fixed order."""
    order = np.random.default_rng(7)
    rate = float(np.clip(toxic.mean(), 1e-4, 1 - 1e-4)) if len(toxic) else 1e-4
    model = Machine(terms, float(np.log(rate / (1 - rate))), np.zeros(len(terms)), 0.01 * order.standard_normal((len(terms), training.factors)))
    constant, slope = model.constant, 1e-8
    seen_w, seen_v = np.full(len(terms), 1e-8), np.full(model.factors.shape, 1e-8)
    for _ in range(training.epochs):
        for part in np.array_split(order.permutation(len(rows)), max(len(rows) // training.batch, 1)):
            if not len(part):
                continue
            index = np.concatenate([rows[i] for i in part])
            owner = np.repeat(np.arange(len(part)), [len(rows[i]) for i in part])
            margin, sums = Machine(terms, constant, model.weights, model.factors).margins(owner, index, len(part))
            error = (probability(margin) - toxic[part]) / len(part)
            slope += error.sum() ** 2
            constant -= training.rate * error.sum() / np.sqrt(slope)
            touched, place = np.unique(index, return_inverse=True)
            step = np.bincount(place, error[owner], len(touched)) + training.weight_decay * model.weights[touched] / len(part)
            seen_w[touched] += step * step
            model.weights[touched] -= training.rate * step / np.sqrt(seen_w[touched])
            pull = np.zeros((len(touched), training.factors))
            np.add.at(pull, place, error[owner, None] * (sums[owner] - model.factors[index]))
            pull += training.factor_decay * model.factors[touched] / len(part)
            seen_v[touched] += pull * pull
            model.factors[touched] -= training.rate * pull / np.sqrt(seen_v[touched])
    return Machine(terms, constant, model.weights, model.factors)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) to (term, n, toxic): in how many texts of the batch a term occurs, and in how many toxic ones."""
    for batch in batches:
        found, marks = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for toxic, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            terms = np.unique(terms_of(raw))
            found.append(terms)
            marks.append(np.full(len(terms), toxic))
        terms, place, n = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        toxic = np.bincount(place, np.concatenate(marks), len(terms)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n), pa.array(toxic)], names=["term", "n", "toxic"])


class Known:
    """Finds the known terms of a text; a table of bits spares most others the search."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[(terms >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def of(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(0, np.int64)
        own = terms_of(raw)
        own = np.unique(own[self.bits[(own >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]])
        at = np.minimum(np.searchsorted(self.terms, own), len(self.terms) - 1)
        return at[self.terms[at] == own]


def _indexed(sent):
    """(toxic, text) to (toxic, index): the known terms of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(sent.value)
        for batch in batches:
            rows = [known.of(raw) for raw in utf8(batch.column(1))]
            ends = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
            index = pa.array(np.concatenate(rows) if rows else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, index)], names=["toxic", "index"])

    return run


def _scored(sent):
    """(id, text) to (id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        known, empty = Known(model.terms), np.zeros(0, np.uint8)
        for batch in batches:
            rows = [known.of(empty if raw is None else raw) for raw in utf8(batch.column(1))]
            owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            margin, _ = model.margins(owner, np.concatenate([np.zeros(0, np.int64), *rows]), len(rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(probability(margin))], names=[batch.schema.names[0], "score"])

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", training: Training = Training()) -> Machine:
    """The machine learnt from the documents that ``labels`` (id, toxic) names. See :func:`toxicity`."""
    spark = docs.sparkSession
    text_batches(spark)
    # An id labelled twice is toxic if any of its labels says so.
    marked = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).groupBy(id_col).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    drawn = F.xxhash64(id_col)
    known = marked.where(drawn <= sample_cut(marked, drawn, training.labelled_ids))
    # The number of ids is bounded by a parameter, so they go to every task and no text is shuffled to meet its label.
    rows = docs.where("text IS NOT NULL").select(id_col, "text").join(F.broadcast(known), id_col).select("toxic", "text")
    # Copies count once, toxic if any is, and a bounded number of distinct texts teaches.
    digest = F.xxhash64("text")
    drawn_rows = rows.where(digest <= sample_cut(rows, digest, training.sample_rows))
    taught = stage(drawn_rows.groupBy(digest.alias("digest")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")).select("toxic", "text"), "taught-texts")
    counts = taught.mapInArrow(_counted, "term bigint, n bigint, toxic bigint").groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    total = taught.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = total["n"], total["toxic"] or 0
    empty = np.zeros(0, np.uint64)
    if not 0 < toxic < n:  # nothing to tell apart: every text gets the smoothed share
        share = (toxic + 0.5) / (n + 1)
        return Machine(empty, float(np.log(share / (1 - share))) if n else -35.0, np.zeros(0), np.zeros((0, training.factors)))
    base, share = toxic / n, F.col("toxic") / F.col("n")
    clean = F.when(F.col("toxic") < F.col("n"), (F.col("n") - F.col("toxic")) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    ratio = F.when(F.col("toxic") > 0, F.col("toxic") * F.log(share / base)).otherwise(0.0) + clean
    odds = (F.col("toxic") + base) * (1 - base) / ((F.col("n") - F.col("toxic") + 1 - base) * base)
    rated = stage(counts.where(F.col("n") >= training.least_texts).select("term", ratio.alias("ratio"), odds.alias("odds")), "rated-terms")
    # A ratio of r nats comes by chance about once in exp(r) terms.
    least = float(np.log(max(rated.count() / training.by_chance, 20.0)))
    chosen = (
        rated.where((F.col("ratio") >= least) & (F.col("odds") >= training.odds))
        .orderBy(F.desc("ratio"), "term")
        .limit(training.terms)
        .toArrow()
    )
    terms = np.sort(chosen["term"].to_numpy().astype(np.int64).view(np.uint64))
    found = taught.mapInArrow(_indexed(spark.sparkContext.broadcast(terms)), "toxic int, index array<bigint>")
    table = found.toArrow()  # bounded by sample_rows
    ends = table["index"].combine_chunks().offsets.to_numpy() if table.num_rows else np.zeros(1, np.int64)
    values, marks = table["index"].combine_chunks().flatten().to_numpy(), table["toxic"].to_numpy()
    rows = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
    order = np.array(sorted(range(len(rows)), key=lambda i: (rows[i].tolist(), marks[i])), np.int64)
    return fit_machine(terms, [rows[i] for i in order], marks[order].astype(float), training)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", training: Training = Training()) -> DataFrame:
    """(id, score, predicted) for each document: the probability of label 1 by a factorization machine learnt from
    ``labels`` (id, toxic), and whether it is at least one half.

    Only the text decides. Null and empty texts have no terms and get the constant's probability. Labels of unknown
    ids, null ids and null labels are ignored; an id labelled twice is toxic if any label says so. Texts that repeat
    teach once. At most ``training.labelled_ids`` ids and ``training.sample_rows`` distinct texts teach, drawn by
    digest at any size of the input. Without labels, or with one class only, every score is the share of toxic texts.
    Rows are judged one by one: repeated ids, repeated rows and null ids do no harm. Other columns are ignored. An
    empty table gives an empty result."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, training))
    judged = docs.select(id_col, "text").mapInArrow(_scored(sent), f"`{id_col}` {dict(docs.dtypes)[id_col]}, score double")
    return judged.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
