"""Quality classifier from weak labels.

Overlapping heuristic labellers each vote reject, keep or abstain on a document. Expectation-maximisation over the
counts of vote patterns of the whole corpus estimates how each labeller votes on good and on bad documents; the
posterior of a document's pattern is its label. On a bounded sample of documents the posteriors train a linear scorer
over hashed features (words, word shapes, votes), and the scorer decides on every document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import sample_cut, text_batches
from ebbtide.llm.text import ALNUM, SPACED, _spans, gram_hashes, mix, utf8, word_hashes
from ebbtide.session import stage

KEEP, REJECT, ABSTAIN = "0", "1", "-"
LABELLERS = (
    "symbols", "symbol_words", "shouting", "exclamations", "stutter", "word_pairs", "top_word", "sentences", "separators", "word_length",
    "abuse", "abuse_share",
)
DIMENSIONS = 1 << 18
# Classes of bytes: 0 white, 1 lower, 2 upper, 3 digit, 4 sentence mark, 5 other ASCII, 6 beyond ASCII.
_KIND = np.full(256, 5, np.uint8)
_KIND[0x80:] = 6
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[0x61:0x7B], _KIND[0x41:0x5B], _KIND[0x30:0x3A] = 1, 2, 3
_KIND[list(b".,;:?'\"()-")] = 4


@dataclass(frozen=True)
class Training:
    """Bounds and settings of what is fitted: labelled rows for the word list of abuse, documents for the scorer.

    ``abuse_share`` is the least share of toxic documents of a listed word, one more document at the base rate counted."""

    labelled_rows: int = 50_000
    sample_rows: int = 10_000
    abuse_share: float = 0.8
    epochs: int = 6
    rate: float = 0.3
    decay: float = 1e-5


class Measured:
    """What the labellers and the features read off one text."""

    def __init__(self, raw: np.ndarray, abuse: np.ndarray):
        kinds = _KIND[raw]
        self.bytes = np.bincount(kinds, minlength=7)
        starts, ends = _spans(raw, SPACED)
        self.words, n = len(starts), len(starts)
        self.hashes = word_hashes(raw, SPACED)
        self.plain = word_hashes(raw, ALNUM)
        self.shouts = int((raw == 0x21).sum())
        symbol = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(kinds == 5, out=symbol[1:])
        self.symbols = symbol[ends] - symbol[starts]
        self.lengths = ends - starts
        last = kinds[ends - 1] if n else kinds[:0]
        self.marks = int(np.isin(raw[ends - 1], list(b".!?")).sum()) if n else 0
        self.stutters = int((self.hashes[1:] == self.hashes[:-1]).sum())
        pairs = gram_hashes(self.hashes, 2)
        self.pairs = 1 - len(np.unique(pairs)) / max(len(pairs), 1)
        self.abuse = int(np.isin(self.plain, abuse).sum()) if len(abuse) else None
        first = kinds[starts] if n else kinds[:0]
        middle = kinds[(starts + ends) // 2] if n else kinds[:0]
        size = np.minimum(self.lengths, 15)
        self.shapes = ((first.astype(np.int64) * 7 + middle) * 7 + last) * 64 + size * 4 + np.minimum(self.symbols, 3)

    def votes(self) -> str:
        n = self.words
        if n == 0:
            return ABSTAIN * len(LABELLERS)
        letters = max(int(self.bytes[1] + self.bytes[2]), 1)
        inked = max(int(self.bytes[1:].sum()), 1)
        _, counts = np.unique(self.hashes, return_counts=True)
        enough = n >= 20

        def vote(value: float, reject: float, keep: float, known: bool = True) -> str:
            return ABSTAIN if not known else REJECT if value >= reject else KEEP if value <= keep else ABSTAIN

        rare_marks = ABSTAIN if not enough else REJECT if self.marks < n / 80 else KEEP if self.marks >= n / 30 else ABSTAIN
        mean = float(self.lengths.mean())
        return "".join(
            [
                vote(self.bytes[5] / inked, 0.12, 0.04),
                vote((self.symbols > 0).mean(), 0.4, 0.15),
                vote(self.bytes[2] / letters, 0.5, 0.15, letters >= 20),
                vote(self.shouts / n, 0.3, 0.05),
                vote(self.stutters / n, 0.2, 0.04, enough),
                vote(self.pairs, 0.5, 0.3, enough),
                vote(counts.max() / n, 0.25, 0.1, enough),
                rare_marks,
                vote(((self.symbols == self.lengths) & (self.lengths <= 3)).mean(), 0.15, 0.03, enough),
                REJECT if mean > 14 or mean < 2 else KEEP if 3 <= mean <= 9 else ABSTAIN,
                ABSTAIN if self.abuse is None else REJECT if self.abuse else KEEP,
                ABSTAIN if self.abuse is None else vote(self.abuse / n, 1 / 400, 0),
            ]
        )

    def features(self, votes: str) -> tuple[np.ndarray, np.ndarray]:
        """Hashed indices and values: distinct words, shares of word shapes, votes and a constant."""
        words = np.unique(self.plain) % np.uint64(DIMENSIONS)
        shapes, counts = np.unique(self.shapes, return_counts=True)
        tokens = np.array([1 + 4 * j + "01-".index(v) for j, v in enumerate(votes)] + [0], np.uint64)
        index = [words, mix(shapes.astype(np.uint64) ^ np.uint64(0xA5A5)) % np.uint64(DIMENSIONS), mix(tokens ^ np.uint64(0xC3C3C3)) % np.uint64(DIMENSIONS)]
        value = [np.full(len(words), 1 / max(len(words), 1) ** 0.5), 2 * counts / max(self.words, 1), np.ones(len(tokens))]
        return np.concatenate(index).astype(np.int64), np.concatenate(value)


def label_model(patterns: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], np.ndarray]:
    """Posterior probability of bad for each vote pattern, and P(vote | class) as [class, labeller, vote], by EM.

    Votes are independent given the class, and an abstention says nothing. It starts from the number of rejections,
    so bad is the class that is rejected more; a prior of a hundredth of the votes holds labellers better than chance."""
    names = sorted(patterns)
    if not names:
        return {}, np.zeros((2, len(LABELLERS), 2))
    votes = np.array([["01-".index(v) for v in name] for name in names])
    weight = np.array([patterns[name] for name in names], float)
    rejects = (votes == 1).sum(axis=1)
    bad = 1 - 0.5 ** (2 * rejects) + 0.02
    bad = np.clip(bad, 0.02, 0.98)
    one_hot = np.stack([votes == v for v in range(2)], axis=2).astype(float)
    table = np.zeros((2, votes.shape[1], 2))
    prior_votes = weight.sum() * np.array([[0.01, 1e-4], [1e-4, 0.01]]) + 0.1
    for _ in range(rounds):
        for c, p in enumerate((1 - bad, bad)):
            table[c] = np.einsum("p,pjv->jv", weight * p, one_hot) + prior_votes[c]
            table[c] /= table[c].sum(axis=1, keepdims=True)
        prior = np.clip((weight * bad).sum() / weight.sum(), 0.01, 0.99)
        logs = np.einsum("pjv,cjv->pc", one_hot, np.log(table)) + np.log([1 - prior, prior])
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
        done, bad = np.abs(new - bad).max() < 1e-6, new
        if done:
            break
    return dict(zip(names, bad.tolist())), table


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], training: Training) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by adaptive gradient steps over mini-batches in a fixed order."""
    weights, squares = np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-8)
    order = np.random.default_rng(7)
    for _ in range(training.epochs):
        for part in np.array_split(order.permutation(len(rows)), max(len(rows) // 64, 1)):
            if not len(part):
                continue
            owner = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            index = np.concatenate([rows[i][0] for i in part])
            value = np.concatenate([rows[i][1] for i in part])
            margin = np.bincount(owner, weights[index] * value, len(part))
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - np.array([rows[i][2] for i in part])
            touched, place = np.unique(index, return_inverse=True)
            step = np.bincount(place, error[owner] * value) / len(part) + training.decay * weights[touched]
            squares[touched] += step * step
            weights[touched] -= training.rate * step / np.sqrt(squares[touched])
    return weights


def _scan(abuse: np.ndarray, weights, want: str):
    empty = np.zeros(0, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value if weights is not None else None
        for batch in batches:
            votes, index, value, scores = [], [], [], []
            for raw in utf8(batch.column(1)):
                measured = Measured(raw if raw is not None else empty, abuse)
                votes.append(measured.votes())
                if want != "votes":
                    at, x = measured.features(votes[-1])
                    if want == "score":
                        scores.append(1 / (1 + float(np.exp(np.clip(-(own[at] * x).sum(), -30, 30)))) if measured.words else 1.0)
                    else:
                        index.append(at)
                        value.append(x)
            out = [batch.column(0), pa.array(votes, pa.string())]
            if want == "score":
                out.append(pa.array(scores, pa.float64()))
            if want == "features":
                ends = pa.array(np.cumsum([0, *map(len, index)]), pa.int32())
                out += [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x) if x else [], kind)) for x, kind in ((index, pa.int64()), (value, pa.float64()))]
            names = {"votes": [], "score": ["p_bad"], "features": ["index", "value"]}[want]
            yield pa.RecordBatch.from_arrays(out, names=[batch.schema.names[0], "votes", *names])

    return run


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, owner = [np.zeros(0, np.uint64)], []
        for i, raw in enumerate(utf8(batch.column(1))):
            found = np.unique(word_hashes(raw, ALNUM)) if raw is not None else words[0]
            words.append(found)
            owner.append(np.full(len(found), i))
        taken = pa.array(np.concatenate(owner) if owner else [], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), pa.array(np.concatenate(words).view(np.int64))], names=["toxic", "word"])


def abuse_words(docs: DataFrame, labels: DataFrame, id_col: str, training: Training) -> np.ndarray:
    """Hashes of words that occur mostly in documents labelled toxic, from a bounded sample of labelled rows.

    A wrong label may fall on any word, so the share is one that a single label does not decide at small counts. And
    the counts must be so far from the base rate (their likelihood ratio at least the number of words) that less than
    one word is expected on the list by chance."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    drawn = F.xxhash64(id_col)
    known = marked.where(drawn <= sample_cut(marked, drawn, training.labelled_rows))
    # At most labelled_rows distinct ids, so they can go to every task, and no text is shuffled.
    rows = docs.select(id_col, "text").join(F.broadcast(known), id_col).select("toxic", "text")
    words = rows.mapInArrow(_distinct_words, f"toxic {dict(labels.dtypes)['toxic']}, word bigint")
    counted = stage(words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")), "labelled-words")
    base, total = known.agg(F.avg("toxic")).first()[0] or 0.0, counted.count()
    if not 0 < base < 1 or not total:
        return np.zeros(0, np.uint64)
    share = F.col("toxic") / F.col("n")
    clean = F.when(share < 1, (F.col("n") - F.col("toxic")) * F.log((1 - share) / (1 - base))).otherwise(0)
    found = (
        counted.where("toxic > 0")
        .where((F.col("toxic") + base) / (F.col("n") + 1) >= training.abuse_share)
        .where(F.col("toxic") * F.log(share / base) + clean >= float(np.log(total)))
        .select("word")
        .toArrow()
    )
    return np.sort(found["word"].to_numpy().astype(np.int64).view(np.uint64))


@dataclass
class Fitted:
    """What :func:`fit` learnt: hashes of abusive words, posteriors by vote pattern, and the scorer's weights, sent out."""

    abuse: np.ndarray
    posterior: dict[str, float]
    weights: object


def fit(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", training: Training = Training()) -> Fitted:
    """The label model over the votes on all documents, and the scorer on a bounded sample. See :func:`scored`."""
    spark = docs.sparkSession
    text_batches(spark)
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(id_col, "text")
    abuse = abuse_words(docs, labels, id_col, training) if labels is not None else np.zeros(0, np.uint64)
    patterns = texts.mapInArrow(_scan(abuse, None, "votes"), f"`{id_col}` {kind}, votes string").groupBy("votes").count()
    # At most 3 ** len(LABELLERS) patterns, whatever the number of documents; in practice some dozens.
    counts = {r["votes"]: r["count"] for r in patterns.collect()}
    posterior, _ = label_model({p: n for p, n in counts.items() if p != ABSTAIN * len(LABELLERS)})
    # Texts that repeat teach once, so their number is bounded however often one repeats and whatever the ids are.
    digest = F.xxhash64("text")
    sample = texts.where(digest <= sample_cut(texts, digest, training.sample_rows)).withColumn("digest", digest).dropDuplicates(["digest"]).drop("digest")
    features = sample.mapInArrow(_scan(abuse, None, "features"), f"`{id_col}` {kind}, votes string, index array<bigint>, value array<double>")
    taught = [
        (np.array(r["index"]), np.array(r["value"]), posterior[r["votes"]])
        for r in features.select("votes", "index", "value").toLocalIterator()
        if r["votes"] in posterior
    ]
    if posterior and not taught:
        raise ValueError("no document of the sample has a vote, so there is nothing to learn a scorer from")
    return Fitted(abuse, posterior, spark.sparkContext.broadcast(fit_scorer(taught, training)))


def scored(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", training: Training = Training()) -> DataFrame:
    """(id, votes, p_weak, p_bad, kept) for each document: the labellers' votes in the order of LABELLERS, the
    posterior of bad by the label model, the scorer's probability of bad, and whether that is below one half.

    The scorer learns from at most ``training.sample_rows`` distinct texts and the word list from at most
    ``training.labelled_rows`` labelled ids, drawn by digest at any size of the input; an id labelled twice has its
    largest label. Null texts and texts without words get no votes and are rejected (p_bad 1). ``labels`` (id, toxic) only teach the
    word list of two labellers; without it, or where it is empty, these abstain. Rows are judged one by one: repeated
    ids, repeated rows and null ids do no harm. Other columns are ignored. An empty table gives an empty result."""
    found = fit(docs, labels, id_col, training)
    kind = dict(docs.dtypes)[id_col]
    judged = docs.select(id_col, "text").mapInArrow(_scan(found.abuse, found.weights, "score"), f"`{id_col}` {kind}, votes string, p_bad double")
    known = docs.sparkSession.createDataFrame([*found.posterior.items()], "votes string, p_weak double")
    return judged.join(F.broadcast(known), "votes", "left").select(
        id_col, "votes", F.coalesce("p_weak", F.lit(1.0)).alias("p_weak"), "p_bad", (F.col("p_bad") < 0.5).alias("kept")
    )


def _kept(text_at: int, abuse: np.ndarray, weights):
    judge = _scan(abuse, weights, "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([batch.column(text_at)] * 2, names=["id", "text"])
            (scores,) = judge(iter([pair]))
            yield batch.filter(pa.compute.less(scores.column(2), 0.5))

    return run


def kept_documents(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", training: Training = Training()) -> DataFrame:
    """The rows of ``docs`` that :func:`scored` keeps, with all their columns."""
    found = fit(docs, labels, id_col, training)
    return docs.mapInArrow(_kept(docs.columns.index("text"), found.abuse, found.weights), docs.schema)
