"""Periodic runs of words by recompression.

A run is a stretch of at least ``MIN_COPIES`` copies of its smallest period (and of ``MIN_LENGTH`` words) that cannot be
extended. Every run of period p covers some four multiples of p, all of which hold the same word: these places of the
harmonic grid, n/p of them for each p, are the candidates. How far a candidate's period reaches to either side is the
longest common extension of two places p apart. It is answered exactly on a run-length grammar of the text, which
recompression builds: blocks of equal symbols become one symbol, then neighbours of which the first falls into one half
of the alphabet and the second into the other become one, in turns, until nothing can be joined. Equal stretches are
parsed alike but for a few symbols at their ends, so an extension climbs and descends the levels once.

The texts of an Arrow batch are one sequence with a symbol of its own between any two, so each step is a few NumPy
operations for all of them. Texts without candidates need no grammar."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import text_batches
from ebbtide.llm.text import SPACED, mix, utf8, word_hashes

MIN_COPIES, MIN_LENGTH = 4, 6  # fixed values: the definition of a run
BLOCK_WORDS = 1 << 18  # words of short texts that are worked on together; a longer text is worked on alone
GRID = 1 << 20  # places of the grid that are looked at together

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_ODD = np.uint64(0xD1342543DE82EF95)


class Level:
    """A sequence of symbols, how many times each repeats the symbol below it, and which symbols of the level below
    (their first and last places) each stands for."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray | None, last: np.ndarray | None, spans: np.ndarray):
        self.symbols, self.first, self.last, self.spans = symbols, first, last, spans
        self.parent: np.ndarray | None = None


def _joined(below: Level, starts: np.ndarray, symbols: np.ndarray) -> Level:
    """The level whose symbols begin at ``starts`` of the level below."""
    ends = np.append(starts[1:], len(below.symbols))
    below.parent = np.repeat(np.arange(len(starts)), ends - starts)
    return Level(symbols, starts, ends - 1, np.add.reduceat(below.spans, starts))


def _blocks(below: Level) -> Level:
    """Each maximal block of equal symbols becomes one symbol."""
    symbols = below.symbols
    starts = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    counts = np.diff(np.append(starts, len(symbols))).astype(np.uint64)
    found = symbols[starts]
    return _joined(below, starts, np.where(counts > 1, mix(found * _ODD + counts), found))


def _pairs(below: Level, turn: int) -> Level:
    """Neighbours of which the first is in one half of the alphabet and the second in the other become one symbol."""
    symbols = below.symbols
    half = mix(symbols ^ np.uint64(turn * 2 + 1)) & np.uint64(1) == 1
    opens = half[:-1] & ~half[1:]
    swapped = ~half[:-1] & half[1:]
    if swapped.sum() > opens.sum():  # the order of the halves that joins more
        opens = swapped
    second = np.concatenate([[False], opens])
    starts = np.flatnonzero(~second)
    found = symbols[starts]
    paired = np.append(opens, False)[starts]
    after = symbols[np.minimum(starts + 1, len(symbols) - 1)]
    return _joined(below, starts, np.where(paired, mix(mix(found) * _ODD + after), found))


def grammar(symbols: np.ndarray, texts: int) -> list[Level]:
    """The levels of recompression of a sequence that holds ``texts`` texts between unique symbols, lowest first."""
    levels = [Level(symbols, None, None, np.ones(len(symbols), np.int64))]
    turn = 0
    while len(levels[-1].symbols) > 3 * texts + 2 and turn < 64:
        levels.append(_blocks(levels[-1]))
        levels.append(_pairs(levels[-1], turn))
        turn += 1
    return levels


def extensions(levels: list[Level], i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """How many equal symbols of the lowest level follow from places ``i`` and ``j`` on, ``i`` and ``j`` included;
    forwards with ``step`` 1, backwards with -1. The sequence's first and last symbols equal no other.

    Both places stand at an edge of a symbol of their level. Equal symbols are climbed over as long as both begin a
    symbol of the next level, else passed; from the first difference on the query only descends. In a block of equal
    symbols as many are passed as both sides have left."""
    total = np.zeros(len(i), np.int64)
    level, a, b = np.zeros(len(i), np.int64), i.astype(np.int64).copy(), j.astype(np.int64).copy()
    falling = np.zeros(len(i), bool)
    active = np.arange(len(i))
    while len(active):
        alive = np.ones(len(active), bool)
        at = level[active]
        for t in np.unique(at):
            pick = np.flatnonzero(at == t)
            rows = active[pick]
            here, x, y = levels[t], a[rows], b[rows]
            same = here.symbols[x] == here.symbols[y]
            lower = rows[~same]
            if t == 0:
                alive[pick[~same]] = False
            elif len(lower):
                edge = here.first if step > 0 else here.last
                a[lower], b[lower], level[lower], falling[lower] = edge[a[lower]], edge[b[lower]], t - 1, True
            rows, x, y = rows[same], x[same], y[same]
            if not len(rows):
                continue
            climb = np.zeros(len(rows), bool)
            left = np.ones(len(rows), np.int64)
            if here.parent is not None:
                above = levels[t + 1]
                px, py = here.parent[x], here.parent[y]
                edge, far = (above.first, above.last) if step > 0 else (above.last, above.first)
                climb = (edge[px] == x) & (edge[py] == y) & ~falling[rows]
                if t % 2 == 0:  # the level above joins blocks
                    left = np.minimum(np.abs(far[px] - x), np.abs(far[py] - y)) + 1
            up, over = rows[climb], ~climb
            if len(up):
                a[up], b[up], level[up] = px[climb], py[climb], t + 1
            rows, left = rows[over], left[over]
            total[rows] += here.spans[x[over]] * left
            a[rows] += step * left
            b[rows] += step * left
        active = active[alive]
    return total


def _candidates(symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i and periods p of the grid with the same word at i, i+p, i+2p, ... as often as a run has copies."""
    longest = sizes // MIN_COPIES
    text = np.repeat(np.arange(len(sizes)), longest)
    period = np.arange(longest.sum()) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    count = (sizes[text] - 1) // period - MIN_COPIES + 2
    bounds = np.cumsum(count)
    at = 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(bounds, (bounds[at - 1] if at else 0) + GRID, "right")))
        n, p = count[at:end], period[at:end]
        p, first = np.repeat(p, n), np.repeat(begins[text[at:end]], n)
        i = first + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * p
        for copy in range(1, MIN_COPIES):
            keep = symbols[i] == symbols[i + copy * p]
            i, p = i[keep], p[keep]
        if len(i):
            yield i, p
        at = end


def runs_of(words: list[np.ndarray]) -> list[np.ndarray]:
    """For each text, given as hashes of its words, the rows (start, length, period) of its runs by start and period."""
    sizes = np.array([len(w) for w in words], np.int64)
    none = np.zeros((0, 3), np.int64)
    if not len(words) or sizes.max() < MIN_LENGTH:
        return [none] * len(words)
    begins = np.cumsum(sizes + 1) - sizes
    symbols = np.empty(int(sizes.sum()) + len(words) + 1, np.uint64)
    fences = np.append(begins - 1, len(symbols) - 1)
    inside = np.ones(len(symbols), bool)
    inside[fences] = False
    symbols[inside] = np.concatenate(words)
    symbols[fences] = mix(np.arange(len(fences), dtype=np.uint64) ^ np.uint64(0x5DEECE66D1CE4E5B))
    grid = [*_candidates(symbols, begins, sizes)]
    if not grid:
        return [none] * len(words)
    i, p = (np.concatenate(x) for x in zip(*grid))
    owners = np.searchsorted(begins, i, "right") - 1
    # Only texts with a candidate go into the grammar.
    used, owner = np.unique(owners, return_inverse=True)
    cuts = [symbols[begins[u] - 1 : begins[u] + sizes[u]] for u in used]
    moved = np.cumsum([0, *map(len, cuts[:-1])])
    sequence = np.concatenate([*cuts, symbols[fences[-1:]]])
    i = i - begins[used][owner] + 1 + moved[owner]
    levels = grammar(sequence, len(used))
    after = extensions(levels, i, i + p, 1)
    before = extensions(levels, i - 1, i + p - 1, -1)
    start, length = i - before, before + p + after
    enough = length >= np.maximum(MIN_LENGTH, MIN_COPIES * p)
    rows = np.stack([owner[enough], (start - moved[owner] - 1)[enough], length[enough], p[enough]], axis=1)
    rows = rows[np.lexsort(rows.T[::-1])]
    # A stretch has multiples of its smallest period as periods too; it is one run, of the smallest.
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[new]
    found = [none] * len(words)
    for k, part in zip(used, np.split(rows, np.searchsorted(rows[:, 0], np.arange(1, len(used))))):
        found[k] = part[np.lexsort((part[:, 3], part[:, 1])), 1:]
    return found


def _collapsed(text: bytes | None, runs: np.ndarray) -> bytes:
    """The words outside of runs and the first period of each, joined by one space."""
    words = text.split() if text is not None else []
    if len(runs):
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
    return b" ".join(words)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, runs, collapsed)."""

    def told(ids: pa.Array, raws: list, words: list[np.ndarray]) -> pa.RecordBatch:
        runs = runs_of(words)
        ends = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
        columns = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
        rows = pa.StructArray.from_arrays([pa.array(columns[:, k]) for k in range(3)], names=["start", "length", "period"])
        texts = [_collapsed(None if raw is None else raw.tobytes(), r).decode() for raw, r in zip(raws, runs)]
        return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(ends, rows), pa.array(texts, pa.string())], names=[name, "runs", "collapsed"])

    for batch in batches:
        name, raws, words, held, at = batch.schema.names[0], [], [], 0, 0
        for row, raw in enumerate(utf8(batch.column(1))):
            found = word_hashes(raw, SPACED, exact_case=True) if raw is not None else np.zeros(0, np.uint64)
            if raws and held + len(found) > BLOCK_WORDS:
                yield told(batch.column(0).slice(at, row - at), raws, words)
                raws, words, held, at = [], [], 0, row
            raws.append(raw)
            words.append(found)
            held += len(found)
        yield told(batch.column(0).slice(at), raws, words)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, runs, collapsed) for each document: its periodic runs of words, by start and period, and its words without
    the copies after the first period of each run, joined by one space.

    Words are runs of anything but ASCII white space, in their own case, counted from 0. A run is a stretch of words
    with smallest period ``period`` (words that far apart are equal) of at least MIN_COPIES periods and MIN_LENGTH
    words that no neighbouring word extends. Runs may overlap; a word is left out if any run holds it after that run's
    first period. Null and empty texts, and texts of white space, have no runs and an empty collapsed text. Rows are
    judged one by one, so repeated ids, repeated rows and null ids do no harm. Other columns are ignored. An empty
    table gives an empty result."""
    text_batches(docs.sparkSession)
    return docs.select(id_col, "text").mapInArrow(_scan, f"`{id_col}` {dict(docs.dtypes)[id_col]}, runs {RUNS}, collapsed string")


def with_planted_tails(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` (id, text) in which each tenth text, by the CRC-32 of its id, repeats a stretch of its words to its end.

    Of n words, word i >= a becomes word a + (i - a) % p, with a = g % n, p = 1 + (n - a) / (3 + g % 8) and g the tenth
    of the CRC-32. Texts without words and rows without an id stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(h / 10)

    def repeated(s):
        n = F.size(s["w"])
        a = (s["g"] % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (3 + s["g"] % 8))).cast("int")
        tail = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(s["w"], F.when(i < a, i).otherwise(a + (i - a) % p)))
        return F.when(n > 0, F.array_join(tail, " ")).otherwise(s["t"])

    # As an array of one, so that words are split once and not for every word.
    one = F.transform(F.array(F.struct(words.alias("w"), g.alias("g"), F.col("text").alias("t"))), repeated)
    return docs.select(id_col, F.when(chosen & F.col("text").isNotNull(), F.get(one, F.lit(0))).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document of :func:`periodic_runs`: number of runs, the longest one (of equal ones the first, then
    that of the smallest period) with its exponent in thousandths, and SHA-256 digests of all runs and of the words kept."""
    best = F.get(F.array_sort("runs", lambda x, y: F.when(x["length"] != y["length"], F.when(x["length"] > y["length"], -1).otherwise(1)).when(
        x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)).when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        id_col,
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
