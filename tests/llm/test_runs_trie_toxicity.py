"""Periodic runs, the trie of conversations and the factorization machine against plain versions."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
from conftest import docs_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.llm import common, periodic_runs, prefix_trie, toxicity
from ebbtide.llm.queries import QUERIES
from ebbtide.llm.text import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    found, n = [], len(words)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i - start + p >= max(6, 4 * p):
                found.append((start, i - start + p, p))
            i += 1
    smallest = {}
    for start, length, p in found:
        smallest.setdefault((start, length), p)
    return sorted(((s, n, p) for (s, n), p in smallest.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words: list[str]) -> list[str]:
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.lists(st.integers(0, 2), max_size=60), st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)).map(lambda x: x[0] * x[1])), max_size=5))
def test_runs_are_those_of_all_periods(texts):
    found = periodic_runs.runs_of([mix(np.array(t, np.uint64) + np.uint64(5)) for t in texts])
    assert [[tuple(r) for r in rows.tolist()] for rows in found] == [plain_runs(t) for t in texts]


def test_a_grammar_spells_its_text():
    """Equal places of every level stand for equal stretches, and the levels shrink to a few symbols."""
    symbols = mix(np.array([0, *(random.Random(3).choices(range(1, 4), k=3000)), 9], np.uint64))
    levels = periodic_runs.grammar(symbols, 1)
    assert len(levels[-1].symbols) <= 5 and all(level.spans.sum() == len(symbols) for level in levels)
    for level in levels[1:]:
        begins = np.cumsum(level.spans) - level.spans
        spelled = collections.defaultdict(set)
        for symbol, start, size in zip(level.symbols.tolist(), begins, level.spans):
            spelled[symbol].add(symbols[start : start + size].tobytes())
        assert all(len(texts) == 1 for texts in spelled.values())


def test_runs_of_odd_documents(spark, odd, none):
    rows = periodic_runs.periodic_runs(odd).collect()
    assert len(rows) == len(docs_rows())
    for r in rows:
        assert r["runs"] == [] or r["doc_id"] == 0
    assert {r["collapsed"] for r in rows if r["doc_id"] in (5, 6, 7)} == {""}
    assert periodic_runs.periodic_runs(none).collect() == []
    texts = {1: "a b " * 40 + "c", 2: "x " + "A a " * 9, 3: "é\té\né é é é", 4: "w " * 30_000 + "v", 5: "a b c d e f a b c d e f"}
    df = spark.createDataFrame([(i, t) for i, t in [*texts.items(), (1, texts[1]), (None, texts[2])]], "doc_id int, text string")
    for r in periodic_runs.periodic_runs(df).collect():
        words = WORD.findall(texts[r["doc_id"] or 2])
        runs = [(0, 30_000, 1)] if r["doc_id"] == 4 else plain_runs(words)
        assert [tuple(x) for x in r["runs"]] == runs and r["collapsed"] == plain_collapsed(words, runs)


def test_the_run_query_against_a_plain_one(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op11_recompression_runs"](spark, small).collect()}
    assert len(got) == len(docs)
    with_runs = 0
    for doc_id, text in docs:
        words = planted(doc_id, WORD.findall(text or ""))
        runs = plain_runs(words) if len(words) < 3000 else None
        r = got[doc_id]
        if runs is None:
            continue
        with_runs += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
    assert with_runs > 5


def plain_trie(rows, shared: bool) -> set[tuple]:
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if shared else 0
        full[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    members, children = collections.defaultdict(list), collections.defaultdict(list)
    for c, v in full.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, set()
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = sum(saved[c] for c in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(full[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.add((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


CONVERSATIONS = "conv_id bigint, turn int, role string, text string, depth string, owner int"


def found_trie(df, component: int, shared: bool) -> list[tuple]:
    turns, convs = prefix_trie.ordered_turns(df), prefix_trie.distinct_conversations(df)
    if shared:
        turns, convs = prefix_trie.with_shared_starts(turns, convs)
    return [tuple(r) for r in prefix_trie.conversation_trie(turns, convs, component).collect()]


def test_the_trie_is_that_of_all_prefixes(spark):
    pick = random.Random(5)
    rows = [(100 * (c // 9) + c, t, pick.choice("ua"), pick.choice(["x", "yé", "", None])) for c in range(60) for t in range(pick.randrange(6))]
    rows += [(7, t, "user", f"long {t // 2}") for t in range(150)]  # deep, and every number twice in some order
    rows += [(8, t, "user", f"long {t // 2}") for t in range(120)]
    rows += [(-105, 0, "u", "x"), (-105, None, None, None), (-100, 3, "u", "x"), (3, 1, "a", "x"), (3, 1, "a", "x"), (None, 1, "u", "x"), (None, 1, "u", "x")]
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], CONVERSATIONS)
    for component, shared in ((prefix_trie.COMPONENT, False), (4, True)):
        got = found_trie(df, component, shared)
        assert len(got) == len(set(got)) and set(got) == plain_trie(rows, shared)


def test_chunks_of_long_conversations_and_lists(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    rows = [(c, t, "u", str(t)) for c in range(30) for t in range(11)] + [(40 + c, t, "u", str(t % 3)) for c in range(3) for t in range(20 + c)]
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], CONVERSATIONS)
    assert set(found_trie(df, 6, False)) == plain_trie(rows, False)


def test_no_conversation_no_node(spark):
    assert found_trie(spark.createDataFrame([], CONVERSATIONS), 10, True) == []
    assert found_trie(spark.createDataFrame([(None, 1, "u", "x", "d", 1)], CONVERSATIONS), 10, False) == []


def test_the_trie_query_against_a_plain_one(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in QUERIES["op12_centroid_trie"](spark, small).collect()} == plain_trie(rows, True)


LABELS = "doc_id bigint, toxic int, text string, score string, digest int"


def test_pairs_count_beyond_their_terms(spark):
    """Toxic only where an insult meets a group: each word alone is as common in clean texts."""
    pick, rows, labels = random.Random(2), [], []
    for i in range(1600):
        insult, group = i % 2, i // 2 % 2
        words = [f"w{pick.randrange(300)}" for _ in range(30)] + ["blockhead"] * insult + ["martians"] * group
        pick.shuffle(words)
        rows.append((i, f"{i} " + " ".join(words)))
        labels.append((i, insult & group, "t", "s", 1))
    docs, labels = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS)
    known = labels.where("doc_id % 5 <> 0")
    wrong = toxicity.toxicity(docs, known).join(labels.select("doc_id", "toxic"), "doc_id").where("predicted <> toxic")
    assert wrong.count() == 0
    model = toxicity.fit(docs, known)
    pair = [toxicity.Known(model.terms).of(np.frombuffer(w, np.uint8)) for w in (b"blockhead martians", b"blockhead", b"martians", b"")]
    both, one, other, none = (model.margins(np.zeros(len(p), int), p, 1)[0][0] for p in pair)
    assert both - one - other + none > 1  # what weights alone cannot give


def test_held_out_documents_are_scored_as_labelled(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = QUERIES["op13_factorization_machine"](spark, sf_dir).join(labels.where("quality = 1"), "doc_id").where("held_out").collect()
    assert len(rows) > 500 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert sum(r["predicted"] for r in rows if r["toxic"]) >= 0.95 * sum(r["toxic"] for r in rows)
    assert sum(r["predicted"] for r in rows if not r["toxic"]) <= 0.005 * len(rows)


def test_odd_documents_are_scored(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, "t", "s", 1), (1, 0, "t", "s", 1), (3, 0, "t", "s", 1), (None, 1, "t", "s", 1), (99, 1, "t", "s", 1), (4, None, "t", "s", 1), (5, 1, "t", "s", 1)], LABELS)
    assert toxicity.toxicity(odd, labels).count() == len(docs_rows())
    for few in (labels.limit(0), labels.where("doc_id = 3")):
        scores = {r["score"] for r in toxicity.toxicity(odd, few).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() < 0.5
    assert toxicity.toxicity(none, labels).collect() == []


def test_samples_are_bounded_and_never_empty(spark):
    digest = F.xxhash64("x")
    for values, rows in ((list(range(5000)), 100), ([None] * 3000 + [1, 2, 3], 100), ([7] * 3000, 1), ([*range(30), *[4] * 4000], 20)):
        df = spark.createDataFrame([(v,) for v in values], "x int")
        taken = df.where(digest <= common.sample_cut(df, digest, rows)).distinct().count()
        assert taken == min(rows, len(set(values)))
