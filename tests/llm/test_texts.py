"""Word hashes, shingle join, line windows, winnowing, packing and quality against plain versions."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from conftest import PASSAGE, SENTENCES, docs_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.llm import common, group_join, line_dedup, packing, quality, text, winnowing

SPACED, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def spaced(value: str | None) -> list[str]:
    return SPACED.findall((value or "").translate(LOWER))


def alnum(value: str | None) -> list[str]:
    return ALNUM.findall((value or "").translate(LOWER))


def raw(value: str) -> np.ndarray:
    return np.frombuffer(value.encode(), np.uint8)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbBzZ09 \t\n.,-éß漢😀 ", max_size=80))
def test_equal_words_have_equal_hashes(value):
    for words, table in ((spaced(value), text.SPACED), (alnum(value), text.ALNUM)):
        hashes = text.word_hashes(raw(value), table).tolist()
        assert len(hashes) == len(words)
        assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))


def test_blocks_do_not_cut_words(monkeypatch):
    value = raw("alpha beta gamma " * 50 + "x" * 400 + " end")
    whole = text.word_hashes(value)
    monkeypatch.setattr(text, "BLOCK", 64)
    assert (text.word_hashes(value) == whole).all()


# ---- shingle join ---------------------------------------------------------------------------------


def brute_components(rows, width: int, percent: int) -> dict:
    sets, parent = {}, {}
    for i, value in rows:
        words = spaced(value)
        n = min(width, len(words))
        sets[i] = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if words else set()
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def varied(seed: int, n: int) -> list[tuple[int, str]]:
    """Families of texts with more and more changed words, around and below every threshold."""
    rng = np.random.default_rng(seed)
    rows = []
    for family in range(n // 12):
        base = [f"w{rng.integers(3000)}" for _ in range(int(rng.integers(4, 160)))]
        for k in range(12):
            words = list(base)
            for _ in range(k // 2):
                words[int(rng.integers(len(words)))] = f"new{rng.integers(10**6)}"
            rows.append((int(len(rows)), " ".join(words)))
    return rows


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_components_are_those_of_all_pairs(spark, width, percent):
    rows = varied(width, 240)
    found = group_join.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute_components(rows, width, percent)


@pytest.mark.parametrize("filtered", [True, False])
def test_rows_of_one_id_are_documents_of_their_own(spark, monkeypatch, filtered):
    if not filtered:
        monkeypatch.setattr(common, "FILTER_HASHES", 0)
    one, two = (" ".join(f"{c}{i}" for i in range(200)) for c in "xy")
    rows = [(1, one), (7, one + " end"), (7, two + " end"), (3, two), (7, "apart from them"), (7, "apart from them"), (9, two.replace(" ", "  ")), (3, one)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = group_join.similar_documents(docs, 3, 90).collect()
    assert sorted(r.component_id for r in found) == [1, 1, 1, 3, 3, 3, 7, 7]
    kept = sorted(map(tuple, group_join.representatives(docs, 3, 90).collect()))
    assert kept == sorted([(1, one), (3, two), (7, "apart from them"), (7, "apart from them")])


def test_other_thresholds_are_refused(none):
    for percent in (60, 100):
        with pytest.raises(ValueError):
            group_join.similar_documents(none, 5, percent)


def test_part_keys_meet_for_every_linked_pair():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        for _ in range(400):
            base = np.unique(rng.integers(0, 1 << 63, int(rng.integers(2, 400)), dtype=np.uint64))
            drop = int(rng.integers(0, max(1, len(base) * (100 - percent) // 100 + 1)))
            other = np.sort(rng.permutation(base)[drop:])
            if not len(other) or 100 * len(other) < percent * len(base) or not drop:
                continue
            one, two = (group_join.part_keys(x, percent) for x in (base, other))
            shared = np.intersect1d(one[0], two[0])
            counts = [int((shared % 2 == i).sum()) for i in range(2)]
            assert any(counts[i] >= max(one[1][i], two[1][i]) for i in range(2))


def test_odd_documents_in_the_shingle_join(odd, none):
    rows = group_join.similar_documents(odd, 3, 90).collect()
    assert len(rows) == odd.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.n_shingles, r.component_id))
    assert by[5] == [(0, 5)] and by[6] == [(0, 6)] and by[7] == [(0, 7)]
    assert by[9] == [(1, 8)] and by[11][0][1] == 10 and by[2][0][1] == 1
    assert by[None][0][1] is None and by[12] == [(3, 12), (3, 12)]
    kept = group_join.representatives(odd, 3, 90)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted("1 3 4 5 6 7 8 10 None 12 12 13".split())
    assert group_join.similar_documents(none).count() == 0 and group_join.representatives(none).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = common.components(spark.createDataFrame(links, "a bigint, b bigint"))
    want = {i: 0 for i in range(21)} | {i: 100 for i in range(100, 140)}
    assert {r.id: r.component for r in found.collect()} == want
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---- line windows ---------------------------------------------------------------------------------


def brute_words(value: str) -> tuple[list[tuple], list[tuple[int, int]], set[int]]:
    """Words with their stretch of the text, the lines as ranges of words, and the first words of the chosen runs."""
    found = list(SPACED.finditer(value))
    after = [m.start() for m in found[1:]] + [len(value)]
    words = [(m.group().translate(LOWER), value[0 if i == 0 else m.start() : after[i]]) for i, m in enumerate(found)]
    lines, begin = [], 0
    for i, m in enumerate(found):
        hard = i + 1 == len(found) or "\n" in value[m.end() : after[i]]
        if hard or i + 1 - begin == line_dedup.LINE_WORDS or m.group()[-1] in ".!?":
            lines.append((begin, i + 1))
            begin = i + 1
    grams = text.gram_hashes(text.word_hashes(raw(value)), line_dedup.RUN_WORDS).tolist()
    width = line_dedup.SPAN_WORDS - line_dedup.RUN_WORDS + 1
    windows = [range(j, j + width) for j in range(len(grams) - width + 1)]
    chosen = {i for w in windows for i in w if grams[i] == min(grams[w.start : w.stop])}
    return words, lines, chosen


def brute_without_repeats(rows, least_words: int = 1) -> list[tuple]:
    """Rows of one id come together and do not repeat each other; those without an id come last."""
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for _, group in itertools.groupby(order, key=lambda i: rows[i][0]):
        before, new = set(seen), set()
        for i in group:
            words, lines, chosen = brute_words(rows[i][1] or "")
            own, repeated, covered = set(), [], set()
            plain = [w for w, _ in words]
            for p in range(len(lines) - 2):
                window = ("lines", *(tuple(plain[a:b]) for a, b in lines[p : p + 3]))
                if window in before or window in own:
                    repeated.append(p)
                own.add(window)
            for p in sorted(chosen):
                run = ("run", *plain[p : p + line_dedup.RUN_WORDS])
                if run in before or run in own:
                    covered |= set(range(p, p + line_dedup.RUN_WORDS))
                own.add(run)
            for _, part in itertools.groupby(enumerate(repeated), lambda x: x[1] - x[0]):
                part = [p for _, p in part]
                first, last = lines[part[0]][0], lines[part[-1] + 2][1]
                if last - first >= least_words:
                    covered |= set(range(first, last))
            new |= own
            kept = "".join(piece for j, (_, piece) in enumerate(words) if j not in covered)
            if not covered:
                kept = rows[i][1]
            elif len(words) - 1 in covered:
                kept = kept.rstrip()
            out.append((rows[i][0], kept, len(lines), sum(covered >= set(range(a, b)) for a, b in lines)))
        seen |= new
    return out


@pytest.mark.parametrize("least_words", [1, 8])
def test_repeats_are_those_of_all_windows_and_runs(spark, least_words):
    pick = np.random.default_rng(3)
    parts = [" ".join(f"p{k}w{i}" + ".\n"[: int(pick.random() < 0.2)] for i in range(int(pick.integers(1, 70)))) for k in range(12)]
    parts += ["a.\nb.\nc.", "x y.\nz.\nq.\nr.\ns.\nt u v."]
    rows = [(int(pick.integers(0, 40)), " ".join(parts[j] for j in pick.integers(0, len(parts), int(pick.integers(1, 6))))) for _ in range(60)]
    found = line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), least_words=least_words)
    assert sorted(map(tuple, found.collect())) == sorted(brute_without_repeats(rows, least_words))


def test_repeated_windows_go(odd, none):
    want = brute_without_repeats([r[:2] for r in docs_rows()])
    found = line_dedup.without_repeats(odd)
    assert set(found.columns) == {*odd.columns, "n_lines"}
    key = lambda r: tuple(map(repr, r))
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect()), key=key) == sorted(want, key=key)
    by = {r.doc_id: r.text for r in found.collect()}
    assert by[1] == "\n".join(SENTENCES) and by[2] == "" and PASSAGE in by[3] and "shared" not in by[4]
    assert "With a different end." in by[4]
    assert line_dedup.without_repeats(none).count() == 0


def test_repeats_inside_a_text(spark):
    part = "\n".join(SENTENCES[:4])
    rows = [(1, f"{part}\nbetween them\n{part}\nend"), (2, "\n".join(SENTENCES[5:]))]
    found = {r.doc_id: r for r in line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[1].text == f"{part}\nbetween them\nend" and found[2].n_removed == 0


def test_passages_from_the_middle_of_a_sentence_go(spark):
    passage = [f"p{i}" for i in range(70)]
    rows = [(0, " ".join(["head", *passage, "tail"]))]
    rows += [(n, " ".join([*(f"own{n}x{i}" for i in range(n)), *passage, f"end{n}", "and", f"more{n}."])) for n in range(2, 40)]
    rows += [(50, " ".join([f"v{i}" for i in range(20)] + passage[5:55] + [f"u{i}" for i in range(20)]))]
    for r in line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc_id > 0").collect():
        kept, before = spaced(r.text), spaced(dict(rows)[r.doc_id])
        assert [w for w in kept if w not in passage] == [w for w in before if w not in passage]
        assert 50 not in [len(list(g)) for k, g in itertools.groupby(kept, lambda w: w in passage) if k] and len(kept) <= len(before) - line_dedup.RUN_WORDS


def test_repeated_short_lines_go(spark):
    menu, small, four = ("\n".join(f"{c}{i} x{i}!!" for i in range(n)) for c, n in (("a", 12), ("b", 3), ("c", 4)))
    own = ["Its own start of some words here.", "Between the lists one more sentence.", "Something else in this place.", "Its own end."]
    rows = [(1, f"{menu}\n"), (2, f"{small}\n"), (3, f"{four}\n"), (4, "\n".join([own[0], menu, own[1], small, own[2], four, own[3]]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least_words, left in ((8, [own[0], own[1], small, own[2], own[3]]), (1, own)):
        found = {r.doc_id: r.text for r in line_dedup.without_repeats(docs, least_words=least_words).collect()}
        assert found == {**dict(rows), 4: "\n".join(left)}


# ---- winnowing ------------------------------------------------------------------------------------


def brute_contamination(rows, items, span: int) -> list[tuple]:
    windows = collections.defaultdict(set)
    for item, value in items:
        words = alnum(value)
        n = min(span, len(words))
        for j in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[j : j + n])].add(item)
    out = []
    for doc, value in rows:
        words, hit, found = alnum(value), set(), set()
        for n in {len(w) for w in windows}:
            for j in range(len(words) - n + 1):
                if (w := tuple(words[j : j + n])) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[w] - {None}
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit)))
    return out


ITEMS = [
    (1, PASSAGE), (2, "One"), (3, None), (4, ""), (5, "?!"), (11, " ".join(f"w{i}" for i in range(500, 530))),
    (None, "plain and simple words"), (6, "A B C D E F G H I"), (7, "same Same same same same same same same same same same same"),
]


def test_every_shared_span_is_found(spark, odd, none):
    extra = [(20, "x a b c d e f g h i y"), (21, "same " * 40), (22, "a b c d e f g h"), (23, " ".join(PASSAGE.split()[7:18])), (24, " ".join(PASSAGE.split()[7:16]))]
    rows = [r[:2] for r in docs_rows()] + extra
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = winnowing.contaminated_documents(docs, items)
    key = lambda r: tuple(map(repr, r))
    want = brute_contamination(rows, ITEMS, 10)
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(want, key=key)
    clean = winnowing.clean_documents(odd, items)
    assert clean.columns == odd.columns
    hit = {r[0] for r in want if r[5]}
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in docs_rows()} - hit
    assert winnowing.contaminated_documents(none, items).count() == 0
    assert not winnowing.contaminated_documents(docs, items.where("false")).where("contaminated").count()


def test_documents_that_open_with_item_words(spark):
    items = [(i, " ".join(f"i{i}x{j}" for j in range(14))) for i in range(40)] + [(40, "five words make an item")]
    rows = [(100 * n + i, " ".join(value.split()[:n]) + " then other words follow here") for n in range(5, 12) for i, value in items]
    frames = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_contamination(rows, items, 10)
    assert sorted(map(tuple, winnowing.contaminated_documents(*frames).collect())) == sorted(want)
    assert {r.doc_id for r in winnowing.clean_documents(*frames).collect()} == {r[0] for r in want if not r[5]}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=10, max_size=40), st.lists(st.integers(0, 3), max_size=10), st.lists(st.integers(0, 3), max_size=10))
def test_a_shared_span_shares_a_fingerprint(span, before, after):
    one, two = (text.mix(np.array(x, np.uint64) + np.uint64(1)) for x in (span, [*before, *span, *after]))
    at_one, one = winnowing.fingerprints(one, 5, 10)
    at_two, two = winnowing.fingerprints(two, 5, 10)
    inside = two[(at_two >= len(before)) & (at_two + 5 <= len(before) + len(span))]
    assert set(one.tolist()) & set(inside.tolist())


# ---- packing --------------------------------------------------------------------------------------


def test_pieces_are_whole_and_sequences_gapless(spark, odd, none):
    from tokenizers import Tokenizer

    names = packing.vocabulary()
    reader = Tokenizer.from_file(names[0])
    limits = packing.Limits(tokens=512, pieces=5, cost=512 * 512)
    rows = packing.packed(odd, *names, limits).collect()
    assert {r[0] for r in docs_rows()} == {r.doc_id for r in rows}
    by, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, value in {(r[0], r[1]) for r in docs_rows()} - {(12, docs_rows()[12][1])}:
        ids = np.array([*reader.encode(value or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for j, r in enumerate(sorted(by[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (j, at) and (j == 0 or r.length == 512)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512 and len(places) <= 5 and sum(n * n for _, n in places) <= 512 * 512
    assert packing.packed(none, *names).count() == 0


def plain_best_fit(lengths: list[int], limits: packing.Limits) -> int:
    bins: list[list[float]] = []
    caps = [limits.tokens, limits.pieces, limits.cost]
    for n in sorted(lengths, reverse=True):
        need = [n, 1, n * n]
        fits = [b for b in bins if all(x >= y for x, y in zip(b, need))]
        if not fits:
            bins.append(list(caps))
            fits = [bins[-1]]
        best = min(fits, key=lambda b: sum(w * ((x - y) / c) ** 2 for w, x, y, c in zip(limits.weights, b, need, caps)))
        best[:] = [x - y for x, y in zip(best, need)]
    return len(bins)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120), st.sampled_from([(64, 64, 4096), (64, 3, 4096), (64, 64, 4096)]), st.sampled_from(["norm", "dot"]))
def test_plans_keep_every_capacity(lengths, caps, rule):
    limits = packing.Limits(*caps, rule=rule)
    plan = packing.plan_sequences(dict(collections.Counter(lengths)), limits)
    bins, ranks = collections.defaultdict(list), collections.defaultdict(list)
    for n, r0, r1, b0, offset in zip(plan.length, plan.r0, plan.r1, plan.b0, plan.offset):
        ranks[n] += range(r0, r1)
        for k in range(r1 - r0):
            bins[b0 + k].append((offset, n))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in collections.Counter(lengths).items()}
    assert len(bins) == plan.sequences
    for places in bins.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(places))]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= caps[0] and len(places) <= caps[1]
    if rule == "norm":
        assert plan.sequences <= plain_best_fit(lengths, limits) * 1.1 + 1


def test_a_piece_that_fits_nowhere_is_an_error():
    with pytest.raises(ValueError, match="exceeds"):
        packing.plan_sequences({50: 1}, packing.Limits(tokens=64, cost=100))


# ---- quality --------------------------------------------------------------------------------------


def test_label_model_finds_the_better_labellers():
    rng = np.random.default_rng(3)
    accuracy = np.linspace(0.62, 0.97, len(quality.LABELLERS))
    truth = rng.random(4000) < 0.2
    votes = ["".join("-" if rng.random() < 0.3 else "01"[int(t == (rng.random() < a))] for a in accuracy) for t in truth]
    posterior, table = quality.label_model(dict(collections.Counter(votes)))
    judged = np.array([posterior[v] > 0.5 for v in votes])
    assert (judged == truth).mean() > 0.97
    found = 0.2 * table[1, :, 1] + 0.8 * table[0, :, 0]
    assert np.corrcoef(found, accuracy)[0, 1] > 0.9
    assert quality.label_model({}) [0] == {}


def test_held_out_documents_are_judged_as_labelled(spark, small):
    docs, labels = (spark.read.parquet(f"{small.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.scored(docs, labels).join(labels, "doc_id")
    clean = found.where("quality = 1 AND toxic = 0")
    assert clean.where("kept").count() >= 0.98 * clean.count()
    bad = found.where("quality = 0")
    assert bad.where("NOT kept").count() >= 0.95 * bad.count()


def test_one_wrong_label_keeps_no_word_off_the_abuse_list(spark):
    texts = [(i, " ".join(f"plain{(i * j) % 97}" for j in range(1, 30)) + (" often" if i < 11 else " seldom" if i < 16 else "")) for i in range(400)]
    labels = [(i, int(i < 10 or 11 <= i < 16 or i % 20 == 3)) for i in range(400)]
    docs, known = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = quality.abuse_words(docs, known, "doc_id", quality.Training())
    assert set(found.tolist()) == set(text.word_hashes(raw("often seldom"), text.ALNUM).tolist())


def test_abuse_is_found_in_every_language(spark, small):
    docs, labels = (spark.read.parquet(f"{small.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels.where("toxic IS NOT NULL"), "doc_id").select("lang", "toxic", "text").collect()
    listed = quality.abuse_words(docs, labels, "doc_id", quality.Training())
    hit = collections.defaultdict(list)
    for r in rows:
        hit[r.toxic, r.lang if r.toxic else ""].append(bool(np.isin(text.word_hashes(raw(r.text or ""), text.ALNUM), listed).any()))
    share = {k: np.mean(v) for k, v in hit.items()}
    assert share.pop((0, "")) <= 0.01 and len(share) == 4 and min(share.values()) >= 0.9, share


def test_odd_documents_are_judged(spark, odd, none):
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    for given_labels in (None, labels, labels.where("false")):
        rows = quality.scored(odd, given_labels).collect()
        assert len(rows) == odd.count()
        assert all(not r.kept and r.p_bad == 1 for r in rows if r.doc_id in (5, 6, 7))
    assert quality.kept_documents(odd).columns == odd.columns
    assert quality.scored(none, labels).count() == 0 and quality.kept_documents(none).count() == 0


@pytest.mark.parametrize("ids", ["cast(null as bigint)", "7", "id"])
def test_the_sample_is_bounded_whatever_the_ids(spark, ids):
    """Neither null nor repeated ids, nor a share of one in ten million, change how many documents teach."""
    docs = spark.range(4000).selectExpr(f"{ids} as doc_id", "concat('Some plain words about number ', id % 3000, ' stand here. It is fine.') as text")
    digest = F.xxhash64("text")
    for rows in (1, 50, 2999):
        taken = docs.where(digest <= common.sample_cut(docs, digest, rows)).select(digest).distinct().count()
        assert taken == rows
    found = quality.scored(docs, training=quality.Training(sample_rows=40))
    assert found.count() == 4000 and found.where("kept").count() == 4000
