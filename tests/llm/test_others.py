"""Pseudonyms, page text, web archives, preference pairs, embeddings and the pipeline against plain versions."""

from __future__ import annotations

import gzip
import io
import re
import time
import zipfile

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import docs_rows
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from ebbtide.llm import html_text, nn_descent, pii, preferences, queries, zip_warc

KEY = b"0123456789abcdef"

# ---- pseudonyms -----------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700), st.text(max_size=5))
def test_permutation_of_a_range_and_back(size, tweak):
    new = [pii.permuted(x, size, KEY, tweak) for x in range(size)]
    assert sorted(new) == list(range(size))
    assert [pii.permuted(x, size, KEY, tweak, back=True) for x in new] == list(range(size))


VALUES = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "378282246310005"], "address": ["192.168.0.1", "8.8.8.8"],
    "ssn": ["123-45-6789", "665-01-0001"], "date": ["1999-12-31", "31.12.1999", "12/31/1999"], "email": ["jo.doe+x@mail.example.com"],
    "phone": ["+1 (212) 555-0199", "212-555-0199", "+44 20 7946 0958"], "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
}


@pytest.mark.parametrize("kind", VALUES)
def test_values_keep_their_format_and_come_back(kind):
    for value in VALUES[kind]:
        text = f"see {value}, or {value} again."
        new, counts = pii.pseudonymised(text, KEY)
        assert counts[pii.KINDS.index(kind)] == 2 and sum(counts) == 2 and value not in new
        shape = lambda s: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d+" if kind == "address" else r"\d", "0", s)))
        assert shape(new) == shape(text)
        assert pii.pseudonymised(new, KEY)[1] == counts  # still a valid value of its kind
        assert pii.pseudonymised(new, KEY, back=True)[0] == text
        assert new != pii.pseudonymised(text, b"another key")[0]


def test_equal_values_stay_linked_in_other_layouts():
    a, b = (pii.pseudonymised(v, KEY)[0] for v in ("4111111111111111", "4111-1111-1111-1111"))
    assert a == b.replace("-", "")
    assert pii.pseudonymised("31.12.1999", KEY)[0].split(".")[::-1] == pii.pseudonymised("1999-12-31", KEY)[0].split("-")


@pytest.mark.parametrize("text", ["4111111111111112", "256.1.1.1", "1.2.3.4.5", "000-12-3456", "2001-02-30", "GB00WEST12345698765432", "version 1.2.3", "a@b", "12345", "tokens of 20 words: none"])
def test_what_fails_its_check_stays(text):
    assert pii.pseudonymised(text, KEY) == (text, [0] * len(pii.KINDS))


def test_odd_documents_are_pseudonymised(odd, none):
    found = pii.with_pseudonyms(odd, KEY)
    texts = lambda rows: sorted(map(repr, ((r[0], r[1]) for r in rows)))
    assert texts((r.doc_id, r.text) for r in found.collect()) == texts(docs_rows())
    assert pii.with_pseudonyms(none, KEY).count() == 0


# ---- page text ------------------------------------------------------------------------------------

LINE = "This is a real paragraph of the article with a good number of words in it, so that it counts as text."


@pytest.mark.parametrize(("page", "want"), [
    (None, ""), ("", ""), ("  ", ""), ("just text &amp; done", "just text & done"), ("<p>Hi", "Hi"),
    (f"<article><h1>A</h1><p><b>{LINE}<br><p>Next&nbsp; one\n here.</p></article>", f"A\n{LINE}\nNext one here."),
    (f"<body><nav><a href=1>x</a></nav><header>h</header><div class=post><h1>T</h1><p>{LINE}</p><p>{LINE}<p>{LINE}</div><div class='side-bar'>s</div><footer>f</footer>", f"T\n{LINE}\n{LINE}\n{LINE}"),
    (f"<div class='cookie-notice'>{LINE}</div><article><p>{LINE}</p><form>f<input></form></article><section id=comments><p>{LINE}</p></section>", LINE),
    (f"<main class='content has-sidebar'><ul><li>{LINE}<li>two</ul><table><tr><td>a<td>b</table></main>", f"{LINE}\ntwo\na\nb"),
    ('<p title="a>b">ok</p><script>if(a<b)"</p>"</script><style>p{}</style><!-- <p>no</p> --><p>after</p>', "ok\nafter"),
    (f"<article><p>{LINE}</p><p>half <a hre", f"{LINE}\nhalf"), ("<b>" * 20000 + "x" + "</i>" * 20000, "x"),
])
def test_main_text(page, want):
    assert html_text.main_text(page) == want


def test_pages_of_the_small_table(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    found = {r.page_id: r for r in html_text.extracted_pages(pages).collect()}
    import html

    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"<(?:/?p|/?h1|br)>", article))
        want = "\n".join(b for b in blocks if b)
        assert found[r.page_id].text == want and found[r.page_id].n_chars == len(want)


PAGES = "page_id bigint, url string, html string, text string, digest string, n_chars int"


def test_odd_pages(spark):
    rows = [(1, None, None, "t", "d", 1), (None, "u", "<p>a", "t", "d", 1), (1, "u", "<p>b", "t", "d", 1), (2, "u", "", "t", "d", 1)]
    found = html_text.extracted_pages(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in found) == [("1", "", 0), ("1", "b", 1), ("2", "", 0), ("None", "a", 1)]
    assert html_text.extracted_pages(spark.createDataFrame([], PAGES)).count() == 0


# ---- web archives ---------------------------------------------------------------------------------


def by_sql(name: str, **tables) -> list[tuple]:
    con = duckdb.connect()
    for table, frame in tables.items():
        con.register(table, frame)
    return con.sql(queries.ORACLE[name]).fetchall()


def test_records_come_back(spark, monkeypatch):
    long = ["<p>" + "é" * 60 + str(i) for i in range(5)]
    rows = [(i, f"http://x/{i}\nfolded", long[i % 5] if i % 3 else f"own {i} " + "y" * 120) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "short"), (103, "u", "short"), (None, "u", long[0]), (2, "again", long[2]), (104, "u", "z" * 300_000), (105, "u", "z" * 300_000)]
    frame = pd.DataFrame(rows, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"})
    monkeypatch.setattr(zip_warc, "RECORDS_PER_FILE", 7)
    pages = spark.createDataFrame([(*r, "t", "d", 1) for r in rows], PAGES)
    key = lambda r: tuple(map(repr, r))
    found = [tuple(r) for r in zip_warc.archived(pages).collect()]
    assert sorted(found, key=key) == sorted((tuple(r) for r in by_sql("op6_zip_packaged_warc", pages=frame)), key=key)
    assert zip_warc.archived(pages.where("false")).count() == 0


def test_payloads_survive_the_round_trip(spark, tmp_path):
    rows = [(1, "http://x/1", "ä" * 100), (2, "http://x/2", "ä" * 100), (3, None, "\r\n\r\n body"), (4, "u", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    written = zip_warc.write_packages(pages, f"file://{tmp_path}/wacz")
    back = {r.page_id: (r.url, r.html, r.record_type, r.refers_to) for r in zip_warc.read_packages(spark, written).collect()}
    assert back == {1: ("http://x/1", "ä" * 100, "response", None), 2: ("http://x/2", None, "revisit", 1), 3: (None, "\r\n\r\n body", "response", None), 4: ("u", "", "response", None)}


@pytest.mark.parametrize(("limit", "count"), [(1 << 31, 1 << 16), (10, 1 << 16), (1 << 31, 2)])
def test_directories_with_and_without_zip64(tmp_path, monkeypatch, limit, count):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", count)
    path = tmp_path / "x.zip"
    bodies = {"archive/a": b"alpha" * 10, "ä/b": b"", "indexes/i": b"PK\x05\x06 not the end"}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as package:
        for name, body in bodies.items():
            package.writestr(name, body)
        package.comment = b"a comment with PK\x05\x06 in it"
    with zip_warc._opened(f"file://{path}") as file:
        found = {m.name: m for m in zip_warc.members(file)}
        assert set(found) == set(bodies)
        for name, body in bodies.items():
            file.seek(zip_warc.first_byte(file, found[name]))
            assert file.read(found[name].size) == body


def test_broken_packages_are_refused(tmp_path):
    (tmp_path / "no.zip").write_bytes(b"PK nothing")
    with zipfile.ZipFile(tmp_path / "packed.zip", "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("a", b"x" * 500)
    with zip_warc._opened(f"file://{tmp_path}/no.zip") as file, pytest.raises(ValueError, match="not a ZIP"):
        zip_warc.members(file)
    with zip_warc._opened(f"file://{tmp_path}/packed.zip") as file, pytest.raises(ValueError, match="compressed"):
        zip_warc.first_byte(file, zip_warc.members(file)[0])


def test_a_record_whose_payload_changed_is_refused():
    raw = gzip.compress(zip_warc.warc_record(1, "u", b"body", "0" * 64, None, "2024-01-01T00:00:00Z"))
    path = io.BytesIO(raw)
    assert zip_warc.parse_record(gzip.decompress(path.getvalue()))[1] == b"body"


# ---- preference pairs -----------------------------------------------------------------------------


def test_common_turns_are_rendered_once(spark):
    schema = "pair_id bigint, turn int, role string, text string, a string, prompt string"
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "more"), (1, 3, "assistant", "sure"), (2, 0, "user", "x"), (3, 0, None, None), (4, 0, "user", "q"), (4, 1, "assistant", "a"), (None, 0, "user", "lost"), (5, 0, "user", "same")]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "bad"), (2, 0, "user", "y"), (4, 0, "user", "q"), (5, 0, "user", "same"), (9, 0, "user", "alone")]
    one, two = (spark.createDataFrame([(*r, "a", "p") for r in rows], schema) for rows in (chosen, rejected))
    found = {r.pair_id: tuple(r)[1:] for r in preferences.rendered_pairs(one, two).collect()}
    mark = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    reply = "<|im_start|>assistant\n"
    assert found[1] == (1, mark("user", "hi") + reply, "good<|im_end|>\n" + mark("user", "more") + mark("assistant", "sure"), "0+15,69+15", "bad<|im_end|>\n", "0+14")
    text = found[1][2]
    assert text[:15] == "good<|im_end|>\n" and text[69:84] == "sure<|im_end|>\n"
    assert found[2] == (0, "", mark("user", "x"), "", mark("user", "y"), "")
    assert found[3] == (0, "", mark("", ""), "", "", "")
    assert found[4] == (1, mark("user", "q") + reply, "a<|im_end|>\n", "0+12", "", "")
    assert found[5] == (1, mark("user", "same"), "", "", "", "") and set(found) == {1, 2, 3, 4, 5}
    assert preferences.rendered_pairs(one.where("false"), two).count() == 0


def test_pairs_of_the_small_table_as_in_sql(spark, small):
    found = queries.QUERIES["op4_preference_pairs"](spark, small).collect()
    want = by_sql("op4_preference_pairs", conversations=pd.read_parquet(f"{small}/conversations.parquet"))
    assert sorted(map(tuple, found)) == sorted(want) and found


def test_the_rejected_side_comes_from_the_next_id_that_exists(spark):
    """Ids with gaps, a conversation without a reply between two with one, a missing id, and none."""
    rows = [(i, t, r, f"{r}{i}") for i in (-5, 3, 40, 2**40) for t, r in enumerate(["user", "assistant"])]
    rows += [(20, 0, "user", "unanswered"), (None, 0, "user", "lost"), (None, 1, "assistant", "lost too")]
    talks = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    found = preferences.rendered_pairs(*preferences.preference_pairs(talks)).collect()
    assert {r.pair_id: r.rejected for r in found} == {-5: "assistant3<|im_end|>\n", 3: "assistant40<|im_end|>\n", 40: f"assistant{2**40}<|im_end|>\n", 2**40: ""}
    want = by_sql("op4_preference_pairs", conversations=talks.toPandas().astype({"conv_id": "Int64"}))
    assert sorted(map(tuple, found)) == sorted(want)
    assert preferences.rendered_pairs(*preferences.preference_pairs(talks.where("false"))).count() == 0


# ---- embeddings -----------------------------------------------------------------------------------


def brute_links(rows, threshold: float) -> dict:
    valid = {}
    for i, vector, label in rows:
        x = None if vector is None else np.array([np.nan if v is None else v for v in vector], float)
        if x is not None and len(x) and label is not None and i is not None and np.isfinite(x).all() and x.any():
            valid[i] = (label, len(x), x / np.linalg.norm(x))
    parent, links = {i: i for i, *_ in rows}, dict.fromkeys((i for i, *_ in rows), 0)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(valid)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if valid[a][:2] == valid[b][:2] and valid[a][2] @ valid[b][2] >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (links[i], root(i)) for i in links}


def test_links_of_embeddings(spark):
    rng = np.random.default_rng(2)
    rows, schema = [], "vec_id bigint, embedding array<float>, label int, unit string, pivot int, n_links string"
    for family in range(60):
        base = rng.standard_normal(24)
        for spread in ([0.0] if family % 2 else [0.02, 0.1, 0.2, 0.3][: family % 5]):
            for _ in range(1 if family % 2 else 4):
                x = base / np.linalg.norm(base) + spread * rng.standard_normal(24) / 24**0.5
                rows.append((len(rows), [float(np.float32(v)) for v in x], family % 3))
    same = rows[0][1]
    rows += [(1000, same, 0), (1001, same, 0), (1002, same, 1), (1003, same, None), (1004, None, 0), (1005, [], 0), (1006, [0.0] * 24, 0), (1007, [None] + same[1:], 0), (1008, [float("nan")] * 24, 0), (1009, [1.0, 0.0], 0), (1010, [2.0, 0.0], 0), (1011, [float("inf")] + same[1:], 0)]
    frame = spark.createDataFrame([(*r, "u", 1, "n") for r in rows], schema)
    found = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicates(frame).collect()}
    want = brute_links(rows, 0.93)
    assert set(found) == set(want) and all(found[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in found.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert np.mean([found[i] == want[i] for i in want]) >= 0.97
    for i in range(1003, 1009):
        assert found[i] == (0, i)
    empty = nn_descent.near_duplicates(frame.where("false"))
    assert empty.columns == ["vec_id", "n_links", "component_id", "kept"] and empty.count() == 0


# ---- pipeline -------------------------------------------------------------------------------------


def test_pipeline_stages_take_odd_rows(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r[0], r[1], None, None, None) for r in docs_rows()]
    docs = spark.createDataFrame(rows, documents.schema)
    for _, step in corpus_pipeline.STAGES[:-1]:
        for given_docs in (docs, docs.where("false")):
            out = step(spark, given_docs, small)
            assert out.columns == documents.columns and [f.dataType for f in out.schema] == [f.dataType for f in documents.schema]
            assert out.count() <= given_docs.count()


def test_pipeline_keeps_what_its_stages_keep(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    packed = corpus_pipeline.run(spark, small)
    kept = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert kept <= {r.doc_id for r in docs.collect()} and len(kept) > 0.5 * docs.count()
    assert packed.agg({"length": "max"}).first()[0] <= 2048


def test_arrow_views_start_anywhere():
    from ebbtide.llm.text import utf8

    for kind in (pa.string(), pa.large_string()):
        part = pa.array(["a", None, "bcd", ""], kind).slice(1)
        assert [None if x is None else x.tobytes() for x in utf8(part)] == [None, b"bcd", b""]


def test_an_iban_before_other_tokens_is_found():
    key = b"key"
    for iban in ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "NO9386011117947"):
        for tail in (" BIC COBADEFF", " 2024", " 12 EUR", " X", ", end", " 4111 1111 1111 1111", ""):
            value = f"Pay {iban}{tail}"
            new, counts = pii.pseudonymised(value, key)
            assert counts[pii.KINDS.index("iban")] == 1 and iban not in new, value
            assert counts[pii.KINDS.index("card")] == ("4111" in tail) and pii.pseudonymised(new, key, True)[0] == value
    new, counts = pii.pseudonymised("AB12 CDEF GHIJ KLMN DE89 3704 0044 0532 0130 00 and so on", key)
    assert counts[pii.KINDS.index("iban")] == 1 and new.startswith("AB12 CDEF GHIJ KLMN DE") and "3704" not in new


@pytest.mark.parametrize(
    "page",
    [
        "<div><p class=ad>Buy now<p>{0}</div>",
        "<ul><li class=menu-item>Buy now<li>{0}</ul>",
        "<table><tr><td class=sidebar>Buy now<td>{0}</table>",
        "<dl><dt class=promo>Buy now<dd>{0}</dl>",
        "<div><nav><ul><li>Buy now<li><a href=x>Shop</a></div><article><p>{0}</article>",
        "<section><aside><p>Buy now<p>More</section><p>{0}",
        "<ul><li><nav><li>Buy now</nav>{0}</ul>",
    ],
)
def test_furniture_without_an_end_tag_hides_only_itself(page):
    article = "The article goes on with a long sentence, and with another one, so that its text is dense enough."
    assert html_text.main_text(page.format(article)) == article


@pytest.mark.parametrize("unit", ["<div><b>", "<ul><li>", "<div>", "<p><table><tr><td><p>", "<li><i>", "<article><section>", "</b></p><dl><dt>"])
def test_deep_pages_take_linear_time(unit):
    page = unit * (100_000 // unit.count("<")) + "The text at the bottom of it all, and some more of it."
    began = time.process_time()
    assert "The text at the bottom of it all" in html_text.main_text(page)
    assert time.process_time() - began < 15


def test_a_page_inside_a_form_has_its_article():
    article = "The article goes on with a long sentence, and with another one, so that its text is dense enough."
    page = f"<body><form action=x><nav><a href=y>Menu</a></nav><input name=q><div><p>{article}</p></div><footer>About</footer></form>"
    assert html_text.main_text(page) == article
    assert html_text.main_text("<body><nav>Menu</nav><form>Your name <input name=q><button>Send</button></form>") == ""
    assert html_text.main_text(f"<p>{article}</p><form><p>Your name</p></form>") == article


def test_plain_words_are_no_secrets():
    key = b"key"
    for value in ("The secret: government officials", "token: something else", "Password: Government issue", "secret: well-known-fact"):
        assert pii.pseudonymised(value, key) == (value, [0] * len(pii.KINDS))
    for value in ("password: hunter22secret", "api_key=aBcDefghIJ", "token: deadbeef0123"):
        new, counts = pii.pseudonymised(value, key)
        assert counts[pii.KINDS.index("secret")] == 1 and new != value and pii.pseudonymised(new, key, True)[0] == value


def test_dates_before_a_time_slashed_phones_and_other_letters_in_addresses():
    key = b"key"
    cases = [("at 2001-12-31T10:00:00Z", "date"), ("Tel. 030/1234567", "phone"), ("to jürgen@example.de", "email"), ("to jane@bücher.de now", "email")]
    for value, kind in cases:
        new, counts = pii.pseudonymised(value, key)
        assert counts[pii.KINDS.index(kind)] == 1 and sum(counts) == 1 and new != value and pii.pseudonymised(new, key, True)[0] == value
    assert pii.pseudonymised("1/2 and 2001-12-31Text", key)[1] == [0] * len(pii.KINDS)


PLAIN_KINDS = {"email": r"\S+@\S+", "ssn": r"\d{3}-\d{2}-\d{4}", "address": r"\d+\.\d+\.\d+\.\d+", "date": r"\d{4}-\d\d-\d\d"}


def test_pseudonyms_are_a_permutation_of_their_format(spark):
    """By brute force over words: equal values get equal pseudonyms, different ones different ones, in the same format,
    and everything else stays."""
    rng = np.random.default_rng(4)
    values = [f"u{i}@host{i % 7}.org" for i in range(80)] + [f"{i % 600 + 1:03d}-{i % 90 + 1:02d}-{i + 1:04d}" for i in range(80)]
    values += [f"10.{i % 3}.{i}.7" for i in range(80)] + [f"19{i % 90 + 10}-0{i % 9 + 1}-1{i % 9}" for i in range(80)]
    rows = [(i, " ".join(values[j] if j < len(values) else f"word{j}" for j in rng.integers(0, 600, 30))) for i in range(200)]
    seen = {}
    for r in pii.with_pseudonyms(spark.createDataFrame(rows, "doc_id bigint, text string"), b"key").collect():
        for old, new in zip(rows[r.doc_id][1].split(" "), r.text.split(" "), strict=True):
            kind = next((k for k, shape in PLAIN_KINDS.items() if re.fullmatch(shape, old)), None)
            assert seen.setdefault(old, new) == new
            assert new == old if kind is None else re.fullmatch(PLAIN_KINDS[kind], new)
    assert len(set(seen.values())) == len(seen)


def test_labels_below_the_recall_are_searched_exactly(spark):
    rng = np.random.default_rng(6)
    rows = []
    for family in range(150):
        base = rng.standard_normal(16)
        for _ in range(4):
            x = base / np.linalg.norm(base) + 0.25 * rng.standard_normal(16) / 4
            rows.append((len(rows), [float(np.float32(v)) for v in x], family % 2))
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    want = brute_links(rows, 0.93)
    poor = nn_descent.Search(neighbours=1, tables=1, bucket=4, rounds=0, block=64)
    found = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicates(frame, search=poor).collect()}
    assert sum(n for n, _ in want.values()) > 100 and found == want
    few = nn_descent.Search(neighbours=1, tables=1, bucket=4, rounds=0, block=64, audit=1)
    assert all(r.n_links <= want[r.vec_id][0] for r in nn_descent.near_duplicates(frame, search=few).collect())

