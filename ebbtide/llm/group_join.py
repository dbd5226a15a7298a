"""Jaccard self-join of texts on word shingles through a token-group matrix.

Documents are partitioned into groups of similar ones, a group keeps the union of its members' tokens, the number of
a query's tokens in that union bounds its similarity with every member, and only groups whose bound reaches the
threshold are opened.

Which groups a query meets at all is found without comparing documents. The hash range is cut into more parts than
two linked sets can have different tokens, so some part holds the same tokens on both sides: a key per part is exact.
Sets that share a key form a bucket. Round one puts each bucket's most central document in a group of its own and asks
the rest of the bucket. Round two keeps what shares keys with other components than its own, groups it by common keys,
in pieces of bounded size, and asks the groups in which a query shares a key with a member. A query gets one link
per component, so a family of n near copies costs about n links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm import common
from ebbtide.llm.text import SPACED, gram_hashes, mix, utf8, word_hashes
from ebbtide.session import release, stage

# Members whose tokens a task holds at once, and queries that one task streams past them.
GROUP_MEMBERS, GROUP_TOKENS, GROUP_QUERIES = 1024, 4_000_000, 2000
PEELS = 1  # times that documents with too few shared keys are put aside; more find little and write each table again
NEVER = (1 << 31) - 1
CODE_SHIFT = 24  # bits that a key's code leaves out


def shingles(raw: np.ndarray | None, width: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; one for the whole text where it has fewer words."""
    words = word_hashes(raw, SPACED) if raw is not None else np.zeros(0, np.uint64)
    return np.unique(gram_hashes(words, min(width, len(words)))) if len(words) else words


def _band_starts() -> np.ndarray:
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 7 // 5)))
    return np.array(starts)


BANDS = _band_starts()  # wider than any threshold from 72 % allows two linked sizes to differ


def part_keys(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, list[int]]:
    """Keys of a set of which two sets with Jaccard similarity of ``percent`` or more share some, unless equal; and
    how many, for bands of even and of odd number (the last bit of a key).

    Two linked sets of at most R tokens differ in at most 2R(100-p)/(100+p) of them. There are ``spare`` more parts
    than that, so ``spare`` parts agree; keys of empty parts are needed only by sets with as many empty parts. With
    the sizes that can meet the set at hand, more parts have to agree, of which some may be empty."""
    size, needs = len(tokens), [NEVER, NEVER]
    if not size:
        return tokens, needs
    own = int(np.searchsorted(BANDS, size, "right")) - 1
    found = []
    for band in [own, own + 1] if size * 100 // percent >= BANDS[own + 1] else [own]:
        largest = int(BANDS[band + 1]) - 1
        differ = 2 * largest * (100 - percent) // (100 + percent)
        if not differ:
            continue
        spare = 2 + differ // 8
        parts = differ + spare
        part = ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        full = part[first]
        sums = np.add.reduceat(mix(tokens ^ np.uint64(0xA0761D6478BD642F)), first)
        tag = np.uint64(band) << np.uint64(40)
        keys = mix(sums ^ mix(full + tag))
        partner = min(size * 100 // percent, largest)
        agree = parts - (size + partner) * (100 - percent) // (100 + percent)
        needs[band % 2] = max(1, agree - (parts - len(full)))
        if parts - len(full) >= spare:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), full, assume_unique=True)
            keys = np.concatenate([keys, mix(mix(empty + tag) ^ np.uint64(1))])
        found.append(keys & ~np.uint64(1) | np.uint64(band % 2))
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), needs


def _sets(width: int, percent: int):
    """(row, doc_id, body, text) to the size and two digests of each text's set, how many keys a link takes, and keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, keys, needs = [], [], [], [], []
            for raw in utf8(batch.column(3)):
                tokens = shingles(raw, width)
                sizes.append(len(tokens))
                one.append(mix(tokens).sum(dtype=np.uint64))
                two.append(mix(tokens ^ np.uint64(0xE7037ED1A0B428DB)).sum(dtype=np.uint64))
                own, need = part_keys(tokens, percent)
                keys.append(own)
                needs.append(need)
            ends = np.cumsum([0, *map(len, keys)])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(one, np.uint64).view(np.int64)),
                    pa.array(np.array(two, np.uint64).view(np.int64)),
                    *(pa.array([need[i] for need in needs], pa.int32()) for i in range(2)),
                    pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(np.concatenate(keys).view(np.int64)) if keys else pa.array([], pa.int64())
                    ),
                ],
                names=["row", "doc_id", "body", "n_shingles", "one", "two", "even", "odd", "keys"],
            )

    return run


def _shared(sent):
    """(doc_id, even, odd, size, keys) to (key, doc_id, even, odd, size) for the keys that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            counts = lists.value_lengths().to_numpy(zero_copy_only=False)
            keys = lists.flatten().to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(common.passing(sent, keys.view(np.uint64) >> np.uint64(CODE_SHIFT)))
            owner = pa.array(np.repeat(np.arange(len(batch)), counts)[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[keep]), *(batch.column(i).take(owner) for i in range(4))], names=["key", "doc_id", "even", "odd", "size"]
            )

    return run


class Group:
    """Members' tokens as one sorted union that knows for each token who holds it: a row of the token-group matrix."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]):
        self.ids, self.own = (np.array([m[i] for m in members], np.int64) for i in range(2))
        self.sizes = np.array([len(m[2]) for m in members])
        tokens = np.concatenate([m[2] for m in members])
        holders = np.repeat(np.arange(len(members), dtype=np.int32), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, self.holders = tokens[order], holders[order]
        self.starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        self.union = tokens[self.starts]
        self.counts = np.diff(np.append(self.starts, len(tokens)))

    def links(self, own: int, tokens: np.ndarray, percent: int) -> list[int]:
        """A similar member of each component other than ``own``; the group stays closed if the union rules it out."""
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        at = at[self.union[at] == tokens]
        if 100 * len(at) < percent * len(tokens):
            return []
        n = self.counts[at]
        places = np.repeat(self.starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(self.holders[places], minlength=len(self.ids))
        found = np.flatnonzero((100 * both >= percent * (len(tokens) + self.sizes - both)) & (self.own != own))
        _, first = np.unique(self.own[found], return_index=True)
        return self.ids[found[first]].tolist()


def _open(width: int, percent: int):
    """Rows (g, piece, salt, role, doc_id, own, text), sorted so that a group's members come before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, group = None, [], None
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(6)))
            links = []
            for (g, piece, salt, role, doc, own), raw in zip(rows, utf8(batch.column(6))):
                if (g, piece, salt) != key:
                    key, members, group = (g, piece, salt), [], None
                tokens = shingles(raw, width)
                if not len(tokens):
                    continue
                if role == 0:
                    members.append((doc, own, tokens))
                elif members:
                    group = group or Group(members)
                    links += [(doc, other) for other in group.links(own, tokens, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in range(2)], names=["a", "b"])

    return run


def open_groups(groups: DataFrame, queries: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) of each query (g, piece, doc_id, own) with members of its group (g, piece, doc_id, own) of other
    components ``own``, one for each component.

    The queries of a group are dealt over as many tasks as they need, each of which gets the members."""
    counts = queries.groupBy("g", "piece").agg(F.ceil(F.count("*") / GROUP_QUERIES).cast("int").alias("salts"))
    members = groups.join(counts, ["g", "piece"]).select(
        "g", "piece", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), "doc_id", "own"
    )
    asked = queries.join(counts, ["g", "piece"]).select(
        "g", "piece", F.pmod(F.xxhash64("doc_id"), "salts").cast("int").alias("salt"), F.lit(1).alias("role"), "doc_id", "own"
    )
    rows = members.union(asked).join(texts, "doc_id").select("g", "piece", "salt", "role", "doc_id", "own", "text")
    spark = texts.sparkSession
    dealt = rows.repartition(common.width(spark), "g", "piece", "salt").sortWithinPartitions("g", "piece", "salt", "role", "doc_id")
    return dealt.mapInArrow(_open(width, percent), "a bigint, b bigint")


def similar_documents(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id): the size of each text's shingle set, and the smallest id it is linked with
    over any number of links, itself included. Linked: Jaccard similarity of the sets of ``percent`` % or more (72 to 99).

    Words are runs of anything but ASCII white space, A-Z read as a-z. A text of fewer words than ``width`` is one
    shingle. Null texts and texts without words have an empty set, are linked with nothing and are their own
    component. Ids are integers; a row without an id gets no component. Rows of one id are documents of their own:
    each has the component of its own text. Equal sets are one class. Other columns are ignored."""
    return _classified(docs, width, percent, id_col).select(F.col("doc_id").alias(id_col), "n_shingles", "component_id")


def _classified(docs: DataFrame, width: int, percent: int, id_col: str) -> DataFrame:
    """Each row (doc_id, body, n_shingles, component_id, best), ``best`` being the document (class_id, class_body) that
    stands for its component: one with the smallest id."""
    if not 72 <= percent <= 99:
        raise ValueError("percent must be from 72 to 99")
    common.text_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64("text").alias("body"), "text")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "body", "text")
    keyed = "row bigint, doc_id bigint, body bigint, n_shingles bigint, one bigint, two bigint, even int, odd int, keys array<bigint>"
    full = stage(rows.mapInArrow(_sets(width, percent), keyed), "keyed-sets")
    same = ["n_shingles", "one", "two"]
    sets = stage(full.select("row", "doc_id", "body", *same), "shingle-sets")
    # A class of equal sets goes by its first document's row, which is written and so the same for all that follows.
    first = F.min(F.struct("doc_id", "row", "body")).alias("first")
    classes = sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(first, F.count("*").alias("n"))
    classes = stage(classes.select(*same, "n", F.col("first.row").alias("lead"), F.col("first.doc_id").alias("class_id"), F.col("first.body").alias("class_body")), "set-classes")
    buckets = _buckets(full, classes, same)
    release(full)
    # Texts of the documents in buckets, by the rows that lead their classes.
    leads = classes.select(F.col("lead").alias("node"), F.col("class_id").alias("doc_id"), F.col("class_body").alias("body"))
    wanted = leads.join(buckets.select(F.col("doc_id").alias("node")).distinct(), "node", "left_semi")
    texts = docs.join(wanted, ["doc_id", "body"]).select(F.col("node").alias("doc_id"), "text")
    if not sets.groupBy("doc_id", "body").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["doc_id"])
    found = components(buckets, texts, width, percent)
    named = classes.join(found.withColumnRenamed("id", "lead"), "lead", "left").withColumn("component", F.coalesce("component", "lead"))
    best = named.groupBy("component").agg(F.min(F.struct("class_id", "class_body")).alias("best"))
    named = stage(named.join(best, "component").select(*same, "best"), "class-components")
    judged = sets.join(named, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("best.class_id", "doc_id"))
    return judged.select("doc_id", "body", "n_shingles", component.alias("component_id"), "best")


def _buckets(full: DataFrame, classes: DataFrame, same: list[str]) -> DataFrame:
    """The keys (key, doc_id, even, odd, size) that documents of different classes share, ``doc_id`` being the row that
    leads a class, of documents that share as many as a link takes.

    Most keys are one document's alone. Codes of 40 bits are counted first, and a filter of the repeated ones stops
    the others before they are shuffled with their documents."""
    own = ["doc_id", "even", "odd", "size", "keys"]
    named = full.where((F.size("keys") > 0) & F.col("doc_id").isNotNull()).select(
        F.col("row").alias("doc_id"), "even", "odd", F.col("n_shingles").alias("size"), "keys", F.xxhash64(*same).alias("h"), *same
    )
    # Of the rows of a class one is taken. Rows that cannot share theirs skip the join.
    sent = common.hash_filter(classes.where("n > 1").select(F.xxhash64(*same).alias("h")))
    several = F.pandas_udf(lambda h: pd.Series(common.passing(sent, h.to_numpy().view(np.uint64))), "boolean")
    marked = named.withColumn("several", several("h"))
    copies = marked.where("several").join(classes.select("lead", *same), same).where("doc_id = lead").select(*own)
    taken = marked.where("NOT several").select(*own).union(copies)
    codes = taken.select(F.explode("keys").alias("key")).groupBy(F.shiftrightunsigned("key", CODE_SHIFT).alias("h")).count()
    repeated = stage(codes.where("count > 1").select("h"), "repeated-codes")
    shared = taken.select(*own).mapInArrow(_shared(common.hash_filter(repeated)), "key bigint, doc_id bigint, even int, odd int, size bigint")
    unpruned = buckets = stage(shared, "shared-keys")
    for _ in range(PEELS):
        buckets = stage(_peeled(buckets, "doc_id"), "shared-keys")
    release(unpruned)
    return buckets


def components(buckets: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Components (id, component) of the documents in buckets (key, doc_id) that have a link; ``texts`` (doc_id, text)."""
    texts = stage(texts, "bucket-texts")
    # The document whose keys lie in the largest buckets is in the middle of a family of near copies.
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n"))
    central = buckets.join(sizes, "key").groupBy("doc_id").agg(F.sum("n").alias("score"))
    scored = stage(buckets.select("key", "doc_id").join(central, "doc_id"), "buckets")
    leads = scored.groupBy("key").agg(F.max_by("doc_id", F.struct("score", -F.col("doc_id"))).alias("g"))
    asked = stage(
        scored.join(leads, "key").where("doc_id <> g").select("g", F.lit(0).alias("piece"), "doc_id").distinct(), "star-queries"
    ).withColumn("own", F.col("doc_id"))
    stars = asked.select("g", "piece").distinct().withColumn("doc_id", F.col("g")).withColumn("own", F.col("g"))
    links = stage(open_groups(stars, asked, texts, width, percent), "links")
    found = stage(common.components(links), "components")
    left = buckets
    for _ in range(PEELS):
        left = stage(_peeled(_named(left, found), "g"), "open-buckets")
    if left.isEmpty():
        return found
    more = _exhaustive(left, texts, width, percent)
    return common.components(stage(links.union(more), "all-links"))


def _peeled(buckets: DataFrame, group: str) -> DataFrame:
    """What of buckets (key, doc_id, even, odd, ...) can still hold a link between different values of ``group``: keys
    with two of them, of documents that share as many keys as a link takes."""
    mixed = buckets.groupBy("key").agg(F.min(group).alias("lo"), F.max(group).alias("hi")).where("lo < hi").select("key")
    kept = buckets.join(mixed, "key", "left_semi")
    odd = F.pmod("key", F.lit(2))
    counts = kept.groupBy("doc_id").agg(F.sum(1 - odd).alias("n_even"), F.sum(odd).alias("n_odd"), F.max("even").alias("e"), F.max("odd").alias("o"))
    alive = counts.select(
        "doc_id", (F.col("n_even") >= F.col("e")).alias("keep_even"), (F.col("n_odd") >= F.col("o")).alias("keep_odd")
    ).where("keep_even OR keep_odd")
    joined = kept.join(alive, "doc_id").where(F.when(odd == 1, F.col("keep_odd")).otherwise(F.col("keep_even")))
    return joined.select(*buckets.columns)


def _named(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Buckets with each document's component ``g``."""
    named = buckets.drop("g").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return named.select("key", "doc_id", "even", "odd", "size", F.coalesce("component", "doc_id").alias("g"))


def _exhaustive(left: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components ``g`` that share keys.

    A document that has to share r of its k keys meets every partner on its k - r + 1 rarest ones. Documents are
    grouped by their most common key, which most of a family have, in pieces of bounded size."""
    counted = left.join(left.groupBy("key").agg(F.count("*").alias("n")), "key").withColumn("own", F.col("g"))
    odd = F.pmod("key", F.lit(2))
    each = Window.partitionBy("doc_id", odd)
    need = F.when(odd == 1, F.col("odd")).otherwise(F.col("even"))
    rare = stage(
        counted.withColumn("rank", F.row_number().over(each.orderBy("n", "key")))
        .withColumn("k", F.count("*").over(each))
        .where(F.col("rank") <= F.col("k") - need + 1)
        .select("key", "doc_id", "own"),
        "rare-keys",
    )
    homes = counted.groupBy("doc_id", "own", "size").agg(F.max_by("key", F.struct("n", "key")).alias("g"))
    pieces = homes.groupBy("g").agg(
        F.ceil(F.greatest(F.count("*") / GROUP_MEMBERS, F.sum("size") / GROUP_TOKENS)).alias("pieces")
    )
    groups = stage(
        homes.join(pieces, "g").select("g", F.pmod(F.xxhash64("doc_id"), "pieces").cast("int").alias("piece"), "doc_id", "own"), "groups"
    )
    present = rare.select("key", "doc_id").join(groups, "doc_id").select("key", "g", "piece").distinct()
    asked = stage(rare.select("key", "doc_id", "own").join(present, "key").select("g", "piece", "doc_id", "own").distinct(), "group-queries")
    return open_groups(groups, asked, texts, width, percent)


def representatives(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component of :func:`similar_documents`: one with the smallest id.
    Rows without an id stay, rows that repeat both id and text stay as often as given. All columns stay."""
    judged = _classified(docs, width, percent, id_col)
    other = (F.col("doc_id") != F.col("best.class_id")) | (F.col("body") != F.col("best.class_body"))
    gone = judged.where(other).select(F.col("doc_id").alias("gone_id"), F.col("body").alias("gone_body")).distinct()
    rows = common.boxed(docs).withColumn("body", F.xxhash64("doc.text"))
    same = (F.col(f"doc.`{id_col}`") == F.col("gone_id")) & (F.col("body") == F.col("gone_body"))
    return rows.join(gone, same, "left_anti").select("doc.*")
