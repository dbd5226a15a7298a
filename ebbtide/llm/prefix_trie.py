"""Prefix trie of conversations, with subtree totals by centroid decomposition.

A node of the trie is a distinct sequence of first turns; the conversations that begin with it are its members. A node
is named by its smallest member and its depth, which no two nodes share. Nodes are found by hash: a prefix has the
exclusive or of the hashes of its turns and their places, a running total that is taken in chunks, so that a very long
conversation is dealt over many tasks.

Subtree totals would take as many rounds as the trie is deep if they were passed from child to parent. Instead the
forest of parent edges is split again and again at centroids: the deepest node of a component that has at least half of
the component's nodes below it or is itself one of them. Its total over the component is added to every node on the
path from it to the component's top, and the component falls apart into what hangs below it and the rest, of which
none has more than half of the nodes. A node's total is the sum of what was added to it. Large components are split by
Spark jobs, all at once, one round for each halving; components that fit into a task are decomposed there."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm import common
from ebbtide.session import stage

CHUNK = 1024  # turns of a conversation, or ids of a node's list, that one task takes at a time
COMPONENT = 1 << 14  # most nodes of a component that is decomposed in one task
FAN = 16  # depths that are tried at once in the search for a centroid


def ordered_turns(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv, pos, a, b, chars): each turn's place in its conversation from 1, a 120-bit digest of role and text, and
    the code points of the text. Order: turn (nulls first), role, text; null role and text are empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv"),
        "turn",
        role.alias("role"),
        F.xxhash64(text).alias("tie"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("a"),
        F.conv(F.substring(digest, 16, 15), 16, 10).cast("bigint").alias("b"),
        F.char_length(text).cast("bigint").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Ranges of the whole order split a conversation of any length; a range counts by itself, then ranges are added up.
    order = ["conv", F.asc_nulls_first("turn"), "role", "tie", "a", "row"]
    ranged = turns.repartitionByRange(common.width(conversations.sparkSession), *order).withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "turn-ranges")
    sizes = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = ranged.withColumn("at", F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order[1:])))
    return placed.join(offsets, ["conv", "part"]).select("conv", (F.col("at") + F.col("before")).alias("pos"), "a", "b", "chars")


def trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie of conversations: ``turns`` (conv, pos, a, b, chars) without gaps from 1, ``convs`` (conv) all of them.

    Returns ``members`` (conv, depth, owner), the node by its smallest member of each conversation's prefix of each
    depth, and ``nodes`` (conv, depth, parent, n_convs, n_children, chars); the root has depth 0 and no parent."""
    chunk = F.floor((F.col("pos") - 1) / CHUNK)
    hashed = turns.select("conv", "pos", chunk.alias("chunk"), F.xxhash64("pos", "a", "b").alias("x"), F.xxhash64("b", "pos", "a").alias("y"), "chars")
    sums = hashed.groupBy("conv", "chunk").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    heads = sums.select("conv", "chunk", *[F.coalesce(F.bit_xor(c).over(before), zero).alias(f"{c}0") for c in "xy"])
    running = Window.partitionBy("conv", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    within = hashed.select("conv", "chunk", "pos", "chars", *[F.bit_xor(c).over(running).alias(c) for c in "xy"])
    prefixes = within.join(heads, ["conv", "chunk"]).select(
        "conv", F.col("pos").alias("depth"), *[F.col(c).bitwiseXOR(F.col(f"{c}0")).alias(c) for c in "xy"], "chars"
    )
    roots = convs.select("conv", zero.alias("depth"), zero.alias("x"), zero.alias("y"), zero.alias("chars"))
    prefixes = stage(prefixes.unionByName(roots), "prefixes")
    own = ["depth", "x", "y"]
    named = prefixes.groupBy(*own).agg(F.min("conv").alias("owner"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"))
    named = stage(named, "named-nodes")
    members = stage(prefixes.join(named.select(*own, "owner"), own).select("conv", "depth", "owner"), "members")
    above = members.select("conv", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    nodes = named.select(F.col("owner").alias("conv"), "depth", "n_convs", "chars").join(above, ["conv", "depth"], "left")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    return members, stage(nodes.select("conv", "depth", "parent", "n_convs", "n_children", "chars"), "nodes")


def _decomposed(width: int):
    """Rows (top_conv, top_depth, conv, depth, parent, value ...), a component's together and by depth, to
    (conv, depth, total ...), each node's subtree totals inside its component by centroid decomposition."""

    def totals(parents: list[int], values: list[list[int]]) -> list[list[int]]:
        """``parents`` by place, a parent before its children; -1 for the top."""
        n = len(parents)
        found = [[0] * n for _ in values]
        children: list[list[int]] = [[] for _ in range(n)]
        for i in range(1, n):
            children[parents[i]].append(i)
        gone, work = [False] * n, [0]
        while work:
            top = work.pop()
            nodes = [top]
            for v in nodes:
                nodes += [c for c in children[v] if not gone[c]]
            size = dict.fromkeys(nodes, 1)
            for v in reversed(nodes[1:]):
                size[parents[v]] += size[v]
            centroid, deeper = top, True
            while deeper:
                deeper = False
                for c in children[centroid]:
                    if not gone[c] and 2 * size[c] >= len(nodes):
                        centroid, deeper = c, True
                        break
            below = [centroid]
            for v in below:
                below += [c for c in children[v] if not gone[c]]
            sums = [sum(x[v] for v in below) for x in values]
            v = centroid
            while True:  # the path from the centroid to the component's top
                for total, own in zip(found, sums):
                    total[v] += own
                if v == top:
                    break
                v = parents[v]
            gone[centroid] = True
            work += [c for c in children[centroid] if not gone[c]]
            if centroid != top:
                work.append(top)
        return found

    names = ["conv", "depth", *(f"total{k}" for k in range(width))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], [[] for _ in names]

        def close() -> None:
            place = {(r[0], r[1]): i for i, r in enumerate(held)}
            sums = totals([place[r[2], r[1] - 1] if i else -1 for i, r in enumerate(held)], [[r[3 + k] for r in held] for k in range(width)])
            for column, more in zip(out, [[r[0] for r in held], [r[1] for r in held], *sums]):
                column += more

        for batch in batches:
            for top_conv, top_depth, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (top_conv, top_depth) != key:
                    if held:
                        close()
                    key, held = (top_conv, top_depth), []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)
            out = [[] for _ in names]
        if held:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    return run


def _centroids(large: DataFrame, members: DataFrame) -> DataFrame:
    """(top_conv, top_depth, c_conv, c_depth) of the components in ``large`` (top_conv, top_depth, conv, depth).

    The nodes that have at least half of a component below them lie on one path, so the deepest of them is found by
    searching its depth: the component's nodes are counted by their ancestor at FAN depths at once."""
    top = ["top_conv", "top_depth"]
    # Nodes by component, conversation and depth are one path each: its range of depths stands for all its nodes.
    paths = stage(large.groupBy(*top, "conv").agg(F.min("depth").alias("lo"), F.max("depth").alias("hi")), "paths")
    state = paths.groupBy(*top).agg(
        F.sum(F.col("hi") - F.col("lo") + 1).alias("n"), F.min("lo").alias("least"), F.max("hi").alias("most"), F.min("conv").alias("c_conv")
    )
    state = stage(state, "searches")
    while True:
        step = F.greatest(F.lit(1), F.ceil((F.col("most") - F.col("least")) / FAN)).cast("bigint")
        tried = state.where("least < most").select(*top, "n", F.explode(F.sequence(F.col("least") + step, F.col("most"), step)).alias("at"))
        counts = paths.join(tried, top).where("hi >= at").withColumn("below", F.col("hi") - F.greatest("lo", "at") + 1)
        ancestors = counts.join(members.select("conv", F.col("depth").alias("at"), "owner"), ["conv", "at"])
        half = ancestors.groupBy(*top, "n", "at", "owner").agg(F.sum("below").alias("below")).where("2 * below >= n")
        best = half.groupBy(*top).agg(F.max("at").alias("at"), F.max_by("owner", "at").alias("owner"))
        joined = state.join(best, top, "left")
        state = stage(
            joined.select(
                *top,
                "n",
                F.coalesce("at", "least").alias("least"),
                # No node a step further down has half of them, so the search goes on before it.
                F.when(F.col("least") < F.col("most"), F.least("most", F.coalesce("at", "least") + step - 1)).otherwise(F.col("most")).alias("most"),
                F.coalesce("owner", "c_conv").alias("c_conv"),
            ),
            "searches",
        )
        if state.where("least < most").isEmpty():
            return state.select(*top, "c_conv", F.col("least").alias("c_depth"))


def rolled_up(nodes: DataFrame, members: DataFrame, values: dict[str, Column], component: int = COMPONENT) -> DataFrame:
    """(conv, depth, values ...) with the total of each of ``values`` over each node's subtree, the node included."""
    spark, at, top = nodes.sparkSession, ["conv", "depth"], ["top_conv", "top_depth"]
    names = [f"total{k}" for k in range(len(values))]
    root = nodes.where("depth = 0").select("conv").first()
    start = F.lit(root["conv"] if root else None).cast("bigint")
    kept = [*top, *at, "parent", *names]
    forest = nodes.select(
        start.alias("top_conv"), F.lit(0).cast("bigint").alias("top_depth"), *at, "parent", *[v.alias(n) for n, v in zip(names, values.values())]
    )
    forest = stage(forest, "forest")
    small, added = [], []
    while True:
        sizes = forest.groupBy(*top).agg(F.count("*").alias("n"))
        many = sizes.where(F.col("n") > component).select(*top)
        if many.isEmpty():
            small.append(forest)
            break
        small.append(forest.join(many, top, "left_anti"))
        large = forest.join(many, top, "left_semi")
        chosen = stage(_centroids(large, members), "centroids")
        # For each path of the component's nodes: is it below the centroid, and by which child of the centroid?
        paths = large.select(*top, "conv").distinct().join(chosen, top)
        here, child = (members.select("conv", (F.col("depth") - k).alias("c_depth"), F.col("owner").alias(n)) for k, n in ((0, "here"), (1, "piece")))
        below = paths.join(here, ["conv", "c_depth"]).where(F.col("here") == F.col("c_conv")).join(child, ["conv", "c_depth"], "left")
        marked = large.join(below.select(*top, "conv", "c_depth", "piece"), [*top, "conv"], "left")
        marked = stage(marked.withColumn("under", F.coalesce(F.col("depth") - F.col("c_depth"), F.lit(-1))), "marked-nodes")
        sums = marked.where("under >= 0").groupBy(*top).agg(*[F.sum(n).alias(n) for n in names]).join(chosen, top)
        # The path from the centroid to the top, as the nodes of the centroid's own conversation, block by block of depths.
        block = F.explode(F.sequence(F.floor(F.col("top_depth") / CHUNK), F.floor(F.col("c_depth") / CHUNK))).alias("block")
        spans = sums.select(F.col("c_conv").alias("conv"), "top_depth", "c_depth", *names, block)
        steps = members.select("conv", "depth", "owner", F.floor(F.col("depth") / CHUNK).alias("block"))
        path = spans.join(steps, ["conv", "block"]).where("depth between top_depth and c_depth")
        added.append(stage(path.select(F.col("owner").alias("conv"), "depth", *names), "path-totals"))
        moved = F.col("under") > 0
        forest = stage(
            marked.where("under <> 0").select(
                F.when(moved, F.col("piece")).otherwise(F.col("top_conv")).alias("top_conv"),
                F.when(moved, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
                *kept[2:],
            ),
            "forest",
        )
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)
    dealt = rest.repartition(common.width(spark), *top).sortWithinPartitions(*top, "depth", "conv").select(*kept)
    found = dealt.mapInArrow(_decomposed(len(names)), ", ".join(f"{c} bigint" for c in [*at, *names]))
    for more in added:
        found = found.unionByName(more)
    return found.groupBy(*at).agg(*[F.sum(n).alias(v) for n, v in zip(names, values)])


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, depth, member) to (conv, depth, first, ids), up to CHUNK ids of a node joined by commas."""
    key, ids, out = None, [], []

    def given() -> pa.RecordBatch:
        columns = [pa.array([o[i] for o in out], t) for i, t in enumerate([pa.int64()] * 3 + [pa.string()])]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "depth", "first", "ids"])

    for batch in batches:
        for conv, depth, member in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv, depth) != key or len(ids) == CHUNK:
                if ids:
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids = (conv, depth), []
            ids.append(member)
        yield given()
        out = []
    if ids:
        out.append((*key, ids[0], ",".join(map(str, ids))))
    yield given()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, depth, first, ids) to (conv, depth, digest). A digest takes its ids in order, so a node's
    list passes through one task, but never stands in its memory."""
    key, state, out = None, None, []

    def given() -> pa.RecordBatch:
        columns = [pa.array([o[i] for o in out], t) for i, t in enumerate([pa.int64(), pa.int64(), pa.string()])]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "depth", "digest"])

    for batch in batches:
        for conv, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (conv, depth) == key:
                state.update(b",")
            else:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (conv, depth), hashlib.sha256()
            state.update(ids.encode())
        yield given()
        out = []
    if key:
        out.append((*key, state.hexdigest()))
    yield given()


def end_digests(members: DataFrame) -> DataFrame:
    """(conv, depth, digest) of the nodes at which conversations end: SHA-256 of their ids, ascending, joined by commas."""
    width, at = common.width(members.sparkSession), ["conv", "depth"]
    last = members.groupBy("conv").agg(F.max("depth").alias("depth")).join(members, ["conv", "depth"])
    ends = last.select(F.col("owner").alias("conv"), "depth", F.col("conv").alias("member"))
    chunks = ends.repartitionByRange(width, *at, "member").sortWithinPartitions(*at, "member").mapInArrow(
        _joined_ids, "conv bigint, depth bigint, first bigint, ids string"
    )
    return chunks.repartition(width, *at).sortWithinPartitions(*at, "first").mapInArrow(_digests, "conv bigint, depth bigint, digest string")


def conversation_trie(turns: DataFrame, convs: DataFrame, component: int = COMPONENT) -> DataFrame:
    """One row for each node of the prefix trie of conversations, given as ``turns`` (conv, pos, a, b, chars; places
    without gaps from 1, see :func:`ordered_turns`) and ``convs`` (conv), which may have no turns.

    conv_id: the smallest member; depth; parent_conv_id: the parent's conv_id, null for the root; n_convs: members;
    n_children; and over the subtree, the node included, n_leaves: nodes without children; saved_tokens: the sum of
    (n_convs - 1) times the code points of the node's last text; ends_sha256: the digest of the ids of conversations
    that end there (:func:`end_digests`; of the empty string where none does).

    Null ids are no conversations. Null roles and texts are empty ones. Turns of a conversation with the same number
    stand in the order of role and text; repeated rows are turns of their own. Other columns are ignored. Without
    conversations there is no row, not even a root. Components of more than ``component`` nodes are split by jobs."""
    members, nodes = trie(turns, convs)
    zero = F.lit(0).cast("bigint")
    values = {
        "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
    }
    totals = rolled_up(nodes, members, values, component)
    none = F.sha2(F.lit("").cast("binary"), 256)
    found = nodes.join(totals, ["conv", "depth"]).join(end_digests(members), ["conv", "depth"], "left")
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("digest", none).alias("ends_sha256"),
    )


def distinct_conversations(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    return conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("conv")).distinct()


def with_shared_starts(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that many share their first turns: the first h turns of conversation c - c % 100 (all
    if it has fewer, none if it is absent), then the turns of c after its first h, with h = crc32(c) % 6."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    starts = turns.where("pos <= 5").select(F.col("conv").alias("base"), "pos", "a", "b", "chars")
    lengths = turns.where("pos <= 5").groupBy(F.col("conv").alias("base")).agg(F.max("pos").alias("have"))
    based = convs.select("conv", (F.col("conv") - F.col("conv") % 100).alias("base"), h.alias("h"))
    taken = based.join(starts, "base").where(F.col("pos") <= F.col("h")).select("conv", "pos", "a", "b", "chars")
    lengths = based.join(lengths, "base", "left").select("conv", "h", F.least("h", F.coalesce("have", F.lit(0))).alias("have"))
    own = turns.join(lengths, "conv").where(F.col("pos") > F.col("h")).withColumn("pos", F.col("pos") - F.col("h") + F.col("have"))
    return taken.unionByName(own.select("conv", "pos", "a", "b", "chars")), convs
