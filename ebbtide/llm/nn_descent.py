"""Near duplicates among embeddings by NN-descent.

Only vectors of the same label are compared, by cosine in double precision. Vectors within half the threshold angle of
a leader form a cell with it: all of them are linked for certain, whatever their number, and only the leader, the
cell's pivot, takes part in the search. The pivots' neighbour graph starts from buckets of random hyperplanes and is
refined round by round: every pivot's neighbours meet and each takes the closest it sees. Lists whose last neighbour
still lies close enough to matter are saturated and are enlarged. The recall of the edges that matter is audited by
exact search for a bounded set of pivots, and rounds go on until it is reached or nothing changes. Labels in which
it still isn't reached are searched exactly, block by block of pivots. Pairs of cells that lie close enough are opened:
their members are compared, counted and linked."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm import common
from ebbtide.session import stage

SLACK = 1e-9  # radians by which bounds are widened, for rounding


@dataclass(frozen=True)
class Search:
    """Settings: length of neighbour lists, tables of hyperplanes and pivots per bucket to start from, most rounds,
    recall to reach, pivots the audit asks exactly (a bound on what it sends to every task), and members of a cell and
    of a block that one task holds."""

    neighbours: int = 10
    tables: int = 4
    bucket: int = 48
    rounds: int = 6
    recall: float = 0.97
    audit: int = 2000
    cell: int = 4096
    block: int = 1024


def _vectors(batch: pa.RecordBatch, at: int) -> np.ndarray:
    raw = batch.column(at)
    if not len(raw):
        return np.zeros((0, 1))
    return np.frombuffer(b"".join(raw.to_pylist()), np.float64).reshape(len(raw), -1)


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, embedding) to (vec_id, label, dim, unit), invalid vectors with a null unit."""
    for batch in batches:
        dims, units = [], []
        for value in batch.column(2):
            x = None if not value.is_valid else value.values.to_numpy(zero_copy_only=False).astype(np.float64)
            norm = 0.0 if x is None or not len(x) or not np.isfinite(x).all() else float(np.linalg.norm(x / np.abs(x).max())) if x.any() else 0.0
            units.append((x / np.abs(x).max() / norm).tobytes() if norm > 0 else None)
            dims.append(0 if x is None else len(x))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
            names=["vec_id", "label", "dim", "unit"],
        )


def _signed(tables: int, bits: int):
    """Adds for each table the side of ``bits`` fixed random hyperplanes on which a vector lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            codes = []
            for dim, unit in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if dim not in planes:
                    planes[dim] = np.random.default_rng(dim).standard_normal((tables, max(bits, 1), dim))
                sides = planes[dim] @ np.frombuffer(unit, np.float64) > 0
                codes.append((sides * (1 << np.arange(max(bits, 1)))).sum(axis=1).tolist() if bits else [0] * tables)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(codes, pa.list_(pa.int64()))], names=["vec_id", "label", "dim", "unit", "codes"]
            )

    return run


def _cells(half: float, most: int):
    """Rows sorted by (label, dim, code) to (vec_id, pivot, angle): each joins the first leader within ``half``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, leaders, used = None, [], np.zeros((0, 1)), 0
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)))
            out = []
            for vec, label, dim, unit, code in rows:
                x = np.frombuffer(unit, np.float64)
                if (label, dim, code) != key or used == most:
                    key, ids, leaders, used = (label, dim, code), [], np.zeros((64, dim)), 0
                cos = leaders[:used] @ x
                near = np.flatnonzero(cos >= math.cos(half))
                if len(near):
                    best = int(near[np.argmax(cos[near])])
                    out.append((vec, ids[best], float(np.arccos(min(1.0, cos[best])))))
                    continue
                if used == len(leaders):
                    leaders = np.concatenate([leaders, np.zeros_like(leaders)])
                leaders[used], used = x, used + 1
                ids.append(vec)
                out.append((vec, vec, 0.0))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate([pa.int64(), pa.int64(), pa.float64()])], names=["vec_id", "pivot", "angle"])

    return run


def _meet(keep: float):
    """Rows (hub, vec_id, size, unit) sorted by hub: all that share a hub meet; (a, b, cos) of the closest of each.

    ``size`` is the length of a row's list. Pairs of at least ``keep`` are always given."""

    def pairs(ids: np.ndarray, sizes: np.ndarray, x: np.ndarray):
        cos = x @ x.T
        np.fill_diagonal(cos, -2.0)
        wanted = np.minimum(sizes, len(ids) - 1)
        order = np.argsort(-cos, axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.broadcast_to(np.arange(len(ids)), order.shape), axis=1)
        a, b = np.nonzero(((rank < wanted[:, None]) | (cos >= keep)) & (cos > -2))
        distinct = ids[a] != ids[b]
        return ids[a[distinct]], ids[b[distinct]], cos[a, b][distinct]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, held = None, []

        def close():
            if len(held) < 2:
                return None
            ids, sizes = (np.array([h[i] for h in held]) for i in range(2))
            return pairs(ids, sizes, np.stack([np.frombuffer(h[2], np.float64) for h in held]))

        def emitted(parts):
            parts = [p for p in parts if p is not None]
            a, b, c = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(3))
            return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(c, pa.float64())], names=["a", "b", "cos"])

        for batch in batches:
            parts = []
            for own, vec, size, unit in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if own != hub:
                    parts.append(close())
                    hub, held = own, []
                held.append((vec, size, unit))
            yield emitted(parts)
        yield emitted([close()])

    return run


def _meetings(hubs: DataFrame, pivots: DataFrame, keep: float) -> DataFrame:
    """Candidate edges of the pivots (hub, vec_id, size) that share a hub."""
    rows = hubs.join(pivots.select("vec_id", "unit"), "vec_id").select("hub", "vec_id", "size", "unit")
    return (
        rows.repartition(common.width(hubs.sparkSession), "hub")
        .sortWithinPartitions("hub", "vec_id")
        .mapInArrow(_meet(keep), "a bigint, b bigint, cos double")
    )


def _closest(edges: DataFrame, sizes: DataFrame, keep: float) -> DataFrame:
    """For each pivot its ``size`` closest neighbours and all of at least ``keep``."""
    own = Window.partitionBy("a").orderBy(F.desc("cos"), "b")
    ranked = edges.dropDuplicates(["a", "b"]).withColumn("rank", F.row_number().over(own))
    joined = ranked.join(sizes.withColumnRenamed("vec_id", "a"), "a")
    return joined.where((F.col("rank") <= F.col("size")) | (F.col("cos") >= keep)).select("a", "b", "cos")


def _audit(asked, keep: float):
    """Rows (vec_id, label, dim, unit) against the audited pivots: the exact edges (a, b) of at least ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = asked.value
        for batch in batches:
            labels, dims, ids = (np.array(batch.column(i).to_pylist(), dtype=np.int64) for i in (1, 2, 0))
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for (label, dim), (own, units) in groups.items():
                rows = np.flatnonzero((labels == label) & (dims == dim))
                if not len(rows):
                    continue
                x = np.frombuffer(b"".join(batch.column(3).take(pa.array(rows)).to_pylist()), np.float64).reshape(len(rows), -1)
                i, j = np.nonzero(units @ x.T >= keep)
                other = own[i] != ids[rows[j]]
                a.append(own[i][other])
                b.append(ids[rows[j]][other])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def _opened(threshold: float):
    """Rows (cell, piece, role, vec_id, own, unit), a piece's members first: (vec_id, own, cell, n) linked members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for batch in batches:
            out = []
            for cell, piece, salt, role, vec, own, unit in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if (cell, piece, salt) != key:
                    key, held, block = (cell, piece, salt), [], None
                x = np.frombuffer(unit, np.float64)
                if role == 0:
                    held.append(x)
                elif held:
                    block = np.stack(held) if block is None else block
                    n = int((block @ x >= threshold).sum())
                    if n:
                        out.append((vec, own, cell, n))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(4)], names=["vec_id", "own", "cell", "n"])

    return run


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", search: Search = Search()
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each vector: how many others have the same label and a cosine of at
    least ``threshold`` (0.71 to 1) among those found, the smallest id reachable over such links, and whether it is
    its own.

    Null, empty and zero vectors, vectors with a null or non-finite component, and vectors without a label link with
    nothing; vectors of different lengths do not link. Repeated vectors link with each other. Ids are integers and
    are expected once; a row without an id links with nothing and has no component. Other columns are ignored. No
    reported link lies below the threshold; those found are at least ``search.recall`` of all by the audit's figures
    for each label it asks, whatever ``search.rounds``."""
    spark = vectors.sparkSession
    half = math.acos(min(1.0, threshold)) / 2
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), vector_col)
    units = stage(rows.mapInArrow(_units, "vec_id bigint, label bigint, dim int, unit binary"), "units")
    valid = units.where("unit IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL")
    largest = valid.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(largest, 1) / search.bucket)))
    signed = stage(valid.mapInArrow(_signed(search.tables, bits), "vec_id bigint, label bigint, dim int, unit binary, codes array<bigint>"), "signed")

    # Cells. Large buckets of a table are dealt over several tasks; a dense place then has a few cells instead of one.
    place = ["label", "dim", "code"]
    coded = signed.select("vec_id", "label", "dim", "unit", F.get("codes", F.lit(0)).alias("code"))
    parts = coded.groupBy(*place).agg(F.ceil(F.count("*") / search.cell).alias("parts"))
    dealt = coded.join(parts, place).withColumn("code", F.col("code") + (1 << 40) * F.pmod(F.xxhash64("vec_id"), "parts"))
    dealt = dealt.select("vec_id", "label", "dim", "unit", "code")
    cells = stage(
        dealt.repartition(common.width(spark), *place).sortWithinPartitions(*place, "vec_id").mapInArrow(_cells(half - SLACK, search.cell), "vec_id bigint, pivot bigint, angle double"),
        "cells",
    )
    spans = cells.groupBy("pivot").agg(F.count("*").alias("members"), F.max("angle").alias("radius"))
    pivots = stage(signed.join(spans.withColumnRenamed("pivot", "vec_id"), "vec_id"), "pivots")
    widest = spans.agg(F.max("radius")).first()[0] or 0.0
    keep = math.cos(min(math.pi / 2, 2 * half + 2 * widest + SLACK))

    edges = _graph(pivots, keep, search)
    return _counted(units, signed, cells, edges, threshold)


def _graph(pivots: DataFrame, keep: float, search: Search) -> DataFrame:
    """Edges (a, b) of at least ``keep`` between pivots, both ways."""
    sizes = pivots.select("vec_id", F.lit(search.neighbours).alias("size"))
    # Buckets of each table, dealt into blocks of bounded size.
    placed = pivots.select("vec_id", "label", "dim", F.posexplode("codes").alias("table", "code"))
    where = ["label", "dim", "table", "code"]
    blocks = placed.groupBy(*where).agg(F.ceil(F.count("*") / (4 * search.bucket)).alias("blocks"))
    hub = F.xxhash64(*where, F.pmod(F.xxhash64("vec_id", "table"), "blocks"))
    first = placed.join(blocks, where).select(hub.alias("hub"), "vec_id").join(sizes, "vec_id")
    graph = stage(_closest(_meetings(first, pivots, keep), sizes, keep), "graph")
    truth = _exact(pivots, keep, search)
    low, known = _below(graph, truth, search), -1
    for _ in range(search.rounds):
        now = graph.where(F.col("cos") >= keep).count()
        if not low or now == known:
            break
        known = now
        full = graph.where(F.col("cos") >= keep).groupBy("a").count().where(F.col("count") >= search.neighbours)
        sizes = sizes.join(full.select(F.col("a").alias("vec_id"), F.lit(True).alias("saturated")), "vec_id", "left").select(
            "vec_id", F.when(F.col("saturated"), F.col("size") * 2).otherwise(F.col("size")).alias("size")
        )
        both = graph.select(F.col("a").alias("hub"), F.col("b").alias("vec_id")).union(graph.select(F.col("b").alias("hub"), F.col("a").alias("vec_id")))
        both = both.union(pivots.select(F.col("vec_id").alias("hub"), "vec_id")).distinct()
        # A pivot that very many name as neighbour is several hubs, each of bounded size.
        counts = both.groupBy("hub").agg(F.ceil(F.count("*") / (8 * search.bucket)).alias("parts"))
        hubs = both.join(counts, "hub").select(F.xxhash64("hub", F.pmod(F.xxhash64("vec_id"), "parts")).alias("hub"), "vec_id").join(sizes, "vec_id")
        graph = stage(_closest(graph.union(_meetings(hubs, pivots, keep)), sizes, keep), "graph")
        low = _below(graph, truth, search)
    near = graph.where(F.col("cos") >= keep).select("a", "b")
    if low:
        near = near.union(stage(_blockwise(pivots.join(_below_rows(graph, truth, search), ["label", "dim"], "left_semi"), keep, search), "exact-edges"))
    return near.union(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def _exact(pivots: DataFrame, keep: float, search: Search) -> DataFrame:
    """Exact edges (a, b, label, dim) of at most ``search.audit`` pivots, chosen by a digest of their ids."""
    spark = pivots.sparkSession
    drawn = F.xxhash64("vec_id", F.lit(3))
    chosen = pivots.where(drawn <= common.sample_cut(pivots, drawn, search.audit))
    groups: dict[tuple[int, int], list] = {}
    for r in chosen.select("vec_id", "label", "dim", "unit").toLocalIterator():
        groups.setdefault((r["label"], r["dim"]), []).append((r["vec_id"], np.frombuffer(r["unit"], np.float64)))
    sent = spark.sparkContext.broadcast({k: (np.array([i for i, _ in v]), np.stack([x for _, x in v])) for k, v in groups.items()})
    truth = pivots.select("vec_id", "label", "dim", "unit").mapInArrow(_audit(sent, keep), "a bigint, b bigint")
    return stage(truth.join(pivots.select(F.col("vec_id").alias("a"), "label", "dim"), "a"), "audit")


def _below_rows(graph: DataFrame, truth: DataFrame, search: Search) -> DataFrame:
    """The (label, dim) of which the graph holds less than the wanted share of the audited edges."""
    found = graph.select("a", "b").union(graph.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    marked = truth.join(found.withColumn("hit", F.lit(1)), ["a", "b"], "left").groupBy("label", "dim")
    return marked.agg((F.coalesce(F.sum("hit"), F.lit(0)) / F.count("*")).alias("recall")).where(F.col("recall") < search.recall)


def _below(graph: DataFrame, truth: DataFrame, search: Search) -> bool:
    return not _below_rows(graph, truth, search).isEmpty()


def _grown(block: np.ndarray | None, held: list[np.ndarray]) -> np.ndarray:
    """``held`` as rows of an array with room for more."""
    if block is not None and len(held) <= len(block):
        block[len(held) - 1] = held[-1]
        return block
    return np.concatenate([np.stack(held), np.zeros((len(held), len(held[0])))])


def _met(keep: float):
    """Rows (label, dim, i, j, side, vec_id, unit), block i of a pair before block j: edges (a, b) between the blocks, or
    inside the block where there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, held, block = None, [], [], None
        for batch in batches:
            a, b = [], []
            for *own, side, vec, unit in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if own != key:
                    key, ids, held, block = own, [], [], None
                x = np.frombuffer(unit, np.float64)
                if key[2] == key[3] or side == 1:
                    if held and key[2] == key[3]:
                        block = _grown(block, held)
                    elif held and block is None:
                        block = np.stack(held)
                    near = np.flatnonzero(block[: len(held)] @ x >= keep) if held else []
                    a += [ids[k] for k in near]
                    b += [vec] * len(near)
                if side == 0:
                    ids.append(vec)
                    held.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _blockwise(pivots: DataFrame, keep: float, search: Search) -> DataFrame:
    """All edges (a, b) of at least ``keep`` among pivots of the same label: every block of pivots meets every block."""
    spark, group, pair = pivots.sparkSession, ["label", "dim"], ["label", "dim", "i", "j"]
    sizes = pivots.groupBy(*group).agg(F.ceil(F.count("*") / search.block).cast("int").alias("blocks"))
    own = pivots.join(sizes, group).withColumn("own", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *group, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "vec_id", "unit"
    )
    return dealt.repartition(common.width(spark), *pair).sortWithinPartitions(*pair, "side", "vec_id").mapInArrow(_met(keep), "a bigint, b bigint")


def _counted(units: DataFrame, signed: DataFrame, cells: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    spark = units.sparkSession
    piece, salt = 1024, 4096
    counts = cells.groupBy("pivot").agg(F.count("*").alias("members"))
    wanted = edges.select(F.col("a").alias("own"), F.col("b").alias("cell"))
    touched = edges.select(F.col("a").alias("pivot")).distinct()
    inside = stage(
        cells.join(touched, "pivot", "left_semi").join(signed.select("vec_id", "unit"), "vec_id").join(counts, "pivot").select("pivot", "vec_id", "unit", "members"),
        "opened-cells",
    )
    pieces = inside.select(
        F.col("pivot").alias("cell"), F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("members") / piece)).cast("bigint").alias("piece"), "vec_id", "unit"
    )
    have = pieces.select("cell", "piece").distinct()
    queries = wanted.join(inside.select(F.col("pivot").alias("own"), "vec_id", "unit"), "own").join(have, "cell")
    load = queries.groupBy("cell", "piece").agg(F.ceil(F.count("*") / salt).cast("bigint").alias("salts"))
    asked = queries.join(load, ["cell", "piece"]).select(
        "cell", "piece", F.pmod(F.xxhash64("vec_id"), "salts").cast("bigint").alias("salt"), F.lit(1).alias("role"), "vec_id", "own", "unit"
    )
    held = pieces.join(load, ["cell", "piece"]).select(
        "cell", "piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), "vec_id", F.col("cell").alias("own"), "unit"
    )
    order = ["cell", "piece", "salt"]
    hits = stage(
        held.union(asked).repartition(common.width(spark), *order).sortWithinPartitions(*order, "role", "vec_id").mapInArrow(
            _opened(threshold), "vec_id bigint, own bigint, cell bigint, n bigint"
        ),
        "cell-links",
    )
    joined = stage(common.components(hits.select(F.col("own").alias("a"), F.col("cell").alias("b")).distinct()), "cell-components")
    across = hits.groupBy("vec_id").agg(F.sum("n").alias("across"))
    named = cells.join(joined.withColumnRenamed("id", "pivot"), "pivot", "left").select("vec_id", "pivot", F.coalesce("component", "pivot").alias("root"))
    roots = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    linked = named.join(roots, "root").join(counts, "pivot").join(across, "vec_id", "left").select(
        "vec_id", (F.col("members") - 1 + F.coalesce("across", F.lit(0))).alias("n_links"), "component_id"
    )
    return (
        units.select("vec_id")
        .join(linked, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
        )
    )
