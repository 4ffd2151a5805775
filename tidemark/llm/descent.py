"""Near-duplicate vectors by NN-descent.

A first neighbour graph comes from random cells; then, round by round, each vector's neighbours are compared with one
another and what is nearer replaces what was listed. Links at the threshold join vectors to components after every round. A list that
is saturated by members of its own component is enlarged: it keeps as many places again for the nearest vectors outside, and only
pairs of different components are compared, so that a large group of near-equal vectors costs no more per vector than others.
Each round also lists neighbours from a few new random cells. Rounds end when one has found no new link and an audit is passed: for
a bounded random set of all vectors, and one of those linked, brute force tells what share of their links lies within components. An
audit failed after the last round is an error. Last, the members of each component are compared in blocks, which counts links exactly
without writing pairs. Equal vectors are one class throughout.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.shipping import ship_package
from tidemark.llm.components import components
from tidemark.llm.staging import written

#: Neighbours listed within a component and as many outside, random cells per vector, vectors of a cell.
NEIGHBOURS, TABLES, CELL = 12, 8, 192
#: Random cells per vector drawn anew in each round, so that a list which leads nowhere gets another start.
FRESH = 2
#: Rounds at least and at most; audited vectors of all and of those linked; mean share of their links that an audit asks for.
ROUNDS, AUDITED, RECALL = (2, 12), (1024, 256), 0.99
#: Vectors of a block in the last comparison.
BLOCK = 256
THRESHOLD = 0.9


def _unit(vectors: list[bytes], kind: str) -> np.ndarray:
    """Vectors of length one, in double precision, from their components as the table holds them."""
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype("<f8")
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole runs of equal `key` from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(key)
        last = column[-1].as_py()
        rows = column.to_pylist()
        at = batch.num_rows
        while at > 0 and rows[at - 1] == last:
            at -= 1
        if held and held[-1].column(key)[-1].as_py() != rows[0]:
            yield pa.Table.from_batches(held)
            held = []
        if at:
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = []
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _runs(values: list) -> list[tuple[int, int]]:
    edges = [0, *(i for i in range(1, len(values)) if values[i] != values[i - 1]), len(values)]
    return list(zip(edges, edges[1:], strict=False)) if values else []


_FOUND = pa.schema({"node": pa.binary(), "other": pa.binary(), "sim": pa.float64()})


def _nearest(nodes: pa.Array, unit: np.ndarray, label: np.ndarray, least: np.ndarray, most: int) -> pa.RecordBatch:
    """For each vector its nearest of the others here with another label, above `least`, `most` at most."""
    sims = unit @ unit.T
    sims[label[:, None] == label[None, :]] = -2.0
    most = min(most, len(nodes))
    top = np.argpartition(sims, -most, axis=1)[:, -most:]
    near = np.take_along_axis(sims, top, 1)
    i, j = np.nonzero(near > least[:, None])
    return pa.record_batch([nodes.take(pa.array(i)), nodes.take(pa.array(top[i, j])), pa.array(near[i, j])], schema=_FOUND)


def _kind(vectors: DataFrame) -> str:
    """Floats travel as floats; cosines are computed in double precision of what the table holds."""
    return "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"


def classes(vectors: DataFrame) -> DataFrame:
    """vec_id, node (digest of a usable vector, else null), v (its components, floats or doubles); written."""
    ship_package()
    form = _kind(vectors)
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, v = [], []
            for vector in batch.column("embedding").to_pylist():
                x = np.array([np.nan if c is None else c for c in vector or [np.nan]], "<f8") + 0.0
                norm = math.sqrt(float((x * x).sum())) if np.isfinite(x).all() else 0.0
                usable = norm > 0 and math.isfinite(norm)
                v.append(x.astype(form).tobytes() if usable else None)
                node.append(hashlib.md5(v[-1]).digest() if usable else None)
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "node": pa.array(node, pa.binary()), "v": pa.array(v, pa.binary())})

    schema = f"vec_id {kind}, node binary, v binary"
    return written(vectors.select("vec_id", "embedding").mapInArrow(run, schema), "vectors")


def _cells(points: DataFrame, n: int, neighbours: int, kind: str, tables: range) -> DataFrame:
    """Nearest within random cells: signs of random projections name a cell, a large cell is cut into random blocks."""
    bits = max(0, math.ceil(math.log2(max(n, 1) / CELL)))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column("v").to_pylist(), kind)
            for table in tables:
                plane = np.random.default_rng(table).standard_normal((x.shape[1], bits))
                code = ((x @ plane > 0) @ (1 << np.arange(bits))).astype(np.int64) * (TABLES + FRESH * ROUNDS[1]) + table
                yield pa.record_batch({"cell": pa.array(code), "node": batch.column("node"), "v": batch.column("v")})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "cell"):
            table = table.combine_chunks()
            for low, high in _runs(table.column("cell").to_pylist()):
                for at in range(low, high, 2 * CELL):  # blocks of a run: only the first guess is local to them
                    part = table.slice(at, min(2 * CELL, high - at))
                    size = part.num_rows
                    unit = _unit(part.column("v").to_pylist(), kind)
                    yield _nearest(part.column("node").combine_chunks(), unit, np.arange(size), np.full(size, -1.5), neighbours)

    dealt = points.mapInArrow(cells, "cell long, node binary, v binary").withColumn("place", F.xxhash64("cell", "node"))
    # The hash of cell and vector deals out a cell that holds very many, anew in each table.
    dealt = dealt.repartition("cell", F.pmod("place", F.lit(max(1, n // 20_000)))).sortWithinPartitions("cell", "place")
    return dealt.mapInArrow(compare, "node binary, other binary, sim double")


def _kept(found: DataFrame, labels: DataFrame, neighbours: int) -> DataFrame:
    """node, other, sim, inside: the nearest of each node, `neighbours` of its own component and as many outside."""
    once = found.groupBy("node", "other").agg(F.max("sim").alias("sim")).join(labels, "node")
    once = once.join(labels.toDF("other", "beyond"), "other").withColumn("inside", F.col("label") == F.col("beyond"))
    rank = F.row_number().over(Window.partitionBy("node", "inside").orderBy(F.desc("sim"), "other"))
    return once.withColumn("rank", rank).where(F.col("rank") <= neighbours).select("node", "other", "sim", "inside")


def _round(graph: DataFrame, points: DataFrame, labels: DataFrame, neighbours: int, seed: int, kind: str) -> DataFrame:
    """One step of the descent: of each vector's neighbours, listed by it or listing it, twice `neighbours` at most and anew in each
    round, those of different components are compared with each other and with it."""
    both = graph.select(F.col("node").alias("center"), F.col("other").alias("node")).union(
        graph.select(F.col("other").alias("center"), "node")
    )
    order = F.xxhash64("center", "node", F.lit(seed))
    pick = F.row_number().over(Window.partitionBy("center").orderBy(order))
    picked = both.distinct().withColumn("pick", pick).where(F.col("pick") <= 2 * neighbours).select("center", "node")
    picked = picked.union(points.select(F.col("node").alias("center"), "node"))
    state = graph.where("NOT inside").groupBy("node").agg(F.min("sim").alias("worst"), F.count("*").alias("listed"))
    least = F.when(F.col("listed") >= neighbours, F.col("worst")).otherwise(F.lit(-1.5))
    member = points.join(labels, "node").join(state, "node", "left").select("node", "v", "label", least.alias("least"))
    rows = picked.join(member, "node").repartition("center").sortWithinPartitions("center")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "center"):
            table = table.combine_chunks()
            nodes = table.column("node").combine_chunks()
            label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
            unit, least = _unit(table.column("v").to_pylist(), kind), table.column("least").to_numpy()
            for low, high in _runs(table.column("center").to_pylist()):
                if high - low > 1:
                    yield _nearest(nodes.slice(low, high - low), unit[low:high], label[low:high], least[low:high], neighbours)

    return rows.select("center", "node", "v", "label", "least").mapInArrow(compare, "node binary, other binary, sim double")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame | None:
    """labels with the components that links between different ones join; None if there is no such link."""
    ends = links.join(labels, "node").join(labels.toDF("other", "beyond"), "other").where("label != beyond")
    edges = written(ends.select(F.col("label").alias("a"), F.col("beyond").alias("b")).distinct(), "joining")
    if not edges.limit(1).count():
        return None
    moved = components(edges).toDF("label", "into")
    return written(labels.join(moved, "label", "left").select("node", F.coalesce("into", "label").alias("label")), "labels")


def _recall(points: DataFrame, labels: DataFrame, threshold: float, seed: int, kind: str) -> float:
    """Mean over audited vectors that have links of the share of these, found by brute force, that lie within components."""
    grouped = labels.groupBy("label").agg(F.count("*").alias("size")).where("size > 1").select("label")
    linked = points.join(labels.join(grouped, "label"), "node").select("node", "v", "label")
    draw = F.xxhash64("node", F.lit(seed))
    chosen = points.join(labels, "node").select("node", "v", "label").orderBy(draw, "node").limit(AUDITED[0]).collect()  # bounded sets of queries
    chosen = list({bytes(r["node"]): r for r in [*chosen, *linked.orderBy(draw, "node").limit(AUDITED[1]).collect()]}.values())
    if not chosen:
        return 1.0
    names, of = [bytes(r["node"]) for r in chosen], [bytes(r["label"]) for r in chosen]
    queries = _unit([r["v"] for r in chosen], kind)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _unit(batch.column("v").to_pylist(), kind) @ queries.T >= threshold
            node, label = batch.column("node").to_pylist(), batch.column("label").to_pylist()
            all_, held = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
            for i, j in zip(*np.nonzero(near), strict=True):
                if node[i] != names[j]:
                    all_[j] += 1
                    held[j] += label[i] == of[j]
            at = np.flatnonzero(all_)
            yield pa.record_batch({"query": pa.array(at), "links": pa.array(all_[at]), "held": pa.array(held[at])})

    found = points.join(labels, "node").select("node", "v", "label").mapInArrow(links, "query long, links long, held long")
    each = found.groupBy("query").agg((F.sum("held") / F.sum("links")).alias("share"))
    share = each.agg(F.avg("share")).first()[0]
    return 1.0 if share is None else share


def _counted(members: DataFrame, threshold: float, kind: str) -> DataFrame:
    """node, n: the links of each class to rows of other classes in its component, compared block against block."""
    sizes = members.groupBy("component").agg(F.count("*").alias("n"))
    placed = members.join(sizes, "component").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # Block i meets block j in cell (least, greatest): every member goes to as many cells as its component has blocks.
    cells = placed.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select(
        F.xxhash64("component", F.least("block", "mate"), F.greatest("block", "mate")).alias("cell"),
        "component", "node", "v", "copies", "block", (F.col("block") == F.col("mate")).alias("own"),
    )
    rows = cells.repartition("cell").sortWithinPartitions("cell", "component", "block")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "cell"):
            table = table.combine_chunks()
            nodes, block = table.column("node").to_pylist(), table.column("block").to_numpy()
            copies, own = table.column("copies").to_numpy(), table.column("own").to_numpy(zero_copy_only=False)
            unit = _unit(table.column("v").to_pylist(), kind)
            names = list(zip(table.column("cell").to_pylist(), table.column("component").to_pylist(), strict=True))
            for low, high in _runs(names):
                x, k, alone = unit[low:high], copies[low:high], bool(own[low])
                near = (x @ x.T) >= threshold
                np.fill_diagonal(near, False)
                if not alone:
                    near &= block[low:high, None] != block[None, low:high]
                yield pa.record_batch({"node": pa.array(nodes[low:high], pa.binary()), "n": pa.array(near @ k.astype(np.int64))})

    return rows.mapInArrow(compare, "node binary, n long").groupBy("node").agg(F.sum("n").alias("n"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS) -> DataFrame:
    """One row per row of vectors: vec_id, n_links (other rows at cosine >= threshold), component_id, kept.

    Cosines are computed in double precision. A vector that is null, zero, or holds null or non-finite components links
    with nothing; so does a row without vec_id, whose component_id is null and which is kept. Equal vectors link with each
    other. Rows of one vec_id are rows of their own. All vectors must have one length; other columns are ignored.
    An empty table gives no rows. Ties for a list's last place go to the smaller digest.
    """
    rows = classes(vectors)
    usable = rows.where("node IS NOT NULL AND vec_id IS NOT NULL")
    points = usable.groupBy("node").agg(F.first("v").alias("v"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    points = written(points, "points")
    n = points.count()
    bare, kind = points.select("node", "v"), _kind(vectors)
    labels = points.select("node", F.col("node").alias("label"))
    found = written(_cells(bare, n, neighbours, kind, range(TABLES)), "found")
    graph, number = None, 0
    while True:
        joined = _joined(labels, found.where(F.col("sim") >= threshold).select("node", "other"))
        labels = labels if joined is None else joined
        if number >= ROUNDS[1] or (number >= ROUNDS[0] and joined is None):
            recall = _recall(bare, labels, threshold, number, kind)
            if recall >= RECALL:
                break
            if number >= ROUNDS[1]:
                raise RuntimeError(f"after {number} rounds, components hold {recall:.3f} of the links of audited vectors")
        listed = found if graph is None else graph.select("node", "other", "sim").union(found)
        graph = written(_kept(listed, labels, neighbours), "graph")
        fresh = TABLES + FRESH * number
        anew = _cells(bare, n, neighbours, kind, range(fresh, fresh + FRESH))
        found = written(_round(graph, bare, labels, neighbours, number, kind).union(anew), "found")
        number += 1
    sizes = labels.groupBy(F.col("label").alias("component")).agg(F.count("*").alias("size")).where("size > 1").select("component")
    groups = labels.select("node", F.col("label").alias("component")).join(sizes, "component")
    members = written(groups.join(points, "node"), "members")
    counted = _counted(members, threshold, kind)
    lowest = members.groupBy("component").agg(F.min("low").alias("component_id"))
    known = members.select("node", "component").join(lowest, "component").join(counted, "node", "left")
    every = points.select("node", "copies", "low").join(known.select("node", "component_id", "n"), "node", "left")
    every = every.select(
        "node", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "low").alias("component_id")
    )
    out = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("node")).alias("node")).join(every, "node", "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
