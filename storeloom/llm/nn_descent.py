"""Near-duplicate vectors by NN-descent: refine a neighbour graph until it stands still, keep the edges at the threshold.

Equal vectors are one class. The first graph links classes that lie next to each other when ordered by the
signs of random projections, in several orders. A refining step brings all neighbours of a node together (in both
directions), compares them with each other in the node's task and offers every node the better ones; lists keep the
``width`` best. Every edge at or above the threshold that is ever seen is kept besides, whatever the lists hold. A node
whose whole list is at or above the threshold is saturated: its list is enlarged to its whole component, compared in
blocks, so that no member is missed and no block is larger than BLOCK vectors squared. Recall is audited by comparing
sampled vectors with all others, until the sample shows that it is above or below the goal; few links need a large
sample, at most all vectors. Below the goal, refining goes on with lists twice as wide; after ``rounds`` attempts all
vectors are compared in blocks instead, which is exact and quadratic.

Cosines are computed in double precision from the vectors as given. Defined cases: null, empty or zero vectors and those
with null or non-finite components link with nothing; vectors of different length do not link; a null id links like
any other, and a component of null ids only has a null id. Repeated rows are equal vectors. Extra columns are ignored.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeloom.llm.components import components
from storeloom.scratch import stage

THRESHOLD = 0.95
WIDTH = 10
ORDERS = 6
SIGN_BITS = 24
REACH = 6
BLOCK = 1024
AUDITED = 256
MOST_AUDITED = 8  # slices of AUDITED vectors in one pass
GOAL = 0.95
EDGES = "src long, dst long, sim double"

log = logging.getLogger(__name__)


def unit(vector: list | None) -> np.ndarray | None:
    """The vector scaled to length one, or None if it cannot link."""
    if not vector or any(x is None for x in vector):
        return None
    values = np.array(vector, dtype=np.float64)
    if not np.isfinite(values).all():
        return None
    largest = np.abs(values).max()
    if largest == 0:
        return None
    values = values / largest
    return values / np.sqrt((values * values).sum())


def _unpack(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype=np.float64) for v in column.to_pylist()]


def _scan(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(place, id, key, unit): a number, the id, a hash of the vector as given and the vector of length one (or null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys, units = [], []
            for v in batch.column("v").to_pylist():
                u = unit(v)
                keys.append(None if u is None else xxhash.xxh3_128_digest((np.array(v, dtype=np.float64) + 0.0).tobytes()))
                units.append(None if u is None else u.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(place, place + batch.num_rows), pa.int64()), batch.column("id"),
                 pa.array(keys, pa.binary()), pa.array(units, pa.binary())], names=["place", "id", "key", "unit"])
            place += batch.num_rows

    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "place long, id long, key binary, unit binary")


def _pairs(src: np.ndarray, dst: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    """Edges in both directions."""
    return pa.RecordBatch.from_arrays([pa.array(np.r_[src, dst]), pa.array(np.r_[dst, src]), pa.array(np.r_[sim, sim])],
                                      names=["src", "dst", "sim"])


def _first_graph(classes: DataFrame, orders: int, seed: int) -> DataFrame:
    """Edges between classes that stand at most REACH places apart in an order by signs of projections."""
    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _unpack(batch.column("unit"))
            sizes = np.array([len(u) for u in units])
            out = []
            for dim in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == dim)
                stacked = np.stack([units[i] for i in mine])
                planes = np.random.default_rng(seed * 1000 + dim).standard_normal((dim, orders * SIGN_BITS))
                bits = (stacked @ planes > 0).reshape(len(mine), orders, SIGN_BITS)
                code = bits @ (1 << np.arange(SIGN_BITS - 1, -1, -1, dtype=np.int64))
                for o in range(orders):
                    out.append((np.full(len(mine), o, np.int32), np.full(len(mine), dim, np.int32), code[:, o], mine))
            if out:
                order, dims, code, at = (np.concatenate(x) for x in zip(*out, strict=True))
                chosen = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(order), pa.array(dims), pa.array(code), chosen.column("class"),
                                                  chosen.column("unit")], names=["o", "dim", "code", "class", "unit"])

    coded = classes.select("class", "unit").mapInArrow(signs, "o int, dim int, code long, class long, unit binary")
    ordered = coded.repartitionByRange("o", "dim", "code", "class").sortWithinPartitions("o", "dim", "code", "class")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, np.ndarray]] = []
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("o", "dim", "class")], _unpack(batch.column("unit")), strict=True))
            rows = held + rows
            fresh = len(held)
            src, dst, sim = [], [], []
            groups = np.array([r[0] * 1_000_003 + r[1] for r in rows])
            for group in np.unique(groups).tolist():
                mine = np.flatnonzero(groups == group)
                stacked = np.stack([rows[i][3] for i in mine])
                ids = np.array([rows[i][2] for i in mine], dtype=np.int64)
                for step in range(1, REACH + 1):
                    new = mine[step:] >= fresh
                    src.append(ids[:-step][new])
                    dst.append(ids[step:][new])
                    sim.append((stacked[:-step] * stacked[step:]).sum(axis=1)[new])
            if src:
                yield _pairs(*(np.concatenate(x) for x in (src, dst, sim)))
            held = rows[-REACH:]

    return ordered.mapInArrow(windows, EDGES)


def _best(edges: DataFrame, width: int) -> DataFrame:
    """The ``width`` best neighbours of each node; the row number is cut before the shuffle."""
    ranked = Window.partitionBy("src").orderBy(F.desc("sim"), "dst")
    return (edges.where("src <> dst").dropDuplicates(["src", "dst"])
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= width).drop("rank"))


def _refine(graph: DataFrame, classes: DataFrame, width: int, threshold: float) -> DataFrame:
    """Edges between neighbours of a common node that would improve a list, or reach the threshold."""
    back = graph.select(F.col("dst").alias("node"), F.col("src").alias("member"), "sim")
    ranked = Window.partitionBy("node").orderBy(F.desc("sim"), "member")
    back = back.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= width).drop("rank")
    around = graph.select(F.col("src").alias("node"), F.col("dst").alias("member"), "sim").unionByName(back).select("node", "member")
    weakest = graph.groupBy("src").agg(F.when(F.count("*") >= width, F.min("sim")).otherwise(-1.0).alias("least"))
    gathered = (around.distinct().join(classes.select(F.col("class").alias("member"), "unit"), "member")
                .join(weakest.select(F.col("src").alias("member"), "least"), "member", "left")
                .select("node", "member", F.coalesce("least", F.lit(-1.0)).alias("least"), "unit"))
    dealt = gathered.repartition("node").sortWithinPartitions("node")

    def local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def compare(members: list[int], least: list[float], units: list[np.ndarray]) -> None:
            if len(members) < 2 or len({len(u) for u in units}) > 1:
                return
            stacked, ids, floor = np.stack(units), np.array(members, dtype=np.int64), np.array(least)
            sims = stacked @ stacked.T
            a, b = np.nonzero(np.triu((sims > np.minimum(floor[:, None], floor[None, :])) | (sims >= threshold - 1e-9), 1))
            kept.append((ids[a], ids[b], sims[a, b]))

        node, members, least, units = None, [], [], []
        for batch in batches:
            for n, m, f, u in zip(*[batch.column(c).to_pylist() for c in ("node", "member", "least")],
                                  _unpack(batch.column("unit")), strict=True):
                if n != node:
                    compare(members, least, units)
                    node, members, least, units = n, [], [], []
                members.append(m)
                least.append(f)
                units.append(u)
            if kept:
                yield _pairs(*(np.concatenate(x) for x in zip(*kept, strict=True)))
                kept = []
        compare(members, least, units)
        if kept:
            yield _pairs(*(np.concatenate(x) for x in zip(*kept, strict=True)))

    return dealt.mapInArrow(local_join, EDGES).groupBy("src", "dst").agg(F.max("sim").alias("sim"))


def _block_links(members: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(class, linked): number of vectors linked to each class within its component (component, class), in blocks."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = (members.join(sizes, "component")
              .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
              .join(classes.select("class", "unit", "copies"), "class"))
    # A block meets every block of its component once, as the left or the right side.
    spread = placed.select("component", "class", "unit", "copies", "block",
                           F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = spread.select("component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                          "block", "class", "copies", "unit")

    def compare(table: pa.Table) -> pa.Table:
        block, low = table.column("block").to_numpy(), table.column("low").to_numpy()
        ids, copies = table.column("class").to_numpy(), table.column("copies").to_numpy()
        units = np.stack([np.frombuffer(v, dtype=np.float64) for v in table.column("unit").to_pylist()])
        left = block == low
        right = ~left if (block != low).any() else left
        linked = units[left] @ units[right].T >= threshold
        if right is left:
            np.fill_diagonal(linked, False)
            out = [(ids[left], linked @ copies[left])]
        else:
            out = [(ids[left], linked @ copies[right]), (ids[right], linked.T @ copies[left])]
        return pa.table({"class": np.concatenate([o[0] for o in out]), "linked": np.concatenate([o[1] for o in out]).astype(np.int64)})

    return (dealt.groupBy("component", "low", "high").applyInArrow(compare, "class long, linked long")
            .groupBy("class").agg(F.sum("linked").alias("linked")))


def _all_edges(classes: DataFrame, threshold: float) -> DataFrame:
    """Every edge at or above the threshold, in both directions; all classes of one length are compared in blocks."""
    sized = classes.select("class", "unit", F.octet_length("unit").alias("size"))
    sizes = sized.groupBy("size").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = sized.join(sizes, "size").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    spread = placed.select("size", "class", "unit", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = spread.select("size", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class", "unit")

    def compare(table: pa.Table) -> pa.Table:
        ids, low, high = (table.column(c).to_numpy() for c in ("class", "low", "high"))
        units = np.stack(_unpack(table.column("unit").combine_chunks()))
        left = table.column("block").to_numpy() == low
        right = left if low[0] == high[0] else ~left
        sims = units[left] @ units[right].T
        if right is left:
            sims = np.triu(sims, 1)
        a, b = np.nonzero(sims >= threshold)
        return pa.Table.from_batches([_pairs(ids[left][a], ids[right][b], sims[a, b])])

    return dealt.groupBy("size", "low", "high").applyInArrow(compare, EDGES)


def _there(classes: DataFrame, queries: pa.Table, threshold: float) -> DataFrame:
    """(class, there): true number of links of the asked classes, which go to all tasks."""
    by_size: dict[int, tuple[list[int], list[bytes]]] = {}
    for k, u in zip(queries.column("class").to_pylist(), queries.column("unit").to_pylist(), strict=True):
        ids, units = by_size.setdefault(len(u) // 8, ([], []))
        ids.append(k)
        units.append(u)
    shared = classes.sparkSession.sparkContext.broadcast(by_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, ids, copies = _unpack(batch.column("unit")), batch.column("class").to_numpy(), batch.column("copies").to_numpy()
            sizes = np.array([len(u) for u in units])
            for dim, (wanted, raw) in shared.value.items():
                mine = np.flatnonzero(sizes == dim)
                if not len(mine):
                    continue
                there = np.stack([units[i] for i in mine]).T
                for at in range(0, len(wanted), AUDITED):
                    asked = np.array(wanted[at:at + AUDITED], np.int64)
                    vectors = np.frombuffer(b"".join(raw[at:at + AUDITED]), dtype=np.float64).reshape(-1, dim)
                    linked = (vectors @ there >= threshold) & (asked[:, None] != ids[mine][None, :])
                    yield pa.RecordBatch.from_arrays([pa.array(asked), pa.array(linked @ copies[mine])], names=["class", "there"])

    return classes.mapInArrow(run, "class long, there long").groupBy("class").agg(F.sum("there").alias("there"))


def _audit(classes: DataFrame, counts: DataFrame, threshold: float, goal: float) -> tuple[float, bool]:
    """Share of the links of sampled classes that are found, and whether it is surely at the goal. The sample grows until
    its 95 % bounds are on one side of the goal or it holds all classes; without any link nothing is missed."""
    slices = max(1, math.ceil(classes.count() / AUDITED))
    number = F.pmod(F.xxhash64(F.lit("audit"), F.col("class")), F.lit(slices))
    moments, done = np.zeros(6), 0
    while True:
        upto = min(slices, done + min(MOST_AUDITED, max(1, done)))
        queries = classes.where((number >= done) & (number < upto)).select("class", "unit").toArrow()
        done = upto
        if queries.num_rows:
            linked = _there(classes, queries, threshold).where("there > 0").join(counts, "class", "left").select(
                F.col("there").cast("double").alias("t"), F.coalesce("linked", F.lit(0)).cast("double").alias("f"))
            sums = linked.agg(F.count("*"), *[F.coalesce(F.sum(F.expr(x)), F.lit(0.0)) for x in ("t", "f", "t * t", "t * f", "f * f")]).first()
            moments += np.array([float(x) for x in sums])
        n, t, f, tt, tf, ff = moments.tolist()
        recall = f / t if t else 1.0
        if done == slices:
            return recall, recall >= goal
        if n >= 30:
            # Spread of the ratio over the sampled classes; where none misses a link, three in n may do so unseen.
            spread = 1.645 * math.sqrt(max(0.0, ff - 2 * recall * tf + recall * recall * tt)) / t
            if recall - max(spread, 3 / n) >= goal:
                return recall, True
            if recall + spread < goal:
                return recall, False


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD,
                    width: int = WIDTH, steps: int = 4, goal: float = GOAL, rounds: int = 3, seed: int = 1,
                    orders: int = ORDERS) -> DataFrame:
    """One row per vector: id, n_links and component (the smallest id reachable by links)."""
    scanned = stage(_scan(vectors, vec_id, embedding), "vectors")
    classes = stage(scanned.where("key is not null").groupBy("key").agg(
        F.min("place").alias("class"), F.min("id").alias("first_id"), F.count("*").alias("copies"),
        F.first("unit").alias("unit")), "vector-classes")
    found = stage(_first_graph(classes, orders, seed).groupBy("src", "dst").agg(F.max("sim").alias("sim")), "first-graph")
    for attempt in range(rounds):
        graph = stage(_best(found, width), "graph")
        edges = found.where(F.col("sim") >= threshold)
        size = max(1, graph.count())
        for _ in range(steps):
            offered = stage(_refine(graph, classes, width, threshold), "offered")
            better = stage(_best(graph.unionByName(offered), width), "graph")
            changed = better.join(graph, ["src", "dst"], "left_anti").count()
            edges = edges.unionByName(offered.where(F.col("sim") >= threshold))
            graph = better
            if changed < 0.02 * size:
                break
        edges = stage(edges.dropDuplicates(["src", "dst"]), "edges")
        labels = components(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")))
        # Saturated: the list holds nothing below the threshold. Their components are compared in blocks.
        full = graph.groupBy("src").agg(F.count("*").alias("n"), F.min("sim").alias("least")).where(
            (F.col("n") >= width) & (F.col("least") >= threshold))
        wide = labels.join(full, labels["node"] == full["src"]).select("component").distinct()
        members = stage(labels.join(wide, "component").select("component", F.col("node").alias("class")), "saturated")
        in_blocks = _block_links(members, classes, threshold)
        narrow = (edges.join(members.select(F.col("class").alias("src")), "src", "left_anti")
                  .join(classes.select(F.col("class").alias("dst"), "copies"), "dst")
                  .groupBy(F.col("src").alias("class")).agg(F.sum("copies").alias("linked")))
        counts = stage(in_blocks.unionByName(narrow), "link-counts")
        recall, reached = _audit(classes, counts, threshold, goal)
        log.info("attempt %d: recall %.4f with lists of %d", attempt + 1, recall, width)
        if reached:
            return _result(scanned, classes, labels, counts)
        if attempt + 1 == rounds:
            break
        width *= 2
        more = _first_graph(classes, orders, seed + attempt + 1).groupBy("src", "dst").agg(F.max("sim").alias("sim"))
        found = stage(more.unionByName(edges).unionByName(graph).groupBy("src", "dst").agg(F.max("sim").alias("sim")), "found")
    log.warning("recall %.4f is below %.4f after %d attempts: comparing all vectors", recall, goal, rounds)
    edges = stage(_all_edges(classes, threshold), "all-edges")
    labels = components(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")))
    counts = stage(edges.join(classes.select(F.col("class").alias("dst"), "copies"), "dst")
                   .groupBy(F.col("src").alias("class")).agg(F.sum("copies").alias("linked")), "link-counts")
    return _result(scanned, classes, labels, counts)


def _result(scanned: DataFrame, classes: DataFrame, labels: DataFrame, counts: DataFrame) -> DataFrame:
    rooted = (classes.join(labels, classes["class"] == labels["node"], "left")
              .select("key", "class", "first_id", "copies", F.coalesce("component", "class").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component"))
    by_key = stage(rooted.join(smallest, "root").join(counts, "class", "left").select(
        "key", "component", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "vector-components")
    return scanned.select("place", "id", "key").join(by_key, "key", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component"))
