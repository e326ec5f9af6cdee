"""Nearest neighbours by an adaptive dimension scan over probed lists.

Equal vectors are one class, which keeps the ``k + 1`` smallest ids of its rows: no result needs more. A quantizer (Lloyd's
algorithm on a sample of at most SAMPLE classes and SAMPLE_BYTES, chosen by hash) deals every class to the list of
its nearest centre. The index is a written table of blocks of a list, at most about BLOCK classes each: their vectors after
a random rotation, cut into column blocks, and the vectors as given. A rotated vector spreads its length evenly over
its coordinates, so the distance over the first d of D coordinates, scaled by D / d, estimates the whole distance, with an
error that falls as one over the root of d. A query walks through the column blocks of a list and tests after each block
whether that estimate can still come from a distance within its radius (the distance of its ``k + 1`` best rows so far);
candidates that fail the test are abandoned. What reaches the last column is measured on the vectors as given, in double
precision. The nearest list is scanned first, and its radius goes along to all other lists.

How many lists to probe follows from an audit: the exact neighbours of up to AUDITED query vectors, found by comparing them
with all rows, tell how many lists hold GOAL of them. The finished result is held against the same neighbours; below
the goal, more lists are probed, in the end all, and the test's confidence is raised until it abandons nothing.

Defined cases: vectors that are null, empty or zero or hold null or non-finite components take no part. Vectors of another
length are no candidates. Ties go to the smaller id, a null id last; a null id is never a query. Repeated rows are
candidates of each other: only the query's own row is left out. Fewer than ``k`` candidates are all returned; empty
tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storeloom.scratch import stage

SAMPLE = 20_000
SAMPLE_BYTES = 32 << 20
MOST_LISTS = 4096
BLOCK = 1024
QUERIES = 512
COLUMNS = 16
ROWS = 256
AUDITED = 256
GOAL = 0.97
CONFIDENCE = 2.1
RESULT = "query_id long, rank int, vec_id long, score double"
CLASSES = "key binary, vector binary, ids array<long>"
FOUND = "key binary, distance double, id long"

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Quantizer:
    """Centres of the lists by length of the vectors; lists are numbered through."""

    centres: dict[int, np.ndarray]
    first: dict[int, int]

    @property
    def widest(self) -> int:
        return max((len(c) for c in self.centres.values()), default=0)


def usable(vector: list | None) -> np.ndarray | None:
    """The vector in double precision, or None if it takes no part."""
    if not vector or any(x is None for x in vector):
        return None
    values = np.array(vector, dtype=np.float64) + 0.0
    return values if np.isfinite(values).all() and values.any() else None


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random rotation, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _vectors(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dim)


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, vectors) of each length in a column of packed vectors."""
    packed = column.to_pylist()
    sizes = np.array([len(v) // 8 for v in packed], np.int64)
    for dim in np.unique(sizes).tolist():
        mine = np.flatnonzero(sizes == dim)
        yield dim, mine, np.frombuffer(b"".join([packed[i] for i in mine]), dtype=np.float64).reshape(-1, dim)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b, up to rounding."""
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :], 0)


def scan(vectors: DataFrame, vec_id: str, embedding: str, is_query: Column) -> DataFrame:
    """(id, asked, key, vector) of the rows that take part; the key is a hash of the packed vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [usable(v) for v in batch.column("v").to_pylist()]
            kept = [i for i, v in enumerate(read) if v is not None]
            packed = [read[i].tobytes() for i in kept]
            mine = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [mine.column("id"), mine.column("asked"), pa.array([xxhash.xxh3_128_digest(v) for v in packed], pa.binary()),
                 pa.array(packed, pa.binary())], names=["id", "asked", "key", "vector"])

    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asked"),
                          F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "id long, asked boolean, key binary, vector binary")


def classes_of(rows: DataFrame, ids: int) -> DataFrame:
    """Equal vectors with their smallest ids; the row number is cut before the shuffle."""
    ranked = Window.partitionBy("key").orderBy(F.asc_nulls_last("id"))
    few = rows.select("key", "id", "vector").withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= ids)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("r", "id"))), lambda x: x["id"])
    return few.groupBy("key").agg(F.first("vector").alias("vector"), listed.alias("ids"))


def fit(classes: DataFrame, seed: int = 7) -> Quantizer:
    """Centres from a bounded sample: about the root of the number of classes for each length, MOST_LISTS at most."""
    sizes = {r["dim"]: r["n"] for r in classes.groupBy((F.octet_length("vector") / 8).cast("int").alias("dim"))
             .agg(F.count("*").alias("n")).collect()}
    centres, first, so_far = {}, {}, 0
    for dim in sorted(sizes):
        sample = (classes.where(F.octet_length("vector") == 8 * dim).select("vector", F.xxhash64(F.lit(seed), "key").alias("h"))
                  .orderBy("h").limit(max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))).toArrow())
        points = _vectors(sample.column("vector"), dim)
        number = max(1, min(MOST_LISTS, round(sizes[dim] ** 0.5), len(points)))
        middle = points[np.random.default_rng(seed).permutation(len(points))[:number]].copy()
        for _ in range(6):
            nearest = np.concatenate([squared(points[i:i + 2048], middle).argmin(axis=1) for i in range(0, len(points), 2048)])
            counts = np.bincount(nearest, minlength=number)
            sums = np.zeros_like(middle)
            np.add.at(sums, nearest, points)
            middle[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        centres[dim], first[dim] = middle, so_far
        so_far += number
    return Quantizer(centres, first)


def assign(classes: DataFrame, quantizer: Quantizer) -> DataFrame:
    """Adds the list of each class."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(quantizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lists = np.zeros(batch.num_rows, np.int32)
            for dim, mine, vectors in _by_length(batch.column("vector")):
                for i in range(0, len(mine), 2048):
                    lists[mine[i:i + 2048]] = model.first[dim] + squared(vectors[i:i + 2048], model.centres[dim]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists)], names=[*batch.schema.names, "list"])

    return classes.mapInArrow(run, f"{CLASSES}, list int")


def build_index(assigned: DataFrame) -> DataFrame:
    """One row per block of a list: packed vectors as given, rotated ones in column blocks, and the ids of their rows.

    A list is dealt to as many blocks as its size asks for, so a hot list is spread over tasks.
    """
    sizes = assigned.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = assigned.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))

    def pack(rows: pa.Table) -> pa.Table:
        dim = len(rows.column("vector")[0].as_py()) // 8
        given = _vectors(rows.column("vector"), dim)
        turned = given @ rotation(dim)
        columns = [turned[:, c:c + COLUMNS].tobytes() for c in range(0, dim, COLUMNS)]
        return pa.table({"list": rows.column("list")[:1], "dim": pa.array([dim], pa.int32()), "given": [given.tobytes()],
                         "columns": [columns], "ids": pa.array([rows.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64())))})

    return placed.select("list", "block", "vector", "ids").groupBy("list", "block").applyInArrow(
        pack, "list int, dim int, given binary, columns array<binary>, ids array<array<long>>")


def probe(queries: DataFrame, quantizer: Quantizer, first: int, upto: int) -> DataFrame:
    """(list, key, vector, radius) of the lists number ``first`` to ``upto`` of each query by distance of their centres."""
    shared = queries.sparkSession.sparkContext.broadcast(quantizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for dim, mine, vectors in _by_length(batch.column("vector")):
                for i in range(0, len(mine), 512):
                    far = squared(vectors[i:i + 512], model.centres[dim])
                    lists = np.argsort(far, axis=1, kind="stable")[:, first:upto].astype(np.int32) + model.first[dim]
                    chosen = batch.take(pa.array(np.repeat(mine[i:i + 512], lists.shape[1])))
                    yield pa.RecordBatch.from_arrays([pa.array(lists.ravel()), *[chosen.column(c) for c in ("key", "vector", "radius")]],
                                                     names=["list", "key", "vector", "radius"])

    return queries.select("key", "vector", "radius").mapInArrow(run, "list int, key binary, vector binary, radius double")


def scan_block(query: np.ndarray, turned: np.ndarray, columns: list[np.ndarray], given: np.ndarray, weights: np.ndarray, wanted: int,
               radius: float, confidence: float) -> tuple[np.ndarray, np.ndarray]:
    """(distances, places) of the classes of a block that may be among the ``wanted`` nearest rows of a query.

    ``radius`` is a distance that many rows are known to have, infinite at first. Rows are taken ROWS at a time, and the
    radius shrinks after each."""
    dim, near, at = len(query), np.zeros(0), np.zeros(0, np.int64)
    for start in range(0, len(given), ROWS):
        alive = np.arange(start, min(start + ROWS, len(given)))
        partial, done = np.zeros(len(alive)), 0
        for block in columns:
            width = block.shape[1]
            step = block[alive] - turned[done:done + width]
            partial = partial + (step * step).sum(axis=1)
            done += width
            # The whole distance of a candidate within the radius has this share in the first columns, with high confidence.
            # Behind the last column nothing is estimated, so only rounding needs room.
            slack = 1 + confidence / done ** 0.5 if done < dim else 1 + 1e-9
            may = partial * dim <= (radius * slack) ** 2 * done
            if not may.all():
                alive, partial = alive[may], partial[may]
                if not len(alive):
                    break
        if not len(alive):
            continue
        difference = given[alive] - query
        near = np.concatenate([near, np.sqrt((difference * difference).sum(axis=1))])
        at = np.concatenate([at, alive])
        order = np.argsort(near, kind="stable")
        near, at = near[order], at[order]
        enough = int(np.searchsorted(np.cumsum(weights[at]), wanted))
        if enough < len(near):
            radius = min(radius, float(near[enough]))
            kept = near <= radius  # ties stay
            near, at = near[kept], at[kept]
    return near, at


def search_lists(index: DataFrame, probes: DataFrame, wanted: int, confidence: float) -> DataFrame:
    """(key, distance, id) of the ``wanted`` nearest rows of each query in the probed lists. Queries meet a block QUERIES
    at a time: a stated set in blocks against the rows of its lists, never one list in one task."""
    sizes = probes.groupBy("list").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("chunks"))
    chunked = (probes.join(sizes, "list").withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")))
               .groupBy("list", "chunk").agg(F.collect_list(F.struct("key", "vector", "radius")).alias("asked")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("dim", "given", "columns", "ids", "asked")}
                dim, ids = row["dim"].as_py(), row["ids"].as_py()
                given = np.frombuffer(row["given"].as_py(), np.float64).reshape(-1, dim)
                columns = [np.frombuffer(c, np.float64).reshape(len(given), -1) for c in row["columns"].as_py()]
                weights = np.array([len(x) for x in ids])
                asked = row["asked"].as_py()
                if dim not in turn:
                    turn[dim] = rotation(dim)
                queries = np.frombuffer(b"".join([q["vector"] for q in asked]), np.float64).reshape(-1, dim)
                turned = queries @ turn[dim]
                out: list[tuple[bytes, float, int | None]] = []
                for q, query in enumerate(queries):
                    near, at = scan_block(query, turned[q], columns, given, weights, wanted, asked[q]["radius"], confidence)
                    rows = [(d, x is None, x or 0, x) for d, a in zip(near.tolist(), at.tolist(), strict=True) for x in ids[a]]
                    out += [(asked[q]["key"], r[0], r[3]) for r in sorted(rows)[:wanted]]
                keys, distances, found = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(distances, pa.float64()), pa.array(found, pa.int64())],
                                                 names=["key", "distance", "id"])

    return index.join(chunked, "list").select("dim", "given", "columns", "ids", "asked").mapInArrow(run, FOUND)


def nearest_rows(found: DataFrame, wanted: int) -> DataFrame:
    """(key, nearest): the ``wanted`` best rows of each query in order; the row number is cut before the shuffle."""
    ranked = Window.partitionBy("key").orderBy("distance", F.asc_nulls_last("id"))
    few = found.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= wanted)
    return few.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("r", "distance", "id"))).alias("nearest"))


def exact_neighbours(assigned: DataFrame, queries: pa.Table, wanted: int) -> DataFrame:
    """(key, distance, id, list) of the ``wanted`` nearest rows of a few queries, by comparing them with all."""
    held: dict[int, tuple[list[bytes], list[bytes]]] = {}
    for key, vector in zip(queries.column("key").to_pylist(), queries.column("vector").to_pylist(), strict=True):
        keys, packed = held.setdefault(len(vector) // 8, ([], []))
        keys.append(key)
        packed.append(vector)
    shared = assigned.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("ids"), batch.column("list").to_numpy()
            for dim, mine, vectors in _by_length(batch.column("vector")):
                keys, packed = shared.value.get(dim, ([], []))
                asked = np.frombuffer(b"".join(packed), np.float64).reshape(-1, dim)
                out = []
                for key, query in zip(keys, asked, strict=True):
                    far = vectors - query
                    distance = np.sqrt((far * far).sum(axis=1))
                    few = min(wanted, len(distance)) - 1
                    for i in np.flatnonzero(distance <= np.partition(distance, few)[few]).tolist():
                        out += [(key, float(distance[i]), x, int(lists[mine[i]])) for x in ids[int(mine[i])].as_py()]
                if out:
                    kinds = (pa.binary(), pa.float64(), pa.int64(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                     names=["key", "distance", "id", "list"])

    found = assigned.select("vector", "ids", "list").mapInArrow(run, f"{FOUND}, list int")
    ranked = Window.partitionBy("key").orderBy("distance", F.asc_nulls_last("id"))
    return found.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= wanted).drop("r")


def lists_needed(quantizer: Quantizer, queries: pa.Table, truth: pa.Table, goal: float) -> int:
    """Probes that reach the share ``goal`` of the true neighbours, the query's own row not counted."""
    rank: dict[bytes, dict[int, int]] = {}
    for key, vector in zip(queries.column("key").to_pylist(), queries.column("vector").to_pylist(), strict=True):
        query = np.frombuffer(vector, np.float64)
        far = squared(query[None, :], quantizer.centres[len(query)])[0]
        order = np.empty(len(far), np.int64)
        order[np.argsort(far, kind="stable")] = np.arange(len(far))
        rank[key] = dict(enumerate(order.tolist(), quantizer.first[len(query)]))
    places, own = [], set()
    for key, distance, held in zip(*[truth.column(c).to_pylist() for c in ("key", "distance", "list")], strict=True):
        if distance == 0 and key not in own:
            own.add(key)
        else:
            places.append(rank[key][held])
    places.sort()
    return places[min(len(places) - 1, int(goal * len(places)))] + 1 if places else 1


def recall_of(truth: pa.Table, found: pa.Table) -> float:
    """Share of the true neighbours among the rows found, without the query's own; a row as near as the farthest true one
    counts."""
    farthest, number = {}, {}
    for key, distance in zip(truth.column("key").to_pylist(), truth.column("distance").to_pylist(), strict=True):
        farthest[key] = max(farthest.get(key, 0.0), distance)
        number[key] = number.get(key, 0) + 1
    hit = sum(min(number[key], sum(r["distance"] <= farthest[key] * (1 + 1e-12) for r in rows)) - 1
              for key, rows in zip(found.column("key").to_pylist(), found.column("nearest").to_pylist(), strict=True))
    return hit / sum(n - 1 for n in number.values()) if any(n > 1 for n in number.values()) else 1.0


def _search(index: DataFrame, asked: DataFrame, quantizer: Quantizer, probes: int, wanted: int, confidence: float) -> DataFrame:
    near = stage(nearest_rows(search_lists(index, probe(asked, quantizer, 0, 1), wanted, confidence), wanted), "nearest-list")
    if probes <= 1:
        return near
    # The radius: the distance of the last wanted row, if the nearest list has that many.
    radius = near.select("key", F.get("nearest", F.lit(wanted - 1))["distance"].alias("known"))
    bounded = asked.join(radius, "key", "left").select("key", "vector", F.coalesce("known", "radius").alias("radius"))
    others = search_lists(index, probe(bounded, quantizer, 1, probes), wanted, confidence)
    both = others.unionByName(near.select("key", F.explode("nearest").alias("n")).select("key", "n.distance", "n.id"))
    return stage(nearest_rows(both, wanted), "nearest")


def search(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
           goal: float = GOAL, confidence: float = CONFIDENCE, seed: int = 7) -> DataFrame:
    """The ``k`` nearest rows of each query row: query_id, rank from 1, vec_id and score, the Euclidean distance."""
    spark: SparkSession = vectors.sparkSession
    wanted = k + 1
    rows = stage(scan(vectors, vec_id, embedding, is_query), "scan-rows")
    classes = stage(classes_of(rows, wanted), "scan-classes")
    asked_rows = rows.where("asked and id is not null")
    asked = stage(asked_rows.groupBy("key").agg(F.first("vector").alias("vector")).withColumn("radius", F.lit(float("inf"))), "scan-queries")
    quantizer = fit(classes, seed)
    if not quantizer.centres:
        return spark.createDataFrame([], RESULT)
    assigned = stage(assign(classes, quantizer), "scan-lists")
    index = stage(build_index(assigned), "scan-index")
    audited = asked.orderBy(F.xxhash64(F.lit(seed), "key")).limit(AUDITED).select("key", "vector").toArrow()
    truth = exact_neighbours(assigned, audited, wanted).toArrow()
    probes = lists_needed(quantizer, audited, truth, goal)
    sampled = spark.createDataFrame(audited.select(["key"])) if audited.num_rows else asked.select("key").limit(0)
    while True:
        near = _search(index, asked, quantizer, probes, wanted, confidence)
        recall = recall_of(truth, near.join(sampled, "key", "left_semi").toArrow())
        log.info("recall %.4f with %d of %d lists", recall, probes, quantizer.widest)
        if recall >= min(goal, 0.95) or not audited.num_rows:
            break
        if probes < quantizer.widest:
            probes = min(quantizer.widest, 2 * probes)
        else:
            confidence *= 2
    answered = asked_rows.select("id", "key").join(near, "key").select(
        F.col("id").alias("query_id"), "nearest", F.array_position(F.transform("nearest", lambda r: r["id"]), F.col("id")).alias("own"))
    others = F.filter("nearest", lambda r, i: F.coalesce(i + 1 != F.col("own"), F.lit(True)))
    return (answered.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("p", "n"))
            .select("query_id", (F.col("p") + 1).alias("rank"), F.col("n.id").alias("vec_id"), F.col("n.distance").alias("score")))
