"""Exact k-means on whole-number vectors with heap-ordered bounds.

A vector whose distance to the nearest other centroid exceeds that to its own by some gap
keeps its centroid until the centroids have moved by the gap. Each cluster holds a heap of its
vectors, keyed by their gap plus the drift the cluster had gathered when they were scanned, and
each round adds to the drift of a cluster its own move and the largest move of any other. Only
vectors whose key the drift has reached are popped, scanned exactly and pushed again; the rest
of the heap is not looked at.

Vectors lie in blocks that keep their heaps and are never shuffled. A round is one map over the
blocks, written to the shared folder, and the sums that vectors took with them from cluster to
cluster, k times width numbers. The folder of the round before is deleted.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringroster.spool import spooled, spooling

SCALE = 1024
WIDTH = 64
K = 8
ROUNDS = 10
BLOCK = 4096  # vectors
LIMIT = 1 << 27  # of a component, so that a squared distance fits 64 bits
SLACK = 1e-12  # relative error of roots and their differences, and more
EVEN = 1e-6  # gaps below count as none
STATE = "ids binary, known binary, vectors binary, own binary, keys binary, rows binary, sizes binary"
MOVED = "counts array<long>, sums array<long>"
RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


def quantised(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id and vec (integers): floor(scale * x), held within LIMIT either way.

    Vectors that are null, have another width or hold a null or non-finite component are left
    out. A row without an id stays.
    """
    vec = F.transform(
        "embedding",
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"),
    )
    odd = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    sound = F.coalesce(F.size("embedding") == width, F.lit(False)) & ~odd
    return vectors.where(sound).select(F.col("vec_id").cast("long"), vec.alias("vec"))


def first_centroids(whole: DataFrame, k: int = K) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes; a row without an id comes last, equal
    ids are ordered by their vectors. With fewer vectors, all of them."""
    name = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = whole.select(name.alias("h"), "vec").orderBy(F.asc_nulls_last("h"), "vec").limit(k)
    return np.array([r["vec"] for r in chosen.collect()], np.int64)


def _blocks(width: int):
    """Rows into blocks; all vectors stand in the heap of cluster 0 with no gap at all."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                ids = part.column(0)
                vecs = part.column(1)
                n = len(ids)
                yield _row(
                    ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"),
                    ids.is_valid().to_numpy(zero_copy_only=False),
                    vecs.flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(n, width),
                    Heaps(np.zeros(n, np.uint8), [[(-np.inf, i) for i in range(n)]]),
                    np.zeros(0, np.int64), np.zeros((0, width), np.int64),
                )

    return pack


@dataclass
class Heaps:
    """Cluster of each vector of a block, and a heap of (key, vector) for each cluster."""

    own: np.ndarray
    heaps: list[list[tuple[float, int]]]

    @staticmethod
    def read(row: dict) -> Heaps:
        keys = np.frombuffer(row["keys"], "<f8").tolist()
        places = np.frombuffer(row["rows"], "<i4").tolist()
        heaps, at = [], 0
        for n in np.frombuffer(row["sizes"], "<i4").tolist():
            heaps.append(list(zip(keys[at : at + n], places[at : at + n], strict=True)))
            at += n
        return Heaps(np.frombuffer(row["own"], np.uint8).copy(), heaps)

    def expired(self, drift: np.ndarray) -> np.ndarray:
        """Pop the vectors whose gap the drift of their cluster has reached."""
        out = []
        for c, heap in enumerate(self.heaps):
            reached = drift[c] * (1 + SLACK) + EVEN
            while heap and heap[0][0] <= reached:
                out.append(heapq.heappop(heap)[1])
        return np.array(sorted(out), np.int64)

    def push(self, vectors: np.ndarray, nearest: np.ndarray, gaps: np.ndarray, drift: np.ndarray) -> None:
        self.own[vectors] = nearest
        keys = gaps + drift[nearest]
        for c, key, vector in zip(nearest.tolist(), keys.tolist(), vectors.tolist(), strict=True):
            heapq.heappush(self.heaps[c], (key, vector))


def distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors x centres."""
    top = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centres).max(initial=0)))
    if vectors.shape[1] * 4 * top * top < 1 << 52:  # all sums are exact as floats
        v, c = vectors.astype(np.float64), centres.astype(np.float64)
        return ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)).astype(np.int64)
    out = np.empty((len(vectors), len(centres)), np.int64)
    for j, centre in enumerate(centres):
        gap = vectors.astype(np.int64) - centre
        out[:, j] = (gap * gap).sum(1)
    return out


def rescan(heaps: Heaps, vectors: np.ndarray, centres: np.ndarray, drift: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Scan the expired vectors of a block; what clusters gained by them, and how many there
    were: counts (k), sums (k x width), vectors scanned."""
    k, width = centres.shape
    while len(heaps.heaps) < k:
        heaps.heaps.append([])
    at = heaps.expired(drift)
    counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
    if not len(at):
        return counts, sums, 0
    moved = vectors[at]
    d = distances(moved, centres)
    nearest = d.argmin(1)  # the smaller number of equals
    upper = np.sqrt(d[np.arange(len(at)), nearest].astype(np.float64)) * (1 + SLACK)
    d[np.arange(len(at)), nearest] = np.iinfo(np.int64).max
    lower = np.sqrt(d.min(1).astype(np.float64)) * (1 - SLACK)
    before = heaps.own[at]
    heaps.push(at, nearest.astype(np.uint8), lower - upper, drift)
    np.add.at(counts, nearest, 1)
    np.add.at(sums, nearest, moved)
    if not first:
        np.subtract.at(counts, before, 1)
        np.subtract.at(sums, before, moved)
    return counts, sums, len(at)


def _row(ids: np.ndarray, known: np.ndarray, vectors: np.ndarray, heaps: Heaps, counts: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    pairs = [p for heap in heaps.heaps for p in heap]
    values = [
        ids.tobytes(), known.tobytes(), vectors.tobytes(), heaps.own.tobytes(),
        np.array([p[0] for p in pairs], "<f8").tobytes(), np.array([p[1] for p in pairs], "<i4").tobytes(),
        np.array([len(h) for h in heaps.heaps], "<i4").tobytes(), counts, sums.ravel(),
    ]
    kinds = [*[pa.binary()] * 7, pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [c.split()[0] for c in f"{STATE}, {MOVED}".split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)


def _read(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[dict, np.ndarray, Heaps]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield row, np.frombuffer(row["vectors"], "<i4").reshape(-1, width), Heaps.read(row)


def _round(centres: np.ndarray, drift: np.ndarray, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, vectors, heaps in _read(batches, centres.shape[1]):
            counts, sums, _ = rescan(heaps, vectors, centres, drift, first)
            ids, known = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["known"], bool)
            yield _row(ids, known, vectors, heaps, counts, sums)

    return run


def _last(centres: np.ndarray, drift: np.ndarray, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, vectors, heaps in _read(batches, centres.shape[1]):
            rescan(heaps, vectors, centres, drift, first)
            ids, known = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["known"], bool)
            exact = np.empty(len(ids), np.int64)
            for c in range(len(centres)):
                mine = heaps.own == c
                exact[mine] = distances(vectors[mine], centres[c : c + 1])[:, 0]
            arrays = [pa.array(ids, pa.int64(), mask=~known), pa.array(heaps.own.astype(np.int32)), pa.array(exact)]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "cluster", "distance"])

    return run


def _gained(state: DataFrame, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all blocks: k counts and k x width sums."""
    slots = state.select(F.posexplode(F.concat("counts", "sums")).alias("slot", "x"))
    out = np.zeros(k * (width + 1), np.int64)
    for r in slots.groupBy("slot").agg(F.sum("x").alias("x")).collect():
        out[r["slot"]] = r["x"]
    return out[:k], out[k:].reshape(k, width)


def moves(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """What each cluster's gaps may have lost: its own move and the largest of any other."""
    gap = (new - old).astype(np.float64)
    step = np.sqrt((gap * gap).sum(1)) * (1 + SLACK)
    others = np.array([np.delete(step, j).max(initial=0.0) for j in range(len(step))])
    return step + others


def clustered(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256.

    Every row counts, repeated ones too; ties go to the smaller cluster number; a component
    beyond LIMIT / scale counts as that. With fewer than k vectors there are as many clusters
    as vectors; with none there are no rows. At most 255 clusters. Only vec_id and embedding
    are read, so other columns may have any names.
    """
    spark = vectors.sparkSession
    whole = quantised(vectors, width, scale)
    centres = first_centroids(whole, k)
    if not len(centres):
        return spark.createDataFrame([], RESULT)
    k = len(centres)
    counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
    drift = np.zeros(k)
    state = whole.mapInArrow(_blocks(width), f"{STATE}, {MOVED}")
    done = []
    try:
        for n in range(rounds):
            keep = spooling(state.mapInArrow(_round(centres, drift, n == 0), f"{STATE}, {MOVED}"))
            state = keep.__enter__()
            if done:
                done.pop().__exit__(None, None, None)
            done.append(keep)
            more, moved = _gained(state, k, width)
            counts, sums = counts + more, sums + moved
            new = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centres)
            drift, centres = drift + moves(centres, new), new
        out = spooled(state.mapInArrow(_last(centres, drift, rounds == 0), "vec_id long, cluster int, distance long"))
    finally:
        for keep in done:
            keep.__exit__(None, None, None)
    inertia = dict.fromkeys(range(k), 0)
    for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("x")).collect():
        inertia[r["cluster"]] = int(r["x"])
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]

    def of_cluster(values: list, kind: str):
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    return out.select(
        "vec_id", "cluster", "distance",
        of_cluster([inertia[c] for c in range(k)], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of_cluster(names, "string").alias("centroid_sha256"),
    )
