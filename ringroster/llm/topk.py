"""Exact top-k search by integer inner product, with block-at-a-time pruning.

Vectors are kept in blocks of neighbouring documents, each with its forward index (the
vectors themselves) and the largest and smallest weight of every term. For a query the
bound of a block is the sum of its term maxima; blocks are taken by falling bound and
scored through the forward index until the bound falls below the k-th score so far.

Blocks are gathered in groups and queries in batches of fixed size. Each pair of a batch
and a group is one small task with a top k of its own, and those are merged, so neither the
queries nor the vectors are ever in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringroster.spool import spooled

SCALE = 256
EVERY = 50
K = 5
BLOCK = 256
GROUP = 16  # blocks
BATCH = 1024  # queries
PLANES = 12
SEED = 10


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and vec (integers): floor(scale * x). Vectors that are null or hold a null or
    non-finite component take no part, nor do rows without an id."""
    vec = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    odd = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~odd
    return vectors.where(sound).select("vec_id", vec.alias("vec"))


def _plane_key(width: int) -> Column:
    """Signs of seeded projections, most telling for neighbours when ordered."""
    rng = np.random.default_rng(SEED)
    bits = []
    for p in range(PLANES):
        signs = F.array(*[F.lit(int(s)) for s in rng.choice([-1, 1], width)])
        dot = F.aggregate(
            F.zip_with("vec", signs, lambda a, b: F.coalesce(a, F.lit(0)) * F.coalesce(b, F.lit(0))),
            F.lit(0).cast("long"),
            lambda s, x: s + x,
        )
        bits.append(F.shiftleft((dot > 0).cast("int"), p))
    return sum(bits[1:], bits[0])


def _matrix(vecs: list, width: int) -> np.ndarray:
    out = np.zeros((len(vecs), width), np.int64)
    for i, v in enumerate(vecs):
        out[i, : len(v)] = v
    return out


def _boxes(width: int, size: int):
    """Rows into boxes of `size`: part, number, n, ids, extra, matrix as bytes."""

    def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids: list[int] = []
        vecs: list = []
        number = 0

        def box() -> pa.RecordBatch:
            values = [part, number, len(ids[:size]), np.asarray(ids[:size], "<i8").tobytes(), _matrix(vecs[:size], width).tobytes()]
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["part", "number", "n", "ids", "matrix"])

        for batch in batches:
            ids += batch.column(0).to_pylist()
            vecs += batch.column(1).to_pylist()
            while len(ids) >= size:
                yield box()
                ids, vecs, number = ids[size:], vecs[size:], number + 1
        if ids:
            yield box()

    return boxed


BOX = "part int, number long, n int, ids binary, matrix binary"


def _unbox(frame: pd.DataFrame, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    return [
        (np.frombuffer(i, "<i8"), np.frombuffer(m, "<i8").reshape(-1, width))
        for i, m in zip(frame["ids"], frame["matrix"], strict=True)
    ]


def best_of_blocks(
    q_ids: np.ndarray, queries: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Top k of a group of blocks for each query: (query place, vec_id, score).

    Rows with the query's own id are left out. Float arithmetic is used where all sums are
    exact in it, else 64-bit integers.
    """
    width = queries.shape[1]
    top = max((int(np.abs(b).max(initial=0)) for _, b in blocks), default=0)
    exact = int(np.abs(queries).max(initial=0)) * top * max(width, 1) < 1 << 52
    kind = np.float64 if exact else np.int64
    q = queries.astype(kind)
    mats = [b.astype(kind) for _, b in blocks]
    high = np.stack([b.max(0) for b in mats])
    low = np.stack([b.min(0) for b in mats])
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bound, axis=1, kind="stable")
    least = -np.iinfo(np.int64).max  # can be negated
    scores = np.full((len(q), k), least, np.int64)
    found = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
    active = np.arange(len(q))
    for turn in range(len(mats)):
        block = order[active, turn]
        going = (scores[active, -1] == least) | (bound[active, block] >= scores[active, -1])
        active, block = active[going], block[going]
        if not len(active):
            break
        for b in np.unique(block):
            who = active[block == b]
            ids = blocks[b][0]
            new = (q[who] @ mats[b].T).astype(np.int64)
            new[ids[None, :] == q_ids[who, None]] = least
            names = np.broadcast_to(ids, new.shape)
            if new.shape[1] > 4 * k:  # all that could be among the k, ties included
                kth = np.partition(new, new.shape[1] - k, axis=1)[:, -k]
                keep = new >= kth[:, None]
                if (keep.sum(1) <= 4 * k).all():
                    rank = np.argsort(~keep, axis=1, kind="stable")[:, : 4 * k]
                    new, names = np.take_along_axis(new, rank, 1), np.take_along_axis(names, rank, 1)
            s = np.concatenate([scores[who], new], 1)
            v = np.concatenate([found[who], names], 1)
            first = np.lexsort((v, -s), axis=1)[:, :k]
            scores[who] = np.take_along_axis(s, first, 1)
            found[who] = np.take_along_axis(v, first, 1)
    at, col = np.nonzero(scores > least)
    return at, found[at, col], scores[at, col]


def nearest(
    vectors: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query.

    Queries are the rows whose vec_id is divisible by `every`; ties go to the smaller id.
    Shorter vectors count as padded with zeros. A query given twice is answered once; two
    different vectors with one query id are answered as one query with the better scores
    of both. No vectors, no rows.
    """
    whole = quantised(vectors, scale)
    width = whole.agg(F.coalesce(F.max(F.size("vec")), F.lit(0))).first()[0]
    width = max(width, 1)
    key = _plane_key(width)
    dealt = whole.withColumn("_key", key).repartitionByRange("_key", "vec_id")
    dealt = dealt.sortWithinPartitions("_key", "vec_id").select("vec_id", "vec")
    blocks = spooled(dealt.mapInArrow(_boxes(width, BLOCK), BOX))
    asked = whole.where(F.col("vec_id") % every == 0).dropDuplicates()
    batches = spooled(asked.mapInArrow(_boxes(width, BATCH), BOX))

    n_groups = max(1, -(-blocks.count() // GROUP))
    n_batches = max(1, batches.count())
    spread = F.xxhash64("part", "number")
    every_group = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))
    every_batch = F.explode(F.sequence(F.lit(0), F.lit(n_batches - 1)))
    left = batches.withColumns({"batch": F.pmod(spread, F.lit(n_batches)).cast("int"), "group": every_group})
    right = blocks.withColumns({"group": F.pmod(spread, F.lit(n_groups)).cast("int"), "batch": every_batch})

    def cell(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")]
        boxes = _unbox(b, width)
        for q_ids, q_mat in _unbox(q, width) if boxes else []:
            at, ids, scores = best_of_blocks(q_ids, q_mat, boxes, k)
            out.append(pd.DataFrame({"query_id": q_ids[at], "vec_id": ids, "score": scores}))
        return pd.concat(out)

    keys = ("batch", "group")
    left, right = left.groupBy(*keys), right.groupBy(*keys)
    part = left.cogroup(right).applyInPandas(cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        part.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
