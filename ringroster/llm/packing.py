"""Packing token sequences by non-negative least squares over length combinations.

Documents are cut into pieces of at most one window. Pieces are counted by length, a
histogram with as many entries as the window is long. Combinations of up to three lengths
that fill the window exactly are the columns of a least-squares problem whose unknowns are
repeat counts; the counts are solved for, rounded without using more pieces than there
are, and the pieces left over are packed greedily, longest first. The result is a list of
patterns with repeat counts; each piece finds its pattern by its place among the pieces of
its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringroster.llm.common import ranked, small_batches, texts_of, token_bytes, tokenizer_path
from ringroster.spool import spooled

WINDOW = 2048
STEPS = 150
CLOSE = 1e-3  # residual, as a share of the counts, at which solving ends
TURNS = 12
REMEMBERED = 200_000  # pieces of text, for a worker holds what it packs beside them
PIECES = (
    "doc_id long, row long, start long, length int, ids binary, ids_crc32 long, doc_tokens long"
)


def pieces(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """Token pieces of documents: the ids with the end id, cut after every full window.

    Null text counts as empty: one piece with the end id. Null and repeated ids are kept.
    """
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # a worker may have served other plans before
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            out: list[tuple] = []
            size = 0
            for doc_id, ids in zip(ids_of, token_bytes(texts, path, REMEMBERED), strict=True):
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[start * 4 : (start + window) * 4]
                    out.append((doc_id, 0, start, len(part) // 4, part, zlib.crc32(part), total))
                size += len(ids)
                if size > 4 << 20:
                    yield _piece_batch(out)
                    out, size = [], 0
            if out:
                yield _piece_batch(out)

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)
    # written once, so the row numbers stay as they are
    with small_batches(docs.sparkSession):
        return spooled(made.withColumn("row", F.monotonically_increasing_id()))


def _piece_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    names = ["doc_id", "row", "start", "length", "ids", "ids_crc32", "doc_tokens"]
    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def combinations(counts: np.ndarray) -> np.ndarray:
    """Combinations of up to three present lengths that fill the window; 0 pads a pair. A
    window of 2048 has at most some 350,000."""
    window = len(counts) - 1
    there = np.flatnonzero(counts[:window])
    there = there[there > 0]
    has = counts > 0
    pair = there[(there <= window // 2) & has[window - there]]
    rows = [np.stack([window - pair, pair, np.zeros_like(pair)], 1)]
    triples = []
    for c in there[there <= window // 3]:
        b = there[(there >= c) & (there <= (window - c) // 2)]
        a = window - c - b
        b, a = b[has[a]], a[has[a]]
        if len(b):
            triples.append(np.stack([a, b, np.full_like(b, c)], 1))
    if triples:
        rows += triples
    return np.concatenate(rows)


def least_squares(combos: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - counts|, by accelerated projected gradient.

    A counts each length in each combination. A length's miss is weighed by one over the
    combinations it is in, so the step need only be bounded by the largest column sum of A, not
    by the busiest length. Lengths in no combination cannot be met, so what they miss does not
    count; the rest is met to CLOSE, or as near as `steps` come.
    """
    width = len(counts)
    flat = combos.ravel()
    degree = np.bincount(flat, minlength=width).astype(float)
    degree[0] = 0
    weight = np.divide(1.0, degree, out=np.zeros(width), where=degree > 0)
    rate = 1.0 / (combos > 0).sum(1).max(initial=1)
    scale = max(1.0, counts.max(initial=1))
    goal = counts / scale
    enough = CLOSE * goal[weight > 0].sum()
    x = np.zeros(len(combos))
    ahead, t = x.copy(), 1.0
    for _ in range(steps):
        got = np.bincount(flat, np.repeat(ahead, 3), minlength=width)
        miss = np.where(weight > 0, got - goal, 0)
        if np.abs(miss).sum() <= enough:
            return ahead * scale
        new = np.maximum(ahead - rate * (weight * miss)[combos].sum(1), 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = np.maximum(new + (t - 1) / t2 * (new - x), 0)
        x, t = new, t2
    return x * scale


def solve(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, repeats) that use every counted piece exactly once; those of least
    squares, or of best fit alone where that needs fewer sequences."""
    fitted, plain = rounded(counts), greedy(counts.astype(np.int64))
    return min(fitted, plain, key=lambda patterns: sum(times for _, times in patterns))


def rounded(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Repeat counts by least squares, made whole in turns.

    Each turn takes the combinations with the largest counts, as whole numbers, until half of
    the pieces are used, and solves again for the pieces left, so what rounding does to one
    length the next solution repairs. The pieces left at the end are packed by best fit.
    """
    left = counts.astype(np.int64).copy()
    window = len(left) - 1
    patterns: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        patterns.append(((window,), int(left[window])))
        left[window] = 0
    for _ in range(TURNS):
        combos = combinations(left)
        if not len(combos):
            break
        x = least_squares(combos, left)
        room = int(left.sum()) / 2
        for i in np.argsort(-x, kind="stable").tolist():
            lengths = tuple(int(n) for n in combos[i] if n)
            most = min(int(left[n]) // lengths.count(n) for n in lengths)
            times = min(most, max(1, int(x[i])))
            if times > 0:
                for n in lengths:
                    left[n] -= times
                patterns.append((lengths, times))
                room -= times * len(lengths)
                if room <= 0:
                    break
    return patterns + greedy(left)


def greedy(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by falling length; a pattern is repeated while its pieces last."""
    left = counts.copy()
    window = len(left) - 1
    patterns = []
    while left.any():
        there = np.flatnonzero(left)
        taken: list[int] = []
        used = np.zeros(window + 1, np.int64)
        room = window
        while room:
            fits = there[: np.searchsorted(there, room, "right")]
            fits = fits[used[fits] < left[fits]]
            if not len(fits):
                break
            n = int(fits[-1])
            times = max(1, min(room // n, int(left[n] - used[n])))
            taken += [n] * times
            used[n] += times
            room -= n * times
        kinds = np.flatnonzero(used)
        repeats = int((left[kinds] // used[kinds]).min())
        left[kinds] -= repeats * used[kinds]
        patterns.append((tuple(taken), repeats))
    return patterns


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """For every slot of every pattern: key (length and first place), sequence, offset.

    The pieces of one length take the slots of that length in turn, a slot as often as
    its pattern is repeated.
    """
    place: dict[int, int] = {}
    rows = []
    base = 0
    for lengths, times in patterns:
        offset = 0
        for n in lengths:
            first = place.get(n, 0)
            rows.append((n << 44 | first, base, offset))
            place[n] = first + times
            offset += n
        base += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True))


def packed(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """Pieces of all documents with their place: doc_id, row, start, length, ids, ids_crc32,
    doc_tokens, sequence_id, offset.

    Every id is in one piece; offsets in a sequence have no gaps from 0. The histogram is
    all that reaches the driver, at most `window` rows. Texts without words give a piece of
    one id; equal rows are separate documents; an empty table gives no rows; other columns
    are ignored.
    """
    cut = pieces(docs, window, path)
    counts = np.zeros(window + 1, np.int64)
    for r in cut.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    if not counts.any():
        return cut.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    keys, sequences, offsets = slots(solve(counts))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        wanted = (length.to_numpy(np.int64) << 44) | rank.to_numpy(np.int64)
        at = np.searchsorted(keys, wanted, "right") - 1
        return pd.DataFrame(
            {"sequence_id": sequences[at] + wanted - keys[at], "offset": offsets[at]}
        )

    narrow = ranked(cut, ["length"], F.xxhash64("row"), "_rank", ["row"])
    at = narrow.withColumn("_at", place("length", "_rank"))
    return at.select(*cut.columns, "_at.sequence_id", "_at.offset")


def sequences(placed: DataFrame) -> DataFrame:
    """Sequences of a packing: sequence_id, ids (bytes of all pieces in order), length.

    A sequence has at most `window` ids, so its pieces are few."""
    part = F.struct("offset", "ids")
    whole = placed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(part)).alias("_parts"), F.sum("length").alias("length")
    )
    ids = F.aggregate("_parts", F.lit(b""), lambda s, p: F.concat(s, p["ids"]))
    return whole.select("sequence_id", ids.alias("ids"), "length")
