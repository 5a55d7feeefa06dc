"""Language-model scores by deleted interpolation.

Tokens are words, lower-cased A-Z, and one end per document. A token's probability mixes
maximum-likelihood estimates of three orders: the token after the token before it, the token
alone, and the uniform share of a vocabulary with one unseen word. A text begins after an
end. The weights depend on how often the token before was seen, and are learned by
expectation maximisation on counts of documents that were kept out of the estimates.

Text is read once, into chunks of a bounded number of tokens, kept as places in the chunk's
list of words. The distinct pairs of neighbours and the distinct words of each chunk are
counted over all chunks by one shuffle: their 64-bit hashes are cut into ranges, as many as
the input needs, and a chunk sends each range one row of hashes with its own counts. The
totals return to their chunks in the same order. As each chunk sends a pair once at most,
no pair or word makes a range larger than others. A row holds one hash at least, so there are
never more rows than different pairs and words in the chunks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringroster.llm.common import compact, mixed, part_count, spool_path, texts_of, word_hashes
from ringroster.spool import delete

CHUNK_TOKENS = 3 << 17
RANGE_KEYS = 1_000_000  # hashes of all chunks in one range, about
BUCKETS = 24  # of context frequency, by powers of four
TURNS = 60
SCALE = 32  # steps of a power of e in the table of held-out counts
END = 0x656E64206F66  # hash that stands for the end
PAIR, WORD = 0, 1
CHUNKS = (
    "chunk long, doc_ids array<long>, outs array<boolean>, gone array<boolean>, lengths array<int>, "
    "words binary, tokens binary"
)


def remainder(docs: DataFrame, divisor: int) -> Column:
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return crc % divisor


def planes(numbers: np.ndarray, width: int = 4) -> bytes:
    """Numbers byte by byte, all lowest bytes, then the next, compressed: high bytes are mostly
    zero, and a batch of rows should take no room for them."""
    return zlib.compress(np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes(), 1)


def from_planes(data: bytes, width: int = 4) -> np.ndarray:
    plain = np.frombuffer(zlib.decompress(data), np.uint8)
    return np.ascontiguousarray(plain.reshape(width, -1).T).view(f"<u{width}").ravel()


def chunked(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Chunks of documents, written to a path; a text longer than a chunk is a chunk of its own.

    Documents whose crc32 of the id has remainder 2 by 7 are held out of everything; of
    the others, those with remainder 0 by 10 are deleted from the estimates the weights are
    learned with."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = 0
        docs_of: list[tuple] = []
        words: list[np.ndarray] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            ids, outs, gone, lengths = zip(*docs_of, strict=True)
            own, place, times = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
            # frequent words first, so that most places are small and compress well
            often = np.argsort(-times, kind="stable")
            rank = np.empty(len(own), np.int64)
            rank[often] = np.arange(len(own))
            values = [
                task.partitionId() << 16 | number, list(ids), list(outs), list(gone), list(lengths),
                own[often].astype("<u8").tobytes(), planes(rank[place]),
            ]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.list_(pa.int32()), *[pa.binary()] * 2]
            names = ["chunk", "doc_ids", "outs", "gone", "lengths", "words", "tokens"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)), texts_of(batch.column(3)), strict=True)
            for doc_id, out, gone, text in rows:
                own = word_hashes(text)
                words.append(np.append(own, np.uint64(END)))
                docs_of.append((doc_id, out, gone, len(own) + 1))
                size += len(own) + 1
                if size >= CHUNK_TOKENS:
                    yield chunk()
                    docs_of, words, size, number = [], [], 0, number + 1
        if docs_of:
            yield chunk()

    keyed = docs.select(
        F.col("doc_id").cast("long"), (remainder(docs, 7) == 2).alias("out"),
        (remainder(docs, 10) == 0).alias("gone"), "text",
    )
    return compact(keyed.mapInArrow(scan, CHUNKS), path)


class Chunk:
    """Tokens of a chunk with its distinct words and pairs, both in the order of their keys or,
    opened without words, of their places in the chunk's list.

    The last token of a chunk is an end, and so is what stands before its first token."""

    def __init__(self, words: bytes | None, tokens: bytes, outs: list, gone: list, lengths: list):
        self.tokens = from_planes(tokens).astype(np.int32)
        if words is not None:
            own = np.frombuffer(words, "<u8")
            order, rank = _order(own)
            self.words, self.tokens = own[order], rank[self.tokens]
        count = int(self.tokens.max()) + 1  # every word of the list occurs
        code = np.roll(self.tokens, 1).astype(np.int64) * count + self.tokens
        code, place = np.unique(code, return_inverse=True)
        self.before, self.last = (code // count).astype(np.int32), (code % count).astype(np.int32)
        self.places = place.astype(np.int32)
        if words is not None:
            keys = pair_keys(self.words, self.before, self.last)
            order, rank = _order(keys)
            self.pairs, self.before, self.last, self.places = keys[order], self.before[order], self.last[order], rank[self.places]
        self.n_words, self.n_pairs = count, len(code)
        outs, gone = np.asarray(outs, bool), np.asarray(gone, bool)
        self.kind = np.repeat(np.where(outs, 2, np.where(gone, 1, 0)).astype(np.int8), lengths)

    def keys(self, kind: int) -> np.ndarray:
        return self.words if kind == WORD else self.pairs

    def counts(self, kind: int, of: int) -> np.ndarray:
        """How often each word or pair is in documents that are kept (0) or deleted (1)."""
        at = self.tokens if kind == WORD else self.places
        return np.bincount(at[self.kind == of], minlength=self.n_words if kind == WORD else self.n_pairs)


def pair_keys(words: np.ndarray, before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mixed(mixed(words[before]) + words[last])


def _order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys as they rise, and the rank of each key."""
    order = np.argsort(keys)
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.arange(len(keys))
    return order, rank


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """Values of one row at a time; a batch may hold many chunks, which are not opened at once."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield [column[i].as_py() for column in batch.columns]


def sent(chunks: DataFrame, ranges: int) -> DataFrame:
    """kind, range, chunk, keys (differences of rising hashes), kept and deleted counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, *values in _rows(batches):
            own = Chunk(*values)
            for kind in (PAIR, WORD):
                keys, kept, gone = own.keys(kind), own.counts(kind, 0), own.counts(kind, 1)
                part = ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                used, at = np.unique(part, return_index=True)
                cuts = [slice(a, b) for a, b in zip(at, [*at[1:], len(keys)], strict=True)]
                columns = [
                    pa.array([kind] * len(used), pa.int32()), pa.array(used, pa.int64()), pa.array([chunk] * len(used), pa.int64()),
                    pa.array([planes(np.diff(keys[x], prepend=np.uint64(0)), 8) for x in cuts], pa.binary()),
                    pa.array([planes(kept[x]) for x in cuts], pa.binary()), pa.array([planes(gone[x]) for x in cuts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "range", "chunk", "keys", "kept", "gone"])

    narrow = chunks.select("chunk", "words", "tokens", "outs", "gone", "lengths")
    return narrow.mapInArrow(rows, "kind int, range long, chunk long, keys binary, kept binary, gone binary")


def added(rows: pd.DataFrame) -> pd.DataFrame:
    """Totals over all chunks of the keys of one kind and range, for each chunk in its order;
    the first row says how many keys are kept, and kept or deleted, anywhere."""
    every = [np.cumsum(from_planes(x, 8), dtype=np.uint64) for x in rows["keys"]]
    found, at = np.unique(np.concatenate(every), return_inverse=True)
    kept, gone = (
        np.bincount(at, np.concatenate([from_planes(x) for x in rows[c]]), len(found)).astype(np.int64) for c in ("kept", "gone")
    )
    ends = np.cumsum([len(x) for x in every])[:-1]
    out = rows[["kind", "range", "chunk"]].copy()
    for name, total in (("kept", kept), ("gone", gone)):
        out[name] = [planes(x, 8) for x in np.split(total[at], ends)]
    first = np.arange(len(rows)) == 0
    out["n_kept"] = np.where(first, (kept > 0).sum(), 0)
    out["n_seen"] = np.where(first, (kept + gone > 0).sum(), 0)
    return out


def returned(chunk: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
    """A chunk with the totals of its words and pairs, and the vocabulary sizes it was told.

    Totals come in the order of their keys and are put in that of the places, so the words, half
    of a chunk, need not be written again."""
    out = chunk.iloc[:1].copy()
    opened = Chunk(None, *(out[c].iloc[0] for c in OPENED))
    words = np.frombuffer(out.pop("words").iloc[0], "<u8")
    orders = {PAIR: _order(pair_keys(words, opened.before, opened.last))[1], WORD: _order(words)[1]}
    totals = totals.sort_values(["kind", "range"])
    for kind, name in ((PAIR, "pair"), (WORD, "word")):
        own = totals[totals["kind"] == kind]
        for column in ("kept", "gone"):
            numbers = np.concatenate([from_planes(x, 8) for x in own[column]])
            out[f"{name}_{column}"] = [planes(numbers[orders[kind]], 8)]
    own = totals[totals["kind"] == WORD]
    out["n_kept"], out["n_seen"] = int(own["n_kept"].sum()), int(own["n_seen"].sum())
    return out


def bucket(seen: np.ndarray) -> np.ndarray:
    """Bucket of a context by how often it was seen; 0 for never."""
    return np.minimum(np.ceil(np.log2(seen + 1.0) / 2), BUCKETS - 1).astype(int)


def learned_weights(rows: pd.DataFrame) -> np.ndarray:
    """Weights of (pair, word, uniform) per bucket by expectation maximisation.

    Each row has a bucket, three probabilities and how often the held-out documents have
    it. A bucket without held-out counts takes the weights of all together; contexts never
    seen have no pairs, so their weight of pairs goes to the others."""
    p = rows[["p2", "p1", "p0"]].to_numpy()
    n, b = rows["n"].to_numpy(np.float64), rows["bucket"].to_numpy(int)

    def fit(which: np.ndarray) -> np.ndarray:
        weights = np.full(3, 1 / 3)
        if not n[which].sum():
            return weights
        for _ in range(TURNS):
            share = p[which] * weights
            total = share.sum(1, keepdims=True)
            weights = (n[which, None] * share / np.maximum(total, 1e-300)).sum(0)
            weights /= weights.sum()
        return np.maximum(weights, 1e-6) / np.maximum(weights, 1e-6).sum()

    every = fit(np.ones(len(n), bool))
    found = np.stack([fit(b == i) if n[b == i].sum() else every for i in range(BUCKETS)])
    found[0, 0] = 0
    found[0] /= found[0].sum()
    return found


OPENED = ["tokens", "outs", "gone", "lengths"]
TOTALS = ["pair_kept", "pair_gone", "word_kept", "word_gone"]


def scored(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    base_score is the add-one unigram score, score the log10 probability under the mixed
    model. A null or empty text has its end alone. A document without an id counts as the
    empty id, repeated rows as separate documents. Without documents to learn from, both
    scores rest on the uniform share. An empty table gives no rows; other columns are
    ignored.
    """
    spark = docs.sparkSession
    passing = [spool_path(spark), spool_path(spark)]
    chunks = chunked(docs, passing[0])
    each = F.transform(F.arrays_zip("outs", "gone", "lengths"), lambda x: F.when(x["outs"], 0).otherwise(x["lengths"]).cast("long"))
    add = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, b: a + b)
    kept_each = F.transform(F.arrays_zip("outs", "gone", "lengths"), lambda x: F.when(x["outs"] | x["gone"], 0).otherwise(x["lengths"]).cast("long"))
    sizes = chunks.agg(
        F.sum(add(F.transform("lengths", lambda x: x.cast("long")))), F.sum(add(each)), F.sum(add(kept_each))
    ).first()
    size, n_all, n_kept = (int(x or 0) for x in sizes)

    ranges = max(2 * part_count(spark), size // RANGE_KEYS)
    totals = sent(chunks, ranges).groupBy("kind", "range").applyInPandas(
        added, "kind int, range long, chunk long, kept binary, gone binary, n_kept long, n_seen long"
    )
    # written, so that the much larger rows they come from can go
    totals = compact(totals, passing[1])
    schema = CHUNKS.replace("words binary, ", "") + ", pair_kept binary, pair_gone binary, word_kept binary, word_gone binary, n_kept long, n_seen long"
    counted = compact(chunks.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInPandas(returned, schema))
    for path in passing:  # all that they hold is in the counted chunks
        delete(spark, path)
    kept_words, v = (int(x or 0) for x in counted.agg(F.sum("n_kept"), F.sum("n_seen")).first())

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Held-out counts by rounded probabilities: a table bounded by its steps."""
        step = lambda p: np.where(p > 0, np.rint(np.log(np.maximum(p, 1e-300)) * SCALE), -1e9).astype(np.int64)
        for *opened, pair, word in _rows(batches):
            own = Chunk(None, *opened)
            n = own.counts(PAIR, 1)
            some = np.flatnonzero(n)
            pair, word = from_planes(pair, 8).astype(np.float64), from_planes(word, 8).astype(np.float64)
            seen = word[own.before[some]]
            p2, p1 = pair[some] / np.maximum(seen, 1), word[own.last[some]] / max(n_kept, 1)
            keys = np.stack([bucket(seen), step(p2), step(p1)], 1)
            keys, at = np.unique(keys, axis=0, return_inverse=True)
            at = at.ravel()
            sums = [np.bincount(at, w * n[some], len(keys)) for w in (np.ones(len(some)), p2, p1)]
            columns = [*(pa.array(keys[:, i], pa.int64()) for i in range(3)), *(pa.array(x, pa.float64()) for x in sums)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "s2", "s1", "n", "p2", "p1"])

    steps = counted.select(*OPENED, "pair_kept", "word_kept").mapInArrow(
        held, "bucket long, s2 long, s1 long, n double, p2 double, p1 double"
    )
    rows = steps.groupBy("bucket", "s2", "s1").agg(
        F.sum("n").alias("n"), (F.sum("p2") / F.sum("n")).alias("p2"), (F.sum("p1") / F.sum("n")).alias("p1")
    ).toPandas()
    rows = rows.sort_values(["bucket", "s2", "s1"])
    rows["p0"] = 1.0 / (kept_words + 1)
    weights = learned_weights(rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, *opened, pair_kept, pair_gone, word_kept, word_gone in _rows(batches):
            own = Chunk(None, *opened)
            c2 = (from_planes(pair_kept, 8) + from_planes(pair_gone, 8)).astype(np.float64)
            c1 = (from_planes(word_kept, 8) + from_planes(word_gone, 8)).astype(np.float64)
            seen = c1[own.before]
            mix = weights[bucket(seen)]
            p = mix[:, 0] * c2 / np.maximum(seen, 1) + mix[:, 1] * c1[own.last] / max(n_all, 1) + mix[:, 2] / (v + 1)
            outs, lengths = np.asarray(opened[1], bool), np.asarray(opened[3], np.int64)
            starts = np.cumsum(lengths) - lengths
            columns = [
                pa.array(ids, pa.int64()), pa.array(outs), pa.array(lengths),
                pa.array(np.add.reduceat((c1 > 0).astype(np.int64)[own.tokens], starts)),
                pa.array(np.full(len(ids), n_all, np.int64)),
                pa.array(np.add.reduceat(np.log10(c1 + 1)[own.tokens], starts) - lengths * np.log10(n_all + v + 1.0)),
                pa.array(np.add.reduceat(np.log10(p)[own.places], starts)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return counted.select("doc_ids", *OPENED, *TOTALS).mapInArrow(score, schema)
