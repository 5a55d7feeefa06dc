"""Ranked lexical search: the best documents for each of a set of items, by dual-tree search.

Items and documents are sparse vectors over terms: an item has a weight for each of its
terms, a document a saturated frequency, and a score is their inner product in whole numbers.
Both sides stand in hierarchies whose nodes hold the largest value of every coordinate below
them: documents in blocks, nodes, leaves and rows, items in nodes, leaves and rows. The inner
product of two nodes' maxima bounds every score between them. A pair of nodes whose bound is
below the weakest k-th score of the items beneath is left out whole, otherwise the search
descends. Nothing else is ever left out, so the result is exact.

Texts are read once a pass. Blocks of documents lie where they were read, none is shuffled;
the items come to the documents. A pass takes items of CHUNK_TERMS terms together, so what is
sent to the tasks is bounded; more items take more passes. One block of each part is searched
first, and the k-th scores found there are where all other blocks start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringroster.llm.common import ALNUM_GAP, texts_of, word_hashes
from ringroster.spool import spooled, spooling

K = 10
CHUNK_TERMS = 1_000_000  # terms of the items of one pass
BLOCK = 4096  # documents
BLOCK_TERMS = 2_000_000  # terms of a block's documents
NODE = 256  # documents
NODE_TERMS = 16_384
LEAF = 8
ITEM_NODE = 64  # items
ITEM_LEAF = 8
EXACT = 1 << 52  # whole numbers up to here are exact as floats
ROUND = 1 + 1e-9  # what rounding may take from a bound
NO_ID = np.iinfo(np.int64).max

BLOCKS = (
    "number int, docs long, words long, ids binary, lengths binary, sizes binary,"
    " terms binary, counts binary, df_terms array<int>, df_counts array<long>"
)
FOUND = "place int, doc_id long, score long"


def term_hashes(text: str | None) -> np.ndarray:
    """Terms of a text in order: runs of ASCII letters and digits and of all characters
    beyond ASCII, A-Z as a-z, each as a 64-bit hash."""
    return word_hashes(text, gaps=ALNUM_GAP)


def _vectors(vocabulary: np.ndarray):
    """Texts into blocks of sparse vectors over a vocabulary (sorted term hashes).

    Documents without any of its terms are counted and left out: their scores are 0.
    """

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, _Held()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                words = term_hashes(text)
                if not len(words):
                    continue
                held.docs += 1
                held.words += len(words)
                at = np.searchsorted(vocabulary, words)
                at[at == len(vocabulary)] = 0
                terms, counts = np.unique(at[vocabulary[at] == words], return_counts=True)
                if len(terms):
                    held.add(NO_ID if doc_id is None else doc_id, len(words), terms, counts)
                    if len(held.ids) == BLOCK or held.size > BLOCK_TERMS:
                        yield held.row(number)
                        number, held = number + 1, _Held()
        if held.docs:
            yield held.row(number)

    return collect


@dataclass
class _Held:
    """Documents of a block being read."""

    docs: int = 0
    words: int = 0
    size: int = 0
    ids: list[int] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    terms: list[np.ndarray] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)

    def add(self, doc_id: int, length: int, terms: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.lengths.append(length)
        self.terms.append(terms)
        self.counts.append(counts)
        self.size += len(terms)

    def row(self, number: int) -> pa.RecordBatch:
        terms = np.concatenate([*self.terms, np.empty(0, np.int64)])
        counts = np.concatenate([*self.counts, np.empty(0, np.int64)])
        seen, df = np.unique(terms, return_counts=True)
        values = [
            number, self.docs, self.words,
            np.array(self.ids, "<i8").tobytes(), np.array(self.lengths, "<i8").tobytes(),
            np.array([len(t) for t in self.terms], "<i8").tobytes(),
            terms.astype("<i4").tobytes(), counts.astype("<i8").tobytes(),
            seen.astype("<i4"), df.astype("<i8"),
        ]
        kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int32()), pa.list_(pa.int64())]
        names = [c.split()[0] for c in BLOCKS.split(",")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


@dataclass(frozen=True)
class Level:
    """One level of the item hierarchy: the nodes that hold each term.

    A term weighs the same in every item, so the maximum of a node is that weight if one of
    its items has the term.
    """

    size: int
    starts: np.ndarray  # of each term in `nodes`
    nodes: np.ndarray

    @staticmethod
    def of(terms: np.ndarray, nodes: np.ndarray, n_terms: int, size: int) -> Level:
        pairs = np.unique(terms * size + nodes)
        starts = np.searchsorted(pairs, np.arange(n_terms + 1) * size)
        return Level(size, starts, pairs % size)

    def maxima(self, terms: np.ndarray, weights: np.ndarray, kept: np.ndarray) -> np.ndarray:
        """terms x kept nodes."""
        counts = self.starts[terms + 1] - self.starts[terms]
        nodes = self.nodes[_places(self.starts[terms], counts)]
        column = np.full(self.size, -1)
        column[kept] = np.arange(len(kept))
        column = column[nodes]
        row = np.repeat(np.arange(len(terms)), counts)
        out = np.zeros((len(terms), len(kept)), weights.dtype)
        met = column >= 0
        out[row[met], column[met]] = weights[terms][row[met]]
        return out


@dataclass
class Search:
    """The item hierarchy and the best documents of each item so far."""

    weights: np.ndarray
    items: Level
    leaves: Level
    nodes: Level
    weak: np.ndarray  # k-th score of each item, 0 while there are fewer
    k: int
    pairs: int = 0  # pairs of rows scored
    scores: np.ndarray = field(init=False)
    docs: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.scores = np.zeros((self.items.size, self.k), np.int64)
        self.docs = np.full((self.items.size, self.k), NO_ID, np.int64)

    @staticmethod
    def of(sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray, weak: np.ndarray, k: int) -> Search:
        """Items in order, each with `sizes` of `terms`."""
        item = np.repeat(np.arange(len(sizes)), sizes)
        n = len(weights)
        whole = int(weights.max(initial=0)) * 10**6 * int(sizes.max(initial=0)) < EXACT
        levels = [Level.of(terms, item // s, n, max(1, -(-len(sizes) // s))) for s in (1, ITEM_LEAF, ITEM_NODE)]
        return Search(weights.astype(np.float64 if whole else np.int64), *levels, weak.copy(), k)

    def weakest(self, span: int) -> np.ndarray:
        return np.minimum.reduceat(self.weak, np.arange(0, len(self.weak), span))

    def offer(self, items: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        """Take in the scores of docs x items."""
        self.pairs += scores.size
        new = scores.T.astype(np.int64)
        good = (new >= self.weak[items][:, None]) & (new > 0)
        hit = good.any(1)
        who = items[hit]
        new = np.where(good[hit], new[hit], 0)
        names = np.where(new > 0, docs[None, :], NO_ID)
        s = np.concatenate([self.scores[who], new], 1)
        d = np.concatenate([self.docs[who], names], 1)
        first = np.lexsort((d, -s), axis=1)[:, : self.k]
        self.scores[who] = np.take_along_axis(s, first, 1)
        self.docs[who] = np.take_along_axis(d, first, 1)
        self.weak[who] = np.maximum(self.weak[who], self.scores[who, -1])

    def block(self, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        """Search the documents of a block; `terms` and `values` hold their vectors in turn."""
        if not len(ids):
            return
        starts = np.cumsum(sizes) - sizes
        # documents with the same most telling term come together, so maxima stay low
        telling = self.weights[terms] * values
        best = np.maximum.reduceat(telling, starts)
        tops = np.flatnonzero(telling == np.repeat(best, sizes))
        lead = terms[tops[np.searchsorted(tops, starts)]]
        order = np.lexsort((ids, -best, lead))
        at = _places(starts[order], sizes[order])
        ids, sizes, terms, values = ids[order], sizes[order], terms[at], values[at]
        held = np.unique(terms)
        by_term = np.argsort(terms, kind="stable")
        top = np.maximum.reduceat(values[by_term], np.searchsorted(terms[by_term], held))
        every = np.arange(self.nodes.size)
        bound = top.astype(self.weights.dtype) @ self.nodes.maxima(held, self.weights, every) * ROUND
        alive = every[(bound > 0) & (bound >= self.weakest(ITEM_NODE))]
        if not len(alive):
            return
        for a, b in self._spans(sizes):
            lo, hi = int(sizes[:a].sum()), int(sizes[:b].sum())
            self._node(ids[a:b], sizes[a:b], terms[lo:hi], values[lo:hi], alive)

    @staticmethod
    def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
        a, held = 0, 0
        for b, n in enumerate(sizes.tolist()):
            if b > a and (b - a == NODE or held + n > NODE_TERMS):
                yield a, b
                a, held = b, 0
            held += n
        if len(sizes) > a:
            yield a, len(sizes)

    def _node(self, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray, nodes: np.ndarray) -> None:
        w = self.weights
        own, column = np.unique(terms, return_inverse=True)
        rows = np.zeros((len(ids), len(own)), w.dtype)
        rows[np.repeat(np.arange(len(ids)), sizes), column] = values
        begin = np.arange(0, len(ids), LEAF)
        leaf_top = np.maximum.reduceat(rows, begin, axis=0)
        bound = leaf_top.max(0) @ self.nodes.maxima(own, w, nodes) * ROUND
        nodes = nodes[(bound > 0) & (bound >= self.weakest(ITEM_NODE)[nodes])]
        for node in nodes.tolist():
            per = ITEM_NODE // ITEM_LEAF
            leaves = np.arange(node * per, min((node + 1) * per, self.leaves.size))
            bounds = leaf_top @ self.leaves.maxima(own, w, leaves) * ROUND
            open_ = (bounds > 0) & (bounds >= self.weakest(ITEM_LEAF)[leaves])
            leaves = leaves[open_.any(0)]
            if not len(leaves):
                continue
            items = (leaves[:, None] * ITEM_LEAF + np.arange(ITEM_LEAF)).ravel()
            items = items[items < self.items.size]
            vectors = self.items.maxima(own, w, items)
            bounds = leaf_top @ vectors * ROUND
            for i in np.argsort(-bounds.max(1), kind="stable").tolist():
                near = np.flatnonzero((bounds[i] > 0) & (bounds[i] >= self.weak[items]))
                if len(near):
                    part = slice(begin[i], begin[i] + LEAF)
                    self.offer(items[near], ids[part], rows[part] @ vectors[:, near])


def frequencies(counts: np.ndarray, lengths: np.ndarray, docs: int, words: int) -> np.ndarray:
    """Saturated frequency of each term: (10**9 * tf) div (1000 * tf + 8 * m)."""
    if docs * 90 * int(lengths.max(initial=0)) < 1 << 62:
        m = 10 + (90 * lengths * docs) // words
    else:
        m = np.array([10 + (90 * n * docs) // words for n in lengths.tolist()], np.int64)
    return (10**9 * counts) // (1000 * counts + 8 * m)


def _searching(search, docs: int, words: int):
    """Blocks into the best documents of each item among them. `search` makes a new Search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = search()
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths, sizes, counts = (np.frombuffer(row[c], "<i8") for c in ("ids", "lengths", "sizes", "counts"))
                terms = np.frombuffer(row["terms"], "<i4").astype(np.int64)
                values = frequencies(counts, np.repeat(lengths, sizes), docs, words)
                state.block(ids, sizes, terms, values)
        at, col = np.nonzero(state.scores)
        found = state.docs[at, col]
        arrays = [pa.array(at, pa.int32()), pa.array(found, pa.int64(), mask=found == NO_ID), pa.array(state.scores[at, col], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["place", "doc_id", "score"])

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.unique(term_hashes(t)) for t in texts_of(batch.column(1))]
        arrays = [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["item_id", "h", "size", "terms"])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _pass(docs: DataFrame, items: list, k: int) -> DataFrame:
    """item_id, rank, doc_id, score for items whose terms fit one pass."""
    spark = docs.sparkSession
    sets = [np.frombuffer(r["terms"], "<u8") for r in items]
    vocabulary = np.unique(np.concatenate(sets))
    with spooling(docs.mapInArrow(_vectors(vocabulary), BLOCKS)) as blocks:
        total = blocks.agg(F.sum("docs"), F.sum("words")).first()
        n_docs, n_words = total[0] or 0, total[1] or 0
        each = F.explode(F.arrays_zip("df_terms", "df_counts")).alias("t")
        df = blocks.select(each).groupBy("t.df_terms").agg(F.sum("t.df_counts").alias("n")).collect()
        # as many as the vocabulary has terms, which CHUNK_TERMS bounds
        seen = np.zeros(len(vocabulary))
        for r in df:
            seen[r["df_terms"]] = r["n"]
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * seen + 1))).astype(np.int64)
        weights[seen == 0] = 0

        own = [np.searchsorted(vocabulary, s) for s in sets]
        own = [t[seen[t] > 0] for t in own]
        lead = [int(t[np.argmax(weights[t])]) if len(t) else -1 for t in own]
        order = sorted(range(len(items)), key=lambda i: (lead[i], items[i]["h"]))
        sizes = np.array([len(own[i]) for i in order], np.int64)
        terms = np.concatenate([*(own[i] for i in order), np.empty(0, np.int64)])
        none = np.zeros(len(items), np.int64)
        columns = [c.split()[0] for c in BLOCKS.split(",")[:8]]

        def search(which, weak: np.ndarray) -> DataFrame:
            run = _searching(lambda: Search.of(sizes, terms, weights, weak, k), n_docs, n_words)
            found = blocks.where(which).select(*columns).mapInArrow(run, FOUND)
            return spooled(_best(found, k).drop("rank"))

        first = search(F.col("number") == 0, none)
        weak = none.copy()
        for r in first.groupBy("place").agg(F.min("score").alias("s"), F.count("*").alias("n")).where(F.col("n") == k).collect():
            weak[r["place"]] = r["s"]  # one row for each item of the pass
        best = _best(first.unionByName(search(F.col("number") > 0, weak)), k)
        names = spark.createDataFrame([(p, items[i]["item_id"]) for p, i in enumerate(order)], "place int, item_id long")
        return spooled(best.join(names, "place").select("item_id", "rank", "doc_id", "score"))


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = K, chunk_terms: int = CHUNK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents with a score above 0 of each item.

    Equal scores go to the smaller doc_id, a null one last. Every row of `docs` is a document
    of its own, so repeated rows take a rank each; a null, empty or term-free text has no
    score. An item given twice is answered once; two items with one id and different texts
    are answered each. Items without a term that occurs have no rows, nor have empty tables.
    Only doc_id, item_id and the texts are read, so other columns may have any names.
    """
    asked = items.select(F.col("item_id").cast("long"), "text").dropDuplicates()
    keyed = asked.withColumn("h", F.xxhash64(F.lit(11), "item_id", "text"))
    kinds = "item_id long, h long, size long, terms binary"
    vectors = spooled(keyed.mapInArrow(_item_terms, kinds))
    total = vectors.agg(F.sum("size")).first()[0] or 0
    passes = max(1, -(-total // chunk_terms))
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    out = []
    for p in range(passes):
        part = vectors.where((F.pmod("h", F.lit(passes)) == p) & (F.col("size") > 0)).collect()
        if part:  # about chunk_terms terms
            part.sort(key=lambda r: (r["h"], r["item_id"] is None, r["item_id"] or 0))
            out.append(_pass(texts, part, k))
    if not out:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, out)
