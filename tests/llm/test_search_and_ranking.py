"""Lexical search, preference scores and centroids against plain Python, on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ringroster.llm import centroids, lexical, preference

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
EXTRA = "_tag string, place int, rank int, score double, h long"
CLASH = ("clash", 3, 4, 0.5, 9)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def searched(docs, items, k):
    """Every score, from the definition."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        scores = []
        for d, b in bags:
            m = 10 + (90 * sum(b.values()) * n_docs) // n_words
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m))
                for t in set(terms(text))
                if t in b
            )
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        scores = sorted(scores, key=lambda x: x[:3])
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(scores[:k])]
    return sorted(out, key=repr)


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    names = [f"t{i}" for i in range(120)]
    weight = 1 / np.arange(1, 121)
    out = []
    for i in range(n):
        size = int(rng.integers(0, 60))
        out.append((i, " ".join(rng.choice(names, size, p=weight / weight.sum()))))
    return out


ODD_DOCS = [
    (500, None), (501, ""), (502, " \n-- ??"), (None, "t1 t2 rare"), (503, "t1 t2 rare"), (503, "t1 t2 rare"),
    (504, "T1,t2;RARE"), (505, "É t1_été Été rare"), (506, "t3 " * 30_000 + "rare"),
]
ODD_ITEMS = [
    (0, "t1 t2 t3 t4 t5"), (1, "rare"), (2, "été t90 t91"), (3, None), (4, ""), (5, "unheard of"),
    (6, "t1 " * 50), (6, "t1 " * 50), (6, "t7 other"), (None, "t80 rare"),
]


def frames(spark, docs, items):
    d = spark.createDataFrame([(*r, *CLASH) for r in docs], f"doc_id long, text string, {EXTRA}")
    i = spark.createDataFrame([(*r, *CLASH) for r in items], f"item_id long, text string, {EXTRA}")
    return d, i


@pytest.mark.parametrize("chunk", [lexical.CHUNK_TERMS, 8])
def test_search_finds_the_best(spark, chunk):
    docs = corpus(300, 1) + ODD_DOCS
    items = [(10 + i, t) for i, t in corpus(25, 2)] + ODD_ITEMS
    d, i = frames(spark, docs, items)
    got = lexical.ranked_documents(d.repartition(3), i, chunk_terms=chunk)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == searched(docs, items, 10)


def test_search_of_nothing(spark):
    d, i = frames(spark, ODD_DOCS, ODD_ITEMS)
    none = d.where("false"), i.where("false")
    for docs, items in ((none[0], i), (d, none[1]), none):
        assert lexical.ranked_documents(docs, items).collect() == []


def search_state(docs, items, k):
    sets = [np.unique(lexical.term_hashes(t)) for _, t in items]
    vocabulary = np.unique(np.concatenate(sets))
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"doc_id": d, "text": t} for d, t in docs])
    rows = [r for b in lexical._vectors(vocabulary)(iter([batch])) for r in b.to_pylist()]
    n, words = sum(r["docs"] for r in rows), sum(r["words"] for r in rows)
    df = np.zeros(len(vocabulary))
    for r in rows:
        df[r["df_terms"]] += r["df_counts"]
    weights = np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)
    own = sorted(
        ((t := np.searchsorted(vocabulary, s))[df[t] > 0] for s in sets),
        key=lambda t: int(t[np.argmax(weights[t])]) if len(t) else -1,
    )
    sizes = np.array([len(t) for t in own])
    state = lexical.Search.of(sizes, np.concatenate(own), weights, np.zeros(len(own), np.int64), k)
    for r in rows:
        ids, lengths, per, counts = (np.frombuffer(r[c], "<i8") for c in ("ids", "lengths", "sizes", "counts"))
        t = np.frombuffer(r["terms"], "<i4").astype(np.int64)
        state.block(ids, per, t, lexical.frequencies(counts, np.repeat(lengths, per), n, words))
    return state


def test_search_leaves_most_pairs_out():
    """Documents on few subjects: bounds must spare most of the scoring."""
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"s{i % 50}w{x}" for x in rng.integers(0, 40, 30))) for i in range(6000)]
    items = [(i, " ".join(f"s{i % 50}w{x}" for x in range(12))) for i in range(100)]
    state = search_state(docs, items, 10)
    assert state.pairs < 0.05 * len(docs) * len(items)
    assert (state.scores[:, -1] > 0).all()


def test_level_maxima():
    level = lexical.Level.of(np.array([0, 2, 2, 3]), np.array([0, 0, 1, 2]), 5, 3)
    weights = np.array([5, 6, 7, 8, 9])
    got = level.maxima(np.array([0, 2, 3, 4]), weights, np.array([2, 0]))
    assert got.tolist() == [[0, 5], [0, 7], [8, 0], [0, 0]]


# preference scores


def labelled(n, seed):
    rng = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"word{x}" for x in rng.integers(0, 400, int(rng.integers(20, 80)))]
        good = i % 4 != 0
        if not good:
            kind = i % 3
            words = [w + "***" for w in words] if kind == 0 else [w.upper() + "!!" for w in words] if kind == 1 else [w for w in words[:5] for _ in range(12)]
        docs.append((i, " ".join(words)))
        labels.append((i, int(good)))
    return docs, labels


def label_frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], f"doc_id long, quality int, {EXTRA}")


def doc_frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], f"doc_id long, text string, {EXTRA}").repartition(3)


def test_preferences_tell_held_out_documents_apart(spark):
    docs, labels = labelled(400, 3)
    odd = [(900, None), (901, ""), (902, " \n "), (903, "a b"), (903, "a b"), (None, "no id"), (904, "x" * 200_000), (905, "ok " * 60_000)]
    got = preference.scored(doc_frame(spark, docs + odd), label_frame(spark, [*labels, (None, 0), (900, None), (901, 7), (77, 1), (77, 0)])).collect()
    assert len(got) == len(docs) + len(odd)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and all(r.predicted == truth[r.doc_id] for r in held)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert len({r.score for r in got if r.doc_id in (900, 901)}) == 1
    assert len({r.score for r in got if r.doc_id == 903}) == 1


def test_held_out_labels_are_not_learned(spark):
    docs, labels = labelled(200, 4)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    a, b = (preference.scored(doc_frame(spark, docs), label_frame(spark, x)).collect() for x in (labels, flipped))
    assert {r.doc_id: round(r.score, 9) for r in a} == {r.doc_id: round(r.score, 9) for r in b}


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 0)]])
def test_one_class_teaches_nothing(spark, labels):
    docs = [(i, f"word {i} here") for i in range(10)]
    got = preference.scored(doc_frame(spark, docs), label_frame(spark, labels)).collect()
    assert len(got) == 10 and {r.predicted for r in got} <= {0, 1}
    assert preference.scored(doc_frame(spark, docs).where("false"), label_frame(spark, labels)).count() == 0


def test_every_row_takes_part_in_pairs(spark):
    rows = [(i, 1, [float(i)] * preference.D) for i in range(7)] + [(100 + i, 0, [-100.0 * (i + 1)] * preference.D) for i in range(3)]
    pairs = preference.preferences(spark.createDataFrame(rows, "doc_id long, good int, x array<double>")).collect()
    gaps = [round(r.x[0]) for r in pairs]
    assert len(gaps) == 7
    assert sorted(g % 100 for g in gaps) == list(range(7))  # each better row once
    assert sorted(Counter(g // 100 for g in gaps).values()) == [2, 2, 3]  # the worse in turn


def test_fit_maximises_the_likelihood(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, preference.D)) + 0.3
    pairs = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(3)
    w = preference.fitted(pairs, np.ones(preference.D))
    # the gradient of mean log likelihood minus the ridge, by definition
    pull = (x * (1 / (1 + np.exp(x @ w)))[:, None]).mean(0) - preference.RIDGE * w
    assert np.abs(pull).max() < 1e-4


# centroids


def clustered(rows, k, rounds, width):
    """Lloyd's rounds in whole numbers, from the definition."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]

    def name(i):
        return (i is None, "" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest())

    centres = [v for _, v in sorted(kept, key=lambda r: (*name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    final = [nearest(v) for _, v in kept]
    total = Counter()
    for d, j in final:
        total[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        ((i, j, d, total[j], sum(total.values()), sha[j]) for (i, _), (d, j) in zip(kept, final, strict=True)), key=repr
    )


VECTORS = f"vec_id long, embedding array<float>, cluster string, distance int, vec int, {EXTRA}"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1, 2, *CLASH) for i, v in rows], VECTORS).repartition(3)


def test_clusters_are_those_of_plain_rounds(spark):
    rng = np.random.default_rng(6)
    spots = rng.normal(size=(5, 64)) * 2
    rows = [(i, (spots[i % 5] + rng.normal(size=64) * (0.2 + i % 3)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)] + [rows[0]] * 3  # copies and repeated rows
    rows += [(2000, None), (2001, []), (2002, [0.0] * 63), (2003, [float("nan")] * 64), (2004, [float("inf")] * 64)]
    rows += [(2005, [None] + [0.0] * 63), (None, [0.5] * 64), (None, [0.5] * 64), (2006, [0.0] * 64), (2007, [90_000.0] + [0.0] * 63)]
    got = centroids.clustered(vector_frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == clustered(rows, 8, 10, 64)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.25] * 64), (2, [0.25] * 64), (3, [0.5] * 64)]
    got = centroids.clustered(vector_frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == clustered(rows, 8, 10, 64)
    assert centroids.clustered(vector_frame(spark, rows).where("false")).collect() == []


def test_later_rounds_scan_few_vectors():
    rng = np.random.default_rng(9)
    spots = rng.integers(-2000, 2000, (4, 16))
    vectors = (spots[np.arange(4000) % 4] + rng.integers(-60, 60, (4000, 16))).astype(np.int32)
    heaps = centroids.Heaps(np.zeros(4000, np.uint8), [[(-np.inf, i) for i in range(4000)]])
    centres, drift = vectors[:4].astype(np.int64), np.zeros(4)
    counts, sums = np.zeros(4, np.int64), np.zeros((4, 16), np.int64)
    scanned = []
    for n in range(6):
        more, moved, seen = centroids.rescan(heaps, vectors, centres, drift, n == 0)
        scanned.append(seen)
        counts, sums = counts + more, sums + moved
        own = centroids.distances(vectors, centres).argmin(1)
        assert (heaps.own == own).all() and sorted(r for h in heaps.heaps for _, r in h) == list(range(4000))
        assert (counts == np.bincount(own, minlength=4)).all()
        new = sums // counts[:, None]
        drift, centres = drift + centroids.moves(centres, new), new
    assert scanned[0] == 4000 and max(scanned[1:]) < 400


def test_distances_of_large_components():
    a = np.array([[1 << 27, -(1 << 27)]], np.int64)
    assert centroids.distances(a, -a).tolist() == [[2 * (1 << 28) ** 2]]
