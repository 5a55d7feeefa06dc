"""Operators of the training-data pipeline against plain Python, on odd rows."""

import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ringroster.llm import (
    common,
    components,
    interpolation,
    jaccard_join,
    language,
    licenses,
    mixing,
    packing,
    quality,
    sharding,
    token_files,
    topk,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _tag string, size int"
LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(6000))
BASE = " ".join(f"word{i}" for i in range(60))
NEAR = BASE.replace("word59", "other")
ROWS = [
    (0, BASE, "en", "a"), (1, NEAR, "en", "a"), (2, BASE.upper(), None, None),
    (3, None, "en", "a"), (4, "", "fr", "b"), (5, " \n\t ", None, "b"), (6, "one two", "fr", "c"),
    (7, "ONE two", "fr", None), (8, LONG, "fr", "c"), (8, LONG, "fr", "c"), (9, "12 34!", "en", "b"),
    (None, "no id here, just nine words of text alone", "en", "a"), (None, None, None, None),
    (10, "Released under the MIT License. " + "le petit chat est sur la table " * 3, "fr", "c"),
    (11, "a\nb\na\n\n" + "x y z q v " * 4 + "$$ 50% <b>", "en", "z"),
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, len(r[1] or ""), "clash", 7) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def encoder():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(common.tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_mix_meets_targets(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    sizes = defaultdict(int)
    for r in ROWS:
        sizes[r[3]] += len(words(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, free, rest = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if 2 * sizes[s] < level * weight[s]}
        if not over:
            break
        for s in over:
            goal[s] = 2 * sizes[s]
            rest -= goal[s]
        free -= over
    goal |= {s: level * weight[s] for s in free}
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[r.source] += r.taken
    assert all(taken[s] <= goal[s] + 1 for s in goal)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(2)).collect()))
    assert mixing.mixed_documents(docs).count() == sum(r.copies for r in got)


def test_knapsack_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 40, 6))
        counts = rng.integers(0, 4, len(lengths))
        budget = int(rng.integers(0, 150))
        sums = {0}
        for n, c in zip(lengths.tolist(), counts.tolist(), strict=True):
            sums = {s + i * n for s in sums for i in range(c + 1)}
        best = max(s for s in sums if s <= budget)
        for taken in (mixing.knapsack(lengths, counts, budget), mixing.fill(lengths, counts, budget)):
            assert (taken <= counts).all() and (taken >= 0).all()
            assert int((taken * lengths).sum()) <= budget
        assert int((mixing.knapsack(lengths, counts, budget) * lengths).sum()) == best


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_jaccard_groups(spark, docs, n, percent):
    rng = np.random.default_rng(n)
    more = []
    for i in range(60):
        own = BASE.split()
        for at in rng.integers(0, 60, rng.integers(0, 5)):
            own[at] = f"edit{rng.integers(0, 4)}"
        more.append((100 + i, " ".join(own), "en", "a", 1, "x", 1))
    both = docs.union(spark.createDataFrame(more, SCHEMA))
    rows = [(r.doc_id, r.text) for r in both.collect()]

    def shingles(text):
        w = words(text)
        k = min(n, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    want = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in least[find(i)] if x is not None]
        want.append((d, len(sets[i]), min(known) if known and sets[i] else (d if not sets[i] else None)))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.linked(both, n, percent).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = jaccard_join.one_of_each(both, n, percent)
    assert kept.columns == both.columns
    wordless = sum(not s for s in sets)
    assert kept.count() == wordless + len({find(i) for i in range(len(rows)) if sets[i]})


def test_signatures_never_reject_similar_sets():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.93], rng.integers(0, 1 << 63, n // 9, dtype=np.uint64))))
        if len(b) and jaccard_join.similar(a, b, 80):
            x, y = (np.frombuffer(jaccard_join.signature(s), "u1") for s in (a, b))
            assert jaccard_join.may_be_similar(x, y, len(a) + len(b), 80)


def test_pairs_are_tested_by_columns_as_by_the_plain_tests(spark):
    rng = np.random.default_rng(3)
    rows, want = [], []
    for i in range(200):
        a = np.unique(rng.integers(0, 1 << 64, int(rng.integers(1, 400)), dtype=np.uint64))
        kept = a[rng.random(len(a)) < rng.choice([0.3, 0.85, 0.95, 1.0])]
        b = np.unique(np.concatenate((kept, rng.integers(0, 1 << 64, int(rng.integers(1, 40)), dtype=np.uint64))))
        x, y = (np.frombuffer(jaccard_join.signature(s), "<i8") for s in (a, b))
        rows.append((i, *([int(v) for v in s] for s in (a.view("<i8"), b.view("<i8"), x, y)), len(a) + len(b)))
        bits = [v.view("u1") for v in (x, y)]
        want.append((jaccard_join.similar(a, b, 85), jaccard_join.may_be_similar(*bits, len(a) + len(b), 85)))
    frame = spark.createDataFrame(rows, "i int, a array<long>, b array<long>, x array<long>, y array<long>, n long")
    found = frame.select(
        "i",
        jaccard_join._similar(F.col("a"), F.col("b"), 85).alias("s"),
        jaccard_join._may_be_similar(F.col("x"), F.col("y"), F.col("n"), 85).alias("m"),
    ).collect()
    assert [(r.s, r.m) for r in sorted(found)] == want
    assert {True, False} <= {s for s, _ in want} and (False, False) in want and len({len(r[3]) for r in rows}) > 2


def test_jaccard_passes_texts_to_workers_only_to_make_sets(spark, monkeypatch):
    """Each pass is a stage of as many tasks as a shuffle has partitions, however few the rows."""
    passes = []
    kind = type(spark.range(0))
    run = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: passes.append(1) or run(self, *a, **b))
    texts = [" ".join(f"w{j}" if j != 3 * i else f"own{i}" for j in range(150)) for i in range(40)] + ["own words of one text", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    context = spark.sparkContext
    context.setJobGroup("few-stages", "")
    try:
        got = {r.doc_id: r.component_id for r in jaccard_join.linked(docs, 4, 85).collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert got == {i: 0 if i < 40 else i for i in range(42)}
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few-stages") for s in tracker.getJobInfo(j).stageIds}
    ran = [s for s in map(tracker.getStageInfo, stages) if s and s.numCompletedTasks]
    assert len(passes) == 5, len(passes)
    assert len(ran) <= 70, len(ran)


def test_sketches_differ_no_more_than_sets():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 400)), dtype=np.uint64)) for _ in range(2))
        b = np.union1d(b[: int(rng.integers(1, 40))], a[rng.random(len(a)) < 0.9])
        x, y = jaccard_join.sketch(a), jaccard_join.sketch(b)
        assert x.shape == (jaccard_join.SKETCH,)
        assert int(np.bitwise_count((x ^ y).view("u8")).sum()) <= len(np.setxor1d(a, b))
    assert not jaccard_join.sketch(np.empty(0, np.uint64)).any()


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_places_are_never_beyond_the_true_ones(spark, percent):
    rows = []
    for n in (1, 2, 7, 100, 140, 5000, 70_000):
        t = jaccard_join.needed(n, percent)
        for reach in range(1, min(jaccard_join.REACH, t) + 1):
            length = n - t + reach
            for place in {0, length // 3, length // 2, length - 1}:
                rows.append((n << 32 | place * 256 // length << 24 | 5 << 4 | 8 | reach, place, length))
    frame = spark.createDataFrame(rows, "meta long, place int, length int")
    got = frame.select("place", "length", jaccard_join._place("meta", percent).alias("p")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.p <= r.place and (r.p == r.place or r.length > 256)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = components.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 140)}


def test_stars_end_without_a_round_that_changes_nothing(spark, monkeypatch):
    rounds = []
    small = components._small
    monkeypatch.setattr(components, "_small", lambda edges: rounds.append(1) or small(edges))
    schema = "u long, v long"
    star = spark.createDataFrame([(i, 1) for i in range(2, 30)] + [(90, 70), (70, 90), (None, 3), (5, 5)], schema)
    edges = components.stars(star)
    assert not rounds
    assert {tuple(r) for r in edges.collect()} == {(i, 1) for i in range(2, 30)} | {(90, 70)}
    assert not components.stars(spark.createDataFrame([], schema)).collect() and not rounds
    # stars found before stand for their links
    more = edges.unionByName(spark.createDataFrame([(29, 90), (0, 70)], schema))
    got = {(r.node, r.root) for r in components.rooted(components.stars(more)).collect()}
    assert rounds and got == {(i, 0) for i in [*range(30), 70, 90]}


def test_packing(spark, docs):
    placed = packing.packed(docs)
    got = placed.collect()
    tokenizer = encoder()
    want = Counter()
    for r in ROWS:
        ids = ids_of(tokenizer, r[1])
        for start in range(0, len(ids), 2048):
            part = np.array(ids[start : start + 2048], "<u4").tobytes()
            want[(r[0], start, len(part) // 4, zlib.crc32(part), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    whole = packing.sequences(placed).collect()
    assert sum(len(r.ids) // 4 for r in whole) == sum(r.length for r in got)


def test_patterns_use_every_piece():
    rng = np.random.default_rng(5)
    counts = np.zeros(257, np.int64)
    counts[1:] = rng.poisson(20, 256)
    used = np.zeros(257, np.int64)
    patterns = packing.solve(counts)
    for lengths, times in patterns:
        assert sum(lengths) <= 256 and times > 0
        np.add.at(used, list(lengths), times)
    assert (used == counts).all()
    full = (counts * np.arange(257)).sum() / (256 * sum(t for _, t in patterns))
    assert full > 0.98


def test_token_files(spark, docs, tmp_path):
    tokenizer = encoder()
    got = [tuple(r) for r in token_files.round_trip(docs).collect()]
    got.sort(key=lambda r: r[1])
    assert [r[0] is not None for r in got] == sorted(r[0] is not None for r in got)
    named = [r[0] for r in got if r[0] is not None]
    assert named == sorted(named)
    start, want = 0, Counter()
    for r in got:
        assert r[1] == start
        start += r[2]
    for r in ROWS:
        ids = np.array(ids_of(tokenizer, r[1]), "<u4")
        want[(r[0], len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r[0], r[2], r[3]) for r in got) == want
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(docs, folder)
    one = token_files.read_tokens(spark, folder).where("doc_id = 6").collect()
    assert len(one) == 1 and one[0].ids == ids_of(tokenizer, "one two")


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 1000])
def test_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n)).collect()]
    assert sorted(got) == list(range(n))


def test_sharding(docs):
    got = sharding.sharded(docs).collect()
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.get(i, 0) for i in range(8)) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(c)) for s, c in counts.items())
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    covered = set()
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    for i in range(len(w) - 4):
        if seen[tuple(w[i : i + 5])] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(docs):
    got = quality.judged(docs).collect()
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert found == Counter((r[0], *base_counts(r[1])) for r in ROWS)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.passing(docs).columns == docs.columns


def planted(seed, letters, sizes):
    """Clean documents of an invented language, and some spoilt in three ways."""
    rng = np.random.default_rng(seed)
    vocabulary = ["".join(rng.choice(letters, int(rng.integers(2, 9)), p=np.arange(len(letters), 0, -1) / sum(range(len(letters) + 1)))) for _ in range(400)]
    clean, spoilt = [], []
    for i in range(400):
        words = list(rng.choice(vocabulary, int(rng.choice(sizes))))
        clean.append(" ".join(words))
        if i % 20 == 0:
            mixed_up = "".join(rng.permutation(list("".join(words))))
            at = np.cumsum([len(w) for w in words])
            spoilt.append(" ".join(mixed_up[a:b] for a, b in zip([0, *at[:-1]], at, strict=True)))
            spoilt.append(" ".join(w + "***" for w in words))
            spoilt.append("".join(rng.choice(list("qxzj#%&0123456789"), len(" ".join(words)))) + " a b c d e f g h i j")
    return clean, spoilt


@pytest.mark.parametrize(
    ("letters", "sizes"),
    [
        (list("etaoinshrdlucmfwyp"), [40, 60]), (list("etaoinshrdlucmfwyp"), [300, 500]),
        (list("оеаинтсрвлкмдпуяыьгзбч"), [40, 60]), (list("оеаинтсрвлкмдпуяыьгзбч"), [300, 500]), (list("αεοιτσνηυρπκμλ"), [120]),
    ],
)
def test_perplexity_rejects_what_is_planted(spark, letters, sizes):
    """Shuffled letters of any script, marks in every word, and noise, in short and long texts."""
    clean, spoilt = planted(41, letters, sizes)
    rows = [(i, t, "xx") for i, t in enumerate(clean + spoilt)]
    got = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert sum(i in kept for i in range(len(clean))) >= 0.98 * len(clean)
    assert sum(i in kept for i in range(len(clean), len(rows))) <= 0.05 * len(spoilt)
    assert all(r.lower < r.upper for r in got)


def test_a_language_hardly_seen_is_not_judged_by_others(spark):
    clean, _ = planted(42, list("etaoinshrdlu"), [60])
    rare, _ = planted(43, list("оеаинтсрвлк"), [60])
    rows = [(i, t, "en") for i, t in enumerate(clean)] + [(1000 + i, t, "ru") for i, t in enumerate(rare[:5])]
    got = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r.kept and r.lower is None for r in got if r.doc_id >= 1000)


def test_documents_full_of_symbols_alone(spark):
    rows = [(i, "a*** b### c$$$ " * 10, None) for i in range(3)]
    got = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == 3 and all(r.log_perplexity is not None for r in got)


def tongues(n):
    """Texts in invented languages of their own syllables, and of an odd one."""
    out = {}
    for name, letters in (("aa", "etaoinsh"), ("bb", "etoilqur"), ("cc", "zkwvyxaj")):
        rng = np.random.default_rng(len(out) + 50)
        syllables = ["".join(rng.choice(list(letters), int(rng.integers(2, 4)))) for _ in range(40)]
        weight = 1 / np.arange(1, 41)

        def text(syllables=syllables, weight=weight / weight.sum(), rng=rng):
            size = int(rng.integers(12, 200))
            return " ".join("".join(rng.choice(syllables, int(rng.integers(1, 4)), p=weight)) for _ in range(size))

        out[name] = [text() for _ in range(n)]
    return out


@pytest.mark.parametrize("known", [1, 2, 4, 30])
def test_a_language_with_few_labels_is_not_rejected(spark, known):
    texts = tongues(120)
    rows = [(i, t, "aa") for i, t in enumerate(texts["aa"])] + [(1000 + i, t, "bb") for i, t in enumerate(texts["bb"])]
    rows += [(5000 + i, t, None) for i, t in enumerate(texts["cc"])]
    learning = [i for i in range(2000, 4000) if zlib.crc32(str(i).encode()) % 3 != 1][:known]
    rows += [(i, t, "cc") for i, t in zip(learning, texts["cc"], strict=False)]
    rows += [(9000 + i, texts["bb"][0], "bb") for i in range(80)]  # a group of copies teaches once
    rows += [(9900, "0123 wqpx 77 ztq# bvnm ggggg " * 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r.doc_id: r for r in language.identified(docs).collect()}
    rest = [got[5000 + i] for i in range(120)]
    assert sum(r.lang_pred == "cc" for r in rest) >= 118
    assert sum(r.rejected for r in rest) <= 2
    assert sum(got[i].rejected for i in range(120)) <= 2 and sum(got[1000 + i].rejected for i in range(120)) <= 2
    assert got[9900].rejected


def test_sample_takes_each_text_once(spark):
    rows = [(i, "same text of words", "aa") for i in range(300)] + [(1000 + i, f"text {chr(97 + i % 26)}{'b' * i}", "aa") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    seen = []
    language_fit = language.fit
    try:
        language.fit = lambda samples: seen.append(samples) or language_fit(samples)
        language.learned(docs, 20)
        language.learned(docs)
    finally:
        language.fit = language_fit
    assert len(seen[0]) == 20
    assert len({c.tobytes() for _, c in seen[1]}) == len(seen[1]) <= 61


def test_learning_holds_the_rows_of_one_language_at_a_time():
    rng = np.random.default_rng(52)
    samples = []
    for k in range(12):
        for _ in range(60):
            counts = np.zeros(language.WIDTH)
            counts[rng.integers(k * 300, k * 300 + 600, 200)] += rng.integers(1, 9, 200)
            packed = language.packed_counts(counts)
            assert sum(map(len, packed)) <= 6 * 200
            assert (language.unpacked_counts(*packed) == counts).all()
            samples.append((f"l{k:02}", language.unpacked_counts(*packed)))
    tracemalloc.start()
    try:
        model = language.fit(samples)
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert held < len(samples) * language.WIDTH * 8  # less than all rows as doubles once
    # the same model as from all rows together
    counts = np.stack([c for _, c in samples]).astype(np.float64)
    assert (model.idf == np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1).all()
    rows = language.unit(np.log1p(counts) * model.idf)
    for k in range(12):
        own, _ = language.clusters(rows[60 * k : 60 * k + 60], language.CENTROIDS, language.SEED)
        assert (np.array([c for c, n in zip(model.centroids, model.languages, strict=True) if n == f"l{k:02}"]) == own).all()


def test_texts_pass_to_workers_in_small_batches(spark, monkeypatch):
    before = spark.conf.get(common.BATCH)
    seen = []
    written = packing.spooled
    monkeypatch.setattr(packing, "spooled", lambda df: seen.append(df.sparkSession.conf.get(common.BATCH)) or written(df))
    docs = spark.createDataFrame([(i, f"word{i} other words") for i in range(2500)], "doc_id long, text string").coalesce(1)
    assert packing.pieces(docs).count() == 2500
    assert seen == [str(common.BATCH_ROWS)] and spark.conf.get(common.BATCH) == before


def test_left_out_cosines():
    rng = np.random.default_rng(51)
    rows = language.unit(rng.random((12, 30)))
    centres, at = language.clusters(rows, 3, 1)
    got = language.left_out(rows, centres, at)
    for i, row in enumerate(rows):
        best = []
        for j, centre in enumerate(centres):
            others = [k for k in range(12) if at[k] == j and k != i]
            if at[i] == j:
                best.append(row @ language.unit(rows[others].sum(0)[None])[0] if others else 0.0)
            else:
                best.append(row @ centre)
        assert got[i] == pytest.approx(max(best))


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(4)
    text = "".join(rng.choice(list("abc d"), 4000))
    codes, counts = np.unique(quality.gram_codes(quality.char_classes(text)), return_counts=True)
    model = quality.kneser_ney(codes, counts)
    for context in (codes // quality.CLASSES)[:50]:
        every = context * quality.CLASSES + np.arange(quality.CLASSES)
        assert np.exp(model.log_probs(every)).sum() == pytest.approx(1.0, abs=0.05)
    junk = quality.gram_codes(quality.char_classes("zq%zq#zq"))
    assert model.log_probs(junk).mean() < model.log_probs(codes).mean()


def test_language(docs):
    got = language.identified(docs).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert 0 <= r.score <= 1
    by_text = {(r.doc_id, r.lang_pred) for r in got}
    assert {(3, "und"), (4, "und"), (5, "und"), (9, "und")} <= by_text
    assert all(p in ("en", "fr", "und") for _, p in by_text)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_every_license_is_found_anywhere(spark, name):
    assert licenses.collision_chance(len(licenses.normalised(licenses.TEMPLATES[name]))) > 0.99
    rows = [(i, " ".join(["filler"] * i) + " " + licenses.TEMPLATES[name] + " and more") for i in range(40)]
    rows.append((99, "the license of a fisherman under the sea is no license to fish"))
    found = licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in found.where(found.license == name).collect()} == set(range(40))


def test_lm_scores(docs):
    tokens = [(r[0], [*words(r[1]), None]) for r in ROWS]
    count = Counter()
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    for d, t in tokens:
        if not out(d):
            count.update(t)
    n, v = sum(count.values()), len(count)
    want = sorted((str(d), out(d), len(t), sum(x in count for x in t), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t), 6)) for d, t in tokens)
    got = interpolation.scored(docs).collect()
    found = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert found == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(700)]
    rows += [(700, None), (750, [float("nan")] * 8), (800, [1.0, None]), (None, [1.0] * 8), (850, [3.0])]
    rows += [(i, [0.5] * 8) for i in range(900, 950)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = sorted(tuple(r) for r in topk.nearest(df).collect())
    whole = {i: [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (8 - len(v)) for i, v in rows if i is not None and v and None not in v and not any(map(math.isnan, v))}
    want = []
    for q in whole:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best[:5])]
    assert got == sorted(want)


def test_empty_tables(spark, empty):
    for result in (
        mixing.mix(empty), jaccard_join.linked(empty), packing.packed(empty), token_files.round_trip(empty),
        sharding.sharded(empty), quality.judged(empty), language.identified(empty),
        licenses.scanned(empty), interpolation.scored(empty),
        topk.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ):
        assert result.collect() == []


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, now, str(tmp_path))
        path = str(tmp_path / name)
        after.write.parquet(path)
        if name != "packing":
            assert after.columns == docs.columns
        before, now = now, spark.read.parquet(path)
        if name in ("language_id", "quality_rules", "near_duplicates"):
            assert now.exceptAll(before).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()
    ends = now.where("start + length = doc_tokens").count()
    assert ends == spark.read.parquet(str(tmp_path / "source_mix")).count()


def test_lm_scores_use_the_true_word_before(spark, monkeypatch):
    rng = np.random.default_rng(3)
    ring = [f"w{k}" for k in rng.permutation(300)]  # each word has one successor
    rows = [(i, " ".join((ring * 3)[k : k + 400])) for i, k in enumerate(rng.integers(0, 300, 60))]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    each = [r.score / 400 for r in interpolation.scored(table).collect() if r.held_out]
    assert each and min(each) > -0.1
    # with fixed weights, the score is that of a plain count of all pairs, over several chunks
    monkeypatch.setattr(interpolation, "learned_weights", lambda rows: np.full((interpolation.BUCKETS, 3), 1 / 3))
    one, two, context = Counter(), Counter(), Counter()
    tokens = {i: [*t.split(), None] for i, t in rows}
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            one.update(t)
            context.update([None, *t[:-1]])
            two.update(zip([None, *t], t))
    n = sum(one.values())
    for r in interpolation.scored(table).collect():
        t = tokens[r.doc_id]
        p = [(two[a, b] / max(context[a], 1) + one[b] / n + 1 / (len(one) + 1)) / 3 for a, b in zip([None, *t], t)]
        assert r.score == pytest.approx(sum(map(math.log10, p)))


def test_distinct_pieces_encode_as_whole_texts_do():
    """Texts in which marks, contractions, special tokens and odd letters meet."""
    rng = np.random.default_rng(21)
    marks = list("abcXYZ'.,!<|>é—İ \n\t12²漢́ßǅ")
    texts = ["".join(rng.choice(marks, int(rng.integers(0, 50)))) for _ in range(3000)]
    texts += [
        None, "", " \n", "it's dogs' it'. x'.y don't.won't ''s", "(the) \"quoted\"... a—. b….", "x<|endoftext|>. <|x",
        "İstanbul, İ. ÇĞ", "İ" * 300 + " abc", "Русский, текст! العربية، नमस्ते.", "a" * 5000, "ab." * 3000, LONG,
    ]
    tokenizer = encoder()
    got = list(common.token_bytes(texts, common.tokenizer_path()))
    assert got == [np.array(ids_of(tokenizer, t), "<u4").tobytes() for t in texts]


def test_memo_forgets_without_losing(monkeypatch):
    monkeypatch.setattr(common, "MEMO", 50)
    monkeypatch.setattr(common, "GROUP", 200)
    common._token_memo.clear()
    rng = np.random.default_rng(22)
    texts = [" ".join(f"w{chr(97 + i % 26)}{'x' * (i % 9)}." for i in rng.integers(0, 900, 30)) for _ in range(60)]
    tokenizer = encoder()
    got = list(common.token_bytes(texts, common.tokenizer_path()))
    assert got == [np.array(ids_of(tokenizer, t), "<u4").tobytes() for t in texts]
    memo = common._token_memo.pop(common.tokenizer_path())
    assert len(memo.before) <= len({w for t in texts for w in t.split()})


def test_even_lengths_are_packed_full():
    rng = np.random.default_rng(23)
    for window, most in ((512, 3), (2048, 30)):
        counts = np.concatenate(([0], rng.poisson(most, window)))
        patterns = packing.solve(counts)
        used = np.zeros(window + 1, np.int64)
        for lengths, times in patterns:
            assert sum(lengths) <= window
            for n in lengths:
                used[n] += times
        assert (used == counts).all()
        sequences = sum(times for _, times in patterns)
        assert sequences <= sum(times for _, times in packing.greedy(counts))
        if window == 2048:
            assert (counts * np.arange(window + 1)).sum() / (window * sequences) > 0.995


def test_least_squares_meets_what_can_be_met():
    rng = np.random.default_rng(24)
    combos = packing.combinations(np.concatenate(([0], np.ones(64, np.int64))))
    x = np.where(rng.random(len(combos)) < 0.1, rng.integers(1, 90, len(combos)), 0)
    goal = np.bincount(combos.ravel(), np.repeat(x, 3), minlength=65).astype(float)
    goal[0] = 0
    found = packing.least_squares(combos, goal, 4000)
    got = np.bincount(combos.ravel(), np.repeat(found, 3), minlength=65)
    assert (found >= 0).all() and np.abs(got - goal)[1:].sum() < 0.01 * goal.sum()


def test_mixture_weights_are_the_most_likely():
    """Of each bucket, no other weights make the held-out counts likelier."""
    import pandas as pd

    rng = np.random.default_rng(31)
    n = 400
    rows = pd.DataFrame(
        {
            "bucket": rng.integers(1, 4, n), "n": rng.integers(1, 50, n),
            "p2": np.where(rng.random(n) < 0.5, rng.random(n), 0), "p1": rng.random(n) / 50, "p0": 1e-4,
        }
    )
    found = interpolation.learned_weights(rows)

    def likelihood(w, part):
        return float((part["n"] * np.log(part[["p2", "p1", "p0"]].to_numpy() @ w)).sum())

    for b in (1, 2, 3):
        part = rows[rows["bucket"] == b]
        best = likelihood(found[b], part)
        assert found[b].sum() == pytest.approx(1) and (found[b] > 0).all()
        for _ in range(300):
            assert likelihood(rng.dirichlet(np.ones(3)), part) <= best + 1e-3 * abs(best)
        for i in range(3):
            for j in range(3):
                moved = found[b].copy()
                step = min(0.02, moved[i] / 2)
                moved[i] -= step
                moved[j] += step
                assert likelihood(moved, part) <= best + 1e-4 * abs(best)
    # a bucket without held-out counts takes the weights of all; one never seen has no pairs
    assert found[5] == pytest.approx(found[6]) and found[0, 0] == 0


def test_shuffle_files_of_finished_plans_go(spark):
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()

    def held():
        return len(list(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(tracker.shuffleStatuses()).keySet()))

    common.free_shuffles(spark)
    before = held()
    wide = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert common.compact(wide).count() == 7
    during = held()
    del wide
    common.free_shuffles(spark)
    assert during > before and held() <= before


@pytest.mark.parametrize("stride", [1, 2, 3, 9])
def test_band_keys_in_blocks_are_those_of_their_windows(monkeypatch, stride):
    monkeypatch.setattr(licenses, "BLOCK", 32)
    rng = np.random.default_rng(stride)
    texts = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 5, 40, 200)]
    shingles, gap, _ = licenses.laid_out(texts, stride)
    a, b = licenses.permutations(6)
    keys = licenses.band_keys(shingles, gap, stride, 3, 2)
    for w in range(len(shingles) // stride - 3):
        window = slice(w * stride, (w + 4) * stride)
        for band in range(3):
            key = np.zeros(1, np.uint64)
            for i in (2 * band, 2 * band + 1):
                h = np.where(gap[window], np.uint64(1 << 63), (shingles[window] * a[i] + b[i]) >> np.uint64(1))
                key = key * np.uint64(0x9E3779B97F4A7C15) + h.min()
            assert keys[band, w] == key[0]


def test_lm_scores_leave_the_counted_chunks_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "checkpoint_folder", lambda _: str(tmp_path))
    docs = spark.createDataFrame([(i, f"a b c{i % 7} d") for i in range(60)], "doc_id long, text string")
    rows = interpolation.scored(docs)
    assert len(list(tmp_path.iterdir())) == 1
    assert rows.count() == 60
    assert spark.conf.get(common.FREED, None) is None


def test_lm_totals_return_in_the_order_of_places():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    tokens = np.append(np.arange(50), rng.integers(0, 50, 400))
    opened = interpolation.planes(tokens), [False], [False], [len(tokens)]
    full, plain = interpolation.Chunk(words.tobytes(), *opened), interpolation.Chunk(None, *opened)
    totals = pd.DataFrame(
        [
            {"kind": kind, "range": 0, "kept": interpolation.planes(n, 8), "gone": interpolation.planes(n * 2, 8), "n_kept": 1, "n_seen": 2}
            for kind in (interpolation.PAIR, interpolation.WORD)
            for n in [full.counts(kind, 0)]
        ]
    )
    chunk = pd.DataFrame([dict(zip(["words", "tokens", "outs", "gone", "lengths"], [words.tobytes(), *opened], strict=True))])
    out = interpolation.returned(chunk, totals)
    assert "words" not in out
    for kind, name in ((interpolation.PAIR, "pair"), (interpolation.WORD, "word")):
        own = interpolation.from_planes(out[f"{name}_kept"].iloc[0], 8)
        assert own.tolist() == plain.counts(kind, 0).tolist()
        assert (interpolation.from_planes(out[f"{name}_gone"].iloc[0], 8) == 2 * own).all()


def test_pieces_remembered_are_bounded():
    path = common.tokenizer_path()
    texts = [" ".join(f"w{i}x{j}" for j in range(50)) for i in range(20)]
    plain = list(common.token_bytes(texts, path))
    common._token_memo.pop(path)
    few = [next(common.token_bytes([t], path, 60)) for t in texts]
    memo = common._token_memo.pop(path)
    assert few == plain and len(memo) + len(memo.before) < 300
