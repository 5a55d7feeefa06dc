"""Language identification by nearest centroids.

A text is the vector of its character trigrams, hashed to a fixed width, weighted by TF-IDF
and normalised. Each language has several centroids, found by spherical k-means over a
bounded sample of its labelled documents. A text takes the language of the nearest centroid
by cosine; one further from all than documents of that language ever are is rejected. How far
that is, is taken from documents compared with centroids they had no part in.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringroster.llm.common import repeat_rows, row_tag, texts_of
from ringroster.spool import spooled

WIDTH = 4096
PER_LANGUAGE = 400  # labelled documents a language is learned from, at most
CENTROIDS = 4
TURNS = 12
SEED = 7
SLACK = 0.5  # share of the first percentile of a language's own cosines
SUPPORT = 20  # documents a language needs for a least cosine of its own
SHORT = 200  # trigrams below which a text may lie further from its centroid
GROUP = 64  # texts compared at once
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def features(text: str) -> np.ndarray:
    """Counts of hashed trigrams of the letters of a text; other characters are gaps."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4").astype(np.int64)
    plain = (codes >= 97) & (codes <= 122)
    codes = np.where(plain, codes - 96, np.where(codes < 170, 0, 32 + codes % 1009))
    codes = np.concatenate(([0], codes, [0]))
    if len(codes) < 3:
        return np.zeros(WIDTH)
    gram = (codes[:-2] * 2048 + codes[1:-1]) * 2048 + codes[2:]
    inner = gram[codes[1:-1] > 0]
    at = ((inner * 0x9E3779B1) & 0xFFFFFFFF) >> 20
    return np.bincount(at, minlength=WIDTH).astype(np.float64)


def packed_counts(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Places of the trigrams that a text has, and their counts: few of all places."""
    at = np.flatnonzero(counts)
    return at.astype("<u2").tobytes(), counts[at].astype("<f4").tobytes()


def unpacked_counts(at: bytes, n: bytes) -> np.ndarray:
    counts = np.zeros(WIDTH, np.float32)
    counts[np.frombuffer(at, "<u2")] = np.frombuffer(n, "<f4")
    return counts


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1.0)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]  # of each centroid
    floors: np.ndarray  # least cosine of each centroid, for a text that is not short

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.log1p(counts) * self.idf)

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the nearest centroid, its cosine, and whether that is too far."""
        cosine = self.vectors(counts) @ self.centroids.T
        at = cosine.argmax(1)
        best = np.clip(cosine[np.arange(len(at)), at], 0.0, 1.0)
        return at, best, best < self.floors[at] * np.minimum(1.0, np.sqrt(counts.sum(1) / SHORT))


def clusters(rows: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids and the place of each row."""
    rng = np.random.default_rng(seed)
    k = min(k, len(rows))
    centres = rows[rng.choice(len(rows), k, replace=False)]
    at = np.zeros(len(rows), np.int64)
    for _ in range(TURNS):
        at = (rows @ centres.T).argmax(1)
        sums = np.stack([rows[at == i].sum(0) for i in range(k)])
        empty = ~sums.any(1)
        centres = np.where(empty[:, None], centres, unit(sums))
    return centres, at


def left_out(rows: np.ndarray, centres: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cosine of each row with the nearest centroid, its own being that of the other rows."""
    cosine = rows @ centres.T
    for i in range(len(centres)):
        own = np.flatnonzero(at == i)
        rest = unit(rows[own].sum(0) - rows[own])
        cosine[own, i] = (rows[own] * rest).sum(1)
    return cosine.max(1)


def fit(samples: list[tuple[str, np.ndarray]]) -> Model | None:
    """Model from (language, counts), sorted so that a rerun agrees.

    The least cosine of a language is SLACK times the first percentile of its documents'
    cosines, each left out of its own centroid. A language of fewer than SUPPORT documents
    takes it from the cosines of single documents with each other in the languages that have
    them, as its centroids are hardly more than single documents; without such languages
    nothing is too far.
    """
    if not samples:
        return None
    there = np.zeros(len(samples[0][1]), np.int64)
    places = defaultdict(list)
    for i, (name, counts) in enumerate(samples):
        there += counts > 0
        places[name].append(i)
    idf = np.log((1 + len(samples)) / (1 + there)) + 1
    centres, languages, own_floors, pairs = [], [], {}, []
    for name in sorted(places):  # rows of one language at a time
        own = np.stack([samples[i][1] for i in places[name]]).astype(np.float64)
        own = unit(np.log1p(own, out=own) * idf)
        found, at = clusters(own, CENTROIDS, SEED)
        if len(own) >= SUPPORT:
            own_floors[name] = SLACK * np.quantile(left_out(own, found, at), 0.01)
            pairs.append(np.quantile((own @ own.T)[~np.eye(len(own), dtype=bool)], 0.01))
        centres += [c for i, c in enumerate(found) if (at == i).any()]
        languages += [name] * (len(centres) - len(languages))
    single = SLACK * min(pairs, default=0.0)
    floors = [min(own_floors.get(name, single), 1.0) for name in languages]
    return Model(idf, np.stack(centres), languages, np.array(floors))


def held_out(docs: DataFrame) -> Column:
    """Whether a document is kept out of learning; one without an id is not."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


def learned(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Learn from at most `per_language` different texts of each language that have letters
    and a label and are not held out, taken in the order of a hash.

    How many rows a language has says how small a share of the hashes is enough for four times
    the sample, so that only these are ranked, however many rows a language has.
    """
    usable = docs.where(~held_out(docs) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    keyed = usable.select("lang", F.xxhash64(F.lit(SEED), "text").alias("h"), "text")
    sizes = keyed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    if not sizes:  # one row for each language, of which the model holds centroids anyway
        return None
    most = [x for r in sizes for x in (F.lit(r["lang"]), F.lit(4 * per_language / max(r["n"], 1)))]
    share = F.pmod("h", F.lit(1 << 30)) / (1 << 30)
    few = keyed.where(share <= F.element_at(F.create_map(*most), F.col("lang")))
    first = Window.partitionBy("lang").orderBy("h")
    ranked = few.dropDuplicates(["lang", "h"]).withColumn("n", F.row_number().over(first))
    met = ranked.where(F.col("n") <= per_language).select("lang", "h", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = texts_of(batch.column(2))
            for lang, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                if has_letter(text):
                    rows.append((lang, h, *packed_counts(features(text))))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "h", "at", "n"])

    rows = met.mapInArrow(count, "lang string, h long, at binary, n binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["h"]))
    return fit([(r["lang"], unpacked_counts(r["at"], r["n"])) for r in rows])


def identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score, rejected, `_tag`.

    lang_pred is `und` with score 0 if the text is null or has no letter (or nothing could
    be learned); such documents are rejected, as are those too far from the centroid they
    are nearest to. Only the text is used, whole, however long. Of equally near centroids the
    first by language wins. Repeated rows are treated alike, and teach once; an empty table
    gives no rows; other columns may have any names.
    """
    model = model or learned(docs)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(3))
            n = batch.num_rows
            names, scores, odd = ["und"] * n, np.zeros(n), np.ones(n, bool)
            places: list[int] = []
            counts: list[np.ndarray] = []

            def compare() -> None:
                if counts:
                    at, best, far = model.nearest(np.stack(counts))
                    for place, i, b, f in zip(places, at, best, far, strict=True):
                        names[place], scores[place], odd[place] = model.languages[i], b, f
                places.clear()
                counts.clear()

            for i, text in enumerate(texts):
                if model is not None and has_letter(text):
                    places.append(i)
                    counts.append(features(text))
                    if len(places) == GROUP:
                        compare()
            compare()
            arrays = [*batch.columns[:3], pa.array(names, pa.string()), pa.array(scores), pa.array(odd)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "_tag", "lang_pred", "score", "rejected"])

    keyed = docs.select(F.col("doc_id").cast("long"), held_out(docs).alias("held_out"), row_tag(docs).alias("_tag"), "text")
    return keyed.mapInArrow(scan, "doc_id long, held_out boolean, _tag long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose language is not rejected."""
    kept = spooled(identified(docs).where("not rejected").select("_tag")).groupBy("_tag")
    plan = kept.agg(F.count("*").alias("_times")).withColumn("_copies", F.col("_times"))
    return repeat_rows(docs, plan)
