"""Quality scores learned from preferences between documents.

Each labelled document of the better class is preferred to one of the other, and each of the
other meets one of the better: pairs, made by seeded places in each class. The Bradley-Terry
model says that a document wins with the logistic function of the difference of scores; the
scores are linear in the features of a text, so the model is fitted by logistic loss on the
differences of features, over all pairs, by Newton steps whose sums Spark takes. A quantile of
the scores of the labelled documents, that which tells the classes apart best, becomes the
threshold.

Texts are read once; the features, some sixty bytes a document, are written and all later
steps read only those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringroster.llm.common import ranked, texts_of, windows_hash, word_hashes
from ringroster.spool import spooled, spooling

FOLDS = 5
THRESHOLD = 0.3  # score at the chosen quantile
STEPS = 12  # Newton steps
RIDGE = 1e-3
BINS = 4096
SEED = 12
SYMBOLS = list(b"#*$%&|<>")
NAMES = (
    "words", "symbols", "shouts", "digits", "capitals", "echoes", "distinct", "repeats",
    "same_lines", "word_length", "stops", "marks", "beyond_ascii", "line_length",
)
D = len(NAMES)


def features(text: str | None) -> list[float]:
    """Shares that tell prose from junk, each on a logarithmic scale and damped for short
    texts; zeros for no text."""
    if not text:
        return [0.0] * D
    data = np.frombuffer(text.encode(), np.uint8)
    count = np.bincount(data, minlength=256)
    words = word_hashes(text)
    n = len(words)
    runs = windows_hash(words, 5)
    lines = [line for line in text.split("\n") if line.strip()]
    capitals, small, beyond = int(count[65:91].sum()), int(count[97:123].sum()), int(count[128:].sum())
    symbols, stops, shouts = int(count[SYMBOLS].sum()), int(count[[44, 46]].sum()), int(count[33])
    digits = int(count[48:58].sum())
    marks = len(data) - capitals - small - beyond - symbols - stops - shouts - digits - int(count[[32, *range(9, 14)]].sum())
    per_word = [symbols, shouts, digits, int((words[1:] == words[:-1]).sum()), len(runs) - len(np.unique(runs)), stops, marks]
    symbol, shout, digit, echo, repeat, stop, mark = (math.log1p(50 * c / (n + 3)) for c in per_word)
    return [
        math.log1p(n), symbol, shout, digit,
        math.log1p(50 * capitals / (capitals + small + beyond + 10)), echo, len(np.unique(words)) / (n + 3),
        repeat, math.log1p(50 * (len(lines) - len(set(lines))) / (len(lines) + 3)),
        math.log1p(len(data) / (n + 1)), stop, mark, math.log1p(50 * beyond / (len(data) + 10)),
        math.log1p(n / (len(lines) + 1)),
    ]


def held_out(folds: int = FOLDS) -> Column:
    """Whether a document is kept out of learning; one without an id is not."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % folds == 0, F.lit(False))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features(t) for t in texts_of(batch.column(2))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(x, pa.list_(pa.float64()))], ["doc_id", "held_out", "x"])


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, D)


def _summed(df: DataFrame, part, size: int) -> np.ndarray:
    """Sum over all rows of an array of `size` numbers that `part` makes of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += part(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], ["slot", "v"])

    out = np.zeros(size)
    for r in df.mapInArrow(run, "slot int, v double").groupBy("slot").agg(F.sum("v").alias("v")).collect():
        out[r["slot"]] = r["v"]  # `size` rows
    return out


def preferences(labelled: DataFrame) -> DataFrame:
    """Pairs as differences `x` of features, better minus worse, from rows of good and x.

    The rows of a class are numbered in the order of a hash. The i-th of one class meets the
    i-th of the other, the smaller class beginning anew as often as needed, so there are as
    many pairs as the larger class has rows.
    """
    with spooling(ranked(labelled, ["good"], F.xxhash64(F.lit(SEED), "doc_id"), "place", ["x"])) as placed:
        sizes = {r["good"]: r["n"] for r in placed.groupBy("good").agg(F.count("*").alias("n")).collect()}
        turn = F.pmod("place", F.lit(max(1, min(sizes.get(0, 0), sizes.get(1, 0)))))
        better = placed.where("good = 1").select(turn.alias("turn"), F.col("x").alias("b"))
        worse = placed.where("good = 0").select(turn.alias("turn"), F.col("x").alias("w"))
        return spooled(better.join(worse, "turn").select(F.zip_with("b", "w", lambda b, w: b - w).alias("x")))


def fitted(pairs: DataFrame, spread: np.ndarray) -> np.ndarray:
    """Weights of the features that maximise the likelihood of all preferences; `spread` is
    the standard deviation of each feature. Zeros if there are no pairs."""
    w = np.zeros(D)
    for _ in range(STEPS):

        def part(batch: pa.RecordBatch, w: np.ndarray = w) -> np.ndarray:
            x = _matrix(batch, "x") / spread
            z = np.clip(x @ w, -500, 500)
            win = 1 / (1 + np.exp(-z))
            pull = x.T @ (1 - win)
            bend = (x * (win * (1 - win))[:, None]).T @ x
            return np.concatenate([[len(x)], pull, bend.ravel()])

        total = _summed(pairs, part, 1 + D + D * D)
        if not total[0]:
            return w
        pull = total[1 : 1 + D] / total[0] - RIDGE * w
        bend = total[1 + D :].reshape(D, D) / total[0] + RIDGE * np.eye(D)
        step = np.linalg.solve(bend, pull)
        w = w + step / max(1.0, float(np.abs(step).max()) / 4)
        if np.abs(step).max() < 1e-6:
            break
    return np.round(w, 4) / spread


def margin(weights: np.ndarray) -> Column:
    return sum((F.lit(float(w)) * F.col("x")[i] for i, w in enumerate(weights)), F.lit(0.0))


def cut(labelled: DataFrame, weights: np.ndarray) -> float:
    """Quantile of the labelled scores that tells the classes apart best: least share of the
    better below it plus share of the worse above. Where several do, the middle of them."""
    scored = labelled.select("good", margin(weights).alias("s"))
    low, high = scored.agg(F.min("s"), F.max("s")).first()
    if low is None or high <= low:
        return 0.0 if low is None else low
    bin_ = F.least(F.floor((F.col("s") - low) / (high - low) * BINS), F.lit(BINS - 1)).cast("int")
    table = np.zeros((2, BINS))
    for r in scored.groupBy("good", bin_.alias("bin")).count().collect():  # 2 * BINS rows at most
        table[r["good"], r["bin"]] = r["count"]
    total = np.maximum(table.sum(1), 1)
    lost = np.concatenate([[0], np.cumsum(table[1])]) / total[1]
    passed = 1 - np.concatenate([[0], np.cumsum(table[0])]) / total[0]
    best = np.flatnonzero(lost + passed <= (lost + passed).min() + 1e-12)
    edge = (best[0] + best[np.flatnonzero(np.diff(np.append(best, BINS + 9)) > 1)[0]]) / 2
    return float(low + (high - low) * edge / BINS)


def scored(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score (0 to 1, higher: better), predicted
    (1 if score >= threshold).

    `labels` has doc_id and quality. A document is good if every quality given for its id is
    1, other qualities than 0 and 1 say nothing; documents with crc32(id) mod `folds` = 0 are
    not learned from. Equal texts have equal scores; an empty or null text has the score of
    features that are all zero; without labels of both kinds every score is the threshold.
    Repeated rows each count, and an empty table gives no rows. Only doc_id, text and quality
    are read, so other columns may have any names.
    """
    narrow = docs.select(F.col("doc_id").cast("long"), held_out(folds).alias("held_out"), "text")
    rows = spooled(narrow.mapInArrow(_features, "doc_id long, held_out boolean, x array<double>"))
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("good"))
    labelled = rows.where(~F.col("held_out")).join(marked, "doc_id").select("doc_id", "good", "x")

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch, "x")
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    with spooling(labelled) as learned:
        total = _summed(learned, moments, 1 + 2 * D)
        n = max(total[0], 1)
        variance = total[1 + D :] / n - (total[1 : 1 + D] / n) ** 2
        spread = np.where(variance > 1e-9, np.sqrt(np.maximum(variance, 1e-9)), 1.0)
        weights = fitted(preferences(learned), spread)
        at = cut(learned, weights)
    base = math.log(threshold / (1 - threshold))
    z = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), margin(weights) - at)) + base
    score = 1 / (1 + F.exp(-z))
    # at the threshold itself rounding must not decide
    value = F.when(F.abs(z - base) < 1e-9, F.lit(threshold)).otherwise(score)
    return rows.select("doc_id", "held_out", value.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
