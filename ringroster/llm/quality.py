"""Quality rules: counts of a text, and perplexity bands of an n-gram model.

The model is a modified Kneser-Ney model over characters: ASCII letters, some kinds of marks,
and all other letters hashed into 32 classes, so that every script has an order of letters to
be judged by. Spark counts the n-grams of all documents of the core, those that pass the base
rules and are not full of symbols; 64 classes and four of them in an n-gram bound the table
of counts, and the model: sorted arrays of n-gram codes with their log-probabilities. Each
language has bands around its usual perplexity, one for each class of lengths, learned from
the core, and documents below or above theirs are rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringroster.llm.common import repeat_rows, row_tag, texts_of, windows_hash, word_hashes
from ringroster.spool import spooled

ORDER = 4
CLASSES = 64
MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20
WHITE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
SYMBOL_PERCENT = 10  # symbols by words above which a document is not of the core
FENCE = 3.0  # half width of a band beyond the quartiles, in quartile ranges
LEAST_RANGE = 0.03  # of log perplexity
SUPPORT = 30  # documents of the core that a band needs
LENGTHS = (200, 400, 800, 1600, 3200)  # characters at which a class of lengths begins
SHORT = 1500  # characters below which a text may stray further, where all lengths share a band
CHUNK = 2 << 20  # characters scored at once
# classes: 0 white space, 1-26 ASCII letters, 27 digits, 28 sentence marks, 29 other ASCII
# characters, 30 other characters that are no letters, 32-63 other letters by a hash
_HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")


def _class_table() -> np.ndarray:
    table = np.zeros(1 << 16, np.uint8)
    for code in range(len(table)):
        c = chr(code)
        if c in WHITE:
            table[code] = 0
        elif code < 128 and c.isalpha():
            table[code] = 1 + ord(c.lower()) - ord("a")
        elif code < 128:
            table[code] = 27 if c.isdigit() else 28 if c in ".,;:!?'\"-()" else 29
        elif c.isalpha():
            table[code] = 32 + (ord(c.lower()[0]) * 0x9E3779B1 >> 7) % 32
        else:
            table[code] = 30
    return table


_TABLE = _class_table()


def char_classes(text: str) -> np.ndarray:
    """Classes of the code points; those beyond 65535 count as other letters."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.where(codes < 1 << 16, _TABLE[codes & 0xFFFF], 32 + codes % 32).astype(np.int64)


def gram_codes(classes: np.ndarray) -> np.ndarray:
    """Code of the n-gram that ends at each character; a text begins after white space."""
    padded = np.concatenate((np.zeros(ORDER - 1, np.int64), classes))
    size, code = len(classes), np.zeros(len(classes), np.int64)
    for i in range(ORDER):
        code = code * CLASSES + padded[i : i + size]
    return code


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = word_hashes(text, lower=False)
    chars = len(text) - sum(text.count(c) for c in WHITE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if _HAS_WORD.search(x)]
    repeated = 0
    windows = windows_hash(words, REPEAT_WINDOW)
    if len(windows):
        _, at, count = np.unique(windows, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[at] > 1)
        if len(twice):
            covered = np.zeros(len(words) + 1, np.int64)
            np.add.at(covered, twice, 1)
            np.add.at(covered, twice + REPEAT_WINDOW, -1)
            repeated = int((np.cumsum(covered) > 0).sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


@dataclass(frozen=True)
class Model:
    """Sorted n-gram codes and log-probabilities of each order, with the backoff weight of
    each context; grams[0] are single classes."""

    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]

    def log_probs(self, codes: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of the last class of each n-gram."""
        return self._at(ORDER - 1, codes)

    def _at(self, level: int, codes: np.ndarray) -> np.ndarray:
        keys = self.grams[level]
        at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
        out = self.logs[level][at]
        missing = np.flatnonzero(keys[at] != codes)
        if len(missing):
            if level == 0:
                out[missing] = -np.log(CLASSES + 1.0) - 5.0
            else:
                gone = codes[missing]
                context, heads = gone // CLASSES, self.contexts[level]
                there = np.minimum(np.searchsorted(heads, context), len(heads) - 1)
                weight = np.where(heads[there] == context, self.backoffs[level][there], 0.0)
                out[missing] = weight + self._at(level - 1, gone % CLASSES**level)
        return out


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> Model:
    """Interpolated modified Kneser-Ney: three discounts per order from the counts of
    counts; lower orders count in how many contexts an n-gram continues."""
    order = np.argsort(codes)
    tables = [(codes[order], counts[order].astype(np.float64))]
    for level in range(ORDER - 1, 0, -1):
        short, n = np.unique(tables[0][0] % CLASSES**level, return_counts=True)
        tables.insert(0, (short, n.astype(np.float64)))
    grams, logs, contexts, backoffs = [], [], [], []
    lower: np.ndarray | None = None
    for level, (keys, n) in enumerate(tables):
        d = discounts(n)
        cut = d[np.minimum(n, 3).astype(int)]
        heads, at = np.unique(keys // CLASSES, return_inverse=True)
        total = np.bincount(at, n)
        spare = np.bincount(at, cut) / total
        below = np.full(len(keys), 1.0 / CLASSES)
        if level:
            below = np.exp(lower[np.searchsorted(grams[-1], keys % CLASSES**level)])
        lower = np.log(np.maximum((n - cut) / total[at] + spare[at] * below, 1e-30))
        grams.append(keys)
        logs.append(lower)
        contexts.append(heads)
        backoffs.append(np.log(np.maximum(spare, 1e-30)))
    return Model(grams, logs, contexts, backoffs)


def discounts(n: np.ndarray) -> np.ndarray:
    """Discount for a count of 0, 1, 2, and 3 or more; half the count where the counts of
    counts do not give one."""
    c = [float((n == i).sum()) for i in range(1, 5)]
    out = np.array([0.0, 0.5, 1.0, 1.5])
    if c[0] and c[1]:
        y = c[0] / (c[0] + 2 * c[1])
        for i in range(1, 4):
            if c[i - 1]:
                out[i] = min(max(i - (i + 1) * y * c[i] / c[i - 1], 0.05), i - 0.05)
    return out


def failed(n_words, n_repeat_words):
    """The base rules, of numbers or columns."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > REPEAT_PERCENT * n_words)


def lean(n_words, n_symbols):
    """Whether a document is not full of symbols."""
    return 100 * n_symbols <= SYMBOL_PERCENT * n_words


def counted_grams(docs: DataFrame, core: bool = True) -> DataFrame:
    """code and n over all texts of the core, or over all; at most CLASSES ** ORDER rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        held: list[np.ndarray] = []
        size = 0

        def merge() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate([*held, np.empty(0, np.int64)]), return_counts=True)
            every, at = np.unique(np.concatenate([codes, new]), return_inverse=True)
            return every, np.bincount(at, np.concatenate([counts, n]), len(every)).astype(np.int64)

        for batch in batches:
            for text in texts_of(batch.column(0)):
                if not text:
                    continue
                if core:
                    n_words, _, n_symbols, _, n_repeat = text_counts(text)
                    if failed(n_words, n_repeat) or not lean(n_words, n_symbols):
                        continue
                held.append(gram_codes(char_classes(text)))
                size += len(text)
                if size > CHUNK:
                    codes, counts = merge()
                    held, size = [], 0
        codes, counts = merge()
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])

    made = docs.select("text").mapInArrow(count, "code long, n long")
    return made.groupBy("code").agg(F.sum("n").alias("n"))


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang, _tag, the counts, n_chars and log_perplexity (null for an empty text)."""
    schema = "doc_id long, lang string, _tag long, " + ", ".join(f"{m} long" for m in MEASURES)
    schema += ", n_chars long, log_perplexity double"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in texts_of(batch.column(3)):
                value = None
                if text and model is not None:
                    value = float(-model.log_probs(gram_codes(char_classes(text))).mean())
                rows.append((*text_counts(text), len(text or ""), value))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64()] * 6 + [pa.float64()]
            arrays = [*batch.columns[:3], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            names = ["doc_id", "lang", "_tag", *MEASURES, "n_chars", "log_perplexity"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    keyed = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), row_tag(docs).alias("_tag"), "text")
    return spooled(keyed.mapInArrow(scan, schema))


def judged(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang): the counts, log_perplexity, lower and
    upper (the band of its language, for its length), base_failed, kept, `_tag`.

    Null and empty texts have counts of 0 and fail the base rules. Documents without a
    language share bands. A band lies FENCE quartile ranges beyond the quartiles of its core
    documents. Where a class of lengths has fewer than SUPPORT of them, the band of the whole
    language holds, wider for short texts; a language with fewer has none, as nothing is known
    of it, and its documents are kept if they pass the base rules. Without any core document
    the model is that of all. Repeated rows are judged alike; an empty table gives no rows;
    other columns are ignored.
    """
    table = counted_grams(docs).toPandas()  # at most CLASSES ** ORDER rows
    if not len(table):
        table = counted_grams(docs, core=False).toPandas()
    model = kneser_ney(table["code"].to_numpy(), table["n"].to_numpy()) if len(table) else None
    size = sum((F.col("n_chars") >= x).cast("int") for x in LENGTHS)
    found = measured(docs, model).withColumns(
        {
            "base_failed": failed(F.col("n_words"), F.col("n_repeat_words")),
            "_lang": F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("-")),
            "_size": size,
        }
    )
    core = found.where(~F.col("base_failed") & lean(F.col("n_words"), F.col("n_symbols")))
    each = F.percentile_approx("log_perplexity", [0.25, 0.75], 10_000)
    sized = core.groupBy(F.col("_lang").alias("_of"), F.col("_size").alias("_class")).agg(
        each.alias("_own"), F.count("*").alias("_n")
    )
    whole = core.groupBy(F.col("_lang").alias("_of_all")).agg(each.alias("_all"), F.count("*").alias("_n_all"))
    met = found.join(sized, (F.col("_lang") == F.col("_of")) & (F.col("_size") == F.col("_class")), "left")
    met = met.join(whole, F.col("_lang") == F.col("_of_all"), "left")
    own = F.coalesce(F.col("_n") >= SUPPORT, F.lit(False))
    known = own | F.coalesce(F.col("_n_all") >= SUPPORT, F.lit(False))
    q = F.when(own, F.col("_own")).otherwise(F.col("_all"))
    wider = F.when(own, 1.0).otherwise(F.sqrt(F.greatest(F.lit(1.0), SHORT / F.greatest("n_chars", F.lit(1)))))
    width = F.greatest(q[1] - q[0], F.lit(LEAST_RANGE)) * FENCE * wider
    met = met.withColumns({"lower": F.when(known, q[0] - width), "upper": F.when(known, q[1] + width)})
    inside = ~known | F.coalesce(F.col("log_perplexity").between(F.col("lower"), F.col("upper")), F.lit(False))
    return met.select(
        "doc_id", *MEASURES, "log_perplexity", "lower", "upper", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), "_tag",
    )


def passing(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept."""
    kept = judged(docs).where("kept").groupBy("_tag").agg(F.count("*").alias("_times"))
    return repeat_rows(docs, kept.withColumn("_copies", F.col("_times")))
