"""Helpers that several operators share: words, seeded ranks, row identity, tokens."""

from __future__ import annotations

import gc
import os
import time
import uuid
from array import array
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringroster.spool import checkpoint_folder

WORD = r"[^\x20\x09-\x0D]+"
END_OF_DOCUMENT = 1
TOKENIZER = "word_bpe_49k.json"
GROUP = 2 << 20  # characters
MEMO = 400_000  # newest pieces that a worker remembers, and as many of before
LINE = 200  # words encoded as one text
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000  # rows with texts or sets that pass to a worker at once
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_MIX = np.uint64(0x9E3779B97F4A7C15)

_token_memo: dict[str, Memo] = {}
_ends: dict[str, np.ndarray] = {}
# ASCII marks that never join what stands before them; an apostrophe may
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
_tokenizers: dict[str, object] = {}


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def part_count(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ranked(
    df: DataFrame, keys: Sequence[str], by: Column, output: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Place of each row within its group, from 0, in the order of a hash.

    A group is dealt over as many buckets as there are shuffle partitions; rows are ranked
    in a bucket and the counts of the buckets before are added, so a group with most of all
    rows is no single task. `keys` must not be null; `df` must be repeatable.
    """
    parts = part_count(df.sparkSession)
    dealt = df.withColumn("_h", by).withColumn("_b", F.pmod("_h", F.lit(parts)))
    bucket = [*keys, "_b"]
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*bucket).agg(F.count("*").alias("_n"))
    counts = counts.select(*bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_below"))
    inside = F.row_number().over(Window.partitionBy(*bucket).orderBy("_h", *ties))
    placed = dealt.withColumn("_in", inside).join(counts, bucket)
    return placed.withColumn(output, F.col("_below") + F.col("_in") - 1).drop(
        "_h", "_b", "_in", "_below"
    )


def compact(df: DataFrame, path: str | None = None) -> DataFrame:
    """As `spooled`, for large rows: written with a stronger compression, to a folder of its own
    unless a path is given. Shuffles of the plan that was written are removed when it has ended,
    without waiting for the driver to collect what held them."""
    spark = df.sparkSession
    path = path or spool_path(spark)
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Plans that run within pass at most BATCH_ROWS rows to a worker at once. An executor holds
    such a batch several times over for each task: while Spark fills it, and in the worker."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def spool_path(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/spool-{uuid.uuid4().hex}"


def free_shuffles(spark: SparkSession) -> None:
    """Have shuffle files of finished plans removed, which Spark does when the driver's JVM has
    collected what nobody holds; otherwise they may lie there for half an hour. Python tells the
    JVM what it has let go in the background, hence the pauses."""
    for _ in range(3):
        gc.collect()
        time.sleep(0.4)
        spark.sparkContext._jvm.System.gc()


def row_tag(df: DataFrame) -> Column:
    """Hash of a whole row with its nulls; equal rows have equal tags."""
    parts: list[Column] = []
    for name in df.columns:
        column = F.col(f"`{name}`")
        parts += [column.isNull(), column]
    return F.xxhash64(*parts)


def repeat_rows(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row of `docs` as often as planned.

    `plan` has one row per row_tag: `_tag`, `_times` (rows of docs with that tag) and
    `_copies` (rows wanted of them in all). Equal rows are brought together only where their
    copies cannot be shared evenly.
    """
    plan = plan.where("_copies > 0").select(F.col("_tag").alias("_key"), "_copies", "_times")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # names cannot clash inside
    rows = docs.select(whole.alias("_row"), row_tag(docs).alias("_tag"))
    met = rows.join(plan, F.col("_tag") == F.col("_key"))
    even = F.col("_copies") % F.col("_times") == 0
    each = met.where(even).withColumn("_copies", (F.col("_copies") / F.col("_times")).cast("long"))
    both = each.unionByName(met.where(~even).dropDuplicates(["_tag"]))
    often = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return both.withColumn("_time", often).select("_row.*")


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    if lower:
        values[65:91] = values[97:123]
    return values


_WHITE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_MARK = np.isin(np.arange(256), list(_MARKS))
_ASCII_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
ALNUM_GAP = ~np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
_VALUES = {lower: _byte_values(lower) for lower in (True, False)}
_PLACES = np.random.default_rng(2).integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)


def word_hashes(
    text: str | None, lower: bool = True, gaps: np.ndarray = _WHITE, tails: bool = False
) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a text, A-Z as a-z if `lower`.

    Words lie between the bytes of `gaps`, by default the six white characters. A word's
    hash is multilinear in its bytes, then mixed. With `tails` also a hash of the whole word
    if it has up to four bytes, else of its last two.
    """
    data = np.frombuffer((text or "").encode(), np.uint8)
    at = np.flatnonzero(~gaps[data])
    if not len(at):
        none = np.empty(0, np.uint64)
        return (none, none) if tails else none
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1] + 1
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(at)))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    value = _VALUES[lower][data[at]]
    if place.max() >= len(_PLACES):
        weight = _PLACES[place % len(_PLACES)] * (2 * (place // len(_PLACES)) + 1).astype(np.uint64)
    else:
        weight = _PLACES[place]
    h = mixed(np.add.reduceat(value * weight, starts) + lengths.astype(np.uint64) * _MIX)
    if not tails:
        return h
    last = starts + lengths - 1
    tail = mixed(value[last] * _PLACES[0] + value[last - 1] * _PLACES[1])
    return h, np.where(lengths > 4, tail, h)


def mixed(h: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def windows_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words (fewer than n words: none)."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    size = len(h) - n + 1
    out = np.full(size, n, np.uint64)
    for i in range(n):
        out = (out ^ h[i : i + size]) * _MIX
        out ^= out >> np.uint64(29)
    return mixed(out)


def texts_of(column: pa.Array) -> Iterable[str | None]:
    """Values of an Arrow text column, one at a time."""
    for value in column:
        yield value.as_py()


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def token_bytes(texts: Iterable[str | None], path: str, most: int = MEMO) -> Iterator[bytes]:
    """Ids of each text and the end id, as little-endian unsigned 32-bit integers.

    No step of this tokenizer looks across ASCII white space, so words are encoded apart. For
    GROUP characters of text at a time their different words are found, encoded or remembered,
    and the ids gathered from these, so nothing is done word by word for all words of a text.
    `most` pieces are remembered, and as many of before.
    """
    _token_memo.setdefault(path, Memo()).most = most
    group: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode()
        # the tokenizer lowers case itself, but special tokens are found before that
        group.append(data if b"<|" in data else data.lower())
        size += len(text or "")
        if size > GROUP:
            yield from _encoded(group, path)
            group, size = [], 0
    if group:
        yield from _encoded(group, path)


def _encoded(group: list[bytes], path: str) -> Iterator[bytes]:
    """Pieces of the words of a group of texts, encoded, and the ids of each text.

    ASCII letters and the ASCII marks after them are pieces of their own, as the tokenizer
    never joins them, so a word is remembered once whatever stands after it. Other words stay
    whole, as a mark in them may belong to a contraction or a special token.
    """
    data = np.frombuffer(b"\n".join([b"", *group, b""]), np.uint8)
    gap = _WHITE[data]
    turn = np.flatnonzero(gap[1:] != gap[:-1])  # before the first and at the last byte of a word
    first, last = turn[::2], turn[1::2]
    kept = data[~gap]
    bounds = np.concatenate(([0], np.cumsum(last - first)))
    cut = _cuts(kept, bounds)
    parted = cut > bounds[:-1]
    bounds = np.sort(np.concatenate([bounds, cut[parted]])).astype("<i8")
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(kept)]
    words = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).dictionary_encode()
    memo = _token_memo.setdefault(path, Memo())
    ids = pa.array(memo.ids_of(words.dictionary.to_pylist(), path), pa.large_binary()).take(words.indices)
    _, ends, found = ids.buffers()
    ends = np.frombuffer(ends, "<i8")[ids.offset : ids.offset + len(ids) + 1]
    found = memoryview(found) if found is not None else memoryview(b"")
    stops = np.cumsum([len(t) + 1 for t in group])  # of the texts in the data
    n = np.concatenate(([0], np.searchsorted(first, stops)))
    at = ends[n + np.concatenate(([0], np.cumsum(parted)))[n]]
    end = array("I", [END_OF_DOCUMENT]).tobytes()
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield bytes(found[a:b]) + end


def _cuts(kept: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where marks begin that end a word of ASCII letters; the word's start if it has none."""
    starts, ends = bounds[:-1], bounds[1:]
    cut = starts.copy()
    at = np.flatnonzero(_MARK[kept[ends - 1]]) if len(starts) else starts
    if not len(at):
        return cut
    others = np.add.reduceat(~_ASCII_LETTER[kept], starts, dtype=np.int32)[at]
    place = ends[at] - 1
    going = np.arange(len(at))
    while len(going):  # one step for each mark of the longest run
        going = going[place[going] > starts[at[going]]]
        going = going[_MARK[kept[place[going] - 1]]]
        place[going] -= 1
    whole = ends[at] - place == others  # nothing but letters before the marks
    cut[at[whole]] = place[whole]
    return cut


def _letters(piece: bytes) -> bool:
    """Whether a piece, in lower case too, has letters only."""
    return piece.isalpha() or (not piece.isascii() and piece.decode().lower().isalpha())


class Memo(dict):
    """Ids of pieces of text, at most twice `most` of them: the newest and those of before.

    When there are `most` new ones, those of before are forgotten; what is met again is kept.
    """

    def __init__(self) -> None:
        super().__init__()
        self.most = MEMO
        self.before: dict[bytes, bytes] = {}

    def ids_of(self, pieces: list[bytes], path: str) -> list[bytes]:
        """Ids of each of different pieces."""
        out = list(map(self.get, pieces))
        missing = [p for p, ids in zip(pieces, out, strict=True) if ids is None]
        if not missing:
            return out
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()
        self._learn(missing, path)
        return [self[p] if ids is None else ids for p, ids in zip(pieces, out, strict=True)]

    def _learn(self, pieces: list[bytes], path: str) -> None:
        before = self.before
        if before:
            self.update((p, before[p]) for p in pieces if p in before)
            pieces = [p for p in pieces if p not in before]
        letters = [p for p in pieces if p.isalpha()]
        others, parted = [], []
        for piece in pieces:
            if piece.isalpha():
                continue
            if _letters(piece):
                letters.append(piece)
            elif piece.isascii() or b"<|" in piece:
                others.append(piece)
            else:  # letters beyond ASCII, and marks after them
                core = piece.rstrip(_MARKS)
                if len(core) < len(piece) and core and _letters(core):
                    parted.append((piece, core, piece[len(core) :]))
                else:
                    others.append(piece)
        for i in range(0, len(letters), LINE * 50):
            lines = [letters[j : j + LINE] for j in range(i, min(i + LINE * 50, len(letters)), LINE)]
            texts = [b" ".join(line).decode() for line in lines]
            for line, found in zip(lines, _batch(texts, path), strict=True):
                self._split(line, np.array(found, "<u4"), path)
        for i in range(0, len(others), 10_000):
            part = others[i : i + 10_000]
            for piece, found in zip(part, _batch([p.decode() for p in part], path), strict=True):
                self[piece] = array("I", found).tobytes()
        if parted:
            asked = set(pieces)
            ends = {x for _, *part in parted for x in part if x not in self and x not in asked}
            self._learn(list(ends), path)
            for piece, core, tail in parted:
                self[piece] = self[core] + self[tail]

    def _split(self, line: list[bytes], ids: np.ndarray, path: str) -> None:
        """Ids of a line of words; a word ends with a token that is marked so."""
        stops = np.flatnonzero(_word_ends(path)[ids]) + 1
        if len(stops) == len(line) and stops[-1] == len(ids):
            data, a = ids.tobytes(), 0
            for piece, b in zip(line, (4 * stops).tolist(), strict=True):
                self[piece] = data[a:b]
                a = b
        else:  # a letter that becomes several characters in lower case
            for piece, found in zip(line, _batch([p.decode() for p in line], path), strict=True):
                self[piece] = array("I", found).tobytes()


def _batch(texts: list[str], path: str) -> list[list[int]]:
    return [e.ids for e in _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def _word_ends(path: str) -> np.ndarray:
    """Of each id, whether its token ends a word."""
    if path not in _ends:
        vocabulary = _tokenizer(path).get_vocab(with_added_tokens=True)
        _ends[path] = np.zeros(max(vocabulary.values()) + 1, bool)
        _ends[path][[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return _ends[path]
