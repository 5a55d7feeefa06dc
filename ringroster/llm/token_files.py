"""Token ids in ORC files.

Ids are integer columns, so ORC stores them run-length encoded in stripes with row indexes;
document ids carry Bloom filters. Files follow doc_id, so stripes are read in parallel and
skipped by their metadata when documents are looked up by id.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringroster.llm.common import texts_of, token_bytes, tokenizer_path
from ringroster.spool import checkpoint_folder

SCHEMA = "doc_id long, part int, place long, ids_before long, n_tokens long, ids array<int>"
STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1_000
BATCH_IDS = 2 << 20


def _encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        place = before = 0
        names = ["doc_id", "part", "place", "ids_before", "n_tokens", "ids"]
        rows: list[tuple[int | None, int, int, int]] = []
        held: list[bytes] = []
        size = 0

        def batch_of() -> pa.RecordBatch:
            ids = pa.array(np.frombuffer(b"".join(held), "<i4"))
            ends = np.cumsum([0, *(len(x) // 4 for x in held)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), ids)
            doc_ids, places, befores, counts = zip(*rows, strict=True)
            columns = [
                pa.array(doc_ids, pa.int64()), pa.array([part] * len(rows), pa.int32()),
                pa.array(places, pa.int64()), pa.array(befores, pa.int64()),
                pa.array(counts, pa.int64()), lists,
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            encoded = token_bytes(texts_of(batch.column(1)), path)
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                n = len(ids) // 4
                rows.append((doc_id, place, before, n))
                held.append(ids)
                place, before, size = place + 1, before + n, size + n
                if size > BATCH_IDS:
                    yield batch_of()
                    rows, held, size = [], [], 0
        if rows:
            yield batch_of()

    return encode


def write_tokens(docs: DataFrame, folder: str, path: str | None = None) -> None:
    """Write the ids of all documents, each with its end id, in ascending doc_id order.

    Null ids come first; rows with one id follow a hash of their text, then the text, and
    an id with very many rows is spread over files. Null text counts as empty.
    """
    tie = F.xxhash64("text")
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .withColumn("_tie", tie)
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie", "text")
        .select("doc_id", "text")
    )
    (
        ordered.mapInArrow(_encoder(path or tokenizer_path()), SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("orc.row.index.stride", str(INDEX_STRIDE))
        .option("orc.compress", "ZSTD")
        .orc(folder)
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The files as a table; filters on doc_id skip files, stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(folder)


def with_starts(tokens: DataFrame) -> DataFrame:
    """Adds `start`, the number of ids of all documents before.

    A row knows the ids before it in its file; the totals of the files before are added.
    That table has one row per file written, which is what bounds the broadcast."""
    files = tokens.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select(F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    met = tokens.join(F.broadcast(offsets), F.col("part") == F.col("_part"))
    return met.withColumn("start", F.col("_before") + F.col("ids_before")).drop("_part", "_before")


def with_checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the ids as they were read."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False)).astype("<u4")
            ends = lists.offsets.to_numpy()
            data = memoryview(values.tobytes())
            crc = [zlib.crc32(data[a * 4 : b * 4]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "ids").mapInArrow(
        check, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write `docs` to a new folder in the shared checkpoint folder and read them back:
    doc_id, start, n_tokens, ids_crc32. An empty table gives no rows."""
    spark = docs.sparkSession
    folder = f"{checkpoint_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, path)
    return with_checksums(with_starts(read_tokens(spark, folder)))
