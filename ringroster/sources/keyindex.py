"""Which part of a dataset holds a key.

Beside a dataset that is cut into months lies a small table of its keys, each with the month
of its row, in buckets by a hash of the key. A landing reads and rewrites the buckets of its
own keys only, so it learns which months it touches without reading the dataset. The table
holds whole keys, not hashes, so it is exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringroster.sources import store

BUCKETS = 64
_BUCKET = "key_bucket"
_PART = "key_part"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def entries(df: DataFrame, keys: Sequence[str], month_column: str) -> DataFrame:
    """Index rows of the rows of a dataset."""
    return df.select(*keys, store.month_of(month_column).alias(_PART))


def buckets_of(df: DataFrame, keys: Sequence[str], buckets: int) -> set[int]:
    """Buckets that the keys of `df` lie in; never more than there are."""
    return {r[0] for r in df.select(_bucket(keys, buckets)).distinct().collect()}


def read(
    spark: SparkSession, location: str, index: dict, like: DataFrame, wanted: Iterable[int]
) -> DataFrame:
    """Entries of some buckets. `like` has the columns of entries."""
    folders = [f"{location}/{index['dirs'][str(b)]}" for b in wanted if str(b) in index["dirs"]]
    if not folders:
        return like.where(F.lit(False))
    return spark.read.schema(like.schema).parquet(*folders)


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [a[k].eqNullSafe(b[f"_of_{k}"]) for k in keys])


def _keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_of_{k}") for k in keys])


def parts_with(known: DataFrame, new: DataFrame, keys: Sequence[str]) -> set[str]:
    """Parts that hold one of the keys of `new`: one row for each part comes back."""
    wanted = _keys(new, keys).distinct()
    found = known.join(wanted, _same(known, wanted, keys), "left_semi")
    return {r[0] for r in found.select(_PART).distinct().collect()}


def updated(known: DataFrame, new: DataFrame, keys: Sequence[str], newest_wins: bool) -> DataFrame:
    """Entries after a merge. `new` has one row a key."""
    keep, add = (known, new) if newest_wins else (new, known)
    other = _keys(add, keys)
    return keep.join(other, _same(keep, other, keys), "left_anti").unionByName(add)


def write(rows: DataFrame, location: str, keys: Sequence[str], old: dict | None, buckets: int) -> dict:
    """Write entries, which replace whole buckets, and return the description of the index."""
    folder = f"index-{uuid.uuid4().hex}"
    dealt = rows.withColumn(_BUCKET, _bucket(keys, buckets))
    dealt.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{location}/{folder}")
    written = store.list_folders(rows.sparkSession, f"{location}/{folder}")
    dirs = {name.partition("=")[2]: f"{folder}/{name}" for name in written}
    return {"keys": list(keys), "buckets": buckets, "dirs": {**(old["dirs"] if old else {}), **dirs}}
