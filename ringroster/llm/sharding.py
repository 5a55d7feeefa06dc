"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered in a total order; the number is permuted by a keyed Feistel network over
a grid just large enough for it, walking the cycle until the result is a row number again.
Shard and slot are the remainder and the quotient of the permuted number, so both can be
computed for any row number without the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringroster.operators.windows import with_global_row_number

SHARDS = 8
SEED = 5
ROUNDS = 6
WALK = 64
PRIME = (1 << 31) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """Round keys from a seed."""
    key, keys = seed % PRIME, []
    for i in range(rounds):
        key = (key * 48_271 + 11 + i) % PRIME
        keys.append(key)
    return keys


def grid(n: int) -> tuple[int, int]:
    """Sides of the grid for n rows: at least n cells, fewer than one side more."""
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _scrambled(half: Column, key: Column) -> Column:
    """Round function: two squarings modulo a prime, within 64 bits."""
    prime = F.lit(PRIME)
    x = (half + key) % prime
    x = (x * x + half * 69_621 + key) % prime
    return (x * x + key) % prime


def permuted(number: Column, n: int, seed: int = SEED) -> Column:
    """Permutation of 0 .. n - 1.

    Fewer than one in sqrt(n) cells of the grid is no row number. A grid of up to WALK
    columns is walked to its end; on a larger one WALK steps fail with a chance below
    64 ** -64, and would raise an error.
    """
    a, b = grid(n)

    def once(x: Column) -> Column:
        keys = round_keys(seed)
        turns = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).cast("long").alias("k")) for i, k in enumerate(keys)])
        start = F.struct((x % a).cast("long").alias("l"), F.floor(x / a).cast("long").alias("r"))

        def turn(s: Column, t: Column) -> Column:
            even = t["i"] % 2 == 0
            left = F.when(even, (s["l"] + _scrambled(s["r"], t["k"])) % a).otherwise(s["l"])
            right = F.when(even, s["r"]).otherwise((s["r"] + _scrambled(s["l"], t["k"])) % b)
            return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

        return F.aggregate(turns, start, turn, lambda s: s["l"] + s["r"] * a)

    steps = F.sequence(F.lit(1), F.lit(WALK))
    walk = lambda x, _: F.when(x >= n, once(x)).otherwise(x)
    found = F.aggregate(steps, once(number), walk)
    return F.when(found < n, found).otherwise(
        F.raise_error(F.lit("no row number within the walk")).cast("long")
    )


def located(number: Column, n: int, shards: int = SHARDS, seed: int = SEED) -> Column:
    """Struct (shard, slot) of a row number among n rows."""
    at = permuted(number, n, seed)
    return F.struct((at % shards).cast("int").alias("shard"), F.floor(at / shards).cast("long").alias("slot"))


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, number, shard, slot.

    Counts of shards differ by one at most and slots have no gaps. A null text has size 1
    and the checksum of no bytes. Numbers follow doc_id (nulls first), checksum and size;
    rows equal in these get neighbouring numbers, and it does not matter which gets which.
    An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    numbered = with_global_row_number(narrow, ["doc_id", "text_crc32", "size"], "number")
    n = numbered.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    place = located(F.col("number") - 1, max(n, 1), shards, seed)
    return numbered.withColumn("_at", place).select(
        "doc_id", "size", "text_crc32", "number", "_at.shard", "_at.slot"
    )
