"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a target of words. Its documents are counted by exact length; a source
whose target is at least its size takes everything, and what is left of the target is
filled by a subset: the same share of every length, then a bounded-knapsack dynamic
programme over the lengths for the last words. Which documents of a length are taken is
decided by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringroster.llm.common import n_words, ranked, repeat_rows, row_tag
from ringroster.operators.windows import with_global_row_number
from ringroster.spool import spooled

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 20
ROOM = 65_536  # words that the dynamic programme fills


def fill(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take so that their sum comes as near to the budget from
    below as the programme finds."""
    taken = np.zeros(len(lengths), np.int64)
    usable = (lengths > 0) & (counts > 0)
    total = int((lengths * counts)[usable].sum())
    if budget >= total:
        return np.where(usable, counts, 0)
    if budget <= 0:
        return taken
    wanted = counts * (budget / total)
    taken = np.where(usable, np.minimum(np.floor(wanted), counts), 0).astype(np.int64)
    rest = budget - int((lengths * taken).sum())
    order = np.argsort(-(wanted - taken), kind="stable")
    order = order[usable[order] & (taken < counts)[order] & (lengths[order] <= rest)]
    before = np.cumsum(lengths[order]) - lengths[order]
    order = order[(rest - before > ROOM) & (before + lengths[order] <= rest)]
    taken[order] += 1
    rest -= int(lengths[order].sum())
    return taken + knapsack(lengths, np.where(usable, counts - taken, 0), rest)


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: counts whose lengths add up to the largest reachable sum within
    the budget. A sum remembers the item by which it was first reached and how often that
    was used, so memory is one entry per sum."""
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    item = np.full(budget + 1, -1, np.int64)
    used = np.zeros(budget + 1, np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        size, left = int(lengths[i]), int(counts[i])
        if left < 1 or size < 1 or size > budget:
            continue
        new, times = np.flatnonzero(reached[: budget + 1 - size]) + size, 1
        new = new[~reached[new]]
        while len(new) and times <= left:
            reached[new], item[new], used[new] = True, i, times
            new, times = new[new + size <= budget] + size, times + 1
            new = new[~reached[new]]
        if reached[budget]:
            break
    taken = np.zeros(len(lengths), np.int64)
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, n = item[at], used[at]
        taken[i] += n
        at -= int(n * lengths[i])
    return taken


def _fill_source(rows: pd.DataFrame) -> pd.DataFrame:
    """The plan of one source from its histogram: one row per distinct length."""
    rows = rows.sort_values("size")
    target, total = rows["target"].iloc[0], int(rows["source_size"].iloc[0])
    whole = min(int(target // total), MOST) if total else 0
    lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    extra = fill(lengths, counts, round(target) - whole * total)
    return pd.DataFrame(
        {
            "_skey": rows["_skey"],
            "_size": lengths,
            "source_size": rows["source_size"],
            "target": rows["target"],
            "_whole": whole,
            "_extra": extra,
        }
    )


def targets(
    sources: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """Adds `target` to a table of sources (`source`, `source_size`).

    Sources by code point, null last, weigh as `weights` repeat. They divide `share` of all
    sizes by weight; what exceeds `most` times a source's size is divided anew among the
    others until nothing exceeds. Each round is one sum over the table of sources.
    """
    order = [F.col("source").isNull(), F.col("source")]
    placed = with_global_row_number(sources, order, "_place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(cycle, ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    placed = placed.withColumns({"_w": weight, "_cap": F.col("source_size") * float(most)})
    first = placed.agg(F.sum("source_size"), F.sum("_w")).first()
    budget = share * (first[0] or 0)
    level, full = (budget / first[1] if first[1] else 0.0), -1
    while True:
        capped = F.col("_cap") <= F.lit(level) * F.col("_w")
        n, fixed, open_weight = placed.agg(
            F.count(F.when(capped, 1)),
            F.coalesce(F.sum(F.when(capped, F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("_w"))), F.lit(0.0)),
        ).first()
        if n == full or not open_weight:
            break
        level, full = (budget - fixed) / open_weight, n
    target = F.least(F.col("_cap"), F.lit(level) * F.col("_w"))
    return placed.withColumn("target", target).drop("_place", "_w", "_cap")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text, source): doc_id, source, size, source_size,
    target, copies and taken = copies * size, plus `_tag`.

    A null or empty text has size 0 and is taken 0 times; a null source is a source of its
    own, null ids are ranked as any other, an empty table gives no rows. Equal rows are
    separate documents; which of them is taken does not matter. Other columns are ignored.
    """
    sized = spooled(
        docs.select(
            F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"),
            row_tag(docs).alias("_tag"),
        ).withColumn("_skey", F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), "source")))
    )
    sources = sized.groupBy("_skey", "source").agg(F.sum("size").alias("source_size"))
    goals = targets(sources, weights, share, most).drop("source")
    histogram = sized.groupBy("_skey", "size").agg(F.count("*").alias("n"))
    plan = (
        histogram.join(goals, "_skey")
        .groupBy("_skey")
        .applyInPandas(
            _fill_source,
            "_skey string, _size long, source_size long, target double, _whole long, _extra long",
        )
    )
    by = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("_tag"))
    placed = ranked(sized, ["_skey", "size"], by, "_rank", ["doc_id", "_tag"])
    met = placed.join(plan.withColumnRenamed("_skey", "_k"), (F.col("_skey") == F.col("_k")) & (F.col("size") == F.col("_size")))
    copies = F.when(F.col("size") > 0, F.col("_whole") + (F.col("_rank") < F.col("_extra")).cast("long")).otherwise(F.lit(0).cast("long"))
    return met.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), "_tag",
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it takes it."""
    taken = mix(docs, **options).groupBy("_tag")
    plan = taken.agg(F.sum("copies").alias("_copies"), F.count("*").alias("_times"))
    return repeat_rows(docs, plan)
