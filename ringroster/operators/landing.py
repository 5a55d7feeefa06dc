"""Merge rules for datasets that accumulate over runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringroster.functions import ColumnLike, as_column
from ringroster.operators.ordering import sort_for_landing
from ringroster.operators.windows import first_per_key


def concat_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both; a column missing on one side is NULL there."""
    return history.unionByName(new, allowMissingColumns=True)


def total_order(df: DataFrame, first: Sequence[ColumnLike] = ()) -> list[Column]:
    """The given columns, then every column that can be ordered, so that only rows equal in
    all of these tie, whatever the order of the input."""
    kinds = (T.MapType, T.VariantType)
    rest = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, kinds)]
    return [*[as_column(c) for c in first], *rest]


def _merge_all(
    history: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[ColumnLike],
    newest_wins: bool,
) -> DataFrame:
    """Rank the rows of both sources together."""
    both = concat_history(
        history.withColumn("_source", F.lit(0)), new.withColumn("_source", F.lit(1))
    )
    order = [F.col("_source"), *total_order(both.drop("_source"), tiebreak)]
    if newest_wins:
        order = [o.desc_nulls_last() for o in order]
    return first_per_key(both, keys, order).drop("_source")


def _without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in `other`; NULL keys equal each other."""
    seen = other.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    same = reduce(and_, [df[k].eqNullSafe(seen[f"_seen_{k}"]) for k in keys])
    return df.join(seen, same, "left_anti")


def one_per_key(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[ColumnLike], newest_wins: bool
) -> DataFrame:
    """The row of each key that a merge takes from one source."""
    order = total_order(df, tiebreak)
    if newest_wins:
        order = [o.desc_nulls_last() for o in order]
    return first_per_key(df, keys, order)


def _merge_unique(
    history: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[ColumnLike],
    newest_wins: bool,
) -> DataFrame:
    """Rank the new rows only and leave out what the other source decides.

    To append, history gives its keys to a join and is itself not shuffled."""
    new = one_per_key(new, keys, tiebreak, newest_wins)
    if newest_wins:
        return concat_history(_without_keys(history, new, keys), new)
    return concat_history(history, _without_keys(new, history, keys))


def merge_keep_first(
    history: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[ColumnLike] = (),
    unique_history: bool = False,
) -> DataFrame:
    """Append only keys not seen before: history wins over new rows.

    Within one source the row least by `tiebreak`, then by all columns, stays. NULL keys equal each other.
    `unique_history` says that history has no key twice, which saves shuffling it.
    """
    merge = _merge_unique if unique_history else _merge_all
    return merge(history, new, keys, tiebreak, newest_wins=False)


def merge_keep_last(
    history: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[ColumnLike] = (),
    unique_history: bool = False,
) -> DataFrame:
    """Upsert: new rows win over history; within one source the row greatest by
    `tiebreak` stays."""
    merge = _merge_unique if unique_history else _merge_all
    return merge(history, new, keys, tiebreak, newest_wins=True)


def first_load(
    df: DataFrame,
    sort: Sequence[str] = (),
    keys: Sequence[str] = (),
    dedup: bool = False,
) -> DataFrame:
    """First landing: all rows as they come, duplicates too unless `dedup`."""
    if dedup:
        df = first_per_key(df, keys, total_order(df))
    return sort_for_landing(df, sort) if sort else df
