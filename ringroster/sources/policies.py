"""Landing policies: how a run's rows enter a landed dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringroster.operators.landing import (
    first_load,
    merge_keep_first,
    merge_keep_last,
    one_per_key,
)
from ringroster.operators.ordering import sort_for_landing
from ringroster.sources import keyindex, store
from ringroster.spool import spooling

KEEP_FIRST = "keep_first"
KEEP_LAST = "keep_last"
SNAPSHOT = "snapshot"


@dataclass(frozen=True)
class Policy:
    """`month_column` cuts the dataset into months, so that a run rewrites only the months
    it changes; rows of one key may lie in different months. `keep_versions` has superseded
    versions removed after each landing (default: all stay)."""

    kind: str
    keys: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()
    tiebreak: tuple[str, ...] = ()
    month_column: str | None = None
    dedup_first_load: bool = False
    guard_empty: bool = True
    keep_versions: int | None = None


def _parts_of(df: DataFrame, month_column: str | None) -> set[str]:
    """Names of the parts that hold rows of `df`: at most one per month."""
    if month_column is None:
        return {store.WHOLE}
    rows = df.select(store.month_of(month_column).alias("part")).distinct().collect()
    return {r.part for r in rows}


def _in_months(policy: Policy) -> bool:
    """Whether a key may lie in any month, so that an index has to say in which."""
    return policy.month_column is not None and policy.month_column not in policy.keys


def _touched(new: DataFrame, location: str, manifest: store.Manifest, policy: Policy) -> tuple[set[str], dict | None]:
    """Parts a merge into a unique dataset can change, which are those of the new rows and
    those that hold one of the new keys, and the index of the keys after it.

    Only the index's buckets of the new keys are read. A dataset without an index gets one
    from a scan of its keys.
    """
    parts = _parts_of(new, policy.month_column)
    if not _in_months(policy):
        return parts, None
    spark, keys, month = new.sparkSession, list(policy.keys), policy.month_column
    newest_wins = policy.kind == KEEP_LAST
    chosen = keyindex.entries(one_per_key(new, keys, policy.tiebreak, newest_wins), keys, month)
    index = manifest.index
    if index is None or index["keys"] != keys:
        index, buckets = None, keyindex.BUCKETS
        known = keyindex.entries(store.load_history(spark, location), keys, month)
    else:
        buckets = index["buckets"]
        wanted = keyindex.buckets_of(new, keys, buckets)
        known = keyindex.read(spark, location, index, chosen, wanted)
    parts |= keyindex.parts_with(known, new, keys)
    after = keyindex.updated(known, chosen, keys, newest_wins)
    return parts, keyindex.write(after, location, keys, index, buckets)


def _arranged(df: DataFrame, policy: Policy, then_by: tuple[str, ...] = ()) -> DataFrame:
    """Order of the landed rows; by month first where the dataset is cut into months."""
    sort = list(policy.sort)
    rest = [k for k in policy.keys if k not in sort] + list(then_by)
    if policy.month_column is None:
        return sort_for_landing(df, sort, rest) if sort else df
    by_month = df.withColumn(store.MONTH, store.month_of(policy.month_column))
    return sort_for_landing(by_month, [store.MONTH, *sort], rest)


def land_with_policy(new: DataFrame, location: str, policy: Policy) -> int:
    """Land one run's rows and return the row count of the dataset."""
    if policy.kind == SNAPSHOT:
        rows = store.land(_arranged(new, policy), location, guard_empty=policy.guard_empty)
        if policy.keep_versions is not None:
            store.expire(new.sparkSession, location, policy.keep_versions)
        return rows
    # the extract is read from its source once, whatever is rerun afterwards
    with spooling(new) as extract:
        if policy.guard_empty and extract.isEmpty():
            manifest = store.read_manifest(new.sparkSession, location)
            return manifest.rows if manifest else 0
        return _merge_into(extract, location, policy)


def _merge_into(new: DataFrame, location: str, policy: Policy) -> int:
    spark = new.sparkSession
    manifest = store.read_manifest(spark, location)
    merge = merge_keep_first if policy.kind == KEEP_FIRST else merge_keep_last
    parts: set[str] = set()
    index = None
    if manifest is None and not policy.dedup_first_load:
        # copies of one row stay, so their place in the spooled files cuts runs of them
        rows = first_load(new.withColumn("_place", F.col("_metadata.row_index")))
        arranged = _arranged(rows, policy, ("_place",)).drop("_place")
    else:
        history = new.where(F.lit(False))
        if manifest is not None:
            # until one merge has gone over all parts, any of them may hold duplicates
            parts = set(manifest.parts)
            if manifest.unique:
                parts, index = _touched(new, location, manifest, policy)
            history = store.load_history(spark, location, parts=parts)
        unique = manifest is None or manifest.unique
        merged = merge(history, new, policy.keys, policy.tiebreak, unique)
        arranged = _arranged(merged, policy)
    months = None if policy.month_column is None else parts | _parts_of(new, policy.month_column)
    rows = store.land(
        arranged,
        location,
        policy.month_column,
        replace=parts,
        unique=manifest is not None or policy.dedup_first_load,
        guard_empty=policy.guard_empty,
        months=months,
        index=index,
    )
    if policy.keep_versions is not None:
        store.expire(spark, location, policy.keep_versions)
    return rows
