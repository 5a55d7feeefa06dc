"""Sorting and limiting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringroster.operators.aggregates import distinct_values


def _asc(columns: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_last(c) for c in columns]


def order_desc(df: DataFrame, c: str, then_by: Sequence[str] = ()) -> DataFrame:
    """Newest first. `then_by` orders equal values, and lets a long run of them be split."""
    return df.orderBy(F.desc_nulls_last(c), *_asc(then_by))


def order_by_count(df: DataFrame, qty: str, name: str) -> DataFrame:
    return df.orderBy(F.desc(qty), F.asc(name))


def sort_for_landing(
    df: DataFrame, columns: Sequence[str], then_by: Sequence[str] = ()
) -> DataFrame:
    """Ascending order over the files of a dataset, NULLs last.

    Rows are range-partitioned and sorted within partitions. `then_by` only serves to cut
    ranges inside a run of equal `columns`, so that such a run is not one task.
    """
    return df.repartitionByRange(*_asc([*columns, *then_by])).sortWithinPartitions(
        *_asc(columns)
    )


def order_mixed(df: DataFrame, directions: Mapping[str, str]) -> DataFrame:
    """Sort by the listed columns that exist, each `asc` or `desc`, NULLs last. Name enough
    columns to tell rows apart, so that a long run of equal values can be split."""
    present = [
        F.asc_nulls_last(c) if way == "asc" else F.desc_nulls_last(c)
        for c, way in directions.items()
        if c in df.columns
    ]
    return df.orderBy(*present) if present else df


def sorted_distinct(df: DataFrame, c: str, desc: bool = False) -> DataFrame:
    return distinct_values(df, c).orderBy(F.desc(c) if desc else F.asc(c))


def latest_year(df: DataFrame, c: str, output: str = "latest_year") -> DataFrame:
    return df.agg(F.max(c).alias(output))


def preview(df: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    return df.select(*columns).limit(n)
