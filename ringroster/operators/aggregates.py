"""Aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringroster.functions import ColumnLike, as_column
from ringroster.functions.durations import no_time_if_null
from ringroster.operators.windows import with_cumulative_pct, with_ordinal


def sum_dur(interval: ColumnLike, when: Column | None = None) -> Column:
    """Exact sum of a day-time interval, none at all if there is none; with `when`, over those
    rows only."""
    value = as_column(interval)
    return no_time_if_null(F.sum(value if when is None else F.when(when, value)))


def avg_dur(interval: ColumnLike, when: Column | None = None) -> Column:
    """Average of a day-time interval to the microsecond, as `sum_dur`."""
    value = as_column(interval)
    return no_time_if_null(F.avg(value if when is None else F.when(when, value)))


def ratio_pct(part: ColumnLike, whole: ColumnLike) -> Column:
    """Percentage, 0 for an empty whole."""
    part, whole = as_column(part), as_column(whole)
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def latest_value(df: DataFrame, c: str, output: str | None = None) -> DataFrame:
    return df.agg(F.max(c).alias(output or c))


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).dropna().distinct()


def value_counts(df: DataFrame, c: str, name: str | None = None, qty: str = "Qtd") -> DataFrame:
    """Rows per value, NULL left out."""
    name = name or c
    return (
        df.select(F.col(c).alias(name)).dropna().groupBy(name).agg(F.count("*").alias(qty))
    )


def pareto(df: DataFrame, reason: str) -> DataFrame:
    """Reasons by falling frequency (name breaks ties) with their cumulative percentage."""
    counts = value_counts(df, reason, "Motivo", "Qtd")
    return with_cumulative_pct(counts, "Qtd", [F.desc("Qtd"), F.asc("Motivo")], "Acumulado_%")


def offenders(pareto_df: DataFrame, limit: float = 85) -> DataFrame:
    """Reasons up to and including the cumulative limit."""
    return pareto_df.where(F.col("`Acumulado_%`") <= limit)


def join_values(df: DataFrame, c: str, output: str, sep: str = ", ") -> DataFrame:
    """One text listing the distinct values in order.

    For columns whose values are few by what they mean, as the reasons up to a limit of a
    Pareto; longer lists are better read as rows from `distinct_values`.
    """
    text = F.array_join(F.array_sort(F.collect_list(c)), sep)
    return distinct_values(df, c).agg(text.alias(output))


def pivot_ordinals(
    df: DataFrame,
    group: Sequence[str],
    others: Sequence[str],
    order: Sequence[ColumnLike],
    value: ColumnLike,
    width: int = 8,
    prefix: str = "HoraPonto",
    drop_null_groups: bool = False,
) -> DataFrame:
    """One row per group with its first `width` values, in order, as columns.

    Positions count within `group`; rows are then grouped by `group` and `others`. Later
    positions are cut before the shuffle, and the grouping reuses its partitioning.
    """
    keys = [*group, *others]
    numbered = with_ordinal(df, group, order, "_n", at_most=width)
    if drop_null_groups:  # after numbering: a dropped row leaves its position empty
        numbered = numbered.dropna(subset=keys)
    cell = as_column(value)
    return numbered.groupBy(*keys).agg(
        *[
            F.first(F.when(F.col("_n") == i, cell), ignorenulls=True).alias(f"{prefix}{i}")
            for i in range(1, width + 1)
        ]
    )
