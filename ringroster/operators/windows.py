"""Ranking, numbering and running totals."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringroster.functions import ColumnLike, as_column
from ringroster.spool import spooled

ROW_BITS = 33  # monotonically_increasing_id: partition above, row in partition below


def _columns(order: Sequence[ColumnLike]) -> list[Column]:
    return [as_column(o) for o in order]


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnLike],
    number: str | None = None,
) -> DataFrame:
    """First row of each key in the given order; NULL keys form one group.

    The order should be total: ties are otherwise broken arbitrarily. Spark keeps only the
    best row per key and input partition before it shuffles, so a hot key stays small.
    `number` keeps the (constant 1) rank as a column.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_columns(order)))
    name = number or "_rank"
    first = df.withColumn(name, rank).where(F.col(name) == 1)
    return first if number else first.drop(name)


def with_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnLike],
    output: str,
    at_most: int | None = None,
) -> DataFrame:
    """Position of each row within its group, from 1; rows past `at_most` are dropped
    before the shuffle where that is what the caller asks for."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_columns(order)))
    numbered = df.withColumn(output, rank)
    return numbered if at_most is None else numbered.where(F.col(output) <= at_most)


def _ranged(df: DataFrame, order: Sequence[ColumnLike], running: str | None = None) -> DataFrame:
    """Rows range-partitioned and sorted, each with its partition and position in it and, if
    asked for, the running sum of a column within the partition.

    They are written out, so a rerun task cannot number rows differently.
    """
    order = _columns(order)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumn("_place", F.monotonically_increasing_id())
    if running is not None:
        placed = placed.withColumn("_running", _running_sum(df, running))
    return spooled(placed)


def _running_sum(df: DataFrame, c: str) -> Column:
    """Sum of a column over the rows of a partition so far, none counting as 0.

    Only this column passes through Python, in batches; a window would need another shuffle.
    """
    kind = df.schema[c].dataType
    if isinstance(kind, T.IntegralType):
        kind, zero = T.LongType(), F.lit(0)
    elif isinstance(kind, T.DecimalType):
        kind, zero = T.DecimalType(38, kind.scale), F.lit(0)
    else:
        kind, zero = T.DoubleType(), F.lit(0.0)

    @F.pandas_udf(kind)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        total = None
        for part in parts:
            sums = part.cumsum() if total is None else part.cumsum() + total
            if len(sums):
                total = sums.iloc[-1]
            yield sums

    return run.asNondeterministic()(F.coalesce(F.col(c).cast(kind), zero.cast(kind)))


def _part() -> Column:
    return F.shiftright(F.col("_place"), ROW_BITS).cast("int")


def _offsets(ranged: DataFrame, measure: Column) -> tuple[Column, list]:
    """Sum of `measure` before the partition of a row, and the sums of all partitions.

    One number for each partition of the range shuffle comes to the driver, which bounds them.
    """
    sums = {r["p"]: r["s"] for r in ranged.groupBy(_part().alias("p")).agg(measure.alias("s")).collect()}
    known = [sums.get(p) or 0 for p in range(max(sums, default=-1) + 1)]
    if not known:
        return F.lit(0), known
    before = list(accumulate(known[:-1], initial=type(known[-1])(0)))
    return F.element_at(F.array(*map(F.lit, before)), _part() + 1), known


def with_global_row_number(
    df: DataFrame, order: Sequence[ColumnLike], output: str
) -> DataFrame:
    """Number all rows from 1 in a total order, without moving them to one task."""
    ranged = _ranged(df, order)
    before, _ = _offsets(ranged, F.count(F.lit(1)))
    inside = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return ranged.select(*df.columns, (before + inside + 1).alias(output))


def row_number_over_agg(
    df: DataFrame, keys: Sequence[str], measure: Column, measure_name: str, output: str
) -> DataFrame:
    """Aggregate by key, then number the groups by the aggregate (keys break ties)."""
    grouped = df.groupBy(*keys).agg(measure.alias(measure_name))
    return with_global_row_number(grouped, [measure_name, *keys], output)


def with_cumulative_pct(
    df: DataFrame, qty: str, order: Sequence[ColumnLike], output: str
) -> DataFrame:
    """Running share of `qty` in percent, in a total order over all rows; NULL if all is 0.

    Two levels: sums within the partitions of one range shuffle, and the sums before each
    partition.
    """
    ranged = _ranged(df, order, qty)
    before, sums = _offsets(ranged, F.sum(qty))
    total = F.nullif(F.lit(float(sum(sums))), F.lit(0.0))
    share = (before + F.col("_running")).cast("double") / total * 100
    return ranged.select(*df.columns, share.alias(output))
