"""Row filters. SQL three-valued logic holds: a NULL never passes a comparison."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringroster.functions import ColumnLike, as_column
from ringroster.functions.text import collated
from ringroster.period import Period


def in_days(df: DataFrame, c: ColumnLike, start: date, end: date) -> DataFrame:
    """Inclusive calendar-day window.

    Written as a half-open range on the bare column, so it is pushed to the scan and can
    use partition and row-group statistics whatever the column's date or time type.
    """
    c = as_column(c)
    return df.where((c >= F.lit(start)) & (c < F.lit(end + timedelta(days=1))))


def in_instants(df: DataFrame, c: ColumnLike, start: datetime, end: datetime) -> DataFrame:
    """Inclusive window of instants; a fraction past `end` is outside."""
    c = as_column(c)
    return df.where((c >= _instant(start)) & (c <= _instant(end)))


def in_period_instants(df: DataFrame, c: ColumnLike, period: Period) -> DataFrame:
    return in_instants(df, c, period.first_instant, period.last_instant)


def _instant(t: datetime) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def from_day(df: DataFrame, c: ColumnLike, start: date) -> DataFrame:
    return df.where(as_column(c) >= F.lit(start))


def one_of(c: ColumnLike, values: Iterable, collation: str | None = None) -> Column:
    """IN, as the source compares: `UTF8_LCASE_RTRIM`, say, for neither case nor trailing
    blanks."""
    return collated(c, collation).isin(list(values))


def none_of(c: ColumnLike, values: Iterable, collation: str | None = None) -> Column:
    """NOT IN: false for members, NULL for NULL."""
    return ~one_of(c, values, collation)


def latest_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest date. The maximum is that of `df` as given, so apply other
    filters to the result, not before. It runs as a scalar subquery and is pushed to the
    scan as a filter."""
    newest = df.agg(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == newest)


def active_in_years(
    df: DataFrame, years: Sequence[int], hire_year: ColumnLike, exit_year: ColumnLike
) -> DataFrame:
    return df.where(touches_years(years, hire_year, exit_year))


def touches_years(years: Sequence[int], hire_year: ColumnLike, exit_year: ColumnLike) -> Column:
    """Hired or left in one of the years; an unknown year is in none of them."""
    return as_column(hire_year).isin(list(years)) | as_column(exit_year).isin(list(years))


def cohort(df: DataFrame, years: Sequence[int], year_col: ColumnLike) -> DataFrame:
    return df.where(as_column(year_col).isin(list(years)))


def by_origin(df: DataFrame, origin_col: ColumnLike, origin: str | None = None) -> DataFrame:
    """Equality filter that is left out when no origin is chosen."""
    return df if origin is None else df.where(as_column(origin_col) == origin)
