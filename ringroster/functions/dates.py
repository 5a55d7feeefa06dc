"""Date and calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringroster.functions import ColumnLike, as_column
from ringroster.functions.durations import clock_to_secs

DAYS_PER_MONTH = 30.44


def as_of_column(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def to_day(c: ColumnLike) -> Column:
    return F.to_date(as_column(c))


def day_plus_seconds(day: ColumnLike, secs: ColumnLike) -> Column:
    """Date plus time of day (in seconds) as a timestamp without zone."""
    zero = F.lit(0)
    return as_column(day).cast("date").cast("timestamp_ntz") + F.make_dt_interval(
        zero, zero, zero, as_column(secs)
    )


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Number of midnights crossed going from `start` to `end`."""
    return F.datediff(as_column(end), as_column(start))


def within_days_flag(start: ColumnLike, end: ColumnLike, n: int) -> Column:
    """1 when `end` falls at most n day boundaries after `start`, else 0 (also for NULL)."""
    return F.when(days_between(start, end) <= n, 1).otherwise(0)


def weekday_num(c: ColumnLike) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(as_column(c))


def year_num(c: ColumnLike) -> Column:
    return F.year(as_column(c))


def year_text(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "yyyy")


def month_num(c: ColumnLike) -> Column:
    return F.month(as_column(c))


def month_abbr(c: ColumnLike) -> Column:
    """Three-letter English month name."""
    return F.date_format(as_column(c), "MMM")


def month_start(c: ColumnLike) -> Column:
    return F.trunc(as_column(c), "month")


def parse_date(c: ColumnLike, fmt: str | None = None) -> Column:
    """Text to date (ISO without `fmt`); NULL where it does not parse."""
    return F.try_to_date(as_column(c), fmt)


def dayfirst_to_iso(c: ColumnLike) -> Column:
    """`dd/MM/yyyy[ HH:mm:ss]` to `yyyy-MM-dd HH:mm:ss`; NULL where invalid.

    Day and clock are parsed apart, so no session time zone can shift the result.
    """
    pieces = F.split(F.trim(as_column(c)), " +", 2)
    day = F.try_to_date(F.get(pieces, 0), "d/M/yyyy")
    secs = F.when(F.size(pieces) == 1, F.lit(0).cast("bigint")).otherwise(
        clock_to_secs(F.get(pieces, 1))
    )
    inside = F.when((secs >= 0) & (secs < 86400), secs)
    return stamp_iso(day_plus_seconds(day, inside))


def stamp_iso(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "yyyy-MM-dd HH:mm:ss")


def stamp_text(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "dd/MM/yyyy HH:mm:ss")


def date_text(c: ColumnLike, fmt: str = "dd/MM/yyyy") -> Column:
    return F.date_format(as_column(c), fmt)


def months_of_days(days: ColumnLike) -> Column:
    return as_column(days) / F.lit(DAYS_PER_MONTH)


def first_date(*cs: ColumnLike) -> Column:
    return F.coalesce(*[as_column(c) for c in cs])


def age_years(birth: ColumnLike, as_of: ColumnLike) -> Column:
    """Completed years: the year difference, less one before the birthday."""
    birth, as_of = as_column(birth), as_column(as_of)
    birthday_ahead = (F.month(as_of) < F.month(birth)) | (
        (F.month(as_of) == F.month(birth)) & (F.day(as_of) < F.day(birth))
    )
    return F.year(as_of) - F.year(birth) - birthday_ahead.cast("int")


def tenure_months(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole calendar months between two dates, month ends clipped; signed."""
    start, end = F.to_date(as_column(start)), F.to_date(as_column(end))
    n = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    landed = F.add_months(start, n)
    overshoot = F.when((end >= start) & (landed > end), -1).when(
        (end < start) & (landed < end), 1
    )
    return n + F.coalesce(overshoot, F.lit(0))


def tenure_text(start: ColumnLike, end: ColumnLike) -> Column:
    """`X anos Y meses`; NULL without a start."""
    n = tenure_months(start, end)
    years = F.call_function("div", n, F.lit(12))
    return F.concat(
        years.cast("string"), F.lit(" anos "), (n % 12).cast("string"), F.lit(" meses")
    )
