"""Durations and times of day.

Measured durations are day-time intervals, exact to the microsecond, so sums and averages lose
nothing; they stay so through Parquet. Labels and texts start from seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringroster.functions import ColumnLike, as_column

DAY_SECS = 86400
NO_TIME = "INTERVAL '0' SECOND"


def time_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Exact day-time interval from `start` to `end`; negative if `end` comes first."""
    return as_column(end) - as_column(start)


def secs_interval(secs: ColumnLike) -> Column:
    """Seconds, whole or not, as a day-time interval."""
    return F.make_dt_interval(secs=as_column(secs).cast("decimal(18,6)"))


def as_intervals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns in seconds become day-time intervals; those that are intervals stay."""
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    return df.withColumns({c: secs_interval(c) for c in numbers})


def exact_secs(interval: ColumnLike) -> Column:
    """Seconds of a day-time interval with their fraction."""
    return as_column(interval).cast("interval second").cast("decimal(20,6)")


def micros(interval: ColumnLike) -> Column:
    """Microseconds of a day-time interval."""
    return (exact_secs(interval) * 1_000_000).cast("bigint")


def time_of_day(interval: ColumnLike) -> Column:
    """What remains of a day-time interval without its whole days."""
    return secs_interval(F.pmod(exact_secs(interval), F.lit(DAY_SECS)))


def no_time_if_null(interval: ColumnLike) -> Column:
    return F.coalesce(as_column(interval), F.expr(NO_TIME))


def secs_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole seconds from `start` to `end`, cut toward zero."""
    return F.timestamp_diff("SECOND", as_column(start), as_column(end))


def epoch_secs(interval: ColumnLike) -> Column:
    """Whole seconds of a day-time interval column."""
    i = as_column(interval)
    return (
        F.extract(F.lit("DAY"), i) * DAY_SECS
        + F.extract(F.lit("HOUR"), i) * 3600
        + F.extract(F.lit("MINUTE"), i) * 60
        + F.extract(F.lit("SECOND"), i)
    ).cast("bigint")


def secs_to_clock(secs: ColumnLike) -> Column:
    """Time of day: seconds within one day."""
    return F.pmod(as_column(secs), F.lit(DAY_SECS))


def secs_of_day(stamp: ColumnLike) -> Column:
    """Seconds since midnight of a timestamp, as JDBC drivers deliver a time of day."""
    t = as_column(stamp)
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("bigint")


def whole_secs(secs: ColumnLike) -> Column:
    return F.floor(as_column(secs))


def zero_if_null(secs: ColumnLike) -> Column:
    return F.coalesce(as_column(secs), F.lit(0).cast("bigint"))


def hms_text(secs: ColumnLike) -> Column:
    """`HH:MM:SS` with total hours; a negative duration keeps its sign."""
    secs = F.floor(as_column(secs))
    size = F.abs(secs)
    return F.concat(
        F.when(secs < 0, "-").otherwise(""),
        _hours(_div(size, 3600)),
        F.lit(":"),
        _sixtieth(_div(size, 60) % 60),
        F.lit(":"),
        _sixtieth(size % 60),
    )


# Plain padding and concatenation, as a format string costs far more per row.
def _sixtieth(n: Column) -> Column:
    """A number below 60 (or an hour of the day) in two digits."""
    return F.lpad(n.cast("string"), 2, "0")


def _hours(n: Column) -> Column:
    """A number in at least two digits."""
    return F.concat(F.when(n < 10, "0").otherwise(""), n.cast("string"))


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def minutes_to_clock(minutes: ColumnLike) -> Column:
    """Minutes of the day as `HH:MM:00.0000000`."""
    m = as_column(minutes)
    return F.concat(
        _hours(_div(m, 60)),
        F.lit(":"),
        _sixtieth(F.pmod(m, F.lit(60))),
        F.lit(":00.0000000"),
    )


def clock_to_secs(c: ColumnLike) -> Column:
    """`HH:MM:SS` (or `HH:MM`, or `HH:MM:SS.fff`) to whole seconds; NULL otherwise."""
    text = F.trim(as_column(c))
    shaped = text.rlike(r"^\d{1,4}:[0-5]\d(:[0-5]\d(\.\d+)?)?$")
    part = F.split(F.substring_index(text, ".", 1), ":")

    def piece(i: int) -> Column:
        return F.get(part, i).try_cast("bigint")

    total = piece(0) * 3600 + piece(1) * 60 + F.coalesce(piece(2), F.lit(0).cast("bigint"))
    return F.when(shaped, total)


def hours_label(secs: ColumnLike, pad: bool = False) -> Column:
    """`8H` or `8H:20`; with `pad`, `08H` or `08H:20`."""
    secs = as_column(secs)
    hours, minutes = _div(secs, 3600), _div(F.pmod(secs, F.lit(3600)), 60)
    rest = F.when(minutes == 0, "").otherwise(F.concat(F.lit(":"), _sixtieth(minutes)))
    return F.concat(_hours(hours) if pad else hours.cast("string"), F.lit("H"), rest)


def shift_label(start: ColumnLike, end: ColumnLike) -> Column:
    """Shift bounds, as in `08H - 14H:20`."""
    return F.concat(hours_label(start, pad=True), F.lit(" - "), hours_label(end, pad=True))


def hm00_text(secs: ColumnLike) -> Column:
    """`HH:MM:00`; whole days and seconds are dropped."""
    clock = secs_to_clock(secs)
    return F.concat(
        _sixtieth(_div(clock, 3600)),
        F.lit(":"),
        _sixtieth(_div(clock, 60) % 60),
        F.lit(":00"),
    )
