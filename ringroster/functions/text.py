"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringroster.functions import ColumnLike, as_column


def norm_upper(c: ColumnLike) -> Column:
    """Upper case without leading and trailing spaces (spaces only)."""
    return F.trim(F.upper(as_column(c)))


def scrub_upper(c: ColumnLike) -> Column:
    """No-break space becomes a space; TAB, CR and LF go; then trim and upper."""
    return F.upper(F.trim(F.translate(as_column(c), "\u00a0\t\r\n", " ")))


def remove_literal(c: ColumnLike, piece: str, collation: str | None = None) -> Column:
    """Text without a piece, wherever it stands; under a collation in any case it allows."""
    text = F.replace(collated(c, collation), F.lit(piece), F.lit(""))
    return F.collate(text, "UTF8_BINARY") if collation else text


def left_chars(c: ColumnLike, n: int) -> Column:
    return F.left(as_column(c), F.lit(n))


def char_after(c: ColumnLike, marker: str, offset: int) -> Column:
    """The character `offset` places after the start of `marker`; NULL without it."""
    text = as_column(c)
    start = F.locate(marker, text)
    return F.when(start > 0, F.substring(text, start + F.lit(offset), F.lit(1)))


def nth_label(c: ColumnLike, n: ColumnLike, sep: str = ":") -> Column:
    """n-th piece (from 1) of a delimited list: '' past the end, NULL below 1."""
    n = as_column(n)
    return F.when(n >= 1, F.split_part(as_column(c), F.lit(sep), F.greatest(n, F.lit(1))))


def concat_null(*parts: ColumnLike) -> Column:
    """Concatenation in which one NULL makes the result NULL."""
    return F.concat(*[as_column(p) for p in parts])


def as_text(c: ColumnLike) -> Column:
    return as_column(c).cast("string")


def key_text(c: ColumnLike, fractional: bool = False) -> Column:
    """Join key as text. A `fractional` number drops its fraction, so 7.0 reads `7`; one
    that is no number gives NULL."""
    c = as_column(c)
    return (c.try_cast("bigint") if fractional else c).cast("string")


def pct_text(c: ColumnLike, signed: bool = False) -> Column:
    return F.format_string("%+.1f%%" if signed else "%.1f%%", as_column(c).cast("double"))


def months_text(c: ColumnLike, signed: bool = False) -> Column:
    return F.format_string("%+.1f" if signed else "%.1f meses", as_column(c).cast("double"))


def count_text(c: ColumnLike, signed: bool = False) -> Column:
    return F.format_string("%+d" if signed else "%d", as_column(c).cast("bigint"))


def money_text(c: ColumnLike, symbol: str = "R$", group: str = ",", decimal: str = ".") -> Column:
    """Currency symbol, grouped thousands and four decimals."""
    number = F.format_number(as_column(c).cast("decimal(18,4)"), 4)
    if (group, decimal) != (",", "."):
        number = F.translate(number, ",.", group + decimal)
    return F.concat(F.lit(symbol), number)


def labelled_fields(pairs: list[tuple[ColumnLike, ColumnLike]], sep: str = " - ") -> Column:
    """`name: value` of every pair whose two sides are present and value not empty."""
    shown = [F.concat(as_column(n), F.lit(": "), null_if(v, "")) for n, v in pairs]
    return F.concat_ws(sep, *shown)


def null_if(c: ColumnLike, value: object) -> Column:
    return F.nullif(as_column(c), F.lit(value))


def collated(c: ColumnLike, collation: str | None) -> Column:
    """The column under a collation, for sources that compare without regard to case or
    trailing blanks. All comparisons with the column follow it."""
    c = as_column(c)
    return F.collate(c, collation) if collation else c


def starts_with(c: ColumnLike, prefix: str, collation: str | None = None) -> Column:
    return F.startswith(collated(c, collation), F.lit(prefix))


def contains_text(c: ColumnLike, piece: str, collation: str | None = None) -> Column:
    return F.contains(collated(c, collation), F.lit(piece))


def icontains(c: ColumnLike, piece: str) -> Column:
    """Contains in any case; NULL counts as no."""
    return F.coalesce(F.contains(F.upper(as_column(c)), F.lit(piece.upper())), F.lit(False))


def upper_in(c: ColumnLike, values: list[str] | tuple[str, ...]) -> Column:
    return F.upper(as_column(c)).isin(list(values))
