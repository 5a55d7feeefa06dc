"""Projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL_COLUMN = "Tabulador"


def select_as(df: DataFrame, outputs: Mapping[str, Column | str]) -> DataFrame:
    """Project to `{output name: column or expression}` in that order."""
    return df.select(
        *[(F.col(e) if isinstance(e, str) else e).alias(name) for name, e in outputs.items()]
    )


def with_prefix(df: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The chosen columns (default all), each renamed `prefix + name`."""
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in columns or df.columns])


def with_label(df: DataFrame, label: str, column: str = LABEL_COLUMN) -> DataFrame:
    """Constant source label as the first column."""
    return df.select(F.lit(label).alias(column), "*")


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in columns if c in present])
