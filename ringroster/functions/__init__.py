"""Column expressions (Column in, Column out); all native, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c
