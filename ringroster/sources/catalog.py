"""Named source tables.

A job asks for tables by logical name; the catalog says where each one is. Filters and
projections stay in the DataFrame plan, and Spark pushes them to Parquet or to the
database.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, time, timedelta
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ringroster.period import Period


@dataclass(frozen=True)
class JdbcSplit:
    """How a JDBC table is read in parallel: ranges of a number, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class PeriodSplit:
    """How a JDBC table is read for a period: one query for each of `pieces` spans of a date
    or timestamp column. Rows outside the period are not asked for."""

    column: str
    pieces: int

    def predicates(self, period: Period) -> list[str]:
        first = datetime.combine(period.start, time.min)
        span = datetime.combine(period.end, time.min) + timedelta(days=1) - first
        cuts = [first + span * i / self.pieces for i in range(self.pieces + 1)]
        texts = [c.isoformat(sep=" ", timespec="milliseconds") for c in cuts]
        return [
            f"{self.column} >= '{a}' AND {self.column} < '{b}'" for a, b in pairwise(texts)
        ]


@dataclass(frozen=True)
class KeySplit:
    """How a JDBC table is read whole: ranges of a whole-number column between its bounds,
    which a query of one row finds out. The first and last range are open, and rows without
    the key come with the first, so no row is missed that was added meanwhile."""

    column: str
    pieces: int

    def predicates(self, low: int | None, high: int | None) -> list[str]:
        pieces = 1 if low is None or high is None else min(self.pieces, high - low)
        if pieces < 2:
            return ["1 = 1"]
        cuts = [low + (high - low) * i // pieces for i in range(1, pieces)]
        c = self.column
        first, last = f"{c} < {cuts[0]} OR {c} IS NULL", f"{c} >= {cuts[-1]}"
        return [first, *[f"{c} >= {a} AND {c} < {b}" for a, b in pairwise(cuts)], last]


@dataclass(frozen=True)
class Source:
    """One table: `parquet` or `orc` path, `table` name, or `jdbc` table name.

    A JDBC table without a split is read by one task, so it is refused if it has more than
    `most_unsplit` rows.
    """

    kind: str
    location: str
    schema: StructType | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    split: JdbcSplit | PeriodSplit | KeySplit | None = None
    most_unsplit: int = 1_000_000


def jdbc_options(source: Source) -> dict[str, str]:
    """Reader options of a JDBC source. `options` must hold at least the `url`."""
    if "url" not in source.options:
        raise ValueError(f"jdbc source {source.location} has no url")
    options = {"dbtable": source.location, "fetchsize": "10000", **source.options}
    if isinstance(source.split, JdbcSplit):
        options |= {
            "partitionColumn": source.split.column,
            "lowerBound": source.split.lower,
            "upperBound": source.split.upper,
            "numPartitions": str(source.split.partitions),
        }
    return options


def bounds_query(source: Source) -> str:
    """SQL for one row: how many rows there are and, of a KeySplit, the bounds of the key."""
    split = source.split
    c = split.column if isinstance(split, KeySplit) else None
    bounds = f", MIN({c}) AS low, MAX({c}) AS high" if c else ""
    return f"SELECT COUNT(*) AS n{bounds} FROM {source.location}"


def jdbc_predicates(
    source: Source, period: Period | None, first_row: Callable[[str], Mapping]
) -> list[str] | None:
    """Disjoint conditions, one for each task, or None where Spark's own ranges are used or
    the table is small. `first_row` runs a query of one row."""
    split = source.split
    if isinstance(split, JdbcSplit):
        return None
    if isinstance(split, PeriodSplit):
        if period is None:
            raise ValueError(f"{source.location} is split by period, and none is given")
        return split.predicates(period)
    found = first_row(bounds_query(source))
    if isinstance(split, KeySplit):
        return split.predicates(found["low"], found["high"])
    if found["n"] > source.most_unsplit:
        raise ValueError(
            f"{source.location} has {found['n']} rows and no split, so one task would read it"
        )
    return None


def read_jdbc(spark: SparkSession, source: Source, period: Period | None = None) -> DataFrame:
    options = jdbc_options(source)

    def first_row(sql: str) -> Mapping:
        asked = {k: v for k, v in options.items() if k != "dbtable"} | {"query": sql}
        return spark.read.format("jdbc").options(**asked).load().first().asDict()

    predicates = jdbc_predicates(source, period, first_row)
    if predicates is None:
        return spark.read.format("jdbc").options(**options).load()
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], source.location, predicates=predicates, properties=rest)


class Catalog:
    """Logical table names and their sources."""

    def __init__(self, sources: Mapping[str, Source]):
        self._sources = dict(sources)

    def __contains__(self, name: str) -> bool:
        return name in self._sources

    def read(self, spark: SparkSession, name: str, period: Period | None = None) -> DataFrame:
        if name not in self._sources:
            raise KeyError(f"no source named {name}")
        source = self._sources[name]
        if source.kind == "table":
            return spark.table(source.location)
        if source.kind == "jdbc":
            return read_jdbc(spark, source, period)
        if source.kind in ("parquet", "orc"):
            reader = spark.read.format(source.kind).options(**source.options)
            if source.schema is not None:
                reader = reader.schema(source.schema)
            return reader.load(source.location)
        raise ValueError(f"unknown source kind {source.kind}")


def read_nanos(spark: SparkSession, path: str, stamp_columns: list[str]) -> DataFrame:
    """Parquet history whose timestamps were written with nanoseconds.

    Spark does not read that type as a timestamp. The session must have
    `spark.sql.legacy.parquet.nanosAsLong=true`; the listed columns then arrive as BIGINT
    and are turned into timestamps without zone, to the microsecond.
    """
    second = F.lit(10**9)
    epoch = F.lit("1970-01-01").cast("date").cast("timestamp_ntz")

    def stamp(c: str) -> Column:
        nanos = F.pmod(F.col(c), second)
        secs = F.call_function("div", F.col(c) - nanos, second)
        micros = F.call_function("div", nanos, F.lit(1000))
        return epoch + _seconds(secs) + _seconds(micros.cast("decimal(18,6)") / 10**6)

    return spark.read.parquet(path).withColumns({c: stamp(c) for c in stamp_columns})


def _seconds(secs: Column) -> Column:
    zero = F.lit(0)
    return F.make_dt_interval(zero, zero, zero, secs.cast("decimal(18,6)"))
