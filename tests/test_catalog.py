"""How tables behind JDBC are split, without a database."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ringroster.period import Period
from ringroster.sources.catalog import (
    JdbcSplit,
    KeySplit,
    PeriodSplit,
    Source,
    bounds_query,
    jdbc_options,
    jdbc_predicates,
)

URL = {"url": "jdbc:x"}
MARCH = Period(date(2024, 3, 1), date(2024, 3, 31))


def hits(spark, rows, schema, predicates):
    """How many of the predicates each row meets."""
    df = spark.createDataFrame(rows, schema)
    counted = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    return [r[0] for r in df.coalesce(1).select(counted).collect()]


@pytest.mark.parametrize("pieces", [1, 2, 7, 31, 100])
def test_period_pieces_are_disjoint_and_cover_the_period(spark, pieces):
    predicates = PeriodSplit("t", pieces).predicates(MARCH)
    assert len(predicates) == pieces
    inside = [datetime(2024, 3, 1) + timedelta(minutes=37 * i) for i in range(1200)]
    inside += [datetime(2024, 3, 31, 23, 59, 59, 999_000)]
    outside = [datetime(2024, 2, 29, 23, 59, 59, 999_000), datetime(2024, 4, 1), None]
    assert hits(spark, [(t,) for t in inside], "t timestamp_ntz", predicates) == [1] * len(inside)
    assert hits(spark, [(t,) for t in outside], "t timestamp_ntz", predicates) == [0] * 3


@pytest.mark.parametrize(("low", "high", "pieces"), [(1, 1000, 8), (-50, 3, 7), (5, 6, 9), (5, 5, 3), (None, None, 4), (1, 9, 1)])
def test_key_pieces_are_disjoint_and_cover_everything(spark, low, high, pieces):
    predicates = KeySplit("k", pieces).predicates(low, high)
    assert 1 <= len(predicates) <= pieces
    keys = [None, -(10**9), 10**9, *range(-60, 1100)]
    assert hits(spark, [(k,) for k in keys], "k bigint", predicates) == [1] * len(keys)


def test_even_pieces():
    predicates = KeySplit("k", 4).predicates(0, 100)
    assert predicates == ["k < 25 OR k IS NULL", "k >= 25 AND k < 50", "k >= 50 AND k < 75", "k >= 75"]


def test_what_is_asked_of_the_database():
    asked = []

    def row(sql):
        asked.append(sql)
        return {"n": 50, "low": 1, "high": 100}

    by_key = Source("jdbc", "dbo.calls", options=URL, split=KeySplit("id", 2))
    assert jdbc_predicates(by_key, None, row) == ["id < 50 OR id IS NULL", "id >= 50"]
    by_day = Source("jdbc", "dbo.calls", options=URL, split=PeriodSplit("at", 3))
    assert len(jdbc_predicates(by_day, MARCH, row)) == 3
    with pytest.raises(ValueError, match="period"):
        jdbc_predicates(by_day, None, row)
    ranged = Source("jdbc", "dbo.calls", options=URL, split=JdbcSplit("id", "0", "9", 3))
    assert jdbc_predicates(ranged, None, row) is None
    assert jdbc_options(ranged)["numPartitions"] == "3" and "partitionColumn" not in jdbc_options(by_key)
    assert asked == ["SELECT COUNT(*) AS n, MIN(id) AS low, MAX(id) AS high FROM dbo.calls"]
    assert bounds_query(by_day) == "SELECT COUNT(*) AS n FROM dbo.calls"


def test_a_large_table_without_a_split_is_refused():
    small = Source("jdbc", "dbo.names", options=URL)
    assert jdbc_predicates(small, None, lambda _: {"n": 1_000_000}) is None
    with pytest.raises(ValueError, match="no split"):
        jdbc_predicates(small, None, lambda _: {"n": 1_000_001})


def test_sources_compare_as_their_settings_say(spark):
    from ringroster.plans.jobs import Settings
    from ringroster.plans.workforce import REGISTER, REGISTER_COLUMNS, hr_register

    data = [("ops a ", "agent"), ("OPS A", "SUPERV Junior "), ("ops b", "AGENT"), (None, "AGENT"), ("OPS A", None)]
    df = spark.createDataFrame(data, "DS_OPERACAO string, DS_FUNCAO string").withColumns(
        {c: F.lit("x") for c in (*REGISTER_COLUMNS, "cached_at") if c not in ("DS_OPERACAO", "DS_FUNCAO")}
    )
    settings = Settings(collation=None, collations={REGISTER: "UTF8_LCASE_RTRIM"})
    seen = hr_register(df, ["OPS A", "OPS B"], collation=settings.collation_of(REGISTER))
    assert sorted(r.DS_OPERACAO for r in seen.collect()) == ["ops a ", "ops b"]
    assert settings.collation_of("other") is None
    assert [r.DS_OPERACAO for r in hr_register(df, ["OPS A"]).collect()] == ["OPS A"]
