"""Ranking, numbering, running totals, pivot and filters."""

import random
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ringroster.operators.aggregates import (
    distinct_values,
    join_values,
    offenders,
    pareto,
    pivot_ordinals,
    value_counts,
)
from ringroster.operators.filters import (
    by_origin,
    in_days,
    in_instants,
    latest_snapshot,
    none_of,
)
from ringroster.operators.ordering import (
    order_by_count,
    order_desc,
    order_mixed,
    preview,
    sort_for_landing,
    sorted_distinct,
)
from ringroster.operators.projections import select_existing, with_label
from ringroster.operators.windows import (
    first_per_key,
    row_number_over_agg,
    with_cumulative_pct,
    with_global_row_number,
    with_ordinal,
)
from ringroster.period import Period, month_to_date
from ringroster.spool import checkpoint_folder


def test_first_per_key_groups_nulls(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 5), (1, 4)], "k int, v int")
    assert rows(first_per_key(df, ["k"], ["v"])) == [(1, 4), (None, 1)]


def test_global_row_number_over_many_partitions(spark):
    rng = random.Random(5)
    data = [(rng.randrange(50), i) for i in range(3000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "t int, id int").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_global_row_number(df, ["t", "id"], "n")
        assert rows(got) == sorted(
            [(*d, n) for n, d in enumerate(sorted(data), start=1)], key=repr
        )
        assert with_global_row_number(df.where("false"), ["t", "id"], "n").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_spool_goes_to_the_folder_of_the_session(spark):
    assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_cumulative_percentage(spark):
    rng = random.Random(6)
    data = [(f"r{i:04d}", rng.randrange(1, 9)) for i in range(500)]
    df = spark.createDataFrame(data, "r string, q bigint").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(with_cumulative_pct(df, "q", [F.desc("q"), F.asc("r")], "pct"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total, run, want = sum(q for _, q in data), 0, []
    for r, q in sorted(data, key=lambda d: (-d[1], d[0])):
        run += q
        want.append((r, q, pytest.approx(run / total * 100)))
    assert got == sorted(want, key=lambda w: repr(w[0]))
    assert max(g[2] for g in got) == 100.0


def test_pareto_ties_nulls_and_limit(spark):
    data = ["b"] * 17 + ["a"] * 17 + ["c"] * 51 + ["d"] * 15 + [None] * 9
    df = spark.createDataFrame([(d,) for d in data], "why string")
    got = [tuple(r) for r in pareto(df, "why").orderBy(F.desc("Qtd"), "Motivo").collect()]
    assert got == [("c", 51, 51.0), ("a", 17, 68.0), ("b", 17, 85.0), ("d", 15, 100.0)]
    assert rows(offenders(pareto(df, "why")).select("Motivo")) == [("a",), ("b",), ("c",)]
    assert pareto(df.where("why IS NULL"), "why").count() == 0


def test_row_number_over_aggregate(spark):
    df = spark.createDataFrame([("x", "b"), ("y", "a"), ("x", "c"), ("z", "a")], "k string, v string")
    got = row_number_over_agg(df, ["k"], F.max("v"), "m", "n")
    assert rows(got) == [("x", "c", 3), ("y", "a", 1), ("z", "a", 2)]


def test_counts_and_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "v string")
    assert rows(value_counts(df, "v")) == [("a", 1), ("b", 2)]
    assert rows(distinct_values(df, "v")) == [("a",), ("b",)]
    assert [r.v for r in sorted_distinct(df, "v", desc=True).collect()] == ["b", "a"]
    assert rows(join_values(df, "v", "all")) == [("a, b",)]
    counts = order_by_count(value_counts(df, "v"), "Qtd", "v")
    assert [r.v for r in counts.collect()] == ["b", "a"]


def test_pivot_keeps_eight_in_order(spark):
    data = [("p", "d1", m, None) for m in range(9, 0, -1)] + [("q", "d1", 5, "x")]
    df = spark.createDataFrame(data, "who string, day string, m int, gone string")
    wide = pivot_ordinals(df, ["who", "day"], ["gone"], ["m"], "m")
    assert rows(wide) == sorted(
        [("p", "d1", None, 1, 2, 3, 4, 5, 6, 7, 8), ("q", "d1", "x", 5, *[None] * 7)], key=repr
    )
    strict = pivot_ordinals(df, ["who", "day"], ["gone"], ["m"], "m", drop_null_groups=True)
    assert rows(strict) == [("q", "d1", "x", 5, *[None] * 7)]
    assert rows(with_ordinal(df.where("who = 'p'"), ["who"], ["m"], "n", 2).select("m", "n")) == [
        (1, 1),
        (2, 2),
    ]


def test_windows_of_time(spark):
    stamps = [
        datetime(2024, 1, 4, 23, 59, 59),
        datetime(2024, 1, 5),
        datetime(2024, 1, 6, 23, 59, 59),
        datetime(2024, 1, 6, 23, 59, 59, 500000),
        datetime(2024, 1, 7),
        None,
    ]
    df = spark.createDataFrame([(t,) for t in stamps], "t timestamp_ntz")
    days = in_days(df, "t", date(2024, 1, 5), date(2024, 1, 6))
    assert sorted(r.t for r in days.collect()) == stamps[1:4]
    p = Period(date(2024, 1, 5), date(2024, 1, 6))
    instants = in_instants(df, "t", p.first_instant, p.last_instant)
    assert sorted(r.t for r in instants.collect()) == stamps[1:3]
    dates = df.select(F.to_date("t").alias("t"))
    assert in_days(dates, "t", p.start, p.end).count() == 3


def test_period():
    p = month_to_date(date(2026, 3, 17))
    assert (p.start, p.end, p.year_text, p.month_text) == (
        date(2026, 3, 1), date(2026, 3, 17), "2026", "03",
    )
    with pytest.raises(ValueError):
        Period(date(2024, 1, 2), date(2024, 1, 1))


def test_snapshot_takes_the_newest_of_all_rows(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None)], "v int, d date"
    )
    assert rows(latest_snapshot(df, "d").select("v")) == [(2,)]
    assert latest_snapshot(df, "d").where("v = 1").count() == 0


def test_exclusion_drops_null(spark):
    df = spark.createDataFrame([("Arquivo ",), ("arquivo ",), ("Arquivo",), (None,)], "v string")
    kept = df.where(none_of("v", ["Arquivo "]))
    assert rows(kept) == [("Arquivo",), ("arquivo ",)]


def test_optional_filter_and_projection(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, o string")
    assert by_origin(df, "o").count() == 2
    assert rows(by_origin(df, "o", "x")) == [(1, "x")]
    assert select_existing(df, ["o", "missing", "a"]).columns == ["o", "a"]
    assert with_label(df, "L").columns == ["Tabulador", "a", "o"]
    assert preview(df, ["a"], 1).count() == 1


def test_orders_put_nulls_last(spark):
    df = spark.createDataFrame([(2, "b"), (None, "a"), (1, "c"), (1, "d")], "n int, s string")
    assert [r.n for r in order_desc(df, "n").collect()] == [2, 1, 1, None]
    mixed = order_mixed(df, {"n": "asc", "missing": "desc", "s": "desc"})
    assert [r.s for r in mixed.collect()] == ["d", "c", "b", "a"]
    landed = sort_for_landing(df.repartition(4), ["n"], ["s"])
    assert [r.n for r in landed.collect()] == [1, 1, 2, None]


def test_strict_pivot_numbers_before_it_drops(spark):
    data = [("p", "d", 480, None), ("p", "d", 481, "x"), ("p", "d", 700, None), ("p", "d", 701, "x")]
    df = spark.createDataFrame(data, "who string, day string, m int, gone string")
    strict = pivot_ordinals(df, ["who", "day"], ["gone"], ["m"], "m", width=4, drop_null_groups=True)
    assert rows(strict) == [("p", "d", "x", None, 481, None, 701)]
