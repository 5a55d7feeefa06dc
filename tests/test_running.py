"""Numbers and running shares over range partitions."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ringroster.operators.windows import with_cumulative_pct, with_global_row_number
from ringroster.spool import checkpoint_folder, spool_scope, spooled


@pytest.fixture
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("kind", ["bigint", "int", "decimal(9,2)", "double"])
def test_running_shares_of_all_rows(many_parts, kind):
    rng = random.Random(3)
    values = [None if rng.random() < 0.1 else rng.randrange(1000) for _ in range(2000)]
    df = many_parts.createDataFrame(list(enumerate(values)), "i int, v int").repartition(5)
    df = df.withColumn("q", F.col("v").cast(kind)).drop("v")
    got = {r.i: r.share for r in with_cumulative_pct(df, "q", [F.desc_nulls_last("q"), "i"], "share").collect()}
    total, running = sum(v or 0 for v in values), 0
    order = sorted(range(2000), key=lambda i: (values[i] is None, -(values[i] or 0), i))
    for i in order:
        running += values[i] or 0
        assert float(got[i]) == pytest.approx(100 * running / total, rel=1e-9)


def test_shares_of_nothing(spark):
    df = spark.createDataFrame([(1, 0), (2, 0)], "i int, q int")
    assert [r.share for r in with_cumulative_pct(df, "q", ["i"], "share").collect()] == [None, None]
    assert with_cumulative_pct(df.where("false"), "q", ["i"], "share").collect() == []
    assert with_global_row_number(df.where("false"), ["i"], "n").collect() == []


def test_large_whole_numbers_stay_exact(spark):
    big = 2**53
    df = spark.createDataFrame([(1, big), (2, 1), (3, 1)], "i int, q bigint")
    got = with_cumulative_pct(df, "q", ["i"], "share").select("i", F.col("share").cast("double")).collect()
    assert sorted(r.i for r in got) == [1, 2, 3] and max(r[1] for r in got) == 100
    exact = spark.createDataFrame([(1, Decimal("0.10")), (2, Decimal("0.20"))], "i int, q decimal(9,2)")
    assert max(float(r.share) for r in with_cumulative_pct(exact, "q", ["i"], "share").collect()) == 100


def test_nothing_is_shuffled_after_the_ranges(many_parts):
    df = many_parts.range(1000).withColumn("q", F.col("id") % 7)
    for placed in (with_cumulative_pct(df, "q", ["q", "id"], "share"), with_global_row_number(df, ["q", "id"], "n")):
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan
        assert "spool-" in plan


def test_numbers_are_those_of_the_order(many_parts):
    df = many_parts.range(1000).withColumn("q", F.col("id") % 7).repartition(6)
    got = [(r.q, r.id) for r in with_global_row_number(df, ["q", "id"], "n").orderBy("n").collect()]
    assert got == sorted((i % 7, i) for i in range(1000))


def test_spools_go_with_their_scope(spark, tmp_path):
    import pathlib

    folder = pathlib.Path(checkpoint_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    with spool_scope(spark):
        rows = with_global_row_number(spark.range(10), ["id"], "n")
        rows.write.parquet(str(tmp_path / "out"))
        with spool_scope(spark):
            spooled(spark.range(3))
        assert len(set(folder.iterdir()) - before) == 1
    assert set(folder.iterdir()) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
