"""Hot and missing keys do not end in one task."""

import re

import pytest
from pyspark.sql import functions as F

from ringroster.operators.joins import join_roster, lookup
from ringroster.operators.skew import exact_left_join, exact_left_joins, split_left_join, split_many_join

HOT = 7


@pytest.fixture
def skewed(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    """Rows and the plan that ran."""
    n = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return n, plan


def hot(spark, rows, share=0.8, name="k"):
    key = F.when(F.col("id") < int(rows * share), HOT).otherwise(F.col("id") % 500 + 1000)
    return spark.range(rows, numPartitions=4).select(key.alias(name), "id", F.sha2(F.col("id").cast("string"), 256).alias(f"{name}_text"))


def test_a_hot_right_key_is_split(skewed):
    left = skewed.range(0, 2000, 1, 4).select("id", F.col("id").alias("k"))
    right = hot(skewed, 40_000, name="r").drop("id")
    n, plan = executed(exact_left_join(left, right, "k", "r", ["id"]))
    assert n == 40_000 + sum(1 for k in range(2000) if k != HOT and not 1000 <= k < 1500)
    assert "SortMergeJoin(skew=true)" in plan


def test_equal_rows_of_a_hot_right_key_are_split(skewed):
    left = skewed.range(0, 2000, 1, 4).select("id", F.col("id").alias("k"))
    key = F.when(F.col("id") < 38_000, HOT).otherwise(F.col("id"))
    right = skewed.range(0, 40_000, 1, 4).select(key.alias("r"), F.lit("x" * 200).alias("v"))
    n, plan = executed(exact_left_join(left, right, "k", "r", ["id"]))
    assert n == 38_000 + 1999 and "SortMergeJoin(skew=true)" in plan


def test_a_hot_left_key_is_split(skewed):
    left = hot(skewed, 40_000)
    rights = [(skewed.range(0, 2000, 1, 4).select(F.col("id").alias(f"{c}_id"), F.lit(c).alias(c)), f"{c}_id") for c in "abc"]
    n, plan = executed(split_left_join(left, rights, "k", ["id"]))
    assert n == 40_000 and plan.count("SortMergeJoin(skew=true)") >= 1
    n, plan = executed(split_left_join(left, rights[:1], "k", ["id"]))
    assert n == 40_000 and "SortMergeJoin(skew=true)" in plan
    n, plan = executed(exact_left_join(left, *rights[0][:1], "k", rights[0][1], ["id"]))
    assert n == 40_000 and "SortMergeJoin(skew=true)" in plan


def test_chain_of_tables_shuffles_the_left_side_once(skewed):
    left = hot(skewed, 1000)
    rights = [(skewed.range(2000).select(F.col("id").alias(f"{c}_id"), F.lit(c).alias(c)), f"{c}_id") for c in "abc"]
    joined = split_left_join(left, rights, "k", ["id"], keys=left.select("k"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_key#") == 1


def largest_share(df):
    """Share of the rows that lie in the fullest partition."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture
def fixed(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_a_key_are_dealt_out(fixed):
    some = F.when(F.col("id") % 5 == 0, F.col("id") % 300)
    left = fixed.range(0, 20_000, 1, 4).select("id", some.alias("k"))
    right = fixed.range(300).select(F.col("id").alias("r"), (F.col("id") * 2).alias("v"))
    tables = [(right, "r"), (right.toDF("r2", "v2"), "r2")]
    for joined in (
        lookup(left, right, "k", "r", spread_by=["id"]),
        split_left_join(left, tables, "k", ["id"]),
        exact_left_joins(left, tables, "k", ["id"]),
    ):
        assert joined.count() == 20_000 and largest_share(joined) < 0.2
        assert joined.where("v IS NOT NULL").count() == 4000 == joined.where("v = 2 * k").count()
    assert largest_share(lookup(left, right, "k", "r")) > 0.7


def test_rows_without_a_partner_are_dealt_out(fixed):
    left = fixed.range(0, 20_000, 1, 4).select("id", (F.col("id") + 10_000_000).alias("k"))
    right = fixed.range(300).select(F.col("id").alias("r"), F.lit("x").alias("v"))
    for spread in ([], ["id"]):
        joined = exact_left_joins(left, [(right, "r")], "k", spread)
        assert joined.count() == 20_000 and largest_share(joined) < 0.2
        assert joined.where("v IS NOT NULL").count() == 0


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz", "decimal(9,2)", "double", "boolean", "binary"])
def test_keys_of_any_type(spark, kind):
    def typed(c):
        text = F.when(c == 1, {"boolean": "true"}.get(kind, "1970-01-01" if "t" in kind[:1] or kind == "date" else "0")).otherwise(
            {"boolean": "false"}.get(kind, "2024-05-06" if "t" in kind[:1] or kind == "date" else "7")
        )
        return F.when(c != 3, text.cast(kind))

    left = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, n int").withColumn("k", typed(F.col("n")))
    right = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "n2 int, v string").withColumn("r", typed(F.col("n2"))).drop("n2")
    got = exact_left_join(left, right, "k", "r", ["id"]).select("id", "v")
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "a"), (1, "b"), (2, None), (3, None)]


def test_scans_grow_with_the_number_of_joins(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "left"))
    joined = spark.read.parquet(str(tmp_path / "left"))
    for n in range(5):
        right = spark.range(5).select(F.col("id").alias(f"r{n}"), F.lit(n).alias(f"v{n}"))
        joined = exact_left_join(joined, right, "id", f"r{n}", ["id"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and joined.count() == 10


def test_keys_with_many_rows_on_both_sides_are_dealt(skewed):
    key = F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 10 == 1, F.lit("Rare ")).otherwise("HOT")
    left = skewed.range(0, 400, 1, 2).select(F.col("id").alias("l"), key.alias("lk"))
    left = left.union(left.where("l = 5"))
    name = F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") == 1, "rare").otherwise("hot  ")
    right = skewed.range(0, 300, 1, 2).select(F.col("id").alias("r"), name.alias("rk"))
    joined = join_roster(left, right, "lk", "rk", "UTF8_LCASE_RTRIM", many=True)
    assert joined.columns == ["l", "lk", "r", "rk"]
    plain = join_roster(left, right, "lk", "rk", "UTF8_LCASE_RTRIM")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))
    same = left.where("lk = 'HOT'"), right.withColumn("rk", F.lit("HOT"))
    joined = join_roster(*same, "lk", "rk", many=True)
    dealt = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert max(dealt) < sum(dealt) / 10


def test_rows_of_a_many_join_do_not_outnumber_its_pairs(skewed):
    left = skewed.range(0, 50).select(F.col("id").alias("k"))
    right = skewed.range(0, 50).select(F.col("id").alias("r"))
    assert split_many_join(left, right, "k", "r").count() == 50


def test_pairs_of_a_many_join_are_small_in_a_file(skewed, tmp_path):
    left = skewed.range(64).select(F.col("id").alias("l"), F.lit("hot").alias("k"))
    right = skewed.range(0, 30_000, 1, 4).select(F.col("id").alias("r"), F.lit("hot").alias("rk"))
    split_many_join(left, right, "k", "rk").write.parquet(str(tmp_path / "pairs"))
    pairs = skewed.read.parquet(str(tmp_path / "pairs"))
    assert pairs.distinct().count() == pairs.count() == 64 * 30_000
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 64 * 30_000 / 2


def test_a_many_join_does_not_hold_the_pairs_of_a_part(skewed):
    left = skewed.range(300).select(F.col("id").alias("l"), F.lit("hot").alias("k"))
    n, plan = executed(split_many_join(left, left.toDF("r", "rk"), "k", "rk").where("l < r"))
    assert n == 300 * 299 / 2
    assert "Generate inline(" in plan and not re.search(r"\*\(\d+\) Generate inline\(", plan)


def test_a_many_join_keeps_equal_rows_and_nulls(skewed):
    left = skewed.range(0, 600, 1, 3).selectExpr("nullif(id % 5, 0) AS `l.1`", "nullif(id % 3, 0) AS k", "map(id % 2, 'x') AS m")
    right = skewed.range(0, 900, 1, 3).selectExpr("nullif(id % 4, 1) AS r", "nullif(id % 6, 0) AS rk", "array(map(id % 2, 'y')) AS rm")
    joined = split_many_join(left, right, "k", "rk")
    plain = left.join(right, F.col("k") == F.col("rk"))
    assert joined.schema.simpleString() == plain.schema.simpleString()
    rows = [sorted(map(str, df.collect())) for df in (joined, plain)]
    assert rows[0] == rows[1] and len(rows[0]) == 2 * 200 * 150
