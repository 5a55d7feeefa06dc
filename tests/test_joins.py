"""Joins against brute force."""

import random

from conftest import rows
from pyspark.sql import functions as F

from ringroster.operators.joins import (
    any_key_rows,
    fan_out,
    join_any_key,
    join_on_expr,
    join_roster,
    link_queue_leg,
    self_parent,
    semi_by_keys,
    with_person_name,
)
from ringroster.operators.skew import exact_left_join, split_left_join


def skewed(rng, n, keys):
    """Keys of which one takes a third of all rows, some NULL."""
    return [rng.choice([1, rng.randrange(keys), rng.randrange(keys)]) if rng.random() > 0.1 else None for _ in range(n)]


def left(spark, rng, n=60):
    data = [(i, k, rng.randrange(3)) for i, k in enumerate(skewed(rng, n, 20))]
    return data, spark.createDataFrame(data, "id bigint, fk bigint, kind int")


def test_any_key_join(spark):
    rng = random.Random(1)
    left_rows, df = left(spark, rng)
    a, b = skewed(rng, 150, 60), skewed(rng, 150, 60)
    right_rows = list(zip(range(150), a, b, strict=True)) + [(900, 5, 5), (901, None, None)]
    right = spark.createDataFrame(right_rows, "rid bigint, a bigint, b bigint")
    got = join_any_key(df, right, "id", ["a", "b"], left_pred=F.col("kind") != 2)
    want = []
    for row in left_rows:
        hits = [r for r in right_rows if row[0] in (r[1], r[2]) and row[2] != 2]
        want += [row + r for r in hits] or [row + (None, None, None)]
    assert rows(got) == sorted(want, key=repr)
    inner = join_any_key(df, right, "id", ["a", "b"], "inner", F.col("kind") != 2)
    assert rows(inner) == sorted([w for w in want if w[3] is not None], key=repr)


def test_any_key_join_is_no_nested_loop(spark):
    _, df = left(spark, random.Random(1))
    right = spark.createDataFrame([(1, 2, 3)], "rid bigint, a bigint, b bigint")
    plan = join_any_key(df, right, "id", ["a", "b"])._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_left_join_keeps_rows_without_key(spark):
    rng = random.Random(2)
    left_rows, df = left(spark, rng)
    right_rows = [(k, i) for i, k in enumerate(skewed(rng, 200, 25))]
    right = spark.createDataFrame(right_rows, "rk bigint, v bigint")
    got = exact_left_join(df, right, "fk", "rk", ["id"], F.col("kind") > 0)
    want = []
    for row in left_rows:
        hits = [r[1] for r in right_rows if r[0] is not None and r[0] == row[1] and row[2] > 0]
        want += [(*row, v) for v in hits] or [(*row, None)]
    assert rows(got) == sorted(want, key=repr)


def test_left_join_to_two_tables_shares_the_key(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 6)], "id bigint, fk bigint")
    a = spark.createDataFrame([(5, "a"), (5, "b")], "ak bigint, av string")
    b = spark.createDataFrame([(6, "c")], "bk bigint, bv string")
    got = split_left_join(df, [(a, "ak"), (b, "bk")], "fk", ["id"])
    assert rows(got) == sorted(
        [(1, 5, "a", None), (1, 5, "b", None), (2, None, None, None), (3, 6, None, "c")], key=repr
    )


def test_copies_of_one_row_stay(spark):
    base = spark.createDataFrame([(1,), (2,)], "id bigint")
    copies = spark.range(0, 900, 1, 9).select(F.lit(1).cast("bigint").alias("k"), F.lit("x").alias("v"))
    got = exact_left_join(base, copies, "id", "k", ["id"])
    assert rows(got.groupBy("id", "v").count()) == [(1, "x", 900), (2, None, 1)]


def test_left_row_stays_without_a_partner(spark):
    """Nothing about the right side is looked up before the join runs."""
    base = spark.createDataFrame([(1,), (2,), (None,)], "id bigint")
    right = spark.createDataFrame([(2, 7), (2, 8), (None, 9)], "k bigint, v bigint")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    got = exact_left_join(base, right, "id", "k", ["id"])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert rows(got) == sorted([(1, None), (2, 7), (2, 8), (None, None)], key=repr)


def test_fan_out(spark):
    rng = random.Random(3)
    left_rows, base = left(spark, rng, 30)
    detail = [(i, k) for i, k in enumerate(skewed(rng, 200, 40))]
    tab = spark.createDataFrame(detail, "tid bigint, base bigint")
    got = fan_out(base, tab, "id", "base")
    want = []
    for row in left_rows:
        hits = [d for d in detail if d[1] == row[0]]
        want += [row + d for d in hits] or [row + (None, None)]
    assert rows(got) == sorted(want, key=repr)


def test_queue_leg(spark):
    rng = random.Random(4)
    kinds = ["fila", "atendimento fila", "ramal"]
    legs = [
        (
            i,
            rng.choice(kinds),
            rng.choice(["L1", "L1", "L2", "L3", None]),
            rng.choice([None, "2024-01-01 10:00:00", "2024-01-01 11:00:00"]),
            rng.choice([None, 201, 314]),
            f"U{i}",
        )
        for i in range(120)
    ]
    schema = "id int, tipo string, linkedid string, at string, idstatusfinal int, uniqueid string"
    df = spark.createDataFrame(legs, schema).withColumn(
        "datahoraatende", F.col("at").cast("timestamp_ntz")
    )
    got = link_queue_leg(df, {"uniqueid": "queue"}).select("id", "queue")

    def matches(x, q):
        if x[1] != "atendimento fila" or q[1] != "fila" or None in (x[2], q[2]) or x[2] != q[2]:
            return False
        if x[3] is None:
            return q[3] is None and x[4] is not None and x[4] == q[4]
        return q[3] == x[3]

    want = []
    for x in legs:
        hits = [q[5] for q in legs if matches(x, q)]
        want += [(x[0], h) for h in hits] or [(x[0], None)]
    assert rows(got) == sorted(want, key=repr)


def test_parent_predicate_never_drops_children(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (2, 1, "x"), (3, 2, "y"), (4, 3, "x"), (5, 99, "x")],
        "id bigint, parent bigint, kind string",
    )
    got = self_parent(df, "parent", {"id": "pid"}, parent_pred=F.col("kind") == "x")
    assert rows(got.select("id", "pid")) == [(1, None), (2, 1), (3, 2), (4, None), (5, None)]


def test_computed_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id bigint, k string")
    right = spark.createDataFrame([("A", 1), ("A", 2), (None, 3)], "rk string, v int")
    got = join_on_expr(df, right, F.upper("k"), "rk", ["id"])
    assert rows(got) == sorted(
        [(1, "a", 1), (1, "a", 2), (2, "b", None), (3, None, None)], key=repr
    )


def test_person_name_in_two_hops(spark):
    users = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "Id bigint, FkPessoa bigint")
    people = spark.createDataFrame([(10, " ana ")], "Id bigint, Nome string")
    facts = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", None)], "f string, u bigint")
    got = with_person_name(facts, users, people, "u", "name").select("f", "name")
    assert rows(got) == [("a", "ANA"), ("b", None), ("c", None), ("d", None), ("e", None)]
    known = with_person_name(facts, users, people, "u", "name", how="inner")
    assert rows(known.select("f")) == [("a",)]


def test_roster_keys_compare_as_text(spark):
    roster = spark.createDataFrame([(7.0, "x"), (None, "y"), (8.0, "z")], "m double, v string")
    register = spark.createDataFrame([(7, "a"), (None, "b"), (9, "c")], "c bigint, w string")
    assert rows(join_roster(roster, register, "m", "c")) == [("7", "x", "7", "a")]


def test_semi_join_ignores_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "x bigint")
    assert rows(semi_by_keys(df, keys, "k", "x")) == [(1,)]


def test_any_key_rows_are_compiled(spark):
    """One row per distinct key that is not null, by plain conditions."""
    data = [(1, 5, 5, 7), (2, None, 5, None), (3, None, None, None), (4, 7, 5, 7)]
    made = any_key_rows(spark.createDataFrame(data, "id int, a int, b bigint, c int"), ["a", "b", "c"])
    assert rows(made.select("id", "_any_key")) == [(1, 5), (1, 7), (2, 5), (4, 5), (4, 7)]
    assert "lambda" not in made._jdf.queryExecution().executedPlan().toString()
