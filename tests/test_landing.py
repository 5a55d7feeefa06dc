"""Merge rules, versioned datasets and policies."""

import random
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringroster.operators.landing import concat_history, first_load, merge_keep_first, merge_keep_last
from ringroster.period import Period
from ringroster.sources.catalog import Catalog, JdbcSplit, Source, jdbc_options, read_nanos
from ringroster.sources.policies import KEEP_FIRST, KEEP_LAST, SNAPSHOT, Policy, land_with_policy
from ringroster.sources.store import (
    dataset_exists,
    land,
    load_history,
    load_period,
    months_of,
    read_manifest,
    replace_snapshot,
)

SCHEMA = "k int, d date, v string"
JAN, FEB, MAR = date(2024, 1, 5), date(2024, 2, 5), date(2024, 3, 5)


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def test_keep_first_and_keep_last_are_mirror_images(spark):
    history = frame(spark, (1, JAN, "old"), (None, None, "old"), (None, None, "older"))
    new = frame(spark, (1, JAN, "new"), (2, JAN, "b"), (2, JAN, "a"), (None, None, "new"))
    first = merge_keep_first(history, new, ["k", "d"], ["v"])
    assert rows(first) == sorted(
        [(1, JAN, "old"), (2, JAN, "a"), (None, None, "old")], key=repr
    )
    last = merge_keep_last(history, new, ["k", "d"], ["v"])
    assert rows(last) == sorted([(1, JAN, "new"), (2, JAN, "b"), (None, None, "new")], key=repr)


@pytest.mark.parametrize("merge", [merge_keep_first, merge_keep_last])
def test_unique_history_gives_the_same_rows(spark, merge):
    rng = random.Random(8)

    def some(n, tag):
        keys = [rng.choice([None, *range(15)]) for _ in range(n)]
        days = [rng.choice([None, JAN, FEB]) for _ in range(n)]
        return [(k, d, f"{tag}{i}") for i, (k, d) in enumerate(zip(keys, days, strict=True))]

    history = {(k, d): (k, d, v) for k, d, v in some(40, "h")}.values()
    old, new = frame(spark, *history), frame(spark, *some(80, "n"))
    for keys in (["k", "d"], ["k"]):
        base = old if len(keys) == 2 else merge(old.where("false"), old, keys)
        plain = merge(base, new, keys, ["v"])
        assert rows(merge(base, new, keys, ["v"], unique_history=True)) == rows(plain)


@pytest.mark.parametrize("merge", [merge_keep_first, merge_keep_last])
def test_merging_twice_changes_nothing(spark, merge):
    history = frame(spark, (1, JAN, "x"), (2, JAN, "y"))
    new = frame(spark, (1, JAN, "z"), (3, JAN, "w"), (3, JAN, "q"))
    once = merge(history, new, ["k"])
    assert rows(merge(once, new, ["k"])) == rows(once)
    assert rows(merge(history, new.where("false"), ["k"])) == rows(history)


def test_history_and_new_may_differ_in_columns(spark):
    old = frame(spark, (1, "x"), schema="k int, a string")
    new = frame(spark, (2, "y"), schema="k int, b string")
    assert rows(concat_history(old, new)) == [(1, "x", None), (2, None, "y")]


def test_first_load_keeps_duplicates_unless_told(spark):
    df = frame(spark, (1, JAN, "x"), (1, JAN, "x"))
    assert first_load(df, ["k"]).count() == 2
    assert first_load(df, keys=["k"], dedup=True).count() == 1


def test_a_missing_dataset_is_empty_with_its_schema(spark, tmp_path):
    where = str(tmp_path / "none")
    assert not dataset_exists(spark, where)
    empty = load_history(spark, where, T.StructType([T.StructField("a", T.IntegerType())]))
    assert empty.count() == 0 and empty.columns == ["a"]
    with pytest.raises(FileNotFoundError):
        load_history(spark, where)


def test_snapshot_is_replaced_by_a_new_version(spark, tmp_path):
    where = str(tmp_path / "snap")
    assert replace_snapshot(frame(spark, (1, JAN, "x"), (2, JAN, "y")), where) == 2
    before = load_history(spark, where)
    assert replace_snapshot(frame(spark, (3, JAN, "z")), where) == 1
    assert rows(load_history(spark, where)) == [(3, JAN, "z")]
    # a reader of the older version is not disturbed
    assert before.count() == 2
    assert read_manifest(spark, where).version == 2


def test_an_empty_result_leaves_the_dataset_alone(spark, tmp_path):
    where = str(tmp_path / "guard")
    replace_snapshot(frame(spark, (1, JAN, "x")), where)
    empty = frame(spark, (1, JAN, "x")).where("false")
    assert replace_snapshot(empty, where) == 1
    assert rows(load_history(spark, where)) == [(1, JAN, "x")]
    assert replace_snapshot(empty, where, guard_empty=False) == 0
    assert load_history(spark, where).count() == 0


def test_a_dataset_may_be_rewritten_from_itself(spark, tmp_path):
    where = str(tmp_path / "self")
    replace_snapshot(frame(spark, (1, JAN, "x")), where)
    land(load_history(spark, where).withColumn("v", F.lit("y")), where)
    assert rows(load_history(spark, where)) == [(1, JAN, "y")]


def test_two_landings_of_one_version_do_not_overwrite(spark, tmp_path, monkeypatch):
    from ringroster.sources import store

    where = str(tmp_path / "race")
    replace_snapshot(frame(spark, (1, JAN, "x")), where)
    stale = read_manifest(spark, where)
    replace_snapshot(frame(spark, (2, JAN, "y")), where)
    monkeypatch.setattr(store, "read_manifest", lambda *_: stale)
    with pytest.raises(RuntimeError):
        replace_snapshot(frame(spark, (3, JAN, "z")), where)


def test_append_if_new_by_month(spark, tmp_path):
    where = str(tmp_path / "calls")
    policy = Policy(KEEP_FIRST, keys=("k", "d"), sort=("k", "d"), tiebreak=("v",), month_column="d")
    first = frame(spark, (1, JAN, "a"), (1, JAN, "a"), (2, FEB, "b"), (3, None, "c"), (3, None, "d"))
    assert land_with_policy(first, where, policy) == 5
    assert not read_manifest(spark, where).unique
    # the second load goes over all parts and removes what the first let in
    assert land_with_policy(frame(spark, (2, FEB, "B"), (4, FEB, "e")), where, policy) == 4
    manifest = read_manifest(spark, where)
    assert manifest.unique and set(manifest.parts) == {"2024-01", "2024-02", "none"}
    # from then on, only the months of the new rows are written
    assert land_with_policy(frame(spark, (5, MAR, "f"), (4, FEB, "E")), where, policy) == 5
    parts = read_manifest(spark, where).parts
    assert parts["2024-01"]["dir"] == manifest.parts["2024-01"]["dir"]
    assert parts["2024-02"]["dir"] != manifest.parts["2024-02"]["dir"]
    assert rows(load_history(spark, where)) == sorted(
        [(1, JAN, "a"), (2, FEB, "b"), (3, None, "c"), (4, FEB, "e"), (5, MAR, "f")], key=repr
    )
    assert rows(load_history(spark, where, parts=["2024-03"])) == [(5, MAR, "f")]
    late = Period(date(2024, 2, 20), date(2024, 3, 1))
    assert rows(load_period(spark, where, late).select("k")) == [(2,), (4,), (5,)]
    assert months_of(Period(date(2023, 11, 5), date(2024, 1, 1))) == [
        "2023-11",
        "2023-12",
        "2024-01",
    ]


def test_nothing_new_changes_nothing(spark, tmp_path):
    where = str(tmp_path / "idle")
    policy = Policy(KEEP_FIRST, keys=("k",), sort=("k",))
    empty = frame(spark, (1, JAN, "a")).where("false")
    assert land_with_policy(empty, where, policy) == 0
    assert not dataset_exists(spark, where)
    land_with_policy(frame(spark, (1, JAN, "a")), where, policy)
    assert land_with_policy(empty, where, policy) == 1
    assert read_manifest(spark, where).version == 1


def test_upsert_finds_a_row_that_changed_its_month(spark, tmp_path):
    where = str(tmp_path / "tabs")
    policy = Policy(KEEP_LAST, keys=("k",), month_column="d", dedup_first_load=True)
    land_with_policy(frame(spark, (1, JAN, "a"), (2, FEB, "b"), (3, MAR, "c")), where, policy)
    before = read_manifest(spark, where).parts
    assert land_with_policy(frame(spark, (1, FEB, "A")), where, policy) == 3
    after = read_manifest(spark, where).parts
    assert set(after) == {"2024-02", "2024-03"}
    assert after["2024-03"] == before["2024-03"]
    assert rows(load_history(spark, where)) == [(1, FEB, "A"), (2, FEB, "b"), (3, MAR, "c")]


def test_landed_files_are_sorted_within_their_month(spark, tmp_path):
    import pyarrow.dataset as ds

    where = str(tmp_path / "sorted")
    policy = Policy(KEEP_FIRST, keys=("k", "d"), sort=("k",), month_column="d")
    data = [((i * 37) % 500, JAN if i % 2 else FEB, "x") for i in range(500)]
    land_with_policy(frame(spark, *data), where, policy)
    land_with_policy(frame(spark, (9999, FEB, "y")), where, policy)
    for part in read_manifest(spark, where).parts.values():
        for file in ds.dataset(f"{where}/{part['dir']}", format="parquet").files:
            keys = ds.dataset(file, format="parquet").to_table()["k"].to_pylist()
            assert keys == sorted(keys)


def test_copies_on_first_load_are_spread_over_files(spark, tmp_path):
    where = str(tmp_path / "copies")
    policy = Policy(KEEP_FIRST, keys=("k", "d"), sort=("k", "d"), month_column="d")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        copies = spark.range(4000).select(
            F.lit(7).alias("k"), F.lit(JAN).alias("d"), F.lit("same").alias("v")
        )
        assert land_with_policy(copies, where, policy) == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = load_history(spark, where).inputFiles()
    assert len(files) > 4
    assert load_history(spark, where).columns == ["k", "d", "v"]


def test_snapshot_policy(spark, tmp_path):
    where = str(tmp_path / "s")
    assert land_with_policy(frame(spark, (1, JAN, "x")), where, Policy(SNAPSHOT)) == 1
    assert land_with_policy(frame(spark, (2, JAN, "y")), where, Policy(SNAPSHOT)) == 1


def test_catalog_reads_by_name(spark, tmp_path):
    frame(spark, (1, JAN, "x")).write.parquet(str(tmp_path / "p"))
    frame(spark, (1, JAN, "x")).write.orc(str(tmp_path / "o"))
    frame(spark, (2, JAN, "y")).createOrReplaceTempView("named_view")
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    catalog = Catalog(
        {
            "p": Source("parquet", str(tmp_path / "p"), schema),
            "o": Source("orc", str(tmp_path / "o")),
            "t": Source("table", "named_view"),
            "bad": Source("csv", "x"),
        }
    )
    assert catalog.read(spark, "p").columns == ["k"]
    assert rows(catalog.read(spark, "o")) == [(1, JAN, "x")]
    assert rows(catalog.read(spark, "t")) == [(2, JAN, "y")]
    assert "t" in catalog and "x" not in catalog
    with pytest.raises(KeyError):
        catalog.read(spark, "x")
    with pytest.raises(ValueError):
        catalog.read(spark, "bad")


def test_jdbc_options_split_the_read():
    source = Source(
        "jdbc",
        "dbo.calls",
        options={"url": "jdbc:sqlserver://host"},
        split=JdbcSplit("id", "0", "1000", 20),
    )
    assert jdbc_options(source) == {
        "dbtable": "dbo.calls",
        "fetchsize": "10000",
        "url": "jdbc:sqlserver://host",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "1000",
        "numPartitions": "20",
    }
    with pytest.raises(ValueError):
        jdbc_options(Source("jdbc", "x"))


def test_history_with_nanosecond_stamps(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    stamps = pa.array([1704067201123456789, None, -1], pa.timestamp("ns"))
    pq.write_table(pa.table({"t": stamps}), tmp_path / "n.parquet")
    got = read_nanos(spark, str(tmp_path / "n.parquet"), ["t"])
    assert dict(got.dtypes)["t"] == "timestamp_ntz"
    assert rows(got.select(F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS"))) == sorted(
        [("2024-01-01 00:00:01.123456",), (None,), ("1969-12-31 23:59:59.999999",)], key=repr
    )


def test_ties_do_not_depend_on_the_order_of_the_input(spark):
    data = [(1, "t", None, "a"), (1, "t", "a", None), (1, "t", "b", "b"), (2, "t", None, None)]
    schema = "k int, declared string, x string, y string"
    history = spark.createDataFrame([], schema)
    for merge in (merge_keep_first, merge_keep_last):
        for unique in (False, True):
            results = [
                rows(merge(history, spark.createDataFrame(d, schema).coalesce(1), ["k"], ["declared"], unique))
                for d in (data, data[::-1])
            ]
            assert results[0] == results[1]


def part_files(where, part):
    import pathlib

    return sorted(pathlib.Path(where, read_manifest_dir(where, part)).rglob("*.parquet"))


def read_manifest_dir(where, part):
    import json
    import pathlib

    newest = max(pathlib.Path(where, "manifests").glob("0*.json"))
    return json.loads(newest.read_text())["parts"][part]["dir"]


@pytest.mark.parametrize("kind", [KEEP_FIRST, KEEP_LAST])
def test_a_landing_reads_only_the_parts_of_its_keys(spark, tmp_path, kind):
    where = str(tmp_path / "indexed")
    policy = Policy(kind, keys=("k",), month_column="d", dedup_first_load=True)
    data = [(i, (JAN, FEB, MAR, None)[i % 4], "a") for i in range(40)] + [(None, JAN, "n")]
    land_with_policy(frame(spark, *data), where, policy)
    assert read_manifest(spark, where).index is None
    # the first merge scans the keys once and leaves an index
    land_with_policy(frame(spark, (1, FEB, "b")), where, policy)
    index = read_manifest(spark, where).index
    assert index["keys"] == ["k"] and len(index["dirs"]) > 10
    # from then on, parts and buckets without one of the new keys cannot even be read
    for part in ("2024-03", "none"):
        for file in part_files(where, part):
            file.write_bytes(b"not parquet")
    moved = frame(spark, (0, FEB, "moved"), (None, JAN, "N"), (100, FEB, "new"))
    assert land_with_policy(moved, where, policy) == 42
    got = {r.k: (r.d, r.v) for r in load_history(spark, where, parts=["2024-01", "2024-02"]).collect()}
    wins = kind == KEEP_LAST
    assert got[0] == ((FEB, "moved") if wins else (JAN, "a"))
    assert got[None] == (JAN, "N" if wins else "n") and got[100] == (FEB, "new")
    after = read_manifest(spark, where).index["dirs"]
    assert 0 < sum(after[b] != index["dirs"].get(b) for b in after) <= 3
    # and what moved is found where it lies now
    land_with_policy(frame(spark, (0, JAN, "back"), (100, JAN, "back")), where, policy)
    got = {r.k: (r.d, r.v) for r in load_history(spark, where, parts=["2024-01", "2024-02"]).collect()}
    assert (got[0], got[100]) == (((JAN, "back"),) * 2 if wins else ((JAN, "a"), (FEB, "new")))


@pytest.mark.parametrize("kind", [KEEP_FIRST, KEEP_LAST])
def test_landings_agree_with_one_merge_of_all(spark, tmp_path, kind):
    rng = random.Random(12)
    where = str(tmp_path / "many")
    policy = Policy(kind, keys=("k", "v"), month_column="d", tiebreak=("d",), dedup_first_load=True)
    want = {}
    for n in range(5):
        data = [(rng.choice([None, *range(12)]), rng.choice([JAN, FEB, MAR, None]), rng.choice("ab")) for _ in range(15)]
        per_key = {}
        for k, d, v in sorted(data, key=lambda r: (r[1] is None, r[1] or JAN)):
            per_key.setdefault((k, v), []).append(d)
        for key, days in per_key.items():
            known = [d for d in days if d is not None]
            best = (max(known) if known else None) if kind == KEEP_LAST else (None if None in days else min(known))
            if kind == KEEP_LAST or key not in want:
                want[key] = best
        assert land_with_policy(frame(spark, *data), where, policy) == len(want)
    assert rows(load_history(spark, where)) == sorted([(k, d, v) for (k, v), d in want.items()], key=repr)


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    where = str(tmp_path / "counted")
    policy = Policy(KEEP_LAST, keys=("k",), month_column="d", dedup_first_load=True)
    data = [(i, (JAN, FEB, None)[i % 3], "a") for i in range(30)]
    land_with_policy(frame(spark, *data), where, policy)
    parts = read_manifest(spark, where).parts
    assert {m: p["rows"] for m, p in parts.items()} == {"2024-01": 10, "2024-02": 10, "none": 10}
    # months nobody named are counted from their files
    land(frame(spark, *data), where, "d")
    assert {m: p["rows"] for m, p in read_manifest(spark, where).parts.items()} == {"2024-01": 10, "2024-02": 10, "none": 10}


def test_nothing_is_left_of_an_empty_landing(spark, tmp_path):
    where = tmp_path / "empty"
    replace_snapshot(frame(spark, (1, JAN, "x")), str(where))
    before = sorted(p.name for p in where.iterdir())
    assert replace_snapshot(frame(spark, (1, JAN, "x")).where("k > 1"), str(where)) == 1
    assert sorted(p.name for p in where.iterdir()) == before


def test_superseded_versions_can_be_removed(spark, tmp_path):
    from ringroster.sources.store import expire

    where = tmp_path / "old"
    assert expire(spark, str(where)) == []
    policy = Policy(KEEP_LAST, keys=("k",), month_column="d", dedup_first_load=True)
    for n in range(4):
        land_with_policy(frame(spark, (1, JAN, f"a{n}"), (2 + n, FEB, "b")), str(where), policy)
    (where / "v0000000009-dead").mkdir()
    want = rows(load_history(spark, str(where)))
    gone = expire(spark, str(where), keep=2)
    assert "v0000000009-dead" in gone and rows(load_history(spark, str(where))) == want
    assert len([p for p in (where / "manifests").glob("0*.json")]) == 2
    kept = Policy(KEEP_LAST, keys=("k",), month_column="d", keep_versions=1)
    land_with_policy(frame(spark, (1, MAR, "z")), str(where), kept)
    assert len([p for p in (where / "manifests").glob("0*.json")]) == 1
    assert rows(load_history(spark, str(where))) == sorted([r for r in want if r[0] != 1] + [(1, MAR, "z")], key=repr)
