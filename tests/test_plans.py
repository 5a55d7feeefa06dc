"""Physical plans that hold at scale."""

import re
from datetime import date

import pytest

from checks import QUERIES, table
from checks.calls import PERIOD
from checks.sources import call_sources
from ringroster.operators.filters import in_days, latest_snapshot
from ringroster.operators.joins import with_person_name
from ringroster.operators.landing import merge_keep_first
from ringroster.operators.windows import with_ordinal
from ringroster.plans.calls_detail import CONTACT_KINDS, calls_detail, calls_legs
from ringroster.sources.catalog import Catalog, Source

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_day_window_is_pushed_to_the_scan(spark):
    events = table(spark, FOLDER, "events")
    plan = plan_of(in_days(events, "ts", date(2024, 1, 5), date(2024, 1, 6)).select("event_id"))
    pushed = re.search(r"PushedFilters: \[(.*?)\],", plan).group(1)
    assert "GreaterThanOrEqual(ts,2024-01-05" in pushed and "LessThan(ts,2024-01-07" in pushed
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_newest_day_is_a_scan_filter(spark):
    plan = plan_of(latest_snapshot(table(spark, FOLDER, "orders"), "o_orderdate"))
    assert "Join" not in plan and "Subquery" in plan


def test_merge_cuts_hot_keys_before_the_shuffle(spark):
    events = table(spark, FOLDER, "events")
    plan = plan_of(merge_keep_first(events, events, ["user_id"], ["event_id"]))
    assert plan.count("Exchange") == 1
    shuffle = plan.index("Exchange")
    assert "Partial" in plan[shuffle:] and "WindowGroupLimit" in plan[shuffle:]


def test_appending_to_unique_history_does_not_shuffle_it(spark, no_broadcast):
    events = table(spark, FOLDER, "events")
    plan = plan_of(merge_keep_first(events, events, ["event_id"], ["ts"], unique_history=True))
    whole = "event_id#\\d+L,ts#\\d+,user_id#\\d+L,event_type#\\d+,value#\\d+,props#\\d+"
    assert len(re.findall(f"FileScan parquet \\[{whole}\\]", plan)) == 2
    # of history's two scans the one below a shuffle reads only the key
    assert len(re.findall(r"FileScan parquet \[event_id#\d+L\]", plan)) == 1
    assert not re.search(r"^Union\n:- Exchange", plan)


def test_first_punches_are_cut_before_the_shuffle(spark):
    lines = table(spark, FOLDER, "lineitem")
    plan = plan_of(with_ordinal(lines, ["l_suppkey"], ["l_partkey"], "n", at_most=8))
    assert "row_number(), 8, Partial" in plan[plan.index("Exchange") :]


def test_fact_is_shuffled_once_for_a_name(spark, no_broadcast):
    orders = table(spark, FOLDER, "orders").select("o_orderkey", "o_custkey")
    users = table(spark, FOLDER, "customer").selectExpr("c_custkey AS Id", "c_nationkey AS FkPessoa")
    people = table(spark, FOLDER, "nation").selectExpr("n_nationkey AS Id", "n_name AS Nome")
    plan = plan_of(with_person_name(orders, users, people, "o_custkey", "name"))
    # one shuffle of the fact, one of the resolved users, two between users and people
    assert plan.count("Exchange hashpartitioning") == 4


def test_call_detail_without_broadcasts(spark, no_broadcast):
    legs = calls_legs(call_sources(spark, FOLDER), PERIOD, CONTACT_KINDS)
    plan = plan_of(calls_detail(legs, "A"))
    # by call id: one shuffle to find the internal leg, one for the three tables after it
    assert len(re.findall(r"hashpartitioning\(id#", plan)) == 2
    assert len(re.findall(r"SortMergeJoin \[id#\d+L?\]", plan)) == 4
    assert "SinglePartition" not in plan and "Window" not in plan
    # the client filter and the kinds reach the scans
    assert "Contains(r_name,A)" in plan
    assert "_queue_leg" not in plan


def test_bucketed_tables_are_joined_where_they_lie(spark, no_broadcast):
    """Detail tables bucketed by call id are not shuffled; the catalog reads them as tables."""
    sources = call_sources(spark, FOLDER)
    for name, key in (("ligacaointerna", "idligacao"), ("ligacaodiscador", "idligacao")):
        writer = sources[name].write.mode("overwrite").bucketBy(8, key).sortBy(key)
        writer.saveAsTable(f"bucketed_{name}")
        sources[name] = Catalog({name: Source("table", f"bucketed_{name}")}).read(spark, name)
    plan = plan_of(calls_legs(sources, PERIOD, CONTACT_KINDS))
    assert "li_idligacao" in plan and "ld_idligacao" in plan
    assert not re.search(r"hashpartitioning\(l[id]_idligacao", plan)


def test_rows_without_a_key_are_spread(spark, no_broadcast):
    legs = calls_legs(call_sources(spark, FOLDER), PERIOD, CONTACT_KINDS)
    plan = plan_of(legs)
    assert re.search(r"THEN hash\(id#", plan)
    assert re.search(r"SortMergeJoin \[.*_key#\d+L?.*, _part#\d+\]", plan)


def test_one_pass_compares_both_periods(spark):
    from checks.staff import YEARS, base
    from ringroster.plans.headcount import headcount_kpis, kpi_compare

    people = base(spark, FOLDER)
    both, one = plan_of(kpi_compare(people, YEARS)), plan_of(headcount_kpis(people, YEARS))
    assert both.count("FileScan") == one.count("FileScan")


def test_union_filters_reach_every_branch(spark):
    from checks.calls import CLIENT, FLOWS, outcome_sources
    from ringroster.plans.calls_outcome import outcome_calls

    plan = plan_of(outcome_calls(outcome_sources(spark, FOLDER), PERIOD, CLIENT, FLOWS))
    pushed = re.findall(r"PushedFilters: \[.*?ReadSchema", plan)
    assert len(pushed) == 13
    assert all("GreaterThanOrEqual(ts" in p and "LessThanOrEqual(ts" in p for p in pushed)


def test_pairs_of_legs_are_made_last(spark, no_broadcast):
    """Rows without an external call are spread, and pairs with queue legs move no more."""
    plan = plan_of(QUERIES["leg_self_join"](spark, FOLDER))
    joins = re.findall(r"SortMergeJoin \[(\w+)#\d+L?(, _part#\d+)?", plan)
    assert joins[0][0] == "_at" and len([j for j in joins if j[0] == "_at"]) == 1
    assert ("idligextprincipal", ", _part#") in [(k, p[:8]) for k, p in joins]


def test_wide_facts_are_not_sorted(spark, no_broadcast):
    plan = plan_of(QUERIES["general_calls"](spark, FOLDER))
    assert "ShuffledHashJoin" in plan and "BuildLeft" in plan and " Sort [" not in plan


def test_pairs_of_contact_legs_are_made_last(spark, no_broadcast):
    plan = plan_of(calls_legs(call_sources(spark, FOLDER), PERIOD))
    joins = re.findall(r"SortMergeJoin \[(\w+)#\d+L?.*?\], \[(\w+)#", plan)
    assert joins[0][0] == "_at"
    # of the left side, only the mark of its partners comes between the names and the pairs
    assert joins[1][0] == "_key" and joins[2][0].startswith("t_id")


def test_legs_are_repeated_after_other_calls_are_met(spark, no_broadcast):
    legs = calls_legs(call_sources(spark, FOLDER), PERIOD, CONTACT_KINDS)
    joins = re.findall(r"SortMergeJoin \[(\w+)#", plan_of(legs))
    # from the last join to the first; tabulations and surveys repeat legs by the first two _at
    assert joins.index("_at") < joins.index("id") < joins.index("idusuario") < len(joins)


def test_no_default_broadcast_hints(spark):
    plan = call_sources(spark, FOLDER)
    legs = calls_legs(plan, PERIOD)
    assert "ResolvedHint" not in legs._jdf.queryExecution().analyzed().toString()
