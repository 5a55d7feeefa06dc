"""Every job, from named sources to its landed dataset."""

import os
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks import calls, staff, tabs
from checks.sources import call_sources
from ringroster.period import Period
from ringroster.plans import headcount, quality, tabulations, workforce
from ringroster.plans.calls_general import CALLS, FACTS, general_calls
from ringroster.plans.jobs import JOBS, Settings, build_job, run_job, run_staff_master
from ringroster.sources.catalog import Catalog, Source
from ringroster.sources.store import load_history, read_manifest

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
SETTINGS = Settings(
    outcome_cost_prefix=calls.CLIENT,
    outcome_flows=calls.FLOWS,
    detail_cost_contains="A",
    register_operations=tuple(staff.OPERATIONS),
)
TABS = {t.name: t for t in tabulations.TABULATIONS}
PUNCH_PERIOD = Period(date(1996, 1, 1), date(1996, 1, 31))
PERIODS = {
    "calls_general": calls.GENERAL_PERIOD,
    "quality": staff.QUALITY_PERIOD,
    "logged_time": staff.LOGIN_PERIOD,
    "punches": PUNCH_PERIOD,
    **{name: tabs.PERIOD for name in TABS},
}


def sources_of(spark, name):
    if name in TABS:
        return tabs.tabulation_sources(spark, FOLDER, TABS[name])
    if name == "calls_general":
        sources = calls.general_sources(spark, FOLDER)
        data = F.to_date("Data").alias("Data")
        sources[CALLS] = sources[CALLS].select(
            *[data if c == "Data" else F.col(f"`{c}`") for c in sources[CALLS].columns]
        )
        return sources
    return {
        "calls_outcome": lambda: calls.outcome_sources(spark, FOLDER),
        "calls_detail": lambda: call_sources(spark, FOLDER),
        "quality": lambda: {quality.SOURCE: staff.quality_source(spark, FOLDER)},
        "roster": lambda: {workforce.ROSTER: staff.roster_days(spark, FOLDER)},
        "register": lambda: {workforce.REGISTER: staff.register_source(spark, FOLDER)},
        "logged_time": lambda: staff.login_sources(spark, FOLDER),
        "punches": lambda: {
            **staff.punch_sources(spark, FOLDER),
            workforce.ROSTER: staff.roster_days(spark, FOLDER),
        },
    }[name]()


def catalog_of(sources):
    """A catalog of views over the sources."""
    for name, df in sources.items():
        df.createOrReplaceTempView(f"source_{name}")
    return Catalog({name: Source("table", f"source_{name}") for name in sources})


def test_all_jobs_are_there():
    assert len(JOBS) == 21


@pytest.mark.parametrize("name", sorted(JOBS))
def test_job_lands(spark, tmp_path, name):
    catalog = catalog_of(sources_of(spark, name))
    period = PERIODS.get(name, calls.PERIOD)
    where = str(tmp_path / name)
    built = build_job(spark, name, catalog, period, SETTINGS)
    n = built.count()
    assert n > 0
    assert run_job(spark, name, catalog, where, period, SETTINGS) == n
    landed = load_history(spark, where)
    assert landed.columns == built.columns
    assert rows(landed.select(*built.columns[:6])) == rows(built.select(*built.columns[:6]))
    # a second run of the same extract changes the keyed datasets to one row per key
    again = run_job(spark, name, catalog, where, period, SETTINGS)
    policy = JOBS[name].policy
    if policy.keys:
        assert again == built.select(*policy.keys).distinct().count()
        assert read_manifest(spark, where).unique
    else:
        assert again == n


def test_wide_outputs_have_their_columns(spark):
    catalog = catalog_of(sources_of(spark, "calls_general"))
    general = build_job(spark, "calls_general", catalog, calls.GENERAL_PERIOD)
    assert len(general.columns) == 110
    assert general.columns[:3] == ["t_uniqueid", "t_Chamada", "t_Data"]
    assert general.columns[32:34] == ["d_Chamada", "d_Numero"]
    assert general.columns[-2:] == ["tx_cpf_cnpj_jira", "fora_de_horario"]
    outcome = build_job(
        spark, "calls_outcome", catalog_of(sources_of(spark, "calls_outcome")), calls.PERIOD, SETTINGS
    )
    assert len(outcome.columns) == 61
    assert outcome.columns[29:33] == ["ref10", "ref14", "ref11", "ref12"]
    detail = build_job(
        spark, "calls_detail", catalog_of(sources_of(spark, "calls_detail")), calls.PERIOD, SETTINGS
    )
    assert detail.columns[0] == "datahora_ts" and len(detail.columns) == 75


def test_calls_without_facts_are_left_out(spark):
    sources = sources_of(spark, "calls_general")
    sources[FACTS] = sources[FACTS].where("OP = 'N3'")
    assert general_calls(sources, calls.GENERAL_PERIOD).count() == 0


def test_sum_of_branches_is_the_union(spark):
    from ringroster.plans.calls_outcome import outcome_calls

    sources = calls.outcome_sources(spark, FOLDER)
    total = outcome_calls(sources, calls.PERIOD, calls.CLIENT, calls.FLOWS).count()
    empty = {name: df.where("false") for name, df in sources.items()}
    parts = sum(
        outcome_calls({**empty, name: df}, calls.PERIOD, calls.CLIENT, calls.FLOWS).count()
        for name, df in sources.items()
    )
    assert total == parts > 0


def test_later_periods_add_to_the_history(spark, tmp_path):
    catalog = catalog_of(sources_of(spark, "n2_fraud"))
    where = str(tmp_path / "n2")
    counts = []
    for month in (2, 3, 4):
        start = date(1997, month, 1)
        period = Period(start, start + timedelta(days=27))
        counts.append(run_job(spark, "n2_fraud", catalog, where, period))
    assert counts == sorted(counts) and counts[0] < counts[-1]
    assert set(read_manifest(spark, where).parts) == {"1997-02", "1997-03", "1997-04"}


def test_missing_source_is_named(spark):
    with pytest.raises(KeyError, match="users"):
        build_job(spark, "n2_fraud", Catalog({}))


def test_staff_master_from_landed_parts(spark, tmp_path):
    roster, register, master = (str(tmp_path / n) for n in ("roster", "register", "master"))
    run_job(spark, "roster", catalog_of(sources_of(spark, "roster")), roster)
    run_job(
        spark, "register", catalog_of(sources_of(spark, "register")), register, settings=SETTINGS
    )
    n = run_staff_master(spark, roster, register, master, staff.AS_OF)
    landed = load_history(spark, master)
    assert n == landed.count() == staff.master(spark, FOLDER).count() > 0
    kpis = headcount.headcount_kpis(headcount.headcount_base(landed, staff.AS_OF), staff.YEARS)
    assert kpis.first() == headcount.headcount_kpis(staff.base(spark, FOLDER), staff.YEARS).first()
    # the punches job can take its staff from the landed roster
    sources = staff.punch_sources(spark, FOLDER)
    settings = Settings(roster_location=roster)
    got = build_job(spark, "punches", catalog_of(sources), PUNCH_PERIOD, settings)
    want = build_job(spark, "punches", catalog_of(sources_of(spark, "punches")), PUNCH_PERIOD)
    assert rows(got) == rows(want) != []
    with pytest.raises(KeyError, match="roster"):
        build_job(spark, "punches", catalog_of(sources), PUNCH_PERIOD)
