"""The jobs by name: which sources each one reads, how it is built and how it lands."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ringroster.period import Period, month_to_date
from ringroster.plans import (
    calls_detail,
    calls_general,
    calls_outcome,
    quality,
    tabulations,
    workforce,
)
from ringroster.plans.calls_outcome import Flows
from ringroster.sources.catalog import Catalog
from ringroster.sources.policies import Policy, land_with_policy
from ringroster.sources.store import load_history, replace_snapshot
from ringroster.spool import spool_scope

Sources = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Settings:
    """What differs between installations: names of clients, operations and IVR flows.

    `collations` says by which collation a source compares texts, by its name in the catalog;
    `collation` is that of all others.
    """

    outcome_cost_prefix: str = ""
    outcome_flows: Flows = Flows("", "")
    detail_cost_contains: str = ""
    register_operations: tuple[str, ...] = ()
    currency: str = "R$"
    collation: str | None = None
    collations: Mapping[str, str | None] = field(default_factory=dict)
    roster_location: str | None = None

    def collation_of(self, source: str) -> str | None:
        return self.collations.get(source, self.collation)


@dataclass(frozen=True)
class Job:
    name: str
    sources: tuple[str, ...]
    build: Callable[[Sources, Period, Settings], DataFrame]
    policy: Policy
    optional: tuple[str, ...] = ()


def _tabulation(job: tabulations.Tabulation) -> Job:
    def build(sources: Sources, period: Period, settings: Settings) -> DataFrame:
        return tabulations.tabulation(job, sources, period)

    return Job(job.name, job.sources, build, job.policy)


def _outcome(sources: Sources, period: Period, settings: Settings) -> DataFrame:
    return calls_outcome.outcome_calls(
        sources,
        period,
        settings.outcome_cost_prefix,
        settings.outcome_flows,
        settings.collation_of(calls_outcome.SOURCES[0]),
    )


def _detail(sources: Sources, period: Period, settings: Settings) -> DataFrame:
    # agent legs never land, so neither they nor their queue legs are looked up
    legs = calls_detail.calls_legs(sources, period, calls_detail.CONTACT_KINDS)
    return calls_detail.calls_detail(
        legs, settings.detail_cost_contains, settings.currency, settings.collation_of("custo")
    )


def _punches(sources: Sources, period: Period, settings: Settings) -> DataFrame:
    if settings.roster_location is not None:
        spark = sources[workforce.PUNCHES].sparkSession
        roster = load_history(spark, settings.roster_location)
    elif workforce.ROSTER in sources:
        roster = workforce.operational_roster(
            sources[workforce.ROSTER], collation=settings.collation_of(workforce.ROSTER)
        )
    else:
        raise KeyError("punches need the roster's source or its landed dataset")
    return workforce.punches_raw(sources, roster, period.start)


JOBS: dict[str, Job] = {
    job.name: job
    for job in (
        Job(
            "calls_general",
            (calls_general.CALLS, calls_general.FACTS),
            lambda s, p, o: calls_general.general_calls(
                s,
                p,
                calls_collation=o.collation_of(calls_general.CALLS),
                facts_collation=o.collation_of(calls_general.FACTS),
            ),
            calls_general.POLICY,
        ),
        Job("calls_outcome", calls_outcome.SOURCES, _outcome, calls_outcome.POLICY),
        Job("calls_detail", calls_detail.SOURCES, _detail, calls_detail.POLICY),
        *[_tabulation(t) for t in tabulations.TABULATIONS],
        Job(
            "quality",
            (quality.SOURCE,),
            lambda s, p, o: quality.quality_evaluations(
                s[quality.SOURCE], p, collation=o.collation_of(quality.SOURCE)
            ),
            quality.POLICY,
        ),
        Job(
            "roster",
            (workforce.ROSTER,),
            lambda s, p, o: workforce.operational_roster(
                s[workforce.ROSTER], collation=o.collation_of(workforce.ROSTER)
            ),
            workforce.SNAPSHOT_POLICY,
        ),
        Job(
            "register",
            (workforce.REGISTER,),
            lambda s, p, o: workforce.hr_register(
                s[workforce.REGISTER],
                o.register_operations,
                collation=o.collation_of(workforce.REGISTER),
            ),
            workforce.SNAPSHOT_POLICY,
        ),
        Job(
            "logged_time",
            (workforce.LOGINS, workforce.LOGIN_USERS),
            lambda s, p, _: workforce.logged_time(
                s[workforce.LOGINS], s[workforce.LOGIN_USERS], p
            ),
            workforce.SNAPSHOT_POLICY,
        ),
        Job(
            "punches",
            (workforce.PUNCHES, workforce.EMPLOYEES, workforce.SCHEDULES),
            _punches,
            workforce.PUNCH_POLICY,
            optional=(workforce.ROSTER,),
        ),
    )
}


def build_job(
    spark: SparkSession,
    name: str,
    catalog: Catalog,
    period: Period | None = None,
    settings: Settings | None = None,
) -> DataFrame:
    """The rows of one job, not landed."""
    job = JOBS[name]
    missing = [s for s in job.sources if s not in catalog]
    if missing:
        raise KeyError(f"job {name} lacks the sources {missing}")
    wanted = [*job.sources, *[s for s in job.optional if s in catalog]]
    period = period or month_to_date()
    sources = {s: catalog.read(spark, s, period) for s in wanted}
    return job.build(sources, period, settings or Settings())


def run_job(
    spark: SparkSession,
    name: str,
    catalog: Catalog,
    location: str,
    period: Period | None = None,
    settings: Settings | None = None,
) -> int:
    """Build one job and land it; return the row count of its dataset."""
    with spool_scope(spark):
        rows = build_job(spark, name, catalog, period, settings)
        return land_with_policy(rows, location, JOBS[name].policy)


def run_staff_master(
    spark: SparkSession,
    roster_location: str,
    register_location: str,
    location: str,
    as_of: date | None = None,
) -> int:
    """Consolidate the landed roster and register into the landed staff master."""
    read = partial(load_history, spark)
    master = workforce.staff_master(read(roster_location), read(register_location), as_of)
    return replace_snapshot(master, location)
