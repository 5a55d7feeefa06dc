"""Headcount and turnover reports over the staff master."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringroster.functions.dates import (
    as_of_column,
    days_between,
    first_date,
    months_of_days,
    parse_date,
    year_num,
)
from ringroster.functions.text import count_text, icontains, months_text, pct_text, upper_in
from ringroster.operators import aggregates
from ringroster.operators.aggregates import ratio_pct
from ringroster.operators.filters import by_origin, cohort, touches_years
from ringroster.operators.ordering import latest_year, order_mixed, sorted_distinct
from ringroster.operators.projections import select_existing, upper_columns

HIRE_YEAR = "DT_ADMISSAO_ANO"
EXIT_YEAR = "DT_DESLIGAMENTO_ANO"
ORIGIN = "ORIGEM_DESLIGAMENTO"
CUBE_KEYS = (HIRE_YEAR, EXIT_YEAR, ORIGIN)
# Situations that count as active, the word that marks an exit, limits.
ACTIVE_SITUATIONS = ("TRABALHANDO", "FÉRIAS", "ATESTADO MÉDICO INTEGRAL")
EXIT_WORD = "DEMISSÃO"
EARLY_DAYS = 90
OFFENDER_LIMIT = 85
# Card labels in order; `worse` cards are worse when they rise.
KPI_LABELS = {
    "volume": "Volume Colaboradores",
    "active": "Efetivo Ativo",
    "exits": "Saídas Totais",
    "turnover_pct": "% Índice Turnover",
    "early_attrition_pct": "% Evasão Exp.",
    "mean_months": "Média Tempo Casa",
}
WORSE_WHEN_RISING = ("exits", "turnover_pct", "early_attrition_pct")
DETAIL_COLUMNS = (
    "TX_SUPERVISOR", "NO_FUNCIONARIO", "ATIVO", "DESLIGADO", "DT_ADMISSAO",
    "DT_DESLIGAMENTO", "DS_OPERACAO", "OB_DESLIGAMENTO", "OB_DESLIGAMENTO2",
    "ORIGEM_DESLIGAMENTO", "DS_MOTIVO_DESLIGAMENTO", "DS_RAZAO_DESLIGAMENTO",
    "SUB_SITUACAO", "DIAS_CASA_ATE_DESLIGAMENTO",
)


@dataclass(frozen=True)
class Selection:
    """Years, and the origin of exits if only one is wanted."""

    years: Sequence[int]
    origin: str | None = None


def headcount_base(master: DataFrame, as_of: date | None = None) -> DataFrame:
    """The staff master with upper-case names, days and months of tenure and the years of
    hire and exit. Dates may be typed or day-first text."""
    staff = upper_columns(master)
    kinds = {f.name: f.dataType for f in staff.schema}

    def day(c: str) -> Column:
        is_text = isinstance(kinds[c], T.StringType)
        return parse_date(c, "dd/MM/yyyy") if is_text else F.to_date(c)

    staff = staff.withColumns({c: day(c) for c in ("DT_ADMISSAO", "DT_DESLIGAMENTO")})
    staff = staff.withColumn(
        "DATA_REF_TEMPO", first_date("DT_DESLIGAMENTO", as_of_column(as_of))
    )
    days = days_between("DT_ADMISSAO", "DATA_REF_TEMPO")
    return staff.withColumns(
        {
            "DIAS_CASA": days,
            "MESES_CASA": months_of_days(days),
            HIRE_YEAR: year_num("DT_ADMISSAO"),
            EXIT_YEAR: year_num("DT_DESLIGAMENTO"),
        }
    )


def cohort_cube(base: DataFrame) -> DataFrame:
    """People by year of hire, year of exit and origin of the exit: all that the KPIs of any
    years and any origin need, in some thousand rows that may be landed.

    Exits are told by the situation text, not by the exit date.
    """
    left = icontains("DS_SITUACAO", EXIT_WORD)
    return base.groupBy(*CUBE_KEYS).agg(
        F.count(F.lit(1)).alias("people"),
        F.count_if(upper_in("DS_SITUACAO", ACTIVE_SITUATIONS)).alias("active"),
        F.count_if(left).alias("exits"),
        F.count_if(left & (F.col("DIAS_CASA") <= EARLY_DAYS)).alias("early_exits"),
        F.sum("MESES_CASA").alias("months"),
        F.count("MESES_CASA").alias("months_known"),
    )


def _kpi_columns(years: Sequence[int], prefix: str = "", origin: str | None = None) -> list[Column]:
    """Aggregates over a cube, of the people hired or leaving in `years`."""
    inside = touches_years(years, HIRE_YEAR, EXIT_YEAR)
    if origin is not None:
        inside = inside & (F.col(ORIGIN) == origin)

    def total(c: str) -> Column:
        return F.coalesce(F.sum(F.when(inside, F.col(c))), F.lit(0))

    volume, exits = total("people"), total("exits")
    mean = total("months") / F.nullif(total("months_known"), F.lit(0))
    values = {
        "volume": volume,
        "active": total("active"),
        "exits": exits,
        "turnover_pct": ratio_pct(exits, volume),
        "early_attrition_pct": ratio_pct(total("early_exits"), exits),
        "mean_months": F.when(volume > 0, mean).otherwise(F.lit(0.0)),
    }
    return [value.alias(prefix + name) for name, value in values.items()]


def headcount_kpis(base: DataFrame, years: Sequence[int]) -> DataFrame:
    """The six KPIs of the chosen years, in one row."""
    return cohort_cube(base).agg(*_kpi_columns(years))


def kpi_selections(cube: DataFrame, selections: Mapping[str, Selection]) -> DataFrame:
    """The KPIs of several selections of years, each of one origin or of all, one row for each
    by its name; the cube is read once."""
    picked = cube.agg(
        *[
            F.struct(F.lit(name).alias("selection"), *_kpi_columns(chosen.years, "", chosen.origin)).alias(f"s{i}")
            for i, (name, chosen) in enumerate(selections.items())
        ]
    )
    return picked.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(selections))])))


def previous_years(years: Sequence[int]) -> list[int]:
    """The years shifted back by how many there are."""
    return [y - len(years) for y in years]


def kpi_compare(base: DataFrame, years: Sequence[int]) -> DataFrame:
    """Each KPI beside its value in the previous years; both come from one cube."""
    both = cohort_cube(base).agg(
        *_kpi_columns(years, "now_"), *_kpi_columns(previous_years(years), "before_")
    )
    rows = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("kpi"),
            F.lit(label).alias("label"),
            F.col(f"now_{name}").cast("double").alias("value"),
            F.col(f"before_{name}").cast("double").alias("previous"),
            F.lit(name in WORSE_WHEN_RISING).alias("rising_is_worse"),
        )
        for position, (name, label) in enumerate(KPI_LABELS.items(), start=1)
    ]
    kpis = both.select(F.inline(F.array(*rows)))
    diff = F.col("value") - F.col("previous")
    worse = F.when(F.col("rising_is_worse"), diff > 0).otherwise(diff < 0)
    worse = F.coalesce(worse, F.lit(False))  # an unknown difference is no warning
    return kpis.select(
        "position",
        "kpi",
        "label",
        "value",
        "previous",
        diff.alias("diff"),
        worse.alias("worse"),
    )


def kpi_text(compared: DataFrame) -> DataFrame:
    """KPIs and differences as shown on cards."""

    def shown(c: str, signed: bool) -> Column:
        return (
            F.when(F.col("kpi").endswith("_pct"), pct_text(c, signed))
            .when(F.col("kpi") == "mean_months", months_text(c, signed))
            .otherwise(count_text(c, signed))
        )

    return compared.select(
        "position",
        "kpi",
        "label",
        shown("value", False).alias("value_text"),
        shown("diff", True).alias("diff_text"),
        F.when(F.col("diff") < 0, "↓").otherwise("↑").alias("arrow"),
        "worse",
    )


def inventory(base: DataFrame) -> DataFrame:
    """All records, and people without an exit date."""
    return base.agg(
        F.count("*").alias("base_rows"),
        F.count_if(F.col("DT_DESLIGAMENTO").isNull()).alias("current_staff"),
    )


def leaving_reasons(
    base: DataFrame, years: Sequence[int], origin: str | None = None
) -> DataFrame:
    """Pareto of leaving reasons in the years, optionally of one origin."""
    left = by_origin(cohort(base, years, EXIT_YEAR), "ORIGEM_DESLIGAMENTO", origin)
    return aggregates.pareto(left, "DS_RAZAO_DESLIGAMENTO")


def main_reasons(reasons: DataFrame, limit: float = OFFENDER_LIMIT) -> DataFrame:
    """Reasons that together make up to 85 % of exits."""
    return aggregates.offenders(reasons, limit)


def detail_listing(base: DataFrame) -> DataFrame:
    """Detail table: the wanted columns that exist, by supervisor, then by name and hire."""
    order = {
        "TX_SUPERVISOR": "asc",
        "ATIVO": "desc",
        "NO_FUNCIONARIO": "asc",
        "DT_ADMISSAO": "asc",
    }
    return order_mixed(select_existing(base, DETAIL_COLUMNS), order)


def hires(base: DataFrame, years: Sequence[int]) -> DataFrame:
    return cohort(base, years, HIRE_YEAR)


def leavers(base: DataFrame, years: Sequence[int]) -> DataFrame:
    return cohort(base, years, EXIT_YEAR)


def available_years(base: DataFrame) -> DataFrame:
    return sorted_distinct(base, HIRE_YEAR, desc=True)


def available_origins(base: DataFrame) -> DataFrame:
    return sorted_distinct(base, "ORIGEM_DESLIGAMENTO")


def default_year(base: DataFrame) -> DataFrame:
    return latest_year(base, HIRE_YEAR)
