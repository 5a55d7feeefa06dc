"""Rosters, HR register, logins, time-clock punches and the staff master."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringroster.functions.codes import age_band, early_exit_flag, trial_status
from ringroster.functions.dates import (
    age_years,
    as_of_column,
    date_text,
    days_between,
    first_date,
    month_abbr,
    parse_date,
    tenure_text,
    year_num,
)
from ringroster.functions.durations import (
    clock_to_secs,
    hm00_text,
    hours_label,
    minutes_to_clock,
    shift_label,
)
from ringroster.functions.text import norm_upper
from ringroster.operators.aggregates import pivot_ordinals
from ringroster.operators.filters import from_day, in_days, latest_snapshot, none_of, one_of
from ringroster.operators.joins import join_roster, semi_by_keys
from ringroster.operators.ordering import order_desc, preview
from ringroster.period import Period
from ringroster.sources.policies import SNAPSHOT, Policy

ROSTER = "roster_days"
REGISTER = "hr_register"
LOGINS = "logins"
LOGIN_USERS = "login_users"
PUNCHES = "punches"
EMPLOYEES = "employees"
SCHEDULES = "schedules"

SNAPSHOT_POLICY = Policy(SNAPSHOT)
PUNCH_POLICY = Policy(SNAPSHOT, guard_empty=False)

# Roster rows left out.
EXCLUDED_TAX_IDS = (0, 20270, 20453)
EXCLUDED_TITLES = (
    "MONITOR DE QUALIDADE",
    "SUPERV TRAINEE",
    "SUPERV JUNIOR",
    "APRENDIZ",
    "TEAM LIDER",
    "CONTROLDESK",
    "ANALISTA DE PLANEJAMENTO",
    "SUPERV PL",
    "COORDENADOR",
    "MULTIPLICADOR DE TREINAMENTO",
    "SUPERVISOR",
    "SUPERVISOR JUNIOR",
    "GERENTE DE ATENDIMENTO",
    "TEAM LEADER",
    "ANALISTA DE PLANEJAMENTO PL",
    "SUPERVISOR TRAINEE",
    "SUPERVISÃO",
    "CONTROL DESK",
)
EXCLUDED_REGISTER_TITLE = "SUPERV JUNIOR"
# Roster columns in output order, and those that are normalised.
ROSTER_COLUMNS = (
    "cd_matricula", "tx_nome", "tm_entrada", "tm_saida", "tm_carga_horaria", "tx_cargo",
    "tx_staff", "tx_escala", "cd_cpf", "tx_escala_semanal", "tx_supervisor", "tx_funcao",
    "quartil", "dt_quadro_dia",
)
ROSTER_NORMALISED = (
    "tx_nome", "tx_cargo", "tx_staff", "tx_escala", "tx_escala_semanal", "tx_supervisor",
    "tx_funcao", "quartil",
)
# Register columns in output order, and those in upper case.
REGISTER_COLUMNS = (
    "CD_FUNCIONARIO", "NO_FUNCIONARIO", "DT_NASCIMENTO", "DS_LOCAL", "DS_OPERACAO",
    "DS_FUNCAO", "DS_SITUACAO", "DT_ADMISSAO", "DT_EXPERIENCIA_FIM",
    "DT_EXPERIENCIA_PRORROGACAO", "DT_DESLIGAMENTO", "OB_DESLIGAMENTO", "OB_DESLIGAMENTO2",
    "ORIGEM_DESLIGAMENTO", "DS_MOTIVO_DESLIGAMENTO", "DS_RAZAO_DESLIGAMENTO",
)
REGISTER_UPPER = (
    "DS_SITUACAO", "OB_DESLIGAMENTO", "OB_DESLIGAMENTO2", "DS_MOTIVO_DESLIGAMENTO",
)
STAFF_DATES = (
    "DT_ADMISSAO", "DT_NASCIMENTO", "DT_EXPERIENCIA_FIM", "DT_EXPERIENCIA_PRORROGACAO",
    "DT_DESLIGAMENTO",
)
SHIFT_TIMES = ("tm_entrada", "tm_saida", "tm_carga_horaria")
PREVIEW_COLUMNS = ("cd_matricula", "IDADE", "FAIXA_ETARIA", "SUB_SITUACAO", "TEMPO_EMPRESA")
PUNCHES_PER_DAY = 8


def operational_roster(
    roster: DataFrame,
    excluded_titles: Sequence[str] = EXCLUDED_TITLES,
    excluded_tax_ids: Sequence[int] = EXCLUDED_TAX_IDS,
    collation: str | None = None,
) -> DataFrame:
    """Newest roster day without excluded titles and placeholder tax ids, distinct.

    The newest day is that of the whole roster. Titles are tested as they are stored,
    before normalisation; a NULL title or tax id is left out.
    """
    staff = latest_snapshot(roster, "dt_quadro_dia").where(
        none_of("cd_cpf", excluded_tax_ids) & none_of("tx_cargo", excluded_titles, collation)
    )
    return staff.select(
        *[norm_upper(c).alias(c) if c in ROSTER_NORMALISED else F.col(c) for c in ROSTER_COLUMNS]
    ).distinct()


def hr_register(
    register: DataFrame,
    operations: Sequence[str],
    excluded_title: str = EXCLUDED_REGISTER_TITLE,
    collation: str | None = None,
) -> DataFrame:
    """Register entries of the operations, without one job title."""
    staff = register.where(
        one_of("DS_OPERACAO", operations, collation)
        & none_of("DS_FUNCAO", [excluded_title], collation)
    )
    return staff.select(
        *[F.upper(c).alias(c) if c in REGISTER_UPPER else F.col(c) for c in REGISTER_COLUMNS],
        F.col("cached_at").alias("DT_ATUALIZACAO_DIRECTIVE"),
    )


def logged_time(logins: DataFrame, users: DataFrame, period: Period) -> DataFrame:
    """Login sessions that began in the period, with staff number and name."""
    names = users.select(
        F.col("tx_user").alias("_user"), "cd_matricula", norm_upper("tx_usuario").alias("tx_usuario")
    )
    sessions = in_days(logins, "dthr_inicio_login", period.start, period.end)
    joined = sessions.join(names, sessions.tx_user == names._user, "inner")
    return joined.select(
        "dthr_inicio_login",
        "dthr_fim_login",
        "cd_ramal",
        "cd_login",
        "cd_matricula",
        "tx_usuario",
        "tp_duracao_login",
        "tp_duracao_pausas",
        "tp_estouro_pausas",
        "tp_duracao_disponivel",
        "tp_duracao_outros",
        "tx_fila",
        norm_upper("tx_custo").alias("tx_custo"),
    )


def newest_logins_first(sessions: DataFrame) -> DataFrame:
    return order_desc(sessions, "dthr_inicio_login", ["cd_login", "cd_ramal"])


def punches_raw(
    sources: Mapping[str, DataFrame],
    roster: DataFrame,
    start: date,
) -> DataFrame:
    """Punches since `start` of the staff on the roster, with name and schedule."""
    staff = semi_by_keys(sources[EMPLOYEES], roster, "numcad", "cd_matricula").select(
        "numcad",
        norm_upper("nomfun").alias("tx_funcionario"),
        F.col("datadm").alias("dt_admissao"),
        F.col("datafa").alias("dt_afastamento"),
        F.col("codesc").alias("_escala"),
    )
    schedules = sources[SCHEDULES].select(
        F.col("codesc").alias("_codigo"), F.col("nomesc").alias("tx_escala")
    )
    staff = staff.join(schedules, staff._escala == schedules._codigo, "inner")
    punches = from_day(sources[PUNCHES], "datacc", start).select(
        F.col("numcra").alias("cd_matricula"), F.col("datacc").alias("dt_ponto"), "horacc"
    )
    return punches.join(staff, punches.cd_matricula == staff.numcad, "inner").select(
        "cd_matricula",
        "dt_ponto",
        "horacc",
        "tx_funcionario",
        "dt_admissao",
        "dt_afastamento",
        "tx_escala",
    )


def punches_wide(punches: DataFrame, drop_null_groups: bool = False) -> DataFrame:
    """One row per person and day with the first eight punches as clock text.

    With `drop_null_groups`, rows without a leave date (or other grouping value) are lost;
    that is the strict reading of the report, and off by default.
    """
    wide = pivot_ordinals(
        punches,
        group=["cd_matricula", "dt_ponto"],
        others=["tx_funcionario", "tx_escala", "dt_admissao", "dt_afastamento"],
        order=["horacc", "tx_funcionario", "tx_escala", "dt_admissao", "dt_afastamento"],
        value=minutes_to_clock("horacc"),
        width=PUNCHES_PER_DAY,
        drop_null_groups=drop_null_groups,
    )
    return wide.select(
        "cd_matricula",
        date_text("dt_ponto", "yyyy-MM-dd").alias("dt_ponto"),
        F.lower("tx_funcionario").alias("tx_funcionario"),
        "tx_escala",
        *[f"HoraPonto{i}" for i in range(1, PUNCHES_PER_DAY + 1)],
        date_text("dt_admissao", "yyyy-MM-dd").alias("dt_admissao"),
        date_text("dt_afastamento", "yyyy-MM-dd").alias("dt_afastamento"),
    )


def _typed(df: DataFrame) -> DataFrame:
    """Dates as DATE (bad text becomes NULL) and shift times as seconds."""
    kinds = {f.name: f.dataType for f in df.schema}

    def is_text(c: str) -> bool:
        return isinstance(kinds[c], T.StringType)

    dates = {c: parse_date(c) if is_text(c) else F.to_date(c) for c in STAFF_DATES}
    times = {c: clock_to_secs(c) if is_text(c) else F.col(c) for c in SHIFT_TIMES}
    return df.withColumns({**dates, **times})


def staff_master(roster: DataFrame, register: DataFrame, as_of: date | None = None) -> DataFrame:
    """Roster joined to the register, with age, trial, tenure and shift columns.

    Dates stay typed here; `staff_master_view` gives them as text.
    """
    staff = _typed(join_roster(roster, register, "cd_matricula", "CD_FUNCIONARIO"))
    staff = staff.withColumn("DT_ATUAL", as_of_column(as_of)).drop("tx_escala", "cd_cpf")
    hired, left = F.col("DT_ADMISSAO"), F.col("DT_DESLIGAMENTO")
    age = age_years("DT_NASCIMENTO", "DT_ATUAL")
    days = days_between(hired, left)
    return staff.withColumns(
        {
            "IDADE": age,
            "FAIXA_ETARIA": age_band(age),
            "SUB_SITUACAO": trial_status(
                left, "DT_EXPERIENCIA_FIM", "DT_EXPERIENCIA_PRORROGACAO", as_of
            ),
            "DIAS_CASA_ATE_DESLIGAMENTO": days,
            "MORTALIDADE_<_90_DIAS": early_exit_flag(days),
            "TEMPO_EMPRESA": tenure_text(hired, first_date(left, F.col("DT_ATUAL"))),
            "MES_ADMISSAO": month_abbr(hired),
            "ANO_ADMISSAO": year_num(hired),
            "MES_DESLIGAMENTO": month_abbr(left),
            "ANO_DESLIGAMENTO": year_num(left),
            "Jornada": shift_label("tm_entrada", "tm_saida"),
            "tm_carga_horaria": hours_label("tm_carga_horaria"),
            "tm_entrada": hm00_text("tm_entrada"),
            "tm_saida": hm00_text("tm_saida"),
        }
    )


def staff_master_view(master: DataFrame) -> DataFrame:
    """The staff master with its dates as `dd/MM/yyyy` text."""
    return master.withColumns({c: date_text(c) for c in (*STAFF_DATES, "DT_ATUAL")})


def staff_preview(master: DataFrame) -> DataFrame:
    return preview(master, PREVIEW_COLUMNS, 5)
