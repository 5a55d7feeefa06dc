"""Tabulations: what operators recorded about tickets, disputes and onboarding cases.

The jobs differ only in their tables and columns, so each is one `Tabulation` and all run
through `tabulation`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringroster.functions.dates import day_plus_seconds, dayfirst_to_iso
from ringroster.functions.text import norm_upper, scrub_upper
from ringroster.operators.filters import in_days
from ringroster.operators.joins import fan_out, lookup, with_person_name
from ringroster.operators.projections import LABEL_COLUMN, with_prefix
from ringroster.period import Period
from ringroster.sources.policies import KEEP_LAST, SNAPSHOT, Policy

USERS = "users"
PEOPLE = "people"
BASE, TAB, ISSUER = "b_", "t_", "d_"
PERSON = "_operator_name"
OPERATOR_FK = "FkUsuarioOperador"

Rule = Callable[[str], Column]


def plain(c: str) -> Column:
    return F.col(c)


def upper(c: str) -> Column:
    return F.upper(F.col(c))


@dataclass(frozen=True)
class Tabulation:
    """One job: source tables, output columns and landing policy.

    A column is `(output, source column, rule)`; source columns carry the prefix of their
    table: `t_` tabulation, `b_` base, `d_` issuer. `base` and `issuer` name the tables of
    jobs whose base rows lead; such a base row appears once per tabulation, or once with
    NULLs if it has none.
    """

    name: str
    label: str
    table: str
    columns: tuple[tuple[str, str, Rule], ...]
    base: str | None = None
    base_fk: str | None = None
    issuer: str | None = None
    day_column: str | None = None
    person_required: bool = False
    policy: Policy = Policy(SNAPSHOT)

    @property
    def sources(self) -> tuple[str, ...]:
        tables = (self.table, self.base, self.issuer, USERS, PEOPLE)
        return tuple(t for t in tables if t)


def tabulation(
    job: Tabulation, sources: Mapping[str, DataFrame], period: Period | None = None
) -> DataFrame:
    """Build one job's dataset. The day window applies where the job has a day column."""
    tab = with_prefix(sources[job.table], TAB)
    spread_by = [f"{TAB}Id"] if job.base is None else [f"{BASE}Id", f"{TAB}Id"]
    if job.base is None:
        rows = _windowed(job, tab, period)
    else:
        base = _windowed(job, with_prefix(sources[job.base], BASE), period)
        rows = fan_out(base, tab, f"{BASE}Id", f"{TAB}{job.base_fk}")
        if job.issuer is not None:
            issuers = with_prefix(sources[job.issuer], ISSUER, ["Id", "DsEmissor"])
            rows = lookup(rows, issuers, f"{BASE}FkTipoEmissor", f"{ISSUER}Id", spread_by=spread_by)
    rows = with_person_name(
        rows,
        sources[USERS],
        sources[PEOPLE],
        f"{TAB}{OPERATOR_FK}",
        PERSON,
        how="inner" if job.person_required else "left",
        spread_by=spread_by,
    )
    return rows.select(
        F.lit(job.label).alias(LABEL_COLUMN),
        *[rule(source).alias(output) for output, source, rule in job.columns],
    )


def _windowed(job: Tabulation, df: DataFrame, period: Period | None) -> DataFrame:
    if job.day_column is None or period is None:
        return df
    return in_days(df, job.day_column, period.start, period.end)


def _entry_instant(day: str) -> Column:
    """Entry day plus the entry time of day, held in seconds beside it."""
    return day_plus_seconds(day, F.col(f"{TAB}HoraDaEntrada"))


def _upsert(month_column: str) -> Policy:
    """Upsert by Id.

    Base-led jobs carry the base row's Id, so the second load keeps one tabulation per base
    row. That is how the datasets behave; pass another policy to key them differently.
    """
    return Policy(KEEP_LAST, keys=("Id",), month_column=month_column)


_NAME = ("Nome", PERSON, plain)
_ANALYST = ("Analista", PERSON, plain)
_STATUS = (("Status", "t_Status", norm_upper), ("MotivoDoStatus", "t_MotivoDoStatus", norm_upper))
_RAISED = (("Status", "t_Status", upper), ("MotivoDoStatus", "t_MotivoDoStatus", upper))
_TAB_STATUS = (
    ("Tabulacao_Status", "t_Status", norm_upper),
    ("Tabulacao_MotivoDoStatus", "t_MotivoDoStatus", norm_upper),
)
_RECORDED = ("Tabulacao_DtCadastro", "t_DtCadastro", plain)
_ISSUER = ("DsEmissor", "d_DsEmissor", plain)

# Labels and output columns, in order.
N2_FRAUD = Tabulation(
    "n2_fraud",
    "N2: Falcon",
    "tab_n2_fraud",
    (
        ("Id", "t_Id", plain),
        _RECORDED,
        ("DataHoraEntrada", "t_DataDaEntrada", _entry_instant),
        *_STATUS,
        _NAME,
    ),
    day_column="t_DtCadastro",
    policy=_upsert("Tabulacao_DtCadastro"),
)
N2_TICKETS = Tabulation(
    "n2_tickets",
    "N2: Jira",
    "tab_n2_tickets",
    (
        ("Id", "t_Id", plain),
        ("DtCadastro", "t_DtCadastro", plain),
        ("Emissor", "t_IdEmissor", norm_upper),
        ("TipoDoDocumento", "t_TipoDoDocumento", plain),
        ("Ticket", "t_Ticket", plain),
        *_RAISED,
        _NAME,
    ),
    day_column="t_DtCadastro",
    policy=_upsert("DtCadastro"),
)
N2_PREVENTION = Tabulation(
    "n2_prevention",
    "N2: JiraPrevencao",
    "tab_n2_prevention",
    (
        ("Id", "t_Id", plain),
        ("DtCadastro", "t_DtCadastro", plain),
        ("DataSolicitacao", "t_DataSolicitacao", plain),
        *_RAISED,
        _NAME,
    ),
    day_column="t_DtCadastro",
    policy=_upsert("DtCadastro"),
)
N3_ISSUERS = Tabulation(
    "n3_issuers",
    "Emissores",
    "tab_n3_issuers",
    (
        ("Id", "b_Id", plain),
        _RECORDED,
        ("DtCadastro", "b_DtCadastro", plain),
        ("DataAlteracao", "b_DataAlteracao", plain),
        ("AgingContestacao", "b_AgingContestacao", plain),
        ("StatusContestacao", "b_StatusContestacao", plain),
        ("CodigoAutorizacao", "b_CodigoAutorizacao", plain),
        _ISSUER,
        *_STATUS,
        _NAME,
    ),
    base="base_n3_issuers",
    base_fk="FkTbaseTabuladorEmissores",
    issuer="issuers",
    day_column="b_DtCadastro",
    policy=_upsert("DtCadastro"),
)
N3_TICKETS = Tabulation(
    "n3_tickets",
    "Jira",
    "tab_n3_tickets",
    (
        ("Id", "b_Id", plain),
        ("Cod_base", "b_Idbase", plain),
        _RECORDED,
        ("DtCadastro", "b_DtCadastro", plain),
        ("DataSolicitacao", "b_DataSolicitacao", plain),
        ("SubEmissor", "b_SubEmissor", plain),
        _ISSUER,
        *_STATUS,
        _NAME,
    ),
    base="base_n3_tickets",
    base_fk="FkTbaseTabuladorZendesk",
    issuer="issuers_tickets",
    day_column="b_DtCadastro",
    policy=_upsert("DtCadastro"),
)
N3_NETWORK_A = Tabulation(
    "n3_network_a",
    "Master",
    "tab_n3_network_a",
    (
        ("Id", "b_Id", plain),
        ("ClaimID", "b_ClaimID", plain),
        _RECORDED,
        ("DtCadastro", "b_DtCadastro", plain),
        ("OriginalTransactionDate", "b_OriginalTransactionDate", dayfirst_to_iso),
        _ISSUER,
        *_STATUS,
        _NAME,
    ),
    base="base_n3_network_a",
    base_fk="FkTbaseTabuladorEmissoresMaster",
    issuer="issuers_network_a",
    day_column="b_DtCadastro",
    policy=_upsert("DtCadastro"),
)
N3_NETWORK_B = Tabulation(
    "n3_network_b",
    "Visa",
    "tab_n3_network_b",
    (
        ("Id", "b_Id", plain),
        ("DtCadastro", "b_DtCadastro", plain),
        _RECORDED,
        ("ROLCase", "b_ROLCase", plain),
        ("DaysToAct", "b_DaysToAct", plain),
        _ISSUER,
        *_STATUS,
        _NAME,
    ),
    base="base_n3_network_b",
    base_fk="FkTbaseTabuladorEmissoresVisa",
    issuer="issuers_network_b",
    day_column="b_DtCadastro",
    policy=_upsert("DtCadastro"),
)
ONBOARDING_BPP = Tabulation(
    "onboarding_bpp",
    "OnboardingBPP",
    "tab_onboarding_bpp",
    (
        _RECORDED,
        ("Parceiro", "t_Parceiro", plain),
        ("Sistema", "t_Sistema", plain),
        ("SituacaoRF", "t_SituacaoRF", plain),
        ("StatusBase", "t_StatusBase", plain),
        ("StatusTabulador", "t_StatusTabulador", plain),
        ("TipoDePessoa", "t_TipoDePessoa", plain),
        ("Trabalhados", "t_Trabalhados", plain),
        ("CNPJ", "t_Cnpj", plain),
        ("NomeEmpresa", "t_NomeEmpressa", scrub_upper),
        _ANALYST,
    ),
)
ONBOARDING_TICKETS = Tabulation(
    "onboarding_tickets",
    "OnboardingJira",
    "tab_onboarding_tickets",
    (
        ("Tabulacao_Id", "t_Id", plain),
        _RECORDED,
        *_TAB_STATUS,
        _ANALYST,
        ("Tabulacao_Observacao", "t_Observacao", plain),
        ("DataSolicitacao", "t_DataSolicitacao", plain),
        ("Tabulacao_Categoria", "t_Categoria", norm_upper),
        ("Base_DtCadastro", "b_DtCadastro", plain),
        ("Base_DtLimite", "b_Datalimite", plain),
        ("Base_Organizations", "b_Organizations", plain),
        ("Base_Chave", "b_Chave", plain),
        ("Base_Status", "b_Status", norm_upper),
        ("Base_SituacaoAtendimento", "b_SituacaoAtendimento", norm_upper),
    ),
    base="base_onboarding_tickets",
    base_fk="FkTbaseTabuladorOnboardingJira",
)
ONBOARDING_PF = Tabulation(
    "onboarding_pf",
    "OnboardingPF",
    "tab_onboarding_pf",
    (
        _RECORDED,
        ("Tabulacao_DtDaEntrada", "t_DataDaEntrada", plain),
        ("HoraDaEntrada", "t_HoraDaEntrada", plain),
        ("Emissor", "t_IdEmissor", plain),
        *_TAB_STATUS,
        ("Categoria", "t_Categoria", norm_upper),
        ("CPF", "t_CPF", plain),
        _ANALYST,
    ),
)
ONBOARDING_PJ = Tabulation(
    "onboarding_pj",
    "OnboardingPJ",
    "tab_onboarding_pj",
    (
        _RECORDED,
        ("DataDaEntrada", "t_DataDaEntrada", plain),
        ("DataInicio", "t_DataInicio", plain),
        ("Emissor", "t_IdEmissor", plain),
        ("CNPJ", "t_Cnpj", plain),
        ("Empressa", "t_Empressa", norm_upper),
        ("Porte", "t_Porte", plain),
        *_TAB_STATUS,
        _ANALYST,
    ),
    person_required=True,
)
ONBOARDING_PJ_MANUAL = Tabulation(
    "onboarding_pj_manual",
    "OnboardingPJ_Manual",
    "tab_onboarding_pj_manual",
    (
        _RECORDED,
        ("Tabulacao_DtDaEntrada", "t_DataDaEntrada", plain),
        ("Tabulacao_DataInicio", "t_DataInicio", plain),
        ("CNPJ", "t_Cnpj", plain),
        *_TAB_STATUS,
        ("Emissor", "t_IdEmissor", plain),
        ("Fila", "t_Fila", plain),
        ("NomeEmpresa", "t_Empressa", scrub_upper),
        ("Porte", "t_Porte", plain),
        ("DataUltimoDiaCorrecao", "t_DataUltimoDiaCorrecao", plain),
        _ANALYST,
    ),
)
ONBOARDING_PLD = Tabulation(
    "onboarding_pld",
    "OnboardingPLD",
    "tab_onboarding_pld",
    (
        _RECORDED,
        ("DataCaso", "t_DataCaso", plain),
        ("HoraCaso", "t_HoraCaso", plain),
        ("DataAnalise", "t_DataAnalise", plain),
        ("HoraAnalise", "t_HoraAnalise", plain),
        ("ProcessID", "t_ProcessID", plain),
        ("NomeCliente", "t_Nome", scrub_upper),
        ("CPF", "t_CPF", plain),
        ("Cargo", "t_Cargo", scrub_upper),
        ("Emissor", "t_SubEmissor", plain),
        ("Resultado", "t_Resultado", plain),
        ("PepTitularRelacionado", "t_PepTitularRelacionado", plain),
        _ANALYST,
    ),
)

TABULATIONS = (
    N2_FRAUD,
    N2_TICKETS,
    N2_PREVENTION,
    N3_ISSUERS,
    N3_TICKETS,
    N3_NETWORK_A,
    N3_NETWORK_B,
    ONBOARDING_BPP,
    ONBOARDING_TICKETS,
    ONBOARDING_PF,
    ONBOARDING_PJ,
    ONBOARDING_PJ_MANUAL,
    ONBOARDING_PLD,
)
