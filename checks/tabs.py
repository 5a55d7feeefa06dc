"""The thirteen tabulation jobs: orders as tabulations, customers as base rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import check, table
from ringroster.functions.dates import date_text, stamp_iso
from ringroster.operators.joins import with_person_name
from ringroster.operators.projections import with_label
from ringroster.period import Period
from ringroster.plans import tabulations
from ringroster.plans.tabulations import Tabulation, tabulation

PERIOD = Period(date(1996, 2, 1), date(1999, 2, 28))
# columns that a job only passes on
PASSED_ON = (
    "TipoDoDocumento", "Ticket", "Parceiro", "Sistema", "SituacaoRF", "StatusBase",
    "StatusTabulador", "TipoDePessoa", "Trabalhados", "Cnpj", "Porte", "CPF", "Observacao",
    "Fila", "ProcessID", "SubEmissor", "Resultado", "PepTitularRelacionado",
)
BASE_PASSED_ON = (
    "AgingContestacao", "StatusContestacao", "CodigoAutorizacao", "Idbase", "SubEmissor",
    "ClaimID", "ROLCase", "DaysToAct", "Organizations", "Chave",
)


def tabulation_sources(spark: SparkSession, folder: str, job: Tabulation) -> dict[str, DataFrame]:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    tab = orders.selectExpr(
        "o_orderkey AS Id",
        "o_custkey AS Fk",
        "o_orderdate AS DtCadastro",
        "cast(o_orderdate AS date) AS DataDaEntrada",
        "o_orderkey * 37 % 86400 AS HoraDaEntrada",
        "date_add(cast(o_orderdate AS date), 1) AS DataSolicitacao",
        "date_add(cast(o_orderdate AS date), 2) AS DataInicio",
        "date_add(cast(o_orderdate AS date), 3) AS DataUltimoDiaCorrecao",
        "cast(o_orderdate AS date) AS DataCaso",
        "o_orderkey % 86400 AS HoraCaso",
        "date_add(cast(o_orderdate AS date), 4) AS DataAnalise",
        "o_orderkey * 3 % 86400 AS HoraAnalise",
        "concat(' ', lower(o_orderstatus), ' ') AS Status",
        "concat(lower(o_orderpriority), ' ') AS MotivoDoStatus",
        "concat(' em ', o_custkey % 7) AS IdEmissor",
        "concat('cat ', o_orderkey % 3) AS Categoria",
        r"concat('\t', chr(160), 'Empresa\r\n ', o_custkey, chr(160)) AS NomeEmpressa",
        r"concat(' Empresa\n', o_custkey, ' ') AS Empressa",
        r"concat(chr(160), 'Nome\t', o_custkey) AS Nome",
        r"concat('Cargo\n', o_custkey % 5) AS Cargo",
        *[f"concat('{c} ', o_orderkey % 10) AS {c}" for c in PASSED_ON],
        "CASE WHEN o_custkey % 13 <> 0 THEN o_custkey % 120 END AS FkUsuarioOperador",
    )
    base = customer.selectExpr(
        "c_custkey AS Id",
        "date_add(DATE'1996-01-01', cast(c_custkey % 1500 AS int)) AS DtCadastro",
        "date_add(DATE'1996-02-01', cast(c_custkey % 1500 AS int)) AS DataAlteracao",
        "date_add(DATE'1996-03-01', cast(c_custkey % 1500 AS int)) AS DataSolicitacao",
        "date_add(DATE'1996-04-01', cast(c_custkey % 1500 AS int)) AS Datalimite",
        """CASE c_custkey % 3 WHEN 0 THEN '31/12/2025' WHEN 1 THEN '05/02/2024 10:11:12'
           ELSE 'x' END AS OriginalTransactionDate""",
        "concat(c_mktsegment, ' ') AS Status",
        "lower(c_mktsegment) AS SituacaoAtendimento",
        "c_nationkey + 1 AS FkTipoEmissor",
        *[f"concat('{c} ', c_custkey % 10) AS {c}" for c in BASE_PASSED_ON],
    )
    sources = {
        job.table: tab.withColumnRenamed("Fk", job.base_fk or "Fk"),
        tabulations.USERS: table(spark, folder, "supplier").selectExpr(
            "s_suppkey AS Id", "CASE WHEN s_suppkey % 9 <> 0 THEN s_nationkey END AS FkPessoa"
        ),
        # ids of one region that nobody refers to
        tabulations.PEOPLE: table(spark, folder, "nation").selectExpr(
            "CASE WHEN n_regionkey <> 4 THEN n_nationkey ELSE -1 - n_nationkey END AS Id",
            "concat(' ', lower(n_name), ' ') AS Nome",
        ),
    }
    if job.base is not None:
        sources[job.base] = base
    if job.issuer is not None:
        sources[job.issuer] = table(spark, folder, "nation").selectExpr(
            "n_nationkey AS Id", "n_name AS DsEmissor"
        )
    return sources


def _built(spark: SparkSession, folder: str, job: Tabulation) -> DataFrame:
    """The job's rows with dates and timestamps as text, for comparison."""
    rows = tabulation(job, tabulation_sources(spark, folder, job), PERIOD)
    shown = {
        f.name: date_text(f.name, "yyyy-MM-dd")
        if f.dataType.typeName() == "date"
        else stamp_iso(f.name)
        for f in rows.schema
        if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
    }
    return rows.withColumns(shown)


_PEOPLE = """
    LEFT JOIN (SELECT s_suppkey AS uid, CASE WHEN s_suppkey % 9 <> 0 THEN s_nationkey END AS pid
               FROM supplier) u
           ON uid = CASE WHEN o_custkey % 13 <> 0 THEN o_custkey % 120 END
    LEFT JOIN (SELECT CASE WHEN n_regionkey <> 4 THEN n_nationkey ELSE -1 - n_nationkey END AS nid,
                      upper(n_name) AS nome FROM nation) p
           ON pid = nid
"""
_TABS = f"FROM orders {_PEOPLE}"
_DAYS = "BETWEEN DATE '1996-02-01' AND DATE '1999-02-28'"
_IN_DAYS = f"WHERE CAST(o_orderdate AS DATE) {_DAYS}"
_BASE = f"""
    FROM (SELECT *, DATE '1996-01-01' + CAST(c_custkey % 1500 AS INT) AS bday FROM customer) b
    LEFT JOIN orders ON c_custkey = o_custkey
    LEFT JOIN (SELECT n_nationkey AS eid, n_name AS emissor FROM nation) ON eid = c_nationkey + 1
    {_PEOPLE}
"""
_BASE_DAYS = f"WHERE bday {_DAYS}"
_STATUS = "upper(o_orderstatus) AS {0}Status, upper(o_orderpriority) AS {0}MotivoDoStatus"
_RAISED = "upper(' ' || o_orderstatus || ' ') AS Status, upper(o_orderpriority) || ' ' AS MotivoDoStatus"
_STAMP = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"


def _p(*names: str, key: str = "o_orderkey") -> str:
    return ", ".join(
        f"CASE WHEN {key} IS NOT NULL THEN '{n} ' || ({key} % 10) END AS {n}" for n in names
    )


def _later(days: int, name: str) -> str:
    return f"strftime(o_orderdate + INTERVAL {days} DAY, '%Y-%m-%d') AS {name}"


def _based(day: str, name: str) -> str:
    return f"strftime(DATE '{day}' + CAST(c_custkey % 1500 AS INT), '%Y-%m-%d') AS {name}"


@check(
    "n2_fraud",
    f"""
    SELECT 'N2: Falcon' AS Tabulador, o_orderkey AS Id, {_STAMP} AS Tabulacao_DtCadastro,
           strftime(o_orderdate + to_seconds(o_orderkey * 37 % 86400), '%Y-%m-%d %H:%M:%S')
               AS DataHoraEntrada, {_STATUS.format("")}, nome AS Nome
    {_TABS} {_IN_DAYS}
    """,
)
def n2_fraud(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.N2_FRAUD)


@check(
    "n2_tickets",
    f"""
    SELECT 'N2: Jira' AS Tabulador, o_orderkey AS Id, {_STAMP} AS DtCadastro,
           'EM ' || (o_custkey % 7) AS Emissor, {_p("TipoDoDocumento", "Ticket")}, {_RAISED},
           nome AS Nome
    {_TABS} {_IN_DAYS}
    """,
)
def n2_tickets(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.N2_TICKETS)


@check(
    "n2_prevention",
    f"""
    SELECT 'N2: JiraPrevencao' AS Tabulador, o_orderkey AS Id, {_STAMP} AS DtCadastro,
           {_later(1, "DataSolicitacao")}, {_RAISED}, nome AS Nome
    {_TABS} {_IN_DAYS}
    """,
)
def n2_prevention(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.N2_PREVENTION)


@check(
    "n3_issuers",
    f"""
    SELECT 'Emissores' AS Tabulador, c_custkey AS Id, {_STAMP} AS Tabulacao_DtCadastro,
           {_based("1996-01-01", "DtCadastro")}, {_based("1996-02-01", "DataAlteracao")},
           {_p("AgingContestacao", "StatusContestacao", "CodigoAutorizacao", key="c_custkey")},
           emissor AS DsEmissor, {_STATUS.format("")}, nome AS Nome
    {_BASE} {_BASE_DAYS}
    """,
)
def n3_issuers(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.N3_ISSUERS)


@check(
    "n3_tickets",
    f"""
    SELECT 'Jira' AS Tabulador, c_custkey AS Id, 'Idbase ' || (c_custkey % 10) AS Cod_base,
           {_STAMP} AS Tabulacao_DtCadastro, {_based("1996-01-01", "DtCadastro")},
           {_based("1996-03-01", "DataSolicitacao")}, {_p("SubEmissor", key="c_custkey")},
           emissor AS DsEmissor, {_STATUS.format("")}, nome AS Nome
    {_BASE} {_BASE_DAYS}
    """,
)
def n3_tickets(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.N3_TICKETS)


@check(
    "n3_network_a",
    f"""
    SELECT 'Master' AS Tabulador, c_custkey AS Id, {_p("ClaimID", key="c_custkey")},
           {_STAMP} AS Tabulacao_DtCadastro, {_based("1996-01-01", "DtCadastro")},
           CASE c_custkey % 3 WHEN 0 THEN '2025-12-31 00:00:00' WHEN 1 THEN '2024-02-05 10:11:12' END
               AS OriginalTransactionDate,
           emissor AS DsEmissor, {_STATUS.format("")}, nome AS Nome
    {_BASE} {_BASE_DAYS}
    """,
)
def n3_network_a(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.N3_NETWORK_A)


@check(
    "n3_network_b",
    f"""
    SELECT 'Visa' AS Tabulador, c_custkey AS Id, {_based("1996-01-01", "DtCadastro")},
           {_STAMP} AS Tabulacao_DtCadastro, {_p("ROLCase", "DaysToAct", key="c_custkey")},
           emissor AS DsEmissor, {_STATUS.format("")}, nome AS Nome
    {_BASE} {_BASE_DAYS}
    """,
)
def n3_network_b(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.N3_NETWORK_B)


_BPP = ("Parceiro", "Sistema", "SituacaoRF", "StatusBase", "StatusTabulador", "TipoDePessoa")


@check(
    "onboarding_bpp",
    f"""
    SELECT 'OnboardingBPP' AS Tabulador, {_STAMP} AS Tabulacao_DtCadastro,
           {_p(*_BPP, "Trabalhados")}, 'Cnpj ' || (o_orderkey % 10) AS CNPJ,
           'EMPRESA ' || o_custkey AS NomeEmpresa, nome AS Analista
    {_TABS}
    """,
)
def onboarding_bpp(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.ONBOARDING_BPP)


@check(
    "onboarding_tickets",
    f"""
    SELECT 'OnboardingJira' AS Tabulador, o_orderkey AS Tabulacao_Id,
           {_STAMP} AS Tabulacao_DtCadastro, {_STATUS.format("Tabulacao_")}, nome AS Analista,
           CASE WHEN o_orderkey IS NOT NULL THEN 'Observacao ' || (o_orderkey % 10) END
               AS Tabulacao_Observacao, {_later(1, "DataSolicitacao")},
           CASE WHEN o_orderkey IS NOT NULL THEN 'CAT ' || (o_orderkey % 3) END
               AS Tabulacao_Categoria, {_based("1996-01-01", "Base_DtCadastro")},
           {_based("1996-04-01", "Base_DtLimite")},
           'Organizations ' || (c_custkey % 10) AS Base_Organizations,
           'Chave ' || (c_custkey % 10) AS Base_Chave, c_mktsegment AS Base_Status,
           c_mktsegment AS Base_SituacaoAtendimento
    {_BASE}
    """,
)
def onboarding_tickets(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.ONBOARDING_TICKETS)


@check(
    "onboarding_pf",
    f"""
    SELECT 'OnboardingPF' AS Tabulador, {_STAMP} AS Tabulacao_DtCadastro,
           {_later(0, "Tabulacao_DtDaEntrada")}, o_orderkey * 37 % 86400 AS HoraDaEntrada,
           ' em ' || (o_custkey % 7) AS Emissor, {_STATUS.format("Tabulacao_")},
           'CAT ' || (o_orderkey % 3) AS Categoria, {_p("CPF")}, nome AS Analista
    {_TABS}
    """,
)
def onboarding_pf(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.ONBOARDING_PF)


@check(
    "onboarding_pj",
    f"""
    SELECT 'OnboardingPJ' AS Tabulador, {_STAMP} AS Tabulacao_DtCadastro,
           {_later(0, "DataDaEntrada")}, {_later(2, "DataInicio")},
           ' em ' || (o_custkey % 7) AS Emissor, 'Cnpj ' || (o_orderkey % 10) AS CNPJ,
           'EMPRESA' || chr(10) || o_custkey AS Empressa, {_p("Porte")},
           {_STATUS.format("Tabulacao_")}, nome AS Analista
    {_TABS} WHERE nome IS NOT NULL
    """,
)
def onboarding_pj(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.ONBOARDING_PJ)


@check(
    "onboarding_pj_manual",
    f"""
    SELECT 'OnboardingPJ_Manual' AS Tabulador, {_STAMP} AS Tabulacao_DtCadastro,
           {_later(0, "Tabulacao_DtDaEntrada")}, {_later(2, "Tabulacao_DataInicio")},
           'Cnpj ' || (o_orderkey % 10) AS CNPJ, {_STATUS.format("Tabulacao_")},
           ' em ' || (o_custkey % 7) AS Emissor, {_p("Fila")}, 'EMPRESA' || o_custkey AS NomeEmpresa,
           {_p("Porte")}, {_later(3, "DataUltimoDiaCorrecao")}, nome AS Analista
    {_TABS}
    """,
)
def onboarding_pj_manual(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.ONBOARDING_PJ_MANUAL)


@check(
    "onboarding_pld",
    f"""
    SELECT 'OnboardingPLD' AS Tabulador, {_STAMP} AS Tabulacao_DtCadastro,
           {_later(0, "DataCaso")}, o_orderkey % 86400 AS HoraCaso, {_later(4, "DataAnalise")},
           o_orderkey * 3 % 86400 AS HoraAnalise, {_p("ProcessID")},
           'NOME' || o_custkey AS NomeCliente, {_p("CPF")}, 'CARGO' || (o_custkey % 5) AS Cargo,
           'SubEmissor ' || (o_orderkey % 10) AS Emissor,
           {_p("Resultado", "PepTitularRelacionado")}, nome AS Analista
    {_TABS}
    """,
)
def onboarding_pld(spark: SparkSession, folder: str) -> DataFrame:
    return _built(spark, folder, tabulations.ONBOARDING_PLD)


@check(
    "person_lookup",
    """
    SELECT 'Pedidos' AS origem, o_orderkey, upper(trim(n_name)) AS person
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def person_lookup(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Id"), F.col("c_nationkey").alias("FkPessoa")
    )
    people = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Nome")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    named = with_person_name(orders, users, people, "o_custkey", "person").drop("o_custkey")
    return with_label(named, "Pedidos", "origem")
