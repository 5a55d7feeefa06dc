"""Rosters, register, logins, punches, quality and the headcount reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import check, table
from ringroster.functions.dates import date_text, stamp_iso
from ringroster.operators.joins import join_roster
from ringroster.operators.projections import upper_columns
from ringroster.period import Period
from ringroster.plans import headcount, quality, workforce

AS_OF = date(2001, 9, 1)
YEARS = [2000, 2001]
OPERATIONS = ["BUILDING", "MACHINERY", "HOUSEHOLD", "FURNITURE"]
MASTER_DATES = (*workforce.STAFF_DATES, "DT_ATUAL")


def roster_days(spark: SparkSession, folder: str) -> DataFrame:
    """A roster line per order: person and shift from the customer, day from the year."""
    return table(spark, folder, "orders").selectExpr(
        "cast(o_custkey AS double) AS cd_matricula",
        "concat('  cust ', o_custkey, ' ') AS tx_nome",
        "o_custkey * 1800 % 86400 AS tm_entrada",
        "(o_custkey * 1800 + 30000) % 86400 AS tm_saida",
        "22800 + o_custkey % 5 * 1800 AS tm_carga_horaria",
        """CASE o_orderpriority WHEN '5-LOW' THEN 'SUPERVISOR' WHEN '2-HIGH' THEN 'APRENDIZ'
           WHEN '1-URGENT' THEN NULL ELSE ' Atendente ' END AS tx_cargo""",
        "concat('staff ', o_custkey % 4) AS tx_staff",
        "'6x1' AS tx_escala",
        """CASE o_custkey % 50 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN 20270
           ELSE o_custkey END AS cd_cpf""",
        "'seg-sab' AS tx_escala_semanal",
        "concat('sup ', o_custkey % 17) AS tx_supervisor",
        "'agente' AS tx_funcao",
        "concat('q', o_custkey % 4) AS quartil",
        "cast(trunc(o_orderdate, 'year') AS date) AS dt_quadro_dia",
    )


def register_source(spark: SparkSession, folder: str) -> DataFrame:
    """A register entry per customer: hired with the first order, left with the last."""
    orders = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("hired"),
        F.to_date(F.max("o_orderdate")).alias("last"),
    )
    customer = table(spark, folder, "customer")
    people = customer.join(orders, customer.c_custkey == orders.o_custkey, "left")
    people = people.withColumn(
        "left_on",
        F.expr("""CASE WHEN c_custkey % 7 = 0 THEN date_add(hired, cast(c_custkey % 180 AS int))
                  WHEN last < DATE'2001-03-01' AND c_custkey % 5 <> 0 THEN last END"""),
    )
    return people.selectExpr(
        "c_custkey AS CD_FUNCIONARIO",
        "c_name AS NO_FUNCIONARIO",
        "date_add(DATE'1950-01-01', cast(c_custkey * 97 % 20000 AS int)) AS DT_NASCIMENTO",
        "concat('site ', c_nationkey) AS DS_LOCAL",
        "c_mktsegment AS DS_OPERACAO",
        """CASE c_custkey % 10 WHEN 3 THEN 'SUPERV JUNIOR' WHEN 4 THEN NULL
           ELSE 'ATENDENTE' END AS DS_FUNCAO""",
        """CASE WHEN left_on IS NOT NULL THEN CASE c_custkey % 3
                WHEN 0 THEN 'demissão sem justa causa' WHEN 1 THEN 'Pedido de Demissão'
                ELSE 'Transferido' END
           ELSE CASE c_custkey % 4 WHEN 0 THEN 'Trabalhando' WHEN 1 THEN 'Férias'
                WHEN 2 THEN NULL ELSE 'Atestado Médico Integral' END END AS DS_SITUACAO""",
        "hired AS DT_ADMISSAO",
        "CASE WHEN c_custkey % 8 <> 0 THEN date_add(hired, 45) END AS DT_EXPERIENCIA_FIM",
        "CASE WHEN c_custkey % 3 = 0 THEN date_add(hired, 90) END AS DT_EXPERIENCIA_PRORROGACAO",
        "left_on AS DT_DESLIGAMENTO",
        "concat('obs ', c_custkey % 6) AS OB_DESLIGAMENTO",
        "cast(NULL AS string) AS OB_DESLIGAMENTO2",
        """CASE WHEN left_on IS NULL THEN NULL WHEN c_custkey % 2 = 0 THEN 'EMPRESA'
           ELSE 'COLABORADOR' END AS ORIGEM_DESLIGAMENTO""",
        "'motivo' AS DS_MOTIVO_DESLIGAMENTO",
        """CASE WHEN c_custkey % 11 <> 0 THEN concat('razão ', c_nationkey) END
           AS DS_RAZAO_DESLIGAMENTO""",
        "TIMESTAMP_NTZ'2001-09-01 06:00:00' AS cached_at",
    )


def master(spark: SparkSession, folder: str) -> DataFrame:
    roster = workforce.operational_roster(roster_days(spark, folder))
    register = workforce.hr_register(register_source(spark, folder), OPERATIONS)
    return workforce.staff_master(roster, register, AS_OF)


def base(spark: SparkSession, folder: str) -> DataFrame:
    return headcount.headcount_base(master(spark, folder), AS_OF)


_ROSTER = """
    WITH roster_days AS (
        SELECT o_custkey AS cd_matricula, upper(trim('  cust ' || o_custkey || ' ')) AS tx_nome,
               o_custkey * 1800 % 86400 AS tm_entrada,
               (o_custkey * 1800 + 30000) % 86400 AS tm_saida,
               22800 + o_custkey % 5 * 1800 AS tm_carga_horaria,
               CASE o_orderpriority WHEN '5-LOW' THEN 'SUPERVISOR' WHEN '2-HIGH' THEN 'APRENDIZ'
                    WHEN '1-URGENT' THEN NULL ELSE ' Atendente ' END AS cargo,
               upper('staff ' || (o_custkey % 4)) AS tx_staff, '6X1' AS tx_escala,
               CASE o_custkey % 50 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN 20270
                    ELSE o_custkey END AS cd_cpf,
               'SEG-SAB' AS tx_escala_semanal, upper('sup ' || (o_custkey % 17)) AS tx_supervisor,
               'AGENTE' AS tx_funcao, upper('q' || (o_custkey % 4)) AS quartil,
               CAST(date_trunc('year', o_orderdate) AS DATE) AS dia
        FROM orders
    ), roster AS (
        SELECT DISTINCT cd_matricula, tx_nome, tm_entrada, tm_saida, tm_carga_horaria,
               upper(trim(cargo)) AS tx_cargo, tx_staff, tx_escala, cd_cpf, tx_escala_semanal,
               tx_supervisor, tx_funcao, quartil, strftime(dia, '%Y-%m-%d') AS dt_quadro_dia
        FROM roster_days
        WHERE cd_cpf <> 0 AND cd_cpf IS NOT NULL AND cd_cpf NOT IN (20270, 20453)
          AND dia = (SELECT max(dia) FROM roster_days)
          AND cargo NOT IN ('SUPERVISOR', 'APRENDIZ', 'COORDENADOR')
    )
"""
_REGISTER = (
    _ROSTER
    + """
    , people AS (
        SELECT c.*, hired, CASE WHEN c_custkey % 7 = 0 THEN hired + CAST(c_custkey % 180 AS INT)
               WHEN last < DATE '2001-03-01' AND c_custkey % 5 <> 0 THEN last END AS left_on
        FROM customer c LEFT JOIN (
            SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS hired,
                   CAST(max(o_orderdate) AS DATE) AS last
            FROM orders GROUP BY o_custkey
        ) ON o_custkey = c_custkey
    ), register AS (
        SELECT c_custkey AS CD_FUNCIONARIO, c_name AS NO_FUNCIONARIO,
               DATE '1950-01-01' + CAST(c_custkey * 97 % 20000 AS INT) AS nasc,
               'site ' || c_nationkey AS DS_LOCAL, c_mktsegment AS DS_OPERACAO,
               CASE c_custkey % 10 WHEN 3 THEN 'SUPERV JUNIOR' WHEN 4 THEN NULL
                    ELSE 'ATENDENTE' END AS DS_FUNCAO,
               upper(CASE WHEN left_on IS NOT NULL THEN CASE c_custkey % 3
                    WHEN 0 THEN 'demissão sem justa causa' WHEN 1 THEN 'Pedido de Demissão'
                    ELSE 'Transferido' END
               ELSE CASE c_custkey % 4 WHEN 0 THEN 'Trabalhando' WHEN 1 THEN 'Férias'
                    WHEN 2 THEN NULL ELSE 'Atestado Médico Integral' END END) AS DS_SITUACAO,
               hired, CASE WHEN c_custkey % 8 <> 0 THEN hired + 45 END AS fim,
               CASE WHEN c_custkey % 3 = 0 THEN hired + 90 END AS prorrogacao, left_on,
               upper('obs ' || (c_custkey % 6)) AS OB_DESLIGAMENTO,
               CAST(NULL AS VARCHAR) AS OB_DESLIGAMENTO2,
               CASE WHEN left_on IS NULL THEN NULL WHEN c_custkey % 2 = 0 THEN 'EMPRESA'
                    ELSE 'COLABORADOR' END AS ORIGEM_DESLIGAMENTO,
               'MOTIVO' AS DS_MOTIVO_DESLIGAMENTO,
               CASE WHEN c_custkey % 11 <> 0 THEN 'razão ' || c_nationkey END
                   AS DS_RAZAO_DESLIGAMENTO,
               '2001-09-01 06:00:00' AS DT_ATUALIZACAO_DIRECTIVE
        FROM people
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE')
          AND c_custkey % 10 NOT IN (3, 4)
    )
"""
)
_STAFF = (
    _REGISTER
    + """
    , joined AS (
        SELECT *, DATE '2001-09-01' AS hoje, coalesce(prorrogacao, fim) AS ref,
               coalesce(left_on, DATE '2001-09-01') AS ate
        FROM roster JOIN register ON cd_matricula = CD_FUNCIONARIO
    ), months AS (
        SELECT *, (year(ate) - year(hired)) * 12 + month(ate) - month(hired) AS m FROM joined
    ), staff AS (
        SELECT *, CASE WHEN CAST(hired + to_months(CAST(m AS INT)) AS DATE) > ate THEN m - 1 ELSE m END
               AS tenure,
               year(hoje) - year(nasc) - CASE WHEN month(hoje) < month(nasc)
                   OR (month(hoje) = month(nasc) AND day(hoje) < day(nasc)) THEN 1 ELSE 0 END AS age,
               CAST(ate - hired AS BIGINT) AS days
        FROM months
    )
"""
)


def _hours(secs: str, fmt: str) -> str:
    return (
        f"CASE WHEN {secs} // 60 % 60 = 0 THEN printf('{fmt}', {secs} // 3600)"
        f" ELSE printf('{fmt}:%02d', {secs} // 3600, {secs} // 60 % 60) END"
    )


def _day(c: str) -> str:
    return f"strftime({c}, '%d/%m/%Y')"


@check("operational_roster", _ROSTER + "SELECT * FROM roster")
def operational_roster(spark: SparkSession, folder: str) -> DataFrame:
    staff = workforce.operational_roster(roster_days(spark, folder))
    return staff.withColumns(
        {
            "cd_matricula": F.col("cd_matricula").cast("bigint"),
            "dt_quadro_dia": date_text("dt_quadro_dia", "yyyy-MM-dd"),
        }
    )


@check(
    "register_filter",
    _REGISTER
    + """
    SELECT CD_FUNCIONARIO, NO_FUNCIONARIO, DS_OPERACAO, DS_FUNCAO, DS_SITUACAO, OB_DESLIGAMENTO,
           ORIGEM_DESLIGAMENTO, DS_RAZAO_DESLIGAMENTO, DT_ATUALIZACAO_DIRECTIVE FROM register
    """,
)
def register_filter(spark: SparkSession, folder: str) -> DataFrame:
    staff = workforce.hr_register(register_source(spark, folder), OPERATIONS)
    return staff.select(
        "CD_FUNCIONARIO",
        "NO_FUNCIONARIO",
        "DS_OPERACAO",
        "DS_FUNCAO",
        "DS_SITUACAO",
        "OB_DESLIGAMENTO",
        "ORIGEM_DESLIGAMENTO",
        "DS_RAZAO_DESLIGAMENTO",
        stamp_iso("DT_ATUALIZACAO_DIRECTIVE").alias("DT_ATUALIZACAO_DIRECTIVE"),
    )


@check(
    "roster_join",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(s_suppkey AS VARCHAR) AS s_suppkey,
           c_name, s_name
    FROM customer JOIN supplier ON CAST(c_custkey AS VARCHAR) = CAST(s_suppkey AS VARCHAR)
    """,
)
def roster_join(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("double").alias("c_custkey"), "c_name"
    )
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return join_roster(customer, supplier, "c_custkey", "s_suppkey")


@check(
    "staff_master",
    _STAFF
    + f"""
    SELECT CAST(cd_matricula AS VARCHAR) AS cd_matricula, tx_nome, tx_cargo, tx_staff,
           tx_escala_semanal, tx_supervisor, tx_funcao, quartil, dt_quadro_dia,
           printf('%02d:%02d:00', tm_entrada // 3600, tm_entrada // 60 % 60) AS tm_entrada,
           printf('%02d:%02d:00', tm_saida // 3600, tm_saida // 60 % 60) AS tm_saida,
           {_hours("tm_carga_horaria", "%dH")} AS tm_carga_horaria,
           CAST(CD_FUNCIONARIO AS VARCHAR) AS CD_FUNCIONARIO, NO_FUNCIONARIO, DS_LOCAL,
           DS_OPERACAO, DS_FUNCAO, DS_SITUACAO, OB_DESLIGAMENTO, OB_DESLIGAMENTO2,
           ORIGEM_DESLIGAMENTO, DS_MOTIVO_DESLIGAMENTO, DS_RAZAO_DESLIGAMENTO,
           DT_ATUALIZACAO_DIRECTIVE, {_day("nasc")} AS DT_NASCIMENTO,
           {_day("hired")} AS DT_ADMISSAO, {_day("fim")} AS DT_EXPERIENCIA_FIM,
           {_day("prorrogacao")} AS DT_EXPERIENCIA_PRORROGACAO,
           {_day("left_on")} AS DT_DESLIGAMENTO, {_day("hoje")} AS DT_ATUAL, CAST(age AS INTEGER) AS IDADE,
           CASE WHEN age >= 0 AND age < 18 THEN 'Menor de 18' WHEN age >= 18 AND age < 25 THEN '18 - 25'
                WHEN age >= 25 AND age < 35 THEN '25 - 35' WHEN age >= 35 AND age < 45 THEN '35 - 45'
                WHEN age >= 45 AND age < 150 THEN '45+' END AS FAIXA_ETARIA,
           CASE WHEN left_on IS NOT NULL THEN CASE WHEN left_on <= ref
                    THEN 'Desligado no período de experiência'
                    ELSE 'Desligado após período de experiência' END
                WHEN hoje > ref THEN 'Efetivado' ELSE 'Em Experiência' END AS SUB_SITUACAO,
           CAST(left_on - hired AS INTEGER) AS DIAS_CASA_ATE_DESLIGAMENTO,
           coalesce(left_on - hired <= 90, false) AS "MORTALIDADE_<_90_DIAS",
           tenure // 12 || ' anos ' || tenure % 12 || ' meses' AS TEMPO_EMPRESA,
           strftime(hired, '%b') AS MES_ADMISSAO, CAST(year(hired) AS INTEGER) AS ANO_ADMISSAO,
           strftime(left_on, '%b') AS MES_DESLIGAMENTO, CAST(year(left_on) AS INTEGER) AS ANO_DESLIGAMENTO,
           {_hours("tm_entrada", "%02dH")} || ' - ' || {_hours("tm_saida", "%02dH")} AS "Jornada"
    FROM staff
    """,
)
def staff_master(spark: SparkSession, folder: str) -> DataFrame:
    view = workforce.staff_master_view(master(spark, folder))
    return view.withColumns(
        {
            "dt_quadro_dia": date_text("dt_quadro_dia", "yyyy-MM-dd"),
            "DT_ATUALIZACAO_DIRECTIVE": stamp_iso("DT_ATUALIZACAO_DIRECTIVE"),
        }
    )


def _kpis_sql(years: str, prefix: str = "") -> str:
    inside = f"(coalesce(year(hired) IN ({years}), false) OR coalesce(year(left_on) IN ({years}), false))"
    left = f"({inside} AND DS_SITUACAO LIKE '%DEMISSÃO%')"
    active = f"{inside} AND DS_SITUACAO IN ('TRABALHANDO', 'FÉRIAS', 'ATESTADO MÉDICO INTEGRAL')"
    n, out = f"count(*) FILTER ({inside})", f"count(*) FILTER ({left})"
    early = f"count(*) FILTER ({left} AND days <= 90)"
    return f"""
        {n} AS {prefix}volume, count(*) FILTER ({active}) AS {prefix}active, {out} AS {prefix}exits,
        round(CASE WHEN {n} > 0 THEN {out} / {n} * 100 ELSE 0 END, 6) AS {prefix}turnover_pct,
        round(CASE WHEN {out} > 0 THEN {early} / {out} * 100 ELSE 0 END, 6) AS {prefix}early_attrition_pct,
        round(CASE WHEN {n} > 0 THEN avg(days / 30.44) FILTER ({inside}) ELSE 0 END, 6)
            AS {prefix}mean_months
    """


@check("headcount_kpis", _STAFF + f"SELECT {_kpis_sql('2000, 2001')} FROM staff")
def headcount_kpis(spark: SparkSession, folder: str) -> DataFrame:
    kpis = headcount.headcount_kpis(base(spark, folder), YEARS)
    return kpis.withColumns(
        {c: F.round(c, 6) for c in ("turnover_pct", "early_attrition_pct", "mean_months")}
    )


SELECTIONS = {
    "two years": headcount.Selection([2000, 2001]),
    "one year": headcount.Selection([1999]),
    "company": headcount.Selection([2000, 2001], "EMPRESA"),
    "never": headcount.Selection([1900]),
}


@check(
    "kpi_selections",
    _STAFF
    + " UNION ALL ".join(
        f"SELECT '{name}' AS selection, {_kpis_sql(', '.join(map(str, chosen.years)))} FROM staff"
        + (f" WHERE ORIGEM_DESLIGAMENTO = '{chosen.origin}'" if chosen.origin else "")
        for name, chosen in SELECTIONS.items()
    ),
)
def kpi_selections(spark: SparkSession, folder: str) -> DataFrame:
    kpis = headcount.kpi_selections(headcount.cohort_cube(base(spark, folder)), SELECTIONS)
    return kpis.withColumns(
        {c: F.round(c, 6) for c in ("turnover_pct", "early_attrition_pct", "mean_months")}
    )


_COMPARED = (
    _STAFF
    + f"""
    , k AS (
        SELECT {_kpis_sql("2000, 2001", "now_")}, {_kpis_sql("1998, 1999", "before_")} FROM staff
    ), c AS (
        SELECT * FROM (
            SELECT 1 AS position, 'volume' AS kpi, 'Volume Colaboradores' AS label,
                   CAST(now_volume AS DOUBLE) AS value, CAST(before_volume AS DOUBLE) AS previous,
                   false AS bad FROM k
            UNION ALL SELECT 2, 'active', 'Efetivo Ativo', now_active, before_active, false FROM k
            UNION ALL SELECT 3, 'exits', 'Saídas Totais', now_exits, before_exits, true FROM k
            UNION ALL SELECT 4, 'turnover_pct', '% Índice Turnover', now_turnover_pct,
                   before_turnover_pct, true FROM k
            UNION ALL SELECT 5, 'early_attrition_pct', '% Evasão Exp.', now_early_attrition_pct,
                   before_early_attrition_pct, true FROM k
            UNION ALL SELECT 6, 'mean_months', 'Média Tempo Casa', now_mean_months,
                   before_mean_months, false FROM k
        )
    ), d AS (
        SELECT *, value - previous AS diff, (value > previous AND bad) OR (value < previous AND NOT bad)
               AS worse FROM c
    )
"""
)


@check(
    "kpi_compare",
    _COMPARED
    + "SELECT position, kpi, label, value, previous, round(diff, 5) AS diff, worse FROM d",
)
def kpi_compare(spark: SparkSession, folder: str) -> DataFrame:
    compared = headcount.kpi_compare(base(spark, folder), YEARS)
    return compared.withColumns(
        {"value": F.round("value", 6), "previous": F.round("previous", 6), "diff": F.round("diff", 5)}
    )


@check(
    "kpi_text",
    _COMPARED
    + """
    SELECT position, kpi, label,
           CASE WHEN kpi LIKE '%pct' THEN printf('%.1f%%', value) WHEN kpi = 'mean_months'
                THEN printf('%.1f meses', value) ELSE printf('%d', CAST(value AS BIGINT)) END
                AS value_text,
           CASE WHEN diff >= 0 THEN '+' ELSE '' END || CASE WHEN kpi LIKE '%pct'
                THEN printf('%.1f%%', diff) WHEN kpi = 'mean_months' THEN printf('%.1f', diff)
                ELSE printf('%d', CAST(diff AS BIGINT)) END AS diff_text,
           CASE WHEN diff < 0 THEN '↓' ELSE '↑' END AS arrow, worse
    FROM d
    """,
)
def kpi_text(spark: SparkSession, folder: str) -> DataFrame:
    return headcount.kpi_text(headcount.kpi_compare(base(spark, folder), YEARS))


@check(
    "inventory",
    _STAFF
    + "SELECT count(*) AS base_rows, count(*) FILTER (left_on IS NULL) AS current_staff FROM staff",
)
def inventory(spark: SparkSession, folder: str) -> DataFrame:
    return headcount.inventory(base(spark, folder))


_REASONS = (
    _STAFF
    + """
    , c AS (
        SELECT DS_RAZAO_DESLIGAMENTO AS "Motivo", count(*) AS "Qtd" FROM staff
        WHERE year(left_on) IN (2000, 2001) AND DS_RAZAO_DESLIGAMENTO IS NOT NULL {origin}
        GROUP BY 1
    ), p AS (
        SELECT *, sum("Qtd") OVER (ORDER BY "Qtd" DESC, "Motivo") / sum("Qtd") OVER () * 100 AS pct
        FROM c
    )
    SELECT "Motivo", "Qtd", round(pct, 6) AS "Acumulado_%" FROM p
"""
)


@check("pareto_reasons", _REASONS.format(origin="AND ORIGEM_DESLIGAMENTO = 'EMPRESA'"))
def pareto_reasons(spark: SparkSession, folder: str) -> DataFrame:
    reasons = headcount.leaving_reasons(base(spark, folder), YEARS, "EMPRESA")
    return reasons.withColumn("Acumulado_%", F.round("`Acumulado_%`", 6))


@check("main_reasons", _REASONS.format(origin="") + "WHERE pct <= 85")
def main_reasons(spark: SparkSession, folder: str) -> DataFrame:
    reasons = headcount.main_reasons(headcount.leaving_reasons(base(spark, folder), YEARS))
    return reasons.withColumn("Acumulado_%", F.round("`Acumulado_%`", 6))


@check(
    "detail_listing",
    _STAFF
    + f"""
    SELECT tx_supervisor AS "TX_SUPERVISOR", NO_FUNCIONARIO AS "NO_FUNCIONARIO",
           {_day("hired")} AS "DT_ADMISSAO", {_day("left_on")} AS "DT_DESLIGAMENTO",
           DS_OPERACAO AS "DS_OPERACAO", OB_DESLIGAMENTO AS "OB_DESLIGAMENTO",
           OB_DESLIGAMENTO2 AS "OB_DESLIGAMENTO2", ORIGEM_DESLIGAMENTO AS "ORIGEM_DESLIGAMENTO",
           DS_MOTIVO_DESLIGAMENTO AS "DS_MOTIVO_DESLIGAMENTO",
           DS_RAZAO_DESLIGAMENTO AS "DS_RAZAO_DESLIGAMENTO",
           CASE WHEN left_on IS NOT NULL THEN CASE WHEN left_on <= ref
                    THEN 'Desligado no período de experiência'
                    ELSE 'Desligado após período de experiência' END
                WHEN hoje > ref THEN 'Efetivado' ELSE 'Em Experiência' END AS "SUB_SITUACAO",
           CAST(left_on - hired AS INTEGER) AS "DIAS_CASA_ATE_DESLIGAMENTO"
    FROM staff
    """,
)
def detail_listing(spark: SparkSession, folder: str) -> DataFrame:
    detail = headcount.detail_listing(base(spark, folder))
    return detail.withColumns({c: date_text(c) for c in ("DT_ADMISSAO", "DT_DESLIGAMENTO")})


@check(
    "hires_leavers",
    _STAFF
    + """
    SELECT 'hired' AS cohort, CAST(year(hired) AS INTEGER) AS year, count(*) AS n FROM staff
    WHERE year(hired) IN (1995, 1996) GROUP BY 2
    UNION ALL
    SELECT 'left', CAST(year(left_on) AS INTEGER), count(*) FROM staff WHERE year(left_on) IN (2000, 2001) GROUP BY 2
    """,
)
def hires_leavers(spark: SparkSession, folder: str) -> DataFrame:
    people = base(spark, folder)
    hired = headcount.hires(people, [1995, 1996]).groupBy(
        F.lit("hired").alias("cohort"), F.col(headcount.HIRE_YEAR).alias("year")
    )
    left = headcount.leavers(people, YEARS).groupBy(
        F.lit("left").alias("cohort"), F.col(headcount.EXIT_YEAR).alias("year")
    )
    return hired.agg(F.count("*").alias("n")).unionByName(left.agg(F.count("*").alias("n")))


@check(
    "selector_values",
    _STAFF
    + """
    SELECT 'year' AS list, CAST(year(hired) AS VARCHAR) AS value FROM staff
    WHERE hired IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'origin', ORIGEM_DESLIGAMENTO FROM staff
    WHERE ORIGEM_DESLIGAMENTO IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'default', CAST(max(year(hired)) AS VARCHAR) FROM staff
    """,
)
def selector_values(spark: SparkSession, folder: str) -> DataFrame:
    people = base(spark, folder)

    def listed(name: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(name).alias("list"), F.col(df.columns[0]).cast("string").alias("value"))

    return (
        listed("year", headcount.available_years(people))
        .unionByName(listed("origin", headcount.available_origins(people)))
        .unionByName(listed("default", headcount.default_year(people)))
    )


@check(
    "staff_upper_names",
    """
    SELECT c_custkey AS "C_CUSTKEY", c_name AS "C_NAME", c_nationkey AS "C_NATIONKEY",
           c_acctbal AS "C_ACCTBAL", c_mktsegment AS "C_MKTSEGMENT" FROM customer
    """,
)
def staff_upper_names(spark: SparkSession, folder: str) -> DataFrame:
    return upper_columns(table(spark, folder, "customer"))


LOGIN_PERIOD = Period(date(2024, 1, 1), date(2024, 1, 17))


def login_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Events as login sessions, customers as the users."""
    logins = table(spark, folder, "events").selectExpr(
        "ts AS dthr_inicio_login",
        "ts + make_dt_interval(0, 0, 0, floor(value)) AS dthr_fim_login",
        "concat('r', event_id) AS cd_ramal",
        "concat('l', user_id) AS cd_login",
        "user_id AS tx_user",
        "floor(value) AS tp_duracao_login",
        "60 AS tp_duracao_pausas",
        "0 AS tp_estouro_pausas",
        "floor(value) - 60 AS tp_duracao_disponivel",
        "0 AS tp_duracao_outros",
        "event_type AS tx_fila",
        "concat(' ', event_type, ' ') AS tx_custo",
    )
    users = table(spark, folder, "customer").selectExpr(
        "c_custkey AS tx_user", "c_custkey AS cd_matricula", "concat(c_name, ' ') AS tx_usuario"
    )
    return {workforce.LOGINS: logins, workforce.LOGIN_USERS: users}


@check(
    "login_sessions",
    """
    SELECT strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS dthr_inicio_login,
           strftime(e.ts + to_seconds(floor(e.value)), '%Y-%m-%d %H:%M:%S') AS dthr_fim_login,
           'r' || e.event_id AS cd_ramal, 'l' || e.user_id AS cd_login,
           c.c_custkey AS cd_matricula, upper(c.c_name) AS tx_usuario,
           CAST(floor(e.value) AS BIGINT) AS tp_duracao_login, 60 AS tp_duracao_pausas,
           0 AS tp_estouro_pausas, CAST(floor(e.value) AS BIGINT) - 60 AS tp_duracao_disponivel,
           0 AS tp_duracao_outros, e.event_type AS tx_fila, upper(e.event_type) AS tx_custo
    FROM events e JOIN customer c ON e.user_id = c.c_custkey
    WHERE CAST(e.ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-17'
    """,
)
def login_sessions(spark: SparkSession, folder: str) -> DataFrame:
    sources = login_sources(spark, folder)
    sessions = workforce.newest_logins_first(
        workforce.logged_time(
            sources[workforce.LOGINS], sources[workforce.LOGIN_USERS], LOGIN_PERIOD
        )
    )
    return sessions.withColumns(
        {c: stamp_iso(c) for c in ("dthr_inicio_login", "dthr_fim_login")}
    )


def punch_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Punches from order lines, employees from customers, schedules from nations."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    dated = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return {
        workforce.PUNCHES: dated.selectExpr(
            "o_custkey AS numcra",
            "cast(o_orderdate AS date) AS datacc",
            "cast(l_partkey % 1440 AS int) AS horacc",
        ),
        workforce.EMPLOYEES: table(spark, folder, "customer").selectExpr(
            "c_custkey AS numcad",
            "concat(' ', c_name, ' ') AS nomfun",
            "date_add(DATE'1990-01-01', cast(c_custkey % 1000 AS int)) AS datadm",
            "CASE WHEN c_custkey % 3 = 0 THEN DATE'2001-05-31' END AS datafa",
            "c_nationkey AS codesc",
        ),
        workforce.SCHEDULES: table(spark, folder, "nation").selectExpr(
            "n_nationkey AS codesc", "n_name AS nomesc"
        ),
    }


_PUNCHES = (
    _ROSTER
    + """
    , punches AS (
        SELECT o_custkey AS cd_matricula, CAST(o_orderdate AS DATE) AS dia,
               CAST(l_partkey % 1440 AS INT) AS horacc, upper(c_name) AS nome,
               DATE '1990-01-01' + CAST(c_custkey % 1000 AS INT) AS adm,
               CASE WHEN c_custkey % 3 = 0 THEN DATE '2001-05-31' END AS afa, n_name AS tx_escala
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        WHERE o_orderdate >= DATE '1996-01-01'
          AND o_custkey IN (SELECT cd_matricula FROM roster)
    )
"""
)


def _raw_punches(spark: SparkSession, folder: str) -> DataFrame:
    roster = workforce.operational_roster(roster_days(spark, folder))
    sources = punch_sources(spark, folder)
    return workforce.punches_raw(sources, roster, date(1996, 1, 1))


@check(
    "punches_raw",
    _PUNCHES
    + """
    SELECT cd_matricula, strftime(dia, '%Y-%m-%d') AS dt_ponto, horacc, nome AS tx_funcionario,
           strftime(adm, '%Y-%m-%d') AS dt_admissao, strftime(afa, '%Y-%m-%d') AS dt_afastamento,
           tx_escala
    FROM punches
    """,
)
def punches_raw(spark: SparkSession, folder: str) -> DataFrame:
    days = ("dt_ponto", "dt_admissao", "dt_afastamento")
    return _raw_punches(spark, folder).withColumns(
        {c: date_text(c, "yyyy-MM-dd") for c in days}
    )


@check(
    "punches_wide",
    _PUNCHES
    + """
    , n AS (
        SELECT *, row_number() OVER (PARTITION BY cd_matricula, dia ORDER BY horacc) AS i,
               printf('%02d:%02d:00.0000000', horacc // 60, horacc % 60) AS hora
        FROM punches
    )
    SELECT cd_matricula, strftime(dia, '%Y-%m-%d') AS dt_ponto, lower(nome) AS tx_funcionario,
           tx_escala, """
    + ", ".join(f"max(hora) FILTER (i = {i}) AS \"HoraPonto{i}\"" for i in range(1, 9))
    + """, strftime(adm, '%Y-%m-%d') AS dt_admissao, strftime(afa, '%Y-%m-%d') AS dt_afastamento
    FROM n GROUP BY cd_matricula, dia, nome, tx_escala, adm, afa
    """,
)
def punches_wide(spark: SparkSession, folder: str) -> DataFrame:
    first = _raw_punches(spark, folder)
    return workforce.punches_wide(first)


QUALITY_PERIOD = Period(date(1996, 1, 1), date(1998, 6, 30))


def quality_source(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as form lines of evaluations."""
    return table(spark, folder, "lineitem").selectExpr(
        "' mon a ' AS MONITOR",
        "l_orderkey AS MONITORIA",
        "l_quantity AS MEDIA",
        "concat('op ', l_returnflag, ' ') AS OPERADOR",
        "l_shipdate + make_dt_interval(0, cast(l_partkey % 7 AS int), 0, 0) AS DIADALIGACAO",
        "l_shipdate + make_dt_interval(0, cast(l_partkey % 7 AS int), 0, 0) AS DATAMONITORIA",
        """CASE WHEN l_partkey % 6 <> 0
           THEN l_shipdate + make_dt_interval(cast(l_suppkey % 12 - 2 AS int), 0, 0, 0) END
           AS DATAFEEDBACK""",
        """CASE l_linenumber WHEN 1 THEN 'tema macro' WHEN 2 THEN 'Arquivo ' WHEN 3 THEN 'Emissor'
           WHEN 4 THEN NULL ELSE concat('MICRO TEMA - T', l_linenumber) END AS PERGUNTA""",
        "'C' AS CLASSIFICACAO",
        "'Q' AS QUESTIONARIO",
        "l_linestatus AS STATUS",
        "l_partkey AS RESPOSTA",
        "'OP' AS OPERACAO",
        "'G' AS PERGUNTAGRUPO",
    )


@check(
    "quality_evaluations",
    """
    WITH q AS (
        SELECT l_orderkey AS m, l_shipdate + to_seconds(l_partkey % 7 * 3600) AS dm, l_linenumber,
               CASE WHEN l_partkey % 6 <> 0 THEN l_shipdate + to_days(CAST(l_suppkey % 12 - 2 AS INT)) END AS fb,
               CASE l_linenumber WHEN 1 THEN 'tema macro' WHEN 2 THEN 'Arquivo ' WHEN 3 THEN 'Emissor'
                    WHEN 4 THEN NULL ELSE 'MICRO TEMA - T' || l_linenumber END AS pergunta,
               l_partkey AS resposta, l_quantity AS media, l_returnflag, l_linestatus
        FROM lineitem
    ), f AS (
        SELECT * FROM q WHERE pergunta NOT LIKE '%macro%'
          AND pergunta NOT IN ('Arquivo ', 'Código', 'Emissor')
          AND CAST(dm AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-06-30'
        QUALIFY row_number() OVER (PARTITION BY m ORDER BY dm, pergunta, resposta) = 1
    )
    SELECT 1 AS "RN", 'MON A' AS "MONITOR", m AS "MONITORIA", media AS "MEDIA",
           upper('op ' || l_returnflag) AS "OPERADOR",
           strftime(dm, '%Y-%m-%d %H:%M:%S') AS "DIADALIGACAO",
           strftime(dm, '%Y-%m-%d') AS "DIADALIGACAO_SHORTDATE",
           strftime(dm, '%Y-%m-%d %H:%M:%S') AS "DATAMONITORIA",
           CAST(dayofweek(dm) + 1 AS INTEGER) AS "DATAMONITORIA_DIA_SEMANA_NUM",
           strftime(dm, '%Y') AS "ANO_DATAMONITORIA", lower(strftime(dm, '%b')) AS "DATAMONITORIA_MES",
           CAST(month(dm) AS INTEGER) AS "DATAMONITORIA_NUM", strftime(dm, '%Y-%m-%d') AS "DATAMONITORIA_SHORTDATE",
           strftime(fb, '%Y-%m-%d %H:%M:%S') AS "DATAFEEDBACK",
           strftime(fb, '%Y-%m-%d') AS "DATAFEEDBACK_SHORTDATE",
           replace(pergunta, 'MICRO TEMA - ', '') AS "PERGUNTA", 'C' AS "CLASSIFICACAO",
           'Q' AS "QUESTIONARIO",
           CASE WHEN date_diff('day', CAST(dm AS DATE), CAST(fb AS DATE)) <= 5 THEN 1 ELSE 0 END AS "DentroSLA",
           l_linestatus AS "STATUS", resposta AS "RESPOSTA", 'OP' AS "OPERACAO", 'G' AS "PERGUNTAGRUPO"
    FROM f
    """,
)
def quality_evaluations(spark: SparkSession, folder: str) -> DataFrame:
    lines = quality.quality_evaluations(quality_source(spark, folder), QUALITY_PERIOD)
    return lines.withColumns(
        {
            **{c: stamp_iso(c) for c in ("DIADALIGACAO", "DATAMONITORIA", "DATAFEEDBACK")},
            **{
                f"{c}_SHORTDATE": date_text(f"{c}_SHORTDATE", "yyyy-MM-dd")
                for c in ("DIADALIGACAO", "DATAMONITORIA", "DATAFEEDBACK")
            },
        }
    )
