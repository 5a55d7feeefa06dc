"""Headcount reports on rows that test their rules."""

from datetime import date

import pytest
from conftest import rows

from ringroster.operators.filters import active_in_years
from ringroster.period import Period
from ringroster.plans import headcount as h
from ringroster.plans import workforce

AS_OF = date(2024, 6, 30)
SCHEMA = (
    "cd_matricula string, tx_supervisor string, no_funcionario string, ds_situacao string, "
    "dt_admissao string, dt_desligamento string, origem_desligamento string, "
    "ds_razao_desligamento string"
)
STAFF = [
    ("1", "s2", "a", "Trabalhando", "01/01/2024", None, None, None),
    ("2", "s1", "b", "demissão sem justa causa", "01/01/2024", "31/03/2024", "EMPRESA", "r1"),
    ("3", "s1", "c", "PEDIDO DE DEMISSÃO", "01/01/2020", "01/02/2024", "COLABORADOR", "r2"),
    ("4", None, "d", None, "15/05/2023", None, None, None),
    ("5", "s3", "e", "Férias", "31/12/2022", None, None, None),
    ("6", "s3", "f", "TRANSFERIDO", "01/01/2022", "01/06/2023", "EMPRESA", "r1"),
    ("7", "s4", "g", "Trabalhando", "99/99/2024", None, None, None),
]


@pytest.fixture(scope="module")
def people(spark):
    return h.headcount_base(spark.createDataFrame(STAFF, SCHEMA), AS_OF).cache()


def test_base(people):
    got = {r.CD_MATRICULA: r for r in people.collect()}
    assert got["2"].DIAS_CASA == 90 and got["2"].DT_DESLIGAMENTO_ANO == 2024
    assert got["1"].DATA_REF_TEMPO == AS_OF and got["1"].DIAS_CASA == 181
    assert got["7"].DT_ADMISSAO is None and got["7"].DIAS_CASA is None


def test_kpis(people):
    got = h.headcount_kpis(people, [2024]).first()
    # 1 and 2 were hired, 2 and 3 left; 2 left within 90 days
    assert (got.volume, got.active, got.exits) == (3, 1, 2)
    assert got.turnover_pct == pytest.approx(200 / 3)
    assert got.early_attrition_pct == 50.0
    assert got.mean_months == pytest.approx((181 + 90 + 1492) / 3 / 30.44)
    touched = active_in_years(people, [2024], h.HIRE_YEAR, h.EXIT_YEAR)
    assert rows(touched.select("CD_MATRICULA")) == [("1",), ("2",), ("3",)]


def test_years_without_rows_give_zero(people):
    assert tuple(h.headcount_kpis(people, [1999]).first()) == (0, 0, 0, 0.0, 0.0, 0.0)


def test_unknown_tenure_gives_null(spark):
    staff = [("9", "s", "x", None, None, "01/02/2024", None, None)]
    base = h.headcount_base(spark.createDataFrame(staff, SCHEMA), AS_OF)
    got = h.headcount_kpis(base, [2024]).first()
    assert got.volume == 1 and got.mean_months is None


def test_comparison(people):
    assert h.previous_years([2023, 2024]) == [2021, 2022]
    got = {r.kpi: r for r in h.kpi_compare(people, [2024]).collect()}
    assert (got["volume"].value, got["volume"].previous, got["volume"].worse) == (3.0, 2.0, False)
    assert got["exits"].diff == 2.0 and got["exits"].worse
    assert got["active"].diff == 1.0 and not got["active"].worse
    text = {r.kpi: r for r in h.kpi_text(h.kpi_compare(people, [2024])).collect()}
    assert (text["turnover_pct"].value_text, text["turnover_pct"].diff_text) == ("66.7%", "+66.7%")
    assert text["exits"].diff_text == "+2" and text["exits"].arrow == "↑"
    assert text["mean_months"].value_text.endswith(" meses")


def test_reasons_and_cohorts(people):
    reasons = h.leaving_reasons(people, [2023, 2024])
    assert rows(reasons.select("Motivo", "Qtd")) == [("r1", 2), ("r2", 1)]
    assert rows(h.main_reasons(reasons).select("Motivo")) == [("r1",)]
    only = h.leaving_reasons(people, [2023, 2024], "COLABORADOR")
    assert rows(only) == [("r2", 1, 100.0)]
    assert h.hires(people, [2024]).count() == 2
    assert h.leavers(people, [2024]).count() == 2


def test_lists(people):
    years = [r[0] for r in h.available_years(people).collect()]
    assert years == [2024, 2023, 2022, 2020]
    assert [r[0] for r in h.available_origins(people).collect()] == ["COLABORADOR", "EMPRESA"]
    assert h.default_year(people).first()[0] == 2024
    assert tuple(h.inventory(people).first()) == (7, 4)


def test_detail_is_by_supervisor_with_the_columns_that_exist(people):
    detail = h.detail_listing(people)
    assert detail.columns == [
        "TX_SUPERVISOR", "NO_FUNCIONARIO", "DT_ADMISSAO", "DT_DESLIGAMENTO",
        "ORIGEM_DESLIGAMENTO", "DS_RAZAO_DESLIGAMENTO",
    ]
    assert [r[0] for r in detail.collect()] == ["s1", "s1", "s2", "s3", "s3", "s4", None]


def _roster(spark, **changes):
    row = {
        "cd_matricula": 7,
        "tx_nome": " ana ",
        "tm_entrada": 28800,
        "tm_saida": 51600,
        "tm_carga_horaria": 30000,
        "tx_cargo": "ATENDENTE",
        "tx_staff": "x",
        "tx_escala": "y",
        "cd_cpf": 123,
        "tx_escala_semanal": "z",
        "tx_supervisor": "sup",
        "tx_funcao": "f",
        "quartil": "q1",
        "dt_quadro_dia": date(2024, 6, 1),
    }
    return {**row, **changes}


def test_roster_tests_the_stored_title_and_the_newest_day(spark):
    data = [
        _roster(spark),
        _roster(spark),
        _roster(spark, tx_cargo="SUPERVISOR"),
        _roster(spark, cd_matricula=8, tx_cargo="SUPERVISOR "),
        _roster(spark, cd_cpf=None),
        _roster(spark, cd_cpf=0),
        _roster(spark, cd_cpf=20453),
        _roster(spark, tx_cargo=None),
        _roster(spark, cd_matricula=9, dt_quadro_dia=date(2024, 5, 31)),
    ]
    schema = "cd_matricula bigint, tx_nome string, tm_entrada bigint, tm_saida bigint, tm_carga_horaria bigint, tx_cargo string, tx_staff string, tx_escala string, cd_cpf bigint, tx_escala_semanal string, tx_supervisor string, tx_funcao string, quartil string, dt_quadro_dia date"
    df = spark.createDataFrame([tuple(d.values()) for d in data], schema)
    got = workforce.operational_roster(df)
    assert rows(got.select("cd_matricula", "tx_nome", "tx_cargo")) == [
        (7, "ANA", "ATENDENTE"),
        (8, "ANA", "SUPERVISOR"),
    ]


def test_staff_master_accepts_text_dates_and_times(spark):
    roster = spark.createDataFrame(
        [(7.0, "08:00:00", "14:20:00", "06:20:00", "s", "e", 1)],
        "cd_matricula double, tm_entrada string, tm_saida string, tm_carga_horaria string, tx_supervisor string, tx_escala string, cd_cpf bigint",
    )
    register = spark.createDataFrame(
        [(7, "2000-02-29", "2024-01-30", None, "2024-04-29", "2024-02-31")],
        "CD_FUNCIONARIO bigint, DT_NASCIMENTO string, DT_ADMISSAO string, DT_EXPERIENCIA_FIM string, DT_EXPERIENCIA_PRORROGACAO string, DT_DESLIGAMENTO string",
    )
    master = workforce.staff_master(roster, register, AS_OF)
    got = master.first().asDict()
    assert got["cd_matricula"] == got["CD_FUNCIONARIO"] == "7"
    assert (got["IDADE"], got["FAIXA_ETARIA"]) == (24, "18 - 25")
    assert got["DT_DESLIGAMENTO"] is None and got["SUB_SITUACAO"] == "Efetivado"
    assert got["TEMPO_EMPRESA"] == "0 anos 5 meses"
    assert got["MORTALIDADE_<_90_DIAS"] is False
    assert (got["MES_ADMISSAO"], got["ANO_ADMISSAO"]) == ("Jan", 2024)
    assert (got["Jornada"], got["tm_carga_horaria"]) == ("08H - 14H:20", "6H:20")
    assert (got["tm_entrada"], got["tm_saida"]) == ("08:00:00", "14:20:00")
    assert "tx_escala" not in got and "cd_cpf" not in got
    view = workforce.staff_master_view(master).first()
    assert (view.DT_ADMISSAO, view.DT_ATUAL) == ("30/01/2024", "30/06/2024")
    assert workforce.staff_preview(master).columns == list(workforce.PREVIEW_COLUMNS)
    # the report reads the landed master, typed or as text, alike
    typed = h.headcount_base(master, AS_OF).select("DIAS_CASA", h.HIRE_YEAR)
    shown = h.headcount_base(workforce.staff_master_view(master), AS_OF).select(
        "DIAS_CASA", h.HIRE_YEAR
    )
    assert rows(typed) == rows(shown) == [(152, 2024)]


def _answers(spark, *lines):
    from datetime import datetime

    schema = (
        "MONITORIA bigint, PERGUNTA string, DATAMONITORIA timestamp_ntz, DATAFEEDBACK timestamp_ntz, "
        "RESPOSTA string"
    )
    at = datetime(2024, 6, 2, 9)
    df = spark.createDataFrame([(m, q, at, None, r) for m, q, r in lines], schema)
    rest = ("MONITOR", "MEDIA", "OPERADOR", "DIADALIGACAO", "CLASSIFICACAO", "QUESTIONARIO", "STATUS", "OPERACAO", "PERGUNTAGRUPO")
    return df.selectExpr("*", *[
        f"cast(NULL AS {'timestamp_ntz' if c == 'DIADALIGACAO' else 'string'}) AS {c}" for c in rest
    ])


def test_quality_filters_before_it_ranks(spark):
    from ringroster.plans.quality import quality_evaluations

    period = Period(date(2024, 6, 1), date(2024, 6, 30))
    answers = _answers(
        spark,
        (1, "A macro question", "x"),
        (1, "MICRO TEMA - B", "y"),
        (1, "MICRO TEMA - C", "z"),
        (2, "Arquivo ", "x"),
        (3, "Arquivo", "x"),
        (4, "arquivo ", "x"),
        (5, "MACRO", "x"),
        (6, None, "x"),
    )
    got = quality_evaluations(answers, period)
    shown = got.select("MONITORIA", "PERGUNTA", "DATAMONITORIA_DIA_SEMANA_NUM", "DATAMONITORIA_MES", "DentroSLA")
    assert rows(shown) == [
        (1, "B", 1, "jun", 0),
        (3, "Arquivo", 1, "jun", 0),
        (4, "arquivo ", 1, "jun", 0),
        (5, "MACRO", 1, "jun", 0),
    ]
    relaxed = quality_evaluations(answers, period, collation="UTF8_LCASE_RTRIM")
    assert rows(relaxed.select("MONITORIA")) == [(1,)]
