"""Quality evaluations: one line per evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringroster.functions.dates import (
    month_abbr,
    month_num,
    to_day,
    weekday_num,
    within_days_flag,
    year_text,
)
from ringroster.functions.text import collated, norm_upper, remove_literal
from ringroster.operators.filters import in_days, none_of
from ringroster.operators.windows import first_per_key
from ringroster.period import Period
from ringroster.sources.policies import KEEP_FIRST, Policy

SOURCE = "quality_answers"
# Questions left out, the prefix cut off and the days allowed for feedback.
EXCLUDED_PIECE = "macro"
EXCLUDED_QUESTIONS = (
    "Arquivo ",
    "Código",
    "Data e hora do atendimento",
    "Desconectou a ligação sem atender a solicitação",
    "Emissor",
    "Emissor (escrever em letras maiúsculas).",
    "Resumo e apontamentos",
)
QUESTION_PREFIX = "MICRO TEMA - "
FEEDBACK_DAYS = 5

POLICY = Policy(
    KEEP_FIRST,
    keys=("MONITORIA", "DATAMONITORIA", "OPERADOR"),
    sort=("MONITORIA", "DATAMONITORIA"),
    month_column="DATAMONITORIA",
)


def quality_evaluations(
    answers: DataFrame,
    period: Period,
    tiebreak: Sequence[str] = ("PERGUNTA", "RESPOSTA"),
    collation: str | None = None,
) -> DataFrame:
    """First form line of each evaluation in the period.

    Lines are filtered first and ranked after, so the first line is the first of those
    that count. Lines of one instant are ordered by `tiebreak`.
    """
    question = collated("PERGUNTA", collation)
    counted = in_days(answers, "DATAMONITORIA", period.start, period.end).where(
        ~F.contains(question, F.lit(EXCLUDED_PIECE)) & none_of(question, EXCLUDED_QUESTIONS)
    )
    first = first_per_key(counted, ["MONITORIA"], ["DATAMONITORIA", *tiebreak], number="RN")
    return first.select(
        "RN",
        norm_upper("MONITOR").alias("MONITOR"),
        "MONITORIA",
        "MEDIA",
        norm_upper("OPERADOR").alias("OPERADOR"),
        "DIADALIGACAO",
        to_day("DIADALIGACAO").alias("DIADALIGACAO_SHORTDATE"),
        "DATAMONITORIA",
        weekday_num("DATAMONITORIA").alias("DATAMONITORIA_DIA_SEMANA_NUM"),
        year_text("DATAMONITORIA").alias("ANO_DATAMONITORIA"),
        F.lower(month_abbr("DATAMONITORIA")).alias("DATAMONITORIA_MES"),
        month_num("DATAMONITORIA").alias("DATAMONITORIA_NUM"),
        to_day("DATAMONITORIA").alias("DATAMONITORIA_SHORTDATE"),
        "DATAFEEDBACK",
        to_day("DATAFEEDBACK").alias("DATAFEEDBACK_SHORTDATE"),
        remove_literal("PERGUNTA", QUESTION_PREFIX).alias("PERGUNTA"),
        "CLASSIFICACAO",
        "QUESTIONARIO",
        within_days_flag("DATAMONITORIA", "DATAFEEDBACK", FEEDBACK_DAYS).alias("DentroSLA"),
        "STATUS",
        "RESPOSTA",
        "OPERACAO",
        "PERGUNTAGRUPO",
    )
