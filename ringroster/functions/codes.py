"""Code tables and the conditional rules built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringroster.functions import ColumnLike, as_column
from ringroster.functions.dates import as_of_column

# Codes and labels as the landed data must show them.
QUEUE_TYPES = {1: "Receptiva", 2: "Discador", 3: "Mista"}
QUEUE_TYPE_OTHER = "Outras"
CALL_STATUS = {
    200: "Atendido",
    300: "Falha",
    301: "Restrição de Contato",
    303: "Não Atendido",
    305: "Ocupado",
    307: "Desligamento",
    308: "Congestionamento",
    310: "Fila Cheia",
    311: "Sem Agentes Disponíveis",
    312: "Fila Vazia",
    313: "Tempo Esgotado",
    314: "Desconexão",
    315: "Fora Horário - Antes",
    316: "Fora Horário - Intervalo",
    317: "Fora Horário - Depois",
    334: "Limite de Canais",
    335: "Sem Rota",
    350: "Secr. Eletrônica",
    351: "Msg. Operadora",
    358: "Falha Operadora",
    366: "Número Inexistente",
    399: "Falha ao Disparar",
}
FINAL_STATUS = {
    201: "Transferido",
    203: "Anúncio",
    204: "Caixa Postal",
    305: "Transbordo",
    314: "Desconexão",
}
CONTACT_TYPES = {"fila": "Fila", "ramal": "Ativa"}
CONTACT_TYPE_OTHER = "Atendimento Agente"
DASH = "-"
QUEUE_KINDS = ("fila", "atendimento fila")
EXTENSION_KIND = "ramal"
AGE_BANDS = (
    (0, 18, "Menor de 18"),
    (18, 25, "18 - 25"),
    (25, 35, "25 - 35"),
    (35, 45, "35 - 45"),
    (45, 150, "45+"),
)
LEFT_IN_TRIAL = "Desligado no período de experiência"
LEFT_AFTER_TRIAL = "Desligado após período de experiência"
CONFIRMED = "Efetivado"
IN_TRIAL = "Em Experiência"


def code_label(c: ColumnLike, codes: Mapping, default: str | None = None) -> Column:
    """Label of a code. A NULL or unknown code gives `default` (NULL without one)."""
    c = as_column(c)
    arms = None
    for code, label in codes.items():
        arms = F.when(c == code, label) if arms is None else arms.when(c == code, label)
    return arms if default is None else arms.otherwise(default)


def dash_if_null(c: ColumnLike) -> Column:
    return F.coalesce(as_column(c), F.lit(DASH))


def first_known(*cs: ColumnLike) -> Column:
    return F.coalesce(*[as_column(c) for c in cs])


def either_label(row_id: ColumnLike, if_absent: ColumnLike, if_present: ColumnLike) -> Column:
    """One label when the row id is missing, the other when it is there."""
    return F.when(as_column(row_id).isNull(), as_column(if_absent)).otherwise(
        as_column(if_present)
    )


def blank_unless(shown: Column, columns: Sequence[str]) -> dict[str, Column]:
    """The columns with `-` wherever `shown` is not true."""
    return {c: F.when(shown, F.col(c)).otherwise(DASH) for c in columns}


def hangup_side(
    who: ColumnLike, kind: ColumnLike, survey_id: ColumnLike, final_status: ColumnLike
) -> Column:
    """Who ended the call; told only for surveyed or disconnected calls."""
    who, kind = as_column(who), as_column(kind)
    surveyed = as_column(survey_id).isNotNull()
    extension = kind == EXTENSION_KIND
    queue = kind.isin(*QUEUE_KINDS)
    side = (
        F.when((extension & (who == "2")) | (queue & (who == "1")), "Contato")
        .when((extension & (who == "1")) | (queue & (who == "2")), "Operador")
        .when(who == "3", "Supervisor")
        .when(who == "4", "Sistema")
        .when(who.isNull() & surveyed, "Sistema")
    )
    return F.when(surveyed | (as_column(final_status) == 314), side)


def survey_state(
    who: ColumnLike, kind: ColumnLike, survey_id: ColumnLike, final_status: ColumnLike
) -> Column:
    """Whether the caller reached the survey, hung up before it or was not sent to it."""
    who, kind = as_column(who), as_column(kind)
    caller_left = (as_column(final_status) == 314) & (
        ((who == "1") & kind.isin(*QUEUE_KINDS)) | ((who == "2") & (kind == EXTENSION_KIND))
    )
    return (
        F.when(as_column(survey_id).isNotNull(), "Transferido")
        .when(caller_left, "Cliente Desligou")
        .otherwise("Não Transferido")
    )


def trial_status(
    left_on: ColumnLike,
    trial_end: ColumnLike,
    trial_extension_end: ColumnLike,
    as_of: date | None = None,
) -> Column:
    """Standing in the trial period. An unknown end counts as passed for leavers, as
    still running for staff."""
    left_on = as_column(left_on)
    limit = F.coalesce(as_column(trial_extension_end), as_column(trial_end))
    return (
        F.when(left_on.isNotNull() & (left_on <= limit), LEFT_IN_TRIAL)
        .when(left_on.isNotNull(), LEFT_AFTER_TRIAL)
        .when(as_of_column(as_of) > limit, CONFIRMED)
        .otherwise(IN_TRIAL)
    )


def age_band(age: ColumnLike) -> Column:
    """Left-closed band of an age; NULL outside all bands."""
    age = as_column(age)
    arms = None
    for low, high, label in AGE_BANDS:
        inside = (age >= low) & (age < high)
        arms = F.when(inside, label) if arms is None else arms.when(inside, label)
    return arms


def early_exit_flag(days: ColumnLike, limit: int = 90) -> Column:
    return F.coalesce(as_column(days) <= limit, F.lit(False))
