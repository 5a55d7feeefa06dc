"""Calls of one client, kept by the source in one table per outcome."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringroster.functions.jsonx import RATINGS, json_text, rating_by_flow
from ringroster.functions.text import starts_with
from ringroster.operators.filters import in_period_instants
from ringroster.operators.ordering import order_desc
from ringroster.period import Period
from ringroster.sources.policies import KEEP_FIRST, Policy

# The outcome tables in union order; the last one holds answered calls.
UNANSWERED = (
    "ligacao_receptivo_abandono",
    "ligacao_receptivo_desistencia",
    "ligacao_receptivo_caixapostal",
    "ligacao_receptivo_forahorario",
    "ligacao_receptivo_forahorario_hist",
    "ligacao_receptivofalha_generica",
    "ligacao_receptivo_timeout",
    "ligacao_receptivofalha_generica_hist",
    "ligacao_receptivoura_falha",
    "ligacao_receptivoura_naotransferido",
    "ligacao_ativoexterno_atendimento",
    "ligacao_ativoexterno_naoatendimento",
)
ANSWERED = "ligacao_receptivo_atendimento"
SOURCES = (*UNANSWERED, ANSWERED)
# Output columns before and after the four ratings.
COLUMNS_BEFORE = (
    "titulo", "datahora", "data", "hora", "horaatende", "uniqueid", "linkedid", "direcao",
    "status", "ddd", "idestado", "custo", "fila", "cadastro", "usuario", "ura", "tabulacao",
    "subtabulacao", "iduranome", "uranome", "uracampos", "urahistorico", "pesquisa",
    "pesquisaperguntas", "pesquisarespostas", "pesquisatransfere", "pesquisa1", "pesquisa2",
    "pesquisa3",
)
COLUMNS_AFTER = (
    "clientedesligou", "numero", "tempototal", "tempoespera", "tempoatende", "todos",
    "atendimento", "naoatendimento", "ocupado", "falhas", "entrante", "sainte", "interna",
    "contareceptivo", "contareceptivoatendimento", "contareceptivoatendimentoantesns",
    "contareceptivoatendimentoaposns", "contareceptivoabandono",
    "contareceptivoabandonoantes10", "contareceptivoabandonoantesns",
    "contareceptivoabandonoaposns", "contareceptivoforahorario", "contaativo",
    "contaativoatendimento", "contaativoexternoatendimento",
    "contaativoexternonaoatendimento", "contaativointernoatendimento",
    "contaativointernonaoatendimento",
)

POLICY = Policy(
    KEEP_FIRST,
    keys=("linkedid", "datahora", "usuario"),
    sort=("linkedid", "datahora"),
    month_column="datahora",
)


@dataclass(frozen=True)
class Flows:
    """IVR flows: one writes ratings under their own keys, one under survey keys."""

    direct: str
    survey: str


def with_ratings(df: DataFrame, answered: bool, flows: Flows) -> DataFrame:
    """The four rating columns. Answered calls read them according to their IVR flow."""
    values = {
        r.output: rating_by_flow(
            r, "uranome", "uracampos", "urahistorico", flows.direct, flows.survey
        )
        if answered
        else json_text("uracampos", r.direct_key)
        for r in RATINGS
    }
    return df.withColumns(values)


def union_outcomes(branches: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name. A filter on the result is pushed into every branch."""
    return reduce(DataFrame.unionByName, branches)


def outcome_calls(
    sources: Mapping[str, DataFrame],
    period: Period,
    cost_centre_prefix: str,
    flows: Flows,
    collation: str | None = None,
) -> DataFrame:
    """The client's calls of the period, all outcomes, newest first, 61 columns."""
    branches = [
        with_ratings(sources[name], name == ANSWERED, flows).select(
            *COLUMNS_BEFORE, *[r.output for r in RATINGS], *COLUMNS_AFTER
        )
        for name in SOURCES
    ]
    calls = union_outcomes(branches).where(
        starts_with(F.col("custo"), cost_centre_prefix, collation)
    )
    return in_period_instants(calls, "datahora", period)


def newest_first(calls: DataFrame) -> DataFrame:
    """Presentation order; landing has its own."""
    return order_desc(calls, "datahora", ["uniqueid", "linkedid"])
