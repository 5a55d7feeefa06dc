"""General calls: the telephony record beside its derived facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringroster.functions.text import collated
from ringroster.operators.filters import in_days, one_of
from ringroster.period import Period
from ringroster.sources.policies import KEEP_FIRST, Policy

CALLS = "general_calls"
FACTS = "general_call_facts"

# Output names of the call record, and source names where they differ.
CALL_COLUMNS = (
    "uniqueid", "Chamada", "Data", "Hora", "Pais", "DDD", "Numero", "Fila", "Tempo_na_ura",
    "Tempo_de_espera", "Tempo_falado", "Tempo_Satisfacao", "Tempo_Total", "Desconexao",
    "Telefone_Entrada", "Id_ligacao", "Submissor", "Final_URA", "Nota", "RespPesquisa",
    "Tabulacao", "SubTabulacao", "Tipo_Contato", "Operador", "FilaNexus", "DataHora",
    "RespPesquisa2", "Nota2", "linkedidSemPonto", "status_ligacao", "desconexao_sistema",
    "cpf_cnpj",
)
CALL_SOURCE_NAMES = {
    "Tempo_na_ura": "Tempo na ura",
    "Tempo_de_espera": "Tempo de espera",
    "Tempo_falado": "Tempo falado",
    "Tempo_Satisfacao": "Tempo Satisfacao",
    "Tempo_Total": "Tempo Total",
    "Desconexao": "Desconexão",
    "Telefone_Entrada": "Telefone Entrada",
    "Id_ligacao": "Id ligação",
    "Tipo_Contato": "Tipo Contato",
}
# Columns of the facts, in output order. Those that also exist on the call
# record are prefixed in the output.
FACT_COLUMNS = (
    "Chamada", "Numero", "Fila", "Desconexao", "Telefone_Entrada", "linkedid", "Submissor",
    "RespPesquisa", "Tabulacao", "SubTabulacao", "Tipo_Contato", "Operador",
    "tx_subemissor_jira", "tx_fila", "tx_prioridade", "tx_categoria", "tx_motivo",
    "tx_submotivo", "OP", "visao", "TotalChamadas", "RetidaEmUra", "Atendidas",
    "Abandonadas", "Recebidas", "Atendidos10Seg", "Atendidos15Seg", "ShortCall", "FCR",
    "RECHAMADA", "tempoEsperaSeg", "tempoFaladoSeg", "tempoURASeg", "encaminhado_Csat",
    "Resp_CSAT", "Csat0", "Csat1", "Csat2", "Csat3", "Csat4", "Csat5", "CsatDetrator",
    "CsatNeutro", "CsatPromotor", "EncaminhadoCSATDetrator",
    "Detrator_informacaoNaoFoiClara", "Detrator_NaoForamEsclarecidas",
    "Detrator_NaoFoiEducado", "CALLBACK", "Entrou_em_URA", "PrimeiraTentativaCPF_URA",
    "ClienteNaoConsta_URA", "Perda_URA", "Roubo_URA", "Saldo_extrato_URA",
    "Desbloquear_cartao_URA", "Senha_incorreta_URA", "Perda_Roubo_URA",
    "Primeira_Mensagem_URA", "HoraTravada", "DataHora", "tx_status", "tx_item",
    "tx_jira_aberto", "tx_jira_fechado", "tx_jira_pendente", "dt_cadastro_jira",
    "dt_data_resolucao", "dias_atraso_BKO", "ToCALLBACK", "ToCALLBACKQueda",
    "tx_transacao_cartao", "TransferenciaOgea_URA", "TransferenciaAssai_URA",
    "desconexao_tronco", "cpf_cnpj", "tx_cpf_cnpj_jira", "fora_de_horario",
)
FACT_SOURCE_NAMES = {"Desconexao": "Desconexão"}
PREFIXED_FACTS = {*CALL_COLUMNS, "linkedid"}
OPERATIONS = ("N2", "SAC")

POLICY = Policy(
    KEEP_FIRST,
    keys=("t_Id_ligacao", "t_Data", "t_Operador"),
    sort=("t_Id_ligacao", "t_Data"),
    tiebreak=("t_DataHora", "t_uniqueid"),
    month_column="t_Data",
)


def fact_output(name: str) -> str:
    return f"d_{name}" if name in PREFIXED_FACTS else name


def general_calls(
    sources: Mapping[str, DataFrame],
    period: Period,
    operations: Sequence[str] = OPERATIONS,
    calls_collation: str | None = None,
    facts_collation: str | None = None,
) -> DataFrame:
    """Calls of the period with facts of the chosen operations, 110 columns. Collations are
    those by which the two sources compare texts."""
    calls = in_days(sources[CALLS], "DataHora", period.start, period.end).select(
        *[
            F.col(f"`{CALL_SOURCE_NAMES.get(c, c)}`").alias(f"t_{c}")
            for c in CALL_COLUMNS
        ]
    )
    facts = sources[FACTS].where(one_of("OP", operations, facts_collation))
    facts = facts.select(
        *[F.col(f"`{FACT_SOURCE_NAMES.get(c, c)}`").alias(fact_output(c)) for c in FACT_COLUMNS]
    )
    # a condition on the facts removes calls without facts, so the join is inner
    collation = calls_collation or facts_collation
    same = collated(calls.t_uniqueid, collation) == collated(facts.d_linkedid, collation)
    # the calls of a period are hashed and the wide facts of all periods pass by unsorted, as a
    # sort holds them whole, far above the compressed size by which Spark joins partitions
    return calls.hint("shuffle_hash").join(facts, same, "inner")
