"""Per-call detail of the omnichannel telephony tables, and queue KPIs.

The calls of the period are cut out first. The large tables keyed by call id are joined one
after the other, so that those joins share one shuffle of the calls. Tables keyed by the external call follow in the same
way, then the small tables, which Spark broadcasts while they are below its threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringroster.functions.codes import (
    CALL_STATUS,
    CONTACT_TYPE_OTHER,
    CONTACT_TYPES,
    DASH,
    FINAL_STATUS,
    QUEUE_TYPE_OTHER,
    QUEUE_TYPES,
    blank_unless,
    code_label,
    dash_if_null,
    either_label,
    first_known,
    hangup_side,
    survey_state,
)
from ringroster.functions.dates import stamp_text
from ringroster.functions.durations import (
    as_intervals,
    epoch_secs,
    hms_text,
    no_time_if_null,
    time_between,
    time_of_day,
)
from ringroster.functions.jsonx import transfer_text
from ringroster.functions.scores import score_label, shifted_score
from ringroster.functions.text import (
    as_text,
    contains_text,
    labelled_fields,
    money_text,
    null_if,
)
from ringroster.operators.aggregates import avg_dur, sum_dur
from ringroster.operators.filters import in_period_instants
from ringroster.operators.joins import (
    any_key_rows,
    join_on_expr,
    link_queue_leg,
    lookup,
)
from ringroster.operators.skew import exact_left_joins, split_left_join
from ringroster.period import Period
from ringroster.sources.policies import KEEP_FIRST, Policy

CALL_TIMES = ("tempototal", "tempoatendimento")  # seconds or intervals, as the source has them

# Source tables, kinds of legs and of queues.
SOURCES = (
    "ligacao", "custo", "ligacaointerna", "ligacaointernafila", "fila", "ligacaodiscador",
    "usuario", "ura", "ligacaotarifacao", "ligacaoexterna", "tronco", "cc_tabulacao",
    "tabulacaofila", "tabulacaocampanha", "subtabulacao", "subtabulacaocampanha",
    "templateps", "pesquisasatisfacao", "desconexao", "contatocanal", "contato",
)
AGENT_KIND = "atendimento fila"
QUEUE_KIND = "fila"
LEG_KINDS = ("fila", AGENT_KIND, "ramal")
CONTACT_KINDS = tuple(CONTACT_TYPES)
QUEUE_KINDS = (1, 2, 3)
VOICE_ASSISTANT = "assistente de voz"
QUESTIONS = (1, 2, 3, 4, 5)

POLICY = Policy(
    KEEP_FIRST,
    keys=("linkedid", "datahora_ts", "usuario"),
    sort=("linkedid", "datahora_ts"),
    tiebreak=("idligacao",),
    month_column="datahora_ts",
)


def _named(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(o) for c, o in names.items()])


def _with_internal_leg(calls: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Inner joins to the internal leg and its queue data.

    The calls are those of one period, while these tables hold all periods. So the calls
    are moved to each table in turn; joining the tables first would move them twice.
    """
    internal = _named(sources["ligacaointerna"], {"id": "li_id", "idligacao": "li_idligacao"})
    queue_data = _named(
        sources["ligacaointernafila"],
        {
            "idligacaointerna": "lif_id",
            "datahorafimespera": "datahorafimespera",
            "nivelservico": "nivelservico",
            "atendeunivelservico": "atendeunivelservico",
            "tempototalhold": "tempototalhold",
            "tempototalmudo": "tempototalmudo",
            "idtemplateps": "idtemplateps",
            "pesquisasatisfacao": "pesquisasatisfacao",
        },
    )
    times = ["nivelservico", "tempototalhold", "tempototalmudo"]
    queue_data = as_intervals(queue_data, times)
    calls = lookup(calls, internal, "id", "li_idligacao", "inner")
    calls = lookup(calls, queue_data, "li_id", "lif_id", "inner")
    return calls.drop("li_id", "lif_id", "li_idligacao")


def _with_call_tables(calls: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Left joins keyed by the call id: dialer, tabulation, survey answer."""
    dialer = _named(
        sources["ligacaodiscador"],
        {
            "idligacao": "ld_idligacao",
            "nomecampanha": "campanha",
            "idcampanha": "idcampanha",
            "nomemailing": "mailing",
            "campos_json": "campos_json",
            "campos": "campos",
        },
    )
    calls = lookup(calls, dialer, "id", "ld_idligacao").drop("ld_idligacao")
    tabulation = _named(
        sources["cc_tabulacao"],
        {
            "id": "t_id",
            "idligacaoagente": "t_agente",
            "idligacaofila": "t_fila",
            "idtipo": "t_idtipo",
            "idtipocampanha": "t_idtipocampanha",
            "idsubtipo": "t_idsubtipo",
            "idsubtipocampanha": "t_idsubtipocampanha",
            "obs": "observacao",
            "datahoratabulacao": "datahoratabulacao",
            "tempotabulando": "tempotabulando",
            **{f"campo{i}": f"t_campo{i}" for i in range(1, 7)},
        },
    )
    tabulation = as_intervals(tabulation, ["tempotabulando"])
    survey = _named(
        sources["pesquisasatisfacao"],
        {
            "id": "idpesquisa",
            "idligacaoagente": "ps_agente",
            "idligacaofila": "ps_fila",
            "nota": "ps_nota1",
            **{f"nota{i}": f"ps_nota{i}" for i in QUESTIONS[1:]},
        },
    )
    surveyed = (
        (F.col("idstatusfinal") == 201)
        & F.col("idtemplateps").isNotNull()
        & F.col("pesquisasatisfacao")
    )
    # call ids are never null and repeat for hang-up records only, so the three tables share
    # one shuffle by them
    rights = [
        (any_key_rows(tabulation, ["t_agente", "t_fila"], "_t_key"), "_t_key"),
        (any_key_rows(survey, ["ps_agente", "ps_fila"], "_ps_key"), "_ps_key", surveyed),
    ]
    calls = exact_left_joins(calls, rights, "id")
    return calls.drop("t_agente", "t_fila", "ps_agente", "ps_fila")


def _with_related_calls(
    legs: DataFrame, sources: Mapping[str, DataFrame], period: Period, kinds: Sequence[str]
) -> DataFrame:
    """External leg, voice-assistant leg and, but for agent legs, hang-up record."""
    calls = as_intervals(sources["ligacao"], CALL_TIMES)
    spans = ("datahora", "datahoraatende", "datahorafim", "tempototal", "tempoatendimento")
    external = _named(calls, {"id": "x_id", **{c: f"externo_{c}" for c in spans}})
    billing = _named(
        sources["ligacaotarifacao"],
        {
            "idligacao": "lt_id",
            "tempotarifado": "externo_tempotarifado",
            "valor": "externo_valor",
        },
    )
    billing = as_intervals(billing, ["externo_tempotarifado"])
    trunk = _named(sources["ligacaoexterna"], {"idligacao": "le_id", "idtronco": "le_tronco"})
    trunk = lookup(
        trunk, _named(sources["tronco"], {"id": "tr_id", "nome": "externo_tronco"}), "le_tronco", "tr_id"
    ).drop("le_tronco", "tr_id")
    legs = split_left_join(
        legs,
        [(external, "x_id"), (billing, "lt_id"), (trunk, "le_id")],
        "idligextprincipal",
        spread_by=["id"],
        keys=_legs_of(sources, period, kinds).select("idligextprincipal"),
    )
    assistant = _named(
        calls.where(F.col("tipo") == VOICE_ASSISTANT),
        {"id": "a_id", "idassistentevoz": "a_ura", **{c: f"assistente_{c}" for c in spans}},
    )
    assistant = lookup(
        assistant, _named(sources["ura"], {"id": "u_id", "nome": "assistente_nome"}), "a_ura", "u_id"
    ).select(
        "a_id",
        F.col("a_id").alias("assistente_idligacao"),
        "assistente_nome",
        *[f"assistente_{c}" for c in spans],
    )
    legs = split_left_join(legs, [(assistant, "a_id")], "idliganterior", spread_by=["id"])
    own = F.when(F.col("tipo") != AGENT_KIND, F.col("uniqueid"))
    return join_on_expr(legs, _hangups(sources), own, "d_uniqueid", spread_by=["id"])


def _hangups(sources: Mapping[str, DataFrame]) -> DataFrame:
    return _named(sources["desconexao"], {"uniqueid": "d_uniqueid", "quem": "quem"})


def _with_queue_hangup(legs: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Hang-up records of agent legs, found through the queue legs of the contact.

    An agent leg is repeated for each of these, and such pairs grow faster than legs. So the
    queue legs meet their hang-up records first, and the pairs are made by the last join.
    """
    queue = sources["ligacao"].where(F.col("tipo") == QUEUE_KIND)
    queue = queue.select("id", "tipo", "linkedid", "datahoraatende", "idstatusfinal", "uniqueid")
    queue = join_on_expr(queue, _hangups(sources), F.col("uniqueid"), "d_uniqueid", spread_by=["id"])
    legs = link_queue_leg(legs, {"uniqueid": "fila_uniqueid", "quem": "fila_quem"}, calls=queue)
    quem = F.when(F.col("tipo") == AGENT_KIND, F.col("fila_quem")).otherwise(F.col("quem"))
    return legs.withColumn("quem", quem).drop("fila_quem")


def _with_people(legs: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Left joins to the agent and the contact of a leg."""
    users = _named(
        sources["usuario"], {"id": "usr_id", "matricula": "matricula", "nome": "usuario"}
    )
    legs = lookup(legs, users, "idusuario", "usr_id", spread_by=["id"]).drop("usr_id")
    channel = _named(sources["contatocanal"], {"id": "conc_id", "idcontato": "conc_contato"})
    contact = _named(sources["contato"], {"id": "c_id", "nome": "nomecontato"})
    contact = lookup(channel, contact, "conc_contato", "c_id").select("conc_id", "nomecontato")
    return split_left_join(legs, [(contact, "conc_id")], "idcontatocanal", spread_by=["id"])


def _with_names(legs: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Left joins to the names of a tabulation and to the survey shown."""
    for table, key, output in (
        ("tabulacaofila", "t_idtipo", "tf_nome"),
        ("tabulacaocampanha", "t_idtipocampanha", "tbc_nome"),
        ("subtabulacao", "t_idsubtipo", "s_nome"),
        ("subtabulacaocampanha", "t_idsubtipocampanha", "sc_nome"),
    ):
        names = _named(sources[table], {"id": "_id", "nome": output})
        legs = lookup(legs, names, key, "_id", spread_by=["id"]).drop("_id", key)
    template = _named(
        sources["templateps"],
        {
            "id": "pesquisafila",
            "nome": "tps_nome",
            "numperguntas": "numperguntas",
            "respiniciaem0": "tps_zero",
            **{f"txtpergunta{i}": f"tps_pergunta{i}" for i in QUESTIONS},
            **{f"txtrespostas{i}": f"tps_respostas{i}" for i in QUESTIONS},
            **{f"respemzero{i}": f"tps_zero{i}" for i in QUESTIONS},
        },
    )
    return lookup(legs, template, "idtemplateps", "pesquisafila", spread_by=["id"])


def _legs_of(
    sources: Mapping[str, DataFrame], period: Period, kinds: Sequence[str]
) -> DataFrame:
    """Legs of the period and kinds, before any join."""
    legs = in_period_instants(sources["ligacao"], "datahora", period)
    return legs.where(F.col("tipo").isin(list(kinds)))


def contact_legs(
    sources: Mapping[str, DataFrame], period: Period, kinds: Sequence[str] = LEG_KINDS
) -> DataFrame:
    """Legs of the period that reached a queue, with their queue and durations."""
    cost_centre = _named(sources["custo"], {"id": "cc_id", "nome": "centrocusto"})
    queue = _named(
        sources["fila"].where(F.col("tipofila").isin(list(QUEUE_KINDS))),
        {
            "id": "f_id",
            "name": "fila",
            "tipofila": "f_tipofila",
            "servicelevel": "f_servicelevel",
            **{f"campotab{i}": f"f_campotab{i}" for i in range(1, 7)},
        },
    )
    queue = as_intervals(queue, ["f_servicelevel"])
    legs = as_intervals(_legs_of(sources, period, kinds), CALL_TIMES)
    legs = lookup(legs, cost_centre, "idcentrocusto", "cc_id", "inner").drop("cc_id")
    legs = lookup(legs, queue, "idfila", "f_id", "inner").drop("f_id")
    wait = time_between("datahora", "datahorafimespera")
    return _with_internal_leg(legs, sources).withColumns(
        {
            "tempoespera": wait,
            "tempoesperafila": F.when(F.col("tipo") == "fila", wait),
            "tempoduracao": F.col("tempototal"),
            "hold_tempo_total": time_of_day("tempototalhold"),
            "mudo_tempo_total": time_of_day("tempototalmudo"),
        }
    )


def calls_legs(
    sources: Mapping[str, DataFrame], period: Period, kinds: Sequence[str] = LEG_KINDS
) -> DataFrame:
    """Legs of the period with all related data, typed.

    A leg is repeated for each dialer, tabulation, survey or hang-up row that it has.
    """
    # rows are repeated late, so that the joins before move and sort each leg once
    legs = _with_related_calls(contact_legs(sources, period, kinds), sources, period, kinds)
    legs = _with_call_tables(_with_people(legs, sources), sources)
    legs = _with_names(legs, sources)
    if AGENT_KIND in kinds:
        legs = _with_queue_hangup(legs, sources)
    return legs.withColumns(
        {
            "tipofila": code_label("f_tipofila", QUEUE_TYPES, QUEUE_TYPE_OTHER),
            "status": code_label("idstatus", CALL_STATUS),
            "statusfinal": code_label("idstatusfinal", FINAL_STATUS, DASH),
            "nivelservicofila": time_of_day("f_servicelevel"),
            "textoextra": transfer_text("extra", "idstatusfinal"),
            "campostabulacao": labelled_fields(
                [(f"f_campotab{i}", f"t_campo{i}") for i in range(1, 7)]
            ),
            "filatabulacao": either_label("t_id", "tbc_nome", "tf_nome"),
            "filasubtabulacao": either_label("t_id", "sc_nome", "s_nome"),
            "desligou": hangup_side("quem", "tipo", "idpesquisa", "idstatusfinal"),
            "pesquisatransferida": survey_state("quem", "tipo", "idpesquisa", "idstatusfinal"),
            "pesquisa": F.when(
                F.col("tps_nome").isNull() | (F.col("idstatus") == 303), DASH
            ).otherwise(F.col("tps_nome")),
            **{f"pergunta{i}": null_if(f"tps_pergunta{i}", "") for i in QUESTIONS},
            **{f"nota{i}": shifted_score(f"ps_nota{i}", f"tps_zero{i}") for i in QUESTIONS},
            **{
                f"resposta{i}": score_label(
                    f"ps_nota{i}",
                    f"tps_respostas{i}",
                    "tps_zero",
                    None if i == 1 else f"tps_pergunta{i}",
                )
                for i in QUESTIONS
            },
        }
    )


# Columns of the landed detail that depend on a survey having been shown.
SURVEY_COLUMNS = (
    "pesquisatransferida",
    *[f"{part}{i}" for i in QUESTIONS for part in ("pergunta", "resposta")],
)


def _detail_columns(currency: str) -> dict[str, Column]:
    """The 74 columns of the landed detail, in order."""

    def stamp(c: str, dashed: bool) -> Column:
        return dash_if_null(stamp_text(c)) if dashed else stamp_text(c)

    def clock(c: str) -> Column:
        return hms_text(epoch_secs(no_time_if_null(c)))

    def dashed_text(c: str) -> Column:
        return dash_if_null(as_text(c))

    answered = F.coalesce(F.col("idstatus") != 303, F.lit(True))
    shown = blank_unless(F.col("pesquisafila").isNotNull() & answered, SURVEY_COLUMNS)
    survey: dict[str, Column] = {}
    for i in QUESTIONS:
        survey[f"pergunta{i}"] = dash_if_null(shown[f"pergunta{i}"])
        survey[f"resposta{i}"] = dash_if_null(shown[f"resposta{i}"])
        survey[f"nota{i}"] = dash_if_null(f"nota{i}")
    kept = {c: F.col(c) for c in ("origem", "destino", "idusuario", "matricula")}
    service_level = first_known(F.col("nivelservico"), F.col("nivelservicofila"))
    return {
        "datahora": stamp("datahora", False),
        "datahoraatende": stamp("datahoraatende", True),
        "datahorafim": stamp("datahorafim", False),
        **kept,
        "usuario": dash_if_null("usuario"),
        "nomecontato": dash_if_null("nomecontato"),
        "centrocusto": F.col("centrocusto"),
        "status": F.col("status"),
        "idstatus": F.col("idstatus"),
        "statusfinal": F.col("statusfinal"),
        "extra": dash_if_null("textoextra"),
        "fila": F.col("fila"),
        "tipofila": F.col("tipofila"),
        "tipo": code_label("tipo", CONTACT_TYPES, CONTACT_TYPE_OTHER),
        "idcampanha": dashed_text("idcampanha"),
        "campanha": dash_if_null("campanha"),
        "idmailing": dashed_text("idmailing"),
        "mailing": dash_if_null("mailing"),
        "campos": dash_if_null("campos"),
        "tempoduracao": clock("tempoduracao"),
        "tempoatendimento": clock("tempoatendimento"),
        "tempoespera": clock("tempoespera"),
        "hold_tempo_total": clock("hold_tempo_total"),
        "mudo_tempo_total": clock("mudo_tempo_total"),
        "nivelservico": hms_text(epoch_secs(service_level)),
        "datahoratabulacao": stamp("datahoratabulacao", True),
        "tempotabulando": dash_if_null(hms_text(epoch_secs("tempotabulando"))),
        "tabulacao": dash_if_null("tf_nome"),
        "subtabulacao": dash_if_null("s_nome"),
        "tabulacaocampanha": dash_if_null("tbc_nome"),
        "subtabulacaocampanha": dash_if_null("sc_nome"),
        "campostabulacao": null_if("campostabulacao", ""),
        "observacao": dash_if_null(null_if("observacao", "")),
        "uniqueid": F.col("uniqueid"),
        "linkedid": F.col("linkedid"),
        "idligacao": F.col("id"),
        "desligou": dash_if_null("desligou"),
        "pesquisa": F.col("pesquisa"),
        "pesquisatransferida": shown["pesquisatransferida"],
        **survey,
        "externo_tronco": dash_if_null("externo_tronco"),
        "externo_idligacao": dashed_text("idligextprincipal"),
        "externo_datahora": stamp("externo_datahora", True),
        "externo_datahoraatende": stamp("externo_datahoraatende", True),
        "externo_datahorafim": stamp("externo_datahorafim", True),
        "externo_tempototal": clock("externo_tempototal"),
        "externo_tempoatendimento": clock("externo_tempoatendimento"),
        "externo_tempotarifado": clock("externo_tempotarifado"),
        "externo_valor": money_text(F.coalesce(F.col("externo_valor"), F.lit(0)), currency),
        "campos_json": F.col("campos_json"),
        "assistente_idligacao": dashed_text("assistente_idligacao"),
        "assistente_nome": dash_if_null("assistente_nome"),
        "assistente_datahora": stamp("assistente_datahora", False),
        "assistente_datahoraatende": stamp("assistente_datahoraatende", False),
        "assistente_datahorafim": stamp("assistente_datahorafim", False),
        "assistente_tempototal": clock("assistente_tempototal"),
        "assistente_tempoatendimento": clock("assistente_tempoatendimento"),
    }


def calls_detail(
    legs: DataFrame,
    cost_centre_contains: str,
    currency: str = "R$",
    collation: str | None = None,
) -> DataFrame:
    """Detail of the queue and outbound calls of one client, one row per leg row.

    The typed `datahora_ts`, cut to the second, is added for keys, order and months; the
    other columns are display text where the report shows text.
    """
    wanted = legs.where(
        contains_text("centrocusto", cost_centre_contains, collation)
        & F.col("tipo").isin(list(CONTACT_KINDS))
    )
    return wanted.select(
        F.date_trunc("second", "datahora").cast("timestamp_ntz").alias("datahora_ts"),
        *[value.alias(name) for name, value in _detail_columns(currency).items()],
    )


def queue_kpis(legs: DataFrame, group: Sequence[str | Column]) -> DataFrame:
    """Volumes, durations and waits (exact intervals) per group, in one aggregation.

    Meant for `contact_legs`, where each leg is one row, so that nothing counts twice.
    """
    kind, status = F.col("tipo"), F.col("idstatus")
    queue, extension = kind == "fila", kind == "ramal"
    contact = queue | extension
    answered = queue & (status == 200) & F.col("datahoraatende").isNotNull()
    wait = "tempoesperafila"
    return legs.groupBy(*group).agg(
        F.sum(F.when(contact, 1).otherwise(0)).alias("total"),
        F.sum(F.when(answered, 1).otherwise(0)).alias("quantidadeatendido"),
        sum_dur("tempoduracao").alias("tempoduracao"),
        sum_dur("tempoatendimento").alias("tempoatendimento"),
        sum_dur("tempoespera").alias("tempoespera"),
        sum_dur("tempoduracao", contact).alias("tempoduracaofila"),
        avg_dur("tempoduracao", contact).alias("tempoduracaofila_avg"),
        sum_dur("tempoatendimento", contact).alias("tempoatendimentofila"),
        avg_dur("tempoatendimento", contact & (status == 200)).alias(
            "tempoatendimentofila_avg"
        ),
        sum_dur(wait, queue).alias("tempoesperafila"),
        avg_dur(wait, queue).alias("tempoesperafila_avg"),
        sum_dur(wait, queue & (status == 200)).alias("tempoesperafila_atd"),
        avg_dur(wait, queue & (status == 200)).alias("tempoesperafila_atd_avg"),
        sum_dur(wait, queue & (status == 314)).alias("tempoesperafila_desc"),
        avg_dur(wait, queue & (status == 314)).alias("tempoesperafila_desc_avg"),
        sum_dur("tempoespera", extension).alias("tempotocaativa"),
        avg_dur("tempoespera", extension).alias("tempotocaativa_avg"),
        sum_dur("hold_tempo_total").alias("hold_tempo"),
        avg_dur("hold_tempo_total").alias("hold_tempo_avg"),
        sum_dur("mudo_tempo_total").alias("mudo_tempo"),
        avg_dur("mudo_tempo_total").alias("mudo_tempo_avg"),
    )
