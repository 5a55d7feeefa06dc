"""Source tables of the call jobs, derived from the test tables.

Every derived column is a plain function of whole rows, so the data grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks import table

_EVENT = """
    event_id, user_id, event_type, value, ts,
    cast(get_json_object(props, '$.k') AS int) AS k
"""


def call_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    events = table(spark, folder, "events").selectExpr(*_split(_EVENT))
    orders = table(spark, folder, "orders")
    nation = table(spark, folder, "nation")
    supplier = table(spark, folder, "supplier")
    part = table(spark, folder, "part")
    names = nation.selectExpr("n_nationkey AS id", "n_name AS nome")
    questions = range(1, 6)
    return {
        "ligacao": events.selectExpr(
            "event_id AS id",
            """CASE event_type WHEN 'view' THEN 'fila' WHEN 'click' THEN 'ramal'
               WHEN 'error' THEN 'atendimento fila' WHEN 'signup' THEN 'assistente de voz'
               ELSE 'externa' END AS tipo""",
            "event_id % 25 AS idfila",
            "user_id % 100 AS idusuario",
            "CASE WHEN k % 2 = 0 THEN event_id % 7 END AS idmailing",
            """CASE WHEN k % 4 <> 0 THEN 200 WHEN k % 3 = 0 THEN 303 WHEN k % 3 = 1 THEN 314
               ELSE 305 END AS idstatus""",
            """CASE k % 5 WHEN 0 THEN 201 WHEN 1 THEN 305 WHEN 2 THEN 314 WHEN 3 THEN NULL
               ELSE 203 END AS idstatusfinal""",
            "cast(floor(value) AS bigint) AS tempototal",
            """CASE WHEN k % 4 <> 0 THEN make_dt_interval(0, 0, 0, floor(value / 2) + user_id % 10 / 10)
               END AS tempoatendimento""",
            "ts AS datahora",
            "ts AS datahoraadd",
            """CASE WHEN k % 4 <> 0 THEN cast(date_trunc('hour', ts) AS timestamp_ntz)
               + make_dt_interval(0, 0, k % 4 * 10, 0) END AS datahoraatende""",
            "ts + make_dt_interval(0, 0, 0, floor(value)) AS datahorafim",
            "event_type AS origem",
            "concat('D', user_id) AS destino",
            "user_id % 5 AS idcentrocusto",
            "concat('U', event_id) AS uniqueid",
            "concat('L', user_id % 50, '-', date_format(ts, 'dd')) AS linkedid",
            """CASE k % 6
               WHEN 0 THEN concat('{"transferencia":{"tipo":"T', k, '","destino":"R', user_id, '"}}')
               WHEN 1 THEN concat('{"transferencia":{"tipo":"T', k, '","destino":""}}')
               WHEN 2 THEN concat('{"transferencia":"S', k, '","destino":"R', user_id, '"}')
               WHEN 3 THEN concat('{"transferencia":"S', k, '"}')
               WHEN 4 THEN concat('{"destino":"R', user_id, '"}')
               END AS extra""",
            "CASE WHEN k % 3 = 0 THEN event_id + 1 END AS idligextprincipal",
            "CASE WHEN k % 7 = 0 THEN event_id - 1 END AS idliganterior",
            "k % 30 AS idassistentevoz",
            "CASE WHEN k % 9 <> 0 THEN k % 50 END AS idcontatocanal",
        ),
        "custo": table(spark, folder, "region").selectExpr(
            "r_regionkey AS id", "r_name AS nome"
        ),
        "ligacaointerna": events.selectExpr("event_id * 3 AS id", "event_id AS idligacao"),
        "ligacaointernafila": events.selectExpr(
            "event_id * 3 AS idligacaointerna",
            "ts + make_dt_interval(0, 0, 0, k + user_id % 1000 / 1000) AS datahorafimespera",
            "CASE WHEN k % 2 = 0 THEN cast(k * 20 AS bigint) END AS nivelservico",
            "k % 2 = 0 AS atendeunivelservico",
            "cast(k + user_id % 8 / 8 AS decimal(9, 3)) AS tempototalhold",
            "cast(k * 2 AS bigint) AS tempototalmudo",
            "CASE WHEN k % 2 = 0 THEN k % 20 END AS idtemplateps",
            "k % 3 <> 1 AS pesquisasatisfacao",
        ),
        "fila": nation.selectExpr(
            "n_nationkey AS id",
            "n_name AS name",
            "n_nationkey % 5 AS tipofila",
            "n_nationkey * 10 + 5 AS servicelevel",
            *[f"concat('campo', {i}) AS campotab{i}" for i in range(1, 6)],
            "cast(NULL AS string) AS campotab6",
        ),
        "ligacaodiscador": orders.selectExpr(
            _missing("o_orderkey", "o_orderstatus = 'P'") + " AS idligacao",
            "o_orderpriority AS nomecampanha",
            "o_custkey AS idcampanha",
            "concat('list ', o_custkey % 9) AS nomemailing",
            "concat('{\"c\":', o_custkey, '}') AS campos_json",
            "CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus END AS campos",
        ),
        "usuario": supplier.selectExpr(
            _missing("s_suppkey", "s_acctbal > 500") + " AS id",
            "concat('M', s_suppkey) AS matricula", "s_name AS nome"
        ),
        "ura": part.selectExpr("p_partkey AS id", "p_name AS nome"),
        "ligacaotarifacao": orders.selectExpr(
            _missing("o_orderkey", "o_orderstatus = 'F'") + " AS idligacao",
            "o_custkey AS tempotarifado",
            "cast(o_totalprice AS decimal(18, 4)) AS valor",
        ),
        "ligacaoexterna": orders.selectExpr(
            _missing("o_orderkey", "o_orderpriority <> '5-LOW'") + " AS idligacao",
            "o_custkey % 30 AS idtronco",
        ),
        "tronco": names,
        "cc_tabulacao": table(spark, folder, "lineitem").selectExpr(
            "l_partkey AS id",
            _missing("l_orderkey", "l_returnflag = 'R'") + " AS idligacaoagente",
            _missing("l_orderkey + l_linenumber % 2", "l_returnflag = 'R'") + " AS idligacaofila",
            "l_linenumber AS idtipo",
            "l_suppkey % 40 AS idtipocampanha",
            "l_partkey % 40 AS idsubtipo",
            "l_suppkey % 7 AS idsubtipocampanha",
            "CASE WHEN l_linenumber = 3 THEN '' ELSE l_linestatus END AS obs",
            *[
                f"CASE WHEN (l_partkey + {i}) % 3 = 0 THEN '' WHEN (l_partkey + {i}) % 3 = 1"
                f" THEN concat('v', l_suppkey) END AS campo{i}"
                for i in range(1, 7)
            ],
            "l_shipdate AS datahoratabulacao",
            "cast(l_quantity AS bigint) AS tempotabulando",
        ),
        "tabulacaofila": names,
        "tabulacaocampanha": names,
        "subtabulacao": names,
        "subtabulacaocampanha": names,
        "templateps": part.selectExpr(
            "p_partkey AS id",
            "CASE WHEN p_partkey % 10 <> 8 THEN p_name END AS nome",
            "p_size % 6 AS numperguntas",
            "p_size % 2 AS respiniciaem0",
            *[
                f"CASE WHEN p_size % 6 < {i} THEN '' ELSE concat('Q', {i}) END AS txtpergunta{i}"
                for i in questions
            ],
            *[
                f"CASE WHEN p_size % 7 = {i} THEN '' ELSE 'a:b:c:d' END AS txtrespostas{i}"
                for i in questions
            ],
            *[f"(p_size + {i}) % 2 AS respemzero{i}" for i in questions],
        ),
        "pesquisasatisfacao": orders.selectExpr(
            "o_orderkey AS id",
            "o_orderkey AS idligacaoagente",
            "o_orderkey + o_custkey % 2 AS idligacaofila",
            "cast(o_custkey % 7 - 1 AS string) AS nota",
            *[
                f"cast((o_custkey + {i}) % 7 - 1 AS string) AS nota{i}"
                for i in questions
                if i > 1
            ],
        ),
        "desconexao": orders.selectExpr(
            "concat('U', " + _missing("o_orderkey", "o_orderpriority <> '1-URGENT'") + ") AS uniqueid",
            "cast(o_custkey % 5 AS string) AS quem",
        ),
        "contatocanal": supplier.selectExpr("s_suppkey AS id", "s_suppkey % 30 AS idcontato"),
        "contato": names,
    }


def _missing(key: str, when: str) -> str:
    """A key, negative where a condition fails, so that the row stays and its key meets none."""
    return f"CASE WHEN {when} THEN {key} ELSE -({key}) END"


def _split(columns: str) -> list[str]:
    """Expressions of a list; a comma inside brackets does not divide."""
    pieces, depth, start = [], 0, 0
    for i, ch in enumerate(columns):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            pieces.append(columns[start:i])
            start = i + 1
    return [p.strip() for p in [*pieces, columns[start:]]]


# The same sources for the SQL side: calls alone, all tables, and the legs put together, with
# one step for each question asked about a leg. Durations are in microseconds.
EVENT_SQL = """
    WITH e AS (
        SELECT event_id, user_id, event_type, value, ts, CAST(props->>'$.k' AS INT) AS k
        FROM events
    ), kinds AS (
        SELECT * FROM (VALUES ('view', 'fila'), ('click', 'ramal'), ('error', 'atendimento fila'),
                              ('signup', 'assistente de voz')) AS v(event_type, tipo)
    ), ligacao AS (
        SELECT event_id AS id, coalesce(kinds.tipo, 'externa') AS tipo,
               event_id % 25 AS idfila, user_id % 100 AS idusuario,
               if(k % 2 = 0, event_id % 7, NULL) AS idmailing,
               if(k % 4 <> 0, 200, [303, 314, 305][k % 3 + 1]) AS idstatus,
               [201, 305, 314, NULL, 203][k % 5 + 1] AS idstatusfinal,
               CAST(floor(value) AS BIGINT) * 1000000 AS tempototal,
               if(k % 4 <> 0, CAST(floor(value / 2) AS BIGINT) * 1000000 + user_id % 10 * 100000, NULL)
                   AS tempoatendimento,
               ts AS datahora,
               if(k % 4 <> 0, date_trunc('hour', ts) + to_minutes(k % 4 * 10), NULL)
                   AS datahoraatende,
               ts + to_seconds(floor(value)) AS datahorafim,
               event_type AS origem, 'D' || user_id AS destino,
               user_id % 5 AS idcentrocusto, 'U' || event_id AS uniqueid,
               format('L{}-{}', user_id % 50, strftime(ts, '%d')) AS linkedid,
               [format('{{"transferencia":{{"tipo":"T{}","destino":"R{}"}}}}', k, user_id),
                format('{{"transferencia":{{"tipo":"T{}","destino":""}}}}', k),
                format('{{"transferencia":"S{}","destino":"R{}"}}', k, user_id),
                format('{{"transferencia":"S{}"}}', k),
                format('{{"destino":"R{}"}}', user_id), NULL][k % 6 + 1] AS extra,
               if(k % 3 = 0, event_id + 1, NULL) AS idligextprincipal,
               if(k % 7 = 0, event_id - 1, NULL) AS idliganterior,
               k % 30 AS idassistentevoz, if(k % 9 <> 0, k % 50, NULL) AS idcontatocanal
        FROM e LEFT JOIN kinds USING (event_type)
    ), sides AS (
        SELECT tipo, quem, CASE WHEN tipo = 'ramal' THEN at_extension
                           WHEN quem > '2' OR contains(tipo, 'fila') THEN at_queue END AS side
        FROM (SELECT DISTINCT tipo FROM ligacao),
             (VALUES ('1', 'Operador', 'Contato'), ('2', 'Contato', 'Operador'),
                     ('3', 'Supervisor', 'Supervisor'), ('4', 'Sistema', 'Sistema')
             ) AS v(quem, at_extension, at_queue)
    ), queue_legs AS (
        SELECT agent.id, queue.uniqueid
        FROM (SELECT * FROM ligacao WHERE tipo = 'atendimento fila') AS agent
        JOIN (SELECT * FROM ligacao WHERE tipo = 'fila') AS queue USING (linkedid, datahoraatende)
        UNION ALL
        SELECT agent.id, queue.uniqueid
        FROM (SELECT * FROM ligacao WHERE tipo = 'atendimento fila') AS agent
        JOIN (SELECT * FROM ligacao WHERE tipo = 'fila') AS queue USING (linkedid, idstatusfinal)
        WHERE coalesce(agent.datahoraatende, queue.datahoraatende) IS NULL
    )"""
TABLE_SQL = EVENT_SQL + f""", waits AS (
        SELECT event_id AS id, ts + to_milliseconds(k * 1000 + user_id % 1000) AS datahorafimespera,
               if(k % 2 = 0, k * 20 * 1000000, NULL) AS nivelservico,
               k * 1000000 + user_id % 8 * 125000 AS hold, k * 2 * 1000000 AS mudo,
               if(k % 2 = 0, k % 20, NULL) AS idtemplateps, k % 3 <> 1 AS asked
        FROM e
    ), queues AS (
        SELECT n_nationkey AS idfila, n_name AS fila, n_nationkey % 5 AS tipofila,
               (n_nationkey * 10 + 5) * 1000000 AS servicelevel
        FROM nation WHERE n_nationkey % 5 BETWEEN 1 AND 3
    ), dialed AS (
        SELECT {_missing("o_orderkey", "o_orderstatus = 'P'")} AS id, o_orderpriority AS campanha,
               o_custkey AS idcampanha, 'list ' || (o_custkey % 9) AS mailing,
               '{{"c":' || o_custkey || '}}' AS campos_json,
               if(o_custkey % 2 = 0, o_orderstatus, NULL) AS campos
        FROM orders
    ), people AS (
        SELECT {_missing("s_suppkey", "s_acctbal > 500")} AS idusuario,
               'M' || s_suppkey AS matricula, s_name AS usuario
        FROM supplier
    ), billed AS (
        SELECT {_missing("o_orderkey", "o_orderstatus = 'F'")} AS id,
               o_custkey * 1000000 AS tempotarifado, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
        FROM orders
    ), nomes AS (SELECT n_nationkey AS id, n_name AS nome FROM nation
    ), trunks AS (
        SELECT {_missing("o_orderkey", "o_orderpriority <> '5-LOW'")} AS id, nome AS externo_tronco
        FROM orders LEFT JOIN nomes ON nomes.id = o_custkey % 30
    ), tabulated AS (
        SELECT unnest(list_distinct([{_missing("l_orderkey", "l_returnflag = 'R'")},
                   {_missing("l_orderkey + l_linenumber % 2", "l_returnflag = 'R'")}])) AS id,
               l_partkey AS t_id, if(l_linenumber = 3, '', l_linestatus) AS obs, l_suppkey AS campo,
               l_shipdate AS datahoratabulacao, CAST(l_quantity AS BIGINT) * 1000000 AS tempotabulando,
               label[l_linenumber] AS tf_nome, label[l_suppkey % 40] AS tbc_nome,
               label[l_partkey % 40] AS s_nome, label[l_suppkey % 7] AS sc_nome
        FROM lineitem, (SELECT map(list(id), list(nome)) AS label FROM nomes)
    ), templates AS (
        SELECT p_partkey AS idtemplateps, p_partkey AS pesquisafila,
               if(p_partkey % 10 <> 8, p_name, NULL) AS tps_nome,
               p_size AS tamanho, p_size % 2 AS respiniciaem0
        FROM part
    ), surveyed AS (
        SELECT unnest(list_distinct([o_orderkey, o_orderkey + o_custkey % 2])) AS id,
               o_orderkey AS idpesquisa, o_custkey AS base
        FROM orders
    ), ended AS (
        SELECT 'U' || {_missing("o_orderkey", "o_orderpriority <> '1-URGENT'")} AS uniqueid,
               CAST(o_custkey % 5 AS VARCHAR) AS quem
        FROM orders
    ), channels AS (
        SELECT s_suppkey AS idcontatocanal, nome AS nomecontato
        FROM supplier LEFT JOIN nomes ON nomes.id = s_suppkey % 30
    ), contact AS (
        SELECT ligacao.*, r_name AS centrocusto, queues.* EXCLUDE (idfila), waits.* EXCLUDE (id),
               epoch_us(datahorafimespera) - epoch_us(datahora) AS tempoespera
        FROM ligacao JOIN waits USING (id) JOIN queues USING (idfila)
        JOIN region ON r_regionkey = idcentrocusto
        WHERE datahora BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 23:59:59'
          AND tipo IN ('fila', 'atendimento fila', 'ramal')
    )"""
CALL_SQL = TABLE_SQL + """, survey AS (
        SELECT * FROM surveyed
        WHERE id IN (SELECT id FROM contact
                     WHERE idstatusfinal = 201 AND asked AND idtemplateps IS NOT NULL)
    ), hangup AS (
        SELECT id, tipo, quem FROM contact JOIN ended USING (uniqueid) WHERE tipo <> 'atendimento fila'
        UNION ALL
        SELECT queue_legs.id, 'atendimento fila', quem FROM queue_legs LEFT JOIN ended USING (uniqueid)
    ), outside AS (
        SELECT called.idligextprincipal, x.datahora AS x_datahora, x.datahoraatende AS x_datahoraatende,
               x.datahorafim AS x_datahorafim, x.tempototal AS x_tempototal,
               x.tempoatendimento AS x_tempoatendimento, tempotarifado, cents, externo_tronco
        FROM (SELECT DISTINCT idligextprincipal, idligextprincipal AS id FROM contact) AS called
        LEFT JOIN ligacao AS x USING (id) LEFT JOIN billed USING (id) LEFT JOIN trunks USING (id)
    ), assistant AS (
        SELECT id AS idliganterior, id AS a_id, p_name AS a_nome, datahora AS a_datahora,
               datahoraatende AS a_datahoraatende, datahorafim AS a_datahorafim,
               tempototal AS a_tempototal, tempoatendimento AS a_tempoatendimento
        FROM ligacao LEFT JOIN part ON p_partkey = idassistentevoz
        WHERE tipo = 'assistente de voz'
    ), legs AS (
        SELECT contact.*, dialed.* EXCLUDE (id), matricula, usuario, tabulated.* EXCLUDE (id),
               pesquisafila, tps_nome, tamanho, respiniciaem0, idpesquisa, base, quem, side,
               nomecontato, outside.* EXCLUDE (idligextprincipal), assistant.* EXCLUDE (idliganterior)
        FROM contact
        LEFT JOIN dialed USING (id)
        LEFT JOIN tabulated USING (id)
        LEFT JOIN survey USING (id)
        LEFT JOIN (SELECT id, quem, side FROM hangup LEFT JOIN sides USING (tipo, quem)) USING (id)
        LEFT JOIN people USING (idusuario)
        LEFT JOIN templates USING (idtemplateps)
        LEFT JOIN channels USING (idcontatocanal)
        LEFT JOIN outside USING (idligextprincipal)
        LEFT JOIN assistant USING (idliganterior)
    )"""
