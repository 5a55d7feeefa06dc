"""Filters, landing merges, windows, text and joins on the tables as they are."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import check, table
from ringroster.functions.dates import (
    date_text,
    day_plus_seconds,
    dayfirst_to_iso,
    month_start,
    stamp_iso,
    within_days_flag,
)
from ringroster.functions.durations import (
    clock_to_secs,
    epoch_secs,
    hm00_text,
    hms_text,
    hours_label,
    minutes_to_clock,
    secs_to_clock,
    shift_label,
    whole_secs,
)
from ringroster.functions.text import (
    concat_null,
    icontains,
    labelled_fields,
    left_chars,
    money_text,
    norm_upper,
    remove_literal,
    scrub_upper,
)
from ringroster.operators.aggregates import join_values, latest_value, offenders, pareto
from ringroster.operators.filters import (
    from_day,
    in_days,
    in_instants,
    latest_snapshot,
    none_of,
    one_of,
)
from ringroster.operators.joins import join_any_key, join_on_expr, join_roster, semi_by_keys
from ringroster.operators.landing import first_load, merge_keep_first, merge_keep_last
from ringroster.operators.ordering import sort_for_landing
from ringroster.operators.projections import select_as
from ringroster.operators.windows import (
    first_per_key,
    row_number_over_agg,
    with_global_row_number,
)
from ringroster.period import month_to_date

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


@check(
    "day_window",
    """
    SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'
    """,
)
def day_window(spark: SparkSession, folder: str) -> DataFrame:
    events = in_days(table(spark, folder, "events"), "ts", date(2024, 1, 5), date(2024, 1, 11))
    return events.select(*EVENT_COLUMNS, stamp_iso("ts").alias("ts_text"))


@check(
    "instant_window",
    """
    SELECT event_id, user_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts <= TIMESTAMP '2024-01-20 23:59:59'
    """,
)
def instant_window(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    start, end = datetime(2024, 1, 10, 6), datetime(2024, 1, 20, 23, 59, 59)
    return in_instants(events, "ts", start, end).select(*EVENT_COLUMNS)


@check(
    "open_window",
    """
    SELECT event_id, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month_start,
           '2024' AS period_year, '01' AS period_month
    FROM events WHERE ts >= date_trunc('month', DATE '2024-01-17')
    """,
)
def open_window(spark: SparkSession, folder: str) -> DataFrame:
    period = month_to_date(date(2024, 1, 17))
    return from_day(table(spark, folder, "events"), "ts", period.start).select(
        "event_id",
        date_text(month_start("ts"), "yyyy-MM-dd").alias("month_start"),
        F.lit(period.year_text).alias("period_year"),
        F.lit(period.month_text).alias("period_month"),
    )


@check(
    "outer_made_inner",
    """
    SELECT o.o_orderkey AS t_orderkey, o.o_orderstatus AS t_status, c.c_name AS d_name,
           c.c_mktsegment AS d_segment
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY')
    """,
)
def outer_made_inner(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    wanted = customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    joined = orders.join(wanted, orders.o_custkey == wanted.c_custkey, "inner")
    return select_as(
        joined,
        {
            "t_orderkey": "o_orderkey",
            "t_status": "o_orderstatus",
            "d_name": "c_name",
            "d_segment": "c_mktsegment",
        },
    )


def _history_and_new(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The first half of the month as landed earlier; all events, with other values, as new."""
    events = table(spark, folder, "events").withColumn("day", date_text("ts", "yyyy-MM-dd"))
    events = events.select("event_id", "user_id", "event_type", "day", "value")
    history = events.where(F.col("day") <= "2024-01-15")
    return history, events.withColumn("value", F.col("value") + 1000)


_BOTH = """
    WITH e AS (
        SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day, value FROM events
    ), b AS (
        SELECT *, 0 AS src FROM e WHERE day <= '2024-01-15'
        UNION ALL
        SELECT event_id, user_id, event_type, day, value + 1000, 1 FROM e
    )
"""


@check(
    "merge_keep_first",
    _BOTH
    + """
    SELECT event_id, user_id, event_type, day, value FROM b
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY src, event_id) = 1
    """,
)
def keep_first(spark: SparkSession, folder: str) -> DataFrame:
    history, new = _history_and_new(spark, folder)
    return merge_keep_first(history, new, ["user_id", "event_type", "day"], ["event_id"])


@check(
    "merge_keep_last",
    _BOTH
    + """
    SELECT event_id, user_id, event_type, day, value FROM b
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY src DESC, day DESC) = 1
    """,
)
def keep_last(spark: SparkSession, folder: str) -> DataFrame:
    history, new = _history_and_new(spark, folder)
    return merge_keep_last(history, new, ["event_id"], ["day"])


@check(
    "append_to_unique_history",
    """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'landed' ELSE 'new' END AS origin
    FROM orders
    """,
)
def append_unique(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    landed = orders.where(F.col("o_orderdate") < F.lit(date(1998, 1, 1)))
    history = landed.select("o_orderkey", "o_custkey", F.lit("landed").alias("origin"))
    new = orders.select("o_orderkey", "o_custkey", F.lit("new").alias("origin"))
    return merge_keep_first(history, new, ["o_orderkey"], ["o_custkey"], unique_history=True)


@check(
    "upsert_unique_history",
    """
    WITH n AS (
        SELECT CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE -l_suppkey END AS key,
               l_orderkey, l_linenumber, 'new' AS origin
        FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY key ORDER BY l_orderkey DESC, l_linenumber DESC) = 1
    )
    SELECT * FROM n UNION ALL
    SELECT s_suppkey, NULL, NULL, 'landed' FROM supplier WHERE s_suppkey NOT IN (SELECT key FROM n)
    """,
)
def upsert_unique(spark: SparkSession, folder: str) -> DataFrame:
    history = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("key"), F.lit("landed").alias("origin")
    )
    known = F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")).otherwise(-F.col("l_suppkey"))
    new = table(spark, folder, "lineitem").select(
        known.alias("key"), "l_orderkey", "l_linenumber", F.lit("new").alias("origin")
    )
    order = ["l_orderkey", "l_linenumber"]
    return merge_keep_last(history, new, ["key"], order, unique_history=True)


@check(
    "first_load_then_merge",
    """
    WITH f AS (
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, 0 AS src
        FROM lineitem WHERE l_returnflag = 'A'
        UNION ALL
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, 1 FROM lineitem
    )
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM f
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY src, l_partkey, l_suppkey, l_quantity
    ) = 1
    """,
)
def first_load_then_merge(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    keys = ["l_orderkey", "l_linenumber"]
    landed = first_load(lines.where(F.col("l_returnflag") == "A"), keys=keys)
    merged = merge_keep_first(
        landed.drop("l_returnflag"),
        lines.drop("l_returnflag"),
        keys,
        ["l_partkey", "l_suppkey", "l_quantity"],
    )
    return sort_for_landing(merged, keys)


@check(
    "snapshot_latest",
    """
    SELECT DISTINCT o_custkey, upper(trim(o_orderpriority)) AS priority,
           strftime(o_orderdate, '%Y-%m-%d') AS day
    FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
      AND o_orderpriority <> '5-LOW'
    """,
)
def snapshot_latest(spark: SparkSession, folder: str) -> DataFrame:
    newest = latest_snapshot(table(spark, folder, "orders"), "o_orderdate")
    return (
        newest.where(F.col("o_orderpriority") != "5-LOW")
        .select(
            "o_custkey",
            norm_upper("o_orderpriority").alias("priority"),
            date_text("o_orderdate", "yyyy-MM-dd").alias("day"),
        )
        .distinct()
    )


@check(
    "latest_value",
    "SELECT strftime(max(l_shipdate), '%Y-%m-%d') AS latest FROM lineitem",
)
def latest(spark: SparkSession, folder: str) -> DataFrame:
    newest = latest_value(table(spark, folder, "lineitem"), "l_shipdate", "latest")
    return newest.select(date_text("latest", "yyyy-MM-dd").alias("latest"))


COLLATION = "UTF8_LCASE_RTRIM"


@check(
    "collated_texts",
    """
    WITH p AS (
        SELECT p_partkey, p_type, CASE p_partkey % 4 WHEN 0 THEN upper(p_brand) WHEN 1 THEN lower(p_brand) || '  '
               WHEN 2 THEN p_brand || ' ' ELSE p_brand END AS brand FROM part
    ), o AS (
        SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lower('Brand#' || c_custkey % 30)
               ELSE 'BRAND#' || c_custkey % 30 || ' ' END AS wanted FROM customer
    )
    SELECT p_partkey, brand, c_custkey, replace(upper(p_type), 'STEEL', '') AS metal
    FROM p JOIN o ON lower(rtrim(brand)) = lower(rtrim(wanted))
    WHERE lower(rtrim(brand)) IN ('brand#1', 'brand#7', 'brand#12', 'brand#25')
      AND lower(rtrim(brand)) <> 'brand#7'
    """,
)
def collated_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Membership, inequality, replacement and a join that see neither case nor trailing blanks."""
    written = """CASE p_partkey % 4 WHEN 0 THEN upper(p_brand) WHEN 1 THEN concat(lower(p_brand), '  ')
                 WHEN 2 THEN concat(p_brand, ' ') ELSE p_brand END AS brand"""
    parts = table(spark, folder, "part").selectExpr("p_partkey", "p_type", written)
    parts = parts.where(
        one_of("brand", ["BRAND#1", "brand#7 ", "Brand#12", "bRAND#25"], COLLATION)
        & none_of("brand", ["BRAND#7  "], COLLATION)
    )
    wanted = """CASE c_custkey % 3 WHEN 0 THEN lower(concat('Brand#', c_custkey % 30))
                ELSE concat('BRAND#', c_custkey % 30, ' ') END AS wanted"""
    people = table(spark, folder, "customer").selectExpr("c_custkey", wanted)
    # a part meets very many people, so its texts are made before
    parts = parts.select(
        "p_partkey", "brand", F.upper(remove_literal("p_type", "Steel", "UTF8_LCASE")).alias("metal")
    )
    joined = join_roster(parts, people, "brand", "wanted", COLLATION, many=True)
    return joined.select("p_partkey", "brand", "c_custkey", "metal")


@check(
    "exclude_lists",
    """
    SELECT p_partkey, p_name, p_brand, p_type FROM part
    WHERE p_brand NOT IN ('Brand#1', 'Brand#7', 'Brand#25') AND p_type <> 'PROMO'
      AND p_name NOT LIKE '%ring%' AND p_name LIKE '%e%' AND p_size IS NOT NULL
    """,
)
def exclude_lists(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return part.where(
        none_of("p_brand", ["Brand#1", "Brand#7", "Brand#25"])
        & (F.col("p_type") != "PROMO")
        & ~F.contains("p_name", F.lit("ring"))
        & icontains("p_name", "E")
        & F.col("p_size").isNotNull()
    ).select("p_partkey", "p_name", "p_brand", "p_type")


@check(
    "first_per_key",
    """
    SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey
    ) = 1
    """,
)
def first_line(spark: SparkSession, folder: str) -> DataFrame:
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    first = first_per_key(table(spark, folder, "lineitem"), ["l_orderkey"], order)
    return first.select("l_orderkey", "l_partkey", "l_linenumber")


@check(
    "sla_flag",
    """
    SELECT o_orderkey, l_linenumber, l_partkey,
           CASE WHEN date_diff('day', o_orderdate, l_shipdate) <= 5 THEN 1 ELSE 0 END AS in_sla
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """,
)
def sla_flag(spark: SparkSession, folder: str) -> DataFrame:
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey)
    return joined.select(
        "o_orderkey",
        "l_linenumber",
        "l_partkey",
        within_days_flag("o_orderdate", "l_shipdate", 5).alias("in_sla"),
    )


@check(
    "date_plus_time",
    """
    SELECT o_orderkey,
           strftime(CAST(o_orderdate AS DATE) + to_seconds(o_orderkey * 37 % 86400),
                    '%Y-%m-%d %H:%M:%S') AS entered
    FROM orders
    """,
)
def date_plus_time(spark: SparkSession, folder: str) -> DataFrame:
    secs = F.col("o_orderkey") * 37 % 86400
    entered = stamp_iso(day_plus_seconds("o_orderdate", secs))
    return table(spark, folder, "orders").select("o_orderkey", entered.alias("entered"))


@check(
    "dayfirst_text",
    """
    WITH t AS (
        SELECT o_orderkey, CASE o_orderkey % 4
            WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
            WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y') || ' 10:11:12'
            WHEN 2 THEN '99/' || strftime(o_orderdate, '%m/%Y')
            ELSE NULL END AS raw
        FROM orders
    )
    SELECT o_orderkey, strftime(coalesce(try_strptime(raw, '%d/%m/%Y'),
           try_strptime(raw, '%d/%m/%Y %H:%M:%S')), '%Y-%m-%d %H:%M:%S') AS iso
    FROM t
    """,
)
def dayfirst_text(spark: SparkSession, folder: str) -> DataFrame:
    day = date_text("o_orderdate")
    turn = F.col("o_orderkey") % 4
    raw = (
        F.when(turn == 0, day)
        .when(turn == 1, F.concat(day, F.lit(" 10:11:12")))
        .when(turn == 2, F.concat(F.lit("99/"), date_text("o_orderdate", "MM/yyyy")))
    )
    return table(spark, folder, "orders").select("o_orderkey", dayfirst_to_iso(raw).alias("iso"))


@check(
    "scrub_text",
    """
    -- this engine upper-cases the sharp s to one letter, Spark to two
    SELECT doc_id, lang, md5(replace(upper(trim(replace(replace(replace(replace(text,
           chr(160), ' '), chr(9), ''), chr(13), ''), chr(10), ''))), chr(7838), 'SS'))
           AS scrubbed_md5
    FROM documents
    """,
)
def scrub_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", "lang", F.md5(scrub_upper("text")).alias("scrubbed_md5")
    )


@check(
    "text_pieces",
    """
    WITH b AS (
        SELECT string_agg(p_brand, ', ' ORDER BY p_brand) AS brands
        FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)
    )
    SELECT p_partkey, lower(p_type) AS type_lower, replace(p_brand, 'Brand#', '') AS brand_no,
           lower(left(p_type, 3)) AS type3, upper(p_name) AS name_upper, brands
    FROM part, b
    """,
)
def text_pieces(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    brands = join_values(part, "p_brand", "brands").scalar()
    return part.select(
        "p_partkey",
        F.lower("p_type").alias("type_lower"),
        remove_literal("p_brand", "Brand#").alias("brand_no"),
        F.lower(left_chars("p_type", 3)).alias("type3"),
        F.upper("p_name").alias("name_upper"),
        brands.alias("brands"),
    )


@check(
    "labelled_fields",
    """
    SELECT p_partkey,
           concat_ws(' - ', 'brand: ' || nullif(p_brand, 'Brand#1'),
                     'type: ' || nullif(p_type, 'PROMO'), 'size: ' || CAST(p_size AS VARCHAR)) AS fields,
           p_name || ' / ' || nullif(p_type, 'PROMO') AS pair
    FROM part
    """,
)
def fields(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.nullif(F.col("p_brand"), F.lit("Brand#1"))
    kind = F.nullif(F.col("p_type"), F.lit("PROMO"))
    size = F.col("p_size").cast("string")
    return table(spark, folder, "part").select(
        "p_partkey",
        labelled_fields(
            [(F.lit("brand"), brand), (F.lit("type"), kind), (F.lit("size"), size)]
        ).alias("fields"),
        concat_null("p_name", F.lit(" / "), kind).alias("pair"),
    )


@check(
    "any_key_join",
    """
    SELECT p.p_partkey, count(l.l_orderkey) AS n,
           CAST(coalesce(sum(CAST(l.l_quantity AS BIGINT)), 0) AS BIGINT) AS qty
    FROM part p LEFT JOIN (
        SELECT p_partkey AS k, l.* FROM lineitem l JOIN part ON p_partkey = l_partkey
        UNION
        SELECT p_partkey AS k, l.* FROM lineitem l JOIN part ON p_partkey = l_suppkey
    ) l ON l.k = p.p_partkey AND p.p_size > 10
    GROUP BY p.p_partkey
    """,
)
def any_key(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity"
    )
    joined = join_any_key(
        part, lines, "p_partkey", ["l_partkey", "l_suppkey"], left_pred=F.col("p_size") > 10
    )
    return joined.groupBy("p_partkey").agg(
        F.count("l_orderkey").alias("n"),
        F.coalesce(F.sum(F.col("l_quantity").cast("bigint")), F.lit(0)).alias("qty"),
    )


@check(
    "expr_key_join",
    """
    SELECT e.event_id, e.event_type, c.c_name
    FROM events e LEFT JOIN customer c ON CASE e.event_type WHEN 'error' THEN NULL
         WHEN 'view' THEN e.user_id ELSE e.event_id % 2000 END = c.c_custkey
    """,
)
def expr_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type", "user_id")
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    key = F.when(F.col("event_type") == "error", F.lit(None)).when(
        F.col("event_type") == "view", F.col("user_id")
    )
    key = key.otherwise(F.col("event_id") % 2000)
    return join_on_expr(events, customer, key, "c_custkey", ["event_id"]).select(
        "event_id", "event_type", "c_name"
    )


@check(
    "semi_keys",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (
        SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'
    )
    """,
)
def semi_keys(spark: SparkSession, folder: str) -> DataFrame:
    urgent = table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return semi_by_keys(lines, urgent, "l_orderkey", "o_orderkey")


@check(
    "global_row_number",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS detalhe FROM events",
)
def global_row_number(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts")
    return with_global_row_number(events, ["ts", "event_id"], "detalhe").drop("ts")


@check(
    "row_number_over_agg",
    """
    WITH g AS (SELECT p_brand, max(p_type) AS top_type FROM part GROUP BY p_brand)
    SELECT p_brand, top_type, row_number() OVER (ORDER BY top_type, p_brand) AS linha FROM g
    """,
)
def number_groups(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return row_number_over_agg(part, ["p_brand"], F.max("p_type"), "top_type", "linha")


_PARETO = """
    WITH c AS (
        SELECT {reason} AS "Motivo", count(*) AS "Qtd" FROM {table}
        WHERE {reason} IS NOT NULL GROUP BY 1
    ), p AS (
        SELECT *, sum("Qtd") OVER (ORDER BY "Qtd" DESC, "Motivo") AS run,
               sum("Qtd") OVER () AS total
        FROM c
    )
    SELECT "Motivo", "Qtd", round(run / total * 100, 6) AS "Acumulado_%" FROM p
"""


@check("pareto_brands", _PARETO.format(reason="p_brand", table="part"))
def pareto_brands(spark: SparkSession, folder: str) -> DataFrame:
    reasons = pareto(table(spark, folder, "part"), "p_brand")
    return reasons.withColumn("Acumulado_%", F.round("`Acumulado_%`", 6))


@check(
    "pareto_offenders",
    _PARETO.format(reason="o_custkey", table="orders") + "WHERE run / total * 100 <= 85",
)
def pareto_customers(spark: SparkSession, folder: str) -> DataFrame:
    reasons = offenders(pareto(table(spark, folder, "orders"), "o_custkey"), 85)
    return reasons.withColumn("Acumulado_%", F.round("`Acumulado_%`", 6))


@check(
    "currency_text",
    """
    WITH c AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
    SELECT o_orderkey,
           'R$' || format('{:,}', cents // 100) || '.' || printf('%02d', cents % 100) || '00' AS price
    FROM c
    """,
)
def currency(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", money_text("o_totalprice").alias("price")
    )


@check(
    "duration_labels",
    """
    WITH s AS (
        SELECT o_orderkey, (o_orderkey * 7919) % 200000 AS secs, o_orderkey % 1440 AS mins,
               (o_orderkey * 60) % 86400 AS a, (o_orderkey * 420) % 86400 AS b
        FROM orders
    )
    SELECT o_orderkey,
           printf('%02d:%02d:%02d', secs // 3600, secs // 60 % 60, secs % 60) AS hms,
           secs % 86400 AS clock_secs,
           secs AS epoch, secs AS whole,
           printf('%02d:%02d:00.0000000', mins // 60, mins % 60) AS punch,
           CASE WHEN secs // 60 % 60 = 0 THEN printf('%dH', secs // 3600)
                ELSE printf('%dH:%02d', secs // 3600, secs // 60 % 60) END AS load_label,
           CASE WHEN a // 60 % 60 = 0 THEN printf('%02dH', a // 3600)
                ELSE printf('%02dH:%02d', a // 3600, a // 60 % 60) END || ' - ' ||
           CASE WHEN b // 60 % 60 = 0 THEN printf('%02dH', b // 3600)
                ELSE printf('%02dH:%02d', b // 3600, b // 60 % 60) END AS shift,
           printf('%02d:%02d:00', secs // 3600 % 24, secs // 60 % 60) AS hm00,
           secs AS parsed
    FROM s
    """,
)
def duration_labels(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    base = table(spark, folder, "orders").select(
        "o_orderkey",
        (key * 7919 % 200000).alias("secs"),
        (key % 1440).alias("mins"),
        (key * 60 % 86400).alias("a"),
        (key * 420 % 86400).alias("b"),
    )
    zero = F.lit(0)
    return base.select(
        "o_orderkey",
        hms_text("secs").alias("hms"),
        secs_to_clock("secs").alias("clock_secs"),
        epoch_secs(F.make_dt_interval(zero, zero, zero, F.col("secs"))).alias("epoch"),
        whole_secs(F.col("secs") + F.lit(0.75)).alias("whole"),
        minutes_to_clock("mins").alias("punch"),
        hours_label("secs").alias("load_label"),
        shift_label("a", "b").alias("shift"),
        hm00_text("secs").alias("hm00"),
        clock_to_secs(hms_text("secs")).alias("parsed"),
    )
