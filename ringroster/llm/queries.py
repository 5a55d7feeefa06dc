"""Queries over the `documents` and `embeddings` tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringroster.llm import (
    centroids,
    interpolation,
    jaccard_join,
    language,
    lexical,
    licenses,
    mixing,
    packing,
    preference,
    quality,
    sharding,
    token_files,
    topk,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_documents(spark, folder)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.linked(_documents(spark, folder), words=4, percent=85).select(
        "doc_id", "n_shingles", "component_id"
    )


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_documents(spark, folder)).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        "doc_tokens", "sequence_id", "offset",
    )


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(_documents(spark, folder))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(_documents(spark, folder)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(_documents(spark, folder)).drop("_tag")


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identified(_documents(spark, folder)).drop("_tag")


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(_documents(spark, folder))


def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return interpolation.scored(_documents(spark, folder))


def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return lexical.ranked_documents(_documents(spark, folder), items)


def op12_preference(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return preference.scored(_documents(spark, folder), labels)


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clustered(spark.read.parquet(f"{folder}/embeddings.parquet"))


def _centroid_sql(rounds: int = centroids.ROUNDS, k: int = centroids.K) -> str:
    """One step of SQL per round."""
    nearest = """
        SELECT i, vec_id, w, c, d FROM (
            SELECT v.i, v.vec_id, v.w, m.c, row_number() OVER (PARTITION BY v.i ORDER BY d, m.c) AS n, d
            FROM v, {centres} AS m, LATERAL (SELECT list_sum(list_transform(
                list_zip(v.w, m.w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d)
        ) WHERE n = 1"""
    steps = [f"""
        v AS MATERIALIZED (
            SELECT row_number() OVER () AS i, vec_id,
                   list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS w
            FROM embeddings
            WHERE len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), m0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, w) - 1 AS c, w
            FROM (SELECT sha256('3:' || vec_id) AS h, w FROM v) ORDER BY h, w LIMIT {k}
        )"""]
    for n in range(rounds):
        steps.append(f"""
        a{n} AS MATERIALIZED ({nearest.format(centres=f"m{n}")}
        ), s{n} AS MATERIALIZED (
            SELECT c, list(x ORDER BY j) AS w FROM (
                SELECT c, j, floor(sum(x) / count(*))::BIGINT AS x
                FROM (SELECT c, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM a{n}) GROUP BY c, j
            ) GROUP BY c
        ), m{n + 1} AS MATERIALIZED (
            SELECT m{n}.c, coalesce(s{n}.w, m{n}.w) AS w FROM m{n} LEFT JOIN s{n} USING (c)
        )""")
    return f"""
        WITH {",".join(steps)}, f AS MATERIALIZED ({nearest.format(centres=f"m{rounds}")})
        SELECT vec_id, f.c::INT AS cluster, d AS distance,
               (sum(d) OVER (PARTITION BY f.c))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(m.w, ',')) AS centroid_sha256
        FROM f JOIN m{rounds} AS m ON m.c = f.c
    """


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_mixing, op2_jaccard_join, op3_packing, op4_token_files, op5_sharding, op6_quality_rules, op7_language_id, op8_license_scan, op9_lm_scores, op10_topk, op11_lexical_search, op12_preference, op13_centroids)
}
SQL: dict[str, str] = {
    "op2_jaccard_join": """
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2),
                                                  lambda i: array_to_string(w[i:i + 3], ' ')))
                END AS s
            FROM words
        ), items AS (
            SELECT doc_id, unnest(s) AS item FROM sets
        ), shared AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
            FROM items AS a JOIN items AS b ON a.item = b.item AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id
        ), links AS (
            SELECT u, v FROM shared JOIN sets AS x ON x.doc_id = u JOIN sets AS y ON y.doc_id = v
            WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)
        ), ways AS (
            SELECT u, v FROM links UNION ALL SELECT v, u FROM links
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT r.doc_id, w.v FROM reach AS r JOIN ways AS w ON w.u = r.other
        )
        SELECT sets.doc_id, len(any_value(s)) AS n_shingles, min(other) AS component_id
        FROM sets JOIN reach ON reach.doc_id = sets.doc_id
        GROUP BY sets.doc_id
    """,
    "op10_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n
            FROM scored
        )
        SELECT query_id, n::INT AS rank, vec_id, score FROM placed WHERE n <= 5
    """,
    "op11_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), sizes AS (
            SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0
        ), total AS (
            SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sizes
        ), items AS (
            SELECT item_id, row_number() OVER () AS i, unnest(list_distinct(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
            FROM (SELECT DISTINCT item_id, text FROM benchmark)
        ), words AS (
            SELECT r, unnest(w) AS term FROM d
        ), postings AS (
            SELECT r, term, count(*)::BIGINT AS tf FROM words
            WHERE term IN (SELECT term FROM items) GROUP BY r, term
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
            FROM postings, total GROUP BY term
        ), parts AS (
            SELECT p.r, doc_id, term,
                   (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)) AS part
            FROM postings AS p JOIN sizes USING (r), total
        ), scored AS (
            SELECT i, item_id, r, doc_id, sum(weight * part)::BIGINT AS score
            FROM items JOIN weights USING (term) JOIN parts USING (term)
            GROUP BY i, item_id, r, doc_id
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS n
            FROM scored WHERE score > 0
        )
        SELECT item_id, n::INT AS rank, doc_id, score FROM placed WHERE n <= 10
    """,
    "op13_centroids": _centroid_sql(),
}
