"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringroster.spool import spooled


def _either(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Each row once for each pair of columns, as (u, v), made in one pass over the rows."""
    each = F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs])
    return rows.select(F.explode(each).alias("_e")).select("_e.u", "_e.v")


def _with_least(both: DataFrame) -> DataFrame:
    """Adds the least of a node and its neighbours, by a partial aggregate and a join that
    Spark can split for a node with very many neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("_u")).drop("_u")


def _large(edges: DataFrame) -> DataFrame:
    """At most one edge for each of `edges`; equal ones fall together in the small star."""
    met = _with_least(_either(edges, ("u", "v"), ("v", "u"))).where("v > u")
    return met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    met = _with_least(down)
    return _either(met, ("v", "m"), ("u", "m")).where("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every edge joins a node to a root: no node has two edges or is on both ends of
    some. That is what rounds end with, and one aggregate over narrow rows tells it."""
    marked = edges.withColumns({"up": F.lit(1).cast("long"), "down": F.lit(0).cast("long")})
    ends = _either(marked, ("u", "up"), ("v", "down"))
    nodes = ends.groupBy("u").agg(F.sum("v").alias("n"), F.min("v").alias("least"))
    return not nodes.where("n > 1 or (n = 1 and least = 0)").agg(F.count("*")).first()[0]


def stars(links: DataFrame, distinct: bool = False) -> DataFrame:
    """An edge (u, v) from each node in `links` (u, v) to the least node of its component, if
    that is another. Stars and further links have the components of all links.

    Links that are `distinct`, in either direction, and written already are not written again.
    Each round is written out, so a lost executor repeats one round at most."""
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    if not distinct:
        edges = spooled(edges.distinct())
    while not _settled(edges):
        edges = spooled(_small(_large(edges)))
    return edges


def rooted(edges: DataFrame) -> DataFrame:
    """node and root for every node of stars."""
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(own).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node of its component) for every node in `links` (u, v)."""
    return rooted(stars(links))
