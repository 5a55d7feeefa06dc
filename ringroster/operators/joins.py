"""Joins.

No broadcast hints: whether a side is broadcast is left to Spark, which compares the
side's size with `spark.sql.autoBroadcastJoinThreshold` when planning and again, with
measured sizes, at run time. Sides above it are joined by shuffle, where adaptive skew
handling splits hot keys; `skew` takes apart the left joins which that cannot split.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringroster.functions import ColumnLike, as_column
from ringroster.functions.text import collated, key_text, norm_upper
from ringroster.operators.skew import (
    exact_left_join,
    spread_part,
    split_left_join,
    split_many_join,
    zero_part,
)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: ColumnLike,
    dim_key: str,
    how: str = "left",
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Join a table on one key. Column names of the two sides must not clash.

    Where the key of a left join may be NULL, `spread_by` names columns that tell the rows
    apart; rows without a key are dealt out by them and do not meet in one task.
    """
    key = as_column(key)
    if not spread_by or how != "left":
        return df.join(dim, key == dim[dim_key], how)
    parted = df.withColumn("_part", spread_part(key, spread_by))
    dim = dim.withColumn("_dim_part", zero_part(dim_key))
    on = (key == dim[dim_key]) & (F.col("_part") == F.col("_dim_part"))
    return parted.join(dim, on, "left").drop("_part", "_dim_part")


def fan_out(base: DataFrame, rows: DataFrame, key: str, rows_key: str) -> DataFrame:
    """Left join of base rows to their many detail rows.

    The two tables may both be large, and one base row may own a large part of the detail
    rows, so hot keys of the detail table are split.
    """
    kept = rows.withColumn("_rows_key", F.col(rows_key))
    return exact_left_join(base, kept, key, "_rows_key", [key])


def person_names(
    users: DataFrame,
    people: DataFrame,
    user_id: str = "Id",
    person_fk: str = "FkPessoa",
    person_id: str = "Id",
    person_name: str = "Nome",
) -> DataFrame:
    """User id and normalised person name; users without a person keep a NULL name."""
    u = users.select(F.col(user_id).alias("_user"), F.col(person_fk).alias("_person_fk"))
    p = people.select(F.col(person_id).alias("_person"), F.col(person_name).alias("_name"))
    return u.join(p, u._person_fk == p._person, "left").select(
        "_user", norm_upper("_name").alias("_user_name")
    )


def with_person_name(
    df: DataFrame,
    users: DataFrame,
    people: DataFrame,
    fk: ColumnLike,
    output: str,
    how: str = "left",
    spread_by: Sequence[str] = (),
    **names: str,
) -> DataFrame:
    """Resolve fact -> user -> person into one name column.

    The two small tables are joined to each other first, so the fact table takes part in
    one join and is shuffled at most once. `spread_by` is that of `lookup`.
    """
    resolved = person_names(users, people, **names)
    joined = lookup(df, resolved, fk, "_user", how, spread_by)
    if how == "inner":
        joined = joined.where(F.col("_user_name").isNotNull())
    return joined.withColumnRenamed("_user_name", output).drop("_user")


def self_parent(
    df: DataFrame,
    fk: str,
    parent_columns: dict[str, str],
    key: str = "id",
    parent_pred: Column | None = None,
) -> DataFrame:
    """Left self join child -> parent. `parent_columns` maps parent column to its output
    name; `parent_pred` filters parents only, so every child stays."""
    parents = df if parent_pred is None else df.where(parent_pred)
    parents = parents.select(
        F.col(key).alias("_parent"), *[F.col(c).alias(o) for c, o in parent_columns.items()]
    )
    return split_left_join(df, [(parents, "_parent")], fk, spread_by=[key])


def answer_key(answered_at: ColumnLike, final_status: ColumnLike) -> Column:
    """Equal for two legs of one contact: the answer time, or for unanswered legs the
    final status. NULL, hence equal to nothing, when that status is unknown."""
    answered_at = as_column(answered_at)
    return F.when(
        answered_at.isNotNull(), F.concat(F.lit("answered "), answered_at.cast("string"))
    ).otherwise(F.concat(F.lit("status "), as_column(final_status).cast("string")))


def link_queue_leg(
    legs: DataFrame,
    queue_columns: dict[str, str],
    key: str = "id",
    link: str = "linkedid",
    kind: str = "tipo",
    answered_at: str = "datahoraatende",
    final_status: str = "idstatusfinal",
    agent_kind: str = "atendimento fila",
    queue_kind: str = "fila",
    calls: DataFrame | None = None,
) -> DataFrame:
    """Left join of each agent leg to the queue legs of the same contact.

    The conditional match is turned into one computed key, so the join is an equi-join on
    (link, answer key) and never pairs all legs of a link. Legs of other kinds are kept
    without a match.
    """
    leg_key = F.concat(F.col(link), F.lit(" "), answer_key(answered_at, final_status))
    queue = (
        (legs if calls is None else calls)
        .where((F.col(kind) == queue_kind) & leg_key.isNotNull())
        .select(
            leg_key.alias("_queue_leg"), *[F.col(c).alias(o) for c, o in queue_columns.items()]
        )
    )
    return exact_left_join(
        legs, queue, leg_key, "_queue_leg", [key], left_pred=F.col(kind) == agent_kind
    )


def any_key_rows(right: DataFrame, keys: Sequence[str], output: str = "_any_key") -> DataFrame:
    """One row per distinct non-null key among `keys`."""
    # plain conditions are compiled, functions of arrays with a lambda are not
    found = []
    for i, key in enumerate(keys):
        earlier = [F.col(key) == F.col(k) for k in keys[:i]]
        repeated = reduce(operator.or_, earlier) if earlier else F.lit(False)
        found.append(F.when(F.coalesce(repeated, F.lit(False)), None).otherwise(F.col(key)))
    return right.withColumn(output, F.explode(F.array(*found))).where(F.col(output).isNotNull())


def join_any_key(
    left: DataFrame,
    right: DataFrame,
    key: str,
    right_keys: Sequence[str],
    how: str = "left",
    left_pred: Column | None = None,
) -> DataFrame:
    """Join on `key IN (right_keys)`, planned as an equi-join.

    A right row is repeated once per distinct key, so a left row meets it at most once, as
    under the IN condition. `left_pred` belongs to the ON clause.
    """
    exploded = any_key_rows(right, right_keys)
    if how == "left":
        return exact_left_join(left, exploded, key, "_any_key", [key], left_pred)
    condition = left[key] == exploded["_any_key"]
    if left_pred is not None:
        condition = condition & left_pred
    return left.join(exploded, condition, how).drop("_any_key")


def join_on_expr(
    left: DataFrame, right: DataFrame, expr: Column, right_key: str, spread_by: Sequence[str]
) -> DataFrame:
    """Left join on a computed key of the left side; the right key column is dropped."""
    return exact_left_join(left, right, expr, right_key, spread_by)


def join_roster(
    roster: DataFrame,
    register: DataFrame,
    roster_key: str,
    register_key: str,
    collation: str | None = None,
    many: bool = False,
) -> DataFrame:
    """Inner join on both keys as text; both keys stay, a NULL key matches nothing.

    `many` says that few keys may have very many rows on both sides."""

    def as_text(df: DataFrame, name: str) -> DataFrame:
        kind = df.schema[name].dataType
        fractional = isinstance(kind, T.FloatType | T.DoubleType | T.DecimalType)
        return df.withColumn(name, key_text(name, fractional))

    left, right = as_text(roster, roster_key), as_text(register, register_key)
    if many:
        keys = [collated(c, collation) for c in (roster_key, register_key)]
        return split_many_join(left, right, *keys)
    same = collated(left[roster_key], collation) == collated(right[register_key], collation)
    return left.join(right, same, "inner")


def semi_by_keys(df: DataFrame, keys: DataFrame, key: str, keys_col: str) -> DataFrame:
    """Rows whose key occurs in another dataset. The keys are made distinct before any
    shuffle and never collected."""
    wanted = keys.select(F.col(keys_col).alias("_wanted")).dropna().distinct()
    return df.join(wanted, df[key] == wanted._wanted, "left_semi")
