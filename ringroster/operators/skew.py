"""Left joins of large tables.

At run time Spark splits a hot key on either side of an inner join, and on the left side of
a left join, where both sides come from a shuffle of their own. It cannot split one on the
right side of a left join, nor on the left of joins that share one shuffle. The joins here are
put so that it can, and read their left side once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringroster.functions import ColumnLike, as_column

LONERS = 1024  # groups that left rows without a partner are dealt to
DEALS = 16  # parts that the rows of one key are dealt to, if they are neither small nor large then
SMALL_PART, LARGE_PART = 32, 65536  # rows
BLOCK = 256  # rows that pass together; a multiple of 8, so that packed bits repeat in whole bytes
CELL_TASKS = 128  # partitions that pairs of parts are dealt to, or as many as the session has

Right = tuple[DataFrame, str] | tuple[DataFrame, str, Column | None]


def spread_part(key: Column, spread_by: Sequence[str]) -> Column:
    """Second key part: 0 for a key, a hash for none, so rows without one do not meet."""
    spread = F.hash(*spread_by) if spread_by else F.lit(0)
    return F.when(key.isNull(), spread).otherwise(0)


def zero_part(right_key: str) -> Column:
    """The part of a right key, which is never spread."""
    # pmod(.., 1) is 0 but no constant, so the optimizer keeps it as a join key
    return F.pmod(F.hash(right_key), F.lit(1))


def _any_value(kind: T.DataType) -> Column:
    """Some value of a type, for rows whose key does not matter."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.lit("").cast(kind)
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return F.lit("1970-01-01").cast(kind)
    return F.lit(0).cast(kind)


def _meet(
    joined: DataFrame, right: DataFrame, right_key: str, key: Column, met: Column, spread: Column
) -> DataFrame:
    """Each left row with its right rows or, where `met` does not hold, with none.

    Left rows without a partner meet one of LONERS rows of nulls that are added to the right
    side, so the join is an inner one, which can be split on both sides.
    """
    spark = right.sparkSession
    kind = right.schema[right_key].dataType
    value = _any_value(kind)
    own = right.columns
    loner = F.pmod(spread, F.lit(LONERS)) + 1
    left = joined.withColumns(
        {
            "_at": F.when(met, key.cast(kind)).otherwise(value),
            "_lone": F.when(met, F.lit(0)).otherwise(loner),
        }
    )
    rows = right.where(F.col(right_key).isNotNull()).withColumns(
        {"_at_right": F.col(right_key), "_lone_right": zero_part(right_key)}
    )
    nulls = spark.range(1, LONERS + 1, 1, 1).select(
        *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in own],
        value.alias("_at_right"),
        F.col("id").cast("int").alias("_lone_right"),
    )
    on = (F.col("_at") == F.col("_at_right")) & (F.col("_lone") == F.col("_lone_right"))
    return left.join(rows.union(nulls), on).drop("_at", "_lone", "_at_right", "_lone_right", right_key)


def exact_left_joins(
    left: DataFrame, rights: Sequence[Right], key: ColumnLike, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Left outer joins on one key to tables that may have hot keys; right keys are dropped.

    First the left rows are marked that have a partner, by left joins to the distinct keys of
    each right side, which share one shuffle. Then each right side is met by an inner join, to
    which rows of nulls are added for left rows without a partner. The left side is read once,
    and which rows come out does not depend on any size or on a look at the keys beforehand.
    A right side is read twice, so it must be repeatable.

    A third item of a right side is a condition on the left row, part of the ON clause. With
    `spread_by`, columns that tell left rows apart, the key may be null or hot on the left.
    """
    key = as_column(key)
    joined, own = left, left.columns
    parted = bool(spread_by)
    spread = F.hash(*spread_by) if parted else F.hash(key)
    if parted:
        joined = joined.withColumn("_key", key)
        key = F.col("_key")
        joined = joined.withColumn("_part", spread_part(key, spread_by))
    for i, (right, right_key, *_) in enumerate(rights):
        keys = right.select(F.col(right_key).alias(f"_other{i}")).dropna().distinct()
        on = key == F.col(f"_other{i}")
        if parted:
            keys = keys.withColumn("_zero", zero_part(f"_other{i}"))
            on = on & (F.col("_part") == F.col("_zero"))
        joined = joined.join(keys, on, "left").drop("_zero")
    for i, (right, right_key, *pred) in enumerate(rights):
        met = F.col(f"_other{i}").isNotNull()
        if pred and pred[0] is not None:
            met = met & F.coalesce(pred[0], F.lit(False))
        joined = _meet(joined, right, right_key, F.col(f"_other{i}"), met, spread)
        own = own + [c for c in right.columns if c != right_key]
    return joined.select(*own)


def exact_left_join(
    left: DataFrame,
    right: DataFrame,
    key: ColumnLike,
    right_key: str,
    spread_by: Sequence[str] = (),
    left_pred: Column | None = None,
) -> DataFrame:
    """One of `exact_left_joins`. A left row whose key is NULL, or for which `left_pred`
    fails, is kept without a partner."""
    return exact_left_joins(left, [(right, right_key, left_pred)], key, spread_by)


def split_left_join(
    left: DataFrame,
    rights: Sequence[tuple[DataFrame, str]],
    key: ColumnLike,
    spread_by: Sequence[str] = (),
    keys: DataFrame | None = None,
) -> DataFrame:
    """Left outer joins of tables with unique keys on one key that may be hot on the left.

    Several tables are first joined to each other along the distinct keys, sharing one
    shuffle in which no key is hot; the left side then takes part in one join, which can be
    split. `keys` is a one-column table with at least all keys of `left`, if one can be had
    for less than reading `left` again. Left rows without a key get a second key part from a
    hash of `spread_by`, so they do not meet in one task. Right key columns are dropped.
    """
    key = as_column(key)
    joined = left.withColumn("_key", key).withColumn("_part", spread_part(F.col("_key"), spread_by))
    if len(rights) == 1:
        right, right_key = rights[0]
        right = right.withColumnRenamed(right_key, "_right_key")
    else:
        source = left.select(key) if keys is None else keys
        right = source.toDF("_right_key").dropna().distinct()
        right = reduce(
            lambda found, r: found.join(r[0], F.col("_right_key") == F.col(r[1]), "left").drop(r[1]), rights, right
        )
    right = right.withColumn("_right_part", zero_part("_right_key"))
    on = (F.col("_key") == F.col("_right_key")) & (F.col("_part") == F.col("_right_part"))
    return joined.join(right, on, "left").drop("_key", "_part", "_right_key", "_right_part")


def _parts(rows: Column) -> Column:
    """Parts that the rows of a key are dealt to."""
    few = F.least(F.lit(DEALS), F.ceil(rows / SMALL_PART))
    return F.greatest(few, F.ceil(rows / LARGE_PART)).cast("int")


def _hashable(kind: T.DataType) -> bool:
    return not any(k in kind.simpleString() for k in ("map<", "variant"))


def _blocks(side: DataFrame, keys: DataFrame, mine: str, other: str) -> DataFrame:
    """The rows of one side in blocks, with a copy of each block for every part of the other side.

    The part of a row comes from a hash of it, so it is the same whenever it is computed. All rows
    of a part are put into blocks by one task, so it does not matter which rows share a block.
    """
    own = [f for f in side.schema if f.name != "_many"]
    hashed = [F.col(f"`{f.name}`") for f in own if _hashable(f.dataType)] or [F.col("_name")]
    part = F.pmod(F.xxhash64(*hashed), F.col(f"_{mine}s")).cast("int")
    dealt = side.join(keys, F.col("_many") == F.col("_found")).withColumn(f"_{mine}", part)
    # rows with the same texts come together, which makes blocks small in a shuffle
    texts = [F.col(f"`{f.name}`") for f in own if isinstance(f.dataType, T.StringType)]
    number = F.row_number().over(Window.partitionBy("_name", f"_{mine}").orderBy("_name", *texts))
    rows = F.collect_list(F.struct(*[F.col(f"`{f.name}`") for f in own])).alias(f"_{mine}_rows")
    numbered = dealt.withColumn("_block", F.floor((number - 1) / BLOCK))
    packed = numbered.groupBy("_name", f"_{mine}", f"_{other}s", "_block").agg(rows)
    each = F.explode(F.sequence(F.lit(0), F.col(f"_{other}s") - 1)).alias(f"_{other}")
    copies = packed.select("_name", f"_{mine}", each, f"_{mine}_rows")
    tasks = max(CELL_TASKS, int(side.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return copies.repartition(tasks, "_name", "_upper", "_lower")


def split_many_join(
    left: DataFrame, right: DataFrame, key: ColumnLike, right_key: ColumnLike
) -> DataFrame:
    """Inner join in which few keys have very many rows on both sides, so that a few small
    partitions make nearly all pairs and no split by size takes them apart.

    The rows of a key are dealt to parts on both sides by a hash of the whole row, and two parts
    meet in one task. Rows pass in blocks; a block is copied once for each part of the other side,
    so there are never more copies of rows than pairs. The pairs of two blocks come out together,
    each left row with the same right rows in the same order, which a columnar file stores as runs
    and repeats; pairs grow with the square of the rows, so their bytes are what counts.

    Both keys are columns of their side, whose names must not clash. Both sides are read twice,
    so they must be repeatable.
    """
    ours, theirs = left.columns, right.columns
    left = left.withColumn("_many", as_column(key))
    right = right.withColumn("_many", as_column(right_key))
    text = isinstance(left.schema["_many"].dataType, T.StringType)
    # under a collation equal keys may be written in several ways, of which one names the key
    name = F.min(F.collate("_many", "UTF8_BINARY") if text else F.col("_many"))
    rows = _parts(F.count(F.lit(1)))
    uppers = left.groupBy(F.col("_many").alias("_found")).agg(name.alias("_name"), rows.alias("_uppers"))
    lowers = right.groupBy(F.col("_many").alias("_sought")).agg(rows.alias("_lowers"))
    keys = uppers.join(lowers, F.col("_found") == F.col("_sought")).drop("_sought")
    cells = _blocks(left, keys, "upper", "lower").join(
        _blocks(right, keys, "lower", "upper"), ["_name", "_upper", "_lower"]
    )
    # a function with a lambda is not compiled, so rows of a block are passed on one by one; compiled
    # together with the join, all pairs of a block with a whole part would be held before
    each = F.inline(F.transform("_upper_rows", lambda row: row))
    pairs = cells.select(each, "_lower_rows").select("*", F.explode("_lower_rows").alias("_lower_row"))
    return pairs.select(*[F.col(f"`{c}`") for c in ours], *[F.col(f"_lower_row.`{c}`") for c in theirs])
