"""Landed datasets: Parquet folders, and a small list of the current ones.

A dataset is never overwritten in place. Each landing writes a new version folder and
then publishes a new manifest, a JSON file naming the current folder of every part. A
reader sees the old parts or the new ones, and a job that dies leaves the old ones in
force (its folder is then an orphan). Older versions stay until `expire` removes them. A
dataset may be cut into months of one column; a landing then rewrites only the
months it changes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ringroster.period import Period

WHOLE = "all"
MONTH = "event_month"
NO_MONTH = "none"
MANIFESTS = "manifests"


def month_of(c: str) -> Column:
    """Part of a row: the month of `c`, or a part of its own for NULL."""
    return F.coalesce(F.date_format(F.col(f"`{c}`"), "yyyy-MM"), F.lit(NO_MONTH))


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    schema: str | None = None
    unique: bool = False
    parts: dict[str, dict] = field(default_factory=dict)
    index: dict | None = None  # of keys, see `keyindex`

    @property
    def rows(self) -> int:
        return sum(part["rows"] for part in self.parts.values())


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def list_folders(spark: SparkSession, location: str) -> list[str]:
    """Names of the folders below a folder."""
    fs, path = _path(spark, location)
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]


def _delete(spark: SparkSession, location: str) -> None:
    fs, path = _path(spark, location)
    fs.delete(path, True)


def dataset_exists(spark: SparkSession, location: str) -> bool:
    return read_manifest(spark, location) is not None


def read_manifest(spark: SparkSession, location: str) -> Manifest | None:
    """The newest manifest, or None before the first landing."""
    fs, folder = _path(spark, f"{location}/{MANIFESTS}")
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    versions = [n for n in names if n.endswith(".json") and not n.startswith(".")]
    if not versions:
        return None
    return _manifest(spark, f"{location}/{MANIFESTS}/{max(versions)}")


def _manifest(spark: SparkSession, location: str) -> Manifest:
    fs, file = _path(spark, location)
    stream = fs.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def _publish(spark: SparkSession, location: str, manifest: Manifest) -> None:
    """Write the manifest under a new name: complete first, visible second."""
    name = f"{manifest.version:010d}.json"
    fs, hidden = _path(spark, f"{location}/{MANIFESTS}/.{name}")
    _, final = _path(spark, f"{location}/{MANIFESTS}/{name}")
    if fs.exists(final):
        raise RuntimeError(f"{location} was landed by another job meanwhile")
    out = fs.create(hidden, True)
    out.write(bytearray(json.dumps(manifest.__dict__).encode()))
    out.close()
    if not fs.rename(hidden, final):
        raise RuntimeError(f"could not publish {final}")


def load_history(
    spark: SparkSession,
    location: str,
    schema: StructType | None = None,
    parts: Iterable[str] | None = None,
) -> DataFrame:
    """Current rows of a dataset (of the named parts only, if given).

    An absent dataset is empty, which needs its `schema`.
    """
    manifest = read_manifest(spark, location)
    known = schema
    if known is None and manifest is not None and manifest.schema:
        known = StructType.fromJson(json.loads(manifest.schema))
    if known is None:
        raise FileNotFoundError(f"no dataset at {location} and no schema given")
    wanted = set(manifest.parts if manifest else ()) if parts is None else set(parts)
    folders = [
        f"{location}/{part['dir']}"
        for name, part in sorted(manifest.parts.items() if manifest else ())
        if name in wanted
    ]
    if not folders:
        return spark.createDataFrame([], known)
    return spark.read.schema(known).parquet(*folders)


def months_of(period: Period) -> list[str]:
    """Part names of the months a period touches."""
    first = period.start.year * 12 + period.start.month - 1
    last = period.end.year * 12 + period.end.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


def load_period(spark: SparkSession, location: str, period: Period) -> DataFrame:
    """Rows in the months of a period: only the folders of those months are listed and
    read. Filter the result for exact days."""
    return load_history(spark, location, parts=months_of(period))


def _counted(writer: DataFrame, months: Iterable[str] | None, folder: str) -> dict[str, int]:
    """Write the rows and count them meanwhile, by month if the months are given."""
    spark, monthly = writer.sparkSession, MONTH in writer.columns
    names = sorted(months) if months is not None else []
    counts = [F.count_if(F.col(MONTH) == m).alias(f"n{i}") for i, m in enumerate(names)]
    seen = Observation()
    out = writer.observe(seen, F.count(F.lit(1)).alias("all"), *counts).write
    out = out.option("compression", "snappy")
    (out.partitionBy(MONTH) if monthly else out).parquet(folder)
    total = seen.get["all"]
    if not monthly:
        return {WHOLE: total}
    found = {m: seen.get[f"n{i}"] for i, m in enumerate(names) if seen.get[f"n{i}"]}
    if sum(found.values()) != total:  # months that nobody named: their files are asked
        written = spark.read.schema(writer.schema).parquet(folder)
        rows = written.groupBy(F.col(MONTH).cast("string").alias("m")).count().collect()
        found = {r["m"]: r["count"] for r in rows}  # one row per month
    return found


def land(
    df: DataFrame,
    location: str,
    month_column: str | None = None,
    replace: Iterable[str] | None = None,
    unique: bool = False,
    guard_empty: bool = True,
    months: Iterable[str] | None = None,
    index: dict | None = None,
) -> int:
    """Write `df` as the next version and publish it; return the dataset's row count.

    With `month_column` it is written in months; `df` may bring its own month column, by
    which it should then be sorted first, so that its order is kept. `replace` names the parts
    which `df` supersedes (default: all). With `guard_empty`, an empty result changes nothing
    and leaves nothing behind. Rows are counted as they are written; with `months`, all that
    rows of `df` may lie in, those of each month too, so nothing is read again.
    """
    spark = df.sparkSession
    old = read_manifest(spark, location) or Manifest()
    version = old.version + 1
    folder = f"v{version:010d}-{uuid.uuid4().hex[:8]}"
    writer, df = df, df.drop(MONTH)
    if month_column is not None and MONTH not in writer.columns:
        writer = df.withColumn(MONTH, month_of(month_column))
    counts = _counted(writer, months, f"{location}/{folder}")
    if not sum(counts.values()) and guard_empty:
        _delete(spark, f"{location}/{folder}")
        return old.rows
    written = {
        m: {"dir": folder if m == WHOLE else f"{folder}/{MONTH}={m}", "rows": n}
        for m, n in counts.items()
    }
    gone = set(old.parts) if replace is None else set(replace)
    kept = {name: part for name, part in old.parts.items() if name not in gone}
    new = Manifest(version, df.schema.json(), unique, {**kept, **written}, index)
    _publish(spark, location, new)
    return new.rows


def expire(spark: SparkSession, location: str, keep: int = 1) -> list[str]:
    """Remove all versions but the newest `keep`, with every folder that only they name, and
    folders of landings that died. Return the names of the removed folders.

    Readers of a removed version and landings that still run would lose their files, so call
    it when there are none.
    """
    fs, folder = _path(spark, f"{location}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    versions = [n for n in names if n.endswith(".json") and not n.startswith(".")]
    named = set()
    for name in versions[-keep:]:
        kept = _manifest(spark, f"{location}/{MANIFESTS}/{name}")
        dirs = [p["dir"] for p in kept.parts.values()]
        dirs += list(kept.index["dirs"].values()) if kept.index else []
        named |= {d.partition("/")[0] for d in dirs}
    gone = [n for n in list_folders(spark, location) if n != MANIFESTS and n not in named]
    for name in versions[:-keep]:
        _delete(spark, f"{location}/{MANIFESTS}/{name}")
    for name in gone:
        _delete(spark, f"{location}/{name}")
    return gone


def replace_snapshot(df: DataFrame, location: str, guard_empty: bool = True) -> int:
    """Replace the whole dataset by `df`."""
    return land(df, location, guard_empty=guard_empty)
