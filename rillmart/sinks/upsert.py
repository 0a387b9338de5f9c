"""Keyed tables: last write per key wins.

A micro-batch is reduced to the newest row of each key and written to its own folder,
``batch_id=N``; a replay overwrites that folder and nothing else. Readers collapse the
folders to the newest row per key, so a write costs the size of the batch, not of the
table. ``compact`` folds old batches into a base from time to time, and ``free`` removes
what a base has made superfluous.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rillmart.operators.latest import latest_per_key

_DELETED = "_deleted"


def deltas(path: str) -> str:
    return f"{path}/deltas"


def write_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    keys: list[str],
    version: list[str],
    ties: list[str] | None = None,
    deleted: F.Column | None = None,
    partition_by: list[str] | None = None,
    collapse: bool = True,
) -> None:
    """Upsert one micro-batch; rows for which ``deleted`` holds are tombstones.

    ``collapse=False`` keeps all versions of a batch, for tables that other jobs follow
    as a change log.
    """
    marked = batch.withColumn(_DELETED, F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False))
    rows = latest_per_key(marked, keys, version, ties) if collapse else marked
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{deltas(path)}/batch_id={batch_id}")


def follow(spark: SparkSession, path: str, schema: str | T.StructType, limit: int | None = None) -> DataFrame:
    """The table's changes as a stream, in the order of its batches."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if limit:
        reader = reader.option("maxFilesPerTrigger", limit)
    return reader.parquet(f"{deltas(path)}/*")


def read_changelog(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """All retained versions, oldest base included, with ``batch_id`` and ``_deleted``."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    full = T.StructType(list(schema.fields))
    full = full.add(_DELETED, T.BooleanType()).add("batch_id", T.LongType())
    try:
        recent = spark.read.schema(full).parquet(deltas(path))
    except AnalysisException as e:
        _only_missing(e)
        recent = spark.createDataFrame([], full)
    upto = compacted_upto(spark, path)
    if upto is None:
        return recent
    base = spark.read.schema(full).parquet(f"{path}/base/upto={upto}")
    return recent.where(F.col("batch_id") > upto).unionByName(base)


def _only_missing(e: AnalysisException) -> None:
    """Nothing written yet is an empty table; anything else is an error."""
    if e.getCondition() != "PATH_NOT_FOUND":
        raise e


def read_latest(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    keys: list[str],
    version: list[str],
    ties: list[str] | None = None,
) -> DataFrame:
    """Current rows of a keyed table: newest version, later batches winning ties."""
    log = read_changelog(spark, path, schema)
    newest = latest_per_key(log, keys, [*version, "batch_id"], ties)
    return newest.where(~F.col(_DELETED)).drop(_DELETED, "batch_id")


def children(spark: SparkSession, pattern: str) -> list:
    """Paths that match, in whatever store they lie; one entry per batch or base folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return [f.getPath() for f in found or []]


def number(path) -> int:
    return int(path.getName().split("=")[1])


def _bases(spark: SparkSession, path: str) -> list[int]:
    """Complete bases, oldest first: a base counts from the marker its writer leaves last."""
    return sorted(number(p.getParent()) for p in children(spark, f"{path}/base/upto=*/_SUCCESS"))


def compacted_upto(spark: SparkSession, path: str) -> int | None:
    """Last batch folded into the newest complete base, or None without one."""
    found = _bases(spark, path)
    return found[-1] if found else None


def compact(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    keys: list[str],
    version: list[str],
    upto: int,
    ties: list[str] | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Fold batches up to ``upto`` into a new base; readers switch once it is complete.

    Tombstones stay, so that an older version that comes late stays gone. ``version`` may
    place ``batch_id`` itself; otherwise later batches win among equal versions. Folding the
    same batches again changes nothing.
    """
    if upto in _bases(spark, path):
        return
    log = read_changelog(spark, path, schema).where(F.col("batch_id") <= upto)
    order = version if "batch_id" in version else [*version, "batch_id"]
    writer = latest_per_key(log, keys, order, ties).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/base/upto={upto}")


def free(spark: SparkSession, path: str) -> None:
    """Remove what the last base but one had folded: its batches, and bases before it.

    A reader that began before the newest base was complete still finds all its files. For
    tables that nobody follows as a stream; a follower may be any number of batches behind.
    """
    bases = _bases(spark, path)
    if len(bases) < 2:
        return
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    old = [p for p in children(spark, f"{deltas(path)}/batch_id=*") if number(p) <= bases[-2]]
    old += [p for p in children(spark, f"{path}/base/upto=*") if number(p) < bases[-2]]
    for p in old:
        p.getFileSystem(conf).delete(p, True)
