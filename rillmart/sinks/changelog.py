"""The typed change log: change records parsed once, in files by source table.

One job parses the change topic; the fact jobs follow the folders of their tables and parse
nothing. A table's rows lie under ``table=T/batch_id=N``, so a reader lists, opens and reads
only the tables it names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rillmart.schemas import CHANGE

#: columns of a change record, then the micro-batch it came with
SCHEMA = T.StructType(list(CHANGE.fields)).add("batch_id", T.LongType())


def writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write a batch of parsed records; a replay replaces the folders of its batch only.

    Rows are gathered by table before they are written, in pieces that AQE sizes: a hot table
    is cut into several files and a small one makes one file, not one per task.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*CHANGE.names, F.lit(batch_id).cast("long").alias("batch_id"))
        out = rows.hint("rebalance", F.col("table")).write.mode("overwrite")
        out = out.option("partitionOverwriteMode", "dynamic").partitionBy("table", "batch_id")
        out.parquet(path)

    return write


def _folders(path: str, tables: tuple[str, ...]) -> str:
    """A pattern that matches the tables' folders, whether or not they exist yet."""
    return f"{path}/table={{{','.join(tables)}}}" if tables else f"{path}/table=*"


def follow(spark: SparkSession, path: str, tables: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """The records of some tables (none named: of all) as a stream, in the order of batches.

    ``limit`` bounds the files of a micro-batch. A table that has no record yet is empty.
    """
    reader = spark.readStream.schema(SCHEMA).option("basePath", path)
    if limit:
        reader = reader.option("maxFilesPerTrigger", limit)
    rows = reader.parquet(_folders(path, tables))
    if tables:
        rows = rows.where(F.col("table").isin(*tables))
    return rows.select(*CHANGE.names)


def read(spark: SparkSession, path: str, tables: tuple[str, ...] = ()) -> DataFrame:
    """The same as a batch table; the filter on tables prunes folders."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    return rows.where(F.col("table").isin(*tables)) if tables else rows
