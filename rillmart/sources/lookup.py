"""Static sides: the dictionary and the dimension tables, read afresh per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart.operators import dims, latest
from rillmart.schemas import BASE_DIC, DIMS
from rillmart.sinks.dims import SCHEMA, VERSION
from rillmart.sinks.upsert import read_changelog


def jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of an external database; give ``partitionColumn``, bounds and
    ``numPartitions`` for one that is not small."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return reader.options(**options).load()


def base_dic(
    spark: SparkSession, path: str | None = None, url: str | None = None, **options: str
) -> DataFrame:
    """The code dictionary, from files or from a database."""
    if path:
        return spark.read.schema(BASE_DIC).parquet(path)
    if url:
        return jdbc_table(spark, url, "base_dic", **options).select(*BASE_DIC.names)
    raise ValueError("base_dic needs a path or a url")


def dimension(spark: SparkSession, path: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """Current rows of one dimension; only that dimension's files are read, and a row whose
    newest version is a tombstone is gone."""
    rows = read_changelog(spark, path, SCHEMA)
    newest = latest.latest_per_key(
        rows.where(F.col("sink_table") == table), ["sink_table", "pk"], VERSION
    )
    newest = newest.where(~F.coalesce(newest["_deleted"], F.lit(False)))
    return dims.as_table(newest, table, columns or DIMS[table].split())


def dimensions(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All dimensions the marts use; lazily read."""
    return {name: dimension(spark, path, name) for name in DIMS}
