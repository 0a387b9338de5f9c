"""Mart tables: one append per micro-batch, safe to replay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart.schemas import TRANSIENT, columns
from rillmart.sinks.upsert import read_latest, write_batch


def mart_rows(df: DataFrame, table: str) -> DataFrame:
    """Rows as the mart stores them: sink order, no transient columns, emit time last."""
    rows = df.drop(*TRANSIENT.get(table, ()))
    return rows.select(*columns(table), F.unix_millis(F.current_timestamp()).alias("ts"))


def parquet_writer(path: str, table: str) -> Callable[[DataFrame, int], None]:
    """Write a batch to its own folder; a replay overwrites it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = mart_rows(batch, table)
        out.write.mode("overwrite").parquet(f"{path}/{table}/batch_id={batch_id}")

    return write


def revising_writer(path: str, table: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """Write windows as they change, and read the newest revision with ``revised``.

    For ``stateful.window_revisions``, whose windows come out closed and again for late rows,
    and for aggregations in ``update`` mode, whose windows are readable from their first row on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = mart_rows(batch, table)
        write_batch(out, batch_id, f"{path}/{table}", ["stt", "edt", *keys], [], collapse=False)

    return write


def revised(
    spark: SparkSession, path: str, table: str, keys: list[str], schema: str
) -> DataFrame:
    """Newest revision of each window written by ``revising_writer``."""
    return read_latest(spark, f"{path}/{table}", schema, ["stt", "edt", *keys], [])


def jdbc_writer(
    url: str, table: str, batch_size: int = 10_000, **options: str
) -> Callable[[DataFrame, int], None]:
    """Append a batch to an OLAP table; at least once, columns bound by name."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = mart_rows(batch, table).write.format("jdbc").mode("append")
        writer = writer.option("url", url).option("dbtable", table)
        writer.option("batchsize", batch_size).options(**options).save()

    return write
