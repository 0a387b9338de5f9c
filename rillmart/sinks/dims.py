"""The dimension store: every configured dimension in one keyed table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from rillmart.plans.dim import dim_sink
from rillmart.sinks.upsert import compact, free, write_batch

SCHEMA = "sink_table string, pk string, type string, data map<string,string>, ts bigint"
#: a dimension row's order: by arrival, then by time
VERSION = ["batch_id", "ts"]


def writer(
    path: str,
    config: Callable[[], DataFrame],
    config_version: list[str],
    honour_deletes: bool = False,
    compact_every: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """Upsert the dimension rows among a batch of change records.

    One job writes all dimensions, each into its own partition; a dimension appears
    with its first row. The configuration is read afresh for each batch, so a change
    of it applies from the next batch on. Of changes within one second the transaction
    with the larger number wins, then a delete over an update over an insert. With
    ``compact_every``, batches before every so many-th one are folded and in time removed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = dim_sink(batch, config(), config_version, keep=["ts", "xid"])
        step = F.when(F.col("type") == "delete", 2).when(F.col("type") == "update", 1).otherwise(0)
        rows = rows.withColumn("step", step)
        deleted = F.col("type") == "delete" if honour_deletes else None
        write_batch(
            rows, batch_id, path, ["sink_table", "pk"], ["ts", "xid", "step"], None, deleted,
            ["sink_table"],
        )
        if compact_every and batch_id and batch_id % compact_every == 0:
            # batches before this one only: this one may yet be replayed
            compact(
                batch.sparkSession, path, SCHEMA, ["sink_table", "pk"], VERSION, batch_id - 1,
                partition_by=["sink_table"],
            )
            free(batch.sparkSession, path)

    return write
