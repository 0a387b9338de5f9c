"""Starting queries and reading finished ones back."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillmart.session import shared_dir, streaming_session


def start(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    partition_by: list[str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a parquet table, exactly once; resumes from ``checkpoint``."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.format("parquet").start(path)


def start_batches(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Hand every micro-batch to ``write(batch, batch_id)``; see ``sinks``."""
    return (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(write)
        .start()
    )


def finish(query: StreamingQuery, timeout: int | None = 600) -> None:
    """Wait for an ``availableNow`` query; one that does not end in time is stopped and reported.

    Without a ``timeout`` it may take as long as its input needs.
    """
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout} s")


def drain(
    spark: SparkSession, build: Callable[[SparkSession], DataFrame], name: str
) -> DataFrame:
    """Run a stream over everything available now and return what it wrote.

    Output and checkpoint go to a fresh folder in the cluster's shared directory.
    """
    base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    stream = build(streaming_session(spark))
    finish(start(stream, f"{base}/out", f"{base}/checkpoint", {"availableNow": True}), timeout=None)
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def drain_in_pieces(
    spark: SparkSession,
    build: Callable[[SparkSession, tuple[int, int]], DataFrame],
    name: str,
    pieces: int,
) -> DataFrame:
    """The same for a stream whose keys are dealt to ``pieces``, drained one after another.

    ``build`` is given the number of a piece and of all, and keeps the keys of that piece. A stream
    drained at once shuffles and holds all its keys in one micro-batch; here disk is needed for one
    piece at a time, for what a piece leaves is freed before the next: its checkpoint, which nobody
    resumes, and its shuffles, which Spark drops with the plan. The executors' own copy of the state
    goes with their next maintenance, within a minute.
    """
    base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    made = []
    for k in range(pieces):
        stream = build(streaming_session(spark), (k, pieces))
        out, checkpoint = f"{base}/out-{k}", f"{base}/checkpoint-{k}"
        finish(start(stream, out, checkpoint, {"availableNow": True}), timeout=None)
        made.append(spark.read.schema(stream.schema).parquet(out))
        del stream
        _free(spark, checkpoint)
    return reduce(DataFrame.unionByName, made)


def _free(spark: SparkSession, checkpoint: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()
