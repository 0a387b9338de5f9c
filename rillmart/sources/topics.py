"""Topics as streams of JSON text, behind one switch.

``files`` keeps a topic as text files written by the jobs of this package (and by
tests); ``kafka`` reads the real thing. Everything after the source is the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Topics:
    """Where topics live.

    ``kind``: ``files`` (``root`` is a folder, one sub-folder per producing job) or
    ``kafka`` (``options`` are passed to source and sink). ``limit`` bounds a
    micro-batch: files or offsets per trigger; None takes a bound that suits the kind.
    """

    kind: str = "files"
    root: str = ""
    options: dict[str, str] = field(default_factory=dict)
    limit: int | None = None
    starting_offsets: str = "latest"

    @property
    def bound(self) -> int:
        """Files or offsets that a micro-batch takes at most."""
        return self.limit or (1_000_000 if self.kind == "kafka" else 1_000)

    def read(self, spark: SparkSession, topic: str, producer: str | None = None) -> DataFrame:
        """Unbounded stream of the topic's payloads, as one ``value`` column.

        A null payload becomes an empty string, which parsing later quarantines.
        Offsets are kept in the query's checkpoint.
        """
        if self.kind == "kafka":
            reader = spark.readStream.format("kafka").options(**self.options)
            reader = reader.option("subscribe", topic)
            reader = reader.option("startingOffsets", self.starting_offsets)
            reader = reader.option("maxOffsetsPerTrigger", self.bound)
            rows = reader.load().select(F.col("value").cast("string").alias("value"))
        elif self.kind == "files":
            reader = spark.readStream.option("recursiveFileLookup", "true")
            reader = reader.option("maxFilesPerTrigger", self.bound)
            rows = reader.text(f"{self.root}/{producer or topic}/*/topic={topic}")
        else:
            raise ValueError(f"unknown kind of topics: {self.kind}")
        return rows.select(F.coalesce("value", F.lit("")).alias("value"))

    def writer(self, producer: str) -> Callable[[DataFrame, int], None]:
        """Write a batch of (topic, value) rows, all topics in one job.

        Files of a batch are overwritten when it is replayed; Kafka is at least once.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = batch.select("topic", "value")
            if self.kind == "kafka":
                rows.write.format("kafka").options(**self.options).save()
            else:
                out = rows.write.mode("overwrite").partitionBy("topic")
                out.text(f"{self.root}/{producer}/batch-{batch_id:08d}")

        return write


def as_topic(df: DataFrame, topic: str, columns: list[str] | None = None) -> DataFrame:
    """Rows as (topic, value): one JSON object each, columns by name in sink order."""
    names = [c for c in columns or df.columns if c in df.columns]
    return df.select(F.lit(topic).alias("topic"), F.to_json(F.struct(*names)).alias("value"))


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make frames available to SQL under their names; they stay plain DataFrames."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def read_as(df: DataFrame, names: list[str]) -> DataFrame:
    """Bind a table to a record's fields by name, in the record's order."""
    return df.select(*names)
