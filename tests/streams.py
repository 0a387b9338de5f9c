"""Feeding a file stream one micro-batch at a time."""

from __future__ import annotations

import os
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import DataFrame

from rillmart.session import streaming_session
from rillmart.streaming import run


class Feed:
    """A folder of parquet files; each file is one micro-batch, in the order added."""

    def __init__(self, spark, root: Path, schema: str) -> None:
        self.spark, self.root, self.schema = spark, root, schema
        (root / "in").mkdir(parents=True)
        self.n = 0

    def add(self, rows: list[tuple]) -> "Feed":
        table = self.spark.createDataFrame(rows, self.schema).toArrow()
        path = self.root / "in" / f"{self.n:04d}.parquet"
        pq.write_table(table, path)
        os.utime(path, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        self.n += 1
        return self

    def stream(self, session) -> DataFrame:
        reader = session.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(str(self.root / "in"))

    def run(self, build) -> DataFrame:
        """Process what is there and not yet processed; returns all output so far."""
        stream = build(self.stream(streaming_session(self.spark)))
        out, checkpoint = str(self.root / "out"), str(self.root / "checkpoint")
        run.finish(run.start(stream, out, checkpoint, {"availableNow": True}), 300)
        return self.spark.read.schema(stream.schema).parquet(out)
