"""The hold by the clock: the newest version of a key within a time of its first."""

import time
from dataclasses import replace

from pyspark.sql import functions as F

from rillmart.schemas import columns, fact_schema
from rillmart.session import streaming_session
from rillmart.settings import DEFAULTS
from rillmart.sinks import upsert
from rillmart.sources.topics import Topics
from rillmart.streaming import run, stateful
from rillmart.streaming.jobs import Warehouse

EVERY_SECOND = {"processingTime": "1 second"}


def wait(found, what, seconds=90):
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        if (got := found()) == what:
            return
        time.sleep(0.5)
    assert got == what


def test_newest_version_within_the_hold_comes_out_without_further_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id string, version bigint, rt timestamp, name string"

    def add(*rows):
        df = spark.createDataFrame(list(rows), "id string, version bigint, s bigint, name string")
        df.select("id", "version", F.timestamp_seconds("s").alias("rt"), "name").coalesce(1).write.mode("append").parquet(source)

    add(("a", 1, 100, "first"), ("a", 3, 100, "newest"), ("a", 2, 100, "between"), ("b", 1, 50, "only"))
    stream = streaming_session(spark).readStream.schema(schema).parquet(source)
    held = stateful.latest_held(stream, "id", "version", 3_000)
    query = run.start(held, out, str(tmp_path / "checkpoint"), EVERY_SECOND)

    def found():
        rows = spark.read.schema(schema).parquet(out).collect() if list((tmp_path / "out").glob("*.parquet")) else []
        return sorted((r.id, r.version, r.name) for r in rows)

    try:
        first = [("a", 3, "newest"), ("b", 1, "only")]
        wait(found, first)
        add(("a", 2, 10, "again"))  # forgotten since: a hold of its own, however old the row
        wait(found, sorted([*first, ("a", 2, "again")]))
    finally:
        query.stop()


def test_sku_mart_with_a_hold(spark, tmp_path):
    settings = replace(DEFAULTS, zone="UTC", sku_hold_ms=2_000)
    w = Warehouse(
        spark, str(tmp_path), Topics(root=str(tmp_path / "topics")), lambda s: None, lambda s: None,
        settings=settings, trigger=EVERY_SECOND,
    )
    name, base = "dwd_trade_order_detail", 1_660_000_000

    def put(batch, *rows):
        df = spark.createDataFrame(
            [(i, "u", "1", sku, str(amount), op, ts) for i, sku, amount, op, ts in rows],
            "id string, user_id string, source_type string, sku_id string, split_original_amount string, op bigint, od_ts bigint",
        ).withColumn("row_op_ts", F.timestamp_seconds("op"))
        for f in fact_schema(name).fields:
            if f.name not in df.columns:
                df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        upsert.write_batch(
            df.select(*columns(name)), batch, w.table_path(name), ["id"], ["row_op_ts"], collapse=False
        )

    put(0, ("d1", "s", "5.00", 1, base), ("d1", "s", "7.00", 2, base), ("d2", "s", "1.00", 1, base + 1),
        ("late", "s", "9.00", 1, base + 3600))
    query = w.start("dws_trade_sku_order_window")

    def found():
        path = tmp_path / "marts" / "dws_trade_sku_order_window"
        if not list(path.glob("**/*.parquet")):
            return []
        return [(r.sku_id, float(r.original_amount)) for r in spark.read.parquet(str(path)).collect()]

    try:
        wait(found, [("s", 8.0)])
    finally:
        query.stop()
