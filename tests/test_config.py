"""The dimension configuration as maintained state, and the tables it declares."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rillmart.operators.dims import config_snapshot
from rillmart.schemas import CONFIG_CHANGE
from rillmart.sinks import config as state
from rillmart.sources import lookup
from rillmart.sources.topics import Topics
from rillmart.streaming import run
from rillmart.streaming.jobs import Warehouse

VERSION = ["ts_ms"]


def row(source, sink=None, cols=None, pk=None, extend=None):
    return (source, sink, cols, pk, extend)


def put(source, ts, cols="id,name", sink=None, **kw):
    return ("u", None, row(source, sink or f"dim_{source}", cols, **kw), ts)


def gone(source, ts):
    return ("d", row(source), None, ts)


def feed(spark, *changes):
    return spark.createDataFrame(list(changes), CONFIG_CHANGE)


def snapshot(df):
    return sorted((tuple(r) for r in config_snapshot(df, VERSION).collect()), key=repr)


def names(folder):
    return sorted(int(p.name.split("=")[1]) for p in folder.glob("*=*"))


def test_versions_equal_the_whole_feed_and_stay_small(spark, tmp_path):
    path, rng, all_changes = str(tmp_path), random.Random(3), []
    for i in range(7):
        batch = []
        for _ in range(rng.randint(0, 12)):
            source, ts = f"t{rng.randint(0, 3)}", rng.randint(0, 30) * 100 + len(all_changes) + len(batch)
            batch.append(gone(source, ts) if rng.random() < 0.3 else put(source, ts, f"id,c{rng.randint(0, 9)}"))
        all_changes += batch
        df = feed(spark, *batch)
        write = state.writer(path, VERSION)
        write(df, i)
        write(df, i)  # replayed
        got = state.read(spark, path)
        assert got.count() <= 4
        assert snapshot(got) == snapshot(feed(spark, *all_changes))
    assert names(tmp_path / "versions") == [5, 6]


def test_a_replayed_batch_sees_the_version_it_saw_first(spark, tmp_path):
    path, write = str(tmp_path), state.writer(str(tmp_path), VERSION)

    def seen(batch_id, reader="r"):
        return [r.sink_columns for r in config_snapshot(state.pinned(spark, path, reader, batch_id), VERSION).collect()]

    with pytest.raises(LookupError):
        state.pinned(spark, path, "r", 0)
    write(feed(spark, put("t", 1, "id")), 0)
    assert seen(0) == ["id"]
    for i in range(1, 5):
        write(feed(spark, put("t", 1 + i, f"id,c{i}")), i)
    assert seen(0) == ["id"]  # five versions on
    assert seen(0, "other") == ["id,c4"]
    assert names(tmp_path / "versions") == [0, 3, 4]  # the pinned one is kept
    assert seen(1) == ["id,c4"] and seen(2) == ["id,c4"]
    assert names(tmp_path / "pins" / "r") == [1, 2]
    write(feed(spark, put("t", 9, "id,z")), 5)
    assert names(tmp_path / "versions") == [4, 5]
    assert seen(2) == ["id,c4"] and seen(3) == ["id,z"]


def test_a_config_row_alone_makes_a_table_and_grows_it(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS cfg_declared")
    write = state.writer(str(tmp_path), VERSION, "cfg_declared", str(tmp_path / "tables"))
    try:
        write(feed(
            spark, put("a", 1, "id, name", "dim_a", extend="it's \\ 4"), put("b", 1, "co`de,id", "dim_b", pk="co`de"),
            put("none", 1, " ", "dim_none"), put("also_a", 1, "id,other", "dim_a"),
        ), 0)
        a = spark.table("cfg_declared.dim_a")
        assert set(a.columns) == {"id", "name", "other"}
        assert a.count() == 0 and {t for _, t in a.dtypes} == {"string"}
        assert spark.table("cfg_declared.dim_b").columns == ["co`de", "id"]
        found = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES cfg_declared.dim_b").collect()}
        assert found["primary_key"] == "co`de" and found["sink_extend"] == ""
        assert not spark.catalog.tableExists("cfg_declared.dim_none")
        old = spark.createDataFrame([("1", "n", "o")], "id string, name string, other string")
        state.publish(old, "cfg_declared", "dim_a")
        write(feed(spark, put("a", 2, "id,NAME,added", "dim_a"), gone("b", 2)), 1)
        assert set(state.columns_of(spark, "cfg_declared", "dim_a")) == {"id", "name", "other", "added"}
        got = spark.table("cfg_declared.dim_a").select("id", "name", "added").collect()
        assert [tuple(r) for r in got] == [("1", "n", None)]
        assert spark.table("cfg_declared.dim_b").count() == 0  # no longer configured, still there
    finally:
        spark.sql("DROP DATABASE cfg_declared CASCADE")


def test_the_dimension_job_follows_the_feed(spark, tmp_path):
    """Configuration and rows come in turns; the tables hold what was configured at the time."""
    spark.sql("CREATE DATABASE IF NOT EXISTS cfg_job")
    topics = Topics(root=str(tmp_path / "topics"))
    feeds = str(tmp_path / "feed")
    w = Warehouse(
        spark, str(tmp_path / "w"), topics, lambda s: None, trigger={"availableNow": True}, database="cfg_job",
        config_feed=lambda s: s.readStream.schema(CONFIG_CHANGE).parquet(feeds),
    )
    assert "dim_config" in w.jobs
    assert "dim_config" not in Warehouse(spark, "x", topics, lambda s: None, lambda s: None).jobs

    def send(i, *records):
        texts = [json.dumps({"table": t, "type": "insert", "ts": i, "data": d}) for t, d in records]
        df = spark.createDataFrame([("topic_db", x) for x in texts], "topic string, value string")
        topics.writer("topic_db")(df, i)

    def go(*jobs):
        for name in jobs:
            run.finish(w.start(name), 120)

    try:
        feed(spark, put("t", 1, "id,name")).write.mode("append").parquet(feeds)
        go("dim_config")
        assert spark.table("cfg_job.dim_t").count() == 0
        send(0, ("t", {"id": "1", "name": "a", "x": "y"}), ("u", {"id": "9"}))
        go("change_log", "dim_sink_app")
        feed(spark, put("t", 2, "id,name,x"), put("u", 2, "id")).write.mode("append").parquet(feeds)
        send(1, ("t", {"id": "2", "name": "b", "x": "z"}), ("u", {"id": "8"}))
        go("dim_config", "change_log", "dim_sink_app")
        w.publish()
        got = spark.table("cfg_job.dim_t").select("id", "name", "x").orderBy("id").collect()
        assert [tuple(r) for r in got] == [("1", "a", None), ("2", "b", "z")]
        assert [tuple(r) for r in spark.table("cfg_job.dim_u").collect()] == [("8",)]
        live = lookup.dimension(spark, w.table_path("dims"), "dim_t", ["id", "x"]).where(F.col("x") == "z")
        assert [tuple(r) for r in live.collect()] == [("2", "z")]
    finally:
        spark.sql("DROP DATABASE cfg_job CASCADE")
