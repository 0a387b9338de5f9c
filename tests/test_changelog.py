"""Change records are parsed once and laid out by table; readers touch their tables only."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rillmart.operators import parse
from rillmart.session import streaming_session
from rillmart.sinks import changelog
from rillmart.sources import tables as t
from rillmart.sources.topics import Topics
from rillmart.streaming import run
from rillmart.streaming.jobs import Warehouse

NOW = {"availableNow": True}


def record(table, n, kind="insert", **data):
    return json.dumps({"table": table, "type": kind, "ts": n, "xid": n, "data": {"id": str(n), **data}})


@pytest.fixture
def warehouse(spark, tmp_path):
    topics = Topics(root=str(tmp_path / "topics"))
    return Warehouse(spark, str(tmp_path), topics, lambda s: None, t.config_changes, trigger=NOW)


def send(w, n, *texts):
    rows = w.spark.createDataFrame([("topic_db", x) for x in texts], "topic string, value string")
    w.topics.writer("topic_db")(rows, n)


def followed(w, *tables):
    """ids seen by a follower, by table."""
    seen = []
    stream = w.changes(*tables)

    def note(batch, _):
        seen.extend((r.table, r.id) for r in batch.select("table", F.col("data.id").alias("id")).collect())

    run.finish(run.start_batches(stream, note, f"{w.root}/c-{'-'.join(tables)}", NOW), 300)
    return sorted(seen, key=repr)


def test_followers_see_their_tables_only(warehouse):
    w = warehouse
    send(w, 0, record("order_info", 1), record("cart_info", 2), record("order_info", 3, "update"))
    run.finish(w.start("change_log"), 300)
    assert followed(w, "order_info") == [("order_info", "1"), ("order_info", "3")]
    send(w, 1, record("cart_info", 4), record("user_info", 5))
    run.finish(w.start("change_log"), 300)
    # a follower goes on where it stood, also in tables that came later
    assert followed(w, "order_info") == []
    assert followed(w, "cart_info", "user_info") == [("cart_info", "2"), ("cart_info", "4"), ("user_info", "5")]
    assert len(followed(w)) == 5
    assert followed(w, "no_such_table") == []


def test_records_keep_all_they_held(warehouse):
    w = warehouse
    texts = [
        record("order_info", 1, status=None, note="a\"b"),
        json.dumps({"database": "d", "table": "order_info", "type": "update", "ts": 2, "commit": "true",
                    "data": {"id": "1"}, "old": {"id": "0"}}),
        json.dumps({"table": None, "type": "insert", "data": None}),
    ]
    send(w, 0, *texts)
    run.finish(w.start("change_log"), 300)
    want, _ = parse.parse_changes(w.spark.createDataFrame([(x,) for x in texts], "value string"))
    got = changelog.read(w.spark, w.change_path).select(*want.columns)
    key = lambda r: repr(r.asDict(recursive=True))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_unusable_records_are_kept_aside_once(warehouse):
    w = warehouse
    bad = ["", "null", "[1]", "{\"table\"", json.dumps({"type": "bootstrap-start", "table": "order_info"})]
    send(w, 0, record("order_info", 1), *bad[1:])
    run.finish(w.start("change_log"), 300)
    out = w.spark.read.text(f"{w.topics.root}/change_log/*/topic=dirty")
    assert sorted(r.value for r in out.collect()) == sorted(bad[1:])
    assert followed(w) == [("order_info", "1")]


def test_a_replay_replaces_its_batch_and_nothing_else(spark, tmp_path):
    path = str(tmp_path / "changes")
    write = changelog.writer(path)

    def batch(*texts):
        return parse.parse_changes(spark.createDataFrame([(x,) for x in texts], "value string"))[0]

    write(batch(record("a", 1), record("b", 2)), 0)
    write(batch(record("a", 3)), 1)
    write(batch(record("a", 1), record("b", 2)), 0)
    rows = changelog.read(spark, path).select("table", "batch_id", F.col("data.id").alias("id"))
    assert sorted(map(tuple, rows.collect())) == [("a", 0, "1"), ("a", 1, "3"), ("b", 0, "2")]


def test_scans_are_filtered_by_table(spark, tmp_path):
    path = str(tmp_path / "changes")
    texts = [record("a", 1), record("b", 2), record("c", 3)]
    changes = parse.parse_changes(spark.createDataFrame([(x,) for x in texts], "value string"))[0]
    changelog.writer(path)(changes, 0)
    plan = changelog.read(spark, path, ("a",))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(table" in plan.replace("`", "") or "PartitionFilters: [(table" in plan
    stream = changelog.follow(streaming_session(spark), path, ("a", "b"))
    query = run.start_batches(stream, lambda batch, _: batch.collect(), str(tmp_path / "c"), NOW)
    run.finish(query, 300)
    # rows the source handed out, before any filter of the plan
    assert sum(p.numInputRows for p in query.recentProgress) == 2


def test_a_hot_table_is_not_one_file_per_task(spark, tmp_path):
    path = str(tmp_path / "changes")
    rows = spark.range(0, 2000, numPartitions=16).select(
        F.to_json(F.struct(
            F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("table"), F.lit("insert").alias("type"),
            F.struct(F.col("id").cast("string").alias("id")).alias("data"),
        )).alias("value")
    )
    changelog.writer(path)(parse.parse_changes(rows)[0], 0)
    assert changelog.read(spark, path).count() == 2000
    assert len(list(Path(path).glob("table=hot/batch_id=0/*.parquet"))) < 16
