"""Sinks: replays, tombstones, compaction, topics, the dimension store."""

import re

from pyspark.sql import functions as F

from rillmart.schemas import columns
from rillmart.sinks import dims as dim_store
from rillmart.sinks import marts, upsert
from rillmart.sources import lookup
from rillmart.sources.topics import Topics, as_topic, read_as, register_views
from test_rules import changes, config

SCHEMA = "id string, v bigint, name string"


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def table(spark, path):
    return upsert.read_latest(spark, path, SCHEMA, ["id"], ["v"])


def put(spark, path, batch_id, data, **kw):
    upsert.write_batch(spark.createDataFrame(data, SCHEMA), batch_id, path, ["id"], ["v"], **kw)


def test_upsert_last_write_wins_and_replays_change_nothing(spark, tmp_path):
    path = str(tmp_path)
    assert table(spark, path).count() == 0
    put(spark, path, 0, [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")])
    put(spark, path, 1, [("b", 2, "w"), ("c", 1, "c")])
    want = [("a", "y"), ("b", "w"), ("c", "c")]
    assert rows(table(spark, path), "id", "name") == want
    put(spark, path, 1, [("b", 2, "w"), ("c", 1, "c")])
    assert rows(table(spark, path), "id", "name") == want
    put(spark, path, 2, [("c", 1, "again")])  # equal version: the later batch wins
    assert ("c", "again") in rows(table(spark, path), "id", "name")


def test_upsert_tombstones_and_compaction(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, 0, [("a", 1, "x"), ("b", 1, "z")])
    put(spark, path, 1, [("a", 2, "gone")], deleted=F.col("name") == "gone")
    before = rows(table(spark, path), "id", "name")
    assert before == [("b", "z")]
    upsert.compact(spark, path, SCHEMA, ["id"], ["v"], upto=1)
    assert rows(table(spark, path), "id", "name") == before
    put(spark, path, 2, [("a", 3, "back")])
    assert rows(table(spark, path), "id", "name") == [("a", "back"), ("b", "z")]
    log = upsert.read_changelog(spark, path, SCHEMA)
    assert log.count() == 3  # two folded rows, one new


def test_only_a_complete_base_counts_and_freeing_spares_the_last_step(spark, tmp_path):
    path = str(tmp_path)

    def folders(kind):
        return sorted(p.name for p in (tmp_path / kind).glob("*=*"))

    for i in range(6):
        put(spark, path, i, [("a", i, f"v{i}"), (f"k{i}", 1, "z")])
    want = rows(table(spark, path), "id", "name")
    (tmp_path / "base" / "upto=9").mkdir(parents=True)  # a fold that did not end
    assert upsert.compacted_upto(spark, path) is None
    upsert.compact(spark, path, SCHEMA, ["id"], ["v"], upto=1)
    upsert.free(spark, path)
    assert len(folders("deltas")) == 6  # readers without the base may be at work
    upsert.compact(spark, path, SCHEMA, ["id"], ["v"], upto=3)
    upsert.free(spark, path)
    assert folders("deltas") == [f"batch_id={i}" for i in (2, 3, 4, 5)]
    assert rows(table(spark, path), "id", "name") == want
    upsert.compact(spark, path, SCHEMA, ["id"], ["v"], upto=3)  # again: nothing new
    upsert.compact(spark, path, SCHEMA, ["id"], ["v"], upto=5)
    upsert.free(spark, path)
    assert folders("base") == ["upto=3", "upto=5", "upto=9"]
    assert rows(table(spark, path), "id", "name") == want


def test_topics_route_rows_and_survive_null_payloads(spark, tmp_path):
    topics = Topics(root=str(tmp_path / "topics"))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "b string, a int")
    one = as_topic(df, "t1", ["a", "b"])
    write = topics.writer("job")
    for _ in range(2):  # a replay
        write(one.unionByName(one.withColumn("topic", F.lit("t2"))), 0)
    stream = topics.read(spark, "t1", "job")
    assert stream.isStreaming and stream.columns == ["value"]
    query = stream.writeStream.format("memory").queryName("t1_rows").trigger(availableNow=True)
    query = query.option("checkpointLocation", str(tmp_path / "c")).start()
    assert query.awaitTermination(120)
    got = sorted(r.value for r in spark.table("t1_rows").collect())
    assert got == ['{"a":1,"b":"a"}', '{"a":2,"b":"b"}']


def test_views_and_named_binding(spark):
    df = spark.createDataFrame([(1, "x")], "n int, s string")
    register_views({"some_view": df})
    assert spark.sql("SELECT s FROM some_view WHERE n = 1").first().s == "x"
    assert read_as(df, ["s", "n"]).columns == ["s", "n"]


def test_mart_rows_follow_sink_order_without_transient_columns(spark, tmp_path):
    name = "dws_traffic_source_keyword_page_view_window"
    df = spark.createDataFrame(
        [(1, "k", "123", "SEARCH", "e", "s")],
        "keyword_count bigint, keyword string, err string, source string, edt string, stt string",
    )
    write = marts.parquet_writer(str(tmp_path), name)
    write(df, 7)
    write(df, 7)
    out = spark.read.parquet(str(tmp_path / name))
    assert out.count() == 1
    assert out.columns == [*columns(name), "ts", "batch_id"]


def test_dimension_store(spark, tmp_path):
    path = str(tmp_path)
    write = dim_store.writer(path, lambda: config(spark), ["ts_ms"])
    write(changes(spark, [
        ("t1", "insert", 1, {"id": "1", "name": "a", "x": "y"}, None),
        ("t1", "insert", 1, {"id": "2", "name": None}, None),
        ("t2", "insert", 1, {"code": "c", "name": "b"}, None),
    ]), 0)
    write(changes(spark, [("t1", "update", 2, {"id": "1", "name": "A"}, None)]), 1)
    dim = lookup.dimension(spark, path, "dim_t1", ["id", "name"])
    assert rows(dim, "id", "name") == [("1", "A"), ("2", "")]
    plan = dim._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sink_table" in plan
    assert rows(lookup.dimension(spark, path, "dim_t2", ["code"]), "code") == [("c",)]
    assert lookup.dimensions(spark, path)["dim_sku_info"].count() == 0


def test_dimension_store_folds_its_batches(spark, tmp_path):
    path = str(tmp_path)
    write = dim_store.writer(path, lambda: config(spark), ["ts_ms"], True, compact_every=2)
    for i in range(6):
        step = [
            ("t1", "update", i, {"id": "1", "name": f"n{i}"}, None), ("t2", "insert", i, {"code": f"c{i}", "name": "b"}, None),
            ("t1", "delete" if i == 1 else "insert", i, {"id": str(min(i, 2) + 10), "name": "x"}, None),
        ]
        write(changes(spark, step), i)
        if i == 4:
            write(changes(spark, step), i)  # a replay of the batch that folds
    dim = lookup.dimension(spark, path, "dim_t1", ["id", "name"])
    assert rows(dim, "id", "name") == [("1", "n5"), ("10", "x"), ("12", "x")]
    assert rows(lookup.dimension(spark, path, "dim_t2", ["code"]), "code") == [(f"c{i}",) for i in range(6)]
    plan = dim._jdf.queryExecution().executedPlan().toString()
    pruned = re.findall(r"PartitionFilters: \[[^\]]*", plan)
    assert len(pruned) == 2 and all("sink_table" in p for p in pruned)  # batches and base alike
    kept = sorted(p.name for p in (tmp_path / "deltas").glob("batch_id=*"))
    assert kept == [f"batch_id={i}" for i in (2, 3, 4, 5)]


def test_later_change_of_one_second_wins_and_deletes_can_count(spark, tmp_path):
    same_second = [
        ("t1", "insert", 1, {"id": "1", "name": "old"}, None), ("t1", "update", 1, {"id": "1", "name": "new"}, None),
        ("t1", "insert", 1, {"id": "2", "name": "x"}, None), ("t1", "delete", 1, {"id": "2", "name": "x"}, None),
    ]
    for honour, want in ((False, [("1", "new"), ("2", "x")]), (True, [("1", "new")])):
        path = str(tmp_path / str(honour))
        write = dim_store.writer(path, lambda: config(spark), ["ts_ms"], honour)
        write(changes(spark, same_second), 0)
        assert rows(lookup.dimension(spark, path, "dim_t1", ["id", "name"]), "id", "name") == want


def test_order_tables_keep_the_later_change_of_a_batch(spark, tmp_path):
    path = str(tmp_path)
    df = spark.createDataFrame([("a", 1, 5, None), ("a", 1, 9, None), ("b", 1, 5, None), ("b", 1, 5, "act")],
                               "id string, row bigint, oi bigint, activity string")
    upsert.write_batch(df, 0, path, ["id"], ["row", "oi"], ["activity"])
    got = upsert.read_latest(spark, path, df.schema, ["id"], ["row", "oi"], ["activity"])
    assert rows(got, "id", "oi", "activity") == [("a", 9, None), ("b", 5, "act")]


def test_a_table_that_was_never_written_reads_as_empty(spark, tmp_path):
    assert upsert.read_changelog(spark, str(tmp_path / "none"), SCHEMA).count() == 0
