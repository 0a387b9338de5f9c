"""The warehouse end to end: topics in, marts out, job by job."""

import json
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rillmart.functions import time as tm
from rillmart.operators import parse, split, visitors
from rillmart.plans import dwd_db, dwd_log, dws
from rillmart.schemas import columns, fact_schema
from rillmart.settings import DEFAULTS
from rillmart.sinks import marts, upsert
from rillmart.sources import lookup, tables as t
from rillmart.sources.topics import Topics
from rillmart.streaming import run
from rillmart.streaming.jobs import JOBS, Warehouse

HORIZON = 6 * 3_600_000
SETTINGS = replace(
    DEFAULTS, zone="UTC", window="1 hour", bounce_horizon_ms=HORIZON, traffic_delay="7 hours",
    order_retention="30 days", refund_retention="30 days",
)


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.fixture(scope="module")
def warehouse(spark, sf, tmp_path_factory):
    """A warehouse whose two input topics hold the supplied tables."""
    root = str(tmp_path_factory.mktemp("warehouse"))
    topics = Topics(root=f"{root}/topics")
    log = t.raw_log(t.table(spark, sf, "events"))
    topics.writer("topic_log")(log.select(F.lit("topic_log").alias("topic"), "value"), 0)
    orders = t.table(spark, sf, "orders")
    facts = [
        make(t.table(spark, sf, source))
        for source, makers in {
            "orders": (t.order_info, t.payment_info),
            "lineitem": (t.order_detail, t.order_refund_info, t.refund_payment),
            "events": (t.cart_info, t.comment_info, t.favor_info, t.coupon_use, t.user_info),
        }.items()
        for make in makers
    ]
    changes = t.as_topic(*facts, *t.promotions_of_orders(orders))
    value = F.to_json(F.struct("database", "table", "type", "ts", "data", "old")).alias("value")
    texts = t.as_records(changes).select(value).unionByName(
        t.dim_changes(spark, sf).select(value)
    )
    topics.writer("topic_db")(texts.withColumn("topic", F.lit("topic_db")), 0)
    w = Warehouse(
        spark, root, topics, lambda s: t.base_dic(s, sf), t.config_changes, settings=SETTINGS,
        trigger={"availableNow": True},
    )
    w.batch_changes = changes
    go(w, "change_log")
    return w


def go(w, *names):
    for name in names:
        run.finish(w.start(name), 300)


def topic(w, name, producer=None):
    raw = w.spark.read.text(f"{w.topics.root}/{producer or name}/*/topic={name}")
    return [json.loads(r.value) for r in raw.collect()]


def mart(w, name):
    return w.spark.read.parquet(f"{w.root}/marts/{name}")


def closed(df, last):
    """Batch windows that end by the stream's last watermark (epoch ms)."""
    text = df.sparkSession.range(1).select(tm.full_string(F.lit(last))).first()[0]
    return df.where(F.col("edt") <= text)


def test_there_are_28_jobs_the_change_log_and_the_config_fold():
    assert len(JOBS) == 28 + 2


def test_log_jobs_and_traffic_marts(warehouse, sf):
    w, spark = warehouse, warehouse.spark
    go(w, "base_log")
    raw = t.raw_log(t.table(spark, sf, "events"))
    batch = dwd_log.base_log(raw)
    counts = {r.topic: r.n for r in batch.groupBy("topic").agg(F.count("*").alias("n")).collect()}
    out = w.spark.read.text(f"{w.topics.root}/base_log/*/*")
    assert out.count() == sum(counts.values())
    got = topic(w, dwd_log.TOPICS["page"], "base_log")
    want = batch.where(F.col("topic") == dwd_log.TOPICS["page"]).select("value").collect()
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, got)) == sorted(key(json.loads(r.value)) for r in want)

    go(w, "dwd_traffic_unique_visitor_detail", "dwd_traffic_user_jump_detail")
    log, _ = parse.parse_app_log(raw, keep=["seq"])
    flat = split.flatten_pages(split.pages(dwd_log.repair(log), ("seq",)))
    uv = visitors.unique_visitors(flat)
    got = sorted((r["common"]["mid"], r["ts"]) for r in topic(w, "dwd_traffic_unique_visitor_detail"))
    assert got == [tuple(r) for r in rows(uv, "mid", "ts")]
    uj = dwd_log.user_jump_detail(flat, SETTINGS)
    jumps = topic(w, "dwd_traffic_user_jump_detail")
    assert 0 < len(jumps) <= uj.count()
    assert {(r["common"]["mid"], r["ts"]) for r in jumps} <= set(rows(uj, "mid", "ts"))

    go(w, "dws_traffic_vc_ch_ar_is_new_page_view_window", "dws_traffic_page_view_window",
       "dws_user_user_login_window", "dws_traffic_source_keyword_page_view_window")
    # the slowest of the three inputs holds the windows
    last = min(
        flat.agg(F.max("ts")).first()[0], uv.agg(F.max("ts")).first()[0], max(r["ts"] for r in jumps)
    )
    name = "dws_traffic_vc_ch_ar_is_new_page_view_window"
    seen = spark.createDataFrame(
        [(*(r["common"][c] for c in ("vc", "ch", "ar", "is_new")), r["ts"]) for r in jumps],
        "vc string, ch string, ar string, is_new string, ts bigint",
    )
    want = closed(dws.traffic_page_view(flat, uv, seen, SETTINGS), last - 7 * 3_600_000)
    kinds = {c: "bigint" if c in (*dws.TRAFFIC_SUMS, "ts") else "string" for c in [*columns(name), "ts"]}
    schema = ", ".join(f"{c} {kind}" for c, kind in kinds.items())
    got = marts.revised(spark, f"{w.root}/marts", name, dws.TRAFFIC_KEYS, schema)
    assert rows(got, *columns(name)) == rows(want, *columns(name))
    name = "dws_traffic_page_view_window"
    want = closed(dws.home_detail_page_view(flat, SETTINGS), flat.where(
        F.col("page_id").isin("home", "good_detail")).agg(F.max("ts")).first()[0] - 2000)
    assert rows(mart(w, name), *columns(name)) == rows(want, *columns(name))
    name = "dws_user_user_login_window"
    logins = visitors.login_rows(flat)
    want = closed(dws.user_login(flat, SETTINGS), logins.agg(F.max("ts")).first()[0] - 2000)
    assert rows(mart(w, name), *columns(name)) == rows(want, *columns(name))


def test_single_table_facts(warehouse, sf):
    w = warehouse
    dic = t.base_dic(w.spark, sf)
    plans = {
        "dwd_interaction_comment": lambda c: dwd_db.interaction_comment(c, dic),
        "dwd_interaction_favor_add": dwd_db.interaction_favor_add,
        "dwd_tool_coupon_get": dwd_db.tool_coupon_get,
        "dwd_tool_coupon_order": dwd_db.tool_coupon_order,
        "dwd_tool_coupon_pay": dwd_db.tool_coupon_pay,
        "dwd_trade_cart_add": lambda c: dwd_db.trade_cart_add(c, dic),
        "dwd_user_register": dwd_db.user_register,
    }
    go(w, *plans)
    for name, plan in plans.items():
        names = columns(name)
        got = sorted((tuple(r.get(c) for c in names) for r in topic(w, name)), key=repr)
        assert got == rows(plan(w.batch_changes), *names), name

    go(w, "dws_user_user_register_window", "dws_trade_cart_add_uu_window")
    name = "dws_trade_cart_add_uu_window"
    adds = dwd_db.trade_cart_add(w.batch_changes, dic)
    last = adds.agg(F.max("ts")).first()[0] * 1000 - 2000
    want = closed(dws.cart_add_uu(adds, SETTINGS), last)
    assert rows(mart(w, name), *columns(name)) == rows(want, *columns(name))


def test_dimensions_orders_and_trade_marts(warehouse, sf):
    w, spark = warehouse, warehouse.spark
    go(w, "dim_sink_app", "dwd_trade_order_pre_process")
    sku = lookup.dimension(spark, w.table_path("dims"), "dim_sku_info", ["id", "sku_name", "tm_id"])
    assert sku.count() == t.table(spark, sf, "part").count()

    wide = upsert.read_changelog(
        spark, w.table_path("dwd_trade_order_pre_process"),
        fact_schema("dwd_trade_order_pre_process"),
    )
    batch = dwd_db.trade_order_pre_process(
        w.batch_changes, t.base_dic(spark, sf), span="30 days", delay="2 seconds"
    )
    # every row is there at once, without promotions; what has promotions has the right ones
    key = ("id", "order_status", "oi_ts", "source_type")
    assert rows(wide.select(*key).distinct(), *key) == rows(batch, *key)
    promoted = wide.where("activity_id is not null or coupon_id is not null")
    late = rows(promoted, *key, "activity_id", "coupon_id")
    assert not Counter(late) - Counter(rows(batch, *key, "activity_id", "coupon_id"))

    go(w, "dwd_trade_order_detail", "dwd_trade_cancel_detail", "dwd_trade_pay_detail_suc")
    detail = upsert.read_latest(
        spark, w.table_path("dwd_trade_order_detail"), fact_schema("dwd_trade_order_detail"),
        ["id"], ["row_op_ts"], ["oi_ts"],
    )
    placed = wide.where(F.col("type") == "insert")
    assert rows(detail, "id") == rows(placed.select("id").distinct(), "id")

    go(w, "dws_trade_order_window", "dws_trade_payment_suc_window", "dws_trade_sku_order_window",
       "dws_trade_province_order_window")
    name = "dws_trade_province_order_window"
    dims = lookup.dimensions(spark, w.table_path("dims"))
    orders = w.batch_changes.where((F.col("table") == "order_info") & (F.col("type") == "insert"))
    last = orders.agg(F.max("ts")).first()[0] * 1000 - 2000
    want = closed(dws.province_order(w.batch_changes, dims, SETTINGS), last)
    assert rows(mart(w, name), *columns(name)) == rows(want, *columns(name))
    sku_mart = mart(w, "dws_trade_sku_order_window")
    assert sku_mart.where(F.col("trademark_id").isNotNull()).count() > 0
    assert mart(w, "dws_trade_order_window").count() > 0


def test_refunds(warehouse, sf):
    w, spark = warehouse, warehouse.spark
    dic = t.base_dic(spark, sf)
    go(w, "dim_sink_app", "dwd_trade_order_refund", "dwd_trade_refund_pay_suc")
    for name, plan in (
        ("dwd_trade_order_refund", dwd_db.trade_order_refund),
        ("dwd_trade_refund_pay_suc", dwd_db.trade_refund_pay_suc),
    ):
        names = [c for c in columns(name) if c != "row_op_ts"]
        got = sorted((tuple(r.get(c) for c in names) for r in topic(w, name)), key=repr)
        assert got == rows(plan(w.batch_changes, dic, "30 days"), *names), name

    go(w, "dws_trade_trademark_category_user_refund_window")
    name = "dws_trade_trademark_category_user_refund_window"
    refunds = dwd_db.trade_order_refund(w.batch_changes, dic, "30 days")
    dims = lookup.dimensions(spark, w.table_path("dims"))
    last = refunds.agg(F.max("ts")).first()[0] * 1000 - 2000
    want = closed(dws.user_refund(refunds, dims, SETTINGS), last)
    assert rows(mart(w, name), *columns(name)) == rows(want, *columns(name))


def test_no_order_line_is_lost_with_production_delays(spark, tmp_path):
    """Lines with and without promotions, one order per micro-batch, DEFAULTS' delays.

    The last order moves every input's watermark far on; its own rows stay open.
    """
    settings = replace(DEFAULTS, zone="UTC")
    topics = Topics(root=str(tmp_path / "topics"), limit=1)
    dic = spark.createDataFrame([("1", "web", "", "", "")], "dic_code string, dic_name string, "
                                "parent_code string, create_time string, operate_time string")
    w = Warehouse(spark, str(tmp_path), topics, lambda s: dic, t.config_changes, settings=settings,
                  trigger={"availableNow": True})
    base = 1_660_000_000

    def record(table, ts, **data):
        return json.dumps({"table": table, "type": "insert", "ts": ts, "data": data})

    def at(ts):
        return spark.range(1).select(F.date_format(F.timestamp_seconds(F.lit(ts)), tm.FULL)).first()[0]

    sent = []
    for i in range(6):
        ts = base + 40 * i if i < 5 else base + 7200
        sent.append([
            record("order_info", ts, id=f"o{i}", order_status="1001", user_id=f"u{i % 3}", province_id="1"),
            record("order_detail", ts, id=f"d{i}", order_id=f"o{i}", sku_id=f"s{i % 2}", sku_name="n",
                   order_price="2.00", sku_num="3", create_time=at(ts), source_type="1", source_id="1",
                   split_total_amount="6.00"),
            *([record("order_detail_activity", ts, order_detail_id=f"d{i}", activity_id="a")] if i % 2 else []),
            *([record("order_detail_coupon", ts, order_detail_id=f"d{i}", coupon_id="c")] if i in (3, 5) else []),
        ])
    for i, texts in enumerate(sent):
        df = spark.createDataFrame([("topic_db", x) for x in texts], "topic string, value string")
        topics.writer("topic_db")(df.coalesce(1), i)
    changes, _ = parse.parse_changes(
        spark.createDataFrame([(x,) for texts in sent for x in texts], "value string")
    )
    go(w, "change_log", "dwd_trade_order_pre_process", "dwd_trade_order_detail")
    schema = fact_schema("dwd_trade_order_detail")
    detail = upsert.read_latest(spark, w.table_path("dwd_trade_order_detail"), schema, ["id"],
                                ["row_op_ts", "oi_ts"], ["activity_id", "coupon_id"])
    batch = dwd_db.trade_order_detail(dwd_db.trade_order_pre_process(changes, dic))
    assert rows(detail, "id") == rows(batch, "id")
    early = rows(detail.where("id <> 'd5'"), "id", "activity_id", "coupon_id")
    assert early == rows(batch.where("id <> 'd5'"), "id", "activity_id", "coupon_id")

    go(w, "dws_trade_sku_order_window", "dws_trade_order_window")
    name, last = "dws_trade_sku_order_window", (base + 7200) * 1000 - 2000
    dims = lookup.dimensions(spark, w.table_path("dims"))
    stamped = batch.withColumn("row_op_ts", F.current_timestamp())
    want = closed(dws.sku_order(stamped, dims, settings), last)
    assert want.count() == 5 and rows(mart(w, name), *columns(name)) == rows(want, *columns(name))
    name = "dws_trade_order_window"
    want = closed(dws.trade_order(batch, settings), last)
    assert want.count() == 3 and rows(mart(w, name), *columns(name)) == rows(want, *columns(name))
