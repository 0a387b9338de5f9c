"""Edge rows of each rule, by hand."""

import json

import pytest
from pyspark.sql import functions as F

from rillmart.functions import naming, text, time as tm
from rillmart.operators import changes as ch
from rillmart.operators import dims, enrich, joins, keywords, latest, parse, sequence, split
from rillmart.operators import visitors, windows
from rillmart.plans import dwd_db, dwd_log, dws
from rillmart.schemas import CHANGE

DAY = 86_400_000
HOUR = 3_600_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def pages(spark, data):
    """(mid, ts, seq, is_new, last_page_id) as flat page records."""
    df = spark.createDataFrame(
        data, "mid string, ts bigint, seq bigint, is_new string, last_page_id string"
    )
    return df.withColumn("dt", tm.day("ts"))


def changes(spark, data):
    """(table, type, ts, data, old)."""
    full = [("db", t, ty, ts, None, None, d, o) for t, ty, ts, d, o in data]
    return spark.createDataFrame(full, CHANGE)


# -- parsing -----------------------------------------------------------------------


def test_dirty_log_records_are_kept_aside(spark):
    good = json.dumps({"common": {"mid": "m"}, "ts": 1})
    bad = ["not json", "", "null", "123", '{"common": {"mid": "m"}', json.dumps({"ts": 1})]
    raw = spark.createDataFrame([(v,) for v in [good, *bad]], "value string")
    log, dirty = parse.parse_app_log(raw)
    assert rows(log, "common.mid", "ts") == [("m", 1)]
    assert sorted(r.value for r in dirty.collect()) == sorted(bad)


def test_snapshot_markers_are_dirty_but_snapshot_rows_pass(spark):
    kinds = ["bootstrap-start", "bootstrap-complete", "bootstrap-insert", "insert", "delete"]
    raw = spark.createDataFrame(
        [(json.dumps({"table": "t", "type": k, "data": {"id": "1"}}),) for k in kinds],
        "value string",
    )
    good, dirty = parse.parse_changes(raw)
    assert sorted(r.type for r in good.collect()) == ["bootstrap-insert", "delete", "insert"]
    assert dirty.count() == 2


def test_missing_json_fields_are_null(spark):
    raw = spark.createDataFrame([('{"table":"t","data":{"a":"1"}}',)], "value string")
    good, _ = parse.parse_changes(raw)
    row = good.select(ch.field("a").alias("a"), ch.field("b").alias("b"), "old").first()
    assert (row.a, row.b, row.old) == ("1", None, None)


def log_record(**parts):
    return json.dumps({"common": {"mid": "m", "is_new": "1"}, "ts": T0, **parts})


def test_five_way_split(spark):
    raw = [
        log_record(page={"page_id": "home"}, actions=[{"action_id": "a"}, {"action_id": "b"}],
                   displays=[{"item": "x"}], err={"code": 1}),
        log_record(page={"page_id": "cart"}, actions=[]),
        log_record(page={"page_id": "list"}),
        log_record(start={"entry": "icon"}, err={"code": 2}),
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "seq bigint, value string")
    out = dwd_log.base_log(df)
    kinds = {
        r.topic: r.n for r in out.groupBy("topic").agg(F.count("*").alias("n")).collect()
    }
    names = dwd_log.TOPICS
    assert kinds == {
        names["page"]: 3, names["start"]: 1, names["action"]: 2, names["display"]: 1,
        names["error"]: 2,
    }
    errors = out.where(F.col("topic") == names["error"]).select("value").collect()
    assert sorted(json.loads(r.value)["code"] for r in errors) == [1, 2]
    page = json.loads(out.where(F.col("topic") == names["page"]).orderBy("seq").first().value)
    assert set(page) == {"common", "page", "ts"}
    action = json.loads(out.where(F.col("topic") == names["action"]).first().value)
    assert action["common"]["mid"] == "m" and action["page"]["page_id"] == "home"
    start = json.loads(out.where(F.col("topic") == names["start"]).first().value)
    assert "err" not in start and start["start"]["entry"] == "icon"


def test_log_records_pass_through_as_written(spark):
    """Numbers, unknown members and nested values survive; an item's own time gives way."""
    common = {"mid": 7, "is_new": "1", "x": {"k": [1.25]}}
    old = {"common": {"mid": 7, "is_new": "0"}, "page": {"page_id": "p"}, "ts": T0}
    page = {
        "common": common, "page": {"page_id": "home", "n": 1.5, "deep": [{"a": None}]}, "ts": T0 + 5,
        "trace": {"id": 9}, "flag": "1", "err": {"code": 3},
        "actions": [{"action_id": "a", "ts": 123, "pos": 2}, {}],
        "displays": [{"item": "x", "order": 1, "text": 'a "ts":5 } b'}],
    }
    start = {"common": {**common, "is_new": "0"}, "start": {"entry": "icon", "ms": 12}, "ts": T0 + 6,
             "trace": True}
    odd = [{"common": common, "page": "home", "ts": 1}, {"common": common, "actions": ["a"], "ts": 1}]
    texts = [json.dumps(r) for r in (old, page, start, *odd)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "seq bigint, value string")
    got = {}
    for r in dwd_log.base_log(df).where("seq > 0").collect():
        got.setdefault(r.topic, []).append(r.value)
    names = dwd_log.TOPICS
    assert sorted(got.pop(names["dirty"])) == sorted(texts[3:])
    got = {k: [json.loads(v) for v in vs] for k, vs in got.items()}
    head = {"common": {**common, "is_new": "0"}, "page": page["page"], "ts": T0 + 5}
    assert got == {
        names["page"]: [{**head, "trace": {"id": 9}, "flag": "1"}],
        names["action"]: [{"action_id": "a", "pos": 2, **head}, head],
        names["display"]: [{**page["displays"][0], **head}],
        names["error"]: [{"code": 3}],
        names["start"]: [start],
    }


def test_claims_are_found_under_any_spelling(spark):
    """A claim is corrected however its name and value are written; other records keep their text."""
    first = '{"common":{"mid":"m","is_new":"0"},"page":{"page_id":"a"},"ts":%d}' % T0
    claims = [
        '{"common":{"mid":"m","is_new" : "1"},"page":{"page_id":"b"},"ts":%d}' % (T0 + 1),
        '{"common":{"mid":"m","is_new":1},"page":{"page_id":"c"},"ts":%d}' % (T0 + 2),
        '{"common":{"mid":"m","is_ne\\u0077":"1"},"page":{"page_id":"d"},"ts":%d}' % (T0 + 3),
        '{"common":{"mid":"m","is_new":"\\u0031"},"page":{"page_id":"e"},"ts":%d}' % (T0 + 4),
    ]
    items = '{"common":{"mid":"m"},"page":{"page_id":"f"},"actions":[{"t\\u0073":4,"n":"\\"ts\\""}],"ts":%d}' % (T0 + 5)
    rows = list(enumerate([first, *claims, items, None]))
    out = dwd_log.base_log(spark.createDataFrame(rows, "seq bigint, value string")).collect()
    pages = {r.seq: json.loads(r.value) for r in out if r.topic == dwd_log.TOPICS["page"]}
    assert [pages[i]["common"]["is_new"] for i in range(5)] == ["0"] * 5
    assert [r.value for r in out if r.seq == 0] == [first]
    assert "is_new" not in pages[5]["common"]
    action = [json.loads(r.value) for r in out if r.topic == dwd_log.TOPICS["action"]]
    assert action == [{"common": {"mid": "m"}, "page": {"page_id": "f"}, "ts": T0 + 5, "n": '"ts"'}]
    assert [(r.seq, r.value) for r in out if r.topic == dwd_log.TOPICS["dirty"]] == [(6, "")]
    assert 6 not in pages


def test_single_kind_selects_match_the_tagged_pass(spark):
    raw = spark.createDataFrame(
        [(log_record(page={"page_id": "p"}, actions=[{"action_id": "a"}], displays=None),)],
        "value string",
    )
    log, _ = parse.parse_app_log(raw)
    assert split.pages(log).count() == split.actions(log).count() == 1
    assert split.displays(log).count() == split.starts(log).count() == split.errors(log).count() == 0


# -- change records ----------------------------------------------------------------


def test_state_transitions(spark):
    df = changes(spark, [
        ("c", "update", 1, {"id": "a", "s": "2"}, {"s": "1"}),
        ("c", "update", 1, {"id": "b", "s": "2"}, {"s": "0"}),
        ("c", "update", 1, {"id": "c", "s": "2"}, {"other": "1"}),
        ("c", "update", 1, {"id": "d", "s": "2"}, None),
        ("c", "update", 1, {"id": "e", "s": "3"}, {"s": "1"}),
    ])
    exact = df.where(ch.moved_to("s", "2", "1")).select(ch.field("id").alias("id"))
    any_old = df.where(ch.moved_to("s", "2")).select(ch.field("id").alias("id"))
    assert rows(exact, "id") == [("a",)]
    assert rows(any_old, "id") == [("a",), ("b",)]


def test_cart_deltas(spark):
    df = changes(spark, [
        ("cart_info", "insert", 1, {"id": "ins", "sku_num": "3"}, None),
        ("cart_info", "update", 1, {"id": "up", "sku_num": "5"}, {"sku_num": "2"}),
        ("cart_info", "update", 1, {"id": "same", "sku_num": "5"}, {"sku_num": "5"}),
        ("cart_info", "update", 1, {"id": "down", "sku_num": "1"}, {"sku_num": "2"}),
        ("cart_info", "update", 1, {"id": "other", "sku_num": "1"}, {"x": "2"}),
        ("cart_info", "update", 1, {"id": "null", "sku_num": "1"}, None),
        ("cart_info", "update", 1, {"id": "text", "sku_num": "many"}, {"sku_num": "2"}),
        ("cart_info", "delete", 1, {"id": "del", "sku_num": "9"}, None),
        ("cart_info", "insert", 1, {"id": "bare"}, None),
    ])
    out = ch.added(ch.of_table(df, "cart_info"), "sku_num", "added")
    got = rows(out.select(ch.field("id").alias("id"), "added"), "id", "added")
    assert got == [("bare", None), ("ins", "3"), ("up", "3")]


def test_coupon_pay_passes_later_updates_too(spark):
    df = changes(spark, [
        ("coupon_use", "update", 1, {"id": "1", "used_time": "t"}, {"used_time": None}),
        ("coupon_use", "update", 2, {"id": "1", "used_time": "t"}, {"x": "y"}),
        ("coupon_use", "update", 2, {"id": "2"}, None),
        ("coupon_use", "insert", 2, {"id": "3", "used_time": "t"}, None),
    ])
    assert dwd_db.tool_coupon_pay(df).count() == 2


# -- visitors ----------------------------------------------------------------------


def fixed(spark, data, salts=8):
    out = visitors.repair_new_visitors(pages(spark, data), salts=salts)
    return dict(rows(out, "seq", "is_new"))


@pytest.mark.parametrize("salts", [1, 8])
def test_new_visitor_repair(spark, salts):
    data = [
        ("new", T0, 1, "1", None), ("new", T0 + HOUR, 2, "1", None),
        ("new", T0 + DAY, 3, "1", None),  # reinstalled a day later
        ("old", T0, 4, "0", None), ("old", T0 + HOUR, 5, "1", None),
        ("none", T0, 6, None, None), ("none", T0 + HOUR, 7, "1", None),
    ]
    assert fixed(spark, data, salts) == {
        1: "1", 2: "1", 3: "0", 4: "0", 5: "0", 6: None, 7: "0"
    }


def test_unique_visitors(spark):
    data = [
        ("m", T0 + 5, 1, "1", "home"),  # not a session start
        ("m", T0 + 9, 2, "1", None), ("m", T0 + 10, 3, "1", None),
        ("m", T0 + DAY, 4, "1", None), ("n", T0 + 9, 5, "1", None), ("n", T0 + 9, 6, "1", None),
    ]
    assert rows(visitors.unique_visitors(pages(spark, data)), "seq") == [(2,), (4,), (5,)]


def test_user_day_flags(spark):
    df = pages(spark, [("u", T0 + 3, 1, "", ""), ("u", T0 + 1, 2, "", ""), ("u", T0 + DAY, 3, "", "")])
    out = visitors.user_day_flags(df.withColumnRenamed("mid", "user_id"))
    assert rows(out, "ts", "unique_user", "new_user") == [(T0 + 1, 1, 1), (T0 + DAY, 1, 0)]


def test_exactly_seven_days_is_not_back(spark):
    def back(ts):
        df = pages(spark, [("u", T0 + HOUR, 1, "", ""), ("u", ts, 2, "", "")])
        out = visitors.login_flags(df.withColumnRenamed("mid", "uid"))
        return dict(rows(out, "ts", "back"))[ts]

    assert back(T0 + 7 * DAY) == 0
    assert back(T0 + 7 * DAY + 1) == 1


def test_login_rows(spark):
    df = spark.createDataFrame(
        [(1, "u", None), (2, "u", "login"), (3, "u", "home"), (4, None, None)],
        "seq int, uid string, last_page_id string",
    )
    assert rows(visitors.login_rows(df), "seq") == [(1,), (2,)]


# -- bounces -----------------------------------------------------------------------


def bounced(spark, data, **kw):
    return [r[0] for r in rows(sequence.bounces(pages(spark, data), **kw), "seq")]


def test_bounce_rule(spark):
    s = 1000
    data = [
        ("next-start", T0, 1, "1", None), ("next-start", T0 + 5 * s, 2, "1", None),
        ("followed", T0, 3, "1", None), ("followed", T0 + 14 * s, 4, "1", "home"),
        ("exact", T0, 5, "1", None), ("exact", T0 + 15 * s, 6, "1", "home"),
        ("three", T0, 7, "1", None), ("three", T0 + s, 8, "1", None), ("three", T0 + 2 * s, 9, "1", None),
        ("page-only", T0, 10, "1", "home"),
        ("tie", T0, 11, "1", None), ("tie", T0, 12, "1", "home"),
    ]
    assert bounced(spark, data) == [1, 2, 5, 7, 8, 9]


def brute_bounces(data, horizon):
    out, by = [], {}
    for mid, ts, seq, _, last in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        by.setdefault(mid, []).append((ts, seq, last))
    for recs in by.values():
        for i, (ts, seq, last) in enumerate(recs):
            if last is None:
                nxt = recs[i + 1] if i + 1 < len(recs) else None
                if nxt is None or nxt[2] is None or nxt[0] - ts >= horizon:
                    out.append(seq)
    return sorted(out)


@pytest.mark.parametrize("bucket", [15_000, 16_000, 60_000])
def test_bounces_do_not_depend_on_buckets(spark, bucket):
    import random

    rng = random.Random(7)
    data, ts = [], T0
    for seq in range(600):
        ts += rng.choice([0, 1, 500, 7_000, 14_999, 15_000, 15_001, 40_000])
        # one visitor holds most of the rows
        mid = "hot" if rng.random() < 0.8 else f"m{rng.randrange(3)}"
        data.append((mid, ts, seq, "1", rng.choice([None, "home"])))
    assert sorted(bounced(spark, data, bucket_ms=bucket)) == brute_bounces(data, 15_000)


# -- latest ------------------------------------------------------------------------


def test_row_stamps_compare_as_times(spark):
    df = spark.createDataFrame(
        [(1, "k", "2022-08-26 07:47:55.04Z"), (2, "k", "2022-08-26 07:47:55.041Z"),
         (3, "j", "2022-08-26 07:47:55.1Z"), (4, "j", "2022-08-26 07:47:55.099Z"),
         (5, "i", "2022-08-26 07:47:55Z"), (6, "i", "2022-08-26 07:47:55.0Z")],
        "n int, k string, row_op_ts string",
    )
    out = latest.latest_by_row_stamp(df, ["k"], ties=["n"])
    assert rows(out, "k", "n") == [("i", 5), ("j", 3), ("k", 2)]


def test_current_state_drops_deleted_keys(spark):
    image = "struct<id: string, v: string>"
    df = spark.createDataFrame(
        [("c", None, ("a", "1"), 1), ("u", ("a", "1"), ("a", "2"), 2),
         ("c", None, ("b", "1"), 1), ("d", ("b", "1"), None, 2)],
        f"op string, before {image}, after {image}, ts_ms bigint",
    )
    assert rows(latest.current_state(df, "id", ["ts_ms"]), "id", "v") == [("a", "2")]


# -- joins and enrichment ----------------------------------------------------------


def test_dictionary_miss_drops_dimension_miss_keeps(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "n int, code string")
    dic = spark.createDataFrame([("a", "Apple")], "dic_code string, dic_name string")
    dim = spark.createDataFrame([("a", "Ant")], "id string, name string")
    assert rows(enrich.lookup(facts, dic, "code", "name"), "n", "name") == [(1, "Apple")]
    out = enrich.enrich(facts, dim, "code", {"label": "name"})
    assert rows(out, "n", "label") == [(1, "Ant"), (2, None), (3, None)]


def test_broadcast_only_what_is_measured_small(spark):
    small = spark.range(10).toDF("dic_code")
    hinted = enrich.checked_broadcast(small, max_rows=10)
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    assert enrich.checked_broadcast(small, max_rows=9) is small
    assert enrich.checked_broadcast(small, max_bytes=10) is small


def order_log(spark):
    def detail(i, order, ts=100):
        return ("order_detail", "insert", ts, {
            "id": i, "order_id": order, "sku_id": "s", "source_type": "a", "order_price": "12.30",
            "sku_num": "3"}, None)

    promo = [
        ("order_detail_activity", "insert", 100, {"order_detail_id": i, "activity_id": "A"}, None)
        for i in ("act", "both")
    ] + [
        ("order_detail_coupon", "insert", 100, {"order_detail_id": i, "coupon_id": "C"}, None)
        for i in ("cou", "both")
    ]
    orders = [
        ("order_info", "insert", 100, {"id": "o", "order_status": "1001", "user_id": "u"}, None),
        ("order_info", "update", 2000, {"id": "o", "order_status": "1003"}, {"order_status": "1001"}),
        ("order_info", "delete", 100, {"id": "o"}, None),
    ]
    details = [detail(i, "o") for i in ("act", "cou", "both", "none")] + [detail("lost", "x")]
    return changes(spark, details + promo + orders)


def dictionary(spark):
    return spark.createDataFrame([("a", "search")], "dic_code string, dic_name string")


def test_order_wide_rows(spark):
    wide = dwd_db.trade_order_pre_process(order_log(spark), dictionary(spark))
    assert wide.count() == 8  # four details, two order changes
    placed = dwd_db.trade_order_detail(wide)
    assert rows(placed, "id", "activity_id", "coupon_id", "split_original_amount", "source_type") == [
        ("act", "A", None, "36.9000", "search"), ("both", "A", "C", "36.9000", "search"),
        ("cou", None, "C", "36.9000", "search"), ("none", None, None, "36.9000", "search"),
    ]
    assert dwd_db.trade_cancel_detail(wide).count() == 4


def test_order_join_is_bounded_in_event_time(spark):
    wide = dwd_db.trade_order_pre_process(
        order_log(spark), dictionary(spark), span="905 seconds", delay="2 seconds"
    )
    assert {r.type for r in wide.collect()} == {"insert"}  # the update came 1900 s later


def test_join_span_is_inclusive(spark):
    a = spark.createDataFrame([(1, 1000)], "k int, s bigint").withColumn("rt", tm.from_seconds("s"))
    b = spark.createDataFrame(
        [(1, 995, "in"), (1, 1005, "in"), (1, 994, "out"), (1, 1006, "out")], "k int, s2 bigint, w string"
    ).withColumn("rt", tm.from_seconds("s2"))
    out = joins.interval_join(a, b, [("k", "k")], span="5 seconds", keep=["w"])
    assert rows(out, "w") == [("in",), ("in",)]


def test_refund_payment_fans_out_over_order_updates(spark):
    log = changes(spark, [
        ("refund_payment", "update", 1, {"id": "r", "order_id": "o", "sku_id": "s",
                                         "payment_type": "a", "refund_status": "0705"}, None),
        ("refund_payment", "update", 1, {"id": "x", "order_id": "o", "sku_id": "s",
                                         "payment_type": "a", "refund_status": "0701"}, None),
        ("order_refund_info", "insert", 1, {"order_id": "o", "sku_id": "s", "refund_num": "1"}, None),
        ("order_refund_info", "insert", 1, {"order_id": "o", "sku_id": "t", "refund_num": "2"}, None),
        ("order_info", "update", 1, {"id": "o", "user_id": "u"}, None),
        ("order_info", "update", 2, {"id": "o", "user_id": "u"}, None),
    ])
    out = dwd_db.trade_refund_pay_suc(log, dictionary(spark))
    assert rows(out, "id", "refund_num") == [("r", "1"), ("r", "1")]


# -- dimensions --------------------------------------------------------------------


def config(spark, *extra):
    image = "struct<source_table: string, sink_table: string, sink_columns: string, sink_pk: string, sink_extend: string>"
    data = [
        ("r", None, ("t1", "dim_t1", "id,name", None, None), 1),
        ("r", None, ("t2", "dim_t2", "code,name", "code", None), 1),
        *extra,
    ]
    return spark.createDataFrame(data, f"op string, before {image}, after {image}, ts_ms bigint")


def dim_records(spark):
    return changes(spark, [
        ("t1", "insert", 1, {"id": "1", "name": "a", "secret": "x"}, None),
        ("t1", "delete", 2, {"id": "1", "name": None}, None),
        ("t2", "update", 1, {"code": "c", "name": "b"}, None),
        ("t3", "insert", 1, {"id": "9"}, None),
    ])


def test_dimension_rows(spark):
    out = dims.dimension_rows(
        dim_records(spark), dims.config_snapshot(config(spark), ["ts_ms"]), keep=["ts"]
    )
    got = sorted((r.sink_table, r.pk, r.type, tuple(sorted(r.data.items()))) for r in out.collect())
    assert got == [
        ("dim_t1", "1", "delete", (("id", "1"), ("name", ""))),
        ("dim_t1", "1", "insert", (("id", "1"), ("name", "a"))),
        ("dim_t2", "c", "update", (("code", "c"), ("name", "b"))),
    ]
    kept = dims.latest_rows(out, ["ts"])
    assert rows(dims.as_table(kept, "dim_t1", ["id", "name"]), "id", "name") == [("1", "")]
    assert dims.latest_rows(out, ["ts"], honour_deletes=True).count() == 1


def test_config_delete_stops_a_table(spark):
    gone = ("d", ("t1", None, None, None, None), None, 2)
    snapshot = dims.config_snapshot(config(spark, gone), ["ts_ms"])
    assert rows(snapshot, "source_table", "sink_pk", "sink_extend") == [("t2", "code", "")]


def test_dimension_helpers(spark):
    assert dims.table_schema("id,name").names == ["id", "name"]
    df = spark.createDataFrame([("1", "a"), ("2", "a")], "id string, tm_name string")
    assert rows(dims.where_equal(df, tm_name="a", id="2"), "id") == [("2",)]
    assert naming.to_lower_camel(naming.to_upper(df)).columns == ["id", "tmName"]


# -- windows -----------------------------------------------------------------------


def test_composite_keys_do_not_collide(spark):
    df = spark.createDataFrame(
        [("1", "23", "o1", 0), ("12", "3", "o1", 0), ("1", "23", "o1", 1), ("1", "23", "o2", 2)],
        "a string, b string, order_id string, ts bigint",
    ).withColumn("rt", tm.from_ms("ts"))
    out = windows.window_count_distinct(df, "order_id", "n", keys=["a", "b"])
    assert rows(out, "a", "b", "n") == [("1", "23", 2), ("12", "3", 1)]


def test_windows_are_aligned_and_half_open(spark):
    df = spark.createDataFrame([(T0,), (T0 + 9_999,), (T0 + 10_000,)], "ts bigint")
    out = windows.window_agg(
        df.withColumn("rt", tm.from_ms("ts")), measures={"n": F.count(F.lit(1))}
    )
    assert rows(out, "stt", "edt", "n") == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", 2),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", 1),
    ]


def test_cart_day_is_the_day_of_the_second(spark):
    """Two days apart are two cart days, although both are days 1970-01-20 read as ms."""
    df = spark.createDataFrame([("u", T0 // 1000), ("u", T0 // 1000 + 86_400)], "user_id string, ts bigint")
    assert dws.cart_add_uu(df).count() == 2


def test_province_skips_what_it_cannot_read(spark):
    log = changes(spark, [
        ("order_info", "insert", 1, {"province_id": "1", "total_amount": "1.50",
                                     "create_time": "2024-01-01 00:00:01"}, None),
        ("order_info", "insert", 1, {"province_id": "1", "total_amount": "2.25",
                                     "create_time": "2024-01-01 00:00:02"}, None),
        ("order_info", "insert", 1, {"province_id": "1", "total_amount": "9",
                                     "create_time": "yesterday"}, None),
    ])
    names = {"dim_base_province": spark.createDataFrame([("2", "x")], "id string, name string")}
    out = dws.province_order(log, names)
    assert [(r.order_count, str(r.order_amount), r.province_name) for r in out.collect()] == [
        (2, "3.75", None)
    ]


def test_unreadable_order_times_count_for_nobody(spark):
    df = spark.createDataFrame(
        [("u", "yesterday"), ("u", None), ("u", "2024-01-01 00:00:01"), ("u", "2024-01-02 00:00:01")],
        "user_id string, create_time string",
    )
    names = ("stt", "order_unique_user_count", "order_new_user_count")
    assert rows(dws.trade_order(df), *names) == [
        ("2024-01-01 00:00:00", 1, 1), ("2024-01-02 00:00:00", 1, 0)
    ]


# -- functions ---------------------------------------------------------------------


def test_times_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        row = spark.createDataFrame([(T0,)], "ts bigint").select(
            tm.full_string("ts").alias("full"),
            tm.to_ms(F.lit("2024-01-01")).alias("ms"),
            tm.to_ms(F.lit("junk"), full=True).alias("junk"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.full, row.ms, row.junk) == ("2024-01-01 08:00:00", T0 - 8 * HOUR, None)


def test_keywords(spark):
    df = spark.createDataFrame(
        [(1, "Red-SHOES, 42!", "keyword", "search"), (2, "ignored", "sku_id", "search"),
         (3, "ignored", "keyword", "home"), (4, None, "keyword", "search"), (5, "小米 手机", "keyword", "search")],
        "n int, item string, item_type string, last_page_id string",
    )
    searched = keywords.search_pages(df)
    native = keywords.explode_words(searched, "item", keep=["n"])
    assert [r[1] for r in rows(native, "n", "keyword")] == ["42", "red", "shoes", "小米", "手机"]
    text.register_segmenter(spark, lambda s: s.split(), "by_space")
    plugged = keywords.explode_words_udtf(searched, "item", "by_space", ["n"])
    assert [r[1] for r in rows(plugged, "n", "keyword")] == ["42!", "Red-SHOES,", "小米", "手机"]
