"""Order rows at once and revised, from one state per order, over micro-batches."""

import random
from collections import Counter
from dataclasses import replace

from pyspark.sql import functions as F

from rillmart import catalog
from rillmart.plans import dwd_db
from rillmart.session import streaming_session
from rillmart.streaming import run as runs
from rillmart.streaming import stateful
from streams import Feed

CHANGES = "table string, type string, ts bigint, data map<string,string>, old map<string,string>"
OUT = ("id", "order_status", "od_ts", "oi_ts", "activity_id", "coupon_id")
SPAN = 905


def detail(id_, order, ts, **more):
    return ("order_detail", "insert", ts, {"id": id_, "order_id": order, "order_price": "1.5", "sku_num": "2", **more}, None)


def order(id_, status, ts, type_="insert"):
    return ("order_info", type_, ts, {"id": id_, "order_status": status, "user_id": "u"}, {"order_status": "0"} if type_ == "update" else None)


def activity(detail_id, value, ts):
    return ("order_detail_activity", "insert", ts, {"order_detail_id": detail_id, "activity_id": value, "activity_rule_id": "r"}, None)


def coupon(detail_id, value, ts):
    return ("order_detail_coupon", "insert", ts, {"order_detail_id": detail_id, "coupon_id": value, "coupon_use_id": "u"}, None)


def run(spark, tmp_path, *batches):
    """Rows of each micro-batch, sorted."""
    feed, seen, out = Feed(spark, tmp_path, CHANGES), Counter(), []
    for batch in batches:
        feed.add(batch)
        made = feed.run(lambda changes: stateful.order_revisions(changes, f"{SPAN} seconds", "2 seconds"))
        now = Counter(tuple(r) for r in made.select(*OUT).collect())
        out.append(sorted((now - seen).elements(), key=repr))
        seen = now
    return out


def test_rows_come_at_once_and_again_with_promotions(spark, tmp_path):
    got = run(
        spark, tmp_path,
        [detail("d1", "o", 100), detail("d2", "o", 100), coupon("d3", "early", 101)],
        [order("o", "1001", 102), activity("d1", "A", 102), detail("d3", "o", 103)],
        [coupon("d1", "C", 104), order("o", "1002", 105, "update"), order("o", "1001", 102), detail("d2", "o", 100)],
        [activity("d2", "B", 105 + SPAN), coupon("d2", "far", 110 + SPAN), activity("nobody", "N", 106)],
    )
    assert got[0] == []
    assert got[1] == [
        ("d1", "1001", 100, 102, "A", None), ("d2", "1001", 100, 102, None, None), ("d3", "1001", 103, 102, None, "early"),
    ]
    assert got[2] == [  # a coupon repeats its detail's rows, an update makes new ones, repeats say nothing
        ("d1", "1001", 100, 102, "A", "C"), ("d1", "1002", 100, 105, "A", "C"),
        ("d2", "1002", 100, 105, None, None), ("d3", "1002", 103, 105, None, "early"),
    ]
    # both promotions of d2 are further from it than the span
    assert {r[4:] for r in got[3]} <= {(None, None)}


def test_sides_further_apart_than_the_span_do_not_meet_and_state_ends(spark, tmp_path):
    far = 10 * SPAN
    got = run(
        spark, tmp_path,
        [detail("d", "o", 100), detail("e", "p", 100), order("p", "1001", 100 + SPAN)],
        [order("o", "1001", 101 + SPAN), order("p", "1005", 101 + SPAN, "update")],
        [detail("z", "q", far), order("q", "1001", far), activity("z", "A", far), coupon("z", "C", far)],
        [detail("y", "q", far + 1), order("o", "late", far + 2), activity("y", "A", far + 1), coupon("y", "C", far + 1)],
    )
    assert got[:2] == [[("e", "1001", 100, 100 + SPAN, None, None)], []]
    assert got[2] == [("z", "1001", far, far, "A", "C")]
    assert got[3] == [("y", "1001", far + 1, far, "A", "C")]


def test_any_arrival_order_ends_as_the_batch_does(spark, tmp_path):
    rng = random.Random(7)
    records = []
    for o in map(str, range(25)):
        ts = 1000 + rng.randrange(300)
        records += [order(o, "1001", ts), order(o, "1003", ts + rng.randrange(1, 400), "update")][: rng.randint(1, 2)]
        for k in range(rng.randint(0, 5)):
            id_ = f"{o}-{k}"
            records.append(detail(id_, o, ts + rng.randrange(200)))
            if rng.random() < 0.5:
                records.append(activity(id_, f"A{id_}", ts + rng.randrange(200)))
            if rng.random() < 0.5:
                records.append(coupon(id_, f"C{id_}", ts + rng.randrange(200)))
    rng.shuffle(records)
    feed = Feed(spark, tmp_path, CHANGES)
    for i in range(4):
        feed.add(records[i::4])
    # the delay outlasts the disorder, so nothing is late
    made = feed.run(lambda changes: stateful.order_revisions(changes, f"{SPAN} seconds", "1 hour"))
    newest = made.groupBy(*OUT[:4]).agg(F.max("activity_id").alias("activity_id"), F.max("coupon_id").alias("coupon_id"))
    batch = dwd_db.trade_order_pre_process(spark.createDataFrame(records, CHANGES).alias("changes"), None, f"{SPAN} seconds")
    rows = lambda df: sorted((tuple(r) for r in df.select(*OUT).collect()), key=repr)
    assert rows(newest) == rows(batch) and made.count() > newest.count()
    assert set(made.columns) == set(batch.columns)


def test_pieces_hold_all_orders_once(spark, tmp_path):
    first = [detail("d1", "o", 100), detail("d2", "p", 100), detail("d3", "q", 100), order("o", "1001", 101), coupon("d9", "early", 101)]
    then = [order("p", "1001", 102), order("q", "1001", 103), activity("d1", "A", 104), coupon("d3", "C", 104), detail("d9", "r", 104),
            order("r", "1001", 105), detail("d8", None, 105), activity("d8", "A", 105), detail(None, "o", 105)]

    def made(name, piece):
        feed = Feed(spark, tmp_path / name, CHANGES).add(first).add(then)
        rows = feed.run(lambda changes: stateful.order_revisions(changes, f"{SPAN} seconds", "1 hour", piece))
        return [tuple(r) for r in rows.select("order_id", *OUT).collect()]

    whole = made("whole", None)
    parts = [made(f"piece-{k}", (k, 3)) for k in range(3)]
    assert sorted(whole, key=repr) == sorted((r for p in parts for r in p), key=repr)
    assert {r[0] for r in whole} == {"o", "p", "q", "r"} and sum(len({r[0] for r in p}) for p in parts) == 4
    assert sorted(made("one", (0, 1)), key=repr) == sorted(whole, key=repr)


def test_a_large_input_is_drained_in_pieces_that_leave_no_state_behind(spark, sf, tmp_path, monkeypatch):
    """Disk is needed for a piece at a time: what one leaves is gone when the next begins."""
    whole = sorted(map(tuple, catalog.QUERIES["stream_order_revisions"](spark, sf).collect()), key=repr)
    monkeypatch.setattr(runs, "shared_dir", lambda spark: str(tmp_path))
    monkeypatch.setattr(catalog, "DEFAULTS", replace(catalog.DEFAULTS, drain_rows=3_000))
    began, start = [], runs.start

    def started(df, path, checkpoint, *more):
        began.append(list(tmp_path.glob("*/checkpoint*")))
        return start(df, path, checkpoint, *more)

    monkeypatch.setattr(runs, "start", started)
    rows = catalog.QUERIES["stream_order_revisions"](spark, sf)
    assert len(began) == 3 and not any(began) and not list(tmp_path.glob("*/checkpoint*"))
    assert sorted(map(tuple, rows.collect()), key=repr) == whole and len(whole) > 0


def test_payloads_leave_out_what_a_row_says_already(spark, tmp_path, monkeypatch):
    """An order's details are held without their number and order, and a row is exchanged once a state."""
    feed = Feed(spark, tmp_path, CHANGES).add([detail("d1", "o", 100, sku_id="s"), order("o", "1001", 101), activity("d1", "A", 101)])
    out = feed.run(lambda changes: stateful.order_revisions(changes, f"{SPAN} seconds", "2 seconds"))
    assert [(r["id"], r["order_id"], r["sku_id"], r["od_ts"], r["activity_id"]) for r in out.collect()] == [("d1", "o", "s", 100, "A")]
    plan = stateful.order_revisions(feed.stream(streaming_session(spark)), f"{SPAN} seconds", "2 seconds")
    text = plan._jdf.queryExecution().analyzed().toString()
    written = [t.split("to_json(")[1] for t in text.splitlines() if "to_json(" in t]
    assert len(written) == 4 and not any("order_id" in t or "order_detail_id" in t for t in written)
    assert text.count("RepartitionByExpression [slot") == 2


def test_state_is_written_with_zstd(spark):
    """State lies on disk twice."""
    assert streaming_session(spark).conf.get("spark.sql.streaming.stateStore.rocksdb.compression") == "zstd"
