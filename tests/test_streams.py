"""Stream faces against batch faces, over several micro-batches."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from rillmart.functions import time as tm
from rillmart.operators import sequence, visitors, windows
from rillmart.plans import dws
from rillmart.session import streaming_session
from rillmart.sinks import marts
from rillmart.sources import tables as t
from rillmart.streaming import run, stateful
from rillmart.streaming.processors import Bounce
from streams import Feed

DAY = 86_400_000
HOUR = 3_600_000
T0 = 1_704_067_200_000
PAGE = (
    "mid string, ts bigint, seq bigint, is_new string, last_page_id string, uid string, page_id string"
)


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.fixture(scope="module")
def log(spark, sf):
    cols = [c.split()[0] for c in PAGE.split(", ")]
    return t.page_log(spark, sf).select(*cols, "dt")


@pytest.fixture(scope="module")
def in_order(log):
    """The log in event order, as four micro-batches."""
    data = [tuple(r) for r in log.drop("dt").orderBy("ts", "seq").collect()]
    n = len(data) // 4 + 1
    return [data[i : i + n] for i in range(0, len(data), n)]


def fed(spark, tmp_path, batches):
    feed = Feed(spark, tmp_path, PAGE)
    for b in batches:
        feed.add(b)
    return feed


def test_new_visitor_repair(spark, tmp_path, log, in_order):
    out = fed(spark, tmp_path, in_order).run(stateful.repair_new_visitors)
    batch = visitors.repair_new_visitors(log)
    assert rows(out, "seq", "is_new", "page_id") == rows(batch, "seq", "is_new", "page_id")


def test_unique_visitors(spark, tmp_path, log, in_order):
    out = fed(spark, tmp_path, in_order).run(stateful.unique_visitors)
    assert rows(out, "mid", "seq") == rows(visitors.unique_visitors(log), "mid", "seq")


def test_login_flags(spark, tmp_path, log, in_order):
    def build(pages):
        return stateful.login_flags(visitors.login_rows(pages), back_after_days=1)

    out = fed(spark, tmp_path, in_order).run(build)
    batch = visitors.login_flags(visitors.login_rows(log), back_after_days=1)
    assert rows(out, "uid", "ts", "uu", "back") == rows(batch, "uid", "ts", "uu", "back")


def test_flags_feed_a_window(spark, tmp_path, log, in_order):
    """First-of-day state and a window in one query; closed windows equal the batch."""

    def build(pages):
        flags = stateful.user_day_flags(pages.withColumn("user_id", F.col("mid")))
        return windows.window_sum(flags, "1 hour", sums={"n": "unique_user", "new": "new_user"})

    out = fed(spark, tmp_path, in_order).run(build)
    flags = visitors.user_day_flags(log.withColumn("user_id", F.col("mid")))
    batch = windows.window_sum(
        tm.with_event_time(flags, tm.from_ms("ts")), "1 hour", sums={"n": "unique_user", "new": "new_user"}
    )
    last = log.agg(F.date_format(tm.from_ms(F.max("ts") - 2000), "yyyy-MM-dd HH:mm:ss")).first()[0]
    closed = batch.where(F.col("edt") <= last)
    assert rows(out, "stt", "n", "new") == rows(closed, "stt", "n", "new")


HORIZON = 6 * HOUR


def decided(batch, log, horizon=HORIZON, delay=2000):
    """Batch bounces whose deciding moment the watermark has passed."""
    from pyspark.sql import Window

    after = F.lead("ts").over(Window.partitionBy("mid").orderBy("ts", "seq"))
    nxt = log.select("seq", after.alias("next_ts"))
    end = log.agg(F.max("ts")).first()[0] - delay
    moment = F.least(F.coalesce("next_ts", F.col("ts") + horizon), F.col("ts") + horizon)
    return batch.join(nxt, "seq").where(moment <= end)


def test_bounces(spark, tmp_path, log, in_order):
    out = fed(spark, tmp_path, in_order).run(
        lambda pages: stateful.bounces(pages, horizon_ms=HORIZON)
    )
    batch = sequence.bounces(log, horizon_ms=HORIZON)
    assert rows(out, "mid", "seq", "page_id") == rows(decided(batch, log), "mid", "seq", "page_id")


def test_bounces_tolerate_disorder_within_the_delay(spark, tmp_path, log, in_order):
    """Neighbouring batches swapped row by row: same answer, given a long enough delay."""
    data = [r for b in in_order for r in b]
    mixed = [data[i::4] for i in range(4)]
    out = fed(spark, tmp_path, mixed).run(
        lambda pages: stateful.bounces(pages, horizon_ms=HORIZON, delay="40 days")
    )
    assert out.count() == 0  # nothing is certain yet with so long a delay

    blocks = [b for i in range(0, len(data), 20) for b in (data[i + 10 : i + 20], data[i : i + 10])]
    half = [sum(blocks[i : i + 10], []) for i in range(0, len(blocks), 10)]
    out = fed(spark, tmp_path / "b", half).run(
        lambda pages: stateful.bounces(pages, horizon_ms=HORIZON, delay="3 days")
    )
    batch = decided(sequence.bounces(log, horizon_ms=HORIZON), log, delay=3 * DAY)
    assert rows(out, "mid", "seq") == rows(batch, "mid", "seq")


def page(mid, ts, seq, last=None, is_new="1"):
    return (mid, ts, seq, is_new, last, mid, "p")


def test_day_going_back_is_let_through_again(spark, tmp_path):
    feed = fed(spark, tmp_path, [
        [page("m", T0 + 2 * DAY, 1)], [page("m", T0 + DAY, 2)], [page("m", T0 + 2 * DAY + 1, 3)],
    ])
    out = feed.run(lambda p: stateful.first_records_of_day(p, "mid", "10 days"))
    assert rows(out, "seq") == [(1,), (2,), (3,)]


def test_forgotten_visitors_start_afresh(spark, tmp_path):
    feed = fed(spark, tmp_path, [
        [page("m", T0, 1)], [page("n", T0 + 3 * DAY, 2)], [page("n", T0 + 3 * DAY + 1, 3)],
        [page("m", T0 + 3 * DAY, 4)],
    ])
    out = feed.run(lambda p: stateful.first_records_of_day(p, "mid", forget_ms=2 * DAY))
    assert rows(out, "seq", "last_day_ms") == [(1, None), (2, None), (4, None)]


def test_late_rows(spark, tmp_path):
    """Late by less than the delay: counted. Late beyond it: dropped, from the batch
    after the one that closes the window."""
    feed = Feed(spark, tmp_path, "ts bigint, n bigint")
    feed.add([(T0, 1), (T0 + 12_000, 1)])  # watermark becomes T0 + 10 s: [0, 10) closes
    feed.add([(T0 + 11_000, 10)])
    feed.add([(T0 + 5_000, 100), (T0 + 11_500, 1_000)])
    feed.add([(T0 + 60_000, 1)])

    def build(df):
        df = tm.with_event_time(df, tm.from_ms("ts"), "2 seconds")
        return windows.window_sum(df, "10 seconds", sums={"n": "n"})

    assert rows(feed.run(build), "stt", "n") == [
        ("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:10", 1_011)
    ]


def test_windows_revised_by_late_rows(spark, tmp_path):
    """Update mode: early results at once, revised while the delay lasts, replay-safe."""
    name = "dws_user_user_register_window"
    feed = Feed(spark, tmp_path, "ts bigint")
    path = str(tmp_path / "marts")
    write = marts.revising_writer(path, name, [])

    def go():
        rows_ = dws.user_register(feed.stream(streaming_session(spark)))
        run.finish(run.start_batches(
            rows_, write, str(tmp_path / "checkpoint"), {"availableNow": True}, "update"
        ), 300)
        schema = "stt string, edt string, register_ct bigint, ts bigint"
        return rows(marts.revised(spark, path, name, [], schema), "stt", "register_ct")

    s0 = T0 // 1000
    feed.add([(s0 + 1,)])
    assert go() == [("2024-01-01 00:00:00", 1)]
    feed.add([(s0 + 11,)]).add([(s0 + 9,)])  # late, but the window is still open
    assert go() == [("2024-01-01 00:00:00", 2), ("2024-01-01 00:00:10", 1)]


def test_processors_travel_by_value():
    """Workers that lack the package can still load a processor."""
    data = cloudpickle.dumps(Bounce(1000))
    code = "import pickle, sys; print(pickle.load(sys.stdin.buffer).horizon_ms)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], input=data, capture_output=True, cwd="/", env=env)
    assert out.stdout.strip() == b"1000", out.stderr


def test_restart_from_checkpoint(spark, tmp_path, log, in_order):
    feed = fed(spark, tmp_path, in_order[:2])
    first = feed.run(stateful.unique_visitors).count()
    for b in in_order[2:]:
        feed.add(b)
    out = feed.run(stateful.unique_visitors)
    assert first < out.count()
    assert rows(out, "mid", "seq") == rows(visitors.unique_visitors(log), "mid", "seq")


def test_latest_after_hold(spark, tmp_path):
    feed = Feed(spark, tmp_path, "id string, v bigint, rt timestamp, what string")
    at = lambda s: __import__("datetime").datetime(2024, 1, 1, 0, 0, s)
    feed.add([("a", 1, at(0), "old"), ("b", 5, at(0), "only")])
    feed.add([("a", 2, at(1), "new"), ("a", 1, at(2), "stale")])
    feed.add([("c", 1, at(30), "later")])
    out = feed.run(lambda df: stateful.latest_after_hold(df, "id", "v", 5_000))
    assert rows(out, "id", "v", "what") == [("a", 2, "new"), ("b", 5, "only")]
