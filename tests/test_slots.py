"""Keyed state by slots of keys: calls do not grow with the keys, and every key keeps its own state."""

import json

import pandas as pd

from rillmart.session import streaming_session
from rillmart.streaming import run, stateful
from rillmart.streaming.processors import FirstOfDay, LatestAfterHold, LatestHeld, OrderRevisions, PromotionRoute

DAY = 86_400_000


class Handle:
    """One slot's state and timer, counting the writes."""

    def __init__(self):
        self.value, self.timers, self.writes = None, [], 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.writes = value, self.writes + 1

    def clear(self):
        self.value = None

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers = [t for t in self.timers if t != at]

    def registerTimer(self, at):
        self.timers.append(at)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now

    getCurrentProcessingTimeInMs = getCurrentWatermarkInMs


def started(processor):
    handle = Handle()
    processor.init(handle)
    return processor, handle


def rows(parts):
    return [tuple(r) for part in parts for r in part.astype(object).where(part.notna(), None).itertuples(index=False)]


def days(*records):
    return pd.DataFrame(
        [(0, k, d * DAY + at, i, d * DAY, pd.Timestamp(d * DAY, unit="ms"), "{}") for i, (k, d, at) in enumerate(records)],
        columns=["slot", "key", "ts", "seq", "day_ms", "rt", "value"],
    )


def test_first_of_day_of_many_keys_in_one_call():
    p, handle = started(FirstOfDay(2 * DAY))
    got = rows(p.handleInputRows((0,), iter([days(("a", 1, 5), ("b", 1, 1)), days(("a", 1, 3), (None, 2, 0), ("b", 2, 0))]), Clock(0)))
    assert [(r[0], r[1], r[6]) for r in got] == [
        ("b", DAY + 1, None), ("a", DAY + 3, None), (None, 2 * DAY, None), ("b", 2 * DAY, DAY),
    ]
    assert handle.writes == 1 and handle.timers == [3 * DAY + 5]
    # a's time is over, b's and the absent key's are not; then a is new again
    assert rows(p.handleExpiredTimer((0,), Clock(3 * DAY + 6), None)) == [] and handle.timers == [4 * DAY]
    got = rows(p.handleInputRows((0,), iter([days(("a", 5, 0), ("b", 5, 0))]), Clock(3 * DAY + 6)))
    assert [(r[0], r[6]) for r in got] == [("a", None), ("b", 2 * DAY)]


def versions(*records):
    return pd.DataFrame([(0, k, v, pd.Timestamp(at, unit="ms"), x) for k, v, at, x in records], columns=["slot", "key", "version", "rt", "value"])


def test_holds_of_many_keys_end_each_at_its_time():
    for processor in (LatestAfterHold(5_000), LatestHeld(5_000)):
        p, handle = started(processor)
        by_clock = isinstance(p, LatestHeld)
        p.handleInputRows((0,), iter([versions(("a", 1, 1_000, "x"), ("b", 7, 4_000, "b")), versions(("a", 3, 2_000, "y"), ("a", 2, 1_500, "z"))]), Clock(0))
        p.handleInputRows((0,), iter([versions(("a", 3, 2_000, "last"), ("c", 1, 9_000, "c"))]), Clock(3_000))
        assert handle.writes == 2 and handle.timers == [5_000 if by_clock else 6_000]
        out = rows(p.handleExpiredTimer((0,), Clock(8_000), None))
        assert [(r[0], r[1], r[3]) for r in out] == [("a", 3, "last"), ("b", 7, "b")][: 2 if by_clock else 1]
        left = rows(p.handleExpiredTimer((0,), Clock(15_000), None))
        assert [r[0] for r in left] == (["c"] if by_clock else ["b", "c"])
        assert handle.value is None and handle.timers == []


def test_promotions_find_the_orders_of_their_own_details():
    def came(*records):
        return pd.DataFrame([(0, k, kind, o, 10, pd.Timestamp(10, unit="ms"), v) for k, kind, o, v in records],
                            columns=["slot", "key", "kind", "order_id", "ms", "rt", "value"])

    p, handle = started(PromotionRoute(100))
    got = rows(p.handleInputRows((0,), iter([came(("1", "activity", None, "A"), ("2", "d", "o2", None), ("2", "coupon", None, "C"))]), Clock(0)))
    assert [r[:4] for r in got] == [("2", "coupon", "o2", 10)]
    got = rows(p.handleInputRows((0,), iter([came(("1", "d", "o1", None))]), Clock(0)))
    assert [r[:4] for r in got] == [("1", "activity", "o1", 10)] and handle.writes == 2 and handle.timers == [111]
    assert rows(p.handleExpiredTimer((0,), Clock(112), None)) == [] and handle.value is None


def test_orders_of_a_slot_are_revised_apart():
    def came(*records):
        return pd.DataFrame([(0, k, kind, i, 10, pd.Timestamp(10, unit="ms"), v) for k, kind, i, v in records],
                            columns=["slot", "key", "kind", "id", "ms", "rt", "value"])

    p, handle = started(OrderRevisions(100, ("activity", "coupon")))
    first = came(("o", "d", "1", "d1"), ("p", "d", "2", "d2"), ("o", "o", None, "new"), ("o", "o", None, "new"))
    assert [(r[0], r[1], *r[3:]) for r in rows(p.handleInputRows((0,), iter([first]), Clock(0)))] == [("o", "1", "d1", "new", None, None)]
    then = came(("p", "o", None, "late"), ("p", "coupon", "2", "C"), ("o", "activity", "1", "A"), ("o", "activity", "2", "B"))
    assert sorted((r[0], r[1], *r[3:]) for r in rows(p.handleInputRows((0,), iter([then]), Clock(0)))) == [
        ("o", "1", "d1", "new", "A", None), ("p", "2", "d2", "late", None, "C"),
    ]
    assert handle.writes == 2 and json.loads(handle.value[1][0])[1] == [[10, "new"]]


def test_a_drain_takes_the_time_its_input_needs(spark, tmp_path, monkeypatch):
    spark.range(3).write.parquet(f"{tmp_path}/in")
    waits = []
    finish = run.finish
    monkeypatch.setattr(run, "finish", lambda query, timeout=600: (waits.append(timeout), finish(query, timeout)))
    out = run.drain(spark, lambda s: s.readStream.schema("id bigint").parquet(f"{tmp_path}/in"), "all")
    assert out.count() == 3 and waits == [None]


def test_keys_are_dealt_to_a_bounded_number_of_slots(spark):
    ids = spark.range(5_000).selectExpr("cast(nullif(id, 0) as string) AS key").select(stateful._slot(slots=64)).distinct()
    assert {r["slot"] for r in ids.collect()} == set(range(64))


def test_state_stores_of_an_executor_share_one_memory_budget(spark):
    """The order join keeps a dozen stores a partition."""
    conf = streaming_session(spark).conf
    assert conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage") == "true"
    assert int(conf.get("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB")) <= 2048
