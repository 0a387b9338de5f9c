"""What keeps the plans sound at scale: shapes of plans, and hot keys."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rillmart.catalog import QUERIES
from rillmart.functions import time as tm
from rillmart.operators import enrich, joins, latest, visitors
from rillmart.plans import dwd_db
from rillmart.sources import tables as t

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))
T0 = 1_704_067_200_000


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no dimension is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


@pytest.mark.parametrize("name", BATCH)
def test_no_query_gathers_or_crosses(spark, sf, name, no_broadcast):
    text = plan(QUERIES[name](spark, sf))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "EvalPython"):
        assert bad not in text, bad


def exchanges(text: str) -> list[str]:
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"hashpartitioning\(([^)]*)\)", text)]


def test_first_records_are_limited_before_the_shuffle(spark, sf):
    text = plan(QUERIES["unique_visitors"](spark, sf))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert text.count("WindowGroupLimit") == 2


def test_histories_are_cut_by_time_and_salt(spark, sf, no_broadcast):
    assert [e.rsplit(",", 1)[0] for e in exchanges(plan(QUERIES["user_jump"](spark, sf)))] == [
        "mid, _bucket"
    ]
    repair = [e.rsplit(",", 1)[0] for e in exchanges(plan(QUERIES["new_visitor_fix"](spark, sf)))]
    assert sorted(repair) == ["mid", "mid, _salt", "mid, _salt"]


def test_scans_read_only_what_is_used(spark, sf):
    def read(name, table):
        text = plan(QUERIES[name](spark, sf))
        found = re.findall(r"ReadSchema: struct<([^>]*)>", text)
        return {c.split(":")[0] for s in found for c in s.split(",") if c.startswith(table)}

    assert read("dim_left", "o_") == {"o_orderkey", "o_custkey"}
    assert read("dws_order_users", "l_") == {"l_orderkey", "l_linenumber", "l_shipdate"}
    assert read("keyword_tokens", "t") == {"text"}
    text = plan(QUERIES["dim_filter"](spark, sf))
    assert "EqualTo(p_brand,Brand#2)" in text and "EqualTo(p_type,ECONOMY)" in text


def test_dictionaries_are_broadcast_after_measuring(spark, sf, no_broadcast):
    assert "BroadcastHashJoin" in plan(QUERIES["lookup_inner"](spark, sf))


# -- hot keys ----------------------------------------------------------------------


def hot(rng, n, share=0.8):
    return ["hot" if rng.random() < share else f"k{rng.randrange(50)}" for _ in range(n)]


def test_hot_visitor_repair_equals_brute_force(spark):
    rng = random.Random(3)
    data = []
    for seq, mid in enumerate(hot(rng, 3000)):
        data.append((mid, T0 + rng.randrange(3 * 86_400_000), seq, rng.choice(["0", "1", None])))
    df = spark.createDataFrame(data, "mid string, ts bigint, seq bigint, is_new string")
    out = visitors.repair_new_visitors(df.withColumn("dt", tm.day("ts")))
    got = {r.seq: r.is_new for r in out.collect()}

    want, first = {}, {}
    for mid, ts, seq, is_new in sorted(data, key=lambda r: (r[1], r[2])):
        day = ts // 86_400_000
        first.setdefault(mid, day if is_new == "1" else day - 1)
        want[seq] = "0" if is_new == "1" and first[mid] != day else is_new
    assert got == want


def test_first_visits_are_found_by_hashing_also_among_ties_and_wide_numbers(spark):
    day = 86_400_000
    data = [
        ("a", T0, -(2**63), "0"), ("a", T0, 2**63 - 1, "1"), ("a", T0 + 1, 0, "1"),
        ("b", T0, 2**63 - 1, "0"), ("b", T0, -(2**63) + 1, "1"), ("b", T0 + day, 1, "1"),
        ("c", None, 2, "0"), ("c", T0, 3, "1"), ("d", None, 4, "1"), (None, T0, 5, "1"), ("e", -day, 6, "1"),
    ]
    df = spark.createDataFrame(data, "mid string, ts bigint, seq bigint, is_new string").withColumn("dt", tm.day("ts"))
    out = visitors.repair_new_visitors(df)
    got = {(r.mid, r.ts, r.seq): r.is_new for r in out.collect()}
    changed = {(m, t, s): "0" for m, t, s, _ in (data[1], data[2], data[5])}
    assert got == {(m, t, s): n for m, t, s, n in data} | changed
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_salt_spreads_a_hot_key(spark):
    df = spark.range(8000).select(F.lit("hot").alias("mid"), "id")
    salted = df.groupBy(F.pmod(F.xxhash64("id"), F.lit(8)).alias("s")).count()
    sizes = [r["count"] for r in salted.collect()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * 1000


def test_hot_order_join_is_split_and_exact(spark):
    """One order holds four fifths of the details; AQE cuts its partition."""
    rng = random.Random(5)
    orders = sorted({o for o in hot(rng, 2000)})
    details = spark.range(40_000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 5 != 0, F.lit("hot")).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))
        ).alias("order_id"),
        F.lit("x" * 200).alias("pad"),
    ).repartition(16)
    side = spark.createDataFrame([(o, f"user-{o}") for o in orders], "order_id string, user_id string")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = joins.interval_join(details, side, [("order_id", "order_id")])
        final = out.select("id", "user_id")
        got = final.collect()
        assert "skew=true" in plan(final)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert len(got) == 40_000
    assert sum(r.user_id == "user-hot" for r in got) == 32_000


def test_hot_detail_keeps_one_row(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").alias("v"),
    )
    out = latest.latest_per_key(df, ["id"], ["v"])
    assert out.where("id = 'hot'").first().v == 4999
    assert out.count() == 1 + 1667


def test_leaving_out_promotions_keeps_the_rows(spark, sf):
    log = t.change_log(spark, sf, "order_info", "order_detail", "order_detail_activity",
                       "order_detail_coupon")
    dic = enrich.checked_broadcast(t.base_dic(spark, sf))
    full = dwd_db.trade_order_pre_process(log, dic).select("id", "oi_ts", "od_ts")
    bare = dwd_db.trade_order_pre_process(log, dic, promotions=False).select("id", "oi_ts", "od_ts")
    assert full.exceptAll(bare).count() == bare.exceptAll(full).count() == 0


def test_the_sku_mart_shuffles_nothing_it_can_make_again(spark, sf):
    """Original amounts are made after the shuffle by detail, window texts after the last join."""
    text = QUERIES["dws_sku_order"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    top, below = text.split("Join LeftOuter", 1)
    assert "date_format" in top and "date_format" not in below
    assert "split_original_amount" not in below.split("Window [row_number", 1)[1]
