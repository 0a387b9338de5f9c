"""Every operator and job as a runnable query over the benchmark tables.

Windows are an hour and the bounce horizon six hours, because the supplied events are
minutes apart; the production defaults stay in ``settings``. All times are UTC.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart import codes
from rillmart.functions import time as tm
from rillmart.functions.money import MONEY, amount, amount_or_zero, original_amount
from rillmart.operators import changes as ch
from rillmart.operators import asof, dims, enrich, joins, keywords, latest, parse, sequence, split
from rillmart.operators import visitors, windows
from rillmart.plans import dim as dim_plan
from rillmart.plans import dwd_db, dwd_log, dws
from rillmart.session import tune
from rillmart.settings import DEFAULTS
from rillmart.sources import tables as t
from rillmart.streaming import run, stateful

Query = Callable[[SparkSession, str], DataFrame]

ZONE = "UTC"
HORIZON_MS = 6 * 3_600_000
WIDE = replace(DEFAULTS, zone=ZONE, window="1 hour", bounce_horizon_ms=HORIZON_MS)

_KEYS = ["vc", "ch", "ar", "is_new"]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark, ZONE)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _dic(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.checked_broadcast(t.base_dic(spark, sf))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "events")


def _days(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", F.date_format("dt", tm.DAY))


def _log(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return parse.parse_app_log(t.raw_log(_events(spark, sf)), keep=["seq"])


# -- scans and sinks ---------------------------------------------------------------


@query
def scan_changelog(spark, sf):
    good, _ = parse.parse_changes(t.raw_changes(_events(spark, sf)), keep=["seq"])
    return good.select(
        "seq", "table", "type", "ts", ch.field("coupon_status").alias("coupon_status"),
        ch.previous("coupon_status").alias("old_status"), ch.field("missing").alias("missing"),
    )


@query
def upsert_latest(spark, sf):
    rows = ch.of_table(t.change_log(spark, sf, "order_info"), "order_info").select(
        *ch.fields("id", "order_status", "total_amount"), "ts"
    )
    return latest.latest_per_key(rows, ["id"], ["ts"], ["order_status"])


@query
def cdc_current_state(spark, sf):
    return latest.current_state(t.row_changes(spark, sf), "id", ["ts_ms"])


@query
def dim_upsert(spark, sf):
    rows = dim_plan.dim_sink(
        t.dim_changes(spark, sf), t.config_changes(spark), ["ts_ms"], keep=["ts"]
    )
    last = dims.latest_rows(rows, ["ts"])
    return last.select(
        "sink_table", "pk", "type", F.col("data")["sku_name"].alias("sku_name"),
        F.col("data")["name"].alias("name"), F.col("data")["weight"].alias("weight"),
        F.col("data")["price"].alias("price"),
    )


@query
def dim_filter(spark, sf):
    sku = t.dims(spark, sf)["dim_sku_info"]
    return dims.where_equal(sku, tm_id="Brand#2", spu_id="ECONOMY")


# -- projections, filters, splits --------------------------------------------------


@query
def json_extract(spark, sf):
    log, _ = _log(spark, sf)
    return log.select(
        "seq", F.col("common.mid").alias("mid"), F.col("page.during_time").alias("during_time"),
        F.col("start")["loading_time"].cast("bigint").alias("loading_time"),
        F.size("actions").alias("n_actions"), "ts",
        F.get_json_object("err", "$.error_code").alias("error_code"),
    )


@query
def dirty_split(spark, sf):
    good, dirty = _log(spark, sf)
    return good.select("seq", F.lit("good").alias("kind"), F.lit(None).cast("int").alias("size")).unionByName(
        dirty.select("seq", F.lit("dirty").alias("kind"), F.length("value").alias("size"))
    )


@query
def map_project(spark, sf):
    """Map entries as columns; a key the map lacks reads as null."""
    return ch.of_table(t.dim_changes(spark, sf), "sku_info").select(
        *ch.fields("id", "sku_name", "price", absent="no_such_column"), "type"
    )


@query
def filter_change_type(spark, sf):
    rows = ch.of_table(t.change_log(spark, sf, "order_info"), "order_info", "insert", "update")
    return rows.groupBy("type", ch.field("order_status").alias("order_status")).agg(
        F.count(F.lit(1)).alias("n"), F.count(ch.previous("order_status")).alias("moved")
    )


@query
def status_transition(spark, sf):
    rows = ch.of_table(t.change_log(spark, sf, "order_info"), "order_info", "update")
    return rows.where(ch.moved_to("order_status", codes.ORDER_REFUNDING)).select(
        *ch.fields("id", "user_id"), "ts"
    )


@query
def cart_delta(spark, sf):
    rows = ch.of_table(t.change_log(spark, sf, "cart_info"), "cart_info")
    return ch.added(rows, "sku_num", "added").select(*ch.fields("id", "sku_num"), "type", "added")


@query
def config_prune(spark, sf):
    rows = ch.of_table(t.dim_changes(spark, sf), "sku_info", "insert")
    kept = rows.select(
        ch.field("id").alias("id"), dims.prune(F.col("data"), F.lit("id,sku_name,tm_id")).alias("d")
    )
    return kept.select(
        "id", F.col("d")["sku_name"].alias("sku_name"), F.col("d")["price"].alias("price"),
        F.size("d").alias("kept"),
    )


@query
def not_null_filter(spark, sf):
    rows = t.page_log(spark, sf).select("seq", "uid", "last_page_id")
    return ch.complete(rows, "uid", "last_page_id")


@query
def unnest_actions(spark, sf):
    log, _ = _log(spark, sf)
    return split.actions(log, ("seq",)).select(
        "seq", F.col("action")["action_id"].alias("action_id"),
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts",
    )


@query
def unnest_displays(spark, sf):
    log, _ = _log(spark, sf)
    return split.displays(log, ("seq",)).select(
        "seq", F.col("display")["item"].alias("item"), F.col("common.mid").alias("mid"), "ts"
    )


@query
def split_pages(spark, sf):
    log, _ = _log(spark, sf)
    return split.flatten_pages(split.pages(log, ("seq",))).drop("dt")


@query
def split_starts(spark, sf):
    log, _ = _log(spark, sf)
    return split.starts(log, ("seq",)).select(
        "seq", F.col("common.mid").alias("mid"), F.col("start")["entry"].alias("entry"),
        F.col("start")["loading_time"].alias("loading_time"), "ts",
    )


@query
def split_errors(spark, sf):
    log, _ = _log(spark, sf)
    return split.errors(log, ("seq",)).select(
        "seq", F.get_json_object("err", "$.error_code").alias("error_code")
    )


@query
def base_log(spark, sf):
    rows = dwd_log.base_log(t.raw_log(_events(spark, sf)), settings=WIDE)
    return rows.groupBy("topic", F.get_json_object("value", "$.common.is_new").alias("is_new")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seq_sum")
    )


# -- joins -------------------------------------------------------------------------


@query
def join_inner(spark, sf):
    log = t.change_log(spark, sf, "order_detail", "order_info")
    details, orders = dwd_db.order_details(log), dwd_db.order_changes(log)
    return joins.interval_join(
        details.select("id", "order_id", "split_original_amount"),
        orders, [("order_id", "order_id")], keep=["user_id", "order_status"],
    )


@query
def join_composite(spark, sf):
    log = t.change_log(spark, sf, "refund_payment", "order_refund_info")
    paid = ch.of_table(log, "refund_payment").select(*ch.fields("id", "order_id", "sku_id"))
    asked = ch.of_table(log, "order_refund_info").select(
        *ch.fields("order_id", "sku_id", "refund_num")
    )
    return joins.interval_join(paid, asked, [("order_id", "order_id"), ("sku_id", "sku_id")])


@query
def join_left(spark, sf):
    log = t.change_log(spark, sf, "order_detail", "order_detail_activity")
    details = dwd_db.order_details(log).select("id", "order_id", "od_ts")
    return joins.interval_join(
        details, dwd_db.detail_activities(log), [("id", "order_detail_id")], "left",
        keep=["activity_id", "activity_rule_id"],
    )


@query
def join_within_interval(spark, sf):
    log = t.change_log(spark, sf, "order_detail", "order_info")
    details = tm.with_event_time(
        dwd_db.order_details(log).select("id", "order_id", "od_ts"), tm.from_seconds("od_ts")
    )
    orders = tm.with_event_time(dwd_db.order_changes(log), tm.from_seconds("oi_ts"))
    return joins.interval_join(
        details, orders, [("order_id", "order_id")], span="30 days",
        keep=["order_status", "oi_ts"],
    ).drop("rt")


@query
def lookup_inner(spark, sf):
    carts = ch.of_table(t.change_log(spark, sf, "cart_info"), "cart_info").select(
        *ch.fields("id", "source_type")
    )
    return enrich.lookup(carts, _dic(spark, sf), "source_type", "dic_name")


@query
def lookup_twice(spark, sf):
    dic = _dic(spark, sf)
    rows = ch.of_table(t.change_log(spark, sf, "order_refund_info"), "order_refund_info").select(
        *ch.fields("id", "sku_id", "refund_type", "refund_reason_type")
    )
    named = enrich.lookup(rows, dic, "refund_type", "type_name")
    return enrich.lookup(named, dic, "refund_reason_type", "reason_name")


@query
def lookup_as_of(spark, sf):
    """Cart records named as the dictionary stood at their second."""
    history = asof.dictionary_history(t.dic_changes(spark, sf), ties=["seq"])
    carts = t.change_log(spark, sf, "cart_info")
    return dwd_db.trade_cart_add(carts, history).select("id", "user_id", "sku_num", "dic_name", "ts")


@query
def config_join(spark, sf):
    rows = dim_plan.dim_sink(t.dim_changes(spark, sf), t.config_changes(spark), ["ts_ms"])
    return rows.groupBy("sink_table", "type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("data")).alias("entries")
    )


@query
def dim_left(spark, sf):
    orders = ch.of_table(t.change_log(spark, sf, "order_info"), "order_info", "insert").select(
        *ch.fields("id", "province_id")
    )
    return enrich.enrich(
        orders, t.dims(spark, sf)["dim_base_province"], "province_id", {"province_name": "name"}
    )


@query
def dim_snowflake(spark, sf):
    rows = dwd_db.order_details(t.change_log(spark, sf, "order_detail")).groupBy("sku_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return enrich.add_sku(rows, t.dims(spark, sf))


# -- aggregations ------------------------------------------------------------------


def _with_rt(df: DataFrame) -> DataFrame:
    return tm.with_event_time(df, tm.from_ms("ts"))


@query
def window_keyed_sum(spark, sf):
    rows = _with_rt(t.page_log(spark, sf))
    return windows.window_sum(
        rows, WIDE.window, ["ch", "page_id"], {"dur_sum": "during_time"}, carried=["vc"]
    )


@query
def window_global_sum(spark, sf):
    rows = _with_rt(t.page_log(spark, sf))
    return windows.window_agg(
        rows, WIDE.window,
        measures={"pv_ct": F.count(F.lit(1)), "dur_sum": F.sum("during_time")},
    )


@query
def keyword_window_count(spark, sf):
    return dws.source_keyword(t.search_log(spark, sf), replace(WIDE, window="1 day"))


@query
def window_count_distinct(spark, sf):
    rows = _with_rt(t.page_log(spark, sf))
    return windows.window_count_distinct(rows, "mid", "visitors", WIDE.window, ["page_id"])


@query
def union_measures(spark, sf):
    pages = t.page_log(spark, sf)
    rows = dws.traffic_measures(
        pages, dwd_log.unique_visitor_detail(pages), dwd_log.user_jump_detail(pages, WIDE, _KEYS)
    )
    names = ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")
    return rows.groupBy("vc", "ch").agg(*[F.sum(n).alias(n) for n in names])


# -- scalar functions --------------------------------------------------------------


@query
def amount_math(spark, sf):
    d = dwd_db.order_details(t.change_log(spark, sf, "order_detail"))
    split_ = amount_or_zero(F.col("split_activity_amount")) + amount_or_zero(
        F.col("split_coupon_amount")
    )
    return d.select(
        "id", "sku_id", original_amount(F.col("order_price"), F.col("sku_num")).alias("original"),
        (amount(F.col("split_total_amount")) - split_).cast(MONEY).alias("net"),
        (F.col("sku_num").try_cast("bigint") * 1000).alias("milli"),
        F.col("sku_id").try_cast("bigint").alias("sku_number"),
    )


@query
def epoch_conversions(spark, sf):
    e = _events(spark, sf).select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms")
    )
    text = tm.full_string("ms")
    return e.select(
        "event_id", "ms", tm.day_string("ms").alias("day"), text.alias("full_text"),
        tm.to_ms(tm.day_string("ms")).alias("midnight_ms"),
        tm.to_ms(text, full=True).alias("second_ms"),
    )


@query
def keyword_tokens(spark, sf):
    docs = t.table(spark, sf, "documents")
    words = keywords.explode_words(docs, "text", keep=["doc_id"])
    return words.groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))


# -- histories ---------------------------------------------------------------------


@query
def new_visitor_fix(spark, sf):
    fixed = visitors.repair_new_visitors(t.page_log(spark, sf))
    return fixed.select("seq", "mid", "is_new")


@query
def unique_visitors(spark, sf):
    rows = visitors.unique_visitors(t.page_log(spark, sf))
    return _days(rows).select("mid", "dt", "seq", "ts", "vc", "ch", "page_id")


@query
def user_jump(spark, sf):
    rows = sequence.bounces(
        t.page_log(spark, sf), horizon_ms=HORIZON_MS, keep=["page_id", "ch"]
    )
    return rows.select("mid", "seq", "ts", "page_id", "ch")


@query
def order_user_flags(spark, sf):
    rows = t.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts"),
    )
    return _days(visitors.user_day_flags(rows.withColumn("dt", tm.day("ts"))))


@query
def login_backflow(spark, sf):
    logins = visitors.login_rows(t.page_log(spark, sf))
    return _days(visitors.login_flags(logins, back_after_days=1))


@query
def cart_unique_users(spark, sf):
    carts = dwd_db.trade_cart_add(t.change_log(spark, sf, "cart_info"), _dic(spark, sf))
    ms = F.col("ts") * 1000
    rows = carts.select("user_id", ms.alias("ts"), tm.day(ms).alias("dt"))
    return _days(visitors.day_starts(rows, ["user_id"]))


@query
def dedup_latest(spark, sf):
    details = dwd_db.order_details(t.change_log(spark, sf, "order_detail"))
    return latest.latest_per_key(
        details, ["id"], ["od_ts"], ["sku_id", "source_id", "order_price", "sku_num",
                                     "split_activity_amount", "split_coupon_amount"],
    ).select("id", "od_ts", "sku_id", "order_price", "sku_num")


@query
def latest_by_row_ts(spark, sf):
    """Stamps with fractions of different length, compared as times."""
    stamp = F.concat(
        F.lit("2022-08-26 07:47:55."),
        F.when(F.pmod("event_id", F.lit(2)) == 0, F.pmod("event_id", F.lit(100)).cast("string"))
        .otherwise(F.lpad(F.pmod("event_id", F.lit(1000)).cast("string"), 3, "0")),
        F.lit("Z"),
    )
    rows = _events(spark, sf).select("event_id", "user_id", stamp.alias("row_op_ts"))
    return latest.latest_by_row_stamp(rows, ["user_id"], ties=["event_id"])


# -- fact jobs ---------------------------------------------------------------------


@query
def dwd_interaction_comment(spark, sf):
    return dwd_db.interaction_comment(t.change_log(spark, sf, "comment_info"), _dic(spark, sf))


@query
def dwd_interaction_favor_add(spark, sf):
    return dwd_db.interaction_favor_add(t.change_log(spark, sf, "favor_info"))


@query
def dwd_tool_coupon_get(spark, sf):
    return dwd_db.tool_coupon_get(t.change_log(spark, sf, "coupon_use"))


@query
def dwd_tool_coupon_order(spark, sf):
    return dwd_db.tool_coupon_order(t.change_log(spark, sf, "coupon_use"))


@query
def dwd_tool_coupon_pay(spark, sf):
    return dwd_db.tool_coupon_pay(t.change_log(spark, sf, "coupon_use"))


@query
def dwd_user_register(spark, sf):
    return dwd_db.user_register(t.change_log(spark, sf, "user_info"))


@query
def dwd_trade_cart_add(spark, sf):
    return dwd_db.trade_cart_add(t.change_log(spark, sf, "cart_info"), _dic(spark, sf))


_WIDE_TABLES = ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")


def _wide(spark, sf):
    return dwd_db.trade_order_pre_process(t.change_log(spark, sf, *_WIDE_TABLES), _dic(spark, sf))


def _placed(spark, sf):
    """Placed orders for readers that use no promotion."""
    log = t.change_log(spark, sf, "order_info", "order_detail")
    return dwd_db.trade_order_detail(
        dwd_db.trade_order_pre_process(log, _dic(spark, sf), promotions=False)
    )


_TIES = [
    "sku_id", "source_id", "order_price", "sku_num", "split_activity_amount",
    "split_coupon_amount", "source_type",
]


def _order_detail(spark, sf):
    """Placed orders as their upsert table holds them: one row per detail."""
    return latest.latest_per_key(
        dwd_db.trade_order_detail(_wide(spark, sf)), ["order_id", "id"], ["od_ts", "oi_ts"], _TIES
    )


@query
def order_wide(spark, sf):
    return _wide(spark, sf).withColumn("old_status", ch.previous("order_status")).drop("old")


@query
def dwd_trade_order_detail(spark, sf):
    return _order_detail(spark, sf)


@query
def dwd_trade_cancel_detail(spark, sf):
    wide = dwd_db.trade_order_pre_process(
        t.change_log(spark, sf, *_WIDE_TABLES), _dic(spark, sf), orders_first=True
    )
    return latest.latest_per_key(
        dwd_db.trade_cancel_detail(wide), ["order_id", "id"], ["od_ts", "oi_ts"], _TIES
    )


@query
def dwd_trade_pay_detail_suc(spark, sf):
    return dwd_db.trade_pay_detail_suc(
        t.change_log(spark, sf, "payment_info"), _order_detail(spark, sf), _dic(spark, sf)
    )


@query
def dwd_trade_order_refund(spark, sf):
    return dwd_db.trade_order_refund(t.change_log(spark, sf, "order_info", "order_refund_info"), _dic(spark, sf))


@query
def dwd_trade_refund_pay_suc(spark, sf):
    return dwd_db.trade_refund_pay_suc(t.change_log(spark, sf, "refund_payment", "order_refund_info", "order_info"), _dic(spark, sf))


# -- marts -------------------------------------------------------------------------


@query
def dws_traffic_page_view(spark, sf):
    pages = t.page_log(spark, sf)
    return dws.traffic_page_view(
        pages, dwd_log.unique_visitor_detail(pages), dwd_log.user_jump_detail(pages, WIDE, _KEYS), WIDE
    )


@query
def dws_keyword(spark, sf):
    return dws.source_keyword(t.search_log(spark, sf), WIDE)


@query
def dws_home_detail_uv(spark, sf):
    return dws.home_detail_page_view(t.page_log(spark, sf), WIDE)


@query
def dws_user_login(spark, sf):
    return dws.user_login(t.page_log(spark, sf), replace(WIDE, back_after_days=1))


@query
def dws_user_register(spark, sf):
    return dws.user_register(dwd_db.user_register(t.change_log(spark, sf, "user_info")), WIDE)


@query
def dws_cart_uu(spark, sf):
    return dws.cart_add_uu(dwd_db.trade_cart_add(t.change_log(spark, sf, "cart_info"), _dic(spark, sf)), WIDE)


@query
def dws_order_users(spark, sf):
    return dws.trade_order(_placed(spark, sf), WIDE)


@query
def dws_payment_users(spark, sf):
    log, dic = t.change_log(spark, sf, "order_info", "order_detail", "payment_info"), _dic(spark, sf)
    wide = dwd_db.trade_order_pre_process(log, dic, promotions=False)
    detail = dwd_db.trade_order_detail(wide)
    return dws.payment_suc(dwd_db.trade_pay_detail_suc(log, detail, dic), WIDE)


@query
def dws_province_order(spark, sf):
    return dws.province_order(t.change_log(spark, sf, "order_info"), t.dims(spark, sf), WIDE)


@query
def dws_sku_order(spark, sf):
    return dws.sku_order(
        _placed(spark, sf), t.dims(spark, sf), WIDE, version=["od_ts"], ties=_TIES
    )


@query
def dws_refund(spark, sf):
    refunds = dwd_db.trade_order_refund(t.change_log(spark, sf, "order_info", "order_refund_info"), _dic(spark, sf))
    return dws.user_refund(refunds, t.dims(spark, sf), replace(WIDE, window="30 days"))


# -- stream faces ------------------------------------------------------------------
# Each runs a real streaming query over all available input and returns its output.


def _page_stream(session: SparkSession, sf: str) -> DataFrame:
    return t.flat_pages(t.stream_table(session, sf, "events"))


@query
def stream_window_append(spark, sf):
    """Window sums that the watermark (two seconds behind) has closed."""

    def build(session):
        rows = tm.with_event_time(_page_stream(session, sf), tm.from_ms("ts"), WIDE.delay)
        return windows.window_sum(rows, WIDE.window, ["ch"], {"dur_sum": "during_time"})

    return run.drain(spark, build, "stream_window_append")


@query
def stream_window_lateness(spark, sf):
    """Windows that may be revised for ten minutes, as they stand when the input ends."""

    def build(session):
        rows = _page_stream(session, sf).select("ch", "during_time", tm.from_ms("ts").alias("rt"))
        sums = rows.withColumn("pv_ct", F.lit(1).cast("bigint")).withColumnRenamed("during_time", "dur_sum")
        return stateful.window_revisions([sums], WIDE.window, ["ch"], ["pv_ct", "dur_sum"], WIDE.delay, "10 minutes")

    rows = run.drain(spark, build, "stream_window_lateness")
    return rows.groupBy("stt", "edt", "ch").agg(F.max("pv_ct").alias("pv_ct"), F.max("dur_sum").alias("dur_sum"))


@query
def stream_window_count_distinct(spark, sf):
    def build(session):
        rows = tm.with_event_time(_page_stream(session, sf), tm.from_ms("ts"), WIDE.delay)
        return windows.window_count_distinct(rows, "mid", "visitors", WIDE.window, ["page_id"])

    return run.drain(spark, build, "stream_window_count_distinct")


@query
def stream_new_visitor_fix(spark, sf):
    def build(session):
        pages = _page_stream(session, sf).select("mid", "ts", "seq", "is_new", "page_id")
        return stateful.repair_new_visitors(pages)

    return run.drain(spark, build, "stream_new_visitor_fix").select("seq", "mid", "is_new")


@query
def stream_unique_visitors(spark, sf):
    def build(session):
        return stateful.unique_visitors(
            _page_stream(session, sf).select("mid", "ts", "seq", "last_page_id", "vc", "ch", "page_id")
        )

    return run.drain(spark, build, "stream_unique_visitors").drop("last_page_id", "rt")


@query
def stream_order_user_flags(spark, sf):
    def build(session):
        orders = t.stream_table(session, sf, "orders").select(
            F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("seq"),
            F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts"),
        )
        return stateful.user_day_flags(orders)

    rows = run.drain(spark, build, "stream_order_user_flags").drop("rt")
    return _days(rows.withColumn("user_id", F.col("user_id").cast("bigint")))


@query
def stream_login_backflow(spark, sf):
    def build(session):
        return stateful.login_flags(
            visitors.login_rows(_page_stream(session, sf)), back_after_days=1
        )

    return _days(run.drain(spark, build, "stream_login_backflow").drop("rt"))


@query
def stream_user_jump(spark, sf):
    """Bounces whose fate is certain: the watermark has passed what decides them."""

    def build(session):
        pages = _page_stream(session, sf).select("mid", "ts", "seq", "last_page_id", "page_id", "ch")
        return stateful.bounces(pages, horizon_ms=HORIZON_MS)

    return run.drain(spark, build, "stream_user_jump").drop("rt", "last_page_id")


@query
def stream_dedup_latest(spark, sf):
    """The newest detail of each product, once its hold of five seconds is over."""

    def build(session):
        log = t.as_topic(t.order_detail(t.stream_table(session, sf, "lineitem")))
        details = dwd_db.order_details(log).select("sku_id", "od_ts")
        stamped = details.withColumn("rt", tm.from_seconds("od_ts"))
        return stateful.latest_after_hold(stamped, "sku_id", "od_ts", 5_000)

    return run.drain(spark, build, "stream_dedup_latest").select("sku_id", "od_ts")


@query
def stream_order_wide(spark, sf):
    """The order join on streams: each side remembers thirty days of event time."""

    def build(session):
        orders = t.stream_table(session, sf, "orders")
        parts = [t.order_info(orders), *t.promotions_of_orders(orders)]
        parts.append(t.order_detail(t.stream_table(session, sf, "lineitem")))
        dic = _dic(session, sf)
        wide = dwd_db.trade_order_pre_process(t.as_topic(*parts), dic, span="30 days", delay="1 day")
        return wide.select("id", "order_id", "order_status", "source_type", "od_ts", "oi_ts",
                           "activity_id", "coupon_id")

    return run.drain(spark, build, "stream_order_wide")


@query
def stream_order_revisions(spark, sf):
    """Order rows at once, revised by promotions: the newest revision of each."""

    def build(session, piece):
        orders = t.stream_table(session, sf, "orders")
        parts = [t.order_info(orders), *t.promotions_of_orders(orders)]
        parts.append(t.order_detail(t.stream_table(session, sf, "lineitem")))
        return stateful.order_revisions(t.as_topic(*parts), "30 days", "1 day", piece)

    pieces = t.pieces(spark, sf, ["orders", "lineitem"], DEFAULTS.drain_rows)
    rows = run.drain_in_pieces(spark, build, "stream_order_revisions", pieces)
    newest = [F.max(c).alias(c) for c in ("activity_id", "coupon_id")]
    return rows.groupBy("id", "order_id", "order_status", "source_type", "od_ts", "oi_ts").agg(*newest)
