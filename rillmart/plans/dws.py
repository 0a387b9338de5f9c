"""Ten-second marts.

Inputs are flat facts. Event time ``rt`` is derived here; on a stream it also gets
the watermark. Every plan aggregates before it enriches, so dimension joins see mart
rows, not facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillmart import codes
from rillmart.functions import time as tm
from rillmart.functions.money import MONEY, amount_or_zero, original_amount
from rillmart.operators import enrich, keywords, visitors
from rillmart.operators.changes import complete, fields, of_table
from rillmart.operators.latest import latest_per_key
from rillmart.operators.windows import bounded, window_agg, window_count_distinct, window_groups, window_sum
from rillmart.settings import DEFAULTS, Settings

TRAFFIC_KEYS = ["vc", "ch", "ar", "is_new"]
TRAFFIC_SUMS = ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")


def _number(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _measures(df: DataFrame, **given: Column) -> DataFrame:
    return df.select(
        *TRAFFIC_KEYS, *[c for c in ("ts", "rt") if c in df.columns], *[given.get(n, _number(0)).alias(n) for n in TRAFFIC_SUMS]
    )


def traffic_inputs(pages: DataFrame, unique: DataFrame, jumps: DataFrame) -> list[DataFrame]:
    """Page, unique-visitor and bounce records as measures of one shape."""
    page_rows = _measures(
        pages,
        pv_ct=_number(1),
        sv_ct=visitors.count_if(F.col("last_page_id").isNull()),
        dur_sum=F.coalesce(F.col("during_time"), _number(0)),
    )
    return [page_rows, _measures(unique, uv_ct=_number(1)), _measures(jumps, uj_ct=_number(1))]


def traffic_measures(pages: DataFrame, unique: DataFrame, jumps: DataFrame) -> DataFrame:
    """All three as one stream of measures."""
    page_rows, unique_rows, jump_rows = traffic_inputs(pages, unique, jumps)
    return page_rows.unionByName(unique_rows).unionByName(jump_rows)


def traffic_page_view(
    pages: DataFrame, unique: DataFrame, jumps: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Traffic per window. On a stream each window comes out once, when the slowest input has
    passed it; the job revises windows instead (``stateful.window_revisions``)."""

    def stamped(df: DataFrame) -> DataFrame:
        return tm.with_event_time(df, tm.from_ms("ts"), settings.traffic_delay)

    rows = traffic_measures(stamped(pages), stamped(unique), stamped(jumps))
    return window_sum(rows, settings.window, TRAFFIC_KEYS, {n: n for n in TRAFFIC_SUMS})


def source_keyword(page_log: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Words searched for, counted."""
    searched = tm.with_event_time(
        keywords.search_pages(page_log), tm.from_ms("ts"), settings.delay
    )
    # the window is the page's, so it is found before the page becomes words
    paged = searched.select(F.window("rt", settings.window).alias("_w"), "item")
    words = keywords.explode_words(paged, "item", keep=["_w"])
    counts = bounded(
        words.groupBy("_w", "keyword").agg(F.count(F.lit(1)).alias("keyword_count")),
        ["keyword", "keyword_count"],
    )
    return counts.withColumn("source", F.lit(codes.KEYWORD_SEARCH))


def home_detail_page_view(page_log: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Visitors of the home page and of product pages, once per day and kind."""
    kinds = page_log.where(F.col("page_id").isin("home", "good_detail"))
    first = visitors.day_starts(kinds, ["mid", "page_id"])
    return home_detail_window(tm.with_event_time(first, tm.from_ms("ts")), settings)


def home_detail_window(first: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Counts of first-of-day visits (``page_id, rt``) per window."""
    return window_agg(
        first,
        settings.window,
        measures={
            "home_uv_ct": F.count_if(F.col("page_id") == "home"),
            "good_detail_uv_ct": F.count_if(F.col("page_id") == "good_detail"),
        },
    )


def user_login(page_log: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    flags = visitors.login_flags(
        visitors.login_rows(page_log), back_after_days=settings.back_after_days
    )
    return user_login_window(tm.with_event_time(flags, tm.from_ms("ts")), settings)


def user_login_window(flags: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Sums of login flags (``uu, back, rt``) per window."""
    return window_sum(flags, settings.window, sums={"back_ct": "back", "uu_ct": "uu"})


def user_register(registered: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    rows = tm.with_event_time(registered, tm.from_seconds("ts"), settings.delay)
    return window_agg(rows, settings.window, measures={"register_ct": F.count(F.lit(1))})


def cart_add_uu(cart_adds: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Users adding to a cart, once per day (the day of the record's second)."""
    ms = F.col("ts") * 1000
    rows = cart_adds.select("user_id", ms.alias("ts"), tm.day(ms).alias("dt"))
    first = visitors.day_starts(rows, ["user_id"])
    return cart_add_window(tm.with_event_time(first, tm.from_ms("ts")), settings)


def cart_add_window(first: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Counts of users' first cart adds of a day (``rt``) per window."""
    return window_agg(first, settings.window, measures={"cart_add_uu_ct": F.count(F.lit(1))})


ORDER_USERS = ("order_unique_user_count", "order_new_user_count")
PAYMENT_USERS = ("payment_suc_unique_user_count", "payment_suc_new_user_count")


def user_rows(df: DataFrame, stamp: str) -> DataFrame:
    """``user_id, ts, dt`` by a date-time string; the window drops what cannot be read.

    No filter here: pushed to the scan it would parse every string a second time.
    """
    rows = df.select("user_id", tm.to_ms(stamp, full=True).alias("ts"))
    return rows.withColumn("dt", tm.day("ts"))


def user_window(
    flags: DataFrame, names: tuple[str, str], settings: Settings = DEFAULTS
) -> DataFrame:
    """Sums of user-day flags (``unique_user, new_user, rt``) per window."""
    unique, new = names
    return window_sum(flags, settings.window, sums={unique: "unique_user", new: "new_user"})


def _user_counts(df: DataFrame, stamp: str, names: tuple[str, str], settings: Settings) -> DataFrame:
    flags = visitors.user_day_flags(user_rows(df, stamp))
    return user_window(tm.with_event_time(flags, tm.from_ms("ts")), names, settings)


def trade_order(order_detail: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Ordering users per window; a user's first row of the day counts."""
    return _user_counts(order_detail, "create_time", ORDER_USERS, settings)


def payment_suc(pay_detail: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Paying users per window, by time of payment."""
    return _user_counts(pay_detail, "pay_time", PAYMENT_USERS, settings)


def province_window(changes: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Orders and amounts by province."""
    placed = of_table(changes, "order_info", "insert").select(
        *fields("province_id", "total_amount", "create_time")
    )
    rows = tm.with_event_time(placed, tm.parse_full("create_time"), settings.delay)
    return window_agg(
        rows,
        settings.window,
        ["province_id"],
        {
            "order_count": F.count(F.lit(1)),
            "order_amount": F.sum(amount_or_zero(F.col("total_amount"))).cast(MONEY),
        },
    )


def name_provinces(counted: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return enrich.enrich(
        counted, dims["dim_base_province"], "province_id", {"province_name": "name"}
    )


def province_order(
    changes: DataFrame, dims: dict[str, DataFrame], settings: Settings = DEFAULTS
) -> DataFrame:
    return name_provinces(province_window(changes, settings), dims)


_AMOUNTS = {
    "original_amount": "split_original_amount",
    "activity_amount": "split_activity_amount",
    "coupon_amount": "split_coupon_amount",
    "order_amount": "split_total_amount",
}


def sku_amounts(order_detail: DataFrame) -> DataFrame:
    """Complete details as decimals, missing amounts as zero."""
    return complete(order_detail, "user_id", "source_type").select(
        "id", "sku_id", "sku_name", "od_ts",
        *[amount_or_zero(F.col(c)).alias(n) for n, c in _AMOUNTS.items()],
    )


def sku_window(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Amounts (with ``rt``) by SKU."""
    return window_agg(rows, settings.window, ["sku_id"], _sku_measures())


def _sku_measures() -> dict[str, Column]:
    return {"sku_name": F.min("sku_name")} | {n: F.sum(n).cast(MONEY) for n in _AMOUNTS}


def sku_order(
    order_detail: DataFrame,
    dims: dict[str, DataFrame],
    settings: Settings = DEFAULTS,
    version: tuple[str, ...] | list[str] = ("row_op_ts",),
    ties: list[str] | None = None,
) -> DataFrame:
    """Amounts by SKU over the newest version of each order detail.

    What can be made again is not shuffled: the original amount comes from price and number, which
    travel anyway, after the shuffles by order and detail, and windows become text last.
    """
    newest = latest_per_key(
        complete(order_detail, "user_id", "source_type"), ["id"], list(version), ties
    )
    original = original_amount(F.col("order_price"), F.col("sku_num"))
    amounts = sku_amounts(newest.withColumn("split_original_amount", original))
    rows = tm.with_event_time(amounts, tm.from_seconds("od_ts"))
    measures = _sku_measures()
    named = enrich.add_sku(window_groups(rows, settings.window, ["sku_id"], measures), dims)
    return bounded(named, [c for c in named.columns if c != "_w"])


_REFUND_KEYS = ["user_id", "trademark_id", "category3_id"]


def _with_sku_links(rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    links = {"trademark_id": "tm_id", "category3_id": "category3_id"}
    return enrich.enrich(rows, dims["dim_sku_info"], "sku_id", links)


def name_refunds(counted: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return enrich.add_categories(enrich.add_trademark(counted, dims), dims)


def user_refund(
    refunds: DataFrame, dims: dict[str, DataFrame], settings: Settings = DEFAULTS
) -> DataFrame:
    """Orders refunded, by user, trademark and category."""
    keyed = _with_sku_links(refunds.select("user_id", "order_id", "sku_id", "ts"), dims)
    rows = tm.with_event_time(keyed, tm.from_seconds("ts"))
    counted = window_count_distinct(rows, "order_id", "refund_count", settings.window, _REFUND_KEYS)
    return name_refunds(counted, dims)


def refund_orders_window(refunds: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Stream half of ``user_refund``: the orders of each user and SKU per window.

    One row per order, so neither state nor output gathers a user's orders.
    """
    rows = tm.with_event_time(refunds, tm.from_seconds("ts"), settings.delay)
    return window_agg(
        rows, settings.window, ["user_id", "sku_id", "order_id"], {"n": F.count(F.lit(1))}
    )


def count_refunds(closed: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Other half, over closed windows with the dimensions of now.

    A window closes for all its groups at once, so the orders of several SKUs of one
    trademark and category meet here and are counted once.
    """
    counted = _with_sku_links(closed, dims).groupBy("stt", "edt", *_REFUND_KEYS).agg(
        F.countDistinct("order_id").alias("refund_count")
    )
    return name_refunds(counted, dims)
