"""Fact tables from database change records.

Each plan narrows the records to its table and columns before any join, and drops
facts without a dictionary entry before they are shuffled. ``ts`` is the record's
epoch second. Arrival-time columns (``pt``, ``row_op_ts``) are added by the sinks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillmart import codes
from rillmart.functions import time as tm
from rillmart.functions.money import original_amount
from rillmart.operators.asof import is_history, lookup_as_of
from rillmart.operators.changes import added, field, fields, moved_to, of_table
from rillmart.operators.enrich import lookup
from rillmart.operators.joins import interval_join


def name_code(
    df: DataFrame, dic: DataFrame | None, code: str, name: str | None = None, at: str | Column = "ts"
) -> DataFrame:
    """Add a code's name as ``name``, or put it in the code's place without one.

    Without a dictionary the codes stay: a stream that must see the dictionary of the
    moment names them batch by batch, after its joins. A dictionary with its history
    (``asof.dictionary_history``) names a fact as of its epoch second ``at``.
    """
    if dic is None:
        return df
    out = name or "_name"
    named = lookup_as_of(df, dic, code, out, at) if is_history(dic) else lookup(df, dic, code, out)
    return named if name else named.drop(code).withColumnRenamed("_name", code)


def _stamped(df: DataFrame, delay: str | None, ts: str = "ts") -> DataFrame:
    return tm.with_event_time(df, tm.from_seconds(ts), delay)


# -- single-table facts ------------------------------------------------------------


def interaction_comment(changes: DataFrame, dic: DataFrame) -> DataFrame:
    comments = of_table(changes, "comment_info", "insert").select(
        *fields("id", "user_id", "sku_id", "order_id", "create_time", appraise_code="appraise"),
        "ts",
    )
    return name_code(comments, dic, "appraise_code", "appraise_name")


def interaction_favor_add(changes: DataFrame) -> DataFrame:
    return of_table(changes, "favor_info", "insert").select(
        *fields("id", "user_id", "sku_id", "create_time"), "ts"
    )


def tool_coupon_get(changes: DataFrame) -> DataFrame:
    return of_table(changes, "coupon_use", "insert").select(
        *fields("id", "coupon_id", "user_id", "get_time"), "ts"
    )


def tool_coupon_order(changes: DataFrame) -> DataFrame:
    """Coupons moving from unused to in use."""
    moved = moved_to("coupon_status", codes.COUPON_USING, codes.COUPON_UNUSED)
    return of_table(changes, "coupon_use", "update").where(moved).select(
        *fields("id", "coupon_id", "user_id", "order_id", order_time="using_time"), "ts"
    )


def tool_coupon_pay(changes: DataFrame) -> DataFrame:
    """Coupon updates that carry a time of use."""
    return of_table(changes, "coupon_use", "update").where(field("used_time").isNotNull()).select(
        *fields("id", "coupon_id", "user_id", "order_id", payment_time="used_time"), "ts"
    )


def user_register(changes: DataFrame) -> DataFrame:
    return of_table(changes, "user_info", "insert").select(
        *fields("create_time", user_id="id"), "ts"
    )


def trade_cart_add(changes: DataFrame, dic: DataFrame) -> DataFrame:
    """What each record adds to a cart, named by its source."""
    rows = added(of_table(changes, "cart_info"), "sku_num", "added_num").select(
        *fields("id", "user_id", "sku_id", "cart_price"),
        F.col("added_num").alias("sku_num"),
        *fields(
            "sku_name", "is_checked", "create_time", "operate_time", "is_ordered", "order_time",
            "source_type", "source_id",
        ),
        "ts",
    )
    return name_code(rows, dic, "source_type", "dic_name").drop("source_type")


# -- orders ------------------------------------------------------------------------


def order_details(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_detail", "insert").select(
        *fields(
            "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time",
            "source_type", "source_id", "split_total_amount", "split_activity_amount",
            "split_coupon_amount",
        ),
        original_amount(field("order_price"), field("sku_num")).alias("split_original_amount"),
        F.col("ts").alias("od_ts"),
    )


def order_changes(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_info", "insert", "update").select(
        *fields("order_status", "user_id", "operate_time", "province_id", order_id="id"),
        "type",
        "old",
        F.col("ts").alias("oi_ts"),
    )


def detail_activities(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_detail_activity", "insert").select(
        *fields("order_detail_id", "activity_id", "activity_rule_id"), "ts"
    )


def detail_coupons(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_detail_coupon", "insert").select(
        *fields("order_detail_id", "coupon_id", "coupon_use_id"), "ts"
    )


def trade_order_pre_process(
    changes: DataFrame,
    dic: DataFrame | None,
    span: str | None = None,
    delay: str | None = None,
    promotions: bool = True,
    orders_first: bool = False,
) -> DataFrame:
    """Order wide rows: detail x order change, with promotions and source name.

    With ``span`` the sides match only that close in event time, which is what a
    stream needs to forget them; streams therefore pass ``span`` and ``delay``. Each
    detail and order change comes out once, in its final form.

    A stream joins the order first, so a row without promotions waits as little as
    possible. Batch joins both promotions first, on one partitioning by detail id, while
    there is still one row per detail, and then exchanges the result by order id. With
    ``promotions=False`` their columns are left out, for readers that use none of them; a
    detail has at most one promotion of each kind, so rows stay the same. A reader that
    keeps few orders asks for ``orders_first``: promotions then meet those lines only.
    """
    details = name_code(order_details(changes), dic, "source_type", at="od_ts")
    orders = order_changes(changes)
    if span:
        details = _stamped(details, delay, "od_ts")
        orders = _stamped(orders, delay, "oi_ts")

    def with_order(df: DataFrame) -> DataFrame:
        return interval_join(df, orders, [("order_id", "order_id")], span=span)

    def with_promotions(df: DataFrame) -> DataFrame:
        by_detail = [("id", "order_detail_id")]
        for side, keep in (
            (detail_activities(changes), ["activity_id", "activity_rule_id"]),
            (detail_coupons(changes), ["coupon_id", "coupon_use_id"]),
        ):
            side = _stamped(side, delay) if span else side
            df = interval_join(df, side, by_detail, "left", span=span, keep=keep)
        return df

    if not promotions:
        return with_order(details).drop("rt")
    if changes.isStreaming or orders_first:
        return with_promotions(with_order(details)).drop("rt")
    return with_order(with_promotions(details)).drop("rt")


def trade_order_detail(order_wide: DataFrame) -> DataFrame:
    """Placed orders."""
    return order_wide.where(F.col("type") == "insert").drop("type", "old")


def trade_cancel_detail(order_wide: DataFrame) -> DataFrame:
    """Cancelled orders; the status before does not matter."""
    return order_wide.where(
        (F.col("type") == "update") & (F.col("order_status") == codes.ORDER_CANCELLED)
    ).drop("type", "old")


def trade_pay_detail_suc(
    changes: DataFrame,
    order_detail: DataFrame,
    dic: DataFrame | None,
    span: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Details of successfully paid orders.

    ``order_detail`` is the placed-orders table, one row per detail. For a bounded
    join it must carry event time ``rt``.
    """
    paid = of_table(changes, "payment_info", "update").where(
        field("payment_status") == codes.PAYMENT_SUCCESS
    ).select(*fields("order_id", "payment_type", pay_time="create_time"), "ts")
    paid = name_code(paid, dic, "payment_type")
    if span:
        paid = _stamped(paid, delay)
    joined = interval_join(
        order_detail, paid, [("order_id", "order_id")], span=span, keep=["payment_type", "pay_time"]
    )
    return joined.drop("rt")


# -- refunds -----------------------------------------------------------------------


def name_refund_codes(df: DataFrame, dic: DataFrame | None) -> DataFrame:
    """Names of the kind of and the reason for a refund."""
    named = name_code(df, dic, "refund_type_code", "refund_type_name")
    return name_code(named, dic, "refund_reason_type_code", "refund_reason_type_name")


def trade_order_refund(
    changes: DataFrame, dic: DataFrame | None, span: str | None = None, delay: str | None = None
) -> DataFrame:
    """Refund requests of orders that went into refunding, with both names."""
    requests = of_table(changes, "order_refund_info", "insert").select(
        *fields(
            "id", "user_id", "order_id", "sku_id", "create_time", "refund_reason_txt",
            "refund_num", "refund_amount", refund_type_code="refund_type",
            refund_reason_type_code="refund_reason_type",
        ),
        "ts",
    )
    requests = name_refund_codes(requests, dic)
    orders = of_table(changes, "order_info", "update").where(
        moved_to("order_status", codes.ORDER_REFUNDING)
    ).select(*fields("province_id", order_id="id"), F.col("ts").alias("oi_ts"))
    if span:
        requests, orders = _stamped(requests, delay), _stamped(orders, delay, "oi_ts")
    joined = interval_join(
        requests, orders, [("order_id", "order_id")], span=span, keep=["province_id"]
    )
    return joined.drop("rt")


def trade_refund_pay_suc(
    changes: DataFrame, dic: DataFrame | None, span: str | None = None, delay: str | None = None
) -> DataFrame:
    """Paid-out refunds with their order and refund request.

    Any update of the order and any record of the request matches, so a refund comes
    out once per pair of them.
    """
    paid = of_table(changes, "refund_payment").where(
        field("refund_status") == codes.REFUND_SUCCESS
    ).select(
        *fields(
            "id", "order_id", "sku_id", "callback_time", payment_type_code="payment_type",
            refund_amount="total_amount",
        ),
        "ts",
    )
    paid = name_code(paid, dic, "payment_type_code", "payment_type_name")
    requests = of_table(changes, "order_refund_info").select(
        *fields("order_id", "sku_id", "refund_num"), F.col("ts").alias("ri_ts")
    )
    orders = of_table(changes, "order_info", "update").select(
        *fields("user_id", "province_id", order_id="id"), F.col("ts").alias("oi_ts")
    )
    if span:
        paid = _stamped(paid, delay)
        requests, orders = _stamped(requests, delay, "ri_ts"), _stamped(orders, delay, "oi_ts")
    joined = interval_join(
        paid,
        requests,
        [("order_id", "order_id"), ("sku_id", "sku_id")],
        span=span,
        keep=["refund_num"],
    )
    joined = interval_join(
        joined, orders, [("order_id", "order_id")], span=span, keep=["user_id", "province_id"]
    )
    return joined.drop("rt")
