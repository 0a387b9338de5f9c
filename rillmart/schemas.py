"""Wire schemas and the column order of every table the jobs write.

Column names and order are fixed values: downstream readers bind to them.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())


def strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


COMMON = strings("ar uid os ch is_new md mid vc ba")
PAGE = strings("page_id item item_type last_page_id").add("during_time", T.LongType())

#: application log record with its objects as JSON text, as the log split passes them on
LOG_TEXT = (
    strings("common page start")
    .add("actions", T.ArrayType(T.StringType()))
    .add("displays", T.ArrayType(T.StringType()))
    .add("err", T.StringType())
    .add("ts", T.LongType())
)

#: the same record typed, for readers of single fields
APP_LOG = (
    T.StructType()
    .add("common", COMMON)
    .add("page", PAGE)
    .add("start", STRING_MAP)
    .add("actions", T.ArrayType(STRING_MAP))
    .add("displays", T.ArrayType(STRING_MAP))
    .add("err", T.StringType())
    .add("ts", T.LongType())
)

#: database change record; ``old`` holds only the columns that changed
CHANGE = (
    T.StructType()
    .add("database", T.StringType())
    .add("table", T.StringType())
    .add("type", T.StringType())
    .add("ts", T.LongType())
    .add("xid", T.LongType())
    .add("commit", T.StringType())
    .add("data", STRING_MAP)
    .add("old", STRING_MAP)
)

TABLE_PROCESS = strings("source_table sink_table sink_columns sink_pk sink_extend")

#: change envelope of the configuration table
CONFIG_CHANGE = (
    T.StructType()
    .add("op", T.StringType())
    .add("before", TABLE_PROCESS)
    .add("after", TABLE_PROCESS)
    .add("ts_ms", T.LongType())
)

BASE_DIC = strings("dic_code dic_name parent_code create_time operate_time")

DIMS = {
    "dim_sku_info": "id sku_name spu_id tm_id category3_id price weight sku_desc is_sale "
    "create_time sku_default_img",
    "dim_spu_info": "id spu_name tm_id category3_id description",
    "dim_base_trademark": "id tm_name",
    "dim_base_category3": "id name category2_id",
    "dim_base_category2": "id name category1_id",
    "dim_base_category1": "id name",
    "dim_base_province": "id name",
}

DETAIL_COLUMNS = (
    "id order_id sku_id sku_name order_price sku_num create_time source_type source_id "
    "split_total_amount split_activity_amount split_coupon_amount split_original_amount od_ts "
    "order_status user_id operate_time province_id oi_ts pt activity_id activity_rule_id "
    "coupon_id coupon_use_id row_op_ts"
).split()

#: columns of the fact tables, in sink order
FACTS = {
    "dwd_interaction_comment": "id user_id sku_id order_id create_time appraise_code "
    "appraise_name ts",
    "dwd_interaction_favor_add": "id user_id sku_id create_time ts",
    "dwd_tool_coupon_get": "id coupon_id user_id get_time ts",
    "dwd_tool_coupon_order": "id coupon_id user_id order_id order_time ts",
    "dwd_tool_coupon_pay": "id coupon_id user_id order_id payment_time ts",
    "dwd_trade_cart_add": "id user_id sku_id cart_price sku_num sku_name is_checked create_time "
    "operate_time is_ordered order_time dic_name source_id ts",
    "dwd_trade_order_pre_process": " ".join(DETAIL_COLUMNS[:-1] + ["type", "old", "row_op_ts"]),
    "dwd_trade_order_detail": " ".join(DETAIL_COLUMNS),
    "dwd_trade_cancel_detail": " ".join(DETAIL_COLUMNS),
    "dwd_trade_pay_detail_suc": " ".join(DETAIL_COLUMNS + ["payment_type", "pay_time"]),
    "dwd_trade_order_refund": "id user_id order_id sku_id province_id create_time "
    "refund_type_code refund_type_name refund_reason_type_code refund_reason_type_name "
    "refund_reason_txt refund_num refund_amount ts row_op_ts",
    "dwd_trade_refund_pay_suc": "id user_id order_id sku_id province_id payment_type_code "
    "payment_type_name callback_time refund_num refund_amount ts row_op_ts",
    "dwd_user_register": "user_id create_time ts",
}

_CATEGORIES = (
    "category1_id category1_name category2_id category2_name category3_id category3_name"
)

#: columns of the mart tables, in sink order; ``ts`` (emit time) is added by the sink
MARTS = {
    "dws_traffic_vc_ch_ar_is_new_page_view_window": "stt edt vc ch ar is_new uv_ct sv_ct pv_ct "
    "dur_sum uj_ct",
    "dws_traffic_source_keyword_page_view_window": "stt edt source keyword keyword_count",
    "dws_traffic_page_view_window": "stt edt home_uv_ct good_detail_uv_ct",
    "dws_user_user_login_window": "stt edt back_ct uu_ct",
    "dws_user_user_register_window": "stt edt register_ct",
    "dws_trade_cart_add_uu_window": "stt edt cart_add_uu_ct",
    "dws_trade_order_window": "stt edt order_unique_user_count order_new_user_count",
    "dws_trade_payment_suc_window": "stt edt payment_suc_unique_user_count "
    "payment_suc_new_user_count",
    "dws_trade_province_order_window": "stt edt province_id province_name order_count "
    "order_amount",
    "dws_trade_sku_order_window": f"stt edt trademark_id trademark_name {_CATEGORIES} sku_id "
    "sku_name spu_id spu_name original_amount activity_amount coupon_amount order_amount",
    "dws_trade_trademark_category_user_refund_window": "stt edt trademark_id trademark_name "
    f"{_CATEGORIES} user_id refund_count",
}

#: columns a bean carries for its own computation but never writes
TRANSIENT = {
    "dws_traffic_source_keyword_page_view_window": ("err",),
    "dws_trade_trademark_category_user_refund_window": ("order_id_set", "sku_id"),
}


def columns(table: str) -> list[str]:
    """Column order of a fact or mart table."""
    return (FACTS.get(table) or MARTS[table]).split()

#: a page record as the page topic holds it
PAGE_RECORD = T.StructType().add("common", COMMON).add("page", PAGE).add("ts", T.LongType())

_TYPES = {
    "od_ts": T.LongType(),
    "oi_ts": T.LongType(),
    "ts": T.LongType(),
    "pt": T.TimestampType(),
    "row_op_ts": T.TimestampType(),
    "old": STRING_MAP,
}


def fact_schema(table: str) -> T.StructType:
    """Schema of a fact table: strings but for epochs, arrival times and ``old``."""
    return T.StructType(
        [T.StructField(c, _TYPES.get(c, T.StringType())) for c in columns(table)]
    )
