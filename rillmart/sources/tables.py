"""The mart's topics and tables as seen through the supplied benchmark tables.

Each function maps benchmark tables to the wire shape the jobs expect, lazily and
without sampling, so every query over them reads the tables as they are. Times are
taken as UTC.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rillmart import codes
from rillmart.functions import time as tm
from rillmart.functions.money import MONEY
from rillmart.functions.time import FULL
from rillmart.schemas import STRING_MAP


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream (one micro-batch per arriving file set)."""
    schema = table(spark, sf_dir, name).schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .parquet(sf_dir)
    )


def pieces(spark: SparkSession, sf_dir: str, names: list[str], rows: int) -> int:
    """How many pieces of about ``rows`` rows the tables have together; counts in file footers."""
    return max(1, math.ceil(sum(table(spark, sf_dir, n).count() for n in names) / rows))


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _ts(c: str) -> Column:
    return F.col(c).cast("timestamp")


def _text(c: Column) -> Column:
    return F.date_format(c, FULL)


def _money(c: str) -> Column:
    return F.col(c).cast(MONEY)


def _mod(c: str, n: int) -> Column:
    return F.pmod(F.col(c), F.lit(n))


def _map(**entries: Column) -> Column:
    pairs = [x for k, v in entries.items() for x in (F.lit(k), v.cast("string"))]
    return F.create_map(*pairs)


def _row(**entries: Column) -> dict[str, Column]:
    return {k: v.cast("string") for k, v in entries.items()}


#: columns whose former values some job reads
_OLD = ("order_status", "coupon_status", "sku_num")


def _old(**entries: Column) -> Column:
    none = F.lit(None)
    return F.struct(*[entries.get(n, none).cast("string").alias(n) for n in _OLD])


def _no_old() -> Column:
    return F.lit(None).cast("struct<" + ", ".join(f"{n}: string" for n in _OLD) + ">")


# -- logs --------------------------------------------------------------------------

_PAGE_OF = {
    "view": "home", "click": "good_detail", "signup": "register", "purchase": "trade",
    "error": "search",
}


def _page_id() -> Column:
    expr = F.lit(None).cast("string")
    for event, page in _PAGE_OF.items():
        expr = F.when(F.col("event_type") == event, F.lit(page)).otherwise(expr)
    return expr


def _flat_log(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    last = F.when(_mod("event_id", 3) == 1, F.lit("login")).when(
        _mod("event_id", 3) == 2, F.lit("home")
    )
    return events.select(
        F.col("event_id").alias("seq"),
        F.unix_millis(_ts("ts")).alias("ts"),
        F.concat(F.lit("mid_"), _s(user)).alias("mid"),
        F.when(F.col("event_type") != "error", _s(user)).alias("uid"),
        F.concat(F.lit("v"), _s(_mod("user_id", 3))).alias("vc"),
        F.concat(F.lit("ch"), _s(_mod("user_id", 4))).alias("ch"),
        _s(_mod("user_id", 25)).alias("ar"),
        F.when(_mod("event_id", 2) == 0, F.lit("1")).otherwise(F.lit("0")).alias("is_new"),
        _page_id().alias("page_id"),
        F.col("props").alias("item"),
        F.lit("sku_id").alias("item_type"),
        last.alias("last_page_id"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("during_time"),
        "event_type",
        "props",
    )


def _nested(flat: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    common = F.struct(
        "ar", "uid", F.lit("Android").alias("os"), "ch", "is_new", none.alias("md"), "mid", "vc",
        none.alias("ba"),
    )
    page = F.struct("page_id", "item", "item_type", "last_page_id", "during_time")
    return flat.select(
        "seq", common.alias("common"), page.alias("page"), "ts", "event_type", "props"
    )


def page_records(events: DataFrame) -> DataFrame:
    """Page records (``seq, common, page, ts``) from the events table or stream."""
    return _nested(_flat_log(events)).select("seq", "common", "page", "ts")


def flat_pages(events: DataFrame) -> DataFrame:
    """Flat page records from the events table or stream, as ``flatten_pages`` gives."""
    return _flat_log(events).drop("event_type", "props").withColumn("dt", tm.day("ts"))


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat page records."""
    return flat_pages(table(spark, sf_dir, "events"))


def raw_log(events: DataFrame) -> DataFrame:
    """JSON application log with start, page and error records and some dirt.

    Signups become start records; every record's ``k`` gives it k % 3 actions and
    k % 4 displays; errors carry an error object. Of fifty records one is cut short,
    one lacks its common part and one is empty.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    is_start = F.col("event_type") == "signup"

    def items(n: Column, name: str) -> Column:
        made = F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.create_map(F.lit(name), F.concat(F.lit(name), _s(i))),
        )
        return F.when(n > 0, made)

    cols = _nested(_flat_log(events)).withColumn("k", k)
    whole = F.to_json(
        F.struct(
            F.when(_mod("seq", 50) != 8, F.col("common")).alias("common"),
            F.when(~is_start, F.col("page")).alias("page"),
            F.when(
                is_start,
                F.create_map(F.lit("entry"), F.lit("icon"), F.lit("loading_time"), _s("k")),
            ).alias("start"),
            items(F.pmod("k", F.lit(3)), "action_id").alias("actions"),
            items(F.pmod("k", F.lit(4)), "item").alias("displays"),
            F.when(F.col("event_type") == "error", F.struct(_s("k").alias("error_code"))).alias(
                "err"
            ),
            F.col("ts"),
        )
    )
    value = (
        F.when(_mod("seq", 50) == 7, F.substring(whole, 1, 40))
        .when(_mod("seq", 50) == 9, F.lit(""))
        .otherwise(whole)
    )
    return cols.select("seq", value.alias("value"))


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search result pages whose keyword is a document's whole text."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("seq"),
        F.col("text").alias("item"),
        F.when(_mod("doc_id", 7) == 0, F.lit("sku_id")).otherwise(F.lit("keyword")).alias(
            "item_type"
        ),
        F.when(_mod("doc_id", 11) == 0, F.lit("home")).otherwise(F.lit("search")).alias(
            "last_page_id"
        ),
        (F.lit(1_704_067_200_000) + F.col("doc_id") * 60_000).alias("ts"),
    )


# -- change records ----------------------------------------------------------------


def _change(
    df: DataFrame,
    name: str,
    type_: Column,
    ts: Column,
    data: Column | dict[str, Column],
    old: Column,
) -> DataFrame:
    """Change records of one table.

    Typed data stays plain columns, which ``as_topic`` puts under the alias ``data``; a map
    stays a map.
    """
    if isinstance(data, dict):
        values = [v.alias(k) for k, v in data.items()]
    else:
        values = [data.alias("data")]
    return df.select(
        F.lit("shop").alias("database"),
        F.lit(name).alias("table"),
        type_.alias("type"),
        ts.cast("bigint").alias("ts"),
        old.alias("old"),
        *values,
    )


_HEAD = ("database", "table", "type", "ts", "old")


def as_topic(*parts: DataFrame) -> DataFrame:
    """Typed change records of several tables as one topic.

    The union of their columns, reached as ``data.column``: jobs address them like the
    entries of parsed records, and column pruning reaches the files.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).alias("data")


def as_records(changes: DataFrame) -> DataFrame:
    """Typed change records in wire form, their values packed into ``data``."""
    values = [c for c in changes.columns if c not in _HEAD]
    return changes.select(
        "database", "table", "type", "ts", F.struct(*values).alias("data"), "old"
    )


def order_info(orders: DataFrame) -> DataFrame:
    """Every order is inserted unpaid; P and F orders are updated a day later."""
    placed = _ts("o_orderdate")
    later = placed + F.expr("INTERVAL 1 DAY")
    base = dict(
        id=F.col("o_orderkey"),
        user_id=F.col("o_custkey"),
        province_id=_mod("o_custkey", 25),
        total_amount=_money("o_totalprice"),
        create_time=_text(placed),
    )
    inserts = _change(
        orders, "order_info", F.lit("insert"), F.unix_seconds(placed),
        _row(order_status=F.lit(codes.ORDER_UNPAID), operate_time=F.lit(None), **base), _no_old(),
    )
    status = (
        F.when(F.col("o_orderstatus") == "P", F.lit(codes.ORDER_PAID))
        .when(_mod("o_orderkey", 2) == 0, F.lit(codes.ORDER_CANCELLED))
        .otherwise(F.lit(codes.ORDER_REFUNDING))
    )
    old = F.when(
        _mod("o_orderkey", 5) == 0, _old()
    ).otherwise(_old(order_status=F.lit(codes.ORDER_UNPAID)))
    updates = _change(
        orders.where(F.col("o_orderstatus").isin("P", "F")), "order_info", F.lit("update"),
        F.unix_seconds(later), _row(order_status=status, operate_time=_text(later), **base), old,
    )
    return inserts.unionByName(updates)


def payment_info(orders: DataFrame) -> DataFrame:
    paid = _ts("o_orderdate") + F.expr("INTERVAL 1 DAY")
    done = F.when(_mod("o_orderkey", 3) != 0, F.lit(codes.PAYMENT_SUCCESS)).otherwise(F.lit("1601"))
    return _change(
        orders.where(F.col("o_orderstatus") == "P"), "payment_info", F.lit("update"),
        F.unix_seconds(paid),
        _row(
            id=F.col("o_orderkey"), order_id=F.col("o_orderkey"),
            payment_type=F.substring("o_orderpriority", 1, 1), create_time=_text(paid),
            payment_status=done,
        ),
        _old(),
    )


def _detail_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def order_detail(lineitem: DataFrame) -> DataFrame:
    shipped = _ts("l_shipdate")
    return _change(
        lineitem, "order_detail", F.lit("insert"), F.unix_seconds(shipped),
        _row(
            id=_detail_id(), order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
            sku_name=F.concat(F.lit("sku-"), _s("l_partkey")),
            order_price=_money("l_extendedprice"), sku_num=F.col("l_quantity").cast("bigint"),
            create_time=_text(shipped), source_type=_mod("l_linenumber", 5) + 1,
            source_id=F.col("l_suppkey"), split_total_amount=_money("l_extendedprice"),
            split_activity_amount=F.when(F.col("l_discount") >= 0.05, _money("l_discount")),
            split_coupon_amount=F.when(F.col("l_tax") >= 0.04, _money("l_tax")),
        ),
        _no_old(),
    )


def _promotion(lineitem: DataFrame, name: str, **entries: Column) -> DataFrame:
    """One promotion row per order detail, however often its line is repeated."""
    once = lineitem.groupBy(_detail_id().alias("id")).agg(
        F.min(F.unix_seconds(_ts("l_shipdate"))).alias("at")
    )
    return _change(
        once, name, F.lit("insert"), F.col("at"), _row(order_detail_id=F.col("id"), **entries), _no_old()
    )


def order_detail_activity(lineitem: DataFrame) -> DataFrame:
    return _promotion(
        lineitem.where(F.col("l_discount") >= 0.05), "order_detail_activity",
        activity_id=_mod("id", 7), activity_rule_id=_mod("id", 3),
    )


def order_detail_coupon(lineitem: DataFrame) -> DataFrame:
    return _promotion(
        lineitem.where(F.col("l_tax") >= 0.04), "order_detail_coupon",
        coupon_id=_mod("id", 11), coupon_use_id=_mod("id", 13),
    )


def promotions_of_orders(orders: DataFrame) -> list[DataFrame]:
    """Promotions of every order's first line, one each; needs no grouping, so it also
    works on a stream."""
    at = F.unix_seconds(_ts("o_orderdate"))
    first = F.col("o_orderkey") * 10 + 1

    def made(name: str, n: int, **entries: Column) -> DataFrame:
        rows = orders.where(_mod("o_orderkey", n) == 0)
        return _change(
            rows, name, F.lit("insert"), at, _row(order_detail_id=first, **entries), _no_old()
        )

    return [
        made("order_detail_activity", 2, activity_id=_mod("o_orderkey", 7), activity_rule_id=F.lit(1)),
        made("order_detail_coupon", 3, coupon_id=_mod("o_orderkey", 11), coupon_use_id=F.lit(2)),
    ]


def order_refund_info(lineitem: DataFrame) -> DataFrame:
    shipped = _ts("l_shipdate")
    return _change(
        lineitem.where(F.col("l_returnflag") == "R"), "order_refund_info", F.lit("insert"),
        F.unix_seconds(shipped),
        _row(
            id=_detail_id(), user_id=F.col("l_suppkey"), order_id=F.col("l_orderkey"),
            sku_id=F.col("l_partkey"), refund_type=_mod("l_linenumber", 5) + 1,
            refund_num=F.col("l_quantity").cast("bigint"), refund_amount=_money("l_extendedprice"),
            refund_reason_type=_mod("l_suppkey", 5) + 1, refund_reason_txt=F.col("l_linestatus"),
            create_time=_text(shipped),
        ),
        _no_old(),
    )


def refund_payment(lineitem: DataFrame) -> DataFrame:
    back = _ts("l_shipdate") + F.expr("INTERVAL 1 DAY")
    done = F.when(_mod("l_suppkey", 3) != 0, F.lit(codes.REFUND_SUCCESS)).otherwise(F.lit("0701"))
    return _change(
        lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")),
        "refund_payment", F.lit("insert"), F.unix_seconds(back),
        _row(
            id=_detail_id(), order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
            payment_type=_mod("l_linenumber", 5) + 1, callback_time=_text(back),
            total_amount=_money("l_extendedprice"), refund_status=done,
        ),
        _no_old(),
    )


def _typed_by(events: DataFrame, event: str | None, name: str, n: int, data: Column, old: Column) -> DataFrame:
    type_ = F.when(_mod("event_id", n) == 0, F.lit("insert")).otherwise(F.lit("update"))
    rows = events if event is None else events.where(F.col("event_type") == event)
    return _change(rows, name, type_, F.unix_seconds(_ts("ts")), data, old)


def cart_info(events: DataFrame) -> DataFrame:
    at = _ts("ts")
    k = F.get_json_object("props", "$.k")
    old = F.when(
        _mod("event_id", 5) == 0, _old()
    ).otherwise(_old(sku_num=k))
    return _typed_by(
        events, None, "cart_info", 4,
        _row(
            id=F.col("event_id"), user_id=F.col("user_id"), sku_id=k,
            cart_price=_money("value"), sku_num=F.floor("value"), sku_name=F.col("event_type"),
            is_checked=F.lit("1"), create_time=_text(at), operate_time=_text(at),
            is_ordered=F.lit("0"), order_time=F.lit(None), source_type=_mod("event_id", 5) + 1,
            source_id=F.col("user_id"),
        ),
        F.when(_mod("event_id", 4) != 0, old),
    )


def comment_info(events: DataFrame) -> DataFrame:
    return _typed_by(
        events, "click", "comment_info", 2,
        _row(
            id=F.col("event_id"), user_id=F.col("user_id"), sku_id=F.get_json_object("props", "$.k"),
            order_id=F.col("event_id"), create_time=_text(_ts("ts")),
            appraise=_mod("event_id", 5) + 1,
        ),
        _no_old(),
    )


def favor_info(events: DataFrame) -> DataFrame:
    return _typed_by(
        events, "view", "favor_info", 2,
        _row(
            id=F.col("event_id"), user_id=F.col("user_id"), sku_id=F.get_json_object("props", "$.k"),
            create_time=_text(_ts("ts")),
        ),
        _no_old(),
    )


def coupon_use(events: DataFrame) -> DataFrame:
    at = _text(_ts("ts"))
    old = F.when(
        _mod("event_id", 5) == 0, _old()
    ).otherwise(_old(coupon_status=F.lit(codes.COUPON_UNUSED)))
    return _typed_by(
        events, "purchase", "coupon_use", 4,
        _row(
            id=F.col("event_id"), coupon_id=_mod("user_id", 9), user_id=F.col("user_id"),
            order_id=F.col("event_id"), get_time=at,
            using_time=at, used_time=F.when(_mod("event_id", 3) == 0, at),
            coupon_status=F.when(_mod("event_id", 2) == 0, F.lit(codes.COUPON_USING)).otherwise(
                F.lit(codes.COUPON_USED)
            ),
        ),
        F.when(_mod("event_id", 4) != 0, old),
    )


def user_info(events: DataFrame) -> DataFrame:
    return _typed_by(
        events, "signup", "user_info", 2,
        _row(id=F.col("user_id"), create_time=_text(_ts("ts"))), _no_old(),
    )


_CHANGE_TABLES = {
    "orders": (order_info, payment_info),
    "lineitem": (
        order_detail, order_detail_activity, order_detail_coupon, order_refund_info, refund_payment,
    ),
    "events": (cart_info, comment_info, favor_info, coupon_use, user_info),
}


def change_log(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """All change records as one topic, or those of the named tables.

    The table name is a constant of each part, so a job that filters on it reads only
    the parts it needs either way; naming them merely makes for a smaller plan.
    """
    parts = []
    for source, makers in _CHANGE_TABLES.items():
        wanted = [m for m in makers if not names or m.__name__ in names]
        rows = table(spark, sf_dir, source) if wanted else None
        parts += [make(rows) for make in wanted]
    return as_topic(*parts)


def raw_changes(events: DataFrame) -> DataFrame:
    """Coupon records as JSON text with dirt: cut records, and snapshot markers."""
    rows = as_records(coupon_use(events)).withColumn("seq", F.col("data.id").cast("bigint"))
    whole = F.to_json(F.struct("database", "table", "type", "ts", "data", "old"))
    value = (
        F.when(_mod("seq", 50) == 7, F.lit("not json"))
        .when(_mod("seq", 50) == 9, F.lit(""))
        .when(_mod("seq", 50) == 8, F.regexp_replace(whole, r'"(insert|update)"', '"bootstrap-start"'))
        .otherwise(whole)
    )
    return rows.select("seq", value.alias("value"))


# -- dictionary and dimensions -----------------------------------------------------


def base_dic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities as a dictionary without '5-LOW', so that some lookups miss."""
    p = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return p.where(F.col("o_orderpriority") != "5-LOW").select(
        F.substring("o_orderpriority", 1, 1).alias("dic_code"),
        F.expr("substring(o_orderpriority, 3)").alias("dic_name"),
    )


def dic_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of the dictionary: its first state, then a rename by every tenth event,
    each seventh of which deletes the code instead."""
    known = base_dic(spark, sf_dir).select(
        F.lit("insert").alias("type"), F.lit(0).cast("bigint").alias("ts"), F.lit(-1).cast("bigint").alias("seq"),
        "dic_code", "dic_name",
    )
    renamed = table(spark, sf_dir, "events").where(_mod("event_id", 10) == 0).select(
        F.when(_mod("event_id", 70) == 0, F.lit("delete")).otherwise(F.lit("update")).alias("type"),
        F.unix_seconds(_ts("ts")).alias("ts"), F.col("event_id").cast("bigint").alias("seq"),
        _s(_mod("user_id", 5) + 1).alias("dic_code"), F.concat(F.lit("name-"), _s("event_id")).alias("dic_name"),
    )
    rows = known.unionByName(renamed)
    return rows.select(
        F.lit("base_dic").alias("table"), "type", "ts", "seq", F.struct("dic_code", "dic_name").alias("data")
    )


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimension tables; nation 24 and 'Brand#1' are left out, so that some miss."""

    def t(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    nation = t("nation").where(F.col("n_nationkey") != 24)
    return {
        "dim_sku_info": t("part").select(
            _s("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
            F.col("p_type").alias("spu_id"), F.col("p_brand").alias("tm_id"),
            _s("p_size").alias("category3_id"),
        ),
        "dim_spu_info": t("part").select(F.col("p_type").alias("id")).distinct().select(
            "id", F.lower("id").alias("spu_name")
        ),
        "dim_base_trademark": t("part").select(F.col("p_brand").alias("id")).distinct().where(
            F.col("id") != "Brand#1"
        ).select("id", F.concat(F.lit("TM "), F.col("id")).alias("tm_name")),
        "dim_base_category3": t("supplier").select(
            _s("s_suppkey").alias("id"), F.col("s_name").alias("name"),
            _s("s_nationkey").alias("category2_id"),
        ),
        "dim_base_category2": nation.select(
            _s("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            _s("n_regionkey").alias("category1_id"),
        ),
        "dim_base_category1": t("region").select(
            _s("r_regionkey").alias("id"), F.col("r_name").alias("name")
        ),
        "dim_base_province": nation.select(
            _s("n_nationkey").alias("id"), F.col("n_name").alias("name")
        ),
    }


def dim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of dimension tables: SKUs with updates and deletes, categories,
    and customers, which no configuration claims."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")

    no_old = F.lit(None).cast(STRING_MAP)

    def sku(rows: DataFrame, type_: str, ts: int, name: Column) -> DataFrame:
        return _change(
            rows, "sku_info", F.lit(type_), F.lit(ts),
            _map(
                id=F.col("p_partkey"), sku_name=name, tm_id=F.col("p_brand"),
                price=_money("p_retailprice"), weight=F.lit(None),
            ),
            no_old,
        )

    name = F.col("p_name")
    return reduce(
        DataFrame.unionByName,
        [
            sku(part, "insert", 1, name),
            sku(part.where(_mod("p_partkey", 3) == 0), "update", 2, F.upper(name)),
            sku(part.where(_mod("p_partkey", 10) == 0), "delete", 3, name),
            _change(
                supplier, "base_category3", F.lit("bootstrap-insert"), F.lit(1),
                _map(id=F.col("s_suppkey"), name=F.col("s_name"), category2_id=F.col("s_nationkey")),
                no_old,
            ),
            _change(
                table(spark, sf_dir, "customer"), "customer_info", F.lit("insert"), F.lit(1),
                _map(id=F.col("c_custkey"), name=F.col("c_name")), no_old,
            ),
        ],
    )


#: configuration used with ``dim_changes``: (op, version, table, sink, columns, pk)
CONFIG_ROWS = (
    ("r", 1, "sku_info", "dim_sku_info", "id,sku_name", None),
    ("u", 2, "sku_info", "dim_sku_info", "id,sku_name,tm_id,weight", "id"),
    ("c", 1, "base_category3", "dim_base_category3", "id,name", None),
    ("c", 1, "customer_info", "dim_customer_info", "id,name", "id"),
    ("d", 2, "customer_info", None, None, None),
)


def config_changes(spark: SparkSession) -> DataFrame:
    """Change envelopes of the dimension configuration."""

    def literal(v: str | None) -> str:
        return "CAST(NULL AS STRING)" if v is None else f"'{v}'"

    rows = ", ".join(
        f"('{op}', {v}, " + ", ".join(literal(x) for x in rest) + ")"
        for op, v, *rest in CONFIG_ROWS
    )
    flat = spark.sql(f"SELECT * FROM VALUES {rows} AS t(op, v, source_table, sink_table, sink_columns, sink_pk)")
    image = F.struct(
        "source_table", "sink_table", "sink_columns", "sink_pk",
        F.lit(None).cast(T.StringType()).alias("sink_extend"),
    )
    gone = F.col("op") == "d"
    return flat.select(
        "op", F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"),
        F.col("v").cast("bigint").alias("ts_ms"),
    )


def row_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An op/before/after feed over customers: created, some updated, some deleted."""
    c = table(spark, sf_dir, "customer")

    def image(balance: Column) -> Column:
        return F.struct(
            _s("c_custkey").alias("id"), F.col("c_name").alias("name"),
            balance.cast(MONEY).alias("balance"),
        )

    old, new = image(F.col("c_acctbal")), image(F.col("c_acctbal") + 100)
    nothing = F.when(F.lit(False), old)

    def feed(rows: DataFrame, op: str, v: int, before: Column, after: Column) -> DataFrame:
        return rows.select(
            F.lit(op).alias("op"), before.alias("before"), after.alias("after"),
            F.lit(v).cast("bigint").alias("ts_ms"),
        )

    return reduce(
        DataFrame.unionByName,
        [
            feed(c, "c", 1, nothing, old),
            feed(c.where(_mod("c_custkey", 3) == 0), "u", 2, old, new),
            feed(c.where(_mod("c_custkey", 5) == 0), "d", 3, old, nothing),
        ],
    )
