"""The 28 jobs of the warehouse as streaming queries, the change log they share, and the
fold of the dimension configuration.

Every job reads topics or keyed tables, and writes topics, keyed tables or a mart, in
micro-batches that can be replayed. Dictionaries and dimensions are read afresh for
each micro-batch, after the stateful part, so a batch always sees their newest rows.

``Warehouse.start(name)`` starts one job; jobs depend on each other only through what
they write, and can run on different clusters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rillmart.functions import time as tm
from rillmart.operators import split, visitors
from rillmart.operators.asof import is_history
from rillmart.operators.dims import config_snapshot
from rillmart.operators.enrich import checked_broadcast
from rillmart.operators.parse import parse_changes_whole, parse_json, parse_log_text
from rillmart.plans import dwd_db, dwd_log, dws
from rillmart.schemas import PAGE_RECORD, columns, fact_schema
from rillmart.session import streaming_session
from rillmart.settings import DEFAULTS, Settings
from rillmart.sinks import dims as dim_sink
from rillmart.sinks import changelog, config as config_state, marts, upsert
from rillmart.sources import lookup
from rillmart.sources.topics import Topics, as_topic
from rillmart.streaming import run, stateful

Write = Callable[[DataFrame, int], None]

JOBS: dict[str, Callable[["Warehouse"], tuple[DataFrame, Write]]] = {}


def job(fn):
    JOBS[fn.__name__] = fn
    return fn


@dataclass
class Warehouse:
    """Everything the jobs share.

    ``dic`` and ``config`` are called once per micro-batch with the batch's session and
    return the dictionary and the change feed of the dimension configuration. A dictionary
    with its history (``asof.dictionary_history``) names facts as of their own second, so a
    replayed batch gets the names it got first; one without gives the names of the moment.

    ``config_feed`` gives the configuration as a stream instead: the job ``dim_config`` folds it
    into versions, the dimension job pins one per micro-batch, and ``config`` is not called.
    With ``database`` the versions declare their tables in the catalog.
    """

    spark: SparkSession
    root: str
    topics: Topics
    dic: Callable[[SparkSession], DataFrame]
    config: Callable[[SparkSession], DataFrame] | None = None
    config_version: list[str] = field(default_factory=lambda: ["ts_ms"])
    settings: Settings = DEFAULTS
    trigger: dict = field(default_factory=lambda: {"processingTime": "5 seconds"})
    config_feed: Callable[[SparkSession], DataFrame] | None = None
    database: str | None = None

    def __post_init__(self) -> None:
        if (self.config is None) == (self.config_feed is None):
            raise ValueError("a warehouse takes either config or config_feed")
        self.session = streaming_session(
            self.spark, self.settings.zone, self.settings.state_partitions
        )

    def start(self, name: str) -> StreamingQuery:
        stream, write = JOBS[name](self)
        return run.start_batches(stream, write, f"{self.root}/checkpoints/{name}", self.trigger)

    @property
    def jobs(self) -> list[str]:
        """The jobs this warehouse runs."""
        return [name for name in JOBS if name != "dim_config" or self.config_feed]

    def publish(self) -> None:
        """Bring the declared tables up to the dimension store's current rows."""
        version = config_state.read(self.spark, self.config_path)
        snapshot = config_snapshot(version, self.config_version)
        for name in config_state.declare(self.spark, snapshot, self.database, self.dimension_path):
            wanted = config_state.columns_of(self.spark, self.database, name)
            rows = lookup.dimension(self.spark, self.table_path("dims"), name, wanted)
            config_state.publish(rows, self.database, name)

    # -- inputs --

    def changes(self, *tables: str) -> DataFrame:
        """Change records of some tables, as the job ``change_log`` has parsed them."""
        return changelog.follow(self.session, self.change_path, tables, self.topics.bound)

    @property
    def change_path(self) -> str:
        return f"{self.root}/changes"

    @property
    def config_path(self) -> str:
        return f"{self.root}/config"

    @property
    def dimension_path(self) -> str:
        return f"{self.root}/dimensions"

    def page_log(self) -> DataFrame:
        """Flat page records; ``seq`` breaks ties between records of one millisecond."""
        return self.flat_pages(dwd_log.TOPICS["page"], "base_log")

    def flat_pages(self, topic: str, producer: str | None = None) -> DataFrame:
        """Page records of a topic as flat columns, with the whole text in ``record``."""
        raw = self.topics.read(self.session, topic, producer)
        records = _good(
            raw, PAGE_RECORD, F.xxhash64("value").alias("seq"), F.col("value").alias("record")
        )
        return split.flatten_pages(records, ("seq", "record"))

    def records(self, topic: str, schema, *extra) -> DataFrame:
        return _good(self.topics.read(self.session, topic), schema, *extra)

    def facts(self, table: str) -> DataFrame:
        return self.records(table, fact_schema(table))

    def table_path(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def follow(self, table: str) -> DataFrame:
        return upsert.follow(
            self.session, self.table_path(table), fact_schema(table), self.topics.bound
        )

    def dictionary(self, batch: DataFrame) -> DataFrame:
        """The dictionary, or its history, which is cut to a batch before it is measured."""
        dic = self.dic(batch.sparkSession)
        return dic if is_history(dic) else checked_broadcast(dic)

    def dims(self, batch: DataFrame) -> dict[str, DataFrame]:
        return lookup.dimensions(batch.sparkSession, self.table_path("dims"))

    # -- outputs --

    def to_topic(self, name: str, make: Callable[[DataFrame], DataFrame] = lambda b: b) -> Write:
        """Facts as JSON, in sink order; arrival time is added to facts that carry it."""
        write = self.topics.writer(name)

        def emit(batch: DataFrame, batch_id: int) -> None:
            rows = _arrived(make(batch), columns(name))
            write(as_topic(rows, name, columns(name)), batch_id)

        return emit

    def to_table(
        self,
        name: str,
        make: Callable[[DataFrame], DataFrame] = lambda b: b,
        collapse: bool = True,
    ) -> Write:
        """Last write wins; within a batch the later order change, then the version of a row
        that has its promotions."""

        def emit(batch: DataFrame, batch_id: int) -> None:
            rows = _arrived(make(batch), columns(name)).select(*columns(name))
            upsert.write_batch(
                rows, batch_id, self.table_path(name), ["id"], ["row_op_ts", "oi_ts"],
                ["activity_id", "coupon_id"], collapse=collapse,
            )

        return emit

    def to_mart(self, name: str, make: Callable[[DataFrame], DataFrame] = lambda b: b) -> Write:
        write = marts.parquet_writer(f"{self.root}/marts", name)
        return lambda batch, batch_id: write(make(batch), batch_id)

    def to_revised_mart(self, name: str, keys: list[str]) -> Write:
        """Windows that may come again; ``marts.revised`` reads the newest of each."""
        return marts.revising_writer(f"{self.root}/marts", name, keys)


def _good(raw: DataFrame, schema, *extra) -> DataFrame:
    """Records of an internal topic; what does not parse is nobody's record."""
    kept = raw.select("*", *extra)
    names = [c for c in kept.columns if c != "value"]
    parsed = parse_json(kept, schema, keep=names)
    return parsed.where(F.col("rec").isNotNull()).select(*names, "rec.*")


def _arrived(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Arrival-time columns the table has and the rows lack."""
    out = df
    for name in ("pt", "row_op_ts"):
        if name in wanted and name not in df.columns:
            out = out.withColumn(name, F.current_timestamp())
    return out


# -- dimensions and logs -----------------------------------------------------------


@job
def change_log(w: Warehouse):
    """Every change record parsed once and laid out by table, for the jobs that follow; records
    that cannot be used to the quarantine."""
    keep, quarantine = changelog.writer(w.change_path), w.topics.writer("change_log")

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = batch.persist()  # two sinks, one parse
        keep(parsed.where("bad is null"), batch_id)
        dirty = parsed.where("bad is not null")
        quarantine(dirty.select(F.lit(dwd_log.TOPICS["dirty"]).alias("topic"), F.col("bad").alias("value")), batch_id)
        parsed.unpersist()

    return parse_changes_whole(w.topics.read(w.session, "topic_db")), write


@job
def dim_config(w: Warehouse):
    """The configuration feed folded into versions, and the tables it declares."""
    write = config_state.writer(w.config_path, w.config_version, w.database, w.dimension_path)
    return w.config_feed(w.session), write


@job
def dim_sink_app(w: Warehouse):
    """Dimension rows to their tables. Which tables they come from is configured, so this job
    follows all of them."""

    def configured(spark: SparkSession, batch_id: int) -> DataFrame:
        if w.config_feed:
            return config_state.pinned(spark, w.config_path, "dim_sink_app", batch_id)
        return w.config(spark)

    def write(batch: DataFrame, batch_id: int) -> None:
        sink = dim_sink.writer(
            w.table_path("dims"), lambda: configured(batch.sparkSession, batch_id), w.config_version,
            w.settings.honour_deletes, w.settings.compact_every,
        )
        sink(batch, batch_id)

    return w.changes(), write


@job
def base_log(w: Warehouse):
    raw = w.topics.read(w.session, "topic_log").withColumn("seq", F.xxhash64("value"))
    log = parse_log_text(raw, keep=["seq"])
    fixed = stateful.repair_new_visitors(log.where("bad is null"))
    rows = split.tagged(fixed.withColumn("common", dwd_log.patched()), dwd_log.TOPICS)
    dirty = log.where("bad is not null").select(
        F.lit(dwd_log.TOPICS["dirty"]).alias("topic"), F.col("bad").alias("value")
    )
    return rows.unionByName(dirty), w.topics.writer("base_log")


_VISIT = ("mid", "ts", "seq", "last_page_id", "record")


def _record_topic(w: Warehouse, name: str) -> Write:
    """Whole page records, as they came."""
    write = w.topics.writer(name)
    value = F.col("record").alias("value")
    return lambda batch, batch_id: write(batch.select(F.lit(name).alias("topic"), value), batch_id)


@job
def dwd_traffic_unique_visitor_detail(w: Warehouse):
    rows = stateful.unique_visitors(w.page_log().select(*_VISIT), w.settings.delay)
    return rows, _record_topic(w, "dwd_traffic_unique_visitor_detail")


@job
def dwd_traffic_user_jump_detail(w: Warehouse):
    rows = stateful.bounces(
        w.page_log().select(*_VISIT),
        horizon_ms=w.settings.bounce_horizon_ms,
        delay=w.settings.delay,
    )
    return rows, _record_topic(w, "dwd_traffic_user_jump_detail")


# -- facts of one table ------------------------------------------------------------


def _simple(name: str, table: str, plan: Callable[..., DataFrame], named: bool = False):
    def build(w: Warehouse):
        def make(batch: DataFrame) -> DataFrame:
            return plan(batch, w.dictionary(batch)) if named else plan(batch)

        return w.changes(table), w.to_topic(name, make)

    build.__name__ = name
    return job(build)


_simple("dwd_interaction_comment", "comment_info", dwd_db.interaction_comment, named=True)
_simple("dwd_interaction_favor_add", "favor_info", dwd_db.interaction_favor_add)
_simple("dwd_tool_coupon_get", "coupon_use", dwd_db.tool_coupon_get)
_simple("dwd_tool_coupon_order", "coupon_use", dwd_db.tool_coupon_order)
_simple("dwd_tool_coupon_pay", "coupon_use", dwd_db.tool_coupon_pay)
_simple("dwd_trade_cart_add", "cart_info", dwd_db.trade_cart_add, named=True)
_simple("dwd_user_register", "user_info", dwd_db.user_register)


# -- orders and refunds ------------------------------------------------------------


@job
def dwd_trade_order_pre_process(w: Warehouse):
    changes = w.changes("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")
    wide = stateful.order_revisions(changes, w.settings.order_retention, w.settings.delay)

    def make(batch: DataFrame) -> DataFrame:
        return dwd_db.name_code(batch, w.dictionary(batch), "source_type", at="od_ts")

    return wide, w.to_table("dwd_trade_order_pre_process", make, collapse=False)


@job
def dwd_trade_order_detail(w: Warehouse):
    rows = dwd_db.trade_order_detail(w.follow("dwd_trade_order_pre_process"))
    return rows, w.to_table("dwd_trade_order_detail")


@job
def dwd_trade_cancel_detail(w: Warehouse):
    rows = dwd_db.trade_cancel_detail(w.follow("dwd_trade_order_pre_process"))
    return rows, w.to_table("dwd_trade_cancel_detail")


@job
def dwd_trade_pay_detail_suc(w: Warehouse):
    """Versions with promotions come up to two retentions late. The details' watermark
    allows for that; an inner join waits for no watermark, so only state lives longer."""
    detail = tm.with_event_time(
        w.follow("dwd_trade_order_detail"), tm.from_seconds("oi_ts"), w.settings.revision_delay
    )
    paid = dwd_db.trade_pay_detail_suc(
        w.changes("payment_info"), detail, None, w.settings.order_retention, w.settings.delay
    )

    def make(batch: DataFrame) -> DataFrame:
        paid_at = F.unix_seconds(tm.parse_full("pay_time"))
        return dwd_db.name_code(batch, w.dictionary(batch), "payment_type", at=paid_at)

    return paid, w.to_table("dwd_trade_pay_detail_suc", make)


@job
def dwd_trade_order_refund(w: Warehouse):
    rows = dwd_db.trade_order_refund(
        w.changes("order_refund_info", "order_info"), None, w.settings.refund_retention, w.settings.delay
    )

    def make(batch: DataFrame) -> DataFrame:
        return dwd_db.name_refund_codes(batch, w.dictionary(batch))

    return rows, w.to_topic("dwd_trade_order_refund", make)


@job
def dwd_trade_refund_pay_suc(w: Warehouse):
    rows = dwd_db.trade_refund_pay_suc(
        w.changes("refund_payment", "order_refund_info", "order_info"), None, w.settings.refund_retention, w.settings.delay
    )

    def make(batch: DataFrame) -> DataFrame:
        return dwd_db.name_code(
            batch, w.dictionary(batch), "payment_type_code", "payment_type_name"
        )

    return rows, w.to_topic("dwd_trade_refund_pay_suc", make)


# -- marts -------------------------------------------------------------------------


@job
def dws_traffic_vc_ch_ar_is_new_page_view_window(w: Warehouse):
    unique = w.flat_pages("dwd_traffic_unique_visitor_detail")
    jumps = w.flat_pages("dwd_traffic_user_jump_detail")
    inputs = [df.withColumn("rt", tm.from_ms("ts")) for df in dws.traffic_inputs(w.page_log(), unique, jumps)]
    rows = stateful.window_revisions(
        inputs, w.settings.window, dws.TRAFFIC_KEYS, list(dws.TRAFFIC_SUMS), w.settings.traffic_delay,
        w.settings.traffic_lateness,
    )
    return rows, w.to_revised_mart("dws_traffic_vc_ch_ar_is_new_page_view_window", dws.TRAFFIC_KEYS)


@job
def dws_traffic_source_keyword_page_view_window(w: Warehouse):
    rows = dws.source_keyword(w.page_log(), w.settings)
    return rows, w.to_mart("dws_traffic_source_keyword_page_view_window")


@job
def dws_traffic_page_view_window(w: Warehouse):
    kinds = w.page_log().where(F.col("page_id").isin("home", "good_detail"))
    keyed = kinds.select(F.concat_ws(" ", "page_id", "mid").alias("who"), "ts", "seq", "page_id")
    first = stateful.first_records_of_day(keyed, "who", w.settings.delay, 2 * 86_400_000)
    rows = dws.home_detail_window(first, w.settings)
    return rows, w.to_mart("dws_traffic_page_view_window")


@job
def dws_user_user_login_window(w: Warehouse):
    flags = stateful.login_flags(
        visitors.login_rows(w.page_log()), "uid", w.settings.back_after_days, w.settings.delay
    )
    rows = dws.user_login_window(flags, w.settings)
    return rows, w.to_mart("dws_user_user_login_window")


@job
def dws_user_user_register_window(w: Warehouse):
    rows = dws.user_register(w.facts("dwd_user_register"), w.settings)
    return rows, w.to_mart("dws_user_user_register_window")


@job
def dws_trade_cart_add_uu_window(w: Warehouse):
    adds = w.facts("dwd_trade_cart_add").select(
        "user_id", (F.col("ts") * 1000).alias("ts"), F.xxhash64("id").alias("seq")
    )
    first = stateful.first_records_of_day(adds, "user_id", w.settings.delay, 2 * 86_400_000)
    rows = dws.cart_add_window(first, w.settings)
    return rows, w.to_mart("dws_trade_cart_add_uu_window")


def _users(w: Warehouse, table: str, stamp: str, names: tuple[str, str]) -> DataFrame:
    rows = w.follow(table).select("user_id", "id", stamp)
    ms = tm.to_ms(stamp, full=True)
    keyed = rows.select("user_id", ms.alias("ts"), F.xxhash64("id").alias("seq"))
    flags = stateful.user_day_flags(
        keyed.where(F.col("ts").isNotNull()), "user_id", w.settings.delay
    )
    return dws.user_window(flags, names, w.settings)


@job
def dws_trade_order_window(w: Warehouse):
    rows = _users(w, "dwd_trade_order_detail", "create_time", dws.ORDER_USERS)
    return rows, w.to_mart("dws_trade_order_window")


@job
def dws_trade_payment_suc_window(w: Warehouse):
    rows = _users(w, "dwd_trade_pay_detail_suc", "pay_time", dws.PAYMENT_USERS)
    return rows, w.to_mart("dws_trade_payment_suc_window")


@job
def dws_trade_province_order_window(w: Warehouse):
    rows = dws.province_window(w.changes("order_info"), w.settings)
    return rows, w.to_mart(
        "dws_trade_province_order_window", lambda b: dws.name_provinces(b, w.dims(b))
    )


@job
def dws_trade_sku_order_window(w: Warehouse):
    """A detail's first version, which waits for no promotion, stands for all: the mart uses
    none, and later versions of it are equal but for their promotions. With ``sku_hold_ms`` the
    newest version within the hold does, and the watermark counts details as they come out."""
    details, hold_ms = w.follow("dwd_trade_order_detail"), w.settings.sku_hold_ms
    if hold_ms is not None:
        details = dws.complete(details, "id", "user_id", "source_type", "od_ts").select(
            "*", F.unix_micros("row_op_ts").alias("_version"), tm.from_seconds("od_ts").alias("_rt")
        )
        details = stateful.latest_held(details.drop("row_op_ts"), "id", "_version", hold_ms, "_rt")
    rows = tm.with_event_time(dws.sku_amounts(details), tm.from_seconds("od_ts"), w.settings.delay)
    if hold_ms is None:
        rows = rows.dropDuplicatesWithinWatermark(["id"])
    summed = dws.sku_window(rows, w.settings)
    return summed, w.to_mart(
        "dws_trade_sku_order_window", lambda b: dws.enrich.add_sku(b, w.dims(b))
    )


@job
def dws_trade_trademark_category_user_refund_window(w: Warehouse):
    rows = dws.refund_orders_window(w.facts("dwd_trade_order_refund"), w.settings)
    return rows, w.to_mart(
        "dws_trade_trademark_category_user_refund_window",
        lambda b: dws.count_refunds(b, w.dims(b)),
    )
