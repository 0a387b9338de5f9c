"""Splitting the application log into its five record kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillmart.functions import jsontext as js, time as tm

_HEAD = ("common", "page", "ts")
_ENTRIES = "array<struct<topic: string, value: string>>"


def pages(log: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Page records: no start object; errors, actions and displays are cut off."""
    return log.where(F.col("start").isNull()).select(*extra, *_HEAD)


def starts(log: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Start records keep everything but the error."""
    return log.where(F.col("start").isNotNull()).select(
        *extra, "common", "start", "page", "actions", "displays", "ts"
    )


def errors(log: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The error object of any record that carries one, and nothing else."""
    return log.where(F.col("err").isNotNull()).select(*extra, "err")


def _unnest(log: DataFrame, array: str, item: str, extra: tuple[str, ...]) -> DataFrame:
    return log.where(F.col("start").isNull()).select(
        *extra, F.explode(array).alias(item), *_HEAD
    )


def actions(log: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per action of a page record, with its page's head."""
    return _unnest(log, "actions", "action", extra)


def displays(log: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per display of a page record, with its page's head."""
    return _unnest(log, "displays", "display", extra)


def tagged(log: DataFrame, topics: dict[str, str], extra: tuple[str, ...] = ()) -> DataFrame:
    """All five kinds in one pass, as (topic, value) rows of JSON text.

    ``topics`` names the topic of each kind (page, start, action, display, error). One
    scan of the log feeds every sink: a topic sink routes rows by the column, a file
    sink partitions by it. Takes a log as ``parse_log_text`` gives it; dirty text in
    ``bad`` goes to the ``dirty`` topic. Objects pass through as text. An action or display
    keeps its members and gets its page's common part, page and time, in place of any of its own.
    """

    def entry(kind: str, value: Column) -> Column:
        return F.struct(F.lit(topics[kind]).alias("topic"), value.alias("value"))

    def when(condition: Column, entries: Column) -> Column:
        return F.when(condition, entries).otherwise(F.array().cast(_ENTRIES))

    part = {n: js.member(n, F.col(n).cast("string")) for n in ("common", "page", "start", "ts")}
    part |= {n: js.member(n, js.array(n)) for n in ("actions", "displays")}
    # a column of its own, so that it is put together once a record
    log = log.withColumn("_head", F.concat_ws(",", *[part[n] for n in _HEAD]))
    head = F.col("_head")

    def items(array: str, kind: str) -> Column:
        return F.transform(
            array, lambda i: entry(kind, js.extended(head, js.without(i, *_HEAD)))
        )

    good = F.col("bad").isNull()
    is_page = good & F.col("start").isNull()
    whole = ("common", "start", "page", "actions", "displays", "ts")
    rows = F.concat(
        when(F.col("err").isNotNull(), F.array(entry("error", F.col("err")))),
        when(good & ~is_page, F.array(entry("start", js.built(*[part[n] for n in whole], F.col("rest"))))),
        when(is_page, F.array(entry("page", js.built(head, F.col("rest"))))),
        when(is_page & F.col("actions").isNotNull(), items("actions", "action")),
        when(is_page & F.col("displays").isNotNull(), items("displays", "display")),
        when(~good, F.array(entry("dirty", F.col("bad")))),
    )
    return log.select(*extra, F.inline(rows))


def flatten_pages(page_log: DataFrame, extra: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Page records as flat columns plus the calendar day; nested reads stay pruned."""
    return page_log.select(
        *extra,
        "ts",
        *[F.col(f"common.{c}").alias(c) for c in ("mid", "uid", "vc", "ch", "ar", "is_new")],
        *[
            F.col(f"page.{c}").alias(c)
            for c in ("page_id", "item", "item_type", "last_page_id", "during_time")
        ],
        tm.day("ts").alias("dt"),
    )
