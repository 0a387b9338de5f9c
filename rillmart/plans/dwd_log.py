"""Log cleaning: base log, unique visitors, bounces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillmart.functions import jsontext as js, time as tm
from rillmart.operators import sequence, split, visitors
from rillmart.operators.parse import parse_log_text
from rillmart.settings import DEFAULTS, Settings


def repair(log: DataFrame, extra: tuple[str, ...] = ("seq",), settings: Settings = DEFAULTS) -> DataFrame:
    """Repair ``common.is_new`` inside nested records, leaving the rest untouched."""
    flat = log.select(
        "*",
        F.col("common.mid").alias("mid"),
        F.col("common.is_new").alias("is_new"),
        tm.day("ts").alias("dt"),
    )
    fixed = visitors.repair_new_visitors(flat, seq=extra[0], salts=settings.salts)
    return fixed.withColumn("common", F.col("common").withField("is_new", F.col("is_new"))).select(
        *log.columns
    )


def patched() -> Column:
    """``common`` with the ``is_new`` found for the visitor in place of the record's own."""
    text = F.col("common")
    changed = (F.col("is_new") == "0") & (F.get_json_object(text, "$.is_new") == "1")
    claim = r'"is_new"\s*:\s*(?:"1"|1)(?=\s*[,}])'
    return (
        F.when(~changed | changed.isNull(), text)
        .when(js.is_flat(text), F.regexp_replace(text, claim, '"is_new":"0"'))
        .otherwise(js.extended(F.lit('"is_new":"0"'), js.without(text, "is_new")))
    )


#: fixed values: topics of the five kinds, and the quarantine of unusable records
TOPICS = {
    "page": "dwd_traffic_page_log",
    "start": "dwd_traffic_start_log",
    "display": "dwd_traffic_display_log",
    "action": "dwd_traffic_action_log",
    "error": "dwd_traffic_error_log",
    "dirty": "dirty",
}


def may_claim(value: Column) -> Column:
    """Whether a log text can hold ``is_new`` 1, under any spelling (letters and digits have no
    escapes but ``\\u``)."""
    return F.coalesce(value.rlike(r'"is_new"\s*:\s*"?1|\\u'), F.lit(False))


def base_log(raw: DataFrame, seq: str = "seq", settings: Settings = DEFAULTS) -> DataFrame:
    """Raw JSON log to (seq, topic, value): five topics and the quarantine.

    Rows that do not parse, or name no device, keep their text under ``dirty``. Only
    records that may claim a new visitor meet the first days in a join; the others are
    told by their text and stay where they are read.
    """

    def parsed(part: DataFrame) -> DataFrame:
        return parse_log_text(part, keep=[seq]).withColumn("dt", tm.day("ts"))

    first = visitors.first_days(parsed(raw), seq=seq)
    claim = may_claim(F.col("value"))
    fixed = visitors.correct_claims(parsed(raw.where(claim)), first, seq=seq, salts=settings.salts)
    whole = fixed.withColumn("common", patched()).unionByName(parsed(raw.where(~claim)))
    return split.tagged(whole, TOPICS, (seq,))


def unique_visitor_detail(page_log: DataFrame) -> DataFrame:
    """First session start of each visitor and day (flat page records)."""
    return visitors.unique_visitors(page_log)


def user_jump_detail(
    page_log: DataFrame, settings: Settings = DEFAULTS, keep: list[str] | None = None
) -> DataFrame:
    """Session starts that led nowhere (flat page records)."""
    return sequence.bounces(page_log, horizon_ms=settings.bounce_horizon_ms, keep=keep)
