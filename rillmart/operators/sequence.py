"""Order-dependent patterns within one visitor's records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rillmart.settings import DEFAULTS

_HOUR_MS = 3_600_000


def bounces(
    page_log: DataFrame,
    key: str = "mid",
    horizon_ms: int = DEFAULTS.bounce_horizon_ms,
    bucket_ms: int | None = None,
    order: tuple[str, str] = ("ts", "seq"),
    keep: list[str] | None = None,
) -> DataFrame:
    """Session starts that led nowhere.

    A start (no last page) is a bounce when the visitor's next record is missing, is
    another start, or comes ``horizon_ms`` or more later.

    No visitor's history is gathered in one place: it is cut into time buckets, and a
    record less than a horizon past the edge of its bucket is also shown to the bucket
    before, where it can only serve as somebody's next record. Records further in are
    too late to matter there. Only starts carry their columns (``keep``, by default
    all) through the shuffle.
    """
    ts, seq = order
    width = max(bucket_ms or max(_HOUR_MS, 4 * horizon_ms), horizon_ms)
    bucket = F.expr(f"{ts} div {width}")
    near_edge = F.pmod(F.col(ts), F.lit(width)) < horizon_ms
    home = F.array(bucket)
    is_start = F.col("last_page_id").isNull()
    payload = [c for c in keep or page_log.columns if c not in (key, ts, seq)]

    placed = page_log.select(
        key,
        ts,
        seq,
        is_start.alias("_start"),
        bucket.alias("_home"),
        F.explode(F.when(near_edge, F.array(bucket, bucket - 1)).otherwise(home)).alias("_bucket"),
        F.when(is_start, F.struct(*payload)).alias("_row"),
    )
    w = Window.partitionBy(key, "_bucket").orderBy(ts, seq)
    judged = placed.withColumn("_next_ts", F.lead(ts).over(w)).withColumn(
        "_next_start", F.lead("_start").over(w)
    )
    led_nowhere = (
        F.col("_next_ts").isNull()
        | F.col("_next_start")
        | (F.col("_next_ts") - F.col(ts) >= horizon_ms)
    )
    return judged.where(
        F.col("_start") & (F.col("_bucket") == F.col("_home")) & led_nowhere
    ).select(key, ts, seq, *[F.col(f"_row.{c}").alias(c) for c in payload])
