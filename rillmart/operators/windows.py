"""Tumbling event-time windows.

Sums are partial before the shuffle, so a global window or a hot key costs one row
per task and window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillmart.functions.time import FULL
from rillmart.settings import DEFAULTS


def window_agg(
    df: DataFrame,
    size: str = DEFAULTS.window,
    keys: list[str] | None = None,
    measures: dict[str, Column] | None = None,
    rt: str = "rt",
) -> DataFrame:
    """Aggregate per tumbling window (and keys); ``stt``/``edt`` are its bounds.

    Works on batch and streaming input alike. Composite keys are grouped as columns,
    never concatenated.
    """
    return bounded(window_groups(df, size, keys, measures, rt), [*(keys or []), *(measures or {})])


def window_groups(
    df: DataFrame, size: str, keys: list[str] | None, measures: dict[str, Column] | None, rt: str = "rt"
) -> DataFrame:
    """``window_agg`` with the window as a column ``_w``, which is narrower than its bounds as text."""
    aggs = [c.alias(n) for n, c in (measures or {}).items()]
    return df.groupBy(F.window(rt, size).alias("_w"), *(keys or [])).agg(*aggs)


def bounded(grouped: DataFrame, columns: list[str]) -> DataFrame:
    """A window column ``_w`` as its two bounds, next to the named columns."""
    return grouped.select(
        F.date_format("_w.start", FULL).alias("stt"),
        F.date_format("_w.end", FULL).alias("edt"),
        *columns,
    )


def window_sum(
    df: DataFrame,
    size: str = DEFAULTS.window,
    keys: list[str] | None = None,
    sums: dict[str, str] | None = None,
    carried: list[str] | None = None,
    rt: str = "rt",
) -> DataFrame:
    """Sums per window and keys; ``sums`` maps output names to columns.

    ``carried`` columns are functionally dependent on the keys (a name next to its
    id); their smallest value is taken, so that a recomputed task agrees.
    """
    measures = {c: F.min(c) for c in carried or []}
    measures |= {n: F.sum(c) for n, c in (sums or {}).items()}
    return window_agg(df, size, keys, measures, rt)


def window_count_distinct(
    df: DataFrame,
    what: str,
    name: str,
    size: str = DEFAULTS.window,
    keys: list[str] | None = None,
    rt: str = "rt",
) -> DataFrame:
    """Distinct values per window and keys.

    Values are first made distinct, spread by value, and then counted, so a hot group is
    split and no group is ever gathered. A stream keeps one small state row per distinct
    value until its window closes.
    """
    keys = keys or []
    if not df.isStreaming:
        return window_agg(df, size, keys, {name: F.countDistinct(what)}, rt)
    parts = ["_w", *keys, what]
    distinct = df.select(F.window(rt, size).alias("_w"), *keys, what).dropDuplicates(parts)
    counted = distinct.groupBy("_w", *keys).agg(F.count(what).alias(name))
    return bounded(counted, [*keys, name])
