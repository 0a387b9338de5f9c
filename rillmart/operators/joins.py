"""Joins between facts.

Streams keep join state for a bounded span of event time: both sides carry a
watermark and the condition bounds how far apart they may lie. The same condition
in batch gives the same rows. Without one (``within=None``) the batch join is
unbounded and belongs to finished history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def within(left: str, right: str, span: str) -> Column:
    """Both event times are present and at most ``span`` apart."""
    gap = F.expr(f"INTERVAL {span}")
    return (F.col(right) >= F.col(left) - gap) & (F.col(right) <= F.col(left) + gap)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    how: str = "inner",
    left_rt: str = "rt",
    right_rt: str = "rt",
    span: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Equi-join, optionally bounded in event time.

    ``on`` pairs left with right columns; of the right side only ``keep`` comes out
    (all but its keys and event time by default).
    """
    keep = keep if keep is not None else [
        c for c in right.columns if c != right_rt and c not in [r for _, r in on]
    ]
    keys = [F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(on)]
    stamp = [F.col(right_rt).alias("_rt")] if span else []
    picked = right.select(*keys, *stamp, *keep)
    condition = F.lit(True)
    for i, (l, _) in enumerate(on):
        condition = condition & (F.col(l) == F.col(f"_k{i}"))
    if span:
        condition = condition & within(left_rt, "_rt", span)
    joined = left.join(picked, condition, how)
    return joined.drop(*[f"_k{i}" for i in range(len(on))], "_rt")
