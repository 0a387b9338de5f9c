"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillmart.settings import DEFAULTS


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread: list[Column | str],
    how: str = "inner",
    salts: int = DEFAULTS.salts,
) -> DataFrame:
    """Join a large side to one narrow row per key, cutting every key in pieces.

    The left side gets a salt from its ``spread`` columns, the right side one copy
    per salt; ``right`` should therefore be narrow and unique on ``on``. Both sides
    are exchanged directly below the join, so AQE can cut a piece that is still too
    large. The salt depends on row values alone: a recomputed task makes the same.
    """
    if salts <= 1:
        return left.join(right, on, how)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    copies = copies.withColumn("_salt", F.col("_salt").cast("bigint"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
