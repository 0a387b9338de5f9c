"""Keeping the newest version of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillmart.functions import time as tm


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """First row of each key under a total ``order``.

    Written as ``row_number() = 1`` so that Spark also limits each group before the
    shuffle: a task sends at most one row per key, however hot the key is.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_per_key(
    df: DataFrame, keys: list[str], version: list[str], ties: list[str] | None = None
) -> DataFrame:
    """Newest row of each key: ``version`` descending, ``ties`` ascending.

    Give ``ties`` enough columns to make the order total, else equal versions are
    resolved by chance.
    """
    order = [F.col(c).desc_nulls_last() for c in version]
    return first_per_key(df, keys, order + [F.col(c).asc_nulls_last() for c in ties or []])


def latest_by_row_stamp(
    df: DataFrame, keys: list[str], stamp: str = "row_op_ts", ties: list[str] | None = None
) -> DataFrame:
    """Newest row of each key by a text stamp such as ``2022-08-26 07:47:55.04Z``."""
    stamped = df.withColumn("_stamp", tm.row_stamp(stamp))
    return latest_per_key(stamped, keys, ["_stamp"], ties).drop("_stamp")


def current_state(
    changes: DataFrame,
    key: str,
    version: list[str],
    ties: list[str] | None = None,
    deletes: bool = True,
) -> DataFrame:
    """Snapshot left by an ``op / before / after`` change feed.

    Per key the newest change wins; with ``deletes`` a key whose newest change is a
    delete is absent. Returns the columns of ``after``.
    """
    keyed = changes.withColumn("_key", F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}")))
    last = latest_per_key(keyed, ["_key"], version, ties)
    if deletes:
        last = last.where(F.col("op") != "d")
    return last.select("after.*")
