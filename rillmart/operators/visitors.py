"""Operators over the history of one visitor or user.

The history is ordered by event time. Along it the calendar day never goes back,
which turns "emit when the day differs from the last one" into "first record of
each (key, day)": a grouping that is reduced before its shuffle and never gathers
the whole history of a hot key.

Inputs carry ``dt`` (calendar day as a date) next to their epoch ``ts`` in ms.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillmart.operators.latest import first_per_key
from rillmart.operators.skew import salted_join
from rillmart.settings import DEFAULTS

_DAY_MS = 86_400_000
#: more than the numbers of records can differ by
_SPREAD = Decimal(10**20)


def first_days(log: DataFrame, key: str = "mid", seq: str = "seq") -> DataFrame:
    """(key, first_day): the day on which each visitor counts as new.

    The first record fixes it: its own day when it claims to be new, the day before
    otherwise. Needs flat ``mid, ts, seq, is_new, dt``; one row per visitor and task is
    shuffled. Records without a visitor or a time tell nothing about it.
    """
    claims_new = F.coalesce(F.col("is_new") == "1", F.lit(False))
    # time, number and claim as one number, so that the least is found by hashing, not sorting
    number = F.coalesce(F.col(seq), F.lit(-(2**63))).cast("decimal(19,0)")
    record = (F.col("ts").cast("decimal(19,0)") * _SPREAD + number) * 2 + claims_new.cast("int")
    first = log.where(F.col(key).isNotNull()).groupBy(key).agg(
        (F.pmod(F.min(record), F.lit(2)) == 1).alias("new"), F.min("dt").alias("day")
    )
    first_day = F.when(F.col("new"), F.col("day")).otherwise(F.date_sub("day", 1))
    return first.select(key, first_day.alias("first_day"))


def correct_claims(
    log: DataFrame,
    first: DataFrame,
    key: str = "mid",
    seq: str = "seq",
    salts: int = DEFAULTS.salts,
) -> DataFrame:
    """Set ``is_new`` to '0' where a record claims it on another day than ``first`` has.

    The log is joined in salted pieces. Only records that claim to be new can change, so a
    caller may leave the others out.
    """
    joined = salted_join(log, first, [key], [seq, "ts"], "left", salts)
    wrong = (F.col("is_new") == "1") & (F.col("first_day") != F.col("dt"))
    return joined.withColumn("is_new", F.when(wrong, F.lit("0")).otherwise(F.col("is_new"))).drop(
        "first_day"
    )


def repair_new_visitors(
    log: DataFrame,
    key: str = "mid",
    seq: str = "seq",
    salts: int = DEFAULTS.salts,
) -> DataFrame:
    """Set ``is_new`` to '0' where a visitor's history shows they are not new.

    A claim on another day than the visitor's first is wrong. Records without a visitor
    stay as they are.
    """
    return correct_claims(log, first_days(log, key, seq), key, seq, salts)


def session_starts(log: DataFrame) -> DataFrame:
    """Records that were not reached from another page."""
    return log.where(F.col("last_page_id").isNull())


def first_records_of_day(
    df: DataFrame, keys: list[str], order: tuple[str, ...] = ("ts", "seq")
) -> DataFrame:
    """The whole first record of each (keys, day)."""
    return first_per_key(df, [*keys, "dt"], list(order))


def unique_visitors(page_log: DataFrame, key: str = "mid") -> DataFrame:
    """First session start of each visitor and day."""
    return first_records_of_day(session_starts(page_log), [key])


def day_starts(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, dt, ts of the first record): enough for every per-day count.

    A plain hash aggregate over fixed-width values; a hot key shrinks to one row per
    day in each task.
    """
    return df.groupBy(*keys, "dt").agg(F.min("ts").alias("ts"))


def user_day_flags(df: DataFrame, key: str = "user_id") -> DataFrame:
    """One row per user and day: ``unique_user`` = 1, ``new_user`` = 1 on the first day.

    The window runs over user-days, not over records.
    """
    first_day = F.min("dt").over(Window.partitionBy(key))
    return day_starts(df, [key]).select(
        key,
        "dt",
        "ts",
        F.lit(1).cast("bigint").alias("unique_user"),
        (F.col("dt") == first_day).cast("bigint").alias("new_user"),
    )


def login_rows(page_log: DataFrame) -> DataFrame:
    """Pages seen logged in, entered directly or from the login page."""
    entered = F.col("last_page_id").isNull() | (F.col("last_page_id") == "login")
    return page_log.where(F.col("uid").isNotNull() & entered)


def login_flags(
    logins: DataFrame, key: str = "uid", back_after_days: int = DEFAULTS.back_after_days
) -> DataFrame:
    """One row per user and day with ``back`` = 1 for a user away longer than the limit.

    Time away runs from midnight of the last login day; exactly the limit is not yet
    away.
    """
    last_day = F.lag("dt").over(Window.partitionBy(key).orderBy("dt"))
    midnight = F.unix_millis(last_day.cast("timestamp"))
    away = F.col("ts") - midnight > F.lit(back_after_days * _DAY_MS)
    return day_starts(logins, [key]).select(
        key,
        "dt",
        "ts",
        F.lit(1).cast("bigint").alias("uu"),
        F.coalesce(away, F.lit(False)).cast("bigint").alias("back"),
    )


def count_if(condition: Column) -> Column:
    """1 or 0 as a bigint, for measures."""
    return F.coalesce(condition, F.lit(False)).cast("bigint")
