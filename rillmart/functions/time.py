"""Epochs, days and window bounds.

Log records carry epoch milliseconds, change records epoch seconds; both are
read in the session time zone, which is the only zone the package knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DAY = "yyyy-MM-dd"
FULL = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_ms(ms: Column | str) -> Column:
    """Epoch milliseconds to timestamp."""
    return F.timestamp_millis(_col(ms))


def from_seconds(seconds: Column | str) -> Column:
    """Epoch seconds to timestamp."""
    return F.timestamp_seconds(_col(seconds))


def day(ms: Column | str) -> Column:
    """Calendar day of epoch milliseconds, as a date (4 bytes in a shuffle)."""
    return F.to_date(from_ms(ms))


def day_string(ms: Column | str) -> Column:
    """Calendar day of epoch milliseconds as ``yyyy-MM-dd``."""
    return F.date_format(from_ms(ms), DAY)


def full_string(ms: Column | str) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(from_ms(ms), FULL)


def _parsed(text: Column | str, full: bool) -> Column:
    """Timestamp of a date or date-time string of just that length, else null.

    The length check plus the cast's own parser is several times as fast as a format
    pattern, and these strings are parsed once per fact.
    """
    col = _col(text)
    return F.when(F.length(col) == (19 if full else 10), col.try_cast("timestamp"))


def to_ms(text: Column | str, full: bool = False) -> Column:
    """``yyyy-MM-dd`` (or the full form) to epoch milliseconds; unparsable gives null."""
    return F.unix_millis(_parsed(text, full))


def parse_full(text: Column | str) -> Column:
    """Full date-time string to timestamp; unparsable gives null."""
    return _parsed(text, full=True)


def row_stamp(text: Column | str) -> Column:
    """Compare-ready value of stamps such as ``2022-08-26 07:47:55.04Z``.

    Fractions of different length compare as numbers: .04 is less than .041.
    """
    return F.try_to_timestamp(F.rtrim(_col(text), F.lit("Z")))


def with_event_time(
    df: DataFrame, stamp: Column, delay: str | None = None, name: str = "rt"
) -> DataFrame:
    """Add the event-time column; on a stream also declare its watermark."""
    out = df.withColumn(name, stamp)
    return out.withWatermark(name, delay) if delay and df.isStreaming else out
