"""Column renaming between storage and API spellings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lower_camel(name: str) -> str:
    """``UPPER_SNAKE`` or ``lower_snake`` to ``lowerCamel``."""
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)


def to_lower_camel(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).alias(lower_camel(c)) for c in df.columns])


def to_upper(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).alias(c.upper()) for c in df.columns])
