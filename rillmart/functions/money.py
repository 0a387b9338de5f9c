"""Amounts arrive as strings; they are computed as exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(16,2)"


def amount(text: Column) -> Column:
    """String to ``decimal(16,2)``; anything unreadable is null."""
    return text.try_cast(MONEY)


def amount_or_zero(text: Column) -> Column:
    return F.coalesce(amount(text), F.lit(0).cast(MONEY))


def original_amount(price: Column, count: Column) -> Column:
    """List price times count, at scale 4, as a string (``36.9000``)."""
    return (amount(price) * amount(count)).cast("string")
