"""Filters and projections over database change records.

The values of a record are reached as ``data.column``. That reads an entry of a ``data``
map (records parsed from JSON), a field of a ``data`` struct, or a plain column of a table
under the alias ``data``, whichever the input has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def field(name: str) -> Column:
    """New value of a column; null when the record does not carry it."""
    return F.col(f"data.{name}")


def previous(name: str) -> Column:
    """Value before the change; null unless this very column changed."""
    return F.col(f"old.{name}")


def of_table(changes: DataFrame, table: str, *types: str) -> DataFrame:
    """Records of one table, optionally of some change types only."""
    out = changes.where(F.col("table") == table)
    return out.where(F.col("type").isin(*types)) if types else out


def fields(*names: str, **renamed: str) -> list[Column]:
    """Projection of map entries to columns: ``fields("id", order_time="using_time")``."""
    return [field(n).alias(n) for n in names] + [field(s).alias(n) for n, s in renamed.items()]


def moved_to(column: str, new: str, old: str | None = None) -> Column:
    """The record moved ``column`` to ``new`` (from ``old``, or from anything else)."""
    was = previous(column) == old if old is not None else previous(column).isNotNull()
    return (field(column) == new) & was


def added_quantity(column: str) -> Column:
    """Quantity a record adds: all of it on insert, the increase on update, else null.

    An update that does not touch the column, lowers it, or holds no number adds
    nothing.
    """
    increase = field(column).try_cast("bigint") - previous(column).try_cast("bigint")
    return F.when(F.col("type") == "insert", field(column)).when(
        (F.col("type") == "update") & (increase > 0), increase.cast("string")
    )


def added(changes: DataFrame, column: str, name: str) -> DataFrame:
    """Records that add something, with the added quantity as ``name``.

    Inserts always count, even where the quantity itself is missing.
    """
    quantity = added_quantity(column)
    return changes.where((F.col("type") == "insert") | quantity.isNotNull()).withColumn(
        name, quantity
    )


def complete(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all the given columns are present."""
    return df.dropna(how="any", subset=list(columns))
