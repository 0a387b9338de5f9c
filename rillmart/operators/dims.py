"""Configuration-driven dimension tables.

A small configuration table says which source tables are dimensions, which of their
columns to keep and where they go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillmart.operators.enrich import checked_broadcast
from rillmart.operators.latest import current_state, latest_per_key
from rillmart.schemas import strings

DEFAULT_PK = "id"


def config_snapshot(config_changes: DataFrame, version: list[str]) -> DataFrame:
    """Current configuration with its defaults: key ``id``, no extension text."""
    return current_state(config_changes, "source_table", version).select(
        "source_table",
        "sink_table",
        "sink_columns",
        F.coalesce("sink_pk", F.lit(DEFAULT_PK)).alias("sink_pk"),
        F.coalesce("sink_extend", F.lit("")).alias("sink_extend"),
    )


def prune(data: Column, sink_columns: Column) -> Column:
    """Keep the listed entries of a string map."""
    wanted = F.split(sink_columns, ",")
    return F.map_filter(data, lambda k, _: F.array_contains(wanted, k))


def dimension_rows(changes: DataFrame, config: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Change records of configured tables as (sink_table, pk, type, data).

    The configuration is complete before the first record is joined, so no record is
    lost to a configuration that arrives later. ``data`` holds the kept columns only,
    missing values as empty strings; ``pk`` is the row's key in its dimension.
    """
    small = checked_broadcast(config)
    joined = changes.join(small, changes["table"] == small["source_table"], "inner")
    data = F.transform_values(
        prune(F.col("data"), F.col("sink_columns")), lambda _, v: F.coalesce(v, F.lit(""))
    )
    return joined.select(
        *(keep or []),
        "sink_table",
        F.element_at("data", F.col("sink_pk")).alias("pk"),
        "type",
        data.alias("data"),
    )


def latest_rows(
    rows: DataFrame, version: list[str], ties: list[str] | None = None, honour_deletes: bool = False
) -> DataFrame:
    """Newest version of each dimension row.

    A delete record upserts its values like any other change, unless
    ``honour_deletes`` asks for the key to go.
    """
    last = latest_per_key(rows, ["sink_table", "pk"], version, ties)
    return last.where(F.col("type") != "delete") if honour_deletes else last


def as_table(rows: DataFrame, sink_table: str, columns: list[str]) -> DataFrame:
    """One dimension as a plain table of strings."""
    return rows.where(F.col("sink_table") == sink_table).select(
        *[F.col("data")[c].alias(c) for c in columns]
    )


def table_schema(sink_columns: str):
    """Schema of a dimension table: every configured column, as a string."""
    return strings(sink_columns.replace(",", " "))


def where_equal(dim: DataFrame, **wanted: str) -> DataFrame:
    """Rows matching all the given column values; pushed down to the files."""
    out = dim
    for name, value in wanted.items():
        out = out.where(F.col(name) == value)
    return out
