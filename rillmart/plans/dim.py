"""Dimension tables from change records and their configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rillmart.operators import dims


def dim_sink(
    changes: DataFrame,
    config_changes: DataFrame,
    config_version: list[str],
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows to upsert into the dimension store: (sink_table, pk, type, data).

    Deletes and snapshot rows pass like any other change.
    """
    config = dims.config_snapshot(config_changes, config_version)
    return dims.dimension_rows(changes, config, keep)
