"""The dimension configuration as maintained state, and the tables it declares.

The job ``dim_config`` folds each batch of the configuration feed into the version before it:
``version=N`` holds the newest change of every source table, deletes included, so reading the
configuration costs one row per source table however long the feed has grown. A reader pins the
version it takes for a micro-batch before it writes anything; a replay finds the pin and sees
the configuration it saw first. Every version also declares its tables in the catalog.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart.operators.dims import config_snapshot
from rillmart.operators.latest import latest_per_key
from rillmart.schemas import CONFIG_CHANGE
from rillmart.sinks.upsert import children, number

#: versions that stay beside those a reader has pinned
KEPT = 2


def writer(
    path: str, version: list[str], database: str | None = None, tables: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Fold batches of the feed; a replay of a version that is complete changes nothing.

    With ``database`` each version declares its tables there, their files under ``tables``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        fold(batch, batch_id, path, version)
        spark = batch.sparkSession
        if database:
            declare(spark, config_snapshot(read(spark, path, batch_id), version), database, tables or path)
        free(spark, path)

    return write


def fold(batch: DataFrame, batch_id: int, path: str, version: list[str]) -> None:
    """Write ``version=batch_id``: the version before, with the batch's changes on top.

    Equal versions of one source table are told by a digest of the whole change, so that a
    replay chooses alike.
    """
    spark = batch.sparkSession
    found = versions(spark, path)
    if batch_id in found:  # a replay, and a reader may be at it
        return
    changes = batch.select(*CONFIG_CHANGE.names)
    before = [v for v in found if v < batch_id]
    if before:
        changes = changes.unionByName(read(spark, path, before[-1]))
    keyed = changes.withColumn(
        "_key", F.coalesce("after.source_table", "before.source_table")
    ).withColumn("_tie", F.xxhash64(F.to_json(F.struct(*CONFIG_CHANGE.names))))
    newest = latest_per_key(keyed.where("_key is not null"), ["_key"], version, ["_tie"])
    newest.drop("_key", "_tie").write.mode("overwrite").parquet(_folder(path, batch_id))


def _folder(path: str, version: int) -> str:
    return f"{path}/versions/version={version}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, oldest first."""
    return sorted(number(p.getParent()) for p in children(spark, f"{path}/versions/version=*/_SUCCESS"))


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest change of every source table, of one version or the newest.

    It has the shape of the feed, and ``config_snapshot`` makes of it what it makes of the feed.
    """
    if version is None:
        found = versions(spark, path)
        if not found:
            raise LookupError(f"no configuration under {path}: the job dim_config has not run yet")
        version = found[-1]
    return spark.read.schema(CONFIG_CHANGE).parquet(_folder(path, version))


def _pins(spark: SparkSession, path: str, reader: str = "*") -> dict[str, dict[int, int]]:
    """Per reader, the version of each micro-batch that has one."""
    found: dict[str, dict[int, int]] = {}
    for p in children(spark, f"{path}/pins/{reader}/batch_id=*/version=*"):
        batch = p.getParent()
        found.setdefault(batch.getParent().getName(), {})[number(batch)] = number(p)
    return found


def pinned(spark: SparkSession, path: str, reader: str, batch_id: int) -> DataFrame:
    """The configuration of a reader's micro-batch: the newest at its first try, then that one.

    A batch that comes before the first version fails, and is tried again with the query, so no
    record meets an empty configuration. Pins of batches that cannot come again are removed.
    """
    while (version := _pins(spark, path, reader).get(reader, {}).get(batch_id)) is None:
        found = versions(spark, path)
        if not found:
            return read(spark, path)
        # a folder made in one step, without a file that could be half written
        pin = f"{path}/pins/{reader}/batch_id={batch_id}"
        _make(spark, f"{pin}/version={found[-1]}")
        if found[-1] not in versions(spark, path):  # freed before the pin was there
            _remove(spark, pin)
    for old in _pins(spark, path, reader)[reader]:
        if old < batch_id - 1:
            _remove(spark, f"{path}/pins/{reader}/batch_id={old}")
    return read(spark, path, version)


def free(spark: SparkSession, path: str) -> None:
    """Remove versions that are neither pinned nor among the newest ``KEPT``."""
    held = {v for of_reader in _pins(spark, path).values() for v in of_reader.values()}
    for v in versions(spark, path)[:-KEPT]:
        if v not in held:
            _remove(spark, _folder(path, v))


def _at(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _make(spark: SparkSession, name: str) -> None:
    path, files = _at(spark, name)
    files.mkdirs(path)


def _remove(spark: SparkSession, name: str) -> None:
    path, files = _at(spark, name)
    files.delete(path, True)


# -- the tables a configuration declares -------------------------------------------


def _name(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def declare(spark: SparkSession, snapshot: DataFrame, database: str, path: str) -> list[str]:
    """Make the tables that do not exist yet and add the columns that others lack.

    All columns are strings; the key and the extension text become table properties. A table
    or column that is configured no longer stays. Rows without a table or columns declare
    nothing. The rows collected are one per configured table. Returns the tables' names.
    """
    rows = snapshot.where("sink_table is not null and trim(sink_columns) != ''").orderBy("sink_table", "source_table")
    names = []
    for row in rows.collect():
        wanted = list(dict.fromkeys(c.strip() for c in row.sink_columns.split(",") if c.strip()))
        table = _name(database, row.sink_table)
        columns = ", ".join(f"{_name(c)} STRING" for c in wanted)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
            f" LOCATION {_text(f'{path}/{row.sink_table}')}"
            f" TBLPROPERTIES ('primary_key' = {_text(row.sink_pk)}, 'sink_extend' = {_text(row.sink_extend)})"
        )
        has = {c.lower() for c in columns_of(spark, database, row.sink_table)}
        added = ", ".join(f"{_name(c)} STRING" for c in wanted if c.lower() not in has)
        if added:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
        if row.sink_table not in names:
            names.append(row.sink_table)
    return names


def columns_of(spark: SparkSession, database: str, table: str) -> list[str]:
    """A declared table's columns now; a session remembers those it saw first, so it forgets them."""
    spark.catalog.refreshTable(_name(database, table))
    return spark.table(_name(database, table)).columns


def publish(dimension: DataFrame, database: str, table: str) -> None:
    """Replace a declared table's rows by a dimension's current ones, which have its columns."""
    rows = dimension.select(*[_name(c) for c in columns_of(dimension.sparkSession, database, table)])
    rows.write.mode("overwrite").insertInto(_name(database, table))
