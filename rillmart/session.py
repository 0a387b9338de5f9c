"""Session construction and the settings every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from rillmart.settings import DEFAULTS, STATE_PARTITIONS

#: Runtime SQL settings. Skewed joins are split by AQE even where the split costs
#: one more exchange further up, and small shuffles are coalesced at run time, so
#: ``spark.sql.shuffle.partitions`` can be sized for the largest shuffle.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # measured at run time: a side that turns out this small is broadcast after all
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(DEFAULTS.broadcast_bytes),
    # a join whose build side is small in every partition, as measured, skips the sorts
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: all state stores of an executor share one cache and one budget for writes: a chain of joins keeps
#: a dozen stores a partition, whose own caches would grow with their number. State lies on disk
#: twice, beside the executor and in the checkpoint; zstd halves what lz4, the default, leaves of it
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1024",
}


def build_session(
    app: str = "rillmart",
    master: str | None = None,
    zone: str = DEFAULTS.zone,
    **conf: str,
) -> SparkSession:
    """A session with the mart's settings; ``conf`` overrides win."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", zone)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def tune(spark: SparkSession, zone: str | None = None) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if zone:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, with one file system."""
    return spark.sparkContext.master.split("[")[0] == "local"


def streaming_session(
    spark: SparkSession, zone: str | None = None, state_partitions: int | None = None
) -> SparkSession:
    """A sibling session for stateful queries.

    State is laid out once for the lifetime of a checkpoint, so the number of
    state partitions is a setting of its own; a local session takes its cores.
    Both sessions share one SparkContext.
    """
    sibling = spark.newSession()
    tune(sibling, zone or spark.conf.get("spark.sql.session.timeZone"))
    for key, value in STATE_CONF.items():
        sibling.conf.set(key, value)
    if state_partitions is None:
        cores = max(2, spark.sparkContext.defaultParallelism)
        state_partitions = cores if is_local(spark) else STATE_PARTITIONS
    sibling.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return sibling


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Where ``spark.checkpoint.dir`` is unset, a local session makes a fresh temporary
    folder and remembers it; on a cluster that folder would be one machine's, so it is
    an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="rillmart-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made
