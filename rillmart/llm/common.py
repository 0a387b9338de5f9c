"""What the operators share: the word rule, shared storage, scratch tables."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillmart.session import shared_dir, tune

#: words are runs of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ready(spark: SparkSession) -> None:
    """Runtime settings the operators rely on.

    Arrow batches hold at most 256 rows, so that a batch stays small where texts are long.
    Functions of this subpackage travel by value: executors need not have it installed.
    """
    tune(spark)
    for name in [n for n in sys.modules if n == "rillmart.llm" or n.startswith("rillmart.llm.")]:
        cloudpickle.register_pickle_by_value(sys.modules[name])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")


def materialize(df: DataFrame) -> DataFrame:
    """The rows written once to the cluster's checkpoint folder, with their lineage cut."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def word_count(text: Column) -> Column:
    """Number of words of a text, as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())
