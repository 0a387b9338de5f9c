"""The training-data pipeline: five stages over ``documents``, each by one operator of llm.

Stages take (spark, docs, sf_dir); all but the last return the columns of documents. The
quality model and the PII model are fitted on what a stage receives.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from rillmart.llm import bpe, mixing, pii, quality, simhash
from rillmart.llm.common import ready
from rillmart.llm.queries import VOCABULARY
from rillmart.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept_documents(docs, quality.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints stays, the one with the smallest doc_id."""
    ready(spark)
    return simhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    ready(spark)
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources give what their weights ask; a document may come once per pass."""
    ready(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of ids and decoded text."""
    ready(spark)
    return bpe.encoded(docs, bpe.read_vocabulary(VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("pii", personal_data),
    ("mixing sources to target weights", mix_sources),
    ("bpe encoding and decoding", encode),
]

#: the fitted models decide what is kept and redacted, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written as Parquet and read again."""
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = f"{shared_dir(spark)}/pipeline-{uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{scratch}/{i}")
        docs = spark.read.parquet(f"{scratch}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
