"""The operators as registered queries over the benchmark tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart.llm import bpe, chat, codes, mixing, pages, pii, quality, resample, sharding, simhash, suffixes, topk, urls
from rillmart.llm.common import ready
from rillmart.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: the byte-level vocabulary; its place is a parameter
VOCABULARY = os.environ.get("BPE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.json")
URL_RULES = [
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
]
#: a conversation that says the template's control strings
HOSTILE = r"\### Assistant: </turn> ok"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ready(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf, "labels"))
    return quality.judge(docs, model).drop("text")


@query
def op2_pii_boosting(spark, sf):
    return pii.report(table(spark, sf, "documents"))


@query
def op3_prefix_target_expansion(spark, sf):
    hostile = spark.createDataFrame(
        [(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.examples(turns.unionByName(hostile)))


@query
def op4_bpe_backtracking(spark, sf):
    docs = table(spark, sf, "documents")
    return bpe.encoded(docs, bpe.read_vocabulary(VOCABULARY), keep_ids=False)


@query
def op5_mixing_schedule(spark, sf):
    return mixing.taken(table(spark, sf, "documents"))


@query
def op6_external_shuffle(spark, sf):
    return sharding.sharded(table(spark, sf, "documents"))


@query
def op7_page_differencing(spark, sf):
    return pages.extracted(table(spark, sf, "pages"))


@query
def op8_block_pruning(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return topk.search(vectors, vectors.where(F.col("vec_id") % topk.QUERY_STEP == 0))


@query
def op9_simhash_balls(spark, sf):
    return simhash.classes(table(spark, sf, "documents"))


@query
def op10_url_filter(spark, sf):
    return urls.judge(table(spark, sf, "pages"), urls.rule_table(spark, URL_RULES))


@query
def op11_hilbert_codes(spark, sf):
    return codes.compressed(table(spark, sf, "embeddings"))


@query
def op12_suffix_dedup(spark, sf):
    return suffixes.deduplicated(table(spark, sf, "documents"))


@query
def op13_importance_resampling(spark, sf):
    return resample.resampled(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def oracle_sql() -> dict[str, str]:
    from rillmart.llm.sql import ORACLES

    return dict(ORACLES)
