"""URL filtering by host-suffix and path-prefix expressions.

A rule names a host and the beginning of a path. Rules have few *shapes* (number of host
labels, length of path); a URL can only match one rule of each shape, so it is expanded into
one expression per shape that the rules use, never into all its suffixes and prefixes.
Expressions meet rules by an equi-join on the first eight hex digits of their SHA-256, the
full digest confirms, and the longest rule wins.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillmart.llm.common import lower_ascii
from rillmart.operators.enrich import checked_broadcast

PREFIX_DIGITS = 8
#: distinct (labels, path length) shapes the rules may have; more is an error, not a cut
MAX_SHAPES = 4096


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; '' where there is none."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The distinct shapes of the rules (a report of at most MAX_SHAPES rows)."""
    found = (
        rules.select(
            F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("chars")
        )
        .distinct()
        .limit(MAX_SHAPES + 1)
        .collect()
    )
    if len(found) > MAX_SHAPES:
        raise ValueError(f"the rules have more than {MAX_SHAPES} shapes")
    return sorted((r["labels"], r["chars"]) for r in found)


def expansions(host: Column, path: Column, kinds: list[tuple[int, int]]) -> Column:
    """The expressions of a URL, as an array: one for each shape it is long enough for."""
    labels = F.size(F.split(host, r"\.", -1))
    each = [
        F.when(
            (labels >= n) & (F.length(path) >= chars) & (host != ""),
            F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, chars)),
        )
        for n, chars in kinds
    ]
    return F.array_distinct(F.array_compact(F.array(*each))) if each else F.array().cast("array<string>")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages.

    The rule is the longest that fits (as ``host + path``), null if none does; the verdict is
    the rule's, else ``default``. Null URLs and URLs without ``://`` have an empty host and
    path and fit no rule. Repeated rows come out as often as they came in; equal rules are one
    (of two equal rules with different verdicts, ``block`` wins); rows with null parts are no
    rules. Other columns of pages are not read, so their names cannot clash.

    Each distinct (host, path) is judged once: the aggregation collapses hot URLs before any
    shuffle, and the join that hands verdicts back to rows can be split by AQE.
    """
    rules = (
        rules.where("host is not null and path is not null and verdict is not null")
        .select(
            F.concat(lower_ascii(F.col("host")), "path").alias("rule"),
            lower_ascii(F.col("host")).alias("host"), "path", "verdict",
        )
        .groupBy("rule", "host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    kinds = shapes(rules)
    keyed = checked_broadcast(
        rules.select(
            _digest(F.col("rule")).alias("rule_digest"),
            F.substring(_digest(F.col("rule")), 1, PREFIX_DIGITS).alias("prefix"),
            "rule", F.col("verdict").alias("rule_verdict"),
        )
    )
    rows = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    expanded = (
        rows.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(expansions(F.col("host"), F.col("path"), kinds)).alias("expression"))
        .select("host", "path", _digest(F.col("expression")).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    judged = (
        expanded.join(keyed, "prefix")
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")).alias("best"))
    )
    return rows.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
