"""Keyword segmentation.

The default segmenter is native: runs of letters and digits, lower-cased, so
counting words over whole corpora never leaves the JVM. A dictionary segmenter
can be plugged in as a Python table function (see ``register_segmenter``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, SparkSession, functions as F

TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column | str) -> Column:
    """Array of the tokens of a text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(col), F.lit(f"({TOKEN})"), F.lit(1))


def register_segmenter(
    spark: SparkSession,
    segment: Callable[[str], Iterable[str]],
    name: str = "analyze_keyword",
) -> None:
    """Register ``name(text) -> (word)`` for use as ``LATERAL name(text)`` in SQL."""

    class Segmenter:
        def eval(self, text: str):
            for word in segment(text) if text is not None else ():
                yield (word,)

    spark.udtf.register(name, F.udtf(Segmenter, returnType="word: string"))
