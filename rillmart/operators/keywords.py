"""Search keywords: which pages carry one, and the words in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rillmart.functions.text import tokens


def search_pages(page_log: DataFrame) -> DataFrame:
    """Result pages of a search that name what was searched."""
    return page_log.where(
        (F.col("item_type") == "keyword")
        & (F.col("last_page_id") == "search")
        & F.col("item").isNotNull()
    )


def explode_words(df: DataFrame, text: str, word: str = "keyword", keep: list[str] | None = None) -> DataFrame:
    """One row per token of ``text``."""
    return df.select(*(keep or []), F.explode(tokens(text)).alias(word))


def explode_words_udtf(df: DataFrame, text: str, function: str, keep: list[str], word: str = "keyword") -> DataFrame:
    """The same through a registered table function ``function(text) -> (word)``."""
    view = f"_words_{function}"
    df.createOrReplaceTempView(view)
    kept = ", ".join(f"t.{c}" for c in keep)
    return df.sparkSession.sql(
        f"SELECT {kept}, w.word AS {word} FROM {view} t, LATERAL {function}(t.{text}) w"
    )
