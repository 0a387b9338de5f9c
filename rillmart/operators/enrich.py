"""Adding dictionary names and dimension attributes to facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillmart.settings import DEFAULTS


def checked_broadcast(
    side: DataFrame,
    max_rows: int = DEFAULTS.broadcast_rows,
    max_bytes: int = DEFAULTS.broadcast_bytes,
) -> DataFrame:
    """Hint a broadcast only after measuring that the side is small.

    For sides whose size the optimizer cannot know (a dictionary behind JDBC, a
    derived table). Reads at most ``max_rows + 1`` rows in one small job; a larger
    side is returned as it is and joins by shuffle, with AQE splitting hot keys.
    File-backed dimensions need no call: Catalyst knows their size.
    """
    measured = side.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("b"),
    )
    size = measured.first()
    return F.broadcast(side) if size["n"] <= max_rows and size["b"] <= max_bytes else side


def lookup(
    fact: DataFrame, dic: DataFrame, code: str | Column, name: str, extra: dict[str, str] = {}
) -> DataFrame:
    """Inner dictionary lookup: facts without an entry vanish.

    ``dic`` has ``dic_code, dic_name``; the name is added as ``name``. Pass the
    dictionary through ``checked_broadcast`` once and use it for several lookups.
    """
    code = F.col(code) if isinstance(code, str) else code
    picked = dic.select(
        F.col("dic_code").alias("_code"),
        F.col("dic_name").alias(name),
        *[F.col(c).alias(n) for n, c in extra.items()],
    )
    return fact.join(picked, code == F.col("_code"), "inner").drop("_code")


def enrich(
    fact: DataFrame, dim: DataFrame, key: str, attributes: dict[str, str], dim_key: str = "id"
) -> DataFrame:
    """Left dimension join: every fact stays, with null attributes on a miss.

    ``attributes`` maps output names to dimension columns. ``dim`` must be unique on
    ``dim_key``. Catalyst broadcasts the (pruned) dimension when its files are small
    enough and shuffles otherwise.
    """
    picked = dim.select(
        F.col(dim_key).alias("_key"), *[F.col(c).alias(n) for n, c in attributes.items()]
    )
    return fact.join(picked, F.col(key) == F.col("_key"), "left").drop("_key")


def category_chain(dims: dict[str, DataFrame]) -> DataFrame:
    """category3 -> category2 -> category1, flattened once: one join instead of three."""
    out = dims["dim_base_category3"].select(
        F.col("id").alias("category3_id"), F.col("name").alias("category3_name"), "category2_id"
    )
    out = enrich(
        out,
        dims["dim_base_category2"],
        "category2_id",
        {"category2_name": "name", "category1_id": "category1_id"},
    )
    return enrich(out, dims["dim_base_category1"], "category1_id", {"category1_name": "name"})


def add_categories(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Category names and ids above ``category3_id``."""
    return enrich(
        fact,
        category_chain(dims),
        "category3_id",
        {
            "category3_name": "category3_name",
            "category2_id": "category2_id",
            "category2_name": "category2_name",
            "category1_id": "category1_id",
            "category1_name": "category1_name",
        },
        dim_key="category3_id",
    )


def add_trademark(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return enrich(fact, dims["dim_base_trademark"], "trademark_id", {"trademark_name": "tm_name"})


_SKU_ATTRIBUTES = (
    "spu_id spu_name trademark_id trademark_name category3_id category3_name category2_id "
    "category2_name category1_id category1_name"
).split()


def sku_snowflake(dims: dict[str, DataFrame]) -> DataFrame:
    """SKUs with product, trademark and three category levels, unique on ``sku_id``.

    Each later lookup uses a key found by an earlier one, and a missing key simply
    misses. The links are resolved among dimensions, whose rows are fewer than any
    fact's.
    """
    sku = dims["dim_sku_info"].select(
        F.col("id").alias("sku_id"), "spu_id", F.col("tm_id").alias("trademark_id"), "category3_id"
    )
    out = enrich(sku, dims["dim_spu_info"], "spu_id", {"spu_name": "spu_name"})
    return add_categories(add_trademark(out, dims), dims)


def add_sku(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Whole snowflake of a SKU, in one join of the fact."""
    attributes = {c: c for c in _SKU_ATTRIBUTES}
    return enrich(fact, sku_snowflake(dims), "sku_id", attributes, dim_key="sku_id")
