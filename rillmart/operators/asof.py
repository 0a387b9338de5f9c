"""Lookups as of a moment: the value that was in force when a fact happened.

Versions of a key become validity intervals, and a fact meets the one interval of its key
that holds its moment. Asking by the fact's own moment makes the answer a function of fact
and history: a replayed batch sees the values it saw first, whatever came later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rillmart.operators.enrich import checked_broadcast
from rillmart.operators.latest import latest_per_key

#: seconds of the pieces that time is cut into
PIECE = 30 * 86_400

#: intervals of one key and piece that a fact may be compared with
FEW = 16

#: facts, on average, of a piece whose facts and intervals are sorted together
SORTED_ROWS = 250_000


def validity(versions: DataFrame, key: str, since: str, ties: list[str] | None = None) -> DataFrame:
    """Versions as intervals: ``since`` up to, but not including, ``until`` (null: still in force).

    Of versions of one key and moment the last by ``ties`` counts.
    """
    last = latest_per_key(versions, [key, since], ties or [since])
    return last.withColumn("until", F.lead(since).over(Window.partitionBy(key).orderBy(since)))


def join_as_of(
    facts: DataFrame,
    intervals: DataFrame,
    key: Column,
    at: Column,
    to: str,
    since: str,
    keep: dict[str, str],
    how: str = "inner",
    piece: int = PIECE,
) -> DataFrame:
    """Each fact with the interval of its key that holds its moment ``at``.

    ``intervals`` come from ``validity`` (key column ``to``, bounds ``since`` and ``until``);
    ``keep`` maps output names to their columns. Time is cut into pieces, and an interval is
    listed in each piece it touches within the span of the facts, so a hot key is spread over
    time. While no key has more than a few intervals in a piece, facts and intervals join on
    key and piece, broadcast if they prove small, else by a shuffle whose hot parts AQE splits.
    With more they are sorted together by moment, in pieces that hold a bounded share of the
    facts, and each fact takes the last interval begun: no fact meets all intervals of its
    piece. ``how`` is "inner" (facts without a version vanish) or "left".
    """
    moment = at.cast("bigint")
    span = facts.agg(F.min(moment).alias("lo"), F.max(moment).alias("hi"), F.count(moment).alias("n")).first()
    lo, hi = (span["lo"], span["hi"]) if span["lo"] is not None else (0, 0)
    first = F.greatest(F.col(since).cast("bigint"), F.lit(lo))
    last = F.least(F.coalesce(F.col("until").cast("bigint") - 1, F.lit(hi)), F.lit(hi))
    met = intervals.where((F.col(since) <= hi) & (F.col("until").isNull() | (F.col("until") > lo)))

    def listed(piece: int) -> DataFrame:
        return met.withColumn("_piece", F.explode(F.sequence(_piece(first, piece), _piece(last, piece)))).select(
            F.col(to).alias("_to"), "_piece", F.col(since).alias("_since"), F.col("until").alias("_until"),
            *[F.col(c).alias(n) for n, c in keep.items()],
        )

    most = listed(piece).groupBy("_to", "_piece").count().agg(F.max("count")).first()[0] or 0
    if most > FEW:
        parts = -(-span["n"] // SORTED_ROWS)
        size = max(1, min(piece, -(-(hi - lo + 1) // parts)))
        return _sorted_as_of(facts, listed(size), key, moment, list(keep), how, size)
    condition = (
        (key == F.col("_to"))
        & (_piece(moment, piece) == F.col("_piece"))
        & (moment >= F.col("_since"))
        & (F.col("_until").isNull() | (moment < F.col("_until")))
    )
    joined = facts.join(checked_broadcast(listed(piece)), condition, how)
    return joined.drop("_to", "_piece", "_since", "_until")


def _sorted_as_of(
    facts: DataFrame, listed: DataFrame, key: Column, moment: Column, keep: list[str], how: str, piece: int
) -> DataFrame:
    """``join_as_of`` by one sort of facts and intervals within each key and piece."""
    types = {f.name: f.dataType for f in listed.schema.fields}
    begun = F.struct("_until", *keep)
    nothing = F.lit(None).cast(T.StructType([T.StructField(n, types[n]) for n in ("_until", *keep)]))
    columns = [F.col(f"`{c}`") for c in facts.columns]
    keyed = facts.select("*", key.alias("_to"), moment.alias("_since"))
    asked = keyed.where(F.col("_to").isNotNull() & F.col("_since").isNotNull()).select(
        F.struct(*columns).alias("_fact"), F.col("_to").cast(types["_to"]).alias("_to"),
        _piece(F.col("_since"), piece).alias("_piece"), "_since", nothing.alias("_begun"),
    )
    none = F.lit(None).cast(asked.schema["_fact"].dataType).alias("_fact")
    starts = listed.where(F.col("_to").isNotNull()).select(
        none, "_to", "_piece", F.col("_since").cast("bigint").alias("_since"), begun.alias("_begun")
    )
    order = Window.partitionBy("_to", "_piece").orderBy("_since", F.col("_fact").isNotNull())
    in_force = F.last("_begun", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = asked.unionByName(starts).withColumn("_begun", in_force).where(F.col("_fact").isNotNull())
    until = F.col("_begun._until")
    holds = F.col("_begun").isNotNull() & (until.isNull() | (F.col("_since") < until))
    if how == "inner":
        return rows.where(holds).select("_fact.*", *[F.col(f"_begun.{n}").alias(n) for n in keep])
    named = rows.select("_fact.*", *[F.when(holds, F.col(f"_begun.{n}")).alias(n) for n in keep])
    unasked = keyed.where(F.col("_to").isNull() | F.col("_since").isNull())
    return named.union(unasked.select(*columns, *[F.lit(None).cast(types[n]).alias(n) for n in keep]))


def _piece(moment: Column, size: int) -> Column:
    return F.floor(moment / F.lit(size)).cast("bigint")


def dictionary_history(changes: DataFrame, since: str = "ts", ties: list[str] | None = None) -> DataFrame:
    """Versions of the code dictionary from its change records, as intervals.

    A delete ends a code: its interval has no name and matches nothing. Columns: ``dic_code,
    dic_name, since, until``.
    """
    code, name = F.col("data.dic_code"), F.col("data.dic_name")
    versions = changes.where(F.col("table") == "base_dic").select(
        code.alias("dic_code"), F.when(F.col("type") != "delete", name).alias("dic_name"),
        F.col(since).alias("since"), *(ties or []),
    )
    return validity(versions, "dic_code", "since", ties).where(F.col("dic_name").isNotNull()).select(
        "dic_code", "dic_name", "since", "until"
    )


def lookup_as_of(
    fact: DataFrame, history: DataFrame, code: str | Column, name: str, at: str | Column = "ts", how: str = "inner"
) -> DataFrame:
    """Dictionary lookup as of the fact's epoch second ``at``; see ``dictionary_history``."""
    code = F.col(code) if isinstance(code, str) else code
    at = F.col(at) if isinstance(at, str) else at
    return join_as_of(fact, history, code, at, "dic_code", "since", {name: "dic_name"}, how)


def is_history(dic: DataFrame) -> bool:
    return "since" in dic.columns
