"""Lookups as of a moment against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from rillmart.operators import asof
from rillmart.plans import dwd_db

HISTORY = "table string, type string, ts bigint, seq bigint, data struct<dic_code: string, dic_name: string>"


def history(spark, rows):
    """rows: (code, name or None for a delete, second, seq)."""
    data = [("base_dic", "update" if n else "delete", ts, seq, (c, n or "gone")) for c, n, ts, seq in rows]
    return asof.dictionary_history(spark.createDataFrame(data, HISTORY), ties=["seq"])


def brute(facts, versions):
    out = []
    for fact, code, ts in facts:
        held = [v for v in versions if v[0] == code and ts is not None and v[2] <= ts]
        name = max(held, key=lambda v: (v[2], v[3]))[1] if held else None
        out.append((fact, name))
    return out


def some(seed, codes, span, n):
    rng = random.Random(seed)
    versions = [(rng.choice(codes), rng.choice([None, "x", "y"]) and f"n{i}", rng.randrange(span), i) for i in range(60)]
    hot = lambda: codes[0] if rng.random() < 0.7 else rng.choice(codes + ["none"])
    facts = [(i, hot(), rng.randrange(-5, span + 50)) for i in range(n)] + [(n, None, 3), (n + 1, codes[0], None)]
    return facts, versions


@pytest.mark.parametrize("piece", [1, 7, 1000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_brute_force_whatever_the_pieces(spark, piece, how):
    facts, versions = some(piece, ["a", "b", "c"], 200, 800)
    df = spark.createDataFrame(facts, "id int, code string, ts bigint").repartition(3)
    out = asof.join_as_of(
        df, history(spark, versions), F.col("code"), F.col("ts"), "dic_code", "since", {"name": "dic_name"}, how, piece
    )
    assert out.columns == ["id", "code", "ts", "name"]
    want = [r for r in brute(facts, versions) if how == "left" or r[1]]
    assert sorted((r["id"], r["name"]) for r in out.collect()) == sorted(want, key=lambda r: r[0])


def test_bounds_ties_and_deletes(spark):
    versions = [("a", "one", 10, 0), ("a", "two", 20, 1), ("a", "last", 20, 2), ("a", None, 30, 3), ("a", "back", 40, 4)]
    facts = [(ts, "a", ts) for ts in (9, 10, 19, 20, 29, 30, 39, 40, 10**9)]
    df = spark.createDataFrame(facts, "id int, code string, ts bigint")
    got = {r["id"]: r["name"] for r in asof.lookup_as_of(df, history(spark, versions), "code", "name").collect()}
    assert got == {10: "one", 19: "one", 20: "last", 29: "last", 40: "back", 10**9: "back"}


def test_empty_sides(spark):
    df = spark.createDataFrame([(1, "a", 5)], "id int, code string, ts bigint")
    none = history(spark, [("z", "n", 0, 0)])
    assert asof.lookup_as_of(df, none, "code", "name").count() == 0
    assert asof.lookup_as_of(df, none, "code", "name", how="left").first()["name"] is None
    assert asof.lookup_as_of(df.limit(0), none, "code", "name").count() == 0


def test_a_replayed_batch_gets_the_same_names(spark):
    """What the history learns later changes no fact of before."""
    facts, versions = some(4, ["1", "2"], 100, 200)
    batch = spark.createDataFrame([f for f in facts if f[2] is not None and f[2] < 50], "id int, source_type string, ts bigint")

    def named(known):
        out = dwd_db.name_code(batch, history(spark, [v for v in versions if v[2] < known]), "source_type")
        return sorted(map(tuple, out.select("id", "source_type").collect()))

    first = named(50)
    assert first and named(100) == first
    plain = spark.createDataFrame([("1", "now")], "dic_code string, dic_name string")
    assert {r["source_type"] for r in dwd_db.name_code(batch, plain, "source_type").collect()} == {"now"}


def test_a_large_history_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(asof, "checked_broadcast", lambda side: side)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts, versions = some(9, ["a", "b"], 300, 300)
        df = spark.createDataFrame(facts, "id int, code string, ts bigint")
        out = asof.join_as_of(df, history(spark, versions), F.col("code"), F.col("ts"), "dic_code", "since", {"name": "dic_name"}, piece=20)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "_piece" in plan and "Broadcast" not in plan
        assert sorted((r["id"], r["name"]) for r in out.collect()) == sorted(r for r in brute(facts, versions) if r[1])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("rows", [3, 40, 10**6])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_many_versions_in_a_piece_are_sorted_with_the_facts(spark, monkeypatch, rows, how):
    """No fact is compared with all versions of its piece."""
    monkeypatch.setattr(asof, "FEW", 2)
    monkeypatch.setattr(asof, "SORTED_ROWS", rows)
    facts, versions = some(rows, ["a", "b", "c"], 200, 500)
    df = spark.createDataFrame(facts, "id int, code string, ts bigint").repartition(3)
    out = asof.join_as_of(
        df, history(spark, versions), F.col("code"), F.col("ts"), "dic_code", "since", {"name": "dic_name"}, how
    )
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.columns == ["id", "code", "ts", "name"]
    want = [r for r in brute(facts, versions) if how == "left" or r[1]]
    assert sorted((r["id"], r["name"]) for r in out.collect()) == sorted(want, key=lambda r: r[0])
