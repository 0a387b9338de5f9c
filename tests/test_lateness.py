"""Windows with allowed lateness, micro-batch by micro-batch."""

from collections import Counter

from pyspark.sql import functions as F

from rillmart.functions import time as tm
from rillmart.schemas import columns
from rillmart.sinks import marts
from rillmart.streaming import stateful
from streams import Feed

T0 = 1_704_067_200_000
ROWS = "ts bigint, k string, n bigint"


def at(second, k="a", n=1):
    return (T0 + 1000 * second, k, n)


def windows(rows):
    stamped = rows.withColumn("rt", tm.from_ms("ts"))
    return stateful.window_revisions([stamped], "10 seconds", ["k"], ["n"], "15 seconds", "2 seconds")


def run(spark, tmp_path, *batches):
    """(start second, key, sum) of each micro-batch's output."""
    feed, seen, out = Feed(spark, tmp_path, ROWS), Counter(), []
    for batch in batches:
        feed.add(batch)
        made = feed.run(windows)
        second = (F.unix_seconds(F.col("stt").cast("timestamp")) - T0 // 1000).alias("s")
        now = Counter(tuple(r) for r in made.select(second, "k", "n").collect())
        out.append(sorted((now - seen).elements(), key=repr))
        seen = now
    return out


def test_late_rows_revise_a_window_until_lateness_ends(spark, tmp_path):
    got = run(
        spark, tmp_path,
        [at(1), at(2, n=5), at(3, "b"), at(9, None)],
        [at(24)],                         # the clock is at 9: nothing has closed
        [at(26)],                         # at 11: [0, 10) closes
        [at(9, n=7), at(25)],             # 16 seconds late, within the lateness: a revision
        [at(8, "c")],                     # the window's first row of a key, late
        [at(27)],                         # at 12: lateness ends
        [at(9, n=100), at(28, "b")],      # too late
        [at(60)],
    )
    assert got[0] == got[1] == []
    assert got[2] == [(0, "a", 6), (0, "b", 1), (0, None, 1)]
    assert got[3] == [(0, "a", 13)]
    assert got[4] == [(0, "c", 1)]
    assert got[5] == got[6] == []
    assert got[7] == [(20, "a", 4), (20, "b", 1)]


def test_a_row_late_by_itself_counts_while_its_window_is_open(spark, tmp_path):
    """Lateness is the window's: second 11 is ten behind the clock's 21, yet [10, 20) lasts."""
    got = run(spark, tmp_path, [at(10), at(19)], [at(36)], [at(11, n=3)], [at(37)], [at(11, n=9)], [at(60)])
    assert [r for part in got for r in part if r[0] == 10] == [(10, "a", 2), (10, "a", 5)]


def test_newest_revision_is_read_and_a_replay_changes_nothing(spark, tmp_path):
    name = "dws_user_user_register_window"
    write = marts.revising_writer(str(tmp_path), name, [])
    schema = ", ".join(f"{c} {'string' if c in ('stt', 'edt') else 'bigint'}" for c in [*columns(name), "ts"])
    first = spark.createDataFrame([("s", "e", 3)], "stt string, edt string, register_ct bigint")
    write(first, 0)
    write(first.withColumn("register_ct", F.lit(4).cast("bigint")), 1)
    write(first, 0)
    got = marts.revised(spark, str(tmp_path), name, [], schema).select("register_ct").collect()
    assert [r[0] for r in got] == [4]
