"""Order-dependent columns equal plain windows, also when one key holds most rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from duebook.operators import blocks, replay
from duebook.operators.blocks import dense_key, dense_key_with_copies, neighbour, ordered_blocks, rank_within, running


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; one key has two thirds of them, some keys a single row."""
    rng = random.Random(7)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, i + 10]), rng.randrange(10**6), i,
             rng.choice([None, None, rng.randrange(100)])) for i in range(3000)]
    return spark.createDataFrame(rows, "key bigint, t bigint, id bigint, v bigint").cache()


def same(a, b):
    assert sorted(map(tuple, a.select(sorted(a.columns)).collect()), key=str) == sorted(
        map(tuple, b.select(sorted(b.columns)).collect()), key=str
    )


def test_dense_key_is_the_plain_row_number(spark, skewed):
    order = ["key", "t", "id"]
    got = dense_key(skewed, "n", order, blocks=7)
    want = skewed.withColumn("n", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    same(got, want)
    assert got.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 3000, 3000)


def test_dense_key_starts_after_a_given_id(skewed):
    top = skewed.agg(F.max("id")).scalar()
    assert dense_key(skewed.limit(5), "n", ["t", "id"], top).agg(F.min("n"), F.max("n")).first() == (3000, 3004)


def test_dense_key_of_nothing(skewed):
    assert dense_key(skewed.limit(0), "n", ["t", "id"]).count() == 0


def test_string_order(spark):
    df = spark.createDataFrame([("10",), ("9",), ("100",), ("C1",), ("c1",)], "s string")
    assert {r["s"]: r["n"] for r in dense_key(df, "n", ["s"], blocks=3).collect()} == {
        "10": 1, "100": 2, "9": 3, "C1": 4, "c1": 5
    }


def test_copies_get_keys_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(blocks, "_COPIES_PER_PIECE", 4)
    rows = [("a",)] * 23 + [("b",)] + [(None,)] * 5 + [("c",)] * 4
    out = dense_key_with_copies(spark.createDataFrame(rows, "s string"), "n", blocks=3).collect()
    assert sorted(r["n"] for r in out) == list(range(1, 34))
    assert sorted((r["n"], r["s"]) for r in out)[4:8] == [(5, None), (6, "a"), (7, "a"), (8, "a")]
    assert sum(r["s"] == "a" for r in out) == 23


def test_rank_within(skewed):
    want = skewed.withColumn(
        "r", F.row_number().over(Window.partitionBy("key").orderBy("t", "id")).cast("bigint")
    )
    same(rank_within(skewed, "r", ["key"], ["t", "id"], blocks=9), want)


def test_running_sum_and_last(skewed):
    w = Window.partitionBy("key").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("s", F.sum("v").over(w)).withColumn("l", F.last("v", True).over(w))
    cut = ordered_blocks(skewed, ["key", "t", "id"], blocks=11)
    got = running(cut, ["key"], sums={"s": F.coalesce("v", F.lit(0))}, lasts={"l": F.col("v")})
    same(got.drop("_block", "_pos"), want.withColumn("s", F.coalesce("s", F.lit(0))))


@pytest.mark.parametrize("step", [-1, 1])
def test_neighbour(skewed, step):
    w = Window.partitionBy("key").orderBy("t", "id")
    want = skewed.withColumn("o", (F.lag if step < 0 else F.lead)("id").over(w))
    cut = ordered_blocks(skewed, ["key", "t", "id"], blocks=11)
    same(neighbour(cut, ["key"], {"o": "id"}, step).drop("_block", "_pos"), want)


def test_sessions_match_session_window(spark, skewed):
    events = skewed.select("key", F.timestamp_seconds("t").alias("ts"), "id")
    got = replay.sessions(events, "key", "ts", "id")
    want = events.groupBy("key", F.session_window("ts", "30 minutes").alias("s")).agg(
        F.count("*").alias("event_count")
    )
    same(got, want.select("key", F.col("s.start").alias("session_start"),
                          F.col("s.end").alias("session_end"), "event_count"))


def test_the_number_of_blocks_does_not_matter(spark):
    from duebook import constants as K
    from duebook.operators import conversations, workflow
    from duebook.plans.core import core
    from duebook.sources import requests

    folder = "/root/testdata/sf0.001"
    c = core(spark, folder)
    changes = requests.status_changes(spark, folder)
    until = F.lit("2024-02-01").cast("timestamp")

    def results():
        return [
            workflow.transition_history(changes, K.NOTIFICATION_TRANSITIONS).collect(),
            conversations.session_memory(c.activity).collect(),
            replay.stuck_intervals(changes, until).collect(),
        ]

    few = results()
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "41")
    try:
        many = results()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    for a, b in zip(few, many):
        assert sorted(map(repr, a)) == sorted(map(repr, b))
