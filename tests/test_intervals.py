"""Interval operators against brute force, with ties, nulls and a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sitebooks.operators.intervals import match_nearest, open_counts
from sitebooks.operators.joins import overlap_join, tolerance_join
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
MICRO = dt.timedelta(microseconds=1)


def minute(m):
    return T0 + dt.timedelta(minutes=m)


def test_tolerance_bounds(spark):
    left = spark.createDataFrame(
        [(1, minute(15)), (2, minute(-15)), (3, minute(15) + MICRO), (4, minute(-15) - MICRO)], "id int, at timestamp"
    ).withColumn("k", F.lit("x"))
    right = spark.createDataFrame([("x", T0)], "k string, ref timestamp")
    hits = match_nearest(left, right, ["k"], "at", "ref", 900).where("matched_at IS NOT NULL")
    assert rows(hits, "id") == [(1,), (2,)]
    assert rows(tolerance_join(left, right, ["k"], "at", "ref", 900), "id") == [(1,), (2,)]
    assert rows(tolerance_join(left, right, ["k"], "at", "ref", 900, "left_anti"), "id") == [(3,), (4,)]


def test_nearest_prefers_the_earlier_of_two(spark):
    left = spark.createDataFrame([("x", minute(10))], "k string, at timestamp")
    right = spark.createDataFrame([("x", minute(5)), ("x", minute(15)), ("x", minute(2))], "k string, ref timestamp")
    assert match_nearest(left, right, ["k"], "at", "ref", 900).first()["matched_at"] == minute(5)


def test_nearest_keeps_rows_with_null_keys(spark):
    left = spark.createDataFrame([(None, T0), ("x", None), ("x", T0)], "k string, at timestamp")
    right = spark.createDataFrame([(None, T0), ("x", T0)], "k string, ref timestamp")
    out = match_nearest(left, right, ["k"], "at", "ref", 900)
    assert sorted((r["k"] or "", r["matched_at"] is not None) for r in out.collect()) == [
        ("", False), ("x", False), ("x", True),
    ]


def _random_intervals(rng, n, span):
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])
        start = rng.randrange(span)
        out.append((i, key, minute(start), minute(start + rng.choice([-3, 0, 1, 5, 30, 400]))))
    return out


@pytest.mark.parametrize("bucket", [600, 3600, 86400])
def test_open_counts_equal_brute_force(spark, bucket):
    data = _random_intervals(random.Random(bucket), 300, 2000)
    df = spark.createDataFrame(data, "id int, k string, s timestamp, e timestamp").withColumn("one", F.lit(1))
    out = open_counts(df, df, ["k"], "s", "s", "e", {"n": "one"}, bucket)
    expected = [
        (i, sum(1 for _, k2, s2, e2 in data if k is not None and k2 == k and s2 < s and e2 >= s))
        for i, k, s, e in data
    ]
    assert rows(out, "id", "n") == expected
    pairs = overlap_join(df, df, ["k"], "s", "e", bucket, "left").groupBy("id").agg(F.count("other_id"))
    assert rows(pairs) == expected


@pytest.mark.parametrize("seconds,bucket", [(900, 60), (900, 7200), (5400, 3600)])
def test_nearest_equals_brute_force(spark, seconds, bucket):
    rng = random.Random(seconds)
    left = [(i, rng.choice(["hot", "hot", "a"]), minute(rng.randrange(3000))) for i in range(200)]
    right = [(rng.choice(["hot", "a", "b"]), minute(rng.randrange(3000))) for _ in range(150)]
    out = match_nearest(
        spark.createDataFrame(left, "id int, k string, at timestamp"),
        spark.createDataFrame(right, "k string, ref timestamp"),
        ["k"], "at", "ref", seconds, bucket_seconds=bucket,
    )
    expected = []
    for i, key, at in left:
        near = [(abs(ref - at), ref) for k, ref in right if k == key and abs(ref - at).total_seconds() <= seconds]
        expected.append((i, min(near)[1] if near else None))
    assert rows(out, "id", "matched_at") == expected


def test_overlap_edges(spark):
    def count(*intervals):
        df = spark.createDataFrame(
            [(i, "k", minute(s), minute(e)) for i, (s, e) in enumerate(intervals)], "id int, k string, s timestamp, e timestamp"
        ).withColumn("one", F.lit(1))
        return [n for _, n in rows(open_counts(df, df, ["k"], "s", "s", "e", {"n": "one"}), "id", "n")]

    assert count((0, 10), (0, 10)) == [0, 0]  # starting together
    assert count((0, 10), (10, 20)) == [0, 1]  # ends exactly when the other begins
    assert count((5, 1), (3, 4), (6, 7)) == [0, 0, 0]  # ends before it starts
    assert count((0, 1)) == [0]
    assert count((0, 5000), (4999, 5001)) == [0, 1]  # spans several buckets


def test_intervals_of_centuries_cost_two_steps(spark):
    df = spark.createDataFrame(
        [(1, "x", dt.datetime(1500, 1, 1), dt.datetime(2500, 1, 1)), (2, "x", T0, minute(1)), (3, "x", None, T0), (4, None, T0, minute(9))],
        "id int, k string, s timestamp, e timestamp",
    ).withColumn("one", F.lit(1))
    out = open_counts(df, df, ["k"], "s", "s", "e", {"n": "one"}, 60)
    assert rows(out, "id", "n") == [(1, 0), (2, 1), (3, 0), (4, 0)]


def test_a_hot_key_is_cut_into_buckets(spark):
    df = spark.range(6000).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id")).alias("s"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id") + 3000).alias("e"),
        F.lit(1).alias("one"),
    )
    got = dict(rows(open_counts(df, df, ["k"], "s", "s", "e", {"n": "one"}, 300), "id", "n"))
    assert all(got[i] == (min(i // 3, 1000) if i % 3 == 0 else 0) for i in range(6000))

