import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitebooks.operators import aggregates, filters, joins, mutate, project, quality, reshape, sets, windows
from tests.conftest import rows


def test_conform_casts_and_fills(spark):
    df = spark.createDataFrame([("7", 1.5), ("x", 2.5)], "Code string, extra double")
    target = StructType.fromDDL("code int, missing string")
    out = project.conform(df, target, optional=["Missing"], lenient=True)
    assert out.schema.simpleString() == "struct<code:int,missing:string>"
    assert rows(out) == [(None, None), (7, None)]
    with pytest.raises(ValueError):
        project.conform(df, target)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        project.conform(df, target, optional=["missing"]).collect()


def test_lenient_conform_counts_what_it_loses(spark):
    df = spark.createDataFrame([("7", "1.5"), ("x", "y"), (None, "2"), ("8", "z")], "Code string, v string")
    target = StructType.fromDDL("code int, v double, more string")
    steps = quality.Steps()
    out = project.conform(df, target, optional=["more"], lenient=True, watch=steps.watch)
    assert len(out.collect()) == 4
    assert rows(steps.frame(spark).select("step", "rows", "unreadable")) == [("lenient cast", 4, 2)]
    assert rows(df.where(project.unreadable(df, StructType.fromDDL("v double, other int")))) == [("8", "z"), ("x", "y")]
    assert df.where(project.unreadable(df, df.schema)).count() == 0


def test_drop_all_refuses_a_bare_string(spark):
    df = spark.createDataFrame([(1, 2)], "a int, abc int")
    with pytest.raises(TypeError):
        project.drop_all(df, "abc")
    assert project.drop_all(df, ["abc", "nothing"]).columns == ["a"]


def test_union_fills_and_casts(spark):
    target = StructType.fromDDL("code string, v int")
    a = spark.createDataFrame([(1, 2)], "code int, v int")
    b = spark.createDataFrame([("x",)], "code string")
    assert rows(sets.union_all([a, b], target)) == [("1", 2), ("x", None)]
    assert rows(sets.union_distinct([a, a, b], target)) == [("1", 2), ("x", None)]


def test_null_safe_join_and_totals(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    out = aggregates.with_totals(df, ["k"], {"total": F.sum("v")})
    assert rows(out) == [(None, 2, 5), (None, 3, 5), ("a", 1, 1)]


def test_coalesce_lookup_never_multiplies(spark):
    df = spark.createDataFrame([(1, "own"), (1, None), (2, None), (3, None), (None, None)], "k int, v string")
    first = spark.createDataFrame([(1, "b"), (1, "a")], "id int, name string")
    second = spark.createDataFrame([(1, "no"), (2, "c")], "id int, name string")
    out = joins.coalesce_lookup(
        df, "place", F.col("v"), [(first, "k", "id", "name"), (second, "k", "id", "name")]
    )
    assert rows(out, "k", "place") == [(None, None), (1, "a"), (1, "own"), (2, "c"), (3, None)]


def test_map_values_keeps_unknown(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    pairs = spark.createDataFrame([("x", "EUR")], "company string, currency string")
    assert rows(joins.map_values(df, "c", pairs, "company", "currency")) == [(None,), ("EUR",), ("y",)]


def test_latest_by_is_deterministic(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, day, "b"), (1, day, "a"), (1, None, "z"), (2, None, "n")], "k int, d date, tag string"
    )
    out = windows.latest_by(df, ["k"], [F.col("d").desc_nulls_last(), F.col("tag")])
    assert rows(out, "k", "tag") == [(1, "a"), (2, "n")]


def test_latest_with_ties(spark):
    df = spark.createDataFrame(
        [("a", 2, "p"), ("a", 2, "q"), ("a", 1, "old"), (None, 5, "n"), (None, 4, "m")],
        "k string, t int, tag string",
    )
    assert rows(windows.latest_with_ties(df, ["k"], "t"), "tag") == [("n",), ("p",), ("q",)]


def test_thresholds(spark):
    df = spark.createDataFrame([("s", 1, 60.0), ("s", 2, 80.0), ("s", 3, 95.0)], "k string, d int, pct double")
    levels = [80.0, 99.0, 50.0]
    flags = windows.flag_until_threshold(df, "pct", ["k"], ["d"], levels)
    assert rows(flags.where("needed = 1"), "threshold", "d") == [(50.0, 1), (80.0, 1), (80.0, 2)]
    counts = windows.count_until_threshold(df, "pct", ["k"], levels)
    assert rows(counts, "threshold", "needed") == [(50.0, 1), (80.0, 2), (99.0, 0)]


def test_unpivot_keeps_null_months(spark):
    df = spark.createDataFrame([("p", 1.0, None)], "id string, Jan double, Feb double")
    out = reshape.unpivot_months(df, ["id"], {"Jan": "Jan", "Feb": "Feb"})
    assert rows(out) == [("p", "Feb", None), ("p", "Jan", 1.0)]


def test_month_spine_has_twelve_rows(spark):
    df = spark.createDataFrame([("a", 2, 5.0), ("a", 2, 1.0), ("b", 12, None)], "k string, m int, v double")
    out = reshape.month_spine(df, ["k"], "m", ["v"])
    assert out.count() == 24
    assert rows(out.where("v <> 0")) == [("a", 2, 6.0)]


def test_explode_drops_null_and_empty(spark):
    df = spark.createDataFrame(
        [(1, [(1,), (2,)]), (2, []), (3, None)], "id int, items array<struct<x:int>>"
    )
    assert rows(reshape.explode_structs(df, "items", ["id"])) == [(1, 1), (1, 2)]


def test_filters(spark):
    df = spark.createDataFrame([("a", 1), (" ", 2), ("", 3), (None, 4)], "c string, y int")
    assert rows(filters.reject_blank(df, "c"), "y") == [(1,)]
    assert rows(filters.keep_years(df, "y", 2, 1, 1), "y") == [(1,), (2,), (3,)]
    assert rows(filters.in_values(df, "y", [1, 4]), "y") == [(1,), (4,)]
    keys = spark.createDataFrame([(4,), (4,)], "k int")
    assert rows(filters.in_values(df, "y", keys), "y") == [(4,)]


def test_watermark(spark):
    at = lambda d: dt.datetime(2020, 1, d)
    df = spark.createDataFrame([(at(1),), (at(2),), (at(3),)], "t timestamp")
    empty = df.where("false")
    assert filters.newer_than(df, "t", empty, at(1)).count() == 2  # equal to the default is excluded
    assert filters.newer_than(df, "t", df.where(F.col("t") <= at(2)), at(1)).count() == 1


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([("c", 2), ("d", 3)], "v string, k int")
    once = mutate.upsert(old, new, ["k"])
    assert rows(once) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(mutate.upsert(once, new, ["k"])) == rows(once)


def test_upsert_of_repeated_source_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (1, "y"), (None, "n"), (None, "n")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        mutate.upsert(old, new, ["k"]).collect()
    got = mutate.upsert(old, new, ["k"], [F.col("v").desc()])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "y"), (2, "b"), (None, "n"), (None, "n")]


def test_lookup_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", 10), (None, 99)], "k2 string, v int")
    got = joins.lookup_spread(left, F.col("k"), dim, "k2")
    assert sorted(map(tuple, got.collect())) == [(1, "a", 10), (2, None, None), (3, None, None), (4, "z", None)]


def test_run_log_upsert_has_two_keys(spark):
    log = spark.createDataFrame([("match", "NL", "2024-01-01"), ("match", "DE", "2024-01-01")], "job string, country string, run_date string")
    new = spark.createDataFrame([("match", "NL", "2024-02-01"), ("size", "NL", "2024-02-01")], "job string, country string, run_date string")
    assert rows(mutate.upsert(log, new, ["job", "country"])) == [
        ("match", "DE", "2024-01-01"), ("match", "NL", "2024-02-01"), ("size", "NL", "2024-02-01"),
    ]


def test_purge_and_audit(spark):
    df = spark.createDataFrame([(1996,), (1997,), (None,)], "y int")
    assert rows(mutate.purge(df, "y", 2001)) == [(None,), (1997,)]
    assert rows(mutate.purge_audit(df, "t", "y", 2001)) == [("t", 1, 1997, 2001)]


def test_changed_groups_take_whole_periods(spark):
    df = spark.createDataFrame([("p1", 1), ("p1", 9), ("p2", 2)], "p string, t int")
    assert rows(mutate.changed_groups(df, "p", "t", F.lit(5))) == [("p1", 1), ("p1", 9)]


def test_after_logged_day(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 7)], "g string, d int")
    log = spark.createDataFrame([("a", 1), ("a", 0)], "g string, last int")
    assert rows(mutate.after_logged_day(df, log, "g", "d", "last")) == [(None, 7), ("a", 2), ("b", 1)]
    again = log.unionByName(spark.createDataFrame([("a", 2), ("b", 1), (None, 7)], "g string, last int"))
    assert mutate.after_logged_day(df, again, "g", "d", "last").count() == 0


def test_watched_counts_come_with_the_job(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    seen_df, seen = quality.watched(df, missing=F.col("k").isNull())
    seen_df.where("k IS NOT NULL").collect()
    assert seen.get == {"rows": 2, "missing": 1}


def test_job_status(spark):
    df = spark.createDataFrame([("Success: 5",), ("boom",), (None,)], "m string")
    assert rows(quality.job_status(df, "m"), "status") == [("failed",), ("failed",), ("success",)]


def test_may_match_keeps_all_that_match(spark):
    df = spark.range(2000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("t"))
    wanted = df.where("k IS NULL OR k % 100 = 0").union(df.where("k = 7"))
    left = [r[0] for r in joins.may_match(df, ["k", "t"], wanted).collect()]
    assert {None, 7, *range(100, 2000, 100)} <= set(left) and len(left) == len(set(left)) < 40
    crowded = [r[0] for r in joins.may_match(df, ["k", "t"], wanted, bits=64).collect()]
    assert {None, 7, *range(100, 2000, 100)} <= set(crowded)
    assert joins.may_match(df, ["k", "t"], wanted.limit(0)).count() == 0


def test_latest_wide_equals_latest_by(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a"]), rng.choice([None, 1, 2, 5]), rng.choice("xyz")) for _ in range(300)] + [(9, "a", None, "z"), (9, "a", None, "y")]
    df = spark.createDataFrame(data, "k int, c string, d int, tag string")
    ties = [F.col("tag"), F.col("c")]
    expected = windows.latest_by(df, ["k", "c"], [F.col("d").desc_nulls_last(), *ties])
    assert rows(windows.latest_wide(df, ["k", "c"], "d", ties)) == rows(expected)
