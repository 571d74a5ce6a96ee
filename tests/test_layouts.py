"""Numbering, interval trees, and tables of which a change or a question touches few files."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from sitebooks.catalog import QUERIES
from sitebooks.operators.joins import interval_nodes, overlap_join
from sitebooks.operators.numbering import numbered
from sitebooks.operators.quality import Steps
from sitebooks.runtime import scratch_dir
from sitebooks.sources import layouts, sinks
from sitebooks.streaming.run_log import ingest_logged, run_log, write_batch
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def names(path):
    """Data files below a path with their inode and time of change."""
    found = glob.glob(f"{path}/**/*.parquet", recursive=True)
    return {f: (os.stat(f).st_ino, os.stat(f).st_mtime_ns) for f in found}


def metrics(df):
    """Run a frame and give the metrics of its file scans."""
    execution = df._jdf.queryExecution()
    df._jdf.collectToPython()
    out = []

    def visit(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return visit(node.plan())
        if kind == "FileSourceScanExec":
            taken = node.metrics()
            out.append({k: taken.apply(k).value() for k in ("numFiles", "numOutputRows") if taken.contains(k)})
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(execution.executedPlan())
    return out


# --- numbering --------------------------------------------------------------------


@pytest.mark.parametrize("seconds", [60, 86_400])
def test_numbers_equal_one_ordered_pass(spark, seconds):
    rng = random.Random(seconds)
    data = []
    for i in range(700):
        key = rng.choice(["hot", "hot", "a", "b", None])
        at = None if rng.random() < 0.05 else T0 + dt.timedelta(seconds=rng.randrange(200_000))
        data.append((key, at, i))
    df = spark.createDataFrame(data, "k string, at timestamp, i int").repartition(5)
    low = lambda v: (v is not None, v) if v is not None else (False,)
    want = sorted(data, key=lambda r: (low(r[0]), low(r[1]), r[2]))
    got = sorted(tuple(r) for r in numbered(df, "no", ["k"], "at", ["i"], seconds).select("no", "i").collect())
    assert got == [(n + 1, r[2]) for n, r in enumerate(want)]
    assert numbered(df.limit(0), "no", ["k"], "at", ["i"]).collect() == []


def test_numbering_exchanges_rows_once(spark):
    df = spark.range(100).select(F.col("id").alias("i"), (F.col("id") % 7).cast("string").alias("k"), F.timestamp_seconds("id").alias("at"))
    plan = numbered(df, "no", ["k"], "at", ["i"])._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(k" in line]
    assert len(wide) == 1 and "SinglePartition" not in plan


# --- interval tree ----------------------------------------------------------------


def test_nodes_make_up_the_interval(spark):
    rng = random.Random(1)
    spans = [(lo, lo + rng.choice([0, 1, 5, 63, 64, 65, 1000, 12_345])) for lo in (rng.randrange(-3000, 3000) for _ in range(60))]
    df = spark.createDataFrame(spans, "lo long, hi long").select("lo", "hi", interval_nodes(F.col("lo"), F.col("hi"), 1).alias("n"))
    for lo, hi, nodes in df.collect():
        cells = [c for n in nodes for c in range(n["node"] * 4 ** n["level"], (n["node"] + 1) * 4 ** n["level"])]
        assert sorted(cells) == list(range(lo, hi + 1))
        assert len(nodes) <= 6 * (hi - lo + 1).bit_length()


def test_a_thousand_years_cost_few_rows(spark):
    long = (1, "x", dt.datetime(1500, 1, 1), dt.datetime(2500, 1, 1))
    df = spark.createDataFrame(
        [long, (2, "x", T0, T0 + dt.timedelta(minutes=1)), (3, "x", None, T0), (4, None, T0, T0 + dt.timedelta(hours=1))],
        "id int, k string, s timestamp, e timestamp",
    )
    nodes = df.where("id = 1").select(F.size(interval_nodes(F.unix_micros("s"), F.unix_micros("e"), 60_000_000))).first()[0]
    assert nodes < 100
    pairs = overlap_join(df, df, ["k"], "s", "e")
    assert rows(pairs, "id", "other_id") == [(1, None), (2, 1), (3, None), (4, None)]
    assert rows(overlap_join(df, df, ["k"], "s", "e", how="inner"), "id", "other_id") == [(2, 1)]


# --- layouts ----------------------------------------------------------------------


def yearly(spark, days):
    path = scratch_dir(spark, "test-years")
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, day date").withColumn("y", F.year("day"))
    sinks.write_files(df, path, partition_by=["y"])
    return path


def test_purge_leaves_later_years_alone_and_can_be_repeated(spark):
    days = [dt.date(y, m, 1) for y in (1999, 2000, 2001, 2002) for m in (1, 6, 12)] + [None]
    path = yearly(spark, days)
    before = names(path)
    audit = layouts.purge_partitions(spark, path, "y", "day", dt.date(2001, 6, 1), "t", 2005)
    assert [tuple(r) for r in audit.collect()] == [("t", 7, dt.date(2001, 6, 1), 2005)]
    after = names(path)
    assert {f for f in after if "y=2002" in f or "__HIVE" in f} == {f for f in before if "y=2002" in f or "__HIVE" in f}
    assert all(after[f] == before[f] for f in after if "y=2001" not in f)
    assert not any("y=1999" in f or "y=2000" in f for f in after)
    left = {r[0] for r in spark.read.parquet(path).select("day").collect()}
    assert left == {d for d in days if d is None or d >= dt.date(2001, 6, 1)}
    again = layouts.purge_partitions(spark, path, "y", "day", dt.date(2001, 6, 1), "t", 2005)
    assert again.first()["rows_removed"] == 0 and names(path) == after


def test_purge_of_a_whole_boundary_year(spark):
    path = yearly(spark, [dt.date(2000, 1, 1), dt.date(2000, 2, 1), dt.date(2001, 1, 1)])
    assert layouts.purge_partitions(spark, path, "y", "day", dt.date(2000, 3, 1), "t", 2004).first()["rows_removed"] == 2
    assert not any("y=2000" in f for f in names(path))


def test_upsert_keeps_files_of_other_buckets(spark):
    path = scratch_dir(spark, "test-buckets")
    df = spark.range(500).select("id", F.lit("old").alias("v"))
    layouts.write_buckets(df, path, ["id"], 8)
    before = names(path)
    source = spark.createDataFrame([(3, "new"), (1000, "new")], "id long, v string")
    touched = layouts.upsert_buckets(source, path, ["id"], 8)
    assert 1 <= len(touched) <= 2
    after = names(path)
    other = {f for f in before if not any(f"_bucket={b}/" in f for b in touched)}
    assert other and all(after[f] == before[f] for f in other)
    got = {tuple(r) for r in layouts.read_buckets(spark, path).collect()}
    assert got == {(i, "new" if i == 3 else "old") for i in range(500)} | {(1000, "new")}
    assert layouts.upsert_buckets(source.limit(0), path, ["id"], 8) == [] and names(path) == after


def test_upsert_refuses_repeated_keys_before_it_writes(spark):
    path = scratch_dir(spark, "test-buckets")
    layouts.write_buckets(spark.range(20).select("id", F.lit("old").alias("v")), path, ["id"], 4)
    before = names(path)
    twice = spark.createDataFrame([(3, "b"), (3, "a")], "id long, v string")
    with pytest.raises(Exception, match="several source rows"):
        layouts.upsert_buckets(twice, path, ["id"], 4)
    assert names(path) == before
    layouts.upsert_buckets(twice, path, ["id"], 4, order=[F.col("v")])
    assert layouts.read_buckets(spark, path).where("id = 3").first()["v"] == "a"


def test_days_prune_partitions_at_run_time(spark):
    path = scratch_dir(spark, "test-days")
    df = spark.range(300).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 30).cast("int")).alias("day"))
    sinks.write_files(df, path, partition_by=["day"])
    asked = df.where("id IN (4, 8, 38)").select("day")
    found = layouts.of_days(spark.read.parquet(path), "day", asked, dt.date(2024, 1, 6))
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found, "id") == [(i,) for i in range(300) if i % 30 == 8]
    scan = max(metrics(found), key=lambda m: m["numOutputRows"])
    assert scan["numFiles"] == len([f for f in names(path) if "day=2024-01-09" in f])


def test_clustered_files_skip_row_groups(spark):
    path = scratch_dir(spark, "test-clustered")
    df = spark.range(40_000).select(
        (F.col("id") * 7919 % 40_000).alias("id"), F.concat(F.lit("S"), (F.col("id") % 50).cast("string")).alias("site"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    layouts.write_clustered(df, path, ["site", "id"], files=4, group_bytes=1 << 17)
    found = spark.read.parquet(path).where("site = 'S7'")
    assert found.count() == 800
    assert sum(m["numOutputRows"] for m in metrics(found)) < 10_000
    for file in names(path):
        import pyarrow.parquet as pq

        table = pq.read_table(file, columns=["site", "id"])
        order = list(zip(table["site"].to_pylist(), table["id"].to_pylist()))
        assert order == sorted(order)


def test_watermark_comes_from_footers(spark):
    path = scratch_dir(spark, "test-mark")
    df = spark.range(50).select("id", F.when(F.col("id") > 9, F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int"))).alias("day"))
    sinks.write_files(df, path)
    sinks.write_files(df.limit(0), path, mode="append")
    found = layouts.footer_extremes(spark, path, ["day", "id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(day), MAX(day), MIN(id), MAX(id)]" in plan
    assert tuple(found.first()) == (dt.date(2024, 1, 11), dt.date(2024, 2, 19), 0, 49)
    assert layouts.footer_watermark(spark, path, "day", dt.date(1000, 1, 1)) == dt.date(2024, 2, 19)
    empty = scratch_dir(spark, "test-mark")
    sinks.write_files(df.limit(0), empty)
    assert layouts.footer_watermark(spark, empty, "day", dt.date(1000, 1, 1)) == dt.date(1000, 1, 1)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


# --- run log and counted steps ----------------------------------------------------


def test_a_repeated_batch_changes_nothing(spark):
    source, data, log, state = (scratch_dir(spark, f"test-{x}") for x in ("in", "data", "log", "state"))
    df = spark.createDataFrame([(1, "DE", T0.date()), (2, "DE", T0.date() + dt.timedelta(1)), (3, "FR", None)], "id int, c string, d date")
    run = lambda: ingest_logged(spark, source, df.schema, data, log, state, "job", "c", "d")
    sinks.write_files(df.where("id < 3"), source)
    run()
    run()  # nothing new
    sinks.write_files(df.where("id = 3"), source, mode="append")
    run()
    want = [("job", "DE", T0.date() + dt.timedelta(1), 2, 0), ("job", "FR", None, 1, 1)]
    assert rows(run_log(spark, log, "c")) == want
    for _ in range(2):
        write_batch(df.where("id = 3"), 1, data, log, "job", "c", "d")
        assert rows(run_log(spark, log, "c")) == want
        assert rows(spark.read.parquet(data), "id") == [(1,), (2,), (3,)]


def test_steps_count_what_passes(spark):
    steps = Steps()
    df = steps.watch(spark.createDataFrame([(1, None), (2, "x")], "id int, k string"), "read", "k")
    df = steps.watch(df.where("k IS NOT NULL"), "known", unreadable=F.col("k") == "y")
    df.write.format("noop").mode("overwrite").save()
    assert [tuple(r) for r in steps.frame(spark).collect()] == [(1, "read", 2, "k", 1, None), (2, "known", 1, None, None, 0)]


def test_schema_growth_is_read_with_merged_footers(spark, sf_dir):
    assert QUERIES["schema_growth"](spark, sf_dir).columns == ["o_orderkey", "priority"]
