"""Sources, sinks and streaming."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitebooks.operators import quality
from sitebooks.plans import feeds, site_info
from sitebooks.runtime import materialise, scratch_dir, scratch_space
from sitebooks.schemas import schema
from sitebooks.sources import files, sinks, tables
from sitebooks.streaming.catch_up import ingest_new_files
from tests.conftest import rows


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_scratch_space_deletes_its_own_directories(spark, tmp_path):
    before = materialise(spark.range(3), "kept")
    with pytest.raises(ZeroDivisionError), scratch_space(spark):
        made = materialise(before, "gone")
        with scratch_space(spark):
            inner = scratch_dir(spark, "inner")
            sinks.write_files(made, inner)
            assert files.path_exists(spark, inner)
        assert not files.path_exists(spark, inner)
        made.write.parquet(str(tmp_path / "result"))
        gone = made.inputFiles()[0].rsplit("/", 1)[0]
        assert files.path_exists(spark, gone)
        1 / 0
    assert not files.path_exists(spark, gone)
    assert before.count() == spark.read.parquet(str(tmp_path / "result")).count() == 3


def test_materialise_cuts_the_lineage(spark):
    df = materialise(spark.range(5).withColumn("v", F.col("id") * 2), "t")
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().toString()


def test_period_feed_in_plain_directories(spark, tmp_path):
    for country, month, data in (("NL", "03", [(1, "a")]), ("DE", "03", [(2, "b")]), ("DE", "04", [(3, "c")])):
        spark.createDataFrame(data, "Code int, Text string").write.parquet(f"{tmp_path}/{country}/2024/{month}")
    extra = spark.createDataFrame([(9, "z")], "Code int, Other string")
    extra.write.parquet(f"{tmp_path}/restricted/OM/2024/03")
    roots = [str(tmp_path), f"{tmp_path}/restricted"]
    march = files.read_period(spark, roots, ["NL", "DE", "OM", "FR"], 2024, 3, merge_schema=True)
    assert rows(march, "Code", "Text", "feed_country", "feed_month") == [(1, "a", "NL", 3), (2, "b", "DE", 3), (9, None, "OM", 3)]
    target = StructType.fromDDL("code string, text string")
    assert rows(feeds.period_feed(spark, roots, ["NL", "FR"], 2024, 3, target)) == [("1", "a")]
    with pytest.raises(FileNotFoundError):
        files.read_period(spark, roots, ["NL"], 1999, 1)
    assert files.read_period(spark, roots, ["NL"], 1999, 1, schema=target).count() == 0
    whole = feeds.history_feed(spark, [str(tmp_path), f"{tmp_path}/absent"], target, pattern="[ND]*/*/*/*.parquet")
    assert rows(whole) == [("1", "a"), ("2", "b"), ("3", "c")]
    fixed = files.read_feed(spark, str(tmp_path), "NL/*/*/*.parquet")
    assert rows(fixed) == [(1, "a")]
    several = files.read_parquet(spark, f"{tmp_path}/NL/2024/03", f"{tmp_path}/DE/2024/04")
    assert rows(several, "Code") == [(1,), (3,)]


def test_cash_capex_names(spark):
    raw = spark.createDataFrame([("NL", 7, "x")], "Country string, `Country Code` int, `Amount @PlanRate` string")
    out = feeds.combine([raw], schema("cash_capex"), feeds.CASH_CAPEX_NAMES, schema("cash_capex").fieldNames())
    with pytest.raises(ValueError):
        feeds.combine([raw], schema("cash_capex"), feeds.CASH_CAPEX_NAMES)
    assert rows(out, "Country_Name", "Country_Code", "PlanRate") == [("NL", "7", "x")]


def test_delimited(spark, tmp_path):
    df = spark.createDataFrame([(1, [2, 1])], "a int, b array<int>")
    sinks.write_delimited(df, f"{tmp_path}/c", "|")
    assert rows(files.read_delimited(spark, f"{tmp_path}/c")) == [("1", "[2, 1]")]


def test_column_presence_and_empty(spark):
    df = files.empty_frame(spark, schema("run_log"))
    assert df.count() == 0 and files.has_any_column(df, "country", "zzz") and not files.has_any_column(df, "zzz")
    assert not files.has_any_column(df, *site_info.TRANSACTION_COLUMNS)


def test_catalog_tables(spark, tmp_path):
    sinks.create_table(spark, "audit", schema("retention_audit"), location=f"{tmp_path}/audit", replace=True)
    # other column order and types than the table: matched by name
    more = spark.createDataFrame([(2024, "t", 3, 2020)], "run_year bigint, table_name string, rows_removed int, removed_before int")
    sinks.append_table(more, "audit")
    sinks.append_table(more, "audit")
    assert rows(tables.read_table(spark, "audit")) == [("t", 3, 2020, 2024)] * 2
    sinks.refresh_table(more, "audit")
    assert tables.read_table(spark, "audit").count() == 1
    sinks.register_table(spark, "audit_again", f"{tmp_path}/audit")
    sinks.register_table(spark, "audit_again", f"{tmp_path}/audit")
    assert spark.table("audit_again").count() == 1
    assert tables.read_location(spark, f"{tmp_path}/audit").count() == 1


def test_watermarks_of_published_tables(spark, tmp_path):
    assert tables.published_watermark(spark, "nowhere", "d") == tables.MISSING_WATERMARK == dt.date(1001, 1, 1)
    sinks.create_table(spark, "marked", StructType.fromDDL("k int, d date"), location=f"{tmp_path}/m")
    assert tables.published_watermark(spark, "marked", "d") == tables.EMPTY_WATERMARK == dt.date(1000, 1, 1)
    day = lambda n: dt.date(2024, 1, n)
    feed = spark.createDataFrame([(1, day(1)), (2, day(2)), (3, None)], "k int, d date")
    assert sinks.replace_with_newer(feed, "marked", "d") == dt.date(1000, 1, 1)
    assert rows(spark.table("marked"), "k") == [(1,), (2,)]
    more = feed.union(spark.createDataFrame([(4, day(3))], "k int, d date"))
    assert sinks.replace_with_newer(more, "marked", "d") == day(2)
    assert rows(spark.table("marked"), "k") == [(4,)]
    with pytest.raises(Exception, match="nope"):
        tables.published_watermark(spark, "marked", "nope")


def test_partition_overwrite_and_schema_growth(spark, tmp_path):
    path = f"{tmp_path}/p"
    sinks.write_files(spark.createDataFrame([("NL", 1), ("DE", 2)], "c string, v int"), path, partition_by=["c"])
    sinks.replace_partitions(spark.createDataFrame([("NL", 9)], "c string, v int"), path, ["c"])
    assert rows(spark.read.parquet(path), "c", "v") == [("DE", 2), ("NL", 9)]
    grown = spark.createDataFrame([("FR", 3, "new")], "c string, v int, w string")
    sinks.write_files(grown, path, mode="append", partition_by=["c"], merge_schema=True)
    assert "w" in spark.read.option("mergeSchema", "true").parquet(path).columns
    sinks.write_files(grown.select("c"), f"{tmp_path}/q", replace_schema=True)


def test_warehouse_options(spark):
    assert tables.warehouse_options("jdbc:x", table="t") == {"url": "jdbc:x", "dbtable": "t"}
    assert tables.warehouse_options("jdbc:x", query="select 1")["query"] == "select 1"
    split = tables.warehouse_options("jdbc:x", query="select 1 k", partition_column="k", bounds=(0, 9), partitions=4)
    assert split["dbtable"] == "(select 1 k) part_source" and split["numPartitions"] == "4" and "query" not in split
    for wrong in ({}, {"table": "t", "query": "q"}, {"table": "t", "partition_column": "k"}):
        with pytest.raises(ValueError):
            tables.warehouse_options("jdbc:x", **wrong)
    df = spark.createDataFrame([("x" * 3000, 1)], "a string, b int")
    options = sinks.warehouse_write_options(df, "jdbc:x", "t", True, 2000)
    assert options["truncate"] == "true" and options["createTableColumnTypes"] == "`a` VARCHAR(2000)"
    assert "truncate" not in sinks.warehouse_write_options(df, "jdbc:x", "t", False, None)
    assert rows(sinks.guard_text(df).select(F.length("a"))) == [(2000,)]
    steps = quality.Steps()
    short = spark.createDataFrame([("abc", None, 1), (None, "abcd", 2), ("ab", "a", 3)], "a string, b string, n int")
    cut = sinks.guard_text(short, 3, watch=steps.watch)
    assert rows(cut) == [(None, "abc", 2), ("ab", "a", 3), ("abc", None, 1)]
    assert rows(steps.frame(spark).select("rows", "unreadable")) == [(3, 1)]


def test_publishable_and_gates(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    out = sinks.publishable(df, {"A": "a"}, at=F.lit(dt.datetime(2024, 1, 1)))
    assert rows(out) == [(1, dt.datetime(2024, 1, 1))]
    assert sinks.publishable(df, stamp_column=None).columns == ["a", "b"]
    assert sinks.require_rows(df, "x") is df and sinks.rows_or_stop(df)
    with pytest.raises(sinks.NoRows):
        sinks.require_rows(df.limit(0), "x")
    assert not sinks.rows_or_stop(df.limit(0))


def test_streaming_equals_batch_and_takes_nothing_twice(spark, tmp_path):
    layout = "PartitionKey string, RowKey string, RequestDateTime string, SiteId string, Transactions string"
    message = lambda key, n: ("NL", key, "t", "s", "[" + ",".join(f'{{"pumpNumber":{i}}}' for i in range(n)) + "]")
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    give = lambda day, *m: spark.createDataFrame(list(m), layout).coalesce(1).write.mode("append").parquet(f"{source}/NL/2024/01/{day}")
    run = lambda: ingest_new_files(spark, source, StructType.fromDDL(layout), out, state, site_info.transactions)
    give("01", message("a", 2))
    give("01", message("b", 1))  # two files of one day
    run()
    assert spark.read.parquet(out).count() == 3
    run()
    assert spark.read.parquet(out).count() == 3
    give("02", message("c", 1))
    give("01", message("late", 1))
    run()
    batch = site_info.transactions(spark.read.schema(layout).option("recursiveFileLookup", "true").parquet(source))
    assert rows(spark.read.parquet(out), "RowKey", "pumpNumber") == rows(batch, "RowKey", "pumpNumber")


def test_streaming_file_date(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.range(2).write.parquet(f"{source}/NL/2024/02/03")
    ingest_new_files(spark, source, StructType.fromDDL("id bigint"), out, f"{tmp_path}/s", dated=True, partition_by=["file_date"])
    assert rows(spark.read.parquet(out), "id", "file_date") == [(0, dt.date(2024, 2, 3)), (1, dt.date(2024, 2, 3))]
