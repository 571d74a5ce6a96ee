"""Tables whose layout lets changes, filters and watermarks touch few files, and logged ingestion."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitebooks.catalog.registry import TX_SQL, query, table, tx
from sitebooks.operators.project import conform
from sitebooks.operators.quality import Steps
from sitebooks.runtime import scratch_dir
from sitebooks.sources import files, layouts, sinks
from sitebooks.streaming.run_log import ingest_logged, run_log, write_batch

_CUT = dt.date(1996, 7, 1)


def _yearly_orders(spark, sf_dir):
    """Orders in a table partitioned by their year; its location."""
    path = scratch_dir(spark, "yearly")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_day"), F.year("o_orderdate").alias("o_year")
    )
    sinks.write_files(od, path, partition_by=["o_year"])
    return path


@query(
    "purge_by_partition",
    f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_day, CAST(year(o_orderdate) AS INTEGER) AS o_year
        FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '{_CUT}'""",
)
def purge_by_partition(spark, sf_dir):
    """Old years go as directories, the year of the cut-off is rewritten, the rest is not touched."""
    path = _yearly_orders(spark, sf_dir)
    layouts.purge_partitions(spark, path, "o_year", "o_day", _CUT, "orders", 2000)
    return spark.read.parquet(path).select("o_orderkey", "o_day", "o_year")


@query(
    "purge_partition_audit",
    f"""SELECT 'orders' AS table_name, count(*) AS rows_removed, DATE '{_CUT}' AS removed_before, 2000 AS run_year
        FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '{_CUT}'""",
)
def purge_partition_audit(spark, sf_dir):
    return layouts.purge_partitions(spark, _yearly_orders(spark, sf_dir), "o_year", "o_day", _CUT, "orders", 2000)


#: Customers that change: neighbours in key order, so that they fall into some buckets only.
_CHANGED, _BUCKETS = 6, 16


@query(
    "upsert_touched_buckets",
    f"""SELECT c_custkey, CASE WHEN c_custkey <= {_CHANGED} THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer
        UNION ALL SELECT -c_custkey, c_acctbal FROM customer WHERE c_custkey BETWEEN 1 AND 2""",
)
def upsert_touched_buckets(spark, sf_dir):
    """A bucketed table takes a few changed and new keys; only their buckets are rewritten."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    path = scratch_dir(spark, "buckets")
    layouts.write_buckets(cust, path, ["c_custkey"], _BUCKETS)
    changed = cust.where(F.col("c_custkey") <= _CHANGED).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    new = cust.where(F.col("c_custkey").between(1, 2)).withColumn("c_custkey", -F.col("c_custkey"))
    layouts.upsert_buckets(changed.unionByName(new), path, ["c_custkey"], _BUCKETS)
    return layouts.read_buckets(spark, path).select("c_custkey", "c_acctbal")


@query(
    "sales_of_observed_days",
    """SELECT event_id, value, CAST(ts AS DATE) AS day FROM events
       WHERE CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM events WHERE user_id = 7)
         AND CAST(ts AS DATE) >= DATE '2023-01-01'""",
)
def sales_of_observed_days(spark, sf_dir):
    """Sales partitioned by day, of the days on which one user was seen."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    path = scratch_dir(spark, "daily")
    sinks.write_files(ev, path, partition_by=["day"])
    observed = ev.where("user_id = 7").select("day")
    found = layouts.of_days(spark.read.parquet(path), "day", observed, dt.date(2023, 1, 1))
    return found.select("event_id", "value", "day")


@query(
    "clustered_output",
    f"""WITH {TX_SQL} SELECT event_id, site, start_ts FROM tx WHERE site = 'G3'""",
)
def clustered_output(spark, sf_dir):
    """Transactions written by site and time, and one site read back."""
    rows = tx(spark, sf_dir).select(
        "event_id", F.col("SiteId").alias("site"), F.col("transactionStartTime").cast("timestamp_ntz").alias("start_ts")
    )
    path = scratch_dir(spark, "clustered")
    layouts.write_clustered(rows, path, ["site", "start_ts"], files=8, group_bytes=1 << 18)
    return spark.read.parquet(path).where("site = 'G3'")


@query(
    "footer_watermark",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_day FROM orders WHERE CAST(o_orderdate AS DATE) > (
         SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderdate < DATE '1996-01-01')""",
)
def footer_watermark(spark, sf_dir):
    """Orders newer than what a table has, by the footers of its files."""
    od = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_day"))
    path = scratch_dir(spark, "loaded")
    sinks.write_files(od.where("o_day < DATE '1996-01-01'"), path)
    mark = layouts.footer_watermark(spark, path, "o_day", dt.date(1000, 1, 1))
    return od.where(F.col("o_day") > F.lit(mark))


def _logged(spark, sf_dir):
    """Two deliveries taken by two runs, and the last batch written a second time; data, log."""
    ev = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("country"), F.to_date("ts").alias("day"))
    source, data, log, state = (scratch_dir(spark, f"logged-{x}") for x in ("in", "data", "log", "state"))
    run = lambda: ingest_logged(spark, source, ev.schema, data, log, state, "events", "country", "day")
    sinks.write_files(ev.where("country <> 'click' AND day < DATE '2024-01-20'"), source)
    run()
    late = ev.where("country <> 'click' AND day >= DATE '2024-01-20' OR country = 'click'")
    sinks.write_files(late, source, mode="append")
    run()
    last = spark.read.parquet(log).agg(F.max("batch")).first()[0]
    write_batch(spark.read.schema(ev.schema).parquet(f"{source}/*.parquet").join(
        spark.read.schema(ev.schema).parquet(f"{data}/batch={last}"), ["event_id", "country", "day"], "left_semi"
    ), last, data, log, "events", "country", "day")
    return data, log


@query(
    "stream_run_log",
    """SELECT 'events' AS job, event_type AS country, max(CAST(ts AS DATE)) AS last_day, CAST(count(*) AS BIGINT) AS rows,
              1::BIGINT AS last_batch FROM events GROUP BY event_type""",
)
def stream_run_log(spark, sf_dir):
    """The log after two runs and a repeated batch."""
    return run_log(spark, _logged(spark, sf_dir)[1], "country")


@query(
    "stream_logged_rows",
    "SELECT event_id, event_type AS country, CAST(ts AS DATE) AS day FROM events",
)
def stream_logged_rows(spark, sf_dir):
    """The rows after two runs and a repeated batch: each once."""
    return spark.read.parquet(_logged(spark, sf_dir)[0]).select("event_id", "country", "day")


@query(
    "dated_paths",
    """SELECT event_id, CAST(ts AS DATE) AS file_date FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'""",
)
def dated_paths(spark, sf_dir):
    """Selected day files of a ``yyyy/mm/dd`` feed in one scan, with the day from the path."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    root, days = scratch_dir(spark, "dated"), ["2024/01/05", "2024/01/06", "2024/01/07"]
    for day in [*days, "2024/01/08"]:
        sinks.write_files(ev.where(F.date_format("ts", "yyyy/MM/dd") == day).select("event_id"), f"{root}/{day}")
    return files.with_file_date(files.read_parquet(spark, *[f"{root}/{day}" for day in days])).select("event_id", "file_date")


@query(
    "schema_growth",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority FROM orders""",
)
def schema_growth(spark, sf_dir):
    """A table gains a column with a later write; it is registered once and read with merged footers."""
    od = table(spark, sf_dir, "orders")
    path, name = scratch_dir(spark, "growing"), f"growing_{uuid.uuid4().hex}"
    sinks.write_files(od.where("o_orderkey % 2 = 0").select("o_orderkey"), path)
    wider = od.where("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    sinks.write_files(wider, path, mode="append", merge_schema=True)
    for _ in range(2):  # registering again changes nothing
        sinks.register_table(spark, name, path, options={"mergeSchema": "true"})
    columns = spark.table(name).columns  # both, whichever file was asked first
    found = spark.read.option("mergeSchema", "true").parquet(path).select(*columns)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return found


@query(
    "empty_results",
    """SELECT 'clean exit' AS outcome, count(*) AS rows FROM orders WHERE o_orderkey < 0
       UNION ALL SELECT 'raised', count(*) FROM orders WHERE o_orderkey < 0
       UNION ALL SELECT 'went on', count(*) FROM orders""",
)
def empty_results(spark, sf_dir):
    """What a job does without rows: end early, or fail; outcomes as inline rows behind an empty frame."""
    od = table(spark, sf_dir, "orders")
    told = []
    outcomes = files.empty_frame(spark, StructType.fromDDL("outcome string, rows long"))
    for frame, gate in ((od.where("o_orderkey < 0"), "stop"), (od.where("o_orderkey < 0"), "raise"), (od, "stop")):
        if gate == "stop":
            outcome = "went on" if sinks.rows_or_stop(frame) else "clean exit"
        else:
            try:
                sinks.require_rows(frame, "orders")
                outcome = "went on"
            except sinks.NoRows:
                outcome = "raised"
        told.append((outcome, frame.count()))
    return outcomes.unionByName(spark.createDataFrame(told, outcomes.schema))


@query(
    "lenient_load_steps",
    """SELECT 1 AS step_no, 'lenient cast' AS step, count(*) AS rows, CAST(NULL AS VARCHAR) AS key, CAST(NULL AS BIGINT) AS without_key,
              count(*) FILTER (WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0) AS unreadable FROM orders
       UNION ALL
       SELECT 2, 'text cut', count(*), NULL, NULL, count(*) FILTER (WHERE length(o_orderpriority) > 8) FROM orders""",
)
def lenient_load_steps(spark, sf_dir):
    """What a lenient load loses: rows with values that turn to null, then rows with texts that are cut, from the run that writes it."""
    od = table(spark, sf_dir, "orders")
    odd = lambda n, c: F.when(F.col("o_orderkey") % n == 0, "no value").otherwise(F.col(c).cast("string"))
    raw = od.select(odd(3, "o_custkey").alias("Customer"), odd(5, "o_totalprice").alias("Amount"), F.col("o_orderpriority").alias("Priority"))
    steps = Steps()
    wanted = StructType.fromDDL("customer long, amount decimal(18,2), priority string")
    out = sinks.guard_text(conform(raw, wanted, lenient=True, watch=steps.watch), 8, watch=steps.watch)
    sinks.write_files(out, scratch_dir(spark, "lenient"))
    return steps.frame(spark)
