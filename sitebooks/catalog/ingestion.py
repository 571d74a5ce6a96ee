"""Feeds written to files and read back, batch and streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitebooks.catalog.registry import query, table
from sitebooks.operators.reshape import explode_structs
from sitebooks.plans import feeds, site_info
from sitebooks.runtime import scratch_dir
from sitebooks.sources import files, sinks, tables
from sitebooks.streaming.catch_up import ingest_new_files


@query(
    "csv_roundtrip",
    """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name,
              '[' || array_to_string(list_sort(list(c_mktsegment)), ', ') || ']' AS segments
       FROM (SELECT DISTINCT n_nationkey, n_name, c_mktsegment FROM nation
             JOIN customer ON n_nationkey = c_nationkey) GROUP BY 1, 2""",
)
def csv_roundtrip(spark, sf_dir):
    """Array columns become text; everything reads back as text."""
    na, cu = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    sets = na.join(cu, na.n_nationkey == cu.c_nationkey).groupBy("n_nationkey", "n_name").agg(
        F.array_sort(F.collect_set("c_mktsegment")).alias("segments")
    )
    path = scratch_dir(spark, "csv")
    sinks.write_delimited(sets, path, sep="|")
    return files.read_delimited(spark, path, sep="|")


@query(
    "partitioned_write",
    """SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN value + 1 ELSE value END
                AS value FROM events""",
)
def partitioned_write(spark, sf_dir):
    """One partition is replaced, the others stay."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    path = scratch_dir(spark, "partitioned")
    sinks.write_files(ev, path, partition_by=["event_type"])
    clicks = ev.where("event_type = 'click'").withColumn("value", F.col("value") + 1)
    sinks.replace_partitions(clicks, path, ["event_type"])
    return spark.read.parquet(path).select("event_id", "event_type", "value")


_LAYOUT = "country={country}/year={year:04d}/month={month:02d}"


def _write_feed(spark, sf_dir, root, test):
    """Orders as a country/year/month feed, one country per order status."""
    laid_out = table(spark, sf_dir, "orders").where(test).select(
        "o_orderkey", "o_totalprice",
        F.col("o_orderstatus").alias("country"),
        F.date_format("o_orderdate", "yyyy").alias("year"),
        F.date_format("o_orderdate", "MM").alias("month"),
    )
    place = ["country", "year", "month"]
    sinks.write_files(laid_out, root, partition_by=place)


@query(
    "feed_period",
    """SELECT o_orderkey, o_totalprice, o_orderstatus AS feed_country, 1998 AS feed_year,
              4 AS feed_month FROM orders
       WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 4""",
)
def feed_period(spark, sf_dir):
    """One month of a two-root feed; a country without files is skipped."""
    main, restricted = scratch_dir(spark, "feed"), scratch_dir(spark, "feed-restricted")
    _write_feed(spark, sf_dir, main, "o_orderstatus <> 'P'")
    _write_feed(spark, sf_dir, restricted, "o_orderstatus = 'P'")
    return files.read_period(
        spark, [main, restricted], ["F", "O", "P", "NONE"], 1998, 4, merge_schema=True,
        layout=_LAYOUT,
    )


@query(
    "feed_history",
    """SELECT o_orderkey, o_totalprice, o_orderstatus AS feed_country,
              CAST(year(o_orderdate) AS INTEGER) AS feed_year,
              CAST(month(o_orderdate) AS INTEGER) AS feed_month FROM orders""",
)
def feed_history(spark, sf_dir):
    """All files of a feed by one glob per root, a missing root skipped."""
    root = scratch_dir(spark, "feed")
    _write_feed(spark, sf_dir, root, "true")
    feed = files.read_feed(
        spark, [root, root + "-absent"], merge_schema=True, skip_missing=True
    )
    return files.with_period(feed).select(
        "o_orderkey", "o_totalprice", "feed_country", "feed_year", "feed_month"
    )


_STORED = StructType().add("o_orderkey", "long").add("o_totalprice", "double")
_CONTRACT = StructType().add("Order_Id", "string").add("Amount", "decimal(18,2)")
_RENAMED = {"o_orderkey": "Order_Id", "o_totalprice": "Amount"}


@query(
    "contract_period_feed",
    """SELECT CAST(o_orderkey AS VARCHAR) AS Order_Id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS Amount
       FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 4""",
)
def contract_period_feed(spark, sf_dir):
    """One month of two roots, renamed and cast to its contract; an empty month would be an error."""
    main, restricted = scratch_dir(spark, "feed"), scratch_dir(spark, "feed-restricted")
    _write_feed(spark, sf_dir, main, "o_orderstatus <> 'P'")
    _write_feed(spark, sf_dir, restricted, "o_orderstatus = 'P'")
    out = feeds.period_feed(
        spark, [main, restricted], ["F", "O", "P", "NONE"], 1998, 4, _CONTRACT, _RENAMED, stored=_STORED, layout=_LAYOUT
    )
    return sinks.require_rows(out, "orders of April 1998").withColumn("Amount", F.col("Amount").cast("double"))


@query(
    "contract_history_feed",
    """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS Order_Id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS Amount
       FROM orders""",
)
def contract_history_feed(spark, sf_dir):
    """The history of two roots that share the orders of one status; each order comes out once."""
    main, restricted = scratch_dir(spark, "feed"), scratch_dir(spark, "feed-restricted")
    _write_feed(spark, sf_dir, main, "true")
    _write_feed(spark, sf_dir, restricted, "o_orderstatus = 'P'")
    out = feeds.history_feed(spark, [main, restricted, main + "-absent"], _CONTRACT, _RENAMED, stored=_STORED)
    return out.withColumn("Amount", F.col("Amount").cast("double"))


def _item(pump: str, product: str) -> str:
    return (
        f"named_struct('pumpNumber', CAST({pump} AS INT), 'productCode', {product}, "
        "'additionalProductInfo', text)"
    )


@query(
    "json_array_explode",
    """SELECT CAST(conv_id AS VARCHAR) AS RowKey, CAST(turn AS INTEGER) AS pumpNumber,
              role AS productCode, text AS additionalProductInfo FROM conversations
       UNION ALL
       SELECT CAST(conv_id AS VARCHAR), CAST(-1 - turn AS INTEGER), 'echo', text
       FROM conversations WHERE turn > 0""",
)
def json_array_explode(spark, sf_dir):
    """Each turn as a JSON message of one or two items, unpacked by the transaction parser."""
    own, echo = _item("turn", "role"), _item("-1 - turn", "'echo'")
    items = f"IF(turn > 0, array({own}, {echo}), array({own}))"
    messages = table(spark, sf_dir, "conversations").select(
        F.lit("NL").alias("PartitionKey"), F.col("conv_id").cast("string").alias("RowKey"),
        F.lit("2024-01-01").alias("RequestDateTime"), F.lit("1").alias("SiteId"),
        F.to_json(F.expr(items)).alias("Transactions"),
    )
    return site_info.transactions(messages).select(
        "RowKey", "pumpNumber", "productCode", "additionalProductInfo"
    )


@query(
    "site_nozzles",
    """SELECT s_name AS SiteId, 'Site ' || s_name AS siteName, 'City' AS City,
              CAST(n AS INTEGER) AS nozzleNumber, CAST(n + 1 AS INTEGER) AS pumpNumber,
              CAST(s_nationkey AS INTEGER) AS tankReferenceId
       FROM supplier CROSS JOIN (SELECT unnest(range(1, 5)) AS n)""",
)
def site_nozzles(spark, sf_dir):
    nozzle = "named_struct('pumpNumber', n + 1, 'nozzleNumber', n, 'tankReferenceId', s_nationkey)"
    sites = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("SiteId"),
        F.to_json(
            F.struct(
                F.concat(F.lit("Site "), "s_name").alias("siteName"), F.lit("City").alias("city")
            )
        ).alias("CurrentSiteData"),
        F.to_json(F.expr(f"transform(sequence(1, 4), n -> {nozzle})")).alias("CurrentPumpNozzle"),
        F.lit("x").alias("Latitude"),
    )
    return site_info.site_nozzles(sites).select(
        "SiteId", "siteName", "City", "nozzleNumber", "pumpNumber", "tankReferenceId"
    )


@query(
    "struct_rows",
    """SELECT event_id, 'value' AS name, value AS amount FROM events
       UNION ALL
       SELECT event_id, 'k', CAST(json_extract(props, '$.k') AS DOUBLE) FROM events
       WHERE event_type <> 'error'""",
)
def struct_rows(spark, sf_dir):
    """Arrays of structs to rows; the second element is missing for some rows."""
    k = F.from_json("props", "k double")["k"]
    ev = table(spark, sf_dir, "events").select(
        "event_id",
        F.array_compact(
            F.array(
                F.struct(F.lit("value").alias("name"), F.col("value").alias("amount")),
                F.when(
                    F.col("event_type") != "error",
                    F.struct(F.lit("k").alias("name"), k.alias("amount")),
                ),
            )
        ).alias("items"),
    )
    return explode_structs(ev, "items", ["event_id"], ["name", "amount"])


@query(
    "stream_catch_up",
    """SELECT event_id, event_type, value FROM events""",
)
def stream_catch_up(spark, sf_dir):
    """Files of two deliveries ingested by two runs; each run takes only what is new."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    source, out = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    state = scratch_dir(spark, "stream-state")
    sinks.write_files(ev.where("event_type <> 'click'"), source)
    ingest_new_files(spark, source, ev.schema, out, state)
    sinks.write_files(ev.where("event_type = 'click'"), source, mode="append")
    ingest_new_files(spark, source, ev.schema, out, state)
    return spark.read.schema(ev.schema).parquet(out)


def _order_table(spark) -> tuple[str, str]:
    """An empty curated table below the shared folder: its name and location."""
    name, path = f"orders_{uuid.uuid4().hex}", scratch_dir(spark, "orders")
    columns = "o_orderpriority string, o_orderkey long, o_orderdate timestamp"
    sinks.create_table(spark, name, StructType.fromDDL(columns), location=path)
    return name, path


@query(
    "append_by_name",
    """SELECT o_orderpriority, o_orderkey FROM orders WHERE o_orderstatus <> 'P'""",
)
def append_by_name(spark, sf_dir):
    """A table is refreshed twice, then appended to, from columns in another order."""
    od = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    od = od.select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    name, path = _order_table(spark)
    sinks.refresh_table(od.where("o_orderstatus = 'P'"), name)
    sinks.refresh_table(od.where("o_orderstatus = 'F'"), name)
    sinks.append_table(od.where("o_orderstatus NOT IN ('F', 'P')"), name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return tables.read_location(spark, path).select("o_orderpriority", "o_orderkey")


@query(
    "replace_with_newer",
    """SELECT o_orderpriority, o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) > (
         SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderdate < DATE '1996-01-01')""",
)
def replace_with_newer(spark, sf_dir):
    """A published table is replaced by what the source has of later days."""
    od = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    name, path = _order_table(spark)
    sinks.append_table(od.where("o_orderdate < '1996-01-01'"), name)
    sinks.replace_with_newer(od, name, "o_orderdate")
    spark.sql(f"DROP TABLE {name}")
    return tables.read_location(spark, path).select("o_orderpriority", "o_orderkey")
