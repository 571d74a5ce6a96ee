"""Pump transactions matched with reference sales by quantity and time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitebooks.functions.calendar import local_time
from sitebooks.operators.filters import in_values
from sitebooks.operators.intervals import BUCKET_SECONDS, match_nearest
from sitebooks.operators.joins import lookup
from sitebooks.operators.quality import unwatched
from sitebooks.operators.windows import dedupe

# Zone of the sites, first day of the first load, tolerance, the
# sales rows that count, and the shifts applied to start and end times.
ZONE = "Europe/Paris"
FIRST_DAY = dt.date(2023, 1, 1)
TOLERANCE_SECONDS = 15 * 60
SALES_CLASS, SALES_INDICATOR = "FUELS", "S"
START_EARLIER = "INTERVAL 1 MINUTE"
UNMATCHED_END_LATER = "INTERVAL 3 MINUTES"
SITE_COLUMNS = {
    "Cluster": "Cluster", "GlobalSiteId": "GlobalSiteId",
    "IsWSMASupportedSite": "IsWSMASupportedSite", "SiteSimulation": "SiteSimulation",
    "SiteStatus": "SiteStatus", "Name": "siteName", "City": "City",
}
TRANSACTION_KEY = [
    "SiteId", "deviceID", "additionalProductInfo", "productCode", "pumpNumber", "nozzleNumber",
    "quantity", "counterReading", "transactionStartTime", "transactionEndTime", "deliveryType",
    "lubricantQuantity", "transactionNumber", "transactionStatus",
]
OUTPUT = [
    "PartitionKey", "RowKey", "RequestDateTime", "SiteId", "deviceID", "additionalProductInfo",
    "productCode", "pumpNumber", "nozzleNumber", "counterReading", "transactionStartTime",
    "transactionEndTime", "deliveryType", "lubricantQuantity", "transactionNumber",
    "transactionStatus", "Cluster", "GlobalSiteId", "IsWSMASupportedSite", "SiteSimulation",
    "SiteStatus", "siteName", "City", "START_DATE", "SALES_QUANTITY", "TRANSACTION_HOUR",
    "TRANSACTION_MINUTE",
]


def site_transactions(
    tx: DataFrame,
    sites: DataFrame,
    zone: str = ZONE,
    first_load: bool = False,
    first_day: dt.date = FIRST_DAY,
    watch: Callable[..., DataFrame] = unwatched,
) -> DataFrame:
    """Distinct transactions in local time with their site attributes.

    Transactions equal in :data:`TRANSACTION_KEY` are one; copies of whole rows
    fall away in the same step; rows that differ only in what the site table says
    are settled by these columns, so the survivor does not depend on the run.  On
    the first load only transactions ending on or after ``first_day`` count.

    Device, product, pump, nozzle and transaction number are whole numbers; text
    that is none becomes null.  ``watch`` counts the rows behind each step and
    how many had such text (:class:`sitebooks.operators.quality.Steps`).
    """
    whole = ("deviceID", "productCode", "pumpNumber", "nozzleNumber", "transactionNumber")
    rows = tx.withColumns(
        {
            c: local_time(F.col(c).cast("timestamp"), zone)
            for c in ("transactionStartTime", "transactionEndTime", "RequestDateTime")
        }
    )
    if first_load:
        rows = rows.where(F.col("transactionEndTime") >= F.lit(first_day))
    unreadable = reduce(lambda a, b: a | b, [F.col(c).isNotNull() & F.col(c).try_cast("int").isNull() for c in whole])
    rows = watch(rows, "keys", "RowKey", unreadable=unreadable)
    rows = rows.withColumns(
        {
            "RowKey": F.trim("RowKey"),
            "SiteId": F.trim("SiteId"),
            **{c: F.col(c).try_cast("int") for c in whole},
        }
    )
    rows = lookup(
        rows,
        sites.withColumn("GlobalSiteId", F.trim("GlobalSiteId")),
        {
            "PartitionKey": "PartitionKey", "SiteId": "SiteId", "pumpNumber": "pumpNumber",
            "nozzleNumber": "nozzleNumber",
        },
        SITE_COLUMNS,
        trim=True,
    )
    rows = watch(rows, "sites", "GlobalSiteId")
    attributes = [c for c in SITE_COLUMNS.values() if c != "GlobalSiteId"]
    survivors = [F.col(c) for c in ("PartitionKey", "RowKey", "RequestDateTime", "GlobalSiteId", *attributes)]
    rows = watch(dedupe(rows, TRANSACTION_KEY, [c.asc_nulls_last() for c in survivors]), "distinct", "GlobalSiteId")
    return rows.withColumns(
        {
            "START_DATE": F.to_date("transactionEndTime"),
            "SALES_QUANTITY": F.col("quantity").cast("decimal(20,2)"),
            "TRANSACTION_HOUR": F.hour("transactionEndTime"),
            "TRANSACTION_MINUTE": F.minute("transactionEndTime"),
        }
    )


def reference_sales(
    sales: DataFrame, dates: DataFrame | None = None, zone: str | None = None
) -> DataFrame:
    """Fuel sales under the transaction key names.

    ``dates`` restricts them to observed dates by a semi join.  Event times are
    taken as they are unless ``zone`` says that they are UTC.
    """
    rows = sales.where(
        (F.col("CLASS_NAME") == SALES_CLASS)
        & (F.col("SALES_OR_RETURN_INDICATOR") == SALES_INDICATOR)
    )
    if dates is not None:
        rows = in_values(rows, "START_DATE", dates)
    at = F.col("EVENT_START_DATE").cast("timestamp")
    return rows.select(
        F.col("COUNTRY_CODE").alias("PartitionKey"),
        F.col("RETAIL_SITE_ID").alias("GlobalSiteId"),
        F.col("SALES_QUANTITY").cast("decimal(20,2)").alias("SALES_QUANTITY"),
        (at if zone is None else local_time(at, zone)).alias("EVENT_START_DATE"),
    )


def match_transactions(
    tx: DataFrame,
    sales: DataFrame,
    seconds: int = TOLERANCE_SECONDS,
    bucket_seconds: int = BUCKET_SECONDS,
    with_flag: bool = False,
) -> DataFrame:
    """Transactions with end times taken from matching sales where there are any.

    A sale matches when country, site and quantity agree and it lies within the
    tolerance of the transaction's end (both ends included); the nearest one
    gives the end time.  Of the matched transactions of one message with equal
    quantity, pump and nozzle only the last ending stays.  Unmatched
    transactions end later by a fixed shift, all start earlier by one.  Rows
    without a global site are dropped.  ``with_flag`` adds ``matched``.

    Match and non-match stay in one frame, so the input is evaluated once:
    matched rows are numbered within their message, unmatched ones lie in
    partitions of their own and are all kept.
    """
    rows = match_nearest(
        tx.where(F.col("GlobalSiteId").isNotNull()),
        sales,
        ["PartitionKey", "GlobalSiteId", "SALES_QUANTITY"],
        "transactionEndTime",
        "EVENT_START_DATE",
        seconds,
        "_sale_at",
        bucket_seconds,
    ).withColumn("matched", F.col("_sale_at").isNotNull())
    message = ["PartitionKey", "GlobalSiteId", "RowKey", "SALES_QUANTITY", "pumpNumber", "nozzleNumber"]
    alone = F.when(~F.col("matched"), F.xxhash64(*TRANSACTION_KEY))
    tie = [F.col(c).asc_nulls_last() for c in TRANSACTION_KEY if c != "transactionEndTime"]
    place = Window.partitionBy(*message, alone).orderBy(F.col("transactionEndTime").desc(), *tie)
    end = F.coalesce("_sale_at", F.expr(f"transactionEndTime + {UNMATCHED_END_LATER}"))
    return (
        rows.withColumn("_rn", F.row_number().over(place))
        .where("NOT matched OR _rn = 1")
        .withColumn("transactionEndTime", end)
        .withColumn("transactionStartTime", F.expr(f"transactionStartTime - {START_EARLIER}"))
        .select(*OUTPUT, *(["matched"] if with_flag else []))
    )
