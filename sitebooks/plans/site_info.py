"""Site and transaction messages: JSON in text columns turned into rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from sitebooks.functions.text import parsed
from sitebooks.operators.project import drop_all
from sitebooks.operators.reshape import explode_structs
from sitebooks.schemas import schema
from sitebooks.sources.files import has_any_column

# Raw site columns that are not carried into the site table, and
# the message keys kept beside each transaction.
UNUSED_SITE_COLUMNS = (
    "Address", "AlertConfig", "Comment", "ConfigMessageId", "Contact", "CountryCode",
    "CurrentTankNozzleProduct", "ForceUpdate", "ITLConfig", "IsRKSite", "LastPumpNozzle",
    "LastSiteData", "LastTankNozzleProduct", "Latitude", "Longitude", "Market", "NozzleInfo",
    "OBN", "OperatingHours", "ReceivedMessageId", "Region", "SLOC", "SiteToAiut", "Source",
    "TankInfo",
)
MESSAGE_KEYS = ("PartitionKey", "RowKey", "RequestDateTime", "SiteId")
#: A transaction file is usable when it carries one of these columns.
TRANSACTION_COLUMNS = ("Transactions", "transactionStartTime", "transactionEndTime")


def site_nozzles(sites: DataFrame) -> DataFrame:
    """One row per nozzle with the site's name and city.

    Sites without a readable nozzle list give no row.
    """
    site = parsed(F.col("CurrentSiteData"), schema("json_site"))
    nozzles = parsed(F.col("CurrentPumpNozzle"), ArrayType(schema("json_nozzle")))
    keep = drop_all(sites, [*UNUSED_SITE_COLUMNS, "CurrentSiteData", "CurrentPumpNozzle"]).columns
    flat = sites.select(
        *keep, site.alias("_site"), nozzles.alias("_nozzles")
    ).select(
        *keep,
        F.col("_site.siteName").alias("siteName"),
        F.col("_site.city").alias("City"),
        "_nozzles",
    )
    return explode_structs(
        flat, "_nozzles", [*keep, "siteName", "City"], schema("json_nozzle").names
    )


def transactions(messages: DataFrame) -> DataFrame:
    """One row per transaction of each message; already flat frames pass through."""
    if not has_any_column(messages, "Transactions"):
        return messages
    items = parsed(F.col("Transactions"), ArrayType(schema("json_transaction")))
    rows = messages.select(*MESSAGE_KEYS, items.alias("_items"))
    return explode_structs(rows, "_items", MESSAGE_KEYS, schema("json_transaction").names)
