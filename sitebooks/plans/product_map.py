"""Product to sales-category mapping, kept at its newest load per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitebooks.functions.codes import composite_key
from sitebooks.operators.mutate import upsert_latest

# Parts of the mapping key and the columns carried along.
KEY_PARTS = (
    "Country_Code", "Calendar_Year", "Calendar_Month", "Sales_Category", "Product_Group_Code",
    "Product_Family_Code",
)
COLUMNS = (
    "Country_Code", "Calendar_Year", "Calendar_Month", "Sales_Category", "Product_Group_Code",
    "Product_Group_Name", "Product_Family_Code", "Product_Family_Name",
)


def keyed_mapping(raw: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Mapping rows with their composite key (null if a part is null) and load time."""
    return raw.select(
        composite_key(*[F.col(c) for c in KEY_PARTS]).alias("Product_Sales_Category_Id"),
        *COLUMNS,
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("CREATE_DATE"),
    )


def merge_mapping(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """Current and fresh rows, newest load per key; equally new rows all stay."""
    return upsert_latest(current, fresh, ["Product_Sales_Category_Id"], "CREATE_DATE")
