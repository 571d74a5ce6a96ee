"""Curated lease table and the sales-based rent rules attached to it."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitebooks.operators.filters import reject_blank
from sitebooks.operators.joins import lookup_spread, may_match
from sitebooks.operators.project import project
from sitebooks.operators.quality import unwatched
from sitebooks.operators.sets import union_all
from sitebooks.operators.windows import latest_by, latest_wide

EXPENSE, INCOME = "Expense Lease", "Income Lease"
ACTIVE = "Active"

# Curated lease column -> source column, in output order.  The four
# name columns and the site id are expressions, see curated_leases().
LEASE_NAMES = {
    "Lease_Name": "TRI_NAME_TX",
    "DCH_Validator_Name": None,
    "Portfolio_Administrator_Name": None,
    "PA_Validator_Name": None,
    "Property_Manager_Name": None,
    "DCH_Validator_Email_Id": "CST_PEOPLE_TX",
    "Portfolio_Administrator_Email_Id": "CST_PEOPLE_TX1",
    "PA_Validator_Email_Id": "CST_PEOPLE_TX2",
    "Property_Manager_Email_Id": "CST_PEOPLE_TX3",
    "Premise_Location_Id": "CST_PREMISE_LOCATION_ID",
    "Property_Id": "CST_PROPERTY_ID_TX",
    "Site_Id": None,
    "Legacy_Lease_Id": "TRI_LEGACY_LEASE_ID_TX",
    "Secondary_Lease_Type_Text": "CST_SECONDARY_LEASE_TYPE_CL",
    "Spider_Type_Text": "CST_SPIDER_CONTRACT_APPROACH_LI",
    "Tenant_Name": "CST_TENANT_ID_TX",
    "Conversion_Group_Text": "TRI_CONVERSION_GROUP_LI",
    "Lease_Term_Period": "TRI_LEASE_TERM_TX",
    "Lease_Type_Code": "TRI_LEASE_TYPE_CL",
    "Total_Contract_LC_Amount": "TRI_TOTAL_CONTRACT_AMOUNT_NU",
    "Contact_Status_Code": "TRI_CONTACT_STATUS_TX",
    "Contract_Status_Code": "TRI_CONTRACT_STATUS_CL",
    "Lease_Status_Code": "TRI_STATUS_CL",
    "Landlord_Name": "CST_LANDLORD_ID_TX",
    "Tenant_Organization_Text": "TRI_TENANT_CONTACT_ORG_LOOKUP_TX",
    "Lease_Expiration_Date": "TRI_EXPIRATION_DA",
    "Original_Contract_Expiration_Date": "TRI_ORIGINAL_EXPIRATION_DA",
    "Original_Contract_Start_Date": "TRI_ORIGINAL_START_DA",
    "Rent_Commencement_Date": "TRI_RENT_COMMENCE_DA",
    "Contract_Start_Date": "TRI_START_DA",
    "SBR_Relevant_Status_Code": "CST_SALES_BASED_RENT_BL",
    "Company_Code": "TRI_BUSINESS_UNIT_ORG_TX",
    "Local_Currency_Code": "CST_CURRENCY_TX",
    "Country_Code": "COUNTRY",
    "Brand_Category_Text": "CST_BRAND_CATEGORY_TX",
    "Brand_Sub_Category_Text": "CST_BRAND_SUB_CATEGORY_TX",
    "Brand_Name": "CST_BRAND_TX",
    "Offer_Type_Text": "CST_OFFER_TYPE_TX",
    "Other_Brand_Text": "CST_OTHER_BRAND_TX",
    "Format_Type_Text": "CST_FORMAT_TYPE_CL",
    "Brand_Operator_Text": "CST_BRAND_OPERATOR_OPEX_CL",
    "Building_Investor_Text": "CST_BUILDING_INVESTOR_CAPEX_CL",
    "Equipment_Investor_Text": "CST_EQUIPMENT_INVESTOR_CAPEX_CL",
    "Other_Brand_Sub_Category_Text": "CST_OTHER_BRAND_SUB_CATEGORY_TX",
    "Minor_Revision_Number": "TRI_MINOR_REVISION_NU",
    "Revision_Number": "TRI_REVISION_NU",
    "Control_Number": "TRI_CONTROL_NUMBER_CN",
    "Lease_Transaction_Id": "TRI_ID_TX",
    "CoLocator_Indicator": "TRI_COLOCATION_BL",
    "Spider_Text": "CST_SPIDER_TX",
    "Evergreen_Indicator": "CST_EVERGREEN_BL",
    "Currency_Name": "TRI_CURRENCY_UO",
    "Capex_Applicable_Indicator": "CST_CAPEX_APPLICABLE_LI",
    "Financing_Capex_Class_Code": "CST_FINANCING_CAPEX_CLASS_LI",
    "Financing_Capex_GrowthSustain_Type_Code": "CST_FINANCING_CAPEX_GROWTH_SUSTAIN_LI",
    "Source_Last_Modified_Date": "TRI_MODIFIED_DATE_SY",
}
LEASE_TIMESTAMPS = (
    "Lease_Expiration_Date", "Original_Contract_Expiration_Date", "Original_Contract_Start_Date",
    "Rent_Commencement_Date", "Contract_Start_Date", "Source_Last_Modified_Date",
)
# Curated rule column -> source column, in output order.
QUANTITY_RULE_NAMES = {
    "Lease_Clause_Legacy_Id": "TRI_CLAUSE_ID_TX",
    "Sales_Category": "TRI_SALES_CATEGORY_CL",
    "Max_Quantity": "CST_MAX_QUANTITY_NU",
    "Min_LC_Amount": "CST_MIN_AMOUNT_NU",
    "Min_Quantity": "CST_MIN_QUANTITY_NU",
    "Multiplier_Value": "CST_QUANTITY_CALC_NU",
    "Quantity_Type_Code": "CST_QUANTITY_CALC_LI",
    "Payment_Method_Type_Text": "CST_PAYMENT_METHOD_LI",
    "Lease_Transaction_Id": "TRI_LEASE_ID_TX",
    "Country_Code": "Country_Code",
    "Company_Code": "Company_Code",
    "Effective_From_Date": "TRI_EFFECTIVE_FROM_DA",
    "Effective_To_Date": "TRI_EFFECTIVE_TO_DA",
    "Control_Number": "TRI_CONTROL_NUMBER_CN",
    "Transaction_Id": "TRI_ID_TX",
    "Sliding_Grade_Indicator": "CST_SLIDING_GRADE_BL",
    "Source_Last_Modified_Date": "TRI_MODIFIED_DATE_SY",
}
VALUE_RULE_NAMES = {
    "Lease_Clause_Legacy_Id": "TRI_CLAUSE_ID_TX",
    "Sales_Category": "TRI_SALES_CATEGORY_CL",
    "Custom_Min_LC_Amount": "CST_MIN_AMOUNT_NU",
    "Max_LC_Amount": "TRI_MAX_AMOUNT_NU",
    "Min_LC_Amount": "TRI_MIN_AMOUNT_NU",
    "Percentage_Value": "TRI_PERCENT_RENT_NU",
    "Payment_Method_Type_Text": "CST_PAYMENT_METHOD_LI",
    "Lease_Transaction_Id": "TRI_LEASE_ID_TX",
    "Country_Code": "Country_Code",
    "Company_Code": "Company_Code",
    "Effective_From_Date": "TRI_EFFECTIVE_FROM_DA",
    "Effective_To_Date": "TRI_EFFECTIVE_TO_DA",
    "Control_Number": "TRI_CONTROL_NUMBER_CN",
    "Transaction_Id": "TRI_ID_TX",
    "Sliding_Grade_Indicator": "CST_SLIDING_GRADE_BL",
    "Source_Last_Modified_Date": "TRI_MODIFIED_DATE_SY",
}


MODIFIED = "TRI_MODIFIED_DATE_SY"
# Columns that tell lease rows apart; few, so that steps carry no others for them.
LEASE_ROW = ("TRI_ID_TX", "TRI_CONTROL_NUMBER_CN", MODIFIED)


# Columns by which property, country and contacts are found and rows are dropped.
RESOLVED_BY = (
    "TRI_LEASE_TYPE_CL", "CST_PROPERTY_ID_TX", "CST_PREMISE_LOCATION_ID", "TRI_BUSINESS_UNIT_ORG_TX",
    "CST_PEOPLE_TX", "TRI_STATUS_CL",
)
# Columns that a rule takes from its lease.
OWNER = ("Country_Code", "Company_Code")


def _ties(df: DataFrame, wanted: Collection[str] | None = None) -> list:
    """Columns that break ties between equally new rows in their order, so runs agree.

    If only the ``wanted`` columns are read afterwards, the order may end behind
    the last of them: rows that are equal up to there give the same.
    """
    names = [c for c in df.columns if c != MODIFIED]
    if wanted is not None:
        names = names[: max((i + 1 for i, c in enumerate(names) if c in wanted), default=0)]
    return [F.col(c) for c in names]


def _newest_first(df: DataFrame) -> list:
    """Newest first; the remaining columns break ties."""
    return [F.col(MODIFIED).desc_nulls_last(), *_ties(df)]


def locations(prop: DataFrame, building: DataFrame, land: DataFrame, space: DataFrame) -> DataFrame:
    """One row per location with the property id that each of the four tables gives it.

    Several ids of one location in one table resolve to the smallest.
    """
    names = ("_property", "_building", "_land", "_space")
    parts = [
        dim.where(F.col("TRI_CONTROL_NUMBER_CN").isNotNull()).select(
            F.col("TRI_CONTROL_NUMBER_CN").alias("_location"),
            *[(F.col(value) if n == name else F.lit(None)).cast("string").alias(n) for n in names],
        )
        for name, dim, value in zip(
            names, (prop, building, land, space), ("TRI_ID_TX", *["TRI_PROPERTY_ID"] * 3)
        )
    ]
    return union_all(parts).groupBy("_location").agg(*[F.min(n).alias(n) for n in names])


def resolve_property(
    leases: DataFrame, prop: DataFrame, building: DataFrame, land: DataFrame, space: DataFrame
) -> DataFrame:
    """Fill the property id of leases by their premise location.

    * a known property id stays;
    * expense leases take the first of property, building and land;
    * income leases take the first of building and space;
    * leases of other types without a property id are dropped.

    One pass over the leases and one join: the four tables are merged to one
    row per location first.  Leases without a location, or with a known property
    id, ask for nothing and are spread over the tasks.
    """
    known = F.col("CST_PROPERTY_ID_TX")
    out = leases.where(known.isNotNull() | F.col("TRI_LEASE_TYPE_CL").isin(EXPENSE, INCOME))
    asked = F.when(known.isNull(), F.col("CST_PREMISE_LOCATION_ID"))
    spread = [c for c in LEASE_ROW if c in leases.columns]
    out = lookup_spread(out, asked, locations(prop, building, land, space), "_location", spread=spread)
    resolved = F.when(
        F.col("TRI_LEASE_TYPE_CL") == EXPENSE, F.coalesce(known, "_property", "_building", "_land")
    ).when(
        F.col("TRI_LEASE_TYPE_CL") == INCOME, F.coalesce(known, F.col("_building"), F.col("_space"))
    ).otherwise(known)
    return out.withColumn("CST_PROPERTY_ID_TX", resolved).drop(
        "_property", "_building", "_land", "_space"
    )


def curated_leases(
    leases: DataFrame,
    prop: DataFrame,
    building: DataFrame,
    land: DataFrame,
    space: DataFrame,
    companies: DataFrame,
    people: DataFrame,
    active_only: bool = False,
    watch: Callable[..., DataFrame] = unwatched,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Newest version of each lease with its property, country and contacts.

    All four contact names show the first contact, given name and family name
    without a separator, null when either part is missing.  ``watch`` counts
    rows behind each step (:class:`sitebooks.operators.quality.Steps`).
    ``columns`` names the curated columns the caller reads, if not all: the same
    rows with these columns, found without carrying the others.
    """
    read = None
    if columns is not None:
        read = {*RESOLVED_BY, *[LEASE_NAMES[c] for c in columns if LEASE_NAMES[c]]}
    # Every row passes one watched branch; the newest dates are read beside it.
    latest = latest_wide(
        leases, ["TRI_ID_TX", "TRI_CONTROL_NUMBER_CN"], MODIFIED, _ties(leases, read),
        seen=lambda df: watch(df, "versions", "TRI_ID_TX"),
    )
    if active_only:
        latest = latest.where(F.lower("TRI_STATUS_CL") == "active")
    latest = watch(latest, "newest", "CST_PROPERTY_ID_TX")
    placed = watch(resolve_property(latest, prop, building, land, space), "property", "CST_PROPERTY_ID_TX")
    countries = (
        reject_blank(companies, "COUNTRY").groupBy("COMP_CODE").agg(F.min("COUNTRY").alias("COUNTRY"))
    )
    contacts = people.groupBy("TRI_USER_NAME_TX").agg(
        F.min(F.concat("TRI_FIRST_NAME_TX", "TRI_LAST_NAME_TX")).alias("_contact")
    )
    joined = lookup_spread(placed, F.col("TRI_BUSINESS_UNIT_ORG_TX"), countries, "COMP_CODE", spread=LEASE_ROW)
    joined = watch(joined, "country", "COUNTRY")
    joined = lookup_spread(joined, F.col("CST_PEOPLE_TX"), contacts, "TRI_USER_NAME_TX", spread=LEASE_ROW)
    joined = watch(joined, "contact", "_contact")
    out = {}
    for name, source in LEASE_NAMES.items():
        if name == "Site_Id":
            out[name] = F.substring("CST_PROPERTY_ID_TX", 6, 15)
        elif source is None:
            out[name] = F.col("_contact")
        elif name in LEASE_TIMESTAMPS:
            out[name] = F.col(source).cast("timestamp")
        else:
            out[name] = F.col(source)
    out["Create_Date"] = F.current_timestamp()
    if columns is not None:
        out = {n: out[n] for n in columns}
    return project(joined, out)


def active_clauses(clauses: DataFrame, statuses: Sequence[str] = (ACTIVE,)) -> DataFrame:
    """Ids of clauses whose newest version has one of the statuses (exact case)."""
    latest = latest_by(clauses, ["TRI_ID_TX", "TRI_CONTROL_NUMBER_CN"], _newest_first(clauses))
    return (
        latest.where(F.col("TRI_STATUS_CL").isin(list(statuses)))
        .select(F.col("TRI_ID_TX").alias("_clause"))
        .distinct()
    )


def curated_rules(
    rules: DataFrame,
    curated: DataFrame,
    clauses: DataFrame,
    names: dict[str, str],
    latest_only: bool,
    statuses: Sequence[str] = (ACTIVE,),
) -> DataFrame:
    """Rules of active clauses with the company and country of their lease.

    Quantity rules keep the newest row per rule id (``latest_only=True``), value
    rules keep all distinct rows.  Rules of unknown leases stay, without company
    and country.  ``names`` holds the ids of rule, clause and lease and the owner's
    columns.
    """
    if latest_only:
        rules = latest_wide(rules, ["TRI_ID_TX"], MODIFIED, _ties(rules))
    active = active_clauses(clauses, statuses)
    near = may_match(rules, ["TRI_CLAUSE_ID_TX"], active.withColumnRenamed("_clause", "TRI_CLAUSE_ID_TX"))
    kept = near.join(active, F.col("TRI_CLAUSE_ID_TX") == F.col("_clause"), "left_semi")
    # Copies go before the owner is joined: both sides are then distinct, and so are their
    # pairs.  Newest rows are distinct already, one per id.
    kept = project(kept, {n: c for n, c in names.items() if n not in OWNER})
    if not latest_only:  # dealt first: combining before the exchange would hold all rows of a split
        kept = kept.repartition(*kept.columns).distinct()
    owner = curated.select(F.col("Lease_Transaction_Id").alias("_lease"), *OWNER).distinct()
    joined = kept.join(owner, F.col("Lease_Transaction_Id") == F.col("_lease"), "left")
    return joined.select(*names).withColumn("Create_Date", F.current_timestamp())


def quantity_rules(rules, curated, clauses, statuses: Sequence[str] = (ACTIVE,)) -> DataFrame:
    """Curated quantity rules."""
    return curated_rules(rules, curated, clauses, QUANTITY_RULE_NAMES, True, statuses)


def value_rules(rules, curated, clauses, statuses: Sequence[str] = (ACTIVE,)) -> DataFrame:
    """Curated value rules."""
    return curated_rules(rules, curated, clauses, VALUE_RULE_NAMES, False, statuses)
