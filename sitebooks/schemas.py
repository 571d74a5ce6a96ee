"""Column contracts of inputs and curated outputs.

Kept as DDL text because that is how a reader checks them against a table.  Use
:func:`schema` to get the ``StructType``; it needs a running session.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column names, order and types of the curated tables and of the
# feeds they are loaded from.
DDL = {
    "exchange_rate": """
        Exchange_Rate_Period_Type_Code string, From_Currency_Code string,
        To_Currency_Code string, Effective_From_Date date, Exchanage_Rate double,
        Ratio_From_Currency_Unit_Number double, Ratio_To_Currency_Unit_Number double,
        Create_Date timestamp""",
    "cash_capex": """
        Ingestion_Revision_Date timestamp, Country_Name string, Country_Code string,
        Company_Code string, CAPIN_Unique_Id string, FISCAL_Period string, Date_Year string,
        Date_Month string, ActualRate string, PlanRate string, Currency_Code string,
        Project_Code string, Project_Text string, CAPIN_Type_Project_Code string,
        CAPIN_Type_Project_Text string, CAPIN_Type_Child_Code string,
        CAPIN_Type_Child_Text string, Entry_Text string, Project_Country string""",
    "finance_capex": """
        Ingestion_Revision_Date timestamp, Country_Name string, Country_Code string,
        Company_Code string, CAPIN_Unique_Id string, FISCAL_Period string, Date_Year string,
        Date_Month string, ActualRate string, PlanRate string, Currency_Code string,
        Project_Code string, Project_Text string, CAPIN_Type_Project_Code string,
        CAPIN_Type_Project_Text string, CAPIN_Type_Child_Code string,
        CAPIN_Type_Child_Text string, Entry_Text string, Project_Country string""",
    "opex_plan_actual": """
        IngestionDate timestamp, FISCAL_PERIOD string, COUNTRY_CODE string,
        COST_CENTER_COUNTRY_CODE string, COST_CENTER_COMPANY_CODE string, COMPANY_CODE string,
        COST_CENTER_CODE string, COST_CENTER_DESCRIPTION string, COST_ELEMENT_CODE string,
        COST_ELEMENT_DESCRIPTION string, CONTROLLING_AREA_CODE string,
        PROFIT_CENTER_CODE string, PROFIT_CENTER_DESCRIPTION string,
        OPEX_LINE_ITEM_CODE string, OPEX_LINE_ITEM_CODE_DESCRIPTION string, ZCO_ITMTX string,
        CURRENCY_CODE string, UNIT string, CURRENCY_TYPE string, ZVCCURTYP string,
        VALUE_TYPE_CODE string, VERSION_NUMBER string, GL_ACCOUNT_CODE string,
        CHRT_ACCTS string, INFO_PROVIDER string, TOTAL_VOLUME_QUANTITY double,
        ACTUAL_AMOUNT double, PLAN_CO_AMOUNT double, PLAN_COMPANY_AMOUNT double,
        PLAN_HARD_AMOUNT double, CREATE_DATE timestamp""",
    "payables": """
        Ingestion_Revision_Date timestamp, Company_Code string, Vendor_Account_Code int,
        FISCAL_Period string, Fiscal_Year_Variant int, Document_Number string,
        Refrence_Key int, Item_Number int, Item_Due_Date int, Country_Code string,
        Reference_Dcoument_Number string, Allocation_Number string, HDR_REF_KEY1 string,
        Header_Text string, Item_Text string, RT_TAXCODE string, PMTMTHSUPL string,
        ZHWAE2 string, DCINDIC string, LOAD_DT string, Dcoument_Type_Code string,
        Paymend_Method_Code string, Paymend_Block_Code string, Create_User_Id string,
        Base_Date int, Net_Due_Date int, Clearing_Document_Number string, Clearing_Date int,
        Document_Created_Date int, Document_Date int, Posting_Date int, DISC_BASE double,
        Discount_DC_Amount double, Document_Currency_Amount double,
        Document_Currency_Code string, Local_Currency_Amount double,
        Local_Currency_Code string, Discount_LC_Amount double, ZBVTYP string, ZQSSHB double,
        ZDMBE2 double""",
    "receivables": """
        Ingestion_Revision_Date timestamp, Company_Code string, Customer_Account_Code int,
        Fiscal_Year_Variant string, FISCAL_Period int, Document_Number string,
        Reference_Key_Id string, Item_Number int, Item_Due_Date int, Country_Code string,
        Reference_Dcoument_Number string, Allocation_Number string, HDR_REF_KEY1 string,
        HDRTXT string, Item_Text string, RT_TAXCODE string, PMTMTHSUPL string,
        Dcoument_Type_Code string, Paymend_Method_Code string, Paymend_Block_Code string,
        Create_User_Id string, Base_Date int, Net_Due_Date int,
        Clearing_Document_Number string, Clearing_Date int, Document_Created_Date int,
        Document_Date int, Posting_Date string, DISC_BASE int, Discount_DC_Amount double,
        Document_Currency_Amount double, Document_Currency_Code string,
        Local_Currency_Amount double, Local_Currency_Code string, Discount_LC_Amount double,
        Dcoument_Status_Code string, SP_GL_Indicator string, Reason_Code string,
        FI_Document_Status string, Account_Type_Code string, ZBVTYP string, ZDMBE2 string,
        ZHWAE2 string, AEDAT string, DCINDIC string, LOAD_DT string""",
    "fixed_asset_nbv": """
        COMPANY_CODE string, CREATE_DATE timestamp, SITE_CODE string, PERIOD string,
        FIXED_ASSET_NET_BOOK_VALUE decimal(18,5), CURRENCY_CODE string, COUNTRY string""",
    "rou_asset_nbv": """
        COMPANY_CODE string, CREATE_DATE timestamp, SITE_CODE string, PERIOD string,
        ROU_ASSET_NET_BOOK_VALUE decimal(18,5), CURRENCY_CODE string, COUNTRY string""",
    "cost_centre_site": """
        FISCAL_PERIOD string, CREATE_DATE timestamp, Cost_Center string, Valid_To string,
        Valid_From string, Company_Code string, Profit_Center string, Name_1 string,
        Indicator string""",
    "tax_rate": """
        FISCAL_PERIOD string, CREATE_DATE timestamp, Company_code string, Country string,
        Percentage double, Year int""",
    "actual_raw": """
        KPI string, SITE_ID string, SITE_NAME string, LEASE_ID string, TRANSACTION_ID string,
        COMPANY_CODE string, YEAR int, MONTH string, LEASE_CLASSIFICATION string,
        ACTUAL_AMOUNT double, ACTUAL_AMOUNT_USD double, LEGALLY_COMMITTED string,
        LOCAL_CURRENCY string, LOAD_DATE timestamp, UPDATE_DATE timestamp,
        NO_OF_LEASE_SITES int, TEXT string, POSTING_PERIOD int, PROFIT_CENTER int,
        CONTRACT_NUMBER string, G_L_ACCOUNT string, ASSIGNMENT string, FLOW_TYPE string,
        DOCUMENT_TYPE string, GROWTH_SUSTAIN_SPLIT_TEXT string""",
    "actual": """
        KPI_TYPE_TEXT string, SITE_ID string, SITE_NAME string, LEASE_ID string,
        COMPANY_CODE string, CALENDAR_YEAR int, CALENDAR_MONTH string,
        LEASE_CLASSIFICATION_CODE string, ACTUAL_LC_AMOUNT double, ACTUAL_USD_AMOUNT double,
        LEGALLY_COMMITTED_INDICATOR string, LOCAL_CURRENCY_CODE string, LEASE_SITE_COUNT int,
        COMMENTS_TEXT string, POSTING_PERIOD int, PROFIT_CENTER int, G_L_ACCOUNT int,
        FLOW_TYPE_CODE string, DOCUMENT_TYPE_CODE string, GROWTH_SUSTAIN_SPLIT_TEXT string""",
    "estimate": """
        KPI_TYPE_TEXT string, LE_TYPE_CODE string, SITE_ID string, SITE_NAME string,
        LEASE_ID string, TRANSACTION_ID string, COMPANY_CODE string, VALUE_TYPE_CODE string,
        CALENDAR_YEAR string, CALENDAR_MONTH string, LEASE_CLASSIFICATION_CODE string,
        LE_LC_AMOUNT double, LE_USD_AMOUNT double, LEGALLY_COMMITTED_INDICATOR string,
        LOCAL_CURRENCY_CODE string, LEASE_START_DATE timestamp, LEASE_EXPIRY_DATE timestamp,
        LEASE_SITE_COUNT int, AUTO_RENEWAL_INDICATOR string""",
    "estimate_with_actuals": """
        COMPANY_CODE string, LEASE_CLASSIFICATION_CODE string, VALUE_TYPE string,
        SITE_ID string, SITE_NAME string, LEASE_ID string, LOCAL_CURRENCY_CODE string,
        CALENDAR_MONTH string, CALENDAR_YEAR string, LE_ACTUAL_PLAN1 string, LE_AMOUNT double,
        LE_USD_AMOUNT double, NO_MONTH int, TRANSACTION_ID string,
        LEGALLY_COMMITTED_INDICATOR string, LEASE_SITE_COUNT int,
        AUTO_RENEWAL_INDICATOR string, KPI_TYPE_TEXT string, LE_Type_Code string,
        LE_ACT string, CREATE_DATE date, UPDATE_DATE date""",
    "baseload": """
        KPI_Type_Text string, Company_Code string, BaseLoad_LC_Amount double,
        BaseLoad_USD_Amount double, Growth_Sustain_Split_Text string, Calendar_Year int,
        Create_Date timestamp, Update_Date timestamp, Local_Currency_Code string,
        BaseLoad_Type int""",
    "plan_company_full_year": """
        KPI string, COMPANY_CODE string, YEAR int, PLAN_AMOUNT double, PLAN_AMOUNT_USD double,
        LEASE_CLASSIFICATION string, LOCAL_CURRENCY string, CREATE_DATE timestamp,
        UPDATE_DATE timestamp, NO_OF_LEASE_SITES int, OP_SUBMISSIONS string""",
    "plan_company_ytd": """
        KPI string, COMPANY_CODE string, YEAR int, PLAN_AMOUNT double, PLAN_AMOUNT_USD double,
        PLAN_YTD_AMOUNT double, PLAN_YTD_AMOUNT_USD double, LEASE_CLASSIFICATION string,
        MONTH string, LOCAL_CURRENCY string, CREATE_DATE date, UPDATE_DATE date,
        NO_OF_LEASE_SITES int, OP_SUBMISSIONS string""",
    "plan_site_full_year": """
        KPI string, COMPANY_CODE string, SITE_ID int, LEASE_ID int, Transaction_ID int,
        PLAN_AMOUNT float, PLAN_AMOUNT_USD float, LEASE_CLASSIFICATION string,
        Legally_Committed string, YEAR int, CREATE_DATE date, UPDATE_DATE date,
        LOCAL_CURRENCY string, NO_OF_LEASE_SITES int, Auto_Renewal_Y_N string,
        OP_SUBMISSIONS string""",
    "plan_site_ytd": """
        KPI string, COMPANY_CODE string, SITE_ID int, LEASE_ID int, TRANSACTION_ID int,
        LEASE_CLASSIFICATION string, LOCAL_CURRENCY string, YEAR int, MONTH string,
        NO_OF_LEASE_SITES int, PLAN_AMOUNT float, PLAN_AMOUNT_USD float,
        PLAN_YTD_AMOUNT float, PLAN_YTD_AMOUNT_USD float, LEGALLY_COMMITTED string,
        AUTO_RENEWAL_Y_N string, CREATE_DATE date, UPDATE_DATE date, OP_SUBMISSIONS string""",
    "run_log": "Notebook_Name string, Country string, Run_Date string",
    "retention_audit": """
        table_name string, rows_removed bigint, removed_before int, run_year int""",
    # JSON held in string columns.
    "json_site": "siteName string, city string",
    "json_nozzle": """
        pumpNumber int, forecourtControllerType string, nozzleNumber int,
        nozzleOrderNumber int, tankReferenceId int""",
    "json_transaction": """
        deviceID int, additionalProductInfo string, productCode string, pumpNumber int,
        nozzleNumber int, quantity double, counterReading double, transactionStartTime string,
        transactionEndTime string, deliveryType string, lubricantQuantity double,
        transactionNumber int, transactionStatus string""",
}


def schema(name: str) -> StructType:
    """The ``StructType`` of a named contract."""
    return StructType.fromDDL(" ".join(DDL[name].split()))
