"""Jobs on small fixtures: the cases where the rules are easy to get wrong."""

import datetime as dt

from pyspark.sql import functions as F

from sitebooks.functions.calendar import MONTHS
from sitebooks.plans import assets, budget, estimate, fx, lease, planning, product_map, publish, retention, site_info, staging
from sitebooks.schemas import DDL, schema
from tests.conftest import rows

RUN = dt.date(2024, 5, 20)
TS = dt.datetime(2024, 2, 3)


def frame(spark, name, records):
    """Rows given as dicts over a declared schema; absent columns are null."""
    fields = schema(name).fieldNames()
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in records], schema(name))


def test_contracts_parse(spark):
    sizes = {name: len(schema(name)) for name in DDL}
    assert sizes["plan_company_full_year"] == 11 and sizes["plan_company_ytd"] == 14
    assert sizes["plan_site_full_year"] == 16 and sizes["plan_site_ytd"] == 19
    assert sizes["opex_plan_actual"] == 31 and sizes["payables"] == 41 and sizes["receivables"] == 46
    assert sizes["finance_capex"] == sizes["cash_capex"] == 19
    assert sizes["actual_raw"] == 25 and sizes["json_transaction"] == 13
    assert len(lease.LEASE_NAMES) + 1 == 57
    assert len(lease.QUANTITY_RULE_NAMES) + 1 == 18 and len(lease.VALUE_RULE_NAMES) + 1 == 17


def _estimate(spark, lines):
    cols = ", ".join(f"{m}_Amount double" for m in ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"))
    data = [(TS, "cat", p, cur, *[v.get(i) for i in range(1, 13)]) for p, cur, v in lines]
    return spark.createDataFrame(
        data, f"Ingestion_Revision_Date timestamp, Capex_Category_Type_Code string, Project_Name string, Currency_Code string, {cols}"
    )


def test_estimate_rates(spark):
    est = _estimate(spark, [("a", "EUR", {2: 5.0}), ("b", "GBP", {1: 1.0}), ("c", "CHF", {1: 1.0})])
    plan_rates = spark.createDataFrame(
        [("EUR", "USD", "01.01.2024", 1.1), ("EUR", "USD", "02.01.2024", 1.2), ("CHF", "USD", "01.01.2024", 9.0)],
        "FROM_CURRENCY string, TO_CURRENCY string, EXCHANGE_DATE string, EXCHANGE_RATE double",
    )
    actual = spark.createDataFrame(
        [("ZQ1", c, "USD", dt.date(2024, m, 30), "0.9-") for c, m in (("EUR", 6), ("EUR", 9), ("GBP", 6))],
        "Exchange_Rate_Period_Type_Code string, From_Currency_Code string, To_Currency_Code string, Effective_From_Date date, Exchanage_Rate string",
    )
    out = fx.estimate_at_two_rates(est, plan_rates, actual, RUN)
    # months without a value are gone, a missing plan rate is 1, a missing actual rate drops the row
    assert rows(out, "Project_Name", "LE_month_no", "Q_month", "Plan_USD", "Actual_USD") == [
        ("a", 2, 3, 1.2, 0.9), ("b", 1, 3, 1.0, 0.9),
    ]
    repeated = fx.estimate_at_two_rates(est, plan_rates, actual, RUN, single_plan_rate=False)
    assert rows(repeated, "Project_Name", "Plan_USD") == [("a", 1.1), ("a", 1.2), ("b", 1.0)]


def test_budget_keeps_null_months_and_uses_the_ingestion_quarter(spark):
    wide = _estimate(spark, [("a", "EUR", {4: 5.0})])
    out = budget.monthly_budget(wide, months={m: f"{m.title()}_Amount" for m in MONTHS})
    assert out.count() == 12
    assert rows(out.where("VALUE IS NOT NULL"), "Calender_MONTH", "Quarter_Number", "Calendar_year") == [("APR", "Q1", 2024)]


def test_net_book_values(spark):
    feed = spark.createDataFrame(
        [("C1", "0012", TS, "001.2024", 1.5, "EUR"), ("C1", "0012", TS, "001.2024", 1.5, "EUR"), ("C2", "77", dt.datetime(2019, 1, 1), "p", 2.0, "EUR"), ("C3", "77", TS, "p", 2.0, "EUR")],
        "COMPANY_CODE string, SITE_CODE string, Ingestion_Revision_Date timestamp, PERIOD string, ROU_Asset_NBV double, CURRENCY_CODE string",
    )
    target = spark.createDataFrame([], schema("rou_asset_nbv"))
    companies = spark.createDataFrame([("C1", "NL"), ("C1", "BE"), ("C3", " ")], "COMP_CODE string, COUNTRY string")
    out = assets.load_net_book_values(feed, target, companies, "rou_asset_nbv")
    assert out.columns == schema("rou_asset_nbv").fieldNames()
    assert rows(out, "COMPANY_CODE", "SITE_CODE", "COUNTRY") == [("C1", "12", "BE"), ("C3", "77", None)]
    both = assets.load_net_book_values(feed, target, companies, "rou_asset_nbv", one_country=False)
    assert rows(both, "COMPANY_CODE", "COUNTRY") == [("C1", "BE"), ("C1", "NL"), ("C3", None)]


def test_cost_centres_incremental_or_whole(spark):
    feed = spark.createDataFrame([(TS, "cc", "BAD_DATA"), (TS, "cd", "X")], "Ingestion_Revision_Date timestamp, Cost_Center string, Indicator string")
    first = assets.load_cost_centre_sites(feed, spark.createDataFrame([], schema("cost_centre_site")), dt.date(2024, 1, 15), optional=schema("cost_centre_site").fieldNames())
    assert rows(first, "FISCAL_PERIOD", "Cost_Center", "Indicator") == [("012.2023", "cc", ""), ("012.2023", "cd", "X")]
    assert assets.load_cost_centre_sites(feed, first, RUN, optional=first.columns).count() == 0
    assert assets.load_cost_centre_sites(feed, first, RUN, reload_all=True, optional=first.columns).count() == 2


PLAN = "KPI string, Company_Code string, Lease_Classification string, Site_ID string, Lease_ID string, Year int, Month string, Plan_Amount double, Plan_Amount_USD double, Local_Currency string, OP_Submissions string, Transaction_ID string, Legally_Committed string, Auto_Renewal_Y_N string, No_Of_Lease_Sites int"


def _plan(spark, lines):
    base = {"k": "K", "c": "C", "l": "LR", "site": "1", "lease": "L", "cur": "EUR", "op": "OP23", "usd": 1.0}
    data = []
    for line in lines:
        v = {**base, **line}
        data.append((v["k"], v["c"], v["l"], v["site"], v["lease"], v["y"], v["m"], v["a"], v["usd"], v["cur"], v["op"], v.get("t"), "Y", "N", 1))
    return spark.createDataFrame(data, PLAN)


def test_ytd_and_full_year_rows(spark):
    plan = _plan(spark, [
        dict(y=2024, m="JAN", a=1.0), dict(y=2024, m="JAN", a=2.0), dict(y=2024, m="DEC", a=4.0),
        dict(y=2024, m="JAN", a=10.0, op="OP24"), dict(y=2025, m="FEB", a=None, usd=None),
    ])
    out = planning.month_ytd_full_year(plan, RUN)
    got = rows(out, "Year", "OP_Submissions", "Month_ID", "Plan_Amount", "Plan_YTD_Amount", "No_Of_Lease_Sites")
    assert got == [
        (2024, "OP23", 1, 3.0, 3.0, 2), (2024, "OP23", 12, 4.0, 7.0, 1), (2024, "OP23", 13, 7.0, 0.0, 3),
        (2024, "OP24", 1, 10.0, 10.0, 1), (2024, "OP24", 13, 10.0, 0.0, 1),
        (2025, "OP23", 2, 0.0, 0.0, 1),  # no December, so no full-year row
    ]
    mixed = planning.month_ytd_full_year(plan, RUN, mix_submissions=True).where("Month_ID < 13 AND Year = 2024")
    assert rows(mixed, "Month_ID", "OP_Submissions", "Plan_YTD_Amount") == [(1, "OP23", 3.0), (1, "OP24", 13.0), (12, "OP23", 17.0)]


def test_ytd_of_the_last_month_is_the_year(spark, sf_dir):
    from sitebooks.catalog.registry import plan_lines

    out = planning.month_ytd_full_year(plan_lines(spark, sf_dir), RUN)
    months = out.where("Month_ID < 13").groupBy("KPI", "Company_Code", "Lease_Classification", "Year", "OP_Submissions").agg(
        F.max_by("Plan_YTD_Amount", "Month_ID").alias("last"), F.sum(F.col("Plan_Amount").cast("decimal(18,2)")).alias("total")
    )
    assert months.where("abs(last - total) > 0.001").count() == 0


def test_currency_falls_back_to_the_company(spark):
    out = planning.month_ytd_full_year(_plan(spark, [dict(y=2024, m="JAN", a=1.0, cur=None)]), RUN)
    assert rows(out, "Local_Currency") == [("C",)]


def test_site_full_year_one_row_or_one_per_line(spark):
    plan = _plan(spark, [
        dict(y=2024, m="JAN", a=1.0, t="t1"), dict(y=2024, m="FEB", a=2.0, t="t2"),
        dict(y=2024, m="FEB", a=5.0, lease=None), dict(y=2022, m="FEB", a=2.0),
    ])
    one = planning.site_full_year(plan, RUN)
    assert rows(one, "Lease_ID", "Plan_Amount", "Transaction_ID") == [(None, 5.0, None), ("L", 3.0, "t2")]
    many = planning.site_full_year(plan, RUN, repeat_per_detail=True)
    assert rows(many, "Lease_ID", "Plan_Amount", "Transaction_ID") == [(None, 5.0, None), ("L", 3.0, "t1"), ("L", 3.0, "t2")]


def test_company_full_year_counts_classified_rows(spark):
    out = planning.company_full_year(_plan(spark, [dict(y=2024, m="JAN", a=None, l=None, usd=None)]), RUN)
    assert rows(out, "Plan_Amount", "No_Of_Lease_Sites", "Create_Date") == [(0.0, 0, RUN)]


def test_estimates_with_actuals(spark):
    act = dict(COMPANY_CODE="C", SITE_ID="1", LEASE_ID="L", LEASE_CLASSIFICATION_CODE="LR")
    actuals = frame(spark, "actual", [
        {**act, "CALENDAR_YEAR": 2024, "CALENDAR_MONTH": "FEB", "ACTUAL_LC_AMOUNT": 7.0, "ACTUAL_USD_AMOUNT": 7.0},
        {**act, "CALENDAR_YEAR": 2024, "CALENDAR_MONTH": "APR", "ACTUAL_LC_AMOUNT": 9.0, "ACTUAL_USD_AMOUNT": 9.0},
        {**act, "CALENDAR_YEAR": 2023, "CALENDAR_MONTH": "JAN", "ACTUAL_LC_AMOUNT": 50.0, "ACTUAL_USD_AMOUNT": 50.0},
    ]).withColumn("TRANSACTION_ID", F.lit(None).cast("string"))
    est = dict(COMPANY_CODE="C", LEASE_ID="L", CALENDAR_YEAR="2024", LE_TYPE_CODE="LE2")
    estimates = frame(spark, "estimate", [
        {**est, "CALENDAR_MONTH": "MAR", "LEASE_CLASSIFICATION_CODE": "Tap UP", "LE_LC_AMOUNT": 1.0, "LE_USD_AMOUNT": 1.0},
        {**est, "CALENDAR_MONTH": "APR", "LEASE_CLASSIFICATION_CODE": "EV DEST", "LE_LC_AMOUNT": 2.0, "LE_USD_AMOUNT": None},
        {**est, "CALENDAR_MONTH": "MAY", "LEASE_CLASSIFICATION_CODE": "other", "VALUE_TYPE_CODE": "RENT", "LE_LC_AMOUNT": 3.0, "LE_USD_AMOUNT": 3.0},
        {**est, "CALENDAR_MONTH": "JAN", "LE_TYPE_CODE": "LE1", "LE_LC_AMOUNT": 4.0, "LE_USD_AMOUNT": 4.0},
        {**est, "CALENDAR_MONTH": "JAN", "LE_TYPE_CODE": "LE1", "LE_LC_AMOUNT": 4.0, "LE_USD_AMOUNT": 4.0},
        {**est, "CALENDAR_MONTH": "JUN", "CALENDAR_YEAR": "2023", "LE_LC_AMOUNT": 8.0, "LE_USD_AMOUNT": 8.0},
    ])
    out = estimate.replace_with_actuals(estimates, actuals, 2024, run_date=RUN, optional=schema("estimate_with_actuals").fieldNames())
    assert out.columns == schema("estimate_with_actuals").fieldNames()
    le2 = out.where("LE_ACT = 'LE2_ACT'")
    # cut-off month 3: February from actuals, April's actual zeroed, March's estimate zeroed
    assert rows(le2.where("LE_AMOUNT <> 0"), "NO_MONTH", "LE_AMOUNT", "LE_USD_AMOUNT", "LEASE_CLASSIFICATION_CODE", "VALUE_TYPE") == [
        (2, 7.0, 7.0, "LR", "ADVANCE_PAYMENT"), (4, 2.0, 0.0, "NTI", "ADVANCE_PAYMENT"), (5, 3.0, 3.0, None, "RENT"),
    ]
    assert le2.count() == 12 + 3
    assert out.where("LE_ACT = 'LE1_ACT'").count() == 2  # equal rows stay without actuals
    april = out.where("LE_ACT = 'LE3_ACT' AND LE_AMOUNT <> 0")
    assert rows(april, "NO_MONTH", "LE_AMOUNT") == [(2, 7.0), (4, 9.0)]
    relabelled = estimate.replace_with_actuals(estimates, actuals, 2024, relabel_other_years=True, run_date=RUN, optional=schema("estimate_with_actuals").fieldNames())
    assert rows(relabelled.where("LE_ACT = 'LE2_ACT' AND NO_MONTH = 1 AND LE_AMOUNT <> 0"), "LE_AMOUNT") == [(50.0,)]


def test_staging_by_name(spark):
    raw = frame(spark, "actual_raw", [{"KPI": "K", "YEAR": 2022, "PROFIT_CENTER": 800001, "FLOW_TYPE": "Q20", "LOAD_DATE": TS}] * 2 + [{"KPI": "K", "YEAR": 2022, "PROFIT_CENTER": 1, "FLOW_TYPE": "Q20", "LOAD_DATE": TS}])
    staged = staging.stage_actuals(raw)
    out = staging.payment_actuals(staged, [TS.date()])
    assert out.count() == 1 and out.columns == schema("actual").fieldNames()
    opex = spark.createDataFrame([("NL", 1.0, 2.0, "2022", "EUR", "LE1")], "COUNTRY_NAME string, OPEX_LE_AMOUNT_USD double, OPEX_LE_AMOUNT double, YEAR string, LOCAL_CURRENCY string, LE_TYPE string")
    assert rows(staging.stage_opex_estimates(opex), "CALENDAR_YEAR", "OPEX_LE_LC_AMOUNT") == [(2022, 2.0)]
    plan = spark.createDataFrame([("e", "NL", "s", "JAN", 2022, 1.0, 2.0)], "GLOBAL_COST_ELEMENT string, COMPANY_CODE string, SFS_LINE_ITEM string, MONTH string, YEAR int, OPEX_PL_AMOUNT_USD double, OPEX_PL_AMOUNT double")
    assert rows(staging.stage_opex_plan(plan), "COUNTRY_CODE", "CALENDAR_YEAR") == [("NL", 2022)]
    le = spark.createDataFrame([("K", "LE1", "S", 2022, TS)], "KPI string, LE_TYPE string, SITE_ID string, YEAR int, LOAD_DATE timestamp")
    for name in ("SITE_NAME", "LEASE_ID", "TRANSACTION_ID", "COMPANY_CODE", "VALUE_TYPE", "MONTH", "LEASE_CLASSIFICATION", "LE_AMOUNT", "LE_AMOUNT_USD", "LEGALLY_COMMITTED", "LOCAL_CURRENCY", "UPDATE_DATE", "NO_OF_LEASE_SITES", "AUTO_RENEWAL_Y_N", "PLAN_AMOUNT", "PLAN_AMOUNT_USD"):
        le = le.withColumn(name, F.lit(None).cast("string"))
    curated = staging.curated_estimates(staging.stage_estimates(le))
    assert rows(curated, "LE_TYPE_CODE", "CALENDAR_YEAR", "LEASE_START_DATE") == [("LE1", "2022", None)]
    assert "PLAN_LC_AMOUNT" in staging.stage_plan(le).columns


def test_publish(spark):
    df = spark.createDataFrame([("C1", 1), ("C9", 2)], "COMPANY_CODE string, Year int")
    companies = spark.createDataFrame([("C1", "NL"), ("C1", "NL")], "company string, country string")
    inner = publish.with_country(df, companies, names=publish.PLAN_PUBLISH_NAMES)
    assert rows(inner, "COMPANY_CODE", "country", "Calendar_Year") == [("C1", "NL", 1)]
    assert inner.where("refresh_date IS NULL").count() == 0
    left = publish.with_country(df, companies, how="left", stamp_column=None)
    assert rows(left) == [("C1", 1, "NL"), ("C9", 2, None)]
    facts = spark.createDataFrame([("United Kingdom",), ("Peru",)], "country_name string")
    regions = spark.createDataFrame([("UK", "GB")], "country_name string, COUNTRY_CODE string")
    assert rows(publish.with_region(facts, regions, stamp_column=None)) == [("United Kingdom", "GB")]


def test_retention_over_several_tables(spark):
    a = spark.createDataFrame([(2019,), (2020,)], "y int")
    kept, audit = retention.apply_retention({"a": (a, "y"), "b": (a.limit(0), "y")}, 2024)
    assert rows(kept["a"]) == [(2020,)]
    assert rows(audit) == [("a", 1, 2020, 2024), ("b", 0, 2020, 2024)]


def _leases(spark, records):
    cols = [c for c in lease.LEASE_NAMES.values() if c and c != "COUNTRY"]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in records], ", ".join(f"{c} string" for c in cols))


def test_lease_curation(spark):
    leases = _leases(spark, [
        dict(TRI_ID_TX="1", TRI_CONTROL_NUMBER_CN="x", TRI_MODIFIED_DATE_SY="2024-01-01 00:00:00", TRI_LEASE_TYPE_CL="Expense Lease", CST_PREMISE_LOCATION_ID="b", TRI_BUSINESS_UNIT_ORG_TX="C1", CST_PEOPLE_TX="p1"),
        dict(TRI_ID_TX="1", TRI_CONTROL_NUMBER_CN="x", TRI_MODIFIED_DATE_SY="2023-01-01 00:00:00", TRI_LEASE_TYPE_CL="Expense Lease", CST_PROPERTY_ID_TX="old"),
        dict(TRI_ID_TX="2", TRI_LEASE_TYPE_CL="Income Lease", CST_PREMISE_LOCATION_ID="p", TRI_BUSINESS_UNIT_ORG_TX="C2", CST_PEOPLE_TX="p2"),
        dict(TRI_ID_TX="3", TRI_LEASE_TYPE_CL="Expense Lease", CST_PREMISE_LOCATION_ID="p"),
        dict(TRI_ID_TX="4", TRI_LEASE_TYPE_CL="Sub Lease", CST_PREMISE_LOCATION_ID="p"),
        dict(TRI_ID_TX="5", TRI_LEASE_TYPE_CL="Sub Lease", CST_PROPERTY_ID_TX="PROP-12345"),
        dict(TRI_ID_TX="6", TRI_LEASE_TYPE_CL="Expense Lease", CST_PREMISE_LOCATION_ID="l"),
    ])
    dim = lambda value, *pairs: spark.createDataFrame(list(pairs), f"TRI_CONTROL_NUMBER_CN string, {value} string")
    companies = spark.createDataFrame([("C1", "NL"), ("C2", " ")], "COMP_CODE string, COUNTRY string")
    people = spark.createDataFrame([("p1", "Ada", "L"), ("p2", "Bob", None)], "TRI_USER_NAME_TX string, TRI_FIRST_NAME_TX string, TRI_LAST_NAME_TX string")
    out = lease.curated_leases(
        leases, dim("TRI_ID_TX", ("p", "prop")), dim("TRI_PROPERTY_ID", ("b", "build")), dim("TRI_PROPERTY_ID", ("l", "land")),
        dim("TRI_PROPERTY_ID", ("p", "space")), companies, people,
    )
    assert len(out.columns) == 57
    assert rows(out, "Lease_Transaction_Id", "Property_Id", "Country_Code", "PA_Validator_Name") == [
        ("1", "build", "NL", "AdaL"), ("2", "space", None, None), ("3", "prop", None, None), ("5", "PROP-12345", None, None), ("6", "land", None, None),
    ]
    assert rows(out.where("Lease_Transaction_Id = '5'"), "Site_Id") == [("12345",)]
    clauses = spark.createDataFrame(
        [("c1", "x", "Active", 2), ("c1", "x", "Retired", 1), ("c2", "x", "active", 1), ("c3", "x", "Retired", 1)],
        "TRI_ID_TX string, TRI_CONTROL_NUMBER_CN string, TRI_STATUS_CL string, TRI_MODIFIED_DATE_SY int",
    )
    names = [c for c in lease.QUANTITY_RULE_NAMES.values() if c not in ("Country_Code", "Company_Code")]
    rule = lambda **v: tuple(v.get(c) for c in names)
    rules = spark.createDataFrame(
        [rule(TRI_ID_TX="r1", TRI_CLAUSE_ID_TX="c1", TRI_LEASE_ID_TX="1", TRI_MODIFIED_DATE_SY="2"), rule(TRI_ID_TX="r1", TRI_CLAUSE_ID_TX="c1", TRI_MODIFIED_DATE_SY="1"),
         rule(TRI_ID_TX="r2", TRI_CLAUSE_ID_TX="c2", TRI_LEASE_ID_TX="1"), rule(TRI_ID_TX="r3", TRI_CLAUSE_ID_TX="c3", TRI_LEASE_ID_TX="none")],
        ", ".join(f"{c} string" for c in names),
    )
    got = lease.quantity_rules(rules, out, clauses)
    assert rows(got, "Transaction_Id", "Company_Code", "Country_Code") == [("r1", "C1", "NL")]
    wider = lease.quantity_rules(rules, out, clauses, statuses=("Active", "Retired"))
    assert rows(wider, "Transaction_Id", "Company_Code") == [("r1", "C1"), ("r3", None)]


def test_product_mapping_keeps_equally_new_rows(spark):
    cols = ", ".join(f"{c} string" for c in product_map.COLUMNS)
    raw = lambda *names: spark.createDataFrame([("NL", "2024", "01", "S", "G", n, "F", "Fn") for n in names], cols)
    at = lambda d: F.to_timestamp(F.lit(d))
    old = product_map.keyed_mapping(raw("a"), at("2024-01-01"))
    new = product_map.keyed_mapping(raw("b", "c"), at("2024-01-02"))
    merged = product_map.merge_mapping(old, new)
    assert len(merged.columns) == 10
    assert rows(merged, "Product_Group_Name") == [("b",), ("c",)]
    assert rows(product_map.merge_mapping(merged, new.limit(0))) == rows(merged)


def test_transactions_parse(spark):
    msgs = spark.createDataFrame(
        [("NL", "1", "t", "s", '[{"pumpNumber":1,"quantity":2.5},{"pumpNumber":2}]'), ("NL", "2", "t", "s", "not json"), ("NL", "3", "t", "s", None), ("NL", "4", "t", "s", "[]")],
        "PartitionKey string, RowKey string, RequestDateTime string, SiteId string, Transactions string",
    )
    out = site_info.transactions(msgs)
    assert len(out.columns) == 17
    assert rows(out, "RowKey", "pumpNumber", "quantity") == [("1", 1, 2.5), ("1", 2, None)]
    assert site_info.transactions(out) is out


def test_some_lease_columns_give_the_same_rows(spark):
    leases = _leases(spark, [
        dict(TRI_ID_TX="1", TRI_MODIFIED_DATE_SY=day, TRI_LEASE_TYPE_CL=kind, CST_PROPERTY_ID_TX=place, TRI_BUSINESS_UNIT_ORG_TX=unit, CST_PEOPLE_TX="p", TRI_NAME_TX=name)
        for day, kind, place, unit, name in [("2024", "Expense Lease", "b", "C2", "n2"), ("2024", "Expense Lease", "b", "C1", "n3"), (None, "Expense Lease", "a", "C1", "n1")]
    ] + [dict(TRI_LEASE_TYPE_CL="Income Lease", CST_BRAND_TX=b) for b in "cab"])
    places = [spark.createDataFrame([("p", "x")], f"TRI_CONTROL_NUMBER_CN string, {value} string") for value in ("TRI_ID_TX", *["TRI_PROPERTY_ID"] * 3)]
    companies = spark.createDataFrame([("C1", "NL"), ("C2", "DE")], "COMP_CODE string, COUNTRY string")
    people = spark.createDataFrame([("p", "Ada", "L")], "TRI_USER_NAME_TX string, TRI_FIRST_NAME_TX string, TRI_LAST_NAME_TX string")
    out = lease.curated_leases(leases, *places, companies, people)
    for columns in (["Country_Code", "Lease_Transaction_Id", "Company_Code"], ["Lease_Name", "PA_Validator_Name"], ["Brand_Name"]):
        some = lease.curated_leases(leases, *places, companies, people, columns=columns)
        assert some.columns == columns and rows(some) == rows(out, *columns)


def test_value_rules_keep_one_of_each_copy(spark):
    names = [c for c in lease.VALUE_RULE_NAMES.values() if c not in lease.OWNER]
    rule = lambda **v: tuple(v.get(c) for c in names)
    one = rule(TRI_ID_TX="r", TRI_CLAUSE_ID_TX="c", TRI_LEASE_ID_TX="1")
    rules = spark.createDataFrame([one, one, rule(TRI_ID_TX="r", TRI_CLAUSE_ID_TX="c"), rule(TRI_ID_TX="r"), rule(TRI_ID_TX="r", TRI_CLAUSE_ID_TX="no")], ", ".join(f"{c} string" for c in names))
    curated = spark.createDataFrame([("1", "NL", "C1"), ("1", "NL", "C1"), ("1", "DE", "C2"), (None, "FR", "C3")], "Lease_Transaction_Id string, Country_Code string, Company_Code string")
    clauses = spark.createDataFrame([("c", "x", "Active", 2), (None, "x", "Active", 2), ("no", "x", "Retired", 2)], "TRI_ID_TX string, TRI_CONTROL_NUMBER_CN string, TRI_STATUS_CL string, TRI_MODIFIED_DATE_SY int")
    got = lease.value_rules(rules, curated, clauses)
    assert rows(got, "Lease_Transaction_Id", "Country_Code") == [(None, None), ("1", "DE"), ("1", "NL")]
