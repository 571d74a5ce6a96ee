"""Lease curation, rent rules and the product mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitebooks.catalog.registry import plain_ts, query, table
from sitebooks.operators.quality import Steps
from sitebooks.plans import lease, product_map
from sitebooks.runtime import scratch_dir
from sitebooks.sources import sinks

_TIMES = [lease.LEASE_NAMES[n] for n in lease.LEASE_TIMESTAMPS if lease.LEASE_NAMES[n] != "TRI_MODIFIED_DATE_SY"]

# Orders stand in for lease versions: the customer is the lease, the order date
# the modification date, the key's parity the control number; status F = expense,
# O = income, P = another type.  Every other column holds its own name and the key.
_LEASE_SQL = """
v AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderkey % 2 ORDER BY o_orderdate DESC, o_orderkey DESC)
            AS rn FROM orders),
ld AS (
  SELECT CAST(o_custkey AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) AS ver,
         CASE o_orderstatus WHEN 'F' THEN 'Expense Lease' WHEN 'O' THEN 'Income Lease'
              ELSE 'Sub Lease' END AS type,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'PROP-' || CAST(o_orderkey AS VARCHAR) END AS prop,
         o_custkey % 40 AS loc, CAST(o_custkey % 25 AS VARCHAR) AS company,
         CAST(o_custkey AS VARCHAR) AS person, CAST(o_orderkey % 2 AS VARCHAR) AS ctrl, o_orderdate AS od, o_orderkey AS okey
  FROM v WHERE rn = 1),
lp AS (SELECT n_nationkey AS k, 'P' || n_name AS p FROM nation WHERE n_nationkey < 8),
lb AS (SELECT n_nationkey AS k, 'B' || n_name AS p FROM nation WHERE n_nationkey BETWEEN 5 AND 15),
ll AS (SELECT n_nationkey AS k, 'L' || n_name AS p FROM nation WHERE n_nationkey > 12),
ls AS (SELECT n_nationkey AS k, 'S' || n_name AS p FROM nation WHERE n_nationkey > 10),
placed AS (
  SELECT ld.*, coalesce(ld.prop, lp.p, lb.p, ll.p) AS place FROM ld
    LEFT JOIN lp ON loc = lp.k LEFT JOIN lb ON loc = lb.k LEFT JOIN ll ON loc = ll.k
    WHERE type = 'Expense Lease' AND prop IS NULL
  UNION ALL
  SELECT ld.*, coalesce(lb.p, ls.p) FROM ld
    LEFT JOIN lb ON loc = lb.k LEFT JOIN ls ON loc = ls.k
    WHERE type = 'Income Lease' AND prop IS NULL
  UNION ALL
  SELECT ld.*, prop FROM ld WHERE prop IS NOT NULL)
"""


def _leases(spark, sf_dir):
    od = table(spark, sf_dir, "orders")
    used = {
        "TRI_ID_TX": F.col("o_custkey").cast("string"),
        "TRI_CONTROL_NUMBER_CN": (F.col("o_orderkey") % 2).cast("string"),
        # Order key as the sub-second part: the modification time has no ties.
        "TRI_MODIFIED_DATE_SY": F.timestamp_micros(
            F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
        ),
        "TRI_LEASE_TYPE_CL": F.when(F.col("o_orderstatus") == "F", lease.EXPENSE)
        .when(F.col("o_orderstatus") == "O", lease.INCOME)
        .otherwise("Sub Lease"),
        "CST_PROPERTY_ID_TX": F.when(
            F.col("o_orderpriority").startswith("1"),
            F.concat(F.lit("PROP-"), F.col("o_orderkey").cast("string")),
        ),
        "CST_PREMISE_LOCATION_ID": (F.col("o_custkey") % 40).cast("string"),
        "TRI_BUSINESS_UNIT_ORG_TX": (F.col("o_custkey") % 25).cast("string"),
        "CST_PEOPLE_TX": F.col("o_custkey").cast("string"),
        "TRI_NAME_TX": F.col("o_orderkey").cast("string"),
        "TRI_STATUS_CL": F.lit("Active"),
    }
    for i, source in enumerate(_TIMES):
        used[source] = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(f" 0{i}:00:00"))
    rest = [s for s in lease.LEASE_NAMES.values() if s and s not in used and s != "COUNTRY"]
    filled = [F.concat(F.lit(f"{n}|"), F.col("o_orderkey").cast("string")).alias(n) for n in dict.fromkeys(rest)]
    return od.select(*[c.alias(n) for n, c in used.items()], *filled)


def _dimensions(spark, sf_dir):
    na = table(spark, sf_dir, "nation")

    def dim(test, letter, value):
        return na.where(test).select(
            F.col("n_nationkey").cast("string").alias("TRI_CONTROL_NUMBER_CN"),
            F.concat(F.lit(letter), "n_name").alias(value),
        )

    return (
        dim("n_nationkey < 8", "P", "TRI_ID_TX"),
        dim("n_nationkey BETWEEN 5 AND 15", "B", "TRI_PROPERTY_ID"),
        dim("n_nationkey > 12", "L", "TRI_PROPERTY_ID"),
        dim("n_nationkey > 10", "S", "TRI_PROPERTY_ID"),
    )


def _curated(spark, sf_dir, **options):
    companies = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("COMP_CODE"),
        F.when(F.col("n_nationkey") < 20, F.col("n_name")).otherwise(" ").alias("COUNTRY"),
    )
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("TRI_USER_NAME_TX"),
        F.col("c_mktsegment").alias("TRI_FIRST_NAME_TX"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("TRI_LAST_NAME_TX"),
    )
    return lease.curated_leases(
        _leases(spark, sf_dir), *_dimensions(spark, sf_dir), companies, people, **options
    )


@query(
    "branch_union_resolve",
    f"""WITH {_LEASE_SQL} SELECT id, type, place FROM placed""",
)
def branch_union_resolve(spark, sf_dir):
    """Property ids by lease type, in one pass instead of three unioned branches."""
    versions = _leases(spark, sf_dir)
    newest = lease.latest_by(
        versions, ["TRI_ID_TX", "TRI_CONTROL_NUMBER_CN"], [F.col("TRI_MODIFIED_DATE_SY").desc()]
    )
    return lease.resolve_property(newest, *_dimensions(spark, sf_dir)).select(
        F.col("TRI_ID_TX").alias("id"),
        F.col("TRI_LEASE_TYPE_CL").alias("type"),
        F.col("CST_PROPERTY_ID_TX").alias("place"),
    )


_CONTACT_SQL = "CASE WHEN c.c_acctbal > 0 THEN c.c_mktsegment || c.c_name END"
_LEASE_COLUMNS_SQL = {
    "Lease_Name": "ver", "Site_Id": "substring(place, 6, 15)", "DCH_Validator_Email_Id": "person",
    "Premise_Location_Id": "CAST(loc AS VARCHAR)", "Property_Id": "place", "Lease_Type_Code": "type",
    "Lease_Status_Code": "'Active'", "Company_Code": "company", "Country_Code": "n.n_name", "Control_Number": "ctrl",
    "Lease_Transaction_Id": "placed.id", "Source_Last_Modified_Date": "od + to_microseconds(okey)",
    **{n: _CONTACT_SQL for n, source in lease.LEASE_NAMES.items() if source is None and n != "Site_Id"},
    **{n: f"CAST(strftime(od, '%Y-%m-%d') || ' 0{_TIMES.index(s)}:00:00' AS TIMESTAMP)" for n, s in lease.LEASE_NAMES.items() if s in _TIMES},
}
_CURATED_SQL = ", ".join(
    f"{_LEASE_COLUMNS_SQL.get(n, chr(39) + str(s) + '|' + chr(39) + ' || CAST(okey AS VARCHAR)')} AS {n}" for n, s in lease.LEASE_NAMES.items()
)


@query(
    "curated_leases",
    f"""WITH {_LEASE_SQL}
        SELECT {_CURATED_SQL}
        FROM placed
        LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n
          ON placed.company = CAST(n.n_nationkey AS VARCHAR)
        LEFT JOIN customer c ON placed.person = CAST(c.c_custkey AS VARCHAR)""",
)
def curated_leases(spark, sf_dir):
    """All columns of the curated table but its load time."""
    out = _curated(spark, sf_dir).select(*lease.LEASE_NAMES)
    return out.withColumns({n: plain_ts(F.col(n)) for n in lease.LEASE_TIMESTAMPS})


@query(
    "curated_lease_steps",
    f"""WITH {_LEASE_SQL},
        full_rows AS (
          SELECT placed.*, n.n_name AS country, CASE WHEN c.c_acctbal > 0 THEN c.c_mktsegment || c.c_name END AS contact
          FROM placed
          LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON placed.company = CAST(n.n_nationkey AS VARCHAR)
          LEFT JOIN customer c ON placed.person = CAST(c.c_custkey AS VARCHAR))
        SELECT 1 AS step_no, 'versions' AS step, count(*) AS rows, 'TRI_ID_TX' AS key,
               count(*) FILTER (WHERE o_custkey IS NULL) AS without_key, CAST(NULL AS BIGINT) AS unreadable FROM orders
        UNION ALL SELECT 2, 'newest', count(*), 'CST_PROPERTY_ID_TX', count(*) FILTER (WHERE prop IS NULL), NULL FROM ld
        UNION ALL SELECT 3, 'property', count(*), 'CST_PROPERTY_ID_TX', count(*) FILTER (WHERE place IS NULL), NULL FROM placed
        UNION ALL SELECT 4, 'country', count(*), 'COUNTRY', count(*) FILTER (WHERE country IS NULL), NULL FROM full_rows
        UNION ALL SELECT 5, 'contact', count(*), '_contact', count(*) FILTER (WHERE contact IS NULL), NULL FROM full_rows""",
)
def curated_lease_steps(spark, sf_dir):
    """Rows behind each step of the lease job and those without the key it looks up, from the run that writes the table."""
    steps = Steps()
    sinks.write_files(_curated(spark, sf_dir, watch=steps.watch), scratch_dir(spark, "curated"))
    return steps.frame(spark)


def _clauses(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("TRI_ID_TX"),
        F.lit("1").alias("TRI_CONTROL_NUMBER_CN"),
        F.col("p_size").alias("TRI_MODIFIED_DATE_SY"),
        F.when(F.col("p_size") < 20, "Active")
        .when(F.col("p_size") < 30, "active")
        .otherwise("Retired")
        .alias("TRI_STATUS_CL"),
    )


def _rules(spark, sf_dir, names):
    li = table(spark, sf_dir, "lineitem")
    used = {
        "TRI_CLAUSE_ID_TX": F.col("l_partkey").cast("string"),
        "TRI_SALES_CATEGORY_CL": F.col("l_returnflag"),
        "CST_MIN_AMOUNT_NU": F.col("l_extendedprice"),
        "TRI_LEASE_ID_TX": F.col("l_suppkey").cast("string"),
        "TRI_ID_TX": F.col("l_orderkey").cast("string"),
        "TRI_MODIFIED_DATE_SY": F.col("l_shipdate"),
    }
    rest = [s for s in names.values() if s not in used and s not in ("Country_Code", "Company_Code")]
    filled = [F.concat(F.lit(f"{n}|"), F.col("l_partkey").cast("string"), "l_returnflag").alias(n) for n in rest]
    return li.select(*[c.alias(n) for n, c in used.items()], *filled)


def _rules_sql(names, used, source):
    """The columns of a rule table: those in ``used``, the others by name, part and flag as in ``_rules``."""
    own = lambda s: f"'{s}|' || CAST({source}l_partkey AS VARCHAR) || {source}l_returnflag"
    return ", ".join(f"{used.get(n, own(s))} AS {n}" for n, s in names.items())


def _rule_keys(source):
    return {
        "Transaction_Id": f"CAST({source}l_orderkey AS VARCHAR)", "Lease_Clause_Legacy_Id": f"CAST({source}l_partkey AS VARCHAR)",
        "Sales_Category": f"{source}l_returnflag", "Lease_Transaction_Id": f"CAST({source}l_suppkey AS VARCHAR)",
        "Source_Last_Modified_Date": f"CAST({source}l_shipdate AS DATE)", "Company_Code": "owner.company", "Country_Code": "owner.country",
    }


# What rules read of the curated leases.
_OWNER_COLUMNS = ("Lease_Transaction_Id", *lease.OWNER)

_OWNER_SQL = f"""
{_LEASE_SQL},
owner AS (
  SELECT DISTINCT placed.id, placed.company, n.n_name AS country FROM placed
  LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n
    ON placed.company = CAST(n.n_nationkey AS VARCHAR))"""


@query(
    "quantity_rules",
    f"""WITH {_OWNER_SQL},
        one AS (SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
                      CAST(l_partkey AS VARCHAR), l_returnflag, l_extendedprice,
                      CAST(l_suppkey AS VARCHAR)) AS rank_no FROM lineitem) WHERE rank_no = 1)
        SELECT {_rules_sql(lease.QUANTITY_RULE_NAMES, {"Min_LC_Amount": "one.l_extendedprice", **_rule_keys("one.")}, "one.")}
        FROM one JOIN part ON one.l_partkey = p_partkey AND p_size < 20
        LEFT JOIN owner ON owner.id = CAST(one.l_suppkey AS VARCHAR)""",
)
def quantity_rules(spark, sf_dir):
    """The newest version of each rule; equal dates are settled by the other columns."""
    rules = _rules(spark, sf_dir, lease.QUANTITY_RULE_NAMES)
    out = lease.quantity_rules(rules, _curated(spark, sf_dir, columns=_OWNER_COLUMNS), _clauses(spark, sf_dir))
    out = out.select(*lease.QUANTITY_RULE_NAMES)
    return out.withColumn("Source_Last_Modified_Date", F.to_date("Source_Last_Modified_Date"))


@query(
    "value_rules",
    f"""WITH {_OWNER_SQL}
        SELECT DISTINCT {_rules_sql(lease.VALUE_RULE_NAMES, {"Custom_Min_LC_Amount": "l_extendedprice", **_rule_keys("")}, "")}
        FROM lineitem JOIN part ON l_partkey = p_partkey AND p_size < 20
        LEFT JOIN owner ON owner.id = CAST(l_suppkey AS VARCHAR)""",
)
def value_rules(spark, sf_dir):
    rules = _rules(spark, sf_dir, lease.VALUE_RULE_NAMES)
    out = lease.value_rules(rules, _curated(spark, sf_dir, columns=_OWNER_COLUMNS), _clauses(spark, sf_dir))
    out = out.select(*lease.VALUE_RULE_NAMES)
    return out.withColumn("Source_Last_Modified_Date", F.to_date("Source_Last_Modified_Date"))


@query(
    "product_mapping",
    """WITH m AS (
         SELECT p_brand || '2024' || '01' || p_type || CAST(p_size AS VARCHAR) || 'F' AS id,
                p_name, DATE '2024-01-01' AS loaded FROM part
         UNION ALL
         SELECT p_brand || '2024' || '01' || p_type || CAST(p_size AS VARCHAR) || 'F',
                p_name || ' new', DATE '2024-02-01' FROM part WHERE p_size > 40)
       SELECT id AS Product_Sales_Category_Id, p_name AS Product_Group_Name, loaded AS loaded_on
       FROM (SELECT *, dense_rank() OVER (PARTITION BY id ORDER BY loaded DESC) AS r FROM m)
       WHERE r = 1""",
)
def product_mapping(spark, sf_dir):
    """A second load of the large sizes replaces theirs; equally new rows stay."""
    part = table(spark, sf_dir, "part")

    def raw(df, suffix):
        return df.select(
            F.col("p_brand").alias("Country_Code"), F.lit("2024").alias("Calendar_Year"),
            F.lit("01").alias("Calendar_Month"), F.col("p_type").alias("Sales_Category"),
            F.col("p_size").cast("string").alias("Product_Group_Code"),
            F.concat("p_name", F.lit(suffix)).alias("Product_Group_Name"),
            F.lit("F").alias("Product_Family_Code"), F.lit("Fuel").alias("Product_Family_Name"),
        )

    def at(day):
        return F.to_timestamp(F.lit(day))

    old = product_map.keyed_mapping(raw(part, ""), at("2024-01-01"))
    new = product_map.keyed_mapping(raw(part.where("p_size > 40"), " new"), at("2024-02-01"))
    return product_map.merge_mapping(old, new).select(
        "Product_Sales_Category_Id", "Product_Group_Name", F.to_date("CREATE_DATE").alias("loaded_on")
    )
