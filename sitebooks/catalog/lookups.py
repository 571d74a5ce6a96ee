"""Joins, cascading lookups and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitebooks.catalog.registry import plain_ts, query, table
from sitebooks.operators import joins, sets
from sitebooks.operators.intervals import match_nearest, open_counts

HALF_DAY = 12 * 3600


@query(
    "enrich_inner_left",
    """SELECT o.o_orderkey, c.c_mktsegment, n.n_name
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n
         ON c.c_nationkey = n.n_nationkey""",
)
def enrich_inner_left(spark, sf_dir):
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    na = table(spark, sf_dir, "nation").where("n_regionkey <> 2")
    return (
        od.join(cu, od.o_custkey == cu.c_custkey)
        .join(na, cu.c_nationkey == na.n_nationkey, "left")
        .select("o_orderkey", "c_mktsegment", "n_name")
    )


@query(
    "trimmed_key_join",
    """SELECT c.c_custkey, n.n_name
       FROM (SELECT c_custkey, '  ' || CAST(c_nationkey AS VARCHAR) || ' ' AS k FROM customer) c
       LEFT JOIN (SELECT n_name, CAST(n_nationkey AS VARCHAR) || '   ' AS k FROM nation) n
         ON trim(c.k) = trim(n.k)""",
)
def trimmed_key_join(spark, sf_dir):
    cu = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("  "), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("k")
    )
    na = table(spark, sf_dir, "nation").select(
        F.concat(F.col("n_nationkey").cast("string"), F.lit("   ")).alias("nk"), "n_name"
    )
    return joins.lookup(cu, na, {"k": "nk"}, {"n_name": "n_name"}, trim=True).select(
        "c_custkey", "n_name"
    )


@query(
    "left_using_country",
    """SELECT s.s_nationkey, s.s_suppkey, n.country
       FROM supplier s LEFT JOIN (
         SELECT DISTINCT n_nationkey AS s_nationkey, n_name AS country FROM nation
         WHERE n_name IS NOT NULL AND trim(n_name) <> '' AND n_nationkey < 20) n
       USING (s_nationkey)""",
)
def left_using_country(spark, sf_dir):
    from sitebooks.plans.assets import company_countries

    na = table(spark, sf_dir, "nation").where("n_nationkey < 20")
    pairs = company_countries(na, "n_nationkey", "n_name").toDF("s_nationkey", "country")
    return (
        table(spark, sf_dir, "supplier")
        .select("s_nationkey", "s_suppkey")
        .join(pairs, ["s_nationkey"], "left")
    )


@query(
    "right_outer",
    """SELECT c.c_custkey, o.o_orderkey FROM orders o RIGHT JOIN customer c
       ON o.o_custkey = c.c_custkey""",
)
def right_outer(spark, sf_dir):
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey")
    return od.join(cu, od.o_custkey == cu.c_custkey, "right").select("c_custkey", "o_orderkey")


@query(
    "map_values_lookup",
    """SELECT o.o_orderkey, coalesce(c.seg, CAST(o.o_custkey AS VARCHAR)) AS segment
       FROM orders o LEFT JOIN (
         SELECT CAST(c_custkey AS VARCHAR) AS k, max(c_mktsegment) AS seg FROM customer
         WHERE c_acctbal > 0 GROUP BY 1) c ON CAST(o.o_custkey AS VARCHAR) = c.k""",
)
def map_values_lookup(spark, sf_dir):
    pairs = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("k"), "c_mktsegment"
    )
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("segment")
    )
    return joins.map_values(od, "segment", pairs, "k", "c_mktsegment")


@query(
    "coalesce_lookup",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
              coalesce(CASE WHEN l.l_discount = 0 THEN 'none' END, p.v, s.v, n.v) AS place
       FROM lineitem l
       LEFT JOIN (SELECT p_partkey AS k, min(p_brand) AS v FROM part WHERE p_size < 10 GROUP BY 1) p
         ON l.l_partkey = p.k
       LEFT JOIN (SELECT s_suppkey AS k, min(s_name) AS v FROM supplier WHERE s_acctbal > 0
                  GROUP BY 1) s ON l.l_suppkey = s.k
       LEFT JOIN (SELECT n_nationkey AS k, min(n_name) AS v FROM nation GROUP BY 1) n
         ON l.l_linenumber = n.k""",
)
def coalesce_lookup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount"
    )
    out = joins.coalesce_lookup(
        li,
        "place",
        F.when(F.col("l_discount") == 0, "none"),
        [
            (table(spark, sf_dir, "part").where("p_size < 10"), "l_partkey", "p_partkey", "p_brand"),
            (table(spark, sf_dir, "supplier").where("s_acctbal > 0"), "l_suppkey", "s_suppkey", "s_name"),
            (table(spark, sf_dir, "nation"), "l_linenumber", "n_nationkey", "n_name"),
        ],
    )
    return out.drop("l_discount")


@query(
    "tolerance_match",
    """WITH pairs AS (
         SELECT c.event_id, p.ts AS matched_at,
                row_number() OVER (PARTITION BY c.event_id ORDER BY
                  abs(epoch_us(c.ts) - epoch_us(p.ts)), p.ts) AS rn
         FROM events c JOIN events p ON c.user_id = p.user_id
         WHERE c.event_type <> 'purchase' AND p.event_type = 'purchase'
           AND c.ts BETWEEN p.ts - INTERVAL 12 HOUR AND p.ts + INTERVAL 12 HOUR)
       SELECT event_id, matched_at FROM pairs WHERE rn = 1""",
)
def tolerance_match(spark, sf_dir):
    """Nearest purchase of the same user within twelve hours of another event."""
    return _nearest(spark, sf_dir).where("matched_at IS NOT NULL").select(
        "event_id", plain_ts(F.col("matched_at")).alias("matched_at")
    )


@query(
    "tolerance_unmatched",
    """SELECT c.event_id, c.ts + INTERVAL 3 MINUTE AS shifted FROM events c
       WHERE c.event_type <> 'purchase' AND NOT EXISTS (
         SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = c.user_id
           AND c.ts BETWEEN p.ts - INTERVAL 12 HOUR AND p.ts + INTERVAL 12 HOUR)""",
)
def tolerance_unmatched(spark, sf_dir):
    return _nearest(spark, sf_dir).where("matched_at IS NULL").select(
        "event_id", plain_ts(F.expr("at + INTERVAL 3 MINUTES")).alias("shifted")
    )


def _nearest(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    others = ev.where("event_type <> 'purchase'").select("event_id", "user_id", at.alias("at"))
    buys = ev.where("event_type = 'purchase'").select("user_id", at.alias("bought"))
    return match_nearest(others, buys, ["user_id"], "at", "bought", HALF_DAY)


@query(
    "tolerance_candidates",
    """SELECT c.event_id, (SELECT count(*) FROM events p WHERE p.event_type = 'purchase'
                AND p.user_id = c.user_id
                AND c.ts BETWEEN p.ts - INTERVAL 12 HOUR AND p.ts + INTERVAL 12 HOUR) AS candidates
       FROM events c WHERE c.event_type <> 'purchase'""",
)
def tolerance_candidates(spark, sf_dir):
    """How many purchases lie within twelve hours of another event, counted without pairing.

    A purchase is within reach exactly while the interval around it is open; an
    interval opens after its start, so the start is put one microsecond earlier.
    """
    ev = table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    others = ev.where("event_type <> 'purchase'").select("event_id", "user_id", at.alias("at"))
    reach = F.make_dt_interval(hours=F.lit(12))
    around = ev.where("event_type = 'purchase'").select(
        "user_id",
        (at - reach - F.make_dt_interval(secs=F.lit(0.000001))).alias("opens"),
        (at + reach).alias("closes"),
        F.lit(1).alias("one"),
    )
    return open_counts(
        others, around, ["user_id"], "at", "opens", "closes", {"candidates": "one"}, HALF_DAY
    ).select("event_id", "candidates")


@query(
    "anti_union_split",
    """SELECT l_orderkey, l_partkey, l_quantity, 'matched' AS kind FROM lineitem
       WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25)
       UNION ALL
       SELECT l_orderkey, l_partkey, l_quantity + 1, 'unmatched' FROM lineitem
       WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25)""",
)
def anti_union_split(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    big = table(spark, sf_dir, "part").where("p_size > 25").select("p_partkey")
    on = li.l_partkey == big.p_partkey
    hit = li.join(big, on, "left_semi").withColumn("kind", F.lit("matched"))
    miss = li.join(big, on, "left_anti").select(
        "l_orderkey", "l_partkey", (F.col("l_quantity") + 1).alias("l_quantity"),
        F.lit("unmatched").alias("kind"),
    )
    return sets.union_all([hit, miss])


@query(
    "feed_union_by_name",
    """SELECT CAST(o_orderkey AS VARCHAR) AS code, o_totalprice AS amount,
              CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS priority
       FROM orders""",
)
def feed_union_by_name(spark, sf_dir):
    """Country branches with different column order and type, one column missing."""
    from pyspark.sql.types import StructType

    from sitebooks.plans.feeds import combine

    od = table(spark, sf_dir, "orders")
    target = StructType.fromDDL("code string, amount double, priority string")
    names = {"o_orderkey": "code", "o_totalprice": "amount", "o_orderpriority": "priority"}
    return combine(
        [
            od.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"),
            od.where("o_orderstatus = 'O'").select("o_orderpriority", "o_totalprice", "o_orderkey"),
            od.where("o_orderstatus = 'P'").select(
                F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderpriority", "o_totalprice"
            ),
        ],
        target,
        names,
    )


@query(
    "union_distinct",
    """SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier""",
)
def union_distinct(spark, sf_dir):
    return sets.union_distinct(
        [
            table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")),
            table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")),
        ]
    )


@query(
    "many_unions",
    """SELECT o_orderpriority AS branch, o_orderkey FROM orders""",
)
def many_unions(spark, sf_dir):
    od = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    # The last branch is the complement of the others, so no priority is lost.
    branches = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
    named = [od.where(F.col("o_orderpriority") == b) for b in branches]
    other = od.where(~F.coalesce(F.col("o_orderpriority").isin(branches), F.lit(False)))
    return sets.union_all(
        [f.select(F.col("o_orderpriority").alias("branch"), "o_orderkey") for f in [*named, other]]
    )
