"""Pump utilisation: relevance, ongoing transactions and dispenser sizing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sitebooks.catalog.registry import TX_MARKERS, TX_SQL, plain_ts, query, table, tx
from sitebooks.operators.joins import overlap_join, tolerance_join
from sitebooks.operators.quality import Steps
from sitebooks.plans import matching, pumps, sizing
from sitebooks.runtime import scratch_dir
from sitebooks.sources import sinks

# The same steps as SQL: pump set per grade, product class, then the overlap
# self-join that the Spark job replaces by a sweep.
_RELEVANT_SQL = f"""{TX_SQL},
flagged AS (
  SELECT *, CASE WHEN regexp_matches(info, '(?i)purchase-1|error') THEN info
                 ELSE 'Mogas / non-truck diesel' END AS flag FROM tx),
sets AS (SELECT site, info, product, list_sort(list(DISTINCT pump)) AS pumps
         FROM flagged GROUP BY 1, 2, 3),
nflag AS (SELECT site, flag, count(DISTINCT pump) AS n_flag FROM flagged GROUP BY 1, 2),
rel AS (
  SELECT f.*, s.pumps, len(s.pumps) AS n_pumps, n.n_flag,
         sum(qty) OVER (PARTITION BY f.site) AS site_vol,
         count(*) OVER (PARTITION BY f.site) AS site_txn,
         sum(qty) OVER (PARTITION BY f.site, f.product) AS grade_vol,
         count(*) OVER (PARTITION BY f.site, f.product) AS grade_txn,
         sum(qty) OVER (PARTITION BY f.site, s.pumps) AS set_vol,
         count(*) OVER (PARTITION BY f.site, s.pumps) AS set_txn,
         sum(qty) OVER (PARTITION BY f.site, f.flag) AS flag_vol,
         count(*) OVER (PARTITION BY f.site, f.flag) AS flag_txn,
         sum(qty) OVER (PARTITION BY f.site, f.product, s.pumps, f.flag) AS combo_vol,
         count(*) OVER (PARTITION BY f.site, f.product, s.pumps, f.flag) AS combo_txn
  FROM flagged f JOIN sets s ON f.site = s.site AND f.info = s.info AND f.product = s.product
  JOIN nflag n ON f.site = n.site AND f.flag = n.flag)"""
_ONGOING_SQL = f"""{_RELEVANT_SQL},
seen AS (
  SELECT a.event_id,
         count(*) FILTER (WHERE list_contains(a.pumps, b.pump)) AS act,
         count(*) FILTER (WHERE list_has_any(a.pumps, b.pumps)) AS pot,
         count(*) FILTER (WHERE a.flag = b.flag) AS comb
  FROM rel a JOIN rel b ON a.country = b.country AND a.site = b.site
    AND b.start_ts < a.start_ts AND b.end_ts >= a.start_ts
  GROUP BY 1),
ongoing AS (
  SELECT rel.*, CAST(coalesce(act, 0) AS BIGINT) AS act, CAST(coalesce(pot, 0) AS BIGINT) AS pot,
         CAST(coalesce(comb, 0) AS BIGINT) AS comb
  FROM rel LEFT JOIN seen USING (event_id))"""
_SERVED_SQL = f"""{_ONGOING_SQL},
peak AS (SELECT site, max(pot) + 1 AS d_max FROM ongoing GROUP BY 1),
d AS (SELECT site, CAST(unnest(range(1, d_max + 1)) AS INTEGER) AS d FROM peak),
scen AS (SELECT o.*, d.d FROM ongoing o JOIN d ON o.site = d.site)"""


def _relevant(rows):
    return pumps.with_relevance(rows, pumps.grade_profiles(rows, TX_MARKERS))


_COUNTING = ("transactionStartTime", "transactionEndTime", "lanes", "asks")


def _ongoing(spark, sf_dir, columns=sizing.INPUT):
    """Counts of transactions open at each start."""
    rows = tx(spark, sf_dir)
    return pumps.ongoing_counts(_relevant(rows).select(*columns, *_COUNTING))


def _set_text(df):
    return df.withColumn("relevant_pumps", F.array_join("relevant_pumps", ","))


def _plain(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query(
    "pump_sets",
    f"""WITH {_RELEVANT_SQL}
        SELECT event_id, row_number() OVER (ORDER BY site, start_ts, event_id) AS txn_id,
               array_to_string(pumps, ',') AS relevant_pumps,
               CAST(n_pumps AS INTEGER) AS n_pumps, flag, CAST(n_flag AS INTEGER) AS n_flag_pumps,
               CAST(combo_vol AS DOUBLE) AS quantity_sum, combo_txn AS txn_count,
               CAST(site_vol AS DOUBLE) AS site_vol, site_txn,
               CAST(grade_vol AS DOUBLE) AS grade_vol, grade_txn,
               CAST(set_vol AS DOUBLE) AS set_vol, set_txn,
               CAST(flag_vol AS DOUBLE) AS flag_vol, flag_txn
        FROM rel""",
)
def pump_sets(spark, sf_dir):
    """Every transaction with its number, the pumps of its grade and all volume totals."""
    rows = pumps.with_transaction_id(tx(spark, sf_dir), ["event_id"])
    out = _set_text(_relevant(rows)).select(
        "event_id", "txn_id", "relevant_pumps", F.col("number_of_relevant_pumps").alias("n_pumps"),
        F.col(pumps.FLAG).alias("flag"), F.col(pumps.FLAG_PUMPS).alias("n_flag_pumps"),
        "quantity_sum", "txn_count", "site_vol", "site_txn", "grade_vol", "grade_txn",
        F.col("relevant_pumps_vol").alias("set_vol"), F.col("relevant_pumps_txn").alias("set_txn"),
        F.col("relevant_pumps_vol_mogas_diesel_aggregated").alias("flag_vol"),
        F.col("relevant_pumps_txn_mogas_diesel_aggregated").alias("flag_txn"),
    )
    return _plain(out, "quantity_sum", "site_vol", "grade_vol", "set_vol", "flag_vol")


@query(
    "pump_sets_mixed_grades",
    f"""WITH {_RELEVANT_SQL}
        SELECT rel.event_id, array_to_string(s.pumps, ',') AS relevant_pumps
        FROM rel LEFT JOIN sets s ON rel.site = s.site AND rel.product = s.product""",
)
def pump_sets_mixed_grades(spark, sf_dir):
    """Pump sets joined by product code alone, so several product texts repeat rows."""
    rows = tx(spark, sf_dir)
    profiles = pumps.grade_profiles(rows, TX_MARKERS)
    out = pumps.with_relevance(rows, profiles, mix_grades=True)
    return _set_text(out).select("event_id", "relevant_pumps")


@query(
    "pump_summary",
    f"""WITH {TX_SQL}
        SELECT tx.site AS GlobalSiteId, info AS additionalProductInfo, product AS productCode,
               pump AS pumpNumber, CAST(sum(qty) AS DOUBLE) AS Transaction_Vol,
               count(*) AS Transaction_Count, m.terr AS TERRITORY_NAME
        FROM tx LEFT JOIN (SELECT DISTINCT country, site, 'T' || substr(site, 2, 1) AS terr
                           FROM tx WHERE substr(site, 2, 1) < '5') m
          ON tx.country = m.country AND tx.site = m.site
        GROUP BY 1, 2, 3, 4, 7""",
)
def pump_summary(spark, sf_dir):
    rows = tx(spark, sf_dir)
    digit = F.substring("GlobalSiteId", 2, 1)
    master = rows.where(digit < "5").select(
        F.col("PartitionKey").alias("COUNTRY_CODE"), F.col("GlobalSiteId").alias("GLOBAL_SITE_ID"),
        F.concat(F.lit("T"), digit).alias("TERRITORY_NAME"),
        F.lit("platform").alias("OPERATING_PLATFORM_NAME"),
    )
    out = pumps.pump_summary(rows, master).select(
        "GlobalSiteId", "additionalProductInfo", "productCode", "pumpNumber", "Transaction_Vol",
        "Transaction_Count", "TERRITORY_NAME",
    )
    return _plain(out, "Transaction_Vol")


@query(
    "ongoing_counts",
    f"""WITH {_ONGOING_SQL}
        SELECT event_id, start_ts, act AS txn_ongoing_actual, pot AS txn_ongoing_potential,
               comb AS txn_ongoing_mogas_diesel_combined FROM ongoing""",
)
def ongoing_counts(spark, sf_dir):
    return _ongoing(spark, sf_dir, ["PartitionKey", "GlobalSiteId", "event_id"]).select(
        "event_id", plain_ts(F.col("transactionStartTime")).alias("start_ts"), *pumps.COUNTS
    )


@query(
    "served_or_waiting",
    f"""WITH {_SERVED_SQL}
        SELECT site AS GlobalSiteId, array_to_string(pumps, ',') AS relevant_pumps,
               d AS If_the_site_has_x_dispensers,
               CASE WHEN pot < d THEN 'immediately_served' ELSE 'waiting' END
                 AS immediately_served_or_waiting,
               CAST(sum(qty) AS DOUBLE) AS volume, count(*) AS number_of_txn,
               CAST(sum(qty) AS DOUBLE) * 100.0::DOUBLE / CAST(set_vol AS DOUBLE) AS Perc_of_relevant_vol,
               CAST(count(*) AS DOUBLE) * 100.0::DOUBLE / CAST(set_txn AS DOUBLE) AS Perc_of_relevant_txn,
               CAST(sum(qty) AS DOUBLE) * 100.0::DOUBLE / CAST(site_vol AS DOUBLE) AS Perc_of_site_vol,
               CAST(count(*) AS DOUBLE) * 100.0::DOUBLE / CAST(site_txn AS DOUBLE) AS Perc_of_site_txn
        FROM scen GROUP BY 1, 2, 3, 4, set_vol, set_txn, site_vol, site_txn""",
)
def served_or_waiting(spark, sf_dir):
    hist = sizing.histogram(_ongoing(spark, sf_dir), sizing.PUMP_SET)
    out = _set_text(sizing.served_or_waiting(hist, sizing.PUMP_SET)).select(
        "GlobalSiteId", "relevant_pumps", sizing.DISPENSERS, sizing.STATE, "volume",
        "number_of_txn", "Perc_of_relevant_vol", "Perc_of_relevant_txn", "Perc_of_site_vol",
        "Perc_of_site_txn",
    )
    return _plain(out, "volume")


@query(
    "served_by_class",
    f"""WITH {_SERVED_SQL}
        SELECT site AS GlobalSiteId, flag, d AS If_the_site_has_x_dispensers,
               CASE WHEN comb < d THEN 'immediately_served' ELSE 'waiting' END
                 AS immediately_served_or_waiting,
               CAST(sum(qty) AS DOUBLE) AS volume, count(*) AS number_of_txn,
               CAST(sum(qty) AS DOUBLE) * 100.0::DOUBLE / CAST(flag_vol AS DOUBLE) AS Perc_of_relevant_vol
        FROM scen GROUP BY 1, 2, 3, 4, flag_vol""",
)
def served_by_class(spark, sf_dir):
    grain = sizing.PRODUCT_CLASS
    hist = sizing.histogram(_ongoing(spark, sf_dir), grain)
    out = sizing.served_or_waiting(hist, grain).select(
        "GlobalSiteId", F.col(pumps.FLAG).alias("flag"), sizing.DISPENSERS, sizing.STATE, "volume",
        "number_of_txn", "Perc_of_relevant_vol",
    )
    return _plain(out, "volume")


@query(
    "served_by_grade",
    f"""WITH {_SERVED_SQL}
        SELECT site AS GlobalSiteId, info AS additionalProductInfo, product AS productCode,
               d AS If_the_site_has_x_dispensers,
               CASE WHEN pot < d THEN 'immediately_served' ELSE 'waiting' END
                 AS immediately_served_or_waiting,
               CAST(sum(qty) AS DOUBLE) AS volume, count(*) AS number_of_txn,
               CAST(sum(qty) AS DOUBLE) * 100.0::DOUBLE / CAST(grade_vol AS DOUBLE) AS Perc_of_grade_vol
        FROM scen GROUP BY 1, 2, 3, 4, 5, grade_vol""",
)
def served_by_grade(spark, sf_dir):
    grain = sizing.PRODUCT_GRADE
    hist = sizing.histogram(_ongoing(spark, sf_dir), grain)
    out = sizing.served_or_waiting(hist, grain).select(
        "GlobalSiteId", "additionalProductInfo", "productCode", sizing.DISPENSERS, sizing.STATE,
        "volume", "number_of_txn", "Perc_of_grade_vol",
    )
    return _plain(out, "volume")


_QUEUE_SQL = f"""{_SERVED_SQL},
q AS (
  SELECT site, pumps, n_pumps, d, greatest(pot + 1 - d, 0) AS ql, sum(qty) AS volume,
         count(*) AS n, set_vol, set_txn
  FROM scen GROUP BY site, pumps, n_pumps, d, greatest(pot + 1 - d, 0), set_vol, set_txn),
qc AS (
  SELECT *, sum(volume) OVER w AS cum_vol, CAST(sum(n) OVER w AS BIGINT) AS cum_txn FROM q
  WINDOW w AS (PARTITION BY site, pumps, d ORDER BY ql
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query(
    "queue_cumulative",
    f"""WITH {_QUEUE_SQL}
        SELECT site AS GlobalSiteId, array_to_string(pumps, ',') AS relevant_pumps,
               d AS If_the_site_has_x_dispensers, CAST(ql AS INTEGER) AS queue_length,
               CAST(volume AS DOUBLE) AS volume, n AS number_of_txn,
               CAST(cum_vol AS DOUBLE) AS cum_vol, cum_txn,
               CAST(cum_vol AS DOUBLE) * 100.0::DOUBLE / CAST(set_vol AS DOUBLE)
                 AS cum_vol_Perc_of_relevant_vol,
               CAST(cum_txn AS DOUBLE) * 100.0::DOUBLE / CAST(set_txn AS DOUBLE)
                 AS cum_txn_Perc_of_relevant_txn
        FROM qc""",
)
def queue_cumulative(spark, sf_dir):
    hist = sizing.histogram(_ongoing(spark, sf_dir), sizing.PUMP_SET)
    out = _set_text(sizing.queue_lengths(hist, sizing.PUMP_SET)).select(
        "GlobalSiteId", "relevant_pumps", sizing.DISPENSERS, "queue_length", "volume",
        "number_of_txn", "cum_vol", "cum_txn", "cum_vol_Perc_of_relevant_vol",
        "cum_txn_Perc_of_relevant_txn",
    )
    return _plain(out, "volume", "cum_vol")


_LEVELS_SQL = "(SELECT unnest([99.5, 98, 95, 90, 85, 80, 75])::DOUBLE AS threshold)"


def _needed_sql(source: str, keys: str, pct: str, available: str) -> str:
    """Rank by share, find the first rank reaching the level, count ranks up to it."""
    return f"""
ranked AS (SELECT {keys}, {available}, {pct} AS pct, d,
                  row_number() OVER (PARTITION BY {keys} ORDER BY {pct}, d) AS rk FROM {source}),
lev AS (SELECT * FROM ranked CROSS JOIN {_LEVELS_SQL}),
cut AS (SELECT *, min(CASE WHEN pct >= threshold THEN rk END)
                    OVER (PARTITION BY {keys}, threshold) AS cut_rank FROM lev),
flags AS (SELECT *, CASE WHEN rk <= cut_rank THEN 1 ELSE 0 END AS flag1 FROM cut)"""


_SET_SERVED_SQL = f"""{_SERVED_SQL},
srv AS (SELECT site, pumps, n_pumps, d,
               CAST(sum(qty) AS DOUBLE) * 100.0::DOUBLE / CAST(set_vol AS DOUBLE) AS pct0
        FROM scen WHERE pot < d GROUP BY site, pumps, n_pumps, d, set_vol)"""


@query(
    "dispensers_needed",
    f"""WITH {_SET_SERVED_SQL}, {_needed_sql('srv', 'site, pumps', 'pct0', 'n_pumps')}
        SELECT site AS GlobalSiteId, array_to_string(pumps, ',') AS relevant_pumps, threshold,
               CAST(sum(flag1) AS BIGINT) AS needed,
               CAST(max(n_pumps) - sum(flag1) AS BIGINT) AS freeable
        FROM flags GROUP BY 1, 2, 3""",
)
def dispensers_needed(spark, sf_dir):
    """Dispensers each pump set needs per service level, and how many could be freed."""
    hist = sizing.histogram(_ongoing(spark, sf_dir), sizing.PUMP_SET)
    return _set_text(sizing.dispensers_needed(hist, sizing.PUMP_SET)).select(
        "GlobalSiteId", "relevant_pumps", "threshold", "needed", "freeable"
    )


@query(
    "threshold_flags",
    f"""WITH {_SET_SERVED_SQL}, {_needed_sql('srv', 'site, pumps', 'pct0', 'n_pumps')}
        SELECT site AS GlobalSiteId, array_to_string(pumps, ',') AS relevant_pumps,
               d AS If_the_site_has_x_dispensers, threshold, CAST(flag1 AS INTEGER) AS Dispenser_needed
        FROM flags""",
)
def threshold_flags(spark, sf_dir):
    hist = sizing.histogram(_ongoing(spark, sf_dir), sizing.PUMP_SET)
    return _set_text(sizing.served_detail(hist, sizing.PUMP_SET)).select(
        "GlobalSiteId", "relevant_pumps", sizing.DISPENSERS, "threshold", "Dispenser_needed"
    )


@query(
    "dispensers_needed_by_queue",
    f"""WITH {_QUEUE_SQL},
        qs AS (SELECT site, pumps, n_pumps, ql, d,
                 CAST(cum_vol AS DOUBLE) * 100.0::DOUBLE / CAST(set_vol AS DOUBLE) AS pct0 FROM qc),
        {_needed_sql('qs', 'site, pumps, ql', 'pct0', 'n_pumps')}
        SELECT site AS GlobalSiteId, array_to_string(pumps, ',') AS relevant_pumps,
               CAST(ql AS INTEGER) AS queue_length, threshold, CAST(sum(flag1) AS BIGINT) AS needed,
               CAST(max(n_pumps) - sum(flag1) AS BIGINT) AS freeable
        FROM flags GROUP BY 1, 2, 3, 4""",
)
def dispensers_needed_by_queue(spark, sf_dir):
    hist = sizing.histogram(_ongoing(spark, sf_dir), sizing.PUMP_SET)
    return _set_text(sizing.dispensers_needed_by_queue(hist, sizing.PUMP_SET)).select(
        "GlobalSiteId", "relevant_pumps", "queue_length", "threshold", "needed", "freeable"
    )


@query(
    "dispensers_needed_by_class",
    f"""WITH {_SERVED_SQL},
        srv AS (SELECT site, flag, n_flag, d,
                 CAST(sum(qty) AS DOUBLE) * 100.0::DOUBLE / CAST(flag_vol AS DOUBLE) AS pct0
                FROM scen WHERE comb < d GROUP BY site, flag, n_flag, d, flag_vol),
        {_needed_sql('srv', 'site, flag', 'pct0', 'n_flag')}
        SELECT site AS GlobalSiteId, flag, threshold, CAST(sum(flag1) AS BIGINT) AS needed,
               CAST(max(n_flag) - sum(flag1) AS BIGINT) AS freeable
        FROM flags GROUP BY 1, 2, 3""",
)
def dispensers_needed_by_class(spark, sf_dir):
    grain = sizing.PRODUCT_CLASS
    hist = sizing.histogram(_ongoing(spark, sf_dir), grain)
    return sizing.dispensers_needed(hist, grain).select(
        "GlobalSiteId", F.col(pumps.FLAG).alias("flag"), "threshold", "needed", "freeable"
    )


# --- the same on product classes and grades ---------------------------------------

_CLASS_QUEUE_SQL = f"""{_SERVED_SQL},
q AS (
  SELECT site, flag, n_flag, d, greatest(comb + 1 - d, 0) AS ql, sum(qty) AS volume, count(*) AS n,
         flag_vol, flag_txn
  FROM scen GROUP BY site, flag, n_flag, d, greatest(comb + 1 - d, 0), flag_vol, flag_txn),
qc AS (
  SELECT *, sum(volume) OVER w AS cum_vol, CAST(sum(n) OVER w AS BIGINT) AS cum_txn FROM q
  WINDOW w AS (PARTITION BY site, flag, d ORDER BY ql
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query(
    "queue_cumulative_by_class",
    f"""WITH {_CLASS_QUEUE_SQL}
        SELECT site AS GlobalSiteId, flag, d AS If_the_site_has_x_dispensers,
               CAST(ql AS INTEGER) AS queue_length, CAST(volume AS DOUBLE) AS volume,
               n AS number_of_txn, CAST(cum_vol AS DOUBLE) AS cum_vol, cum_txn,
               CAST(cum_vol AS DOUBLE) * 100.0::DOUBLE / CAST(flag_vol AS DOUBLE)
                 AS cum_vol_Perc_of_relevant_vol,
               CAST(cum_txn AS DOUBLE) * 100.0::DOUBLE / CAST(flag_txn AS DOUBLE)
                 AS cum_txn_Perc_of_relevant_txn
        FROM qc""",
)
def queue_cumulative_by_class(spark, sf_dir):
    hist = sizing.histogram(_ongoing(spark, sf_dir), sizing.PRODUCT_CLASS)
    out = sizing.queue_lengths(hist, sizing.PRODUCT_CLASS).select(
        "GlobalSiteId", F.col(pumps.FLAG).alias("flag"), sizing.DISPENSERS, "queue_length",
        "volume", "number_of_txn", "cum_vol", "cum_txn", "cum_vol_Perc_of_relevant_vol",
        "cum_txn_Perc_of_relevant_txn",
    )
    return _plain(out, "volume", "cum_vol")


@query(
    "dispensers_needed_by_class_queue",
    f"""WITH {_CLASS_QUEUE_SQL},
        qs AS (SELECT site, flag, n_flag, ql, d,
                 CAST(cum_vol AS DOUBLE) * 100.0::DOUBLE / CAST(flag_vol AS DOUBLE) AS pct0 FROM qc),
        {_needed_sql('qs', 'site, flag, ql', 'pct0', 'n_flag')}
        SELECT site AS GlobalSiteId, flag, CAST(ql AS INTEGER) AS queue_length, threshold,
               CAST(sum(flag1) AS BIGINT) AS needed,
               CAST(max(n_flag) - sum(flag1) AS BIGINT) AS freeable
        FROM flags GROUP BY 1, 2, 3, 4""",
)
def dispensers_needed_by_class_queue(spark, sf_dir):
    hist = sizing.histogram(_ongoing(spark, sf_dir), sizing.PRODUCT_CLASS)
    return sizing.dispensers_needed_by_queue(hist, sizing.PRODUCT_CLASS).select(
        "GlobalSiteId", F.col(pumps.FLAG).alias("flag"), "queue_length", "threshold", "needed",
        "freeable",
    )


@query(
    "dispensers_needed_by_grade",
    f"""WITH {_SERVED_SQL},
        srv AS (SELECT site, info, product, pumps, n_pumps, d,
                 CAST(sum(qty) AS DOUBLE) * 100.0::DOUBLE / CAST(grade_vol AS DOUBLE) AS pct0
                FROM scen WHERE pot < d GROUP BY site, info, product, pumps, n_pumps, d, grade_vol),
        {_needed_sql('srv', 'site, info, product, pumps', 'pct0', 'n_pumps')}
        SELECT site AS GlobalSiteId, info AS additionalProductInfo, product AS productCode,
               array_to_string(pumps, ',') AS relevant_pumps, threshold,
               CAST(sum(flag1) AS BIGINT) AS needed,
               CAST(max(n_pumps) - sum(flag1) AS BIGINT) AS freeable
        FROM flags GROUP BY 1, 2, 3, 4, 5""",
)
def dispensers_needed_by_grade(spark, sf_dir):
    grain = sizing.PRODUCT_GRADE
    hist = sizing.histogram(_ongoing(spark, sf_dir), grain)
    return _set_text(sizing.dispensers_needed(hist, grain)).select(
        "GlobalSiteId", "additionalProductInfo", "productCode", "relevant_pumps", "threshold",
        "needed", "freeable",
    )


# --- transactions matched with reference sales ------------------------------------

FIRST_DAY = dt.date(2024, 1, 10)


def _match_sql(transactions: str = "TRUE", sales: str = "TRUE") -> str:
    """Nearest sale per transaction, the last ending of a matched message, all unmatched ones."""
    return f"""
WITH m AS (
  SELECT * FROM (
    SELECT event_id, v, 'C' || CAST(user_id % 3 AS VARCHAR) AS country, CAST(user_id AS VARCHAR) AS site,
           CAST(floor(value / 100) AS DECIMAL(20,2)) AS qty,
           timezone('Europe/Paris', timezone('UTC', ts + to_minutes(4 + v))) AS end_ts,
           timezone('Europe/Paris', timezone('UTC', ts)) AS start_local
    FROM events CROSS JOIN (SELECT unnest([0, 1])::BIGINT AS v) WHERE event_type <> 'purchase')
  WHERE {transactions}),
t AS (SELECT 'C' || CAST(user_id % 3 AS VARCHAR) AS country, CAST(user_id AS VARCHAR) AS site,
             CAST(floor(value / 100) AS DECIMAL(20,2)) AS qty, ts AS sale_ts
      FROM events WHERE event_type = 'purchase' AND {sales}),
best AS (SELECT m.event_id, m.v, t.sale_ts, row_number() OVER (PARTITION BY m.event_id, m.v
           ORDER BY abs(epoch_us(m.end_ts) - epoch_us(t.sale_ts)), t.sale_ts) AS rn
         FROM m JOIN t ON m.country = t.country AND m.site = t.site AND m.qty = t.qty
           AND m.end_ts BETWEEN t.sale_ts - INTERVAL 12 HOUR AND t.sale_ts + INTERVAL 12 HOUR),
r AS (SELECT m.*, b.sale_ts FROM m LEFT JOIN (SELECT * FROM best WHERE rn = 1) b USING (event_id, v)),
one AS (SELECT *, row_number() OVER (PARTITION BY event_id, sale_ts IS NULL ORDER BY v DESC) AS k FROM r)
SELECT CAST(event_id AS VARCHAR) AS RowKey, coalesce(sale_ts, end_ts + INTERVAL 3 MINUTE) AS end_ts,
       start_local - INTERVAL 1 MINUTE AS start_ts, sale_ts IS NOT NULL AS matched,
       CAST(qty AS DOUBLE) AS qty, CAST(hour(end_ts) AS INTEGER) AS hr
FROM one WHERE sale_ts IS NULL OR k = 1"""


def _raw_transactions(spark, sf_dir):
    """Every event that is no purchase as three rows of one message.

    The second ends a minute later; the third repeats the first under another
    row key, so it is a copy.
    """
    ev = table(spark, sf_dir, "events").where("event_type <> 'purchase'")
    at = F.col("ts").cast("timestamp")
    null = F.lit(None).cast("string")
    rows = ev.withColumn("_v", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    key = F.col("event_id").cast("string")
    return rows.select(
        F.concat(F.lit("C"), (F.col("user_id") % 3).cast("string")).alias("PartitionKey"),
        F.when(F.col("_v") < 2, key).otherwise(F.concat(key, F.lit("z"))).alias("RowKey"),
        at.alias("RequestDateTime"),
        F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("SiteId"),
        F.lit(1).alias("deviceID"),
        null.alias("additionalProductInfo"),
        F.lit("5").alias("productCode"),
        F.lit(1).alias("pumpNumber"),
        F.lit(1).alias("nozzleNumber"),
        F.floor(F.col("value") / 100).cast("double").alias("quantity"),
        F.lit(0.0).alias("counterReading"),
        at.alias("transactionStartTime"),
        (at + F.make_dt_interval(mins=F.lit(4) + F.col("_v") % 2)).alias("transactionEndTime"),
        null.alias("deliveryType"),
        F.lit(None).cast("double").alias("lubricantQuantity"),
        F.col("event_id").cast("int").alias("transactionNumber"),
        null.alias("transactionStatus"),
    )


def _sites(spark, sf_dir):
    user = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("C"), (F.col("user_id") % 3).cast("string")).alias("PartitionKey"),
        F.concat(user, F.lit("  ")).alias("SiteId"),
        F.lit(1).alias("pumpNumber"),
        F.lit(1).alias("nozzleNumber"),
        user.alias("GlobalSiteId"),
        *[F.lit(None).cast("string").alias(c) for c in matching.SITE_COLUMNS if c != "GlobalSiteId"],
    ).distinct()


def _sales(spark, sf_dir):
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        F.concat(F.lit("C"), (F.col("user_id") % 3).cast("string")).alias("COUNTRY_CODE"),
        F.col("user_id").cast("string").alias("RETAIL_SITE_ID"),
        F.floor(F.col("value") / 100).cast("double").alias("SALES_QUANTITY"),
        at.alias("EVENT_START_DATE"),
        F.to_date(at).alias("START_DATE"),
        F.lit(matching.SALES_CLASS).alias("CLASS_NAME"),
        F.lit(matching.SALES_INDICATOR).alias("SALES_OR_RETURN_INDICATOR"),
    )


def _matched(rows, sales):
    return matching.match_transactions(rows, sales, 12 * 3600, with_flag=True).select(
        "RowKey",
        plain_ts(F.col("transactionEndTime")).alias("end_ts"),
        plain_ts(F.col("transactionStartTime")).alias("start_ts"),
        "matched",
        F.col("SALES_QUANTITY").cast("double").alias("qty"),
        F.col("TRANSACTION_HOUR").alias("hr"),
    )


@query("match_transactions", _match_sql())
def match_transactions(spark, sf_dir):
    """Events as transactions, purchases as reference sales; whole-hundred quantities."""
    rows = matching.site_transactions(_raw_transactions(spark, sf_dir), _sites(spark, sf_dir))
    return _matched(rows, matching.reference_sales(_sales(spark, sf_dir)))


@query(
    "transaction_steps",
    """WITH r AS (SELECT event_id, v, event_id % 11 = 0 AS bad FROM events
                 CROSS JOIN (SELECT unnest([0, 1, 2])::BIGINT AS v) WHERE event_type <> 'purchase')
       SELECT 1 AS step_no, 'keys' AS step, count(*) AS rows, 'RowKey' AS key, CAST(0 AS BIGINT) AS without_key,
              count(*) FILTER (WHERE bad) AS unreadable FROM r
       UNION ALL SELECT 2, 'sites', count(*), 'GlobalSiteId', count(*) FILTER (WHERE bad), NULL FROM r
       UNION ALL SELECT 3, 'distinct', count(*), 'GlobalSiteId', count(*) FILTER (WHERE bad), NULL FROM r WHERE v < 2""",
)
def transaction_steps(spark, sf_dir):
    """Rows behind each step of the transaction job, from the run that writes it; some pump numbers are no numbers."""
    raw = _raw_transactions(spark, sf_dir)
    odd = F.col("transactionNumber") % 11 == 0
    raw = raw.withColumn("pumpNumber", F.when(odd, "pump one").otherwise(F.col("pumpNumber").cast("string")))
    steps = Steps()
    rows = matching.site_transactions(raw, _sites(spark, sf_dir), watch=steps.watch)
    sinks.write_files(rows, scratch_dir(spark, "transactions"))
    return steps.frame(spark)


@query(
    "match_first_load",
    _match_sql(
        f"end_ts >= DATE '{FIRST_DAY}'", "CAST(ts AS DATE) IN (SELECT CAST(end_ts AS DATE) FROM m)"
    ),
)
def match_first_load(spark, sf_dir):
    """The same from a first day on, with the sales of observed dates only."""
    rows = matching.site_transactions(
        _raw_transactions(spark, sf_dir), _sites(spark, sf_dir), first_load=True, first_day=FIRST_DAY
    )
    return _matched(rows, matching.reference_sales(_sales(spark, sf_dir), rows.select("START_DATE")))


_YEARS = (2023, 2024)


@query(
    "clean_transactions",
    f"""WITH {TX_SQL},
       moved AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN start_ts - INTERVAL 2 YEAR ELSE start_ts END AS began FROM tx)
       SELECT event_id, site, pump, qty, CASE WHEN event_id % 3 = 0 THEN 'A' ELSE 'City' END AS city,
              row_number() OVER (ORDER BY site, began, event_id) AS txn_id
       FROM moved WHERE year(began) BETWEEN {_YEARS[0]} AND {_YEARS[1]}""",
)
def clean_transactions(spark, sf_dir):
    """Copies that differ in other columns are kept once, years outside the range go, the rest is numbered."""
    rows = tx(spark, sf_dir)
    start = F.col("transactionStartTime")
    rows = rows.withColumn(
        "transactionStartTime", F.when(F.col("event_id") % 5 == 0, F.add_months(start, -24).cast("timestamp")
                                       + (start - F.date_trunc("day", start))).otherwise(start)
    )
    empty = {c: F.lit(None).cast("string") for c in pumps.SAME_TRANSACTION if c not in rows.columns}
    rows = rows.withColumns({**empty, "transactionNumber": F.col("event_id").cast("string")})
    copies = rows.withColumn("City", F.when(F.col("event_id") % 3 == 0, "A").otherwise("Town"))
    kept = pumps.cleaned(rows.unionByName(copies), *_YEARS)
    return pumps.with_transaction_id(kept, ["event_id"]).select(
        "event_id",
        F.col("GlobalSiteId").alias("site"),
        F.col("pumpNumber").alias("pump"),
        F.col("SALES_QUANTITY").alias("qty"),
        F.col("City").alias("city"),
        "txn_id",
    )


@query(
    "overlap_pairs",
    f"""WITH {TX_SQL}
        SELECT a.event_id, b.event_id AS other_event_id FROM tx a LEFT JOIN tx b
          ON a.site = b.site AND b.start_ts < a.start_ts AND b.end_ts >= a.start_ts""",
)
def overlap_pairs(spark, sf_dir):
    """Each transaction with those open when it begins; null where there is none."""
    rows = tx(spark, sf_dir).select("event_id", "GlobalSiteId", "transactionStartTime", "transactionEndTime")
    pairs = overlap_join(rows, rows, ["GlobalSiteId"], "transactionStartTime", "transactionEndTime")
    return pairs.select("event_id", "other_event_id")


@query(
    "tolerance_pairs",
    f"""WITH {TX_SQL}
        SELECT a.event_id, b.event_id AS near_event_id FROM tx a JOIN tx b
          ON a.site = b.site AND a.product = 'purchase' AND b.product = 'click'
         AND b.start_ts BETWEEN a.start_ts - INTERVAL 15 MINUTE AND a.start_ts + INTERVAL 15 MINUTE""",
)
def tolerance_pairs(spark, sf_dir):
    """Purchases with all clicks of the site within a quarter of an hour."""
    rows = tx(spark, sf_dir).select("event_id", "GlobalSiteId", "productCode", "transactionStartTime")
    clicks = rows.where("productCode = 'click'").select(
        F.col("event_id").alias("near_event_id"), "GlobalSiteId", F.col("transactionStartTime").alias("near_at")
    )
    return tolerance_join(
        rows.where("productCode = 'purchase'"), clicks, ["GlobalSiteId"], "transactionStartTime", "near_at", 900
    ).select("event_id", "near_event_id")
