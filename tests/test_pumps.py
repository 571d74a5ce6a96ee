"""Pump jobs on small fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sitebooks.plans import matching, pumps, sizing
from tests.conftest import rows

T0 = dt.datetime(2024, 3, 1)
TX = "event_id int, PartitionKey string, GlobalSiteId string, SiteId string, siteName string, City string, additionalProductInfo string, productCode string, pumpNumber int, SALES_QUANTITY decimal(20,2), transactionStartTime timestamp, transactionEndTime timestamp"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def make(spark, records):
    data = []
    for i, r in enumerate(records):
        s = r.get("site", "1")
        data.append((i, r.get("country", "NL"), s, s, f"site {s}", "city", r.get("info"), r.get("grade", "95"), r.get("pump", 1), r.get("qty", 1), at(r["s"]), at(r["e"])))
    from decimal import Decimal

    return spark.createDataFrame([(*d[:9], Decimal(d[9]), *d[10:]) for d in data], TX)


def counted(tx, slots=pumps.SLOTS, **kwargs):
    profiles = pumps.grade_profiles(tx, ("gas",), slots=slots)
    return pumps.ongoing_counts(pumps.with_relevance(tx, profiles), slots=slots, **kwargs)


def brute(records):
    """Counts by looking at every pair, straight from the definition."""
    sets, flag = {}, lambda r: r.get("info") if "gas" in (r.get("info") or "") else "road"
    grade = lambda r: (r.get("country", "NL"), r.get("site", "1"), r.get("info"), r.get("grade", "95"))
    for r in records:
        sets.setdefault(grade(r), set()).add(r.get("pump", 1))
    out = []
    for i, a in enumerate(records):
        n = [0, 0, 0]
        for b in records:
            if grade(a)[:2] != grade(b)[:2] or not (b["s"] < a["s"] <= b["e"]):
                continue
            n[0] += b.get("pump", 1) in sets[grade(a)]
            n[1] += bool(sets[grade(a)] & sets[grade(b)])
            n[2] += flag(a) == flag(b)
        out.append((i, *n))
    return out


@pytest.mark.parametrize("bucket, slots", [(900, 32), (43200, 32), (900, 8), (600, 12)])  # fewer slots: sites by class
def test_counts_equal_brute_force_with_a_hot_site(spark, bucket, slots):
    rng = random.Random(7)
    records = []
    for _ in range(250):
        s = rng.randrange(1500)
        grade = rng.choice(["95", "98", "D", "G"])
        records.append(dict(
            site="hot" if rng.random() < 0.5 else rng.choice("ab"), grade=grade, info=rng.choice([None, "x", "gas 1"]),
            pump=rng.choice({"95": [1, 2], "98": [2, 3], "D": [4], "G": [5, 6]}[grade]), s=s, e=s + rng.choice([-2, 0, 3, 40, 900]),
        ))
    out = counted(make(spark, records), slots, bucket_seconds=bucket)
    assert rows(out, "event_id", *pumps.COUNTS) == brute(records)


def test_edges(spark):
    both = [dict(s=0, e=5), dict(s=0, e=5), dict(s=5, e=9)]
    assert [r[1] for r in rows(counted(make(spark, both)), "event_id", "txn_ongoing_actual")] == [0, 0, 2]
    null_site = [dict(s=0, e=5, site=None), dict(s=1, e=5, site=None)]
    assert [r[1] for r in rows(counted(make(spark, null_site)), "event_id", "txn_ongoing_potential")] == [0, 0]
    null_pump = [dict(s=0, e=9, pump=None), dict(s=1, e=9)]
    out = rows(counted(make(spark, null_pump)), "event_id", *pumps.COUNTS)
    assert out == [(0, 0, 0, 0), (1, 0, 1, 1)]


def test_rows_without_a_profile_are_kept(spark):
    tx = make(spark, [dict(s=0, e=5), dict(s=1, e=5, grade="other")])
    known = pumps.grade_profiles(tx.where("productCode = '95'"))
    out = pumps.ongoing_counts(pumps.with_relevance(tx, known))
    assert rows(out, "event_id", "txn_ongoing_potential") == [(0, 0), (1, 0)]


def test_merge_equal_adds_up(spark):
    tx = make(spark, [dict(s=0, e=9), dict(s=1, e=2), dict(s=1, e=2)])
    merged = counted(tx, merge_equal=True)
    assert rows(merged, "txn_ongoing_actual") == [(0,), (2,)]


def test_profiles(spark):
    tx = make(spark, [dict(s=0, e=1, pump=2), dict(s=0, e=1, pump=1), dict(s=0, e=1, info="gas", grade="G", pump=7, qty=5)])
    got = rows(
        pumps.grade_profiles(tx, ("gas",)).where("pumpNumber IS NOT NULL"), "productCode", "pumpNumber", F.array_join("relevant_pumps", ","),
        pumps.FLAG, pumps.FLAG_PUMPS, "site_vol", "grade_txn",
    )
    road = "Mogas / non-truck diesel"
    assert got == [("95", 1, "1,2", road, 2, 7.0, 2), ("95", 2, "1,2", road, 2, 7.0, 2), ("G", 7, "7", "gas", 1, 7.0, 1)]


def sized(spark, records, fn, grain=sizing.PUMP_SET, **kwargs):
    hist = sizing.histogram(counted(make(spark, records)), grain)
    return fn(hist, grain, **kwargs)


def test_no_overlap_needs_one(spark):
    records = [dict(s=0, e=1), dict(s=10, e=11)]
    out = sized(spark, records, sizing.served_or_waiting)
    assert rows(out, sizing.DISPENSERS, sizing.STATE, "number_of_txn") == [(1, sizing.SERVED, 2)]


def test_three_at_once(spark):
    records = [dict(s=0, e=100), dict(s=1, e=100), dict(s=2, e=100), dict(s=3, e=4)]
    out = sized(spark, records, sizing.served_or_waiting)
    served = rows(out.where(F.col(sizing.STATE) == sizing.SERVED), sizing.DISPENSERS, "Perc_of_relevant_txn")
    assert served == [(1, 25.0), (2, 50.0), (3, 75.0), (4, 100.0)]
    total = out.groupBy(sizing.DISPENSERS).agg(F.sum("number_of_txn").alias("n"))
    assert rows(total, "n") == [(4,)] * 4
    queue = sized(spark, records, sizing.queue_lengths)
    assert rows(queue.where(f"{sizing.DISPENSERS} = 2"), "queue_length", "number_of_txn", "cum_txn") == [(0, 2, 2), (1, 1, 3), (2, 1, 4)]
    need = sized(spark, records, sizing.dispensers_needed, thresholds=[50.0, 75.0, 76.0])
    assert rows(need, "threshold", "needed", "freeable") == [(50.0, 2, -1), (75.0, 3, -2), (76.0, 4, -3)]
    wide = sizing.wide_thresholds(need, ["SiteId"], [50.0, 75.0])
    assert rows(wide) == [("1", 2, -1, 3, -2)]


def test_need_falls_with_the_level(spark, sf_dir):
    from sitebooks.catalog import QUERIES

    need = QUERIES["dispensers_needed"](spark, sf_dir).where("needed > 0")
    levels = need.groupBy("GlobalSiteId", "relevant_pumps").agg(F.array_sort(F.collect_list(F.struct("threshold", "needed"))).alias("l"))
    for row in levels.collect():
        counts = [x["needed"] for x in row["l"]]
        assert counts == sorted(counts)


SITES = "PartitionKey string, SiteId string, pumpNumber int, nozzleNumber int, GlobalSiteId string, Cluster string, IsWSMASupportedSite string, SiteSimulation string, SiteStatus string, Name string, City string"
RAW = "PartitionKey string, RowKey string, RequestDateTime timestamp, SiteId string, deviceID string, additionalProductInfo string, productCode string, pumpNumber int, nozzleNumber int, quantity double, counterReading double, transactionStartTime timestamp, transactionEndTime timestamp, deliveryType string, lubricantQuantity double, transactionNumber int, transactionStatus string"


def _raw(key, end, qty=10.0, site="7", number=1):
    return ("NL", f" {key} ", T0, site, "1", None, "5", 1, 1, qty, 0.0, at(end - 2), at(end), None, None, number, None)


def _sale(minutes, qty=10.0, kind="FUELS"):
    return ("NL", "G7", qty, at(minutes), T0.date(), kind, "S")


def _matched(spark, raw, sales, **kwargs):
    sites = spark.createDataFrame([("NL ", "7 ", 1, 1, " G7 ", None, None, None, None, "seven", None)], SITES)
    sales = spark.createDataFrame(sales, "COUNTRY_CODE string, RETAIL_SITE_ID string, SALES_QUANTITY double, EVENT_START_DATE timestamp, START_DATE date, CLASS_NAME string, SALES_OR_RETURN_INDICATOR string")
    tx = matching.site_transactions(spark.createDataFrame(raw, RAW), sites, zone="UTC", **kwargs)
    return matching.match_transactions(tx, matching.reference_sales(sales, tx.select("START_DATE")))


def test_matching(spark):
    raw = [_raw("a", 100, number=1), _raw("a", 101, number=2), _raw("b", 500, number=3), _raw("c", 10, site="8", number=4), _raw("a", 100, number=1)]
    out = _matched(spark, raw, [_sale(90), _sale(103), _sale(500, kind="SHOP")])
    assert out.columns == matching.OUTPUT and len(out.columns) == 27
    # of two matched rows of message "a" the later one stays and takes the nearer sale's time;
    # "b" is unmatched and ends three minutes later; "c" has no global site
    assert rows(out, "RowKey", "transactionEndTime", "transactionStartTime") == [("a", at(103), at(98)), ("b", at(503), at(497))]


def test_first_load_cuts_off(spark):
    raw = [_raw("a", 100)]
    assert _matched(spark, raw, [_sale(0)], first_load=True).count() == 1
    assert _matched(spark, raw, [_sale(0)], first_load=True, first_day=dt.date(2025, 1, 1)).count() == 0
