"""Pump relevance, volume totals and ongoing-transaction counts.

Input: one row per transaction with PartitionKey (country), GlobalSiteId,
SiteId, siteName, additionalProductInfo, productCode, pumpNumber,
SALES_QUANTITY, transactionStartTime and transactionEndTime; further columns
are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitebooks.functions.calendar import in_years
from sitebooks.functions.codes import (
    DEFAULT_PRODUCT_CLASS,
    SPECIAL_PRODUCT_MARKERS,
    product_class,
)
from sitebooks.operators.aggregates import value_set
from sitebooks.operators.intervals import (
    SLOT_SECONDS,
    SLOTS,
    packed,
    slot_counts,
)
from sitebooks.operators.joins import null_safe_join
from sitebooks.operators.numbering import numbered
from sitebooks.operators.windows import dedupe

SITE = ["PartitionKey", "GlobalSiteId", "SiteId"]
GRADE = [*SITE, "additionalProductInfo", "productCode"]
# Columns in which copies of a transaction agree.
SAME_TRANSACTION = (
    "SiteId", "deviceID", "additionalProductInfo", "productCode", "pumpNumber", "nozzleNumber",
    "SALES_QUANTITY", "counterReading", "transactionStartTime", "transactionEndTime",
    "deliveryType", "lubricantQuantity", "transactionNumber", "transactionStatus",
)
FLAG = "mogas_diesel_non_truck_flag"
FLAG_PUMPS = "number_of_relevant_pumps_mogas_diesel_non_truck_aggregated"
COUNTS = ("txn_ongoing_actual", "txn_ongoing_potential", "txn_ongoing_mogas_diesel_combined")


def grade_profiles(
    tx: DataFrame,
    markers: tuple[str, ...] = SPECIAL_PRODUCT_MARKERS,
    default: str = DEFAULT_PRODUCT_CLASS,
    slots: int = SLOTS,
) -> DataFrame:
    """One row per site, grade and pump: pump set, product class, volume totals, lanes.

    The transactions are aggregated once, to site and grade; everything else is
    derived from that small table, one site at a time.  Totals are given for the
    site, the product code, the pump set and the product class.

    A *class* is a distinct (pump set, product class) pair among the grades of a
    global site; a *kind* is a pump of a class (or no pump).  A transaction
    counts for a class as *actual* if its pump is in the class's pump set,
    as *potential* if the pump sets overlap, as *combined* if the product class
    is the same.  ``lanes`` says where a transaction on this pump is announced
    (group and slot of :func:`slot_counts`), ``asks`` where it asks and which
    slots count, as three bit sets:

    * a site of up to ``slots`` kinds is one group with a slot per kind, so a
      transaction is announced once, however many classes it counts for;
    * of a site with more kinds, each class is a group, and the slot says as
      which of the three (4, 2, 1 added up) it counts there.

    A pump that is null has a row of its own.
    """
    grades = (
        tx.groupBy(*GRADE)
        .agg(
            value_set("pumpNumber").alias("relevant_pumps"),
            F.sum(F.col("SALES_QUANTITY").cast("decimal(20,2)")).alias("_vol"),
            F.count(F.lit(1)).alias("_txn"),
        )
        .withColumn(FLAG, product_class(F.col("additionalProductInfo"), markers, default))
    )
    # The coarsest partitioning comes first: it also serves the finer windows.
    place = Window.partitionBy("PartitionKey", "GlobalSiteId")
    own = F.struct(F.col("relevant_pumps").alias("pumps"), F.col(FLAG).alias("flag"))
    grades = grades.withColumn("_all", F.array_sort(F.collect_set(own).over(place)))

    by = lambda *extra: Window.partitionBy(*SITE, *extra)
    flag_set = F.array_distinct(F.flatten(F.collect_list("relevant_pumps").over(by(FLAG))))
    combo = by("productCode", "relevant_pumps", FLAG)
    out = {
        "site_vol": F.sum("_vol").over(by()).cast("double"),
        "site_txn": F.sum("_txn").over(by()),
        "grade_vol": F.sum("_vol").over(by("productCode")).cast("double"),
        "grade_txn": F.sum("_txn").over(by("productCode")),
        "relevant_pumps_vol": F.sum("_vol").over(by("relevant_pumps")).cast("double"),
        "relevant_pumps_txn": F.sum("_txn").over(by("relevant_pumps")),
        "relevant_pumps_vol_mogas_diesel_aggregated": F.sum("_vol").over(by(FLAG)).cast("double"),
        "relevant_pumps_txn_mogas_diesel_aggregated": F.sum("_txn").over(by(FLAG)),
        "quantity_sum": F.sum("_vol").over(combo).cast("double"),
        "txn_count": F.sum("_txn").over(combo),
        "number_of_relevant_pumps": F.size("relevant_pumps"),
        FLAG_PUMPS: F.size(flag_set),
        "_class": F.array_position("_all", own).cast("int"),
    }
    bit = lambda test, worth: F.when(test, worth).otherwise(0)
    lane = lambda group, slot: F.struct(group.cast("int").alias("group"), slot.cast("int").alias("slot"))
    # Kinds are numbered class by class: the pumps of its set in order, then no pump.
    kinds = lambda classes: F.aggregate(classes, F.lit(0), lambda n, c: n + F.size(c["pumps"]) + 1)
    base = lambda number: kinds(F.slice("_all", F.lit(1), number))  # noqa: E731  (kinds of the classes before)
    one_group = kinds(F.col("_all")) <= slots
    place_in_set = F.coalesce(F.array_position("relevant_pumps", F.col("pumpNumber")) - 1, F.size("relevant_pumps"))
    code = F.transform(
        "_all",
        lambda c, i: F.struct(
            (i + 1).alias("no"),
            (
                bit(F.array_contains(c["pumps"], F.col("pumpNumber")), 4)
                + bit(F.arrays_overlap(c["pumps"], F.col("relevant_pumps")), 2)
                + bit(c["flag"] == F.col(FLAG), 1)
            ).alias("code"),
        ),
    )
    apart = F.transform(F.filter(code, lambda c: c["code"] > 0), lambda c: lane(c["no"], c["code"]))
    lanes = F.when(one_group, F.array(lane(F.lit(0), base(F.col("_class") - 1) + place_in_set))).otherwise(apart)

    one = F.lit(1).cast("long")
    shift = lambda bits, by: F.call_function("shiftleft", bits, by.cast("int"))
    every = lambda c: shift(one, F.size(c["pumps"]) + 1) - 1
    hit = lambda c: F.aggregate(
        F.transform(c["pumps"], lambda p, k: F.when(F.array_contains("relevant_pumps", p), shift(one, k)).otherwise(0).cast("long")),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    none = F.lit(0).cast("long")
    tests = {
        COUNTS[0]: (hit, 0b11110000),
        COUNTS[1]: (lambda c: F.when(F.arrays_overlap(c["pumps"], F.col("relevant_pumps")), every(c)).otherwise(none), 0b11001100),
        COUNTS[2]: (lambda c: F.when(c["flag"] == F.col(FLAG), every(c)).otherwise(none), 0b10101010),
    }
    masks = [
        F.when(
            one_group,
            F.aggregate(F.transform("_all", lambda c, i: shift(test(c), base(i))), none, lambda a, x: a + x),
        ).otherwise(F.lit(apart_bits).cast("long")).alias(name)
        for name, (test, apart_bits) in tests.items()
    ]
    asks = F.struct(F.when(one_group, 0).otherwise(F.col("_class")).cast("int").alias("group"), *masks)
    return (
        grades.withColumns(out)
        .withColumn("asks", asks)
        .withColumn("pumpNumber", F.explode(F.array_append("relevant_pumps", F.lit(None))))
        .withColumn("lanes", lanes)
        .drop("_vol", "_txn", "_all", "_class")
    )


def with_relevance(tx: DataFrame, profiles: DataFrame, mix_grades: bool = False) -> DataFrame:
    """Add the grade profile to every transaction.

    ``mix_grades`` joins the pump sets without the product text, so that a
    product code sold under several texts repeats its transactions; the result
    then has no class columns.
    """
    key = [*GRADE, "pumpNumber"]
    if not mix_grades:
        return null_safe_join(tx, profiles, key, "left")
    sets = ["relevant_pumps", "number_of_relevant_pumps"]
    per_product = [*SITE, "productCode"]
    own = null_safe_join(tx, profiles.drop(*sets, "asks", "lanes"), key, "left")
    by_product = profiles.select(*GRADE, *sets).distinct().drop("additionalProductInfo")
    return null_safe_join(own, by_product, per_product, "left")


def cleaned(
    tx: DataFrame, first_year: int, last_year: int, columns: Sequence[str] = SAME_TRANSACTION
) -> DataFrame:
    """Transactions of the years (both included), one of each set of copies.

    Copies agree in the 14 columns of :data:`SAME_TRANSACTION`; the one with the
    smallest other columns stays.  The years are a range on the start time, so
    they reach the scan.
    """
    rest = [F.col(f.name) for f in tx.schema.fields if f.name not in columns and "map<" not in f.dataType.simpleString()]
    kept = tx.where(in_years(F.col("transactionStartTime"), first_year, last_year))
    return dedupe(kept, list(columns), [c.asc_nulls_last() for c in rest] or [F.lit(0)])


def with_transaction_id(tx: DataFrame, tie: Sequence[str], out: str = "txn_id") -> DataFrame:
    """Add a gapless number over all transactions, ordered by site, start and ``tie``; see :func:`numbered`."""
    return numbered(tx, out, ["SiteId"], "transactionStartTime", tie)


def pump_summary(tx: DataFrame, site_master: DataFrame | None = None) -> DataFrame:
    """Volume and number of transactions per site, grade and pump."""
    out = tx.groupBy(
        *SITE, "siteName", "City", "additionalProductInfo", "productCode", "pumpNumber"
    ).agg(
        F.sum(F.col("SALES_QUANTITY").cast("decimal(20,2)")).alias("Transaction_Vol"),
        F.count(F.lit(1)).alias("Transaction_Count"),
    )
    if site_master is None:
        return out
    names = {"COUNTRY_CODE": "PartitionKey", "GLOBAL_SITE_ID": "GlobalSiteId"}
    master = site_master.select(
        *names, "TERRITORY_NAME", "OPERATING_PLATFORM_NAME"
    ).distinct().withColumnsRenamed(names)
    return out.join(master, list(names.values()), "left")


def ongoing_counts(
    rows: DataFrame, bucket_seconds: int = SLOT_SECONDS, merge_equal: bool = False, slots: int = SLOTS
) -> DataFrame:
    """Add to every transaction how many others of its site were open when it began.

    Another transaction is open when it started earlier and ends at or after the
    start; transactions starting together do not see each other.  Three counts:
    on a pump relevant for this grade (actual), of a grade sharing a pump
    (potential), of the same product class (combined).  A transaction without a
    start or a site is kept and told 0.

    A transaction is announced once with its kind, and asks once: it reads the
    running vector of open kinds and adds up those that its class counts (see
    :func:`grade_profiles` for sites with very many kinds).  No two transactions
    are ever paired, and the rows are exchanged once.

    ``merge_equal`` returns the counts per (site, start, end, pump, pump set)
    with those of indistinguishable transactions added up.
    """
    place = ["PartitionKey", "GlobalSiteId"]
    start, end = "transactionStartTime", "transactionEndTime"
    live = F.coalesce(
        (F.col(start) < F.col(end)) & F.col(place[0]).isNotNull() & F.col(place[1]).isNotNull(),
        F.lit(False),
    )
    step = lambda group, at, slot, sign: F.struct(
        group.cast("int").alias("_group"), F.col(at).cast("timestamp").alias("_t"), slot.cast("int").alias("_slot"), F.lit(sign).alias("_sign")
    )
    up = F.transform("lanes", lambda x: step(x["group"], start, x["slot"], 1))
    down = F.transform("lanes", lambda x: step(x["group"], end, x["slot"], -1))
    # A row without a profile still asks, and is told 0.
    question = F.array(step(F.coalesce(F.col("asks.group"), F.lit(0)), start, F.lit(None), 0))
    told = rows.select(
        *place,
        packed(rows.drop("lanes")).alias("_row"),
        F.explode(F.when(live & F.col("lanes").isNotNull(), F.concat(question, up, down)).otherwise(question)).alias("_step"),
    )
    stream = told.select(
        *place, "_step.*", F.when(F.col("_step._slot").isNull(), F.col("_row")).alias("_row")
    )
    found = slot_counts(stream, [*place, "_group"], slots, bucket_seconds)
    bits = lambda mask: reduce(
        lambda a, b: a + b,
        [F.when(F.getbit(mask, F.lit(j)) == 1, F.col("_open")[j]).otherwise(F.lit(0).cast("long")) for j in range(slots)],
    )
    out = found.withColumns({c: bits(F.coalesce(F.col(f"asks.{c}"), F.lit(0).cast("long"))) for c in COUNTS}).drop("asks", "_open")
    if not merge_equal:
        return out
    return out.groupBy(
        "SiteId", *place, "siteName", "transactionStartTime", "transactionEndTime", "pumpNumber",
        "relevant_pumps",
    ).agg(*[F.sum(c).alias(c) for c in COUNTS])
