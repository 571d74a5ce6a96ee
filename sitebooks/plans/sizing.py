"""How many dispensers a site needs for a service level.

Input: transactions with their relevance and ongoing counts, as produced by
:mod:`sitebooks.plans.pumps`.  Every result is computed from a histogram of the
ongoing counts per group, so the transactions are aggregated once and the
what-if over 1..D dispensers costs D rows per group, not D rows per transaction.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitebooks.functions.money import share
from sitebooks.operators.windows import count_until_threshold, flag_until_threshold
from sitebooks.plans.pumps import FLAG, FLAG_PUMPS

SITE = ["PartitionKey", "GlobalSiteId", "SiteId", "siteName"]
DISPENSERS = "If_the_site_has_x_dispensers"
STATE = "immediately_served_or_waiting"
SERVED, WAITING = "immediately_served", "waiting"
# Default service levels in percent of the volume.
THRESHOLDS = (99.5, 98.0, 95.0, 90.0, 85.0, 80.0, 75.0)


#: Columns the summaries use; drop the others before counting ongoing transactions.
INPUT = (
    *SITE, "additionalProductInfo", "productCode", "relevant_pumps", "number_of_relevant_pumps",
    FLAG, FLAG_PUMPS, "SALES_QUANTITY",
)


@dataclass(frozen=True)
class Grain:
    """What a summary is grouped by, and which total its shares refer to."""

    keys: tuple[str, ...]
    available: str
    ongoing: str
    #: Columns the reference total is taken over, beside the site.
    base: tuple[str, ...]
    vol: str
    txn: str
    share_name: str = "relevant"


PUMP_SET = Grain(
    ("relevant_pumps",), "number_of_relevant_pumps", "txn_ongoing_potential",
    ("relevant_pumps",), "relevant_pumps_vol", "relevant_pumps_txn",
)
PRODUCT_CLASS = Grain(
    (FLAG,), FLAG_PUMPS, "txn_ongoing_mogas_diesel_combined",
    (FLAG,), "relevant_pumps_vol_mogas_diesel_aggregated",
    "relevant_pumps_txn_mogas_diesel_aggregated",
)
PRODUCT_GRADE = Grain(
    ("additionalProductInfo", "productCode", "relevant_pumps"), "number_of_relevant_pumps",
    "txn_ongoing_potential", ("productCode",), "grade_vol", "grade_txn", "grade",
)


def histogram(rows: DataFrame, grain: Grain) -> DataFrame:
    """Volume and transactions per site, group and ongoing count, with the site's D.

    D, the largest number of dispensers considered, is one more than the
    largest potential count of the site, for every grain.  The totals the shares
    refer to are sums of the histogram, so the rows need not carry them.
    """
    fine = rows.groupBy(
        *SITE, *grain.keys, grain.available, F.col(grain.ongoing).cast("int").alias("ongoing")
    ).agg(
        F.sum(F.col("SALES_QUANTITY").cast("decimal(20,2)")).alias("volume"),
        F.count(F.lit(1)).alias("number_of_txn"),
        F.max("txn_ongoing_potential").alias("_peak"),
    )
    site, base = Window.partitionBy(*SITE), Window.partitionBy(*SITE, *grain.base)
    return fine.withColumns(
        {
            "D": (F.max("_peak").over(site) + 1).cast("int"),
            "site_vol": F.sum("volume").over(site).cast("double"),
            "site_txn": F.sum("number_of_txn").over(site),
            grain.vol: F.sum("volume").over(base).cast("double"),
            grain.txn: F.sum("number_of_txn").over(base),
        }
    ).drop("_peak")


def _group(grain: Grain) -> list[str]:
    return [*SITE, *grain.keys, grain.available, "site_vol", "site_txn", grain.vol, grain.txn]


def _with_shares(df: DataFrame, grain: Grain) -> DataFrame:
    name = grain.share_name
    return df.withColumns(
        {
            f"Perc_of_{name}_vol": share(F.col("volume"), F.col(grain.vol)),
            f"Perc_of_{name}_txn": share(F.col("number_of_txn"), F.col(grain.txn)),
            "Perc_of_site_vol": share(F.col("volume"), F.col("site_vol")),
            "Perc_of_site_txn": share(F.col("number_of_txn"), F.col("site_txn")),
        }
    )


def _ladder(hist: DataFrame, grain: Grain) -> DataFrame:
    """The histogram of each group without gaps below D, with its running sums.

    One row per group and ongoing count: ``volume`` and ``number_of_txn`` of the
    customers that met that many (0 in a gap), ``cum_*`` of those that met at
    most that many, ``all_*`` of the whole group.
    """
    group = _group(grain)
    bar = F.struct("ongoing", "volume", "number_of_txn")
    packed = hist.groupBy(*group).agg(F.collect_list(bar).alias("_bars"), F.max("D").alias("D"))
    bar_type = packed.schema["_bars"].dataType
    gaps = F.transform(
        F.sequence(F.lit(0), F.col("D") - 1),
        lambda o: F.struct(o.alias("ongoing"), F.lit(0).alias("volume"), F.lit(0).alias("number_of_txn")),
    ).cast(bar_type)
    bars = (
        packed.select(*group, "D", F.explode(F.concat("_bars", gaps)).alias("_bar"))
        .select(*group, "D", "_bar.*")
        .groupBy(*group, "D", "ongoing")
        .agg(F.sum("volume").alias("volume"), F.sum("number_of_txn").alias("number_of_txn"))
    )
    whole = Window.partitionBy(*group)
    so_far = whole.orderBy("ongoing").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return bars.withColumns(
        {
            "cum_vol": F.sum("volume").over(so_far),
            "cum_txn": F.sum("number_of_txn").over(so_far),
            "all_vol": F.sum("volume").over(whole),
            "all_txn": F.sum("number_of_txn").over(whole),
        }
    )


def served_or_waiting(hist: DataFrame, grain: Grain) -> DataFrame:
    """Volume and transactions served at once or waiting, for d = 1..D dispensers.

    Served with d dispensers are those that met fewer than d ongoing ones.
    """
    states = F.array(
        F.struct(
            F.lit(SERVED).alias(STATE),
            F.col("cum_vol").alias("volume"),
            F.col("cum_txn").alias("number_of_txn"),
        ),
        F.struct(
            F.lit(WAITING).alias(STATE),
            (F.col("all_vol") - F.col("cum_vol")).alias("volume"),
            (F.col("all_txn") - F.col("cum_txn")).alias("number_of_txn"),
        ),
    )
    long = (
        _ladder(hist, grain)
        .where("ongoing < D")
        .select(
            *_group(grain), (F.col("ongoing") + 1).alias(DISPENSERS), F.explode(states).alias("_s")
        )
        .select(*_group(grain), DISPENSERS, "_s.*")
        .where("number_of_txn > 0")
    )
    return _with_shares(long, grain)


def queue_lengths(hist: DataFrame, grain: Grain) -> DataFrame:
    """Volume per queue length for d = 1..D dispensers, with running sums over the length.

    Length 0 is what d dispensers serve at once.  A longer queue q holds exactly
    the customers that met ``q + d - 1`` ongoing transactions, so its running sum
    is the running sum of the histogram, whatever d is.
    """
    group = _group(grain)
    o = F.col("ongoing")
    cell = lambda d, q, vol, txn: F.struct(
        d.alias(DISPENSERS), q.alias("queue_length"), vol.alias("volume"),
        txn.alias("number_of_txn"),
    )
    at_once = F.when(
        (o < F.col("D")) & (F.col("cum_txn") > 0),
        F.array(cell(o + 1, F.lit(0), F.col("cum_vol"), F.col("cum_txn"))),
    )
    queued = F.when(
        (o > 0) & (F.col("number_of_txn") > 0),
        F.transform(
            F.sequence(F.lit(1), F.least(o, F.col("D"))),
            lambda d: cell(d, o + 1 - d, F.col("volume"), F.col("number_of_txn")),
        ),
    )
    cells = F.flatten(F.array_compact(F.array(at_once, queued)))
    out = (
        _ladder(hist, grain)
        .select(*group, "cum_vol", "cum_txn", F.explode(cells).alias("_c"))
        .select(*group, "_c.*", "cum_vol", "cum_txn")
    )
    return _with_shares(out, grain).withColumns(
        {
            "cum_vol_Perc_of_relevant_vol": share(F.col("cum_vol"), F.col(grain.vol)),
            "cum_txn_Perc_of_relevant_txn": share(F.col("cum_txn"), F.col(grain.txn)),
        }
    )


def served_detail(
    hist: DataFrame, grain: Grain, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Served rows with a flag per threshold: 1 up to the first d that reaches it."""
    served = served_or_waiting(hist, grain).where(F.col(STATE) == SERVED)
    return flag_until_threshold(
        served, f"Perc_of_{grain.share_name}_vol", [*SITE, *grain.keys], [DISPENSERS],
        thresholds, "Dispenser_needed",
    )


def _freeable(df: DataFrame, grain: Grain) -> DataFrame:
    return df.withColumn("freeable", F.col(grain.available) - F.col("needed"))


def dispensers_needed(
    hist: DataFrame, grain: Grain, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Dispensers needed and freeable per group and threshold (0: never reached)."""
    served = served_or_waiting(hist, grain).where(F.col(STATE) == SERVED)
    return _freeable(
        count_until_threshold(
            served, f"Perc_of_{grain.share_name}_vol", _group(grain), thresholds
        ),
        grain,
    )


def dispensers_needed_by_queue(
    hist: DataFrame, grain: Grain, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """The same per accepted queue length, judged by the cumulative share.

    Numbers of dispensers for which a queue length does not occur are not
    counted; they are not filled up with zero.
    """
    return _freeable(
        count_until_threshold(
            queue_lengths(hist, grain), "cum_vol_Perc_of_relevant_vol",
            [*_group(grain), "queue_length"], thresholds,
        ),
        grain,
    )


def wide_thresholds(
    df: DataFrame, keys: Sequence[str], thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """One column pair per threshold instead of one row per threshold."""
    aggs = []
    for t in thresholds:
        hit = F.col("threshold") == F.lit(float(t))
        aggs.append(F.max(F.when(hit, F.col("needed"))).alias(f"Dispenser_needed_for_{t}%_vol"))
        aggs.append(
            F.max(F.when(hit, F.col("freeable"))).alias(
                f"Freeable_dispensers_if_we_serve_{t}%_vol"
            )
        )
    return df.groupBy(*keys).agg(*aggs)
