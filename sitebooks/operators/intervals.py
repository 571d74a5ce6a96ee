"""Matching and counting on the time axis without pairing rows.

The operators merge their two inputs into one time-ordered stream per key and
read the answer off a running window.  Their cost is one sort of the input, no
matter how many pairs would meet, and the stream of a key is cut into time
buckets so that a hot key is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a time bucket.  It only balances work: a key's stream is split at
#: bucket ends, and narrower buckets split a hot key further.
BUCKET_SECONDS = 900


def _bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / (seconds * 1_000_000)).cast("long")


def packed(df: DataFrame) -> Column:
    """All columns as a one-element array: null in the rows that only steer a window.

    Spark would spread a plain struct over one column per field, which every
    steering row would then carry.
    """
    return F.array(F.struct(*[F.col(c) for c in df.columns]))


def _all_known(*names: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def match_nearest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    seconds: int,
    out: str = "matched_at",
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Add to each left row the nearest right instant with equal keys within ``seconds``.

    Both ends of the tolerance are included; of two equally near instants the
    earlier one wins; ``out`` is null when there is none (also for null keys or
    a null instant), so one call yields the match and the anti-match.

    A left row sits in one time bucket; a right row is offered to every bucket its
    reach extends into (three at most), so a left row sees all right rows within
    the tolerance.  Rows that cannot match are spread over buckets by a hash, so
    that the left side is read once and null keys are no hot key.
    """
    width = max(bucket_seconds, seconds)
    reach_by = F.make_dt_interval(secs=F.lit(seconds))
    usable = _all_known(*keys, left_ts)
    payload = packed(left)
    plain = [F.col(f.name) for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    probes = left.select(
        *keys,
        F.when(usable, _bucket(F.col(left_ts), width))
        .otherwise(F.pmod(F.xxhash64(*plain), F.lit(1 << 16)))
        .alias("_b"),
        F.col(left_ts).alias("_t"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast("timestamp").alias("_ref"),
        payload.alias("_row"),
    )
    refs = (
        right.where(_all_known(*keys, right_ts))
        .select(*keys, F.col(right_ts).cast("timestamp").alias("_ref"))
        .distinct()
        .withColumn(
            "_b",
            F.explode(
                F.sequence(
                    _bucket(F.col("_ref") - reach_by, width),
                    _bucket(F.col("_ref") + reach_by, width),
                )
            ),
        )
        .select(
            *keys,
            "_b",
            F.col("_ref").alias("_t"),
            F.lit(0).alias("_kind"),
            "_ref",
            F.lit(None).cast(probes.schema["_row"].dataType).alias("_row"),
        )
    )
    stream = probes.unionByName(refs)
    place = Window.partitionBy("_b", *keys)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    # The later neighbour is a running value of the reversed order: a frame that
    # runs to the end of the partition would be recomputed for every row.
    before = F.last("_ref", ignorenulls=True).over(
        place.orderBy(F.col("_t"), F.col("_kind")).rowsBetween(*so_far)
    )
    after = F.last("_ref", ignorenulls=True).over(
        place.orderBy(F.col("_t").desc(), F.col("_kind")).rowsBetween(*so_far)
    )
    micros = seconds * 1_000_000
    reach = lambda ref: F.abs(F.unix_micros(F.col("_t").cast("timestamp")) - F.unix_micros(ref))
    return (
        stream.withColumn("_before", before)
        .withColumn("_after", after)
        .where("_kind = 1")
        .withColumn("_db", reach(F.col("_before")))
        .withColumn("_da", reach(F.col("_after")))
        .withColumn(
            out,
            F.when(
                (F.col("_db") <= micros)
                & (F.col("_da").isNull() | (F.col("_db") <= F.col("_da"))),
                F.col("_before"),
            ).when(F.col("_da") <= micros, F.col("_after")),
        )
        .select(F.inline("_row"), out)
    )


def interval_steps(start: str, end: str, live: Column) -> list[Column]:
    """The two steps of an interval, null where it is not ``live``.

    A step is ``(_t, _kind, _sign)``: one up at the start, one down at the end,
    whatever lies between.  Steps follow what is asked at the same instant.
    """
    step = lambda at, sign: F.struct(
        F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.lit(sign).alias("_sign")
    )
    return [F.when(live, step(start, 1)), F.when(live, step(end, -1))]


def running_counts(
    stream: DataFrame, keys: Sequence[str], names: Sequence[str], bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """Answer the questions of a step stream.

    The stream has the keys, ``_t``, ``_kind``, one column of signed steps per
    name and ``_row``, which holds the asking row (kind 0) or null.

    It is cut into time buckets.  The steps of each bucket are summed before the
    shuffle, and the running sum of these few sums is what is open when a bucket
    begins (its carry); it joins the bucket's stream as a first row.  So the
    cost does not depend on how long intervals are, and the buckets of a hot key
    are worked on apart.  Questions without a time are told 0.
    """
    cut = stream.withColumn("_b", _bucket(F.col("_t"), bucket_seconds))
    sums = cut.groupBy(*keys, "_b").agg(*[F.sum(n).alias(n) for n in names])
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        sums.select(*keys, "_b", *[F.sum(n).over(earlier).alias(n) for n in names])
        .where(reduce(lambda a, b: a | b, [F.col(n) != 0 for n in names]))
        .select(
            *keys,
            "_b",
            F.lit(None).cast("timestamp").alias("_t"),
            F.lit(-1).alias("_kind"),
            *names,
            F.lit(None).cast(stream.schema["_row"].dataType).alias("_row"),
        )
    )
    so_far = (
        Window.partitionBy("_b", *keys)
        .orderBy("_t", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cut.unionByName(carry)
        .select("_kind", "_row", *[F.sum(n).over(so_far).alias(f"_n_{n}") for n in names])
        .where("_kind = 0")
        .select(F.inline("_row"), *[F.col(f"_n_{n}").alias(n) for n in names])
    )


#: Kinds of intervals that one stream can tell apart.
SLOTS = 32
#: Width of a time bucket of :func:`slot_counts`; like the other it only balances work.
SLOT_SECONDS = 6 * 3600


def slot_counts(
    stream: DataFrame, keys: Sequence[str], slots: int = SLOTS, bucket_seconds: int = SLOT_SECONDS
) -> DataFrame:
    """Answer questions about several kinds of intervals at once: a running vector of what is open.

    The stream has the keys, ``_t``, and either ``_slot`` and ``_sign`` (a step of
    the kind ``_slot``) or ``_row`` (a row asking just before the steps of its
    instant).  The asking rows come back with ``_open``, the number open of each
    kind.

    The stream is exchanged once, by keys and time bucket, and read twice from
    there: summed per bucket, and in order.  The running sum of the sums is what
    is open when a bucket begins; it joins the bucket's rows where they are.
    Only sums and asked buckets are exchanged for it.  A sum is a vector, so a
    bucket must hold many steps: most sites have a few in a quarter of an hour.
    """
    cut = stream.withColumn("_b", _bucket(F.col("_t"), bucket_seconds)).repartition(*keys, "_b")
    change = [F.when(F.col("_slot") == j, F.col("_sign")) for j in range(slots)]
    # Every column of the stream is used in the sums, so that both readers ask for the same exchange.
    sums = cut.groupBy(*keys, "_b").agg(
        F.count("_row").alias("_asked"), F.min("_t").alias("_first"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"_{j}") for j, c in enumerate(change)]
    )
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    names = {k: f"_at_{k}" for k in [*keys, "_b"]}
    carry = (
        sums.select(*[F.col(k).alias(n) for k, n in names.items()], "_asked", "_first", F.array(*[F.sum(f"_{j}").over(earlier) for j in range(slots)]).alias("_carry"))
        .where((F.col("_asked") > 0) & F.col("_first").isNotNull() & F.exists("_carry", lambda n: n != 0))
        .select(*names.values(), "_carry")
    )
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(n) for k, n in names.items()])
    so_far = (
        Window.partitionBy(*keys, "_b")
        .orderBy("_t", "_after")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    zero = F.lit(0).cast("long")
    # Sorted before the window's inputs, a column per slot, are computed; the window keeps this order.
    in_order = cut.withColumn("_after", F.col("_row").isNull()).sortWithinPartitions(*keys, "_b", "_t", "_after")
    running = [F.coalesce(F.sum(c).over(so_far), zero) for c in change]
    # The carry joins behind the window, in its order: before it, the sort would hold it with every row.
    asked = in_order.select(*keys, "_b", "_row", F.array(*running).alias("_run")).where("_row IS NOT NULL")
    total = [F.col("_run")[j] + F.coalesce(F.col("_carry")[j], zero) for j in range(slots)]
    return asked.join(carry, same, "left").select(F.inline("_row"), F.array(*total).alias("_open"))


def open_counts(
    probes: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    weights: Mapping[str, str],
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Add to each probe the weight of the intervals open just before it.

    An interval counts for a probe with equal keys when ``start < at`` and
    ``end >= at``.  ``weights`` maps output columns to integer columns of
    ``intervals`` (a column of ones counts them).  Intervals that do not end
    after they start are never open; null keys never match.

    Sweep line: an interval adds its weight at ``start`` and takes it back after
    ``end``, and a probe reads the running sum (:func:`running_counts`).
    """
    live = F.coalesce(_all_known(*keys) & (F.col(start) < F.col(end)), F.lit(False))
    steps = (
        intervals.withColumn("_step", F.explode(F.array(*interval_steps(start, end, live))))
        .where("_step IS NOT NULL")
        .select(
            *keys,
            F.col("_step._t").cast("timestamp").alias("_t"),
            "_step._kind",
            *[(F.col(w) * F.col("_step._sign")).cast("long").alias(n) for n, w in weights.items()],
        )
    )
    asked = probes.select(
        *keys,
        F.col(at).cast("timestamp").alias("_t"),
        F.lit(0).alias("_kind"),
        *[F.lit(0).cast("long").alias(n) for n in weights],
        packed(probes).alias("_row"),
    )
    no_row = F.lit(None).cast(asked.schema["_row"].dataType)
    return running_counts(
        asked.unionByName(steps.withColumn("_row", no_row)), keys, list(weights), bucket_seconds
    )
