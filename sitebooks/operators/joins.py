"""Equi-joins, cascading lookups and interval joins.

No join here is a cross join, and none is forced to broadcast: Spark picks a
broadcast from its own size estimate (``spark.sql.autoBroadcastJoinThreshold``)
and adaptive execution splits skewed partitions of shuffled joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitebooks.operators.intervals import open_counts


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys where null equals null; the left keys are kept."""
    pairs = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(pairs)
    test = None
    for left_key, right_key in pairs.items():
        one = F.col(left_key).eqNullSafe(F.col(right_key))
        test = one if test is None else test & one
    return left.join(right, test, how).drop(*pairs.values())


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    bring: Mapping[str, str],
    how: str = "left",
    trim: bool = False,
) -> DataFrame:
    """Bring dimension columns ``{dim column: new name}`` along ``{df key: dim key}``.

    ``trim=True`` compares trimmed keys; the keys are normalised before the
    join, so it stays an equi-join.
    """
    norm = (lambda c: F.trim(c.cast("string"))) if trim else (lambda c: c)
    side = dim.select(
        *[norm(F.col(d)).alias(f"_key_{i}") for i, d in enumerate(on.values())],
        *[F.col(src).alias(dst) for src, dst in bring.items()],
    )
    test = None
    for i, key in enumerate(on):
        one = norm(df[key]) == side[f"_key_{i}"]
        test = one if test is None else test & one
    return df.join(side, test, how).drop(*[f"_key_{i}" for i in range(len(on))])


def coalesce_lookup(
    df: DataFrame,
    out: str,
    first: Column,
    dims: Sequence[tuple[DataFrame, str, str, str]],
) -> DataFrame:
    """First non-null of ``first`` and the values of several lookups, in order.

    ``dims`` holds ``(dimension, df key, dim key, dim value)``.  Each dimension
    is reduced to one value per key before the join, so the lookup can never
    multiply rows; several values for one key resolve to the smallest.

    Dimensions asked by one key are merged to a row per key and joined once.  A
    row with a ``first`` value asks nothing, and rows that ask nothing are spread
    over the tasks (:func:`lookup_spread`).
    """
    by_key: dict[str, list[int]] = {}
    for i, (_, key, _, _) in enumerate(dims):
        by_key.setdefault(key, []).append(i)
    values = [F.col(f"_v{i}") for i in range(len(dims))]
    for key, numbers in by_key.items():
        parts = []
        for i in numbers:
            dim, _, dim_key, value = dims[i]
            empty = [(F.col(value) if j == i else F.lit(None)).alias(f"_v{j}") for j in numbers]
            parts.append(dim.where(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias("_k"), *empty))
        side = reduce(DataFrame.unionByName, parts).groupBy("_k").agg(*[F.min(f"_v{j}").alias(f"_v{j}") for j in numbers])
        df = lookup_spread(df, F.when(first.isNull(), F.col(key)), side, "_k")
    df = df.withColumn(out, F.coalesce(first, *values))
    return df.drop(*[f"_v{i}" for i in range(len(dims))])


def lookup_spread(
    df: DataFrame, key: Column, dim: DataFrame, dim_key: str, tasks: int = 4096, spread: Sequence[str] = ()
) -> DataFrame:
    """Left join to ``dim`` (unique in ``dim_key``) whose null keys are no hot key.

    Rows with a null ``key`` find nothing wherever they are, so a hash of the row
    deals them over ``tasks`` places instead of one.  ``spread`` names the columns
    to hash where a few tell rows apart: hashing all of them makes every step
    before carry all of them.  The dimension's other columns are added.
    """
    plain = [F.col(c) for c in spread] or [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    place = F.when(key.isNull(), F.pmod(F.xxhash64(*plain), F.lit(tasks)) + 1).otherwise(F.lit(0))
    left = df.withColumns({"_key": key, "_place": place})
    right = dim.withColumnRenamed(dim_key, "_dim_key").withColumn("_dim_place", F.lit(0).cast("long"))
    test = (F.col("_key") == F.col("_dim_key")) & (F.col("_place") == F.col("_dim_place"))
    return left.join(right, test, "left").drop("_key", "_place", "_dim_key", "_dim_place")


#: Bits of the map that :func:`may_match` sends to all tasks (32 MB, whatever the data).
MATCH_BITS = 1 << 28


def may_match(df: DataFrame, keys: Sequence[str], wanted: DataFrame, bits: int = MATCH_BITS) -> DataFrame:
    """Rows of ``df`` whose ``keys`` may occur in ``wanted``: all that do, and some others.

    The keys (same names on both sides, null equals null) are hashed to one of
    ``bits`` bits.  The bit map has a fixed size and is broadcast, so rows are
    dropped where they are read, before anything exchanges or sorts them.  About
    ``n / bits`` of the other rows stay for ``n`` keys wanted; an exact step must
    follow.
    """
    bit = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(bits))
    marks = (
        wanted.select(F.bitmap_bucket_number(bit).alias("_part"), F.bitmap_bit_position(bit).alias("_bit"))
        .repartition("_part")
        .groupBy("_part")
        .agg(F.bitmap_construct_agg("_bit").alias("_marks"))
    )
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("_marks", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = df.join(F.broadcast(marks), F.bitmap_bucket_number(bit) == F.col("_part"))
    return found.where(F.getbit(byte, (at % 8).cast("int")) == 1).drop("_part", "_marks")


def map_values(
    df: DataFrame, column: str, pairs: DataFrame, key: str, value: str, out: str | None = None
) -> DataFrame:
    """Replace values found in a two-column frame, keep the others."""
    side = pairs.groupBy(F.col(key).alias("_mk")).agg(F.max(value).alias("_mv"))
    joined = df.join(side, df[column] == side["_mk"], "left")
    return joined.withColumn(out or column, F.coalesce("_mv", df[column])).drop("_mk", "_mv")


def tolerance_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    seconds: int,
    how: str = "inner",
) -> DataFrame:
    """Equal keys and ``|left_ts - right_ts| <= seconds``, both ends included.

    Time is cut into buckets of the tolerance; a right row is offered to its own
    and both neighbouring buckets, so every pair meets exactly once and the
    bucket joins the equi keys.  A hot key is thereby spread over its buckets.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.  Right
    columns other than the keys must not share names with the left.
    """
    micros = seconds * 1_000_000
    names = {k: f"_r_{k}" for k in keys}
    near = right.withColumnsRenamed(names).withColumn(
        "_rb",
        F.explode(
            F.transform(
                F.array(F.lit(-1), F.lit(0), F.lit(1)),
                lambda d: F.floor(F.unix_micros(F.col(right_ts)) / micros) + d,
            )
        ),
    )
    probe = left.withColumn("_lb", F.floor(F.unix_micros(F.col(left_ts)) / micros))
    test = (F.col("_lb") == F.col("_rb")) & (
        F.abs(F.unix_micros(F.col(left_ts)) - F.unix_micros(F.col(right_ts))) <= micros
    )
    for key, renamed in names.items():
        test = test & (F.col(key) == F.col(renamed))
    return probe.join(near, test, how).drop("_lb", "_rb", *names.values())


#: Cells of this length are the leaves of the interval tree, and a node has this many children.
CELL_SECONDS, CHILDREN = 60, 4


def interval_nodes(start: Column, end: Column, cell_micros: int) -> Column:
    """The tree nodes ``(level, node)`` that make up the cells from ``start`` to ``end`` (both in microseconds, included).

    At each level the aligned nodes of the range that no node above holds, which
    are fewer than ``CHILDREN`` at each end: so their number grows with the
    logarithm of the length.  The nodes are disjoint.
    """
    lo, hi = F.floor(start / cell_micros).cast("long"), F.floor(end / cell_micros).cast("long")
    none = F.array().cast("array<long>")
    run = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(none)

    def at(level: Column) -> Column:
        size = F.pow(F.lit(float(CHILDREN)), level)
        low, high = F.ceil(lo / size).cast("long"), (F.floor((hi + 1) / size) - 1).cast("long")
        top, bottom = F.ceil(low / CHILDREN).cast("long"), (F.floor((high + 1) / CHILDREN) - 1).cast("long")
        ends = F.concat(run(low, top * CHILDREN - 1), run((bottom + 1) * CHILDREN, high))
        nodes = F.when(bottom < top, run(low, high)).otherwise(ends)
        return F.transform(nodes, lambda n: F.struct(level.alias("level"), n.alias("node")))

    highest = F.ceil(F.log(float(CHILDREN), (hi - lo + 1).cast("double"))).cast("int")
    return F.flatten(F.transform(F.sequence(F.lit(0), highest), at))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    cell_seconds: int = CELL_SECONDS,
    how: str = "left",
) -> DataFrame:
    """Pairs where the right interval is open when the left one starts.

    The test is ``right.start < left.start AND right.end >= left.start`` on
    equal keys; ``how`` is ``inner`` or ``left``.  Right columns come back with
    the prefix ``other_``.

    Time is a tree of aligned nodes.  A right interval is stored at the nodes
    that make it up (:func:`interval_nodes`), a left row asks the nodes above
    its start, of the levels in use, and each pair meets at one of them: a
    thousand years cost a few dozen rows, and a hot key is spread over its
    nodes.  Left rows without a pair are those that
    :func:`sitebooks.operators.intervals.open_counts` counts nothing for.  Use
    this where the pairs themselves are wanted; counting costs less.
    """
    micros = cell_seconds * 1_000_000
    other = right.select(*[F.col(c).alias(f"other_{c}") for c in right.columns])
    o_start, o_end = F.col(f"other_{start}"), F.col(f"other_{end}")
    stored = other.where(o_start < o_end).withColumn(
        "_at", F.explode(interval_nodes(F.unix_micros(o_start), F.unix_micros(o_end), micros))
    ).withColumns({"_level": F.col("_at.level"), "_node": F.col("_at.node")}).drop("_at")
    used = stored.select(F.array_sort(F.collect_set("_level")).alias("levels")).scalar()
    cell = F.floor(F.unix_micros(F.col(start)) / micros)
    probe = left.withColumn("_asked", F.explode(used)).withColumn(
        "_asked_node", F.floor(cell / F.pow(F.lit(float(CHILDREN)), F.col("_asked"))).cast("long")
    )
    test = (F.col("_asked") == F.col("_level")) & (F.col("_asked_node") == F.col("_node"))
    test = test & (o_start < F.col(start)) & (o_end >= F.col(start))
    for key in keys:
        test = test & (F.col(key) == F.col(f"other_{key}"))
    pairs = probe.join(stored, test).drop("_level", "_node", "_asked", "_asked_node")
    if how == "inner":
        return pairs
    counted = open_counts(left, right.withColumn("_one", F.lit(1)), keys, start, start, end, {"_open": "_one"})
    alone = counted.where("_open = 0").drop("_open")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields]
    return pairs.unionByName(alone.select(*left.columns, *nothing))
