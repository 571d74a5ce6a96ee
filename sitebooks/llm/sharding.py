"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces of a shard that are numbered apart, so that a shard is not one task.
PIECES = 256


def draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) decided by key and shard: 52 bits of an md5."""
    digest = F.md5(F.concat(key, F.lit(f":{shard}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def scored(key: Column, shard: int, weight: float) -> Column:
    """A shard's claim to a key, ``weight / -ln(draw)``; equal claims go to the smaller number."""
    return F.struct((F.lit(float(weight)) / -F.log(draw(key, shard))).alias("score"), F.lit(-shard).alias("order"))


def assign(
    documents: DataFrame,
    weights: list[float],
    grown_weight: float | None = None,
    key: str = "doc_id",
    text: str = "text",
    pieces: int = PIECES,
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``grown_shard`` of every row.

    Each shard's claim depends on the key, its number and its weight alone.  The
    largest claim wins, so shards fill in proportion to their weights, and one
    more shard (``grown_weight``, default the mean) only wins rows for itself.

    ``slot`` numbers the rows of a shard from 0 without gaps: rows are numbered
    within ``pieces`` pieces of a shard (by a hash of the row), and pieces follow
    each other by their counts, so no task holds a whole shard.  One exchange of
    the rows serves counts and numbers, so claims are made once.  Texts do not travel.

    A null text counts as empty; a null key is hashed as an empty key; repeated
    rows share a shard, in slots of their own; an empty table gives no rows;
    other columns are ignored.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    if grown_weight is None:
        grown_weight = sum(weights) / len(weights)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + F.lit(16)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"),
    )
    # Another hash than the claims': the row itself, so that repeated keys spread as well.
    row = F.concat_ws(":", "__key", "size", "text_crc32")
    piece = F.coalesce((F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("long") % pieces).cast("int"), F.lit(0))
    claims = [scored(F.col("__key"), i, w) for i, w in enumerate(weights)]
    best = F.greatest(*claims) if len(claims) > 1 else claims[0]
    rows = rows.select("*", best.alias("__best"), scored(F.col("__key"), len(weights), grown_weight).alias("__new"))
    rows = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        (-F.col("__best.order")).cast("int").alias("shard"),
        (-F.greatest("__best", "__new")["order"]).cast("int").alias("grown_shard"),
        piece.alias("piece"),
    )
    rows = rows.repartition("shard", "piece")
    inner = Window.partitionBy("shard", "piece").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("__row", F.row_number().over(inner) - 1)
    # The counts ask for every column, and no key can be null, so that both uses read the same exchange.
    last = F.max(F.struct("__row", "grown_shard"))["__row"]
    counts = numbered.groupBy("shard", "piece").agg((last + 1).cast("long").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n")
    first = counts.select(F.col("shard").alias("__shard"), F.col("piece").alias("__piece"), before.alias("__first"))
    joined = numbered.join(first, (F.col("shard") == F.col("__shard")) & (F.col("piece") == F.col("__piece")))
    slot = (F.col("__first") + F.col("__row")).cast("long").alias("slot")
    return joined.select("doc_id", "size", "text_crc32", "shard", slot, "grown_shard")
