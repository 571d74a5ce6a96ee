"""Removal of repeated passages, found by anchors at the positions of a difference cover."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitebooks.llm.common import NOT_SPACE, Words, buffers, inside, ngrams, slices
from sitebooks.runtime import materialise

#: Words of a window.
WINDOW = 13
#: A difference cover: for any two positions some shift below PERIOD brings both onto it.
PERIOD, COVER = 7, (0, 1, 3)
#: Words of an anchor: a window holds PERIOD anchors' starts, so each shared window shares an aligned anchor.
ANCHOR = WINDOW - PERIOD + 1
#: Bytes of text in a block of documents, hashes meant for one bucket, and bytes of a bucket's entries held before they are merged.
BLOCK, BUCKET, HELD = 2 << 20, 1 << 20, 32 << 20

LOW = (1 << 48) - 1
BLOCKS = T.StructType(
    [
        T.StructField("block", T.LongType(), False),
        T.StructField("ids", T.BinaryType(), False),
        T.StructField("offsets", T.BinaryType(), False),
        T.StructField("data", T.BinaryType(), False),
        T.StructField("bytes", T.LongType(), False),
    ]
)
NO_ID = np.iinfo(np.int64).min


def blocks(documents: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Documents in blocks: ids, offsets and the compressed bytes of their texts."""
    source = documents.select(F.col(text).cast("string"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)))

    def run(batches):
        number, pack = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch, 0, BLOCK):
                raw, offsets = buffers(part.column(0))
                row = [number, np.asarray(part.column(1)).tobytes(), offsets.tobytes(), pack.compress(raw.tobytes()), len(raw)]
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=BLOCKS.names)
                number += 1

    return source.mapInArrow(run, BLOCKS)


def opened(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, Words]:
    """Ids and words of a block."""
    ids, offsets, data = (batch.column(batch.schema.get_field_index(c))[i].as_py() for c in ("ids", "offsets", "data"))
    raw = zstandard.ZstdDecompressor().decompress(data) if data else b""
    n = len(ids) // 8
    texts = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(raw))
    return np.frombuffer(ids, np.int64), Words(texts, NOT_SPACE)


def anchors(ids: np.ndarray, words: Words, h: np.ndarray):
    """Positions and hashes of the anchors of documents that have a window and an id.

    The high bits of a hash number its bucket, its 48 low bits are what is sent there.
    """
    own = ids != NO_ID
    fit = np.repeat((words.count >= WINDOW) & own, words.count)
    place = np.arange(len(h)) - np.repeat(words.of[:-1], words.count)
    at = np.flatnonzero(words.whole(ANCHOR))
    at = at[fit[at] & np.isin(place[at] % PERIOD, COVER)]
    return at, ngrams(h, ANCHOR)[at]


def windows(ids: np.ndarray, words: Words, h: np.ndarray):
    """Starts of all windows of documents with an id."""
    at = np.flatnonzero(words.whole(WINDOW))
    return at[np.repeat(ids != NO_ID, words.count)[at]]


PAIR = np.dtype([("h", "<u8"), ("g", "<u4")])


def digests(words: Words, h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """96-bit hashes of the windows starting at ``at``."""
    out = np.empty(len(at), PAIR)
    out["h"] = ngrams(h, WINDOW)[at]
    out["g"] = ngrams(words.hashes(1), WINDOW, 1)[at] >> np.uint64(32)
    return out


def ordered(rows: np.ndarray) -> np.ndarray:
    return np.lexsort((rows["g"], rows["h"]))


def heads(rows: np.ndarray) -> np.ndarray:
    """Where a new value starts in sorted rows."""
    return np.r_[True, (rows["h"][1:] != rows["h"][:-1]) | (rows["g"][1:] != rows["g"][:-1])] if len(rows) else np.empty(0, bool)


def packed(ids: np.ndarray) -> bytes:
    """Ids as the smallest one and each one's distance from it, in four bytes if all fit, else in eight."""
    low = ids.min()
    apart = ids.view(np.uint64) - low.view(np.uint64)
    return low.tobytes() + (apart.astype(np.uint32) if apart.max() < 1 << 32 else apart).tobytes()


def unpacked(data: bytes, count: int) -> np.ndarray:
    """The ids of :func:`packed`."""
    low = np.frombuffer(data, np.uint64, 1)
    apart = np.frombuffer(data, np.uint32 if len(data) == 8 + 4 * count else np.uint64, count, 8)
    return (low + apart).view(np.int64)


def emit(bucket: np.ndarray, block: int, parts: list[np.ndarray], last=np.ndarray.tobytes):
    """One row per bucket: the block and the bytes of each part's entries (all sorted by bucket); ``last`` writes the last part's."""
    if not len(bucket):
        return
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    edges = [*first.tolist(), len(bucket)]
    form = [np.ndarray.tobytes] * (len(parts) - 1) + [last]
    columns = [pa.array([f(p[a:b]) for a, b in zip(edges, edges[1:])], pa.binary()) for f, p in zip(form, parts)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[first].astype(np.int32)), pa.array(np.full(len(first), block), pa.int64()), *columns],
        names=["bucket", "block", *[f"p{i}" for i in range(len(parts))]],
    )


def by_bucket(rows: DataFrame, merge, entries, held: int = HELD) -> DataFrame:
    """Rows ``(block, answer)``: what each bucket tells the blocks that sent entries to it.

    A bucket is read as a stream.  ``entries(parts)`` gives the entries of some of
    its rows as an array with a field ``block``; whenever ``held`` bytes of rows
    have gathered, and at the end, ``merge(entries)`` gives the blocks to answer,
    the answers, and the entries to go on with.  It goes on with one entry per
    hash (and equal smallest ids), so a hash that every block sends costs no memory.
    """

    def run(batches):
        bucket, parts, size, kept = None, [], 0, None

        def merged():
            new = entries(parts)
            return merge(new if kept is None else np.concatenate([kept, new]))

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[0] != bucket or size >= held:
                    if parts:
                        block, told, kept = merged()
                        yield from answers(block, told)
                    if row[0] != bucket:
                        kept = None
                    bucket, parts, size = row[0], [], 0
                parts.append(row[1:])
                size += sum(map(len, row[2:]))
        if parts:
            yield from answers(*merged()[:2])

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "block long, answer binary")


def answers(block: np.ndarray, rows: np.ndarray):
    """Rows (block, bytes of its rows) from a block number per row."""
    order = np.argsort(block, kind="stable")
    block, rows = block[order], rows[order]
    first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.empty(0, np.int64)
    edges = [*first.tolist(), len(block)]
    for a in range(0, len(first), 1000):
        some = range(a, min(a + 1000, len(first)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(block[first[a : a + 1000]], pa.int64()), pa.array([rows[edges[i] : edges[i + 1]].tobytes() for i in some], pa.binary())],
            names=["block", "answer"],
        )


FULL = np.dtype([("h", "<u8"), ("g", "<u4"), ("doc", "<i8")])
#: Entries of a bucket: an anchor's 6 bytes (``done``: its block has its answer), and a window with a block's smallest id.
ANCHORS = np.dtype([("key", "V6"), ("block", "<i8"), ("done", "?")])
WINDOWS = np.dtype([*FULL.descr, ("block", "<i8")])


def wide(low: np.ndarray) -> np.ndarray:
    """Numbers from their 6 low bytes."""
    out = np.zeros((len(low), 8), np.uint8)
    out[:, :6] = np.ascontiguousarray(low).view(np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def shared(rows: np.ndarray):
    """Anchors that two blocks have, for each block without its answer; one entry per anchor stays."""
    keys = wide(rows["key"])
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order]
    same = keys[1:] == keys[:-1]
    twice = np.r_[False, same] | np.r_[same, False]
    told = rows[twice & ~rows["done"]]
    rows["done"] |= twice
    return told["block"], told["key"], rows[np.r_[True, ~same]]


def smaller(rows: np.ndarray):
    """Windows of which another block has a smaller id, for each block; the entries with the smallest ids stay.

    A block sent its smallest id, so what it is told holds for all its documents.
    """
    rows = rows[np.lexsort((rows["doc"], rows["g"], rows["h"]))]
    new = heads(rows)
    low = rows["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
    beaten = low < rows["doc"]
    told = np.empty(int(beaten.sum()), PAIR)
    told["h"], told["g"] = rows["h"][beaten], rows["g"][beaten]
    return rows["block"][beaten], told, rows[~beaten]


def deduplicated(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", held: int = HELD) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: texts without passages that a smaller id has too.

    A word goes if a window of 13 words over it also starts in a document with
    a smaller id; ``kept`` are the other words, joined by one space.  Windows
    are those of the input, so the result does not depend on any order.

    1. Blocks of documents are written to the shared folder.
    2. Each block sends the hashes of its 7-word anchors at the positions of the
       difference cover, once each, to buckets; a bucket tells the blocks which
       of their anchors another block has.  Two equal windows start their
       anchors at positions that some shift below the period brings onto the
       cover together, so every shared window holds a shared anchor.
    3. Windows around shared anchors are extended: hashed whole (96 bits) and
       sent, once per block and with the smallest id, to buckets, which answer
       if another block has a smaller id.
    4. Each block compares its windows among themselves and with the answers.

    However often a passage occurs, a block sends it once, and a bucket merges
    what it has read whenever ``held`` bytes have gathered, so a passage that
    all blocks have costs no memory.  The number of buckets follows the amount
    of text.

    Null and empty texts have no words; rows with a null id keep all words and
    remove none elsewhere; repeated rows have the same id, so they remove
    nothing from each other; an empty table gives no rows; other columns are
    ignored.
    """
    spark = documents.sparkSession
    table = materialise(blocks(documents, text, doc_id), "text-blocks")
    total = table.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    least = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // 12 // BUCKET)
    bits = min(30, max(1, int(least - 1).bit_length()))

    def send_anchors(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, words = opened(batch, i)
                _, keys = anchors(ids, words, words.hashes(0))
                keys = np.unique(keys)
                low = np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :6])
                yield from emit(keys >> np.uint64(64 - bits), batch.column(0)[i].as_py(), [low])

    def marks(parts):
        sizes = [len(p[1]) // 6 for p in parts]
        rows = np.zeros(sum(sizes), ANCHORS)
        rows["key"] = np.frombuffer(b"".join(p[1] for p in parts), "V6")
        rows["block"] = np.repeat([p[0] for p in parts], sizes)
        return rows

    # The bucket of an anchor is not in the answer; a block finds it again in its own anchors.
    first = by_bucket(
        table.select("block", "ids", "offsets", "data").mapInArrow(send_anchors, "bucket int, block long, p0 binary"),
        shared,
        marks,
        held,
    )
    lists = lambda rows: rows.groupBy("block").agg(F.collect_list("answer").alias("answers")).withColumnRenamed("block", "to")
    base = table.select("block", "ids", "offsets", "data")
    told = lists(first)
    one = base.join(told, F.col("block") == F.col("to"), "left").select("block", "ids", "offsets", "data", "answers")

    def send_windows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, words = opened(batch, i)
                h = words.hashes(0)
                at, keys = anchors(ids, words, h)
                if not len(at):
                    continue
                doc = words.doc()
                low = keys & np.uint64(LOW)
                order = np.lexsort((doc[at], keys))
                k, d = keys[order], doc[at][order]
                twice = np.unique(k[1:][(k[1:] == k[:-1]) & (d[1:] != d[:-1])])
                known = np.isin(keys, twice)
                if told_here := batch.column(4)[i].as_py():
                    known |= np.isin(low, wide(np.frombuffer(b"".join(told_here), "V6")))
                cover = np.zeros(len(h) + 1, np.int64)
                hit = at[known]
                np.add.at(cover, np.maximum(hit - (PERIOD - 1), words.of[:-1][doc[hit]]), 1)
                np.add.at(cover, hit + 1, -1)
                near = np.cumsum(cover[:-1]) > 0
                starts = windows(ids, words, h)
                starts = starts[near[starts]]
                rows = np.empty(len(starts), FULL)
                found = digests(words, h, starts)
                rows["h"], rows["g"], rows["doc"] = found["h"], found["g"], ids[doc[starts]]
                rows = rows[np.lexsort((rows["doc"], rows["g"], rows["h"]))]
                rows = rows[heads(rows)]
                pair = np.empty(len(rows), PAIR)
                pair["h"], pair["g"] = rows["h"], rows["g"]
                yield from emit(rows["h"] >> np.uint64(64 - bits), batch.column(0)[i].as_py(), [pair, rows["doc"].copy()], packed)

    def arrived(parts):
        sizes = [len(p[1]) // PAIR.itemsize for p in parts]
        rows = np.empty(sum(sizes), WINDOWS)
        pair = np.frombuffer(b"".join(p[1] for p in parts), PAIR)
        rows["h"], rows["g"], rows["block"] = pair["h"], pair["g"], np.repeat([p[0] for p in parts], sizes)
        rows["doc"] = np.concatenate([unpacked(p[2], n) for p, n in zip(parts, sizes)])
        return rows

    second = by_bucket(one.mapInArrow(send_windows, "bucket int, block long, p0 binary, p1 binary"), smaller, arrived, held)
    two = base.join(lists(second), F.col("block") == F.col("to"), "left").select("block", "ids", "offsets", "data", "answers")

    def keep(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, words = opened(batch, i)
                h, doc = words.hashes(0), words.doc()
                at = windows(ids, words, h)
                rows = np.empty(len(at), FULL)
                found = digests(words, h, at)
                rows["h"], rows["g"], rows["doc"] = found["h"], found["g"], ids[doc[at]]
                beaten = np.frombuffer(b"".join(batch.column(4)[i].as_py() or []), PAIR)
                told_here = np.empty(len(beaten), FULL)
                told_here["h"], told_here["g"], told_here["doc"] = beaten["h"], beaten["g"], NO_ID  # some smaller id: before all ids
                # Only windows that occur twice in the block, or that an answer names, can go.
                every = np.concatenate([rows["h"], told_here["h"]])
                every.sort()
                twice = np.unique(every[1:][every[1:] == every[:-1]])
                some = np.flatnonzero(inside(rows["h"], twice))
                joined = np.concatenate([rows[some], told_here])
                order = np.lexsort((joined["doc"], joined["g"], joined["h"]))
                new = heads(joined[order])
                low = np.empty(len(joined), np.int64)
                low[order] = joined["doc"][order][np.flatnonzero(new)][np.cumsum(new) - 1] if len(joined) else 0
                gone = at[some[low[: len(some)] < rows["doc"][some]]]
                steps = np.zeros(len(h) + 1, np.int64)
                np.add.at(steps, gone, 1)
                np.add.at(steps, gone + WINDOW, -1)
                stay = np.cumsum(steps[:-1]) == 0
                removed = np.bincount(doc[~stay], minlength=words.texts)
                data = words.raw.tobytes()
                begin, end = words.start.tolist(), words.end.tolist()
                kept = []
                for t in range(words.texts):
                    a, b = int(words.of[t]), int(words.of[t + 1])
                    span = range(a, b) if not removed[t] else (a + np.flatnonzero(stay[a:b])).tolist()
                    kept.append(b" ".join([data[begin[j] : end[j]] for j in span]))
                for lo in range(0, words.texts, 500):
                    cut = slice(lo, lo + 500)
                    own = ids[cut]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own, pa.int64(), mask=own == NO_ID),
                            pa.array(words.count[cut], pa.int64()),
                            pa.array(removed[cut], pa.int64()),
                            pa.array(kept[cut], pa.binary()).cast(pa.string()),
                        ],
                        names=["doc_id", "n_words", "n_removed", "kept"],
                    )

    return two.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")
