"""Fill-in-the-middle rearrangement of whole texts, cut in code points with a memory of content-defined chunks."""

from __future__ import annotations

from bisect import bisect_right
from hashlib import sha256
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitebooks.llm.common import buffers, map_text, mix

# --- fixed values of the contract --------------------------------------------------
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
LEFT_PLAIN, SUFFIX_FIRST = 90, 20  # of 100: from here on plain; below here suffix first
# -----------------------------------------------------------------------------------
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
EDGE = max(map(len, SENTINELS)) - 1

#: Bytes of a chunk: none shorter (but the last), about MEAN longer on average, none longer by more than a character.
SHORTEST, MEAN, LONGEST = 128, 512, 4096
#: Bytes the rolling hash looks back at, and chunks a task remembers (it forgets all when full; results do not change).
WINDOW, REMEMBER = 32, 50_000
#: Digits of the length of an id.
KEY = 10

FIELDS = [
    T.StructField("n", T.LongType(), False),
    T.StructField("form", T.StringType(), False),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType(), False),
]


class Summary(NamedTuple):
    """What a run of bytes contributes: code points, whether a sentinel lies inside, and its first and last bytes."""

    chars: int
    marked: bool
    head: bytes
    tail: bytes

    @staticmethod
    def of(data: bytes) -> Summary:
        raw = np.frombuffer(data, np.uint8)
        chars = int(np.count_nonzero((raw & 0xC0) != 0x80))
        return Summary(chars, any(s in data for s in SENTINELS), data[:EDGE], data[-EDGE:])

    def then(self, other: Summary) -> Summary:
        """The summary of both runs in a row; a sentinel across the boundary is seen by the edge bytes alone."""
        seam = self.tail + other.head
        return Summary(
            self.chars + other.chars,
            self.marked or other.marked or any(s in seam for s in SENTINELS),
            self.head if len(self.head) == EDGE else (self.head + other.head)[:EDGE],
            (self.tail + other.tail)[-EDGE:],
        )


EMPTY = Summary(0, False, b"", b"")
GEAR = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


def rolling(raw: np.ndarray) -> np.ndarray:
    """At each byte a hash of the last WINDOW bytes: the sum of their gears, each shifted by its distance."""
    h, step = GEAR[raw], 1
    while step < WINDOW:  # the sum over 2 * step bytes from two sums over step bytes
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return h


def chunks(data: bytes, ends: list[int]) -> list[int]:
    """Chunk ends of a text, from the candidate ends in order; every end lies between two characters."""
    out, at, k, size = [], 0, 0, len(data)
    while size - at > SHORTEST:
        k = bisect_right(ends, at + SHORTEST - 1, k)
        end = ends[k] if k < len(ends) else size
        end = min(end, at + LONGEST, size)
        while end < size and data[end] & 0xC0 == 0x80:
            end += 1
        out.append(end)
        at = end
    if at < size:
        out.append(size)
    return out


class Memory:
    """Summaries of chunks by their hash; a hit counts only if the bytes are the same."""

    def __init__(self, remember: int = REMEMBER):
        self.remember, self.known, self.hits = remember, {}, 0

    def summary(self, chunk: bytes) -> Summary:
        key = xxhash.xxh3_64_intdigest(chunk)
        found = self.known.get(key)
        if found is not None and found[0] == chunk:
            self.hits += 1
            return found[1]
        made = Summary.of(chunk)
        if len(self.known) >= self.remember:
            self.known.clear()
        self.known[key] = (chunk, made)
        return made


def offset(data: bytes, start: int, end: int, chars: int) -> int:
    """The byte position behind ``chars`` characters of ``data[start:end]``."""
    if chars == 0:
        return start
    leads = np.flatnonzero((np.frombuffer(data, np.uint8, end - start, start) & 0xC0) != 0x80)
    return start + int(leads[chars]) if chars < len(leads) else end


def rearranged(data: bytes, ends: list[int], memory: Memory, key: str) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text, its chunk ends being ``ends``."""
    starts = [0, *ends[:-1]]
    parts = [memory.summary(data[a:b]) for a, b in zip(starts, ends)]
    total = EMPTY
    for part in parts:
        total = total.then(part)
    n = total.chars
    h = sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if n == 0 or total.marked or h3 % 100 >= LEFT_PLAIN:
        return n, "plain", None, None, data
    counts = list(accumulate(p.chars for p in parts))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))

    def position(chars: int) -> int:
        at = bisect_right(counts, chars)  # the first chunk that ends behind the cut
        if at == len(parts):
            return len(data)
        return offset(data, starts[at], ends[at], chars - (counts[at - 1] if at else 0))

    a, b = position(first), position(second)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", first, second - first, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", first, second - first, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def transformed(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """``doc_id`` and ``carry`` columns with ``n, form, prefix_chars, middle_chars, output``: each text for infilling.

    A text of n code points is cut in prefix, middle and suffix at two places
    drawn from the id, and its parts are put in the order prefix, suffix,
    middle (``psm``) or suffix, prefix, middle (``spm``) behind marks; empty
    texts, texts that hold a mark, and a tenth of all stay ``plain``.

    A rolling hash over 32 bytes cuts each text in chunks, so that passages
    that documents share become equal chunks.  A task remembers per chunk (by
    hash, then compared byte by byte) its number of code points, whether a mark
    lies inside, and its edges.  Summaries of consecutive chunks combine to
    that of the text; running sums of their counts tell in which chunk a cut
    lies, and only that chunk is looked into.

    A null or empty text is empty and plain; a null id is cut as the empty id;
    repeated rows are transformed each alike; an empty table gives no rows.
    Other columns, also those named like new ones, are left out unless carried.
    """
    source = documents.select(
        F.col(text).cast("string").alias("text"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("__key"),
        F.struct(*[F.col(c) for c in carry or [] if c not in {"doc_id", *(f.name for f in FIELDS)}], F.lit(0).alias("__0")).alias("__row"),
    )
    # Text and key travel as one column (behind the key's length), so that batches are still cut by the size of texts.
    size = F.lpad(F.octet_length("__key").cast("string"), KEY, "0")
    joined = source.select("doc_id", "__row", F.concat(size, "__key", F.coalesce("text", F.lit(""))).alias("__both"))

    def start():
        memory = Memory()

        def fn(both):
            raw, offsets = buffers(both)
            data, edges = raw.tobytes(), offsets.tolist()
            hits = np.flatnonzero(rolling(raw) < np.uint32((1 << 32) // (MEAN - SHORTEST))) + 1
            made = []
            for a, b in zip(edges, edges[1:]):
                cut = a + KEY + int(data[a : a + KEY])
                # The window must lie in the text, so that equal texts are cut alike wherever they stand.
                lo, hi = np.searchsorted(hits, (cut + WINDOW, b))
                one = data[cut:b]
                made.append(rearranged(one, chunks(one, (hits[lo:hi] - cut).tolist()), memory, data[a + KEY : cut].decode()))
            n, form, first, middle, output = zip(*made) if made else ((),) * 5
            return [
                pa.array(n, pa.int64()),
                pa.array(form, pa.string()),
                pa.array(first, pa.int64()),
                pa.array(middle, pa.int64()),
                pa.array(output, pa.binary()).cast(pa.string()),
            ]

        return fn

    found = map_text(joined, "__both", ["doc_id", "__row"], FIELDS, start)
    kept = [F.col(f"__row.{f.name}").alias(f.name) for f in source.schema["__row"].dataType.fields if f.name != "__0"]
    return found.select("doc_id", *kept, *[f.name for f in FIELDS])


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from: marks occur once each, as texts that hold one stay plain."""
    p, s, m = (F.lit(x.decode()) for x in SENTINELS)
    middle = F.split_part(output, m, F.lit(2))
    head = F.split_part(output, m, F.lit(1))
    psm = F.concat(F.substring(F.split_part(head, s, F.lit(1)), len(PREFIX) + 1, 2**31 - 1), middle, F.split_part(head, s, F.lit(2)))
    spm = F.concat(F.split_part(head, p, F.lit(2)), middle, F.substring(F.split_part(head, p, F.lit(1)), len(SUFFIX) + 1, 2**31 - 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(found: DataFrame) -> DataFrame:
    """Checksums of the output and of the text rebuilt from it."""
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
