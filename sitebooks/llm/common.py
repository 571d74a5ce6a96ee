"""Shared pieces: running numpy code over whole texts in Arrow batches, hashing words, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitebooks.runtime import materialise, prepare

#: Bytes of text handled at once.  A longer single text is handled alone and whole.
CHUNK = 1 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Session settings for the operators here: Arrow batches of few rows, as texts may be long."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` with about ``limit`` bytes in a string column, one row at least."""
    sizes = np.nan_to_num(np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.float64))
    part = (np.cumsum(sizes) // limit).astype(np.int64)
    edges = np.flatnonzero(np.diff(part)) + 1 if len(part) else np.empty(0, np.int64)
    first = 0
    for edge in [*edges.tolist(), batch.num_rows]:
        if edge > first:
            yield batch.slice(first, edge - first)
            first = edge


def map_text(
    df: DataFrame, text: str, carry: list[str], fields: list[T.StructField], start: Callable[[], Callable], limit: int = CHUNK
) -> DataFrame:
    """Add columns computed from whole texts, in Python tasks and without a shuffle.

    ``start()`` runs once per task and gives ``fn(texts)``, which takes an Arrow
    string array (null where the text is null) and gives one Arrow array per
    field.  Columns in ``carry`` are kept; a carried column named as a new
    field is replaced by it, other columns are left out.
    """
    carry = [c for c in dict.fromkeys(carry) if c not in {f.name for f in fields}]
    source = df.select(F.col(text).cast("string").alias("__text"), *[F.col(c) for c in carry if c != text])
    both = text in carry  # it travels once
    kept = [T.StructField(text, T.StringType())] if both else []
    kept += source.schema.fields[1:]

    def run(batches):
        fn = start()
        for batch in batches:
            for part in slices(batch, 0, limit):
                made = fn(part.column(0))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[0 if both else 1 :], *made], names=[f.name for f in [*kept, *fields]]
                )

    return source.mapInArrow(run, T.StructType([*kept, *fields]))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets of the texts in them; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if texts.offset:
        texts = pa.concat_arrays([texts.slice(0)])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


# --- words and their hashes -------------------------------------------------------


def byte_class(pattern_bytes: list[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[pattern_bytes] = True
    return table


#: Bytes of words: everything but white space; digits, a-z and non-ASCII (after lower-casing A-Z).
NOT_SPACE = ~byte_class([0x20, *range(0x09, 0x0E)])
ALNUM = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, made as far as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.empty(0, np.uint64)

    def reach(self, n: int) -> Powers:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, x in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, x, np.uint64)
                steps[:1] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self


WORD_POWERS = (Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F))
#: Odd numbers and offsets of the two hashes of a word.
SEEDS = ((0x9E3779B97F4A7C15, 0x9FB21C651E98DF25), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Words:
    """The words of several texts: byte spans and, per text, the range of word numbers.

    ``of[i]:of[i + 1]`` are the words of text i; ``start``, ``end`` are byte
    positions in ``raw`` (after ``table``, such as :data:`LOWER`, was applied).
    """

    def __init__(self, texts: pa.Array, is_word: np.ndarray, table: np.ndarray = SAME):
        raw, offsets = buffers(texts)
        self.raw = raw if table is SAME else table[raw]
        inside = is_word[self.raw]
        before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        filled = offsets[1:] > offsets[:-1]
        before[offsets[:-1][filled]] = False
        after[offsets[1:][filled] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.of = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.of)
        self.texts = len(texts)
        self._lanes = None

    def lanes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of the words in lanes of eight, filled up with zeros; each lane's number in its word; each word's first lane."""
        if self._lanes is None:
            size = self.end - self.start
            times = (size + 7) >> 3
            first = np.cumsum(times) - times
            number = np.arange(int(times.sum())) - np.repeat(first, times)
            at = np.repeat(self.start, times) + 8 * number
            behind = np.ndarray(len(self.raw) + 1, "<u8", np.concatenate([self.raw, np.zeros(8, np.uint8)]), strides=(1,))
            short = np.maximum(8 - np.repeat(size, times) + 8 * number, 0).astype(np.uint64) << np.uint64(3)
            self._lanes = behind[at] & (np.uint64(2**64 - 1) >> short), number, first
        return self._lanes

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; two seeds give independent hashes.

        Every lane is mixed with its number before the sum, so that no exchange
        of bytes between places of a long word leaves the sum as it is.
        """
        if not len(self.start):
            return np.empty(0, np.uint64)
        lane, number, first = self.lanes()
        odd, start = (np.uint64(x) for x in SEEDS[seed])
        salt = mix((np.arange(int(number.max()) + 1, dtype=np.uint64) + np.uint64(1)) * odd + start)
        sums = np.add.reduceat(mix(lane * odd ^ salt[number]), first)
        return mix(sums + (self.end - self.start).astype(np.uint64) * start)

    def same(self, other: np.ndarray) -> np.ndarray:
        """For each word whether its bytes are those of word ``other`` (a word number each)."""
        if not len(self.start):
            return np.empty(0, bool)
        lane, _, first = self.lanes()
        size = self.end - self.start
        times = (size + 7) >> 3
        out = size == size[other]
        shift = np.repeat(np.where(out, first[other] - first, 0), times)
        return out & np.logical_and.reduceat(lane == lane[np.arange(len(lane)) + shift], first)

    def doc(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(self.texts), self.count)

    def whole(self, n: int) -> np.ndarray:
        """For each word number that could start n words: whether they lie in one text."""
        m = max(0, len(self.start) - n + 1)
        return np.arange(n, n + m) <= np.repeat(self.of[1:], self.count)[:m]


def ngrams(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of every n consecutive word hashes (texts run into each other: see ``Words.whole``)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    p = WORD_POWERS[seed].reach(len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * p.up[: len(words)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * p.down[:m])


def inside(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted array; a bit table keeps most values from the search."""
    if not len(ordered) or not len(values):
        return np.zeros(len(values), bool)
    bits = min(22, max(10, int(len(ordered)).bit_length() + 3))
    table = np.zeros(1 << bits, bool)
    table[(ordered >> np.uint64(64 - bits)).astype(np.int64)] = True
    found = table[(values >> np.uint64(64 - bits)).astype(np.int64)]
    at = np.flatnonzero(found)
    place = np.minimum(np.searchsorted(ordered, values[at]), len(ordered) - 1)
    found[at] = ordered[place] == values[at]
    return found


# --- connected components ---------------------------------------------------------


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """``(node, root)`` for every node of the ``(a, b)`` edges; the root is the component's smallest node.

    Alternates stars around the smallest neighbour until nothing changes; each
    round is written to the shared folder, so that lost executors cost no more
    than a round.  A node with very many edges is a skewed join key, which
    adaptive execution splits; minima are combined before the shuffle.
    """

    def summary(df):
        return tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0))).first())

    now = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    seen = summary(now)
    while seen[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("k"), F.least("low", "a").alias("low"))
        large = both.join(low, F.col("a") == F.col("k")).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "k")
        small = large.join(low, F.col("a") == F.col("k")).select(
            F.explode(
                F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct(F.col("a"), F.col("low").alias("b")))
            ).alias("e")
        )
        now = materialise(small.select("e.a", "e.b").where("a != b").distinct(), label)
        last, seen = seen, summary(now)
        if last == seen:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
