"""Benchmark decontamination by winnowing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitebooks.llm.common import ALNUM, LOWER, Words, inside, map_text, ngrams

#: Words of a window, and of the k-grams whose smallest hash is kept per window.
WINDOW, KGRAM = 13, 7
#: Bytes of benchmark text that one pass holds in memory; a larger benchmark takes several passes.
BLOCK = 32 << 20

HITS = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]), False)
FIELDS = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("hits", HITS, False),
    T.StructField("items", T.ArrayType(T.StringType(), False), False),
]


def smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive hashes."""
    m = len(hashes) - width + 1
    if m <= 0:
        return np.empty(0, hashes.dtype)
    low = hashes[:m].copy()
    for i in range(1, width):
        np.minimum(low, hashes[i : i + m], out=low)
    return low


class Index:
    """Winnowed fingerprints and window hashes of benchmark items.

    Items of fewer than ``WINDOW`` words are one window each; they are kept by
    length and looked up at every position (a window of one k-gram).
    """

    def __init__(self, ids: list[str], texts: list[str]):
        self.ids = ids
        words = Words(pa.array(texts, pa.string()), ALNUM, LOWER)
        h, g, doc = words.hashes(0), words.hashes(1), words.doc()
        self.prints = np.unique(smallest(ngrams(h, KGRAM), WINDOW - KGRAM + 1)[words.whole(WINDOW)])
        self.windows = {WINDOW: self._windows(h, g, doc, words.whole(WINDOW), WINDOW)}
        for n in {int(c) for c in words.count if 0 < c < WINDOW}:
            at = np.zeros(len(h), bool)
            at[words.of[:-1][words.count == n]] = True
            self.windows[n] = self._windows(h, g, doc, at[: len(h) - n + 1], n)

    @staticmethod
    def _windows(h, g, doc, at, n):
        """Sorted window hashes with check hashes and item numbers, one row per window and item."""
        rows = np.zeros(int(at.sum()), [("h", "u8"), ("g", "u8"), ("item", "i8")])
        rows["h"], rows["g"], rows["item"] = ngrams(h, n)[at], ngrams(g, n, 1)[at], doc[: len(at)][at]
        return np.unique(rows)

    def find(self, texts: pa.Array):
        """Per text: number of words, hit ranges of word numbers, sorted ids of the items found."""
        words = Words(texts, ALNUM, LOWER)
        h, g, doc = words.hashes(0), words.hashes(1), words.doc()
        steps = np.zeros(len(h) + 1, np.int64)
        found = []
        for n, rows in self.windows.items():
            whole = words.whole(n)
            if not len(rows) or not whole.any():
                continue
            starts = np.flatnonzero(whole)
            if n == WINDOW:  # a run of windows with the same smallest hash is one fingerprint
                low = smallest(ngrams(h, KGRAM), WINDOW - KGRAM + 1)[starts]
                first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
                known = inside(low[first], self.prints)
                starts = starts[np.repeat(known, np.diff(np.r_[first, len(low)]))]
            hashes = ngrams(h, n)[starts]
            some = inside(hashes, rows["h"])
            starts, hashes = starts[some], hashes[some]
            check = ngrams(g, n, 1)[starts]
            left, right = np.searchsorted(rows["h"], hashes, "left"), np.searchsorted(rows["h"], hashes, "right")
            times = right - left
            row = np.repeat(left - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
            owner = np.repeat(np.arange(len(starts)), times)
            same = rows["g"][row] == check[owner]
            row, owner = row[same], owner[same]
            hit = np.unique(starts[owner])
            steps[hit] += 1
            steps[hit + n] -= 1
            found.append(np.stack([doc[starts[owner]], rows["item"][row]], 1))
        covered = np.cumsum(steps[:-1]) > 0
        items = [set() for _ in range(words.texts)]
        for d, i in np.unique(np.concatenate(found), axis=0).tolist() if found else []:
            items[d].add(self.ids[i])
        hits = [[] for _ in range(words.texts)]
        if covered.any():
            new = np.zeros(len(covered) + 1, bool)
            new[words.of] = True
            edge = covered & (new[:-1] | ~np.r_[False, covered[:-1]])
            last = covered & (new[1:] | ~np.r_[covered[1:], False])
            for a, b in zip(np.flatnonzero(edge).tolist(), np.flatnonzero(last).tolist()):
                d = int(doc[a])
                base = int(words.of[d])
                hits[d].append({"start": a - base, "end": b + 1 - base})
        return words.count, hits, [sorted(x) for x in items]


def _pass(documents, rows, text, carry):
    """One pass over the documents against benchmark rows of a proven size."""
    ids, texts = [str(r[0]) for r in rows], [r[1] for r in rows]
    index = documents.sparkSession.sparkContext.broadcast(Index(ids, texts))

    def start():
        def fn(part):
            count, hits, items = index.value.find(part)
            return [
                pa.array(count, pa.int64()),
                pa.array(hits, pa.list_(pa.struct([pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)]))),
                pa.array(items, pa.list_(pa.string())),
            ]

        return fn

    return map_text(documents, text, carry, FIELDS, start)


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    item_id: str = "item_id",
    item_text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """Which words of which documents lie in windows of benchmark items, and in whose.

    Adds ``n_words``, ``hits`` (ranges of word numbers, end exclusive) and
    ``items`` (sorted ids as strings) to the ``carry`` columns (default
    ``doc_id``), one row per document row.  The documents are scanned without a
    shuffle.  For each window of 13 words the smallest hash of its 7-grams is
    kept; equal windows keep the same one, so looking up these fingerprints in
    the benchmark's finds every shared span of 13 words or more, and the windows
    around a hit are then compared by 128-bit hashes.

    The benchmark goes to the tasks in blocks of at most ``block`` bytes of
    text (one item at least): its size is measured first, and each further
    block is one more pass, whose results are merged per document row.

    Null texts have no words; an item without words, without an id or with a
    null text takes no part; repeated items count once per id; empty tables
    give no rows or no hits.  Extra columns are ignored unless carried.
    """
    carry = ["doc_id"] if carry is None else carry
    size = F.coalesce(F.octet_length(item_text), F.lit(0))
    items = benchmark.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item_id).alias("id"), F.col(item_text).cast("string").alias("t"), size.alias("n")
    )
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total <= block:
        return _pass(documents, items.select("id", "t").collect(), text, carry)

    # Several passes: rows are told apart by their content, equal rows by nothing.
    blocks = -(-2 * total // block)
    part = F.pmod(F.xxhash64("id", "t"), F.lit(blocks))
    # Two hashes with different seeds, as 64 bits alone would let rows of a very large table meet.
    whole = [F.col(c) for c in documents.columns]
    key = F.struct(F.xxhash64(*whole).alias("a"), F.xxhash64(F.lit(7), *reversed(whole)).alias("b"))
    keyed = documents.withColumn("__key", key)
    made = None
    for b in range(blocks):
        rows = items.where(part == b).select("id", "t").collect()
        one = _pass(keyed, rows, text, [*carry, "__key"])
        made = one if made is None else made.union(one)
    spans = F.array_sort(F.flatten(F.collect_list("hits")))
    grouped = made.groupBy("__key").agg(
        *[F.first(c).alias(c) for c in carry],
        F.first("n_words").alias("n_words"),
        spans.alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.count("*") / blocks).cast("int").alias("__times"),
    )
    merged = F.aggregate(
        "hits",
        F.array().cast(HITS),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["start"]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.try_element_at(acc, F.lit(-1))["start"].alias("start"),
                        F.greatest(F.try_element_at(acc, F.lit(-1))["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    grouped = grouped.withColumn("hits", merged)
    return grouped.withColumn("__times", F.explode(F.sequence(F.lit(1), F.greatest("__times", F.lit(1))))).select(
        *carry, "n_words", "hits", "items"
    )


def verdict(found: DataFrame) -> DataFrame:
    """Digest columns of :func:`contamination` and the rule: at least a twentieth of the words is hit."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return (
        found.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )
