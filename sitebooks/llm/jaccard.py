"""Near-duplicate documents by the Jaccard similarity of their word n-grams, counted by vertical fragments."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitebooks.llm.common import LOWER, NOT_SPACE, Words, buffers, components, ngrams, slices
from sitebooks.llm.simhash import EDGES, least
from sitebooks.runtime import materialise

SHINGLE, PERCENT = 3, 90
#: Fragments of the global order.
FRAGMENTS = 8
#: Bytes of text in a block, its documents at most, and n-grams meant for one bucket.
BLOCK, ROWS, BUCKET = 4 << 20, 1 << 12, 1 << 20
#: Sets that share an n-gram are joined pair by pair up to this number; more are dealt in cells of so many sets or n-grams a side.
FEW, SIDE, SIDE_GRAMS = 64, 1024, 1 << 20
#: N-grams in more sets of a cell than this are counted by matrix products, so many columns at once.
DENSE, COLUMNS = 32, 4096
#: Levels of frequency: level k holds the n-grams that 2**k up to 2**(k + 1) - 1 sets have.
LEVELS = 48

NO_ID = np.iinfo(np.int64).min
DIGEST = np.dtype([("a", "<u8"), ("b", "<u8")])
BLOCKS = T.StructType(
    [
        T.StructField("block", T.LongType(), False),
        *[T.StructField(c, T.BinaryType(), False) for c in ("ids", "sizes", "digests", "offsets", "data")],
        T.StructField("grams", T.LongType(), False),
    ]
)
LIGHT = "node long, doc_id long, n long, digest binary"
LIVE = "node long, n long, absent long, grams array<long>, levels binary, mass array<long>"


def sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each text as hashes: one array of all, by text and then by hash, and the bounds of the texts.

    A text of fewer words is one gram, the whole sequence; one without words has none.
    """
    words = Words(texts, NOT_SPACE, LOWER)
    h, doc = words.hashes(0), words.doc()
    grams, owner = [], []
    for k in range(1, n + 1):
        made = ngrams(h, k)
        at = np.flatnonzero(words.whole(k))
        if k < n:
            at = at[words.count[doc[at]] == k]
        grams.append(made[at])
        owner.append(doc[at])
    gram, of = np.concatenate(grams).view(np.int64), np.concatenate(owner)
    order = np.lexsort((gram, of))
    gram, of = gram[order], of[order]
    new = np.r_[True, (gram[1:] != gram[:-1]) | (of[1:] != of[:-1])] if len(gram) else np.empty(0, bool)
    return gram[new], np.searchsorted(of[new], np.arange(len(texts) + 1))


def blocks(documents: DataFrame, text: str, doc_id: str, n: int, size: int = BLOCK) -> DataFrame:
    """Documents in blocks: ids, set sizes and digests beside the compressed texts."""
    source = documents.select(F.col(text).cast("string"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)))

    def run(batches):
        number, pack = TaskContext.get().partitionId() << 24, zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                for part in slices(batch.slice(a, ROWS), 0, size):
                    raw, offsets = buffers(part.column(0))
                    gram, at = sets(part.column(0), n)
                    data, edges = gram.tobytes(), (8 * at).tolist()
                    digests = b"".join(xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(edges, edges[1:]))
                    row = [number, np.asarray(part.column(1)).tobytes(), np.diff(at).tobytes(), digests]
                    row += [offsets.tobytes(), pack.compress(raw.tobytes()), len(gram)]
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=BLOCKS.names)
                    number += 1

    return source.mapInArrow(run, BLOCKS)


def light(table: DataFrame) -> DataFrame:
    """One row per document without its text; ``node`` numbers the documents."""

    def run(batches):
        for batch in batches:
            for block, ids, sizes, digests in zip(*[c.to_pylist() for c in batch.columns]):
                own = np.frombuffer(ids, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block * ROWS + np.arange(len(own))),
                        pa.array(own, pa.int64(), mask=own == NO_ID),
                        pa.array(np.frombuffer(sizes, np.int64)),
                        pa.array([digests[i : i + 16] for i in range(0, len(digests), 16)], pa.binary()),
                    ],
                    names=["node", "doc_id", "n", "digest"],
                )

    return table.select("block", "ids", "sizes", "digests").mapInArrow(run, LIGHT)


def opened(batch: pa.RecordBatch, i: int, n: int):
    """Sets of a block, the documents that come first with their digest, and the distinct n-grams of these with their counts."""
    digests, offsets, data = (batch.column(batch.schema.get_field_index(c))[i].as_py() for c in ("digests", "offsets", "data"))
    raw = zstandard.ZstdDecompressor().decompress(data) if data else b""
    count = len(digests) // 16
    gram, at = sets(pa.LargeStringArray.from_buffers(count, pa.py_buffer(offsets), pa.py_buffer(raw)), n)
    _, first = np.unique(np.frombuffer(digests, DIGEST), return_index=True)
    own = np.zeros(count, bool)
    own[first] = True
    distinct, times = np.unique(gram[np.repeat(own, np.diff(at))].view(np.uint64), return_counts=True)
    return gram, at, distinct, times


def frequencies(table: DataFrame, bits: int, n: int) -> DataFrame:
    """``(block, bucket, levels)``: for the distinct n-grams of each block, in order, how frequent each is in all blocks.

    A block sends each of its n-grams once, with its count, as the 32 bits behind the bucket's.
    """

    def send(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                _, _, distinct, times = opened(batch, i, n)
                bucket = (distinct >> np.uint64(64 - bits)).astype(np.int64)
                low = (distinct >> np.uint64(32 - bits)).astype(np.uint32)
                count = np.minimum(times, 255).astype(np.uint8)
                first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
                edges = [*first.tolist(), len(bucket)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[first].astype(np.int32)),
                        pa.array(np.full(len(first), batch.column(0)[i].as_py()), pa.int64()),
                        pa.array([low[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                        pa.array([count[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                    ],
                    names=["bucket", "block", "grams", "counts"],
                )

    def count(batches):
        held: list[tuple] = []

        def answers():
            low = np.frombuffer(b"".join(r[2] for r in held), np.uint32)
            _, back = np.unique(low, return_inverse=True)
            total = np.bincount(back, np.frombuffer(b"".join(r[3] for r in held), np.uint8))
            level = np.frexp(total)[1].astype(np.uint8) - 1
            made, at = level[back].tobytes(), np.cumsum([0, *[len(r[3]) for r in held]]).tolist()
            for a in range(0, len(held), 1000):
                some = held[a : a + 1000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[1] for r in some], pa.int64()),
                        pa.array([r[0] for r in some], pa.int32()),
                        pa.array([made[x:y] for x, y in zip(at[a:], at[a + 1 : a + 1 + len(some)])], pa.binary()),
                    ],
                    names=["block", "bucket", "levels"],
                )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and held[-1][0] != row[0]:
                    yield from answers()
                    held = []
                held.append(row)
        if held:
            yield from answers()

    sent = table.select("block", "digests", "offsets", "data").mapInArrow(send, "bucket int, block long, grams binary, counts binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(count, "block long, bucket int, levels binary")


def least_overlap(n: int | np.ndarray, percent: int):
    """Common n-grams that a set of n must have with a similar one."""
    return -(-percent * n // 100)


def living(table: DataFrame, classes: DataFrame, levels: DataFrame, n: int, percent: int) -> DataFrame:
    """The sets that may be similar to another: their shared n-grams in the global order (level, hash).

    One document stands for all with the same set.  N-grams of one set only
    come first in the order; ``absent`` is their number, they are left out.
    """
    chosen = classes.groupBy(F.floor(F.col("node") / ROWS).alias("block")).agg(
        F.collect_list(F.pmod("node", F.lit(ROWS)).cast("int")).alias("chosen")
    )
    told = levels.groupBy("block").agg(F.collect_list(F.struct("bucket", "levels")).alias("told"))
    joined = table.join(told, "block").join(chosen, "block").select("digests", "offsets", "data", "told", "chosen", "block")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                gram, at, distinct, _ = opened(batch, i, n)
                parts = sorted((t["bucket"], t["levels"]) for t in batch.column(3)[i].as_py())
                level = np.frombuffer(b"".join(p[1] for p in parts), np.uint8)
                rows = []
                for d in batch.column(4)[i].as_py():
                    own = gram[at[d] : at[d + 1]]
                    k = level[np.searchsorted(distinct, own.view(np.uint64))]
                    absent = int(np.count_nonzero(k == 0))
                    if len(own) - least_overlap(len(own), percent) + 1 <= absent:
                        continue  # the n-grams it must share one of are all its own
                    order = np.lexsort((own, k))[absent:]
                    mass = np.bincount(k[order], minlength=LEVELS).tolist()
                    rows.append((batch.column(5)[i].as_py() * ROWS + d, len(own), absent, own[order], k[order].tobytes(), mass))
                if rows:
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[pa.array(c, pa.int64()) for c in columns[:3]],
                            pa.array(columns[3], pa.list_(pa.int64())),
                            pa.array(columns[4], pa.binary()),
                            pa.array(columns[5], pa.list_(pa.int64())),
                        ],
                        names=["node", "n", "absent", "grams", "levels", "mass"],
                    )

    return joined.mapInArrow(run, LIVE)


def pivots(live: DataFrame, fragments: int) -> list[tuple[int, int]]:
    """Where the global order is cut so that the fragments hold about equally many entries.

    Entries are counted per level; within a level hashes are spread evenly.
    """
    rows = live.select(F.posexplode("mass").alias("level", "k")).where("k > 0").groupBy("level").agg(F.sum("k").alias("k")).collect()
    return cut_points(sorted((r["level"], r["k"]) for r in rows), fragments)


def cut_points(mass: list[tuple[int, int]], fragments: int) -> list[tuple[int, int]]:
    """Levels and hashes where each fragment but the first begins, from the entries of each level."""
    total, out, done = sum(k for _, k in mass), [], 0
    for level, k in mass:
        while len(out) < fragments - 1 and done + k > (goal := total * (len(out) + 1) // fragments):
            out.append((level, (goal - done) * (1 << 64) // k - (1 << 63)))
        done += k
    return out


def fragment(gram: np.ndarray, level: np.ndarray, cuts: list[tuple[int, int]]) -> np.ndarray:
    """The fragment of each n-gram."""
    out = np.zeros(len(gram), np.int64)
    for at, low in cuts:
        out += (level > at) | ((level == at) & (gram >= low))
    return out


def segments(live: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    """One row per set and fragment in which it has n-grams."""

    def run(batches):
        for batch in batches:
            rows = []
            for node, gram, level in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                gram, level = np.array(gram, np.int64), np.frombuffer(level, np.uint8)
                edges = np.searchsorted(fragment(gram, level, cuts), np.arange(len(cuts) + 2)).tolist()
                rows += [(node, f, gram[a:b]) for f, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
            for a in range(0, len(rows), 2000):
                node, f, part = zip(*rows[a : a + 2000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(f, pa.int32()), pa.array(part, pa.list_(pa.int64()))], names=["node", "f", "part"]
                )

    return live.select("node", "grams", "levels").mapInArrow(run, "node long, f int, part array<long>")


def candidates(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets that share an n-gram among those of which similar sets share one, if sizes and places allow similarity."""
    a, b = postings.alias("a"), postings.alias("b")
    need = F.ceil((F.col("a.n") + F.col("b.n")) * F.lit(percent) / F.lit(100 + percent))
    rest = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))  # this n-gram and all behind it
    fits = F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent
    joined = a.join(b, (F.col("a.gram") == F.col("b.gram")) & (F.col("a.node") < F.col("b.node")) & fits & (rest >= need))
    return joined.select(
        F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb")
    ).distinct()


def similar(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar: overlaps are counted in each fragment by itself and summed per pair."""
    left = pairs.join(parts.select(F.col("node").alias("a"), "f", F.col("part").alias("pa")), "a")
    both = left.join(parts.select(F.col("node").alias("b"), "f", F.col("part").alias("pb")), ["b", "f"])
    partial = both.select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).alias("common"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return total.where(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * percent).select("a", "b")


def overlaps(gram: np.ndarray, of: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common n-grams of each set of ``left`` with each other of ``right`` (sets by number), from entries (n-gram, set)."""
    out = np.zeros((len(left), len(right)), np.float32)
    count = int(max(left.max(), right.max())) + 1
    row, column = np.full(count, -1), np.full(count, -1)
    row[left], column[right] = np.arange(len(left)), np.arange(len(right))
    _, back, times = np.unique(gram, return_inverse=True, return_counts=True)
    order = np.argsort(back, kind="stable")
    back, of = back[order], of[order]
    dense = times > DENSE
    at = np.flatnonzero(dense[back])
    where, who = (np.cumsum(dense) - 1)[back[at]], of[at]
    for low in range(0, int(dense.sum()), COLUMNS):
        a, b = np.searchsorted(where, (low, low + COLUMNS))
        marks = np.zeros((count, COLUMNS), np.float32)
        marks[who[a:b], where[a:b] - low] = 1
        out += marks[left] @ marks[right].T
    # The others: every entry with those up to DENSE - 1 places on that are of the same n-gram.
    at = np.flatnonzero(~dense[back])
    back, of = back[at], of[at]
    for step in range(1, DENSE):
        same = np.flatnonzero(back[step:] == back[:-step])
        if not len(same):
            break
        for x, y in ((of[same], of[same + step]), (of[same + step], of[same])):
            ok = (row[x] >= 0) & (column[y] >= 0)
            np.add.at(out, (row[x[ok]], column[y[ok]]), 1)
    return out


def linked(n: np.ndarray, grams: list, levels: list, left: np.ndarray, right: np.ndarray, cuts: list, percent: int) -> np.ndarray:
    """For each set of a cell the smallest set number linked to it; overlaps are summed over the fragments.

    After each fragment, pairs that the fragments to come cannot make similar
    are given up, and the cell ends when none is left.
    """
    sizes = np.array([len(g) for g in grams])
    gram = np.concatenate([np.asarray(g, np.int64) for g in grams])
    of = np.repeat(np.arange(len(n)), sizes)
    part = fragment(gram, np.frombuffer(b"".join(levels), np.uint8), cuts)
    rest = np.zeros((len(cuts) + 2, len(n)), np.int64)  # n-grams of a set in this fragment and those behind it
    for f in range(len(cuts), -1, -1):
        rest[f] = rest[f + 1] + np.bincount(of[part == f], minlength=len(n))
    both = n[left][:, None] + n[right][None, :]
    need = -(-percent * both // (100 + percent))
    total = np.zeros(both.shape, np.float32)
    alive = np.minimum(n[left][:, None], n[right][None, :]) * 100 >= np.maximum(n[left][:, None], n[right][None, :]) * percent
    for f in range(len(cuts) + 1):
        alive &= total + np.minimum(rest[f][left][:, None], rest[f][right][None, :]) >= need
        if not alive.any():
            break
        at = np.flatnonzero(part == f)
        if len(at):
            total += overlaps(gram[at], of[at], left, right)
    alive &= total >= need
    i, j = np.nonzero(alive)
    apart = left[i] != right[j]
    return least(len(n), left[i[apart]], right[j[apart]])


def cells(live: DataFrame, postings: DataFrame, sizes: DataFrame, cuts: list[tuple[int, int]], percent: int, side: int = SIDE) -> DataFrame:
    """Edges among the sets that share a frequent n-gram, found cell by cell and reduced to one edge per set and cell.

    The sets of an n-gram are dealt in parts of about ``side`` sets and
    ``SIDE_GRAMS`` n-grams; a cell is a pair of parts, so that no task holds an
    unbounded group.
    """
    parts = sizes.withColumn("parts", F.greatest(F.ceil(F.col("m") / side), F.ceil(F.col("grams") / SIDE_GRAMS)).cast("int"))
    dealt = postings.join(parts.select(F.col("gram").alias("g"), "parts"), F.col("gram") == F.col("g"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = dealt.select(
        F.xxhash64("gram", F.least("part", "other"), F.greatest("part", "other")).alias("cell"),
        "node",
        (F.col("part") <= F.col("other")).alias("left"),
        (F.col("part") >= F.col("other")).alias("right"),
    )
    full = placed.join(live.select("node", "n", "grams", "levels"), "node").select("cell", "node", "n", "left", "right", "grams", "levels")

    def run(batches):
        held: list[tuple] = []

        def edges():
            _, node, n, left, right, grams, levels = zip(*held)
            sides = [np.flatnonzero(np.array(s)) for s in (left, right)]
            if len(held) < 2 or not all(map(len, sides)):
                return
            low = linked(np.array(n), grams, levels, *sides, cuts, percent)
            node = np.array(node)
            moved = np.flatnonzero(low != np.arange(len(low)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[low[moved]])], names=["a", "b"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:5]]
            lists = batch.column(5)
            for i, row in enumerate(zip(*columns)):
                if held and held[-1][0] != row[0]:
                    yield from edges()
                    held = []
                held.append((*row, lists[i].values.to_numpy(), batch.column(6)[i].as_py()))
        if held:
            yield from edges()

    return full.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, EDGES)


def groups(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    n: int = SHINGLE,
    percent: int = PERCENT,
    fragments: int = FRAGMENTS,
    few: int = FEW,
    side: int = SIDE,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: the smallest id reachable over links of ``percent`` Jaccard similarity or more.

    A document's set holds its distinct n-grams of lower-cased words, or its
    whole word sequence if that is shorter.  Documents with equal sets are one.

    1. Blocks send each n-gram once to buckets, which answer how frequent it
       is.  That gives a global order of all n-grams: by level of frequency, then
       by hash.  N-grams that one set alone has can overlap with nothing and are
       left out from here on.
    2. Two similar sets share one of the first n-grams of both (as many as
       similarity lets differ, and one).  Sets that do, and whose sizes and
       places allow similarity, are candidates.
    3. The global order is cut into ``fragments`` of equal weight.  Each set is
       cut with it, overlaps are counted in each fragment by itself, and the
       counts are summed per pair.  Pairs of an n-gram that more than ``few``
       sets share are counted in cells of bounded size instead, fragment after
       fragment, and leave them as a spanning forest.

    Documents without words (null, empty or blank texts) have empty sets and are
    linked with nothing; rows with a null id get their size, no component, and
    link nothing; rows that repeat an id are documents of their own; an empty
    table gives no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    table = materialise(blocks(documents, text, doc_id, n, block), "gram-blocks")
    total = table.agg(F.coalesce(F.sum("grams"), F.lit(0))).first()[0]
    bits = min(24, max(1, int(max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET) - 1).bit_length()))
    every = materialise(light(table), "gram-documents")
    known = every.where("n > 0 and doc_id is not null")
    classes = materialise(known.groupBy("digest").agg(F.min("doc_id").alias("low"), F.min("node").alias("node")), "gram-classes")
    live = materialise(living(table, classes, frequencies(table, bits, n), n, percent), "gram-sets")
    cuts = pivots(live, fragments)

    first = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) + 1 - F.col("absent")
    leading = live.select("node", "n", "absent", F.posexplode(F.slice("grams", F.lit(1), first.cast("int"))).alias("k", "gram"))
    leading = materialise(leading.select("gram", "node", "n", (F.col("absent") + F.col("k")).alias("place")), "gram-postings")
    sizes = materialise(
        leading.groupBy("gram").agg(F.count("*").alias("m"), F.sum("n").alias("grams")).where("m > 1"), "gram-sizes"
    )
    rare = leading.join(sizes.where(F.col("m") <= few), "gram", "left_semi")
    pairs = materialise(candidates(rare, percent), "gram-pairs")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("asked")).distinct()
    parts = segments(live.join(asked, F.col("node") == F.col("asked"), "left_semi"), cuts)
    often = leading.select("gram", "node").join(sizes.where(F.col("m") > few).select("gram"), "gram", "left_semi")
    edges = similar(pairs, parts, percent).union(cells(live, often, sizes.where(F.col("m") > few), cuts, percent, side))
    roots = components(edges, "gram-links")

    grouped = classes.join(roots.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left")
    grouped = grouped.select("digest", "low", F.coalesce("root", "node").alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    answer = materialise(grouped.join(lowest, "root").select(F.col("digest").alias("key"), "component_id"), "gram-components")
    found = every.join(answer, (F.col("digest") == F.col("key")) & (F.col("n") > 0), "left")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
