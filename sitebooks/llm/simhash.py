"""SimHash fingerprints, and linking them with BK-trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitebooks.llm.common import components, map_text
from sitebooks.runtime import materialise

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Fingerprints of one tree; larger shards are keyed again, and then dealt in blocks.
TREE = 2048
UPPER_TO_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half the hashes of the word shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(UPPER_TO_LOWER).split()
    if not words:
        return 0
    if len(words) <= n:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(n))))
    total, m, step = np.zeros(64, np.int64), len(words) - n + 1, 1 << 16
    for a in range(0, m, step):  # bounded memory for very long texts
        size = min(step, m - a)
        h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for _, s in zip(range(size), shingles)), np.uint64, size)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > m, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, text: str = "text", carry: list[str] | None = None, n: int = SHINGLE) -> DataFrame:
    """Add ``fp``, the fingerprint as a signed long, to the ``carry`` columns."""

    def start():
        def fn(texts):
            made = np.fromiter((fingerprint(t, n) for t in texts.to_pylist()), np.uint64, len(texts))
            return [pa.array(made.view(np.int64))]

        return fn

    return map_text(documents, text, ["doc_id"] if carry is None else carry, [T.StructField("fp", T.LongType(), False)], start)


# --- BK-trees ---------------------------------------------------------------------


class Forest:
    """One BK-tree per shard, in flat arrays; children are keyed by their distance to the parent.

    The first value of a shard is its root; the values at each distance from it
    form one child, which is built the same way.  All trees grow a level at a
    time, so that numpy does the work.
    """

    def __init__(self, shard: np.ndarray, value: np.ndarray):
        n = len(value)
        self.value = value
        self.root = np.full(int(shard.max()) + 1 if n else 0, -1)
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        left, group = np.arange(n), shard.astype(np.int64)
        while len(left):
            order = np.argsort(group, kind="stable")
            left, group = left[order], group[order]
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            pivot = np.repeat(left[first], np.diff(np.r_[first, len(left)]))
            if len(left) == n:
                self.root[shard[left[first]]] = left[first]
            rest = pivot != left
            left, pivot = left[rest], pivot[rest]
            edge[left] = np.bitwise_count(value[left] ^ value[pivot])
            parent[left] = pivot
            group = pivot * 65 + edge[left]
        # A child is the first of its parent and distance; its siblings were pushed below it, so parents are unique here.
        kids = np.flatnonzero(parent >= 0)
        order = np.argsort(parent[kids] * 65 + edge[kids], kind="stable")
        self.kid = kids[order]
        self.key = (parent * 65 + edge)[self.kid]

    def within(self, shard: np.ndarray, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, tree entry) at distance ``radius`` or less, following edges within the radius."""
        q = np.arange(len(query))
        node = self.root[shard]
        q, node = q[node >= 0], node[node >= 0]
        pairs = []
        while len(q):
            d = np.bitwise_count(query[q] ^ self.value[node]).astype(np.int64)
            near = d <= radius
            pairs.append((q[near], node[near]))
            low = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0), "left")
            high = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), "right")
            times = high - low
            q = np.repeat(q, times)
            node = self.kid[np.repeat(low - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())]
        if not pairs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest entry number joined to each of n entries by the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        now = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(now, a, low)
        np.minimum.at(now, b, low)
        now = now[now]
        if (now == label).all():
            break
        label = now
    return label


EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def linker(radius: int, budget: int = 8 << 20):
    """Task code: rows (shard, fp, rep, tree, ask) of whole shards, sorted by shard, to few edges.

    ``tree`` rows make the shard's BK-tree, ``ask`` rows are looked up in it.
    Links within a shard are reduced to one edge per fingerprint before they
    leave the task, so a dense shard does not give all its pairs.
    """

    def edges_of(rows: list[np.ndarray]):
        shard, fp, rep, tree, ask = rows
        number = np.cumsum(np.r_[False, shard[1:] != shard[:-1]])
        at, who = np.flatnonzero(tree), np.flatnonzero(ask)
        forest = Forest(number[at], fp[at]) if len(at) else None
        if forest is None or not len(who):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        roots = np.full(int(number[-1]) + 1, -1)
        roots[: len(forest.root)] = forest.root
        forest.root = roots
        q, e = forest.within(number[who], fp[who], radius)
        q, e = who[q], at[e]
        keep = rep[q] != rep[e]
        label = least(len(fp), q[keep], e[keep])
        moved = np.flatnonzero(label != np.arange(len(fp)))
        return rep[moved], rep[label[moved]]

    def run(batches):
        held, size = [], 0

        def flush(rows):
            shard = rows[0]
            first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.empty(0, np.int64)
            work = np.cumsum(np.diff(np.r_[first, len(shard)]).astype(np.int64) ** 2)
            cuts = np.flatnonzero(np.diff(work // budget)) + 1 if len(work) else []
            for a, b in zip([0, *first[cuts].tolist()], [*first[cuts].tolist(), len(shard)]):
                made = edges_of([r[a:b] for r in rows])
                if len(made[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in made], names=["a", "b"])

        for batch in batches:
            cols = [np.asarray(c) for c in batch.columns[:3]] + [c.to_numpy(zero_copy_only=False) for c in batch.columns[3:]]
            cols[1] = cols[1].view(np.uint64)
            held.append(cols)
            size += batch.num_rows
            if size >= 1 << 17:
                rows = [np.concatenate(x) for x in zip(*held)]
                end = int(np.searchsorted(rows[0], rows[0][-1]))  # the last shard may go on
                yield from flush([r[:end] for r in rows])
                held, size = [[r[end:] for r in rows]], len(rows[0]) - end
        if held:
            yield from flush([np.concatenate(x) for x in zip(*held)])

    return run


def bands(fp: Column, bits: list[tuple[int, int]]) -> list[Column]:
    """One key per range of bits (lowest bit, width): radius + 1 ranges, of which a pair in reach shares one."""
    return [
        F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(i << 48)
        for i, (low, width) in enumerate(bits)
    ]


def cut(positions: list[int], parts: int) -> list[list[int]]:
    """Bit positions in ``parts`` runs of about equal length."""
    edges = [round(i * len(positions) / parts) for i in range(parts + 1)]
    return [positions[a:b] for a, b in zip(edges, edges[1:])]


def links(nodes: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Edges ``(a, b)`` of representatives that connect what fingerprints within ``radius`` connect.

    ``nodes`` has distinct ``fp`` with a ``rep``.  The 64 bits are cut in
    radius + 1 bands; fingerprints in reach agree in one band at least, so each
    band value is a shard and every link lies in a shard.  A shard of more than
    ``tree`` fingerprints is cut again by bands of its other bits; what is
    still larger is dealt in blocks (part of the tree, part of the queries), so
    no task has to hold an unbounded shard and no link is lost.
    """
    runs = cut(list(range(64)), radius + 1)
    first = bands(F.col("fp"), [(r[0], len(r)) for r in runs])
    one = nodes.select("fp", "rep", F.explode(F.array(*[F.xxhash64(F.lit(1), k) for k in first])).alias("shard"))
    if radius == 0:
        return one.where(F.lit(False)).select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    sizes = one.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > tree)
    hot = materialise(sizes, "hot-shards")
    ask = F.lit(True)
    dealt = one.select("shard", "fp", "rep", F.lit(True).alias("tree"), ask.alias("ask"))
    if not hot.isEmpty():
        # Second level: for each band, its hot shards by bands of the remaining bits.
        cold = one.join(hot, "shard", "left_anti").select("shard", "fp", "rep", F.lit(True).alias("tree"), F.lit(True).alias("ask"))
        keys = []
        for i, run in enumerate(runs):
            others = [p for r in runs if r is not run for p in r]
            for j, part in enumerate(cut(others, radius + 1)):
                mask = sum(1 << p for p in part)
                mask -= (mask >> 63) << 64
                inner = F.col("fp").bitwiseAND(F.lit(mask).cast("long"))
                outer = F.xxhash64(F.lit(1), first[i])
                keys.append(F.struct(outer.alias("shard"), F.xxhash64(F.lit(2 + i * 16 + j), first[i], inner).alias("sub")))
        two = nodes.select("fp", "rep", F.explode(F.array(*keys)).alias("k")).select("fp", "rep", "k.shard", "k.sub")
        two = two.join(hot, "shard", "left_semi").select(F.col("sub").alias("shard"), "fp", "rep")
        many = two.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(tree)).cast("int").alias("parts"))
        split = two.join(many, "shard").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        blocks = split.withColumn("other", other).select(
            F.xxhash64("shard", F.least("part", "other"), F.greatest("part", "other")).alias("shard"),
            "fp",
            "rep",
            (F.col("part") <= F.col("other")).alias("tree"),
            (F.col("part") >= F.col("other")).alias("ask"),
        )
        dealt = cold.union(blocks)
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(linker(radius), EDGES)


def groups(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = SHINGLE, radius: int = RADIUS, tree: int = TREE
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest id reachable over links of ``radius`` bits or less.

    Documents with equal fingerprints are one node, so a group of copies costs
    one node; links are found by BK-trees per shard (:func:`links`) and joined
    to components.  Null and empty texts have fingerprint 0 and are linked like
    any other; rows with a null id get a fingerprint and no component; repeated
    rows get equal answers; texts of any length are read whole, in bounded
    pieces; an empty table gives no rows; other columns are ignored.
    """
    ids = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = materialise(fingerprints(ids, n=n), "fingerprints")
    nodes = materialise(
        prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-nodes"
    )
    roots = components(links(nodes, radius, tree), "fingerprint-links")
    known = nodes.join(roots, nodes["rep"] == roots["node"], "left").select(
        F.col("fp").alias("__fp"), F.coalesce("root", "rep").alias("component_id")
    )
    known = materialise(known, "fingerprint-groups")
    found = prints.join(known, F.col("fp") == F.col("__fp"), "left")
    return found.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_of_each(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each group of :func:`groups`; rows with a null id stay.

    Rows that repeat an id are one document: it goes if any of them is a near
    copy of a smaller id, else the row with the smallest text stays (nulls
    first; of equal texts the one whose other columns hash lowest).  Empty and
    null texts are copies of each other; an empty table gives no rows.
    """
    gone = found.where("doc_id is not null and doc_id != component_id").select(F.col("doc_id").alias("__gone"))
    kept = documents.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")
    twice = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__twice"))
    twice = materialise(twice, "repeated-ids")
    if twice.isEmpty():
        return kept
    single = kept.join(twice, F.col(doc_id) == F.col("__twice"), "left_anti")
    rest = [F.col(f.name) for f in documents.schema.fields if f.name not in (doc_id, text) and "map<" not in f.dataType.simpleString()]
    first = Window.partitionBy(doc_id).orderBy(F.asc_nulls_first(text), F.xxhash64(*rest) if rest else F.lit(0))
    several = kept.join(twice, F.col(doc_id) == F.col("__twice"), "left_semi").withColumn("__rn", F.row_number().over(first))
    return single.union(several.where("__rn = 1").drop("__rn"))
