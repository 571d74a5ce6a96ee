"""The n-gram join against comparing all pairs."""

import random

import numpy as np
import pytest

from sitebooks.llm import jaccard, queries
from sitebooks.llm.common import ready

UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def grams(text, n=3):
    words = (text or "").encode().translate(UPPER).split()
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def brute(docs, percent=90):
    own = [grams(t) for _, t in docs]
    label = list(range(len(docs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    usable = [i for i in range(len(docs)) if own[i] and docs[i][0] is not None]
    for x, i in enumerate(usable):
        for j in usable[x + 1 :]:
            small, large = sorted((len(own[i]), len(own[j])))
            if 100 * small >= percent * large and root(i) != root(j):
                common = len(own[i] & own[j])
                if 100 * common >= percent * (small + large - common):
                    label[root(j)] = root(i)
    low = {}
    for i in usable:
        low[root(i)] = min(low.get(root(i), docs[i][0]), docs[i][0])
    return sorted(
        ((d[0], len(own[i]), low[root(i)] if i in set(usable) else d[0]) for i, d in enumerate(docs)), key=lambda r: (r[0] is not None, r)
    )


def check(spark, docs, **options):
    frame = ready(spark).createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, gram string, n int").repartition(3)
    found = sorted(map(tuple, jaccard.groups(frame, **options).collect()), key=lambda r: (r[0] is not None, r))
    assert found == brute(docs, options.get("percent", 90))


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        at = rng.randrange(len(words))
        words[at : at + rng.choice((0, 1, 1))] = [f"e{rng.randrange(10**6)}"] * rng.choice((0, 1, 1))
    return " ".join(words)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    out = []
    for group in range(12):  # groups of near copies around the limit, some of them long
        base = [f"w{rng.randrange(40 if group % 3 else 4000)}" for _ in range(rng.choice((20, 60, 200, 900)))]
        out += [edited(rng, base, rng.randrange(0, 2 + len(base) // 40)) for _ in range(12)]
    out += [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    out += [None, "", " \n", "a", "A", "a b", "A  B", "b a", "é b", "É b", "a b c", "a b c a b c", "x" * 5000, "one two three " * 4000]
    out += out[:30]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("few", (64, 3))  # pairs joined, and nearly all of them in cells
def test_groups_equal_brute_force(spark, docs, few):
    check(spark, docs, few=few)


def test_other_limits_and_many_cells(spark, docs):
    check(spark, docs, percent=70, few=2, fragments=3, side=4, block=2000)
    check(spark, docs, percent=100, fragments=1)


def test_null_and_repeated_ids_and_no_rows(spark):
    texts = [(None, "a b c d"), (5, "a b c d"), (5, "x y z"), (3, "x y z"), (9, None), (None, None)]
    check(spark, texts)
    check(spark, [(None, "a b c d")])
    check(spark, [])


def test_overlaps_of_dense_and_rare_grams():
    rng = np.random.default_rng(2)
    table = rng.random((90, 300)) < rng.choice([0.02, 0.3, 0.9], 300)
    of, gram = np.nonzero(table)
    left, right = np.arange(0, 60), np.arange(30, 90)
    want = table[left].astype(int) @ table[right].astype(int).T
    other = left[:, None] != right[None, :]  # a set with itself is not asked for
    assert (jaccard.overlaps(gram, of, left, right) == want)[other].all()


def test_fragments_are_of_about_equal_weight():
    rng = np.random.default_rng(4)
    gram = rng.integers(-(2**63), 2**63 - 1, 40_000)
    level = rng.choice([1, 2, 5], 40_000, p=[0.7, 0.2, 0.1]).astype(np.uint8)

    cuts = jaccard.cut_points([(k, int(v)) for k, v in enumerate(np.bincount(level)) if v], 8)
    found = np.bincount(jaccard.fragment(gram, level, cuts), minlength=8)
    assert len(found) == 8 and found.min() > 4500 and found.max() < 5500


def test_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(map(tuple, queries.op13_jaccard_join(spark, sf_dir).collect()))
    assert found == brute(docs)
