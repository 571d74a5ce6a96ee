"""Fill-in-the-middle against a plain version over Python strings."""

from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitebooks.llm import infill, queries
from sitebooks.llm.common import ready


def plain(doc_id, text):
    t = text or ""
    n = len(t)
    h = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    sha = lambda x: sha256(x.encode()).hexdigest()
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(t), sha(t)
    p, m, s = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, sha(f"<S>{s}<P>{p}<M>{m}"), sha(t)
    return doc_id, n, "psm", a, b - a, sha(f"<P>{p}<S>{s}<M>{m}"), sha(t)


def check(spark, docs):
    frame = ready(spark).createDataFrame(docs, "doc_id long, text string")
    found = infill.digest(infill.transformed(frame)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[5])
    assert sorted(map(tuple, found), key=key) == sorted((plain(*d) for d in docs), key=key)


def test_odd_texts(spark):
    long = "".join(chr(0x4E00 + i % 5000) for i in range(200_000))
    texts = [None, "", "a", "é", "😀", "<P>", "x<S>y", "<M", "<" * 5000, "P>" * 3000, "ab " * 100_000, long, " " * 70_000]
    texts += ["x" * k + "<M>" + "y" * k for k in (126, 127, 128, 129, 4094, 4095, 4096, 5000)]  # marks across chunk ends
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(texts)]
    check(spark, docs + [(None, "no id"), (None, None), (7, "repeated"), (7, "repeated")])


def test_random_texts(spark):
    rng = np.random.default_rng(5)
    shared = "".join(rng.choice(list("abc <PSM>é漢😀\n"), 3000))
    docs = []
    for i in range(400):
        own = "".join(rng.choice(list("abcdefg \né漢😀"), int(rng.integers(0, 3000))))
        docs.append((i, own[: len(own) // 2] + (shared.replace("<", "") if i % 3 else shared) + own[len(own) // 2 :]))
    check(spark, docs)


def test_empty_table_and_clashing_columns(spark):
    check(spark, [])
    frame = ready(spark).createDataFrame([(1, "abc", "x", 5)], "doc_id long, text string, form string, n int")
    assert infill.transformed(frame).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    carried = infill.transformed(frame.withColumn("lang", F.lit("en")), carry=["lang", "text", "n"]).first()
    assert (carried["lang"], carried["text"], carried["n"]) == ("en", "abc", 3)


def test_ids_of_text(spark):
    frame = ready(spark).createDataFrame([("a\x00b", "some text of words"), ("é", "x\x00y" * 9)], "doc_id string, text string")
    got = {tuple(r) for r in infill.digest(infill.transformed(frame)).collect()}
    assert got == {plain("a\x00b", "some text of words"), plain("é", "x\x00y" * 9)}


def test_chunks_follow_content_and_are_remembered():
    rng = np.random.default_rng(1)
    passage = bytes(rng.integers(97, 123, 20_000, dtype=np.uint8))
    memory = infill.Memory()
    for front in (b"", b"one", b"and a longer beginning " * 9):
        data = front + passage
        hits = np.flatnonzero(infill.rolling(np.frombuffer(data, np.uint8)) < np.uint32((1 << 32) // (infill.MEAN - infill.SHORTEST))) + 1
        ends = infill.chunks(data, hits[hits >= infill.WINDOW].tolist())
        assert ends[-1] == len(data) and all(b - a <= infill.LONGEST + 3 for a, b in zip([0, *ends], ends))
        infill.rearranged(data, ends, memory, "7")
    assert memory.hits > 40  # the passage is cut alike behind other beginnings


def test_equal_hashes_of_other_bytes_are_told_apart(monkeypatch):
    monkeypatch.setattr(infill.xxhash, "xxh3_64_intdigest", lambda data: 1)
    memory = infill.Memory()
    assert [memory.summary(x).chars for x in (b"abc", b"abcd", b"abc")] == [3, 4, 3]
    assert memory.hits == 0


@pytest.mark.parametrize("cut", range(1, 7))
def test_summaries_combine(cut):
    for data in (b"ab<P>cd", b"<M>", b"a<", b"\xc3\xa9\xc3\xa9<S>"):
        whole, parts = infill.Summary.of(data), infill.EMPTY
        for i in range(0, len(data), cut):
            parts = parts.then(infill.Summary.of(data[i : i + cut]))
        assert parts == whole


def test_query_covers_all_documents(spark, sf_dir):
    found = queries.op11_fill_in_middle(spark, sf_dir)
    rows = {tuple(r) for r in found.collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert rows == {plain(*d) for d in docs}
