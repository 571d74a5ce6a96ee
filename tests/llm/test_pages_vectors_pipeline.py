"""Pages, neighbours and the pipeline."""

import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sitebooks.llm import language, neighbours, pages, queries, secrets, simhash
from sitebooks.llm.common import ready
from tests.llm.test_text import closure, plain_contamination, plain_fingerprint

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header>Site &amp; name</header><nav><ul><li><a href="/">Home</a><li>About</ul></nav><div class="ad">Buy {n}</div>
<article><header><h1>Title {n}</h1></header><p><b>One&nbsp;&lt;{n}&gt;<br> two <p>Three
 {n}</p><aside>Note</aside><div class="comments"><p>Nice post {n}</p></div></article>
<form><input name=q>Search</form><footer>&copy; me {n}</footer>"""


def frame(spark, rows):
    return ready(spark).createDataFrame(rows, "page_id long, url string, html string, text string")


def test_articles_without_their_surroundings(spark):
    rows = [(n, f"https://h.example/{n}", PAGE.format(n=n), "clash") for n in range(6)]
    rows += [(90, "https://h.example/x", None, None), (91, None, "", None), (92, "no url", "just <b>text</b> &am", None), (92, "no url", "just <b>text</b> &am", None)]
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in pages.extracted(frame(spark, rows)).collect()]
    want = [(n, t := f"Title {n}\nOne <{n}> two\nThree {n}", len(t)) for n in range(6)]
    want += [(90, "", 0), (91, "", 0), (92, "just text &am", 13), (92, "just text &am", 13)]
    assert sorted(got) == sorted(want)
    assert pages.extracted(frame(spark, [])).collect() == []


def test_slots_that_a_host_repeats_are_template(spark):
    body = "<div class=top>Welcome to us</div>{x}<div class=body><p>Own {n}</p><p>text {n}</p></div><div class=tail>See you {k}</div>"
    rows = [(n, "http://a.example/p", body.format(n=n, k=n % 2, x="<hr><table><tr><td>extra</table>" if n % 5 == 0 else ""), None) for n in range(20)]
    rows += [(99, "http://b.example/", body.format(n=99, k=0, x=""), None)]
    got = {r["page_id"]: r["text"] for r in pages.extracted(frame(spark, rows)).collect()}
    assert all(got[n] == f"Own {n}\ntext {n}" for n in range(20) if n % 5)
    assert got[99] == "Welcome to us\nOwn 99\ntext 99\nSee you 0"  # nothing to compare with


def test_simple_tree_matching_keeps_order():
    one, two = pages.unfolded("a(b()c(x()y())d())"), pages.unfolded("a(c(x()z()y())b()d())")
    assert pages.match(one, two, {})[0] == 5  # a, c with x and y, d
    assert pages.aligned("a(b()c(x()y())d())", "a(c(x()z()y())b()d())") == {
        "/a": "/a", "/a/c": "/a/c", "/a/c/x": "/a/c/x", "/a/c/y": "/a/c/y", "/a/d": "/a/d"
    }


def test_driver_pages_give_their_articles(spark, sf_dir):
    got = {r["page_id"]: r["text"] for r in queries.op5_main_text(spark, sf_dir).collect()}
    source = dict(duckdb.execute(f"select page_id, html from '{sf_dir}/pages.parquet'").fetchall())
    assert set(got) == set(source)
    import html

    for i, h in source.items():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", h, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1|article)\b[^>]*>", inner)]
        assert got[i] == "\n".join(b for b in blocks if b), i


def test_copies_of_pages_do_not_make_a_body_template(spark):
    body = "<div class=top>Welcome</div><div class=body><p>Own {n}</p></div><h2>{h}</h2>"
    rows = [(n, "http://m.example/", body.format(n=n % 2, h="x"), None) for n in range(100)]  # 2 pages x 50 copies
    rows += [(100 + n, "http://k.example/", body.format(n=n % 20, h=f"part {n % 20 // 2}"), None) for n in range(40)]
    got = {r["page_id"]: r["text"] for r in pages.extracted(frame(spark, rows)).collect()}
    assert all(got[n] == f"Welcome\nOwn {n % 2}\nx" for n in range(100))
    assert all(got[100 + n] == f"Own {n % 20}\npart {n % 20 // 2}" for n in range(40))


def test_induction_decides_inside_and_beside_articles(spark):
    words = ["alpha", "beta", "gamma", "delta", "eta", "theta", "iota", "kappa"]
    own = lambda n: f"Page {words[n]} tells of {words[n]} and nothing else, at some length."
    notice = "<article><p>{x}</p><p>Subscribe to us!</p><p>{x} Again.</p></article><div><p>Outside {n}</p></div>"
    teaser = "<div class=top>Welcome</div><div class=text><p>{x}</p><p>{x} Again.</p></div><article>Teaser {n}</article>"
    alike = "<article><p>One text for all pages of the host.</p></article><p>At {n}</p>"
    rows = [
        (100 * k + n, f"http://h{k}.example/", form.format(x=own(n), n=n), None)
        for k, form in enumerate((notice, teaser, alike)) for n in range(8)
    ]
    got = {r["page_id"]: r["text"] for r in pages.extracted(frame(spark, rows)).collect()}
    assert [got[n] for n in range(8)] == [f"{own(n)}\n{own(n)} Again." for n in range(8)]
    assert [got[100 + n] for n in range(8)] == [f"{own(n)}\n{own(n)} Again.\nTeaser {n}" for n in range(8)]
    assert {got[200 + n] for n in range(8)} == {"One text for all pages of the host."}


def test_class_words_and_forms_around_the_main_text_do_not_drop_it():
    of = lambda source: pages.main_text(source, None, set())
    long = "The body of the page, which is long enough."
    article = f"<article><p>{long}</p><div class=comments-area><article class=comment><p>{long} {long} No.</p></article></div></article>"
    for around in (
        "<body class='single has-sidebar'>{}</body>", "<div id=page class='no-sidebar'>{}</div>", "<body class='social-policy'>{}</body>",
        "<body><form action=/ id=aspnet>{}<input></form></body>", "<body><div class='content sidebar-left'>{}</div></body>",
        "<div style='overflow:hidden' aria-hidden=false data-class=sidebar>{}</div>",
    ):
        for inner in (article, article.replace("<article><p>", "<article class='post comments-open'><p>"), f"<p>{long}</p>"):
            assert of(around.format(inner) + "<div class=sidebar><p>Side</p></div><form>Find</form>") == long, (around, inner)
    assert of(f"<div class='related'><article>Card</article></div><div><p>{long}</p></div><div class=footer-links>x</div>") == long
    assert of(f"<p>{long}</p><div id=comments><p>{long} {long}</p></div>") == long


def test_unescaped_less_than_signs_are_text(spark):
    code = "<div><p>if (i<n) x a<b) y</p><p>f<g(x)> me<a@b.example> no{n}</p></div>"
    rows = [(n, "http://c.example/", code.replace("{n}", str(n)), None) for n in range(6)]
    got = {r["page_id"]: r["text"] for r in pages.extracted(frame(spark, rows)).collect()}
    assert got[3].endswith("f<g(x)> me<a@b.example> no3")
    assert pages.main_text(rows[3][2], None, set()) == "if (i<n) x a<b) y\nf<g(x)> me<a@b.example> no3"


def vectors(spark, rows):
    return ready(spark).createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")


def exact(x, ids, query, k):
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = y @ y[ids.index(query)]
    order = sorted((-s, i) for s, i in zip(sims.tolist(), ids) if i != query)
    return [i for _, i in order[:k]]


def test_neighbours_of_odd_and_repeated_vectors(spark):
    nan = float("nan")
    rows = [(i, [float(i % 7 + 1), float(i % 3), 1.0], 0, "x") for i in range(60)]
    rows += [(100, None, 0, ""), (101, [0.0, 0.0, 0.0], 0, ""), (102, [1.0, None, 1.0], 0, ""), (103, [nan, 1.0, 1.0], 0, ""),
             (104, [float("inf"), 1.0, 1.0], 0, ""), (None, [1.0, 1.0, 1.0], 0, ""), (105, [1.0, 2.0], 0, ""), (0, [1.0, 0.0, 1.0], 0, "again"), (106, [], 0, "")]
    df = vectors(spark, rows)
    got = neighbours.nearest(df, df.where("vec_id in (0, 21, 100, 105)"), 5, shard=30).collect()
    assert {r["query_id"] for r in got} == {0, 21}
    own = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 0]
    same = [i for i in range(1, 60) if i % 21 == 0]  # equal vectors come first, by id
    x = np.array([r[1] for r in rows[:60]])
    assert own[: len(same)] == same and own == exact(x, list(range(60)), 0, 5)
    assert neighbours.nearest(vectors(spark, []), vectors(spark, [])).collect() == []


def test_recall_against_brute_force(spark, sf_dir):
    data = duckdb.execute(f"select vec_id, embedding from '{sf_dir}/../sf0.1/embeddings.parquet' order by vec_id").fetchall()
    ids, x = [r[0] for r in data], np.array([r[1] for r in data], np.float64)
    df = spark.read.parquet(f"{sf_dir}/../sf0.1/embeddings.parquet")
    got = neighbours.nearest(df, df.where("vec_id % 50 = 0"), shard=2000).collect()
    asked = [i for i in ids if i % 50 == 0]
    assert len(got) == 5 * len(asked)
    found = {q: {r["vec_id"] for r in got if r["query_id"] == q} for q in asked}
    hits = sum(len(found[q] & set(exact(x, ids, q, 5))) for q in asked)
    assert hits >= 0.9 * 5 * len(asked)
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    at = {i: n for n, i in enumerate(ids)}
    assert all(abs(r["score"] - y[at[r["query_id"]]] @ y[at[r["vec_id"]]]) < 1e-12 for r in got)


def test_recall_of_a_full_shard_without_clusters():
    x = np.random.default_rng(7).standard_normal((neighbours.SHARD, 64)).astype(np.float32)
    graph, y, hits, asked = neighbours.Graph(x), x / np.linalg.norm(x, axis=1, keepdims=True), 0, range(0, len(x), 50)
    for q in asked:
        best = np.argsort(-(y @ y[q]))[:6]
        hits += len({i for i in graph.find(x[q], neighbours.SEARCH)[:6]} & set(best.tolist())) - 1
    assert hits >= 0.9 * 5 * len(asked)


def test_pipeline_equals_its_stages_by_hand(spark, sf_dir):
    rows = {r[0]: r for r in duckdb.execute(f"select doc_id, text, lang from '{sf_dir}/documents.parquet'").fetchall()}
    df = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(df.where("crc32(cast(doc_id as string)) % 4 != 2"))
    said = {r["doc_id"]: r for r in language.predict(df, model).collect()}
    texts = {i: r[1] for i, r in rows.items() if said[i]["lang_pred"] != "und" and said[i]["score"] >= 0.5}
    low = closure({i: plain_fingerprint(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if low[i] == i}
    items = duckdb.execute(f"select item_id, text from '{sf_dir}/benchmark.parquet'").fetchall()
    texts = {i: t for i, t in texts.items() if not plain_contamination({i: t}, items)[i][4]}
    exact_ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def clean(t):
        spans = secrets.base_spans(t)
        at, out = 0, []
        for s, _, e in sorted([*spans, *secrets.novel_spans(t, spans)]):
            out += [t[at:s], "[secret]"] if s >= at else []
            at = max(at, e)
        return "".join([*out, t[at:]])

    want = {i: [*exact_ids.encode(clean(t), add_special_tokens=False).ids, 0] for i, t in texts.items()}
    got = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"] and len(ids) == r["length"]
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == {i: len(v) for i, v in want.items()}


def test_stages_keep_columns_and_bear_odd_rows(spark, sf_dir):
    rows = [(1, "the cat is here", "en", "s", 3, "x"), (2, None, None, None, None, None), (None, "", "fr", "s", 0, "y"), (1, "the cat is here", "en", "s", 3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string")
    for table in (docs, docs.limit(0)):
        now = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, sf_dir)
            assert now.columns == docs.columns, name
        assert now.count() == (1 if table is docs else 0)
        pieces = corpus_pipeline.STAGES[-1][1](spark, table, sf_dir)
        assert {r["doc_id"] for r in pieces.collect()} == ({1, 2, None} if table is docs else set())


def test_one_row_of_a_repeated_id_stays_by_order(spark):
    rows = [(2, "b words of one text", "x"), (2, "a words of other text", "z"), (2, "a words of other text", "y"), (1, None, "x"), (3, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = simhash.groups(docs)
    for frame in (docs, docs.orderBy(F.desc("source"))):
        kept = {tuple(r) for r in simhash.one_of_each(frame.repartition(3), found).collect()}
        assert {(r[0], r[1]) for r in kept} == {(1, None), (2, "a words of other text")} and len(kept) == 2
