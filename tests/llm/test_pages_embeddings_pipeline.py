import html
import re
from datetime import datetime

import numpy as np
import pytest
from helpers import SCHEMA, awkward, classes, empty
from pyspark.sql import functions as F

import corpus_pipeline
from punctual.llm import blocks, components, embeddings, htmltext, queries, urlfilter

SMALL = "/root/testdata/sf0.001"

PAGES = {
    None: "",
    "": "",
    "plain < text &amp; more": "plain < text & more",
    "<nav>menu</nav><article><h1>T</h1><p>a&nbsp;b\n c<br>d</p><aside>x</aside><p>e</p></article><footer>f</footer>": "T a b c d e",
    "<body class='has-sidebar'><div id=content><p>Main text that is long enough to count.</p><div class=comments><p>reader says</p></div>"
    "<p>Tail.</p></div><form>Name<input></form>": "Main text that is long enough to count. Tail.",
    "<script>var a='</p>'</script><style>p{}</style><p>one<!-- two --> three": "one three",
    "<article><p>kept</p><div class='ad-banner'><div>buy</div></div><section class=comment-list>no</section><p>too</article>": "kept too",
    "<nav>never closed<article>in</article>": "in",
    "<header>site</header><main><header><h1>In</h1></header>body</main>": "In body",
    "<div class='post-header'><h1>Own</h1></div><p>text of the post, long enough</p><div class='entry-comments'>said</div><div class='page-footer'>f</div>": "Own text of the post, long enough",
    "<p hidden>no</p><p style='display: none'>no</p><p>yes</p>": "yes",
    "<p title='a>b'>x</p><p": "x",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert htmltext.main_text(page) == PAGES[page]


def test_window_sums_choose_on_pages_with_an_article():
    body = " ".join(["body text outside of any article element"] * 8)
    card = "<article><h3>Teaser</h3></article>"
    assert htmltext.main_text(f"<div><p>{body}</p><p>{body}</p></div>{card}") == f"{body} {body}"
    assert htmltext.main_text(f"{card}<div><p>{body}</p></div>{card}<p>{body}</p>") == f"{body} {body}"
    # The article outweighs short text around it, and stays whole.
    gap = "<div class=ad>" + "<p>buy</p>" * 5 + "</div>"
    assert htmltext.main_text(f"<p>top</p><article><p>{body}</p>{gap}<p>End.</p></article><p>below</p>") == f"{body} End."


NAMED = {
    "<article class='post category-social-media'><p>in</p></article>": "in",
    "<article class='post tag-advertising'><p>in</p></article>": "in",
    "<article><h2 id='related-work'>Related</h2><p>a</p><h2 id='search'>Search</h2><section id='related-work'>b</section></article>": "Related a Search b",
    "<article><p>a</p><div class='related-posts-2'>no</div><ul class='social-links top'><li>no</ul><p>b</p></article>": "a b",
    "<article><p class='ad'>buy <b>now<p>a<p>b</article>": "a b",
    "<article><p>a</p><p class='ad'>buy</article><article><p>b</article>": "a b",
    "<article><ul><li>a<li class='share'>no<ul><li>no<li>no</ul>no<li>b</ul><p>c</article>": "a b c",
    "<article><ul><li class='share'>no<p>no<p>no</ul><p>a</article>": "a",
    "<article><table><tr><td class='ad'>no<table><tr><td>no</table><td>a<tr><td class='ad'>no<tr><td>b</table>c</article>": "a b c",
    "<article><dl><dt>a<dd class='ad'>no<dt>b</dl><div class='ad'>no<div>no</article><article>c</article>": "a b c",
}


@pytest.mark.parametrize("page", NAMED)
def test_names_and_left_out_end_tags(page):
    assert htmltext.main_text(page) == NAMED[page]


def test_main_text_of_long_pages():
    page = "<article>" + "<p>word</p>" * 100_000 + "</article>"
    assert htmltext.main_text(page) == " ".join(["word"] * 100_000)


def test_main_text_query_on_all_pages(spark):
    pages = {row.page_id: row.html for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = queries.line_block_text(spark, SMALL).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*)</article>", pages[row.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", part)).split()) for part in re.split(r"</?(?:p|h1|br)>", article)]
        assert row.text == " ".join(part for part in parts if part) and row.n_chars == len(row.text)


def test_extract_keeps_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "<p>a</p>", "y"), (2, "<p>a</p>", "y")], "page_id long, html string, text string")
    assert sorted(map(tuple, htmltext.extract(df).select("page_id", "text").collect())) == [(1, ""), (2, "a"), (2, "a")]
    assert htmltext.extract(df.limit(0)).count() == 0


def day(n):
    return datetime(2024, 1, n)


def test_paths_keep_their_case(spark):
    entries = spark.createDataFrame([("Bad.example/Ok", "block", day(1)), ("BAD.example/B/C", "block", day(1))], "key string, action string, since timestamp")
    urls = {"http://bad.example/Ok/1": False, "http://Bad.Example/Ok": False, "http://bad.example/ok/1": True, "http://bad.example/B/C/d": False, "http://bad.example/b/c": True}
    captures = spark.createDataFrame([(url, day(2)) for url in urls], "url string, fetched timestamp")
    assert {row.url: row.kept for row in urlfilter.evaluate(captures, urlfilter.intervals(entries)).collect()} == urls


def test_lists_at_fetch_time(spark):
    entries = spark.createDataFrame(
        [("Bad.example", "block", day(5)), ("bad.example", "allow", day(10)), ("bad.example", "block", day(10)), ("bad.example", "allow", day(20)),
         ("bad.example/ok", "allow", day(6)), ("deep.bad.example", "allow", day(7)), (None, "block", day(1)), ("x.example", None, day(1))],
        "key string, action string, since timestamp")
    asked = [
        ("http://bad.example/a", day(4), True), ("http://bad.example/a", day(5), False), ("https://u:p@WWW.bad.example.:80/a?q", day(9), False),
        ("http://bad.example", day(10), False), ("http://bad.example", day(20), True), ("http://bad.example/ok/1", day(7), True),
        ("http://bad.example/okay", day(7), False), ("http://deep.bad.example/", day(8), True), ("http://verybad.example/", day(8), True),
        (None, day(8), True), ("no url", day(8), True), ("http://bad.example", None, True), ("http://bad.example/a", day(5), False),
    ]
    captures = spark.createDataFrame([(*row, "mine") for row in asked], "url string, fetched timestamp, want boolean, key string")
    for seconds in (86400, 365 * 86400):
        rows = urlfilter.evaluate(captures, urlfilter.intervals(entries), bucket_seconds=seconds).collect()
        assert len(rows) == len(asked) and all(row.kept == row.want and row.key == "mine" for row in rows)
    assert urlfilter.evaluate(captures, urlfilter.intervals(entries.limit(0))).filter("not kept").count() == 0
    assert urlfilter.evaluate(captures.limit(0), urlfilter.intervals(entries)).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(500, 501), (501, 500), (7, 7)]
    rows = components.connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {row.node: row.root for row in rows} == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 501: 500}


def test_block_pairs_meet_once(spark):
    df = spark.range(50).select(F.lit(1).alias("g"), F.col("id").cast("string").alias("node")).union(spark.createDataFrame([(2, "alone")], "g int, node string"))
    met = {}
    for row in blocks.block_pairs(df, "g", "node", 7).collect():
        met.setdefault((row.low, row.high), []).append((row.node, row.own))
    pairs = [frozenset((a, b)) for (low, high), rows in met.items() for a, p in rows for b, q in rows if a < b and (low == high or p != q)]
    assert len(pairs) == len(set(pairs)) == 50 * 49 // 2


def brute_links(rows, threshold=0.98):
    good = []
    for key, vector, label in rows:
        ok = label is not None and vector and all(v is not None and np.isfinite(v) for v in vector) and any(vector)
        good.append(np.array(vector, float) / np.linalg.norm(np.array(vector, float)) if ok else None)
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for i in range(len(rows)):
        for j in range(i):
            a, b = good[i], good[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [(row[0], links[at], rows[find(at)][0]) for at, row in enumerate(rows)]


@pytest.mark.parametrize("block", [16, 512])
def test_embedding_links_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block)
    chance = np.random.default_rng(3)
    rows = []
    for center in chance.normal(size=(25, 32)):
        for _ in range(int(chance.integers(1, 12))):
            rows.append((center + chance.normal(scale=0.13, size=32)).tolist())
    rows = [(at, vector, int(at % 2)) for at, vector in enumerate(rows)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 32, 1), (n + 2, [None] * 32, 1), (n + 3, [float("nan")] * 32, 1), (n + 4, rows[0][1], None),
             (n + 5, [float("inf")] * 32, 1), (n + 6, [1.0, 2.0], 1), (n + 7, [2.0, 4.0], 1), (n + 8, rows[0][1], 0), (n + 9, [], 0), (n + 10, [2.0, 4.0], 1)]
    got = embeddings.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "vec_id", "embedding", "label").collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.link(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), "vec_id", "embedding", "label").count() == 0


def test_embedding_query_equals_all_pairs(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    got = queries.collision_counting(spark, SMALL).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(rows)


def test_pipeline_stages_on_awkward_rows(spark):
    for make in (awkward, empty):
        docs = make(spark)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns
            out.collect()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
        assert last.count() == docs.count() and last.columns == [*docs.columns, "ids", "n_tokens", "decoded_bytes"]
    assert corpus_pipeline.keep_one_of_each(spark, spark.createDataFrame([(1, "a b", "en", "s", 3, 1, "", "", "")] * 3, SCHEMA), SMALL).count() == 1


def test_pipeline_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = {row.doc_id for row in queries.quality_rules(spark, SMALL).filter("kept").collect()}
    pairs = [(row.doc_id, row.text) for row in docs.orderBy("doc_id").collect() if row.doc_id in good]
    unique = {key for (key, _), least in zip(pairs, classes(pairs)) if key == least}
    assert {row.doc_id for row in corpus_pipeline.keep_one_of_each(spark, corpus_pipeline.keep_good(spark, docs, SMALL), SMALL).collect()} == unique
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {row.doc_id for row in rows} <= unique
    assert all(row.decoded_bytes == len(row.text.encode()) and len(row.ids) == 4 * row.n_tokens for row in rows)
