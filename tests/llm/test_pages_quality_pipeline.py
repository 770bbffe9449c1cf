import zlib

import numpy as np
import pytest

import corpus_pipeline
from marginlens.llm import html_extract, quality
from marginlens.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


# --- HTML ---
@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain &amp; text", "plain & text"), ("a<b", "a<b"), ("</p></div>t", "t"),
    ("<b>a</b><br>b<p>c", "a b c"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<main><section><p>aa, bb, cc</p></section><section><p>x</p></section></main><aside>no</aside>", "aa, bb, cc x"),
    ("<p>one\n  two&nbsp;three</p>", "one two three"),
    ("<article><h1>T</h1><p>a <b>b<p>c</article><footer>f</footer>", "T a b c"),
    ("<script>var x='</p>'</script><style>p{}</style><!-- c --><p>kept, yes</p>", "kept, yes"),
    ("<article><header><h1>Title</h1></header><p>Body, text.</p><div class='comments'><p>nice, post</p></div></article>",
     "Title Body, text."),
    ("<article><p>x</p><ul><li>point one<li>point two</ul></article>", "x point one point two"),
    ("<body><div id='sidebar'><p>menu, text, long</p></div><div class='content'><p>Real, text.</p></div></body>", "Real, text."),
    ("<article><p>A, b.</p><form><p>Name, mail</p></form><div role=alert>Warn</div><p hidden>h</p></article>", "A, b."),
])
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


def test_articles_lose_no_text_by_ids_or_linked_lists():
    page = ("<article><h2 id='related-work'>Related work</h2><p class='notice'>A notice, in prose.</p>"
            "<section id='discussion'><p>We discuss, at length.</p></section><h2 class='search'>Search engines</h2>"
            "<ul><li><a href='a'>First source</a></li><li><a href='b'>Second source</a></li></ul>"
            "<div id='related'><a href='c'>More like this</a></div><div class='share'>Share it</div></article>"
            "<div id='sidebar'><p>Aside, from the text.</p></div>")
    assert html_extract.main_text(page) == ("Related work A notice, in prose. We discuss, at length. Search engines "
                                            "First source Second source")


def test_best_container_and_prose_siblings():
    body = "<p>Long sentence, with commas, and more words that go on.</p>" * 5
    page = f"<body><div class=x><div>{body}</div><p>A closing line.</p></div><div><a href=1>l1</a> <a href=2>l2</a></div></body>"
    got = html_extract.main_text(page)
    assert got.count("Long sentence") == 5 and got.endswith("A closing line.") and "l1" not in got


def test_deep_and_long_pages():
    assert html_extract.main_text("<div>" * 20_000 + "x") == "x"
    assert len(html_extract.main_text("<article>" + "<p>word, word</p>" * 20_000)) == 20_000 * 11 - 1


def test_extract_pages_keeps_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "t"), (1, "u", "<p>a</p>", "t"), (None, None, None, None)],
                                  "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url, r.text) for r in html_extract.extract_pages(pages).collect())
    assert got == [(0, None, ""), (1, "u", "a"), (1, "u", "a")]
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


# --- quality ---
def test_marginals_match_enumeration():
    import itertools
    rng = np.random.default_rng(2)
    u, trans = rng.normal(size=6) * 2, rng.normal(size=(2, 2))
    total, good = 0.0, np.zeros(6)
    for path in itertools.product((0, 1), repeat=6):
        w = np.exp(sum(u[t] * s for t, s in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        total += w
        good += w * np.array(path)
    assert np.allclose(quality.chain_marginals(u.tolist(), trans), good / total)
    batch, joint = quality.marginals(u[None], trans, np.array([6]))
    assert np.allclose(batch[0], good / total) and np.allclose(joint[0].sum((1, 2)), 1)


def test_padding_does_not_change_marginals():
    u = np.random.default_rng(3).normal(size=(2, 9))
    trans = np.array([[.4, -.1], [0, .8]])
    got, _ = quality.marginals(u, trans, np.array([9, 4]))
    assert np.allclose(got[1, :4], quality.chain_marginals(u[1, :4].tolist(), trans))


def test_extreme_potentials_stay_finite():
    got = quality.chain_marginals([1e6, -1e6, 1e6], np.array([[5, -5], [-5, 5.]]))
    assert all(0 <= p <= 1 for p in got)


def test_no_labels_scores_one_half(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (2, None), (None, "x " * 50_000), (1, "a\nb")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert [r.score for r in quality.score_documents(docs, model).collect()] == [0.5] * 4
    assert quality.score_documents(docs.limit(0), model).count() == 0


def test_learns_and_never_trains_on_the_held_out_fold(spark):
    good, bad = "Some plain words make a line.\nAnother line of words follows.", "BUY!! NOW!! BUY!!\nX!! X!! X!!"
    rows = [(i, good if i % 2 else bad, "clash") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    # labels of the held-out fold are wrong on purpose
    labels = [(i, (i % 2) if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(200)]
    model = quality.train(docs, spark.createDataFrame(labels + [(7, None), (None, 1)], "doc_id long, quality int"))
    out = quality.score_documents(docs, model, out="s").collect()
    assert all((r.s >= quality.THRESHOLD) == (r.doc_id % 2) for r in out)


def test_held_out_accuracy(spark):
    rows = QUERIES["op10_quality"](spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and np.mean([p == t for p, t in held]) > 0.95


# --- pipeline ---
def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns, name
        after = corpus_pipeline.staged(after, name)
        assert after.exceptAll(before).count() == 0, name
        before = after
    texts = [r.text for r in before.collect()]
    assert len(texts) == len(set(texts)) and 0 < len(texts) < docs.count()
    out = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert out.count() == len(texts)


def test_pipeline_on_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, doc string"
    line = "a plain line of words that reads well enough."
    docs = spark.createDataFrame([(1, line, "en", "s", 1, "c", "d"), (2, line, None, None, None, None, None),
                                  (2, line, None, None, None, None, None), (None, None, None, None, None, None, None),
                                  (4, "", "en", "s", 0, "c", "d"), (5, "w " * 60_000, "en", "s", 0, "c", "d")], schema)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for rows in (docs, docs.limit(0)):
        cur = rows
        for name, stage in corpus_pipeline.STAGES:
            cur = corpus_pipeline.staged(stage(spark, cur, str(tmp_path)), name)
        assert cur.columns[:2] == ["doc_id", "n_tokens"]
        assert cur.count() == (0 if rows is not docs else 3)


def test_registry_names_and_order():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "tokens"]
