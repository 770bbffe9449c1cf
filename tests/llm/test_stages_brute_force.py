"""Queries and pipeline stages on the smallest tables against independent brute-force versions."""
import hashlib
import html
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from marginlens.llm import html_extract, quality
from tests.llm.test_search import _brute, _hits, words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def _score(text, model):
    """The score from the batched forward-backward pass, one chain at a time."""
    lines = (text or "").split("\n")
    unary = quality.chain_inputs(quality.line_features(lines), model["mean"], model["scale"]) @ model["w"]
    good, _ = quality.marginals(unary[None, :].astype(float), model["trans"], np.array([len(lines)]))
    weights = np.array([len(x) for x in lines], float)
    weights = weights if weights.any() else np.ones(len(lines))
    return float((good[0] * weights).sum() / weights.sum())


def _kept(stage, spark, docs):
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF)
    assert out.columns == docs.columns
    return sorted(r.doc_id for r in out.collect())


def test_quality_query_and_stage(spark, docs, rows):
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r.doc_id: r for r in quality.op10_quality(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = _score(text, model)
        assert abs(got[i].score - want) < 1e-6 and got[i].predicted == int(got[i].score >= 0.3)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert _kept("quality", spark, docs) == sorted(i for i, _ in rows if got[i].score >= quality.THRESHOLD)


def test_repeated_labelled_ids_and_long_texts_have_a_bound(spark):
    """One id of a thousand rows and a text of many lines train as one document of bounded size."""
    good, bad = "A fine and quiet sentence ends here.\n" * 5, "!!! ### $$$ buy buy\n" * 5
    rows = [(k, good if k % 2 else bad) for k in range(40)] + [(1, f"{good}{k}") for k in range(1000)] + [(3, good * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    seen = []
    fit = quality.fit
    try:
        quality.fit = lambda features, y: seen.append((len(features), max(map(len, features)))) or fit(features, y)
        quality.train(docs, labels)
    finally:
        quality.fit = fit
    assert seen[0][0] <= 40 and seen[0][1] <= quality.TRAIN_CHAINS * quality.TRAIN_LINES


def test_exact_dedup_stage(spark, docs, rows):
    best = {}
    for i, text in rows:
        best[text or ""] = max(i, best.get(text or "", i))
    assert _kept("exact_dedup", spark, docs) == sorted(best.values())


def test_near_dedup_stage(spark, docs, rows):
    classes = _brute(rows)
    least = defaultdict(list)
    for i, (c, _) in classes.items():
        least[c].append(i)
    assert _kept("near_dedup", spark, docs) == sorted(min(ids) for ids in least.values())


def test_decontamination_stage(spark, docs, rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[n].add(tuple(w[k:k + n]))
    clean = [i for i, text in rows if not any(tuple(w[k:k + n]) in some for n, some in windows.items()
                                              for w in [words_of(text)] for k in range(len(w) - n + 1))]
    assert _kept("decontamination", spark, docs) == sorted(clean)
    assert 0 < len(clean) < len(rows) and _hits([], items) == (0, "")


def test_tokens_stage(spark, docs, rows):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    clash = docs.withColumnsRenamed({"lang": "ids_sha256", "source": "n_tokens"})
    got = {r.doc_id: tuple(r)[1:] for r in dict(corpus_pipeline.STAGES)["tokens"](spark, clash, SF).collect()}
    for i, text in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_main_text_of_all_small_pages(spark):
    """The pages' articles by patterns: what stands in <article>, block by block."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.op6_html(spark, SF).collect()}
    for page in pages:
        article = re.search(r"<article>(.*?)(</article>|<footer>)", re.sub(r"<!--.*?-->", "", page.html, flags=re.S), re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p|br)>", article)]
        want = " ".join(b for b in blocks if b)
        assert got[page.page_id] == (want, len(want))
