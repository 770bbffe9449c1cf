"""Jaccard join, decontamination, substring dedup against brute force."""
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginlens.llm import decontaminate, jaccard_join, shingles, substring_dedup
from marginlens.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").translate(LOW))


def shingle_set(text):
    w = words_of(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def prose(rnd, n):
    return " ".join(rnd.choice("abcdefghij") + str(rnd.randrange(300)) for _ in range(n))


def edited(rnd, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rnd.randrange(len(w))] = f"new{rnd.randrange(10 ** 6)}"
    return " ".join(w)


def test_words_and_hashes_agree_with_the_pattern():
    for text in ["Éa b-c D1,é\tÉ", "", None, "  ", "ÀB à", "a" * 10_000, "x\x00y z{|}~", "日本 語"]:
        h = shingles.word_hashes(text)
        w = words_of(text)
        assert len(h) == len(w) and len(set(h.tolist())) == len(set(w))
    both = shingles.word_hashes("one two one"), shingles.word_hashes("zz one")
    assert both[0][0] == both[0][2] == both[1][1]


# --- components ---
def test_components_against_union_find(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(80)] + [(200, k) for k in range(201, 260)] + \
        [(k, k + 1) for k in range(300, 340)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- Jaccard join ---
def _corpus(seed=1):
    rnd = random.Random(seed)
    texts = [prose(rnd, rnd.randint(3, 150)) for _ in range(60)]
    base = prose(rnd, 120)
    texts += [edited(rnd, base, rnd.randint(0, 3)) for _ in range(70)]  # one large near group
    texts += [edited(rnd, texts[k], 1) for k in range(30)] + [base] * 20
    texts += ["", None, "!!!", "!!!", "two words", "Two  WORDS", "w " * 30_000]
    rnd.shuffle(texts)
    return list(enumerate(texts))


def _brute(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    n = defaultdict(int)
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                    n[i] += 1
                    n[j] += 1
                    a, b = sorted((find(i), find(j)))
                    up[b] = a
    return {i: (find(i), n[i]) for i in sets}


@pytest.mark.parametrize("blocks", [(512, 256), (16, 8)])
def test_jaccard_classes_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(jaccard_join, "SIGNATURE_BLOCK", blocks[0])
    monkeypatch.setattr(jaccard_join, "SET_BLOCK", blocks[1])
    rows = _corpus()
    docs = spark.createDataFrame([(i, t, "c", 0) for i, t in rows], "doc_id long, text string, node string, cluster int")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_classes(docs).collect()}
    assert got == _brute(rows)


def test_jaccard_repeated_rows_null_ids_and_empty(spark):
    schema = "doc_id long, text string, set_id string"
    text = "a b c d e f g"
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (None, text, "x"), (4, "", "x"), (4, "", "x")], schema)
    got = sorted((r.doc_id or 0, r.class_id, r.n_links) for r in jaccard_join.jaccard_classes(docs).collect())
    assert got == [(0, 1, 2), (1, 1, 2), (1, 1, 2), (4, 4, 0), (4, 4, 0)]
    kept = jaccard_join.keep_one_per_class(docs)
    assert kept.columns == docs.columns
    assert sum(r.text == text for r in kept.collect()) == 1
    assert jaccard_join.jaccard_classes(docs.limit(0)).count() == 0


def test_prefix_is_shortened_until_the_recall():
    assert jaccard_join.prefix_length(0.8, 0.9) > jaccard_join.prefix_length(0.8, 0.9999)
    d = jaccard_join.prefix_length(0.8)
    assert 1 - (1 - 0.8 ** d) ** jaccard_join.TREES >= jaccard_join.TARGET_RECALL


def test_prefixes_are_shortened_where_buckets_are_small():
    least, lengths = jaccard_join.prefix_length(0.8), jaccard_join.LONGEST
    sizes = np.ones((jaccard_join.TREES, lengths - least + 1), np.int64)
    alone = jaccard_join.matched_prefixes(sizes, least, 0.8)

    def recall(depths):
        return 1 - np.prod(1 - 0.8 ** np.asarray(depths, float))

    assert recall(alone) >= jaccard_join.TARGET_RECALL
    sizes[3] = [9000, 4000, 1000, 300, 90][:lengths - least + 1]
    sizes[7] = [500, 200, 50, 20, 10][:lengths - least + 1]
    depths = jaccard_join.matched_prefixes(sizes, least, 0.8)
    assert depths[3] == lengths and depths[3] >= depths[7] >= max(np.delete(depths, [3, 7])) == least
    sizes[7] = jaccard_join.CHEAP  # small buckets are asked for in any case
    assert jaccard_join.matched_prefixes(sizes, least, 0.8)[7] == least
    assert recall(depths) >= jaccard_join.TARGET_RECALL
    # every bucket large: still the recall, by shortening all of them
    assert recall(jaccard_join.matched_prefixes(np.full_like(sizes, 10 ** 6), least, 0.8)) >= jaccard_join.TARGET_RECALL


def test_recall_of_planted_pairs_at_the_threshold(spark):
    """Pairs at exactly 0.8 among texts that share lines with many others."""
    rnd = random.Random(21)
    lines = [prose(rnd, 12) for _ in range(6)]
    docs, planted = [], []
    for k in range(250):
        own = [f"u{rnd.randrange(10 ** 9)}" for _ in range(41)]
        head = rnd.choice(lines).split()
        text = head + own  # 53 words, 49 shingles; a changed word inside costs 5: 44 / 54 = 0.81
        other = list(text)
        other[rnd.randrange(20, 45)] = "changed"
        docs += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(other))]
        planted.append((2 * k, 2 * k + 1))
    got = {r.doc_id: r.class_id for r in jaccard_join.jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = sum(got[a] == got[b] for a, b in planted)
    print(f"recall of {len(planted)} pairs at 0.81: {found / len(planted):.4f}")
    assert found == len(planted)
    want = _brute(docs)
    assert got == {i: c for i, (c, _) in want.items()}


def test_the_forest_compares_less_than_fixed_prefixes(spark):
    """Texts that are alike in parts only: their large buckets are asked at longer prefixes."""
    rnd = random.Random(22)
    frame = [prose(rnd, 60) for _ in range(2)]
    docs = [(k, f"{frame[k % 2]} {prose(rnd, 28)}") for k in range(240)]
    texts = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) text_key", "text")
    least = jaccard_join.prefix_length(0.8)
    sketch = jaccard_join._sketch(texts, least).filter("set_id is not null")
    nodes = jaccard_join.staged(sketch.selectExpr("monotonically_increasing_id() as node", "keys", "sig"), "nodes")
    fixed = nodes.select(F.explode("keys").alias("key")).groupBy("key").count().filter("count > 1")
    fixed = fixed.agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    members = jaccard_join.buckets(nodes, least, cheap=8).groupBy("key").agg(F.count_if("asks").alias("a"), F.count_if(F.expr("not asks")).alias("o"))
    forest = members.agg(F.sum(F.col("a") * (F.col("a") - 1) / 2 + F.col("a") * F.col("o"))).first()[0]
    print(f"pairs compared: {forest:.0f} by the forest, {fixed:.0f} with a fixed prefix")
    assert 0 < forest < 0.9 * fixed


def test_a_chain_of_texts_whose_ends_are_unlike(spark):
    """Each text is near the next one only; the class is the whole chain, links are counted exactly."""
    rnd = random.Random(23)
    words = [f"c{rnd.randrange(10 ** 9)}" for _ in range(50 + 4 * 60)]
    docs = [(k, " ".join(words[4 * k:4 * k + 50])) for k in range(60)]  # 42 of 50 shingles in common with the next
    got = {r.doc_id: (r.class_id, r.n_links) for r in
           jaccard_join.jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == _brute(docs)
    assert {c for c, _ in got.values()} == {0} and sorted(n for _, n in got.values())[:2] == [1, 1]


# --- decontamination ---
def _hits(words, items, size=10):
    hit, ids = set(), set()
    for item_id, text in items:
        w = words_of(text)
        n = min(size, len(w))
        for s in range(len(w) - n + 1) if n else ():
            for p in range(len(words) - n + 1):
                if words[p:p + n] == w[s:s + n]:
                    hit.update(range(p, p + n))
                    if item_id is not None:
                        ids.add(str(item_id))
    return len(hit), ",".join(sorted(ids))


def test_contamination_against_brute_force(spark):
    import hashlib
    rnd = random.Random(8)
    items = [(k, " ".join(rnd.choice("abcdef") for _ in range(rnd.randint(8, 25)))) for k in range(12)]
    items += [(20, "Short ITEM here"), (21, ""), (22, None), (None, "zz yy xx ww vv uu tt ss rr qq pp"), (3, "a a a a a a a a a a a a")]
    docs = []
    for k in range(40):
        w = [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 2)):
            part = words_of(rnd.choice(items)[1])
            a = rnd.randrange(max(1, len(part)))
            at = rnd.randrange(len(w) + 1)
            w[at:at] = part[a:] if rnd.random() < .5 else part
        docs.append((k, "; ".join(w).upper() if k % 3 else ",".join(w)))
    docs += [(100, None), (101, ""), (7, docs[7][1]), (None, "zz yy xx ww vv uu tt ss rr qq pp"), (102, "a " * 3000)]
    df = spark.createDataFrame([(i, t, "c", "d") for i, t in docs], "doc_id long, text string, doc string, words string")
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, words string")
    got = decontaminate.contamination(df, bench).collect()
    want = []
    for i, t in docs:
        n, ids = _hits(words_of(t), items)
        want.append((i, len(words_of(t)), n, len(ids.split(",")) if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), n > 0))
    key = lambda r: tuple(map(str, r))
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted(want, key=key)
    clean = decontaminate.keep_clean(df, bench)
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(w[0]) for w in want if not w[5])


def test_contamination_empty_tables_and_native_plan(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.contamination(docs, bench)
    assert [(r.n_words, r.n_hit, r.contaminated) for r in out.collect()] == [(2, 0, False)]
    assert decontaminate.contamination(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_series_of_one_word(spark):
    """Every diagonal of a long item matches; the work stays linear in their number."""
    docs = spark.createDataFrame([(1, "so " * 8000), (2, "so " * 9), (3, "x " + "so " * 300 + "y")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "so " * 300), (6, "so " * 12 + "end")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: (8000, 2), 2: (0, 0), 3: (300, 2)}
    assert [r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()] == [2]


def test_texts_are_cut_once_outside_the_search(spark):
    """No lambda over candidates or words may hold the cutting of the text."""
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "a b c")], "item_id long, text string")
    for out in (decontaminate.keep_clean(docs, bench), decontaminate.contamination(docs, bench)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        inner = [line for line in plan.splitlines() if "candidates" in line and "lambdafunction" in line]
        assert inner
        for line in inner:
            for body in re.findall(r"lambdafunction\((.*)", line):
                assert "split(" not in body


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta"), (2, "alpha x x x x x x beta"), (3, "beta alpha")], "doc_id long, text string")
    keyed = decontaminate._keyed(docs, "doc_id", "text")
    terms = spark.createDataFrame([("q", "alpha"), ("q", "beta")], "query string, term string")
    found = decontaminate.proximity_matches(decontaminate.build_postings(keyed, terms), terms, 4)
    ids = keyed.join(found, "doc").select("doc_id").distinct()
    assert sorted(r.doc_id for r in ids.collect()) == [1, 3]


# --- substring dedup ---
def test_compact_windows_cover_every_long_subsequence():
    rng = np.random.default_rng(0)
    for k in range(60):
        h = rng.integers(0, 20 if k % 2 else 10 ** 6, rng.integers(1, 50))
        span = int(rng.integers(1, 8))
        windows = substring_dedup.compact_windows(h, span)
        for i in range(len(h)):
            for j in range(i + span - 1, len(h)):
                low = h[i:j + 1].min()
                assert any(a <= i and j <= b and h[c] == low for a, c, b in windows)


def test_compact_windows_of_repeated_values_stay_few():
    assert len(substring_dedup.compact_windows(np.zeros(20_000, np.uint64))) < 1000


def test_passages_against_brute_force(spark):
    rnd = random.Random(6)
    shared = [prose(rnd, n) for n in (55, 80, 51, 120)]
    docs = []
    for k in range(50):
        parts = [prose(rnd, rnd.randint(5, 80))]
        if k < 30:
            parts += [shared[k % 4], prose(rnd, rnd.randint(5, 60))]
        docs.append((k, " ".join(parts)))
    docs += [(60, prose(rnd, 49)), (61, None), (62, ""), (63, "b " * 5000), (64, "c " * 20)]
    twice = prose(rnd, 70)
    docs += [(65, f"{twice} {prose(rnd, 30)} {twice}"), (70, docs[40][1]), (71, docs[40][1]), (71, docs[40][1])]
    near = edited(rnd, shared[3], 2)
    docs += [(80, f"{prose(rnd, 20)} {near}")]
    df = spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id long, text string, doc string")
    got = defaultdict(set)
    rows = substring_dedup.repeated_passages(df).collect()
    for r in rows:
        got[r.doc_id].update(range(r.start_word, r.end_word))
        assert r.partner_id != r.doc_id
    where = defaultdict(set)
    for i, t in docs:
        w = words_of(t)
        for k in range(len(w) - 49):
            where[tuple(w[k:k + 50])].add((i, k))
    want = defaultdict(set)
    for places in where.values():
        if len({i for i, _ in places}) > 1:
            for i, k in places:
                want[i].update(range(k, k + 50))
    assert all(want[i] <= got[i] for i in want)
    assert set(got) - set(want) == {80}  # the near copy; a passage repeated inside one document is not reported
    assert substring_dedup.repeated_passages(df.limit(0)).count() == 0


def _marked(rows):
    got = defaultdict(set)
    for r in rows:
        got[r.doc_id].update(range(r.start_word, r.end_word))
    return got


@pytest.mark.parametrize("near", [False, True])
def test_passage_around_a_frequent_line_is_found(spark, near):
    # the line is in every document, a passage of 50 words around it in two of them each
    rnd = random.Random(14)
    line = prose(rnd, 40)
    docs, want = [], {}
    for k in range(60):
        passage = f"{prose(rnd, k % 11)} {line} {prose(rnd, 10 - k % 11)}".split()
        for i in (2 * k, 2 * k + 1):
            lead = prose(rnd, rnd.randint(3, 40))
            docs.append((i, f"{lead} {' '.join(passage)} {prose(rnd, 30)}"))
            want[i] = set(range(len(lead.split()), len(lead.split()) + 50))
            if near:
                passage[rnd.randrange(4, 46)] = "changed"
    got = _marked(substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert [i for i in want if len(want[i] & got[i]) < (45 if near else 50)] == []  # unshared ends are trimmed


def test_recall_of_passages_at_the_threshold(spark):
    # one changed word inside 50 leaves 41 of 46 shingles: similarity 41 / 51
    rnd = random.Random(15)
    docs = []
    for k in range(400):
        passage = [f"p{rnd.randrange(10 ** 9)}" for _ in range(50)]
        for i in (2 * k, 2 * k + 1):
            docs.append((i, f"{prose(rnd, rnd.randint(3, 60))} {' '.join(passage)} {prose(rnd, rnd.randint(3, 60))}"))
            passage[rnd.randrange(4, 46)] = "changed"
    got = _marked(substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert len(got) >= 798


def test_recall_of_passages_put_together_from_common_wordings(spark):
    """300 near pairs; every passage is made of five parts with four wordings each,
    so that every shingle and every single min-hash is in very many documents."""
    rnd = random.Random(31)
    wordings = [[[f"w{slot}{v}{i}x{rnd.randrange(10 ** 6)}" for i in range(10)] for v in range(4)] for slot in range(5)]
    docs, pairs = [], []
    for k in range(300):
        passage = [w for slot in wordings for w in rnd.choice(slot)]
        other = list(passage)
        other[rnd.randrange(4, 46)] = f"changed{k}"  # 41 of 51: just over the threshold
        for i, p in ((2 * k, passage), (2 * k + 1, other)):
            docs.append((i, f"{prose(rnd, rnd.randint(3, 40))} {' '.join(p)} {prose(rnd, rnd.randint(3, 40))}"))
        pairs.append((2 * k, 2 * k + 1))
    got = _marked(substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    found = sum(len(got[a]) >= 45 and len(got[b]) >= 45 for a, b in pairs)
    print(f"recall of {len(pairs)} pairs from common wordings: {found / len(pairs):.3f}")
    assert found >= 0.9 * len(pairs)


def test_levels_reach_their_recall():
    for width, bands in substring_dedup.LEVELS:
        assert substring_dedup.level_recall(0.8, width, bands) >= 0.98


def test_rows_of_a_large_group_unlike_both_ends_meet_the_whole_group(spark):
    rows = [(7, d, 10, 59, s) for d, s in ((1, 11), (2, 12), (3, 13), (4, 13), (5, 14), (6, 15))] + [(8, 9, 0, 49, 16), (8, 1, 0, 49, 17)]
    large = spark.createDataFrame(rows, "key long, doc long, l int, r int, same long")
    end = 60 + substring_dedup.WIDTH - 1  # in words, exclusive
    spans = [(d, 1, 10, end) for d in (1, 3, 4, 6)] + [(5, 1, 10, 30), (5, 2, 30, end), (2, 1, 10, end - 1), (9, 1, 0, 60), (1, 9, 0, 60)]
    spans = spark.createDataFrame(spans, "doc long, partner long, start int, end int")
    got = {(r.a.doc, r.b.doc) for r in substring_dedup._rest_links(large, spans).collect()}
    assert got == {(1, 2), (2, 3), (2, 4), (2, 5), (2, 6)}  # 2 alone has an unmarked place; 5 is covered by two spans
    assert substring_dedup._rest_links(large, spans.withColumn("end", substring_dedup.F.lit(99))).count() == 0


def test_sliding_minima_and_passage_keys():
    rng = np.random.default_rng(6)
    span = substring_dedup.SPAN
    h = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    assert (substring_dedup.sliding_min(h) == [h[i:i + span].min() for i in range(200 - span + 1)]).all()
    chosen = rng.random(200 - span + 1) < .8
    for level, (_, bands) in enumerate(substring_dedup.LEVELS):
        keys, left, right = substring_dedup.passage_keys(h, chosen, level)
        held = np.zeros((bands, len(chosen)), int)
        for k, a, z in zip(keys.tolist(), left.tolist(), right.tolist()):
            held[k & substring_dedup.KIND_BITS, a:z - span + 2] += 1
        assert (held == chosen).all()  # every chosen passage once per band
        moved = substring_dedup.passage_keys(np.concatenate((rng.integers(0, 1 << 63, 9, dtype=np.uint64), h[20:90])),
                                             np.ones(79 - span + 1, bool), level)[0]
        whole = substring_dedup.passage_keys(h, np.ones(len(chosen), bool), level)[0]
        assert set(moved.tolist()) & set(whole.tolist())  # the same passage has the same keys wherever it stands


def test_scattered_shingles_are_no_passage():
    rng = np.random.default_rng(3)
    lines = [rng.integers(0, 1 << 32, 20, dtype=np.uint32) for _ in range(12)]
    fill = lambda n: rng.integers(0, 1 << 32, n, dtype=np.uint32)
    x = np.concatenate(lines)
    y = np.concatenate([part for k in rng.permutation(12) for part in (lines[k], fill(12))])
    assert substring_dedup.shared_spans(x, y) == ([], [])  # every line, but in no order and far apart
    y = np.concatenate([lines[k * 5 % 12] for k in range(12)])
    assert substring_dedup.shared_spans(x, y) == ([], [])  # every line and nothing else, in another order
    line, rest = lines[0], lines[1:5]
    x = np.concatenate([fill(30), line, *rest, fill(30)])
    y = np.concatenate([line, fill(50), line, *rest[:2], fill(2), *rest[2:], fill(9), line])  # repeats and an insertion
    (a, b), = substring_dedup.shared_spans(x, y)[0]
    (c, d), = substring_dedup.shared_spans(x, y)[1]
    assert (a, b, c, d) == (30, 130, 70, 172)
    one, two = np.zeros(50, np.uint32), np.concatenate((fill(60), np.zeros(1, np.uint32), fill(60)))
    assert substring_dedup.shared_spans(one, two) == ([], [])  # one place is not fifty


def test_spans_against_every_pair_of_passages():
    rng = np.random.default_rng(4)
    span = substring_dedup.SPAN
    for _ in range(12):
        base = rng.integers(0, 1 << 32, 70, dtype=np.uint32)
        other = base.copy()
        for _ in range(rng.integers(0, 6)):
            at = int(rng.integers(len(other)))
            kind = rng.integers(3)
            part = rng.integers(0, 1 << 32, int(rng.integers(1, 4)), dtype=np.uint32)
            other = np.concatenate((other[:at], part if kind < 2 else part[:0], other[at + (kind != 1):]))
        x, y = np.concatenate((base[40:60], base)), np.concatenate((other, base[:20]))
        if len(y) < span:
            continue
        want = np.zeros(len(x), bool)
        for i in range(len(x) - span + 1):
            own = substring_dedup.Counter(x[i:i + span].tolist())
            for j in range(len(y) - span + 1):
                both = (own & substring_dedup.Counter(y[j:j + span].tolist())).total()
                if both / (2 * span - both) >= 0.8:
                    want[i:i + span] = True
        got = substring_dedup.similar_places(x, y)[0]
        assert not (want & ~got).any()


def test_texts_laid_end_to_end_are_like_each_alone():
    rnd = random.Random(9)
    texts = ["", "a b", None, prose(rnd, 300), "x " * 120, "Ünïcode Ärger " * 40, prose(rnd, 4), prose(rnd, 75) + "\n", prose(rnd, 5)]
    alone = [shingles.shingle_hashes(shingles.word_hashes(t)) for t in texts]
    alone = [s if len(shingles.word_hashes(t)) >= shingles.WIDTH else s[:0] for s, t in zip(alone, texts)]
    s, count = shingles.shingles_of([None if t is None else t.encode() for t in texts])
    assert count.tolist() == [len(a) for a in alone] and (s == np.concatenate(alone)).all()
    start, want = 0, []
    for a in alone:
        want += (substring_dedup.compact_windows(a) + start).tolist()
        start += len(a)
    assert sorted(substring_dedup.compact_windows(s, substring_dedup.SPAN, count).tolist()) == sorted(want)
    chosen = np.random.default_rng(2).random(len(s) - substring_dedup.SPAN + 1) < .5
    whole = substring_dedup.passage_keys(s, chosen, 1)
    parts = [substring_dedup.passage_keys(s, chosen, 1, bands) for bands in (range(6), range(6, 14))]
    assert all((a == np.concatenate(b)).all() for a, b in zip(whole, zip(*parts)))


def test_pairs_laid_end_to_end_are_like_each_alone():
    rng = np.random.default_rng(5)
    fill = lambda n: rng.integers(0, 1 << 32, n, dtype=np.uint32)
    pairs = [(fill(60), fill(70)), (np.zeros(300, np.uint32), np.zeros(90, np.uint32))]
    for _ in range(40):
        x = rng.integers(0, 40, 120, dtype=np.uint32) if rng.random() < .3 else fill(int(rng.integers(46, 200)))
        at = int(rng.integers(0, len(x)))
        pairs.append((x, np.concatenate((fill(int(rng.integers(0, 50))), x[:at], fill(int(rng.integers(0, 4))), x[at:]))))
    got = [([], []) for _ in pairs]
    xs, ys = ([p[k] for p in pairs] for k in (0, 1))
    both = substring_dedup.spans_of_pairs(np.concatenate(xs), np.array([len(x) for x in xs]), np.concatenate(ys), np.array([len(y) for y in ys]))
    for side, (pair, start, end) in enumerate(both):
        for p, a, b in zip(pair.tolist(), start.tolist(), end.tolist()):
            got[p][side].append((a, b))
    assert got == [substring_dedup.shared_spans(x, y) for x, y in pairs]
    assert sum(bool(a) for a, _ in got) >= 30


def test_segments_of_few_lines_are_compared_in_little_time():
    rng = np.random.default_rng(8)
    lines = [rng.integers(0, 1 << 32, 6, dtype=np.uint32) for _ in range(5)]
    x, y = (np.concatenate([lines[k] for k in rng.integers(0, 5, n)]) for n in (150, 90))
    began = time.process_time()  # 13.9 s pair by pair
    a, b = substring_dedup.shared_spans(x, y)
    assert a and b
    assert time.process_time() - began < 4


@pytest.mark.parametrize("query", ["op3_jaccard_join", "op9_substring_dedup"])
def test_queries_on_the_smallest_tables(spark, query):
    from marginlens.llm.registry import QUERIES
    got = QUERIES[query](spark, "/root/testdata/sf0.001")
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    if query == "op3_jaccard_join":
        assert {r.doc_id: (r.class_id, r.n_links) for r in got.collect()} == _brute(list(docs.items()))
    else:
        assert got.agg(F.count("*")).first()[0] > 0
