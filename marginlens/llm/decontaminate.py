"""Benchmark decontamination over a distributed positional inverted index
(DataFrame functions only).

1. Items are cut into windows of ``WINDOW`` consecutive words (an item of
   fewer words is one window).
2. The corpus frequency of every benchmark term is counted with map-side
   combine; a window with a term that never occurs is dropped.
3. For every window its two rarest terms are taken, and the positions of these
   terms in the training documents are stored as an index
   (``term, doc, pos``). Frequent words are never indexed unless a window has
   nothing rarer.
4. Phrase search: the position list of the rarest term, shifted by its offset
   in the item, is intersected with the shifted list of the second. What
   remains is a few (document, item, diagonal) candidates.
5. Each candidate is verified word by word along its diagonals; windows that
   match in full are hits. All candidates of a document travel together, an
   item's words once with the list of its diagonals (at most one per word of
   the document and item), so the text is joined once and no row is made per
   window or word.

:func:`proximity_matches` answers "all these terms within a span" from the
same index.

The benchmark's term, anchor and candidate tables are written before they are
joined. Catalyst sees their real size and broadcasts only below the session's
threshold; beyond it they take an ordinary shuffle join.

Defined cases: null or empty text has no words; rows repeating an id are
judged each on its own text; a null item id counts for ``n_hit`` but not among
the items; an empty benchmark leaves every document clean.
"""
from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginlens.llm.common import driver_table, fresh, staged

WINDOW = 10
#: Everything but word characters, as a fixed pattern of the contract.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text) -> F.Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), BETWEEN, -1), "")


def _doc_key(id_col: str, text_col: str) -> F.Column:
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                       F.xxhash64(text_col).cast("string"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, words, doc``; ``doc`` names a row by its id and text."""
    return docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("words"),
                       _doc_key(id_col, text_col).alias("doc"))


def build_postings(keyed: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index ``term, doc, pos`` (0-based) of the given terms."""
    tokens = keyed.select("doc", F.posexplode("words").alias("pos", "term"))
    return staged(tokens.join(terms.select("term").distinct(), "term").select("term", "doc", "pos"), "postings")


def _windows(items: DataFrame, size: int) -> DataFrame:
    """``item, start, n, term, offset``: the words of every window of every item."""
    n = F.least(F.lit(size), F.size("words"))
    return (items.filter(F.size("words") > 0).withColumn("n", n)
            .select("item", "n", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("n"))).alias("start"))
            .select("item", "start", "n", F.posexplode(F.slice("words", F.col("start") + 1, F.col("n")))
                    .alias("k", "term"))
            .select("item", "start", "n", "term", (F.col("start") + F.col("k")).alias("offset")))


def _anchors(windows: DataFrame, frequency: DataFrame) -> DataFrame:
    """Per item the distinct ``(term1, offset1, term2, offset2)`` of its windows' two rarest terms."""
    counted = windows.join(frequency, "term", "left")
    by_term = (counted.groupBy("item", "start", "term")
               .agg(F.min("offset").alias("offset"), F.first("freq").alias("freq")))
    ranked = (by_term.groupBy("item", "start")
              .agg(F.sort_array(F.collect_list(F.struct("freq", "term", "offset"))).alias("t"))
              .filter(F.col("t")[0]["freq"].isNotNull()))  # nulls sort first: a term that never occurs
    second = F.get("t", F.least(F.lit(1), F.size("t") - 1))
    return ranked.select("item", F.col("t")[0]["term"].alias("term1"), F.col("t")[0]["offset"].alias("offset1"),
                         second["term"].alias("term2"), second["offset"].alias("offset2")).distinct()


def phrase_candidates(postings: DataFrame, anchors: DataFrame) -> DataFrame:
    """Distinct ``doc, item, diagonal`` where both lists of a window meet; ``diagonal`` = position - offset."""
    first = (postings.withColumnRenamed("term", "term1").join(anchors, "term1")
             .select("doc", "item", (F.col("pos") - F.col("offset1")).alias("diagonal"), "term2", "offset2")
             .withColumn("pos2", F.col("diagonal") + F.col("offset2")))
    second = postings.select(F.col("term").alias("term2"), F.col("doc").alias("doc2"), F.col("pos").alias("pos2"))
    both = first.join(second, (first["term2"] == second["term2"]) & (first["doc"] == second["doc2"])
                      & (first["pos2"] == second["pos2"]), "left_semi")
    return both.select("doc", "item", "diagonal").distinct()


def proximity_matches(postings: DataFrame, queries: DataFrame, span: int) -> DataFrame:
    """``query, doc, last_pos`` where all terms of a query lie within ``span`` words.

    ``queries`` has ``query, term``; its terms must be in the index.
    """
    asked = queries.distinct()
    need = asked.groupBy("query").agg(F.count("*").alias("n_terms"))
    near = Window.partitionBy("query", "doc").orderBy("pos").rangeBetween(-(span - 1), 0)
    return (postings.join(asked, "term").withColumn("n", F.size(F.collect_set("term").over(near)))
            .join(need, "query").filter(F.col("n") == F.col("n_terms"))
            .select("query", "doc", F.col("pos").alias("last_pos")))


def _bound(value, body) -> F.Column:
    """``body(value)`` with ``value`` computed once.

    A lambda variable cannot be inlined by the optimizer, so a costly value
    that other lambdas use many times stays outside of them.
    """
    return F.transform(F.array(value), body)[0]


def _verified(cand, text_words) -> F.Column:
    """The candidate's item id, window length and the document positions of its
    windows that match in full, on any of the candidate's diagonals.

    A diagonal's words are compared once each (a string of 0 and 1); places are
    listed only where a run of ``n`` equal words exists.
    """
    n = F.least(F.lit(WINDOW), F.size(cand["words"]))

    def starts(diagonal):
        same = F.array_join(F.transform(cand["words"], lambda w, j: F.when(
            F.get(text_words, diagonal + j) == w, F.lit("1")).otherwise(F.lit("0"))), "")
        run = F.repeat(F.lit("1"), n)
        return _bound(same, lambda s: F.when(s.contains(run), F.transform(
            F.filter(F.sequence(F.lit(0), F.size(cand["words"]) - n), lambda j: F.substr(s, j + 1, n) == run),
            lambda j: diagonal + j)).otherwise(F.array().cast("array<int>")))

    return F.struct(cand["item_id"].alias("item_id"), n.alias("n"),
                    F.array_distinct(F.flatten(F.transform(cand["diagonals"], starts))).alias("at"))


def _search(keyed: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc, candidates`` of the documents that hold a candidate.

    A candidate is an item with its words once and all its diagonals.
    """
    items = staged(benchmark.select(F.monotonically_increasing_id().alias("item"),
                                    F.col("item_id").cast("string").alias("item_id"),
                                    words(F.col("text")).alias("words")), "benchmark_items")
    windows = staged(_windows(items, WINDOW), "benchmark_windows")
    vocabulary = staged(windows.select("term").distinct(), "benchmark_terms")
    frequency = staged(keyed.select(F.explode("words").alias("term")).join(vocabulary, "term")
                       .groupBy("term").agg(F.count(F.lit(1)).alias("freq")), "term_frequency")
    anchors = staged(_anchors(windows, frequency), "anchors")
    wanted = staged(anchors.select(F.explode(F.array("term1", "term2")).alias("term")).distinct(), "anchor_terms")
    postings = build_postings(keyed, wanted)
    found = (phrase_candidates(postings, anchors)
             .groupBy("doc", "item").agg(F.collect_list("diagonal").alias("diagonals"))
             .join(items, "item")
             .groupBy("doc").agg(F.collect_list(F.struct("item_id", "words", "diagonals")).alias("candidates")))
    return staged(found, "candidates")


def _hits(text, candidates) -> F.Column:
    """The verified candidates of a text, its words cut once."""
    return F.when(F.col(candidates).isNotNull(), _bound(words(text), lambda own: F.filter(
        F.transform(F.col(candidates), lambda c: _verified(c, own)), lambda c: F.size(c["at"]) > 0)))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window of ``benchmark``, all columns."""
    doc, cands = (fresh(docs, n) for n in ("_doc", "_candidates"))
    found = _search(_keyed(docs, id_col, text_col), benchmark).withColumnsRenamed({"doc": f"{doc}_r", "candidates": cands})
    joined = docs.withColumn(doc, _doc_key(id_col, text_col)).join(found.hint("merge"), F.col(doc) == F.col(f"{doc}_r"), "left")
    dirty = F.size(_hits(F.col(text_col), cands)) > 0
    return joined.filter(~F.coalesce(dirty, F.lit(False))).select(*docs.columns)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits``.

    ``hits`` lists (item id, window length, document word positions) of the matches.
    """
    found = _search(_keyed(docs, id_col, text_col), benchmark)
    # the list of candidates grows with the corpus: a merge join at every size, words cut after it
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), _doc_key(id_col, text_col).alias("doc"))
    judged = (rows.join(found.hint("merge"), "doc", "left").withColumn("words", words(F.col("text")))
              .withColumn("hits", F.coalesce(_hits(F.col("text"), "candidates"), F.array())))
    covered = F.array_distinct(F.flatten(F.transform(
        "hits", lambda c: F.flatten(F.transform(c["at"], lambda s: F.sequence(s, s + c["n"] - 1))))))
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("hits", lambda c: c["item_id"]),
                                                 lambda x: x.isNotNull())))
    return (judged.select("doc_id", F.size("words").cast("long").alias("n_words"), "hits",
                          F.size(covered).cast("long").alias("n_hit"), ids.alias("ids"))
            .select("doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"), "hits"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(driver_table(spark, sf_dir, "documents"),
                         driver_table(spark, sf_dir, "benchmark")).drop("hits")


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)
), dw AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hit AS (
  SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.phrase = bw.phrase
), pos AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), its AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
