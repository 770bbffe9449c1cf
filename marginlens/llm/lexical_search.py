"""Ranked lexical search, reversed: the items' index meets the documents' stream.

The items are the few and the documents the many, so the inverted index is
built over the *items'* terms and the documents are streamed through it:

1. The items' terms are cut by Spark and dealt into blocks of about
   ``BLOCK_POSTINGS`` (item, term) pairs. One block's index is all that is
   broadcast, so its size is bounded however many items there are; every block
   is a pass over all documents.
2. A first pass counts what the formula needs of the corpus: documents, words,
   and the document frequency of the block's terms (partial sums per task).
3. The second pass counts each document's terms, scatters every term's
   contribution to the items on its posting list, and updates one heap of
   ``k`` entries per item. A score that cannot enter a full heap is dropped
   by one vectorised comparison.
4. The tasks' heaps are merged by rank in two steps (first among tasks of one
   of ``FAN`` groups, then over the groups), so no task sees more than a share
   of the heaps of an item.

Nothing is shuffled but heap entries; memory is bounded by one Arrow batch,
one block's index and its heaps. A long text is cut into terms piece by piece.

Score of a document for an item, in integers (``div`` rounds down): the sum
over the item's distinct terms of ``w * ((10^9 * tf) div (1000 * tf + 8 * m))``
with ``m = 10 + (90 * n * N) div L`` and
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``.

Defined cases: a null or empty text has no terms (an item without terms has no
row, a document without terms is not counted); every row is a document or an
item of its own, also under a repeated or null id; equal scores go by
ascending doc_id, null last; empty tables give an empty result.
"""
from __future__ import annotations

import heapq
import math
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginlens.llm.common import driver_table, ship_package, staged

TOP = 10
#: (item, term) pairs of a block on average; an item is never split.
BLOCK_POSTINGS = 200_000
#: Groups of tasks whose heaps are merged first.
FAN = 64
#: Bytes of text cut into terms at once.
PIECE = 1 << 20
#: Scattered contributions held at once.
SCATTER = 1 << 20

#: ASCII lower-cased, everything that is neither letter nor digit a space; bytes from 0x80 on are parts of words.
_KEPT = (string.ascii_letters + string.digits).encode()
_TABLE = bytes(b if b >= 0x80 else ord(chr(b).lower()) if b in _KEPT else 0x20 for b in range(256))


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, piece by piece; no term is cut."""
    at = 0
    while at < len(text):
        end = at + PIECE
        piece = text[at:end].translate(_TABLE)
        if end < len(text):  # take the rest of the last term along
            rest = end
            while rest < len(text) and _TABLE[text[rest]] != 0x20:
                rest += 1
            piece += text[end:rest].translate(_TABLE)
            end = rest
        yield piece.split()
        at = end


def term_counts(text: bytes | None) -> Counter:
    counts: Counter = Counter()
    for terms in term_lists(text or b""):
        counts.update(terms)
    return counts


def _texts(batch: pa.RecordBatch, col: str) -> list:
    """The texts as bytes, without decoding them."""
    column = batch.column(col)
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def item_postings(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(item, item_id)`` and its distinct ``(item, term)`` pairs, both written."""
    rows = staged(items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"),
                               F.col(text_col).alias("text")), "search_items")

    def cut(batches):
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), _texts(batch, "text")):
                terms = sorted(term_counts(text))
                if terms:
                    yield pa.RecordBatch.from_pydict({"item": pa.array([item] * len(terms), pa.int64()),
                                                      "term": pa.array(terms, pa.binary())})

    pairs = rows.select("item", "text").mapInArrow(cut, "item long, term binary")
    return rows.select("item", "item_id"), staged(pairs, "search_postings")


class ItemIndex:
    """One block's inverted index: a term's number, and the items that hold it."""

    def __init__(self, pairs: list[tuple[int, bytes]]):
        self.items = sorted({item for item, _ in pairs})
        place = {item: k for k, item in enumerate(self.items)}
        self.terms: dict[bytes, int] = {t: k for k, t in enumerate(sorted({t for _, t in pairs}))}
        self.known = frozenset(self.terms)
        by_term = sorted((self.terms[t], place[item]) for item, t in pairs)
        self.postings = np.array([p for _, p in by_term], np.int64)
        self.length = np.bincount([t for t, _ in by_term], minlength=len(self.terms)).astype(np.int64)
        self.first = np.cumsum(self.length) - self.length


def corpus_counts(docs: DataFrame, text_col: str, index) -> tuple[int, int, np.ndarray]:
    """``N, L`` and the document frequency of every term of the (broadcast) index."""
    def count(batches):
        found = index.value
        df, n_docs, n_terms = np.zeros(len(found.terms), np.int64), 0, 0
        for batch in batches:
            for text in _texts(batch, "text"):
                seen, n = set(), 0
                for terms in term_lists(text or b""):
                    n += len(terms)
                    seen |= found.known.intersection(terms)
                n_docs += n > 0
                n_terms += n
                df[[found.terms[t] for t in seen]] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"key": pa.array([-1, -2, *held.tolist()], pa.int64()),
                                          "n": pa.array([n_docs, n_terms, *df[held].tolist()], pa.int64())})

    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(count, "key long, n long")
            .groupBy("key").agg(F.sum("n").alias("n")).collect())  # two numbers and one per term of the block
    got = {r.key: r.n for r in rows}
    df = np.zeros(len(index.value.terms), np.int64)
    for key, n in got.items():
        if key >= 0:
            df[key] = n
    return got.get(-1, 0), got.get(-2, 0), df


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df], np.int64)


class Heaps:
    """The ``k`` best documents of every item; the worst is on top."""

    def __init__(self, n: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n)]
        self.enter = np.ones(n, np.int64)  # least score that can still enter

    def update(self, scores: np.ndarray, ids: list) -> None:
        """``scores``: documents by items."""
        for row, item in zip(*(a.tolist() for a in np.nonzero(scores >= self.enter))):
            doc, heap = ids[row], self.heaps[item]
            entry = (int(scores[row, item]), doc is not None, -(doc or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.enter[item] = heap[0][0]

    def rows(self) -> list[tuple[int, int | None, int]]:
        return [(item, -neg if known else None, score) for item, heap in enumerate(self.heaps) for score, known, neg in heap]


def _scored(index: ItemIndex, weights: np.ndarray, held: list[tuple[int, list]], n_docs: int, n_terms: int) -> np.ndarray:
    """Scores, documents by items, of documents given as (words, [(term, tf)])."""
    doc = np.repeat(np.arange(len(held)), [len(h) for _, h in held])
    m = np.array([10 + (90 * n * n_docs) // n_terms for n, _ in held], np.int64)[doc]
    term = np.array([t for _, h in held for t, _ in h], np.int64)
    tf = np.array([f for _, h in held for _, f in h], np.int64)
    part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
    times = index.length[term]
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    item = index.postings[np.repeat(index.first[term], times) + within]
    scores = np.zeros(len(held) * len(index.items), np.int64)
    np.add.at(scores, np.repeat(doc, times) * len(index.items) + item, np.repeat(part, times))
    return scores.reshape(len(held), -1)


def stream_documents(docs: DataFrame, index, weights: np.ndarray, n_docs: int, n_terms: int, k: int,
                     id_col: str, text_col: str) -> DataFrame:
    """``item, doc_id, score, task``: the heaps of every task."""
    def search(batches):
        found = index.value
        heaps, held, ids, size = Heaps(len(found.items), k), [], [], 0

        def flush():
            if held:
                heaps.update(_scored(found, weights, held, n_docs, n_terms), ids)
                held.clear()
                ids.clear()

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), _texts(batch, "text")):
                counts = term_counts(text)
                terms = [(found.terms[t], f) for t, f in counts.items() if t in found.known]
                if not terms:
                    continue
                held.append((counts.total(), terms))
                ids.append(doc)
                size += sum(int(found.length[t]) for t, _ in terms) + len(found.items)
                if size > SCATTER:
                    flush()
                    size = 0
        flush()
        rows = heaps.rows()
        yield pa.RecordBatch.from_pydict({
            "item": pa.array([found.items[i] for i, _, _ in rows], pa.int64()),
            "doc_id": pa.array([d for _, d, _ in rows], pa.int64()),
            "score": pa.array([s for _, _, s in rows], pa.int64())})

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(search, "item long, doc_id long, score long").withColumn("task", F.spark_partition_id()))


def merged_heaps(heaps: DataFrame, k: int) -> DataFrame:
    """``item, rank, doc_id, score``: the best ``k`` of all tasks' heaps."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]

    def best(df, *by):
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)

    few = best(heaps.withColumn("group", F.pmod("task", F.lit(FAN))), "item", "group").select("item", "doc_id", "score")
    return best(few, "item")


def reversed_search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                    item_id_col: str = "item_id", item_text_col: str = "text",
                    block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: every item's ``k`` best documents."""
    spark = docs.sparkSession
    ship_package(spark)
    names, pairs = item_postings(items, item_id_col, item_text_col)
    blocks = -(-pairs.count() // block_postings)
    found = []
    for block in range(blocks):
        mine = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        rows = [(r.item, bytes(r.term)) for r in mine.collect()]  # one block, bounded by block_postings on average
        if not rows:
            continue
        index = spark.sparkContext.broadcast(ItemIndex(rows))
        n_docs, n_terms, df = corpus_counts(docs, text_col, index)
        if n_terms:
            heaps = stream_documents(docs, index, term_weights(n_docs, df), n_docs, n_terms, k, id_col, text_col)
            found.append(staged(merged_heaps(heaps, k), "search_ranked"))
    ranked = spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    for part in found:
        ranked = ranked.unionByName(part)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search(driver_table(spark, sf_dir, "documents"), driver_table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT DISTINCT i, item_id, unnest(w) AS term
  FROM (SELECT row_number() OVER () AS i, item_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark)
), c AS (
  SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0
), tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL
), wt AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS wt
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c
), dm AS (
  SELECT r, doc_id, 10 + (90 * len(w) * n_docs) // n_terms AS m FROM d, c WHERE len(w) > 0
), s AS (
  SELECT i, item_id, r, doc_id, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM b JOIN tf USING (term) JOIN wt USING (term) JOIN dm USING (r) GROUP BY ALL
), k AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
