"""Exact de-duplication with a heavy-hitter split (DataFrame functions only).

1. Every row becomes a narrow identity (id, SHA-256 of the text, row tag),
   written once to shared storage.
2. ``freqItems`` -- the mergeable frequent-items algorithm of Misra-Gries and
   Karp-Shenker-Papadimitriou -- lists every digest that holds more than
   ``support`` of the rows (at most ``1 / support`` candidates, no false
   negative). Without a given support it follows the number of rows
   (:func:`hot_support`).
3. The candidates are verified: their exact size and survivor come from a
   map-side-combined aggregate. These few winners are broadcast -- their
   number is bounded by ``1 / support`` whatever the input -- and the rows of
   hot groups get their decision map-side, with no shuffle.
4. The remaining digests, each under ``support`` of the rows, take an ordinary
   shuffle and a window.

Defined cases: null text equals the empty text; no normalisation; of equal
texts the row with the largest id stays, a null id losing to any other; rows
tied on text and id keep exactly one; an empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginlens.llm.common import driver_table, fresh, staged, text_or_empty

#: Share of the rows from which a digest counts as hot. It falls with the number
#: of rows, so that a digest that is not hot has at most ``COLD_ROWS`` rows, down
#: to ``LEAST_SUPPORT``; ``1 / LEAST_SUPPORT`` rows bound the broadcast at any size.
SUPPORT, LEAST_SUPPORT = 0.002, 1e-5
COLD_ROWS = 1_000_000


def hot_support(n_rows: int) -> float:
    return max(LEAST_SUPPORT, min(SUPPORT, COLD_ROWS / max(n_rows, 1)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                support: float | None = None) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = staged(docs.select(
        F.col(id_col).alias("doc_id"),
        F.sha2(text_or_empty(text_col), 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("_row")), "dedup_identities")

    support = hot_support(rows.count()) if support is None else support
    # at most 1/support strings reach the driver, by the algorithm's own bound
    found = rows.freqItems(["text_sha256"], support).first()
    hot = list(found[0] or []) if found else []

    winner = F.max(F.struct("doc_id", "_row"))
    winners = (rows.filter(F.col("text_sha256").isin(hot))
               .groupBy("text_sha256")
               .agg(winner.alias("_win"), F.count(F.lit(1)).alias("group_size")))
    winners = F.broadcast(staged(winners, "dedup_hot_winners"))

    def decide(df: DataFrame) -> DataFrame:
        return df.select("doc_id", F.col("_win.doc_id").alias("keep_id"), "group_size",
                         (F.col("_row") == F.col("_win._row")).alias("kept"), "text_sha256")

    same = Window.partitionBy("text_sha256")
    rest = (rows.join(winners.select("text_sha256"), "text_sha256", "left_anti")
            .withColumns({"_win": winner.over(same), "group_size": F.count(F.lit(1)).over(same)}))
    return decide(rows.join(winners, "text_sha256")).unionByName(decide(rest))


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that survive :func:`exact_dedup`, all columns.

    Rows equal in id and text collapse to one of them.
    """
    key, sha = fresh(docs, "_keep_id"), fresh(docs, "_keep_sha")
    survivors = staged(exact_dedup(docs, id_col, text_col).filter("kept")
                       .select(F.col("doc_id").alias(key), F.col("text_sha256").alias(sha)), "dedup_survivors")
    tagged = docs.withColumns({key: F.col(id_col), sha: F.sha2(text_or_empty(text_col), 256)})
    on = tagged[key].eqNullSafe(survivors[key]) & (tagged[sha] == survivors[sha])
    return tagged.join(survivors, on, "left_semi").dropDuplicates([key, sha]).select(*docs.columns)


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup(driver_table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
