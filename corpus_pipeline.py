"""The training-data pipeline: ``documents`` in, token digests out.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and reread as
the next one's ``docs``. All but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.llm import bpe, decontaminate, quality
from marginlens.llm.common import driver_table, fresh, staged
from marginlens.llm.exact_dedup import keep_first_copies
from marginlens.llm.jaccard_join import keep_one_per_class


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier does not reject.

    It learns from labelled rows of the stage's own input.
    """
    model = quality.train(docs, driver_table(spark, sf_dir, "labels"))
    score = fresh(docs, "_quality_score")
    scored = quality.score_documents(docs, model, out=score)
    return scored.filter(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every set of equal texts: that with the largest doc_id."""
    return keep_first_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates: that with the least doc_id."""
    return keep_one_per_class(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window, judged row by row on id and text."""
    return decontaminate.keep_clean(docs, driver_table(spark, sf_dir, "benchmark"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what is left."""
    import public_tokenizers

    return bpe.bpe_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("tokens", tokens_stage),
]

#: The learned quality stage has no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = driver_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
