"""Corpus preparation: documents to packed training sequences.

Toxic documents go, then exact copies, then near copies (one of each group of
5-word shingle sets with Jaccard similarity of 0.8 or more stays), then sources
are mixed to their target weights, then the documents are tokenised and packed.
Every stage's result is written as Parquet and read again by the next one, so a
lost executor or a restart costs one stage at most.

Edge cases: rows with a null doc_id take part like others, and columns beyond
those of ``documents`` pass through all stages but the last, whatever their
names. Null and empty texts have the toxicity score of no text and stay (one of
them, as they equal each other, after the exact stage); texts without words have
no near copies and no size, so the mix takes none of them. Of rows that repeat a
doc_id and its text one stays; rows that share a doc_id and differ in text are
documents of their own. Ties go by the operators' total orders, so reruns agree.
Without labels of both kinds nothing counts as toxic. An empty table gives an
empty result with the packing's columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewise.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from tidewise.llm.common import prepare, table
from tidewise.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.keep_one(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs, small=True)   # beside what the stages before left in the executors


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# The toxicity model and the tokeniser have no SQL form; tests compare run()
# with brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, f"pipeline/{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
