"""From raw documents to token ids: the stages of a training corpus.

Each stage takes all that its predecessor kept. Null and blank texts have a quality score of 0 and so
leave with the first stage; rows with equal ids stay separate rows, and other columns of the documents
pass until the last stage, which returns ids, language and source with the tokens. An empty table
passes all stages. ``run`` stores what a stage returns as Parquet in
the shared folder and reads it back, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import bpe, exact_dedup, mixing, ngram_jaccard, quality
from orderlake.llm.common import TOKENIZER, documents, labels, remainder, stored
from orderlake.llm.queries import KEEP_QUALITY


# Rows that go to a Python worker at once: with whole texts the usual 10,000 fill its memory.
BATCH_ROWS = 500


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, run with at most ``BATCH_ROWS`` rows a batch; the session keeps that setting."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    model = quality.fit(docs, labels(spark, sf_dir), remainder(F.col("doc_id"), 4) != 2)
    scored = quality.score(docs, model)
    return scored.filter(F.col("quality_score") >= KEEP_QUALITY).drop("quality_score")


@in_small_batches
def different_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text."""
    return exact_dedup.deduplicated(docs)


@in_small_batches
def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each group of near copies: five-word shingles, similarity 0.8 or more."""
    return ngram_jaccard.representatives(docs, words=5, percent=80)


@in_small_batches
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated and cut as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


@in_small_batches
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, with the hash of what they decode to."""
    return bpe.checked_ids(
        docs,
        public_tokenizers.path(TOKENIZER),
        public_tokenizers.PATTERN,
        keep=["doc_id", "lang", "source"],
    )


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", different_texts),
    ("n-gram Jaccard join", dissimilar_documents),
    ("source mix", mixed_sources),
    ("byte-level BPE", token_ids),
]

# A classifier trained by gradient steps cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
