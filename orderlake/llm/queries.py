"""The operators applied to the test tables, one query each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    fingerprint,
    lm_score,
    merkle,
    mixing,
    ngram_jaccard,
    quality,
    secrets,
    spelling,
    toxicity,
    url_filter,
)
from orderlake.llm.common import TOKENIZER, documents, labels, remainder


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.similar_documents(documents(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secrets.digests(secrets.scan(docs, secrets.fit(docs)))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return bpe.round_trip(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.backoff_scores(documents(spark, sf_dir))


def op4_lm_score_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``op4_lm_score``, but every word counts for itself."""
    return lm_score.backoff_scores(documents(spark, sf_dir), word_key=lm_score.word_hash)


def dated_lists(hosts: DataFrame) -> DataFrame:
    """List entries (list, key, dated, active) that follow from the hosts by fixed arithmetic.

    Every host enters and leaves a list, some come back, some take their parent domain or a path
    along.
    """
    number = F.conv(F.substring(F.md5(F.col("host").cast("binary")), 1, 6), 16, 10).cast("int")
    rows = hosts.withColumn("x", number).withColumn(
        "list", F.element_at(F.array(*map(F.lit, ("malware", "spam", "adult"))), F.col("x") % 3 + 1)
    )
    start = F.date_add(F.lit("2023-10-01").cast("date"), F.col("x") % 300)

    def entry(key: str, after: int, active: bool):
        return F.struct(
            F.expr(key).alias("key"),
            F.date_add(start, F.lit(after) + F.col("x") % 40).alias("dated"),
            F.lit(active).alias("active"),
        )

    host = "concat('host:', host)"
    parent = "concat('domain:', regexp_replace(host, '^[^.]*[.]', ''))"
    prefix = "concat('prefix:', host, '/en')"
    always = [entry(host, 0, True), entry(host, 50, False), entry(host, 20, True)]
    again = F.when(F.col("x") % 4 == 0, F.array(entry(host, 150, True)))
    domain = F.when(
        F.col("x") % 23 == 0, F.array(entry(parent, 30, True), entry(parent, 90, False))
    )
    path = F.when(F.col("x") % 5 == 0, F.array(entry(prefix, 80, True)))
    none = F.array().cast("array<struct<key:string,dated:date,active:boolean>>")
    entries = F.concat(F.array(*always), *(F.coalesce(c, none) for c in (again, domain, path)))
    return rows.select("list", F.explode(entries).alias("e")).select("list", "e.*")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, fetched on a day that follows from their ids."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    day = (F.col("page_id") % 366).cast("int")
    captures = pages.select(
        "page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched")
    )
    host = url_filter.url_host(F.col("url"))
    hosts = pages.select(host.alias("host")).filter("host <> ''").distinct()
    return url_filter.filtered_urls(captures, dated_lists(hosts))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def _with_held_out(scored: DataFrame, divisor: int, held: int, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), divisor) == held, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, labels(spark, sf_dir), remainder(F.col("doc_id"), 5) != 0)
    return _with_held_out(toxicity.score(docs, model), 5, 0, 0.5)


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Learnt from the labels that are not held out, and from texts of ``documents``."""
    docs = documents(spark, sf_dir)
    return quality.fit(docs, labels(spark, sf_dir), remainder(F.col("doc_id"), 4) != 2)


KEEP_QUALITY = 0.7


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = quality.score(docs, quality_model(spark, sf_dir), keep=["doc_id"])
    return _with_held_out(
        scored.withColumnRenamed("quality_score", "score"), 4, 2, KEEP_QUALITY
    )


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(documents(spark, sf_dir))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.digests(
        decontaminate.contamination(documents(spark, sf_dir), benchmark)
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(documents(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_rows(documents(spark, sf_dir))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_secret_scan": op2_secret_scan,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_lm_score": op4_lm_score,
    "op4_lm_score_words": op4_lm_score_words,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_source_mix": op7_source_mix,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_decontamination": op11_decontamination,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_merkle_manifest": op13_merkle_manifest,
}
