"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitwatch.llm import (
    decontaminate,
    licenses,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    pii,
    prefix_hash,
    quality,
    simhash,
    source_divergence,
    toxicity,
    warc,
)
from hitwatch.llm.common import read
from hitwatch.llm.labelled import fitted, training_sample

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_prefix_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return prefix_hash.fingerprints(read(spark, folder, "documents"))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that are near an earlier one."""
    return line_dedup.edited_lines(read(spark, folder, "documents")).drop("row")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, from its text and from the other documents of its source
    (as host) and language within the source (as path)."""
    documents = read(spark, folder, "documents")
    model = fitted(training_sample(documents, read(spark, folder, "labels"), "quality"), quality.train)
    sites = documents.select(
        "doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path")
    )
    return quality.quality(sites, model)


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as it comes back from the archives it was written to."""
    return warc.round_trip(read(spark, folder, "pages")).drop("path")


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every piece of every document in a training sequence."""
    return packing.pack(read(spark, folder, "documents"), TOKENIZER)


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in every document."""
    return licenses.licenses(read(spark, folder, "documents"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    documents = read(spark, folder, "documents")
    return pii.personal_data(documents, pii.learn(pii.profile_counts(documents)))


def op8_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the similarity of its best window."""
    return decontaminate.contaminated(
        read(spark, folder, "documents"), read(spark, folder, "benchmark")
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, learned from labelled documents not held out."""
    documents = read(spark, folder, "documents")
    sample = training_sample(documents, read(spark, folder, "labels"), "toxic")
    model = fitted(sample, toxicity.train)
    return toxicity.toxicity_scores(documents, model)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, with a repetition planted into one in ten."""
    return periodic_runs.runs_of_documents(read(spark, folder, "documents"), plant=True)


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Distances between the sources of each language, and the terms that set them apart."""
    return source_divergence.divergence(read(spark, folder, "documents"))


def op13_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix by source weights takes of every document."""
    return mixing.mix(read(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_prefix_fingerprints,
        op2_line_dedup,
        op3_quality,
        op4_warc,
        op5_best_fit_packing,
        op6_license_scan,
        op7_pii,
        op8_simhash_near_duplicates,
        op9_benchmark_decontamination,
        op10_toxicity,
        op11_periodic_runs,
        op12_source_divergence,
        op13_source_mix,
    )
}

#: SQL of the queries that SQL can express on whole tables.
ORACLE_SQL: dict[str, str] = {
    "op6_license_scan": licenses.oracle(),
    "op12_source_divergence": source_divergence.oracle(),
    "op4_warc": """
        with sized as (
            select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as payload_bytes
            from pages
        ), digests as (
            select page_id, payload_bytes, sha1(payload) as payload_digest,
                max(page_id) over (partition by payload) as newest
            from sized
        )
        select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
            case when payload_bytes >= 1000 and page_id < newest then 'revisit' else 'response'
            end as record_type,
            case when payload_bytes >= 1000 and page_id < newest then newest end as refers_to
        from digests
    """,
}
