"""The queries of this package and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.llm import (
    decontamination,
    katz,
    licences,
    mixing,
    packing,
    privacy,
    quality,
    search,
    simhash,
    spelling,
    topk,
    toxicity,
    warc,
)
from halyard.llm.tables import read
from halyard.llm.oracles import ORACLES  # noqa: F401
from halyard.sources.workspace import workspace_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.personal_data(read(spark, sf_dir, "documents"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_query = F.col("vec_id") % topk.QUERY_STEP == 0
    return topk.top_k(read(spark, sf_dir, "embeddings"), is_query)


def op3_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source brought to the same share of as many documents as there are."""
    return mixing.mix_sources(read(spark, sf_dir, "documents"), with_copy=True)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.apply_policy(quality.ledger(read(spark, sf_dir, "documents")), quality.STANDARD)
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "fail_bits", "policy",
    )


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read(spark, sf_dir, "documents"))


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(read(spark, sf_dir, "pages"), workspace_path(spark, "warc"))
    return warc.read_index(spark, path)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    )


def op10_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(read(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_personal_data,
        op2_top_k,
        op3_hilbert_packing,
        op4_simhash_dedup,
        op5_mix_sources,
        op6_quality_rules,
        op7_licence_scan,
        op8_warc_archive,
        op9_toxicity,
        op10_katz_scores,
        op11_spelling_variants,
        op12_ranked_search,
        op13_decontamination,
    )
}
