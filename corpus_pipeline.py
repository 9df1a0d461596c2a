"""A corpus pipeline of five stages: drop toxic documents, keep one of each group of near
copies, mask personal data, mix sources to equal shares, pack into training sequences.

Each stage works on what its predecessor kept. All but the last return the columns of documents
as they came, with extra columns whatever their names. A null text counts as empty, texts of any
length are read whole, and a table without rows gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from halyard.llm import mixing, packing, privacy, simhash, toxicity
from halyard.llm.tables import read, stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier calls toxic; it learns from labels of ``docs``.

    Repeated rows are scored alike and stay or go together. Where no label names a row of
    ``docs``, all rows score alike.
    """
    model = toxicity.fit_toxicity(docs, read(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group that fingerprints of three-word
    shingles link at three bits or fewer.

    Texts without words are one group, repeated rows leave one, and a null id is larger than any
    other. Rows that share the smallest id of a group leave that with the smallest text hash.
    """
    return simhash.without_near_copies(docs)


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data and the terms that disclose it. Every row stays, repeated ones too."""
    return privacy.sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that every source gets the same share.

    A null source is a source. Rows that share an id are drawn as often as each other.
    """
    return mixing.mix_sources(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs documents into sequences along a space-filling curve.

    A row per piece; an empty text is one token, rows that share an id are packed apart.
    """
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_copies_stage),
    ("personal_data", privacy_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the classifier, the fingerprints and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
