"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept. All but the last return the columns of ``documents``; the
last returns the pieces of the packed sequences with their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import exact_dedup, minhash, mixing, packing, quality
from vigil.llm.common import materialize, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier accepts."""
    return quality.keep_rows(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the one with the largest id."""
    return exact_dedup.keep_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id."""
    return minhash.keep_rows(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as often as the mix takes them; rows taken 0 times go."""
    return mixing.mixed_rows(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens along the Hilbert curve."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("packing", sequences),
]

#: A fitted classifier and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
