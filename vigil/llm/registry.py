"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import bwt, chat, decontaminate, exact_dedup, itq, minhash, mixing, negatives, packing, quality, secret_scan, spelling, urls
from vigil.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_curve_packing": lambda spark, sf_dir: packing.query(table(spark, sf_dir, "documents")),
    "op2_url_ratio": lambda spark, sf_dir: urls.query(table(spark, sf_dir, "pages")),
    "op3_minhash_near_dedup": lambda spark, sf_dir: minhash.query(table(spark, sf_dir, "documents")),
    "op4_bwt_repeats": lambda spark, sf_dir: bwt.query(table(spark, sf_dir, "documents")),
    "op5_chat_format": lambda spark, sf_dir: chat.query(spark, table(spark, sf_dir, "conversations")),
    "op6_exact_dedup": lambda spark, sf_dir: exact_dedup.query(table(spark, sf_dir, "documents")),
    "op7_itq_near_dedup": lambda spark, sf_dir: itq.query(table(spark, sf_dir, "embeddings")),
    "op8_ordinal_quality": lambda spark, sf_dir: quality.query(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ),
    "op9_secret_scan": lambda spark, sf_dir: secret_scan.query(table(spark, sf_dir, "documents")),
    "op10_mixing": lambda spark, sf_dir: mixing.query(table(spark, sf_dir, "documents")),
    "op11_trie_spelling": lambda spark, sf_dir: spelling.query(table(spark, sf_dir, "documents")),
    "op12_sorted_negatives": lambda spark, sf_dir: negatives.query(table(spark, sf_dir, "embeddings")),
    "op13_automaton_decontamination": lambda spark, sf_dir: decontaminate.query(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ),
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_ratio": urls.ORACLE_SQL,
    "op3_minhash_near_dedup": minhash.ORACLE_SQL,
    "op5_chat_format": chat.ORACLE_SQL,
    "op6_exact_dedup": exact_dedup.ORACLE_SQL,
    "op7_itq_near_dedup": itq.ORACLE_SQL,
    "op10_mixing": mixing.ORACLE_SQL,
    "op11_trie_spelling": spelling.ORACLE_SQL,
    "op12_sorted_negatives": negatives.ORACLE_SQL,
    "op13_automaton_decontamination": decontaminate.ORACLE_SQL,
}
