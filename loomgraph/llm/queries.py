"""The registered queries of the training-data operators and, where SQL can express one, its SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, collocations, divergence, html_text, language, line_dedup, media, mixing, near_dups, quality, rules, toxicity, warc
from .common import read


def tokenizer_file() -> str:
    """The vocabulary file, from the session's machine; ``LOOMGRAPH_BPE`` names another one."""
    if path := os.environ.get("LOOMGRAPH_BPE"):
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(spark, sf_dir, "documents"), tokenizer_file())


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read(spark, sf_dir, "pages"))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media(read(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(read(spark, sf_dir, "documents"), k=3, percent=85).drop("set_hash")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents (doc_id) and all pages (page_id), the other id being null."""
    docs = read(spark, sf_dir, "documents")
    rows = language.document_rows(docs).unionByName(language.page_rows(read(spark, sf_dir, "pages")))
    return language.identify(rows, language.fit(docs), ["doc_id", "page_id"])


def op5_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return line_dedup.drop_boilerplate(docs.select("doc_id", "source", "text"), counts=True)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op5_mixing_sources": mixing.SQL, "op6_warc": warc.SQL, "op8_quality_rules": rules.SQL, "op10_line_dedup": line_dedup.SQL, "op11_phrase_collocations": collocations.SQL, "op13_source_divergence": divergence.SQL}
