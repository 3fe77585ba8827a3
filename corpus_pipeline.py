"""The corpus pipeline: documents to token ids, in five stages.

Each stage is a function of (session, documents, folder of the tables) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the last return the columns of
``documents``; the last returns the ids of every document and of its text decoded again.

Defined cases, as the stages' operators have them: a null or empty text has no words and goes with the quality
rules; a null language or source is one of its own; rows that repeat a document are one for near duplicates, and one
stays; an id with several texts stays with each that stays; rows without an id stay; an empty table gives an empty
result; columns beside those of ``documents`` pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import bpe, line_dedup, mixing, near_dups, rules
from loomgraph.llm.common import read, remove, scratch, shared_dir
from loomgraph.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified threshold of their language go."""
    return rules.keep(docs, read(spark, sf_dir, "labels"))


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of their source's documents go."""
    return line_dedup.drop_boilerplate(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each component linked by five-word shingles at a similarity of 0.8 or more."""
    return near_dups.deduplicated(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its target asks for; a document taken twice is there twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the digests of the ids and of the text decoded from them."""
    return bpe.encode(docs, tokenizer_file(), carry=("doc_id", "source"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_frequent_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("mixing_sources", mix_sources),
    ("bpe_encoding", encode),
]

#: SQL expresses neither near-duplicate components nor BPE; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents. What a stage has written on its way goes when its result is written, and the result when
    the next one's is."""
    docs, last = read(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = shared_dir(spark)
        with scratch():
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last:
            remove(last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
