"""A training corpus from raw documents: quality, frequent lines, near copies, mix, codes.

Each stage reads what the one before it wrote, and all but the last give documents.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickmetrics.llm import (
    Vocabulary,
    bpe_encode,
    dedup_lines,
    drop_near_copies,
    keep_good,
    mix_documents,
)
from clickmetrics.llm.common import written

VOCABULARY_FILE = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them have. ``n_chars`` is left as it was
    read: it says how long the raw text is."""
    counts = "lines"
    while counts in docs.columns:
        counts += "_"
    return dedup_lines(docs, into=counts).drop(counts)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_documents(docs)


def bpe_codes(
    spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary_file: str = VOCABULARY_FILE
) -> DataFrame:
    """The codes of each document of the mix, packed, with what identifies it."""
    encoded = bpe_encode(docs, Vocabulary.from_file(vocabulary_file))
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources", mix_sources),
    ("BPE encoding", partial(bpe_codes, vocabulary_file=VOCABULARY_FILE)),
]

#: The fingerprints' XXH64 and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each but the last written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
