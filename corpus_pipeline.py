"""A training corpus in five stages, from raw documents to packed windows.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns a DataFrame that
is written as Parquet and read again for the next one. All but the last return the columns of ``documents``.

All stages take nulls in any column, empty and very long texts, equal texts under several ids, rows that repeat
whole, columns with other names beside those of ``documents``, which come through untouched, and a table without
rows, which gives none. What each makes of them is said below.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.language_id import accepted
from millrace.llm.line_dedup import without_repeated_lines
from millrace.llm.mixing import sample_mixture
from millrace.llm.packing import pack_documents
from millrace.llm.simhash_vp import keep_one
from millrace.session import prepare, scratch_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; ``lang`` becomes the language found.

    Null and empty texts and texts without a letter go. Long texts are read whole, a null lang or id is no
    obstacle, repeated rows are judged alike and all stay. Of equal sizes the first language by name counts.
    """
    return accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that another document, or an earlier line, already has; ``n_chars`` follows.

    Documents that lose every line with content go, so of equal texts under several ids one stays; texts that
    are null, empty or without a letter or digit stay as they are. Rows that repeat whole, id and text, count as one
    document and stay together; the next stage keeps one of them.
    """
    return without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    Of rows that repeat whole one stays. Null and blank texts are one group. Null ids count for no minimum.
    """
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected token shares meet the target weights. A null source or language is a value of its own."""
    return sample_mixture(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 tokens: doc_id, start, ids, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone; repeated rows are packed each on its own.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("mixing", mixing), ("packing", packing)]

# SimHash over XXH64, compression and token ids have no SQL counterpart; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a written table between any two."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
