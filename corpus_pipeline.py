"""Corpus pipeline: language ID, near-duplicates, secrets, source mix, byte-level BPE.

Each stage takes all rows that the one before it kept, is written as Parquet to the
shared folder and read again by the next. Stages before the last return the columns
of ``documents``. Rows with a null text or without a letter go in the first stage;
an empty table passes through as one; columns of any other name are carried along. Rows
that repeat an id are rows of one document and stay or go together; of equal texts the
smallest id stays; very long texts pass whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patrona.llm import text as T
from patrona.llm.byte_bpe import encode_documents
from patrona.llm.langid import known_languages
from patrona.llm.minhash_forest import near_duplicates
from patrona.llm.mixing import mix_sources
from patrona.llm.secret_scan import redact_secrets
from patrona.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; ``und`` and undecided ones go."""
    return known_languages(docs, ~T.in_share("doc_id", 3, 1), public_tokenizers.path("piece_bpe_32k.model"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    copies = near_duplicates(docs, shingle_words=4).where("not kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and ``n_chars`` counted again."""
    clean = redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its first word (a document without a word goes)."""
    copies = mix_sources(docs).where("copies > 0").groupBy("doc_id").agg(F.max("copies").cast("int").alias("_copies"))
    return (docs.join(copies, "doc_id").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
            .select(*docs.columns))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of each row."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

#: Byte-level BPE and the language model cannot be stated in SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
