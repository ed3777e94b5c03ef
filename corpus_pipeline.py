"""A corpus pipeline: language ID, near duplicates, decontamination, secrets, token ids.

Every stage takes what its predecessor kept, is written as Parquet to the shared folder and read back. All
but the last return the columns of ``documents``; the last returns ``doc_id``, the count of tokens and the
digests of ids and of the decoded text.

Defined cases are those of the operators: rows with null texts or without a letter have no language and go
in the first stage; a table without rows passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeline.llm import byte_bpe, catalog, decontaminate, language, secrets, simhash
from stakeline.llm.frames import read, settle


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is rejected."""
    return language.keep_accepted(docs, catalog.learned_languages(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates."""
    return simhash.keep_one_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover a twentieth or more."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; documents stay, and ``n_chars`` follows the text."""
    clean = secrets.redact(docs)
    if "n_chars" not in clean.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(kind))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, as counts and digests, with the round trip."""
    ranks = catalog.vocabulary("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.encode(docs, ranks, decoded_col="decoded"))


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("byte-level BPE", encoded),
]

#: The stages learn, hash and compress, which SQL can't express; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
