"""Named queries of the operators, with check statements where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe, decontaminate, html_text, language, lexical, line_dedup, negatives, quality, repeats, secrets, sharding, simhash,
    token_counts,
)
from .frames import read
from .statements import STATEMENTS

#: The folder of the public vocabularies; None asks the installed package.
TOKENIZERS: str | None = None


def vocabulary(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judged(decontaminate.find_contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.find_repeats(read(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read(spark, sf_dir, "pages"))


def held_out(doc_id):
    """A null id is never held out (and never learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned_languages(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries from the rows that are not held out."""
    return language.learn(docs.where(~held_out(F.col("doc_id"))))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = language.predict(docs, learned_languages(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.encode(read(spark, sf_dir, "documents"), ranks, decoded_col="decoded"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.assess(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("print")).alias("fingerprint"), "component_id")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def moved_label(vec_id, label):
    """The stated test labels: those of ids divisible by seven go one on."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(read(spark, sf_dir, "embeddings"), label=moved_label)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_sharding, op2_decontamination, op3_token_counts, op4_repeats, op5_secret_scan, op6_html_text,
             op7_language, op8_byte_bpe, op9_quality, op10_simhash, op11_line_dedup, op12_lexical_search,
             op13_hard_negatives, pipeline)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(STATEMENTS)
