"""Driver queries of the subpackage: one thin query per operator, over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.llm import bpe, conversations, html, langid, lexical, lines, minhash, mixing, quality, substrings
from indicata.llm import topk, toxicity, trie


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows by inner product for every hundredth vector."""
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without strings of 400 bytes that occur twice, and whether they held any."""
    found = substrings.digest(substrings.remove_repeats(_table(spark, sf_dir, "documents")))
    return found.withColumn("repeated", F.col("n_removed") > 0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents; learned from those not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.identify(docs, model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near duplicates among all documents."""
    docs = _table(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts of all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digest(bpe.encode(docs, path, public_tokenizers.PATTERN))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of all sources takes."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rule and learned verdict of all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.learn(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).select(
        "row.doc_id", *[f"stats.{x}" for x in quality.STATISTICS[:5]], "base_failed", "kept")


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html.extract(_table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; labels learned from those not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    found = toxicity.score(docs, toxicity.learn(docs, labels))
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that all documents lose as fuzzy repeats, and a digest of what is left."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "row.doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by the similarity of their word shingles."""
    return trie.join(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired digest of all conversations, damaged by a checksum first."""
    rows = conversations.damaged(_table(spark, sf_dir, "conversations"))
    return conversations.summarise(rows, key="key", present=F.col("present")).withColumnRenamed("key", "conv_id")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for each benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_repeated_strings": op2_repeated_strings,
    "op3_language_id": op3_language_id,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_mix_sources": op6_mix_sources,
    "op7_quality_rules": op7_quality_rules,
    "op8_main_text": op8_main_text,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_ngram_join": op11_ngram_join,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_top_k": topk.oracle(),
    "op4_near_duplicates": minhash.oracle(),
    "op6_mix_sources": mixing.oracle(),
    "op11_ngram_join": trie.oracle(),
    "op13_lexical_search": lexical.oracle(),
}
