"""Queries over the training-data tables, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, htmltext, langid, linededup, pii, quality, simhash, substring, timestamps, topk, toxicity, trie


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that every document loses to passages of smaller ids, and a digest of the rest."""
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page."""
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that every document loses to earlier lines."""
    return linededup.digest(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, query_mod=50)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that every document holds."""
    found = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.size("found").alias("n_items"), F.array_join("found.item", ",").alias("items"), F.array_join("found.distance", ",").alias("distances"), (F.size("found") > 0).alias("contaminated"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations."""
    return trie.build(table(spark, sf_dir, "conversations"))


def op13_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instant of every stamp."""
    return timestamps.normalise(table(spark, sf_dir, "stamps")).select("stamp_id", "utc_us", "rule", "ambiguous")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_language_id": op3_language_id,
    "op5_html_text": op5_html_text,
    "op4_line_dedup": op4_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_exact_topk": op7_exact_topk,
    "op8_pii": op8_pii,
    "op10_decontamination": op10_decontamination,
    "op9_byte_bpe": op9_byte_bpe,
    "op11_quality": op11_quality,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_timestamps": op13_timestamps,
}

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": substring.ORACLE,
    "op4_line_dedup": linededup.ORACLE,
    "op7_exact_topk": topk.ORACLE,
    "op12_prefix_trie": trie.ORACLE,
    "op13_timestamps": timestamps.ORACLE,
}
