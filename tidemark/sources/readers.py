"""Readers of tables and landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED_SCHEMA = "entities array<struct<canonical_name:string,aliases:array<string>,domain:string,category:string>>"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def landed(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Whole files of a landing folder as raw documents with a content hash; glob patterns work. Fetching is left to whatever
    lands the files, whose retries and rate limits are policy (see fetch_policy)."""
    rows = spark.read.text(path, wholetext=True).select(F.col("value").alias("raw_content"), F.col("_metadata.file_path").alias("source_url"), F.col("_metadata.file_modification_time").alias("fetched_at"))
    return rows.withColumns({"source_name": F.lit(source), "http_status": F.lit(200), "content_hash": F.sha2(F.col("raw_content").cast("binary"), 256)})


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """The seed dimension of a JSON file {"entities": [...]}, in file order."""
    rows = spark.read.schema(SEED_SCHEMA).json(path, multiLine=True)
    return rows.select(F.posexplode("entities").alias("ordinal", "e")).select("ordinal", "e.*")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Records of an earlier run: a JSON array of envelopes."""
    return spark.read.json(path, multiLine=True)


def page_urls(spark: SparkSession, base: str, total: int, size: int = 100) -> DataFrame:
    """Addresses of the pages of a listing that takes start and max_results."""
    return spark.range(0, total, size).select(F.col("id").alias("start"), F.concat(F.lit(base), F.lit("&start="), F.col("id").cast("string"), F.lit(f"&max_results={size}")).alias("url"))


def fallback(tries: list[tuple[str, DataFrame]], key: str = "url", least: int = 500) -> DataFrame:
    """For each key the first method whose page is whole: status 200, longer than least, and no challenge page."""
    from functools import reduce

    from tidemark.functions.classify import is_challenge

    ranked = [df.where((F.col("http_status") == 200) & (F.length("raw_content") > least) & ~is_challenge(F.col("raw_content"))).select(key, "raw_content", F.lit(i).alias("rank"), F.lit(name).alias("fetch_method")) for i, (name, df) in enumerate(tries)]
    return reduce(DataFrame.unionByName, ranked).groupBy(key).agg(F.min_by("raw_content", "rank").alias("raw_content"), F.min_by("fetch_method", "rank").alias("fetch_method"))


def backoff_seconds(attempt: int, retry_after: str | None = None, base: float = 1.0, most: float = 60.0, jitter: float = 0.0) -> float:
    """Delay before a retry: exponential up to a limit, at least what the server asks for, plus a share of jitter (0 to 0.3)."""
    delay = min(most, base * 2**attempt)
    if retry_after and retry_after.strip().replace(".", "", 1).isdigit():
        delay = max(delay, float(retry_after))
    return delay * (1 + min(0.3, max(0.0, jitter)))
