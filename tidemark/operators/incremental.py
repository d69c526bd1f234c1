"""Change detection over crawls, versions, refetch times and cached lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def changed(crawls: DataFrame, url: str, seq: str, text: str) -> DataFrame:
    """crawls with hash, changed (against the crawl before; a new address has changed) and version."""
    order = Window.partitionBy(url).orderBy(seq)
    hashed = crawls.withColumn("hash", F.sha2(F.col(text).cast("binary"), 256))
    flagged = hashed.withColumn("changed", ~F.col("hash").eqNullSafe(F.lag("hash").over(order)))
    return flagged.withColumn("version", F.sum(F.col("changed").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def crawl_state(crawls: DataFrame, url: str, seq: str, text: str) -> DataFrame:
    """The newest state of each address; an etag stays if a later crawl has none."""
    last = lambda c: F.max_by(c, F.when(F.coalesce(c, F.lit("")) != "", F.col(seq)))
    return crawls.groupBy(url).agg(F.max_by(F.sha2(F.col(text).cast("binary"), 256), seq).alias("last_seen_hash"), F.max(seq).alias("last_crawled_at"), *[last(c).alias(c) for c in ("etag", "last_modified") if c in crawls.columns])


def due(last: Column, now: Column, seconds: int = 300) -> Column:
    """Whether an address may be fetched again; an unknown one may."""
    return F.coalesce(F.unix_micros(now.cast("timestamp")) - F.unix_micros(last.cast("timestamp")) >= seconds * 1_000_000, F.lit(True))


def cached_stars(repos: DataFrame, snapshot: DataFrame, now: Column, ttl_seconds: int = 86_400) -> DataFrame:
    """repos with stars from the newest snapshot row (repo, stars, fetched_at) that is not older than the limit, else null."""
    live = snapshot.where(F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("fetched_at").cast("timestamp")) < ttl_seconds * 1_000_000)
    newest = live.groupBy("repo").agg(F.max_by("stars", "fetched_at").alias("stars"))
    return repos.join(newest, "repo", "left")
