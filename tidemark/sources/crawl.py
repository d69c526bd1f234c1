"""The rules of a crawl as relations: which answer counts, when a request may start, what a quota leaves, and the driver.

Fetching itself stays outside of the engine: whatever fetches lands every answer it gets as a row, and these rules judge them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import netloc

#: Retries, seconds of the first and of the longest wait, requests a second and burst of a domain, and requests below
#: which a quota counts as low.
RETRIES, BASE, LONGEST, RATE, BURST, LOW = 3, 1.0, 60.0, 1.0, 5, 5


def wait_seconds(attempt: Column, retry_after: Column) -> Column:
    """Wait after an attempt, from 0: doubled each time up to a limit, at least the seconds that the server asks for; without jitter."""
    return F.greatest(F.least(F.lit(LONGEST), F.lit(BASE) * F.pow(F.lit(2.0), attempt)), F.coalesce(F.trim(retry_after).try_cast("double"), F.lit(0.0)))


def settled(attempts: DataFrame, retries: int = RETRIES) -> DataFrame:
    """url, outcome ("ok", "too_large", "refused", "exhausted" or "unfinished"), attempts, waited, http_status and raw_content of
    attempts (url, attempt from 0, http_status or null for a broken connection, retry_after, raw_content).

    Broken connections, 429 and 5xx are retried; the first other answer settles an address, and later attempts don't count."""
    retried = F.col("http_status").isNull() | (F.col("http_status") == 429) | (F.col("http_status") >= 500)
    rows = attempts.where(F.col("attempt") <= retries).withColumn("retried", retried)
    final = F.min_by(F.struct("attempt", "http_status", "raw_content"), F.when(~F.col("retried"), F.col("attempt")))
    ends = rows.groupBy("url").agg(final.alias("f"), F.max("attempt").alias("last"))
    waits = rows.where("retried").join(ends.select("url", F.col("f.attempt").alias("end")), "url").where("end IS NULL OR attempt < end").groupBy("url").agg(F.sum(wait_seconds(F.col("attempt"), F.col("retry_after"))).alias("waited"))
    status = F.col("f.http_status")
    outcome = F.when(status.isNull(), F.when(F.col("last") >= retries, "exhausted").otherwise("unfinished")).when(status == 413, "too_large").when(status >= 400, "refused").otherwise("ok")
    used = F.coalesce(F.col("f.attempt"), F.col("last")) + 1
    return ends.join(waits, "url", "left").select("url", outcome.alias("outcome"), used.alias("attempts"), F.coalesce("waited", F.lit(0.0)).alias("waited"), status.alias("http_status"), F.when(outcome == "ok", F.col("f.raw_content")).alias("raw_content"))


def paced(requests: DataFrame, url: str = "url", at: str = "at", rate: float = RATE, burst: int = BURST) -> DataFrame:
    """requests (url, at in seconds) with domain and start: a bucket of `burst` tokens per domain, refilled at `rate` a second, lets a
    request start when it holds one. The k-th request starts at the latest of: its own time, and for each j before it the time of j
    plus what k - j + 1 requests beyond the burst take to refill; that is a running maximum, so one sort per domain is enough."""
    domain = F.coalesce(F.nullif(netloc(F.col(url)), F.lit("")), F.col(url))
    order = Window.partitionBy("domain").orderBy(at, url)
    rows = requests.withColumn("domain", domain).withColumn("_k", F.row_number().over(order) - 1)
    # a token for each burst-th request before is the earliest start of this one: at_j + (k - j + 1 - burst) / rate
    base = F.max(F.col(at) - F.col("_k") / rate).over(order.rowsBetween(Window.unboundedPreceding, 0))
    start = F.greatest(F.col(at).cast("double"), base + (F.col("_k") + 1 - burst) / rate)
    return rows.withColumn("start", start).drop("_k")


def quota(answers: DataFrame, source: str = "source", seq: str = "seq", headers: str = "headers") -> DataFrame:
    """Per source: remaining and reset_at of the last answers whose headers tell them, whether that is low, and whether any answer was a
    403 with nothing left."""
    low = F.transform_keys(F.col(headers), lambda k, v: F.lower(k))
    rows = answers.withColumn("_left", F.try_element_at(low, F.lit("x-ratelimit-remaining")).try_cast("int")).withColumn("_reset", F.try_element_at(low, F.lit("x-ratelimit-reset")).try_cast("double"))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq)))
    found = rows.groupBy(source).agg(last("_left").alias("remaining"), last("_reset").alias("reset_at"), F.count_if((F.col("http_status") == 403) & (F.col("_left") == 0)).alias("n"))
    return found.select(source, "remaining", "reset_at", F.coalesce(F.col("remaining") <= LOW, F.lit(False)).alias("low"), (F.col("n") > 0).alias("exhausted"))


def crawled(discovered: DataFrame, attempts: DataFrame, retries: int = RETRIES) -> DataFrame:
    """The discovered sources (url, …) with the content of those that were fetched; a failed address yields nothing."""
    return discovered.join(settled(attempts, retries).where("outcome = 'ok'").select("url", "http_status", "raw_content"), "url")
