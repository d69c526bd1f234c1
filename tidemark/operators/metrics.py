"""Operational metrics of crawls: counters per source, freshness average, report."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Errors beyond which the system counts as degraded, and weight of the newest age in the average.
MOST_ERRORS, NEWEST = 50, 0.2


def moving_average(events: DataFrame, by: str = "source", seq: str = "seq", value: str = "freshness") -> DataFrame:
    """(by, average): the average in which the newest value has a weight of NEWEST, rounded after each step, over the values in
    the order of seq. Each key's rows come sorted and in pieces, and only the average so far is held."""
    kind = events.select(by).schema[0].dataType.simpleString()
    rows = events.where(F.col(value).isNotNull()).select(F.col(by).alias("k"), F.col(seq).alias("s"), F.col(value).cast("double").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, key, average = False, None, 0.0
        done: list[tuple] = []
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not started or k != key:
                    if started:
                        done.append((key, average))
                    started, key, average = True, k, half_up(v)
                else:
                    average = half_up((1 - NEWEST) * average + NEWEST * v)
        if started:
            done.append((key, average))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], batch_type), pa.array([x[1] for x in done], pa.float64())], names=[by, "average"])

    batch_type = to_arrow_type(rows.schema["k"].dataType)
    return rows.repartition("k").sortWithinPartitions("k", "s").mapInArrow(run, f"{by} {kind}, average double")


def half_up(x: float) -> float:
    """Two decimals as Spark's round gives them: of the shortest decimal that reads as x, halves away from zero."""
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def source_metrics(events: DataFrame) -> DataFrame:
    """Counters of events (source, seq, ts, accepted, duplicate, stale, error, limited, timeout), and the moving average
    of freshness."""
    flag = lambda c: F.count_if(c)
    counts = events.groupBy("source").agg(
        F.count("*").alias("crawled"), flag("accepted").alias("accepted"), flag("duplicate").alias("duplicates"), flag("stale").alias("stale"), flag("error").alias("errors"),
        flag("limited").alias("limited"), flag("timeout").alias("timeouts"), F.max("ts").alias("last_crawl"),
    )
    averages = moving_average(events).withColumnRenamed("average", "avg_freshness_hours").withColumnRenamed("source", "_source")
    return counts.join(averages, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def report(metrics: DataFrame) -> DataFrame:
    """One row of totals; timeouts do not count towards health."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}")
    sums = metrics.agg(F.count("*").alias("sources"), *map(total, ["crawled", "accepted", "duplicates", "stale", "errors", "limited"]))
    rate = F.coalesce(F.try_divide(F.col("total_duplicates") * 100, F.col("total_accepted") + F.col("total_duplicates")), F.lit(0.0))
    return sums.withColumns({"duplication_rate": F.round(rate, 4), "health": F.when(F.col("total_errors") + F.col("total_limited") > MOST_ERRORS, "DEGRADED").otherwise("HEALTHY")})
