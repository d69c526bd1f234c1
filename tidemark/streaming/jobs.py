"""Structured Streaming forms: exact deduplication, change detection, telemetry, alerts, freshness."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.dates import is_fresh
from tidemark.functions.similar import PREFIX, jaro_winkler_many, least_jaro
from tidemark.operators.metrics import NEWEST, half_up
from tidemark.operators.validate import validate


def stream_table(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet folder as a stream; the rate limit is the number of files per batch."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def first_seen(stream: DataFrame, key: str) -> DataFrame:
    """The first row of each key; state grows with the keys, as a set of all seen keys does."""
    return stream.dropDuplicates([key])


def first_seen_within(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """As first_seen, with state bounded by a watermark: a key may come again after the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def only_fresh(stream: DataFrame, at: str, now: Column, hours: float = 24.0) -> DataFrame:
    """Rows that are fresh at the batch's clock; a watermark would compare with the newest event instead."""
    return stream.where(is_fresh(F.col(at), now, hours))


def changes(stream: DataFrame, url: str, seq: str, text: str) -> DataFrame:
    """(url, seq, hash, changed): whether the content differs from the last one seen of the address, over all batches."""
    rows = stream.select(F.col(url).cast("string").alias("url"), F.col(seq).cast("long").alias("seq"), F.sha2(F.col(text).cast("binary"), 256).alias("hash"))

    def update(key, frames: Iterator[pd.DataFrame], state: GroupState):
        last = state.get[0] if state.exists else None
        frame = pd.concat(list(frames)).sort_values("seq")
        flags = []
        for h in frame["hash"]:
            flags.append(h != last)
            last = h
        state.update((last,))
        frame["changed"] = flags
        yield frame[["url", "seq", "hash", "changed"]]

    return rows.groupBy("url").applyInPandasWithState(update, "url string, seq long, hash string, changed boolean", "hash string", "append", GroupStateTimeout.NoTimeout)


#: Names of an entry of the state.
PAGE = 256


class FirstOfSimilar(StatefulProcessor):
    """Whether a name is like one that its block has kept. Kept names stand in pages of PAGE names of one length; a frame of new
    names reads the pages of lengths that can be similar one by one, so neither a task nor an entry of the state ever holds
    a block. A page lasts until ttl has passed since its last name came."""

    def __init__(self, threshold: float, ttl_ms: int | None, page: int = PAGE):
        self.threshold, self.ttl_ms, self.page = threshold, ttl_ms, page
        self.ratio = 3 * least_jaro(threshold, PREFIX) - 2  # shorter to longer, at least

    def init(self, handle) -> None:
        self.pages = handle.getMapState("pages", "length int, page int", "names array<string>", self.ttl_ms)
        self.sizes = handle.getMapState("sizes", "length int", "names int", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            frame = frame.sort_values("seq", kind="stable")
            names = frame["name"].tolist()
            twin = [False] * len(names)
            lengths = {len(n) for n in names if n is not None}
            for (length,), (size,) in self.sizes.iterator() if self.sizes.exists() else ():
                if any(self._may(length, n) for n in lengths):
                    for page in range(-(-size // self.page)):
                        if self.pages.containsKey((length, page)):
                            self._mark(names, twin, self.pages.getValue((length, page))[0])
            kept: list[str] = []
            for i, n in enumerate(names):
                if n is not None and not twin[i]:
                    near = [k for k in kept if self._may(len(k), len(n))]
                    twin[i] = bool((jaro_winkler_many(near, [n] * len(near)) >= self.threshold).any())
                    if not twin[i]:
                        kept.append(n)
            self._keep(kept)
            frame["status"] = ["duplicate" if t else "keep" for t in twin]
            yield frame[["block", "seq", "name", "status"]]

    def _may(self, a: int, b: int) -> bool:
        return a == b or min(a, b) >= self.ratio * max(a, b)

    def _mark(self, names: list, twin: list[bool], old: list[str]) -> None:
        open_ = [i for i, n in enumerate(names) if n is not None and not twin[i] and self._may(len(n), len(old[0]))]
        for at in range(0, len(open_), 256):
            some = open_[at : at + 256]
            score = jaro_winkler_many([names[i] for i in some for _ in old], list(old) * len(some)).reshape(len(some), len(old))
            for i, hit in zip(some, (score >= self.threshold).any(axis=1)):
                twin[i] = bool(hit)

    def _keep(self, kept: list[str]) -> None:
        for length in sorted({len(n) for n in kept}):
            new = [n for n in kept if len(n) == length]
            size = self.sizes.getValue((length,))[0] if self.sizes.containsKey((length,)) else 0
            while new:
                page, there = divmod(size, self.page)
                old = list(self.pages.getValue((length, page))[0]) if there and self.pages.containsKey((length, page)) else []
                self.pages.updateValue((length, page), (old + new[: self.page - there],))
                size, new = size + len(new[: self.page - there]), new[self.page - there :]
            self.sizes.updateValue((length,), (size,))

    def close(self) -> None:
        pass


def fuzzy_first_seen(stream: DataFrame, block: str, name: str, seq: str, threshold: float = 0.90, ttl: str | None = None) -> DataFrame:
    """(block, seq, name, status): per block a name is a duplicate if a kept one is similar; null names are kept. Exact keys that cross
    blocks need first_seen before this. Within a batch names count in the order of seq as far as they come in one frame, frames in
    the order in which they come. With a ttl, kept names are forgotten when it has passed.

    The session's state store must be RocksDB, see session.SETTINGS. State that may expire asks for one more batch time and again, so a
    query with a ttl that is to stop when all is read needs spark.sql.streaming.noDataMicroBatches.enabled = false."""
    rows = stream.select(F.col(block).cast("string").alias("block"), F.col(seq).cast("long").alias("seq"), F.col(name).cast("string").alias("name"))
    ttl_ms = int(pd.Timedelta(ttl).total_seconds() * 1000) if ttl else None
    return rows.groupBy("block").transformWithStateInPandas(FirstOfSimilar(threshold, ttl_ms), "block string, seq long, name string, status string", "Append", "ProcessingTime" if ttl else "None")


def telemetry(stream: DataFrame, time: str, key: str, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Counts per key and tumbling window; late rows within the delay still count."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def alerts(stream: DataFrame, condition: str, time: str, frequency: str) -> DataFrame:
    """INSTANT alerts are the matching rows; DAILY and WEEKLY ones are counts per window."""
    hits = stream.where(condition)
    if frequency == "INSTANT":
        return hits
    return hits.withWatermark(time, "1 hour").groupBy(F.window(time, {"DAILY": "1 day", "WEEKLY": "7 days"}[frequency]).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def moving_average(stream: DataFrame, by: str, seq: str, value: str) -> DataFrame:
    """(by, average, n) after each batch: the average in which the newest value has a weight of NEWEST, carried on over all batches;
    within a batch rows count in the order of seq."""
    rows = stream.where(F.col(value).isNotNull()).select(F.col(by).cast("string").alias(by), F.col(seq).cast("long").alias("seq"), F.col(value).cast("double").alias("value"))

    def update(key, frames: Iterator[pd.DataFrame], state: GroupState):
        average, n = state.get if state.exists else (None, 0)
        for v in pd.concat(list(frames)).sort_values("seq")["value"]:
            average, n = half_up(v if average is None else (1 - NEWEST) * average + NEWEST * v), n + 1
        state.update((average, n))
        yield pd.DataFrame({by: [key[0]], "average": [average], "n": [n]})

    return rows.groupBy(by).applyInPandasWithState(update, f"{by} string, average double, n long", "average double, n long", "append", GroupStateTimeout.NoTimeout)


def cached(stream: DataFrame, key: str, value: str, time: str, ttl: str) -> DataFrame:
    """(key, at, value, hit): lookups answered from state; a key's value holds until ttl has passed since it was stored by event time,
    and the lookup that comes later stores its own. Keys that the watermark has left behind by ttl lose their state."""
    seconds = int(pd.Timedelta(ttl).total_seconds())
    rows = stream.withWatermark(time, ttl).select(F.col(key).cast("string").alias("key"), F.col(time).alias("at"), F.col(value).cast("string").alias("value"))

    def update(keys, frames: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        held, stored = state.get if state.exists else (None, None)
        frame = pd.concat(list(frames)).sort_values("at")
        out = []
        for at, v in zip(frame["at"], frame["value"], strict=True):
            hit = stored is not None and at.timestamp() - stored < seconds
            if not hit:
                held, stored = v, at.timestamp()
            out.append((keys[0], at, held, hit))
        state.update((held, stored))
        state.setTimeoutTimestamp(max(int((stored + seconds) * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["key", "at", "value", "hit"])

    return rows.groupBy("key").applyInPandasWithState(update, "key string, at timestamp, value string, hit boolean", "held string, stored double", "append", GroupStateTimeout.EventTimeTimeout)


def with_dead_letters(stream: DataFrame, schema: str, json_col: str, accepted: str, rejected: str, checkpoint: str) -> None:
    """Process what is there and stop: records that their schema accepts go to one Parquet table, all others with their violations to
    another. Each batch writes a partition of its number, so a repeated batch replaces what it wrote."""

    def write(batch: DataFrame, number: int) -> None:
        checked = validate(batch, schema, json_col).persist()
        try:
            for path, rows in ((accepted, checked.where("status = 'PASSED'").drop("violations", "status")), (rejected, checked.where("status = 'FAILED'"))):
                rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            checked.unpersist()

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there into Parquet and stop."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
