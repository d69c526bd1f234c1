"""One run from payloads to survivors: routing, resolution, deduplication, and counters that cost no second pass.

Counters are observed where the rows pass: records of each type, decisions of the resolver, records that stay. There is one
counter for each type and decision, which are fixed, so nothing that grows comes to the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import dedup, ingest, resolve
from tidemark.operators.ingest import Route
from tidemark.tables import discard, stored

#: Types whose names are resolved.
RESOLVED = ("STARTUP", "PRODUCT")
TYPES = ("RESEARCH_PAPER", "STARTUP", "PRODUCT", "JOB", "NEWS")
DECISIONS = ("ACCEPTED", "REVIEW", "REJECTED")


@dataclass
class Run:
    """records (seq, …, status), all of them, and what was counted on the way."""

    records: DataFrame
    crawled: Observation
    decided: Observation
    kept: Observation

    def survivors(self) -> DataFrame:
        return self.records.where("status = 'keep'").drop("status")

    def counters(self) -> dict[str, dict[str, int]]:
        """crawled, accepted and duplicates by type and decisions of the resolver; records must have been written or collected."""
        crawled, kept = self.crawled.get, self.kept.get
        return {
            "crawled": {t: crawled[t] for t in TYPES},
            "accepted": {t: kept[t] for t in TYPES},
            "duplicates": {t: crawled[t] - kept[t] for t in TYPES},
            "decisions": {d: self.decided.get[d] for d in DECISIONS},
        }


def run(payloads: DataFrame, routes: list[Route], seeds: DataFrame, threshold: float = 0.90, keys: tuple[str, ...] = (), address: str = "source_url") -> Run:
    """Payloads in the order of routes, then of keys, then of name and url: the first record of a kind stays.

    A startup's or product's name becomes the resolver's, where it decides for one; then come the exact key, the normalised
    key and similar names. Each step is written, so a lost executor repeats no finished one."""
    crawled, decided, kept = (Observation(f"run_{x}") for x in ("crawled", "decided", "kept"))
    number = F.lit(len(routes))
    for k in range(len(routes) - 1, -1, -1):
        number = F.when(F.col(address).contains(routes[k][0]), F.lit(k)).otherwise(number)
    found = ingest.routed(payloads, routes, address, keys).withColumn("_route", number)
    placed = found.repartitionByRange("_route", *keys, "name", "url").sortWithinPartitions("_route", *keys, "name", "url")
    # ranges in order, rows sorted: these ids are the order of the whole
    rows = placed.withColumn("seq", F.monotonically_increasing_id()).drop("_route")
    rows = stored(rows.observe(crawled, *(F.count_if(F.col("record_type") == t).alias(t) for t in TYPES)))
    named = rows.where(F.col("record_type").isin(*RESOLVED))
    answered = resolve.resolve(named, seeds, name="name")
    answered = answered.observe(decided, *(F.count_if(F.col("decision") == d).alias(d) for d in DECISIONS))
    answered = answered.withColumn("name", F.coalesce(F.nullif("canonical", F.lit("")), "name")).select(*rows.columns)
    others = rows.where(~F.coalesce(F.col("record_type").isin(*RESOLVED), F.lit(False)))
    c, none = F.col, F.lit(None).cast("string")
    kind = c("record_type")
    together = answered.unionByName(others).withColumns({
        "exact": text.exact_key(kind, c("url"), c("name"), none, c("url")),
        "norm": text.normalize_key(c("name")),
        "block": text.block_key(c("name"), kind),
    })
    together = stored(together)
    discard(rows)
    judged = dedup.survivors(together, threshold).drop("exact", "norm", "block")
    judged = judged.observe(kept, *(F.count_if((F.col("record_type") == t) & (F.col("status") == "keep")).alias(t) for t in TYPES))
    return Run(judged, crawled, decided, kept)
