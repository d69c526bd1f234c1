"""Results as JSON that other programs read: arrays of records, and crawl state as an object by address.

Every file of a folder is whole JSON of its own. A file holds at most PER_FILE entries, since whoever reads JSON that spans
lines reads a file at once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.sinks import public

#: Entries of a file, and chains of a lineage file.
PER_FILE, CHAINS = 100_000, 50
#: Fields of a state entry; the first three are required.
STATE = "url string, last_seen_hash string, last_crawled_at string, etag string, last_modified string"
REQUIRED = ["url", "last_seen_hash", "last_crawled_at"]


def _written(lines: DataFrame, path: str, opening: str, closing: str, per_file: int) -> None:
    """Each partition of lines (value) as files of one JSON value each."""
    rows = -(-lines.count() // per_file)
    if not rows:
        lines.sparkSession.createDataFrame([(opening + closing,)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return

    def wrap(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        yield pd.DataFrame({"value": [opening]})
        for frame in frames:
            values = frame["value"].tolist()
            if values:
                out = ([] if last is None else [last + ","]) + [v + "," for v in values[:-1]]
                last = values[-1]
                if out:
                    yield pd.DataFrame({"value": out})
        yield pd.DataFrame({"value": ([] if last is None else [last]) + [closing]})

    lines.repartition(rows).mapInPandas(wrap, "value string").write.mode("overwrite").text(path)


def write_array(rows: DataFrame, path: str, per_file: int = PER_FILE) -> None:
    """Rows as JSON arrays, nulls kept and private columns left out; readers.records reads them back. No rows give an empty array."""
    kept = public(rows)
    whole = F.to_json(F.struct(*(F.col(f"`{c}`") for c in kept.columns)), {"ignoreNullFields": "false"})
    _written(kept.select(whole.alias("value")), path, "[", "]", per_file)


def deliver(folder: str, records: DataFrame, chains: DataFrame, metrics: DataFrame, mappings: DataFrame, order: str, most_chains: int = CHAINS) -> None:
    """pipeline_results, lineage_chains (the first by `order`), observability_report and entity_mapping_logs, as arrays."""
    write_array(records, f"{folder}/pipeline_results")
    write_array(chains.orderBy(order).limit(most_chains), f"{folder}/lineage_chains")
    write_array(metrics, f"{folder}/observability_report")
    write_array(mappings, f"{folder}/entity_mapping_logs")


def to_entry(columns: dict[str, Column]) -> Column:
    """A state entry as JSON; absent fields are null."""
    names = [f.split()[0] for f in STATE.split(", ")]
    return F.to_json(F.struct(*(columns.get(n, F.lit(None)).cast("string").alias(n) for n in names)), {"ignoreNullFields": "false"})


def from_entry(entry: Column) -> Column:
    """The entry of a JSON text, null if it is none or lacks a required field."""
    found = F.from_json(entry, STATE)
    whole = F.lit(True)
    for name in REQUIRED:
        whole = whole & found[name].isNotNull()
    return F.when(whole, found)


def save_state(state: DataFrame, path: str, per_file: int = PER_FILE) -> None:
    """State (url and other fields of STATE, one row for each address) as JSON objects by address."""
    entry = to_entry({c: F.col(c) for c in state.columns})
    key = F.regexp_extract(F.to_json(F.struct(F.col("url").cast("string").alias("k"))), r"^\{\"k\":(.*)\}$", 1)  # as a JSON string
    _written(state.where("url IS NOT NULL").select(F.concat(key, F.lit(": "), entry).alias("value")), path, "{", "}", per_file)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The entries of saved state. A file that is no JSON object gives none, a broken entry is left out; an absent folder is empty."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], STATE)
    names = [f.split()[0] for f in STATE.split(", ")]
    objects = F.from_json("value", f"map<string, struct<{', '.join(f'{n}: string' for n in names)}>>")
    entries = spark.read.text(path, wholetext=True).select(F.explode(objects).alias("key", "e")).select("e.*")
    return entries.where(" AND ".join(f"{n} IS NOT NULL" for n in REQUIRED))
