"""Payload tables to records: routing to parsers, envelopes, enrichment, and what leaves the engine."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates, scoring
from tidemark.operators import lineage, validate

#: A route: what an address must hold, the parser, and columns of its rows by name of the common columns.
Route = tuple[str, Callable[[DataFrame], DataFrame], dict[str, Column]]
#: Columns of routed rows.
COMMON = ("record_type", "name", "url", "detail")


def routed(payloads: DataFrame, routes: list[Route], address: str = "source_url", keys: tuple[str, ...] = ()) -> DataFrame:
    """COMMON columns of all that the parsers find in payloads; a payload goes to the first route whose text its address
    holds, and yields nothing if there is none."""
    number = reduce(lambda c, x: c.when(F.col(address).contains(x[1][0]), F.lit(x[0])), enumerate(routes), F.when(F.lit(False), F.lit(0)))
    marked = payloads.withColumn("_route", number)
    parts = []
    for k, (_, parser, columns) in enumerate(routes):
        found = parser(marked.where(F.col("_route") == k).drop("_route"))
        parts.append(found.select(*keys, F.col(address), *(columns.get(c, F.lit(None)).cast("string").alias(c) for c in COMMON)))
    return reduce(DataFrame.unionByName, parts)


def literal_sources(spark, rows: list[tuple[str, str, str]]) -> DataFrame:
    """The fixed list of what to read: (source_name, source_url, kind)."""
    return spark.createDataFrame(rows, "source_name string, source_url string, kind string")


def with_config(payloads: DataFrame, config: DataFrame, address: str = "source_url", api: str = "api_url") -> DataFrame:
    """payloads with the columns of the source that their address names; others go. A config holds an address once."""
    return payloads.join(config.withColumnRenamed(api, address), address)


def paper_date(text: Column, collected: Column) -> Column:
    """A paper's date; one that can't be read becomes the moment of collection."""
    return F.coalesce(dates.parse_utc(text), collected)


def with_authors(papers: DataFrame, authors: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """papers with the author list of their id, empty without one."""
    return papers.join(authors.select(key, "authors"), key, "left").withColumn("authors", F.coalesce("authors", F.array().cast("array<string>")))


def enrich(records: DataFrame, run_id: str, now: Column) -> DataFrame:
    """records (record_type, source_url, json, published, collected, corroborated, disputed, method, incomplete) with id, violations,
    status, quality_score, quality_breakdown and lineage_chain_id. The lineage status is that of the validation."""
    checked = validate.validate_by_type(records, "record_type", "json")
    parts = scoring.breakdown(*(F.col(c) for c in ("source_url", "published", "collected", "corroborated", "disputed", "method", "incomplete")), now)
    scored = checked.withColumn("quality_breakdown", parts).withColumn("quality_score", F.col("quality_breakdown.total"))
    chained = lineage.chains(scored, run_id, status="status")
    return chained.withColumnRenamed("record_id", "id").withColumn("lineage_chain_id", F.sha2(F.concat_ws("|", F.lit("chain"), "id").cast("binary"), 256))


def inspect(records: DataFrame, key: Column) -> DataFrame:
    """The one record of a key as indented JSON."""
    return records.where(key).select(F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("record"))


def searchable(records: DataFrame, flags: DataFrame, key: str = "record_id") -> DataFrame:
    """records without those that a flag holds back for review."""
    return records.join(flags.where("status = 'PENDING_REVIEW'").select(key).distinct(), key, "left_anti")


def write_json(records: DataFrame, path: str) -> None:
    """Records as JSON, one object a line in every file, nulls kept and private columns left out."""
    from tidemark.sources.sinks import public

    public(records).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def chunks(docs: DataFrame, key: str, text_col: str, size: int = 2000, between: str = r"\n\s*\n") -> DataFrame:
    """key, chunk and text: paragraphs of a text, gathered by their running length: chunk n holds the paragraphs that begin
    within its n-th `size` characters. Empty paragraphs are left out. One shuffle, by row."""
    rows = docs.select(F.col(key), F.col(text_col).alias("_t"), F.monotonically_increasing_id().alias("_row"))  # before any row becomes several
    each = rows.select(key, "_row", F.posexplode(F.split("_t", between)).alias("_at", "_p")).where(F.trim("_p") != "")
    before = F.sum(F.length("_p")).over(Window.partitionBy("_row").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    placed = each.withColumn("chunk", F.floor(F.coalesce(before, F.lit(0)) / size))
    joined = placed.groupBy("_row", key, "chunk").agg(F.array_sort(F.collect_list(F.struct("_at", "_p"))).alias("_l"))
    return joined.select(key, "chunk", F.array_join(F.transform("_l", lambda x: x["_p"]), "\n\n").alias("text"))
