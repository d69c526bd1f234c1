"""Sinks: flattened CSV tabs, JSON, top rows per type, crawl state, versioned upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tabs with their columns and least number of rows.
TABS = {
    "Startups": (["schemaVersion", "recordType", "source.name", "source.url", "content.entityName", "content.data.employeeCount", "collectedAt"], 1000),
    "Products": (["schemaVersion", "recordType", "source.name", "source.url", "content.startupName", "content.pricingModel", "collectedAt"], 1000),
    "Research Papers": (["schemaVersion", "recordType", "content.title", "content.authors", "content.paper_url", "content.github_url", "content.github_stars", "content.published_date"], 1000),
    "Jobs": (["schemaVersion", "recordType", "source.name", "source.url", "content.company", "content.date", "content.is_remote", "content.role_family"], 0),
    "News": (["source.name", "source.url", "content.title", "content.publishedAt", "content.fullText", "collectedAt"], 0),
    "Entity Mapping Log": (["rawName", "canonicalName", "method", "confidence", "sourceUrl", "decision"], 0),
}
TAB_OF = {"STARTUP": "Startups", "PRODUCT": "Products", "RESEARCH_PAPER": "Research Papers", "JOB": "Jobs", "NEWS": "News"}


def flat_text(value: Column, kind: T.DataType) -> Column:
    """A cell: null is empty, lists are JSON, booleans upper case, timestamps ISO."""
    if isinstance(kind, T.BooleanType):
        out = F.upper(value.cast("string"))
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        out = F.to_json(value)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        out = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    else:
        out = value.cast("string")
    return F.coalesce(out, F.lit(""))


def flatten(records: DataFrame, columns: list[str]) -> DataFrame:
    """One text column per dotted path; a path that the schema lacks is empty."""

    def kind_of(path: str) -> T.DataType | None:
        kind: T.DataType = records.schema
        for part in path.split("."):
            if not isinstance(kind, T.StructType) or part not in kind.names:
                return None
            kind = kind[part].dataType
        return kind

    return records.select(*[(F.lit("") if (kind := kind_of(c)) is None else flat_text(F.col(c), kind)).alias(c) for c in columns])


def write_tab(records: DataFrame, tab: str, folder: str) -> None:
    flatten(records, TABS[tab][0]).write.mode("overwrite").option("header", True).csv(f"{folder}/{tab.replace(' ', '_').lower()}")


def tab_counts(records: DataFrame, spark_tabs: dict[str, int] | None = None) -> DataFrame:
    """tab, rows and ok: whether the least number of rows is there."""
    least = spark_tabs or {t: n for t, (_, n) in TABS.items()}
    tab = F.element_at(F.create_map(*[F.lit(x) for kv in TAB_OF.items() for x in kv]), F.col("recordType"))
    need = F.element_at(F.create_map(*[F.lit(x) for kv in least.items() for x in kv]), F.col("tab"))
    return records.withColumn("tab", tab).where("tab IS NOT NULL").groupBy("tab").agg(F.count("*").alias("rows")).withColumn("ok", (need == 0) | (F.col("rows") >= need))


def first_per_type(records: DataFrame, kind: str, order: list[str], most: int) -> DataFrame:
    return records.withColumn("_n", F.row_number().over(Window.partitionBy(kind).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def web_extract(records: DataFrame, kind: str, order: list[str], most: int = 400, capped: tuple[str, ...] = ("STARTUP", "PRODUCT", "RESEARCH_PAPER")) -> DataFrame:
    """The first rows of the large types and all of the others."""
    some = first_per_type(records.where(F.col(kind).isin(*capped)), kind, order, most)
    return some.unionByName(records.where(~F.col(kind).isin(*capped)))


def public(records: DataFrame) -> DataFrame:
    """Without private columns."""
    return records.drop(*[c for c in records.columns if c.startswith("_")])


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """current with changes: new keys start at version 1, known keys take the change and the next version. Changes hold each key once."""
    old = current.select(*keys, F.col(version).alias("_old"))
    merged = changes.drop(version).join(old, keys, "left").withColumn(version, F.coalesce(F.col("_old") + 1, F.lit(1))).drop("_old")
    return current.join(changes.select(*keys), keys, "left_anti").unionByName(merged.select(*current.columns))


def column_letter(n: int) -> str:
    """1 is A, 27 is AA."""
    out = ""
    while n > 0:
        n, rest = divmod(n - 1, 26)
        out = chr(65 + rest) + out
    return out
