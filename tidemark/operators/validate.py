"""Record schemas: what a JSON record must hold, checked field by field with built-in functions.

A record is JSON text. Each rule that it breaks gives one message "path: what is wrong", in the order of the schema;
fields that the schema doesn't know come last. Text that is not a JSON object breaks one rule and no other."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates

#: Names of choices.
PRICING = ("FREE", "FREEMIUM", "PAID", "ENTERPRISE")
ROLES = ("Engineering", "Product", "Research", "Sales", "Design", "Marketing", "Operations", "Data", "Other")
METHODS = ("exact_alias", "normalization", "fuzzy_match", "context_match", "manual_review")
DECISIONS = ("ACCEPTED", "REVIEW", "REJECTED")
FLAGS = ("missing_field", "disputed_value", "low_confidence", "stale_data", "unverified_source", "schema_violation", "duplicate_suspect", "freshness_uncertain")
STATUSES = ("OPEN", "VERIFIED", "DISPUTED", "RESOLVED", "PENDING_REVIEW")
URL = r"^https?://[^\s/?#@:]+(?::\d{1,5})?(?:[/?#]\S*)?$"


@dataclass(frozen=True)
class Rule:
    """A field. kind: text, url, time, whole, number, flag, texts or object. A field that is not required may be absent or null."""

    path: str
    kind: str = "text"
    required: bool = True
    shortest: int = 0
    low: float | None = None
    high: float | None = None
    among: tuple[str, ...] = field(default=())
    pattern: str | None = None


def _envelope(kind: str, *content: Rule, source: bool = True) -> list[Rule]:
    """The fields that all records share, around their content."""
    head = [Rule("schemaVersion", required=False, pattern=r"^\d+\.\d+$"), Rule("recordType", required=False, among=(kind,))]
    origin = [Rule("source", "object"), Rule("source.name", shortest=1), Rule("source.url", "url")] if source else []
    return [*head, *origin, Rule("content", "object"), *content, Rule("collectedAt", "time", required=source)]


SCHEMAS: dict[str, list[Rule]] = {
    "STARTUP": _envelope("STARTUP", Rule("content.entityName", shortest=1), Rule("content.data", "object", required=False), Rule("content.data.employeeCount", "whole", required=False, low=0)),
    "PRODUCT": _envelope("PRODUCT", Rule("content.startupName", required=False), Rule("content.pricingModel", required=False, among=PRICING)),
    "RESEARCH_PAPER": _envelope(
        "RESEARCH_PAPER", Rule("content.title", shortest=1), Rule("content.authors", "texts", required=False), Rule("content.paper_url", "url"), Rule("content.github_url", "url", required=False),
        Rule("content.github_stars", "whole", required=False, low=0), Rule("content.published_date", "time"), source=False,
    ),
    "JOB": _envelope("JOB", Rule("content.company", shortest=1), Rule("content.date", "time"), Rule("content.is_remote", "flag"), Rule("content.role_family", among=ROLES)),
    "NEWS": _envelope("NEWS", Rule("content.title", shortest=1), Rule("content.fullText", shortest=1), Rule("content.publishedAt", "time"), Rule("content.mentionedEntities", "texts", required=False)),
    "ENTITY_MAPPING": [
        Rule("rawName", shortest=1), Rule("canonicalName", required=False), Rule("method", among=METHODS), Rule("confidence", "number", low=0, high=1), Rule("sourceUrl", "url"), Rule("decision", among=DECISIONS),
    ],
    "QUALITY_FLAG": [
        Rule("id", required=False), Rule("record_type"), Rule("record_id"), Rule("flag_type", among=FLAGS), Rule("field_name"), Rule("expected_value", required=False), Rule("actual_value", required=False),
        Rule("source_url", required=False), Rule("status", required=False, among=STATUSES), Rule("quality_score", "number", required=False, low=0, high=100), Rule("created_at", "time", required=False), Rule("resolved_at", "time", required=False),
    ],
}
#: How the type of a JSON value begins, by kind.
TYPES = {"text": ("STRING",), "url": ("STRING",), "time": ("STRING",), "whole": ("BIGINT", "DECIMAL"), "number": ("BIGINT", "DECIMAL", "DOUBLE"), "flag": ("BOOLEAN",), "texts": ("ARRAY<STRING", "ARRAY<VOID"), "object": ("OBJECT",)}


def _broken(record: Column, rule: Rule) -> Column:
    """What is wrong with one field, or null."""
    path = "$." + rule.path
    value, kind = F.try_variant_get(record, path, "string"), F.schema_of_variant(F.try_variant_get(record, path, "variant"))
    found = F.when(kind.isNull() | (kind == "VOID"), F.lit("missing") if rule.required else F.lit(None))
    fits = reduce(lambda a, b: a | b, (kind.startswith(t) for t in TYPES[rule.kind]))
    if rule.kind == "whole":
        fits = fits & F.try_variant_get(record, path, "decimal(38,18)").try_cast("bigint").eqNullSafe(F.try_variant_get(record, path, "decimal(38,18)"))
    found = found.when(~fits, F.lit(f"not of kind {rule.kind}"))
    if rule.shortest:
        found = found.when(F.length(value) < rule.shortest, F.lit("too short"))
    if rule.kind == "url":
        found = found.when(~value.rlike(URL), F.lit("not a URL"))
    if rule.kind == "time":
        found = found.when(dates.parse_utc(value).isNull(), F.lit("not a time"))
    if rule.pattern:
        found = found.when(~value.rlike(rule.pattern), F.lit("wrong form"))
    if rule.among:
        found = found.when(~value.isin(*rule.among), F.lit("not among the choices"))
    if rule.low is not None:
        found = found.when(value.try_cast("double") < rule.low, F.lit("too small"))
    if rule.high is not None:
        found = found.when(value.try_cast("double") > rule.high, F.lit("too large"))
    return F.concat(F.lit(f"{rule.path}: "), found)


def _violations(json: Column, record: Column, schema: str | list[Rule]) -> Column:
    """The messages of a record: its text, and the same text parsed."""
    rules = SCHEMAS[schema] if isinstance(schema, str) else schema
    known: dict[str, list[str]] = {"": []}
    for rule in rules:
        parent, _, name = rule.path.rpartition(".")
        known.setdefault(parent, []).append(name)
        if rule.kind == "object":
            known.setdefault(rule.path, [])

    def unknown(parent: str, names: list[str]) -> Column:
        keys = F.json_object_keys(F.get_json_object(json, f"$.{parent}") if parent else json)
        extra = F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*map(F.lit, names)) if names else F.array().cast("array<string>"))
        return F.transform(extra, lambda k: F.concat(F.lit(f"{parent}." if parent else ""), k, F.lit(": not in the schema")))

    found = F.concat(F.array_compact(F.array(*(_broken(record, rule) for rule in rules))), *(unknown(*x) for x in known.items()))
    is_object = F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, found).otherwise(F.array(F.lit("not an object")))


def violations(json: Column, schema: str | list[Rule]) -> Column:
    """The messages of a record; none if it is valid. Null and text that is no JSON object give "not an object"."""
    return dates.let(F.try_parse_json(json), lambda record: _violations(json, record, schema))


def validate(records: DataFrame, schema: str, json_col: str = "json") -> DataFrame:
    """records with violations (array<string>) and status, PASSED or FAILED.

    The record is parsed in a step of its own, so that the rules are compiled; in a lambda they would be interpreted."""
    own = f"_record_{uuid.uuid4().hex}"
    parsed = records.withColumn(own, F.try_parse_json(F.col(json_col)))
    checked = parsed.withColumn("violations", _violations(F.col(json_col), F.col(own), schema)).drop(own)
    return checked.withColumn("status", F.when(F.size("violations") == 0, "PASSED").otherwise("FAILED"))


def validate_by_type(records: DataFrame, kind_col: str = "recordType", json_col: str = "json") -> DataFrame:
    """As validate, each record by the schema that its type names; a type without a schema fails."""
    chosen = reduce(lambda c, kind: c.when(F.col(kind_col) == kind, violations(F.col(json_col), kind)), SCHEMAS, F.when(F.lit(False), F.array().cast("array<string>")))
    checked = records.withColumn("violations", F.coalesce(chosen, F.array(F.lit("recordType: no such schema"))))
    return checked.withColumn("status", F.when(F.size("violations") == 0, "PASSED").otherwise("FAILED"))


def drift_alerts(checked: DataFrame, source: str = "source", seq: str = "seq", most: int = 100) -> DataFrame:
    """Per source: how many records broke rules, and how many times each rule was broken, most often first. The number of
    messages is that of rules and unknown fields; of the latter the `most` commonest are listed."""
    # a filter before the explosion would move below the rules and have them read every record once more; valid records have no messages
    broken = checked.select(source, seq, F.explode_outer("violations").alias("message")).where("message IS NOT NULL")
    by_rule = broken.groupBy(source, "message").agg(F.count("*").alias("n"), F.min(seq).alias("first"))
    ranked = by_rule.withColumn("k", F.row_number().over(Window.partitionBy(source).orderBy(F.desc("n"), "message"))).where(F.col("k") <= most)
    return ranked.groupBy(source).agg(F.sum("n").alias("broken"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "message", "first"))).alias("a")).select(source, "broken", F.transform("a", lambda x: F.struct(x["message"].alias("message"), (-x["n"]).alias("n"), x["first"].alias("first"))).alias("alerts"))
