"""Data-quality scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.classify import holds
from tidemark.functions.dates import age_hours

#: Weights, reliability by address, freshness by age in hours, confidence by method, penalty.
WEIGHTS = {"reliability": 0.30, "corroboration": 0.25, "freshness": 0.25, "confidence": 0.20}
RELIABILITY = [
    (100.0, ["arxiv.org", "api.github.com", "boards-api.greenhouse.io", "huggingface.co/api"]),
    (92.0, ["techcrunch.com", "venturebeat.com", "remoteok.com"]),
    (85.0, ["steven2358", "open-llms", "paperswithcode.com"]),
]
FRESHNESS = [(24.0, 100.0), (168.0, 85.0), (720.0, 70.0)]
CONFIDENCE = [(100.0, ["api_structured", "rss_feed"]), (90.0, ["html_parsing", "json_ld"]), (80.0, ["browser_render", "css_selector"]), (75.0, ["llm_extraction", "fuzzy"])]
PENALTY = 25.0


def reliability(url: Column) -> Column:
    found = F.when(F.lit(False), 0.0)
    for score, words in RELIABILITY:
        found = found.when(holds(url, words), score)
    return found.otherwise(70.0)


def corroboration(corroborated: Column, reliable: Column, incomplete: Column) -> Column:
    return F.when(corroborated, 100.0).when((reliable >= 95) & ~incomplete, 80.0).when(reliable >= 95, 65.0).when(~incomplete, 70.0).otherwise(50.0)


def freshness(at: Column, now: Column) -> Column:
    age = age_hours(at, now)
    found = F.when(at.isNull(), 50.0)
    for hours, score in FRESHNESS:
        found = found.when(age <= hours, score)
    return found.otherwise(55.0)


def confidence(method: Column) -> Column:
    found = F.when(F.lit(False), 0.0)
    for score, names in CONFIDENCE:
        found = found.when(F.lower(method).isin(names), score)
    return found.otherwise(70.0)


def breakdown(url: Column, published: Column, collected: Column, corroborated: Column, disputed: Column, method: Column, incomplete: Column, now: Column) -> Column:
    """The five components and the total, 0 to 100."""
    r = reliability(url)
    parts = {"reliability": r, "corroboration": corroboration(corroborated, r, incomplete), "freshness": freshness(F.coalesce(published, collected), now), "confidence": confidence(method)}
    penalty = F.when(disputed, PENALTY).otherwise(0.0)
    total = sum((WEIGHTS[k] * c for k, c in parts.items()), F.lit(0.0)) - penalty
    total = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.round(total, 2)))
    return F.struct(*[c.alias(k) for k, c in parts.items()], penalty.alias("penalty"), total.alias("total"))
