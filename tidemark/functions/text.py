"""Text, name and address expressions."""

from __future__ import annotations

import unicodedata
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.similar import jaro_winkler_many

#: Legal endings that deduplication deletes, in this order.
LEGAL_ENDINGS = [
    r"\binc\.?\b", r"\bltd\.?\b", r"\bllc\.?\b", r"\bcorp\.?\b", r"\bco\.?\b", r"\bpvt\.?\b",
    r"\bpbc\.?\b", r"\bgmbh\.?\b", r"\bs\.?a\.?\b", r"\bplc\.?\b", r"\bptyltd\.?\b",
]
#: Words that entity resolution ignores.
IGNORED_WORDS = (
    r"\b(inc|incorporated|llc|ltd|limited|corp|corporation|pbc|public\s+benefit\s+corp|gmbh|sa|sas|srl|pty\s+ltd|"
    r"pvt\s+ltd|co|company|technologies|tech|ai|labs?|research)\b"
)
#: Hosts that many records share, and owners that are no accounts.
SHARED_HOSTS = ["huggingface.co", "github.com", "raw.githubusercontent.com", "thataicollection.com"]
RESERVED_OWNERS = ["topics", "explore", "settings", "notifications"]


@F.pandas_udf(T.StringType())
def nfkd(names: pd.Series) -> pd.Series:
    """NFKD form; Spark has no function for it. Meant for distinct names."""
    return names.map(lambda x: unicodedata.normalize("NFKD", x), na_action="ignore")


def decomposed(name: Column) -> Column:
    """NFKD only where a character is not ASCII, so plain names never leave the JVM's fast path alone."""
    return F.when(name.rlike(r"[^\x00-\x7F]"), nfkd(name)).otherwise(name)


def normalize_key(name: Column, decompose: bool = True) -> Column:
    """Key for deduplication: NFKD, lower case, no legal endings, no punctuation but hyphens, single spaces."""
    text = F.lower(decomposed(name) if decompose else name)
    text = F.regexp_replace(text, r"\p{M}", "\u0001")
    text = reduce(lambda x, ending: F.regexp_replace(x, ending, ""), LEGAL_ENDINGS, text)
    text = F.regexp_replace(text, r"[^\p{L}\p{N}_\s-]", "")
    return F.coalesce(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def normalize_name(name: Column, decompose: bool = True) -> Column:
    """Key for entity resolution; unlike normalize_key it also drops industry words, and punctuation parts words."""
    text = F.lower(F.regexp_replace(decomposed(name) if decompose else name, r"\p{M}", ""))
    text = F.regexp_replace(F.replace(text, F.lit("."), F.lit("")), r"[^\p{L}\p{N}_\s]", " ")
    text = F.regexp_replace(text, IGNORED_WORDS, " ")
    return F.coalesce(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def netloc(url: Column) -> Column:
    """Authority of an address in lower case, without any "www."; port and user stay."""
    return F.replace(F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))), F.lit("www."), F.lit(""))


def exact_key(kind: Column, url: Column, name: Column, arxiv_id: Column, paper_url: Column, decompose: bool = True) -> Column:
    """The key that makes two records of one type the same; null if there is none."""
    host, has = netloc(url), lambda c: F.coalesce(c, F.lit("")) != ""
    startup = (
        F.when(has(url) & has(host) & ~host.isin(SHARED_HOSTS), F.concat(F.lit("startup_domain:"), host))
        .when(has(url) & has(host), F.concat(F.lit("startup_url:"), url))
        .when(has(name), F.concat(F.lit("startup_name:"), normalize_key(name, decompose)))
    )
    paper = F.when(has(arxiv_id), F.concat(F.lit("arxiv:"), arxiv_id)).when(has(paper_url), F.concat(F.lit("url:"), paper_url))
    other = F.when(has(url), F.concat(F.lit("url:"), url))
    return F.when(kind == "RESEARCH_PAPER", paper).when(kind == "STARTUP", startup).when(kind.isin("PRODUCT", "JOB", "NEWS"), other)


def record_name(kind: Column, entity: Column, startup: Column, title: Column, company: Column, job_title: Column, url: Column) -> Column:
    """The name that a record is compared by: jobs by company and title, or by address without a title."""
    job = F.when(F.coalesce(job_title, F.lit("")) != "", F.concat_ws(":", company, job_title)).otherwise(url)
    return F.when(kind == "STARTUP", entity).when(kind == "PRODUCT", startup).when(kind.isin("RESEARCH_PAPER", "NEWS"), title).when(kind == "JOB", job)


def block_key(name: Column, kind: Column, decompose: bool = True) -> Column:
    """Record type and the first two characters of the key."""
    return F.concat(kind, F.lit(":"), F.substring(normalize_key(name, decompose), 1, 2))


def content_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def excerpt(text: Column, limit: int = 350) -> Column:
    """The first paragraph, cut at a space near the limit."""
    first = F.split_part(text, F.lit("\n\n"), F.lit(1))
    cut = F.substring(first, 1, limit)
    space = F.length(cut) - F.length(F.substring_index(cut, " ", -1))  # characters up to the last space, with it
    short = F.when(space > 201, F.substring(cut, F.lit(1), space - 1)).otherwise(cut)
    return F.when(F.coalesce(text, F.lit("")) == "", "").when(F.length(first) <= limit, first).otherwise(F.concat(short, F.lit("...")))


def github_repo(url: Column) -> Column:
    """owner/repo of an address; the name loses trailing characters of ".git" one by one. Null if it is none."""
    owner = F.regexp_extract(url, r"github\.com/([^/]+)/([^/\s#?.]+)", 1)
    repo = F.rtrim(F.regexp_extract(url, r"github\.com/([^/]+)/([^/\s#?.]+)", 2), F.lit(".git"))
    return F.when((owner != "") & ~F.lower(owner).isin(RESERVED_OWNERS), F.concat(owner, F.lit("/"), repo))


def github_link(*sources: Column) -> Column:
    """The first repository address in the sources, without trailing punctuation."""
    return F.coalesce(*[F.nullif(F.rtrim(F.regexp_extract(c, r"https?://github\.com/[^\s)\]>]+", 0), F.lit(".,;:")), F.lit("")) for c in sources])


def arxiv_id(url: Column) -> Column:
    """Identifier at the end of an address without its version, or else the address."""
    return F.coalesce(F.nullif(F.regexp_extract(url, r"(\d{4}\.\d{4,5})(v\d+)?$", 1), F.lit("")), url)


def display_name(slug: Column) -> Column:
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


@F.pandas_udf(T.DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity: prefix weight 0.1, at most four characters, only above 0.7."""
    out, there = np.full(len(left), np.nan), (left.notna() & right.notna()).to_numpy()
    out[there] = jaro_winkler_many(left[there].tolist(), right[there].tolist())
    return pd.Series(out).where(there)


#: Where a filter reads the similarity that a column keeps, it is not computed again.
jaro_winkler = jaro_winkler.asNondeterministic()


def _jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken, matched = [False] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                matched.append(ch)
                break
    m = len(matched)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(matched, (ch for j, ch in enumerate(b) if taken[j]), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro


def may_reach(left: Column, right: Column, threshold: float) -> Column:
    """Whether lengths allow the similarity: a bound that filters pairs before the function sees them."""
    short, long = F.least(F.length(left), F.length(right)), F.greatest(F.length(left), F.length(right))
    jaro = (2 + short / F.greatest(long, F.lit(1))) / 3
    return jaro + 0.4 * (1 - jaro) >= threshold
