"""Language of pages by Bayesian fusion of evidence.

Four kinds of evidence are multiplied: the likelihood of the page's text under character-trigram models (counted per
language over all labelled documents), the language that the markup declares, the suffix of the address, and a
prior for the host. The tables for declarations, suffixes and hosts are grouped sums of the text evidence over all
pages, so no page is labelled by hand. A host's prior leans on its registered domain's, and that one on the prior of all pages
(Dirichlet smoothing at either level); a page's own text evidence is taken out of its host's and domain's counts.

The text likelihood is tempered by a power that grows slower than the text, since trigrams are far from independent.

The model has BUCKETS trigram buckets for every language of the labelled documents, 128 KB each, and is broadcast, so memory
grows with the number of languages. Hosts and suffixes are grouped with map-side sums and joined back as ordinary skewed joins.

Pages with null or empty HTML have only the other evidence; a null address has none from host or suffix. Without
any labelled document the language is null. Repeated rows each have a row; null ids are kept; extra columns are ignored;
empty tables give empty results."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

#: Trigram buckets, languages that a task counts before it passes them on, and pseudo-counts of the smoothing: trigrams, hosts and domains, declarations and suffixes.
BUCKETS, HELD, GRAM_PRIOR, HOST_PRIOR, TABLE_PRIOR = 1 << 15, 256, 0.5, 8.0, 20.0
#: Share of a fresh declaration that is right, before any is counted.
DECLARED_RIGHT = 0.9

UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[^>]*>?", re.DOTALL | re.IGNORECASE)
#: Parts of a declaration, searched one after the other inside one tag.
HTML, LANG, META, CONTENT_LANGUAGE, CONTENT = (
    re.compile(x, re.IGNORECASE)
    for x in (r"<html\b", r"\b(?:xml:)?lang\s*=\s*[\"']?\s*([a-zA-Z]{2,3})", r"<meta\b", "content-language", r"content\s*=\s*[\"']?\s*([a-zA-Z]{2,3})")
)
ADDRESS = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", re.IGNORECASE)
NOT_LETTERS = re.compile(r"[\W\d_]+")


def grams(text: str) -> np.ndarray:
    """Buckets of the character trigrams of the words, in lower case, with a space on either side."""
    flat = " " + NOT_LETTERS.sub(" ", text.lower()) + " "
    c = np.frombuffer(flat.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    h = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1] * np.uint64(0x85EBCA77) + c[2:] * np.uint64(0xC2B2AE3D)) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(40)).astype(np.int64) % BUCKETS


def declaration(source: str) -> str | None:
    """The first language that an html or meta tag declares, wherever in the page; comments, scripts and styles do
    not count. A tag is searched from its first html or meta on only, so the work is linear."""
    for m in UNSEEN.finditer(source):
        tag = m.group()
        if m.group(1) or tag.startswith("<!--"):
            continue
        said = None
        if start := HTML.search(tag):
            said = LANG.search(tag, start.end())
        if not said and (start := META.search(tag)) and (start := CONTENT_LANGUAGE.search(tag, start.end())):
            said = CONTENT.search(tag, start.end())
        if said:
            return said.group(1).lower()
    return None


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """Host, registered domain (its last two labels) and suffix."""
    m = ADDRESS.match((url or "").strip())
    if not m:
        return None, None, None
    host = m.group(1).lower().strip(".")
    labels = host.split(".")
    return host, ".".join(labels[-3:-1] + labels[-1:]) if len(labels) > 2 else host, labels[-1]


def trigram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, b, n): how often a language has trigrams of a bucket, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                sums = total.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))
                text = text.as_py()
                for at in range(0, len(text), 1 << 20):
                    found, n = np.unique(grams(text[at : at + (1 << 20)]), return_counts=True)
                    sums[found] += n
            if len(total) > HELD:
                yield from flush(total)
                total = {}
        yield from flush(total)

    def flush(total: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, sums in total.items():
            b = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(b), pa.string()), pa.array(b.astype(np.int32)), pa.array(sums[b])], names=["lang", "b", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("t"), F.lower(F.trim(F.col(lang_col).cast("string"))).alias("l")).where("t IS NOT NULL AND l <> ''")
    return rows.mapInArrow(run, "lang string, b int, n long").groupBy("lang", "b").agg(F.sum("n").alias("n"))


def text_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages, and the logarithm of each bucket's chance by language (rows are buckets)."""
    counts = trigram_counts(docs, text_col, lang_col).groupBy("lang").agg(F.collect_list(F.struct("b", "n")).alias("c"))
    chances: dict[str, np.ndarray] = {}
    # a row has at most BUCKETS counts
    for r in counts.select("lang", "c.b", "c.n").toLocalIterator():
        sums = np.full(BUCKETS, GRAM_PRIOR)
        sums[r.b] += r.n
        chances[r.lang] = np.log(sums / sums.sum()).astype(np.float32)
    langs = sorted(chances)
    return langs, np.stack([chances[x] for x in langs], axis=1) if langs else np.zeros((BUCKETS, 0), np.float32)


def evidence(pages: DataFrame, langs: list[str], table: np.ndarray, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """id, host, domain, suffix, declared, and text (array<double>): normalised likelihoods by language."""
    kind = pages.select(id_col).schema[0].dataType.simpleString()
    shared = pages.sparkSession.sparkContext.broadcast(table)
    known = set(langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: dict[str, list] = {c: [] for c in ("host", "domain", "suffix", "declared", "text")}
            for url, source in zip(batch.column(1), batch.column(2), strict=True):
                source = source.as_py() or ""
                said = declaration(source)
                host, domain, suffix = address(url.as_py())
                found = grams(html.unescape(UNSEEN.sub(" ", source)))
                sums = shared.value[found].sum(axis=0, dtype=np.float64)
                if len(found) <= 2:
                    sums = np.zeros(len(langs))
                sums = (sums - sums.max()) / max(1.0, len(found) ** 0.5 / 2)
                likely = np.exp(np.maximum(sums, -60.0))
                for c, x in zip(cols, (host, domain, suffix, said if said in known else None, (likely / likely.sum()).tolist()), strict=True):
                    cols[c].append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.list_(pa.float64()) if c == "text" else pa.string()) for c, x in cols.items())], names=["id", *cols])

    rows = pages.select(F.col(id_col), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return rows.mapInArrow(run, f"id {kind}, host string, domain string, suffix string, declared string, text array<double>")


def _sums(n: int) -> F.Column:
    return F.array(*[F.sum(F.col("text")[i]) for i in range(n)]).alias("sums")


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row of pages: id_col, lang, probability and text_lang (the language by text alone)."""
    langs, table = text_model(docs, text_col, lang_col)
    if not langs:
        none = F.lit(None)
        return pages.select(id_col, none.cast("string").alias("lang"), none.cast("double").alias("probability"), none.cast("string").alias("text_lang"))
    n = len(langs)
    facts = saved(evidence(pages, langs, table, id_col, url_col, html_col))
    by_host = facts.where("host IS NOT NULL").groupBy("host", "domain").agg(_sums(n))
    by_domain = by_host.groupBy("domain").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(n)]).alias("domain_sums"))
    # one row, one for each language, and one row
    whole = facts.agg(_sums(n)).first().sums or [0.0] * n
    declared = {r.declared: r.sums for r in facts.where("declared IS NOT NULL").groupBy("declared").agg(_sums(n)).collect()}
    by_suffix = facts.where("suffix IS NOT NULL").groupBy("suffix").agg(_sums(n))
    suffix_whole = facts.where("suffix IS NOT NULL").agg(_sums(n)).first().sums
    prior = (np.array([x or 0.0 for x in whole]) + 1) / (sum(x or 0.0 for x in whole) + n)
    said = np.array([declared.get(x, [0.0] * n) for x in langs])  # declared x language
    right = np.full((n, n), (1 - DECLARED_RIGHT) / max(1, n - 1))
    np.fill_diagonal(right, DECLARED_RIGHT if n > 1 else 1.0)
    said = (said + TABLE_PRIOR * right) / (said.sum(axis=0) + TABLE_PRIOR)
    total = np.array([x or 0.0 for x in suffix_whole])
    log_said = {x: np.log(said[i]).tolist() for i, x in enumerate(langs)}
    kind = pages.select(id_col).schema[0].dataType.simpleString()

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, chance, plain = [], [], []
            for row in batch.select(["declared", "suffix_sums", "text", "sums", "domain_sums"]).to_pylist():
                text = np.array(row["text"])
                p = prior
                for name in ("domain_sums", "sums"):
                    if row[name] is not None:
                        others = np.maximum(np.array(row[name]) - text, 0)
                        p = (others + HOST_PRIOR * p) / (others.sum() + HOST_PRIOR)
                z = np.log(np.maximum(text, 1e-30)) + np.log(p)
                z += log_said.get(row["declared"], 0.0)
                if row["suffix_sums"] is not None:
                    x = np.array(row["suffix_sums"])
                    z += np.log((x + TABLE_PRIOR * (x.sum() + 1) / (total.sum() + 1)) / (total + TABLE_PRIOR))
                e = np.exp(z - z.max())
                i = int(np.argmax(e))
                best.append(langs[i])
                chance.append(float(e[i] / e.sum()))
                plain.append(langs[int(np.argmax(text))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best, pa.string()), pa.array(chance, pa.float64()), pa.array(plain, pa.string())], names=[id_col, "lang", "probability", "text_lang"])

    joined = facts.join(by_host.join(by_domain, "domain").select("host", "sums", "domain_sums"), "host", "left")
    joined = joined.join(by_suffix.withColumnRenamed("sums", "suffix_sums"), "suffix", "left")
    return joined.select("id", "declared", "suffix_sums", "text", "sums", "domain_sums").mapInArrow(fuse, f"{id_col} {kind}, lang string, probability double, text_lang string")
