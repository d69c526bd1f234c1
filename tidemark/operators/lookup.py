"""Many names looked up in texts and hosts: entities of a table in one pass, saved searches against arriving records.

Names become an Aho-Corasick automaton, which reads a text once however many names there are. A table of names is dealt into
blocks of a bounded number of names and characters; each block is broadcast and costs one pass. Names and texts are compared in lower
case. Null and empty names are found nowhere, null texts hold nothing."""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names and characters of a block.
NAMES, CHARACTERS = 100_000, 4_000_000
_automata: dict[str, object] = {}


def _automaton(number: str, rows: list[tuple[int, str]]):
    """The automaton of a block; a worker builds it once and keeps the last few."""
    if number not in _automata:
        import ahocorasick

        while len(_automata) >= 4:
            del _automata[next(iter(_automata))]
        by_name: dict[str, list[int]] = {}
        for i, name in rows:
            by_name.setdefault(name.lower(), []).append(i)
        made = ahocorasick.Automaton()
        for name, ids in by_name.items():
            made.add_word(name, (len(name), ids))
        made.make_automaton()
        _automata[number] = made
    return _automata[number]


def _is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _ends(text: str, at: int) -> bool:
    """Whether a word begins or ends before the character at."""
    return (at > 0 and _is_word(text[at - 1])) != (at < len(text) and _is_word(text[at]))


def found_in(texts: DataFrame, text: Column, names: DataFrame, id_col: str, name_col: str, words: bool = True, block: int = NAMES) -> list[Column]:
    """For each block of names a column of the sorted ids of the names that the text holds: anywhere, or with `words` where a word
    begins before them and ends behind them."""
    known = names.where(F.coalesce(F.col(name_col), F.lit("")) != "").select(F.col(id_col).cast("long").alias("i"), F.col(name_col).cast("string").alias("n"))
    size = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("n")), F.lit(0)).alias("c")).first()
    parts = max(1, -(-size.n // block), -(-size.c // CHARACTERS))
    context = texts.sparkSession.sparkContext
    out = []
    for k in range(parts):
        # about `block` names come to the driver
        shared = context.broadcast([(r.i, r.n) for r in known.where(F.pmod(F.xxhash64("i", "n"), F.lit(parts)) == k).collect()])
        if not shared.value:
            continue
        out.append(_finder(shared, uuid.uuid4().hex, words)(text))
    return out


def _finder(shared, number: str, words: bool):
    @F.arrow_udf("array<long>")
    def find(texts: pa.Array) -> pa.Array:
        made = _automaton(number, shared.value)
        # one text at a time leaves the batch, so a worker holds no second copy of it
        return pa.array((_found(made, t.as_py(), words) for t in texts), pa.list_(pa.int64()), size=len(texts))

    return find


def _found(made, text: str | None, words: bool) -> list[int]:
    seen: set[int] = set()
    low = (text or "").lower()
    for end, (length, ids) in made.iter(low):
        if not words or (_ends(low, end + 1) and _ends(low, end + 1 - length)):
            seen.update(ids)
    return sorted(seen)


def mentions(texts: DataFrame, text: str, names: DataFrame, id_col: str = "ordinal", name_col: str = "name", block: int = NAMES) -> DataFrame:
    """texts with an array `mentioned` of the ids of all names that stand in the text as words, in order."""
    columns = found_in(texts, F.col(text), names, id_col, name_col, block=block)
    each = reduce(lambda a, b: F.concat(a, b), columns) if columns else F.array().cast("array<long>")
    return texts.withColumn("mentioned", F.array_sort(each))


def by_host(rows: DataFrame, host: str, table: DataFrame, host_col: str = "host", value_col: str = "company", order: str = "ordinal") -> DataFrame:
    """rows with value_col of the first of the table's hosts (by order) that is the row's host or a parent of it; null if there
    is none. Distinct hosts become their parents, which meet the table in a join, so neither side is bounded."""
    labels = F.split(F.lower("_h"), r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    hosts = rows.select(F.col(host).alias("_h")).where("_h IS NOT NULL").distinct()
    known = table.select(F.lower(host_col).alias("_p"), F.col(value_col).alias("_v"), F.col(order).alias("_o"))
    best = hosts.withColumn("_p", F.explode(parents)).join(known, "_p").groupBy("_h").agg(F.min_by("_v", "_o").alias(value_col))
    return rows.join(best, rows[host] == best["_h"], "left").drop("_h")


def alerts(records: DataFrame, searches: DataFrame, texts: list[Column], kind: str, pricing: Column) -> DataFrame:
    """(search_id, frequency and the columns of records) of every record that a saved search finds.

    searches has search_id, query, kind, pricing and frequency, as search.matches takes them: the query stands somewhere in one of the
    texts, kind is ALL or the record's, pricing holds products only. The searches' queries are what is indexed, so a
    record is read once however many searches there are; what it finds is joined with the searches' other tests. Works on
    streams of records."""
    low = F.concat_ws("\x00", *(F.coalesce(F.lower(t), F.lit("")) for t in texts))  # no query spans two texts
    asked = searches.withColumn("query", F.lower("query")).withColumn("_blank", F.trim(F.coalesce("query", F.lit(""))) == "")
    # a query that many searches share is one name, so a record holds each of its queries once, however many searches ask for it
    terms = asked.where("NOT _blank").groupBy("query").agg(F.min("search_id").cast("long").alias("_term"))
    columns = found_in(records, F.col("_low"), terms, "_term", "query", words=False)
    hits = reduce(lambda a, b: F.concat(a, b), columns) if columns else F.array().cast("array<long>")
    marked = records.withColumns({"_low": low, "_pricing": F.coalesce(pricing, F.lit("UNVERIFIED"))})
    asked = asked.join(terms, "query", "left")
    rules = asked.select("search_id", "_term", F.col("kind").alias("_kind"), F.col("pricing").alias("_asked"), "frequency", "_blank")
    fits = F.col("_kind").isin("ALL") | (F.col("_kind") == F.col(kind))
    priced = (F.col("_asked") == "ALL") | (F.col(kind) != "PRODUCT") | (F.col("_asked") == F.col("_pricing"))
    held = marked.withColumn("_term", F.explode(hits)).join(rules, "_term").where(fits & priced)
    # a search without words finds all records of its kind, which is its result; there is a row per kind that such searches name
    blank = rules.where("_blank").groupBy("_kind").agg(F.collect_list(F.struct("search_id", "_asked", "frequency")).alias("_all"))
    every = marked.join(blank, fits).withColumn("_s", F.explode("_all")).select("*", "_s.*").where(priced)
    columns = ["search_id", "frequency", *records.columns]
    return held.select(*columns).unionByName(every.select(*columns))


def alert_counts(records: DataFrame, searches: DataFrame, texts: list[Column], kind: str, pricing: Column, id_col: str) -> DataFrame:
    """(search_id, frequency, n, first): how many records each saved search finds and the least id of them; searches that find none
    have no row.

    Searches that ask the same find the same, so records are counted once for each distinct test (query, kind, pricing) and
    the searches then take the counts of theirs: rows follow records and tests, not records times searches."""
    tests = [F.when(F.trim(F.coalesce("query", F.lit(""))) == "", "").otherwise(F.lower("query")).alias("query"), "kind", "pricing"]
    distinct = searches.select("search_id", *tests).groupBy("query", "kind", "pricing").agg(F.min("search_id").alias("search_id"), F.lit(None).cast("string").alias("frequency"))
    found = alerts(records, distinct, texts, kind, pricing).groupBy(F.col("search_id").alias("_test")).agg(F.count("*").alias("n"), F.min(id_col).alias("first"))
    counted = distinct.join(found, distinct["search_id"] == found["_test"]).select(*(F.col(c).alias(f"_{c}") for c in ("query", "kind", "pricing")), "n", "first")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("query", "kind", "pricing")]
    return searches.select("search_id", "frequency", *tests).join(counted, same).select("search_id", "frequency", "n", "first")
