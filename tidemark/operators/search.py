"""Search over records: substring, lexical, vector, fused; and hops over relationships."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import first_filled

#: Published defaults of BM25 and of reciprocal rank fusion.
K1, B, RRF_K = 1.2, 0.75, 60


def matches(query: str, kind: str, pricing: str, c: dict[str, Column]) -> Column:
    """Whether a record passes the type, pricing and substring filters. The blank test trims, the match does not; pricing holds
    products only."""
    test = F.lit(True) if kind == "ALL" else c["type"] == kind
    if pricing != "ALL":
        test = test & ((c["type"] != "PRODUCT") | (F.coalesce(c["pricing"], F.lit("UNVERIFIED")) == pricing))
    if query.strip():
        low = query.lower()
        test = test & reduce(lambda a, b: a | b, [F.coalesce(F.lower(t), F.lit("")).contains(low) for t in searched(c)])
    return test


def searched(c: dict[str, Column]) -> list[Column]:
    """The texts of a record that a query may stand in."""
    return [first_filled(c["entity"], c["title"], c["company"]), first_filled(c["full_text"], c["startup"], c["source"]), F.array_join(c["authors"], " ")]


def bm25(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """(id_col, score) of the documents that hold a term. Words are counted by a pattern; only documents that a term's letters
    occur in are split into words, and only the query's terms are exploded."""
    low = F.lower(text_col)
    total = docs.select(F.regexp_count(F.col(text_col), F.lit(r"[\p{L}\p{N}]+")).alias("len")).agg(F.count("*").alias("n"), F.avg(F.coalesce("len", F.lit(-1))).alias("avg_len"))
    may_hold = reduce(lambda a, b: a | b, (low.contains(t) for t in terms), F.lit(False))
    words = docs.where(may_hold).select(F.col(id_col).alias("d"), F.filter(F.split(low, r"[^\p{L}\p{N}]+"), lambda w: w != "").alias("w"))
    words = words.select("d", F.size("w").alias("len"), F.filter("w", lambda w: w.isin(terms)).alias("hits"))
    tf = words.where(F.size("hits") > 0).select("d", "len", F.explode("hits").alias("term")).groupBy("d", "len", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    # df has a row per query term, total has one row
    scored = tf.join(F.broadcast(df), "term").join(F.broadcast(total))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len")))
    return scored.groupBy(F.col("d").alias(id_col)).agg(F.round(F.sum(part), 6).alias("score"))


def cosine(table: DataFrame, query: list[float], id_col: str, vec_col: str) -> DataFrame:
    """(id_col, score): cosine similarity to one query vector."""
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = F.aggregate(F.zip_with(F.col(vec_col).cast("array<double>"), q, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    norm = lambda v: F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda a, x: a + x))
    return table.select(id_col, F.round(dot / (norm(F.col(vec_col).cast("array<double>")) * norm(q)), 6).alias("score"))


def rrf(lists: list[DataFrame], id_col: str) -> DataFrame:
    """(id_col, score) of ranked lists (id_col, rank): the sum of 1 / (k + rank)."""
    every = reduce(DataFrame.unionByName, [x.select(id_col, "rank") for x in lists])
    return every.groupBy(id_col).agg(F.round(F.sum(1.0 / (RRF_K + F.col("rank"))), 8).alias("score"))


def hops(edges: DataFrame, start: DataFrame, most: int) -> DataFrame:
    """(node, hops): nodes within that many hops of start (node), with the fewest hops."""
    seen = start.select("node").distinct().withColumn("hops", F.lit(0))
    front = seen
    for k in range(1, most + 1):
        front = front.join(edges, front.node == edges.src).select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("hops", F.lit(k))
        seen = seen.unionByName(front)
    return seen
