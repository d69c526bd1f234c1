"""Searches and relationship hops."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import search as ops
from tidemark.operators import lookup, text_index, vector_index
from tidemark.plans.core import typed
from tidemark.plans.registry import query
from tidemark.sources.readers import table
from tidemark.tables import fresh_path


def _columns():
    kind = F.col("kind")
    return {
        "type": kind,
        "pricing": F.when(F.col("doc_id") % 4 == 0, "FREE").when(F.col("doc_id") % 4 == 1, "PAID"),
        "entity": F.when(kind == "STARTUP", F.col("source")),
        "title": F.when(kind.isin("RESEARCH_PAPER", "NEWS"), F.substring("text", 1, 60)),
        "company": F.when(kind == "JOB", F.col("source")),
        "full_text": F.when(kind == "NEWS", F.col("text")),
        "startup": F.when(kind == "PRODUCT", F.substring("text", 1, 20)),
        "source": F.col("lang"),
        "authors": F.when(kind == "RESEARCH_PAPER", F.slice(F.split("text", " "), 1, 3)).otherwise(F.lit(None).cast("array<string>")),
    }


_REC = """WITH r AS (SELECT doc_id, ['STARTUP', 'PRODUCT', 'RESEARCH_PAPER', 'JOB', 'NEWS'][CAST(doc_id % 5 AS INT) + 1] AS kind, * EXCLUDE (doc_id) FROM documents),
  f AS (SELECT doc_id, kind, CASE WHEN doc_id % 4 = 0 THEN 'FREE' WHEN doc_id % 4 = 1 THEN 'PAID' END AS pricing,
    lower(coalesce(CASE WHEN kind IN ('STARTUP', 'JOB') THEN source WHEN kind IN ('RESEARCH_PAPER', 'NEWS') THEN substring(text, 1, 60) END, '')) AS title,
    lower(coalesce(CASE WHEN kind = 'NEWS' THEN nullif(text, '') WHEN kind = 'PRODUCT' THEN nullif(substring(text, 1, 20), '') END, lang)) AS body,
    lower(coalesce(CASE WHEN kind = 'RESEARCH_PAPER' THEN array_to_string(list_slice(string_split(text, ' '), 1, 3), ' ') END, '')) AS authors FROM r)
"""


@query("search_records", _REC + "SELECT doc_id, kind FROM f WHERE contains(title, 'the ') OR contains(body, 'the ') OR contains(authors, 'the ')")
def search_records(spark, sf):
    return typed(spark, sf).where(ops.matches("The ", "ALL", "ALL", _columns())).select("doc_id", "kind")


@query("search_pricing", _REC + "SELECT doc_id, kind FROM f WHERE kind <> 'PRODUCT' OR coalesce(pricing, 'UNVERIFIED') = 'UNVERIFIED'")
def search_pricing(spark, sf):
    return typed(spark, sf).where(ops.matches("  ", "ALL", "UNVERIFIED", _columns())).select("doc_id", "kind")


@query("search_by_type", _REC + "SELECT doc_id, kind FROM f WHERE kind = 'NEWS' AND (contains(title, 'der') OR contains(body, 'der') OR contains(authors, 'der'))")
def search_by_type(spark, sf):
    return typed(spark, sf).where(ops.matches("der", "NEWS", "ALL", _columns())).select("doc_id", "kind")


_ASKED, _KINDS = ["the ", "DER", "  ", "en", "la ", "zz", "un", "Web", "crawl", "de"], ["ALL", "NEWS", "PRODUCT", "JOB", "STARTUP", "RESEARCH_PAPER"]


@query(
    "saved_search_alerts",
    _REC + f""", a AS (SELECT s_suppkey AS search_id, lower({_ASKED!r}[CAST(s_suppkey % 10 AS INT) + 1]) AS q, {_KINDS!r}[CAST(s_suppkey % 6 AS INT) + 1] AS k, ['ALL', 'FREE', 'UNVERIFIED'][CAST(s_suppkey % 3 AS INT) + 1] AS p, ['INSTANT', 'DAILY'][CAST(s_suppkey % 2 AS INT) + 1] AS frequency FROM supplier)
    SELECT search_id, frequency, count(*) AS n, min(doc_id) AS first_doc FROM a JOIN f ON (k = 'ALL' OR k = kind) AND (p = 'ALL' OR kind <> 'PRODUCT' OR coalesce(pricing, 'UNVERIFIED') = p)
      AND (trim(q) = '' OR contains(title, q) OR contains(body, q) OR contains(authors, q)) GROUP BY ALL""",
)
def saved_search_alerts(spark, sf):
    """Every supplier has saved a search; each record is read once and finds the searches."""
    i, pick = F.col("s_suppkey"), lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("s_suppkey") % len(values) + 1).cast("int"))
    searches = table(spark, sf, "supplier").select(i.alias("search_id"), pick(_ASKED).alias("query"), pick(_KINDS).alias("kind"), pick(["ALL", "FREE", "UNVERIFIED"]).alias("pricing"), pick(["INSTANT", "DAILY"]).alias("frequency"))
    c = _columns()
    return lookup.alert_counts(typed(spark, sf), searches, ops.searched(c), "kind", c["pricing"], "doc_id").withColumnRenamed("first", "first_doc")


TERMS = ["thing", "worthless", "nicht", "pour"]
_BM25 = rf"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents),
  n AS (SELECT count(*) AS n, avg(len(w)) AS a FROM w), t AS (SELECT doc_id, len(w) AS len, unnest(list_filter(w, lambda x: x IN ({', '.join(f"'{t}'" for t in TERMS)}))) AS term FROM w),
  tf AS (SELECT doc_id, len, term, count(*) AS tf FROM t GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  s AS (SELECT doc_id, round(sum(ln(1 + (n.n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / n.a))), 6) AS score FROM tf JOIN df USING (term), n GROUP BY doc_id)
"""


def _lexical(spark, sf):
    return ops.bm25(table(spark, sf, "documents"), TERMS, "doc_id", "text")


@query("lexical_topk", _BM25 + "SELECT doc_id, score FROM s ORDER BY score DESC, doc_id LIMIT 50")
def lexical_topk(spark, sf):
    return _lexical(spark, sf).orderBy(F.desc("score"), "doc_id").limit(50)


_VECTOR = [round(((i * 37) % 19 - 9) / 10, 1) for i in range(64)]
_COSINE = f"WITH c AS (SELECT vec_id AS doc_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST([{', '.join(map(str, _VECTOR))}] AS DOUBLE[])), 6) AS score FROM embeddings)"


def _semantic(spark, sf):
    return ops.cosine(table(spark, sf, "embeddings"), _VECTOR, "vec_id", "embedding").withColumnRenamed("vec_id", "doc_id")


@query("cosine_topk", _COSINE + " SELECT doc_id AS vec_id, score FROM c ORDER BY score DESC, doc_id LIMIT 50")
def cosine_topk(spark, sf):
    return _semantic(spark, sf).orderBy(F.desc("score"), "doc_id").limit(50).withColumnRenamed("doc_id", "vec_id")


@query("indexed_lexical_topk", _BM25 + "SELECT doc_id, score FROM s ORDER BY score DESC, doc_id LIMIT 50")
def indexed_lexical_topk(spark, sf):
    """As lexical_topk, from postings that are written first."""
    path = fresh_path(spark)
    text_index.build(table(spark, sf, "documents"), path, "doc_id", "text")
    return text_index.search(spark, path, TERMS, 50).withColumnRenamed("id", "doc_id")


@query("indexed_cosine_topk", _COSINE + " SELECT doc_id AS vec_id, score FROM c ORDER BY score DESC, doc_id LIMIT 50")
def indexed_cosine_topk(spark, sf):
    """As cosine_topk, from lists of vectors that are written first; only lists that may hold one of the best are read."""
    path = fresh_path(spark)
    vector_index.build(table(spark, sf, "embeddings"), path, "vec_id", "embedding")
    return vector_index.search(spark, path, _VECTOR, 50).withColumnRenamed("id", "vec_id")


@query(
    "rrf_hybrid",
    _BM25.rstrip() + ", " + _COSINE[5:] + ", a AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM s), b AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM c), "
    "u AS (SELECT * FROM a WHERE k <= 100 UNION ALL SELECT * FROM b WHERE k <= 100) SELECT doc_id, round(sum(1.0::DOUBLE / (60 + k)), 8) AS score FROM u GROUP BY doc_id",
)
def rrf_hybrid(spark, sf):
    """The hundred best of either list, fused; the lists are bounded, so their ranks come from one small window each."""
    from pyspark.sql import Window

    ranked = lambda df: df.orderBy(F.desc("score"), "doc_id").limit(100).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "doc_id")))
    return ops.rrf([ranked(_lexical(spark, sf)), ranked(_semantic(spark, sf))], "doc_id")


@query(
    "graph_hops",
    """WITH RECURSIVE e AS (SELECT 'c' || c_nationkey AS src, 'n' || n_nationkey AS dst FROM (SELECT DISTINCT c_nationkey FROM customer) JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation),
  w AS (SELECT 'c0' AS node, 0 AS hops UNION SELECT e.dst, w.hops + 1 FROM w JOIN e ON e.src = w.node WHERE w.hops < 3) SELECT node, min(hops) AS hops FROM w GROUP BY node""",
)
def graph_hops(spark, sf):
    name = lambda p, c: F.concat(F.lit(p), F.col(c))
    nation = table(spark, sf, "nation")
    up = nation.select(name("n", "n_nationkey").alias("src"), name("r", "n_regionkey").alias("dst"))
    owners = table(spark, sf, "customer").select("c_nationkey").distinct().select(name("c", "c_nationkey").alias("src"), name("n", "c_nationkey").alias("dst"))
    edges = up.union(up.select("dst", "src")).union(owners)
    return ops.hops(edges, spark.createDataFrame([("c0",)], "node string"), 3)
