"""Cosine search over an inverted file: vectors in lists around centroids, stored as a table partitioned by list.

build() fits the centroids on a bounded sample and then places every vector. It also measures, for a sample of them as queries
against all vectors, how many lists must be opened for a recall of TARGET, and stores that number. search() opens the lists nearest to the query only;
the partitions of the others are not read. With probes it is approximate. Without, it is exact: the k-th best score of the
first lists is a floor, and a list is opened as well if the angles of its centroid and of its farthest member allow a better
one. search_many() does the same for a table of queries, approximately, with the stored number of lists.

Vectors that are null, hold null or non-finite components or have no length have no direction and take no part. Repeated
ids are vectors of their own; ties go to the smaller id."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Vectors that the centroids are fitted on, most lists, rounds of fitting, lists that are opened first.
SAMPLE, MOST_LISTS, ROUNDS, FIRST = 65_536, 4096, 10, 4
#: Queries that the recall is measured on, their neighbours, and the share of these that must be found.
ASKED, NEIGHBOURS, TARGET = 64, 10, 0.97
#: Angles are compared with this much room for rounding.
ROOM = 1e-6


def directions(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): doubles of length one of the rows that have a direction."""
    vec = F.col(vec_col).cast("array<double>")
    norm = F.sqrt(F.aggregate(F.transform("vec", lambda x: x * x), F.lit(0.0), lambda a, x: a + x))
    # a null component makes the norm null, an infinite or undefined one makes it infinite or NaN
    rows = vectors.select(F.col(id_col).alias("id"), vec.alias("vec")).withColumn("norm", norm)
    whole = F.col("norm").isNotNull() & (F.col("norm") > 0) & (F.col("norm") < math.inf)
    return rows.where(whole).select("id", F.transform("vec", lambda x: x / F.col("norm")).alias("vec"))


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)


def build(vectors: DataFrame, path: str, id_col: str, vec_col: str, lists: int | None = None, sample: int = SAMPLE, seed: int = 7) -> None:
    """Write path/vectors (list, id, vec) and path/lists (list, centroid, n, least: the least cosine between the centroid and a member)."""
    spark = vectors.sparkSession
    rows = directions(vectors, id_col, vec_col)
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select(array_to_vector("vec").alias("features")).persist()
    try:
        n = chosen.count()
        lists = lists or max(1, min(MOST_LISTS, math.isqrt(rows.count())))
        lists = min(lists, n)
        if lists > 1:
            model = KMeans(k=lists, maxIter=ROUNDS, seed=seed, distanceMeasure="cosine").fit(chosen)
            centers = [c / np.linalg.norm(c) for c in model.clusterCenters()]
            placed = model.transform(rows.withColumn("features", array_to_vector("vec"))).select(F.col("prediction").alias("list"), "id", "vec")
        else:
            centers = [chosen.first().features.toArray()] if n else []
            placed = rows.select(F.lit(0).alias("list"), "id", "vec")
    finally:
        chosen.unpersist()
    # a list of any size is written by as many tasks as it needs
    placed.hint("rebalance", "list").write.mode("overwrite").partitionBy("list").parquet(f"{path}/vectors")
    kind = rows.schema["id"].dataType.simpleString()
    spark.createDataFrame([(kind, 1)], "id_type string, probes int").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")
    stored = members(spark, path)
    centroids = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "list int, centroid array<double>")
    sizes = stored.join(F.broadcast(centroids), "list").groupBy("list").agg(F.first("centroid").alias("centroid"), F.count("*").alias("n"), F.min(dot(F.col("vec"), F.col("centroid"))).alias("least"))
    sizes.coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")
    asked = stored.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(ASKED)
    places = sorted(r.place for r in search_many(asked, path, "id", "vec", NEIGHBOURS, MOST_LISTS).select("place").collect())  # at most ASKED x NEIGHBOURS
    probes = places[math.ceil(TARGET * len(places)) - 1] + 1 if places else 1
    spark.createDataFrame([(kind, probes)], "id_type string, probes int").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")


def lists_of(spark: SparkSession, path: str) -> list[tuple[int, np.ndarray, float]]:
    """(list, centroid, angle of the farthest member) of each list; there are at most MOST_LISTS."""
    return [(r.list, np.array(r.centroid), math.acos(max(-1.0, min(1.0, r.least)))) for r in spark.read.parquet(f"{path}/lists").orderBy("list").collect()]


def members(spark: SparkSession, path: str, lists: list[int] | None = None) -> DataFrame:
    """The vectors of some lists, whose partitions alone are read, or of all."""
    kind = spark.read.parquet(f"{path}/settings").first().id_type
    rows = spark.read.schema(f"id {kind}, vec array<double>, list int").parquet(f"{path}/vectors")
    return rows if lists is None else rows.where(F.col("list").isin([int(x) for x in lists]))


def search(spark: SparkSession, path: str, query: list[float], k: int = 10, probes: int | None = None, round_to: int = 6) -> DataFrame:
    """(id, score) of the k best: of the `probes` nearest lists, or of all vectors if probes is None."""
    q = np.asarray(query, float)
    q = q / np.linalg.norm(q)
    found = sorted(((math.acos(max(-1.0, min(1.0, float(q @ c)))), radius, at) for at, c, radius in lists_of(spark, path)))
    literal = F.array(*[F.lit(float(x)) for x in q])
    score = lambda lists: members(spark, path, lists).select("id", F.round(dot(F.col("vec"), literal), round_to).alias("score")).orderBy(F.desc("score"), "id").limit(k)
    if probes is not None:
        return score([at for *_, at in found[:probes]])
    first = [at for *_, at in found[:FIRST]]
    floor = [r.score for r in score(first).collect()]
    if len(floor) < k:
        return score([at for *_, at in found])
    worst = math.acos(max(-1.0, min(1.0, floor[-1] - 10.0**-round_to))) + ROOM
    return score(first + [at for angle, radius, at in found[FIRST:] if angle - radius <= worst])


def search_many(queries: DataFrame, path: str, id_col: str, vec_col: str, k: int = 10, probes: int | None = None) -> DataFrame:
    """(query, id, score, place, rank): the k best of the `probes` nearest lists (the stored number if None) of every query; place is
    the rank of the list. Queries meet the centroids, which are one
    bounded row, where they are; then they are joined with the vectors of their lists."""
    spark = queries.sparkSession
    if probes is None:
        probes = spark.read.parquet(f"{path}/settings").first().probes
    table = spark.read.parquet(f"{path}/lists").agg(F.collect_list(F.struct("list", "centroid")).alias("lists"))
    asked = directions(queries, id_col, vec_col).withColumnsRenamed({"id": "query", "vec": "q"})
    near = F.transform("lists", lambda c: F.struct((-dot(F.col("q"), c["centroid"])).alias("away"), c["list"].alias("list")))
    asked = asked.join(F.broadcast(table)).select("query", "q", F.posexplode(F.slice(F.array_sort(near), 1, probes)).alias("place", "near")).select("query", "q", "place", F.col("near.list").alias("list"))
    scored = asked.join(members(spark, path), "list").select("query", "id", dot(F.col("q"), F.col("vec")).alias("score"), "place")
    # the limit on the rank also holds before the shuffle, so at most k rows of a query and partition meet
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
