"""Bodies kept once in files of their own, by the digest of their content; tables keep pointers.

The store is a Parquet table partitioned by the first two digits of the digest. Null bodies have no pointer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "digest string, body string, part string"


def digest(body: Column) -> Column:
    return F.sha2(body.cast("binary"), 256)


def bodies(spark: SparkSession, path: str) -> DataFrame:
    """The store; a store that nothing has been written to is empty."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def offload(rows: DataFrame, body: str, path: str) -> DataFrame:
    """rows with content_hash and body_uri in place of body; bodies that the store lacks are written, each once.

    Running it again writes nothing. Bodies that two writers add at once may be stored twice, which `restored` allows for."""
    spark = rows.sparkSession
    found = rows.where(F.col(body).isNotNull()).select(digest(F.col(body)).alias("digest"), F.col(body).cast("string").alias("body"))
    new = found.dropDuplicates(["digest"]).join(bodies(spark, path).select("digest"), "digest", "left_anti")
    new.withColumn("part", F.substring("digest", 1, 2)).hint("rebalance", "part").write.mode("append").partitionBy("part").parquet(path)
    uri = F.concat(F.lit(f"{path}/part="), F.substring("content_hash", 1, 2), F.lit("#"), "content_hash")
    return rows.withColumn("content_hash", digest(F.col(body))).withColumn("body_uri", uri).drop(body)


def restored(rows: DataFrame, path: str, body: str = "body") -> DataFrame:
    """rows with the bodies that content_hash points to; null where the store has none."""
    held = bodies(rows.sparkSession, path).select(F.col("digest").alias("content_hash"), F.col("body").alias(body), F.col("part").alias("_part")).dropDuplicates(["content_hash"])
    return rows.withColumn("_part", F.substring("content_hash", 1, 2)).join(held, ["content_hash", "_part"], "left").drop("_part")
