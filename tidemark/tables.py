"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; only a session on one machine may name none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses; what is written there goes when the driver ends."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read from there: lineage ends, a lost executor repeats nothing before it."""
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete what `stored` wrote and nothing will read again."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            place = context._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
