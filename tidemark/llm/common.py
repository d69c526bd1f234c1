"""Shared pieces: lineage cuts in the cluster's shared folder, and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the one that the session names in spark.checkpoint.dir. Only a
    single-machine session that names none gets a temporary folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """df from the shared folder, without lineage; for small or quickly replaced tables."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Whether the shuffle files of a query go as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: columnar and compressed, so reads take only the columns they
    need. The shuffle files behind it go at once; the table goes by `discard`, or when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that `saved` wrote and nothing will read again."""
    for table in tables:
        for file in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            place = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
            place.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: Bits of a bitmap for each key, and the least and the most bits in all: at most 64 MB are broadcast.
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 8, 1 << 16, 1 << 28


def _among(rows: DataFrame, keys: DataFrame, columns: list[str], wanted: bool) -> DataFrame:
    """The rows whose columns may be among those of keys, or the others. Working columns have names that no row has."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_KEY * keys.count()).bit_length()))
    b, w, m = (f"{c}_{uuid.uuid4().hex}" for c in "bwm")
    place = f"pmod(xxhash64({', '.join(f'`{c}`' for c in columns)}), {bits})"
    words = keys.select(F.expr(place).alias(b)).groupBy(F.shiftright(b, 6).alias(w)).agg(F.expr(f"bit_or(shiftleft(1L, CAST({b} & 63 AS INT)))").alias(m))
    placed = rows.withColumn(b, F.expr(place)).withColumn(w, F.shiftright(b, 6))
    test = F.expr(f"shiftrightunsigned(coalesce({m}, 0L), CAST({b} & 63 AS INT)) & 1 = {int(wanted)}")
    return placed.join(F.broadcast(words), w, "inner" if wanted else "left").where(test).drop(b, w, m)


def maybe_among(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose columns may be among those of keys: a filter before a shuffle, to be followed by the join.

    The keys, a table that is cheap to read twice, become a bitmap, whose words are the only thing broadcast. It has
    BITS_PER_KEY bits for each key and never more than MOST_BITS; a fuller bitmap lets more rows pass, and no row of
    keys is ever lost."""
    return _among(rows, keys, columns, True)


def surely_not_among(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """All other rows."""
    return _among(rows, keys, columns, False)


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) of every node of edges (u, v); component is the smallest node reachable.

    Alternates the large-star and the small-star step, which contract any component to a star in a
    number of rounds that grows with the logarithm of its size. Each step groups with a map-side
    minimum and joins it back, so a node with very many neighbours is an ordinary skewed join.
    Self-loops and repeated edges are ignored; no edges give no rows."""
    edges = checkpoint(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if (state.n, state.x) == before or not state.n:
            break
        before = (state.n, state.x)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = checkpoint(small)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


#: A key with more than 1/HOT of the rows is hot: there can be at most HOT such keys.
HOT = 256


def hot_rows(facts: DataFrame, count_col: str, hot: int = HOT, total: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(hot, others) of facts, a table that is cheap to read twice and has one row for each key and the number of rows with
    that key in count_col. At most `hot` rows have more than 1/hot of the sum, which is `total` if that is known already, so the
    first table can be broadcast at any size."""
    total = facts.agg(F.sum(count_col)).first()[0] or 0 if total is None else total
    is_hot = F.col(count_col) * hot > total
    return facts.where(is_hot), facts.where(~is_hot)


def look_up(rows: DataFrame, facts: DataFrame, keys: list[str], count_col: str, hot: int = HOT, total: int | None = None) -> DataFrame:
    """The rows whose keys facts holds, with the columns of facts but count_col. Both are cheap to read twice.

    Hot keys (see hot_rows) meet their rows where these are, by a broadcast of at most `hot` rows; only the rows of other
    keys, each less than 1/hot of all, are shuffled."""
    few, others = hot_rows(facts, count_col, hot, total)
    there = rows.join(F.broadcast(few.drop(count_col)), keys)
    rest = rows.join(F.broadcast(few.select(*keys)), keys, "left_anti").join(others.drop(count_col), keys)
    return there.unionByName(rest)


def dense_names(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """Per distinct keys of rows: name, a number from 0 without gaps, and n, its rows; and the number of all rows. The table is
    written before anything reads it, so a lost executor never changes a name. One row for each partition comes to the driver."""
    found = saved(rows.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)  # monotonically_increasing_id puts the partition above 33 bits
    sizes = sorted((r.part, r.names, r.rows) for r in found.groupBy(part.alias("part")).agg(F.count("*").alias("names"), F.sum("n").alias("rows")).collect())
    starts, start = [], 0
    for at, names, _ in sizes:
        starts.append((at, start - (at << 33)))
        start += names
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "_part long, _start long"))
    return found.join(starts, part == F.col("_part")).select(*keys, "n", (F.col("_at") + F.col("_start")).alias("name")), sum(r for _, _, r in sizes)


def running(rows: DataFrame, group: str, order: list[Column], value: str) -> tuple[DataFrame, DataFrame]:
    """(rows with `before`: the sum of value in earlier rows of their group, runs: (group, part, total) for each group and partition).

    Rows are dealt by ranges of group and order, so a group of any size spreads over many partitions. Sums within a partition
    and sums of whole partitions make up the result; a window never holds more than a partition's rows of a group, or more rows
    than there are partitions."""
    place = saved(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id()))
    place = place.withColumn("part", F.shiftright("_at", 33))
    runs = place.groupBy(group, "part").agg(F.sum(value).alias("total"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = saved(runs.withColumn("_start", F.coalesce(F.sum("total").over(earlier), F.lit(0))))
    inside = Window.partitionBy(group, "part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    summed = place.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(runs.drop("total"), [group, "part"])
    return summed.withColumn("before", F.col("_inside") + F.col("_start")).drop("_at", "_inside", "_start", "part"), runs.drop("_start")
