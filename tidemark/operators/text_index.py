"""Full text search over stored postings, by BM25.

build() writes postings by term: for each term and segment of documents a row with the documents, how often each holds the term
and how long it is, and two bounds (most occurrences, least length). Rows are partitioned by a bucket of the term and sorted by
it, so a query reads the row groups of its own terms. A new batch of documents is a new part of the table; document counts and
lengths are kept by batch, so scores always follow all batches.

search() first reads the bounds alone. They give the most that a document of a segment can score. The best segments are read
and their k-th score is a floor; only segments that may reach it are read after that. Results are exact.

Null texts count as documents without words and have no length. Rows that repeat an id and a length are one document. Words are
runs of letters and digits in lower case; a term that is no such word finds nothing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.search import K1, B

#: Documents of a segment on average, buckets of terms, segments that are read first.
SEGMENT, BUCKETS, FIRST = 1024, 64, 8
#: Words that one task counts, on average, and postings that it hands on at once.
TASK_WORDS, BATCH = 4_000_000, 10_000
#: Scores are compared with this much room for rounding.
ROOM = 1e-6


def bucket(term: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def build(docs: DataFrame, path: str, id_col: str, text_col: str, batch: int = 0, segment: int = SEGMENT, buckets: int = BUCKETS) -> None:
    """Write the postings of one batch; writing a batch again replaces it.

    Texts are dealt by segment, once; a task holds its segments whole, counts their words and writes their postings by bucket. So the
    disk holds the texts once and the postings, and neither words nor postings are shuffled."""
    text = F.col(text_col).cast("string")
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    length = F.regexp_count(F.lower(text), F.lit(r"[\p{L}\p{N}]+"))
    sizes = docs.select(length.alias("len")).agg(F.lit(kind).alias("id_type"), F.count("*").alias("n"), F.count("len").alias("texts"), F.coalesce(F.sum("len"), F.lit(0)).cast("long").alias("words"))
    sizes.write.mode("overwrite").parquet(f"{path}/sizes/batch={batch}")
    total = docs.sparkSession.read.parquet(f"{path}/sizes/batch={batch}").first()
    # documents are spread over segments by a hash: a segment's postings of a term are bounded whatever the term
    segments = max(1, -(-total.n // segment))
    rows = docs.select(F.col(id_col).alias("d"), words(text).alias("w")).select("d", F.size("w").alias("len"), F.array_join("w", " ").alias("w")).where("len > 0")
    tasks = max(1, min(segments, -(-total.words // TASK_WORDS)))
    dealt = rows.withColumn("segment", F.pmod(F.xxhash64("d", "len"), F.lit(segments)).cast("int")).repartition(tasks, "segment")
    postings = dealt.mapInArrow(_counted, f"term string, segment int, docs array<struct<d:{kind},tf:int,len:int>>, n int, most int, least int")
    postings = postings.withColumn("bucket", bucket(F.col("term"), buckets))
    postings.sortWithinPartitions("bucket", "term", "segment").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings/batch={batch}")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of whole segments of documents (d, len, w, segment); w has the words, parted by spaces."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches).combine_chunks()
    d, len_, segment = rows["d"].combine_chunks(), rows["len"].to_numpy(), rows["segment"].to_numpy()
    # rows of one id and length are one document; documents are numbered by segment, id and length
    place = pc.rank(d, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
    _, first, doc = np.unique(np.stack([segment, place, len_], axis=1).astype(np.int64), axis=0, return_index=True, return_inverse=True)
    texts = pc.split_pattern(rows["w"].combine_chunks(), " ")
    terms = texts.flatten().dictionary_encode()
    own = np.repeat(doc.reshape(-1), pc.list_value_length(texts).to_numpy(zero_copy_only=False))
    _, number = np.unique(segment[first], return_inverse=True)
    held, found = len(terms.dictionary), len(first)
    key = (number[own].astype(np.int64) * held + terms.indices.to_numpy(zero_copy_only=False)) * found + own
    key, tf = np.unique(key, return_counts=True)
    group, doc = np.divmod(key, found)
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    ends = np.append(starts, len(key)).astype(np.int32)
    at, tf, lengths = first[doc], tf.astype(np.int32), len_[first[doc]].astype(np.int32)
    docs = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([d.take(pa.array(at)), pa.array(tf), pa.array(lengths)], names=["d", "tf", "len"]))
    columns = {
        "term": terms.dictionary.take(pa.array(group[starts] % held)),
        "segment": pa.array(segment[at[starts]].astype(np.int32)),
        "docs": docs,
        "n": pa.array(np.diff(ends)),
        "most": pa.array(np.maximum.reduceat(tf, starts)),
        "least": pa.array(np.minimum.reduceat(lengths, starts)),
    }
    yield from pa.table(columns).to_batches(max_chunksize=BATCH)


def postings(spark: SparkSession, path: str, terms: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The postings of some terms: the partitions of their buckets, and of these the row groups that may hold them."""
    asked = sorted(set(terms))
    kind = spark.read.parquet(f"{path}/sizes").first().id_type
    table = spark.read.schema(f"term string, segment int, docs array<struct<d:{kind},tf:int,len:int>>, n int, most int, least int, batch int, bucket int").parquet(f"{path}/postings")
    places = [r.b for r in spark.createDataFrame([(t,) for t in asked], "t string").select(bucket(F.col("t"), buckets).alias("b")).collect()] if asked else []
    return table.where(F.col("bucket").isin(places) & F.col("term").isin(asked))


def _part(idf: Column, tf: Column, length: Column, average: float) -> Column:
    """What a term adds to a score; it grows with tf and falls with the length."""
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))


def search(spark: SparkSession, path: str, terms: list[str], k: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """(id, score) of the k documents with the best scores above none, ties to the smaller id; scores have six digits."""
    sizes = spark.read.parquet(f"{path}/sizes").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"), F.sum("words").alias("words")).first()
    rows = postings(spark, path, terms, buckets)
    held = {r.term: r.df for r in rows.groupBy("term").agg(F.sum("n").alias("df")).collect()}  # a row per term of the query
    average = (sizes.words or 0) / max(1, sizes.texts or 0)
    idf = F.element_at(F.create_map(*[x for t, df in held.items() for x in (F.lit(t), F.lit(math.log(1 + (sizes.n - df + 0.5) / (df + 0.5))))]), F.col("term")) if held else F.lit(0.0)
    average = average or 1.0
    bounds = rows.groupBy("batch", "segment").agg(F.sum(_part(idf, F.col("most"), F.col("least"), average)).alias("bound"))

    def best(segments: DataFrame) -> DataFrame:
        one = rows.join(segments.select("batch", "segment"), ["batch", "segment"]).select("term", F.explode("docs").alias("p"))
        parts = one.select(F.col("p.d").alias("id"), _part(idf, F.col("p.tf"), F.col("p.len"), average).alias("part"))
        return parts.groupBy("id").agg(F.round(F.sum("part"), 6).alias("score")).orderBy(F.desc("score"), "id").limit(k)

    first = best(F.broadcast(bounds.orderBy(F.desc("bound"), "batch", "segment").limit(FIRST))).collect()
    floor = first[-1].score if len(first) == k else 0.0
    return best(bounds.where(F.col("bound") >= floor - ROOM))
