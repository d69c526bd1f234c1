"""Removal of repeated passages by Rabin-Karp hashes of fixed-length word windows.

Every window of WINDOW consecutive words has a polynomial hash over 64 bits, taken from prefix sums. A
window goes if its word sequence also starts in a text with a smaller id, so what is needed per window is the
smallest id that has it. Counting is done in Spark, in two rounds, so that windows which cannot repeat
are never shuffled:

1. Each window names an anchor, the GRAM words inside it whose hash is least (the first such on ties).
   Equal windows name equal anchors, and neighbouring windows mostly share one, so a text has about
   one anchor per thirteen words. Anchors are grouped with a map-side minimum and maximum of the id.
2. Windows whose anchor is in two texts or more are grouped by (anchor, window hash), likewise. The two
   hashes come from different word hashes, so a false match needs both to collide.

Repeated windows are joined back and merged per text into maximal intervals. Texts of equal words are
one text throughout, and every copy but the first loses all that windows cover; a hot group of copies is
thus one row. Only texts that can lose words are shuffled with their text. Anchors of one hot passage are pre-aggregated, and its rows in the joins are split by
adaptive execution.

Words are runs of anything but ASCII white space. Null text has no words. Texts shorter than a window
lose nothing. Rows that repeat an id count as texts of their own but never remove from each other, and rows
whose id is null lose nothing. Extra columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import maybe_among, saved, surely_not_among

#: Words of a window and of an anchor.
WINDOW, GRAM = 50, 25
#: Occurrences of a window from which they are spread, and over how many tasks.
HOT, SALTS = 4096, 64
#: Odd multiplier of the polynomial, its inverse modulo 2**64, and the seeds of the two word hashes.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SEEDS = (11, 23)
NOTHING = hashlib.sha256(b"").hexdigest()


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def rolling(word_hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of that length, mixed so that every bit counts in comparisons."""
    n = len(word_hashes) - length + 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(word_hashes * _powers(BASE, len(word_hashes)), dtype=np.uint64)))
    h = (sums[length:] - sums[:-length]) * _powers(INVERSE, n)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def word_hashes(words: list[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def anchor_of_windows(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all grams, and for each window the place of its anchor among them."""
    grams = rolling(word_hashes(words, SEEDS[0]), gram)
    inside = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    return grams, np.concatenate([inside[i : i + 65_536].argmin(axis=1) + np.arange(i, min(i + 65_536, len(inside))) for i in range(0, len(inside), 65_536)])


def intervals(starts: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal intervals [a, b) of words under the windows that begin at the sorted starts."""
    breaks = np.flatnonzero(np.diff(starts) > window)
    firsts = starts[np.concatenate(([0], breaks + 1))]
    lasts = starts[np.concatenate((breaks, [len(starts) - 1]))] + window
    return list(zip(firsts.tolist(), lasts.tolist(), strict=True))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row of docs: id_col, n_words, whole_sha256 (of all words joined by spaces), spans
    (array<struct<a,b>> of word intervals to remove, null for none) and all_removed (a copy of the words
    of a smaller id that windows cover whole; it has no spans of its own)."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    raw = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t")).withColumn("k", F.xxhash64("t"))

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts, digests, anchors = [], [], []
                for x in part.column("t"):
                    words = (x.as_py() or b"").split()
                    counts.append(len(words))
                    digests.append(hashlib.sha256(b" ".join(words)).digest())
                    if len(words) < window:
                        anchors.append(None)
                    else:
                        grams, places = anchor_of_windows(words, window, gram)
                        anchors.append(np.unique(grams[np.unique(places)]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("k"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(anchors, pa.list_(pa.int64()))],
                    names=["id", "k", "n_words", "sha", "anchors"],
                )

    # one row per text; anchors stay beside their text until they are dealt
    texts = saved(raw.mapInArrow(survey, f"id {kind}, k long, n_words long, sha binary, anchors array<long>"))
    first = texts.groupBy("sha").agg(F.min("id").alias("first"))
    texts = texts.join(first, "sha")
    leading = texts.where((F.col("id") == F.col("first")) & F.col("anchors").isNotNull()).select("id", "k", "anchors")
    dealt = leading.select("id", "k", F.explode("anchors").alias("anchor"))
    shared = dealt.groupBy("anchor").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("anchor")
    wanted = saved(dealt.join(shared, "anchor").groupBy("id", "k").agg(F.collect_set("anchor").alias("shared")))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column("t")[i].as_py().split()
                grams, places = anchor_of_windows(words, window, gram)
                own = grams[places]
                starts = np.flatnonzero(np.isin(own.view(np.int64), batch.column("shared")[i].values.to_numpy()))
                if not len(starts):
                    continue
                hashes = rolling(word_hashes(words, SEEDS[1]), window)[starts]
                ids = pa.array([batch.column("id")[i].as_py()] * len(starts), batch.column("id").type)
                keys = pa.array(np.full(len(starts), batch.column("k")[i].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([ids, keys, pa.array(starts, pa.int32()), pa.array(own[starts].view(np.int64)), pa.array(hashes.view(np.int64))], names=["id", "k", "start", "anchor", "hash"])

    seen = saved(maybe_among(raw, wanted, ["id", "k"]).join(wanted, ["id", "k"]).mapInArrow(windows, f"id {kind}, k long, start int, anchor long, hash long"))
    of = ["anchor", "hash"]
    least = saved(seen.groupBy(*of).agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n")).where("least < most").select(*of, "least", "n"))
    # occurrences of a passage that very many texts share meet their least id in SALTS tasks, all others in one; what is among
    # the hot ones by hash is so on either side
    hot = least.where(F.col("n") > HOT).select(*of)
    one, many = F.lit(0).alias("salt"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    leading = surely_not_among(least, hot, of).select(*of, "least", one).union(maybe_among(least, hot, of).select(*of, "least", many))
    place = F.pmod(F.xxhash64("id", "start"), F.lit(SALTS)).cast("int").alias("salt")
    spread = surely_not_among(seen, hot, of).select("*", one).union(maybe_among(seen, hot, of).select("*", place))
    met = spread.join(leading, [*of, "salt"])
    starts = met.where("id > least").groupBy("id", "k").agg(F.collect_set("start").alias("starts"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"a": a, "b": b} for a, b in intervals(np.sort(x.values.to_numpy()), window)] for x in batch.column("starts")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("k"), pa.array(spans, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], names=["id", "k", "spans"])

    spans = starts.mapInArrow(merge, f"id {kind}, k long, spans array<struct<a:int,b:int>>")
    copy = F.coalesce((F.col("id") > F.col("first")) & (F.col("n_words") >= window), F.lit(False))
    return (
        texts.select("id", "k", "n_words", F.lower(F.hex("sha")).alias("whole_sha256"), copy.alias("all_removed"))
        .join(spans, ["id", "k"], "left")
        .select(F.col("id").alias(id_col), "k", "n_words", "whole_sha256", "spans", "all_removed")
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """Per row of docs: id_col, n_words, n_removed, kept_sha256 (of the kept words joined by one space, UTF-8), and
    with with_text the kept words themselves, joined likewise.

    Without the text, only texts that lose a part of their words are read again."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    found = repeated_passages(docs, id_col, text_col, window, gram)
    raw = docs.select(F.col(id_col), F.col(text_col).cast("string").cast("binary").alias("t")).withColumn("k", F.xxhash64("t"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, spans, everything in zip(batch.column("t"), batch.column("spans"), batch.column("all_removed"), strict=True):
                words = (text.as_py() or b"").split()
                counts.append(len(words))
                total, parts, at = 0, [], 0
                for span in [{"a": 0, "b": len(words)}] if everything.as_py() else spans.as_py() or []:
                    parts += words[at : span["a"]]
                    total, at = total + span["b"] - span["a"], span["b"]
                removed.append(total)
                kept.append(b" ".join(parts + words[at:]))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array([x.decode() if with_text else None for x in kept], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "n_removed", "kept_sha256", "kept_text"])

    schema = f"{id_col} {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    if with_text:
        return raw.join(found.dropDuplicates([id_col, "k"]), [id_col, "k"], "left").select(id_col, "t", "spans", "all_removed").mapInArrow(cut_out, schema)
    found = saved(found)
    cut = found.where(F.col("spans").isNotNull())
    parts = maybe_among(raw, cut, [id_col, "k"]).join(cut.dropDuplicates([id_col, "k"]), [id_col, "k"]).select(id_col, "t", "spans", "all_removed").mapInArrow(cut_out, schema).drop("kept_text")
    lost = F.when(F.col("all_removed"), F.col("n_words")).otherwise(F.lit(0).cast("long"))
    digest = F.when(F.col("all_removed"), F.lit(NOTHING)).otherwise(F.col("whole_sha256"))
    return found.where(F.col("spans").isNull()).select(id_col, "n_words", lost.alias("n_removed"), digest.alias("kept_sha256")).unionByName(parts)


#: DuckDB SQL of the digests, by comparing whole windows as text.
ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM p),
m AS (SELECT h, min(doc_id) AS least FROM h GROUP BY h),
r AS (SELECT h.doc_id, h.i FROM h JOIN m USING (h) WHERE m.least < h.doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM r),
k AS (SELECT d.doc_id, len(d.w) AS n, x.i, d.w[x.i] AS word FROM d, (SELECT unnest(range(1, (SELECT max(len(w)) + 1 FROM d))) AS i) x WHERE x.i <= len(d.w)),
kept AS (SELECT k.doc_id, string_agg(k.word, ' ' ORDER BY k.i) AS t, count(*) AS n FROM k LEFT JOIN c USING (doc_id, i) WHERE c.i IS NULL GROUP BY k.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
