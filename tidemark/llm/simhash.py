"""SimHash near-duplicates by an inverted index over byte positions.

A 64-bit fingerprint has eight positional bytes. Two that differ in at most three bits share at least
five of them, whatever the bits. The index is read by the sets of positions in TRIPLES: every five
positions out of eight hold one of them whole, so a linked pair meets in at least one posting list.
Of a pair that meets, the shared positional bytes are tallied, pairs with fewer than five are
dropped, and the rest is verified by the bits.

Only distinct fingerprints enter the index, so copies cost nothing there. A posting list of up to LIST
fingerprints is searched in one task, which walks its links and returns a spanning forest, never the
pairs. A longer list is not searched by pairs at all: each of its fingerprints is sent to the points
within two bits of it (1 + 64 + 2016, a fixed number); two fingerprints are within three bits exactly
if some point is within one bit of the first and two of the second, or within one bit of both. At a point
all that came meet in one link each to the smallest that is within one bit. So the work per fingerprint is
bounded on either path and no link is lost.

Words are runs of anything but ASCII white space, with A-Z in lower case; shingles are three words.
A text of fewer words is one shingle, and a text without words, null included, has fingerprint zero, which
links like any other. Rows that repeat a doc_id each have a row in the result; null ids are allowed and
never the smallest. Extra columns are ignored, and an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, connected_components

#: Words of a shingle, seed of its hash, bits that may differ, and the bytes that must then agree.
SHINGLE, SEED, BITS, MATCHES = 3, 42, 3, 5
#: All threes among positions 0-3 and among 4-7: any five positions hold three of one half.
TRIPLES = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]
#: Fingerprints of a posting list that one task searches.
LIST = 4096


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, unsigned."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    ends = (ends[len(words) - n :] - 1).tolist()
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 65_536):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + 65_536], ends[at : at + 65_536], strict=True)], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id_col, fp long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = [_signed(fingerprint(x.as_py(), shingle)) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=[id_col, "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string").cast("binary").alias("_t")).mapInArrow(run, f"{id_col} {kind}, fp long")


def links_in_list(fps: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one posting list."""
    found: list[tuple[int, int]] = []
    left = fps
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            node = todo.pop()
            differ = left ^ node
            tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            linked = (tally >= MATCHES) & (np.bitwise_count(differ) <= BITS)
            if linked.any():
                found += [(int(node), int(x)) for x in left[linked]]
                todo += list(left[linked])
                left = left[~linked]
    return found


def _ball() -> list[list[int]]:
    """Masks of no bit, one bit and two bits."""
    return [[0], [1 << i for i in range(64)], [(1 << i) | (1 << j) for i, j in combinations(range(64), 2)]]


def links(distinct: DataFrame, longest: int = LIST) -> DataFrame:
    """Edges (u, v) among the distinct fingerprints fp, whose components are those of all links of at most
    BITS bits."""
    masks = [_signed(sum(255 << (8 * p) for p in t)) for t in TRIPLES]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"))
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(sizes, ["t", "key"])
    lists = met.where(F.col("n") <= longest).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for fps in batch.column(0):
                found += links_in_list(fps.values.to_numpy().view(np.uint64))
            u, v = np.array(found, np.uint64).reshape(-1, 2).T.copy().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    near = lists.select("fps").mapInArrow(search, "u long, v long")

    hot = met.where(F.col("n") > longest).select("fp").distinct()
    none, one, two = _ball()
    flip = lambda masks: F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(_signed(m))) for m in masks])).alias("z")
    first = hot.select("fp", flip(none + one))
    centre = first.groupBy("z").agg(F.min("fp").alias("c"))
    around = first.union(hot.select("fp", flip(two)))
    far = around.join(centre, "z").where("fp <> c").select(F.col("c").alias("u"), F.col("fp").alias("v")).distinct()
    return near.union(far)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, longest: int = LIST) -> DataFrame:
    """id_col, fp (long), fingerprint (16 hexadecimal digits) and component_id, the smallest id_col among
    the texts that a chain of links reaches."""
    prints = checkpoint(fingerprints(docs, id_col, text_col, shingle))
    distinct = prints.groupBy("fp").agg(F.min(id_col).alias("least"))
    parts = connected_components(links(distinct.select("fp"), longest))
    # the fingerprints of a component share its smallest id; a fingerprint outside any stays by itself
    named = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = parts.join(least, "component").select(F.col("node").alias("fp"), "component_id")
    alone = distinct.select("fp", F.col("least").alias("own"))
    of_print = alone.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "own").alias("component_id"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(of_print, "fp").select(id_col, "fp", digits, "component_id")
