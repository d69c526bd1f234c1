"""SimHash near-duplicates by Jaccard similarity: a wide fingerprint, its byte positions as an inverted index, and
exact verification.

A 64-bit SimHash of all shingles differs in some ten bits for texts whose shingles have a Jaccard similarity of 0.8,
too many for any byte to be sure to agree. Here each of POSITIONS bytes is the SimHash of a consistent sample of
SAMPLE shingles, the first in an order that only this position has, so a byte agrees with a chance of about 0.55 at 0.8
(0.27 if every shingle counted). Two texts at 0.8 share 17 of 32 positional bytes on average.

1. Texts with equal shingle sets are one node.
2. The index is read by threes of positions, TABLES of them; texts that agree on three bytes meet in a list. A list of more
   than LIST nodes is first read by EXTRA further positions each, as often as needed. What agrees on everything and is
   still too long is cut by hash, with its first node in every part. This finds the large groups without pairing them within
   themselves, and loses other pairs of these lists; step 5 finds the rest.
3. In a list the shared positional bytes of each pair are tallied; pairs of at least MATCHES (which similar texts
   miss with a chance under 0.01) are candidates. Every node proposes its best candidate, and what is proposed is verified
   by the exact Jaccard similarity of the shingles. Verified links make groups.
4. Nodes that still have candidates in another group propose the next best, twice as many each time, until
   none is left. So no candidate between two groups stays unverified, while a large group is never paired within itself.
5. Lists of more than LIST nodes are then compared whole: all nodes but those of a list's largest group meet each other and
   that group, in tiles of some LIST nodes. Only the largest group is not compared with itself. Steps 3 and 4 are repeated on the tiles.
   The rows of the tiles grow with the nodes of a list times those outside of its largest group.

Words are runs of anything but ASCII white space with A-Z in lower case; fewer than `shingle` words are one shingle. Texts
without words, null included, have equal (empty) sets. Rows are known by id and text, so null or repeated
ids lose no other text. Extra columns stay, also those named like working columns; an empty table gives an empty one."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, discard, maybe_among, saved, surely_not_among
from tidemark.llm.substring import rolling

#: Words of a shingle, and the similarity NUM / DEN from which texts are near-duplicates.
SHINGLE, NUM, DEN = 5, 4, 5
#: Bytes of a fingerprint, shingles behind each, threes of positions that are looked up, and shared bytes of a candidate.
POSITIONS, SAMPLE, TABLES, MATCHES = 32, 3, 32, 10
#: Nodes of a list that one task compares, further positions by which a longer one is read, and how often.
LIST, EXTRA, LEVELS = 1024, 6, 4
_rng = np.random.default_rng(2024)
_ORDERS = _rng.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
REMEMBERED = 65_536


def _threes() -> list[tuple[int, ...]]:
    """TABLES threes of positions that use all positions alike."""
    rng, out = random.Random(7), []
    while len(out) < TABLES:
        order = rng.sample(range(POSITIONS), POSITIONS)
        out += [tuple(sorted(order[i : i + 3])) for i in range(0, POSITIONS - 2, 3)]
    return out[:TABLES]


class Shingler:
    """Distinct shingle hashes of texts, with the word hashes that a worker remembers."""

    def __init__(self, shingle: int = SHINGLE):
        self.shingle, self.known = shingle, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < self.shingle:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w, 5)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        return np.unique(rolling(hashes, self.shingle))


def fingerprint(shingles: np.ndarray) -> bytes:
    """POSITIONS bytes; zeros for a text without shingles."""
    if not len(shingles):
        return bytes(POSITIONS)
    best = np.zeros((0, POSITIONS), np.uint64)
    for at in range(0, len(shingles), 16_384):
        best = np.concatenate((best, shingles[at : at + 16_384, None] * _ORDERS))
        if len(best) > SAMPLE:
            best = np.partition(best, SAMPLE - 1, axis=0)[:SAMPLE]
    best = np.sort(best, axis=0)
    bits = ((best * _MIX) >> np.uint64(56)).astype(np.uint8)
    if len(bits) < SAMPLE:
        return bits[0].tobytes()
    a, b, c = bits
    return ((a & b) | (a & c) | (b & c)).tobytes()


def prints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """id, t1, t2 (hashes of the text), node (digest of its shingle set) and fp of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingler(shingle)
        for batch in batches:
            nodes, fps = [], []
            for x in batch.column("t"):
                found = of(x.as_py())
                nodes.append(xxhash.xxh3_128_digest(found.tobytes()))
                fps.append(fingerprint(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(nodes, pa.binary()), pa.array(fps, pa.binary())], names=["id", "t1", "t2", "node", "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return _named(docs, id_col, text_col).mapInArrow(run, f"id {kind}, t1 long, t2 long, node binary, fp binary")


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), *(h.alias(n) for n, h in _text_hashes(text)), text.cast("binary").alias("t"))


def _text_hashes(text: F.Column) -> list[tuple[str, F.Column]]:
    return [("t1", F.xxhash64(text)), ("t2", F.xxhash64(F.lit(1), text))]


def lists(nodes: DataFrame, longest: int = LIST) -> tuple[DataFrame, DataFrame | None]:
    """(key, node, fp) of the posting lists of two nodes or more, none longer than `longest` and some; and (key, node) of
    the lists that are longer, if there are any, which the first table holds in a form that loses pairs."""
    part = lambda p: F.substring("fp", p + 1, 1)
    rows = nodes.select("node", F.explode(F.array(*(F.xxhash64(F.lit(t), *map(part, three)) for t, three in enumerate(_threes())))).alias("key"))
    prints = nodes.select("node", "fp")
    rng = random.Random(11)
    out = whole = None
    for level in range(LEVELS + 1):
        # most keys are of one node: they are counted first, and only rows of the others are dealt out
        sizes = saved(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
        met = saved(maybe_among(rows, sizes, ["key"]).join(sizes, "key"))
        discard(sizes)
        short = met.where(F.col("n") <= longest).select("key", "node").join(prints, "node").select("key", "node", "fp")
        out = short if out is None else out.union(short)
        hot = met.where(F.col("n") > longest)
        if not hot.head(1):
            return out, whole
        if whole is None:
            whole = saved(hot.select("key", "node"))
        if level == LEVELS:
            parts = F.ceil(2 * F.col("n") / longest).cast("int")
            own = hot.select(F.xxhash64("key", F.lit(-1), F.pmod(F.xxhash64("node"), parts)).alias("key"), "node")
            lead = hot.groupBy("key").agg(F.min("node").alias("node"), F.first("n").alias("n"))
            lead = lead.select("node", "key", F.explode(F.sequence(F.lit(0), parts - 1)).alias("p")).select(F.xxhash64("key", F.lit(-1), F.col("p").cast("long")).alias("key"), "node")
            return out.union(own.union(lead).distinct().join(prints, "node").select("key", "node", "fp")), whole
        further = rng.sample(range(POSITIONS), EXTRA)
        rows = hot.join(prints, "node").select("node", F.explode(F.array(*(F.xxhash64("key", F.lit(p), part(p)) for p in further))).alias("key"))


def tiles(whole: DataFrame, nodes: DataFrame, parts: DataFrame | None, longest: int = LIST) -> DataFrame:
    """(key, node, fp) of tiles in which all pairs of a list (key, node) meet but those within its largest group."""
    group = F.coalesce("component", "node") if parts is not None else F.col("node")
    grouped = saved((whole.join(parts, "node", "left") if parts is not None else whole).select("key", "node", group.alias("g")))
    sizes = grouped.groupBy("key", "g").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("g", F.struct("n", "g")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most")).where(F.col("all") > F.col("most"))
    half = max(1, longest // 2)
    cut = lambda n: F.ceil(n / half).cast("int")
    placed = grouped.join(main, "key").withColumn("rests", cut(F.col("all") - F.col("most"))).withColumn("mains", cut(F.col("most")))
    at = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n, tile: F.transform(F.sequence(F.lit(0), F.col(n) - 1), tile)
    name = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    among = each("rests", lambda j: name(F.least(j, F.col("at")), F.greatest(j, F.col("at"))))
    of_rest = F.concat(among, each("mains", lambda k: name(F.col("at"), -1 - k)))
    of_main = each("rests", lambda i: name(i, -1 - F.col("at")))
    is_main = F.col("g") == F.col("main")
    rows = placed.withColumn("at", F.when(is_main, at("mains")).otherwise(at("rests"))).withColumn("is_main", is_main)
    rows = rows.select("key", "node", F.explode(F.when(F.col("is_main"), of_main).otherwise(of_rest)).alias("tile"))
    return saved(rows.select(F.xxhash64("key", "tile.a", "tile.b").alias("key"), "node").join(nodes.select("node", "fp"), "node").select("key", "node", "fp"))


def proposals(members: DataFrame, first: int, last: int, least: int = MATCHES) -> DataFrame:
    """(u, v), u < v: for every node of a list (key, node, fp, part) its candidates of other parts, from the first
    best to the last best (numbers from 0, the last excluded)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[bytes, bytes]] = set()
            for rows in batch.column(0):
                values = rows.values
                names = values.field("node").to_pylist()
                fps = np.frombuffer(b"".join(values.field("fp").to_pylist()), np.uint8).reshape(-1, POSITIONS)
                parts = np.unique(np.array([x or n for x, n in zip(values.field("part").to_pylist(), names, strict=True)], dtype="S16"), return_inverse=True)[1]
                if parts.max() == 0:
                    continue
                for at in range(0, len(fps), 128):
                    tally = np.zeros((len(fps[at : at + 128]), len(fps)), np.int16)
                    for p in range(POSITIONS):
                        tally += fps[at : at + 128, p, None] == fps[None, :, p]
                    tally[parts[at : at + 128, None] == parts[None, :]] = 0
                    for i in np.flatnonzero((tally >= least).sum(axis=1) > first).tolist():
                        order = np.argsort(-tally[i], kind="stable")[first:last]
                        for j in order[tally[i][order] >= least].tolist():
                            a, b = names[at + i], names[j]
                            found.add((a, b) if a < b else (b, a))
            pairs = sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.binary()) for k in (0, 1)], names=["u", "v"])

    together = members.groupBy("key").agg(F.collect_list(F.struct("node", "fp", "part")).alias("rows"))
    return together.select("rows").mapInArrow(run, "u binary, v binary").distinct()


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(node, s): the shingles of the wanted nodes, each from the one row (id, t1, t2) that wanted names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingler(shingle)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                sets = [of(x.as_py()) for x in batch.column(1).slice(at, 256)]
                ends = np.cumsum([0, *map(len, sets)])
                values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], names=["node", "s"])

    rows = maybe_among(_named(docs, id_col, text_col), wanted, ["t1", "t2"]).dropDuplicates(["t1", "t2"])
    met = rows.select("t1", "t2", "t").join(wanted.select("node", "t1", "t2"), ["t1", "t2"])
    return met.select("node", "t").mapInArrow(run, "node binary, s array<long>")


def groups(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, shingle: int, num: int = NUM, den: int = DEN, longest: int = LIST) -> DataFrame:
    """(node, component) of the nodes that have a link; nodes: node, fp and the text (t1, t2) that stands for it."""
    found, whole = lists(nodes, longest)
    members = saved(found)
    edges = sets = parts = None
    first, last = 0, 1
    while True:
        own = members.withColumn("part", F.lit(None).cast("binary")) if parts is None else members.join(parts.withColumnRenamed("component", "part"), "node", "left")
        pairs = saved(proposals(own.select("key", "node", "fp", "part"), first, last))
        if not pairs.head(1):
            discard(members, pairs)
            if whole is None:
                break
            members, whole, sets, first, last = tiles(whole, nodes, parts, longest), None, None, 0, 1
            continue
        if sets is None:  # whoever has a candidate proposes it at once, so later pairs need no other sets
            ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
            wanted = saved(nodes.join(ends, "node", "left_semi").select("node", "t1", "t2"))
            sets = saved(shingle_sets(docs, wanted, id_col, text_col, shingle))
            discard(wanted)
        compared = pairs.join(sets.select(F.col("node").alias("u"), F.col("s").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("s").alias("b")), "v")
        alike = F.size(F.array_intersect("a", "b")) * (num + den) >= (F.size("a") + F.size("b")) * num
        linked = saved(compared.where(alike).select("u", "v"))
        discard(pairs)
        edges = linked if edges is None else edges.union(linked)
        if linked.head(1):
            parts = saved(connected_components(edges))
        # the ranks are among other groups only, so they begin anew when groups have grown
        first, last = (0, last) if linked.head(1) else (last, 2 * last + 1)
    if parts is None:
        return nodes.select("node", F.col("node").alias("component")).limit(0)
    return parts


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, num: int = NUM, den: int = DEN, longest: int = LIST) -> DataFrame:
    """One row of docs of each group, the first by id_col; null ids come last. Of rows that share both the id and the
    text one stays. Only rows that may go are shuffled."""
    every = saved(prints(docs, id_col, text_col, shingle))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t1", "t2")).alias("f")
    nodes = saved(every.groupBy("node").agg(first, F.any_value("fp").alias("fp")).select("node", "fp", "f.*"))
    parts = groups(docs, nodes.select("node", "fp", "t1", "t2"), id_col, text_col, shingle, num, den, longest)
    stays = saved(nodes.join(parts, "node", "left").groupBy(F.coalesce("component", "node").alias("g")).agg(F.min(F.struct("none", "id", "t1", "t2")).alias("f")).select("f.*"))
    same = ["none", "id", "t1", "t2"]
    rows = every.groupBy(F.col("id").isNull().alias("none"), "id", "t1", "t2").agg(F.count("*").alias("n")).alias("r")
    met = rows.join(stays.withColumn("stays", F.lit(True)).alias("k"), [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in same], "left")
    judged = saved(met.where("k.stays IS NULL OR r.n > 1").select("r.id", "r.t1", "r.t2", F.col("k.stays").isNotNull().alias("stays")))
    discard(every, nodes)

    text = F.col(text_col).cast("string")
    named = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), *(h.alias(n) for n, h in _text_hashes(text)))
    own = [F.col("row")[c].alias(c) for c in docs.columns]
    clear = surely_not_among(named, judged, same[1:]).select(*own)
    # of the others, what surely does not stay goes before the shuffle too
    held = saved(maybe_among(stays.select(*same[1:]), judged, same[1:]))
    again = maybe_among(maybe_among(named, judged, same[1:]), held, same[1:]).dropDuplicates(same[1:]).alias("r")
    kept = again.join(judged.alias("k"), [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in same[1:]], "left").where("k.stays IS NULL OR k.stays").select(*own)
    return clear.unionByName(kept)
