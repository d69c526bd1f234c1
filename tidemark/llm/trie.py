"""Conversation prefix trie by prefix doubling.

Turns get dense names: equal (role, text) pairs, told apart by a SHA-256 digest, so texts are never shuffled. Blocks of two,
four, eight ... aligned turns are named from the names of their halves, one round of joins for each power of two. The first d
turns of a conversation are the blocks of the binary digits of d; going down the powers, a prefix and the block behind it
are named together. Rounds grow with the logarithm of the longest conversation, rows of all rounds with the turns.

Prefixes of equal depth and name are a node. A conversation is the smallest member of all nodes on a last stretch of its own
path, its chain (it may be empty). Sums over a subtree are therefore sums over the members of what each member's own chain
holds below, so no round climbs the tree.

Conversations are rebuilt as HEAD says: the first turns come from the conversation of the group, and the others are its own.
Names that very many rows have (a common first turn, copies of a conversation) are joined by look_up, long conversations are numbered
over many partitions (running), ids of a node's ends are packed in pieces of PIECE ids before one task digests them in order.

Null role or text is empty, null turns come first, and turns of equal number are ordered by their digest. Rows without a conv_id
belong to no conversation. Equal rows are turns of their own. Extra columns are ignored. An empty table gives no rows, not even
a root."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, dense_names, discard, look_up, running, saved

#: Conversations of a group, whose first one lends its first turns; at most HEAD - 1 of them.
GROUP, HEAD = 20, 4
#: Ids of a piece of a node's ends.
PIECE = 512
WORD = r"[^\x20\x09-\x0D]+"


def own_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per row with a conversation: c, turn, key (digest of role and text) and words."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    key = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return conversations.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns c, d (from 1), key, words of the rebuilt conversations; conversations c, len)."""
    order = [F.col("turn").asc_nulls_first(), F.col("key")]
    placed, runs = running(turns.withColumn("one", F.lit(1).cast("long")), "c", order, "one")
    placed = saved(placed.select("c", F.col("before").alias("p"), "key", "words"))
    lent = F.crc32(F.col("c").cast("string").cast("binary")) % HEAD
    convs = runs.groupBy("c").agg(F.sum("total").alias("n")).withColumn("h", lent)
    first = F.col("c") - F.col("c") % GROUP
    heads = placed.where((F.col("c") == first) & (F.col("p") < HEAD - 1)).groupBy(F.col("c").alias("b")).agg(F.array_sort(F.collect_list(F.struct("p", "key", "words"))).alias("head"))
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<p:bigint,key:binary,words:bigint>>")), F.lit(1), F.col("h").cast("int"))
    convs = convs.withColumn("b", first).join(heads, "b", "left").withColumn("head", head)
    convs = saved(convs.withColumn("shift", F.size("head").cast("long") - F.col("h")).withColumn("len", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    borrowed = convs.select("c", F.explode("head").alias("t")).select("c", (F.col("t.p") + 1).alias("d"), "t.key", "t.words")
    own = look_up(placed, convs.select("c", "h", "shift", "n"), ["c"], "n").where("p >= h").select("c", (F.col("p") + F.col("shift") + 1).alias("d"), "key", "words")
    out = saved(own.unionByName(borrowed)), checkpoint(convs.select("c", "len"))
    discard(placed, convs)
    return out


def named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows, which are cheap to read, with the dense name of their keys in place of these."""
    names, total = dense_names(rows, keys)
    out = saved(look_up(rows, names, keys, "n", total=total).drop(*keys))
    discard(names)
    return out


def prefixes(turns: DataFrame) -> DataFrame:
    """Per turn (c, d, key): c, d and the name of the first d turns of c, which is unique among those of equal d."""
    blocks = [named(turns.select("c", (F.col("d") - 1).alias("i"), "key"), ["key"])]
    while True:
        half = lambda odd: F.max(F.when(F.col("i") % 2 == odd, F.col("name")))
        pairs = blocks[-1].groupBy("c", F.shiftright("i", 1).alias("i")).agg(half(0).alias("left"), half(1).alias("right"))
        pairs = saved(pairs.where("left IS NOT NULL AND right IS NOT NULL"))
        if pairs.isEmpty():
            break
        blocks.append(named(pairs, ["left", "right"]))
        discard(pairs)
    found: list[DataFrame] = []
    for level in range(len(blocks) - 1, -1, -1):
        width = 1 << level
        ends = blocks[level].where("i % 2 = 0").select("c", (F.col("i") * width).alias("start"), F.col("name").alias("right"))
        before = reduce(DataFrame.unionByName, found).select("c", F.col("d").alias("start"), F.col("name").alias("left")) if found else None
        whole = ends.where("start = 0").select("c", F.lit(width).cast("long").alias("d"), F.col("right").alias("name"))
        if before is not None:
            joined = saved(ends.where("start > 0").join(before, ["c", "start"]).select("c", (F.col("start") + width).alias("d"), "left", "right"))
            found.append(named(joined, ["left", "right"]))
            discard(joined)
        found.append(whole.select("c", "d", "name"))
    return reduce(DataFrame.unionByName, found)


def digest_ends(ends: DataFrame) -> DataFrame:
    """Per node (d, name) of ends (c, d, name): the number of ends, and the digest of the ids in numeric order.

    A digest is sequential, so the ids of a node meet in one task, as packed pieces that it reads in order and never holds together."""
    pieces = ends.groupBy("d", "name", F.expr(f"c div {PIECE}").alias("piece"), F.expr("c >= 0").alias("positive")).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("c")).alias("ids"))
    pieces = pieces.select("d", "name", "positive", "piece", "n", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    pieces = pieces.repartition("d", "name").sortWithinPartitions("d", "name", "positive", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, n = None, hashlib.sha256(), 0
        for batch in batches:
            rows: list[tuple] = []
            for d, name, count, ids in zip(*(batch.column(x).to_pylist() for x in ("d", "name", "n", "ids"))):
                if (d, name) == node:
                    state.update(b",")
                else:
                    if node:
                        rows.append((*node, n, state.hexdigest()))
                    node, state, n = (d, name), hashlib.sha256(), 0
                state.update(ids.encode())
                n += count
            yield table(rows)
        if node:
            yield table([(*node, n, state.hexdigest())])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (("d", pa.int64()), ("name", pa.int64()), ("n_ends", pa.int64()), ("ends_sha256", pa.string()))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], names=[x for x, _ in kinds])

    return pieces.mapInArrow(run, "d long, name long, n_ends long, ends_sha256 string")


def build(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    # finding the ranges of the order takes a pass of its own, so texts are digested first, in one pass
    own = saved(own_turns(conversations, conv_col, turn_col, role_col, text_col))
    turns, convs = rebuilt(own)
    discard(own)
    root = convs.select("c", F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("name"))
    paths = saved(prefixes(turns.select("c", "d", "key")).unionByName(root))
    ends = saved(digest_ends(paths.join(convs.select("c", F.col("len").alias("d")), ["c", "d"])))
    nodes = paths.groupBy("d", "name").agg(F.min("c").alias("c"), F.count("*").alias("n_convs")).join(ends, ["d", "name"], "left")
    nodes = nodes.join(turns.select("c", "d", "words"), ["c", "d"], "left")
    saves = (F.col("n_convs") - 1) * F.coalesce("words", F.lit(0))
    leaf = F.coalesce(F.col("n_ends") == F.col("n_convs"), F.lit(False)).cast("long")
    nodes = saved(nodes.select("d", "name", "c", "n_convs", saves.alias("saves"), leaf.alias("leaf"), "ends_sha256"))

    # chains: the nodes of one smallest member, from `top` down; below: what the chain holds from a depth down
    chains = checkpoint(nodes.groupBy("c").agg(F.min("d").alias("top"), F.max("d").alias("bottom"), F.sum("saves").alias("all_saves"), F.max("leaf").alias("leaf"), F.count("*").alias("n")))
    deeper, _ = running(nodes.select("c", "d", "saves"), "c", [F.col("d").desc()], "saves")
    deeper = deeper.select("c", "d", (F.col("before") + F.col("saves")).alias("below"))
    parts = look_up(paths, chains.withColumn("n", F.col("bottom") + 1), ["c"], "n").join(deeper, ["c", "d"], "left")
    sums = parts.groupBy("d", "name").agg(
        F.sum(((F.col("d") + 1 >= F.col("top")) & (F.col("d") < F.col("bottom"))).cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.coalesce("below", "all_saves")).alias("saved_tokens"),
    )

    # only the top of a chain has a parent with another smallest member
    tops = saved(chains.where("top > 0").select(F.col("c").alias("child"), (F.col("top") - 1).alias("d"), "c").join(paths, ["c", "d"]).drop("c"))
    parents = look_up(tops, nodes.select("d", "name", F.col("c").alias("parent"), "n_convs"), ["d", "name"], "n_convs").select(F.col("child").alias("c"), (F.col("d") + 1).alias("d"), "parent")
    out = nodes.drop("leaf").join(sums, ["d", "name"]).join(parents, ["c", "d"], "left")
    parent = F.when(F.col("d") > 0, F.coalesce("parent", "c"))
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


ORACLE = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL
), k AS (
  SELECT c, max(p) + 1 AS n, c - c % {GROUP} AS b, xor(list_reduce([4294967295] || flatten(list_transform(range(1, length(CAST(c AS VARCHAR)) + 1),
    lambda i: [CAST(ord(CAST(c AS VARCHAR)[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % {HEAD} AS h
  FROM t GROUP BY c
), r AS (
  SELECT k.c, t.p AS q, r, x FROM k JOIN t ON t.c = k.b AND t.p < k.h
  UNION ALL
  SELECT t.c, least(k.h, coalesce(z.n, 0)) + t.p - k.h AS q, r, x FROM t JOIN k ON t.c = k.c LEFT JOIN k z ON z.c = k.b WHERE t.p >= k.h
), s AS (
  SELECT k.c, coalesce(list({{'r': r, 'x': x}} ORDER BY q) FILTER (q IS NOT NULL), []) AS seq FROM k LEFT JOIN r ON k.c = r.c GROUP BY k.c
), m AS (
  SELECT c, u.d AS d, seq[1:u.d] AS pre, len(seq) = u.d AS ends FROM s, unnest(range(0, len(seq) + 1)) u(d)
), v AS (
  SELECT pre, d, min(c) AS conv_id, count(*) AS n_convs, bool_and(ends) AS leaf, CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(pre[d].x, '[^\\x20\\x09-\\x0D]+')) END AS words,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY pre, d
), a AS (
  SELECT pre[1:u.e] AS pre, u.e AS d, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens, count(*) FILTER (u.e = v.d - 1) AS n_children FROM v, unnest(range(0, v.d + 1)) u(e) GROUP BY ALL
)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, v.n_convs, a.n_children, a.n_leaves, CAST(a.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN a ON v.d = a.d AND v.pre = a.pre LEFT JOIN v o ON o.d = v.d - 1 AND o.pre = v.pre[1:v.d - 1]
"""
