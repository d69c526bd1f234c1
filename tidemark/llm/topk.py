"""Exact top-k inner-product search by columnar branch and bound.

Vectors become integers, floor(256 * x). A block of candidates is held in vertical layout, one row of
the array per dimension. For one query the products are summed up dimension block by dimension
block; after each, what the remaining dimensions can add at most and at least is bounded by the
product of the two remaining norms, and only candidates whose upper bound reaches the k-th best lower
bound stay. The survivors' columns are compacted before the next block.

Queries are every vector whose id is divisible by query_mod, against every other vector. Queries are taken
in blocks of about QUERIES, each a broadcast of bounded size; the candidates are read once for a block, where they
are, and never shuffled. A task goes through its candidates block by block and carries each query's k best on, so the
k-th best score so far is a floor that prunes all later blocks. What is shuffled is k rows for each task and
query, merged in two steps. A vector is known by its row, so rows that repeat an id are queries and candidates each, and
only the query's own row is left out. Null vectors and those with a null or a non-finite component take no part; only
vectors of equal length are compared, empty ones included. Ties go to the smaller id.
Large components are summed as Python integers; scores beyond 64 bits saturate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, saved

#: Vectors in a block of candidates and of queries, and dimensions in a block.
CANDIDATES, QUERIES, DIMS = 16_384, 16_384, 16


def integer_vectors(table: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(row, id, v array<double> of whole numbers) of the vectors that take part."""
    x = F.col("_v")
    usable = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * scale == float("inf")))
    return (
        table.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("_v"))
        .where(usable & F.col("id").isNotNull())
        .select(F.monotonically_increasing_id().alias("row"), "id", F.transform("_v", lambda c: F.when(F.abs(c) * scale >= 2.0**53, c * scale).otherwise(F.floor(c * scale).cast("double"))).alias("v"))
    )


def best_in_block(query: np.ndarray, columns: np.ndarray, rests: list[np.ndarray], k: int, own: int = -1, dims: int = DIMS, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k best candidates of one block for one query, best first; of those below floor, a score that
    k others have already, some may be left out. Ties go to the smaller place.

    columns has a row per dimension, rests[i] each candidate's norm over the dimensions from block i on, and own is the place
    of the query itself. Scores are whole numbers below 2**53 wherever float64 is used, so they are exact."""
    alive = np.arange(columns.shape[1])
    if own >= 0:
        alive = np.delete(alive, own)
    partial = np.zeros(len(alive))
    for b, at in enumerate(range(0, len(query), dims)):
        part = columns[at : at + dims]
        partial += query[at : at + dims] @ (part if len(alive) == part.shape[1] else part[:, alive])
        if at + dims >= len(query) or not len(alive):
            continue
        rest = np.sqrt((query[at + dims :] ** 2).sum()) * rests[b + 1][alive] * (1 + 1e-9) + 1e-6
        least = max(floor, np.partition(partial - rest, len(alive) - k)[len(alive) - k]) if len(alive) > k else floor
        stay = partial + rest >= least
        alive, partial = alive[stay], partial[stay]
    order = np.lexsort((alive, -partial))[:k]
    return alive[order], partial[order]


def exact_scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores as Python integers, for vectors too large for float64 sums."""
    q = [int(c) for c in query]
    return np.array([sum(a * int(c) for a, c in zip(q, row, strict=True)) for row in rows], dtype=object)


class Queries:
    """A block of queries, and a task's k best of each: (minus the score, id) in order."""

    def __init__(self, rows: list[int], ids: list[int], vectors: list[np.ndarray], k: int):
        self.rows, self.ids, self.k = rows, ids, k
        self.lengths: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            self.lengths.setdefault(len(v), []).append(i)
        self.vectors = {d: np.array([vectors[i] for i in own]).reshape(len(own), d) for d, own in self.lengths.items()}

    def start(self) -> None:
        self.best: list[list[tuple[int, int]]] = [[] for _ in self.rows]

    def offer(self, i: int, found: list[tuple[int, int]]) -> None:
        self.best[i] = sorted(self.best[i] + found)[: self.k]

    def meet(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """A block of candidates of one length."""
        d = vectors.shape[1]
        if d not in self.lengths:
            return
        order = np.argsort(ids, kind="stable")
        rows, ids, vectors = rows[order], ids[order], vectors[order]
        place = {r: j for j, r in enumerate(rows.tolist())}
        queries = self.vectors[d]
        if max(np.abs(vectors).max(initial=0), np.abs(queries).max(initial=0)) ** 2 * d >= 2.0**53:
            for i, q in zip(self.lengths[d], queries, strict=True):
                scores = exact_scores(q, vectors)
                self.offer(i, [(-max(-(2**63) + 1, min(2**63 - 1, s)), int(ids[j])) for j, s in enumerate(scores) if rows[j] != self.rows[i]])
            return
        columns = np.ascontiguousarray(vectors.T)
        squares = (columns**2)[::-1].cumsum(axis=0)[::-1]
        rests = [np.sqrt(squares[at]) for at in range(0, d, DIMS)]
        for i, q in zip(self.lengths[d], queries, strict=True):
            floor = float(-self.best[i][-1][0]) if len(self.best[i]) == self.k else -np.inf
            places, scores = best_in_block(q, columns, rests, self.k, place.get(self.rows[i], -1), floor=floor)
            if len(places) and scores[0] >= floor:
                self.offer(i, [(-int(s), int(ids[j])) for j, s in zip(places.tolist(), scores.tolist(), strict=True)])


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, ids, vectors) of batches (row, id, v), by length, `most` vectors at a time."""
    waiting: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    held: dict[int, int] = {}

    def ready(d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held[d] = 0
        parts = waiting.pop(d)
        return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))

    for batch in batches:
        rows, ids, lists = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
        sizes = lists.value_lengths().to_numpy()
        for d in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == d)
            for at in range(0, len(own), most):
                some = own[at : at + most]
                flat = lists.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False)
                waiting.setdefault(d, []).append((rows[some], ids[some], flat.reshape(len(some), d)))
                held[d] = held.get(d, 0) + len(some)
                if held[d] >= most:
                    yield ready(d)
    for d in list(waiting):
        yield ready(d)


def top_k(table: DataFrame, k: int = 5, query_mod: int = 50, id_col: str = "vec_id", vec_col: str = "embedding", block: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), id_col and score: the k best of every query, or all if there are fewer."""
    vectors = saved(integer_vectors(table, id_col, vec_col))
    asked = vectors.where(F.col("id") % query_mod == 0)
    n = -(-asked.count() // block) or 1
    context = table.sparkSession.sparkContext
    keep = "slice(array_sort(collect_list(struct(-score AS s, vec_id AS v))), 1, {k})"
    # the k best of every task meet first by a part of the query's rows
    part = F.pmod(F.xxhash64("vec_id"), F.lit(16))
    every = []
    for b in range(n):
        # about `block` rows come to the driver and are broadcast
        mine = asked.where(F.pmod(F.xxhash64("row"), F.lit(n)) == b).toArrow()
        lists = mine.column("v").to_pylist()
        shared = context.broadcast(Queries(mine.column("row").to_pylist(), mine.column("id").to_pylist(), [np.array(x, np.float64) for x in lists], k))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            queries = shared.value
            queries.start()
            for rows, ids, found in _blocks(batches, CANDIDATES):
                queries.meet(rows, ids, found)
            for at in range(0, len(queries.rows), 4096):
                out = [(queries.rows[i], queries.ids[i], v, -s) for i in range(at, min(at + 4096, len(queries.rows))) for s, v in queries.best[i]]
                names = ["q", "query_id", "vec_id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(4)], names=names)

        pairs = vectors.mapInArrow(search, "q long, query_id long, vec_id long, score long")
        some = pairs.groupBy("q", "query_id", part.alias("p")).agg(F.expr(keep.format(k=k)).alias("b"))
        best = some.groupBy("q", "query_id").agg(F.expr(f"slice(array_sort(flatten(collect_list(b))), 1, {k})").alias("b"))
        ranked = best.select("query_id", F.posexplode("b").alias("rank", "e")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("e.v").alias(id_col), (-F.col("e.s")).alias("score"))
        # with more blocks than one, each is done and its broadcast dropped before the next
        every.append(saved(ranked))
        shared.destroy()
    discard(vectors)
    out = every[0]
    for x in every[1:]:
        out = out.union(x)
    return out


#: DuckDB SQL of the top five for every fiftieth vector.
ORACLE = """
WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.id AS query_id, c.id AS vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id <> c.id AND len(q.v) = len(c.v) WHERE q.id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
"""
