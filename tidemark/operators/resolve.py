"""Entity resolution of raw names against a seed dimension: alias, normalised name, domain, similarity, review, novel."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.similar import PREFIX, common, least_jaro
from tidemark.functions.text import _jaro_winkler, normalize_name
from tidemark.tables import discard, stored

#: Similarities from which a name is accepted and reviewed, and confidence by method.
ACCEPT, REVIEW = 0.92, 0.70
CONFIDENCE = {"exact_alias": 1.0, "normalization": 0.98, "context_match": 0.95}
#: Seeds that open names are compared with at once; each block of them reaches the workers by itself.
BLOCK = 20_000


def alias_table(seeds: DataFrame) -> DataFrame:
    """(alias, canonical, ordinal) of canonical_name and aliases, in lower case; of a repeated alias the last seed holds."""
    every = seeds.select("canonical_name", "ordinal", F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("alias"))
    return every.groupBy(F.lower("alias").alias("alias")).agg(F.max_by("canonical_name", "ordinal").alias("canonical"), F.max("ordinal").alias("ordinal"))


#: Characters of a name that its places are kept for as bits; longer names are compared one by one.
BITS = 64
#: Names that are compared with a group of blocks by one task, and the most tasks that they are dealt to.
NAMES_A_TASK, MOST_TASKS = 500, 4096
#: Blocks of seeds that reach the workers together; what a name has found in a group bounds what it looks for in the next.
GROUP = 5
#: Names whose letters are counted at once, pairs that are compared at once, seeds that share most letters and are looked at first,
#: steps of similarity that a bound is rounded down to.
TOGETHER, PAIRS, FIRST, STEPS = 64, 1 << 14, 32, 200
#: Arrays of needed letters that a block keeps.
KEPT = 256


@lru_cache(maxsize=1)
def _windows() -> np.ndarray:
    """The bits of the places of a name that may match a place of another, by the other's length, that place and the name's length."""
    n = np.arange(BITS + 1)
    own, i, other = np.meshgrid(n, n[:BITS], n, indexing="ij")
    reach = np.maximum(own, other) // 2 - 1
    low = np.maximum(0, i - reach)
    high = np.maximum(low, np.minimum(other, i + reach + 1))
    below = np.array([min((1 << k) - 1, 2**64 - 1) for k in range(2 * BITS)], np.uint64)
    return (below[high] & ~below[low]).reshape(-1)


@lru_cache(maxsize=4096)
def _least_shared(length: int, threshold: float) -> np.ndarray:
    """Letters in common that a name of that length needs for the threshold, by the characters of the common beginning and the length
    of the other name; names of more than BITS characters need none, as they are compared by themselves."""
    out = np.zeros((PREFIX + 1, BITS + 2), np.uint8)
    for prefix in range(PREFIX + 1):
        for other in range(1, BITS + 1):
            out[prefix, other] = min(255, common(min(length, other), max(length, other), least_jaro(threshold, prefix)))
    return out


class Nearest:
    """A block of seeds (ordinal, canonical, normalised name), sorted by name, that many names are compared with.

    For each letter the seeds that hold it are a row of bytes, so one operation counts a letter for all seeds; the places where a seed
    holds a letter are bits of a number, so one operation compares a character of many pairs. Names of a common beginning lie together.
    The similarity of two names is the same in either order: of equal letters the first of both sides match."""

    def __init__(self, seeds: list[tuple[int, str, str]]):
        self.seeds = sorted(seeds, key=lambda x: (x[2], x[0]))
        self.names, size = [n for _, _, n in self.seeds], len(self.seeds)
        self.ordinals = np.array([o for o, _, _ in self.seeds], np.int64)
        self.lengths = np.array([len(n) for n in self.names], np.int64)
        self.capped = np.minimum(self.lengths, BITS + 1).astype(np.uint8)
        self.letters = {c: k for k, c in enumerate(sorted(set("".join(self.names))))}
        self.counts = np.zeros((len(self.letters), size), np.uint8)
        # the last row is that of a character that no seed holds
        self.places = np.zeros((len(self.letters) + 1, size), np.uint64)
        codes, _ = self._codes(self.names)
        for j in range(codes.shape[1]):
            rows = np.flatnonzero(self.lengths > j)
            self.counts[codes[rows, j], rows] += 1
            self.places[codes[rows, j], rows] |= np.uint64(1 << j)
        for i in np.flatnonzero(self.lengths > BITS).tolist():
            for ch in self.names[i][BITS:]:
                k = self.letters[ch]
                self.counts[k, i] = min(255, int(self.counts[k, i]) + 1)
        self.held = (self.counts > 0).view(np.uint8)
        self.equal: dict[str, int] = {}
        for i, n in enumerate(self.names):
            self.equal.setdefault(n, i)
        self.least: dict[tuple[int, float, int], np.ndarray] = {}

    def __reduce__(self):
        return Nearest, (self.seeds,)

    def _codes(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The first BITS characters of names as rows of `places`, and the lengths of the names."""
        lengths = np.fromiter(map(len, names), np.int64, len(names))
        out = np.full((len(names), min(BITS, int(lengths.max(initial=0)))), len(self.letters), np.int64)
        flat = np.fromiter((self.letters.get(c, len(self.letters)) for n in names for c in n[:BITS]), np.int64)
        out[np.arange(out.shape[1]) < lengths[:, None]] = flat
        return out, lengths

    def _shared(self, name: str, start: int, end: int) -> np.ndarray:
        """Letters that a name of at most BITS characters has in common with each of the seeds from start to end."""
        own: dict[str, int] = {}
        for ch in name:
            own[ch] = own.get(ch, 0) + 1
        shared = np.zeros(end - start, np.uint8)
        for ch, n in own.items():
            k = self.letters.get(ch)
            if k is not None:
                shared += self.held[k, start:end] if n == 1 else np.minimum(self.counts[k, start:end], np.uint8(n))
        return shared

    def _beginnings(self, name: str) -> list[tuple[int, int]]:
        """For 0, 1, … characters the range of the seeds that begin with as many of the name."""
        out = [(0, len(self.names))]
        for p in range(1, min(PREFIX, len(name)) + 1):
            low, high = out[-1]
            low = bisect_left(self.names, name[:p], low, high)
            out.append((low, bisect_right(self.names, name[:p], low, high, key=lambda n, p=p: n[:p])))
        return out

    def _needed(self, length: int, threshold: float, prefix: int) -> np.ndarray:
        key = (length, threshold, prefix)
        if key not in self.least:
            if len(self.least) >= KEPT:
                self.least.clear()
            self.least[key] = _least_shared(length, threshold)[prefix][self.capped]
        return self.least[key]

    def may_be_alike(self, name: str, threshold: float, start: int = 0, shared: np.ndarray | None = None) -> np.ndarray:
        """Places, from start on, of the seeds that letters, lengths and common beginnings allow to reach the threshold."""
        if len(name) > BITS:
            return np.arange(start, len(self.names))
        shared = self._shared(name, start, len(self.names)) if shared is None else shared
        ranges, found = self._beginnings(name), []
        edges = [(low, p) for p, (low, _) in enumerate(ranges)] + [(high, p - 1) for p, (_, high) in reversed(list(enumerate(ranges)))]
        for (a, p), (b, _) in zip(edges, edges[1:]):
            a = max(a, start)
            if a < b:
                found.append(a + np.flatnonzero(shared[a - start : b - start] >= self._needed(len(name), threshold, p)[a:b]))
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def similarities(self, names: list[str], which: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The similarity of names[which] to the seeds at rows, as _jaro_winkler has it."""
        codes, own = self._codes(names)
        out = np.empty(len(rows))
        for at in range(0, len(rows), PAIRS):
            some = slice(at, at + PAIRS)
            out[some] = self._similar(codes, own, which[some], rows[some])
        for k in np.flatnonzero((own[which] > BITS) | (self.lengths[rows] > BITS)).tolist():
            out[k] = _jaro_winkler(names[which[k]], self.names[rows[k]])
        return out

    def _similar(self, codes: np.ndarray, own: np.ndarray, which: np.ndarray, rows: np.ndarray) -> np.ndarray:
        la, lb, one = own[which], self.lengths[rows], np.uint64(1)
        windows, at = _windows(), np.minimum(la, BITS) * (BITS * (BITS + 1)) + np.minimum(lb, BITS)
        taken, m, swaps, hits = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), []
        width = int(min(BITS, la.max(initial=0)))
        chosen = np.ascontiguousarray(codes[which, :width].T)
        for i in range(width):
            places = self.places[chosen[i], rows]
            free = places & windows[at + i * (BITS + 1)] & ~taken
            first = free & (~free + one)
            taken |= first
            hit = first != 0
            m += hit
            hits.append((places, hit))
        left = taken
        for places, hit in hits:  # the k-th match of either side, in their order
            first = left & (~left + one)
            swaps += hit & ((places & first) == 0)
            left = np.where(hit, left ^ first, left)
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(m > 0, (m / la + m / lb + (m - swaps // 2) / m) / 3, 0.0)
        prefix, same = np.zeros(len(rows), np.int64), np.ones(len(rows), bool)
        for i in range(min(PREFIX, width)):
            same &= (self.places[chosen[i], rows] & np.uint64(1 << i)) != 0
            prefix += same
        out = np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
        return np.where((prefix == la) & (la == lb), 1.0, out)  # equal letters alone match nothing

    def alike(self, names: list[str], threshold: float, starts: list[int] | None = None) -> Iterator[tuple[int, int]]:
        """(place among names, place among seeds) of the pairs whose similarity reaches the threshold; of each name the seeds from its
        start on. Pairs are compared when there are many of them."""
        which, rows, size = [], [], 0
        for k, name in enumerate(names):
            found = self.may_be_alike(name, threshold, starts[k] if starts else 0)
            if len(found):
                which.append(np.full(len(found), k)), rows.append(found)
                size += len(found)
            if size >= PAIRS or size and k == len(names) - 1:
                w, r = np.concatenate(which), np.concatenate(rows)
                good = self.similarities(names, w, r) >= threshold
                yield from zip(w[good].tolist(), r[good].tolist(), strict=True)
                which, rows, size = [], [], 0
        if size:
            w, r = np.concatenate(which), np.concatenate(rows)
            good = self.similarities(names, w, r) >= threshold
            yield from zip(w[good].tolist(), r[good].tolist(), strict=True)

    def holds_alike(self, names: list[str], threshold: float) -> set[int]:
        """Places of the names that are equal or similar to a seed."""
        found = {k for k, n in enumerate(names) if n in self.equal}
        rest = [k for k in range(len(names)) if k not in found]
        return found | {rest[k] for k, _ in self.alike([names[k] for k in rest], threshold)}

    def best(self, names: list[str], known: list[tuple[int, str, float] | None], least: float = REVIEW) -> list[tuple[int, str, float] | None]:
        """For each name (ordinal, canonical, similarity) of the most similar seed or what is known, whichever is better, the first by
        ordinal of several; none that is below `least`."""
        out = []
        for at in range(0, len(names), TOGETHER):
            out += self._best(names[at : at + TOGETHER], known[at : at + TOGETHER], least)
        return out

    def _best(self, names: list[str], known: list, least: float) -> list:
        best = list(known)

        def take(which: list[np.ndarray], rows: list[np.ndarray]) -> None:
            if not rows:
                return
            w, r = np.concatenate(which), np.concatenate(rows)
            scores = self.similarities(names, w, r)
            order = np.lexsort((self.ordinals[r], -scores, w))
            for i in order[np.unique(w[order], return_index=True)[1]].tolist():
                k, (ordinal, canonical, _), score = int(w[i]), self.seeds[r[i]], float(scores[i])
                if score >= least and (best[k] is None or (score, -ordinal) > (best[k][2], -best[k][0])):
                    best[k] = (ordinal, canonical, score)

        open_ = []
        for k, name in enumerate(names):
            if name in self.equal:
                found = (*self.seeds[self.equal[name]][:2], 1.0)
                best[k] = found if best[k] is None or (1.0, -found[0]) > (best[k][2], -best[k][0]) else best[k]
            elif name and self.seeds:
                open_.append(k)
        shared = {k: self._shared(names[k], 0, len(self.names)) for k in open_ if len(names[k]) <= BITS}
        which, rows = [], []
        for k, letters in shared.items():
            # a good one first, so that few others may be better
            low, high = self._beginnings(names[k])[-1]
            first = np.concatenate([np.flatnonzero(letters == letters.max())[:FIRST], low + np.argsort(-letters[low:high].astype(np.int16), kind="stable")[:FIRST]])
            which.append(np.full(len(first), k)), rows.append(first)
        take(which, rows)
        which, rows, size = [], [], 0
        for k in open_:
            bound = max(least, int(best[k][2] * STEPS) / STEPS) if best[k] else least
            found = self.may_be_alike(names[k], bound, 0, shared.get(k))
            which.append(np.full(len(found), k)), rows.append(found)
            size += len(found)
            if size >= PAIRS:
                take(which, rows)
                which, rows, size = [], [], 0
        take(which, rows)
        return best

    def __call__(self, name: str, least: float = REVIEW) -> tuple[int, str, float] | None:
        """(ordinal, canonical, similarity), or none that reaches `least`."""
        return self.best([name], [None], least)[0]


def _nearest_udf(blocks: Broadcast):
    @F.pandas_udf("struct<ordinal:long,best:string,score:double>")
    def nearest(norms: pd.Series, ordinals: pd.Series, names: pd.Series, scores: pd.Series) -> pd.DataFrame:
        known = [None if name is None else (int(o), name, s) for o, name, s in zip(ordinals, names, scores, strict=True)]
        asked = norms.tolist()
        for block in blocks.value:
            known = block.best(asked, known)
        rows = [r or (None, None, None) for r in known]
        return pd.DataFrame({"ordinal": pd.array([r[0] for r in rows], "Int64"), "best": [r[1] for r in rows], "score": pd.array([r[2] for r in rows], "Float64")})

    return nearest


def nearest_seeds(names: DataFrame, seeds: DataFrame, decompose: bool, block: int, group: int = GROUP) -> DataFrame:
    """(_norm, best, score) of the names whose most similar seed reaches REVIEW. All names meet all seeds, whose letters decide most
    pairs; tasks are as many as the names need, and what a task holds is bounded by a group of blocks of seeds.

    Of seeds with the same normalised name the first by ordinal holds, as they are equally similar to any name."""
    known = seeds.select("ordinal", "canonical_name", normalize_name(F.col("canonical_name"), decompose).alias("n")).where("n <> ''")
    known = stored(known.groupBy("n").agg(F.min_by(F.struct("ordinal", "canonical_name"), "ordinal").alias("s")).select("s.*", "n"))
    none = lambda kind: F.lit(None).cast(kind)
    names = stored(names.select("_norm", none("long").alias("ordinal"), none("string").alias("best"), none("double").alias("score")))
    parts, tasks = -(-known.count() // block) or 1, -(-names.count() // NAMES_A_TASK) or 1
    context = names.sparkSession.sparkContext
    dealt = known.withColumn("_part", F.pmod(F.xxhash64("n"), F.lit(parts)))
    for k in range(0, parts, group):
        # about `group` times `block` rows come to the driver
        rows: dict[int, list] = {}
        for r in dealt.where(F.col("_part").between(k, k + group - 1)).collect():
            rows.setdefault(r["_part"], []).append((r.ordinal, r.canonical_name, r.n))
        blocks = context.broadcast([Nearest(x) for x in rows.values()])
        # names are few bytes and much work: their number is dealt, not their size
        found = names.repartition(min(tasks, MOST_TASKS)).select("_norm", _nearest_udf(blocks)("_norm", "ordinal", "best", "score").alias("s"))
        after = stored(found.select("_norm", "s.*"))
        discard(names)
        names = after
        blocks.destroy()
    discard(known)
    return names.where("best IS NOT NULL").select("_norm", "best", "score")


def resolve(raw: DataFrame, seeds: DataFrame, name: str = "raw_name", domain: str | None = None, decompose: bool = True, block: int = BLOCK) -> DataFrame:
    """raw with canonical, method, confidence and decision.

    seeds has ordinal, canonical_name, aliases and domain. Similarity is computed once per distinct name that no
    lookup resolves, with one group of blocks of seeds after the other; only seeds whose letters allow a better similarity than the
    best so far are compared in full."""
    aliases = alias_table(seeds)
    normal = aliases.withColumn("norm", normalize_name(F.col("alias"), decompose)).where("norm <> ''").groupBy("norm").agg(F.max_by("canonical", "ordinal").alias("by_norm"))
    domains = seeds.where("domain IS NOT NULL").groupBy(F.lower("domain").alias("d")).agg(F.min_by("canonical_name", "ordinal").alias("by_domain"))
    rows = raw.withColumn("_raw", F.trim(name)).withColumn("_low", F.lower("_raw")).withColumn("_norm", normalize_name(F.col("_raw"), decompose))
    rows = rows.withColumn("_domain", F.lower(F.replace(F.col(domain), F.lit("www."), F.lit(""))) if domain else F.lit(None).cast("string"))
    rows = rows.join(aliases.select(F.col("alias").alias("_low"), F.col("canonical").alias("by_alias")), "_low", "left")
    rows = rows.join(normal.withColumnRenamed("norm", "_norm"), "_norm", "left")
    rows = rows.join(domains.withColumnRenamed("d", "_domain"), "_domain", "left")
    open_names = rows.where("by_alias IS NULL AND by_norm IS NULL AND by_domain IS NULL AND _norm <> ''").select("_norm").distinct()
    rows = rows.join(nearest_seeds(open_names, seeds, decompose, block), "_norm", "left")
    blank = F.coalesce("_raw", F.lit("")) == ""
    score = F.coalesce("score", F.lit(0.0))

    def pick(*values: Column) -> Column:
        tests = [blank, F.col("by_alias").isNotNull(), F.col("by_norm").isNotNull(), F.col("by_domain").isNotNull(), score >= ACCEPT, score >= REVIEW]
        found = F.when(tests[0], values[0])
        for test, value in zip(tests[1:], values[1:], strict=False):
            found = found.when(test, value)
        return found.otherwise(values[-1])

    text = lambda x: F.lit(x)
    return rows.select(
        *[F.col(c) for c in raw.columns],
        pick(F.lit(None).cast("string"), F.col("by_alias"), F.col("by_norm"), F.col("by_domain"), F.col("best"), F.lit(None).cast("string"), F.col("_raw")).alias("canonical"),
        pick(*map(text, ["exact_alias", "exact_alias", "normalization", "context_match", "fuzzy_match", "manual_review", "exact_alias"])).alias("method"),
        pick(F.lit(0.0), F.lit(1.0), F.lit(0.98), F.lit(0.95), F.round(score, 4), F.round(score, 4), F.lit(1.0)).alias("confidence"),
        pick(*map(text, ["REJECTED", "ACCEPTED", "ACCEPTED", "ACCEPTED", "ACCEPTED", "REVIEW", "ACCEPTED"])).alias("decision"),
    )


def mapping_log(resolved: DataFrame, name: str = "raw_name", url: str = "source_url") -> DataFrame:
    """One row per decision; rejected blanks are not logged."""
    return resolved.where("decision <> 'REJECTED'").select(F.col(name).alias("rawName"), F.col("canonical").alias("canonicalName"), "method", "confidence", F.col(url).alias("sourceUrl"), "decision")
