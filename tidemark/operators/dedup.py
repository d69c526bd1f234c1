"""Three-tier deduplication with first-wins semantics.

Records arrive in the order of seq. A record is a duplicate if an earlier survivor has its exact key, its
normalised key, or a similar name in its block; dropped records shield nobody. Equal keys form cliques, which are
handled by minima per key and never expanded; only similar names become pairs, and of large blocks these are found tile by tile.
Before that the first records in order are decided and take along all that are like them, while that settles much."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import jaro_winkler, may_reach
from tidemark.operators.resolve import MOST_TASKS, Nearest
from tidemark.tables import discard, stored


def first_wins(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The first row of each key; rows without a key all stay."""
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(seq).alias("_first"))
    return df.join(first, key, "left").where(F.col("_first").isNull() | (F.col(seq) == F.col("_first"))).select(*df.columns)


#: Names of a block that are all compared with each other.
SMALL = 1024


def fuzzy_pairs(names: DataFrame, threshold: float = 0.90, block: str = "block", name: str = "norm", small: int = SMALL) -> DataFrame:
    """(block, a, b, score): distinct names of a block, a < b, whose similarity reaches the threshold.

    In a block of at most `small` names all pairs are compared whose lengths allow the similarity. A larger block is dealt into
    tiles (see candidates), so no task holds a block, and only similar names leave them."""
    distinct = stored(names.select(F.col(block).alias("block"), F.col(name).alias("n")).where("n <> ''").distinct())
    large = stored(distinct.groupBy("block").agg(F.count("*").alias("names")).where(F.col("names") > small))
    rest = distinct.join(large, "block", "left_anti")
    pairs = rest.withColumnRenamed("n", "a").join(rest.withColumnRenamed("n", "b"), "block").where((F.col("a") < F.col("b")) & may_reach(F.col("a"), F.col("b"), threshold))
    if not large.isEmpty():
        pairs = pairs.unionByName(candidates(distinct.join(large, "block"), threshold, small))
    return pairs.withColumn("score", jaro_winkler("a", "b")).where(F.col("score") >= threshold)


#: A tile has at most about this many times `small` names on either side.
TILE = 8


def candidates(rows: DataFrame, threshold: float, small: int = SMALL) -> DataFrame:
    """(block, a, b), a < b: the similar pairs of rows (block, n, names) of large blocks, names distinct.

    A block's names are dealt by hash; each two of its parts meet in a tile, where letters in common rule most pairs out and the rest
    is compared one name with many. Nothing is written but names, once for each part of their block."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        block, r, c = frame["block"].iloc[0], frame["r"].iloc[0], frame["c"].iloc[0]
        sides = [sorted(frame["n"][frame["h"] == x]) for x in ((r, c) if r != c else (r,))]
        made = [Nearest([(i, n, n) for i, n in enumerate(side)]) for side in sides]
        out = []
        for side, other in zip(sides, made[::-1], strict=True):
            # the lesser name of a pair is compared with the greater ones
            starts = [bisect_right(other.names, n) for n in side]
            out += [(block, side[k], other.names[i]) for k, i in other.alike(side, threshold, starts)]
        return pd.DataFrame(out, columns=["block", "a", "b"])

    parts = F.ceil(F.col("names") / (small * TILE)).cast("int")
    dealt = rows.select("block", "n", parts.alias("_p"), F.pmod(F.xxhash64("n"), parts).cast("int").alias("h"))
    placed = dealt.select("block", "n", "h", F.explode(F.sequence(F.lit(0), F.col("_p") - 1)).alias("k"))
    placed = placed.select("block", "n", "h", F.least("h", "k").alias("r"), F.greatest("h", "k").alias("c"))
    # a tile is few bytes and much work: the number of tasks follows from that of names, not from their size
    tasks = min(MOST_TASKS, max(1, -(-placed.count() // (small * TILE))))
    return placed.repartition(tasks * 2, "block", "r", "c").groupBy("block", "r", "c").applyInPandas(compare, "block string, a string, b string")


#: Rounds of joins before the rest is decided in order, and rows of a part that one task then reads.
JOIN_ROUNDS, PART = 3, 500_000


def survivors(records: DataFrame, threshold: float = 0.90, part: int = PART) -> DataFrame:
    """records (seq, exact, norm, block, …) with status "keep" or "duplicate". seq is not null and differs between records.

    A round decides every record whose earlier neighbours are decided. A few rounds of joins settle all but chains of similar
    names, which would need a round for each link. What is open then is dealt by ranges of seq into parts of a bounded number
    of rows; a task goes through its part in order, so a chain of any length within a part takes one round, and the first part is
    always settled whole. There is no limit on rounds, and each needs fewer parts than the one before."""
    base = records.select("seq", "exact", F.concat_ws("|", F.split_part("block", F.lit(":"), F.lit(1)), "norm").alias("norm"), "block", F.col("norm").alias("name"))
    state, settled = stored(base.withColumn("status", F.lit("open"))), []
    open_ = state.count()
    while open_ > LEAD_FROM:
        after = stored(_led(state, threshold, open_))
        discard(state)
        settled.append(stored(after.where("status <> 'open'").select("seq", "status")))
        state = stored(after.where("status = 'open'"))
        discard(after)
        before, open_ = open_, state.count()
        if (before - open_) * LEAST_SHARE < before:
            break
    # what is open now is like no kept record, so only open records matter to each other
    base = state.drop("status")
    pairs = stored(fuzzy_pairs(base, threshold, name="name"))
    both = pairs.select("block", "a", "b").union(pairs.select("block", F.col("b").alias("a"), F.col("a").alias("b")))
    near = stored(base.select("seq", "block", F.col("name").alias("a")).join(both, ["block", "a"]).select("seq", F.concat_ws("|", "block", "b").alias("other")))
    state = stored(base.withColumn("place", F.concat_ws("|", "block", "name")).withColumn("status", F.lit("open")))
    rounds = 0
    while not state.where("status = 'open'").isEmpty():
        seen = _bounds(state, near)
        if rounds < JOIN_ROUNDS:
            earlier = lambda kind: F.coalesce(F.least(*[F.coalesce(f"{t}_{kind}", F.lit(1 << 62)) for t in ("exact", "norm", "near")]), F.lit(1 << 62)) < F.col("seq")
            status = F.when(F.col("status") != "open", F.col("status")).when(earlier("keep"), "duplicate").when(earlier("open"), "open").otherwise("keep")
            after = stored(seen.select("seq", "exact", "norm", "block", "name", "place", status.alias("status")))
        else:
            decided = _in_order(seen.where("status = 'open'"), near, part)
            after = stored(state.join(decided.withColumnRenamed("status", "now"), "seq", "left").withColumn("status", F.coalesce("now", "status")).drop("now"))
        discard(state)
        state, rounds = after, rounds + 1
    out = records.join(reduce(DataFrame.unionByName, settled, state.select("seq", "status")), "seq")
    discard(pairs, near)
    return out


#: Records that are decided at once before all others are compared with those of them that stay: one in HEAD_SHARE of the open ones, but
#: no fewer than HEAD and no more than MOST_HEAD; open records from which that is done, and the share of them (one in so many) that it
#: must settle to be done again.
HEAD, MOST_HEAD, HEAD_SHARE, LEAD_FROM, LEAST_SHARE = 1024, 16_384, 16, 4096, 8


#: Records that one task compares with the records that lead.
NAMES_A_TASK = 2048


def _led(state: DataFrame, threshold: float, rows: int) -> DataFrame:
    """Open records with the status of the first of them in order, which depends on no other, and of those that are
    like one of these that stays. Where most names are alike, a few such records settle the table without its pairs."""
    # MOST_HEAD rows at most come to the driver and go to the tasks
    size = max(HEAD, min(MOST_HEAD, rows // HEAD_SHARE))
    head = [(r.seq, r.exact, r.norm, r.block, r.name) for r in state.orderBy("seq").limit(size).collect()]
    leaders = _Leaders(threshold)
    shared = state.sparkSession.sparkContext.broadcast((leaders, leaders.lead(head)))

    @F.pandas_udf("string")
    def judged(seq: pd.Series, exact: pd.Series, norm: pd.Series, block: pd.Series, name: pd.Series) -> pd.Series:
        kept, decided = shared.value
        some = lambda column: [x if isinstance(x, str) else None for x in column]
        claimed = kept.claimed(*map(some, (exact, norm, block, name)))
        return pd.Series([decided.get(s) or ("duplicate" if c else "open") for s, c in zip(seq, claimed, strict=True)])

    # names are few bytes and much work: their number is dealt, not their size
    dealt = state.repartition(min(MOST_TASKS, -(-rows // NAMES_A_TASK)))
    return dealt.withColumn("status", judged("seq", "exact", "norm", "block", "name"))


class _Leaders:
    """Keys and names of records that stay, by block."""

    def __init__(self, threshold: float):
        self.threshold, self.exact, self.norm, self.names, self.made = threshold, set(), set(), {}, {}

    def lead(self, rows: list[tuple]) -> dict:
        """Decide rows (seq, exact, norm, block, name) in order; the status by seq. Those that stay lead."""
        blocks, near, out = {}, {}, {}
        for _, _, _, block, name in rows:
            if block is not None and name:
                blocks.setdefault(block, set()).add(name)
        for block, names in blocks.items():
            names = sorted(names)
            for k, i in Nearest([(i, n, n) for i, n in enumerate(names)]).alike(names, self.threshold):
                near.setdefault((block, names[k]), []).append((block, names[i]))
        places = set()
        for seq, exact, norm, block, name in rows:
            twin = exact in self.exact or norm in self.norm or any(x in places for x in near.get((block, name), ()))
            out[seq] = "duplicate" if twin else "keep"
            if not twin:
                self.exact |= {exact} - {None}
                self.norm |= {norm} - {None}
                if block is not None and name:
                    places.add((block, name))
        for block, name in places:
            self.names.setdefault(block, []).append(name)
        return out

    def claimed(self, exact: list, norm: list, block: list, name: list) -> list[bool]:
        """Whether a record that stays has the exact key, the normalised key or a similar name in the block, for many records."""
        out = [e in self.exact or n in self.norm for e, n in zip(exact, norm, strict=True)]
        places = {}
        for i, (b, n) in enumerate(zip(block, name, strict=True)):
            if not out[i] and n and b in self.names:
                places.setdefault(b, {}).setdefault(n, []).append(i)
        for b, names in places.items():
            if b not in self.made:
                self.made[b] = Nearest([(i, n, n) for i, n in enumerate(sorted(self.names[b]))])
            asked = list(names)
            for k in self.made[b].holds_alike(asked, self.threshold):
                for i in names[asked[k]]:
                    out[i] = True
        return out


def _bounds(state: DataFrame, near: DataFrame) -> DataFrame:
    """state with, for its exact key, its normalised key and similar names, the first record that is kept and the first that is open."""
    keep, left = F.min(F.when(F.col("status") == "keep", F.col("seq"))), F.min(F.when(F.col("status") == "open", F.col("seq")))
    bounds = {c: state.where(F.col(c).isNotNull()).groupBy(c).agg(keep.alias(f"{c}_keep"), left.alias(f"{c}_open")) for c in ("exact", "norm")}
    by_place = state.groupBy(F.col("place").alias("other")).agg(keep.alias("k"), left.alias("o"))
    fuzzy = near.join(by_place, "other").groupBy("seq").agg(F.min("k").alias("near_keep"), F.min("o").alias("near_open"))
    return state.join(bounds["exact"], "exact", "left").join(bounds["norm"], "norm", "left").join(fuzzy, "seq", "left")


def _in_order(rows: DataFrame, near: DataFrame, part: int) -> DataFrame:
    """(seq, status) of the open records that their part of the order decides; `rows` has the bounds of each.

    A part is a range of seq. It knows which keys its own records have taken or may take, and by the bounds which
    records have an open neighbour before the part; these stay open unless a kept record claims them."""
    bound = lambda kind: F.least(*[F.coalesce(f"{t}_{kind}", F.lit(1 << 62)) for t in ("exact", "norm", "near")])
    own = lambda tag, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(tag), F.col(c)))
    # a record looks at its keys and at the places of similar names; once kept, it takes its keys and its own place
    mine = rows.select("seq", bound("keep").alias("kept"), bound("open").alias("open"), F.array_compact(F.array(own("e", "exact"), own("n", "norm"))).alias("keys"), F.concat(F.lit("p"), "place").alias("place"))
    looks = rows.select("seq").join(near, "seq").select("seq", F.concat(F.lit("p"), "other").alias("other"))
    none = lambda kind: F.lit(None).cast(kind)
    lines = mine.withColumn("other", none("string")).unionByName(looks.select("seq", F.lit(0).cast("bigint").alias("kept"), F.lit(0).cast("bigint").alias("open"), none("array<string>").alias("keys"), none("string").alias("place"), "other"))
    lines = stored(lines)
    parts = max(1, -(-lines.count() // part))

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, taken, doubtful = None, set(), set()
        record, others = None, []

        def settle() -> tuple:
            seq, kept, open_, keys, place = record
            looked = [*keys, *others]
            if kept < seq or any(k in taken for k in looked):
                return seq, "duplicate"
            if open_ < first or any(k in doubtful for k in looked):
                doubtful.update([*keys, place])
                return seq, "open"
            taken.update([*keys, place])
            return seq, "keep"

        for frame in frames:
            out = []
            for seq, kept, open_, keys, place, other in frame[["seq", "kept", "open", "keys", "place", "other"]].itertuples(index=False, name=None):
                first = seq if first is None else first
                if isinstance(other, str):
                    others.append(other)
                    continue
                if record is not None:
                    out.append(settle())
                record, others = (seq, kept, open_, list(keys), place), []
            yield pd.DataFrame(out, columns=["seq", "status"])
        if record is not None:
            yield pd.DataFrame([settle()], columns=["seq", "status"])

    # all lines of a record meet, its own first; no range cuts a record, as ranges are of seq alone
    dealt = lines.repartitionByRange(parts, "seq").sortWithinPartitions("seq", F.col("other").asc_nulls_first())
    decided = stored(dealt.mapInPandas(decide, "seq long, status string"))
    discard(lines)
    return decided


def dedup_stats(judged: DataFrame) -> DataFrame:
    """Records seen and dropped, and distinct keys and blocks of the survivors."""
    kept = F.col("status") == "keep"
    return judged.agg(
        F.count("*").alias("total_seen"),
        F.count_if(~kept).alias("duplicates"),
        F.count_distinct(F.when(kept, F.col("exact"))).alias("exact_keys"),
        F.count_distinct(F.when(kept, F.col("norm"))).alias("normalized_keys"),
        F.count_distinct(F.when(kept, F.col("block"))).alias("blocks"),
    )
