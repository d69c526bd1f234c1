"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and benchmark items are sequences of words (runs of letters and digits, in lower case). A text holds an
item if some stretch of it is within floor(TOLERANCE * n) word edits of the item's n words.

Windows of an item's size are embedded by CGK random walks, which copy the current word and move on
by a coin that depends on the step and the word; nearby windows in edit distance agree on many steps, whatever the
edits shift. A table has a walk of its own and samples a few of its steps. The items of each length are put into the
tables by what they show there; a window is looked up in every table, and the items that it meets are verified by
the exact edit distance to the best stretch around the window.

How many tables: when the index is built, items of about each length are mutated to the full tolerance, by insertions
only, deletions only, substitutions only, and all three. As many tables are used as let each of the four kinds meet
with the target recall. A length for which MOST_TABLES are not enough uses no tables; its windows meet every item that
the runs below name, which is exact.

Which windows are embedded: by the pigeonhole principle, e edits leave one of e + 1 runs of the item
untouched, so a stretch within tolerance shares ceil((n - e) / (e + 1)) words in a row with it (at most four are asked
for), and n - e words of the item lie within reach. Windows start as far from such a run as e edits can move them.
This drops no window within tolerance.

A text is searched where it is read, so there is no shuffle, no group and no skew. Items are split by a hash into
blocks of about ITEMS; a block's model is a bounded broadcast. With more blocks than one, each is a pass of its
own, whose findings are kept by a hash of the text, and its broadcast goes before the next. Null and
empty texts hold nothing; items that are null or have no words match nothing; items that repeat a text are
all reported. Extra columns are ignored and empty tables give empty or clean results."""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

#: Word edits per word of an item, recall of the tables at that many edits, and items of a broadcast model.
TOLERANCE, RECALL, ITEMS = 0.2, 0.99, 20_000
#: Steps that a table samples, the most tables, trials of each kind of edit, and windows embedded at once.
SAMPLED, MOST_TABLES, TRIALS, AT_ONCE = 2, 384, 150, 2048
EDITS = ("insert", "delete", "replace", "mixed")
WORD = re.compile(r"[^\W_]+")
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def allowed(n: int) -> int:
    return math.floor(TOLERANCE * n + 1e-9)


def run_length(n: int) -> int:
    """Words in a row that a stretch within tolerance shares with an item of n words, four at most."""
    e = allowed(n)
    return min(4, -(-(n - e) // (e + 1)))


def gram_keys(ids: np.ndarray, q: int) -> np.ndarray:
    key = np.zeros(len(ids) - q + 1, np.uint64)
    for i in range(q):
        key += (ids[i : len(ids) - q + 1 + i].astype(np.uint64) + np.uint64(1)) * np.uint64(_MIX[i])
    return key


def cgk(windows: np.ndarray, lengths: np.ndarray, coins: np.ndarray) -> Iterator[np.ndarray]:
    """The steps of the embeddings of windows of word numbers, each a table (windows x walks) of the words that the walks
    show; beyond its length a window shows -1. coins: steps x walks."""
    rows = np.arange(len(windows))[:, None]
    padded = np.concatenate((windows, np.full((len(windows), 1), -1, np.int64)), axis=1)
    padded[np.arange(padded.shape[1]) >= lengths[:, None]] = -1
    at = np.zeros((len(windows), coins.shape[1]), np.int64)
    for coin in coins:
        word = padded[rows, at]
        yield word
        h = (word.astype(np.uint64) + np.uint64(7)) * coin
        h ^= h >> np.uint64(29)
        h *= np.uint64(_MIX[0])
        at += (h >> np.uint64(63)).astype(np.int64)
        np.minimum(at, windows.shape[1], out=at)


def mutated(item: list[int], kind: str, rng: random.Random) -> list[int]:
    """The item's words with allowed(n) edits of a kind; new words have negative numbers that are not in any item."""
    out = list(item)
    for _ in range(allowed(len(item))):
        edit = rng.choice(EDITS[:3]) if kind == "mixed" else kind
        at, new = rng.randrange(len(out) + (edit == "insert")), -rng.randrange(2, 1 << 40)
        if edit == "insert":
            out.insert(at, new)
        elif edit == "replace":
            out[at] = new
        elif len(out) > 1:
            del out[at]
    return out


def distance_to_stretch(item: list[int], text: list[int]) -> int:
    """Word edits between the item and the stretch of the text that is nearest to it."""
    line = np.zeros(len(text) + 1, np.int64)
    words, order = np.array(text, np.int64), np.arange(len(text) + 1)
    for i, word in enumerate(item):
        new = np.empty_like(line)
        new[0] = i + 1
        new[1:] = np.minimum(line[:-1] + (words != word), line[1:] + 1)
        line = np.minimum.accumulate(new - order) + order
    return int(line.min())


class Tables:
    """The hash tables of items of one length."""

    def __init__(self, items: list[list[int]], trials: list[list[int]], recall: float):
        self.n = len(items[0])
        rng = np.random.default_rng(self.n)
        steps = max(SAMPLED, 2 * self.n)
        self.coins = rng.integers(1, 1 << 63, (steps, MOST_TABLES), dtype=np.uint64) | np.uint64(1)
        self.shown = np.zeros((steps, MOST_TABLES), bool)
        for k in range(MOST_TABLES):
            self.shown[rng.choice(steps, SAMPLED, replace=False), k] = True
        self.exact = not self._enough(trials, recall)
        self.items: list[tuple[np.ndarray, np.ndarray]] = []
        if not self.exact:
            for keys in self.keys(items).T:
                order = np.argsort(keys, kind="stable")
                self.items.append((keys[order], order))

    def keys(self, windows: list[list[int]]) -> np.ndarray:
        """(windows x tables): hashes of the words that the tables sample."""
        rows = np.full((len(windows), self.n), -1, np.int64)
        lengths = np.array([min(len(w), self.n) for w in windows], np.int64)
        for i, w in enumerate(windows):
            rows[i, : lengths[i]] = w[: self.n]
        out = np.zeros((len(windows), self.coins.shape[1]), np.uint64)
        for j, word in enumerate(cgk(rows, lengths, self.coins)):
            mine = self.shown[j]
            out[:, mine] = (out[:, mine] ^ (word[:, mine].astype(np.uint64) + np.uint64(j + 1))) * np.uint64(_MIX[1])
        return out

    def _enough(self, trials: list[list[int]], recall: float) -> bool:
        """Keep as many tables as let mutated items of every kind meet their origin; false if there are too few."""
        rng, most = random.Random(17 + self.n), 1
        for kind in EDITS:
            own = [trials[k % len(trials)][: self.n] for k in range(TRIALS)]
            changed = [mutated(x, kind, rng) for x in own]
            # behind a shorter stretch the text goes on
            changed = [x + [-rng.randrange(2, 1 << 40) for _ in range(self.n - len(x))] for x in changed]
            meets = self.keys(own) == self.keys(changed)
            first = np.sort(np.where(meets.any(axis=1), meets.argmax(axis=1), MOST_TABLES))
            most = max(most, int(first[max(0, math.ceil(recall * TRIALS) - 1)]) + 1)
        if most > MOST_TABLES:
            return False
        used = np.flatnonzero(self.shown[:, :most].any(axis=1)).max() + 1
        self.coins, self.shown = self.coins[:used, :most].copy(), self.shown[:used, :most].copy()
        return True

    def lookup(self, windows: list[list[int]]) -> set[tuple[int, int]]:
        """(window, item) that meet in some table; items by their place among those of this length."""
        found: set[tuple[int, int]] = set()
        for at in range(0, len(windows), AT_ONCE):
            for mine, (keys, order) in zip(self.keys(windows[at : at + AT_ONCE]).T, self.items, strict=True):
                first, last = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
                for w in np.flatnonzero(last > first).tolist():
                    found.update((at + w, i) for i in order[first[w] : last[w]].tolist())
        return found


class Index:
    """The items of a block: their words, the runs that lead to windows, and the tables of each length."""

    def __init__(self, items: list[tuple[int, str]], recall: float = RECALL):
        self.ids, self.items = [], []
        self.numbers: dict[str, int] = {}
        for item_id, text in items:
            words = words_of(text)
            if words:
                self.ids.append(item_id)
                self.items.append([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words])
        runs: dict[int, list[tuple[int, int, int]]] = {}
        lengths: dict[int, list[int]] = {}
        for i, item in enumerate(self.items):
            q = run_length(len(item))
            lengths.setdefault(len(item), []).append(i)
            for at, key in enumerate(gram_keys(np.array(item), q).tolist()):
                runs.setdefault(q, []).append((key, i, at))
        self.runs = {}
        for q, found in runs.items():
            found.sort()
            keys = np.array([x[0] for x in found], np.uint64)
            self.runs[q] = (keys, np.array([x[1] for x in found]), np.array([x[2] for x in found]))
        self.lengths = lengths
        self.tables = {n: Tables([self.items[i] for i in own], [self.items[i] for i in own], recall) for n, own in lengths.items()}

    def windows(self, numbers: np.ndarray) -> dict[int, set[int]]:
        """By item, the starts in the text that a run which the text shares with the item points to."""
        found: dict[int, set[int]] = {}
        for q, (keys, items, places) in self.runs.items():
            if len(numbers) < q:
                continue
            known = numbers > 0
            whole = known[: len(numbers) - q + 1].copy()
            for i in range(1, q):
                whole &= known[i : len(numbers) - q + 1 + i]
            spots = np.flatnonzero(whole)
            if not len(spots):
                continue
            seen = gram_keys(numbers, q)[spots]
            first, last = np.searchsorted(keys, seen, "left"), np.searchsorted(keys, seen, "right")
            hit = np.flatnonzero(last > first)
            for spot, a, b in zip(spots[hit].tolist(), first[hit].tolist(), last[hit].tolist(), strict=True):
                for item, place in zip(items[a:b].tolist(), places[a:b].tolist(), strict=True):
                    found.setdefault(item, set()).add(spot - place)
        return found

    def search(self, texts: list[np.ndarray]) -> list[list[tuple[int, int]]]:
        """For each text its (item id, distance), by item id and then distance."""
        # by length of the items: the starts of windows, and for exact lengths the items themselves
        wanted: dict[int, set[tuple[int, int]]] = {}
        named: set[tuple[int, int, int]] = set()
        for t, numbers in enumerate(texts):
            for item, starts in self.windows(numbers).items():
                n = len(self.items[item])
                e = allowed(n)
                own = np.array(self.items[item])
                for start in starts:
                    low = max(0, start - e)
                    if np.isin(own, numbers[low : max(0, start) + n + 2 * e]).sum() < n - e:
                        continue
                    spots = range(low, min(start + e, len(numbers) - 1) + 1)
                    if self.tables[n].exact:
                        named.update((t, item, s) for s in spots)
                    else:
                        wanted.setdefault(n, set()).update((t, s) for s in spots)
        for n, spots in wanted.items():
            every = sorted(spots)
            met = self.tables[n].lookup([texts[t][s : s + n].tolist() for t, s in every])
            named.update((every[w][0], self.lengths[n][i], every[w][1]) for w, i in met)
        found: list[dict[int, int]] = [{} for _ in texts]
        for t, item, s in sorted(named):
            n = len(self.items[item])
            e = allowed(n)
            if found[t].get(item, e + 1) == 0:
                continue
            d = distance_to_stretch(self.items[item], texts[t][max(0, s - e) : s + n + e].tolist())
            if d <= e:
                found[t][item] = min(d, found[t].get(item, d))
        return [sorted((self.ids[item], d) for item, d in x.items()) for x in found]


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return items.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).where("i IS NOT NULL AND t IS NOT NULL")


def _index(rows: DataFrame) -> Index:
    """The index of a block, of about ITEMS rows."""
    return Index([(r.i, r.t) for r in rows.orderBy("i", "t").collect()])


def _found(index: Index, texts: pa.Array) -> list[list[tuple[int, int]]]:
    get = index.numbers.get
    return index.search([np.fromiter((get(w, 0) for w in words_of(x.as_py())), np.int64) for x in texts])


FOUND = "array<struct<item:long,distance:int>>"
_FOUND = pa.list_(pa.struct([("item", pa.int64()), ("distance", pa.int32())]))


def _searched(rows: DataFrame, index: Index) -> DataFrame:
    """Rows (key, text) as (key, found)."""
    shared = rows.sparkSession.sparkContext.broadcast(index)
    key = rows.columns[0]
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [[{"item": i, "distance": d} for i, d in x] for x in _found(shared.value, part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, _FOUND)], names=[key, "found"])

    return rows.mapInArrow(run, f"{key} {kind}, found {FOUND}")


def _passes(docs: DataFrame, items: DataFrame, n: int, text_col: str) -> DataFrame:
    """(h, item, distance) of all blocks; h is a hash of the text. Each block is read, broadcast and searched by itself."""
    texts = docs.where(F.col(text_col).isNotNull()).select(_text_hash(text_col).alias("h"), F.col(text_col).cast("string").alias("t"))
    every = None
    for k in range(n):
        own = _searched(texts, _index(items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)))
        part = saved(own.select("h", F.explode("found").alias("f")).select("h", "f.item", "f.distance").distinct())
        every = part if every is None else every.union(part)
    return every


def _text_hash(text_col: str) -> F.Column:
    return F.sha2(F.col(text_col).cast("string").cast("binary"), 256)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block: int = ITEMS) -> DataFrame:
    """Per row of docs: id_col and found, array<struct<item,distance>>, by item."""
    rows = _items(items, item_col, item_text)
    n = -(-rows.count() // block) or 1
    if n == 1:
        return _searched(docs.select(id_col, F.col(text_col).cast("string").alias("_t")), _index(rows))
    lists = _passes(docs, rows, n, text_col).groupBy("h").agg(F.array_sort(F.collect_list(F.struct("item", "distance"))).alias("found"))
    own = docs.select(id_col, _text_hash(text_col).alias("h"))
    return own.join(lists, "h", "left").select(id_col, F.coalesce("found", F.expr(f"CAST(array() AS {FOUND})")).alias("found"))


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block: int = ITEMS) -> DataFrame:
    """The rows of docs that hold no item, with their own columns."""
    rows = _items(items, item_col, item_text)
    n = -(-rows.count() // block) or 1
    if n > 1:
        return docs.alias("d").join(_passes(docs, rows, n, text_col).select("h").distinct().alias("f"), _text_hash(f"d.{text_col}") == F.col("f.h"), "left_anti")
    shared = docs.sparkSession.sparkContext.broadcast(_index(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield part.filter(pa.array([not x for x in _found(shared.value, part.column(text_col))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
