"""Toxicity by noisy-channel deobfuscation.

A character trigram model is counted over all documents. Tokens that look disguised (letters beside
digits or symbols, letters drawn out, letters spelled apart) become a lattice: each character may
stand for itself or for the letters that it imitates, a repeat may be swallowed, a separator may be
deleted, and in spelled-out runs a word may end after any letter. A Viterbi search over the lattice
finds the likeliest letters under channel costs and the trigram model. Plain tokens stay as they are. The
restored text is scored by a logistic regression on the words it holds and their beginnings.

The regression is fitted on a bounded sample of labelled rows: the first SAMPLE of them in the order
of a hash of their id, equal texts counted once. Its features are all that toxic rows of the sample share and that tell the
kinds apart with TELLING or more. Trigram counts cover everything. Rows with crc32(id as text) mod 3 = 1 are
held out; labels, language, source and id are never inputs. Of a labelled id that repeats, the larger label holds.

Null text counts as empty and gets the score of a text without features. If no label can be learned
from, or only one kind, the score is the share of toxic labels (0 without labels). Repeated rows are
scored alike, ids may be null, extra columns are ignored, and an empty table gives an empty result."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, saved

#: Labelled rows that the classifier is fitted on, toxic rows that must share a feature, how telling it must be (its log ratio
#: between the kinds times the root of its rows), weight of the L2 penalty, and words that a worker remembers.
SAMPLE, SHARED, TELLING, PENALTY, REMEMBERED = 20_000, 3, 6.0, 0.2, 65_536
#: Score from which a text counts as toxic.
THRESHOLD = 0.7
#: Lengths of the word beginnings that are features beside whole words.
STEMS = (4, 5, 6, 7)

#: Characters and the letters that they imitate.
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = ".-_*'~"
EDGES = "\"'`.,;:?!…()[]{}<>#%&*^=/\\~|_-+«»“”„¿¡"
DRAWN_OUT = re.compile(r"(.)\1\1")
#: Costs in nats: standing for another letter, swallowing a repeat, deleting a separator, deleting another sign, ending a word.
IMITATION, REPEAT, DELETION, SIGN, BREAK = 0.7, 0.4, 0.2, 1.0, 0.5


def _letters() -> list[str]:
    return [c for c in map(chr, range(0x180)) if c.isalpha() and c == c.lower() and len(c) == 1]


LETTERS = _letters()
#: Codes: 0 outside of words, 1.. for LETTERS, then one for all other letters.
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
OTHER = len(LETTERS) + 1
SIZE = OTHER + 1


def _lookup() -> np.ndarray:
    table = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000 and (c := chr(point)).isalpha():
            table[point] = CODE.get(c, OTHER)
    return table


_table: list[np.ndarray] = []


def codes(text: str) -> np.ndarray:
    """Codes of a lower-case text, one code 0 at either end."""
    if not _table:
        _table.append(_lookup())
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.concatenate((np.zeros(1, np.int32), _table[0][points], np.zeros(1, np.int32)))


def count_trigrams(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The code trigrams of all texts, sorted, and their counts; there are at most SIZE ** 3 of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, size = np.zeros(SIZE**3, np.int64), [], 0

        def count() -> None:
            text = " ".join(waiting)
            for at in range(0, len(text), 1 << 20):
                c = codes(text[at : at + (1 << 20)]).astype(np.int64)
                np.add(total, np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3), out=total)

        for batch in batches:
            for x in batch.column(0):
                waiting.append((x.as_py() or "").lower())
                size += len(waiting[-1])
                if size >= 1 << 20:  # one count over many short texts
                    count()
                    waiting, size = [], 0
        count()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["g", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(run, "g int, n long")
    found = rows.groupBy("g").agg(F.sum("n").alias("n")).toArrow()
    grams, counts = found.column("g").to_numpy().astype(np.int64), found.column("n").to_numpy().astype(np.int64)
    order = np.argsort(grams)
    return grams[order], counts[order]


class Speller:
    """Restores disguised tokens under a trigram model: sorted trigrams and their counts, two arrays of bounded size."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams, counts
        pairs = np.bincount(grams // SIZE, counts, SIZE * SIZE)
        self.pairs = pairs
        self.starts = pairs.reshape(SIZE, SIZE).sum(axis=1)
        self.singles = np.bincount(grams % SIZE, counts, SIZE)
        self.total = max(1.0, float(counts.sum()))
        self.costs: dict[int, float] = {}

    def cost(self, a: int, b: int, c: int) -> float:
        """Minus the logarithm of c's chance after a, b; orders one to three are mixed."""
        gram = (a * SIZE + b) * SIZE + c
        found = self.costs.get(gram)
        if found is None:
            at = int(np.searchsorted(self.grams, gram))
            n = float(self.counts[at]) if at < len(self.grams) and self.grams[at] == gram else 0.0
            one = (float(self.singles[c]) + 0.5) / (self.total + SIZE)
            two = (float(self.pairs[b * SIZE + c]) + 5 * one) / (float(self.starts[b]) + 5)
            three = (n + 5 * two) / (float(self.pairs[a * SIZE + b]) + 5)
            found = self.costs[gram] = -math.log(three)
        return found

    def decode(self, token: str, spelled: bool = False) -> str:
        """The likeliest letters behind a token; words are parted by spaces."""
        # by the last two codes: cost, what was read so far as a chain of (before, letter), and the last character
        best: dict[tuple[int, int], tuple[float, tuple, str]] = {(0, 0): (0.0, (), "")}
        for ch in token:
            options: list[tuple[str, float]] = []
            if ch.isalpha():
                options.append((ch, 0.0))
            options += [(letter, IMITATION) for letter in IMITATES.get(ch, "")]
            following: dict[tuple[int, int], tuple[float, tuple, str]] = {}

            def offer(state, cost, letters, last, following=following):
                if state not in following or cost < following[state][0]:
                    following[state] = (cost, letters, last)

            for (a, b), (cost, letters, last) in best.items():
                if ch in SEPARATORS:
                    offer((a, b), cost + DELETION, letters, last)
                    if b:
                        offer((b, 0), cost + self.cost(a, b, 0) + BREAK, (letters, " "), "")
                    continue
                if not options:
                    offer((a, b), cost + 2 * DELETION, letters, last)
                    continue
                if ch == last:
                    offer((a, b), cost + REPEAT, letters, last)
                if not ch.isalnum():
                    offer((a, b), cost + SIGN, letters, last)
                for letter, price in options:
                    c = CODE.get(letter, OTHER)
                    offer((b, c), cost + price + self.cost(a, b, c), (letters, letter), ch)
                    if spelled and b:
                        turned = cost + BREAK + self.cost(a, b, 0) + price + self.cost(b, 0, c)
                        offer((0, c), turned, ((letters, " "), letter), ch)
            best = following
        if not best:
            return ""
        (_, _, chain) = min(((cost + self.cost(a, b, 0), k, letters) for k, ((a, b), (cost, letters, _)) in enumerate(best.items())), key=lambda x: x[:2])
        out = []
        while chain:
            chain, letter = chain
            out.append(letter)
        return "".join(reversed(out)).strip()


def disguised(word: str) -> bool:
    """Whether a trimmed token needs the lattice: letters beside other characters, or a letter thrice in a row."""
    if word.isalpha():
        return bool(DRAWN_OUT.search(word))
    return any(c.isalpha() for c in word) and any(c in IMITATES or c in SEPARATORS for c in word)


def trimmed(token: str) -> str:
    """A token without the punctuation around it; one leading or up to two trailing signs that imitate a
    letter may be part of the word."""
    word = token.strip(EDGES)
    tail = len(word) - len(word.rstrip("$@"))
    at = token.find(word)
    lead = token[at - 1] if word and at and token[at - 1] in IMITATES else ""
    return lead + (word[: len(word) - tail] if tail > 2 else word)


class Reader:
    """Words of a restored text, with what a worker has restored before."""

    def __init__(self, speller: Speller):
        self.speller, self.memory = speller, {}

    def words(self, token: str) -> tuple[str, ...]:
        found = self.memory.get(token)
        if found is None:
            word = trimmed(token)
            found = tuple(self.speller.decode(word).split()) if disguised(word) else (word,) if word else ()
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            if len(token) <= 64:
                self.memory[token] = found
        return found

    def restored(self, text: str) -> set[str]:
        """The distinct words of the restored text."""
        tokens = text.lower().split()
        words: set[str] = set()
        for token in set(tokens):
            words.update(self.words(token))
        run: list[str] = []
        for token in [*tokens, ""]:  # letters spelled apart
            if len(token) == 1 and (token.isalpha() or token in IMITATES):
                run.append(token)
            elif run:
                if len(run) >= 3 and len(set(run)) > 1:
                    words.update(self.speller.decode("".join(run), spelled=True).split())
                run = []
        return words


def word_features(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word + "$", *(word[:n] for n in STEMS if len(word) >= n)] if len(word) >= 3 else []


class Model:
    """Weights by feature, and the intercept."""

    def __init__(self, counts: tuple[np.ndarray, np.ndarray], weights: dict[str, float], intercept: float):
        self.counts, self.weights, self.intercept = counts, weights, intercept

    def scorer(self):
        reader, memory, weights = Reader(Speller(*self.counts)), {}, self.weights

        def of(token: str) -> tuple[str, ...]:
            word = trimmed(token)
            if word.isalpha() and not DRAWN_OUT.search(word):  # most tokens: as word_features, without a lattice
                if len(word) < 3:
                    found = ()
                else:
                    stems = {word[:n] for n in STEMS} if len(word) >= STEMS[0] else ()
                    found = tuple(f for f in (word + "$", *stems) if f in weights)
            else:
                found = tuple(f for w in reader.words(token) for f in word_features(w) if f in weights)
            if len(memory) >= REMEMBERED:
                memory.clear()
            if len(token) <= 64:
                memory[token] = found
            return found

        def score(text: str | None) -> float:
            tokens = (text or "").lower().split()
            found: set[str] = set()
            singles = 0
            for token in set(tokens):
                known = memory.get(token)
                if known is None:
                    known = of(token)
                if known:
                    found.update(known)
                if len(token) == 1:
                    singles += 1
            if singles > 1:
                apart = reader.restored(" ".join(spelled_runs(tokens)))
                found.update(f for w in apart for f in word_features(w) if f in weights)
            z = self.intercept + sum(weights[f] for f in sorted(found))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def spelled_runs(tokens: list[str]) -> list[str]:
    """The runs of three or more single letters among the tokens, apart from each other."""
    out: list[str] = []
    run: list[str] = []
    for token in [*tokens, ""]:
        if len(token) == 1 and (token.isalpha() or token in IMITATES):
            run.append(token)
        else:
            if len(run) >= 3:
                out += [*run, "--"]
            run = []
    return out


def fit_logistic(rows: list[list[int]], y: np.ndarray, n: int, penalty: float = PENALTY, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2-penalised logistic regression on sets of features, by accelerated gradient steps."""
    index = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.fromiter((c for r in rows for c in r), np.int64, len(index))
    w, b = np.zeros(n), math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    v_w, v_b = w.copy(), b
    step = 4.0 / (len(rows) * (1 + max(1.0, np.mean([len(r) for r in rows]) * 2)) / 10 + penalty)
    momentum = 0.0
    last = np.inf
    for _ in range(rounds):
        z = v_b + np.bincount(index, v_w[cols], len(rows))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss = -np.sum(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)) + penalty * (v_w**2).sum() / 2
        if loss > last * 1.0001:
            step, momentum = step / 2, 0.0
        last = loss
        gap = p - y
        new_w = v_w - step * (np.bincount(cols, gap[index], n) + penalty * v_w)
        new_b = v_b - step * gap.sum()
        after = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        rate = (momentum - 1) / after if momentum else 0.0
        v_w, v_b = new_w + rate * (new_w - w), new_b + rate * (new_b - b)
        w, b, momentum = new_w, new_b, after
    return w, b


def held_out(column) -> F.Column:
    return F.crc32(column.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, telling: float = TELLING) -> Model:
    """Counts over docs and a classifier on a bounded sample of the labels that are not held out."""
    counts = count_trigrams(docs, text_col)
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
    chosen = usable.groupBy(F.col(id_col).alias("i")).agg(F.max(label_col).cast("int").alias("y")).orderBy(F.xxhash64("i"), "i").limit(sample)
    context = docs.sparkSession.sparkContext
    share = context.broadcast(counts)
    # at most `sample` ids of eight bytes are broadcast
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(chosen), "i").groupBy("t").agg(F.max("y").alias("y")).select("y", "t")
    texts = saved(texts)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Speller(*share.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [sorted({f for w in reader.restored(x.as_py() or "") for f in word_features(w)}) for x in part.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], names=["f"])

    # what a few toxic rows have in common may be a feature; eight bytes of each come to the driver and reach the workers
    toxic = texts.where("y = 1").select("t").mapInArrow(restore, "f array<string>").select(F.explode("f").alias("f"))
    common = saved(toxic.groupBy("f").agg(F.count("*").alias("p")).where(F.col("p") >= SHARED).select("f", F.xxhash64("f").alias("h")))
    hashes = np.unique(common.select("h").toArrow().column("h").to_numpy())
    known = context.broadcast(hashes)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, all_hashes = Reader(Speller(*share.value)), known.value
        for batch in batches:
            found = []
            for x in batch.column(1):
                own = {f for w in reader.restored(x.as_py() or "") for f in word_features(w)}
                mine = np.fromiter((xxhash.xxh64_intdigest(f.encode(), 42) for f in own), np.uint64, len(own)).view(np.int64)
                places = np.searchsorted(all_hashes, mine)
                inside = places < len(all_hashes)
                places, mine = places[inside], mine[inside]
                found.append(np.unique(places[all_hashes[places] == mine]).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["y", "x"])

    rows = saved(texts.mapInArrow(index, "y int, x array<int>"))
    share.destroy()
    known.destroy()
    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        discard(texts, rows, common)
        return Model(counts, {}, 30.0 if n.get(1) else -30.0)
    by = rows.select("y", F.explode("x").alias("f")).groupBy("f").agg(F.sum("y").alias("p"), F.count("*").alias("n"))
    p = (F.col("p") + 0.5) / (n[1] + 1)
    q = (F.col("n") - F.col("p") + 0.5) / (n[0] + 1)
    best = [r.f for r in by.where(F.abs(F.log(p / q)) * F.sqrt("n") >= telling).orderBy("f").select("f").collect()]
    # the bounded sample, as numbers of the chosen features
    sparse = rows.select("y", F.array_intersect("x", F.expr(f"array({', '.join(map(str, best))})")).alias("x")).toArrow() if best else None
    names = {r.h: r.f for r in common.where(F.col("h").isin(hashes[best].tolist())).collect()} if best else {}
    discard(texts, rows, common)
    if sparse is None:
        return Model(counts, {}, math.log(n[1] / n[0]))
    place = np.zeros(len(hashes), np.int64)
    place[best] = np.arange(len(best))
    x = [place[v.values.to_numpy()] for v in sparse.column("x").combine_chunks()]
    w, b = fit_logistic(x, sparse.column("y").to_numpy().astype(float), len(best))
    return Model(counts, {names[int(hashes[f])]: float(w[k]) for k, f in enumerate(best) if abs(w[k]) > 1e-4}, b)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per row of docs: id_col, held_out, score and predicted."""
    model = train(docs, labels, id_col, text_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            found = [scorer(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=[id_col, "score"])

    scored = docs.select(id_col, F.col(text_col).cast("string").alias("_t")).mapInArrow(run, f"{id_col} {kind}, score double")
    out = F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out")
    return scored.select(id_col, out, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are not predicted toxic, with their own columns; each row is scored where it is."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.value.scorer()
        for batch in batches:
            clean = [scorer(x.as_py()) < THRESHOLD for x in batch.column(text_col)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
