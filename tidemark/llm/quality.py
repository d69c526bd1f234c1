"""Quality by Bradley-Terry ranking of pairs.

A text is described by counts over all of it: its words and how many differ or repeat at once, characters that are no letters, capitals, digits, signs,
sentences and lines. A row of label 1 is preferred to one of label 0, and the weights make such preferences likely: the
chance that i is preferred to j is the logistic function of w . (x_i - x_j). The raw score w . x has no natural zero, so a
quantile of the raw scores of the labelled rows becomes the threshold: the one that agrees best with their labels, both kinds
weighing alike. The score is the logistic function of the raw score, moved so that the quantile falls on THRESHOLD.

Features and scores are column expressions, without Python per row. Weights are fitted on all labelled rows that are not held out,
and on all pairs of them: a row weighs as PARTNERS preferences, spread evenly over all rows of the other label. How likely the
preferences are, and the slopes of that, are sums over pairs of functions of the difference of two raw scores; so rows are summed by raw score, in steps
of STEP with linear weights between two steps, and only such sums are paired, on the driver. A Newton step is two passes over the
features; neither rows nor pairs are held anywhere. The threshold follows from exact quantiles of all raw scores. Rows with
crc32(id as text) mod 5 = 0 are held out; labels, language, source and id are never inputs of a score.

Null and empty texts have no words and all their counts are 0. Of a labelled id that repeats, the label of most rows holds (1 if
they tie); labels other than 0 and 1 are ignored. Without labels of both kinds the score is the share of label 1 (0 without any).
Equal texts are scored alike, ids may be null (not held out), extra columns are ignored, and an empty table gives an empty result."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, saved

#: Preferences that a labelled row weighs as, weight of the L2 penalty, step of raw scores by which rows are summed.
PARTNERS, PENALTY, STEP = 8, 1.0, 1 / 16
#: Score from which a text counts as good, and the quantiles that may become it.
THRESHOLD, QUANTILES = 0.3, np.arange(0, 1, 0.0025)

#: What is counted in a text, by name; each counts as a share of the words or of the characters.
BY_WORD = {
    "sentences": r"[.!?](?=\s|$)",
    "lines": r"\n",
    "shouted": r"!",
    "bars": r"\|",
    "capital_words": r"(?<!\p{L})\p{Lu}{2,}+(?!\p{L})",
    "sign_runs": r"[^\p{L}\p{N}\s]{3,}",
    "letterless": r"(?<!\S)[^\p{L}\s]++(?!\S)",
    "linked": r"https?://|www\.",
    "marked": r"[<>{}\[\]\\=_#@$%&*^~+]",
}
BY_CHARACTER = {"others": r"\P{L}", "capitals": r"\p{Lu}", "digits": r"\p{N}"}
FEATURES = ["length", "word_length", "distinct", "at_once", *BY_WORD, *BY_CHARACTER]
#: Shares also count on a scale that tells small ones apart.
ALL = [*FEATURES, *(f"fine_{f}" for f in FEATURES[2:])]


def features(rows: DataFrame, text: str = "t") -> DataFrame:
    """rows with an array `x` of the features of their text, in the order of ALL, in its place."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumn(text, F.coalesce(F.col(text), F.lit(""))).withColumn("_w", words)
    n, size = F.size("_w"), F.length(text)
    at_once = F.size(F.filter(F.zip_with("_w", F.slice("_w", 2, F.greatest(n - 1, F.lit(0))), lambda a, b: a == b), lambda same: same))
    counted = {
        "length": F.log1p(n), "word_length": F.coalesce(F.try_divide(size, n), F.lit(0.0)), "distinct": F.coalesce(F.try_divide(F.size(F.array_distinct("_w")), n), F.lit(0.0)),
        "at_once": F.coalesce(F.try_divide(at_once, n), F.lit(0.0)),
    }
    counted |= {k: F.coalesce(F.try_divide(F.regexp_count(text, F.lit(p)), n), F.lit(0.0)) for k, p in BY_WORD.items()}
    counted |= {k: F.coalesce(F.try_divide(F.regexp_count(text, F.lit(p)), size), F.lit(0.0)) for k, p in BY_CHARACTER.items()}
    shares = rows.withColumn("x", F.array(*[F.least(counted[f], F.lit(50.0)) for f in FEATURES])).drop("_w", text)
    return shares.withColumn("x", F.concat("x", F.transform(F.slice("x", 3, len(FEATURES) - 2), lambda v: F.log1p(v * 100))))


def held_out(column: Column) -> Column:
    return F.crc32(column.cast("string").cast("binary")) % 5 == 0


def pairs(y: np.ndarray, partners: int = PARTNERS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(preferred, other): every row beside `partners` rows of the other label."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rng = np.random.default_rng(seed)
    up = np.concatenate([np.repeat(good, partners), rng.choice(good, len(bad) * partners)])
    down = np.concatenate([rng.choice(bad, len(good) * partners), np.repeat(bad, partners)])
    return up, down


def fit_pairs(x: np.ndarray, up: np.ndarray, down: np.ndarray, penalty: float = PENALTY, rounds: int = 50) -> np.ndarray:
    """Weights w that make sigmoid(w . (x[up] - x[down])) likely under an L2 penalty, by Newton steps."""
    gap, w = x[up] - x[down], np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(gap @ w, -30, 30)))
        slope = penalty * w - gap.T @ p
        step = np.linalg.solve(gap.T @ (gap * (p * (1 - p))[:, None]) + penalty * np.eye(len(w)), slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _best(agree: np.ndarray) -> float:
    best = np.flatnonzero(agree >= agree.max() - 1e-12)
    return float(QUANTILES[best[len(best) // 2]])


def best_quantile(raw: np.ndarray, y: np.ndarray) -> float:
    """The quantile of the raw scores from which rows count as good that agrees best with the labels, both kinds weighing alike."""
    cuts = np.quantile(raw, QUANTILES)
    found = (raw[None, :] >= cuts[:, None]) if len(raw) * len(cuts) < 1e7 else np.array([raw >= c for c in cuts])
    return _best(found[:, y == 1].mean(axis=1) + (~found[:, y == 0]).mean(axis=1))


def summed(rows: DataFrame, add: Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, sums) of what add gives for the labels and features of batches of rows: integer keys and a row of `width` numbers for each.
    The driver gets `width` rows for each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for keys, values in add(batch.column(0).to_numpy(zero_copy_only=False), x):
                for k, v in zip(keys.tolist(), values, strict=True):
                    total[k] = total[k] + v if k in total else v
        keys = np.fromiter(total, np.int64, len(total))
        values = np.concatenate([*total.values(), np.zeros(0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys, width)), pa.array(np.tile(np.arange(width, dtype=np.int32), len(keys))), pa.array(values)], names=["k", "j", "v"])

    found = rows.select("y", "x").mapInArrow(run, "k long, j int, v double").groupBy("k", "j").agg(F.sum("v").alias("v")).orderBy("k", "j").toArrow()
    return found.column("k").to_numpy()[::width], found.column("v").to_numpy().reshape(-1, width)


def fit_all_pairs(rows: DataFrame, mean: np.ndarray, spread: np.ndarray, n: tuple[int, int], penalty: float = PENALTY, rounds: int = 50) -> np.ndarray:
    """Weights w, for features less their mean by their spread, that make the preferences between all n[1] rows of label 1 and all
    n[0] of label 0 likely under an L2 penalty. rows: y, x."""
    width, each = len(mean), PARTNERS * (1 / n[0] + 1 / n[1])

    def by_score(w: np.ndarray) -> tuple[float, np.ndarray, tuple]:
        """The loss at w, its slope, and what the bend needs."""

        def add(y, x):
            x = (x - mean) / spread
            s = x @ w / STEP
            low = np.floor(s)
            for k, part in ((low, 1 - (s - low)), (low + 1, s - low)):
                keys, place = np.unique(k.astype(np.int64) * 2 + y, return_inverse=True)
                sums = np.zeros((len(keys), width + 1))
                np.add.at(sums, place, np.column_stack((part, x * part[:, None])))
                yield keys, sums

        keys, sums = summed(rows, add, width + 1)
        (a, good), (b, bad) = (((keys[keys % 2 == y] // 2) * STEP, sums[keys % 2 == y]) for y in (1, 0))
        gap = a[:, None] - b[None, :]
        p = 1 / (1 + np.exp(np.clip(gap, -700, 700)))
        loss = each * float(good[:, 0] @ np.logaddexp(0, -gap) @ bad[:, 0]) + penalty / 2 * float(w @ w)
        slope = penalty * w - each * (good[:, 1:].T @ (p @ bad[:, 0]) - bad[:, 1:].T @ (p.T @ good[:, 0]))
        q = p * (1 - p)
        cross = good[:, 1:].T @ q @ bad[:, 1:]
        return loss, slope, (a, q @ bad[:, 0], b, q.T @ good[:, 0], cross + cross.T)

    def bend(w: np.ndarray, parts: tuple) -> np.ndarray:
        a, of_good, b, of_bad, cross = parts

        def add(y, x):
            x = (x - mean) / spread
            s = x @ w
            h = np.where(y == 1, np.interp(s, a, of_good), np.interp(s, b, of_bad))
            yield np.zeros(1, np.int64), (x.T @ (x * h[:, None])).reshape(1, -1)

        return each * (summed(rows, add, width * width)[1].reshape(width, width) - cross) + penalty * np.eye(width)

    w = np.zeros(width)
    loss, slope, parts = by_score(w)
    for _ in range(rounds):
        step = np.linalg.solve(bend(w, parts), slope)
        after = by_score(w - step)
        while after[0] > loss * 1.001 and np.abs(step).max() > 1e-3:  # sums by score are a little rough
            step = step / 2
            after = by_score(w - step)
        w, (loss, slope, parts) = w - step, after
        if np.abs(step).max() < 1e-5:
            break
    return w


def quantiles(values: DataFrame, shares: np.ndarray) -> np.ndarray:
    """As np.quantile of the one column of values, however many there are: they are sorted by ranges, and only what stands at the
    wanted places comes to the driver."""
    column = values.columns[0]
    order = saved(values.repartitionByRange(column).sortWithinPartitions(column).withColumn("_at", F.monotonically_increasing_id()))
    sizes = sorted(tuple(r) for r in order.groupBy(F.shiftright("_at", 33)).count().collect())
    ends = np.cumsum([n for _, n in sizes])
    at = shares * (ends[-1] - 1)
    low = np.floor(at).astype(np.int64)
    places = np.unique(np.concatenate((low, np.minimum(low + 1, ends[-1] - 1))))
    part = np.searchsorted(ends, places, "right")
    names = [(sizes[p][0] << 33) + int(x - (ends[p] - sizes[p][1])) for p, x in zip(part.tolist(), places.tolist(), strict=True)]
    by_name = dict(order.where(F.col("_at").isin(names)).select("_at", column).collect())
    found = np.array([by_name[name] for name in names])
    discard(order)
    # as numpy, so that an exact place gives exactly its value
    below, above, t = found[np.searchsorted(places, low)], found[np.searchsorted(places, np.minimum(low + 1, ends[-1] - 1))], at - low
    return np.where(t < 0.5, below + (above - below) * t, above - (above - below) * (1 - t))


def raw_score(x: Column, weights: list[float]) -> Column:
    return F.aggregate(F.zip_with(x, F.array(*map(F.lit, weights)), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


class Model:
    """Weights by feature and the raw score that is the threshold; or a constant score."""

    def __init__(self, weights: list[float] | None, at: float):
        self.weights, self.at = weights, at

    def score(self, x: Column) -> Column:
        if self.weights is None:
            return F.lit(self.at)
        raw = raw_score(x, self.weights)
        z = raw - self.at + math.log(THRESHOLD / (1 - THRESHOLD))
        # the threshold itself counts as good, whatever the rounding of the logistic function
        return F.when(raw >= self.at, F.greatest(1 / (1 + F.exp(-z)), F.lit(THRESHOLD))).otherwise(F.least(1 / (1 + F.exp(-z)), F.lit(math.nextafter(THRESHOLD, 0))))


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(i, o, x) of every row: its id, a hash of its text and its features."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    return saved(features(rows.withColumn("o", F.xxhash64("t")), "t"))


def train(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """A model fitted on all labels that are not held out. rows: (i, o, x), as `described` gives them."""
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
    usable = usable.groupBy(F.col(id_col).alias("i")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    # of rows that repeat an id one text counts
    met = rows.where(F.col("i").isNotNull() & ~held_out(F.col("i"))).join(usable, "i").groupBy("i").agg(F.min_by(F.struct("y", "x"), "o").alias("r"))
    known = saved(met.select("r.y", "r.x"))
    columns = [F.col("x")[k] for k in range(len(ALL))]
    facts = known.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0)), *map(F.avg, columns), *map(F.stddev_pop, columns)).first()
    n, good = facts[0], facts[1]
    if not 0 < good < n:
        discard(known)
        return Model(None, good / n if n else 0.0)
    mean, spread = np.array(facts[2 : 2 + len(ALL)], float), np.array(facts[2 + len(ALL) :], float)
    spread = np.where(spread > 1e-9, spread, 1)
    w = fit_all_pairs(known, mean, spread, (n - good, good)) / spread
    # digits beyond those that the fit settles depend on the order of sums
    weights = [float(f"{v:.9g}") for v in w]
    raw = known.select("y", raw_score(F.col("x"), weights).alias("raw"))
    cuts = quantiles(raw.select("raw"), QUANTILES)
    # how many cuts a row reaches: of the rows by that number and label at most len(QUANTILES) + 1 sums of either label are needed
    reached = F.size(F.filter(F.array(*map(F.lit, cuts.tolist())), lambda c: c <= F.col("raw")))
    counts = np.zeros((2, len(QUANTILES) + 1))
    for r in raw.groupBy("y", reached.alias("c")).count().collect():
        counts[r.y, r.c] = r["count"]
    discard(known)
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:] / counts.sum(axis=1)[:, None]
    best = _best(above[1] + 1 - above[0])
    return Model(weights, float(cuts[np.flatnonzero(best == QUANTILES)[0]]))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Per row of docs: id_col, held_out, score and predicted. Features are counted once, for training and scores alike."""
    rows = described(docs, id_col, text_col)
    model = train(rows, labels, id_col, label_col)
    out = F.coalesce(held_out(F.col("i")), F.lit(False)).alias("held_out")
    return rows.select(F.col("i").alias(id_col), out, model.score(F.col("x")).alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of docs that count as good, with their own columns."""
    described_rows = described(docs, id_col, text_col)
    model = train(described_rows, labels, id_col, label_col)
    discard(described_rows)
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_own")
    rows = features(docs.select(own, F.col(text_col).cast("string").alias("_t")), "_t")
    return rows.where(model.score(F.col("x")) >= THRESHOLD).select("_own.*")
