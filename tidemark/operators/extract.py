"""Texts cut to a token budget, and the facts found in their pieces merged by a fixed order.

The calls that find facts stay outside of the engine; what goes in and what comes out are relations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces that count as a token: up to six letters, up to three digits, any other sign.
TOKEN = r"[\p{L}\p{M}]{1,6}|\p{N}{1,3}|[^\s\p{L}\p{M}\p{N}]"
#: Lines that stay with every chunk, and where a sentence ends.
HEADING, SENTENCE = r"(?m)^#{1,3} .*$", r"([.!?])\s+"


def tokens(text: Column) -> Column:
    """An estimate of the tokens of a text, in the JVM. No character counts twice, so a text has at most one token for each."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0))


def budgeted(docs: DataFrame, key: str, text_col: str, budget: int, count: Callable[[Column], Column] = tokens, between: str = r"\n\s*\n") -> DataFrame:
    """key, chunk, text and tokens: paragraphs in order, no chunk of more than `budget` tokens.

    A paragraph of more than a quarter of the budget becomes sentences, a sentence of more than that becomes words, and a longer word
    becomes runs of characters, so nothing is ever dropped. Chunk n holds the units that begin within its n-th three quarters of a budget;
    what it can exceed these by is one unit. A separator costs nothing. `count` must give a text no more than
    its characters, and a joined text no more than its units. Null and blank texts have no chunks. One shuffle, by row."""
    if budget < 4:
        raise ValueError("a budget has at least four tokens")
    most = budget // 4
    rows = docs.select(F.col(key), F.col(text_col).cast("string").alias("_t"), F.monotonically_increasing_id().alias("_row"))
    # what is not split further keeps its count; an explosion that may be empty gets no filter that would count everything once more
    paragraphs = rows.select(key, "_row", F.posexplode_outer(F.split("_t", between)).alias("_p", "_u")).where(F.trim("_u") != "").withColumn("_n", count(F.col("_u")))
    long = F.col("_n") > most
    parts = lambda pieces: F.when(long, pieces).otherwise(F.array("_u"))
    split = lambda rows, names, pieces, at: rows.select(key, "_row", *names, long.alias("_long"), F.col("_n").alias("_whole"), F.posexplode_outer(parts(pieces)).alias(at, "_u"))
    recount = lambda rows: rows.withColumn("_n", F.when(F.col("_long"), count(F.col("_u"))).otherwise(F.col("_whole")))
    sentences = recount(split(paragraphs, ["_p"], F.split(F.regexp_replace("_u", SENTENCE, "$1\u0001"), "\u0001"), "_s"))
    words = recount(split(sentences, ["_p", "_s"], F.split("_u", r"\s+"), "_w").where("_u <> ''"))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.length("_u") - 1) / most).cast("int")), lambda k: F.substr("_u", k * most + 1, F.lit(most)))
    units = recount(split(words, ["_p", "_s", "_w"], runs, "_c"))
    order = ["_p", "_s", "_w", "_c"]
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = units.withColumn("chunk", F.floor(before / (budget - most)))
    # what a unit is joined with: a run goes on at once, words and sentences after a space, paragraphs after an empty line
    joined = placed.groupBy("_row", key, "chunk").agg(F.array_sort(F.collect_list(F.struct(*order, "_u"))).alias("_l"), F.sum("_n").cast("int").alias("tokens"))
    gap = lambda x, i: F.when(i == 0, "").when(x["_c"] > 0, "").when(x["_p"] != F.element_at("_l", i)["_p"], "\n\n").otherwise(" ")
    text = F.array_join(F.transform("_l", lambda x, i: F.concat(gap(x, i), x["_u"])), "")
    return joined.select(key, "chunk", text.alias("text"), "tokens")


def headings(text: Column) -> Column:
    """The main headings of a text, as an array, to go with each of its chunks."""
    return F.regexp_extract_all(text, F.lit(HEADING), F.lit(0))


def merged(facts: DataFrame, keys: list[str], value: str = "value", confidence: str = "confidence", chunk: str = "chunk") -> DataFrame:
    """keys, value, confidence, chunks and conflict of facts (keys, chunk, value, confidence): one value for each key.

    Of several values the one that most facts hold wins, then the highest confidence, then the earliest chunk, then the
    smallest value, so the result depends on nothing else. Null values are no facts; a key without others is null with no
    confidence. conflict tells whether there was more than one value. Two sums, no window: a key of any size is no group in memory."""
    there = F.col(value).isNotNull()
    held = facts.groupBy(*keys, value).agg(F.count_if(there).alias("_n"), F.max(confidence).alias("_c"), F.min(chunk).alias("_k"))
    rank = F.when(there, F.struct(-F.col("_n"), -F.coalesce("_c", F.lit(float("-inf"))), F.col("_k"), F.col(value)))
    best = held.groupBy(*keys).agg(F.min_by(F.struct(F.col(value).alias("v"), F.col("_c").alias("c"), F.col("_n").alias("n")), rank).alias("_b"), F.count_if(there).alias("_values"))
    return best.select(*keys, F.col("_b.v").alias("value"), F.col("_b.c").alias("confidence"), F.coalesce("_b.n", F.lit(0)).alias("facts"), (F.col("_values") > 1).alias("conflict"))
