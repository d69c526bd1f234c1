"""Near-duplicate lines by an exact set-similarity join, with DataFrame functions only.

A line is the set of its words in lower case. Of two lines with a Jaccard similarity of at least
NUM / DEN the later one goes, later by (id, line number), whatever becomes of the earlier one. So a line only
needs one earlier match. `clean` and `digest` take every line with a word; lines of fewer than min_words distinct
words stay where a caller of `removed_lines` asks for that.

1. Words are counted over all documents into a fixed number of hash buckets, and each bucket gets one of
   sixteen rarity classes. A word's key is its class, then its hash, so that sorted keys begin with the
   rarest words.
2. Lines of equal sets are one, at their first place. A set of so few words that one word more or less is too much
   (three at 4 / 5) has no match but its equals, and goes no further.
3. Near copies first: of the sets whose words agree in one of four quarters (by hash, seen through parity bits) and
   whose sizes are close, each is verified against LEADERS of them, the first of as many parts. Most members of a large
   family of variants find their match here, so that no later step pairs them with each other.
4. Two sets that match share a key within their prefixes of n - ceil(t n) + 1 keys. Prefix keys are dealt out, and
   sets without a match yet meet the earlier sets of the key. Pairs must fit in length, pass the positional filter,
   and differ in no more parity bits than similar sets can. The Jaccard similarity of the whole sets is then verified
   on the lines themselves.
5. A key of more than `few` sets is too frequent to be paired. If only such keys are shared, the prefixes longer by one
   key share two; so these sets are dealt out once more by the frequent key together with each later key.

The literals in the plan are a fixed-size table; nothing that grows is broadcast or collected, but for a bitmap of
bounded size that spares lines a shuffle.

Null text has no lines; empty lines are kept. Rows with a null id lose nothing and remove nothing. An id stands
for one document: rows that repeat an id get the removals found for any of them. Extra columns stay as they
are, also those named like working columns; an empty table gives an empty result."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, maybe_among, saved, surely_not_among

#: Similarity from which a later line goes, default of removed_lines for the distinct words of a line that may go, and
#: that number for whole documents.
NUM, DEN, MIN_WORDS, ANY = 4, 5, 5, 1
#: Hash buckets of the word counts, and sets that share a key up to which all are paired.
BUCKETS, FEW = 32_768, 1024
#: Sets of a quarter that all others of it are verified against, and slots of a first count of keys.
LEADERS, SLOTS = 8, 65_536
#: Parts of the keys that are dealt out one after the other.
PARTS = 2
HASH_BITS = 59


def _plain(text: str) -> str:
    """SQL of a text in lower case with one kind of space; a split by one plain character needs no regular expression."""
    for space in ("\\t", "\\r", "\\u000C", "\\u000B"):
        text = f"replace({text}, '{space}', ' ')"
    return f"lower({text})"


def _words(plain: str) -> str:
    return f"array_remove(split({plain}, ' '), '')"


def rarity(docs: DataFrame) -> list[int]:
    """Rarity classes 0 (rarest) to 15 of all buckets, four bits each, as BUCKETS / 16 longs."""
    words = docs.select(F.explode(F.expr(f"split(replace({_plain('text')}, '\\n', ' '), ' ')")).alias("w")).where("w <> ''")
    # at most BUCKETS rows come to the driver
    rows = words.groupBy(F.expr(f"CAST(xxhash64(w) & {BUCKETS - 1} AS INT)").alias("b")).count().toArrow()
    counts = [0] * BUCKETS
    for b, n in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
        counts[b] = n
    present = sorted(c for c in counts if c)
    low = present[len(present) // 4] if present else 1
    classes = [max(0, min(15, round(2 * math.log2(c / low)) + 2)) if c else 0 for c in counts]
    words16 = [sum(c << (4 * k) for k, c in enumerate(classes[at : at + 16])) for at in range(0, BUCKETS, 16)]
    return [x - (1 << 64) if x >> 63 else x for x in words16]


def keys_of(plain: str, table: str) -> str:
    """SQL of the sorted keys of a line; they are the line's set. No step makes nulls, so the sort is one of longs."""
    hashes = f"array_distinct(transform({_words(plain)}, w -> xxhash64(w)))"
    rank = f"(shiftrightunsigned(element_at({table}, CAST(shiftright(h & {BUCKETS - 1}, 4) AS INT) + 1), CAST(shiftleft(h & 15, 2) AS INT)) & 15L)"
    return f"sort_array(transform({hashes}, h -> coalesce(shiftleft({rank}, {HASH_BITS}), 0L) | (h & {(1 << HASH_BITS) - 1}L)))"


def removed_lines(docs: DataFrame, num: int = NUM, den: int = DEN, min_words: int = MIN_WORDS, few: int = FEW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line): the line numbers, from 0, that go."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    # one literal, which the optimiser makes an array once
    table = f"CAST(split('{','.join(map(str, rarity(source)))}', ',') AS ARRAY<BIGINT>)"
    lines = source.select("id", F.posexplode(F.split(F.expr(_plain("text")), "\n")).alias("line", "t"))
    keyed = lines.select("id", "line", F.expr(keys_of("t", table)).alias("keys"))
    # one key more than the prefix, for step 5
    prefix = F.expr(f"slice(keys, 1, size(keys) - CAST(ceil({num} * size(keys) / {den}) AS INT) + 2)")
    parity = lambda half: F.expr(f"aggregate(keys, 0L, (a, k) -> if(k & 64 = {half}, a ^ shiftleft(1L, CAST(k & 63 AS INT)), a))")
    wide = saved(keyed.select("id", "line", F.xxhash64("keys").alias("h"), parity(0).alias("b0"), parity(64).alias("b1"), F.size("keys").alias("n"), prefix.alias("prefix")))
    # a set is known by a hash of all keys and their parity bits
    same = ["h", "b0", "b1"]
    used = wide.where(F.col("n") >= max(1, min_words))
    heads = used.groupBy(*same).agg(F.min(F.struct("id", "line")).alias("at"), F.any_value("prefix").alias("prefix"), F.any_value("n").alias("n"), F.count("*").alias("uses"))
    sets = saved(heads.select(*same, "n", "at.id", "at.line", "prefix", "uses"))
    places = saved(used.select("id", "line", *same))
    discard(wide)
    # n words are like n + 1 at best
    able = sets.where(F.col("n") * (den - num) >= num)

    earlier = "(y.id < x.id OR y.id = x.id AND y.line < x.line)"
    alike = (
        f"{den} * y.n >= {num} * x.n AND {den} * x.n >= {num} * y.n "
        f"AND (bit_count(x.b0 ^ y.b0) + bit_count(x.b1 ^ y.b1)) * {num + den} <= (x.n + y.n) * {den - num}"
    )
    need = f"CAST(ceil({num} * (x.n + y.n) / {den + num}) AS INT)"
    # a set that has its match has -1 - i in place of i; both sides read the same columns, so they share an exchange.
    # (A condition on x alone would move below x's exchange.) The first key that two sets share has only others before
    # it, so what follows bounds the overlap; it is enough that they meet there.
    yi = "if(y.i < 0, -1 - y.i, y.i)"
    folded = f"{alike[: alike.index('AND (bit')]}AND if(x.n <= 64 OR y.n <= 64, bit_count(x.b0 ^ x.b1 ^ y.b0 ^ y.b1), bit_count(x.b0 ^ y.b0) + bit_count(x.b1 ^ y.b1)) * {num + den} <= (x.n + y.n) * {den - num}"
    fits = F.expr(f"least(x.i, y.n) >= 0 AND {earlier} AND {folded} AND least(x.n - x.i, y.n - {yi}) >= {need}")
    ends = [F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in ("id", "line")]
    facts = ["n", "b0", "b1", "id", "line"]

    quarters = F.array(*(F.xxhash64(F.lit(q), F.expr(f"shiftrightunsigned(b{q // 2}, {32 * (q % 2)}) & 4294967295L"), F.expr("floor(ln(n) / ln(1.5))")) for q in range(4)))
    parts = able.select(F.explode(quarters).alias("key"), F.pmod("h", F.lit(LEADERS)).alias("slot"), *facts)
    common = saved(parts.groupBy("key").agg(F.count("*").alias("uses")).where("uses > 1").select("key"))
    parts = saved(maybe_among(parts, common, ["key"]))
    leaders = parts.groupBy("key", "slot").agg(F.min(F.struct("id", "line", "n", "b0", "b1")).alias("f")).select("key", "f.*")
    near = saved(parts.alias("x").join(leaders.alias("y"), [F.col("x.key") == F.col("y.key"), F.expr(f"{earlier} AND {alike}")]).select(*ends).distinct())
    discard(common, parts)
    matched = verified(source, near, table, num, den)
    discard(near)

    def state(*done: DataFrame) -> DataFrame:
        """able and m, whether a set has its match. Only sets that may have one are shuffled."""
        have = saved(reduce(DataFrame.union, done).distinct())
        met = maybe_among(able, have, ["id", "line"]).join(have.withColumn("m", F.lit(True)), ["id", "line"], "left").withColumn("m", F.col("m").isNotNull())
        return surely_not_among(able, have, ["id", "line"]).withColumn("m", F.lit(False)).unionByName(met)

    place = F.expr("if(m, -1 - i, i)").alias("i")
    keys = F.expr("slice(prefix, 1, size(prefix) - 1)")
    # what is dealt out is narrow: a hash of the key, and one parity word for sets that it is wide enough for. A collision is
    # a candidate more, that the verification refuses.
    bits = [F.expr("if(n <= 64, b0 ^ b1, b0)").alias("b0"), F.expr("if(n <= 64, 0L, b1)").alias("b1")]
    narrow = ["n", *bits, "id", "line"]
    short = F.hash("key").alias("key")
    hot = saved(_hot(able.select(F.explode(keys).alias("key")).select(short), few))
    some_hot = bool(hot.head(1))

    def meetings(rows: DataFrame, but: DataFrame | None = None) -> DataFrame:
        """The pairs that fit and meet in a key of rows, but for the keys of `but`. One part of the keys is dealt out after the
        other, and its shuffle goes before the next, so the disk holds a part of what is dealt out at a time."""
        found = []
        for part in range(PARTS):
            dealt = rows.where(F.pmod("key", F.lit(PARTS)) == part).repartition("key")
            dealt = dealt if but is None else dealt.join(but.hint("shuffle_hash"), "key", "left_anti")
            found.append(saved(dealt.alias("x").join(dealt.alias("y"), [F.col("x.key") == F.col("y.key"), fits]).select(*ends).distinct()))
        out = saved(reduce(DataFrame.union, found).distinct())
        discard(*found)
        return out

    found = meetings(state(matched).select("m", F.posexplode(keys).alias("i", "key"), *facts).select(short, place, *narrow), hot if some_hot else None)
    more = verified(source, found, table, num, den)
    discard(found)
    results = [matched, more]
    if some_hot:
        often = state(matched, more).select("m", F.posexplode("prefix").alias("i", "key"), *facts, "prefix").where("i < size(prefix) - 1").withColumn("key", F.hash("key"))
        often = maybe_among(often, hot, ["key"]).join(hot, "key", "left_semi")
        pairs = often.select(F.explode(F.expr("slice(prefix, i + 2, size(prefix))")).alias("later"), "key", "m", "i", *facts).select(F.xxhash64("key", "later").alias("key"), place, *narrow)
        found = meetings(pairs)
        results.append(verified(source, found, table, num, den))
        discard(found)

    # only sets that go, or that several lines have, concern any line
    done = saved(reduce(DataFrame.union, results).distinct())
    going = maybe_among(sets, done, ["id", "line"]).join(done.withColumn("gone", F.lit(True)), ["id", "line"], "left").where("gone OR uses > 1")
    going = going.unionByName(surely_not_among(sets, done, ["id", "line"]).where("uses > 1").withColumn("gone", F.lit(None).cast("boolean")))
    judged = saved(going.select(*same, F.struct("id", "line").alias("at"), "gone"))
    out = saved(maybe_among(places, judged, same).join(judged, same).where("gone OR struct(id, line) > at").select("id", "line"))
    discard(places, sets, hot, done, judged, *results)
    return out


def _hot(rows: DataFrame, few: int) -> DataFrame:
    """The keys of more than `few` rows (key). Counts by hash first leave few keys to be counted one by one."""
    slot = F.pmod(F.xxhash64("key"), F.lit(SLOTS))
    heavy = saved(rows.groupBy(slot.alias("slot")).agg(F.count("*").alias("uses")).where(F.col("uses") > few).select("slot"))
    some = maybe_among(rows.withColumn("slot", slot), heavy, ["slot"])
    return some.groupBy("key").agg(F.count("*").alias("uses")).where(F.col("uses") > few).select("key")


def verified(source: DataFrame, pairs: DataFrame, table: str, num: int, den: int) -> DataFrame:
    """(id, line) of the sets x of those pairs that are similar enough."""
    sides = [pairs.select(F.col(f"{s}_id").alias("id"), F.col(f"{s}_line").alias("line")) for s in "xy"]
    wanted = sides[0].union(sides[1]).distinct()
    lines = maybe_among(source, wanted, ["id"]).select("id", F.posexplode(F.split(F.expr(_plain("text")), "\n")).alias("line", "t"))
    keys = saved(maybe_among(lines, wanted, ["id", "line"]).select("id", "line", F.expr(keys_of("t", table)).alias("keys")))
    for s in "xy":
        pairs = pairs.join(keys.select(F.col("id").alias(f"{s}_id"), F.col("line").alias(f"{s}_line"), F.col("keys").alias(s)), [f"{s}_id", f"{s}_line"])
    overlap = F.size(F.array_intersect("x", "y"))
    found = saved(pairs.where(overlap * (num + den) >= (F.size("x") + F.size("y")) * num).select(F.col("x_id").alias("id"), F.col("x_line").alias("line")).distinct())
    discard(keys)
    return found


def _without(lines: str, gone: str) -> str:
    """SQL of the lines whose numbers are not among gone, in linear time."""
    return f"transform(array_except(if(size({lines}) > 0, sequence(0, size({lines}) - 1), CAST(array() AS array<int>)), {gone}), i -> element_at({lines}, i + 1))"


def clean(docs: DataFrame, num: int = NUM, den: int = DEN, min_words: int = ANY, few: int = FEW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text of the kept lines, and n_lines, n_removed and removed (line numbers, ascending), which replace
    columns of these names."""
    gone = removed_lines(docs, num, den, min_words, few, id_col, text_col).groupBy("id").agg(F.array_sort(F.collect_set("line")).alias("_gone"))
    joined = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("id")).join(gone, "id", "left")
    text = F.col("_row")[text_col].cast("string")
    lines = joined.select("_row", F.split(text, "\n").alias("_lines"), F.coalesce("_gone", F.array().cast("array<int>")).alias("_removed"))
    kept = F.array_join(F.expr(_without("_lines", "_removed")), "\n")
    own = {text_col: F.when(F.size("_removed") == 0, F.col("_row")[text_col]).otherwise(kept)}
    added = {"n_lines": F.coalesce(F.size("_lines"), F.lit(0)), "n_removed": F.size("_removed"), "removed": F.col("_removed")}
    columns = [own.get(c, F.col("_row")[c]).alias(c) for c in docs.columns if c not in added]
    return lines.select(*columns, *(v.alias(c) for c, v in added.items()))


def keep_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """docs, with all their columns and no others, without the lines that go. Rows that lose lines and have no word left
    go too. chars_col, if given, gets the new number of characters of the rows that lose lines.

    Only rows that may lose lines are shuffled, to meet their line numbers."""
    gone = saved(removed_lines(docs, min_words=ANY, id_col=id_col, text_col=text_col).groupBy("id").agg(F.collect_set("line").alias("gone")))
    keys = gone.select(F.col("id").alias(id_col))
    met = maybe_among(docs, keys, [id_col]).select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("id")).join(gone, "id", "left")
    text = F.col("_row")[text_col].cast("string")
    split = met.select("_row", F.split(text, "\n").alias("_lines"), "gone")
    kept = split.select("_row", "gone", F.array_join(F.expr(_without("_lines", "gone")), "\n").alias("_kept")).where(r"gone IS NULL OR _kept RLIKE '\\S'")
    new = {text_col: F.col("_kept")} | ({chars_col: F.length("_kept").cast("long")} if chars_col else {})
    columns = [(F.when(F.col("gone").isNotNull(), new[c]).otherwise(F.col("_row")[c]) if c in new else F.col("_row")[c]).alias(c) for c in docs.columns]
    return surely_not_among(docs, keys, [id_col]).unionByName(kept.select(*columns))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id_col, n_lines, n_removed and removed_lines (numbers from 0, comma-joined). The texts
    themselves are only scanned."""
    gone = removed_lines(docs, min_words=ANY, id_col=id_col, text_col=text_col).groupBy("id").agg(F.array_sort(F.collect_set("line")).alias("gone"))
    counts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.size(F.split(F.col(text_col).cast("string"), "\n")), F.lit(0)).alias("n_lines"))
    joined = counts.join(gone, "id", "left")
    gone_or_none = F.coalesce("gone", F.array().cast("array<int>"))
    return joined.select(F.col("id").alias(id_col), "n_lines", F.size(gone_or_none).alias("n_removed"), F.array_join(gone_or_none, ",").alias("removed_lines"))


#: DuckDB SQL of the digests: the same rule by a plain prefix join over whole sets of words.
ORACLE = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
s AS (SELECT doc_id, line, list_sort(list_distinct(list_filter(string_split(translate(lower(t), chr(9) || chr(11) || chr(12) || chr(13), '    '), ' '), lambda x: x <> ''))) AS w FROM l),
k AS (SELECT w, min(row(doc_id, line)) AS first FROM s WHERE len(w) > 0 GROUP BY w),
n AS MATERIALIZED (SELECT row_number() OVER (ORDER BY first) AS id, w, first, len(w) AS n FROM k),
f AS (SELECT x, count(*) AS c FROM (SELECT unnest(w) AS x FROM n) GROUP BY x),
o AS (SELECT id, n, x, row_number() OVER (PARTITION BY id ORDER BY c, x) AS i FROM (SELECT id, n, unnest(w) AS x FROM n) JOIN f USING (x)),
p AS MATERIALIZED (SELECT id, n, x FROM o WHERE i <= n - (4 * n + 4) // 5 + 1),
c AS (SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.x = b.x AND b.id < a.id AND 5 * b.n >= 4 * a.n AND 5 * a.n >= 4 * b.n),
g AS (SELECT DISTINCT a FROM c JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (x.n + y.n)),
r AS (SELECT s.doc_id, s.line FROM s JOIN n ON s.w = n.w WHERE row(s.doc_id, s.line) > n.first OR n.id IN (SELECT a FROM g))
SELECT d.doc_id, CAST(coalesce(len(string_split(any_value(text), chr(10))), 0) AS INTEGER) AS n_lines, CAST(count(r.line) AS INTEGER) AS n_removed, coalesce(string_agg(r.line, ',' ORDER BY r.line), '') AS removed_lines
FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""
