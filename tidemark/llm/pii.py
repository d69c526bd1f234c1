"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Base entities come from four regular expressions. They are the seeds of a graph of patterns and instances, with
long hexadecimal keys as the seeds of a fifth kind, "secret". An instance is an identifier-like string (a base entity, or
any other run with digits). A pattern is the two or three words before an instance, the word after it, with what is
attached to it, or its shape (letters and digits by class). A pattern scores
the smoothed share of seeds of one kind among its distinct instances and must hold a few of them; an instance scores
one minus the chance that all its patterns of TRUST or more err. Instances over a threshold join the seeds with their score and
the next round scores the patterns anew. Instances that reach ACCEPT add their spans with the kind of their best
pattern, and the seeds of "secret" add theirs; base spans always stay, and added spans never overlap them.

The expressions are rewritten without changing what they match: possessive repeats, and starts only where a run
starts or the last match ended, so that long runs cost linear time and no stack. Contexts reach back to
the match before and on to the match after, whatever their length.

Rows meet by document (windows within one text), by pattern and by instance; the latter two are grouped with
map-side partial sums over distinct values, so a string or a context that a third of all texts hold is one row.

Null text counts as empty and has no spans. Rows that repeat are each reported. Extra columns are ignored; an empty
table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, maybe_among, saved

KINDS = ("email", "ip", "card", "phone", "secret")
#: What the four kinds look like, and identifier-like runs.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "other": r"(?<![A-Za-z0-9])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![A-Za-z0-9])|(?:\G|(?<![A-Za-z0-9@._+-]))(?=[A-Za-z@._+-]*+[0-9])[A-Za-z0-9@._+-]{6,}+",
}
#: What a text must hold for a form to match at all.
NEEDS = {"email": "contains(t, '@')", "ip": "contains(t, '.') AND t RLIKE '[0-9]'", "card": "t RLIKE '[0-9]'", "phone": "contains(t, '+')", "other": "t RLIKE '[0-9]'"}
#: The seeds of secrets: hexadecimal keys of 128 bits or more, with letters and digits.
SECRET = r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{32,}$"
#: Rounds, distinct seeds that a pattern needs, weight of doubt, and scores for patterns, for seeds and for spans.
ROUNDS, SUPPORT, DOUBT, TRUST, JOIN, ACCEPT = 3, 5, 2.0, 0.5, 0.8, 0.8
#: One key in so many is hidden from the patterns.
HIDE = 5


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, id, kind, i, value, start, end, left, right: every match of every form, with a few words on either side; one row
    of nulls for a text without."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"), F.monotonically_increasing_id().alias("row"))
    none = "CAST(array() AS array<string>)"
    for kind, form in FORMS.items():
        rows = rows.withColumn(f"m_{kind}", F.expr(f"if({NEEDS[kind]}, regexp_extract_all(t, {_quoted(form)}, 0), {none})"))
    # a text without a match needs no pieces
    parts = rows.select("id", "row", *(F.expr(f"if(size(m_{k}) > 0, split(t, {_quoted(f)}, -1), {none})").alias(f"p_{k}") for k, f in FORMS.items()), *(f"m_{k}" for k in FORMS))
    found = [
        f"transform(m_{k}, (m, i) -> struct('{k}' AS kind, i AS i, m AS value, length(get(p_{k}, i)) AS gap, "
        f"substring_index(concat(coalesce(get(m_{k}, i - 1), ''), get(p_{k}, i)), ' ', -4) AS left, substring_index(concat(get(p_{k}, i + 1), coalesce(get(m_{k}, i + 1), '')), ' ', 2) AS right))"
        for k in FORMS
    ]
    every = parts.select("id", "row", F.explode_outer(F.expr(f"concat({', '.join(found)})")).alias("e")).select("id", "row", "e.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    every = every.withColumn("stop", F.sum(F.col("gap") + F.length("value")).over(so_far))
    # of other runs, signs at the ends are not part of the identifier
    other = F.col("kind") == "other"
    every = every.withColumn("end", F.when(other, F.col("stop") - F.length(F.regexp_extract("value", r"[@._+-]*+$", 0))).otherwise(F.col("stop")))
    every = every.withColumn("value", F.when(other, F.regexp_replace("value", r"^[@._+-]++|(?<![@._+-])[@._+-]++$", "")).otherwise(F.col("value")))
    return every.withColumn("start", F.col("end") - F.length("value"))


def valid(kind: str = "kind", value: str = "value") -> str:
    """SQL: whether a match of a base form holds."""
    digits = f"regexp_replace({value}, '[^0-9]', '')"
    parts = f"forall(split({value}, '[.]'), x -> length(ltrim('0', x)) <= 3 AND coalesce(try_cast(ltrim('0', x) AS INT), 0) <= 255)"
    return (
        f"CASE {kind} WHEN 'email' THEN true WHEN 'ip' THEN {parts} "
        f"WHEN 'card' THEN if(length({digits}) BETWEEN 12 AND 19, luhn_check({digits}), false) "
        f"WHEN 'phone' THEN length({digits}) BETWEEN 9 AND 15 ELSE false END"
    )


def instances(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base spans (base true) and the identifier-like runs that overlap none, with their patterns; and a row of nulls
    for each text without matches."""
    found = matches(docs, id_col, text_col).withColumn("base", F.coalesce(F.expr(valid()), F.lit(False)))
    # both frames grow with the rows read, which costs linear time
    before = Window.partitionBy("row").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("reach", F.max(F.when(F.col("base"), F.col("end"))).over(before)).withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(after))
    free = (F.col("kind") == "other") & (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    found = found.withColumn("free", F.coalesce(free, F.lit(False)))
    # contexts end where the identifier begins, so what is attached to it belongs to them
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    ahead = lambda words: F.regexp_extract(plain("left"), r"(?<!\S)(?:\S++\s++){" + str(words) + r"}\S*+$", 0)
    behind = F.regexp_extract(plain("right"), r"^\S*+\s++\S++", 0)
    shape = F.regexp_replace(F.regexp_replace(F.lower("value"), "[a-z]+", "a"), "[0-9]", "0")
    # a text keeps one row even if nothing of it stays
    first = F.row_number().over(Window.partitionBy("row").orderBy(F.coalesce("base", F.lit(False)).desc(), F.col("free").desc(), "start", "kind")) == 1
    kept = found.withColumn("first", first).where("base OR free OR first")
    use = F.col("base") | F.col("free")
    named = lambda name, x: F.when(F.trim(x) != "", F.concat(F.lit(f"{name}:"), x))
    patterns = F.array_compact(F.array(named("3", ahead(2)), named("2", ahead(1)), named("r", behind), named("s", shape)))
    return kept.select("id", "row", *(F.when(use, F.col(c)).alias(c) for c in ("kind", "start", "end")), "base", F.when(use, F.lower("value")).alias("value"), F.when(use, patterns).alias("patterns"))


def is_hidden(value: F.Column, hide: int) -> F.Column:
    return F.pmod(F.xxhash64(value), F.lit(hide)) == 0 if hide else F.lit(False)


def seeds_of(found: DataFrame, hide: int = 0) -> DataFrame:
    """(value, kind): the distinct seeds, base entities and the keys that are seeds of secrets; one key in `hide` is left out."""
    key = F.col("value").rlike(SECRET) & ~is_hidden(F.col("value"), hide)
    kind = F.when(F.col("base"), F.col("kind")).when(key, F.lit("secret"))
    return found.select("value", kind.alias("kind")).where("value IS NOT NULL AND kind IS NOT NULL").groupBy("value").agg(F.min("kind").alias("kind"))


def keys_of(found: DataFrame) -> DataFrame:
    """(value): the distinct keys, seeds or hidden, that are no base entities."""
    return found.where(~F.col("base") & F.col("value").rlike(SECRET)).select("value").distinct()


def discovered(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, doubt: float = DOUBT, trust: float = TRUST, join: float = JOIN, accept: float = ACCEPT, hide: int = 0) -> DataFrame:
    """(value, kind, score) of the instances other than seeds that the patterns vouch for."""
    nodes = found.where("value IS NOT NULL")
    seeds = checkpoint(seeds_of(found, hide).withColumn("w", F.lit(1.0)))
    edges = checkpoint(nodes.select("value", F.explode("patterns").alias("pattern")).distinct())
    members = seeds
    scored = None
    for _ in range(rounds):
        known = edges.join(members, "value", "left")
        # by pattern and kind first, so that the kind with the most weight names the pattern
        by_kind = known.groupBy("pattern", "kind").agg(F.count("*").alias("n"), F.sum(F.coalesce("w", F.lit(0.0))).alias("w"), F.count("w").alias("f"))
        patterns = by_kind.groupBy("pattern").agg(F.sum("n").alias("n"), F.max("w").alias("w"), F.max_by("f", F.struct("w", "kind")).alias("f"), F.max_by("kind", F.struct("w", "kind")).alias("kind"))
        trusted = patterns.where(F.col("f") >= support).select("pattern", "kind", (F.col("w") / (F.col("n") + doubt)).alias("s")).where(F.col("s") >= trust)
        reached = edges.join(trusted, "pattern").join(seeds.select("value"), "value", "left_anti")
        err = F.exp(F.sum(F.log(F.greatest(1 - F.col("s"), F.lit(1e-9)))))
        scored = reached.groupBy("value").agg((1 - err).alias("score"), F.max_by("kind", F.struct("s", "kind")).alias("kind"))
        scored = checkpoint(scored)
        members = seeds.union(scored.where(F.col("score") >= join).select("value", "kind", F.col("score").alias("w")))
    return scored.where(F.col("score") >= accept).select("value", "kind", "score")


def recovered(found: DataFrame, hide: int = HIDE) -> DataFrame:
    """(hidden, found): how many keys were hidden, and how many of them the patterns alone found as secrets."""
    hidden = keys_of(found).where(is_hidden(F.col("value"), hide))
    again = discovered(found, hide=hide).where("kind = 'secret'").select("value", F.lit(1).alias("hit"))
    return hidden.join(again, "value", "left").agg(F.count("*").alias("hidden"), F.count("hit").alias("found"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hide: int = HIDE) -> DataFrame:
    """Per row of docs: id_col, and base and spans, arrays of (kind, start, end, by_context) by start and kind; positions are code
    points, the end exclusive. by_context tells whether patterns found the span's value, which was no seed."""
    found = saved(instances(docs, id_col, text_col))
    by_context = discovered(found, hide=hide).select("value", F.col("kind").alias("as_kind"), F.lit(True).alias("by_context"))
    by_form = keys_of(found).select("value", F.lit("secret").alias("as_kind"), F.lit(False).alias("by_context"))
    extra = checkpoint(by_context.union(by_form).groupBy("value").agg(F.max_by("as_kind", "by_context").alias("as_kind"), F.bool_or("by_context").alias("by_context")))
    # only rows that may hold such a value are shuffled by it; all rows, those of texts without any, stay for their base spans
    added = maybe_among(found.where(~F.col("base") & F.col("value").isNotNull()), extra, ["value"]).join(extra, "value")
    judged = found.withColumns({"as_kind": F.lit(None).cast("string"), "by_context": F.lit(None).cast("boolean")}).unionByName(added)
    base, added = F.col("base"), ~F.col("base") & F.col("as_kind").isNotNull()
    kind = F.when(base, F.col("kind")).otherwise(F.col("as_kind"))
    rank = F.expr("array_position(array({}), k) - 1".format(", ".join(f"'{k}'" for k in KINDS))).cast("int")
    span = F.struct(F.col("start"), rank.alias("rank"), F.col("end"), (~base & F.coalesce("by_context", F.lit(False))).alias("by_context"))
    judged = judged.withColumn("k", kind)
    lists = judged.groupBy("row", "id").agg(F.array_sort(F.collect_list(F.when(base, span))).alias("base"), F.array_sort(F.collect_list(F.when(base | added, span))).alias("spans"))
    name = lambda x: F.struct(F.element_at(F.array(*map(F.lit, KINDS)), x["rank"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["by_context"].alias("by_context"))
    return lists.select(F.col("id").alias(id_col), F.transform("base", name).alias("base"), F.transform("spans", name).alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base spans by kind, the digest of all of them, all spans as text, the numbers of all and of added spans, of
    secrets, and of spans that patterns found."""
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    sizes = [F.size("spans").cast("long").alias("n_spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"), F.size(F.filter("spans", lambda x: x["kind"] == "secret")).cast("long").alias("n_secret")]
    sizes.append(F.size(F.filter("spans", lambda x: x["by_context"])).cast("long").alias("n_by_context"))
    return found.select(id_col, *(count(k) for k in KINDS[:4]), F.sha2(text("base").cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"), *sizes)
