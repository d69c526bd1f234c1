import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import extract, offload

FACTS = "doc long, field string, chunk int, value string, confidence double"


def squeezed(text):
    return re.sub(r"\s+", "", text)


@pytest.mark.parametrize("budget", [4, 17, 60, 1000])
def test_no_chunk_exceeds_its_budget_and_nothing_is_lost(spark, budget):
    rng = random.Random(budget)
    word = lambda: "".join(rng.choice("abcdéfg12") for _ in range(rng.choice([1, 4, 9, 70])))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(1, 12))) + rng.choice([". ", "! ", "?", ""])
    texts = ["\n\n".join("".join(sentence() for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 6))) for _ in range(40)]
    texts += ["", None, "  \n\n ", "x" * 5000, "!" * 700, "a\n\n\n\nb", "日本語" * 50, "one. two. three."]
    docs = spark.createDataFrame([(i % 40, t) for i, t in enumerate(texts)], "i int, text string")  # ids repeat
    rows = extract.budgeted(docs, "i", "text", budget).collect()
    counted = spark.createDataFrame([(r.text, r.tokens) for r in rows], "t string, n int").select(extract.tokens(F.col("t")).alias("real"), "n").collect()
    assert all(c.real <= c.n <= budget for c in counted)
    for i in range(40):
        own = [r for r in rows if r.i == i]
        assert sorted(c for r in own for c in squeezed(r.text)) == sorted(c for k, t in enumerate(texts) if k % 40 == i and t for c in squeezed(t))
    long = sorted((r.chunk, r.text) for r in rows if r.i == 43 % 40 and set(r.text) == {"x"})
    assert "".join(t for _, t in long) == "x" * 5000  # in order
    if budget == 1000:
        assert [r.text for r in rows if r.i == 47 % 40 and r.text.startswith("one")] == ["one. two. three."]


def test_budget_of_other_counts_and_headings(spark):
    docs = spark.createDataFrame([(1, "# A\n\nabc def\n\n## B\nghi")], "i int, text string")
    rows = extract.budgeted(docs, "i", "text", 8, count=F.length).collect()
    assert all(r.tokens <= 8 for r in rows)
    assert docs.select(extract.headings(F.col("text")).alias("h")).first().h == ["# A", "## B"]
    with pytest.raises(ValueError):
        extract.budgeted(docs, "i", "text", 3)


def brute_merge(rows):
    out = {}
    for key in {r[:2] for r in rows}:
        held = {}
        for doc, field, chunk, value, confidence in rows:
            if (doc, field) == key and value is not None:
                held.setdefault(value, []).append((chunk, confidence))
        ranked = sorted((-len(x), -max([c for _, c in x if c is not None], default=float("-inf")), min(k for k, _ in x), v) for v, x in held.items())
        best = ranked[0] if ranked else None
        out[key] = (best[3], None if best[1] == float("inf") else -best[1], -best[0], len(held) > 1) if best else (None, None, 0, False)
    return out


def test_merge_in_a_fixed_order(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(30), rng.choice("ab"), rng.randrange(6), rng.choice(["x", "y", "z", None]), rng.choice([0.5, 0.9, None])) for _ in range(300)] + [(99, "a", 0, None, 0.4)]
    for order in (rows, rows[::-1]):
        got = extract.merged(spark.createDataFrame(order, FACTS).repartition(3), ["doc", "field"]).collect()
        assert {(r.doc, r.field): (r.value, r.confidence, r.facts, r.conflict) for r in got} == brute_merge(rows)
    assert extract.merged(spark.createDataFrame([], FACTS), ["doc", "field"]).collect() == []


def test_bodies_are_kept_once(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(i, ["same", "other " + "x" * 1000, None, "", f"own {i}"][i % 5]) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, body string")
    for _ in range(2):
        kept = offload.offload(df, "body", path)
    assert kept.columns == ["id", "content_hash", "body_uri"]
    assert offload.bodies(spark, path).count() == 3 + 10
    assert sorted(tuple(r) for r in offload.restored(kept, path).select("id", "body").collect()) == sorted(rows)
    offload.offload(spark.createDataFrame([(60, "same"), (61, "new")], "id int, body string"), "body", path)
    assert offload.bodies(spark, path).count() == 14
    assert offload.restored(spark.createDataFrame([("0" * 64,), (None,)], "content_hash string"), path).select("body").distinct().collect()[0].body is None
    assert offload.restored(kept, str(tmp_path / "none")).where("body IS NOT NULL").count() == 0
