import random
import string
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.test_operators import brute_survivors
from tidemark.functions import similar, text
from tidemark.operators import dedup

RECORDS = "seq long, exact string, norm string, block string"


def names(n, seed, letters="abcdeé ", lengths=(0, 1, 2, 3, 5, 8, 12, 20, 33, 45)):
    rng = random.Random(seed)
    made = ["".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(n)]
    return made + [x[: rng.randrange(len(x) + 1)] + rng.choice(letters) + x[rng.randrange(len(x) + 1) :] for x in made]


def test_many_similarities_equal_one_by_one():
    a = names(1500, 1)
    b = a[:]
    random.Random(2).shuffle(b)
    b[700:] = [x[:3] + x[4:] + "a" for x in a[700:]]
    got = similar.jaro_winkler_many(a, b)
    assert [float(x) for x in got] == [text._jaro_winkler(x, y) for x, y in zip(a, b)]
    assert len(similar.jaro_winkler_many([], [])) == 0


@pytest.mark.parametrize("threshold", [0.8, 0.9, 0.95])
def test_similar_names_share_a_key(threshold):
    rng = random.Random(3)
    pool = [x for x in set(names(60, 4)) if 0 < len(x) <= similar.LONGEST]
    pool += [x[:-1] + rng.choice("xyz") for x in pool if len(x) > 1]
    made = {x: similar.keys(x, threshold) for x in set(pool)}
    found = 0
    for a, b in combinations(sorted(made), 2):
        if text._jaro_winkler(a, b) >= threshold:
            short, long = (a, b) if len(a) <= len(b) else (b, a)
            sides = (2, 2) if len(a) == len(b) else (0, 1)
            assert {k for k, s in made[short] if s == sides[0]} & {k for k, s in made[long] if s == sides[1]}, (a, b)
            found += 1
    assert found > 30


def brute_pairs(rows, threshold):
    return {(a, b) for a, b in combinations(sorted(set(rows)), 2) if a and text._jaro_winkler(a, b) >= threshold}


def test_large_blocks_lose_no_pair(spark):
    rows = names(200, 5)
    df = spark.createDataFrame([("X:aa", n) for n in rows] + [("Y:bb", n) for n in rows[:40]] + [("X:aa", None)], "block string, norm string")
    got = dedup.fuzzy_pairs(df, 0.9, small=50).collect()
    assert {(r.a, r.b) for r in got if r.block == "X:aa"} == brute_pairs(rows, 0.9)
    assert {(r.a, r.b) for r in got if r.block == "Y:bb"} == brute_pairs(rows[:40], 0.9)
    assert len(got) == len({(r.block, r.a, r.b) for r in got}) and all(r.score == text._jaro_winkler(r.a, r.b) for r in got)


def test_a_hot_block_compares_few_pairs(spark):
    rng = random.Random(6)
    rows = sorted({"ac" + "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(6, 14))) for _ in range(1500)})
    df = spark.createDataFrame([("X:ac", n, len(rows), 0) for n in rows], "block string, n string, names long, longs long")
    compared = dedup.candidates(df, 0.9, 100).count()
    assert compared < 0.03 * len(rows) ** 2 / 2  # of all pairs


@pytest.mark.parametrize("part", [40, 10_000])
def test_a_chain_of_names_settles(spark, part):
    """Each name is like the next ones only: a round for each link would be needed."""
    rng = random.Random(7)
    name, rows = [rng.choice(string.ascii_lowercase) for _ in range(16)], []
    for i in range(260):
        name[2 + i % 14] = rng.choice(string.ascii_lowercase)
        rows.append((i, None, "".join(name), "X:aa"))
    got = {r.seq: r.status for r in dedup.survivors(spark.createDataFrame(rows, RECORDS), 0.9, part=part).collect()}
    assert got == brute_survivors(rows, 0.9)


def test_a_chain_of_ten_thousand_keys(spark):
    """Records share an exact key with the one before and a name with the one after, so each depends on the last."""
    rows = [(i, f"e{i // 2}", f"n{(i + 1) // 2:05d}".translate(str.maketrans(string.digits, "bcdfghjklm")) * 1, f"X:{i % 7}") for i in range(10_000)]
    df = spark.createDataFrame(rows, RECORDS).withColumn("block", F.concat(F.lit("X:"), F.col("norm")))  # no similar names in a block
    got = {r.seq: r.status for r in dedup.survivors(df, 0.9, part=4000).collect()}
    kept_e, kept_n, expected = set(), set(), {}
    for seq, e, n, _ in rows:
        twin = e in kept_e or n in kept_n
        expected[seq] = "duplicate" if twin else "keep"
        if not twin:
            kept_e.add(e), kept_n.add(n)
    assert got == expected and set(expected.values()) == {"keep", "duplicate"}


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_parts_in_order_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(dedup, "JOIN_ROUNDS", 0)
    rng = random.Random(seed)
    pool = ["acme", "acmee", "acmes", "acne", "abcde", "abcdf", "abxdf", "zeta", "zetas", ""]
    rows = []
    for i in range(120):
        n, kind = rng.choice(pool), rng.choice("AB")
        rows.append((i * 3, rng.choice([None, f"u{rng.randrange(60)}"]), n, f"{kind}:{n[:2]}"))
    got = {r.seq: r.status for r in dedup.survivors(spark.createDataFrame(rows, RECORDS), 0.85, part=25).collect()}
    assert got == brute_survivors(rows, 0.85)


def test_survivors_of_nothing(spark):
    assert dedup.survivors(spark.createDataFrame([], RECORDS)).collect() == []


@pytest.mark.parametrize("seed", range(2))
def test_records_that_lead_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(dedup, "HEAD", 15)
    monkeypatch.setattr(dedup, "LEAD_FROM", 20)
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abc ") for _ in range(rng.choice([0, 4, 9])))
    rows = [(i, rng.choice([None, f"url:{rng.randrange(60)}"]), word(), rng.choice(["X:aa", "Y:aa", "X:bb"])) for i in range(300)]
    got = {r.seq: r.status for r in dedup.survivors(spark.createDataFrame(rows, RECORDS), 0.85).collect()}
    assert got == brute_survivors(rows, 0.85)


def test_names_that_are_all_alike_make_no_pairs(spark, monkeypatch):
    compared, plain = [], dedup.fuzzy_pairs
    monkeypatch.setattr(dedup, "fuzzy_pairs", lambda names, *args, **more: compared.append(names.count()) or plain(names, *args, **more))
    df = spark.range(6000).selectExpr("id AS seq", "CAST(NULL AS STRING) AS exact", "concat('supplier', lpad(id, 9, '0')) AS norm", "'JOB:su' AS block")
    assert dedup.survivors(df, 0.9).where("status = 'keep'").count() < 10
    assert sum(compared) < 100  # all of them before


def test_the_records_that_lead_grow_with_the_open_ones(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HEAD", 64)
    monkeypatch.setattr(dedup, "LEAD_FROM", 256)
    rounds, led = [], dedup._led
    monkeypatch.setattr(dedup, "_led", lambda state, threshold, rows: rounds.append(rows) or led(state, threshold, rows))
    rng = random.Random(8)
    kinds = ["aa" + "".join(rng.choice(string.ascii_lowercase) for _ in range(12)) for _ in range(400)]
    rows = [(i, None, kinds[i % 400] + "abcdefghij"[i // 400], "X:aa") for i in range(4000)]
    got = {r.seq: r.status for r in dedup.survivors(spark.createDataFrame(rows, RECORDS), 0.9).collect()}
    assert got == {i: "keep" if i < 400 else "duplicate" for i in range(4000)}
    assert len(rounds) <= 4  # 6 with heads of 64
