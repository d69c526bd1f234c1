import hashlib
import random
import re
import zlib
from collections import defaultdict

from tidemark.llm import common, trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[2] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c > 0 else -1)
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        words = lambda n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), sum((len(members[n]) - 1) * words(n) for n in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, schema=SCHEMA):
    return sorted((tuple(r) for r in trie.build(spark.createDataFrame(rows, schema)).select(*COLUMNS).collect()), key=repr)


def test_random_conversations(spark):
    rng = random.Random(9)
    rows = []
    for c in rng.sample(range(-50, 400), 160):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, turn, rng.choice(["user", "user", None]), rng.choice(["hi there", "a b  c", "", None, "ok"])))
    rows += rng.sample(rows, 12) + [(None, 0, "user", "lost"), (7, None, "user", "first"), (7, None, "", "first")]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_long_conversations_and_many_copies(spark):
    rng = random.Random(2)
    rows = [(c, t, "user", f"t{t if t < 11 else rng.randrange(3)} x") for c in (20, 21, 40, 41, 60) for t in range(37)]
    rows += [(c, t, "user", f"copy {t}") for c in range(1000, 1700) for t in range(2)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert max(r[1] for r in got) == 37


def test_turnless_role_and_text_borders(spark):
    rows = [(c, 0, "user", "one") for c in range(100, 110)] + [(5, 0, "ab", "c"), (5, 1, "a", "bc"), (6, 0, "a", "bc"), (6, 1, "ab", "c")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)  # some conversations have no turns left


def test_empty_and_clashing_columns(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, 0, "u", "x", 1, 2, 3)], SCHEMA + ", c int, d int, name int") == brute([(1, 0, "u", "x")])
    assert run(spark, [(None, 0, "u", "x")]) == []


def test_long_text(spark):
    rows = [(c, t, "user", "w " * 200_000 + str(t)) for c in (1, 2) for t in range(5)]
    assert run(spark, rows) == brute(rows)


def test_names_are_dense(spark):
    rows = spark.createDataFrame([(i % 37,) for i in range(500)], "k int").repartition(7)
    names, total = common.dense_names(rows, ["k"])
    assert total == 500 and sorted(r.name for r in names.collect()) == list(range(37))


def test_running_sums_over_partitions(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(0 if i % 3 else i % 5, i, i % 4) for i in range(3000)], "g int, i int, v int")
    got, _ = common.running(rows, "g", [F.col("i")], "v")
    sums = defaultdict(int)
    expected = {}
    for i in range(3000):
        g = 0 if i % 3 else i % 5
        expected[i] = sums[g]
        sums[g] += i % 4
    assert {r.i: r.before for r in got.collect()} == expected


def test_look_up_of_hot_and_rare_keys(spark):
    rows = spark.createDataFrame([(0 if i % 2 else i, i) for i in range(2000)], "k int, i int")
    facts = rows.groupBy("k").count().withColumnRenamed("count", "n").selectExpr("k", "n", "k * 10 AS ten").where("k <> 6")
    got = common.look_up(rows, facts, ["k"], "n").collect()
    assert len(got) == 1999 and all(r.ten == r.k * 10 for r in got)
