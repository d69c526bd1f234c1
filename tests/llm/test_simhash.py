import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus():
    rng = random.Random(5)
    words = [f"w{i}É" for i in range(60)] + ["The", "OF"]
    texts = [None, "", " \n\t ", "one", "One", "two words", "a b c", "a b c d"]
    base = [rng.choice(words) for _ in range(150)]
    for _ in range(40):
        near = list(base)
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(len(near))] = rng.choice(words)
        texts.append(" ".join(near))
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(30)]
    return texts + texts[10:20] + ["long " * 100_000]


def test_against_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(100 - i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp string")
    expected = {100 - i: brute_print(t) for i, t in enumerate(texts)}
    parts = brute_components(expected)
    for longest in (4096, 2):  # lists searched by one task, and by points around each fingerprint
        got = {r.doc_id: r for r in simhash.near_duplicates(docs, longest=longest).collect()}
        assert {i: int(r.fingerprint, 16) for i, r in got.items()} == expected
        assert all(len(r.fingerprint) == 16 for r in got.values())
        assert {i: r.component_id for i, r in got.items()} == parts


@pytest.mark.parametrize("longest", [4096, 1])
def test_links_lose_nothing(spark, longest):
    from tidemark.llm.common import connected_components

    rng = np.random.default_rng(3)
    fps = {0}
    for _ in range(60):
        fps.add(int(rng.integers(0, 1 << 63)))
        x = rng.choice(list(fps))
        for _ in range(rng.integers(1, 5)):
            x = int(x) ^ (1 << int(rng.integers(0, 63)))
        fps.add(int(x))
    fps = sorted(fps)
    parts = brute_components(dict(zip(range(len(fps)), fps, strict=True)))
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.node: r.component for r in connected_components(simhash.links(df, longest)).collect()}
    assert {x: got.get(x, x) for x in fps} == {x: fps[parts[i]] for i, x in enumerate(fps)}


def test_chain_and_empty(spark):
    from tidemark.llm.common import connected_components

    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(5, 5), (100, 101), (101, 100)], "u long, v long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
