"""The pipeline's stages one by one on a small corpus with planted cases, each judged on its own input."""

import random

import pytest

import corpus_pipeline as cp
from tests.llm import test_linededup, test_simhash_wide


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)] + ["the", "of"] * 30
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = {i: "\n".join(say(20) for _ in range(5)) for i in range(240)}
    for i in range(200, 240):  # toxic
        texts[i] = texts[i].replace("the", "idiot", 4) + " idiot moron idiot"
    for i in range(60, 65):  # copies
        texts[i] = texts[i - 60]
    for i in range(70, 75):  # near copies
        w = texts[i - 60].split(" ")
        w[len(w) // 2] = "changed"
        texts[i] = " ".join(w)
    items = [say(30) for _ in range(5)]
    for k, i in enumerate(range(80, 85)):  # benchmark passages
        texts[i] = texts[i] + "\n" + items[k]
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i >= 200)) for i in texts]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, lambda df: {r.doc_id for r in df.collect()}
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "byte_bpe"]
    stage = dict(cp.STAGES)

    kept = stage["toxicity"](spark, docs, folder)
    assert kept.columns == columns and set(range(200)) <= ids(kept) and len(ids(kept)) <= 202  # few labels to learn from

    kept = stage["line_dedup"](spark, docs, folder)
    gone = test_linededup.brute([(r.doc_id, r.text) for r in docs.collect()])
    assert kept.columns == columns
    for r in kept.collect():
        source = docs.where(f"doc_id = {r.doc_id}").first().text.split("\n")
        assert r.text == "\n".join(x for n, x in enumerate(source) if n not in gone.get(r.doc_id, [])) and r.n_chars == len(r.text)
    assert not ids(kept) & (set(range(60, 65)) | set(range(70, 75))) and set(range(90, 240)) <= ids(kept)

    kept = stage["simhash_near_dedup"](spark, docs, folder)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    groups = test_simhash_wide.groups_of([t for _, t in rows])
    assert kept.columns == columns and ids(kept) == {rows[g][0] for g in groups} and not ids(kept) & (set(range(60, 65)) | set(range(70, 75)))

    kept = stage["decontamination"](spark, docs, folder)
    assert kept.columns == columns and ids(docs) - ids(kept) == set(range(80, 85))

    out = stage["byte_bpe"](spark, docs, folder)
    assert out.count() == docs.count() and "ids_sha256" in out.columns


def test_run(spark, folder):
    ids = {r.doc_id for r in cp.run(spark, folder).collect()}
    assert set(range(90, 200)) <= ids
    assert len(ids & set(range(200, 240))) <= 2 and not ids & (set(range(60, 65)) | set(range(70, 75)) | set(range(80, 85)))


def test_empty(spark, folder, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 0").write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_odd_rows(spark, folder):
    """Null ids and texts, repeated ids and rows, and extra columns named like working columns, through every stage."""
    say = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    rows = [(None, say("a", 40)), (None, say("b", 40)), (1, None), (2, ""), (3, say("c", 40)), (3, say("d", 40)), (3, say("d", 40)), (4, say("c", 40)), (None, say("b", 40))]
    names = ["words", "n_lines", "n_removed", "removed", "words_removed", "id", "line", "row", "t1", "_among", "found", "score"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[k] * len(names)) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    stage = dict(cp.STAGES)
    for name, least in (("toxicity", 9), ("line_dedup", 8), ("simhash_near_dedup", 5), ("decontamination", 5)):
        docs = stage[name](spark, docs, folder)
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and docs.columns[5:] == names
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() == least, name
    assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=str) == sorted([(None, say("a", 40)), (None, say("b", 40)), (1, None), (3, say("c", 40)), (3, say("d", 40))], key=str)
    assert stage["byte_bpe"](spark, docs, folder).count() == 5


def test_line_dedup_keeps_unmatched_lines(spark, folder):
    say = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    rows = [(1, say("a", 30)), (2, say("b", 30)), (3, f"{say('a', 30)}\n{say('b', 30)}\nonly here"), (4, f"{say('b', 30)}\n\n{say('a', 30)}"), (5, ""), (6, None), (7, "the\nonly\nline"), (8, "line\nnew")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in dict(cp.STAGES)["line_dedup"](spark, docs, folder).collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 2: (rows[1][1], len(rows[1][1])), 3: ("only here", 9), 5: ("", 0), 6: (None, 0), 7: ("the\nonly\nline", 13), 8: ("new", 3)}
