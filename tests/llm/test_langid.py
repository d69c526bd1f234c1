import html
import math
import random
import re

from tidemark.llm import langid


def test_address():
    assert langid.address("https://u:p@www.Ex.co.uk:80/x") == ("www.ex.co.uk", "ex.co.uk", "uk")
    assert langid.address("http://a.de?q") == ("a.de", "a.de", "de")
    assert langid.address(None) == langid.address("nonsense") == (None, None, None)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in langid.identify(pages, docs).collect()}
    truth = {r.page_id: re.search(r"/(en|fr|de|es)/", r.url).group(1) for r in pages.collect()}
    assert len(got) == len(truth)
    assert sum(got[i].lang == x for i, x in truth.items()) >= 0.97 * len(truth)
    # without the declaration, and with a wrong one
    bare = pages.selectExpr("page_id", "url", "regexp_replace(html, '<html[^>]*>', '<html>') AS html")
    assert sum(r.lang == truth[r.page_id] for r in langid.identify(bare, docs).collect()) >= 0.9 * len(truth)


def test_evidence_meets(spark):
    docs = spark.createDataFrame([("the and of the and with", "en"), ("der die und das mit und", "de")] * 5 + [(None, "en"), ("x", None)], "text string, lang string")
    rows = [(i, "http://h.example.de/", "<html lang=de><p>der die und das") for i in range(30)]
    rows += [(100, "http://h.example.de/", "<p>"), (101, "http://other.com", '<html lang="en">'), (102, None, None), (103, "http://other.com", "<script>der die das</script><p>the and of the")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, lang string")
    got = {r.page_id: r.lang for r in langid.identify(pages, docs).collect()}
    assert got[0] == got[100] == "de" and got[101] == got[103] == "en" and got[102] in ("de", "en") and len(got) == 34
    assert langid.identify(pages, docs.where("lang = 'xx'")).where("lang IS NOT NULL").count() == 0
    assert langid.identify(pages.where("page_id < 0"), docs).count() == 0


def test_declaration_anywhere():
    head = "<!-- <html lang=fr> -->" + "<script>'<html lang=es>'" + "x" * 9000 + "</script><style>" + "y" * 9000 + "</style><link rel=preload>" * 200
    assert langid.declaration(f"<!doctype html>{head}<html class=a lang='DE-at'><p>") == "de"
    assert langid.declaration(f'<html>{head}<meta http-equiv="Content-Language" content="de">') == "de"
    assert langid.declaration(f"<html>{head}<p lang=de><meta content=de>") is None and langid.declaration("") is None
    for part in ("<html ", "<meta ", "<meta content-language ", "lang ", "<html lang <meta content-language content "):
        assert langid.declaration(part * 100_000) is None  # linear


def test_late_declaration_is_evidence(spark):
    docs = spark.createDataFrame([("the and of the and with", "en"), ("der die und das mit und", "de")] * 5, "text string, lang string")
    late = "<!--" + "x" * 5000 + "-->"
    pages = spark.createDataFrame([(1, None, f"{late}<html lang=de><p>"), (2, None, f"{late}<html lang=en><p>")], "page_id long, url string, html string")
    assert {r.page_id: r.lang for r in langid.identify(pages, docs).collect()} == {1: "de", 2: "en"}


def test_every_language_and_suffix_counts(spark):
    say = lambda k: " ".join(f"{chr(0x4E00 + 7 * k + i)}{chr(0x5E00 + k)}" for i in range(7))
    docs = spark.createDataFrame([(say(k) * (2 if k else 1), f"l{k:02d}") for k in range(70)], "text string, lang string")
    pages = spark.createDataFrame([(k, None, f"<p>{say(k)}") for k in range(70)], "page_id long, url string, html string")
    assert {r.page_id: r.lang for r in langid.identify(pages, docs).collect()} == {k: f"l{k:02d}" for k in range(70)}

    docs = spark.createDataFrame([("the and of the and with", "en"), ("der die und das mit und", "de")] * 5, "text string, lang string")
    rows = [(f"http://h{i}.s{i % 1000:04d}/", "<p>the and of the and with the and") for i in range(4000)]
    rows += [(f"http://g{i}.zz/", "<p>der die und das mit und der die") for i in range(3)] + [("http://new.zz/", None)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    assert langid.identify(pages, docs).where("page_id = 4003").first().lang == "de"


def brute_identify(pages, docs):
    """The fusion over plain lists and dictionaries, one page after the other."""
    counts = {}
    for text, lang in docs:
        if text is not None and lang:
            own = counts.setdefault(lang.lower().strip(), {})
            for b in langid.grams(text).tolist():
                own[b] = own.get(b, 0) + 1
    langs = sorted(counts)
    chance = {x: lambda b, c=counts[x], t=sum(counts[x].values()): (c.get(b, 0) + langid.GRAM_PRIOR) / (t + langid.GRAM_PRIOR * langid.BUCKETS) for x in langs}
    facts = []
    for page, url, source in pages:
        found = langid.grams(html.unescape(langid.UNSEEN.sub(" ", source or ""))).tolist()
        z = {x: sum(math.log(chance[x](b)) for b in found) if len(found) > 2 else 0.0 for x in langs}
        top = max(z.values())
        e = {x: math.exp(max(-60.0, (v - top) / max(1.0, math.sqrt(len(found)) / 2))) for x, v in z.items()}
        declared = langid.declaration(source or "")
        facts.append((page, *langid.address(url), declared if declared in langs else None, {x: v / sum(e.values()) for x, v in e.items()}))

    def sums(test):
        chosen = [f[5] for f in facts if test(f)]
        return {x: sum(t[x] for t in chosen) for x in langs}

    whole = sums(lambda f: True)
    prior = {x: (whole[x] + 1) / (sum(whole.values()) + len(langs)) for x in langs}
    suffixed = sums(lambda f: f[3] is not None)
    out = {}
    for page, host, domain, suffix, declared, text in facts:
        p = prior
        if host is not None:
            for own in (sums(lambda f: f[2] == domain), sums(lambda f: f[1] == host)):
                others = {x: max(own[x] - text[x], 0) for x in langs}
                p = {x: (others[x] + langid.HOST_PRIOR * p[x]) / (sum(others.values()) + langid.HOST_PRIOR) for x in langs}
        score = {}
        for x in langs:
            z = math.log(max(text[x], 1e-30)) + math.log(p[x])
            if declared:
                rows = {y: sums(lambda f, y=y: f[4] == y) for y in langs}
                right = langid.DECLARED_RIGHT if declared == x else (1 - langid.DECLARED_RIGHT) / (len(langs) - 1)
                z += math.log((rows[declared][x] + langid.TABLE_PRIOR * right) / (sum(rows[y][x] for y in langs) + langid.TABLE_PRIOR))
            if suffix is not None:
                own = sums(lambda f: f[3] == suffix)
                z += math.log((own[x] + langid.TABLE_PRIOR * (sum(own.values()) + 1) / (sum(suffixed.values()) + 1)) / (suffixed[x] + langid.TABLE_PRIOR))
            score[x] = z
        top = max(score.values())
        out[page] = ({x: math.exp(v - top) / sum(math.exp(u - top) for u in score.values()) for x, v in score.items()}, text)
    return out


def test_fusion_against_brute_force(spark):
    rng = random.Random(6)
    words = {"en": "the of and with that from".split(), "de": "der die und das nicht mit".split(), "fr": "le la les des dans pour".split()}
    say = lambda x, n: " ".join(rng.choice(words[x]) for _ in range(n))
    docs = [(say(x, 40), x) for x in words for _ in range(3)] + [(None, "en"), ("zz", ""), ("x y", None)]
    pages = []
    for i in range(60):
        x, y = rng.choice(list(words)), rng.choice(list(words))
        tag = rng.choice(["<html>", f'<html lang="{x}">', f"<html lang={y}-XX>", "<html lang=zz>"])
        url = rng.choice([f"http://h{rng.randrange(3)}.{x}site.{x}/p", f"https://www.site.{y}", None, "nonsense", "http://plain.com/"])
        pages.append((i, url, rng.choice([f"{tag}<p>{say(x, rng.randint(0, 12))}", f"{tag}<p>{say(x, 2)} {say(y, 2)}", None if i % 9 == 0 else tag])))
    expected = brute_identify(pages, docs)
    got = langid.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), spark.createDataFrame(docs, "text string, lang string")).collect()
    assert len(got) == 60
    for r in got:
        chances, text = expected[r.page_id]
        assert abs(r.probability - max(chances.values())) < 1e-4 and abs(chances[r.lang] - max(chances.values())) < 1e-4, r
        assert abs(text[r.text_lang] - max(text.values())) < 1e-4
