"""URL rules, spelling variants and hard negatives against brute force, and on awkward tables."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from llm_data import documents, no_documents
from pyspark.sql import functions as F

from flowtables.llm import hardnegatives as hn
from flowtables.llm import spelling, urlrules
from flowtables.llm.urlrules import Rule, site

BIG = (1 << 62) + 1


# URL rules

URLS = [None, "", "no scheme", "://", "http://", "http://ORG/", "http://org", "http://Example.ORG/es/", "https://a.example.org/es/x?y#z",
        "https://a.example.org/es", "http://myexample.org/es/1", "http://example.org/en/12", "http://a.com/fr/", "http://a.com/de/1",
        "http://a.com/it/", "http://com?x=/fr/", "http://casino-win.net/en/1", "http://b.net/casino/", "http://b.casinos.net/", "http://mycasino.net/",
        "http://é.casino.net/ü/ñ", "http://ads.x.net/", "http://x.ads/", "ftp://h.net/cgi-bin/a/redirect/b", "http://h.net/a//b://c.com/fr/",
        "http://h.net/" + "a/" * 60 + "wp-login.php", "http://sub.gov/x", "http://bad.gov\n/x", "http://bet.gov/", "HTTP://U@H.NET:80/phpmyadmin/"]


def test_safe_tokens_are_enclosed():
    assert urlrules.safe_tokens("||example.org/en/1") == ["example", "org", "en"]
    assert urlrules.safe_tokens("*foo*") == urlrules.safe_tokens("foo") == [] and urlrules.safe_tokens("|Foo|") == ["foo"]
    assert urlrules.safe_tokens("/a*b/c^") == ["c"]


def test_index_decides_like_all_rules_on_all_urls(spark):
    r = random.Random(13)
    words = ["a", "bb", "casino", "en", "x1", "é"]
    extra = [Rule(r.choice(["allow", "block"]), r.choice(["", "|", "||", "^", "*"]) + r.choice("./-^*").join(r.sample(words, r.randint(1, 3)))
                  + r.choice(["", "^", "*", "|", "/"]), f"r{i % 7}", r.randint(0, 2), r.random() < 0.3) for i in range(150)]
    rules = [*urlrules.SITES, *urlrules.DEFAULTS, *extra]
    urls = URLS + ["http://" + r.choice(".-").join(r.choices(words, k=3)) + "/" + r.choice("/-.?#").join(r.choices(words, k=4)) for _ in range(400)]
    pages = spark.createDataFrame([(None if i == 3 else BIG + i, u, "h", "r") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string").repartition(5)

    def brute(url):
        host, path = urlrules.parts(url)
        fits = [x for x in rules if re.search(urlrules._regex(x.pattern), host if x.host_only else host + path)]
        best = min(fits, key=lambda x: (x.tier, -len(x.name), x.verdict != "block", x.name), default=None)
        name = best.name if best and not best.tier else None
        return host, path, name, best.verdict if best else "allow", best.tier if best else None

    got = {r.page_id: r for r in urlrules.judged(pages, rules).collect()}
    assert len(got) == len(urls)
    tried = 0
    for i, u in enumerate(urls):
        row = got[None if i == 3 else BIG + i]
        host, path, name, verdict, tier = brute(u)
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, name, verdict), u
        assert (row.pattern is not None) == bool(tier)
        tried += row.n_tried
    assert tried < 0.75 * len(urls) * len(rules)  # the rest was never run


def test_site_rules_and_no_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = {URLS[r.page_id]: (r.rule, r.verdict) for r in urlrules.judged(pages, urlrules.SITES).collect()}
    assert got["http://ORG/"] == ("org/", "allow") and got["http://org"] == (None, "allow")
    assert got["https://a.example.org/es/x?y#z"] == ("example.org/es/", "block") and got["https://a.example.org/es"] == ("org/", "allow")
    assert got["http://myexample.org/es/1"] == ("org/", "allow") and got["http://example.org/en/12"] == ("example.org/en/1", "block")
    assert got["http://com?x=/fr/"] == (None, "allow") and got["http://a.com/de/1"] == ("com/de/", "block")
    assert {r.verdict for r in urlrules.judged(pages, []).collect()} == {"allow"}
    assert urlrules.judged(pages.limit(0), [site("block", "x")]).count() == 0
    long = spark.createDataFrame([(1, "http://h.net/" + "a/b." * 300_000 + "end")], "page_id long, url string")
    rules = [Rule("block", "/a*.b*.c", "never"), Rule("block", "*a*b*end|", "there")]
    assert [(r.verdict, r.pattern) for r in urlrules.judged(long, rules).collect()] == [("block", "*a*b*end|")]


# Spelling variants

def close(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_near_words_are_all_pairs_one_edit_apart(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LONGEST", 12)  # fewer levels; longer words go by hashes
    r = random.Random(3)
    words = {"".join(r.choice("abé") for _ in range(r.randint(4, 9))) for _ in range(120)}
    for size in (11, 12, 13, 14, 900):
        base = "".join(r.choice("ab") for _ in range(size))
        words |= {base, base[:5] + "c" + base[6:], base[:-1] + "c", base + "a", "a" + base, base[1:], "a" * size, "a" * (size - 1) + "b"}
    words = sorted(words)
    got = [tuple(x) for x in spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()]
    assert sorted(got) == [(a, b) for a in words for b in words if close(a, b)]


def brute_variants(rows, letters=7):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= letters and n >= 2}
    out = {}
    for w, n in words.items():
        near = [v for v in words if close(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best and words[best] >= 10 * n else None, n, len(near))
    rows = set()
    for w, (form, n, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, near, words[form] if form else None))
    return rows


def test_variants_of_texts_and_of_awkward_rows(spark):
    r = random.Random(4)
    base = ["Receive", "separate", "Éléphants", "definite"]
    texts = []
    for i in range(300):
        word = r.choice(base)
        if r.random() < 0.06:
            k = r.randrange(len(word))
            word = word[:k] + r.choice(["", "x", word[k] * 2]) + word[k + 1:]
        texts.append((None if i == 5 else BIG + i % 250, f"{word} {word.upper()}-{r.choice(base)}1{r.choice(base)}s tiny"))
    got = spelling.spelling_variants(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {tuple(x) for x in got.collect()} == brute_variants(texts) and got.count() == len(brute_variants(texts))
    awkward = documents(spark)
    rows = [(x.doc_id, x.text) for x in awkward.collect()]
    assert {tuple(x) for x in spelling.spelling_variants(awkward).collect()} == brute_variants(rows)
    assert spelling.spelling_variants(no_documents(spark)).count() == 0


def test_forms_lead_to_a_root_and_ties_to_the_smallest_word(spark):
    words = [("aaaaaaaa", 1), ("aaaaaaab", 12), ("aaaaaabb", 150), ("aaaaaaac", 12), ("zzzzzzz", 2), ("zzzzzzy", 19)]
    got = {x.word: (x.form, x.root, x.n_near, x.form_n) for x in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert got["aaaaaaaa"] == ("aaaaaaab", "aaaaaabb", 2, 12) and got["aaaaaaab"] == ("aaaaaabb", "aaaaaabb", 3, 150)
    assert got["aaaaaabb"] == (None, "aaaaaabb", 1, None) and got["zzzzzzz"] == (None, "zzzzzzz", 1, None)


# Hard negatives

def brute_negatives(rows):
    usable = [(i, g, v) for i, g, v in rows if g is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    usable = [(i, (g + 1) % 10 if i is not None and i % 7 == 0 else g, [math.floor(256 * x) for x in v]) for i, g, v in usable]
    out = Counter()
    for k, (a, group, v) in enumerate(usable):
        if a is None or a % 50:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w, strict=True)), i is None, i or 0, g) for m, (i, g, w) in enumerate(usable)
                         if m != k and len(w) == len(v)))
        for s, nameless, p, _ in [x for x in scored if x[3] == group][:5]:
            fits = [x for x in scored if x[3] != group and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            for rank, (t, none, n, _) in enumerate(fits, 1):
                out[(a, None if nameless else p, rank, None if none else n, -s, -t)] += 1
    return out


@pytest.mark.parametrize("dimensions, part", [(3, 30), (40, 32_768)])
def test_hard_negatives_are_those_of_brute_force(spark, dimensions, part):
    r = random.Random(dimensions)
    vectors = [[r.gauss(0, 0.3) for _ in range(dimensions)] for _ in range(130)]
    rows = [(50 * (i // 3) if i % 3 == 0 else i, r.randrange(4), v) for i, v in enumerate(vectors)]
    rows += [(BIG - BIG % 50, 1, vectors[0]), (BIG, 2, vectors[1]), (BIG + 2, 2, vectors[1]), (None, 2, vectors[2]), (None, 1, vectors[3]),
             (50, 1, vectors[5]), (50, 1, vectors[5]), (100, 9, [0.0] * dimensions), (150, None, vectors[1]), (200, 1, None), (250, 1, []),
             (300, 1, [None] * dimensions), (350, 1, [math.nan] * dimensions), (400, 1, [math.inf] * dimensions), (450, 1, [0.5]), (451, 1, [0.5]), (452, 2, [0.3])]
    table = spark.createDataFrame([(*x, 1, "s") for x in rows], "vec_id long, label int, embedding array<double>, rank int, score string").repartition(4)
    got = hn.hard_negatives(hn.relabelled(table), F.col("vec_id") % 50 == 0, hn.Mining(part=part))
    assert Counter(tuple(x) for x in got.collect()) == brute_negatives(rows)


def test_hard_negatives_of_few_rows(spark):
    kind = "vec_id long, label int, embedding array<float>"
    for rows in ([], [(50, 1, [1.0])], [(50, 1, [1.0]), (51, 2, [1.0])], [(51, 1, [1.0]), (52, 1, [1.0])]):
        assert hn.hard_negatives(hn.relabelled(spark.createDataFrame(rows, kind)), F.col("vec_id") % 50 == 0).count() == 0
    rows = [(50, 1, [1.0]), (51, 1, [1.0]), (52, 2, [0.9]), (53, 2, [1e30])]
    got = hn.hard_negatives(hn.relabelled(spark.createDataFrame(rows, kind)), F.col("vec_id") % 50 == 0).collect()
    assert [tuple(x) for x in got] == [(50, 51, 1, 52, 65536, 256 * 230)]
