"""Languages, quality, licenses and pages: known results, held-out accuracy, awkward tables."""

import random
import time

import numpy as np
import pytest
from conftest import DATA
from llm_data import DOCUMENTS, documents, no_documents, prose
from pyspark.sql import functions as F

from flowtables.llm import html, language, licences, quality
from flowtables.llm.common import held_out, table

ENGLISH = "the and of that with this from have there which would their been other into more than".split()
FRENCH = "le la les des une dans pour avec cette qui sont mais nous leur être été même aux".split()
RUSSIAN = "это как его она они был для что так все меня если уже или нет быть".split()


def sentence(words, n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(w, sentence(words, 60, i)) for i in range(30) for w, words in (("en", ENGLISH), ("fr", FRENCH), ("ru", RUSSIAN))]
    return language.trained(spark.createDataFrame([*rows, (None, "le la les"), ("en", None)], "lang string, text string"))


def test_spans_of_mixed_languages(model):
    a, b, c = sentence(ENGLISH, 40, 91), sentence(FRENCH, 30, 92), sentence(RUSSIAN, 5, 93)
    text = f"{a}\n{b} {c}"
    (top, score, spans), = language.predicted([text], model)
    assert top == "en" and 0.4 < score < 0.7
    assert [(s, text[i:j]) for s, i, j in spans] == [("en", a), ("fr", b), ("ru", c)]


def test_viterbi_against_all_paths():
    from itertools import product
    r = np.random.default_rng(4)
    scores, text = r.normal(size=(14, 3)).astype(np.float32), np.array([0] * 5 + [2] * 1 + [3] * 8)
    got = language.best_path(scores, text, 0.7)
    for t in (0, 2, 3):
        rows = np.flatnonzero(text == t)
        value = lambda p: sum(scores[i, s] for i, s in zip(rows, p)) - 0.7 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: B023,B905,E731
        assert abs(value(got[rows]) - max(map(value, product(range(3), repeat=len(rows))))) < 1e-5


def test_texts_in_pieces_and_together_agree(model, monkeypatch):
    texts = [sentence(ENGLISH, 300, 1) + " " + sentence(FRENCH, 200, 2), "", "x", sentence(RUSSIAN, 50, 3)]
    whole = language.predicted(texts, model)
    monkeypatch.setattr(language, "CHARS", 100)
    assert language.predicted(texts, model) == whole


def test_languages_of_awkward_rows(spark, model):
    out = language.with_language(documents(spark), model, with_spans=True)
    assert set(documents(spark).columns) | {"lang_pred", "spans"} == set(out.columns)
    got = out.select("doc_id", "lang_pred", "score").collect()
    assert len(got) == len(DOCUMENTS) and all(0 <= r.score <= 1 for r in got)
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (4, 5, 6, 9))
    empty = language.trained(no_documents(spark))
    assert {r[0] for r in language.with_language(documents(spark), empty).select("lang_pred").collect()} == {"und"}
    assert language.with_language(no_documents(spark), model).count() == 0


def test_rare_labels_and_repeated_texts_are_learned(spark):
    rows = [("en", sentence(ENGLISH, 20, i)) for i in range(400)] + [("ru", sentence(RUSSIAN, 20, 1))]
    rows += [("fr", sentence(FRENCH, 20, i)) for i in range(20)]
    once = language.trained(spark.createDataFrame(rows, "lang string, text string"), each=50)
    assert once.languages == ("en", "fr", "ru")
    again = language.trained(spark.createDataFrame(rows + [rows[0]] * 300 + [rows[-1]] * 500, "lang string, text string"), each=50)
    assert again.languages == once.languages and np.array_equal(again.scores, once.scores)


def test_language_stage_drops_texts_without_letters_only(spark):
    import corpus_pipeline
    for docs in (documents(spark), documents(spark).withColumn("lang", F.lit(None).cast("string"))):
        kept = corpus_pipeline.detect_language(spark, docs, "")
        assert kept.columns == docs.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d[0]) for d in DOCUMENTS if d[0] not in (4, 5, 6, 9))


def test_languages_held_out(spark):
    docs = table(spark, DATA.replace("sf0.001", "sf0.01"), "documents")
    out = language.with_language(docs, language.trained(docs.where(~held_out(3, 1)))).where(held_out(3, 1))
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98


def test_quality_held_out(spark):
    folder = DATA.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels").select("doc_id", "quality")
    fit = quality.fitted(docs, labels.where(~held_out(5, 0)))
    got = quality.scored(docs.join(labels, "doc_id").where(held_out(5, 0)), fit).select("quality", "score", "predicted").toPandas()
    good, bad = got.score[got.quality == 1], got.score[got.quality == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.95
    assert (got.predicted == (got.score >= 0.3)).all()


def test_quality_of_awkward_rows(spark):
    assert quality.fitted(no_documents(spark), no_documents(spark), label="n_chars") is None
    rows = [(prose(40, i), 1) for i in range(80)] + [("### " * 30 + str(i), 0) for i in range(80)] + [(None, 1), ("x", None)]
    known = spark.createDataFrame([(i, *r) for i, r in enumerate([*rows, ("y", 5)])] + [(None, "a", 1)], "doc_id int, text string, quality int")
    fit = quality.fitted(known, known.union(known))
    for model in (fit, None):
        out = quality.scored(documents(spark), model).select("doc_id", "score", "predicted").collect()
        assert len(out) == len(DOCUMENTS) and all(0 <= r.score <= 1 for r in out)
    assert quality.scored(no_documents(spark), fit).count() == 0
    good, bad = fit.scores(fit.features([prose(60, 999), "### " * 50]))
    assert good > 0.5 > bad


def test_license_phrases_and_templates(spark):
    bsd = dict(licences.TEMPLATES)["bsd"]
    texts = ["MIT License mit-license.", "the GNU General\nPublic License, Apache License", "cc by by", bsd.upper() + " " + prose(300, 1),
             " ".join(bsd.split()[:8]), prose(700, 2) + " " + bsd + " " + prose(700, 3), None, "", "mıt license ccby"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, score string")
    got = [tuple(r) for r in licences.license_scan(df).orderBy("doc_id").select(
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect()]
    assert got[0] == (4, 2, 0, 2, "mit", "mit", 1.0)
    assert got[1] == (7, 2, 1, 5, "apache,gpl", "apache,gpl", 1.0)
    assert got[2] == (3, 1, 0, 0, "cc-by", "cc-by", 1.0)
    assert got[3][1:] == (0, None, None, "", "bsd", 1.0) and got[5][5] == "bsd"
    assert got[4][1:] == (0, None, None, "", "", 0.0)
    assert got[6] == got[7] == (0, 0, None, None, "", "", 0.0)
    assert got[8] == (3, 0, None, None, "", "", 0.0)
    assert licences.license_scan(no_documents(spark)).count() == 0
    assert licences.license_scan(documents(spark)).count() == len(DOCUMENTS)


def test_filters_lose_no_match():
    r = random.Random(6)
    vocabulary = [f"w{i}".encode() for i in range(40)]
    templates = tuple((str(i), " ".join(w.decode() for w in r.sample(vocabulary, r.randint(3, 12)))) for i in range(25))
    scan = licences.Scan({}, templates, 0.7, 30, 10)
    index = licences.Index(scan, {w: r.randint(0, 50) for w in vocabulary})
    for _ in range(400):
        block = [r.choice(vocabulary) for _ in range(r.randint(1, 30))]
        want = {}
        for i, (_, text) in enumerate(templates):
            words = set(text.encode().split())
            if len(words & set(block)) >= 0.7 * len(words) - 1e-9:
                want[i] = len(words & set(block)) / len(words)
        assert index.matches(block) == want


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div id="main-menu"><a href=y>More</a></div>
<div class="cookie-notice"><p>We use cookies, really, and more, and more text here.</p></div><!-- note, <p>x</p> -->
<main><article><header><h1>A &lt;title&gt;</h1></header><div class="body"><p>First, with some text, that is long
enough<br>to count &amp; more.<p>Second wor<b>d</b> with a <a href="z>z">link</a>, and more, and more text to read.
<ul><li>one<li>two</ul><form><p>Your address, please, to sign up, now and here</p><input value=a></form></div>
<aside><p>By the way, this is at the side, and so on, and on.</p></aside></article>
<section id="comments"><div class="comment"><p>I like it, very much, and so on, and so on, and so on.</p></div></section></main>
<footer>&copy; foot</footer></body></html>"""


def test_main_text_of_a_page():
    assert html.main_text(PAGE) == ("A <title> First, with some text, that is long enough to count & more. "
                                    "Second word with a link, and more, and more text to read. one two")


def test_only_whole_attribute_names_count():
    shown = ['<a href="/wiki/hidden-figures">', '<p title="a hidden cost">', '<div data-hidden="false">', "<p data-id=share>",
             "<a href='?id=menu&class=nav'>", "<a href=/x?role=menu>", '<p alt = "style=display:none">', '<p aria-hidden="false">',
             '<p title="x"data-class="nav">', "<p x-hidden>"]
    for tag in shown:
        assert html.main_text(f"<div>{tag}Words of the text") == "Words of the text", tag
    gone = ["<p hidden>", "<p HIDDEN='until-found'>", '<p aria-hidden = "true">', "<p title='a'id=menu>", "<p x=1 class='a nav'>",
            "<div role=menu>", '<p style="display: none">', '<p title="x>y" / id="share">']
    for tag in gone:
        assert html.main_text(f"<div>{tag}Words of the text") == "", tag


def test_wrappers_with_names_of_other_parts():
    beside = '<div class="sidebar"><p>At the side, there is this, and more of it.</p></div><div id="comments"><p>I like it, really, so much, yes, yes.</p></div>'
    texts = [f"Paragraph {i} of the article, with commas, and with words enough to count." for i in range(4)]
    body = "".join(f"<p>{t}</p>" for t in texts)
    start = "<body><div class='site-footer'><p>All rights are reserved, by us, of course.</p></div>"
    opened = ['<div class="layout has-sidebar">', '<div class="overflow-hidden">', '<div class="page with-header">', '<form id="aspnetForm">',
              '<div class="page sidebar-left">', '<div id="header-and-text"><fieldset>', '<div class="md:hidden">', '<div class="hasSidebar">']
    for tag in opened:
        for inner in ("<div>", "<article>", "<main>", '<div class="text">'):
            page = f"{start}{tag}{inner}{body}</{inner[1:5].rstrip('>') if inner[1] != 'a' else 'article'}>{beside}<input value=a></body>"
            assert html.main_text(page) == " ".join(texts), (tag, inner)
    many = beside.replace("</p>", "</p>" + "<p>And one more comment, with words, and commas, to read.</p>" * 9)
    assert html.main_text(f"<div>{body}</div>{many}") == " ".join(texts)
    cards = '<div class="related">' + "<article><p>Another article, which is short, to read.</p></article>" * 5 + "</div>"
    assert html.main_text(f"<main>{body}</main>{cards}") == " ".join(texts)


@pytest.mark.parametrize("sections", [2, 3, 6])
def test_article_in_sections_of_sections(sections):
    texts = [f"Section {i}, with commas, and with some more words in it, so that it counts for something." for i in range(sections)]
    links = "<div>" + "<a href=x>Some link</a> " * 9 + "</div>"
    parts = "".join(f'<div class="row"><div class="column"><p>{t}</p></div></div>' for t in texts)
    for page in (f"<body>{links}<div>{parts}</div>{links}</body>", f"<body>{links}{parts}{links}</body>"):
        assert html.main_text(page) == " ".join(texts)


def test_pages_that_are_hardly_pages(spark):
    pages = ["", None, "plain &amp text", "<p>a<script>x", "<div>" * 3_000 + "deep", "<p>" + "long, " * 100_000, "<", "<p", "a < b",
             "<p>x</p></div></p><p>y"]
    df = spark.createDataFrame([(i, "u", p, "n") for i, p in enumerate(pages)], "page_id long, url string, html string, text string")
    got = [r.text for r in html.extracted(df).orderBy("page_id").collect()]
    assert got[:5] == ["", "", "plain & text", "a", "deep"] and got[5] == ("long, " * 100_000).strip()
    assert got[8:] == ["a < b", "x y"]
    assert html.extracted(df.limit(0)).count() == 0


def test_pages_of_the_table(spark):
    import re
    from html import unescape
    for r in html.extracted(table(spark, DATA, "pages")).collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        parts = [" ".join(unescape(re.sub("</?b>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert r.text == " ".join(p for p in parts if p) and r.n_chars == len(r.text)


@pytest.mark.parametrize("page", ["<b>" * 30_000 + "</i>" * 30_000, "<div>" * 30_000 + "</section>" * 30_000,
                                  "<span>" * 30_000 + "<p>" * 30_000, "<header>" * 30_000, "<ul><li>" * 30_000])
def test_malformed_pages_are_parsed_in_one_pass(page):
    start = time.perf_counter()
    assert html.main_text(page + "the text, at last") in ("the text, at last", "")
    assert time.perf_counter() - start < 10


def test_labels_of_documents_that_are_not_there_change_nothing(spark):
    docs = spark.createDataFrame([(i, prose(80, i) if i % 2 else "zz qq " * 60 + str(i)) for i in range(200)], "doc_id long, text string")
    own = docs.selectExpr("doc_id", "doc_id % 2 as quality")
    foreign = spark.range(10_000, 40_000).selectExpr("id as doc_id", "id % 2 as quality")
    few = quality.Fit(texts=40)
    model, same = quality.fitted(docs, own, few), quality.fitted(docs, own.union(foreign), few)
    assert model is not None and model == same
    with pytest.warns(UserWarning):
        assert quality.fitted(docs, foreign, few) is None
