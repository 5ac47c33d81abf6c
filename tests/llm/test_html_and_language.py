from __future__ import annotations

import html as entities
import math
import re

import pytest

from tidemark.llm import html, language
from tidemark.llm.html import extract, main_text

FOLDER = "/root/testdata/sf0.001"
LONG = "This is the running text of the article and it is long enough to stand out from all the rest of the page. "


def test_pages_of_the_test_table(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in extract(pages).collect():
        article = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:h1|p)[^>]*>", article)]
        assert r.text == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("outside", [
    "<nav><ul><li><a href=x>Home page and more</a></li></ul></nav>", "<header>Site header words</header>", "<footer>Footer words &copy;</footer>",
    "<aside>Sidebar with several words</aside>", '<div class="cookie-notice">We use cookies for everything we do here</div>',
    '<div id="adBanner">Buy this very good thing now</div>', "<form><label>Your name</label><input></form>", "<script>var a = '<p>no</p>';</script>",
    "<style>p{}</style>", "<!-- a comment -->", '<section class="comments"><p>Reader says that this is great</p></section>', '<div role="navigation">Go there</div>',
    "<noscript>Switch scripts on</noscript>", '<ul class="menu"><li>One</li></ul>', '<div hidden>not shown at all</div>',
])
@pytest.mark.parametrize("shape", ["<article><h1>Title</h1><p>{0}</p>{1}<p>{0}</p></article>", "<div class='content'><h1>Title</h1><p>{0}</p><p>{0}</p></div>{1}", "{1}<main><h1>Title</h1><p>{0}<p>{0}</main>"])
def test_parts_outside_the_article_are_left_out(outside, shape):
    page = f"<html><head><title>T</title></head><body>{shape.format(LONG, outside)}</body></html>"
    assert main_text(page) == "\n".join(["Title", LONG.strip(), LONG.strip()])


def test_blocks_references_and_white_space():
    page = "<body><article><p>a &amp; b\n\t c &#233;&nbsp;d<br>e</p><ul><li>one</li><li>two</li></ul><blockquote>quoted</blockquote></article>"
    assert main_text(page) == "a & b c é d e\none\ntwo\nquoted"


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<nav>only a menu</nav>") == main_text("<p></p>") == ""
    assert main_text("plain text without any markup") == "plain text without any markup"
    assert main_text("<nav>menu<article><p>short</p></article>") == "short"  # a menu left open
    assert main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    long = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    assert len(main_text(long)) == 5000 * len(LONG) - 1 + 0 * 5000
    assert main_text('<article><p>text</p><article class="comment"><p>me too</p></article></article>') == "text"


def test_rows_are_independent(spark):
    rows = [(1, "u", "<article><p>x</p></article>", "t"), (1, "u", "<article><p>x</p></article>", "t"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in extract(pages).collect()) == [(0, ""), (1, "x"), (1, "x")]
    assert extract(pages.limit(0)).collect() == []


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


TEXTS = {"en": "the cat and the dog were in the house with that thing", "de": "der hund und die katze sind nicht in dem haus", "fr": "le chat et les chiens sont dans une maison avec elle"}


def test_learns_predicts_and_rejects(spark):
    docs = labelled(spark, [(i, f"{text} {i}", lang, "x") for i, (lang, text) in enumerate(list(TEXTS.items()) * 8)])
    model = language.learn(docs)
    new = labelled(spark, [(1, "THE HOUSE and the cat!", None, "x"), (2, "die katze und der hund", "en", "x"), (3, None, None, "x"), (4, "123 ... !", None, "x"), (5, "", None, "x"), (6, "ЭТО НЕ ТО", None, "x"), (1, "les chats", None, "x")])
    found = language.predict(new, model, "doc_id")
    assert sorted((r.doc_id, r.lang_pred) for r in found.collect()) == [(1, "en"), (1, "fr"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, found.where("doc_id = 6").first().lang_pred)]
    assert {r.doc_id for r in found.where("rejected").collect()} == {3, 4, 5, 6}
    assert all(0 <= r.score <= 1 for r in found.collect())
    kept = language.keep_known_languages(docs.union(new))
    assert kept.columns == docs.columns and kept.count() == docs.count() + 3


def test_nothing_to_learn_from(spark):
    docs = labelled(spark, [(1, "some words", None, "x"), (2, "?!", "en", "x"), (3, None, "de", "x")])
    assert language.learn(docs.limit(0)) is None
    kept = language.keep_known_languages(docs)
    assert [r.doc_id for r in kept.collect()] == [1]
    assert language.predict(docs.limit(0), None, "doc_id").collect() == []


def test_stage_sends_small_batches_and_gets_no_text_back(spark, monkeypatch):
    size, store, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", language.materialize, []
    monkeypatch.setattr(language, "materialize", lambda df: rows.append(int(spark.conf.get(size))) or store(df))
    before = spark.conf.get(size)
    known = [(i, f"{text} {i}", lang, "x") for i, (lang, text) in enumerate(list(TEXTS.items()) * 8)]
    # equal ids, equal texts, no id, no text
    odd = [(1, "ЭТО НЕ ТО", None, "x"), (1, "les chats", None, "y"), (None, "ЭТО НЕ ТО", None, "x"), (None, "les chats", None, "x"), (None, "les chats", None, "x"), (2, "12", "en", "x"), (None, None, "en", "x"), (2, None, None, "x"), (3, "", None, "x")]
    docs = labelled(spark, known + odd)
    kept = language.keep_known_languages(docs)
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r.text and ("les chats" in r.text or r.lang and r.text != "12"))
    assert rows and max(rows) <= 500 and spark.conf.get(size) == before
    assert "MapInArrow" not in kept._jdf.queryExecution().toString()  # else whole texts come back from workers


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn(docs.where("doc_id % 2 = 0"), sample=50)
    judged = language.predict(docs.where("doc_id % 2 = 1"), model, "doc_id", "lang")
    assert judged.where("lang = lang_pred").count() >= 0.97 * judged.count()
    assert judged.where("rejected").count() == 0


@pytest.mark.parametrize("lang", ["de", "fr", "es"])
def test_rejects_a_language_held_out_of_learning(spark, lang):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    judged = language.predict(docs, language.learn(docs.where(f"lang <> '{lang}'")), "doc_id", "lang").cache()
    new, old = judged.where(f"lang = '{lang}'"), judged.where(f"lang <> '{lang}'")
    assert new.where("rejected").count() >= 0.8 * new.count()
    assert old.where("rejected").count() <= 0.01 * old.count()


def test_counts_do_not_depend_on_case_or_signs():
    assert (language.gram_counts("Ab, cd!") == language.gram_counts("ab cd")).all()
    assert language.gram_counts("12 ,.") is None


def test_headings_and_paragraphs_named_after_their_subject_stay():
    page = (
        f"<body><article><header class='top'><h1>Headline</h1><div>By someone</div></header><p>{LONG}</p><h2 id='related-work'>Related work</h2>"
        f"<p class='comment'>{LONG}</p><h2 id='social-history'>Social history</h2><p>{LONG}</p>"
        "<div id='related-posts'><h3>Other posts</h3></div><header class='banner'><h3>Buy this</h3></header></article></body>"
    )
    assert main_text(page) == "\n".join(["Headline", LONG.strip(), "Related work", LONG.strip(), "Social history", LONG.strip()])


LINES = [f"Sentence number {i} of a story that is told at some length, with commas, pauses and all the rest." for i in range(8)]


def unmarked(*parts: str) -> str:
    return "<html><head><title>T</title></head><body>" + "".join(parts) + "</body></html>"


#: Pages without an article mark, and their texts, written by hand.
UNMARKED = [
    (  # menus and imprints that nothing names
        unmarked("<div><a href='/'>Home</a> <a href='/n'>News</a></div>", f"<div><h1>Headline</h1><p>{LINES[0]}</p><p>Short one.</p><p>{LINES[1]}</p></div>",
                 "<div><a href='/i'>Imprint</a><a href='/t'>Terms</a></div><div><p><a>x</a></p><p>Copyright 2024</p><p>Tel. 030 1</p></div>"),
        ["Headline", LINES[0], "Short one.", LINES[1]],
    ),
    (  # links inside the container
        unmarked(f"<div><p><a href='/'>Home</a></p><p><a href='/x'>Up</a></p><h2>Story</h2><p>{LINES[0]}</p><p>{LINES[1]} <a href='#'>more</a></p>",
                 "<ul><li><a href='1'>One</a></li><li><a href='2'>Two</a></li><li><a href='3'>Three</a></li><li><a href='4'>Four</a></li></ul><p>4 views</p><p>Seen today</p></div>"),
        ["Story", LINES[0], f"{LINES[1]} more"],
    ),
    (  # a list of links between paragraphs, and short text behind the last of them
        unmarked(f"<div><p>{LINES[0]}</p><p>{LINES[1]}</p><p><a>a</a></p><p><a>b</a></p><p><a>c</a></p><p><a>d</a></p><p><a>e</a></p><p><a>f</a></p><p><a>g</a></p>",
                 f"<p>{LINES[2]}</p><p>{LINES[3]}</p><p><a>x</a></p><p><a>y</a></p><p><a>z</a></p><p>c 1</p><p>c 2</p><p>c 3</p></div>"),
        [LINES[0], LINES[1], LINES[2], LINES[3]],
    ),
    (  # a page inside one form, and a form inside a page
        unmarked("<form action='/all'><input type='hidden' name='state' value='x'>", f"<div><h1>Headline</h1><p>{LINES[0]}</p><p>{LINES[1]}</p>" + "".join(f"<p>{x}</p>" for x in LINES[3:]),
                 f"<fieldset><label>Your address</label><input name='m'><p>We never pass it on.</p><button>Send</button></fieldset><p>{LINES[2]}</p></div></form>"),
        ["Headline", LINES[0], LINES[1], *LINES[3:], LINES[2]],
    ),
    (  # names of headings, paragraphs and containers that only sound like parts of a site
        unmarked(f"<div class='alert-story'><h2 id='related-work'>Related work</h2><p>{LINES[0]}</p><p class='comment'>{LINES[1]}</p></div>",
                 f"<div class='comment-list'><p>{LINES[2]}</p></div><div id='relatedPosts'><p>{LINES[3]}</p></div>"),
        ["Related work", LINES[0], LINES[1]],
    ),
]


@pytest.mark.parametrize("number", range(len(UNMARKED)))
def test_pages_without_marks(number):
    page, lines = UNMARKED[number]
    assert main_text(page) == "\n".join(lines)


def test_the_threshold_decides(monkeypatch):
    """Without it, other lines come out, on pages with and without marks."""
    pages = [page for page, _ in UNMARKED]
    marked = f"<article><h1>H</h1><p>{LINES[0]}</p><p>{LINES[1]}</p><ul>" + "".join(f"<li><a>{c}</a></li>" for c in "abcdefg") + f"</ul><p>{LINES[2]}</p></article>"
    assert main_text(marked) == "\n".join(["H", *LINES[:3]])
    before = [main_text(page) for page in [*pages, marked]]
    monkeypatch.setattr(html, "LINKED", -1.0)
    changed = [main_text(page, share=-1e9) != text for page, text in zip([*pages, marked], before)]
    assert sum(changed) >= 4 and changed[-1]


def stream_by_hand(text):
    return " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "


def vector_by_hand(text, weights):
    """Damped, weighted, scaled counts of letter n-grams by bucket, as a dictionary."""
    stream = [ord(c) for c in stream_by_hand(text)]
    counts = {}
    for order in range(3):
        for at in range(len(stream) - order):
            code = stream[at]
            for point in stream[at + 1:at + order + 1]:
                code = (code * 40503 + point) % 2**32
            bucket = ((code * 2654435761 + order * 97) % 2**32 * 2654435761 % 2**32) >> 20
            counts[bucket] = counts.get(bucket, 0) + 1
    vector = {b: math.log(1 + n) * float(weights[b]) for b, n in counts.items()}
    norm = math.sqrt(sum(x * x for x in vector.values()))
    return {b: x / norm for b, x in vector.items()} if norm else {}


def test_prediction_is_that_of_the_nearest_centroid(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn(docs.where("doc_id % 3 > 0"), sample=100)
    assert len(model.languages) == len(model.centroids) == 4 * 4
    assert all(abs(sum(x * x for x in row) - 1) < 1e-4 for row in model.centroids.tolist())
    odd = ["Das ist the house", "a", "ß", "É à", "x" * 500, "12 34", "", None, "the\u2028cat's 3rd", "ÇÇÇ ññ"]
    rows = [(r.doc_id, r.text) for r in docs.where("doc_id % 30 = 0").collect()] + [(10**6 + i, t) for i, t in enumerate(odd)]
    found = {r.doc_id: r for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string"), model, "doc_id").collect()}
    centroids = model.centroids.tolist()
    for i, text in rows:
        if not any(c.isalpha() for c in text or ""):
            assert (found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True)
            continue
        vector = vector_by_hand(text, model.weights)
        cosines = [sum(x * row[b] for b, x in vector.items()) for row in centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert cosines[best] - max(c for c, name in zip(cosines, model.languages) if name == found[i].lang_pred) < 1e-5
        assert abs(found[i].score - min(1, max(0, cosines[best]))) < 1e-4
        kind = max(k for k, n in enumerate(language.CLASSES) if n <= max(3, len(stream_by_hand(text))))
        if abs(1 - cosines[best] - model.reach[best, kind]) > 1e-4:
            assert found[i].rejected == (1 - cosines[best] > model.reach[best, kind])
