import html
import os
import random
import re
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixtures import frame  # noqa: E402

from farelens.llm import html_crf  # noqa: E402
from farelens.llm.common import table  # noqa: E402

PAGES = "page_id long, url string, html string, text string"


def article(page):
    """The sample pages' main text, cut out by their own markup."""
    m = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    inner = re.sub(r"<br>|</?b>", " ", re.sub(r"</?(p|h1)>", "\n", m[1])) if m else ""
    return "\n".join(x for x in (" ".join(html.unescape(line).split()) for line in inner.split("\n")) if x)


def test_sample_pages(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    want = {r.page_id: (r.url, article(r.html)) for r in pages.collect()}
    got = html_crf.extract_main_text(pages).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (*want[r.page_id], len(want[r.page_id][1]))


def test_composed_pages_not_seen_in_training():
    field = html_crf.trained()
    right = total = 0
    for page, labels in html_crf.labelled_pages(150, seed=4242):
        found = field.decode(html_crf.page_features(html_crf.leaf_blocks(page)))
        right += sum(a == b for a, b in zip(found, labels, strict=True))
        total += len(labels)
    assert right / total > 0.98


LAYOUT = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
<header class="site-header"><div class=logo>Site</div></header>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div>
<main><article><h1>Big &amp; news</h1><p>First   <em>line</em>&nbsp;of
text.</p><!-- <p>hidden</p> --><p>Short</p><aside class="related"><p>Read also this</p></aside>
<form class="newsletter"><label>Mail</label><input></form><p>Last &lt;one&gt; 5 < 6.</p></article></main>
<section class="comments"><div class="comment"><p>Nice article, thanks for it.</p></div></section>
<aside class="sidebar"><ul><li><a href=/x>Link</a></li></ul></aside>
<div class="ad">Buy this now.</div><footer><p>&copy; 2024 Site</p></footer></body></html>"""


def test_layouts():
    field = html_crf.trained()
    assert html_crf.main_text(field, LAYOUT) == "Big & news\nFirst line of text.\nShort\nLast <one> 5 < 6."
    cut = LAYOUT[: LAYOUT.index("Short</p>") + 5]
    assert html_crf.main_text(field, cut) == "Big & news\nFirst line of text.\nShort"


def test_odd_markup():
    def texts(page):
        return [b[0] for b in html_crf.leaf_blocks(page)]

    assert texts("") == texts("   ") == texts("<p></p>") == texts("<!-- x") == texts("<script>a") == []
    assert texts("a<p>b<p>c<br>d</div>e") == ["a", "b", "c de"]
    assert texts("<p title='a>b'>x</p><p class=\"y") == ["x"]
    assert texts("1 < 2 & 3 &amp &#65; &am") == ["1 < 2 & 3 & A &am"]
    assert texts("<TABLE><TR><TD>a<TD>b<TR><TD>c</TABLE>d") == ["a", "b", "c", "d"]
    assert len(texts("<div>" * 3000 + "deep")) == 1


def test_table_cases(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, None, "<article><p>x</p></article>"), (4, "v", "<article><p>" + "word " * 200_000)]
    got = html_crf.extract_main_text(frame(spark, rows, PAGES)).collect()
    assert sorted((r.page_id or 0, r.url, r.n_chars) for r in got if r.page_id != 1) == [
        (0, None, 1), (2, "u", 0), (2, "u", 0), (4, "v", 999_999)]
    assert [r.text for r in got if r.page_id == 1] == [""]
    assert html_crf.extract_main_text(frame(spark, [], PAGES)).collect() == []


def test_viterbi_finds_the_best_sequence():
    import itertools

    import numpy as np

    rng = np.random.RandomState(3)
    field = html_crf.Field()
    field.index = {str(i): i for i in range(7)}
    field.w, field.pair, field.first = rng.normal(0, 1, (7, 2)), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)
    rows = [(str(i), str((i * 3) % 7)) for i in range(7)]
    e = field.emissions(rows)

    def score(y):
        return field.first[y[0]] + sum(e[i][y[i]] for i in range(7)) + sum(field.pair[y[i], y[i + 1]] for i in range(6))

    best = max(itertools.product((0, 1), repeat=7), key=score)
    assert field.decode(rows) == list(best)
    assert field.decode([]) == []


@pytest.mark.parametrize("n", [1])
def test_training_is_repeatable(n):
    a, b = (html_crf.Field().fit([(html_crf.page_features(html_crf.leaf_blocks(p)), y) for p, y in html_crf.labelled_pages(20, 5)], n) for _ in range(2))
    assert (a.w == b.w).all() and (a.pair == b.pair).all()


def test_silent_elements_without_end_tags():
    def texts(page):
        return [b[0] for b in html_crf.leaf_blocks(page)]

    field = html_crf.trained()
    whole = LAYOUT.replace("</head>", "")
    assert html_crf.main_text(field, whole) == html_crf.main_text(field, LAYOUT) != ""
    assert texts("<html><head><title>T</title><meta charset=x><article><p>text") == ["text"]
    assert texts("<head><title>T</title>text<p>more") == ["text", "more"]
    assert texts("<head><title>The <body> tag</title><noscript><p>no</p></noscript><body>yes") == ["yes"]
    for tag in ("button", "select", "object", "noscript", "textarea", "canvas", "iframe", "datalist"):
        assert texts(f"<div><p>a</p><{tag}>no<p>b</p><p>c</p></div>d") == ["a", "b", "c", "d"]
        assert texts(f"<div><p>a</p><{tag}>no<p>no</p>no</{tag}><p>c</p></div>d") == ["a", "c", "d"]
        assert texts(f"<div><{tag}>no<p>b</p><{tag}>no</{tag}>c</div>") == ["b", "c"]
    assert texts("<object><object>no</object><p>no</p></object><p>b") == ["b"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["so x=2 holds"]


WORDS = "the of and house river green people made under light water story over small great".split()


def unseen_page(kind, rng):
    """Layouts and names that no training page has; the label of each block."""
    labels = []

    def t(label, low, high, end=""):
        labels.append(label)
        return " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high))) + end

    def paragraphs():
        return "".join(f"<p>{t(1, 15, 70, '.')}</p>" for _ in range(rng.randint(3, 9)))

    def menu():
        return "<ul>" + "".join(f"<li><a href='/{i}'>{t(0, 1, 3)}</a></li>" for i in range(rng.randint(3, 8))) + "</ul>"

    def foot():
        return f"<div>&copy; {t(0, 2, 5)}</div>"

    if kind == "bare body":
        body = menu() + f"<h1>{t(1, 3, 8)}</h1>" + paragraphs() + foot()
    elif kind == "only paragraphs":
        body = paragraphs()
    elif kind == "unknown classes":
        body = f"<div class='mw-head'>{menu()}</div><div class='mw-parser-output'>{paragraphs()}<h2>{t(1, 1, 4)}</h2>{paragraphs()}</div>" + foot()
    elif kind == "builder":
        body = f"<div class='tdb-top'>{menu()}</div><div class='tdi_51'><div class='tdb-block-inner td-fix-index'>{paragraphs()}</div></div>" + foot()
    elif kind == "layout table":
        body = f"<table width=100%><tr><td class='left'>{menu()}</td><td class='text'>{paragraphs()}</td></tr></table>" + foot()
    else:
        body = f"<div id=a>{menu()}</div>" + "<div class=xq>" * 6 + f"<h1>{t(1, 3, 8)}</h1>" + paragraphs() + "</div>" * 6 + f"<div class=zz>{menu()}</div>" + foot()
    return f"<html><head><title>x</title></head><body>{body}</body></html>", labels


@pytest.mark.parametrize("kind", ["bare body", "only paragraphs", "unknown classes", "builder", "layout table", "nested wrappers"])
def test_layouts_that_training_never_saw(kind):
    field, rng = html_crf.trained(), random.Random(kind)
    right = total = 0
    for _ in range(60):
        page, labels = unseen_page(kind, rng)
        blocks = html_crf.leaf_blocks(page)
        assert len(blocks) == len(labels)
        right += sum(a == b for a, b in zip(field.decode(html_crf.page_features(blocks)), labels, strict=True))
        total += len(labels)
    assert right / total >= 0.95


def test_deep_pages_take_linear_time():
    def seconds(n):
        start = time.perf_counter()
        assert len(html_crf.page_features(html_crf.leaf_blocks("<div class='a b'>x" * n))) == n
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(20_000) < 40 * max(seconds(2_000), 0.01)
