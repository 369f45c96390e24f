"""HTML extraction: the best run against all runs, the marked text of given pages, and odd pages."""

from __future__ import annotations

import html
import re

import pytest

from ampertide.llm import html_text as ht

FOLDER = "/root/testdata/sf0.01"
NONE = ({}, {})


def marked_text(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b))).strip() for b in re.split(r"</?(?:p|h1|br)>", body))
    return " ".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    result = {r.page_id: r for r in ht.main_text(pages, ht.learn(ht.labelled_sample(pages))).collect()}
    given = pages.collect()
    assert len(result) == len(given)
    for p in given:
        assert result[p.page_id].text == marked_text(p.html) and result[p.page_id].n_chars == len(result[p.page_id].text)


def test_same_text_without_the_marking_element(spark):
    """The weights find the run where nothing marks it."""
    pages = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").orderBy("page_id").limit(60).collect()]
    weights = ht.learn(pages[:30])
    for page in pages[30:]:
        plain = page.replace("<article>", "<div>").replace("</article>", "</div>")
        assert ht.extract(plain, weights) == marked_text(page)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p> \n </p>", ""),
        ("plain &lt;b&gt; words", "plain <b> words"),
        ("<p>un<b>closed <i>words", "unclosed words"),
        ("<div><p>one  two\nthree or more words</p><div class='ad-box'>buy now</div><p>four &eacute;&#233; five six seven eight</p></div>", "one two three or more words four éé five six seven eight"),
        ("<nav>a b c</nav><p>the text of it</p><div id=comments><p>nice nice nice</p></div><footer>f</footer>", "the text of it"),
        ("<article><header><h1>Head</h1></header><p>Body of it<aside>side</aside><form>name</form><p>more</article>", "Head Body of it more"),
        ("<script>var a='<p>no no no no no</p>';</script><style>p{}</style><p>yes it is", "yes it is"),
        ("<p hidden>not seen</p><p>seen by all</p><!-- <p>gone gone gone gone</p> -->", "seen by all"),
        ("<p>" + "word " * 50_000 + "</p>", ("word " * 50_000).strip()),
        ("<" * 2000 + "a b c", None),
    ],
)
def test_pages(page, text):
    found = ht.extract(page, NONE)
    assert text is None or found == text


def test_scan_finds_the_best_run():
    """Against all runs, on scores made of words of noise and text."""
    page = "<p>a b c d</p><ul><li><a>x</a><li><a>y y y y y y</a></ul><p>e f g h i j k</p><table><tr><td><td><td></table><p>l</p>"
    sequence = ht.tokens(page)
    counts = ht._blocks(sequence)
    scores = []
    for x in sequence:
        if isinstance(x, ht.Piece):
            scores.append(ht._word_weight(ht.feature(x, counts), {}) * len(x.text.split()))
        else:
            scores.append(ht.PRIOR_TAG * (0.1 if x.lstrip("/") in ht.INLINE else 1.0))
    spans = [(sum(scores[i:j]), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    _, i, j = max(spans, key=lambda s: (s[0], -s[1], -(s[2] - s[1])))
    assert ht.extract(page, NONE) == " ".join(x.text.strip() for x in sequence[i:j] if isinstance(x, ht.Piece))


@pytest.mark.parametrize("opened, closed", [("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")])
def test_text_goes_on_outside_the_marked_element(opened, closed):
    """The run grows to the ends of a marked element and keeps what it holds outside; without one the scan decides."""
    inside, outside = " ".join(["inside"] * 60), " ".join(["outside"] * 40)
    page = f"<nav>a b c</nav>{opened}<p>{inside}</p>{closed}<p>{outside}</p><footer>f</footer>"
    assert ht.extract(page, NONE) == f"{inside} {outside}"
    page = f"<nav>a b c</nav><p>{outside}</p>{opened}<p>{inside}</p>{closed}<ul><li><a>x y z</a></ul><footer>f</footer>"
    assert ht.extract(page, NONE) == f"{outside} {inside}"


TEXT = " ".join(["word"] * 30)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class='layout has-sidebar'><article><p>{TEXT}</article><div class=sidebar>s s s</div></div>", TEXT),
        (f"<nav>a b</nav><div class='layout has-sidebar'><p>{TEXT}</p><div class=sidebar>s s s</div></div>", TEXT),
        (f"<form action=x><div id=share-page><main><p>{TEXT}</main></div><div class=related>r r r</div></form>", TEXT),
        (f"<form><p>{TEXT}</p><div class=comments><p>{TEXT} {TEXT}</p></div></form>", TEXT),
        (f"<p>{TEXT}</p><div class=comments><p>{TEXT} {TEXT}</p></div>", TEXT),
        (f"<article><p>{TEXT}</article><div class=comments><article><p>{TEXT} {TEXT}</article></div>", TEXT),
        (f"<div hidden class=widget><p>{TEXT}</p></div>", ""),
        (f"<html><head><title>t</title><meta charset=x><body><p>{TEXT}", TEXT),
        (f"<html><head><title>t</title><link rel=x><div><p>{TEXT}</div>", TEXT),
    ],
)
def test_noise_around_the_whole_page(page, text):
    assert ht.extract(page, NONE) == text


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "x", "y"), (None, "u", "<p>a b c d", "x", "y"), (None, "u", "<p>a b c d", "x", "y")]
    pages = spark.createDataFrame(rows, schema)
    weights = ht.learn(ht.labelled_sample(pages))
    result = [(r.page_id, r.text, r.n_chars) for r in ht.main_text(pages, weights).collect()]
    assert sorted(result, key=str) == [(1, "", 0), (None, "a b c d", 7), (None, "a b c d", 7)]
    assert ht.main_text(pages.limit(0), weights).collect() == []


def test_blanks_between_inline_elements():
    inline = sorted(ht.INLINE - ht.VOID)
    for a in inline:
        for b in ("b", "a", "span"):
            page = f"<article><p>one <{a}>Hello</{a}> <{b}>world</{b}> two <{a}>x</{a}><{b}>y</{b}>\n</p><p> <i>next</i> </p></article>"
            assert ht.extract(page, ht.learn([])) == "one Hello world two xy next"
    page = "<article><p><a>the first</a> <a>second</a> and some more words</p></article>"
    assert ht.extract(page, ht.learn([])) == "the first second and some more words"
    page = '<article><p><b>left</b><span class="ad">gone</span> <i>right</i> with some more words</p></article>'
    assert ht.extract(page, ht.learn([])) == "left right with some more words"


def test_script_heavy_page_in_linear_time():
    import time

    page = "<article><script>" + "<a " * 200_000 + "</script><p>the text of this page</p><style>" + "</a" * 50_000 + "</style></article>"
    start = time.process_time()
    assert ht.extract(page, ht.learn([])) == "the text of this page"
    assert time.process_time() - start < 5
    assert ht.extract("<p>some words before an open script</p><script>" + "<b>" * 50_000, ht.learn([])) == "some words before an open script"
