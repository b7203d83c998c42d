"""Main-text extraction: known pages, held-out layouts, consistency of the choice."""

import html
import re

import numpy as np
import pytest

from gridmart.llm import html_extract as H

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def model(pages):
    return H.train([p for p in pages[:120] if len(p) <= H.MAX_PAGE_CHARS])


def told(page):
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())


def test_held_out_pages(model, pages):
    got = H.extract_pages(pages[120:], model)
    assert [g == told(p) for g, p in zip(got, pages[120:])].count(False) == 0


def test_held_out_layouts(model, pages):
    right = total = 0
    for i in range(120, 170):
        for seen, truth in H.variants(pages[i], pages[i - 1], 10_000 + i):
            nodes = H.elements(H.parse(truth))
            want = H.text_of(nodes, H.truth_of(nodes)) if H.truth_of(nodes) is not None else ""
            total += 1
            right += H.extract_pages([seen], model)[0] == want
    assert right / total > 0.97


PARA = "Some long sentence of the story, with many words in it, that goes on for a while. " * 3
BODY = f"<h1>Head &amp; line</h1><p>{PARA}<b>bo</b>ld&nbsp;word<br>next<p>second &lt;tag&gt; \n\t {PARA}</p>"
WANT = " ".join(f"Head & line {PARA}bold word next second <tag> {PARA}".split())


@pytest.mark.parametrize("page", [
    f"<html><body><nav><a href=/>x</a></nav><article>{BODY}</article><footer>f</footer>",
    f"<body><script>var a = '<p>no</p>';</script><style>p{{}}</style><article>{BODY}<!-- <p>no</p> --></article>",
    f"<body><aside class=sidebar><p>side text</p></aside><article>{BODY}<section id=comments><p>reader words here</p></section></article>",
    f"<body><div class='cookie-notice'><p>We use cookies</p></div><article>{BODY}</article><form><p>sign</p></form>",
    f"<BODY><ARTICLE>{BODY}</ARTICLE>",
])
def test_hand_made_pages(model, page):
    assert H.extract_pages([page], model) == [WANT]


AFTER = f"<p>{PARA}</p>"


@pytest.mark.parametrize("inside, text", [
    ('<svg width="9" height="9"/>', ""), ("<p><svg/></p>", ""), ("<math/>", ""),
    ("<svg><title>no</title><path d='M0'/></svg>", ""), ('<svg><path d="M0">', ""),
    (f"<svg><path><p>{PARA}</p><svg><foreignObject><p>no</p></foreignObject></svg>", PARA),
    ("<p data-x=it's>" + PARA + "it's</p>", PARA + "it's "), (f'<p title="a>b" ">{PARA}</p>', PARA),
    (f"<p it's class = 'x>y' a=b\"c>{PARA}</p>", PARA), (f'<p a=b="c>{PARA}</p>', PARA), ("<br/\"><hr '>", ""),
    (f"<p>{PARA} if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then {PARA}</p>", f"{PARA} if x=2 then {PARA}"),
    (f"<p>{PARA} if <math><mi>x</mi> then {PARA}</p>", f"{PARA} if x then {PARA}"),
    (f"<xmp>{PARA} <b>5 &amp; 6</b></xmp>", f"{PARA} <b>5 &amp; 6</b> "),
])
def test_text_around_drawings_formulas_and_stray_quotes(model, inside, text):
    page = f"<html><body><nav><a href=/>x</a></nav><article>{BODY}{inside}{AFTER}</article><footer>f</footer>"
    assert H.extract_pages([page], model) == [" ".join(f"{WANT} {text} {PARA}".split())]


WRAPS = [('<a href="/x">', "</a>"), ('<span class="more">', "</span>"), ("<em>", "</em>"), ("<strong>", "</strong>"), ("<code>", "</code>")]


@pytest.mark.parametrize("opening, closing", WRAPS)
def test_inline_elements_follow_their_block(model, pages, opening, closing):
    """Three words of a paragraph wrapped: the text of held-out pages stays as it was."""
    lost = total = 0
    for page in pages[120:]:
        found = re.search(r"<article>.*?<p>[^<]*? ([^<> &]+ [^<> &]+ [^<> &]+) [^<]*", page, re.S)
        if found:
            a, b = found.span(1)
            total += 1
            lost += H.extract_pages([page[:a] + opening + page[a:b] + closing + page[b:]], model) != [told(page)]
    assert total > 20 and lost == 0


@pytest.mark.parametrize("inside, text", [
    (f'<p><a href="/x">{PARA}</a></p>', PARA), (f'<p class="message-body">{PARA}</p>', PARA),
    (f"<figure><img src=x><figcaption>A caption of the figure</figcaption></figure><p>{PARA}</p>", f"A caption of the figure {PARA}"),
    (f'<p>{PARA} <span class="ad"><a href="/x">word</a></span> {PARA}</p>', f"{PARA} word {PARA}"),
    (f'<p>see <a href="/1">one</a>, <a href="/2">two</a> and <a href="/3">three</a>. {PARA}</p>', f"see one, two and three. {PARA}"),
])
def test_links_names_and_captions_inside_the_article(model, inside, text):
    page = f"<html><body><nav><a href=/>x</a></nav><article>{BODY}{inside}{AFTER}</article><footer>f</footer>"
    assert H.extract_pages([page], model) == [" ".join(f"{WANT} {text} {PARA}".split())]


def test_the_title_in_a_header_of_the_article(model):
    page = (f'<body><header><h1><a href="/">Site</a></h1><ul><li><a href="/a">a</a></li></ul></header>'
            f"<article><header><h1>Head line</h1></header><p>{PARA}</p><p>{PARA}</p></article><footer>f</footer>")
    assert H.extract_pages([page], model) == [" ".join(f"Head line {PARA} {PARA}".split())]


def test_dropping_an_ancestor_drops_its_descendants():
    r = np.random.default_rng(4)
    page = "<div>a<div>b<p>c<b>d</b></p></div><ul><li>e<li>f</ul></div>" * 20
    nodes = H.elements(H.parse(page))
    for _ in range(30):
        z = r.normal(0, 3, len(nodes))
        kept = H.decode(nodes, z)
        assert kept[0] and all(kept[v.parent.at] for v in nodes[1:] if kept[v.at])


def test_decoding_is_the_best_consistent_choice():
    nodes = H.elements(H.parse("<div>a<div>b<p>c</p></div><p>d</p>e</div>"))
    r = np.random.default_rng(5)
    own = np.array([any(isinstance(c, str) for c in v.children) for v in nodes])
    for _ in range(50):
        z = r.normal(0, 3, len(nodes))
        gain = np.where(own, z, 0.25 * z)
        best = max(
            sum(gain[i] for i in range(1, len(nodes)) if m >> i & 1)
            for m in range(1, 1 << len(nodes), 2)
            if all(not m >> v.at & 1 or m >> v.parent.at & 1 for v in nodes[1:]))
        assert abs(sum(gain[i] for i in np.flatnonzero(H.decode(nodes, z)) if i) - best) < 1e-9


def test_edge_rows_through_spark(spark, model):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>"), (3, "u", "plain text &amp; more"), (4, "u", "<" * 5000),
            (5, "u", "<div>" * 3000 + "deep"), (6, "u", f"<article>{BODY}</article>"), (6, "u", f"<article>{BODY}</article>")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, text int")
    got = H.extract(df, model).collect()
    assert [r.page_id for r in got] == [r[0] for r in rows] and [r.url for r in got] == [r[1] for r in rows]
    assert [got[i].text for i in (0, 1, 2)] == ["", "", ""] and got[6].text == got[7].text == WANT
    assert all(r.n_chars == len(r.text) for r in got)
    assert H.extract(df.limit(0), H.fit(df.limit(0))).collect() == []


def test_a_repeated_key_gives_the_fit_one_page(spark, monkeypatch):
    rows = [(1, f"<article>{i}</article>") for i in range(300)] + [(2, "<main>same</main>")] * 300 + [(3, "<main>x</main>")]
    seen = []
    monkeypatch.setattr(H, "train", seen.append)
    H.fit(spark.createDataFrame(rows, "page_id long, html string").repartition(5), max_pages=1000)
    assert len(seen[0]) == 3 and seen[0][1:] == ["<main>same</main>", "<main>x</main>"]


def test_no_article_to_learn_from_falls_back_to_node_classes(spark):
    df = spark.createDataFrame([(1, "u", "<div class=menu>x</div><div><p>kept words</p></div><footer>f</footer>")],
                               "page_id long, url string, html string")
    assert H.fit(df) is None
    assert H.extract(df, None).first().text == "kept words"
