from __future__ import annotations

import html
import re

import pytest

from tillstream.llm.common import table
from tillstream.llm.html_text import extract_text, main_text

LONG = "A sentence of some length, with a comma, that goes on for a while. " * 3
LONG = LONG.strip()


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "source,expected",
    [
        ("", ""),
        (page(""), ""),
        (page(f"<article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article>"), f"Head\n{LONG}\nShort."),
        (page(f"<nav><a href=x>Menu</a></nav><main><p>{LONG}</main><footer>&copy; x</footer>"), LONG),
        (page(f"<article><p><b>Bold<br><p>{LONG}</p></article>"), f"Bold\n{LONG}"),
        (page(f"<article><p>a &amp; b &lt;x&gt; &#233;&nbsp;c\n\t d {LONG}</p></article>"), f"a & b <x> é c d {LONG}"),
        (page(f"<article><p>{LONG}</p><script>var t='</p><p>x</p>';</script><style>p{{}}</style></article>"), LONG),
        (page(f"<article><p>{LONG}</p><!-- <p>no</p> --><form><p>no {LONG}</p></form></article>"), LONG),
        (page(f"<article><p>{LONG}</p><div class='comments'><p>{LONG}</p></div></article>"), LONG),
        (page(f"<div class='ad'>{LONG}</div><div id=content><p>{LONG}</p><p>Two.</p></div>"), f"{LONG}\nTwo."),
        (page(f"<div id=sidebar><p>{LONG}</p></div><div><p>{LONG}</p></div>"), LONG),
        (page(f"<div><ul><li><a href=a>{LONG}</a><li><a href=b>{LONG}</a></ul></div><div><p>{LONG}</p></div>"), LONG),
        (page(f"<div><div><p>{LONG}</p></div><div><p>{LONG}</p><p>{LONG}</p></div></div>"), f"{LONG}\n{LONG}\n{LONG}"),
        (page("<article><p>Tiny.</p></article>"), "Tiny."),
        (page(f"<header><h1>Site</h1></header><article><header><h1>Head</h1></header><p>{LONG}</p></article>"), f"Head\n{LONG}"),
        (page(f"<article><p>1 < 2 and {LONG}<p>x<td>cell</article>"), f"1 < 2 and {LONG}\nx\ncell"),
        (page(f"<article><p hidden>no</p><p style='display:none'>no</p><p>{LONG}</p></article>"), LONG),
        (page(f"<article><table><tr><td>a<td>b<tr><td>c</table><p>{LONG}</p></article>"), f"a\nb\nc\n{LONG}"),
        (f"<p>{LONG}", LONG),
        ("just words", "just words"),
        ("<article><p>" + LONG + "<scr", LONG),
    ],
)
def test_pages(source, expected):
    assert main_text(source) == expected


PAGE = f"<article><p>{LONG}</p></article>"


@pytest.mark.parametrize(
    "source,expected",
    [
        (f"<div class='page has-sidebar'>{PAGE}</div>", LONG),
        (f"<div id='sidebar'><div class=related>{PAGE}</div></div>", LONG),
        (f"<article><h2 id='related-work'>Related</h2><p>{LONG}</p><h3 class=search>S</h3></article>", f"Related\n{LONG}\nS"),
        (f"<article><p>{LONG}</p><section id='side-effects'><p>Few.</p></section></article>", f"{LONG}\nFew."),
        (f"<article><p>{LONG}</p><div class='side-by-side'><p>Few.</p></div></article>", f"{LONG}\nFew."),
        (f"<article><p>{LONG} <a href='/hidden-gems'>gems</a> and <a href='/v?id=comment-5'>it</a>.</p></article>", f"{LONG} gems and it."),
        (f"<article><p>{LONG}</p><p data-x='style=display:none' title='a hidden b'>Few.</p></article>", f"{LONG}\nFew."),
        (f"<div class='side'><p>{LONG}</p><p>{LONG}</p></div><div><p>Short.</p></div>", f"{LONG}\n{LONG}\nShort."),
        (f"<article class='post has-comments'><p>{LONG}</p></article>", LONG),
        ("<div class='notice'><p>Few.</p></div>", "Few."),
        # what the names are for
        (f"{PAGE}<div class='sidebar'><article><p>Few.</p></article></div>", LONG),
        (f"<article><p>{LONG}</p><div id='comments'><article class='comment'>{f'<p>{LONG}</p>' * 9}</article></div></article>", LONG),
        (f"{PAGE}<div class='cookie-consent'>{f'<p>{LONG}</p>' * 9}</div>", LONG),
        (f"<article><p>{LONG}<span class='ad-box'>Buy</span></p><div class='social-share'>Share</div></article>", LONG),
    ],
)
def test_names_that_hold_a_listed_word(source, expected):
    assert main_text(page(source)) == expected


NAMES = """ad-slot ad-unit google_ads dfp-ad sponsored-content nav-primary primary-menu site-header page-header
login-form newsletter-form cookie-law-info comment-form user-comments right-rail most-popular trending adBox
ad-wrapper top-ads advertisement banner-ad sidebar left-sidebar widget-area main-nav navbar navigation-menu
breadcrumbs site-footer comments comment-list disqus_thread cookie-banner cookie-consent gdpr-popup modal-overlay
newsletter-signup subscribe-box social-share share-buttons related-posts recommended pagination site-search
reader-comments promo-box sponsor-links menu""".split()


@pytest.mark.parametrize("name", NAMES)
def test_usual_names_of_what_is_not_text(name):
    """Beside the text and inside it, without and with an article element."""
    extra = f"<div class='{name}'><p>Few words.</p><a href=x>Go</a></div>"
    for around in ("article", "div"):
        assert main_text(page(f"{extra}<{around}><p>{LONG}</p><p>{LONG}</p></{around}>")) == f"{LONG}\n{LONG}"
        if name not in ("site-header", "page-header"):
            assert main_text(page(f"<{around}><p>{LONG}</p>{extra}<p>{LONG}</p></{around}>")) == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("name", ["ad-hoc-methods", "menu-engineering", "share-of-market", "comments-on-law-x", "nav-history"])
def test_long_text_with_such_a_name_stays(name):
    text = f"<section id='{name}'><p>{LONG}</p></section>"
    if not name.startswith("comments"):
        assert main_text(page(f"<article><p>{LONG}</p>{text}</article>")) == f"{LONG}\n{LONG}"


def test_what_stands_within_a_line_does_not_end_it():
    within = ["<svg><path d=x /><text>t</text></svg>", "<script>var a = '<p>';</script>", "<input value=x>", "<button>b</button>",
              "<math><mi>x</mi></math>", "<style>p{}</style>", "<label>l</label>", "<noscript>n</noscript>"]
    for x in within:
        for around in ("article", "div"):
            source = f"<{around}><p>Some {x} words, here {x}and {x} there.</p><p>{LONG}</p></{around}>"
            assert main_text(page(source)) == f"Some words, here and there.\n{LONG}", x
    assert main_text(page(f"<article><p>{LONG}<nav>n</nav>{LONG}<aside>a</aside></article>")) == f"{LONG}\n{LONG}"


def test_all_articles_of_a_page():
    teaser = "<article><a href=x>More of this to read on another page, it says</a></article>"
    source = f"<article><p>{LONG}</p></article><article><p>{LONG}</p><p>Two.</p></article>{teaser}"
    assert main_text(page(source)) == f"{LONG}\n{LONG}\nTwo."
    assert main_text(page(f"<main><p>{LONG}</p></main><article><p>Few.</p></article>")) == LONG


def plain_best(source):
    """The container with the most points, by regular expressions, for pages of divs and paragraphs."""
    points, size, links, stack, parent = {}, {}, {}, [], {}
    for m in re.finditer(r"<div id=(\w+)>|</div>|<p>(.*?)</p>", source):
        if m[1]:
            parent[m[1]] = stack[-1] if stack else None
            stack.append(m[1])
        elif m[2] is None:
            stack.pop()
        else:
            text, linked = re.sub(r"<[^>]*>", "", m[2]), sum(map(len, re.findall(r"<a[^>]*>(.*?)</a>", m[2])))
            for d in stack:
                size[d], links[d] = size.get(d, 0) + len(text), links.get(d, 0) + linked
            if len(text) >= 25:
                score = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
                points[stack[-1]] = points.get(stack[-1], 0) + score
                if parent[stack[-1]]:
                    points[parent[stack[-1]]] = points.get(parent[stack[-1]], 0) + score / 2
    return max(points, key=lambda d: points[d] * (1 - links[d] / size[d]))


def test_pages_without_article_take_the_best_container():
    """Points, link density and siblings decide, as in a plain scoring."""
    import random

    draw = random.Random(9)
    for _ in range(60):
        parts, texts = [], {}
        for k in range(draw.randint(2, 4)):
            paragraphs = []
            for j in range(draw.randint(1, 5)):
                words = ", ".join(f"w{k}x{j}y{i}" for i in range(draw.randint(1, 30)))
                paragraphs.append(f"<p><a href=x>{words}</a></p>" if draw.random() < 0.4 else f"<p>{words}</p>")
            texts[f"d{k}"] = paragraphs
            parts.append(f"<div id=o{k}><div id=d{k}>{''.join(paragraphs)}</div></div>")
        source = "".join(parts)
        got = main_text(page(source)).split("\n")
        best = plain_best(source).replace("o", "d")
        for p in texts[best]:
            assert re.sub(r"<[^>]*>", "", p) in got, (best, source)


LONGER = f"<div>{f'<p>{LONG}</p>' * 10}</div>"


@pytest.mark.parametrize(
    "sibling,expected",
    [
        ("<div><p>One short section.</p></div>", ["One short section."]),
        ("<ul><li>a</li><li>b</li></ul>", ["a", "b"]),
        ("<ol><li>a</ol><dl><dt>b<dd>c</dl>", ["a", "b", "c"]),
        ("<table><tr><td>a<td>b</table>", ["a", "b"]),
        ("<figure><img src=x><figcaption>a</figcaption></figure>", ["a"]),
        ("<h4>a</h4><h5>b</h5><h6>c</h6>", ["a", "b", "c"]),
        ("words alone", ["words alone"]),
        ("<ul><li><a href=x>a</a><li><a href=y>b</a></ul>", []),
        ("<div class=sidebar><p>no</p></div>", []),
    ],
)
def test_siblings_stay_however_long_the_best_is(sibling, expected):
    for wrapped in (LONGER, f"<section>{LONGER}</section>"):
        got = main_text(page(f"<div id=content>{wrapped}{sibling}</div>"))
        assert got.split("\n") == [LONG] * 10 + expected


def test_a_deep_or_broken_page_ends():
    assert main_text("<div>" * 3000 + "x" * 100) == "x" * 100
    assert len(main_text("<div>x" * 100_000)) > 0 and main_text("<div></b>" * 100_000) == ""
    assert main_text("<" * 5000 + "a='" * 2000) is not None
    assert len(main_text(page("<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"))) == 5000 * (len(LONG) + 1) - 1


def test_rows(spark):
    source = page(f"<article><p>{LONG}</p></article>")
    rows = [(1, "u", source), (1, "u", source), (None, None, source), (2, "u", None), (3, "u", "")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars long")
    got = extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == sorted(
        (r[0] or 0, LONG if r[2] else "", len(LONG) if r[2] else 0) for r in rows
    )
    assert extract_text(pages.filter("false")).collect() == []


def test_whole_table(spark, sf_dir):
    """Nothing of what stands around an article comes with it."""
    pages = table(spark, sf_dir, "pages")
    got = {r.page_id: r for r in extract_text(pages).collect()}
    for r in pages.collect():
        inside = r.html.split("<article>")[1].split("</article>")[0]
        words = html.unescape(re.sub(r"<[^>]*>", " ", inside)).split()
        assert got[r.page_id].text.split() == words
