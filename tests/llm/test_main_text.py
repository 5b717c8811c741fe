from __future__ import annotations

import math
import random
import re
import time

import pytest

from tidewatch.llm.main_text import _density, extract, main_text, measure, parse

SHELL = '<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Menu one</a></li></ul></nav>%s<footer>&copy; someone</footer></body></html>'


def page(body):
    return SHELL % body


CASES = [
    ("<article><h1>Head</h1><p>One  two\n three.</p><p>Four.</p></article>", "Head\nOne two three.\nFour."),
    ("<article><h1>Head</h1><p><b>Head.<br><p>Second &amp; third&nbsp;x &lt;y&gt;</p></article>", "Head\nHead.\nSecond & third x <y>"),
    ('<div class="ad">Buy this now</div><article><p>Text here.</p><div class="comments"><p>Nice!</p></div><form>Your name <input></form></article>', "Text here."),
    ("<header><h1>Site</h1></header><main><p>First par.</p><aside>See also</aside><p>Last par.</p></main>", "First par.\nLast par."),
    ('<div id="wrap"><div class="sidebar">side words side words</div><div class="text"><p>%s</p><p>%s</p><p>short</p></div></div>' % ("long " * 60, "more " * 50), ("long " * 60).strip() + "\n" + ("more " * 50).strip() + "\nshort"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
    ("<article>loose <i>inline</i> words<p>block</p>tail</article>", "loose inline words\nblock\ntail"),
    ("<article><p>a</p><div class='cookie-notice'>We use cookies</div><p>b</p></article>", "a\nb"),
    ("<article><p>5 < 6 and a<b</p></article>", "5 < 6 and a"),
    ("<article><p>caf&eacute; &#233; &#x1F642; &unknown;</p><!-- <p>no</p> --></article>", "café é 🙂 &unknown;"),
    ('<article><p hidden>no</p><p style="display: none">no</p><p role="alert">no</p><p>yes</p></article>', "yes"),
    ("<article><p>unclosed <b>bold<p>next</article>", "unclosed bold\nnext"),
    ("<ARTICLE><P>Upper</P><SCRIPT>x</SCRIPT></ARTICLE>", "Upper"),
    ("<p>only</p>", "only"),
]


@pytest.mark.parametrize("body,want", CASES)
def test_pages(body, want):
    assert main_text(page(body)) == want


PROSE = [f"Sentence {k} is plain prose of the report, " * 5 for k in range(5)]
PARAGRAPHS = "".join(f"<p>{t}</p>" for t in PROSE)
WANT = "\n".join(t.strip() for t in PROSE)
LINKS = "".join(f'<a href="/{k}">Link {k}</a> ' for k in range(9))


@pytest.mark.parametrize(
    "body,want",
    [
        (f"<div id='links'>{LINKS}</div><div id='c'>{PARAGRAPHS}<p>Short.</p></div><div id='bottom'><ul><li>{LINKS}</ul></div>", WANT + "\nShort."),
        (f"<div><div id='links'>{LINKS}</div>{PARAGRAPHS}</div>", WANT),
        (f"<div id='links'>{LINKS}</div><div>{PROSE[0]}<br>{PROSE[1]}</div>", " ".join(PROSE[:2]).replace("  ", " ").strip()),
        (f"<div>{PARAGRAPHS}</div><div><div>{LINKS}</div><div>{PARAGRAPHS}</div></div>", WANT + "\n" + WANT),
        (f"<article><h1>Head</h1><div>{PARAGRAPHS}</div><div id='more'>{LINKS}</div><p>By me</p></article><div>{LINKS}</div>", "Head\n" + WANT + "\nBy me"),
        (f"<div id='links'>{LINKS}</div><main><p>{PROSE[0]}</p></main>", PROSE[0].strip()),
    ],
)
def test_menus_without_a_name_are_left_out(body, want):
    assert main_text(f"<html><body>{body}</body></html>") == want


@pytest.mark.parametrize(
    "page,want",
    [
        (f"<div class='layout has-sidebar'><div class='sidebar'>Side words</div><div>{PARAGRAPHS}</div></div>", WANT),
        (f"<div id='page' class='header-fixed'><div class='page-footer'>Small print</div><div>{PARAGRAPHS}</div></div>", WANT),
        (f"<div class='content-widget'>{PARAGRAPHS}</div>", WANT),
        (f"<article class='post comments-open'>{PARAGRAPHS}<div class='comment'>Nice!</div></article>", WANT),
        (f"<form id='aspnetForm'><div class='search'>Find</div><div>{PARAGRAPHS}</div></form>", WANT),
        (f"<div class='widget'><div class='share-bar'>Tell others</div>{PARAGRAPHS}</div>", WANT),
        (f"<div>{PARAGRAPHS}</div><div id='comments'><p>{PROSE[0]}</p><p>{PROSE[1]}</p></div>", WANT),
        (f"<div>{PARAGRAPHS}</div><article class='comment'><p>{PROSE[0]}</p></article>", WANT),
    ],
)
def test_names_do_not_take_the_article_out(page, want):
    assert main_text(f"<html><body>{page}</body></html>") == want


def test_no_text():
    assert [main_text(x) for x in (None, "", "<html><body></body></html>", "<nav>menu</nav>", "<script>", "<!-- x")] == [""] * 6
    assert main_text("no tags at all") == "no tags at all"


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + "<p>deep text</p>" + "</div>" * 3000
    assert main_text(deep) == "deep text"
    long = page("<article>" + "".join(f"<p>par {k}</p>" for k in range(20_000)) + "</article>")
    assert main_text(long) == "\n".join(f"par {k}" for k in range(20_000))
    assert main_text("<a title=\"" + "x" * 50_000) is not None


def test_density_of_text_and_links():
    root = parse("<div><p>plain words here</p></div><div><a>linked words here</a></div>")
    nodes = measure(root)
    by = {n.name: n for n in nodes}
    assert by["p"].chars == 14 and by["a"].link_chars == 15 and root.tags == 4 and root.link_tags == 1
    assert by["p"].density > by["a"].density
    assert by["p"].density == _density(by["p"], root.link_chars / root.chars)
    assert root.total == sum(c.density for c in root.children)


def test_rows(spark):
    pages = [page(b) for b, _ in CASES] + [None, "", page(CASES[0][0])]
    want = [w for _, w in CASES] + ["", "", CASES[0][1]]
    source = spark.createDataFrame([(k, f"u{k}" if k else None, p, "x") for k, p in enumerate(pages)], "page_id long, url string, html string, text string")
    rows = extract(source).collect()
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in sorted(rows, key=lambda r: r["page_id"])] == [(k, w, len(w)) for k, w in enumerate(want)]
    assert extract(source).columns == ["page_id", "url", "text", "n_chars"]
    assert extract(source.limit(0)).count() == 0


# comments, titles ---------------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 2, 4, 8, 40])
@pytest.mark.parametrize("shape", ["<div id='comments'>%s</div>", "<section class='user-comments x'>%s</section>", "<div class='comment-replies'><div class='comment'>%s</div></div>", "<article class='comment'>%s</article>"])
def test_reader_comments_go_however_long(n, shape):
    said = shape.replace("user-comments", "comments") % "".join(f"<p>I think so too, number {k}, and here is why I do.</p>" for k in range(n))
    want = "Title\nA short article."
    assert main_text(f"<html><body><article><h1>Title</h1><p>A short article.</p></article>{said}</body></html>") == want
    assert main_text(f"<html><body><article><h1>Title</h1><p>A short article.</p>{said}</article></body></html>") == want
    assert main_text(f"<html><body><div><h1>Title</h1><p>A short article.</p></div>{said}</body></html>") == want


def test_a_page_of_comments_only_keeps_its_text():
    assert main_text("<html><body><div class='comments'><p>All there is.</p></div></body></html>") == "All there is."
    assert main_text("<div class='comments'><article><p>Text of the page.</p></article></div>") == "Text of the page."


def test_long_asides_beside_an_article_go():
    side = f"<div class='widget'>{PARAGRAPHS}</div>"
    assert main_text(f"<html><body><article><p>Short text.</p></article>{side}</body></html>") == "Short text."


def test_a_title_in_the_article_s_header():
    assert main_text("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>Text of it.</p></article>") == "Title\nText of it."


# densities without names -----------------------------------------------------------------
def stripped(html):
    """The page with every structural element a div and without classes, ids and roles."""
    html = re.sub(r"<(/?)(nav|header|footer|aside|article|main|form|section)\b[^>]*>", r"<\1div>", html)
    return re.sub(r"\s(class|id|role)=(\"[^\"]*\"|'[^']*'|\S+?(?=[\s>]))", "", html)


def test_densities_alone_find_the_article(spark):
    """On pages stripped of all names no line of the article is lost, and few others are kept."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    same = lines = others = 0
    for html in pages:
        want, got = set(main_text(html).split("\n")), set(main_text(stripped(html)).split("\n"))
        assert want <= got
        lines, others, same = lines + len(want), others + len(got - want), same + (want == got)
    assert same >= 0.85 * len(pages) and others <= 0.03 * lines


def test_unnamed_blocks_of_short_lines_are_left_out():
    ad, foot = "<div>Buy one of these today</div>", "<div>(c) 2021 someone, all rights reserved by them</div>"
    assert main_text(f"<html><body><div>{LINKS}</div>{ad}<div>{PARAGRAPHS}</div>{foot}</body></html>") == WANT


def brute_density(node, body):
    """The formula, from the texts below a node."""
    def texts(n, linked=False):
        linked = linked or n.name == "a"
        for part in n.parts:
            yield from [("".join(part.split()), linked)] if isinstance(part, str) else texts(part, linked)

    def tags(n, linked=False):
        linked = linked or n.name == "a"
        yield from (x for c in n.children for x in [linked or c.name == "a", *tags(c, linked)])

    def counts(n):
        t, g = list(texts(n)), list(tags(n))
        return sum(len(x) for x, _ in t), len(g), sum(len(x) for x, l in t if l), sum(g) + (n.name == "a")  # noqa: E741

    (c, t, lc, lt), (cb, _, lcb, _) = counts(node), counts(body)
    if not c:
        return 0.0
    t, lt = t or 1, lt or 1
    base = math.log(c / ((c - lc) or 1) * lc + lcb / cb * c + math.e)
    value = math.log(max(c / (lc or 1) * t / lt, 1.0))
    return c / t * value / (math.log(base) if base > 1 else 1.0)


def test_densities_by_the_formula():
    rng = random.Random(17)
    names = ["div", "p", "a", "b", "ul", "li", "span", "section"]

    def some(depth):
        inner = "".join(rng.choice(["words of text ", "x", " ", "", some(depth - 1) if depth else "end"]) for _ in range(rng.randint(0, 4)))
        name = rng.choice(names)
        return f"<{name}>{inner}</{name}>"

    for _ in range(150):
        root = parse("".join(some(4) for _ in range(3)))
        nodes = measure(root)
        for n in nodes:
            assert n.density == pytest.approx(brute_density(n, root), rel=1e-9, abs=1e-9)
            assert n.total == pytest.approx(sum(brute_density(c, root) for c in n.children), rel=1e-9, abs=1e-9)


# hard pages -----------------------------------------------------------------------------
@pytest.mark.parametrize(
    "html",
    ["a<b" * 330_000, "<a" * 500_000, "<a " * 330_000, '<a "' * 250_000, "<a '\">x" * 150_000, "<!--" * 250_000, "<div>" * 60_000 + "</x>" * 150_000,
     "<nav>" + "<div>" * 60_000 + "</x>" * 150_000, "<i>" * 60_000 + "<ul></ul>" * 80_000, "<div class='comment'>" * 20_000 + "x", "<p>x</p>" * 120_000, "<form><p>x" * 50_000],
    ids=lambda h: h[:12],
)
def test_a_megabyte_of_anything_takes_seconds(html):
    begun = time.perf_counter()
    main_text(html)
    assert time.perf_counter() - begun < 15


def test_quotes_and_brackets():
    assert main_text("<p title='a>b'>one</p><p title=\"it's > x\">two</p>") == "one\ntwo"
    assert main_text("<article><p title='open>one</p><p>two</p></article>") == "one\ntwo"
    assert main_text("<article><p>1 < 2 > 0</p><!-- a -- > b --><p>x</p><!doctype y><?php z?></article>") == "1 < 2 > 0\nx"


def test_repeats_clashing_names_and_long_pages(spark):
    html = page(f"<article>{PARAGRAPHS}</article>")
    long = page("<article><p>" + "long words " * 200_000 + "</p></article>")
    source = spark.createDataFrame([(1, "u", html), (1, "u", html), (2, "v", long), (None, None, None)], "page_id long, url string, html string").selectExpr("*", "'x' AS n_chars", "1 AS TEXT")
    rows = extract(source).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in rows) == [(0, 0), (1, len(WANT)), (1, len(WANT)), (2, 11 * 200_000 - 1)]
