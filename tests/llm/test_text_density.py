import time

import pytest

from marketlake.llm.text_density import blocks, extract_main_text, main_text, parse

P = "<p>" + "A paragraph of running text that is clearly part of the article. " * 3 + "</p>"
PARA = "A paragraph of running text that is clearly part of the article. " * 3
PARA = PARA.strip()
MENU = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(9)) + "</ul></nav>"


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_article_with_everything_around_it():
    text = main_text(page(
        MENU + '<header>Site</header><div class="ad">Buy now</div><article><h1>Head&amp;line</h1>'
        + P + "<script>var t='</p>';</script><p>Short.</p><form>Sign <input></form>"
        + '<section class="comments"><p>First!</p></section></article><aside>Side</aside>'
        + "<footer>&copy; us</footer>"))
    assert text == f"Head&line\n{PARA}\nShort."


def test_page_without_article_elements():
    links = "".join(f'<div><a href="/{i}">A related story number {i}</a></div>' for i in range(12))
    text = main_text(page(f"<div>{links}</div><div id=main><h2>Title</h2><div>{P}{P}</div><div>{P}</div></div>"
                          f"<div class='footer'>Imprint</div>"))
    assert text.count(PARA) == 3 and "related" not in text and "Imprint" not in text


def test_white_space_references_and_unclosed_elements():
    text = main_text(page("<article><p>a&nbsp;&lt;b&gt;\n\t c <b>bold<br>x<p>second &#233;<i>&eacute;</i> "
                          "<div>third</div>tail</article>"))
    assert text == "a <b> c bold x\nsecond éé\nthird\ntail"


@pytest.mark.parametrize("html", [None, "", "<", "<p", "plain text", "</div></p>", "<!-- open", "<script>x",
                                  "<a href='", "<p>x</span></div>y", "<table><tr><td>c<td>d</table>"])
def test_broken_pages_do_not_crash(html):
    assert isinstance(main_text(html), str)


def test_plain_text_page():
    assert main_text("Just some text\nwithout markup") == "Just some text without markup"


def test_stray_end_tags_do_not_end_the_article():
    assert main_text(f"<article><p>One.</div></section>{P}</article><footer>f</footer>") == f"One.\n{PARA}"


def test_boilerplate_by_name():
    for attr in ('class="ad"', "class='left side-bar sidebar'", "id=comments", 'role="navigation"',
                 "hidden", 'style="display: none"', 'class="cookieNotice"'):
        assert blocks(parse(f"<div {attr}>no</div><p>yes</p>")) == ["yes"], attr
    for attr in ('class="adventure"', 'class="roadmap"', 'data-class="ad"'):
        assert blocks(parse(f"<div {attr}>yes</div>")) == ["yes"], attr


def test_deep_and_large_pages_are_read_in_linear_time():
    start = time.perf_counter()
    deep = main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000)
    wide = main_text("<article>" + "<p>word word</p>" * 50_000 + "</article>")
    unclosed = main_text("<article>" + "<b><p>word" * 5_000 + "</article>")
    assert "deep" in deep and wide.count("\n") == 49_999 and unclosed.count("word") == 5_000
    assert time.perf_counter() - start < 60


def test_query_columns_nulls_and_clashes(spark):
    rows = [(1, "u", page(f"<article>{P}</article>")), (1, "u", page(f"<article>{P}</article>")), (2, None, None),
            (None, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' as _text", "'y' as text")
    got = extract_main_text(df).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars, r._text) for r in got) == sorted(
        [("1", PARA, len(PARA), "x")] * 2 + [("2", "", 0, "x"), ("None", "", 0, "x")])
    assert extract_main_text(df.limit(0)).count() == 0


def test_given_pages(spark):
    """Against a plain reading of the pages' article elements."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract_main_text(pages).collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
        assert r.text == "\n".join(t for t in texts if t)


def paragraphs(name, n):
    return [f"{name} {i}: " + "running text that is clearly part of the article, " * 3 + "end." for i in range(n)]


def tagged(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("sizes", [(4, 4), (8, 3), (3, 8), (5, 5, 5), (1, 6, 2)])
@pytest.mark.parametrize("tag", ["div", "section", "article"])
def test_all_sections_of_a_page(sizes, tag):
    parts = [paragraphs(f"part {k}", n) for k, n in enumerate(sizes)]
    body = "".join(f"<{tag}>{tagged(p)}</{tag}>" for p in parts)
    links = "".join(f'<li><a href="/{i}">Another story number {i}</a></li>' for i in range(20))
    want = "\n".join(t for p in parts for t in p)
    assert main_text(page(f"<div>{body}</div>")) == want
    assert main_text(page(f"{MENU}<ul>{links}</ul><div>{body}</div><div><ul>{links}</ul></div>")) == want


def test_heading_and_text_beside_the_body():
    texts = paragraphs("body", 6)
    lead = "A lead that stands by itself, without an element around it, and is <b>long</b> enough to count."
    links = "".join(f'<li><a href="/{i}">Another story number {i}</a></li>' for i in range(20))
    got = main_text(page(f"<ul>{links}</ul><div><h1>A headline of some length</h1>{lead}<div>{tagged(texts)}</div></div>"))
    assert got == "\n".join(["A headline of some length", lead.replace("<b>", "").replace("</b>", ""), *texts])
    assert main_text(page(f"<div><h1>Title</h1><div>{tagged(texts)}</div></div>")) == "\n".join(["Title", *texts])
    other = f"<h2>More</h2><ul>{links}</ul>"
    assert main_text(page(f"{other}<h1>Title</h1><div>{tagged(texts)}</div>{other}")) == "\n".join(["Title", *texts])


ARTICLE = f"<article><h1>Head</h1>{P * 6}</article>"
WHOLE = "\n".join(["Head", *[PARA] * 6])


@pytest.mark.parametrize("body", [
    f'<div class="content">{ARTICLE}</div>',
    f'<div class="content has-sidebar">{MENU}{ARTICLE}<div class="sidebar"><p>Aside</p></div></div>',
    f'<div class="single no-comments">{ARTICLE}</div><div class="footer">Imprint</div>',
    f'<form id="aspnetForm">{MENU}{ARTICLE}<div class="footer">Imprint</div></form>',
    f'<article><h1>Head</h1><div class="article-share-wrap-text">{P * 6}</div></article>',
    f'<div id="search-page"><div class="widget-area">{ARTICLE}</div></div>',
])
def test_names_do_not_drop_what_holds_most_of_the_page(body):
    assert main_text(page(body)) == WHOLE


def test_named_parts_that_hold_less_still_go():
    comments = "<div class='comments'>" + "".join(f"<p>Reader {i} says: {PARA}</p>" for i in range(9)) + "</div>"
    assert main_text(page(ARTICLE + comments)) == WHOLE  # longer than the article
    form = f"<form>{P}<input></form>"
    assert main_text(page(f"<article><h1>Head</h1>{P * 6}{form}</article>")) == WHOLE
    hidden = f"<div style='display:none'>{P * 30}</div><div hidden>{P * 30}</div>"
    assert main_text(page(ARTICLE + hidden)) == WHOLE
