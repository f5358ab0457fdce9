"""Main text of pages: the tables' pages against their article, and hard markup."""
import html
import re
import time

import pytest

from oppflow.llm.html_text import extract, main_text, measure, parse

FOLDER = "/root/testdata/sf0.01"


def article_of(page):
    """What the generated pages hold between the article tags, by plain text cutting."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))).split())


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    want = {r.page_id: article_of(r.html) for r in pages.collect()}
    got = {r.page_id: r.text for r in extract(pages).collect()}
    assert got == want


LONG = "This is running text of the article, long enough to stand out from what is around it, and then some more. "
MENU = "".join(f'<li><a href="/{i}">Menu entry {i}</a></li>' for i in range(12))


@pytest.mark.parametrize("page", [
    f"<body><div id=menu><ul>{MENU}</ul></div><div class='content'><p>{LONG}</p><p>{LONG}</p></div><div class=footer>All rights</div></body>",
    f"<body><table><tr><td><ul>{MENU}</ul><td><p>{LONG}<p>{LONG}</table></body>",
    f"<body><nav><ul>{MENU}</ul></nav><main><section><p>{LONG}</p></section><section><p>{LONG}</p></section></main><section class='comments'><p>{LONG}nice</p></section></body>",
    f"<header><h1>Site</h1></header><article><p>{LONG}</p><aside>see also</aside><form><p>Sign up</p></form><p>{LONG}</p><div class='ad-banner ad'>Buy</div></article><script>x='<p>';</script>",
    f"<p>{LONG}</p><!-- <p>hidden</p> --><p>{LONG}</p><div class='cookie-notice cookie'>We use cookies</div><div role=navigation>Home</div><div hidden>no</div>",
])
def test_boilerplate_goes(page):
    assert main_text(page) == (LONG + LONG).strip()


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("<script>a</script>", ""), ("plain text", "plain text"), ("a < b &amp; c &lt;d&gt;", "a < b & c <d>"),
    ("<p>a<br>b<p>c <b>d</b>e</p>\n f", "a b c de f"), ("<p>one&nbsp;two \n\t three</p>", "one two three"), ("<p>x<!-- open", "x"), ("<p>te<script>1</script>xt</p>", "text"),
    ("<div><p>a</div></p>b</i>", "a b"), ("<p>&eacute;&#233;&#xe9; &unknown; &am", "ééé &unknown; &am"), ("<p title='a>b'>q</p>", "q"), ("<p>5 <3 hearts", "5 <3 hearts"),
    ("<ul><li>one<li>two</ul>", "one two"), ("<nav>only menu</nav>", ""), ("<title>t</title>", ""), ("<P CLASS=X>Up</P>", "Up"), ("<td>a<td>b", "a b"),
])
def test_markup(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<article><p title=don't>One cat.</p><p>Two isn't a dog.</p><p>Three</p></article>", "One cat. Two isn't a dog. Three"),
    ("<p title=5\">a</p><p>b\"</p>", 'a b"'), ("<p title = 'a > b'>a</p><p>b</p>", "a b"), ("<p title=a=\"x>y\">a</p>", "a"), ("<p a' b>a</p><p>it's</p>", "a it's"),
])
def test_quotes_open_strings_only_after_an_equals_sign(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", [
    "<nav>Home</nav><form><label>Name</label><input></form>", "<div class=comments><p>Nice text, thank you for it.</p></div>", "<header>Site</header><footer>All rights</footer>",
    "<form><p>Name</p></form><nav>Home</nav>",
])
def test_furniture_alone_is_no_text(page):
    assert main_text(page) == ""


def test_time_is_linear_in_stray_tags():
    for page in ("<div>" * 40_000 + "</b>" * 40_000, "<p><td>" + "<b>" * 40_000 + "<hr>" * 40_000, "<b>" * 40_000 + "<li>" * 40_000, "<p a=" + " " * 100_000 + ">x", "<p " + "='" * 50_001 + ">x"):
        began = time.process_time()
        main_text(page)
        assert time.process_time() - began < 3


def test_long_and_deep_pages():
    deep = "<div>" * 20_000 + LONG + "</div>" * 20_000
    assert main_text(deep) == LONG.strip()
    assert main_text("<p>" + "word " * 200_000) == ("word " * 200_000).strip()
    assert main_text("<" * 20_000) == "<" * 20_000
    assert main_text('x <a "' * 3_001).startswith("x")  # a tag that never ends


def test_links_lower_the_density():
    root = parse(f"<body><div><p>{LONG}</p></div><div><a href=x>{LONG}</a></div></body>")
    nodes = {n.tag + str(i): n for i, n in enumerate(measure(root))}
    dense = [n.density for n in nodes.values() if n.tag == "div"]
    assert dense[0] > 2 * dense[1]


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>é🙂</p>", "t"), (1, "u", "<p>é🙂</p>", "t"), (None, None, None, None)], "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in extract(df).collect()) == [(0, "", 0), (1, "é🙂", 2), (1, "é🙂", 2)]
    assert extract(df.limit(0)).collect() == []


INSIDE = f"<div class='social share'><p>Share this</p></div><p>{LONG}</p><div id=comments class=comments-area><article class=comment>Nice one</article></div><p>{LONG}</p>"
LINE = "<p>One line outside</p>"


@pytest.mark.parametrize("page", [
    f"<body>{LINE}<div class='site has-sidebar'><article>{INSIDE}</article></div></body>",
    f"<body>{LINE}<div class='content with-sidebar'><article>{INSIDE}</article><div class=sidebar>{LONG}</div></div></body>",
    f"<body>{LINE}<div id='header-and-content'><div class=header>Site</div><main>{INSIDE}</main></div></body>",
    f"<body>{LINE}<div class='page nav-open'><article>{INSIDE}</article></div></body>",
    f"<body>{LINE}<form id=aspnetForm><div class='content sidebar'><div class='menu'><ul>{MENU}</ul></div><article>{INSIDE}</article></div></form></body>",
    f"<body>{LINE}<div class='post comments-open'><main>{INSIDE}</main></div></body>",
    f"<main><h1></h1><div class='page toolbar'><article>{INSIDE}</article></div></main>",
    f"<body><form><nav><ul>{MENU}</ul></nav><div class=body><p>{LONG}</p><p>{LONG}</p></div><div class=footer>All rights</div></form></body>",
    f"<body><div class='page sidebar-right'><p>{LONG}</p><p>{LONG}</p><div class=cookie>We use cookies</div></div></body>",
])
def test_marked_wrappers_stay(page):
    assert main_text(page) == (LONG + LONG).strip()


@pytest.mark.parametrize("page", [
    f"<article><p>{LONG}</p></article><section class=comments>{f'<article><p>{LONG}</p></article>' * 9}</section>",
    f"<main><p>{LONG}</p><div class=related><article>{LONG}{LONG}</article></div></main>",
    f"<body><p>{LONG}</p><div class=cookie-consent><p>{LONG}</p><p>{LONG}</p></div></body>",
    f"<body><article><p>{LONG}</p></article><form><p>{LONG}</p><p>{LONG}</p></form></body>",
])
def test_large_furniture_goes(page):
    assert main_text(page) == LONG.strip()


def test_bylines_stay():
    assert main_text(f"<article><p class=byline>By A. Writer</p><p>{LONG}</p></article>") == f"By A. Writer {LONG}".strip()
