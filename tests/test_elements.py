"""Elements by tag depth against a small parser with a stack, and the two readings of tables against each other."""
import random
import re

import pytest
from pyspark.sql import functions as F

from oppflow.functions import elements as E
from oppflow.functions import html as H


def pages_of(spark, pages):
    return spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").repartition(3)


def values(spark, pages, column):
    return [r.x for r in pages_of(spark, pages).select("page_id", column.alias("x")).orderBy("page_id").collect()]


TOKENS = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>", "<tbody>", "</tbody>", "<thead>", "</thead>", "a", "b ", "<b>c</b>"]


def rows_and_cells(page):
    """[[cell texts of a body row]] by a stack of open elements."""
    stack, made = [], []

    def cut(to):
        del stack[to:]

    def last(names, scope):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in scope:
                return None
        return None

    for token in re.findall(r"<[^>]*>|[^<]+", page):
        m = re.fullmatch(r"<(/?)(table|thead|tbody|tr|td|th)>", token)
        if not m:
            if not token.startswith("<"):
                for e in stack:
                    e[1].append(token)
            continue
        name = m[2]
        if m[1]:
            i = last({name}, set() if name == "table" else {"table"})
            if i is not None:
                cut(i)
            continue
        if name != "table" and not any(e[0] == "table" for e in stack):
            continue
        if name in ("thead", "tbody"):  # a section ends all that is open in its table
            cut(max(i for i, e in enumerate(stack) if e[0] == "table") + 1)
        closes, scope = {"td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
                         "thead": (set(), set()), "tbody": (set(), set()), "table": (set(), set())}[name]
        # the outermost of the kind within the scope
        while (i := last(closes, scope)) is not None:
            cut(i)
        element = (name, [], [e for e in stack])
        stack.append(element)
        made.append(element)
    def in_head(row):
        inside = [x[0] for x in row[2]]
        return "thead" in inside[len(inside) - inside[::-1].index("table"):]

    rows = [e for e in made if e[0] == "tr" and not in_head(e)]
    return [[" ".join("".join(c[1]).split()) for c in made if c[0] == "td" and any(x is r for x in c[2])] for r in rows]


def cells_of(page):
    return F.transform(H.table_rows(page), lambda row: F.transform(H.row_cells(row), lambda c: F.regexp_replace(c, " ", "")))


def test_random_tables_equal_the_stack(spark):
    rng = random.Random(11)
    pages = ["".join(rng.choices(TOKENS, k=rng.randrange(0, 40))) for _ in range(1500)]
    got = values(spark, pages, E.bind(E.folded(F.col("html"), E.TABLE_TAGS), cells_of))
    want = [[[c.replace(" ", "") for c in row] for row in rows_and_cells(p)] for p in pages]
    assert [p for p, g, w in zip(pages, got, want, strict=True) if g != w] == []


def test_pages_without_nesting_read_the_same_folded(spark):
    rng = random.Random(12)

    def table():
        rows = "".join("<tr>" + "".join(f"<td>{rng.randrange(99)}" + rng.choice(["", "</td>"]) for _ in range(rng.randrange(4))) + rng.choice(["", "</tr>"]) for _ in range(rng.randrange(4)))
        return "<table>" + rng.choice(["", "<thead><tr><td>h</td></tr></thead>"]) + rng.choice(["", "<tbody>"]) + rows + rng.choice(["</table>", "</tbody></table>"])

    pages = [" ".join(table() for _ in range(rng.randrange(4))) for _ in range(300)]
    plain = values(spark, pages, E.bind(H.table_page(F.col("html")), cells_of))
    folded = values(spark, pages, E.bind(E.folded(H.markup(F.col("html")), E.TABLE_TAGS), cells_of))
    assert plain == folded and any(plain)
    assert not any(values(spark, pages, E.has_marks(H.table_page(F.col("html")))))


@pytest.mark.parametrize("page,classes,texts", [
    ('<div class="card">a<div>b</div>c</div>d', ["card"], ["a b c"]),
    ('<div class="card">a<div class="x card">b</div>c</div>', ["card"], ["a b c", "b"]),
    ('<ul><li class=card>a<li>b</ul>', ["card"], ["a"]), ('<div class="cards">a</div>', ["card"], []),
    ('<p class="card">a<p>b', ["card"], ["a"]), ('<div class="card">a', ["card"], ["a"]), ('<span class="card">a<span>b</span>c</span>d', ["card"], ["abc"]),
    ('<div data-class="card">a</div>', ["card"], []), ("<DIV CLASS='card'>a</DIV>b", ["card"], ["a"]), ('</div><div class="card">a</div>', ["card"], ["a"]),
])
def test_blocks(spark, page, classes, texts):
    found = values(spark, [page], F.transform(E.bind(H.flow_page(F.col("html")), lambda p: H.blocks(p, classes)), H.visible))
    assert found == [texts]


def test_null_empty_long_deep_and_marked_pages(spark):
    deep = "<div>" * 400 + '<b class="card">x</b>' + "</div>" * 400
    long = "<table>" + "<tr><td>a<table><tr><td>b</td></tr></table></td></tr>" * 1500 + "</table>"
    pages = [None, "", deep, long, "<div class=\"card\">a\ue000\uf001b</div>"]
    cards = values(spark, pages, F.transform(E.bind(H.flow_page(F.col("html")), lambda p: H.blocks(p, ["card"])), H.visible))
    assert cards[:2] == [None, []] and cards[3:] == [[], ["ab"]]
    assert cards[2] == []  # deeper than the levels, so it is text of what is around it
    rows = values(spark, pages, F.size(E.bind(H.table_page(F.col("html")), H.table_rows)))
    assert rows[3] == 3000 and rows[1:3] == [0, 0]
