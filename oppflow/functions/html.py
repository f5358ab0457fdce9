"""Cutting captured pages into rows, links, cards and labelled fields.

Pages stay in their row: a page is cut into arrays and the arrays are worked on where they are, so no step
here shuffles.  What depends on nesting - rows, cells, cards, classed fields - is read from a page that
``elements.marked`` has gone through; links and labels are read from any fragment.
"""
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from oppflow.functions import elements as E
from oppflow.functions.text import bind, strip

_REFERENCE = r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
# named references as the HTML standard has them, from the table of the Python library; a space for the hard one
_NAMED = "\x1e".join(f"{n}\x1f{' ' if n == 'nbsp' else chr(c)}" for n, c in [*name2codepoint.items(), ("apos", 39)])
LINK_SCHEMA = "array<struct<href:string,text:string>>"
_TARGET = r"""\bhref\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
_BLOCK_TAGS = r"(?i)</?(?:br|p|div|li|ul|ol|dl|dt|dd|tr|td|th|table|h[1-6]|hr|section|article|header|footer|blockquote|pre)\b[^>]*>"


def _character(reference: Column) -> Column:
    """What one character reference stands for; itself where that is nothing."""
    name = F.regexp_replace(reference, "[&;]", "")
    code = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10).cast("int")).when(
        name.startswith("#"), F.substring(name, 2, 7).cast("int"))
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    coded = F.when(code == 160, " ").when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    named = F.try_element_at(F.str_to_map(F.lit(_NAMED), F.lit("\x1e"), F.lit("\x1f")), name)
    return F.coalesce(coded, named, reference)


def decode(text: Column) -> Column:
    """All character references, in one pass."""
    def decoded(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(_REFERENCE), F.lit(0)), _character)
        pieces = F.zip_with(F.split(t, _REFERENCE, -1), F.concat(found, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
        return F.when(F.contains(t, F.lit("&")), F.array_join(pieces, "")).otherwise(t)
    return bind(text, decoded)


def markup(html: Column) -> Column:
    """A page without what no reader sees: comments, scripts, styles; and without characters that the marks use."""
    return F.regexp_replace(html, rf"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|{E.MARKS}", "")


def visible(html: Column) -> Column:
    """What a reader sees of a fragment: no tags, one space between words and around blocks."""
    def read(text: Column) -> Column:
        tagged = F.regexp_replace(F.regexp_replace(text, _BLOCK_TAGS, " "), rf"(?s)<[^>]*>|{E.MARKS}", "")
        bare = decode(F.when(F.contains(text, F.lit("<")), tagged).otherwise(F.regexp_replace(text, E.MARKS, "")))
        return strip(F.regexp_replace(bare, r"[\s\p{Z}]+", " "))

    # a cell or link without markup and doubtful characters is what it shows
    return bind(html, lambda text: F.when(text.rlike(r"[^\x21-\x25\x27-\x3B\x3D-\x7E\x20]|^ |  | $"), read(text)).otherwise(text))


def joined_text(html: Column) -> Column:
    """Text of a fragment with every piece trimmed and put side by side."""
    return strip(decode(F.regexp_replace(html, rf"(?s)(?:\s|{E.MARKS})*+<[^>]*>(?:\s|{E.MARKS})*+|{E.MARKS}", "")))


def table_page(html: Column) -> Column:
    """A page marked for its tables alone."""
    return E.marked(markup(html), E.TABLE_TAGS)


def flow_page(html: Column) -> Column:
    """A page marked for tables, blocks, lists and inline elements."""
    return E.marked(markup(html), E.FLOW_TAGS)


def table_rows(page: Column) -> Column:
    """Body rows of all tables, those inside cells too."""
    body = F.when(page.rlike("(?i)<t(?:head|foot)"), F.regexp_replace(page, E.PLAIN_HEAD, "")).otherwise(page)
    return F.when(E.has_marks(page), E.body_rows(page)).otherwise(
        F.regexp_extract_all(body, F.lit(E.PLAIN_ROW), F.lit(2)))


def tables(page: Column, starts: str = E.tag("table")) -> Column:
    """The tables that begin so and are in no other of them, their own tags left out."""
    plain = F.filter(F.regexp_extract_all(page, F.lit(E.PLAIN_TABLE), F.lit(0)), lambda t: t.rlike(f"^<(?:{starts})"))
    return F.when(E.has_marks(page), E.outermost(page, starts)).otherwise(
        F.transform(plain, lambda t: F.regexp_extract(t, E.PLAIN_TABLE, 2)))


def rows_of(page: Column, starts: str) -> Column:
    """Body rows of the tables that begin so, and of what is nested in them."""
    return F.flatten(F.transform(tables(page, starts), table_rows))


def all_rows(table: Column) -> Column:
    """Rows of a table, those of its head too."""
    return F.when(E.has_marks(table), E.elements(table, E.tag("tr"))).otherwise(F.regexp_extract_all(table, F.lit(E.PLAIN_ROW), F.lit(2)))


def row_cells(row: Column) -> Column:
    cells = F.when(E.has_marks(row), E.elements(row, E.tag("td"))).otherwise(F.regexp_extract_all(row, F.lit(E.PLAIN_CELL), F.lit(2)))
    return F.transform(cells, visible)


def links(html: Column) -> Column:
    """Every anchor with a target, as array<struct<href, text>> in page order."""
    anchors = F.regexp_extract_all(
        html, F.lit(rf"(?is)<a\b[^>]*?{_TARGET}[^>]*>.*?</a\s*>"), F.lit(0)
    )

    def target(a: Column) -> Column:
        given = F.regexp_extract(a, rf"(?is)^<a\b[^>]*?({_TARGET})", 1)
        return decode(F.regexp_replace(given, r"""(?is)^href\s*=\s*["']?|["']$""", ""))
    return F.transform(anchors, lambda a: F.struct(target(a).alias("href"), visible(a).alias("text")))


def first_link(html: Column) -> Column:
    """The first anchor of a fragment; null where there is none."""
    return F.get(links(html), 0)


def first_by_href(found: Column) -> Column:
    """First link of every target, in page order; sorts instead of comparing all pairs."""
    tagged = F.transform(found, lambda x, i: F.struct(x["href"].alias("href"), i.alias("i"), x["text"].alias("text")))
    kept = bind(
        F.sort_array(tagged),
        lambda s: F.filter(s, lambda x, i: (i == 0) | (x["href"] != F.coalesce(F.get(s, i - 1)["href"], F.lit("\u0000")))),
    )
    in_order = F.sort_array(
        F.transform(kept, lambda x: F.struct(x["i"].alias("i"), x["href"].alias("href"), x["text"].alias("text")))
    )
    return F.transform(in_order, lambda x: F.struct(x["href"].alias("href"), x["text"].alias("text")))


def blocks(page: Column, classes: list[str], tags: list[str] = (), partial: bool = False) -> Column:
    """Elements of one of the classes, or one of the tags, with what is in them."""
    return E.elements(page, "|".join([E.classed(classes, partial), *([E.tag(*tags)] if tags else [])]))


def element_text(page: Column, tags: list[str] = (), classes: list[str] = (), partial: bool = False) -> Column:
    """Visible text of the first element with one of the tags or classes, else ''."""
    starts = ([E.tag(*tags)] if tags else []) + ([E.classed(classes, partial)] if classes else [])
    return visible(E.first_element(page, "|".join(starts)))


def paragraphs(html: Column) -> Column:
    """Innermost blocks with their bold parts, as array<struct<names, text>>; names are lower case."""
    bold = F.lit(r"(?is)<strong\b[^>]*>(.*?)</strong\s*>")
    return F.transform(
        F.regexp_extract_all(html, F.lit(r"(?is)<(p|div|li|td|dd)\b[^>]*>((?:(?!</?(?:p|div|li|td|dd)\b).)*+)</\1\s*>"), F.lit(2)),
        lambda p: F.struct(
            F.transform(F.regexp_extract_all(p, bold, F.lit(1)), lambda b: F.lower(joined_text(b))).alias("names"),
            joined_text(p).alias("text"),
        ),
    )


def labelled(parts: Column, label: str) -> Column:
    """``Label: value`` of the first paragraph whose bold text names the label."""
    named = F.filter(
        parts, lambda p: F.exists(p["names"], lambda b: F.contains(b, F.lit(label.lower())))
    )
    value = F.regexp_extract(F.get(named, 0)["text"], rf"(?is)\Q{label}\E[: ]*(.*)$", 1)
    return F.coalesce(strip(value), F.lit(""))
