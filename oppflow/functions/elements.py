"""Elements of a page by tag depth.

``marked`` folds a page's structural tags with a stack of open elements, once, and writes what it finds into the
page: before an element's tag stands a character for its kind and one for its level, after its last character the level
again.  A missing end tag ends with what ends it in a browser (a row with the next row, an item with the next
item, a paragraph with the next block, everything with its parent), and an end tag that nothing opened changes nothing.  So
an element is what lies between two equal level characters, however often its kind is nested in it, and plain
patterns find it.  Everything stays in the page's row, and the time is linear in the page but for the stack's few characters.

Tags deeper than ``LEVELS`` are left as text of the element around them; so are rows and cells outside a table.
"""
from pyspark.sql import Column
from pyspark.sql import functions as F

from oppflow.functions.text import bind

TABLE_TAGS = ["table", "thead", "tbody", "tfoot", "tr", "td", "th"]
FLOW_TAGS = TABLE_TAGS + [
    "ul", "ol", "li", "dl", "dt", "dd", "p", "div", "section", "article", "main", "aside", "nav", "header", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "span", "a", "strong", "b", "em", "i", "small", "label"]
_BLOCKS = FLOW_TAGS[: FLOW_TAGS.index("span")]
LEVELS = 250
CHUNK = 256  # tags folded into one text before the texts are put side by side

# kinds and levels are characters of the private use area, which are taken out of the page first
_KIND = {tag: chr(0xF000 + i) for i, tag in enumerate(FLOW_TAGS)}
_LEVEL = [chr(0xE000 + i) for i in range(LEVELS)]
KINDS, MARKS = "[\uF000-\uF0FF]", "[\uE000-\uF0FF]"
_END = rf"(?<!{KINDS})\1"


def _kinds(*tags: str) -> str:
    return "".join(_KIND[t] for t in tags)


# what a start tag ends, as patterns over the stack: an element of these kinds and all in it, but nothing outside these scopes
_IMPLIED = [
    (["td", "th"], rf"[{_kinds('td', 'th')}][^{_kinds('tr', 'table')}]*$"),
    (["tr"], rf"{_kinds('tr')}[^{_kinds('table')}]*$"),
    (["thead", "tbody", "tfoot"], rf"[^{_kinds('table')}]*$"),
    (["li"], rf"{_kinds('li')}[^{_kinds('ul', 'ol', 'table')}]*$"),
    (["dt", "dd"], rf"[{_kinds('dt', 'dd')}][^{_kinds('dl', 'table')}]*$"),
]
_HEAD_ROW = "\uF0FF"  # written for a row of a head or foot; on the stack it is a row
_IN_HEAD = rf"[{_kinds('thead', 'tfoot')}][^{_kinds('table')}]*$"
_P = rf"{_kinds('p')}[^{_kinds('table')}]*$"


def _tokens(html: Column, tags: list[str]) -> Column:
    """array<struct<kind, is_end, piece>>: a page cut before every structural tag."""
    names = "|".join(sorted(tags, key=len, reverse=True))
    pieces = F.split(html, rf"(?i)(?=</?(?:{names})(?![\w-]))", -1)
    name = lambda p: F.lower(F.regexp_extract(p, rf"(?i)^</?({names})(?![\w-])", 1))
    # the kind by the place of the name; '' before the first tag
    kinds = F.lit("".join(_KIND[t] for t in tags))
    place = lambda p: F.find_in_set(name(p), F.lit(",".join(tags)))
    return F.transform(pieces, lambda p: bind(
        place(p), lambda i: F.struct(F.when(i > 0, F.substring(kinds, i, 1)).otherwise("").alias("kind"), p.startswith("</").alias("is_end"), p.alias("piece"))))


def _step(stack: Column, x: Column, tags: list[str]) -> Column:
    """struct<stack, text>: the stack after a tag and what is written for it."""
    kind, table = x["kind"], _KIND["table"]
    parts = _kinds(*TABLE_TAGS[1:])
    part = F.contains(F.lit(parts), kind)
    after = F.call_function("substring_index", stack, kind, F.lit(-1))  # what is open inside the last element of the kind
    found = F.contains(stack, kind)
    closes = found & ~(part & F.contains(after, F.lit(table)))
    ended = F.when(closes, F.left(stack, F.length(stack) - F.length(after) - 1)).otherwise(stack)

    begun = [F.when(F.contains(F.lit(_kinds(*of)), kind), F.regexp_replace(stack, pattern, "")) for of, pattern in _IMPLIED if of[0] in tags]
    if "p" in tags:
        others = _kinds(*(t for t in _BLOCKS if not any(t in of for of, _ in _IMPLIED)))
        begun.append(F.when(F.contains(F.lit(others), kind), F.regexp_replace(stack, _P, "")))
    begun = F.coalesce(*begun, stack)

    plain = (kind == "") | (~x["is_end"] & ((F.length(stack) >= LEVELS - 1) | (part & ~F.contains(stack, F.lit(table)))))

    def written(keep: Column) -> Column:
        ends = ended_levels(F.length(stack), F.length(keep))
        head_row = (kind == _KIND["tr"]) & keep.rlike(_IN_HEAD)
        opened = F.concat(F.when(head_row, F.lit(_HEAD_ROW)).otherwise(kind), F.substring(F.lit("".join(_LEVEL)), F.length(keep) + 1, F.lit(1)))
        return F.when(x["is_end"], F.struct(keep.alias("stack"), F.concat(ends, x["piece"]).alias("text"))).otherwise(
            F.struct(F.concat(keep, kind).alias("stack"), F.concat(ends, opened, x["piece"]).alias("text")))

    return F.when(plain, F.struct(stack.alias("stack"), x["piece"].alias("text"))).otherwise(
        bind(F.when(x["is_end"], ended).otherwise(begun), written))


def ended_levels(high: Column, low: Column) -> Column:
    """The level characters from ``high`` elements down to ``low``, innermost first."""
    falling = F.lit("".join(reversed(_LEVEL)))
    return F.substring(falling, LEVELS - high + 1, high - low)


_NESTED = r"(?i)<table(?![\w-])[^<]*+(?:<(?!/?table(?![\w-]))[^<]*+)*+<table(?![\w-])"
_STRAY = r"(?i)(?:^|</table(?![\w-]))[^<]*+(?:<(?!table(?![\w-])|t[rdh](?![\w-]))[^<]*+)*+<t[rdh](?![\w-])"


def _uneven(page: Column) -> Column:
    """A table inside a table, or a row or cell outside tables."""
    return (page.rlike("(?is)<table.*<table") & page.rlike(_NESTED)) | page.rlike(_STRAY)


def _until(start: str, *ends: str) -> str:
    """What follows a tag up to one of the tags ``ends``, as the second group; the tag is the first."""
    return rf"(?i)(<(?:{start})(?![\w-])[^>]*+>?)([^<]*+(?:<(?!(?:{'|'.join(ends)})(?![\w-]))[^<]*+)*+)"


# elements of pages whose tables hold no tables: an element ends with the next tag that can end it
PLAIN_TABLE = _until("table", "/table")
PLAIN_HEAD = _until("thead|tfoot", "/table", "/thead", "/tfoot", "tbody", "thead", "tfoot")
PLAIN_ROW = _until("tr", "/?table", "/?tbody", "/?thead", "/?tfoot", "/?tr")
PLAIN_CELL = _until("td", "/?table", "/?tbody", "/?thead", "/?tfoot", "/?tr", "/?td", "th")


def marked(html: Column, tags: list[str]) -> Column:
    """The page with kinds and levels written into it.

    Where only tables are asked for, a page without a table inside a table is left as it is, as its rows and cells end
    with the next one: ``has_marks`` says which it is, and the table functions of ``html`` read both.  (In such a page, a
    section's end tag ends a row also if the section was never begun.)
    """
    if tags != TABLE_TAGS:
        return folded(html, tags)
    return bind(html, lambda page: F.when(_uneven(page), folded(page, tags)).otherwise(page))


def has_marks(page: Column) -> Column:
    """Whether a page, or a fragment of one, has elements that the fold has marked."""
    return page.rlike(MARKS)


def folded(html: Column, tags: list[str]) -> Column:
    """``marked`` by the fold over the page's tags."""
    state = F.struct(F.lit("").alias("stack"), F.lit("").alias("text"))

    def add(done: Column, x: Column) -> Column:
        return bind(_step(done["stack"], x, tags), lambda now: F.struct(now["stack"].alias("stack"), F.concat(done["text"], now["text"]).alias("text")))

    def fold(tokens: Column) -> Column:
        def chunk(done: Column, at: Column) -> Column:
            start = F.struct(done["stack"].alias("stack"), F.lit("").alias("text"))
            return bind(F.aggregate(F.slice(tokens, at, F.lit(CHUNK)), start, add),
                        lambda now: F.struct(now["stack"].alias("stack"), F.concat(done["texts"], F.array(now["text"])).alias("texts")))

        short = F.aggregate(tokens, state, add, lambda done: F.concat(done["text"], ended_levels(F.length(done["stack"]), F.lit(0))))
        empty = F.struct(F.lit("").alias("stack"), F.array().cast("array<string>").alias("texts"))
        long = F.aggregate(F.sequence(F.lit(1), F.size(tokens), F.lit(CHUNK)), empty, chunk,
                           lambda done: F.concat(F.array_join(done["texts"], ""), ended_levels(F.length(done["stack"]), F.lit(0))))
        return F.when(F.size(tokens) <= CHUNK, short).otherwise(long)

    # a level that no element has says that the page was folded, also if nothing in it is an element
    return F.concat(F.lit(_LEVEL[-1]), bind(_tokens(html, tags), fold))


def _opening(starts: str) -> str:
    """The start of an element whose tag begins as the pattern ``starts`` says: kind, level (the first group) and the tag."""
    return rf"(?s){KINDS}(.)<(?=(?:{starts}))[^>]*+>?"


def elements(page: Column, starts: str) -> Column:
    """What is in every element whose tag begins so, those inside others too, as array<string> in page order."""
    return F.regexp_extract_all(page, F.lit(rf"{_opening(starts)}(?=(.*?){_END})"), F.lit(2))


def body_rows(page: Column) -> Column:
    """What is in every table row that is not in the head or foot of its own table."""
    return F.regexp_extract_all(page, F.lit(rf"(?s){_KIND['tr']}(.)<[^>]*+>?(?=(.*?){_END})"), F.lit(2))


def outermost(page: Column, starts: str) -> Column:
    """Such elements that are in no other of them."""
    return F.regexp_extract_all(page, F.lit(rf"{_opening(starts)}(.*?){_END}"), F.lit(2))


def first_element(page: Column, starts: str) -> Column:
    """The first such element, or ''."""
    return F.regexp_extract(page, rf"{_opening(starts)}(.*?){_END}", 2)


def tag(*names: str) -> str:
    """A tag of one of the names, as a pattern for ``starts``."""
    return rf"(?i:{'|'.join(names)})(?![\w-])"


def classed(names: list[str], partial: bool = False, of: str = r"\w+") -> str:
    """A tag with one of the classes, or with a class that holds one of the texts."""
    wanted = "|".join(names)
    quoted = rf"""["'][^"']*(?:{wanted})""" if partial else rf"""["'](?:[^"']*\s)?(?:{wanted})(?=[\s"'])"""
    bare = rf"[^\s\"'>]*(?:{wanted})" if partial else rf"(?:{wanted})(?=[\s>])"
    return rf"{of}(?=[^>]*\s(?i:class)\s*=\s*(?:{quoted}|{bare}))"


def identified(name: str, of: str = r"\w+") -> str:
    return rf"""{of}(?=[^>]*\s(?i:id)\s*=\s*["']?{name}(?=["'\s>]))"""
