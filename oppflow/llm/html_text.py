"""Main text of a page by composite text density.

A page is cut into tags and text once and built into a tree.  For every node the characters, tags,
characters of links and link tags below it are counted.  Its density is characters per tag, adjusted
for links: ``c / t * log_b(c / lc * t / lt)`` with a base ``b`` that grows with the share of link text of node and body,
so lists of links fall and running text stays.  The density sum of a node adds up
the densities of its children.  The densest node sets the path to the body; the smallest density on that path is
the threshold.  Of the nodes that reach it, the one with the largest density sum is the content.

What is no text at all (scripts, styles, templates, comments) and what pages mark as something other than the
article - by tag, role, or a word of class or id - is taken out of the tree, also if nothing else is left.  A form or a node marked by
class or id that is around the article, or holds most of the text, is only unwrapped; what is marked inside it still goes.

Block tags, line breaks and cells end a block.  Character references are decoded.  White space inside a
block becomes one space; blocks are joined by one space.  Null and empty pages give an empty
text; so do pages without text or with furniture alone.  A quote opens a string only as the first character of an attribute's value.
The time of parsing is linear in the page, whatever its tags; a page is held in memory whole.  Repeated rows are extracted each; other columns are ignored.
"""
import html
import math
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# tags by their part in a page, as the HTML standard has them
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
DROPPED = frozenset(
    "head script style textarea title xmp iframe noembed noframes noscript template svg math canvas object audio video nav header footer aside form button select "
    "option fieldset menu dialog input".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre "
    "section table ul".split())
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
              "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPES = frozenset("ul ol dl table article section main body html div aside nav header footer".split())
# words of class and id that name page furniture
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|banner|breadcrumb|breadcrumbs|comment|comments|commentlist|consent|cookie|cookies|copyright|disqus|footer|"
    r"gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|notices|overlay|pagination|paywall|popup|promo|related|replies|respond|share|sharing|sidebar|"
    r"signup|social|sponsor|sponsored|subscribe|toolbar|widget)(?:$|[\s_-])")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# words that say how a page is laid out, not what a node is: has-sidebar, nav-open
LAYOUT = re.compile(r"(?<!\S)(?:(?:has|with|without|no)[_-]\S+|\S+[_-](?:open|opened|closed|enabled|disabled))(?!\S)")
# furniture that can have more text than the article, or articles of its own
APART = re.compile(r"(?:^|[\s_-])(?:comment|comments|commentlist|consent|cookie|cookies|disqus|gdpr|paywall|popup|related|replies|respond)(?:$|[\s_-])")
PROSE = 40  # characters without spaces from which a marked node can hold an article that the page does not mark
HARD, SECTION, WRAPPER = 3, 2, 1  # marks: never text of the article; a part beside it; furniture, unless it is around the article

NO_BREAK = frozenset("script style template noscript svg math canvas object audio video button select".split())  # inside a word they do not part it

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*\"|'[^']*')|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}


class Node:
    __slots__ = ("tag", "children", "mark", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str):
        self.tag = tag
        self.children: list[Node | str] = []
        self.mark = 0
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def mark_of(tag: str, attributes: str) -> int:
    """0 for what may be text of the article, else the kind of furniture."""
    if tag in DROPPED and tag not in ("form", "fieldset"):
        return HARD
    out = WRAPPER if tag in DROPPED else 0
    if not attributes or tag in ("html", "body", "article", "main"):
        return out
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES and value != "form"):
            return HARD
        if name == "role" and value == "form":
            out = max(out, WRAPPER)
        if name in ("class", "id") and FURNITURE.search(value):
            value = LAYOUT.sub("", value)
            if FURNITURE.search(value):
                out = max(out, SECTION if APART.search(value) else WRAPPER)
    return out


class Open:
    """The open elements and, by tag, where they are, so that no end tag searches through them."""

    def __init__(self, root: Node):
        self.nodes, self.scopes = [root], [0]
        self.places: dict[str, list[int]] = defaultdict(list)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.nodes))
        if node.tag in SCOPES or node.tag == "td":
            self.scopes.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, place: int) -> None:
        while len(self.nodes) > place:
            self.places[self.nodes.pop().tag].pop()
            if self.scopes[-1] == len(self.nodes):
                self.scopes.pop()

    def close(self, tag: str) -> None:
        if self.places[tag]:
            self.cut(self.places[tag][-1])

    def leave(self, tags: tuple[str, ...]) -> None:
        """End open elements that a new one of their kind ends, within the innermost scope."""
        place = max((self.places[t][-1] for t in tags if self.places[t]), default=0)
        if place and place >= self.scopes[-1]:
            self.cut(place)


def parse(page: str) -> Node:
    """The tree of a page; end tags that nothing opened are ignored, open ones end with their parent."""
    root = Node("html")
    opened, at, hidden = Open(root), 0, 0  # hidden: number of open elements below which everything is furniture
    stack = opened.nodes
    while at < len(page):
        lt = page.find("<", at)
        text = page[at: lt if lt >= 0 else len(page)]
        found = _TOKEN.match(page, lt) if lt >= 0 else None
        if lt >= 0 and not found:  # a bare less-than sign is text
            text, at = text + "<", lt + 1
        else:
            at = found.end() if found else len(page)
        if text and not hidden:
            stack[-1].children.append(text)
        if not found or not found[2]:
            continue
        tag, attributes = found[2].lower(), found[3]
        if found[1]:
            opened.close(tag)
        else:
            if tag in CLOSES_P:
                opened.leave(("p",))
            if tag in SAME_LEVEL:
                opened.leave(SAME_LEVEL[tag])
            node = Node(tag)
            if not hidden:
                stack[-1].children.append(node)
            if tag in VOID or (attributes.endswith("/") and tag in ("svg", "math")):
                pass
            else:
                opened.push(node)
                if tag in RAW:
                    end = _RAW_END[tag].search(page, at)
                    body_end = end.start() if end else len(page)
                    if not hidden and tag not in DROPPED:
                        node.children.append(page[at:body_end])
                    at = body_end
                if not hidden:
                    node.mark = mark_of(tag, attributes)
                    if node.mark == HARD:
                        hidden = len(stack)
                        stack[-2].children.pop()
                        stack[-2].children.append(Node("wbr" if tag in NO_BREAK else "hr"))  # dropped blocks still part the text around them
        if hidden and len(stack) < hidden:
            hidden = 0
    take_out(root)
    return root


def take_out(root: Node) -> None:
    """Empty the marked nodes, but for those around the article and those with most of the text."""
    nodes = post_order(root)
    if not any(node.mark for node in nodes):
        return
    # text outside links: all, outside parts beside the article, outside marked nodes, of articles outside such parts, of <main>
    whole, talkless, bare, articles, mains = {}, {}, {}, {}, {}
    for node in nodes:
        key, below = id(node), [c for c in node.children if isinstance(c, Node)]
        own = 0 if node.tag == "a" else sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        whole[key] = 0 if node.tag == "a" else own + sum(whole[id(c)] for c in below)
        talkless[key] = 0 if node.mark == SECTION or node.tag == "a" else own + sum(talkless[id(c)] for c in below)
        bare[key] = 0 if node.mark or node.tag == "a" else own + sum(bare[id(c)] for c in below)
        mains[key] = whole[key] if node.tag == "main" else sum(mains[id(c)] for c in below)
        articles[key] = 0 if node.mark == SECTION and not mains[key] else talkless[key] if node.tag in ("article", "main") else sum(articles[id(c)] for c in below)

    def level(top: Node) -> tuple[list[tuple[Node, Node | None]], list[Node]]:
        """Marked nodes below ``top`` that are in no other, each with the article around it, and the unmarked articles."""
        marked, shown, todo = [], [], [(c, None) for c in top.children if isinstance(c, Node)]
        while todo:
            node, around = todo.pop()
            if node.mark:
                marked.append((node, around))
                continue
            if node.tag in ("article", "main"):
                shown.append(node)
                around = node
            todo.extend((c, around) for c in node.children if isinstance(c, Node))
        return marked, shown

    todo = [(root, root, None)]
    while todo:
        top, page, outer = todo.pop()
        marked, shown = level(top)
        for node, around in marked:
            around = around or outer
            within = around or page
            key, frame = id(node), id(within)
            rival = sum(bare[id(x)] for x in shown if x.tag == "article" and x is not around)
            if node.mark == SECTION:
                keep = mains[key] > 0 and not around
                keep = keep or (articles[key] > rival and 2 * articles[key] > whole[frame] and not around)
            elif articles[key] and not around:
                keep = articles[key] > rival and 2 * articles[key] > bare[id(page)]
            else:
                keep = not rival and 2 * talkless[key] > talkless[frame] and talkless[key] >= PROSE
            if keep:
                node.mark = 0
                todo.append((node, within, around))
            else:
                node.tag, node.children = "hr", []  # still parts the text around it


def post_order(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in node.children if isinstance(c, Node))
    return out[::-1]


def measure(root: Node) -> list[Node]:
    """Count characters and tags below every node, then densities and their sums; children before parents."""
    nodes = post_order(root)
    for node in nodes:
        for child in node.children:
            if isinstance(child, Node):
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
            else:
                node.chars += len("".join(child.split()))
        if node.tag == "a":
            node.link_chars = node.chars
    body_share = root.link_chars / root.chars if root.chars else 0.0
    for node in nodes:
        c, t, lc, lt = node.chars, node.tags or 1, node.link_chars, node.link_tags
        if c:
            base = math.log(c / max(c - lc, 1) * lc + body_share * c + math.e)
            adjust = math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0)) / math.log(base) if base > 1 + 1e-12 else math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0))
            node.density = c / t * adjust
        node.sum = sum(child.density for child in node.children if isinstance(child, Node))
        if not node.sum:
            node.sum = node.density
    return nodes


def content(root: Node) -> Node:
    """The subtree with the largest density sum among nodes that reach the threshold of the densest node's path."""
    nodes = measure(root)
    parents = {id(c): n for n in nodes for c in n.children if isinstance(c, Node)}
    blocks = [n for n in nodes if n.tag not in INLINE]
    densest = max(blocks, key=lambda n: n.density)  # the first of equals in post order
    limit, node = densest.density, densest
    while id(node) in parents:
        node = parents[id(node)]
        limit = min(limit, node.density)
    chosen = max((n for n in blocks if n.density >= limit), key=lambda n: (n.sum, n.chars))
    # a part of what the page itself marks as the article stands for the whole of it
    node, whole = chosen, None
    while True:
        if node.tag in ("article", "main") and (whole is None or node.tag == "article" or whole.tag == "main"):
            whole = node
        if id(node) not in parents:
            return whole or chosen
        node = parents[id(node)]


def blocks_of(node: Node) -> list[str]:
    """Texts of the blocks in page order."""
    out: list[list[str]] = [[]]
    todo: list[Node | str | None] = [node]
    while todo:
        item = todo.pop()
        if item is None:
            out.append([])
        elif isinstance(item, str):
            out[-1].append(item)
        else:
            outer = item.tag not in INLINE
            if outer:
                out.append([])
                todo.append(None)
            todo.extend(reversed(item.children))
    texts = (" ".join(html.unescape("".join(parts)).split()) for parts in out)
    return [t for t in texts if t]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return " ".join(blocks_of(content(parse(page))))


@F.pandas_udf(T.StringType())
def main_texts(pages: pd.Series) -> pd.Series:
    return pd.Series([main_text(p) if isinstance(p, str) else "" for p in pages], dtype=object)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: key, url, text, n_chars."""
    rows = pages.select(F.col(key).alias(key), F.col(url).alias(url), main_texts(F.col(page).cast("string")).alias("text"))
    return rows.select(key, url, "text", F.length("text").cast("long").alias("n_chars"))
