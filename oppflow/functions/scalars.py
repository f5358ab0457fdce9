"""Small rules on single values: dates, money, ids, links, lists."""
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from oppflow.functions.text import strip

# --- fixed values: what counts as a date or an amount ---------------------
DATE_LIKE = r"\d{1,2}[/-]\d{1,2}[/-]\d{2,4}"
DOLLARS = r"\$[\d,.]+"
NUMBER_ONLY = r"^[\d,.]+$"
# --- fixed values: where a URL carries an id, in order of preference ------
URL_ID_PATTERNS = [
    r"[Ii]d=([\p{L}\p{N}_]+)", r"bid[Ii]d=([\p{L}\p{N}_]+)",
    r"solicitation[Ii]d=([\p{L}\p{N}_]+)", r"doc[Ii]d=([\p{L}\p{N}_]+)",
    r"number=([\p{L}\p{N}_]+)",
]
DEFAULT_PAGES = ["default.aspx", "index.html"]


def contains_any(text: Column, fragments: list[str]) -> Column:
    """True where ``text`` holds one of the literal fragments."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(f)) for f in fragments], F.lit(False))


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null, empty nor a number equal to zero, however it is written.

    Payload leaves are read as text, so a zero sent as text counts as zero too.
    """
    zero = [F.coalesce(c.try_cast("double") == 0, F.lit(False)) for c in columns]
    return F.coalesce(*[F.when((c != "") & ~z, c) for c, z in zip(columns, zero, strict=True)], F.lit(""))


def first_nonempty(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in columns], F.lit(""))


def looks_like_date(text: Column) -> Column:
    return text.rlike(DATE_LIKE)


def looks_like_amount(text: Column) -> Column:
    bare = strip(text)
    return text.rlike(DOLLARS) | (bare.rlike(NUMBER_ONLY) & (F.length(bare) > 3))


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def id_from_url(url: Column) -> Column:
    """An id parameter, else the last path segment unless it is a default page."""
    segment = F.split_part(last_segment(url), F.lit("?"), F.lit(1))
    named = [blank_to_null(F.regexp_extract(url, p, 1)) for p in URL_ID_PATTERNS]
    return F.coalesce(*named, F.when(~segment.isin(DEFAULT_PAGES), segment), F.lit(""))


def bid_id_from_url(url: Column) -> Column:
    """``bidId=`` digits, else the last path segment with its query."""
    return F.coalesce(blank_to_null(F.regexp_extract(url, r"bidId=(\d+)", 1)), last_segment(url), F.lit(""))


def event_id_from_url(url: Column) -> Column:
    return F.coalesce(
        blank_to_null(F.regexp_extract(url, r"[Ee]vent[Ii]d=(\d+)", 1)),
        blank_to_null(F.regexp_extract(url, r"docId=(\d+)", 1)),
        F.lit(""),
    )


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against the page it was found on."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.concat(host, F.coalesce(
        blank_to_null(F.regexp_extract(page, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*(/.*/|/)", 1)), F.lit("/")
    ))
    return (
        F.when(F.coalesce(href, F.lit("")) == "", "")
        .when(href.startswith("http") | href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(host, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
        .otherwise(_collapse_dots(F.concat(folder, href)))
    )


def _collapse_dots(url: Column) -> Column:
    """``./`` goes away and ``x/../`` cancels out, segment by segment."""
    host = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    tail = F.regexp_extract(url, r"([?#].*)?$", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*([^?#]*)", 1)
    kept = F.aggregate(
        F.split(F.substr(path, F.lit(2)), "/"),
        F.expr("cast(array() as array<string>)"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.when(
        path.rlike(r"(^|/)\.{1,2}(/|$)"), F.concat(host, F.lit("/"), F.array_join(kept, "/"), tail)
    ).otherwise(url)


def parse_money(text: Column) -> Column:
    """Dollar text as a double; what is not a number counts as zero."""
    bare = strip(F.regexp_replace(text, r"[$,]", ""))
    number = bare.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.coalesce(F.when(number, bare.try_cast("double")), F.lit(0.0))


def show_money(value: Column) -> Column:
    """Billions, millions, thousands or plain; a dash when there is nothing."""
    def scaled(size: float, places: int, unit: str) -> Column:
        part = value / F.lit(size)
        # format_number rounds the binary value half-even; an exact tie goes up here
        tie = (part * F.lit(4 if places else 2)) % 2 == 1
        part = F.when(tie, part + F.lit(0.01 if places else 0.1)).otherwise(part)
        return F.concat(F.lit("$"), F.replace(F.format_number(part, places), F.lit(","), F.lit("")), F.lit(unit))

    plain = F.regexp_replace(F.format_number(value, 3), r"\.?0+$", "")
    return (
        F.when(F.coalesce(value, F.lit(0.0)) == 0, "—")
        .when(value >= 1e9, scaled(1e9, 1, "B"))
        .when(value >= 1e6, scaled(1e6, 1, "M"))
        .when(value >= 1e3, scaled(1e3, 0, "K"))
        .otherwise(F.concat(F.lit("$"), plain))
    )


def parse_list(raw: Column) -> Column:
    """Comma- or newline-separated entries, trimmed and lower-cased; comma wins."""
    raw = F.coalesce(raw, F.lit(""))
    parts = F.when(F.contains(raw, F.lit(",")), F.split(raw, ",")).otherwise(F.split(raw, "\n"))
    return F.filter(F.transform(parts, lambda p: F.lower(strip(p))), lambda p: p != "")


def source_badge(total: Column, matches: Column) -> Column:
    return F.when(total == 0, "No Data").when(matches > 0, "Active").otherwise("No Matches")


def place(city: Column, state: Column) -> Column:
    """``City, ST``, or only the state where the city is missing."""
    state = F.coalesce(state, F.lit(""))
    return F.when(F.coalesce(city, F.lit("")) != "", F.concat(city, F.lit(", "), state)).otherwise(state)
