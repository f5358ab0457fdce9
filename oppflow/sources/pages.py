"""Captured portal pages -> raw records.

Input is ``(page_id, url, html)`` with ``state`` and ``label`` of the portal, which ``with_portal`` looks
up by the page's address.  Every source turns a page into an
array of record structs in its own row and explodes it last.
"""
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oppflow.fixed_values import (
    BUYSPEED_NOISE, NAVIGATION_WORDS, PORTAL_LINK_FRAGMENTS, PORTALS, STATES,
)
from oppflow.functions import elements as E
from oppflow.functions import html as H
from oppflow.functions.scalars import (
    absolute_url, bid_id_from_url, blank_to_null, contains_any, event_id_from_url, first_nonempty, id_from_url,
    last_segment, looks_like_amount, looks_like_date, DATE_LIKE, DOLLARS,
)
from oppflow.functions.text import bind, strip
from oppflow.schema import raw_record

ORDER = ["page_id", "page_ord", "item_ord"]
_FIELDS = ["id", "title", "agency", "status", "posted_date", "close_date", "url", "description", "amount"]
RECORDS = "array<struct<" + ",".join(f"{f}:string" for f in _FIELDS) + ">>"


def portals(spark: SparkSession) -> DataFrame:
    """Platform, state, label and start page of the known portals (48 rows)."""
    return spark.createDataFrame(PORTALS, "platform string, state string, label string, base string")


def _address(url: Column) -> Column:
    """struct<host, pieces>: lower-case host and the pieces of the path."""
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    pieces = F.filter(F.split(bare, "/"), lambda x: x != "")
    return F.struct(F.lower(F.get(pieces, 0)).alias("host"), F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))).alias("pieces"))


def with_portal(pages: DataFrame, known: DataFrame) -> DataFrame:
    """The pages of known portals with ``platform``, ``state`` and ``label``; pages of other hosts go.

    Of the portals on a page's host, the one whose start page shares the most leading pieces of the path; then one whose
    whole address, query included, begins the page's; then the one with fewer pieces of its own, then by label.
    """
    portal = F.struct("platform", "state", "label", "base", F.col("a.pieces").alias("pieces"))
    # a host's portals are a row, looked up by every page in its own row; the portals are a short fixed list
    hosts = known.withColumn("a", _address(F.col("base"))).groupBy(F.col("a.host").alias("portal_host")).agg(F.collect_list(portal).alias("portals"))
    placed = pages.withColumn("page_address", _address(F.col("url"))).join(
        F.broadcast(hosts), F.col("page_address.host") == F.col("portal_host"))

    def shared(own: Column) -> Column:
        same = F.zip_with(own, F.col("page_address.pieces"), lambda a, b: F.coalesce(a == b, F.lit(False)))
        return F.array_position(F.concat(same, F.array(F.lit(False))), False) - 1

    ranked = F.sort_array(F.transform("portals", lambda p: F.struct(
        (-shared(p["pieces"])).alias("shared"), (~F.startswith(F.col("url"), p["base"])).alias("other"), F.size(p["pieces"]).alias("n"), p["label"].alias("label"), p["platform"].alias("platform"), p["state"].alias("state"))))
    best = placed.withColumn("portal_found", F.get(ranked, 0)).drop("page_address", "portal_host", "portals")
    return best.select(*pages.columns, "portal_found.platform", "portal_found.state", "portal_found.label")


def slugs(spark: SparkSession) -> DataFrame:
    """State slug as used in aggregator URLs -> state code (50 rows)."""
    rows = [(name.lower().replace(" ", "-"), code) for code, name, _ in STATES]
    return spark.createDataFrame(rows, "slug string, state string")


def _record(**fields: Column) -> Column:
    return F.struct(*[F.coalesce(fields.get(f, F.lit("")), F.lit("")).alias(f) for f in _FIELDS])


def _none() -> Column:
    return F.expr(f"cast(array() as {RECORDS})")


def _explode(pages: DataFrame, records: Column, state: Column, source: Column) -> DataFrame:
    # captures that share a page_id are told apart by address and content
    place = F.concat_ws("/", F.coalesce("url", F.lit("")), F.hex(F.xxhash64("html")))
    rows = pages.select(
        "page_id", place.alias("page_ord"), state.alias("state"), source.alias("source"),
        F.posexplode(records).alias("item_ord", "r"),
    )
    return raw_record(
        rows, ORDER, state=F.col("state"), source=F.col("source"), **{f: F.col(f"r.{f}") for f in _FIELDS}
    )


def _tables(build) -> Column:
    """What ``build`` makes of the page marked for tables; marked once, however often it is read."""
    return bind(H.table_page(F.col("html")), build)


def _flow(build) -> Column:
    return bind(H.flow_page(F.col("html")), build)


def _plain(build) -> Column:
    return bind(H.markup(F.col("html")), build)


def _first_filled(*lists: Column) -> Column:
    """The first list that is not empty, else the last; later ones are only made if earlier ones are empty."""
    if len(lists) == 1:
        return lists[0]
    return bind(lists[0], lambda found: F.when(F.size(found) > 0, found).otherwise(_first_filled(*lists[1:])))


def _portal(pages: DataFrame, records: Column) -> DataFrame:
    return _explode(pages, records, F.col("state"), F.col("label"))


def _dates(cells: Column) -> Column:
    return F.filter(cells, lambda c: c.rlike(DATE_LIKE))


def _posted(dates: Column) -> Column:
    return F.when(F.size(dates) > 1, F.get(dates, 0)).otherwise("")


def _closes(dates: Column) -> Column:
    return F.coalesce(F.get(F.reverse(dates), 0), F.lit(""))


# ---------------------------------------------------------- generic portals
def row_record(row: Column, base: Column) -> Column:
    """A table row of unknown layout; null when it is no record."""

    def build(cells: Column, link: Column) -> Column:
        href = F.coalesce(link["href"], F.lit(""))
        longest = F.array_max(
            F.transform(cells, lambda c, i: F.struct(F.length(c).alias("n"), (-i).alias("i"), c.alias("c")))
        )["c"]
        title = first_nonempty(link["text"], longest)

        def with_title(t: Column) -> Column:
            short = F.filter(cells, lambda c: (c != "") & (F.length(c) < 30) & (c != t))
            ident = F.coalesce(F.get(short, 0), F.when(href != "", id_from_url(href)), F.lit(""))

            def with_id(i: Column) -> Column:
                owner = F.filter(
                    cells,
                    lambda c: (F.length(c) > 3) & (c != t) & (c != i) & ~looks_like_date(c),
                )
                return bind(
                    _dates(cells),
                    lambda d: _record(
                        id=i, title=t, agency=F.get(owner, 0), status=F.lit("Open"),
                        posted_date=_posted(d), close_date=_closes(d),
                        url=absolute_url(base, href), description=t,
                        amount=F.get(F.filter(cells, lambda c: c.rlike(DOLLARS)), 0),
                    ),
                )

            return F.when((F.size(cells) >= 2) & (F.length(t) >= 5), bind(ident, with_id))

        return bind(title, with_title)

    return bind(H.row_cells(row), lambda cells: bind(H.first_link(row), lambda link: build(cells, link)))


def _table_records(base: Column) -> Column:
    found = _tables(lambda page: F.transform(H.table_rows(page), lambda row: row_record(row, base)))
    return F.filter(found, lambda r: r.isNotNull())


def listed_links(html: Column, fragments: list[str] = PORTAL_LINK_FRAGMENTS) -> Column:
    """Links to records: right target, a real text, the first of each target."""
    wanted = F.filter(
        H.links(html),
        lambda x: contains_any(x["href"], fragments)
        & (F.length(x["text"]) >= 10),
    )
    return F.filter(H.first_by_href(wanted), lambda x: ~F.lower(x["text"]).isin(NAVIGATION_WORDS))


def _link_records(base: Column, fragments: list[str]) -> Column:
    return F.transform(
        _plain(lambda html: listed_links(html, fragments)),
        lambda x: _record(
            id=id_from_url(x["href"]), title=x["text"], status=F.lit("Open"),
            url=absolute_url(base, x["href"]), description=x["text"],
        ),
    )


# --- fixed values: elements that hold one record on card-style pages -------
CARD_CLASSES = ["card", "list-item", "solicitation-item", "bid-item", "opportunity-card", "result-item"]


def card_title(card: Column) -> Column:
    return first_nonempty(
        H.element_text(card, ["h[234]", "a"], ["title"]), H.element_text(card, ["strong", "b"])
    )


def _card_records(base: Column) -> Column:
    cards = F.transform(
        _flow(lambda page: H.blocks(page, CARD_CLASSES, ["article"])),
        lambda card: bind(
            F.struct(card_title(card).alias("title"), H.first_link(card)["href"].alias("href")),
            lambda x: _record(
                id=F.when(F.coalesce(x["href"], F.lit("")) != "", id_from_url(x["href"])),
                title=x["title"], status=F.lit("Open"), url=absolute_url(base, x["href"]),
                description=x["title"],
            ),
        ),
    )
    return F.filter(cards, lambda r: F.length(r["title"]) >= 10)


def portal_tables(pages: DataFrame) -> DataFrame:
    return _portal(pages, _table_records(F.col("url")))


def portal_links(pages: DataFrame, fragments: list[str] = PORTAL_LINK_FRAGMENTS) -> DataFrame:
    return _portal(pages, _link_records(F.col("url"), fragments))


def portal_cards(pages: DataFrame) -> DataFrame:
    return _portal(pages, _card_records(F.col("url")))


def state_portals(pages: DataFrame, fragments: list[str] = PORTAL_LINK_FRAGMENTS) -> DataFrame:
    """Tables where a page has usable ones, else links, else cards, decided per page."""
    base = F.col("url")
    return _portal(pages, _first_filled(_table_records(base), _link_records(base, fragments), _card_records(base)))


# ------------------------------------------------------------ shared platforms
def _platform_row(row: Column, base: Column, buyspeed: bool) -> Column:
    """A row of a known platform: id, title, then agency, dates and amount columns."""

    def build(cells: Column, link: Column) -> Column:
        href = F.coalesce(link["href"], F.lit(""))
        from_url = bid_id_from_url(href) if buyspeed else event_id_from_url(href)
        ident = first_nonempty(F.get(cells, 0), F.when(href != "", from_url))
        title = first_nonempty(link["text"], F.get(cells, 1), ident if buyspeed else F.lit(""))
        rest = F.slice(cells, F.lit(3), F.greatest(F.size(cells) - 2, F.lit(0)))
        owner = F.filter(
            F.slice(rest, 1, 3),
            lambda c: (c != "") & ~looks_like_date(c) & (F.lit(True) if buyspeed else F.length(c) > 3),
        )
        url = (
            absolute_url(base, href) if buyspeed else F.when(href.startswith("http"), href)
        )
        record = bind(
            _dates(rest),
            lambda d: _record(
                id=ident, title=title, agency=F.get(owner, 0), status=F.lit("Open"),
                posted_date=_posted(d), close_date=_closes(d), url=url, description=title,
                amount=F.get(F.filter(rest, looks_like_amount), 0),
            ),
        )
        keep = (F.size(cells) >= 2) & (title != "")
        if buyspeed:
            keep &= ~contains_any(F.lower(title), BUYSPEED_NOISE)
        return F.when(keep, record)

    return bind(H.row_cells(row), lambda cells: bind(H.first_link(row), lambda link: build(cells, link)))


def _platform(pages: DataFrame, buyspeed: bool, rows: Column, fragments: list[str], min_text: int) -> DataFrame:
    """Records of the rows; only where a page has no rows at all, of its links."""
    base = F.col("url")

    def target(href: Column) -> Column:
        if buyspeed:
            return absolute_url(base, href)
        site = F.split_part(base, F.lit("/apps"), F.lit(1))
        return F.when(href.startswith("http"), href).otherwise(F.concat(site, href))

    wanted = _plain(lambda html: F.filter(
        H.links(html), lambda x: contains_any(x["href"], fragments) & (F.length(x["text"]) > min_text)))
    fallback = F.transform(
        wanted,
        lambda x: _record(
            id=bid_id_from_url(x["href"]) if buyspeed else event_id_from_url(x["href"]),
            title=x["text"], status=F.lit("Open"), url=target(x["href"]), description=x["text"],
        ),
    )
    found = bind(rows, lambda found: F.when(F.size(found) > 0, F.filter(
        F.transform(found, lambda row: _platform_row(row, base, buyspeed)), lambda r: r.isNotNull())).otherwise(fallback))
    return _portal(pages, found)


def buyspeed(pages: DataFrame) -> DataFrame:
    """Rows of tables of class ``table``, else of the result table, else of any."""
    rows = _tables(lambda page: _first_filled(
        H.rows_of(page, E.classed(["table"], of=E.tag("table"))), H.rows_of(page, E.identified("bidSearchResultsTable", of=E.tag("table"))), H.table_rows(page)))
    return _platform(pages, True, rows, ["bidDetail", "BidDetail", "publicBidDetail"], 5)


def jaggaer(pages: DataFrame) -> DataFrame:
    """Table rows, else list items; an item without cells is no record, but it keeps the links out."""
    rows = _first_filled(_tables(H.table_rows), _flow(lambda page: H.blocks(page, ["event-list-item", "event-row"])))
    return _platform(pages, False, rows, ["Event", "event", "PublicEvent"], 10)


# -------------------------------------------------------- dedicated sources
def texas_esbd(pages: DataFrame) -> DataFrame:
    """Result blocks with ``Label: value`` paragraphs."""

    def build(link: Column, parts: Column) -> Column:
        due, clock = H.labelled(parts, "Due Date"), H.labelled(parts, "Due Time")
        member = H.labelled(parts, "Agency/Texas SmartBuy Member Number")
        amount = first_nonempty(*[
            H.labelled(parts, label)
            for label in ("Estimated Amount", "Estimated Value", "Amount", "Value", "Budget")
        ])
        return F.when(
            link.isNotNull(),
            _record(
                id=first_nonempty(
                    H.labelled(parts, "Solicitation ID"), F.replace(link["href"], F.lit("/esbd/"), F.lit(""))
                ),
                title=link["text"],
                agency=F.concat(F.lit("Agency #"), blank_to_null(member)),
                status=H.labelled(parts, "Status"), posted_date=H.labelled(parts, "Posting Date"),
                close_date=strip(F.concat(blank_to_null(due), F.lit(" "), clock)),
                url=F.concat(F.lit("https://www.txsmartbuy.gov"), blank_to_null(link["href"])),
                amount=amount,
            ),
        )

    def from_block(block: Column) -> Column:
        link = H.first_link(E.first_element(block, E.classed(["esbd-result-title"])))
        return bind(link, lambda x: bind(H.paragraphs(block), lambda parts: build(x, parts)))

    found = F.filter(
        F.transform(_flow(lambda page: H.blocks(page, ["esbd-result-row"])), from_block), lambda r: r.isNotNull()
    )
    return _explode(pages, found, F.lit("TX"), F.lit("TX ESBD"))


def nc_evp(pages: DataFrame) -> DataFrame:
    """Seven fixed columns of the tables of class ``table``; an amount may follow in a later one."""
    site = F.lit("https://evp.nc.gov")

    def build(row: Column) -> Column:
        def with_cells(cells: Column) -> Column:
            extra = F.slice(cells, F.lit(8), F.greatest(F.size(cells) - 7, F.lit(0)))
            amount = F.filter(extra, lambda c: F.contains(c, F.lit("$")) | c.rlike(r"^[,.]*\d[\d,.]*$"))
            href = F.coalesce(H.first_link(row)["href"], F.lit(""))
            return F.when(
                F.size(cells) > 0,
                _record(
                    id=F.get(cells, 0), title=F.get(cells, 1), description=F.get(cells, 2),
                    close_date=F.get(cells, 3), posted_date=F.get(cells, 4), status=F.get(cells, 5),
                    agency=F.get(cells, 6),
                    url=F.when(href.startswith("/"), F.concat(site, href)).otherwise(href),
                    amount=F.get(amount, 0),
                ),
            )

        return bind(H.row_cells(row), with_cells)

    rows = _tables(lambda page: H.rows_of(page, E.classed(["table"], of=E.tag("table"))))
    found = F.filter(F.transform(rows, build), lambda r: r.isNotNull())
    return _explode(pages, found, F.lit("NC"), F.lit("NC eVP"))


def nc_doa(pages: DataFrame) -> DataFrame:
    """Fallback list of posted links."""
    site = F.lit("https://www.doa.nc.gov")
    wanted = _plain(lambda html: F.filter(
        H.links(html),
        lambda x: (
            F.contains(F.lower(x["href"]), F.lit("solicitation"))
            | F.lower(x["text"]).rlike("solicitation|rfp|bid")
        )
        & (F.length(x["text"]) > 10),
    ))
    found = F.transform(
        wanted,
        lambda x: _record(
            title=x["text"], agency=F.lit("NC Dept. of Administration"),
            url=F.when(x["href"].startswith("http"), x["href"]).otherwise(F.concat(site, x["href"])),
        ),
    )
    return _explode(pages, found, F.lit("NC"), F.lit("NC DOA"))


def ny_nyscr(pages: DataFrame) -> DataFrame:
    """Listing blocks, else detail links, else the table, else any ad links."""
    site = F.lit("https://www.nyscr.ny.gov")

    def full(href: Column) -> Column:
        return (
            F.when(href.startswith("http"), href).when(href != "", F.concat(site, href)).otherwise("")
        )

    def listed(title: Column, href: Column) -> Column:
        return _record(title=title, status=F.lit("Open"), url=full(href), description=F.left(title, F.lit(500)))

    listings = E.classed(["listing", "ad-", "result"], partial=True, of=E.tag("div"))
    block_records = F.transform(
        _flow(lambda page: E.elements(page, listings)),
        lambda b: bind(
            F.struct(H.first_link(b).alias("link"), F.left(H.visible(b), F.lit(200)).alias("text")),
            lambda x: listed(
                F.coalesce(x["link"]["text"], x["text"]), F.coalesce(x["link"]["href"], F.lit(""))
            ),
        ),
    )
    detail_records = F.transform(
        _plain(lambda html: F.filter(
            H.links(html),
            lambda x: F.contains(x["href"], F.lit("/Ads/")) & F.contains(x["href"], F.lit("Detail")),
        )),
        lambda x: listed(x["text"], x["href"]),
    )

    def from_row(row: Column) -> Column:
        def build(cells: Column, link: Column) -> Column:
            title = F.coalesce(link["text"], F.get(cells, 0))
            return F.when(
                F.size(cells) >= 3,
                _record(
                    id=F.get(cells, 0), title=title, agency=F.get(cells, 1), status=F.lit("Open"),
                    posted_date=F.get(cells, 2), close_date=F.get(cells, 3),
                    url=full(F.coalesce(link["href"], F.lit(""))), description=title,
                ),
            )

        return bind(H.row_cells(row), lambda c: bind(H.first_link(row), lambda x: build(c, x)))

    any_records = F.transform(
        _plain(lambda html: F.filter(
            H.links(html),
            lambda x: F.contains(F.lower(x["href"]), F.lit("/ads/")) & (F.length(x["text"]) > 10),
        )),
        lambda x: _record(title=x["text"], status=F.lit("Open"), url=full(x["href"]), description=x["text"]),
    )
    long_title = lambda r: r.isNotNull() & (F.length(r["title"]) > 5)
    # the first table alone, without its first row; only a page without tables shows other links
    from_table = lambda t: bind(H.all_rows(t), lambda rows: F.transform(
        F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), from_row))
    in_table = _tables(lambda page: bind(
        F.get(H.tables(page), 0), lambda t: F.when(t.isNotNull(), from_table(t)).otherwise(any_records)))
    chosen = _first_filled(block_records, detail_records, in_table)
    return _explode(pages, F.filter(chosen, long_title), F.lit("NY"), F.lit("NY NYSCR"))


def _aggregator(pages: DataFrame, state_slugs: DataFrame, source: str, site: str, slug_pattern: str,
                cards: list[list[str]], items: list[str], partial: bool, title: list[str], agency: list[str],
                close: list[str], posted: list[str], amount: list[str],
                links_to: list[str], not_to: list[str]) -> DataFrame:
    """Card, table-row, list or link pages of an aggregator; the slug in the URL gives the state.

    The first of the ``cards`` class lists that a page has, else its table rows, else elements of the ``items``
    classes, else links.
    """
    base = pages.select("page_id", "url", "html", F.regexp_extract("url", slug_pattern, 1).alias("slug"))
    # 50 fixed rows
    placed = base.join(F.broadcast(state_slugs), "slug", "inner")

    def absolute(href: Column) -> Column:
        return (
            F.when(href.startswith("http"), href)
            .when(href != "", F.concat(F.lit(site), href))
            .otherwise("")
        )

    def from_block(block: Column) -> Column:
        def build(name: Column, href: Column) -> Column:
            return F.when(
                name != "",
                _record(
                    id=last_segment(href), title=name, status=F.lit("Open"), url=absolute(href), description=name,
                    agency=H.element_text(block, classes=agency, partial=partial),
                    close_date=H.element_text(block, classes=close, partial=partial),
                    posted_date=H.element_text(block, classes=posted, partial=partial),
                    amount=H.element_text(block, classes=amount, partial=partial),
                ),
            )

        name = first_nonempty(
            H.element_text(block, ["h[34]"], title, partial), H.element_text(block, ["a"])
        )
        return bind(
            F.struct(name.alias("n"), F.coalesce(H.first_link(block)["href"], F.lit("")).alias("h")),
            lambda x: build(x["n"], x["h"]),
        )

    wanted = _plain(lambda html: F.filter(
        H.links(html),
        lambda x: contains_any(x["href"], links_to)
        & ~contains_any(x["href"], not_to)
        & (F.length(x["text"]) > 10),
    ))
    fallback = F.transform(
        wanted,
        lambda x: _record(
            id=last_segment(x["href"]), title=x["text"], status=F.lit("Open"), url=absolute(x["href"]),
            description=x["text"],
        ),
    )
    found = _flow(lambda page: _first_filled(
        *[H.blocks(page, names, partial=partial) for names in cards], H.table_rows(page), H.blocks(page, items, partial=partial)))
    chosen = bind(found, lambda x: F.when(
        F.size(x) > 0, F.filter(F.transform(x, from_block), lambda r: r.isNotNull())).otherwise(fallback))
    return _explode(placed, chosen, F.col("state"), F.lit(source))


def bidnet(pages: DataFrame, state_slugs: DataFrame) -> DataFrame:
    return _aggregator(
        pages, state_slugs, "BidNet Direct", "https://www.bidnetdirect.com",
        r"bidnetdirect\.com/([^/]+)/",
        # --- fixed values: class names on these pages
        cards=[["bid-card", "solicitation-card"]], items=["search-result", "result-item"], partial=False,
        title=["title", "bid-title"], agency=["agency", "organization", "department", "entity-name"],
        close=["close-date", "deadline", "due-date", "end-date"],
        posted=["post-date", "posted-date", "publish-date"],
        amount=["amount", "value", "budget", "estimate", "price", "cost"],
        links_to=["/solicitations/"], not_to=["/open-bids"],
    )


def demandstar(pages: DataFrame, state_slugs: DataFrame) -> DataFrame:
    return _aggregator(
        pages, state_slugs, "DemandStar", "https://www.demandstar.com",
        r"/browse-bids/states/([^/?#]+)",
        # --- fixed values: parts of class names on these pages
        cards=[["bid-row", "bid-card"], ["BidRow", "BidCard"]], items=["result-item", "listing-item"], partial=True,
        title=["[Tt]itle", "[Nn]ame"], agency=["[Aa]gency", "[Oo]rganization", "[Ee]ntity"],
        close=["[Cc]lose", "[Dd]eadline", "[Dd]ue", "[Ee]nd"], posted=["[Pp]ost", "[Pp]ublish", "[Ss]tart"],
        amount=["[Aa]mount", "[Vv]alue", "[Bb]udget", "[Pp]rice", "[Cc]ost"],
        links_to=["/bid/", "/bids/", "/solicitation"], not_to=[],
    )
