"""Captured pages: the pages table as it is, and pages rendered from the orders."""
from pyspark.sql import functions as F

from oppflow.catalog.base import query, table
from oppflow.fixed_values import PORTALS, STATES
from oppflow.functions import html as H
from oppflow.operators.identity import first_wins
from oppflow.session import spread
from oppflow.sources import pages as P

_BASE = "https://p.example.org/bids/list"


@query("a10_captured_pages", "select page_id, url, length(html) as chars from pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", "url", F.length("html").cast("bigint").alias("chars"))


def captured(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url", "html", F.lit("CA").alias("state"), F.lit("Portal").alias("label"))
    return spread(pages, "page_id")


_LINKS = r"""v_a as (
  select page_id, i, regexp_extract(a, 'href="([^"]*)"', 1) as href, trim(regexp_replace(regexp_extract(a, '(?s)<a[^>]*>(.*)</a>', 1), '<[^>]*>', '', 'g')) as text
  from (select page_id, generate_subscripts(l, 1) as i, unnest(l) as a from (
    select page_id, regexp_extract_all(html, '(?s)<a [^>]*href="[^"]*"[^>]*>.*?</a>') as l from pages))),
v_link as (select page_id, i, replace(href, '&amp;', '&') as href, replace(text, '&amp;', '&') as text from v_a)"""


@query("b11_links_on_pages", "with " + _LINKS + """
select page_id, href, count(*) as n from v_link group by page_id, href""")
def _(spark, d):
    each = captured(spark, d).select("page_id", F.explode(H.links(F.col("html"))).alias("x"))
    return each.groupBy("page_id", F.col("x.href").alias("href")).agg(F.count("*").alias("n"))


@query("c7_first_of_each_link", "with " + _LINKS + """
select page_id, href, min(i) - 1 as item_ord, arg_min(text, i) as text from v_link group by page_id, href""")
def _(spark, d):
    each = captured(spark, d).select("page_id", F.posexplode(H.links(F.col("html"))).alias("item_ord", "x"))
    rows = each.select("page_id", "item_ord", "x.href", "x.text")
    return first_wins(rows, ["page_id", "href"], ["item_ord"]).withColumn("item_ord", F.col("item_ord").cast("bigint"))


# --------------------------------------------------- pages made from orders
def _order_pages(spark, d, html, url=f"'{_BASE}?o=1'"):
    return spread(table(spark, d, "orders"), "o_orderkey", rows=50_000).selectExpr(
        "o_orderkey as page_id", f"{url} as url", f"{html} as html", "'MD' as state", "'Portal' as label"
    )


_US = "date_format(o_orderdate, 'MM/dd/yyyy')"
_MONEY = "concat('$', format_number(o_totalprice, 2))"
_TABLE = f"""concat('<html><table class="t"><thead><tr><th>Id</th><th>Title</th></tr></thead><tbody>',
  '<tr><td> B', o_orderkey, ' </td><td>', if(o_orderkey % 3 = 0, concat('Supply &amp; delivery of goods ', o_custkey),
    concat('<a class="x" href="/bids/view?bidId=', o_orderkey, '"><b>Supply</b> contract no ', o_custkey, '</a>')),
  '</td><td>Agency ', o_custkey, '</td><td>{{0}}</td><td>', date_format(date_add(cast(o_orderdate as date), 20), 'MM/dd/yyyy'),
  '</td>', if(o_orderkey % 2 = 0, concat('<td>', {_MONEY}, '</td>'), ''), '</tr>\\n',
  '<tr><td>only cell</td></tr><tr><td>x</td><td>y</td></tr></tbody></table></html>')""".replace("{0}", "', " + _US + ", '")
_D1, _D2 = "strftime(o_orderdate, '%m/%d/%Y')", "strftime(cast(o_orderdate as date) + 20, '%m/%d/%Y')"
_TITLE = "case when o_orderkey % 3 = 0 then 'Supply & delivery of goods ' || o_custkey else 'Supply contract no ' || o_custkey end"
_AMOUNT = "case when o_orderkey % 2 = 0 then '$' || format('{:,.2f}', o_totalprice) else '' end"
_URL = "case when o_orderkey % 3 = 0 then '' else 'https://p.example.org/bids/view?bidId=' || o_orderkey end"
_COLUMNS = ["page_id", "id", "title", "agency", "posted_date", "close_date", "amount", "url"]


@query("b10_table_rows", f"""
select o_orderkey as page_id, 'B' || o_orderkey as id, {_TITLE} as title, 'Agency ' || o_custkey as agency,
  {_D1} as posted_date, {_D2} as close_date, {_AMOUNT} as amount, {_URL} as url from orders""")
def _(spark, d):
    return P.portal_tables(_order_pages(spark, d, _TABLE)).select(*_COLUMNS)


@query("b16_buyspeed_rows", f"""
select o_orderkey as page_id, 0 as item_ord, 'B' || o_orderkey as id, {_TITLE} as title, 'Agency ' || o_custkey as agency,
  {_D1} as posted_date, {_D2} as close_date, {_AMOUNT} as amount, {_URL} as url from orders where o_orderkey % 3 = 0
union all select o_orderkey, 1, 'x', 'y', '', '', '', '', '' from orders""")
def _(spark, d):
    # titles with the word contract are noise there
    html = _TABLE.replace("Supply</b> contract no", "Supply</b> CONTRACTS no")
    rows = P.buyspeed(_order_pages(spark, d, html))
    return rows.select("page_id", F.when(F.col("id") == "x", 1).otherwise(0).alias("item_ord"), *_COLUMNS[1:])


@query("b17_jaggaer_rows", f"""
select o_orderkey as page_id, 'B' || o_orderkey as id, {_TITLE} as title, 'Agency ' || o_custkey as agency,
  {_D1} as posted_date, {_D2} as close_date, {_AMOUNT} as amount, '' as url from orders
union all select o_orderkey, 'x', 'y', '', '', '', '', '' from orders""")
def _(spark, d):
    return P.jaggaer(_order_pages(spark, d, _TABLE)).select(*_COLUMNS)


@query("b15_positional_table", """
select o_orderkey as page_id, 'S' || o_orderkey as id, 'T ' || o_custkey as title, 'D' as description, 'o' as close_date, 'p' as posted_date,
  o_orderstatus as status, 'Dept ' || o_custkey as agency, case when o_orderkey % 2 = 0 then '12,500.00' else '' end as amount,
  case when o_orderkey % 3 = 0 then 'https://evp.nc.gov/s/' || o_orderkey else 'https://o.example.org/' || o_orderkey end as url from orders""")
def _(spark, d):
    html = """concat('<table class="table"><tbody><tr><td><a href="', if(o_orderkey % 3 = 0, '/s/', 'https://o.example.org/'), o_orderkey, '">S', o_orderkey,
      '</a></td><td>T ', o_custkey, '</td><td>D</td><td>o</td><td>p</td><td>', o_orderstatus, '</td><td>Dept ', o_custkey, '</td><td>n/a</td>',
      if(o_orderkey % 2 = 0, '<td>12,500.00</td>', ''), '</tr></tbody></table>')"""
    return P.nc_evp(_order_pages(spark, d, html)).select(
        "page_id", "id", "title", "description", "close_date", "posted_date", "status", "agency", "amount", "url"
    )


@query("b15_posted_links", """
select o_orderkey as page_id, 'Open RFP ' || o_orderkey || ' now' as title, 'https://www.doa.nc.gov/x/' || o_orderkey as url from orders
union all select o_orderkey, 'Number ' || o_orderkey || ' item', 'http://e.org/Solicitation/' || o_orderkey from orders where o_orderkey % 2 = 0""")
def _(spark, d):
    html = """concat('<a href="/x/', o_orderkey, '">Open RFP ', o_orderkey, ' now</a><a href="/about">About this office</a>',
      if(o_orderkey % 2 = 0, concat('<a href="http://e.org/Solicitation/', o_orderkey, '">Number ', o_orderkey, ' item</a>'), ''))"""
    return P.nc_doa(_order_pages(spark, d, html)).select("page_id", "title", "url")


_BLOCK = """concat('<div class="esbd-result-row a"><div class="esbd-result-title"><a href="/esbd/', o_orderkey, '">Title ', o_custkey, '</a></div>',
  '<p><strong>Solicitation ID:</strong> ', if(o_orderkey % 4 = 0, '', concat('S-', o_orderkey)), '</p><p><strong>Due Date:</strong> ', date_format(o_orderdate, 'M/d/yyyy'),
  '</p><p><strong>Due Time:</strong> 2:00 PM</p><p><strong>Agency/Texas SmartBuy Member Number:</strong> ', o_custkey,
  '</p><p><strong>Status:</strong> ', o_orderstatus, '</p>', if(o_orderkey % 2 = 0, '<p><strong>Estimated Value:</strong> $5</p>', '<p><strong>Budget:</strong> $9</p>'), '</div>')"""


@query("b14_labelled_fields", """
select o_orderkey as page_id, case when o_orderkey % 4 = 0 then cast(o_orderkey as varchar) else 'S-' || o_orderkey end as id, 'Title ' || o_custkey as title,
  'Agency #' || o_custkey as agency, o_orderstatus as status, strftime(o_orderdate, '%-m/%-d/%Y') || ' 2:00 PM' as close_date,
  'https://www.txsmartbuy.gov/esbd/' || o_orderkey as url, case when o_orderkey % 2 = 0 then '$5' else '$9' end as amount from orders""")
def _(spark, d):
    return P.texas_esbd(_order_pages(spark, d, _BLOCK)).select("page_id", "id", "title", "agency", "status", "close_date", "url", "amount")


_CARDS = """concat('<div class="card wide"><div><h3>Bridge repair ', o_custkey, '</h3></div><a href="/p/', o_orderkey, '">More</a></div>',
    '<div class="card"><strong>Bus fleet order ', o_custkey, '</strong></div><div class="card"><h3>Too short</h3></div>')"""
_LINKED = """concat('<nav><a href="/home">Home</a></nav><table><tr><td>layout</td></tr></table><a href="docs/bid-', o_orderkey, '.html">Road salt supply ', o_custkey,
    '</a><a href="docs/bid-', o_orderkey, '.html">the same target</a><a href="/rfp/short">short</a>')"""
# a table, links or cards, depending on the page
_MIXED = f"case o_orderkey % 3 when 0 then {_TABLE} when 1 then {_LINKED} else {_CARDS} end"


@query("b13_strategy_per_page", f"""
select o_orderkey as page_id, 'B' || o_orderkey as id, {_TITLE} as title, '' as url from orders where o_orderkey % 3 = 0
union all select o_orderkey, 'bid-' || o_orderkey || '.html', 'Road salt supply ' || o_custkey, 'https://p.example.org/bids/docs/bid-' || o_orderkey || '.html'
  from orders where o_orderkey % 3 = 1
union all select o_orderkey, cast(o_orderkey as varchar), 'Bridge repair ' || o_custkey, 'https://p.example.org/p/' || o_orderkey from orders where o_orderkey % 3 = 2
union all select o_orderkey, '', 'Bus fleet order ' || o_custkey, '' from orders where o_orderkey % 3 = 2""")
def _(spark, d):
    return P.state_portals(_order_pages(spark, d, _MIXED)).select("page_id", "id", "title", "url")


@query("b12_cards", """
select o_orderkey as page_id, cast(o_orderkey as varchar) as id, 'Bridge repair ' || o_custkey as title, 'https://p.example.org/p/' || o_orderkey as url from orders
union all select o_orderkey, '', 'Bus fleet order ' || o_custkey, '' from orders""")
def _(spark, d):
    return P.portal_cards(_order_pages(spark, d, _CARDS)).select("page_id", "id", "title", "url")


@query("b11_portal_links", """
select o_orderkey as page_id, 'bid-' || o_orderkey || '.html' as id, 'Road salt supply ' || o_custkey as title from orders""")
def _(spark, d):
    return P.portal_links(_order_pages(spark, d, _LINKED)).select("page_id", "id", "title")


_NY = """case o_orderkey % 4
  when 0 then concat('<div class="ad-listing"><a href="/Ads/Search/', o_orderkey, '">Paper goods ', o_custkey, '</a></div><table><tr><td>z</td></tr></table>')
  when 1 then concat('<p><a href="/Ads/Detail/', o_orderkey, '">Ink ', o_custkey, ' supply</a></p>')
  when 2 then concat('<table><tr><th>h</th></tr><tr><td>N', o_orderkey, '</td><td>Agency</td><td>1/2/2024</td><td>2/3/2024</td></tr><tr><td>no</td></tr></table>')
  else concat('<a href="https://n.example.org/ads/', o_orderkey, '">Snow removal ', o_custkey, '</a><a href="/ads/1">tiny</a>') end"""


@query("b18_nyscr_strategies", """
select o_orderkey as page_id, '' as id, 'Paper goods ' || o_custkey as title, '' as close_date, 'https://www.nyscr.ny.gov/Ads/Search/' || o_orderkey as url
  from orders where o_orderkey % 4 = 0
union all select o_orderkey, '', 'Ink ' || o_custkey || ' supply', '', 'https://www.nyscr.ny.gov/Ads/Detail/' || o_orderkey from orders where o_orderkey % 4 = 1
union all select o_orderkey, 'N' || o_orderkey, 'N' || o_orderkey, '2/3/2024', '' from orders where o_orderkey % 4 = 2 and length('N' || o_orderkey) > 5
union all select o_orderkey, '', 'Snow removal ' || o_custkey, '', 'https://n.example.org/ads/' || o_orderkey from orders where o_orderkey % 4 = 3""")
def _(spark, d):
    return P.ny_nyscr(_order_pages(spark, d, _NY)).select("page_id", "id", "title", "close_date", "url")


_SLUG_NAMES = [name.lower().replace(" ", "-") for _, name, _ in STATES]
_SLUGS_SQL = "v_slug(i, slug, state) as (values " + ", ".join(
    f"({i}, '{slug}', '{STATES[i][0]}')" for i, slug in enumerate(_SLUG_NAMES)
) + ")"
_SPARK_SLUG = "element_at(split('" + ",".join(_SLUG_NAMES) + "', ','), cast(o_orderkey % 50 as int) + 1)"


@query("b12_aggregator_cards", "with " + _SLUGS_SQL + """
select o_orderkey as page_id, state, cast(o_orderkey as varchar) as id, 'Card ' || o_custkey as title, 'Unit ' || o_custkey as agency, '1/5/2024' as close_date, '$7' as amount,
  'https://www.bidnetdirect.com/solicitations/' || o_orderkey || '/' as url from orders join v_slug on i = o_orderkey % 50 where o_orderkey % 2 = 0
union all select o_orderkey, state, cast(o_orderkey as varchar), 'Linked bid ' || o_custkey, '', '', '', 'https://www.bidnetdirect.com/solicitations/' || o_orderkey
  from orders join v_slug on i = o_orderkey % 50 where o_orderkey % 2 = 1""")
def _(spark, d):
    html = """if(o_orderkey % 2 = 0, concat('<div class="bid-card"><h4>Card ', o_custkey, '</h4><a href="/solicitations/', o_orderkey, '/">see</a><span class="agency">Unit ', o_custkey,
      '</span><span class="x due-date">1/5/2024</span><em class="price">$7</em></div>'),
      concat('<a href="/texas/solicitations/open-bids">Open bids in Texas</a><a href="/solicitations/', o_orderkey, '">Linked bid ', o_custkey, '</a>'))"""
    url = f"concat('https://www.bidnetdirect.com/', {_SPARK_SLUG}, '/solicitations/open-bids')"
    rows = P.bidnet(_order_pages(spark, d, html, url), P.slugs(spark))
    return rows.select("page_id", "state", "id", "title", "agency", "close_date", "amount", "url")


@query("h4_slug_to_state", "with " + _SLUGS_SQL + """
select o_orderkey as page_id, state, 'Row ' || o_custkey as title, 'Org ' || o_custkey as agency from orders join v_slug on i = o_orderkey % 50""")
def _(spark, d):
    html = """concat('<li class="row BidRow-3"><p class="bidTitle">Row ', o_custkey, '</p><p class="org-entity">Org ', o_custkey, '</p></li>')"""
    url = f"concat('https://www.demandstar.com/app/browse-bids/states/', {_SPARK_SLUG})"
    return P.demandstar(_order_pages(spark, d, html, url), P.slugs(spark)).select("page_id", "state", "title", "agency")


# ------------------------------------------------- nested and list-style pages
_INNER = "<table><tr><td>inner a</td><td>inner cell b</td></tr></table>"
_OUTER = f"""concat('<div><TABLE class="t"><tbody><tr><td>B', o_orderkey, '</td><td><a href="/bids/view?bidId=', o_orderkey, '">Supply contract no ', o_custkey,
  '</a>{_INNER}</td><td>Agency ', o_custkey, '<td>', {_US}, if(o_orderkey % 2 = 0, '</td></tr>', ''), '</tbody></TABLE></div><table><tr><td>x</td></tr></table>')"""


@query("b10_nested_tables", f"""
select o_orderkey as page_id, 0 as item_ord, 'B' || o_orderkey as id, 'Supply contract no ' || o_custkey as title,
  'Supply contract no ' || o_custkey || ' inner a inner cell b' as agency, {_D1} as close_date, 'https://p.example.org/bids/view?bidId=' || o_orderkey as url from orders
union all select o_orderkey, 1, 'inner a', 'inner cell b', '', '', '' from orders""")
def _(spark, d):
    rows = P.portal_tables(_order_pages(spark, d, _OUTER))
    return rows.select("page_id", "item_ord", "id", "title", "agency", "close_date", "url")


_CARDS_AND_FOOTER = """concat('<div class="card"><div class="inner"><h3>Bridge repair ', o_custkey, '</h3></div><div>text</div></div>',
  if(o_orderkey % 2 = 0, concat('<section class="list-item"><h2>Outer works ', o_custkey, '</h2><article><b>Inner works ', o_custkey, '</b><a href="/i/', o_orderkey, '">i</a></article></section>'), ''),
  '<footer><a href="/privacy">Privacy</a></footer>')"""


@query("b12_cards_without_links", """
select o_orderkey as page_id, 0 as item_ord, '' as id, 'Bridge repair ' || o_custkey as title, '' as url from orders
union all select o_orderkey, 1, cast(o_orderkey as varchar), 'Outer works ' || o_custkey, 'https://p.example.org/i/' || o_orderkey from orders where o_orderkey % 2 = 0""")
def _(spark, d):
    # the link of the inner card is the outer one's too; its own title, the link's text, is too short
    return P.portal_cards(_order_pages(spark, d, _CARDS_AND_FOOTER)).select("page_id", "item_ord", "id", "title", "url")


_ITEMS = """concat('<ul><li class="', if(o_orderkey % 2 = 0, 'search-result odd', 'x result-item'), '"><h4>Item ', o_custkey, '<li class="other"><a href="/help">help</a></ul>',
  '<a href="/solicitations/', o_orderkey, '">A link that is not read</a>')"""


@query("b12_aggregator_items", "with " + _SLUGS_SQL + """
select o_orderkey as page_id, state, '' as id, 'Item ' || o_custkey as title, '' as url from orders join v_slug on i = o_orderkey % 50""")
def _(spark, d):
    url = f"concat('https://www.bidnetdirect.com/', {_SPARK_SLUG}, '/solicitations/open-bids')"
    return P.bidnet(_order_pages(spark, d, _ITEMS, url), P.slugs(spark)).select("page_id", "state", "id", "title", "url")


_LIST = """concat(if(o_orderkey % 2 = 0, '<div class="event-row"><span>Event</span></div>', ''), '<a href="/apps/PublicEvent?id=', o_orderkey, '">Road salt supply ', o_custkey, '</a>')"""


@query("b17_list_keeps_links_out", """
select o_orderkey as page_id, 'Road salt supply ' || o_custkey as title from orders where o_orderkey % 2 = 1""")
def _(spark, d):
    return P.jaggaer(_order_pages(spark, d, _LIST)).select("page_id", "title")


_TWO = """concat('<table><tr><td>M', o_orderkey, '</td><td>menu</td></tr></table>', if(o_orderkey % 3 = 0, '',
  concat('<table id="bidSearchResultsTable" class="', if(o_orderkey % 3 = 1, 'wide table', 'wide'), '"><thead><tr><td>h</td><td>head</td></tr></thead><tr><td>B', o_orderkey, '</td><td>Paper ', o_custkey, '</td></tr></table>')))"""


@query("b16_result_table", """
select o_orderkey as page_id, case when o_orderkey % 3 = 0 then 'M' else 'B' end || o_orderkey as id, case when o_orderkey % 3 = 0 then 'menu' else 'Paper ' || o_custkey end as title from orders""")
def _(spark, d):
    return P.buyspeed(_order_pages(spark, d, _TWO)).select("page_id", "id", "title")


@query("b15_table_of_class", """
select o_orderkey as page_id, 'B' || o_orderkey as id, 'Paper ' || o_custkey as title from orders where o_orderkey % 3 = 1""")
def _(spark, d):
    return P.nc_evp(_order_pages(spark, d, _TWO)).select("page_id", "id", "title")


_BASES_SQL = "v_portal(i, state, label, base) as (values " + ", ".join(
    "(" + ", ".join([str(i), *("'" + x.replace("'", "''") + "'" for x in p[1:])]) + ")" for i, p in enumerate(PORTALS)) + ")"
_BASES = "array(" + ", ".join(f"'{p[3]}'" for p in PORTALS) + ")"


@query("a10_records_of_portals", "with " + _BASES_SQL + f"""
select o_orderkey as page_id, min(q.state) as state, min(q.label) as source, 'B' || o_orderkey as id, 'Paper goods ' || min(o_custkey) as title
from orders join v_portal p on p.i = o_orderkey % {len(PORTALS) + 1} join v_portal q on q.base = p.base
group by o_orderkey""")
def _(spark, d):
    """Pages below the start page of every known portal, and of a host that is none."""
    url = f"concat(coalesce(get({_BASES}, cast(o_orderkey % {len(PORTALS) + 1} as int)), 'https://other.example.org'), '/list/', o_orderkey, '?page=2')"
    html = "concat('<table><tr><td>B', o_orderkey, '</td><td>Paper goods ', o_custkey, '</td></tr></table>')"
    pages = _order_pages(spark, d, html, url).drop("state", "label")
    return P.portal_tables(P.with_portal(pages, P.portals(spark))).select("page_id", "state", "source", "id", "title")
