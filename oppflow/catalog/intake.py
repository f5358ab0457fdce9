"""Payload sources, files and state.

Payloads are rendered as JSON from the standard tables and read back by the
normalisers; the SQL side computes the expected columns from the tables.
"""
from pyspark.sql import functions as F

from oppflow.catalog.base import (
    EVENTS, EXCLUDED, KEYWORDS, TAGGED, events, fresh_dir, query, rfps, table, tagged, with_sql,
)
from oppflow.operators import identity, preferences
from oppflow.plans import ingest
from oppflow.session import spread
from oppflow.sources import api, store
from oppflow.sources.commits import DatedMemory
from oppflow.sources.pages import portal_tables

_ALL = ["id", "title", "agency", "status", "posted_date", "close_date", "url", "description", "amount"]
_AWARD = _ALL + ["recipient", "recipient_state", "pi_name"]


def bodies(spark, d, name, order, body, *more, rows=None):
    source = table(spark, d, name)
    source = spread(source, order, rows=rows) if rows else source
    return source.selectExpr(f"{order} as payload_ord", f"to_json({body}) as body", *more)


@query("b1_sam_gov", r"""
select 'N' || o_orderkey as id, o_orderpriority || ' ' || o_orderkey as title,
  case when o_orderkey % 2 = 0 then 'Path ' || o_custkey else 'Dept ' || o_custkey end as agency,
  o_orderstatus as status, strftime(o_orderdate, '%Y-%m-%d') as posted_date, '' as close_date,
  'https://sam.example.org/' || o_orderkey as url, left(repeat(o_orderpriority, 150), 1000) as description,
  case o_orderkey % 3 when 0 then cast(o_custkey + 7 as varchar) when 1 then '5' || o_custkey else '' end as amount from orders""")
def _(spark, d):
    rows = bodies(spark, d, "orders", "o_orderkey", """named_struct('totalRecords', 1, 'opportunitiesData', array(named_struct(
        'noticeId', concat('N', o_orderkey), 'title', concat(o_orderpriority, ' ', o_orderkey),
        'fullParentPathName', if(o_orderkey % 2 = 0, concat('Path ', o_custkey), null),
        'department', concat('Dept ', o_custkey), 'type', o_orderstatus,
        'postedDate', date_format(o_orderdate, 'yyyy-MM-dd'), 'uiLink', concat('https://sam.example.org/', o_orderkey),
        'description', repeat(o_orderpriority, 150),
        'award', if(o_orderkey % 3 = 0, named_struct('amount', o_custkey + 7), null),
        'estimatedValue', if(o_orderkey % 3 = 1, 0, null), 'baseAndAllOptionsValue', '',
        'amount', if(o_orderkey % 3 = 1, concat('5', o_custkey), null))))""")
    return api.sam_gov(rows).select(*_ALL)


@query("b2_grants_gov", r"""
select cast(o_custkey as varchar) as id, arg_min(o_orderpriority || ' ' || o_orderkey, o_orderkey) as title,
  arg_min(case o_orderkey % 3 when 0 then 'A' || o_orderkey else 'B' || o_orderkey end, o_orderkey) as agency,
  arg_min(case when o_orderkey % 2 = 0 then o_orderstatus else 'Posted' end, o_orderkey) as status,
  'https://www.grants.gov/search-results-detail/' || o_custkey as url,
  arg_min(case when o_orderkey % 2 = 0 then 'S' || o_orderkey else o_orderpriority || ' ' || o_orderkey end, o_orderkey) as description,
  arg_min(case when o_orderkey % 4 = 0 then '' else cast(o_orderkey + 100 as varchar) end, o_orderkey) as amount
from orders group by o_custkey""")
def _(spark, d):
    hit = """named_struct('id', if(o_orderkey % 2 = 0, o_custkey, null), 'number', o_custkey,
        'title', if(o_orderkey % 2 = 0, concat(o_orderpriority, ' ', o_orderkey), null), 'oppTitle', concat(o_orderpriority, ' ', o_orderkey),
        'agency', if(o_orderkey % 3 = 0, concat('A', o_orderkey), null), 'agencyName', concat('B', o_orderkey),
        'oppStatus', if(o_orderkey % 2 = 0, o_orderstatus, null),
        'synopsis', if(o_orderkey % 2 = 0, concat('S', o_orderkey), concat(o_orderpriority, ' ', o_orderkey)),
        'awardCeiling', 0, 'awardFloor', '', 'amount', if(o_orderkey % 4 = 0, null, o_orderkey + 100))"""
    rows = table(spark, d, "orders").selectExpr(
        "o_orderkey as payload_ord",
        f"""case o_orderkey % 3 when 0 then to_json(named_struct('data', named_struct('hitCount', 1, 'oppHits', array({hit}))))
            when 1 then to_json(named_struct('oppHits', array({hit}))) else to_json(array({hit})) end as body""",
    )
    return api.grants_gov(rows).select("id", "title", "agency", "status", "url", "description", "amount")


@query("b3_sbir", r"""
select 'P' || p_partkey as id, p_name as title, p_brand as agency, case when p_partkey % 2 = 0 then p_type else 'Open' end as status,
  cast(p_size as varchar) as posted_date,
  case when p_partkey % 3 = 0 then 'https://l.example.org/' || p_partkey else 'https://www.sbir.gov/node/P' || p_partkey end as url,
  left(repeat(p_name, 80), 500) as description from part""")
def _(spark, d):
    item = """named_struct('solicitation_number', if(p_partkey % 2 = 0, concat('P', p_partkey), null), 'solicitationId', concat('P', p_partkey),
        'solicitationTitle', p_name, 'agency', p_brand, 'current_status', if(p_partkey % 2 = 0, p_type, null),
        'openDate', p_size, 'url', if(p_partkey % 3 = 0, concat('https://l.example.org/', p_partkey), ''),
        'description', repeat(p_name, 80))"""
    rows = table(spark, d, "part").selectExpr(
        "p_partkey as payload_ord",
        f"if(p_partkey % 2 = 0, to_json(array({item})), to_json(named_struct('results', array({item})))) as body",
    )
    return api.sbir(rows).select("id", "title", "agency", "status", "posted_date", "url", "description")


_NIH = r"""
select 'C' || c_nationkey || '-' || (c_custkey // 4) as id, arg_min(c_name, c_custkey) as title,
  arg_min('NIH / ' || case when c_custkey % 2 = 0 then c_mktsegment else 'NIH' end, c_custkey) as agency,
  arg_min(case when c_custkey % 5 = 0 then cast(c_custkey + 9 as varchar) else cast(c_custkey + 1 as varchar) end, c_custkey) as amount,
  arg_min(c_name, c_custkey) as recipient,
  arg_min(case when c_custkey % 3 = 0 then 'City, N' || c_nationkey else 'N' || c_nationkey end, c_custkey) as recipient_state,
  arg_min('Ann ' || c_custkey || '; Lee; P3', c_custkey) as pi_name
from customer group by c_nationkey, c_custkey // 4"""


@query("b4_nih_reporter", _NIH)
def _(spark, d):
    rows = bodies(spark, d, "customer", "c_custkey", """named_struct('results', array(named_struct(
        'project_num', concat('C', c_nationkey, '-', c_custkey div 4), 'project_title', c_name,
        'agency_ic_fundings', if(c_custkey % 2 = 0, array(named_struct('abbreviation', c_mktsegment)), null),
        'principal_investigators', array(
            named_struct('full_name', concat('Ann ', c_custkey), 'first_name', 'x', 'last_name', 'y'),
            named_struct('full_name', '', 'first_name', '', 'last_name', 'Lee'),
            named_struct('full_name', '', 'first_name', '', 'last_name', ''),
            named_struct('full_name', 'P3', 'first_name', '', 'last_name', ''),
            named_struct('full_name', 'P4', 'first_name', '', 'last_name', '')),
        'organization', named_struct('org_name', c_name, 'org_city', if(c_custkey % 3 = 0, 'City', null), 'org_state', concat('N', c_nationkey)),
        'award_amount', if(c_custkey % 5 = 0, 0, c_custkey + 1), 'total_cost', c_custkey + 9)))""")
    return api.nih_reporter(rows).select("id", "title", "agency", "amount", "recipient", "recipient_state", "pi_name")


@query("b5_nsf_awards", r"""
select cast(s_suppkey as varchar) as id, s_name as title, 'NSF — ' || case when s_suppkey % 2 = 0 then 'ENG' else 'NSF' end as agency,
  'https://www.nsf.gov/awardsearch/showAward?AWD_ID=' || s_suppkey as url,
  case when s_suppkey % 4 = 0 then '' else cast(s_suppkey + 50 as varchar) end as amount,
  n_name as recipient, case when s_suppkey % 3 = 0 then 'ST' else 'Town, ST' end as recipient_state,
  case when s_suppkey % 2 = 0 then 'Jo Hill' else 'Hill' end as pi_name
from supplier join nation on s_nationkey = n_nationkey""")
def _(spark, d):
    joined = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = joined.selectExpr("s_suppkey as payload_ord", """to_json(named_struct('response', named_struct('award', array(
        named_struct('id', s_suppkey, 'title', s_name, 'agency', if(s_suppkey % 2 = 0, 'ENG', null),
          'estimatedTotalAmt', if(s_suppkey % 4 = 0, 0, s_suppkey + 50), 'awardeeName', n_name,
          'awardeeCity', if(s_suppkey % 3 = 0, '', 'Town'), 'awardeeStateCode', 'ST',
          'piFirstName', if(s_suppkey % 2 = 0, 'Jo', ''), 'piLastName', 'Hill'),
        named_struct('id', s_suppkey, 'title', 'again', 'agency', '', 'estimatedTotalAmt', 1, 'awardeeName', '',
          'awardeeCity', '', 'awardeeStateCode', '', 'piFirstName', '', 'piLastName', ''))))) as body""")
    return api.nsf_awards(rows).select("id", "title", "agency", "url", "amount", "recipient", "recipient_state", "pi_name")


@query("b6_federal_register", r"""
select doc_id as payload_ord, cast(doc_id as varchar) as id, source as title,
  case when doc_id % 3 = 0 then '' else lang end as agency, left(text, 500) as description from documents""")
def _(spark, d):
    rows = bodies(spark, d, "documents", "doc_id", """named_struct('results', array(
        named_struct('document_number', doc_id, 'title', source, 'abstract', text,
          'agencies', if(doc_id % 3 = 0, cast(array() as array<struct<name:string>>), array(named_struct('name', lang), named_struct('name', 'x')))),
        named_struct('document_number', doc_id, 'title', 'again', 'abstract', '', 'agencies', cast(array() as array<struct<name:string>>))))""")
    return api.federal_register(rows).select("payload_ord", "id", "title", "agency", "description")


@query("b7_usaspending", r"""
select l_orderkey || '-' || l_linenumber || '-' || l_partkey as id,
  'USAspending (' || case when l_linenumber % 2 = 0 then 'Contracts' else 'Grants' end || ')' as source,
  'https://www.usaspending.gov/award/G' || l_orderkey as url, l_returnflag as title,
  cast(cast(l_quantity as integer) as varchar) as amount, 'City' || l_suppkey || ', TX' as recipient_state,
  'R' || l_suppkey as recipient from lineitem""")
def _(spark, d):
    # landed in one folder per award group, as requests are made, and read back
    path = fresh_dir(spark)
    rows = bodies(spark, d, "lineitem", "l_orderkey", """named_struct('results', array(named_struct(
        'Award ID', concat(l_orderkey, '-', l_linenumber, '-', l_partkey), 'generated_internal_id', concat('G', l_orderkey),
        'Description', l_returnflag, 'Award Amount', cast(l_quantity as int), 'Recipient Name', concat('R', l_suppkey),
        'Recipient City Name', concat('City', l_suppkey), 'Recipient State Code', 'TX')))""",
        "if(l_linenumber % 2 = 0, 'Contracts', 'Grants') as award_group")
    rows.select("body", "award_group").write.partitionBy("award_group").text(path)
    rows = api.read_bodies(spark, path, whole_files=False)
    return api.usaspending(rows).select("id", "source", "url", "title", "amount", "recipient_state", "recipient")


@query("b8_propublica", r"""
select c_custkey || '-' || i as id, c_name as title, case when c_custkey % 2 = 0 then 'Paris, TX' else 'TX' end as agency,
  'NTEE: ' || case when c_custkey % 3 = 0 then '' else 'B' || c_nationkey end || ' | Score: ' || i as description
from customer, range(0, 20) t(i)""")
def _(spark, d):
    rows = bodies(spark, d, "customer", "c_custkey", """named_struct('organizations', transform(sequence(0, 24), i -> named_struct(
        'ein', concat(c_custkey, '-', i), 'name', c_name, 'city', if(c_custkey % 2 = 0, 'Paris', ''), 'state', 'TX',
        'ntee_code', if(c_custkey % 3 = 0, null, concat('B', c_nationkey)), 'score', i)))""", rows=5_000)
    return api.propublica(rows).select("id", "title", "agency", "description")


@query("b9_open_data", r"""
select o_orderkey as payload_ord, 'NY' as state, 'New York Open Data (Awarded)' as source, '' as id,
  case when o_orderkey % 2 = 0 then o_orderpriority else 'type ' || o_custkey end as title, 'auth ' || o_custkey as agency,
  strftime(o_orderdate, '%Y-%m-%d') as posted_date, '2030-06-30' as close_date,
  case when o_orderkey % 3 = 0 then 'c' || o_custkey else 'd' || o_custkey end as amount
from orders where o_orderdate >= timestamp '1996-01-01'""")
def _(spark, d):
    rows = table(spark, d, "orders").selectExpr(
        "o_orderkey as payload_ord", "0 as item_ord", "date_format(o_orderdate, 'yyyy-MM-dd') as begin_date",
        "if(o_orderkey % 2 = 0, o_orderpriority, '') as procurement_description", "concat('type ', o_custkey) as type_of_procurement",
        "concat('auth ', o_custkey) as authority_name", "'2030-06-30' as fiscal_year_end_date",
        "if(o_orderkey % 3 = 0, concat('c', o_custkey), null) as contract_amount", "concat('d', o_custkey) as amount_expended_to_date",
    )
    return api.open_data(rows, "NY", since="1996-01-01").select(
        "payload_ord", "state", "source", "id", "title", "agency", "posted_date", "close_date", "amount"
    )


# ---------------------------------------------------------- files and state
@query("a9_landed_payloads", """select p_partkey as id, p_name as title from part""")
def _(spark, d):
    path = fresh_dir(spark)
    bodies(spark, d, "part", "p_partkey", """named_struct('opportunitiesData', array(named_struct(
        'noticeId', p_partkey, 'title', p_name)))""").select("body").write.text(path)
    rows = api.sam_gov(api.read_bodies(spark, path, whole_files=False))
    return rows.select(F.col("id").cast("bigint").alias("id"), "title")


def _sources(spark, d):
    suppliers = bodies(spark, d, "supplier", "s_suppkey", """named_struct('opportunitiesData', array(named_struct(
        'noticeId', s_suppkey, 'title', s_name)))""")
    parts = bodies(spark, d, "part", "p_partkey", """named_struct('results', array(named_struct(
        'document_number', p_partkey, 'title', p_name)))""")
    return [
        ("sam", lambda: api.sam_gov(suppliers)),
        ("broken", lambda: suppliers.select("no_such_column")),
        ("register", lambda: api.federal_register(parts)),
    ]


_UNION = """
select 0 as source_ord, 'SAM.gov' as source, cast(s_suppkey as varchar) as id, s_name as title from supplier
union all select 2, 'Federal Register', cast(p_partkey as varchar), p_name from part"""


@query("a11_union_of_sources", _UNION)
def _(spark, d):
    rows, _failed = store.union_sources(_sources(spark, d))
    return rows.select("source_ord", "source", "id", "title")


@query("a11_failed_sources", """
select 'broken' as source, (select count(*) from supplier) + (select count(*) from part) as rows_of_others""")
def _(spark, d):
    rows, failed = store.union_sources(_sources(spark, d))
    names = F.transform(F.array(*[F.lit(f) for f in failed]), lambda f: F.split_part(f, F.lit(":"), F.lit(1)))
    return rows.agg(F.count("*").alias("rows_of_others")).select(F.explode(names).alias("source"), "rows_of_others")


@query("g10_union_all", """
select 'SAM.gov' as source, cast(s_suppkey as varchar) as id, s_name as title from supplier
union all select 'Federal Register', cast(p_partkey as varchar), p_name from part""")
def _(spark, d):
    good = [s for s in _sources(spark, d) if s[0] != "broken"]
    rows, _failed = store.union_sources(good)
    return rows.select("source", "id", "title")


@query("a2_append_records", with_sql(TAGGED, select="""
select rfp_id, state, keyword_match, '2024-02-01' as scrape_date from v_tag"""))
def _(spark, d):
    raw = rfps(spark, d).drop("scrape_date").withColumn("id", F.col("rfp_id")).withColumn("hash", identity.record_hash())
    path = fresh_dir(spark)
    for part in ("source < 'm'", "source >= 'm'"):
        rows = ingest.enrich(raw.filter(part), KEYWORDS, F.lit("2024-02-01 00:01:00").cast("timestamp"), EXCLUDED)
        store.append_rfps(rows, path)
    back = store.read_rfps(spark, path).filter("scrape_date = '2024-02-01'")
    return back.select("rfp_id", "state", "keyword_match", "scrape_date")


@query("a3_seen_state", with_sql(EVENTS, select="select hash, min(ts) as first_seen from v_event group by hash"))
def _(spark, d):
    state = store.seen_table(spark, fresh_dir(spark))
    ev = events(spark, d).groupBy("hash").agg(F.min("ts").alias("first_seen"))
    rows = ev.select("hash", "first_seen", F.lit("").alias("title"), F.lit("").alias("state"))
    state.write(rows.filter("hash < '5'"))
    # the second version is built from the first while that one stays readable
    state.write(state.read().unionByName(rows.filter("hash >= '5'")))
    return state.read().select("hash", F.col("first_seen").cast("timestamp_ntz").alias("first_seen"))


_OPS = """
select cast(user_id as varchar) as email, event_type as kw, case when event_id % 3 = 0 then 'remove' else 'add' end as op,
  event_id as seq from events"""


@query("a5_preference_log", _OPS)
def _(spark, d):
    path = fresh_dir(spark)
    ops = table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("email"), F.col("event_type").alias("kw"),
        F.when(F.col("event_id") % 3 == 0, "remove").otherwise("add").alias("op"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
    )
    for kind in ("op = 'add'", "op = 'remove'"):
        ops.filter(kind).write.mode("append").parquet(path)
    return store.preference_log(spark, path).select("email", "kw", "op", "seq")


@query("a6_form_responses", """
select event_id, ts, 'u' || user_id as email, case when event_id % 2 = 0 then event_type || ', "x"' else event_type || chr(10) || 'y' end as added,
  case when event_id % 4 = 0 then event_type else '' end as removed
from (select event_id, date_trunc('second', ts) as ts, user_id, event_type from events) where event_id % 7 <> 3""")
def _(spark, d):
    path = fresh_dir(spark)
    ev = table(spark, d, "events")

    def quoted(column):
        return F.concat(F.lit('"'), F.replace(column, F.lit('"'), F.lit('""')), F.lit('"'))

    added = F.when(F.col("event_id") % 2 == 0, F.concat("event_type", F.lit(', "x"'))).otherwise(F.concat("event_type", F.lit("\ny")))
    removed = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise("")
    # blanks with and without quotes, rows with and without the seventh field
    full = F.concat_ws(
        ",", F.date_format("ts", "M/d/yyyy H:mm:ss"), F.concat(F.lit("u"), F.col("user_id").cast("string")),
        F.col("event_id").cast("string"), F.lit(""), quoted(added),
        F.when((removed == "") & (F.col("event_id") % 3 == 0), "").otherwise(quoted(removed)), F.when(F.col("event_id") % 5 > 0, ""),
    )
    short = F.concat_ws(",", F.date_format("ts", "M/d/yyyy H:mm:ss"), F.lit("short row"))
    lines = ev.select(F.when(F.col("event_id") % 7 == 3, short).otherwise(full).alias("value"))
    lines.write.option("lineSep", "\n").text(path)
    rows = preferences.timed(preferences.read_responses(spark, path, header=False))
    return rows.select(
        F.col("answer_1").cast("bigint").alias("event_id"), F.col("ts").cast("timestamp_ntz").alias("ts"), "email",
        F.col("add").alias("added"), F.col("remove").alias("removed"),
    )


# ------------------------------------------------ one order over all sources
def _landed(spark, d, shuffled):
    """Lines of two kinds of payload and captured pages, of which many share an id."""
    path = fresh_dir(spark)
    bodies(spark, d, "supplier", "s_suppkey", """named_struct('opportunitiesData', array(named_struct(
        'noticeId', concat('N', s_suppkey % 40), 'title', concat('Supplier ', s_suppkey))))""").sort("payload_ord").select("body").coalesce(2).write.text(f"{path}/sam")
    bodies(spark, d, "part", "p_partkey", """named_struct('results', array(named_struct(
        'document_number', concat('N', p_partkey % 60), 'title', concat('Part ', p_partkey))))""").sort("payload_ord").select("body").coalesce(3).write.text(f"{path}/register")
    pages = table(spark, d, "customer").selectExpr(
        "0L as page_id", "concat('https://p.example.org/', lpad(c_custkey, 9, '0')) as url", "'MD' as state", "'Portal' as label",
        "concat('<table><tr><td>N', c_custkey % 90, '</td><td>Customer no ', c_custkey, '</td></tr></table>') as html")
    mixed = (lambda df: df.repartition(7)) if shuffled else (lambda df: df)
    rows, _ = store.union_sources([
        ("sam", lambda: mixed(api.sam_gov(mixed(api.read_bodies(spark, f"{path}/sam", whole_files=False))))),
        ("register", lambda: mixed(api.federal_register(mixed(api.read_bodies(spark, f"{path}/register", whole_files=False))))),
        ("portal", lambda: mixed(portal_tables(mixed(pages)))),
    ])
    return rows


@query("c2_first_over_sources", """
select source_ord, id, arg_min(title, pos) as title from (
  select 0 as source_ord, 'N' || (s_suppkey % 40) as id, 'Supplier ' || s_suppkey as title, s_suppkey as pos from supplier
  union all select 1, 'N' || (p_partkey % 60), 'Part ' || p_partkey, p_partkey from part
  union all select 2, 'N' || (c_custkey % 90), 'Customer no ' || c_custkey, c_custkey from customer) as x
where not exists (select 1 from supplier where 'N' || (s_suppkey % 40) = x.id and x.source_ord > 0)
  and not exists (select 1 from part where 'N' || (p_partkey % 60) = x.id and x.source_ord > 1)
group by source_ord, id""")
def _(spark, d):
    rows = _landed(spark, d, shuffled=True)
    return identity.first_wins(rows, ["id"], ["source_ord", "payload_ord", "item_ord"]).select("source_ord", "id", "title")


@query("a9_order_is_total", """
select (select count(*) from supplier) + (select count(distinct p_partkey % 60) from part) + (select count(*) from customer) as places""")
def _(spark, d):
    rows = _landed(spark, d, shuffled=False)
    return rows.select("source_ord", "payload_ord", "item_ord").distinct().agg(F.count("*").alias("places"))


# ------------------------------------------------------- dated memory
@query("a3_dated_memory", """
with e as (select distinct 'u' || user_id || event_type as hash, event_id % 3 as run from events)
select hash, min(run) as run from e group by hash having min(run) > 0""")
def _(spark, d):
    """Three runs; the second is lost once before its commit record and repeated, the last forgets the first one's hashes."""
    memory = DatedMemory(spark, fresh_dir(spark))
    rows = table(spark, d, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string"), "event_type").alias("hash"), F.lit("t").alias("title"), F.lit("s").alias("state"),
        (F.col("event_id") % 3).alias("run"))
    for run, day in enumerate(["2024-01-01", "2024-02-15", "2024-04-10"]):
        for _attempt in range(2):
            fresh = identity.unseen(rows.filter(F.col("run") == run).dropDuplicates(["hash"]), memory.read(f"run {run}"))
            memory.append(fresh, f"run {run}", F.lit(f"{day} 00:01:00").cast("timestamp"), 60)
    days = F.date_format("first_seen", "yyyy-MM-dd")
    return memory.read().select("hash", F.when(days == "2024-02-15", 1).when(days == "2024-04-10", 2).otherwise(0).cast("bigint").alias("run"))
