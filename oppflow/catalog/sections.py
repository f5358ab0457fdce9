"""Dashboard sections, listings and interactive questions."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from oppflow.catalog.base import (
    AWARDS, EVENTS, KEYWORDS, RFPS, TAGGED, awards, events, fresh_dir, query, rfps, tagged, with_sql,
)
from oppflow.functions.scalars import show_money, source_badge
from oppflow.operators import dashboard as D
from oppflow.operators import summary as S
from oppflow.sources import store


def stored(spark, d):
    """Tagged records with the joined keyword list, as they are stored."""
    return tagged(spark, d).withColumn("matched_keywords", F.array_join("matched_kw", ", "))


def population(spark):
    """Population of the nations that stand for states; two of them are unknown."""
    rows = [(f"NATION_{i}", 0.5 + i * 1.25) for i in range(23)]
    return spark.createDataFrame(rows, "state string, millions double")


POPULATION = "v_pop as (select 'NATION_' || i as state, 0.5 + i * 1.25 as millions from range(0, 23) t(i))"


@query("keywords_by_state", with_sql(TAGGED, select="""
select state, keyword, n, total, round_even(n * 100.0 / total, 1) as share from (
  select state, keyword, count(*) as n from (select state, unnest(matched_kw) as keyword from v_tag) group by state, keyword)
join (select state, count(*) as total from v_tag group by state) using (state)"""))
def _(spark, d):
    """How often each keyword is matched in each state, and in what share of its records."""
    rows = stored(spark, d).select("state", F.explode_outer("matched_kw").alias("keyword"), "matched_kw")
    counted = rows.groupBy("state", "keyword").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("keyword").isNull() | (F.col("keyword") == F.get("matched_kw", 0))).alias("first"),
    )
    # a record counts once towards its state: by its first keyword, or by having none
    total = F.sum("first").over(Window.partitionBy("state"))
    return counted.withColumn("total", total).filter("keyword is not null").select(
        "state", "keyword", "n", "total", F.bround(F.col("n") * 100.0 / F.col("total"), 1).alias("share")
    )


@query("f1_overview", with_sql(TAGGED, select="""
select count(*) as total_rfps, count(*) filter (keyword_match) as keyword_matches, count(distinct state) as states_covered,
  count(distinct source) as sources_active, max(scrape_date) as scrape_date from v_tag"""))
def _(spark, d):
    return S.overview(stored(spark, d))


@query("e21_corpus_header", with_sql(TAGGED, select="""
select count(*) as total_rfps, count(distinct state) as states, count(distinct source) as sources,
  count(*) filter (keyword_match) as matched, round(count(*) filter (keyword_match) * 100.0 / count(*), 1) as match_pct from v_tag"""))
def _(spark, d):
    return S.corpus_header(stored(spark, d))


_STATES = (AWARDS, POPULATION, """v_states as (
  select a.state, count(*) as total, count(*) filter (keyword_match) as matches,
    round_even(count(*) filter (keyword_match) / count(*) * 100, 1) as match_rate,
    coalesce(round_even(count(*) / any_value(millions), 1), 0) as per_capita
  from v_award a left join v_pop p on a.state = p.state group by a.state)""")


@query("f2_state_breakdown", with_sql(*_STATES, select="select state, total, matches, match_rate, per_capita from v_states"))
def _(spark, d):
    return S.state_breakdown(awards(spark, d), population(spark))


@query("h2_states_left_population", with_sql(*_STATES, select="select state, per_capita from v_states"))
def _(spark, d):
    return S.state_breakdown(awards(spark, d), population(spark)).select("state", "per_capita")


_SOURCES = with_sql(TAGGED, select="""
select source, count(*) as total, count(*) filter (keyword_match) as matches from v_tag group by source""")


@query("f3_source_performance", _SOURCES)
def _(spark, d):
    return S.source_performance(stored(spark, d))


_RECIPIENTS = """v_recip as (
  select r.recipient, count(*) as count, round(sum(o_totalprice), 2) as total_amount, any_value(recipient_state) as location,
    (select string_agg(pi_name, '; ' order by pi_name) from (
      select distinct pi_name from v_award x where x.recipient = r.recipient order by pi_name limit 3)) as pi_names
  from v_award r group by r.recipient order by count desc, r.recipient limit 30)"""


@query("f4_top_recipients", with_sql(AWARDS, _RECIPIENTS, select="select recipient as name, count, total_amount, location, pi_names from v_recip"))
def _(spark, d):
    return S.top_recipients(awards(spark, d))


@query("j3_recipient_search", with_sql(AWARDS, _RECIPIENTS, select="""
select recipient as name, count from v_recip where contains(lower(recipient || ' ' || location || ' ' || pi_names), 'nation_1')"""))
def _(spark, d):
    return D.search_recipients(S.top_recipients(awards(spark, d)), "Nation_1 ").select("name", "count")


@query("f5_daily_counts", with_sql(AWARDS, select="""
select scrape_date, count(*) as new_rfps, count(*) filter (keyword_match) as new_matches from v_award group by scrape_date"""))
def _(spark, d):
    return S.daily_counts(awards(spark, d))


@query("g1_cumulative_counts", with_sql(AWARDS, select="""
select scrape_date, count(*) as new_rfps, count(*) filter (keyword_match) as new_matches,
  cast(sum(count(*)) over w as bigint) as cumulative_rfps, cast(sum(count(*) filter (keyword_match)) over w as bigint) as cumulative_matches
from v_award group by scrape_date window w as (order by scrape_date rows unbounded preceding)"""))
def _(spark, d):
    return S.cumulative_counts(S.daily_counts(awards(spark, d)))


_KEYWORDS = (TAGGED, """v_kw as (
  select row_number() over (order by count(*) desc, keyword) as rank, keyword, count(*) as count
  from (select unnest(matched_kw) as keyword from v_tag) group by keyword)""")


@query("f6_keyword_frequency", with_sql(*_KEYWORDS, select="select rank, keyword, count from v_kw where rank <= 20"))
def _(spark, d):
    return S.keyword_frequency(stored(spark, d))


@query("g6_top_k", with_sql(AWARDS, select="""
select pos, recipient, amount from v_award order by o_totalprice desc, pos limit 50"""))
def _(spark, d):
    from oppflow.functions.scalars import parse_money
    rows = awards(spark, d).orderBy(parse_money(F.col("amount")).desc(), "pos").limit(50)
    return rows.select("pos", "recipient", "amount")


@query("d14_source_badge", with_sql(TAGGED, select="""
select source, case when count(*) = 0 then 'No Data' when count(*) filter (keyword_match) > 0 then 'Active' else 'No Matches' end as badge
from v_tag group by source"""))
def _(spark, d):
    rows = S.source_performance(stored(spark, d))
    return rows.select("source", source_badge(F.col("total"), F.col("matches")).alias("badge"))


_BUCKETS = """v_bucket as (
  select s.state, s.per_capita, s.total, s.matches, case when s.per_capita > 0 and s.state <> 'Federal' then
    cast(least(floor((ln(s.per_capita) - lo) / case when hi = lo then 1 else hi - lo end * 9), 8) as integer) end as bucket
  from v_states s, (select ln(min(per_capita)) as lo, ln(max(per_capita)) as hi from v_states where per_capita > 0))"""


@query("d15_log_buckets", with_sql(*_STATES, _BUCKETS, select="select state, bucket from v_bucket"))
def _(spark, d):
    return D.map_buckets(S.state_breakdown(awards(spark, d), population(spark))).select("state", "bucket")


@query("j4_state_map", with_sql(*_STATES, _BUCKETS, select="select state, per_capita, total, matches, bucket from v_bucket"))
def _(spark, d):
    return D.map_buckets(S.state_breakdown(awards(spark, d), population(spark)))


@query("d16_share_of_max", with_sql(*_KEYWORDS, select="""
select keyword, count, round(count / (select max(count) from v_kw) * 100, 1) as pct from v_kw where rank <= 20"""))
def _(spark, d):
    return D.share_of_max(S.keyword_frequency(stored(spark, d)), "count").select("keyword", "count", "pct")


@query("recipient_amounts_shown", with_sql(AWARDS, _RECIPIENTS, select="""
select recipient as name, case when total_amount >= 1e6 then '$' || format('{:.1f}', total_amount / 1e6) || 'M'
  when total_amount >= 1e3 then '$' || format('{:.0f}', total_amount / 1e3) || 'K' else '$' || total_amount end as shown from v_recip"""))
def _(spark, d):
    return S.top_recipients(awards(spark, d)).select("name", show_money(F.col("total_amount")).alias("shown"))


# ----------------------------------------------------------------- listings
_LIST = """v_list as (
  select left(title, 120) as title, state, left(agency, 80) as agency, source, keyword_match, scrape_date, pos from v_tag)"""


@query("b20_full_database", with_sql(TAGGED, _LIST, select="""
select title, state, agency, source, keyword_match, scrape_date, pos from v_list"""))
def _(spark, d):
    rows = D.full_database(stored(spark, d), "pos", "scrape_date")
    return D.newest_first(rows, "scrape_date", "pos").select("title", "state", "agency", "source", "keyword_match", "scrape_date", "pos")


@query("g5_sorted_listing", with_sql(TAGGED, _LIST, select="""
select scrape_date, pos, state from v_list order by scrape_date desc, pos"""))
def _(spark, d):
    return D.newest_first(stored(spark, d), "scrape_date", "pos").select("scrape_date", "pos", "state")


@query("g7_page_at_offset", with_sql(TAGGED, _LIST, select="""
select scrape_date, pos, title from v_list order by scrape_date desc, pos limit 100 offset 200"""))
def _(spark, d):
    rows = D.full_database(stored(spark, d), "pos", "scrape_date")
    return D.page(rows, [F.desc("scrape_date"), F.asc("pos")], 2).select("scrape_date", "pos", "title")


@query("g7_page_after_key", with_sql(TAGGED, _LIST, select="""
select scrape_date, pos, title from v_list where scrape_date < '2024-01-20' or (scrape_date = '2024-01-20' and pos > 400)
order by scrape_date desc, pos limit 100"""))
def _(spark, d):
    rows = D.full_database(stored(spark, d), "pos", "scrape_date")
    last = {"scrape_date": "2024-01-20", "pos": 400}
    return D.page_after(rows, [("scrape_date", False), ("pos", True)], last).select("scrape_date", "pos", "title")


@query("j1_search", with_sql(TAGGED, select="""
select pos, title from v_tag where state = 'en' and keyword_match
  and contains(lower(concat_ws(' ', title, agency, state, source)), 'the')"""))
def _(spark, d):
    return D.search(stored(spark, d), " The ", state="en", matches_only=True).select("pos", "title")


@query("j2_facets", with_sql(RFPS, select="""
select 'state' as facet, state as value from v_rfp where state <> '' group by state
union all select 'source', source from v_rfp where source <> '' group by source"""))
def _(spark, d):
    records = rfps(spark, d)
    state = D.facets(records, "state").select(F.lit("state").alias("facet"), F.col("state").alias("value"))
    return state.unionByName(D.facets(records, "source").select(F.lit("source").alias("facet"), F.col("source").alias("value")))


@query("a7_dashboard_files", with_sql(TAGGED, select="""
select 'states' as section, state as name, count(*) as total from v_tag group by state
union all select 'sources', source, count(*) from v_tag group by source"""))
def _(spark, d):
    path = fresh_dir(spark)
    records = stored(spark, d)
    store.write_sections(
        {"states": S.state_breakdown(records, population(spark)), "sources": S.source_performance(records)}, path
    )
    states = spark.read.schema("state string, total bigint").json(f"{path}/states")
    sources = spark.read.schema("source string, total bigint").json(f"{path}/sources")
    return states.select(F.lit("states").alias("section"), F.col("state").alias("name"), "total").unionByName(
        sources.select(F.lit("sources").alias("section"), F.col("source").alias("name"), "total")
    )
