"""Scan, identity, tagging, scalar rules."""
from pyspark.sql import functions as F

from oppflow.catalog.base import (
    COMBINED, EVENTS, EXCLUDED, KEYWORDS, RFPS, STOP_SQL, TAGGED, _ANY_EXCLUDED, _ANY_KEYWORD,
    events, query, rfps, table, tagged, with_sql,
)
from oppflow.functions import scalars as S
from oppflow.functions.text import bigrams, bind, combined_text, match_text, tokens
from oppflow.operators import identity
from oppflow.operators.tagging import excluded, key_terms, keywords_in
from oppflow.plans.ingest import enrich, typed_dates, windows_back


@query("a1_scan_records", with_sql(RFPS, select="select rfp_id, state, source, title, scrape_date, pos from v_rfp"))
def _(spark, d):
    return rfps(spark, d).select("rfp_id", "state", "source", "title", "scrape_date", "pos")


# ----------------------------------------------------------------- identity
_HASHED = RFPS + """,
v_hash as (select *, left(sha256(concat_ws('-', state, '', title)), 16) as hash from v_rfp)"""


def hashed(spark, d):
    """Copies of a title in one state collide on purpose."""
    return rfps(spark, d).withColumn("id", F.lit("")).withColumn("hash", identity.record_hash())


@query("c1_record_hash", with_sql(_HASHED, select="select pos, hash from v_hash"))
def _(spark, d):
    return hashed(spark, d).select("pos", "hash")


@query("c2_first_wins_in_batch", with_sql(_HASHED, select="""
select hash, min(pos) as pos, arg_min(title, pos) as title, arg_min(source, pos) as source from v_hash group by hash"""))
def _(spark, d):
    return identity.first_wins(hashed(spark, d), ["hash"], ["pos"]).select("hash", "pos", "title", "source")


_HALVES = EVENTS + """,
v_seen as (select hash, min(ts) as first_seen from v_event where ts < timestamp '2024-01-03' group by hash),
v_new as (select hash, min(event_id) as event_id from v_event where ts >= timestamp '2024-01-03' group by hash)"""


def halves(spark, d):
    """The first days of the month as memory, the others as the new run."""
    ev = events(spark, d)
    split = F.lit("2024-01-03").cast("timestamp")
    seen = ev.filter(F.col("ts") < split).groupBy("hash").agg(F.min("ts").alias("first_seen")).select(
        "hash", "first_seen", F.lit("").alias("title"), F.lit("").alias("state")
    )
    run = ev.filter(F.col("ts") >= split).withColumn("title", F.lit("")).withColumn("state", F.lit(""))
    return seen, run


def _fresh(spark, d):
    seen, run = halves(spark, d)
    return seen, identity.unseen(identity.first_wins(run, ["hash"], ["event_id"]), seen)


_UNSEEN = with_sql(_HALVES, select="select hash, event_id from v_new where hash not in (select hash from v_seen)")


@query("c3_drop_seen", _UNSEEN)
def _(spark, d):
    return _fresh(spark, d)[1].select("hash", "event_id")


@query("h1_records_anti_seen", _UNSEEN)
def _(spark, d):
    return _fresh(spark, d)[1].select("hash", "event_id")


@query("c4_remember_new", with_sql(_HALVES, select="""
select hash, first_seen from v_seen union all
select hash, timestamp '2024-02-01' from v_new where hash not in (select hash from v_seen)"""))
def _(spark, d):
    seen, fresh = _fresh(spark, d)
    now = F.lit("2024-02-01").cast("timestamp")
    return identity.remember(seen, fresh, now).select("hash", F.col("first_seen").cast("timestamp_ntz").alias("first_seen"))


@query("c5_forget_expired", with_sql(_HALVES, select="""
select hash, first_seen from v_seen where first_seen >= timestamp '2024-04-03 06:00:00' - interval 90 day"""))
def _(spark, d):
    seen, _run = halves(spark, d)
    kept = identity.forget(seen, F.lit("2024-04-03 06:00:00").cast("timestamp"))
    return kept.select("hash", F.col("first_seen").cast("timestamp_ntz").alias("first_seen"))


@query("c6_first_query_wins", """
select l_partkey as id, arg_min(l_orderkey, struct_pack(a := l_suppkey, b := l_orderkey, c := l_linenumber)) as l_orderkey,
       min(l_suppkey) as query_ord
from lineitem group by l_partkey""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("query_ord"), "l_orderkey", "l_linenumber"
    )
    return identity.first_wins(rows, ["id"], ["query_ord", "l_orderkey", "l_linenumber"]).select("id", "l_orderkey", "query_ord")


@query("g2_first_wins_numbering", with_sql(_HASHED, select="""
select pos, hash, row_number() over (partition by hash order by pos) as nth from v_hash qualify nth <= 2"""))
def _(spark, d):
    from oppflow.operators.ranking import top_per_group
    return top_per_group(hashed(spark, d), ["hash"], [F.asc("pos")], 2).select("pos", "hash", F.col("rank").alias("nth"))


@query("c9_run_report", with_sql(TAGGED, select="""
select count(*) as new_rfps, count(*) filter (keyword_match) as matched, count(*) filter (not keyword_match) as unmatched from v_tag"""))
def _(spark, d):
    return identity.run_report(tagged(spark, d))


# ------------------------------------------------------------------ tagging
@query("d1_match_text", with_sql(RFPS, select="select pos, concat_ws(' ', title, description, agency) as text from v_rfp"))
def _(spark, d):
    return rfps(spark, d).select("pos", match_text().alias("text"))


@query("d2_exclusion_test", with_sql(RFPS, select=rf"""
select pos, regexp_matches(concat_ws(' ', title, description, agency), '{_ANY_EXCLUDED}') as excluded from v_rfp"""))
def _(spark, d):
    return rfps(spark, d).select("pos", excluded(match_text(), EXCLUDED).alias("excluded"))


@query("d3_keyword_extraction", with_sql(RFPS, select=rf"""
select pos, hit, count(*) as n from (
  select pos, unnest(regexp_extract_all(concat_ws(' ', title, description, agency), '{_ANY_KEYWORD}')) as hit from v_rfp)
group by pos, hit"""))
def _(spark, d):
    from oppflow.functions.phrases import phrase_pattern
    found = F.regexp_extract_all(match_text(), F.lit(phrase_pattern(KEYWORDS)), F.lit(0))
    return rfps(spark, d).select("pos", F.explode(found).alias("hit")).groupBy("pos", "hit").agg(F.count("*").alias("n"))


@query("d4_distinct_keywords_in_order", with_sql(RFPS, select=rf"""
select pos, array_to_string(list_filter(hits, lambda x, i: list_position(hits, x) = i), '|') as keywords from (
  select pos, list_transform(regexp_extract_all(concat_ws(' ', title, description, agency), '{_ANY_KEYWORD}'),
                             lambda x: lower(x)) as hits from v_rfp)"""))
def _(spark, d):
    return rfps(spark, d).select("pos", F.array_join(keywords_in(match_text(), KEYWORDS), "|").alias("keywords"))


@query("d5_tag_records", with_sql(TAGGED, select="""
select pos, keyword_match, array_to_string(matched_kw, ', ') as matched_keywords from v_tag"""))
def _(spark, d):
    return tagged(spark, d).select("pos", "keyword_match", F.array_join("matched_kw", ", ").alias("matched_keywords"))


# ------------------------------------------------------------- scalar rules
# text of many shapes derived from orders: dates, amounts, links, lists
_SHAPES = r"""v_shape as (
  select o_orderkey as pos,
    case o_orderkey % 4
      when 0 then 'Closes ' || strftime(o_orderdate, '%m/%d/%Y')
      when 1 then strftime(o_orderdate, '%Y-%m-%d')
      when 2 then o_orderpriority
      else strftime(o_orderdate, '%d-%m-%y') || ' 2:00 PM' end as date_text,
    case o_orderkey % 5
      when 0 then '$' || format('{:,.2f}', o_totalprice)
      when 1 then format('{:.2f}', o_totalprice)
      when 2 then cast(o_custkey as varchar)
      when 3 then 'n/a'
      else cast(o_custkey as varchar) || 'd' end as money_text,
    case o_orderkey % 7
      when 0 then '/bids/view?bidId=' || o_orderkey
      when 1 then 'https://x.example.org/a/' || o_orderkey || '/'
      when 2 then 'doc/' || o_orderkey || '?page=2'
      when 3 then '/list/default.aspx'
      when 4 then '?number=N' || o_orderkey
      when 5 then ''
      else '//cdn.example.org/s/' || o_orderkey || '#top' end as href,
    case when o_orderkey % 2 = 0 then ' ' || o_orderpriority || ', A' || o_custkey || ' ,, b' || chr(10) || 'c'
         else o_orderpriority || chr(10) || chr(10) || ' B' || o_custkey end as list_text,
    case o_orderkey % 5 when 0 then 0.0 when 1 then round(o_totalprice / 1000, 2) when 2 then o_totalprice
         when 3 then o_totalprice * 1000 else o_totalprice * 100000 end as money
  from orders)"""


def shapes(spark, d):
    key = F.col("o_orderkey")
    text = key.cast("string")
    return table(spark, d, "orders").select(
        key.alias("pos"),
        F.when(key % 4 == 0, F.concat(F.lit("Closes "), F.date_format("o_orderdate", "MM/dd/yyyy")))
        .when(key % 4 == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(key % 4 == 2, F.col("o_orderpriority"))
        .otherwise(F.concat(F.date_format("o_orderdate", "dd-MM-yy"), F.lit(" 2:00 PM"))).alias("date_text"),
        F.when(key % 5 == 0, F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
        .when(key % 5 == 1, F.format_string("%.2f", "o_totalprice"))
        .when(key % 5 == 2, F.col("o_custkey").cast("string"))
        .when(key % 5 == 3, "n/a")
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit("d"))).alias("money_text"),
        F.when(key % 7 == 0, F.concat(F.lit("/bids/view?bidId="), text))
        .when(key % 7 == 1, F.concat(F.lit("https://x.example.org/a/"), text, F.lit("/")))
        .when(key % 7 == 2, F.concat(F.lit("doc/"), text, F.lit("?page=2")))
        .when(key % 7 == 3, "/list/default.aspx")
        .when(key % 7 == 4, F.concat(F.lit("?number=N"), text))
        .when(key % 7 == 5, "")
        .otherwise(F.concat(F.lit("//cdn.example.org/s/"), text, F.lit("#top"))).alias("href"),
        F.when(
            key % 2 == 0,
            F.concat(F.lit(" "), "o_orderpriority", F.lit(", A"), F.col("o_custkey").cast("string"), F.lit(" ,, b\nc")),
        ).otherwise(F.concat("o_orderpriority", F.lit("\n\n B"), F.col("o_custkey").cast("string"))).alias("list_text"),
        F.when(key % 5 == 0, 0.0).when(key % 5 == 1, F.round(F.col("o_totalprice") / 1000, 2))
        .when(key % 5 == 2, F.col("o_totalprice")).when(key % 5 == 3, F.col("o_totalprice") * 1000)
        .otherwise(F.col("o_totalprice") * 100000).alias("money"),
    )


@query("d6_date_like", with_sql(_SHAPES, select=r"""
select pos, date_text, regexp_matches(date_text, '[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4}') as is_date from v_shape"""))
def _(spark, d):
    return shapes(spark, d).select("pos", "date_text", S.looks_like_date(F.col("date_text")).alias("is_date"))


@query("d7_amount_like", with_sql(_SHAPES, select=r"""
select pos, money_text, money_text like '%$%' or
  (translate(money_text, '0123456789,.', '') = '' and length(money_text) > 3) as is_amount from v_shape"""))
def _(spark, d):
    return shapes(spark, d).select("pos", "money_text", S.looks_like_amount(F.col("money_text")).alias("is_amount"))


@query("d8_id_from_url", with_sql(_SHAPES, select=r"""
select pos, href, case pos % 7 when 0 then cast(pos as varchar) when 1 then cast(pos as varchar) when 2 then cast(pos as varchar)
  when 4 then 'N' || pos when 6 then pos || '#top' else '' end as url_id from v_shape"""))
def _(spark, d):
    return shapes(spark, d).select("pos", "href", S.id_from_url(F.col("href")).alias("url_id"))


@query("d9_absolute_url", with_sql(_SHAPES, select=r"""
select pos, case pos % 7 when 0 then 'https://p.example.org' || href when 1 then href
  when 2 then 'https://p.example.org/bids/' || href when 3 then 'https://p.example.org' || href
  when 4 then 'https://p.example.org/bids/list' || href when 5 then '' else 'https:' || href end as url from v_shape"""))
def _(spark, d):
    base = F.lit("https://p.example.org/bids/list?x=1")
    return shapes(spark, d).select("pos", S.absolute_url(base, F.col("href")).alias("url"))


@query("d10_parse_money", with_sql(_SHAPES, select=r"""
select pos, coalesce(case when not regexp_matches(money_text, '[a-zA-Z]')
  then try_cast(replace(replace(money_text, '$', ''), ',', '') as double) end, 0) as amount from v_shape"""))
def _(spark, d):
    return shapes(spark, d).select("pos", S.parse_money(F.col("money_text")).alias("amount"))


@query("d11_date_windows", """
select strftime(cast(o as date) - cast(least(s + 90, 3650) as integer), '%m/%d/%Y') as from_date,
       strftime(cast(o as date) - cast(s as integer), '%m/%d/%Y') as to_date, s // 90 as chunk, cast(o as date) as day
from (select distinct o_orderdate as o from orders), range(0, 3650, 90) t(s)""")
def _(spark, d):
    days = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return windows_back(days, "day", 3650, 90).select("from_date", "to_date", F.col("chunk").cast("bigint").alias("chunk"), "day")


@query("d12_parse_list", with_sql(_SHAPES, select=r"""
select pos, array_to_string(list_filter(list_transform(
  case when contains(list_text, ',') then string_split(list_text, ',') else string_split(list_text, chr(10)) end,
  lambda x: lower(trim(x, ' ' || chr(10)))), lambda x: x <> ''), '|') as items from v_shape"""))
def _(spark, d):
    return shapes(spark, d).select("pos", F.array_join(S.parse_list(F.col("list_text")), "|").alias("items"))


@query("d13_show_money", with_sql(_SHAPES, select=r"""
select pos, case when money = 0 then '—'
  when money >= 1e9 then '$' || format('{:.1f}', money / 1e9 + if((money / 1e9 * 4) % 2 = 1, 0.01, 0)) || 'B'
  when money >= 1e6 then '$' || format('{:.1f}', money / 1e6 + if((money / 1e6 * 4) % 2 = 1, 0.01, 0)) || 'M'
  when money >= 1e3 then '$' || format('{:.0f}', money / 1e3 + if((money / 1e3 * 2) % 2 = 1, 0.1, 0)) || 'K'
  else '$' || rtrim(rtrim(format('{:.3f}', money), '0'), '.') end as shown from v_shape"""))
def _(spark, d):
    return shapes(spark, d).select("pos", S.show_money(F.col("money")).alias("shown"))


# ------------------------------------------------------------- record terms
_TEXTS = RFPS + f",\nv_text as (select *, {COMBINED} as ctext from v_rfp)"
_TOKENS = _TEXTS + rf""",
v_words as (
  select *, list_filter(string_split_regex(lower(ctext), '[^\p{{L}}\p{{N}}_]+'),
    lambda x: length(x) >= 3 and not regexp_full_match(x, '\p{{Nd}}+') and x not in {STOP_SQL}) as words
  from v_text),
v_pairs as (
  select pos, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) as term from v_words)"""


@query("e1_combined_text", with_sql(_TEXTS, select="select pos, ctext as text from v_text"))
def _(spark, d):
    return rfps(spark, d).select("pos", combined_text().alias("text"))


@query("e2_tokens", with_sql(_TOKENS, select="""
select word, count(*) as n from (select unnest(words) as word from v_words) group by word"""))
def _(spark, d):
    words = rfps(spark, d).select(F.explode(tokens(combined_text())).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query("e3_word_pairs", with_sql(_TOKENS, select="select term, count(*) as n from v_pairs group by term"))
def _(spark, d):
    pairs = rfps(spark, d).select(F.explode(bind(tokens(combined_text()), bigrams)).alias("term"))
    return pairs.groupBy("term").agg(F.count("*").alias("n"))


@query("e4_key_terms", with_sql(_TOKENS, select="""
select pos, rank, term from (
  select pos, term, row_number() over (partition by pos order by count(*) desc, term) as rank from v_pairs group by pos, term)
where rank <= 10
union all select pos, 1, words[1] from v_words where len(words) = 1"""))
def _(spark, d):
    terms = rfps(spark, d).select("pos", F.posexplode(key_terms(combined_text())).alias("i", "term"))
    return terms.select("pos", (F.col("i") + 1).cast("bigint").alias("rank"), "term")


_KEYS = _TOKENS + """,
v_tops as (select pos, string_agg(term, ', ' order by rank) as key_terms from (
  select pos, term, row_number() over (partition by pos order by count(*) desc, term) as rank from v_pairs group by pos, term)
  where rank <= 10 group by pos
  union all select pos, words[1] from v_words where len(words) = 1)"""


@query("b19_canonical_record", with_sql(_KEYS, TAGGED.replace(RFPS + ",", "").lstrip(), select="""
select t.rfp_id, left(sha256(concat_ws('-', t.state, t.rfp_id, t.title)), 16) as hash, t.source, t.state, t.title, t.agency,
  '' as status, '' as url, t.description, t.keyword_match, array_to_string(t.matched_kw, ', ') as matched_keywords,
  coalesce(k.key_terms, '') as key_terms, '2024-02-01' as scrape_date, timestamp '2024-02-01 00:01:00' as scrape_timestamp
from v_tag t left join v_tops k using (pos)"""))
def _(spark, d):
    raw = rfps(spark, d).drop("scrape_date").withColumn("id", F.col("rfp_id")).withColumn("hash", identity.record_hash())
    now = F.lit("2024-02-01 00:01:00").cast("timestamp")
    rows = enrich(raw, KEYWORDS, now, EXCLUDED)
    return rows.select(
        "rfp_id", "hash", "source", "state", "title", "agency", "status", "url", "description", "keyword_match",
        "matched_keywords", "key_terms", "scrape_date", F.col("scrape_timestamp").cast("timestamp_ntz").alias("scrape_timestamp"),
    )


@query("typed_dates", """
select o_orderkey as pos, cast(o_orderdate as timestamp) as posted_ts,
  case when o_orderkey % 3 = 2 then null else cast(cast(o_orderdate as date) + 30 as timestamp) end as close_ts from orders""")
def _(spark, d):
    key = F.col("o_orderkey")
    closes = F.date_add(F.col("o_orderdate").cast("date"), 30)
    rows = table(spark, d, "orders").select(
        key.alias("pos"),
        F.when(key % 2 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("posted_date"),
        F.when(key % 3 == 0, F.date_format(closes, "yyyy-MM-dd'T'HH:mm:ss")).when(key % 3 == 1, F.date_format(closes, "M/d/yyyy"))
        .otherwise("until filled").alias("close_date"),
    )
    return typed_dates(rows).select(
        "pos", F.col("posted_ts").cast("timestamp_ntz").alias("posted_ts"), F.col("close_ts").cast("timestamp_ntz").alias("close_ts")
    )
