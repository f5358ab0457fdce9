"""Digests and keyword preferences."""
from pyspark.sql import functions as F

from oppflow.catalog.base import (
    AS_OF, AWARDS, MEMBERS, RFPS, TAGGED, awards, fresh_dir, query, rfps, table, tagged, with_sql,
)
from oppflow.functions.text import match_text
from oppflow.operators import digest as G
from oppflow.operators import preferences as P
from oppflow.operators.matching import phrase_hits
from oppflow.plans.preference_sync import PreferenceStore, digest_patterns, sync
from oppflow.schema import RFP_TEXT_COLUMNS
from oppflow.session import cut

_EMPTY = ["status", "posted_date", "close_date", "url", "recipient", "recipient_state", "pi_name"]
LABELS = "v_label(state, label, ord) as (values ('de', 'Germany', 0), ('en', 'England', 1), ('NATION_7', 'Seventh', 2), ('NATION_3', 'Third', 3))"


def labels(spark):
    rows = [("de", "Germany", 0), ("en", "England", 1), ("NATION_7", "Seventh", 2), ("NATION_3", "Third", 3)]
    return spark.createDataFrame(rows, "state string, label string, ord int")


def stored(spark, d):
    df = tagged(spark, d)
    for c in _EMPTY:
        df = df.withColumn(c, F.lit(""))
    return df


_DAY = f"v_day as (select * from v_tag where keyword_match and scrape_date = '{AS_OF}')"
_WEEK = "v_week as (select * from v_tag where keyword_match and scrape_date >= '2024-01-13')"


@query("i1_matches_of_the_day", with_sql(TAGGED, _DAY, select="select pos, state, scrape_date from v_day"))
def _(spark, d):
    return G.on_day(stored(spark, d), AS_OF).select("pos", "state", "scrape_date")


@query("i2_matches_of_the_week", with_sql(TAGGED, _WEEK, select="select pos, state, scrape_date from v_week"))
def _(spark, d):
    return G.past_week(stored(spark, d), AS_OF).select("pos", "state", "scrape_date")


_ROWS = """
select coalesce(l.ord, 1000000) as ord, a.state, coalesce(l.label, a.state) as label,
  cast(count(*) over (partition by a.state) as bigint) as group_rows, bool_or(recipient <> '') over (partition by a.state) as has_recipient,
  coalesce(nullif(title, ''), '—') as title, case when bool_or(recipient <> '') over (partition by a.state) then
    case when recipient <> '' and recipient_state <> '' then recipient || ', ' || recipient_state else coalesce(nullif(recipient, ''), '—') end
  end as recipient_shown, pos from v_dig a left join v_label l on a.state = l.state"""
_DIGEST_AWARDS = """v_dig as (select pos, state, 'Award ' || pos as title, case when source = 'MACHINERY' then '' else recipient end as recipient,
  case when pos % 5 = 0 then '' else recipient_state end as recipient_state from v_award)"""


def award_rows(spark, d):
    rows = awards(spark, d).withColumn("title", F.concat(F.lit("Award "), F.col("pos").cast("string")))
    rows = rows.withColumn("recipient", F.when(F.col("source") == "MACHINERY", "").otherwise(F.col("recipient")))
    rows = rows.withColumn("recipient_state", F.when(F.col("pos") % 5 == 0, "").otherwise(F.col("recipient_state")))
    for c in RFP_TEXT_COLUMNS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(""))
    return rows


@query("i3_digest_rows", with_sql(AWARDS, LABELS, _DIGEST_AWARDS, select=_ROWS))
def _(spark, d):
    rows = G.digest_rows(award_rows(spark, d), labels(spark), "pos")
    return rows.select("ord", "state", "label", "group_rows", "has_recipient", "title", "recipient_shown", "pos")


@query("h3_state_labels", with_sql(AWARDS, LABELS, select="""
select a.state, coalesce(label, a.state) as label, coalesce(ord, 1000000) as ord, count(*) as n
from v_award a left join v_label l on a.state = l.state group by all"""))
def _(spark, d):
    return G.state_counts(awards(spark, d), labels(spark)).select("state", "label", "ord", "n")


@query("i4_plain_listing", with_sql(AWARDS, _DIGEST_AWARDS, select=r"""
select pos, '[' || state || '] ' || title || chr(10) || '  ID:   |  Agency: ' || chr(10) || '  Status:   |  Closes: ' || chr(10)
  || case when recipient <> '' then '  Recipient: ' || recipient || case when recipient_state <> '' then ' (' || recipient_state || ')' else '' end || chr(10) else '' end
  || '  ' || chr(10) as entry from v_dig"""))
def _(spark, d):
    rows = award_rows(spark, d).withColumn("pi_name", F.lit(""))
    return rows.select("pos", G.plain_entry().alias("entry"))


_COUNTS = """
select cast(sum(n) as bigint) as n, string_agg(n || ' ' || label, ', ' order by ord, state) as summary from (
  select a.state, coalesce(label, a.state) as label, coalesce(ord, 1000000) as ord, count(*) as n
  from {view} a left join v_label l on a.state = l.state group by all)"""


@query("f8_counts_line", with_sql(AWARDS, LABELS, select=_COUNTS.format(view="v_award")))
def _(spark, d):
    return G.counts_line(G.state_counts(awards(spark, d), labels(spark)))


@query("f9_group_flags", with_sql(AWARDS, """v_flag as (
  select state, case when state < 'NATION_2' then '' else recipient end as recipient, case when pos % 2 = 0 then '' else pi_name end as pi_name from v_award)""",
  select="""select state, count(*) as group_rows, bool_or(recipient <> '') as has_recipient, bool_or(pi_name <> '') as has_pi
from v_flag group by state"""))
def _(spark, d):
    rows = awards(spark, d)
    rows = rows.withColumn("recipient", F.when(F.col("state") < "NATION_2", "").otherwise(F.col("recipient")))
    return G.group_flags(rows.withColumn("pi_name", F.when(F.col("pos") % 2 == 0, "").otherwise(F.col("pi_name"))))


# ---------------------------------------------------------- personal digests
def members(spark):
    return spark.createDataFrame(MEMBERS, "name string, email string, patterns array<string>")


def base_patterns(spark):
    return members(spark).select("email", F.explode("patterns").alias("pattern"))


_MEMBER_SQL = "v_pattern(email, pattern) as (values " + ", ".join(
    f"('{email}', '{p}')" for _, email, patterns in MEMBERS for p in patterns
) + ")"
_HITS = """v_hit as (
  select distinct email, pos, state from v_week, v_pattern
  where contains(lower(concat_ws(' ', title, description, agency)), lower(pattern)))"""
_ALL_HITS = """
select distinct email, pos from v_tag, v_pattern where contains(lower(concat_ws(' ', title, description, agency)), lower(pattern))"""


@query("h6_members_by_pattern", with_sql(TAGGED, _MEMBER_SQL, select=_ALL_HITS))
def _(spark, d):
    return G.personal_hits(stored(spark, d), "pos", base_patterns(spark))


@query("h6_members_by_pattern_large_dictionary", with_sql(TAGGED, _MEMBER_SQL, select=_ALL_HITS))
def _(spark, d):
    """The same hits where members' patterns lie among all first lines of the corpus."""
    lowered = base_patterns(spark).select("email", F.lower("pattern").alias("phrase"))
    records = stored(spark, d)
    texts = records.select("pos", F.lower(match_text()).alias("text"))
    lines = records.select(F.lower("title").alias("phrase"))
    hits = phrase_hits(texts, "pos", "text", lowered.select("phrase").unionByName(lines).distinct())
    return hits.join(lowered, "phrase").select("email", "pos").distinct()


@query("h6_texts_per_phrase", with_sql(RFPS, """v_low as (select pos, lower(concat_ws(' ', title, description, agency)) as text from v_rfp),
v_phrase as (select distinct lower(substr(description, 101, 24)) as phrase from v_rfp where length(description) > 101)""", select="""
select phrase, count(*) as n from v_phrase join v_low on contains(text, phrase) group by phrase"""))
def _(spark, d):
    """How many records hold each of as many phrases as there are records; most share their starts with others."""
    records = rfps(spark, d)
    texts = records.select("pos", F.lower(match_text()).alias("text"))
    phrases = records.filter(F.length("description") > 101).select(F.lower(F.substring("description", 101, 24)).alias("phrase")).distinct()
    return phrase_hits(texts, "pos", "text", phrases).groupBy("phrase").agg(F.count("*").alias("n"))


def _week(spark, d):
    """Matched records of the week, tagged once and written."""
    return cut(G.past_week(stored(spark, d), AS_OF).select("pos", "state", "title", "description", "agency"))


@query("i5_personal_digest", with_sql(TAGGED, _WEEK, _MEMBER_SQL, _HITS, select="select email, pos, state from v_hit"))
def _(spark, d):
    return G.personal_digest(_week(spark, d), "pos", base_patterns(spark), "state")


@query("i6_personal_headers", with_sql(TAGGED, _WEEK, _MEMBER_SQL, LABELS, _HITS, select="""
select email, case email when 'a@example.org' then 'Ada' when 'b@example.org' then 'Bo' else 'Cy' end as first_name,
  cast(sum(n) as bigint) as n, string_agg(n || ' ' || label, ', ' order by ord, state) as summary,
  'Weekly RFP Digest: ' || cast(sum(n) as bigint) || ' Matches for ' ||
    case email when 'a@example.org' then 'Ada' when 'b@example.org' then 'Bo' else 'Cy' end || ' — January 20, 2024' as subject
from (select email, h.state, coalesce(label, h.state) as label, coalesce(ord, 1000000) as ord, count(*) as n
  from v_hit h left join v_label l on h.state = l.state group by all) group by email"""))
def _(spark, d):
    week = _week(spark, d)
    found = G.interests(week, "pos", base_patterns(spark))
    return G.personal_headers(found, week, "pos", members(spark), labels(spark), AS_OF)


@query("i6_daily_header", with_sql(TAGGED, _DAY, LABELS, select="""
select n, summary, 'RFP Alert: ' || n || ' New Matches — January 20, 2024' as subject from (""" + _COUNTS.format(view="v_day") + ")"))
def _(spark, d):
    line = G.counts_line(G.state_counts(G.on_day(stored(spark, d), AS_OF), labels(spark)))
    return line.select("n", "summary", G.subject("daily", F.col("n"), AS_OF).alias("subject"))


# --------------------------------------------------------------- preferences
def responses(spark, d):
    """Events as form responses: each adds one keyword and may remove another."""
    ev = table(spark, d, "events")
    key = F.col("event_id")
    return ev.select(
        key.alias("seq"), F.date_format("ts", "M/d/yyyy H:mm:ss").alias("timestamp"),
        F.when(key % 3 == 0, F.concat(F.lit(" U"), F.col("user_id").cast("string"), F.lit("@X.org ")))
        .when(key % 3 == 1, F.concat(F.lit("alias"), F.col("user_id").cast("string"), F.lit("@y.org")))
        .otherwise(F.concat(F.lit("nobody"), F.col("user_id").cast("string"), F.lit("@z.org"))).alias("email"),
        F.when(key % 5 == 0, "").otherwise(F.concat(F.initcap("event_type"), F.lit(", Extra"))).alias("add"),
        F.when(key % 4 == 0, F.concat(F.lit("extra\n"), "event_type")).otherwise("").alias("remove"),
    )


def form_members(spark, d):
    users = table(spark, d, "events").select("user_id").distinct()
    return users.select(
        F.concat(F.lit("Name "), F.col("user_id").cast("string")).alias("name"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@x.org")).alias("email"),
        F.array(F.lit("GIS"), F.lit("Click"), F.lit("tax")).alias("patterns"),
    )


def aliases(spark, d):
    users = table(spark, d, "events").select("user_id").distinct().filter("user_id % 2 = 0")
    return users.select(
        F.concat(F.lit("alias"), F.col("user_id").cast("string"), F.lit("@y.org")).alias("login_email"),
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("@x.org")).alias("email"),
    )


def _resolved(spark, d):
    return P.resolve_email(P.timed(responses(spark, d)), form_members(spark, d), aliases(spark, d))


_RESOLVED = """v_form as (
  select event_id as seq, date_trunc('second', ts) as ts, user_id, event_type,
    case when event_id % 3 = 0 or (event_id % 3 = 1 and user_id % 2 = 0) then 'u' || user_id || '@x.org' end as member,
    case when event_id % 5 = 0 then [] else [event_type, 'extra'] end as added,
    case when event_id % 4 = 0 then ['extra', event_type] else [] end as removed
  from events)"""
_OPS = """v_op as (
  select member as email, unnest(added) as kw, 'add' as op, ts, seq from v_form where member is not null
  union all select member, unnest(removed), 'remove', ts, seq from v_form where member is not null)"""
_FOLD = """v_fold as (
  select email, kw, op, seq from v_op qualify row_number() over (partition by email, kw order by ts desc, seq desc, op desc) = 1)"""


@query("h5_sender_to_member", with_sql(_RESOLVED, select="select seq, member from v_form"))
def _(spark, d):
    return _resolved(spark, d).select("seq", "member")


@query("h5_rejected_senders", with_sql(_RESOLVED, select="select seq from v_form where member is null"))
def _(spark, d):
    return P.rejected(_resolved(spark, d)).select("seq")


@query("i7_fold_preferences", with_sql(_RESOLVED, _OPS, _FOLD, select="select email, kw, op, seq from v_fold"))
def _(spark, d):
    return P.fold(P.operations(P.change_history(_resolved(spark, d)))).drop("ts")


@query("i7_fold_since_mark", with_sql(_RESOLVED, _OPS, """v_new as (
  select email, kw, op, seq from v_op where ts > timestamp '2024-01-10 00:00:00'
  qualify row_number() over (partition by email, kw order by ts desc, seq desc, op desc) = 1)""", select="select email, kw, op, seq from v_new"))
def _(spark, d):
    fresh = P.newer_than(_resolved(spark, d), F.lit("2024-01-10 00:00:00").cast("timestamp"))
    return P.fold(P.operations(P.change_history(fresh))).drop("ts")


@query("i8_high_water_mark", with_sql(_RESOLVED, select="select max(ts) as mark from v_form"))
def _(spark, d):
    return P.high_water_mark(P.timed(responses(spark, d))).select(F.col("mark").cast("timestamp_ntz").alias("mark"))


@query("i9_change_history", with_sql(_RESOLVED, select="""
select member as email, seq, array_to_string(added, '|') as added, array_to_string(removed, '|') as removed
from v_form where member is not null and (len(added) > 0 or len(removed) > 0)"""))
def _(spark, d):
    rows = P.change_history(_resolved(spark, d))
    return rows.select("email", "seq", F.array_join("added", "|").alias("added"), F.array_join("removed", "|").alias("removed"))


@query("i10_effective_patterns", with_sql(_RESOLVED, _OPS, _FOLD, """v_base as (
  select 'u' || user_id || '@x.org' as email, unnest(['GIS', 'Click', 'tax']) as pattern from (select distinct user_id from events))""", select="""
select distinct email, pattern from (
  select email, case when email in (select email from v_fold) then lower(pattern) else pattern end as pattern from v_base
  union all select email, kw from v_fold where op = 'add') x
where not exists (select 1 from v_fold f where f.email = x.email and f.kw = x.pattern and f.op = 'remove')"""))
def _(spark, d):
    folded = P.fold(P.operations(P.change_history(_resolved(spark, d))))
    return P.effective_patterns(form_members(spark, d), folded)


@query("g9_merge_lists", """
select event_id, array_to_string(list_sort(list_distinct(list_filter(['gis', 'click', 'tax', event_type, 'zz'],
  lambda x: x <> 'tax' and not (event_id % 2 = 0 and x = event_type)))), '|') as patterns from events""")
def _(spark, d):
    removed = F.array(F.lit("tax"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise("none"))
    merged = P.merge_lists(F.array(F.lit("GIS"), F.lit("Click"), F.lit("tax")), F.array("event_type", F.lit("zz")), removed)
    return table(spark, d, "events").select("event_id", F.array_join(merged, "|").alias("patterns"))


# ----------------------------------------------------- preferences as a job
_FORM = """v_form as (
  select event_id as seq, date_trunc('second', ts) as ts, 'U' || user_id || '@example.org' as sender, case when user_id % 5 = 0 then null else 'u' || user_id || '@example.org' end as email,
    case when event_id % 3 = 0 then '' else event_type || ', w' || (event_id % 4) end as added, case when event_id % 3 = 0 then event_type else '' end as removed from events)"""
_FORM_OPS = """v_op as (
  select email, ts, seq, 'add' as op, unnest(string_split(added, ', ')) as kw from v_form where email is not null and added <> ''
  union all select email, ts, seq, 'remove', removed from v_form where email is not null and removed <> ''),
v_folded as (
  select email, kw, op from v_op qualify row_number() over (partition by email, kw order by ts desc, seq desc, op desc) = 1)"""


def _form(spark, d):
    added = F.concat("event_type", F.lit(", w"), (F.col("event_id") % 4).cast("string"))
    third = F.col("event_id") % 3 == 0
    return table(spark, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("@example.org")).alias("email"),
        F.when(third, "").otherwise(added).alias("add"), F.when(third, F.col("event_type")).otherwise("").alias("remove"), F.col("event_id").alias("seq"))


def _form_members(spark, d):
    """Members but for every fifth sender; some have a base pattern that their answers remove or repeat."""
    users = table(spark, d, "events").select("user_id").distinct().where("user_id % 5 <> 0")
    return users.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.org")).alias("email"), F.concat(F.lit("Member "), F.col("user_id").cast("string")).alias("name"),
        F.array(F.lit("Click"), F.lit("w0"), F.lit("ononst")).alias("patterns"))


def _synced(spark, d):
    """Two syncs: the answers of the first two weeks, then the whole export; the second one is lost once and repeated."""
    kept = PreferenceStore(spark, fresh_dir(spark), buckets=8)
    members, answers = _form_members(spark, d), _form(spark, d)
    aliases = spark.createDataFrame([], "login_email string, email string")
    sync(kept, answers.where("timestamp < '2024-01-15'"), members, aliases, "first")
    for _attempt in range(2):
        sync(kept, answers, members, aliases, "second")
    return kept, members


@query("i8_preference_sync", "with " + _FORM + "," + _FORM_OPS + " select email, kw, op from v_folded")
def _(spark, d):
    return _synced(spark, d)[0].state.read().select("email", "kw", "op")


@query("i8_sync_history", "with " + _FORM + """
select 'history' as kind, count(*) as n, (select max(ts) from v_form) as mark from v_form where email is not null
union all select 'rejected', count(*), (select max(ts) from v_form) from v_form where email is null""")
def _(spark, d):
    kept = _synced(spark, d)[0]
    mark = F.lit(kept.mark()).cast("timestamp_ntz").alias("mark")
    return kept.history().agg(F.count("*").alias("n")).select(F.lit("history").alias("kind"), "n", mark).unionByName(
        kept.rejected().agg(F.count("*").alias("n")).select(F.lit("rejected").alias("kind"), "n", mark))


_EFFECTIVE = """v_base as (
  select distinct m.email, p as pattern from (select distinct email from v_form where email is not null) m, (values ('click'), ('w0'), ('ononst')) t(p)),
v_effective as (
  select email, pattern from v_base union select email, kw from v_folded where op = 'add'
  except select email, kw from v_folded where op = 'remove'),
v_own as (
  select distinct email, pos, state from v_week, v_effective where contains(lower(concat_ws(' ', title, description, agency)), lower(pattern)))"""


@query("i5_digest_of_effective_patterns", with_sql(TAGGED, _WEEK, _FORM, _FORM_OPS, _EFFECTIVE, select="select email, pos, state from v_own"))
def _(spark, d):
    kept, members = _synced(spark, d)
    return G.personal_digest(_week(spark, d), "pos", digest_patterns(kept, members), "state")


@query("i6_headers_of_effective_patterns", with_sql(TAGGED, _WEEK, _FORM, _FORM_OPS, _EFFECTIVE, LABELS, select="""
select email, cast(sum(n) as bigint) as n, string_agg(n || ' ' || label, ', ' order by ord, state) as summary
from (select email, h.state, coalesce(label, h.state) as label, coalesce(ord, 1000000) as ord, count(*) as n
  from v_own h left join v_label l on h.state = l.state group by all) group by email"""))
def _(spark, d):
    kept, members = _synced(spark, d)
    week = _week(spark, d)
    found = G.interests(week, "pos", digest_patterns(kept, members))
    return G.personal_headers(found, week, "pos", members, labels(spark), AS_OF).select("email", "n", "summary")
