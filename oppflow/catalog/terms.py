"""Corpus terms, phrases, gaps and drift."""
from pyspark.sql import functions as F

from oppflow.catalog.base import (
    COMBINED, EXCLUDED, KEYWORDS, RFPS, STOP_SQL, TAGGED, fresh_dir, query, rfps, tagged, with_sql,
)
from oppflow.session import cut
from oppflow.operators import drift, rake, tfidf
from oppflow.operators.ranking import ranked
from oppflow.plans.analysis import analyse, report
from oppflow.sources import store

EARLIER = "2024-01-15"  # the previous run saw what was scraped up to this day
RUN_1, RUN_2 = "2024-01-15 00:01:00", "2024-02-01 00:01:00"
KW_SQL = "(values " + ", ".join(f"('{k}')" for k in sorted(KEYWORDS)) + ") k(keyword)"


def tfidf_sql(p: str, source: str = "v_rfp", where: str = "true") -> str:
    """The chain from records to mean scores; ``p`` prefixes every step."""
    return rf"""{p}_base as (select * from {source} where {where}),
{p}_n as (select count(*) as n from {p}_base),
{p}_words as (
  select pos, list_filter(string_split_regex(lower({COMBINED}), '[^\p{{L}}\p{{N}}_]+'),
    lambda x: regexp_full_match(x, '[a-z]{{3,}}') and x not in {STOP_SQL}) as words from {p}_base),
{p}_tf as (
  select pos, term, count(*) as tf from (
    select pos, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) as term
    from {p}_words) group by pos, term),
{p}_terms as (select term, cast(sum(tf) as bigint) as tf, count(*) as df from {p}_tf group by term),
{p}_vocab as (
  select term, tf, df, ln((1 + n) / (1 + df)) + 1 as idf from {p}_terms, {p}_n
  where df >= 2 and df <= 0.85 * n order by tf desc, term limit 5000),
{p}_w as (
  select pos, term, raw / sqrt(sum(raw * raw) over (partition by pos)) as weight from (
    select pos, term, t.tf * idf as raw from {p}_tf t join {p}_vocab v using (term))),
{p}_score as (select term, sum(weight) / any_value(n) as score from {p}_w, {p}_n group by term),
{p}_top as (
  select row_number() over (order by round(score, 6) desc, term) as rank, term, round(score, 6) as score
  from {p}_score qualify rank <= 50),
{p}_gap as (
  select row_number() over (order by round(score, 6) desc, term) as rank, term, round(score, 6) as score
  from {p}_score where score >= 0.001 and not exists (
    select 1 from {KW_SQL} where contains(keyword, term) or contains(term, keyword)) qualify rank <= 30)"""


def rake_sql(p: str, source: str = "v_rfp", where: str = "true") -> str:
    return rf"""{p}_text as (select pos, {COMBINED} as ctext from {source} where {where}),
{p}_piece as (
  select pos, i, piece, piece in {STOP_SQL} or not regexp_matches(piece, '^[\p{{L}}\p{{N}}_]') as brk from (
    select pos, generate_subscripts(l, 1) as i, unnest(l) as piece from (
      select pos, regexp_extract_all(lower(ctext), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]+') as l
      from {p}_text where length(ctext) >= 80))),
{p}_span as (select *, sum(cast(brk as integer)) over (partition by pos order by i) as grp from {p}_piece),
{p}_cand as (
  select string_agg(piece, ' ' order by i) as phrase, count(*) as len from {p}_span
  where not brk group by pos, grp having count(*) between 2 and 4),
{p}_word as (
  select word, count(*) as freq, avg(len) as score from (
    select unnest(string_split(phrase, ' ')) as word, len from {p}_cand) group by word),
{p}_bag as (
  select max(phrase) as phrase from (
    select phrase, array_to_string(list_sort(string_split(phrase, ' ')), ' ') as bag from {p}_cand) group by bag),
{p}_ps as (
  select phrase, round(sum(score), 6) as score from (
    select phrase, unnest(string_split(phrase, ' ')) as word from {p}_bag) join {p}_word using (word) group by phrase),
{p}_best as (
  select row_number() over (order by score desc, phrase desc) as rank, phrase, score from {p}_ps qualify rank <= 50)"""


_TFIDF = (RFPS, tfidf_sql("c"))
_RAKE = (RFPS, rake_sql("r"))


def _docs(df, *keep):
    return tfidf.with_terms(df, tfidf.STOP_WORDS, *keep)


def _earlier(df):
    return df.filter(F.col("scrape_date") <= EARLIER)


def _words(df, *keep):
    """Terms of records whose text is read once."""
    return tfidf.read_once(df, tfidf.STOP_WORDS, *keep)


def _scores(docs):
    """Unrounded mean scores of a set of documents."""
    return tfidf.weigh_once(docs).scores().select("term", "score")


def _top(docs):
    return tfidf.top_corpus_terms(tfidf.corpus_scores(_scores(docs)))


# ------------------------------------------------------------ term weights
@query("e5_corpus_terms", with_sql(*_TFIDF, select="select term, tf, df from c_terms"))
def _(spark, d):
    return tfidf.term_counts(_docs(rfps(spark, d)))


@query("e6_vocabulary", with_sql(*_TFIDF, select="select term, tf, df, round(idf, 6) as idf from c_vocab"))
def _(spark, d):
    records = rfps(spark, d)
    n = records.agg(F.count("*")).scalar()
    return tfidf.vocabulary(_docs(records), n).withColumn("idf", F.round("idf", 6))


@query("e7_term_weights", with_sql(*_TFIDF, select="select pos, term, round(weight, 6) as weight from c_w"))
def _(spark, d):
    records = rfps(spark, d)
    docs = _words(records, "pos")
    vocab = tfidf.vocabulary(docs, records.agg(F.count("*")).scalar())
    return tfidf.weights(docs, vocab, "pos").withColumn("weight", F.round("weight", 6))


@query("e8_top_terms", with_sql(*_TFIDF, select="select rank, term, score from c_top"))
def _(spark, d):
    return _top(_words(rfps(spark, d)))


def _group_sql(by: str) -> str:
    return with_sql(*_TFIDF, select=f"""
select {by}, n, term, round(s, 6) as score, rank from (
  select {by}, term, n, s, row_number() over (partition by {by} order by round(s, 6) desc, term) as rank from (
    select b.{by}, w.term, any_value(g.n) as n, sum(w.weight) / any_value(g.n) as s
    from c_w w join c_base b using (pos)
    join (select {by}, count(*) as n from c_base where {by} is not null group by {by}) g on g.{by} = b.{by}
    where g.n >= 5 group by b.{by}, w.term))
where rank <= 20""")


def _group_terms(df, by):
    return tfidf.top_group_terms(tfidf.weigh_once(_words(df, by), [by]).scores(by), by)


@query("e9_top_terms_by_state", _group_sql("state"))
def _(spark, d):
    return _group_terms(rfps(spark, d), "state")


@query("e10_top_terms_by_source", _group_sql("source"))
def _(spark, d):
    return _group_terms(rfps(spark, d), "source")


@query("g4_top_per_group", _group_sql("scrape_date"))
def _(spark, d):
    return _group_terms(rfps(spark, d), "scrape_date")


@query("e11_matched_versus_rest", with_sql(TAGGED, tfidf_sql("c", "v_tag"), """d as (
  select term, round(coalesce(sum(weight) filter (keyword_match), 0) / (select count(*) from v_tag where keyword_match)
    - coalesce(sum(weight) filter (not keyword_match), 0) / (select count(*) from v_tag where not keyword_match), 6) as diff
  from c_w join (select pos, keyword_match from c_base) using (pos) group by term)""", select="""
select 'matched' as side, row_number() over (order by diff desc, term) as rank, term, diff from d where diff > 0 qualify rank <= 20
union all
select 'unmatched', row_number() over (order by diff, term) as rank, term, diff from d where diff < 0 qualify rank <= 20"""))
def _(spark, d):
    weighed = tfidf.weigh_once(_words(tagged(spark, d), "keyword_match"), ["keyword_match"])
    return tfidf.matched_versus_rest(weighed.scores("keyword_match"))


# ----------------------------------------------------------------- phrases
@query("e12_candidate_phrases", with_sql(*_RAKE, select="select phrase, count(*) as n from r_cand group by phrase"))
def _(spark, d):
    return rake.phrases(rfps(spark, d)).select("phrase", "n")


@query("e13_word_scores", with_sql(*_RAKE, select="select word, freq, round(score, 6) as score from r_word"))
def _(spark, d):
    scores = rake.word_scores(rake.phrases(rfps(spark, d)))
    return scores.withColumn("score", F.round("score", 6))


@query("c8_one_phrase_per_bag", with_sql(*_RAKE, select="select phrase from r_bag"))
def _(spark, d):
    return rake.one_per_bag(rake.phrases(rfps(spark, d))).select("phrase")


@query("h10_phrase_scores", with_sql(*_RAKE, select="select phrase, score from r_ps"))
def _(spark, d):
    return rake.phrase_scores(rake.phrases(rfps(spark, d)))


@query("e14_top_phrases", with_sql(*_RAKE, select="select rank, phrase, score from r_best"))
def _(spark, d):
    return rake.top_phrases(rfps(spark, d))


# -------------------------------------------------------------------- gaps
@query("e15_gap_terms", with_sql(*_TFIDF, select="select rank, term, score from c_gap"))
def _(spark, d):
    return drift.gap_terms(_scores(_words(rfps(spark, d))), KEYWORDS)


@query("h7_terms_no_keyword_covers", with_sql(*_TFIDF, select=f"""
select term from c_vocab where not exists (
  select 1 from {KW_SQL} where contains(keyword, term) or contains(term, keyword))"""))
def _(spark, d):
    from oppflow.operators.matching import covered_by
    records = rfps(spark, d)
    vocab = tfidf.vocabulary(_docs(records), records.agg(F.count("*")).scalar())
    return vocab.filter(~covered_by(F.col("term"), KEYWORDS)).select("term")


@query("e16_keyword_coverage", with_sql(*_TFIDF, select=f"""
select 'found' as side, row_number() over (order by round(score, 6) desc, keyword) as rank, keyword, round(score, 6) as score,
  0 as remaining from {KW_SQL} join c_score on term = keyword qualify rank <= 20
union all
select 'missing', row_number() over (order by keyword) as rank, keyword, null,
  greatest(count(*) over () - 30, 0) from {KW_SQL} where keyword not in (select term from c_vocab) qualify rank <= 30"""))
def _(spark, d):
    scores = _scores(_words(rfps(spark, d)))
    found = drift.covered_keywords(scores, KEYWORDS).select(
        F.lit("found").alias("side"), "rank", "keyword", "score", F.lit(0).cast("bigint").alias("remaining")
    )
    missing = drift.missing_report(drift.missing_keywords(scores, KEYWORDS)).select(
        F.lit("missing").alias("side"), "rank", "keyword", F.lit(None).cast("double").alias("score"), "remaining"
    )
    return found.unionByName(missing)


@query("h9_keywords_left_vocabulary", with_sql(*_TFIDF, select=f"""
select keyword, round(score, 6) as score from {KW_SQL} left join c_score on term = keyword"""))
def _(spark, d):
    table = drift.keyword_table(spark, KEYWORDS)
    scores = _scores(_words(rfps(spark, d)))
    return table.join(scores, F.col("keyword") == F.col("term"), "left").select("keyword", F.round("score", 6).alias("score"))


# ------------------------------------------------------------------- drift
_TWO_RUNS = (RFPS, tfidf_sql("o", where=f"scrape_date <= '{EARLIER}'"), tfidf_sql("c"))
_TWO_RAKES = (*_TWO_RUNS, rake_sql("q", where=f"scrape_date <= '{EARLIER}'"), rake_sql("r"))


def _terms_only(docs, ts):
    """A snapshot of one run's top terms."""
    return cut(_top(docs).select(
        F.lit(ts).cast("timestamp").alias("run_ts"), F.lit("tfidf").alias("kind"), "rank", "term", "score"
    ))


def _full(docs, df, ts):
    scores = _scores(docs)
    top = tfidf.top_corpus_terms(tfidf.corpus_scores(scores))
    return cut(drift.snapshot(F.lit(ts).cast("timestamp"), top, drift.gap_terms(scores, KEYWORDS), rake.top_phrases(df)))


def _two(spark, d):
    """Snapshots of the top terms of both runs, from words read once."""
    docs = _words(rfps(spark, d), "scrape_date")
    return _terms_only(docs, RUN_2), _terms_only(_earlier(docs), RUN_1)


@query("e17_new_and_dropped_terms", with_sql(*_TWO_RUNS, select="""
select 'new' as change, term, score from c_top where term not in (select term from o_top)
union all select 'dropped', term, score from o_top where term not in (select term from c_top)"""))
def _(spark, d):
    now, old = _two(spark, d)
    new = drift.new_entries(now, old, "tfidf").select(F.lit("new").alias("change"), "term", "score")
    return new.unionByName(drift.dropped_entries(now, old).select(F.lit("dropped").alias("change"), "term", "score"))


@query("g8_set_difference", with_sql(*_TWO_RUNS, select="""
select term from c_top except select term from o_top"""))
def _(spark, d):
    now, old = _two(spark, d)
    return now.select("term").subtract(old.select("term"))


@query("h8_runs_full_outer", with_sql(*_TWO_RUNS, select="""
select coalesce(c.term, o.term) as term, o.score as old_score, c.score as new_score,
  case when o.term is null then 'new' when c.term is null then 'dropped' else 'kept' end as status
from c_top c full join o_top o on c.term = o.term"""))
def _(spark, d):
    return drift.term_status(*_two(spark, d))


@query("e18_rising_terms", with_sql(*_TWO_RUNS, select="""
select row_number() over (order by round((c.score - o.score) / o.score, 6) desc, term) as rank, term,
  o.score as old_score, c.score as new_score, round((c.score - o.score) / o.score, 6) as gain
from c_top c join o_top o using (term) where o.score > 0 and (c.score - o.score) / o.score > 0.10
order by gain desc, term limit 15"""))
def _(spark, d):
    return drift.rising_terms(*_two(spark, d))


@query("e19_new_gaps_and_phrases", with_sql(*_TWO_RAKES, select="""
select 'gap' as kind, term, score from c_gap where term not in (select term from o_gap)
union all select 'rake', phrase, score from r_best where phrase not in (select phrase from q_best)"""))
def _(spark, d):
    records = rfps(spark, d)
    docs = _words(records, "scrape_date")
    now, old = _full(docs, records, RUN_2), _full(_earlier(docs), _earlier(records), RUN_1)
    gaps = drift.new_entries(now, old, "gap").select(F.lit("gap").alias("kind"), "term", "score")
    return gaps.unionByName(drift.new_entries(now, old, "rake").select(F.lit("rake").alias("kind"), "term", "score"))


@query("e20_baseline_run", with_sql(*_TWO_RUNS, select="""
select 'baseline' as change, '' as term, cast(0.0 as double) as score, (select count(*) from c_top) as terms"""))
def _(spark, d):
    now = _terms_only(_words(rfps(spark, d)), RUN_2)
    changes = drift.changes(now, now.filter(F.lit(False)))
    return changes.join(now.agg(F.count("*").alias("terms"), F.lit("baseline").alias("change")), "change")


@query("e22_run_summary", with_sql(*_TWO_RUNS, select="""
select (select count(*) from v_rfp) as rfps, (select term from c_top where rank = 1) as top_term,
  (select count(*) from c_gap) as gap_candidates,
  (select count(*) from c_top where term not in (select term from o_top)) as new_terms"""))
def _(spark, d):
    records = rfps(spark, d)
    docs = _words(records, "scrape_date")
    scores = _scores(docs)
    top = tfidf.top_corpus_terms(tfidf.corpus_scores(scores))
    gaps = drift.gap_terms(scores, KEYWORDS)
    now = drift.snapshot(F.lit(RUN_2).cast("timestamp"), top, gaps, gaps.limit(0).withColumnRenamed("term", "phrase"))
    return drift.run_summary(records, now, _terms_only(_earlier(docs), RUN_1))


@query("a4_term_snapshots", with_sql(*_TWO_RUNS, select="select 'tfidf' as kind, rank, term, score from o_top"))
def _(spark, d):
    path = fresh_dir(spark)
    for snap in reversed(_two(spark, d)):
        store.append_snapshot(snap, path)
    earlier = drift.previous_run(store.snapshots(spark, path), F.lit(RUN_2).cast("timestamp"))
    return earlier.select("kind", "rank", "term", "score")


def _analysed(spark, d):
    """The whole analysis of a first run."""
    return analyse(tagged(spark, d), KEYWORDS, store.snapshots(spark, fresh_dir(spark)), F.lit(RUN_2).cast("timestamp"))


@query("a8_analysis_report", with_sql(*_TFIDF, rake_sql("r"), select="""
select 'tfidf' as section, rank, term, score from c_top union all
select 'rake', rank, phrase, score from r_best union all
select 'gap', rank, term, score from c_gap"""))
def _(spark, d):
    return report(_analysed(spark, d))


@query("f7_dashboard_terms", with_sql(*_TFIDF, rake_sql("r"), select="""
select 'tfidf' as kind, rank, term, score from c_top where rank <= 20 union all
select 'rake', rank, phrase, score from r_best where rank <= 15 union all
select 'gap', rank, term, score from c_gap where rank <= 15"""))
def _(spark, d):
    from oppflow.operators.summary import snapshot_slices
    return snapshot_slices(_analysed(spark, d)["snapshot"])


@query("g3_rank_column", with_sql(*_TFIDF, select="""
select rank, term, tf from (select row_number() over (order by tf desc, term) as rank, term, tf from c_terms) where rank <= 50"""))
def _(spark, d):
    counts = tfidf.term_counts(_docs(rfps(spark, d))).select("term", "tf")
    return ranked(counts, [F.desc("tf"), F.asc("term")], 50)
