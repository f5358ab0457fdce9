"""Runs with memory: deduplication, expiry, drift, preferences, digests."""
import random

import pytest
from pyspark.sql import functions as F

from oppflow.operators import digest, drift, identity, preferences, tfidf
from oppflow.operators.matching import BLOCK, join_hot, phrase_hits
from oppflow.plans import analysis, ingest
from oppflow.sources import store

RAW = "state string, source string, id string, title string, agency string, description string, pos bigint"


def at(text):
    return F.lit(text).cast("timestamp")


def batch(spark, *titles):
    rows = [("TX", "s", str(i), t, "a", "", i) for i, t in enumerate(titles)]
    return spark.createDataFrame(rows, RAW)


def test_second_run_adds_nothing_and_expiry_readmits(spark, tmp_path):
    state, path = store.seen_table(spark, f"{tmp_path}/seen"), f"{tmp_path}/rfps"

    def run(when):
        return ingest.run(batch(spark, "Water main", "Road salt"), state, path, ["water"], at(when), ["pos"]).first()

    assert run("2024-01-01 00:00:00").asDict() == {"new_rfps": 2, "matched": 1, "unmatched": 1}
    assert run("2024-01-02 00:00:00").new_rfps == 0
    # still blocks the run that forgets it, is let in by the next
    assert run("2024-04-15 00:00:00").new_rfps == 0
    assert state.read().count() == 0
    assert run("2024-04-16 00:00:00").new_rfps == 2
    assert store.read_rfps(spark, path).count() == 4
    assert state.versions() == [1, 2, 3, 4]


def test_a_repeated_run_replaces_its_records(spark, tmp_path):
    state, path = store.seen_table(spark, f"{tmp_path}/seen"), f"{tmp_path}/rfps"
    lost = store.seen_table(spark, f"{tmp_path}/lost")
    for memory in (lost, state):
        ingest.run(batch(spark, "Water main"), memory, path, ["water"], at("2024-01-01"), ["pos"], batch="r1").collect()
    assert store.read_rfps(spark, path).count() == 1


def test_reading_a_day_prunes_the_store(spark, tmp_path):
    path = f"{tmp_path}/rfps"
    for day in ("2024-01-01", "2024-01-02"):
        fresh = ingest.new_records(batch(spark, f"Water {day}"), store.seen_table(spark, f"{tmp_path}/none").read(), ["pos"])
        store.append_rfps(ingest.enrich(fresh, ["water"], at(day)), path)
    day = digest.on_day(store.read_rfps(spark, path), "2024-01-02").select("title")
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    columns = plan.split("ReadSchema: ")[1]
    assert "2024-01-02" in filters and "description" not in columns
    assert [r.title for r in day.collect()] == ["Water 2024-01-02"]


def test_stream_ingest_repeats_a_batch_without_effect(spark, tmp_path):
    from oppflow.streaming import jobs
    path = f"{tmp_path}/store"
    sink = jobs.ingest_sink(path, ["water"], ["pos"])
    first = batch(spark, "Water main", "Road salt").withColumn("scraped_at", at("2024-01-01"))
    second = batch(spark, "Water main", "Salt shed").withColumn("scraped_at", at("2024-02-01"))
    late = batch(spark, "Water main").withColumn("scraped_at", at("2024-06-01"))
    for rows, number in ((first, 0), (second, 1), (second, 1), (first, 0), (late, 2)):
        sink(rows, number)
    got = sorted((r.title, r.batch) for r in spark.read.parquet(path).collect())
    # ids differ with the position, so only the water record comes again; it has expired by June
    assert got == [("Road salt", 0), ("Salt shed", 1), ("Water main", 0), ("Water main", 2)]


def test_expiry_keeps_the_exact_limit(spark):
    seen = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2023-12-31 23:59:59.999999")], "hash string, t string")
    seen = seen.select("hash", F.col("t").cast("timestamp").alias("first_seen"))
    assert [r.hash for r in identity.forget(seen, at("2024-03-31 00:00:00")).collect()] == ["a"]


def test_first_wins_does_not_depend_on_partitions(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("pos"))
    results = {
        tuple(sorted(map(tuple, identity.first_wins(rows.repartition(n), ["k"], ["pos"]).collect()))) for n in (1, 3, 8)
    }
    assert len(results) == 1


def test_first_wins_cuts_hot_keys_before_the_shuffle(spark):
    rows = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    plan = identity.first_wins(rows, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    # printed from the last step to the first
    final, exchange, partial = (plan.index(s) for s in ("1, Final", "Exchange hashpartitioning(k", "1, Partial"))
    assert final < exchange < partial


def test_weights_have_length_one(spark):
    docs = spark.createDataFrame(
        [(i, f"water bridge salt {'road' if i % 2 else 'sewer'} number{i}", "", "") for i in range(8)],
        "pos int, title string, description string, agency string",
    )
    terms = tfidf.with_terms(docs, tfidf.STOP_WORDS, "pos")
    vocab = tfidf.vocabulary(terms, 8)
    kept = {r.term for r in vocab.collect()}
    assert "road" in kept and "water" not in kept  # in every document
    norms = tfidf.weights(terms, vocab, "pos").groupBy("pos").agg(F.sum(F.col("weight") ** 2).alias("n"))
    assert all(r.n == pytest.approx(1.0) for r in norms.collect())
    model = tfidf.fit(terms)
    mean = {r.term: r.score for r in model.mean_scores(terms).collect()}
    rows = tfidf.weights(terms, vocab, "pos").groupBy("term").agg((F.sum("weight") / 8).alias("s")).collect()
    assert mean == pytest.approx({r.term: r.s for r in rows})


def test_small_groups_are_left_out(spark):
    rows = [("A", "water road salt", "", "")] * 5 + [("B", "water sewer pipe", "", "")] * 4
    df = spark.createDataFrame(rows, "state string, title string, description string, agency string")
    docs = tfidf.with_terms(df, tfidf.STOP_WORDS, "state")
    assert {r.state for r in tfidf.top_group_terms(tfidf.fit(docs).mean_scores(docs, "state"), "state").collect()} == {"A"}


def test_empty_vocabulary(spark):
    df = spark.createDataFrame([("one", "", "")], "title string, description string, agency string")
    docs = tfidf.with_terms(df)
    assert tfidf.fit(docs).mean_scores(docs).count() == 0


def test_analysis_of_two_runs(spark, tmp_path):
    text = "stormwater bridge repair, salt road. " * 4
    rows = [("TX" if i % 2 else "NY", "s", f"{'water' if i < 6 else 'sewer'} job {i}", text, "", i % 3 == 0, "2024-01-01") for i in range(12)]
    df = spark.createDataFrame(rows, "state string, source string, title string, description string, agency string, keyword_match boolean, scrape_date string")
    path = f"{tmp_path}/snapshots"
    first = analysis.analyse(df.limit(8), ["road"], store.snapshots(spark, path), at("2024-01-01"))
    assert [r.change for r in first["changes"].collect()] == ["baseline"]
    store.append_snapshot(first["snapshot"], path)
    second = analysis.analyse(df, ["road"], store.snapshots(spark, path), at("2024-01-02"))
    assert "baseline" not in {r.change for r in second["changes"].collect()}
    summary = second["run_summary"].first()
    assert summary.rfps == 12 and summary.gap_candidates == second["gaps"].count()
    for term in [r.term for r in second["gaps"].collect()]:
        assert term not in "road" and "road" not in term
    assert analysis.report(second).count() > 0


# -------------------------------------------------------------- preferences
FORM = "timestamp string, email string, add string, remove string, seq bigint"
MEMBERS = "name string, email string, patterns array<string>"
ALIASES = "login_email string, email string"


def folded(spark, *responses):
    members = spark.createDataFrame([("A B", "A@x.org", ["GIS"]), ("C D", "c@x.org", ["GIS", "Tax"])], MEMBERS)
    aliases = spark.createDataFrame([("home@y.org", "a@x.org")], ALIASES)
    rows = preferences.timed(spark.createDataFrame(list(responses), FORM))
    resolved = preferences.resolve_email(rows, members, aliases)
    ops = preferences.fold(preferences.operations(preferences.change_history(resolved)))
    return members, resolved, ops


def test_removal_wins_within_a_response(spark):
    _, _, ops = folded(spark, ("1/2/2024 3:04:05", "a@x.org", "x", "x", 1))
    assert [(r.kw, r.op) for r in ops.collect()] == [("x", "remove")]


def test_effective_patterns(spark):
    members, _, ops = folded(spark, ("1/2/2024 3:04:05", "Home@y.org ", "ai", "", 1))
    got = {(r.email, r.pattern) for r in preferences.effective_patterns(members, ops).collect()}
    assert got == {("a@x.org", "gis"), ("a@x.org", "ai"), ("c@x.org", "GIS"), ("c@x.org", "Tax")}


def test_unknown_sender_is_reported_and_moves_the_mark(spark):
    _, resolved, ops = folded(
        spark, ("1/2/2024 3:04:05", "a@x.org", "x", "", 1), ("12/2/2024 3:04:05", "who@z.org", "y", "", 2),
    )
    assert [r.seq for r in preferences.rejected(resolved).collect()] == [2]
    assert str(preferences.high_water_mark(resolved).first().mark) == "2024-12-02 03:04:05"
    assert ops.count() == 1


def test_folding_in_pieces_gives_the_same(spark):
    rows = [(f"u{i % 2}", f"k{i % 3}", "add" if i % 5 else "remove", i) for i in range(60)]
    ops = spark.createDataFrame(rows, "email string, kw string, op string, seq bigint")
    whole = {tuple(r) for r in preferences.fold(ops).collect()}
    first = preferences.fold(ops.filter("seq < 30"))
    assert {tuple(r) for r in preferences.fold(first.unionByName(ops.filter("seq >= 20"))).collect()} == whole


# ------------------------------------------------------------------ digests
def test_week_has_eight_dates(spark):
    days = spark.createDataFrame([(f"2025-01-{d:02d}", True) for d in range(1, 9)] + [("2024-12-31", True)], "scrape_date string, keyword_match boolean")
    assert digest.past_week(days, "2025-01-08").count() == 8


def test_phrase_search(spark):
    texts = [(i, t) for i, t in enumerate(["xrewhan der", "de r", "", "ab", "über die der\nbrücke", None, "😀ab😀", "der"])]
    df = spark.createDataFrame(texts, "pos bigint, text string")
    words = ["rewh", "der", "b", "ab", "r\nb", "zzz", "ü", "rewhan der", "über die der\nbrücke", "😀", "", "xrewhan derx"]
    phrases = spark.createDataFrame([(w,) for w in words], "phrase string")
    expected = {(i, w) for i, t in texts for w in words if t and w and w in t}
    assert sorted(tuple(r) for r in phrase_hits(df, "pos", "text", phrases).collect()) == sorted(expected)
    assert phrase_hits(df.limit(0), "pos", "text", phrases).collect() == phrase_hits(df, "pos", "text", phrases.limit(0)).collect() == []


def test_phrase_search_over_block_ends(spark):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choices("abcö ", weights=(8, 4, 2, 1, 3), k=rng.choice((3, 63, 64, 65, 130, 400))))) for i in range(60)]
    long = [t for _, t in texts if len(t) > 200]
    words = {t[a: a + n] for t in long for a, n in [(rng.randrange(100), rng.choice((1, 3, 4, 5, 20, BLOCK - 1, BLOCK, BLOCK + 1, 150))) for _ in range(8)]}
    words |= {w + "b" for w in words if len(w) > 3} | {"a" * n for n in (4, 9, 70)}
    df = spark.createDataFrame(texts, "pos bigint, text string").repartition(3)
    found = phrase_hits(df, "pos", "text", spark.createDataFrame([(w,) for w in words], "phrase string"))
    assert sorted(tuple(r) for r in found.collect()) == sorted((i, w) for i, t in texts for w in words if w in t)


def test_phrase_search_of_a_large_dictionary_with_common_starts(spark):
    """A hundred thousand phrases that differ at the end; every one meets its own text and no other."""
    n = 100_000
    phrases = spark.range(n).select(F.format_string("department of water %06d", "id").alias("phrase"))
    texts = spark.range(0, n, 50).select(F.col("id").alias("pos"), F.format_string("the department of water %06d and the department of water", "id").alias("text"))
    found = phrase_hits(texts, "pos", "text", phrases)
    assert found.count() == n // 50 == found.filter(F.col("phrase").endswith(F.lpad(F.col("pos").cast("string"), 6, "0"))).count()


def test_member_without_patterns_gets_nothing(spark):
    rfps = spark.createDataFrame([(1, "t", "d", "a")], "pos bigint, title string, description string, agency string")
    none = spark.createDataFrame([("a@x.org", "")], "email string, pattern string")
    assert digest.personal_hits(rfps, "pos", none).count() == 0


def test_hot_key_join_equals_plain_join(spark):
    rows = spark.range(300).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("string").alias("word"))
    lookup = spark.range(35).select(F.col("id").cast("string").alias("word"), (100 - F.col("id")).alias("freq"), (F.col("id") * 1.5).alias("score"))
    plain = {tuple(r) for r in rows.join(lookup, "word").select("id", "word", "score").collect()}
    for hot in (1, 5, 100):
        got = join_hot(rows, lookup, "word", "freq", hot).select("id", "word", "score").collect()
        assert len(got) == len(plain) and {tuple(r) for r in got} == plain


def test_missing_keywords_report(spark):
    scores = spark.createDataFrame([("road", 0.5)], "term string, score double")
    words = [f"word {i:02d}" for i in range(33)] + ["Road"]
    missing = drift.missing_report(drift.missing_keywords(scores, words)).collect()
    assert len(missing) == 30 and {r.remaining for r in missing} == {3}
    assert [r.keyword for r in drift.covered_keywords(scores, words).collect()] == ["road"]


def test_one_pass_gives_the_sums_of_every_group(spark):
    rows = [("TX" if i % 3 else None, "s", i % 2 == 0, f"water {'road' if i % 2 else 'salt'} pump{i % 4} x{i}", "", "") for i in range(24)]
    df = spark.createDataFrame(rows, "state string, source string, keyword_match boolean, title string, description string, agency string")
    docs = tfidf.read_once(df, tfidf.STOP_WORDS, "state", "source", "keyword_match")
    weighed = tfidf.weigh_once(docs, ["state", "source", "keyword_match"])
    plan = weighed.model.sums(docs, ["state", "source", "keyword_match"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("Exchange hashpartitioning") == 1
    assert {(r.section, r.value): r.n for r in weighed.sums.collect()} == {
        ("corpus", ""): 24, ("state", "TX"): 16, ("source", "s"): 24, ("keyword_match", "true"): 12, ("keyword_match", "false"): 12}
    model = weighed.model
    each = {by: {r.term: r.score for r in weighed.scores(by).collect() if by != "keyword_match" or r.keyword_match == "true"} for by in (None, "state", "keyword_match")}
    parts = {None: docs, "state": docs.filter("state = 'TX'"), "keyword_match": docs.filter("keyword_match")}
    vocab = spark.createDataFrame(list(zip(model.terms, model.idf)), "term string, idf double")
    for by, part in parts.items():
        keyed = part.withColumn("k", F.monotonically_increasing_id())
        n = part.count()
        plain = {r.term: r.s for r in tfidf.weights(keyed, vocab, "k").groupBy("term").agg((F.sum("weight") / n).alias("s")).collect()}
        assert {t: s for t, s in each[by].items() if s > 0} == pytest.approx(plain)
