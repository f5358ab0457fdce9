"""Rows of a task stay few, whatever row groups the input has."""
import pytest
from pyspark.sql import functions as F

from oppflow.catalog import intake
from oppflow.operators import tfidf
from oppflow.session import spread


def _most(df):
    held = df.select(F.spark_partition_id().alias("task")).groupBy("task").count()
    return held.agg(F.max("count")).first()[0]


@pytest.fixture(scope="module")
def one_group(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("one"))
    spark.range(4000).select(F.col("id").alias("k"), F.lit("water bridge").alias("title")).coalesce(1).write.parquet(f"{path}/t.parquet")
    return path


def test_a_row_group_makes_no_large_task(spark, one_group):
    df = spark.read.parquet(f"{one_group}/t.parquet")
    for keys in (["k"], []):
        dealt = spread(df, *keys, rows=100)
        assert _most(dealt) <= 200 and dealt.columns == df.columns
        assert dealt.agg(F.sum("k"), F.count("*")).first() == df.agg(F.sum("k"), F.count("*")).first()
    assert _most(spread(df, "k")) < 4000
    even = df.repartition(2 * spark.sparkContext.defaultParallelism, "k")
    assert _most(spread(even, rows=20)) <= 60  # alike, but too large


def test_payloads_are_rendered_in_small_tasks(spark, one_group):
    rows = intake.bodies(spark, one_group, "t", "k", "named_struct('a', title)", rows=100)
    assert _most(rows) <= 200 and rows.count() == 4000


def test_terms_are_counted_in_small_tasks(spark, monkeypatch):
    df = spark.range(400).select(F.lit("").alias("agency"), F.lit("").alias("description"), F.format_string("water x%d", F.col("id") % 7).alias("title")).coalesce(1)
    expected = sorted(tuple(r) for r in tfidf.term_counts(tfidf.with_terms(df)).collect())
    monkeypatch.setattr(tfidf, "TASK_ROWS", 10)
    for terms in (tfidf.with_terms, tfidf.read_once):
        assert _most(terms(df)) <= 60
        assert sorted(tuple(r) for r in tfidf.term_counts(terms(df)).collect()) == expected


def test_phrases_are_indexed_under_long_pieces(spark):
    from oppflow.operators.matching import BLOCK, phrase_hits, rarest_pieces
    words = [f"road works {i:03d} and bridge repair" for i in range(200)] + ["road", "roadworks ab", "x" * BLOCK + "y"]
    phrases = spark.createDataFrame([(w,) for w in words], "phrase string")
    texts = spark.createDataFrame([(i, f"about {w}, " * 3) for i, w in enumerate(words)], "pos bigint, text string")
    index = {r.phrase: r.piece for r in rarest_pieces(phrases, texts, "text").collect()}
    assert {len(index[w]) for w in words[:200]} == {16} and len({index[w] for w in words[:200]}) > 100
    assert [len(index[w]) for w in words[200:]] == [4, 8, 16]
    expected = sorted((i, w) for i, v in enumerate(words) for w in words if w in v)
    assert sorted(tuple(r) for r in phrase_hits(texts, "pos", "text", phrases).collect()) == expected


def test_members_get_records_by_group(spark, monkeypatch):
    """Pairs are decided for groups, and no list or task of them is long, however many members share a pattern."""
    from oppflow.operators import digest
    monkeypatch.setattr(digest, "GROUP", 8)
    monkeypatch.setattr(digest, "TASK_PAIRS", 500)
    rows = [(i % 90 if i % 45 else None, ["a road", "Bridge", "road bridge", None][i % 4], None, "x", f"s{i % 3}") for i in range(200)]
    rfps = spark.createDataFrame(rows, "pos bigint, title string, description string, agency string, state string")
    own = [(f"m{i}" if i else None, p) for i in range(60) for p in (["ROAD"], ["bridge", "road"], ["tunnel"], ["", None], ["x"])[i % 5]]
    patterns = spark.createDataFrame(own, "email string, pattern string")
    expected = {(e, r[0]) for e, p in own if p for r in rows if p.lower() in f"{r[1] or ''}  x".lower()}

    def in_order(pairs):
        return sorted((tuple(p) for p in pairs), key=repr)

    found = digest.interests(rfps, "pos", patterns)
    assert found.pairs.count() <= 12 < len(expected)
    hits = digest.personal_hits(rfps, "pos", patterns)
    assert in_order(hits.collect()) == in_order(expected) and _most(hits) < len(expected) / 2
    digested = digest.personal_digest(rfps, "pos", patterns, "state").collect()
    assert in_order(digested) == in_order((e, k, r[4]) for e, k in expected for r in rows if k is not None and r[0] == k)
    members = spark.createDataFrame([(f"m{i}", f"M{i} N") for i in range(60)], "email string, name string")
    labels = spark.createDataFrame([("s1", "One", 0)], "state string, label string, ord int")
    heads = {r.email: (r.n, r.summary) for r in digest.personal_headers(found, rfps, "pos", members, labels, "2024-01-20").collect()}
    count = {e: [r.state for r in digested if r.email == e] for e in {e for e, _ in expected if e}}
    assert heads == {e: (len(s), f"{s.count('s1')} One, {s.count('s0')} s0, {s.count('s2')} s2") for e, s in count.items()}


def test_terms_are_few_in_each_task_after_the_shuffle(spark, monkeypatch):
    """Whatever number of shuffle tasks the session has, and its settings stay as they are."""
    df = spark.range(400).select(F.lit("").alias("agency"), F.lit("").alias("description"), F.translate(F.format_string("w%d", "id"), "0123456789", "abcdefghij").alias("title"))
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    docs = tfidf.with_terms(df.select("*", F.monotonically_increasing_id().alias("pos")), tfidf.STOP_WORDS, "pos")
    monkeypatch.setattr(tfidf, "TASK_ROWS", 10)
    counts = tfidf.term_counts(docs)
    held = counts.groupBy(F.input_file_name()).count().agg(F.max("count"), F.sum("count")).first()
    assert held[1] == 390 and held[0] <= 40  # one word a document, of three letters from the number 10 on
    vocab = tfidf.vocabulary(tfidf.with_terms(df.unionByName(df)), 800)
    assert vocab.count() == 390 and _most(tfidf.weights(docs, vocab, "pos")) <= 40
    assert before == [spark.conf.get(n) for n in names]


def test_phrases_sum_hot_and_rare_words(spark, monkeypatch):
    """Whatever number of words every task holds; words of one frequency stay together, and a word may be there twice."""
    from oppflow.operators import rake
    rows = [("road works", 3), ("works road", 2), ("road repair works now", 1), ("new new bridge", 1), ("old lamp", 1), ("road lamp", 4)]
    counted = spark.createDataFrame(rows, "phrase string, n bigint")
    freq, long = {}, {}
    for p, n in rows:
        for w in p.split():
            freq[w], long[w] = freq.get(w, 0) + n, long.get(w, 0) + n * len(p.split())
    last = {tuple(sorted(p.split())): p for p, _ in sorted(rows)}
    expected = {p: round(sum(long[w] / freq[w] for w in p.split()), 6) for p in last.values()}
    for hot, held in ((0, 0), (1, 1), (5, 4), (100, 8)):
        monkeypatch.setattr(rake, "HOT_WORDS", hot)
        assert rake.hot_words(rake.word_scores(counted))[0].count() == held
        got = [tuple(r) for r in rake.phrase_scores(counted).collect()]
        assert dict(got) == expected and len(got) == len(expected)
    assert rake.phrase_scores(counted.limit(0)).collect() == []


def test_ten_thousand_documents_are_the_most_of_a_task(spark):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 12_000 * cores, 1, cores).select(*[F.lit("water").alias(c) for c in ("title", "description", "agency")])
    for terms in (tfidf.with_terms, tfidf.read_once):
        assert _most(terms(df)) <= 2 * tfidf.TASK_ROWS <= 10_000
    assert tfidf.term_counts(tfidf.with_terms(df)).first().df == 12_000 * cores


def _index(spark, words, texts):
    from oppflow.operators import matching as M
    index = M.spans(M.rarest_pieces(spark.createDataFrame([(w,) for w in words], "phrase string"), texts, "text"))
    after = F.length("head") - F.col("place") - F.length("span")
    sizes = index.groupBy(F.length("piece").alias("size")).agg(F.max("place").alias("before"), F.max(after).alias("after"))
    return index, sizes.collect()


def test_texts_are_read_a_step_apart(spark, monkeypatch):
    """No row for every character and size, and whole texts however their cells end."""
    from oppflow.operators import matching as M
    monkeypatch.setattr(M, "CELL", 64)
    rows = [(1, "abcdefgö" * 30), (2, None), (3, ""), (None, "ß")]
    texts = spark.createDataFrame(rows, "pos bigint, text string")
    got = M.read(texts, "pos", "text", {16: 8, 4: 1}).select("pos", "size", "piece").collect()
    expected = [(k, size, bytes(raw[i: i + size])) for k, t in rows for raw in [(t or "").encode()] for size, step in ((16, 8), (4, 1)) for i in range(0, len(raw), step)]
    # the places of a cell begin anew with it, which all steps divide
    assert sorted(((r.pos, r.size, bytes(r.piece)) for r in got), key=repr) == sorted(expected, key=repr)


def test_places_with_a_piece_of_a_phrase_only_are_not_shuffled(spark):
    """What goes on to the index holds a whole span, not only a piece that many phrases and texts have."""
    from oppflow.operators import matching as M
    words = [f"{a}the department of water{b}" for a in "klmn" for b in "pqrs"]
    texts = [f"x the department of water {i:03d} " * 20 for i in range(50)] + ["a kthe department of waterp, " * 3]
    texts = spark.createDataFrame(list(enumerate(texts)), "pos bigint, text string")
    index, sizes = _index(spark, words, texts)
    going = M.near_places(texts, "pos", "text", index, sizes)
    assert {r.pos for r in going.collect()} == {50} and going.count() <= 6
    assert [tuple(r) for r in M.phrase_hits(texts, "pos", "text", index.select("phrase")).collect()] == [(50, "kthe department of waterp")]


def test_phrases_of_all_lengths_at_all_places(spark, monkeypatch):
    """Over cell ends, in several rounds of short phrases, with an index that is not broadcast; keys come twice or are null."""
    import random

    from oppflow.operators import matching as M
    for name, value in (("CELL", 64), ("BLOCK", 80), ("SHORT_PHRASES", 40)):
        monkeypatch.setattr(M, name, value)
    rng = random.Random(7)
    texts = [(i // 2 if i > 3 else None, "".join(rng.choices("abö ", weights=(4, 3, 1, 2), k=rng.choice((0, 1, 5, 63, 200, 300))))) for i in range(40)]
    raw = [t for _, t in texts if len(t) > 150]
    words = {t[a: a + n] for t in raw for n in (1, 2, 3, 4, 7, 10, 11, 15, 22, 23, 24, 40, 60, 78) for a in (0, rng.randrange(100), len(t) - n)}
    words |= {w[:-1] + "z" for w in words} | {"a", " "}
    df = spark.createDataFrame(texts, "pos bigint, text string").repartition(3)
    expected = {(k, w) for k, t in texts for w in words if w in t and len(w.encode()) <= 80}
    phrases = spark.createDataFrame([(w,) for w in words if len(w.encode()) <= 80], "phrase string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = [tuple(r) for r in M.phrase_hits(df, "pos", "text", phrases).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == len(expected) and set(got) == expected
