"""What changed between two runs of the corpus analysis, and what the dictionary misses."""
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oppflow.fixed_values import MIN_GAP_SCORE, TOP_GAPS, TOP_PHRASES, TOP_TERMS
from oppflow.operators.matching import covered_by
from oppflow.operators.ranking import ranked

RISING_SHARE = 0.10
RISING_SHOWN = 15
COVERED_SHOWN = 20
MISSING_SHOWN = 30


def gap_terms(scores: DataFrame, keywords: list[str], k: int = TOP_GAPS) -> DataFrame:
    """High-scoring vocabulary terms no keyword covers.  ``scores(term, score)`` unrounded."""
    open_terms = scores.filter(
        (F.col("score") >= MIN_GAP_SCORE) & ~covered_by(F.col("term"), keywords)
    ).select("term", F.round("score", 6).alias("score"))
    return ranked(open_terms, [F.desc("score"), F.asc("term")], k)


def keyword_table(spark: SparkSession, keywords: list[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in sorted({k.lower() for k in keywords})], "keyword string")


def covered_keywords(scores: DataFrame, keywords: list[str], k: int = COVERED_SHOWN) -> DataFrame:
    """Keywords that are vocabulary terms, by score."""
    table = keyword_table(scores.sparkSession, keywords)
    found = table.join(scores, F.col("keyword") == F.col("term")).select(
        "keyword", F.round("score", 6).alias("score")
    )
    return ranked(found, [F.desc("score"), F.asc("keyword")], k)


def missing_keywords(scores: DataFrame, keywords: list[str]) -> DataFrame:
    """Every keyword that is no vocabulary term, alphabetical."""
    table = keyword_table(scores.sparkSession, keywords)
    return table.join(scores.select(F.col("term").alias("keyword")), "keyword", "left_anti")


def missing_report(missing: DataFrame, k: int = MISSING_SHOWN) -> DataFrame:
    """The first ``k`` missing keywords and how many more there are."""
    shown = ranked(missing, [F.asc("keyword")], k)
    rest = missing.agg(F.greatest(F.count("*") - F.lit(k), F.lit(0)).alias("remaining")).scalar()
    return shown.withColumn("remaining", rest)


def snapshot(run_ts: Column, terms: DataFrame, gaps: DataFrame, phrases: DataFrame) -> DataFrame:
    """The lists of one run as rows ``(run_ts, kind, rank, term, score)``."""
    parts = [
        ("tfidf", terms.filter(F.col("rank") <= TOP_TERMS), "term"),
        ("gap", gaps.filter(F.col("rank") <= TOP_GAPS), "term"),
        ("rake", phrases.filter(F.col("rank") <= TOP_PHRASES), "phrase"),
    ]
    rows = [
        df.select(
            run_ts.alias("run_ts"), F.lit(kind).alias("kind"), "rank", F.col(name).alias("term"), "score"
        )
        for kind, df, name in parts
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def previous_run(snapshots: DataFrame, before: Column) -> DataFrame:
    """Rows of the latest run earlier than ``before``; none on the first run."""
    earlier = snapshots.filter(F.col("run_ts") < before)
    return earlier.filter(F.col("run_ts") == earlier.agg(F.max("run_ts")).scalar())


def _kind(snap: DataFrame, kind: str) -> DataFrame:
    return snap.filter(F.col("kind") == kind).select("term", "score")


def new_entries(current: DataFrame, previous: DataFrame, kind: str) -> DataFrame:
    return _kind(current, kind).join(_kind(previous, kind), "term", "left_anti")


def dropped_entries(current: DataFrame, previous: DataFrame, kind: str = "tfidf") -> DataFrame:
    return new_entries(previous, current, kind)


def rising_terms(current: DataFrame, previous: DataFrame, k: int = RISING_SHOWN) -> DataFrame:
    """Terms of both runs whose score grew by more than a tenth."""
    both = _kind(current, "tfidf").withColumnRenamed("score", "new_score").join(
        _kind(previous, "tfidf").withColumnRenamed("score", "old_score"), "term"
    )
    gain = F.when(F.col("old_score") > 0, (F.col("new_score") - F.col("old_score")) / F.col("old_score"))
    rising = both.withColumn("gain", gain).filter(F.col("gain") > RISING_SHARE)
    rising = rising.select("term", "old_score", "new_score", F.round("gain", 6).alias("gain"))
    return ranked(rising, [F.desc("gain"), F.asc("term")], k)


def term_status(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Every term of either run: new, dropped or kept, with both scores."""
    now = _kind(current, "tfidf").withColumnRenamed("score", "new_score")
    old = _kind(previous, "tfidf").withColumnRenamed("score", "old_score")
    return now.join(old, "term", "full_outer").select(
        "term", "old_score", "new_score",
        F.when(F.col("old_score").isNull(), "new").when(F.col("new_score").isNull(), "dropped")
        .otherwise("kept").alias("status"),
    )


def changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """All changes of a run as ``(change, term, score)``; ``baseline`` on the first run."""
    first_run = _kind(previous, "tfidf").agg(F.count("*") == 0).scalar()
    parts = [
        ("new_term", new_entries(current, previous, "tfidf")),
        ("dropped_term", dropped_entries(current, previous)),
        ("rising_term", rising_terms(current, previous).select("term", F.col("new_score").alias("score"))),
        ("new_gap", new_entries(current, previous, "gap")),
        ("new_phrase", new_entries(current, previous, "rake")),
    ]
    rows = None
    for change, df in parts:
        df = df.select(F.lit(change).alias("change"), "term", "score")
        rows = df if rows is None else rows.unionByName(df)
    baseline = _kind(current, "tfidf").agg(F.count("*").alias("n")).select(
        F.lit("baseline").alias("change"), F.lit("").alias("term"), F.lit(0.0).alias("score")
    )
    return (
        rows.withColumn("_first", first_run).filter(~F.col("_first")).drop("_first")
        .unionByName(baseline.withColumn("_first", first_run).filter("_first").drop("_first"))
    )


def run_summary(rfps: DataFrame, current: DataFrame, previous: DataFrame) -> DataFrame:
    """One row: records, top term, gap candidates, new terms."""
    return rfps.agg(F.count("*").alias("rfps")).select(
        "rfps",
        F.coalesce(
            current.filter("kind = 'tfidf' and rank = 1").agg(F.max("term")).scalar(), F.lit("n/a")
        ).alias("top_term"),
        current.filter("kind = 'gap'").agg(F.count("*")).scalar().alias("gap_candidates"),
        F.when(
            _kind(previous, "tfidf").agg(F.count("*")).scalar() > 0,
            new_entries(current, previous, "tfidf").agg(F.count("*")).scalar(),
        ).otherwise(F.lit(0)).alias("new_terms"),
    )
