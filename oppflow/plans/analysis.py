"""The corpus analysis of a run, all sections from one weighing of the text."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oppflow.fixed_values import STOP_WORDS
from oppflow.operators import drift, rake, summary, tfidf
from oppflow.operators.dashboard import full_database
from oppflow.session import cut

GROUPS = ("state", "source", "keyword_match")  # what terms are compared by


def analyse(
    rfps: DataFrame, keywords: list[str], snapshots: DataFrame, run_ts: Column,
    stop_words: list[str] = STOP_WORDS,
) -> dict[str, DataFrame]:
    """Report sections by name, plus ``snapshot`` to append for the next run.

    Words are written once, and so are the sums of the one weighing that all term sections read.
    """
    weighed = tfidf.weigh_once(tfidf.read_once(rfps, stop_words, *GROUPS), GROUPS)
    scores = weighed.scores().select("term", "score")
    snap = cut(drift.snapshot(
        run_ts, tfidf.top_corpus_terms(tfidf.corpus_scores(scores)), drift.gap_terms(scores, keywords),
        rake.top_phrases(rfps, stop_words)))
    before = drift.previous_run(snapshots, run_ts)
    return {
        "header": summary.corpus_header(rfps),
        "top_terms": _listed(snap, "tfidf", "term"),
        "state_terms": tfidf.top_group_terms(weighed.scores("state"), "state"),
        "source_terms": tfidf.top_group_terms(weighed.scores("source"), "source"),
        "matched_terms": tfidf.matched_versus_rest(weighed.scores("keyword_match")),
        "phrases": _listed(snap, "rake", "phrase"),
        "gaps": _listed(snap, "gap", "term"),
        "covered_keywords": drift.covered_keywords(scores, keywords),
        "missing_keywords": drift.missing_report(drift.missing_keywords(scores, keywords)),
        "changes": drift.changes(snap, before),
        "run_summary": drift.run_summary(rfps, snap, before),
        "snapshot": snap,
    }


def _listed(snap: DataFrame, kind: str, name: str) -> DataFrame:
    """A ranked list of this run, read from its snapshot."""
    return snap.filter(F.col("kind") == kind).select("rank", F.col("term").alias(name), "score")


def report(sections: dict[str, DataFrame]) -> DataFrame:
    """The ranked lists of the analysis as one table ``(section, rank, term, score)``."""
    parts = [("tfidf", sections["top_terms"], "term", "score"), ("rake", sections["phrases"], "phrase", "score"),
             ("gap", sections["gaps"], "term", "score")]
    rows = [
        df.select(F.lit(name).alias("section"), "rank", F.col(term).alias("term"), F.col(score).alias("score"))
        for name, df, term, score in parts
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def dashboard(rfps: DataFrame, population: DataFrame, snapshot: DataFrame) -> dict[str, DataFrame]:
    """Dashboard sections by name.

    Stored records are ordered by the time of their run and then by hash, which a run has once; so a recipient's first
    place is that of one certain record.
    """
    return {
        "overview": summary.overview(rfps),
        "states": summary.state_breakdown(rfps, population),
        "sources": summary.source_performance(rfps),
        "terms": summary.snapshot_slices(snapshot),
        "top_recipients": summary.top_recipients(rfps.withColumn("pos", F.struct("scrape_timestamp", "hash"))),
        "database": full_database(rfps, "scrape_date", "hash"),
        "daily_counts": summary.cumulative_counts(summary.daily_counts(rfps)),
        "keyword_frequency": summary.keyword_frequency(rfps),
    }
