"""Record identity, first-wins deduplication and the memory of seen records."""
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oppflow.fixed_values import SEEN_DAYS


def record_hash(state: str = "state", ident: str = "id", title: str = "title") -> Column:
    """First 16 hex digits of SHA-256 over ``state-id-title``."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in (state, ident, title)]
    return F.left(F.sha2(F.concat_ws("-", *parts), 256), F.lit(16))


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the earliest row of every key.

    ``row_number() = 1`` is cut to one row per key *before* the shuffle as well as
    after it (the plan shows a partial and a final WindowGroupLimit), so a key that
    holds a third of all rows sends one row per task, not all of them to one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def unseen(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose hash no earlier run has seen; the batch holds each hash once."""
    return batch.join(seen.select("hash"), "hash", "left_anti")


def remember(seen: DataFrame, fresh: DataFrame, now: Column) -> DataFrame:
    """Old memory plus the fresh hashes; a re-sighting never renews ``first_seen``."""
    added = fresh.select("hash", now.cast("timestamp").alias("first_seen"), "title", "state")
    return seen.select("hash", "first_seen", "title", "state").unionByName(added)


def forget(seen: DataFrame, now: Column, days: int = SEEN_DAYS) -> DataFrame:
    """Drop hashes first seen more than ``days`` ago; exactly ``days`` is kept."""
    return seen.filter(F.col("first_seen") >= now - F.lit(timedelta(days=days)))


def run_report(fresh: DataFrame) -> DataFrame:
    return fresh.agg(
        F.count("*").alias("new_rfps"),
        F.count_if("keyword_match").alias("matched"),
        F.count_if(~F.col("keyword_match")).alias("unmatched"),
    )
