"""The sync of form responses into keyword preferences, as a job that reads only what is new."""
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oppflow.operators import preferences as P
from oppflow.session import cut
from oppflow.sources.commits import BucketState, committed
from oppflow.sources.store import exists
from oppflow.schema import PREFERENCE_SCHEMA

HISTORY_SCHEMA = "email string, ts timestamp, seq bigint, added array<string>, removed array<string>, raw_add string, raw_remove string"
REJECTED_SCHEMA = "email string, ts timestamp, seq bigint"


@dataclass
class PreferenceStore:
    """Folded state, history, rejected responses and the high-water mark below one folder.

    All of a sync counts with the one commit record of its batch, which also holds the mark.
    """
    spark: SparkSession
    root: str
    buckets: int = 64

    @property
    def state(self) -> BucketState:
        return BucketState(self.spark, f"{self.root}/state", PREFERENCE_SCHEMA, ["email"], self.buckets)

    def mark(self, batch: str | None = None):
        """The latest response time that batches before ``batch`` have read; None before the first."""
        commits = self.state.commits
        done = commits.read() if batch is None else commits.before(batch)
        return done.agg(F.max("mark").alias("mark")).first().mark

    def _appended(self, name: str, schema: str) -> DataFrame:
        if not exists(self.spark, f"{self.root}/{name}"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema + ", batch string").parquet(f"{self.root}/{name}")
        return committed(rows, self.state.commits.read()).drop("batch")

    def history(self) -> DataFrame:
        return self._appended("history", HISTORY_SCHEMA)

    def rejected(self) -> DataFrame:
        return self._appended("rejected", REJECTED_SCHEMA)


def sync(store: PreferenceStore, responses: DataFrame, members: DataFrame, aliases: DataFrame, batch: str) -> DataFrame:
    """Read the responses above the mark, add their changes to state and history, and move the mark; returns a report of one row.

    ``responses`` are those of the whole export, or of its new part.  The mark is the latest time of any well-formed
    response, also of unknown senders, so nobody's answer is read twice.  A response at exactly the mark counts as read.
    """
    mark = store.mark(batch)
    fresh = cut(P.resolve_email(P.newer_than(P.timed(responses), F.lit(mark).cast("timestamp")), members, aliases))
    history = cut(P.change_history(fresh))
    history.write.mode("overwrite").parquet(f"{store.root}/history/batch={batch}")
    P.rejected(fresh).select("email", "ts", "seq").write.mode("overwrite").parquet(f"{store.root}/rejected/batch={batch}")
    latest = P.high_water_mark(fresh).select(F.greatest("mark", F.lit(mark).cast("timestamp")).cast("string").alias("mark")).first().mark
    store.state.merge(P.operations(history), batch, P.fold, mark=latest)
    return fresh.agg(
        F.count("*").alias("responses"), F.count_if(F.col("member").isNull()).alias("rejected"),
    ).crossJoin(history.agg(F.count("*").alias("changes")))  # one row each


def digest_patterns(store: PreferenceStore, members: DataFrame) -> DataFrame:
    """(email, pattern) that digests search for: base patterns with the folded preferences applied."""
    return P.effective_patterns(members, store.state.read())
