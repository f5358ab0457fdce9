"""One run of the ingest: raw records in, new tagged records and new memory out."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oppflow.fixed_values import EXCLUSIONS, SEEN_DAYS, STOP_WORDS
from oppflow.operators.identity import first_wins, forget, record_hash, remember, run_report, unseen
from oppflow.operators.tagging import add_key_terms, tag
from oppflow.schema import RFP_SCHEMA, canonical, or_empty
from oppflow.session import cut
from oppflow.sources.commits import DatedMemory, committed
from oppflow.sources.store import StateTable, exists, write_batch


def new_records(raw: DataFrame, seen: DataFrame, order: list[str]) -> DataFrame:
    """Hash, keep the first of each hash, drop what earlier runs have seen.

    Both steps shuffle by hash, and the second reuses the partitioning of the first.
    """
    hashed = raw.withColumn("hash", record_hash())
    return unseen(first_wins(hashed, ["hash"], order), seen)


def enrich(
    fresh: DataFrame, keywords: list[str], now: Column,
    exclusions: list[str] = EXCLUSIONS, stop_words: list[str] = STOP_WORDS,
) -> DataFrame:
    """Tag and mine each record in its row and bring it to the stored columns."""
    return canonical(add_key_terms(tag(fresh, keywords, exclusions), stop_words), now)


def run(
    raw: DataFrame, seen_state: StateTable | DatedMemory, store: str, keywords: list[str], now: Column,
    order: list[str], seen_days: int = SEEN_DAYS, exclusions: list[str] = EXCLUSIONS,
    stop_words: list[str] = STOP_WORDS, batch: str | None = None,
) -> DataFrame:
    """A whole run.  Returns its report (one row).

    The run writes a folder named ``batch``, or by its time where no name is given: a run that was lost between
    records and memory is repeated under the same name, or at the same time, and replaces its records.

    With a ``DatedMemory`` the run adds its own hashes to the memory and nothing else, and its commit record makes
    records and memory count together (``committed_rfps``); with a ``StateTable`` the memory is written anew.

    An expired hash still blocks the run that forgets it, and is let in by the next.
    The new records are written once to shared storage; records, memory and report
    are all read from there, so none of the text work is done twice.
    """
    if batch is None:
        batch = raw.sparkSession.range(1).select(F.date_format(now, "yyyyMMdd'T'HHmmss").alias("name")).first().name
    dated = isinstance(seen_state, DatedMemory)
    seen = seen_state.read(batch) if dated else seen_state.read()
    rfps = cut(enrich(new_records(raw, seen, order), keywords, now, exclusions, stop_words))
    write_batch(rfps, store, batch)
    if dated:
        seen_state.append(rfps, batch, now, seen_days)
        return run_report(rfps)
    seen_state.write(forget(remember(seen, rfps, now), now, seen_days))
    return run_report(rfps)


def committed_rfps(memory: DatedMemory, store: str) -> DataFrame:
    """The stored records of finished runs; what a lost run left is not read."""
    if not exists(memory.spark, store):
        return memory.spark.createDataFrame([], RFP_SCHEMA)
    rows = memory.spark.read.schema(RFP_SCHEMA + ", batch string").parquet(store)
    return committed(rows, memory.commits.read()).drop("batch")


def typed_dates(rfps: DataFrame) -> DataFrame:
    """Add ``posted_ts`` and ``close_ts`` parsed from the heterogeneous date texts."""
    # --- fixed values: date layouts that sources use
    layouts = [
        "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy h:mm a",
        "M/d/yyyy", "M/d/yy", "MMM d, yyyy",
    ]

    def parsed(name: str) -> Column:
        return F.coalesce(*[F.try_to_timestamp(or_empty(name), F.lit(f)) for f in layouts])

    return rfps.withColumn("posted_ts", parsed("posted_date")).withColumn("close_ts", parsed("close_date"))


def windows_back(days: DataFrame, day: str, total: int, chunk: int) -> DataFrame:
    """Windows of ``chunk`` days going back ``total`` days; neighbours share a day."""
    offsets = F.sequence(F.lit(0), F.lit(total - 1), F.lit(chunk))
    layout = "MM/dd/yyyy"
    return days.select(day, F.posexplode(offsets).alias("chunk", "start")).select(
        day, "chunk",
        F.date_format(F.date_sub(day, F.least(F.col("start") + chunk, F.lit(total))), layout).alias("from_date"),
        F.date_format(F.date_sub(day, F.col("start")), layout).alias("to_date"),
    )
