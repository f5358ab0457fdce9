"""The incremental jobs as Structured Streaming."""
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from oppflow.fixed_values import EXCLUSIONS, SEEN_DAYS, STOP_WORDS
from oppflow.operators.identity import first_wins, record_hash
from oppflow.operators.preferences import fold
from oppflow.plans.ingest import enrich
from oppflow.schema import RFP_SCHEMA
from oppflow.session import cut
from oppflow.sources.commits import BucketState
from oppflow.sources.store import StateTable, _files, exists, write_batch


def new_keys(stream: DataFrame, ts: str = "ts", key: str = "hash", days: int = SEEN_DAYS) -> DataFrame:
    """Each key once, remembered for ``days`` from its first sighting.

    Which of several rows in one micro-batch survives is arbitrary, so only the key
    goes on; use ``ingest`` where the row matters.
    """
    return (
        stream.withWatermark(ts, f"{days} days").dropDuplicatesWithinWatermark([key]).select(key)
    )


def daily(stream: DataFrame, ts: str = "ts", delay: str = "2 days") -> DataFrame:
    """Rows and matches per day; run it in update mode and keep the last row per day."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day"))
        .agg(F.count("keyword_match").alias("new_rfps"), F.count_if("keyword_match").alias("new_matches"))
        .select(
            F.date_format("window.start", "yyyy-MM-dd").alias("scrape_date"), "new_rfps", "new_matches"
        )
    )


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Process what has arrived, batch by batch, and stop."""
    return (
        stream.writeStream.outputMode(mode).foreachBatch(sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that may see a batch twice: the batch number names its folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def latest_per_key(written: DataFrame, key: str) -> DataFrame:
    """The row of the latest batch for every key, from what ``append_to`` wrote."""
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("batch")))
    return written.withColumn("_last", last).filter("_last = 1").drop("_last", "batch")


def admitted_times(hashed: DataFrame, earlier: DataFrame, days: int) -> DataFrame:
    """(hash, scraped_at) of the sightings to store: each more than ``days`` after the one stored before it.

    ``earlier`` has the ``last`` stored time of a hash.  A hash has as many times as the batch has runs.
    """
    limit = F.lit(timedelta(days=days))
    times = hashed.groupBy("hash").agg(F.sort_array(F.collect_set("scraped_at")).alias("times")).join(earlier, "hash", "left")
    start = F.struct(F.expr("cast(array() as array<timestamp>)").alias("kept"), F.col("last").cast("timestamp").alias("last"))

    def step(seen, t):
        new = seen["last"].isNull() | (t > seen["last"] + limit)
        return F.when(new, F.struct(F.concat(seen["kept"], F.array(t)).alias("kept"), t.alias("last"))).otherwise(seen)
    return times.select("hash", F.explode(F.aggregate("times", start, step)["kept"]).alias("scraped_at"))


def ingest_sink(
    path: str, keywords: list[str], order: list[str], days: int = SEEN_DAYS,
    exclusions: list[str] = EXCLUSIONS, stop_words: list[str] = STOP_WORDS,
) -> Callable[[DataFrame, int], None]:
    """Tag, mine and append a micro-batch of raw records whose hash is new.

    The stored records are the memory: a batch that runs again compares itself with
    the batches *before* it and writes its own folder anew, so the result is the
    same.  Only the dates of the last ``days`` days are read for it.

    A record is new where no stored record of its hash is at most ``days`` older.  That is decided record by record, so
    records that arrive in the order of their time give the same rows however they are cut into batches.  Where records can arrive
    late, use ``keyed_ingest_sink``.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        oldest = batch.agg(F.min("scraped_at")).first()[0]
        if oldest is None:
            return
        hashed = batch.withColumn("hash", record_hash())
        earlier = spark.createDataFrame([], "hash string, last timestamp")
        if exists(spark, path):
            since = F.lit(oldest - timedelta(days=days))
            earlier = spark.read.schema(RFP_SCHEMA + ", batch int").parquet(path).filter(
                (F.col("batch") < number)
                & (F.col("scrape_date") >= F.date_format(since, "yyyy-MM-dd"))
                & (F.col("scrape_timestamp") >= since)
            ).groupBy("hash").agg(F.max("scrape_timestamp").alias("last"))
        admitted = admitted_times(hashed, earlier, days)
        fresh = first_wins(hashed, ["hash", "scraped_at"], order).join(admitted, ["hash", "scraped_at"], "left_semi")
        write_batch(enrich(fresh, keywords, F.col("scraped_at"), exclusions, stop_words), path, str(number))

    return write


def stored_records(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """What ``keyed_ingest_sink`` has stored: the last change of every hash and time, where it is no removal."""
    schema = RFP_SCHEMA + ", kept boolean, sighting int"
    if not exists(spark, f"{path}/changes"):
        return spark.createDataFrame([], schema).drop("kept")
    changes = spark.read.schema(schema + ", batch int").parquet(f"{path}/changes")
    if before is not None:
        changes = changes.filter(F.col("batch") < before)
    last = F.row_number().over(Window.partitionBy("hash", "scrape_timestamp").orderBy(F.desc("batch")))
    return changes.withColumn("_last", last).filter("_last = 1 and kept").drop("_last", "kept", "batch")


def keyed_ingest_sink(
    path: str, keywords: list[str], order: list[str], days: int = SEEN_DAYS,
    exclusions: list[str] = EXCLUSIONS, stop_words: list[str] = STOP_WORDS,
) -> Callable[[DataFrame, int], None]:
    """``ingest_sink`` for records that arrive in any order: after all batches, what one batch of them all would store.

    Every micro-batch is kept as sightings.  For the hashes that it brings, the times to store are decided anew from
    the batch's oldest record on, with the sightings of earlier batches and the last stored time before.  What differs from
    what is stored is written as changes: records to add, and times to take back because a late record came before them.  So a
    batch writes touched hashes alone, and reads only days since its oldest record (and ``days`` before it).  A repeated batch
    reads the ones before it and writes the same folders.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        hashed = batch.withColumn("hash", record_hash()).withColumn("day", F.to_date("scraped_at"))
        hashed.write.mode("overwrite").partitionBy("day").parquet(f"{path}/sightings/batch={number}")
        fields = StructType([*hashed.schema.fields, StructField("batch", IntegerType())])
        if not any_rows(spark, f"{path}/sightings/batch={number}"):
            return
        seen = spark.read.schema(fields).parquet(f"{path}/sightings").filter(F.col("batch") <= number)
        own = seen.filter(F.col("batch") == number)
        oldest = own.agg(F.min("scraped_at")).first()[0]
        if oldest is None:
            return
        touched = cut(own.select("hash").distinct())
        start, since = F.lit(oldest), F.lit(oldest - timedelta(days=days))
        history = seen.filter((F.col("day") >= F.to_date(start)) & (F.col("scraped_at") >= start)).join(touched, "hash", "left_semi")
        one = cut(first_wins(history, ["hash", "scraped_at"], [*order, "batch"]))
        stored = stored_records(spark, path, number).filter(
            (F.col("scrape_date") >= F.date_format(since, "yyyy-MM-dd")) & (F.col("scrape_timestamp") >= since)
        ).join(touched, "hash", "left_semi").select("hash", F.col("scrape_timestamp").alias("scraped_at"), "sighting", "scrape_date")
        stored = cut(stored)
        earlier = stored.filter(F.col("scraped_at") < start).groupBy("hash").agg(F.max("scraped_at").alias("last"))
        admitted = admitted_times(one, earlier, days)
        wanted = cut(one.join(admitted, ["hash", "scraped_at"], "left_semi").withColumn("sighting", F.col("batch")))
        present = stored.filter(F.col("scraped_at") >= start)
        added = wanted.join(present.select("hash", "scraped_at", "sighting"), ["hash", "scraped_at", "sighting"], "left_anti")
        records = enrich(added, keywords, F.col("scraped_at"), exclusions, stop_words)
        keys = added.select(F.col("hash").alias("h"), F.col("scraped_at").alias("t"), "sighting")
        records = records.join(keys, (F.col("hash") == F.col("h")) & (F.col("scrape_timestamp") == F.col("t"))).drop("h", "t")
        gone = present.join(wanted.select("hash", "scraped_at"), ["hash", "scraped_at"], "left_anti").select(
            "hash", F.col("scraped_at").alias("scrape_timestamp"), "sighting", "scrape_date")
        changes = records.withColumn("kept", F.lit(True)).unionByName(gone.withColumn("kept", F.lit(False)), allowMissingColumns=True)
        changes.write.mode("overwrite").partitionBy("scrape_date").parquet(f"{path}/changes/batch={number}")

    return write


def any_rows(spark: SparkSession, path: str) -> bool:
    """Whether a partitioned write has left a folder of rows."""
    fs, folder = _files(spark, path)
    return any("=" in s.getPath().getName() for s in fs.listStatus(folder))


def bucket_preference_sink(state: BucketState) -> Callable[[DataFrame, int], None]:
    """Fold a micro-batch of operations into the buckets of the members that it names; other buckets stay as they are."""

    def write(batch: DataFrame, number: int) -> None:
        state.merge(batch, f"stream-{number}", fold)

    return write


def preference_sink(state: StateTable) -> Callable[[DataFrame, int], None]:
    """Fold a micro-batch of operations into the preference state.

    Operations carry their own ``seq``, so folding a batch twice changes nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        columns = [c for c in ("email", "kw", "op", "ts", "seq") if c in batch.columns]
        state.write(fold(state.read().select(*columns).unionByName(batch.select(*columns))))

    return write
