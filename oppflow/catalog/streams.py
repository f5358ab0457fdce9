"""The streaming jobs, drained over the events and the documents."""
from pyspark.sql import functions as F

from oppflow.catalog.base import (
    EVENTS, EXCLUDED, KEYWORDS, TAGGED, fresh_dir, query, rfps, table, with_sql,
)
from oppflow.sources.commits import BucketState
from oppflow.streaming import jobs


def event_stream(spark, d):
    """The events file as a stream with an event-time timestamp."""
    schema = table(spark, d, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return raw.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
        (F.col("event_type") == "purchase").alias("keyword_match"),
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("hash"),
    )


@query("k1_stream_new_keys", with_sql(EVENTS, select="select distinct hash from v_event"))
def _(spark, d):
    path = fresh_dir(spark)
    stream = jobs.new_keys(event_stream(spark, d))
    jobs.run_available(stream, f"{path}/progress", jobs.append_to(f"{path}/out")).awaitTermination()
    return spark.read.schema("hash string").parquet(f"{path}/out").select("hash")


@query("k2_stream_daily_counts", with_sql(EVENTS, select="""
select scrape_date, count(*) as new_rfps, count(*) filter (keyword_match) as new_matches from v_event group by scrape_date"""))
def _(spark, d):
    path = fresh_dir(spark)
    stream = jobs.daily(event_stream(spark, d))
    jobs.run_available(stream, f"{path}/progress", jobs.append_to(f"{path}/out"), "update").awaitTermination()
    written = spark.read.schema("scrape_date string, new_rfps bigint, new_matches bigint, batch int").parquet(f"{path}/out")
    return jobs.latest_per_key(written, "scrape_date")


@query("k3_stream_ingest", with_sql(TAGGED, select="""
select left(sha256(concat_ws('-', state, '', title)), 16) as hash, arg_min(rfp_id, pos) as rfp_id, arg_min(keyword_match, pos) as keyword_match
from v_tag group by 1"""))
def _(spark, d):
    path = fresh_dir(spark)
    rows = rfps(spark, d).drop("scrape_date").withColumn("id", F.lit("")).withColumn(
        "scraped_at", F.lit("2024-02-01 00:01:00").cast("timestamp")
    )
    rows.write.parquet(f"{path}/landed")
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/landed")
    sink = jobs.ingest_sink(f"{path}/store", KEYWORDS, ["pos"], exclusions=EXCLUDED)
    jobs.run_available(stream, f"{path}/progress", sink).awaitTermination()
    return spark.read.parquet(f"{path}/store").select("hash", "rfp_id", "keyword_match")


@query("k4_stream_preferences", """
select cast(user_id as varchar) as email, event_type as kw, case when event_id % 3 = 0 then 'remove' else 'add' end as op, event_id as seq
from events qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1""")
def _(spark, d):
    path = fresh_dir(spark)
    stream = event_stream(spark, d).select(
        F.col("user_id").cast("string").alias("email"), F.col("event_type").alias("kw"),
        F.when(F.col("event_id") % 3 == 0, "remove").otherwise("add").alias("op"), F.col("event_id").alias("seq"),
    )
    state = BucketState(spark, f"{path}/state", "email string, kw string, op string, seq bigint", ["email"], 16)
    jobs.run_available(stream, f"{path}/progress", jobs.bucket_preference_sink(state)).awaitTermination()
    return state.read()


_KEPT = """with recursive e as (
  select 'u' || user_id || '-' || event_type as rfp_id, ts, min(event_id) as event_id from events group by 1, 2),
kept(rfp_id, ts) as (
  select rfp_id, min(ts) from e group by rfp_id
  union all
  select e.rfp_id, min(e.ts) from kept join e on e.rfp_id = kept.rfp_id and e.ts > kept.ts + interval 2 day group by e.rfp_id)
select kept.rfp_id, cast(event_id as varchar) as event_id, kept.ts from kept join e on e.rfp_id = kept.rfp_id and e.ts = kept.ts"""


@query("k3_stream_late_records", _KEPT)
def _(spark, d):
    """Three batches whose records' times overlap, so that records come late in the second and third."""
    path = fresh_dir(spark)
    rows = table(spark, d, "events").select(
        F.lit("S").alias("state"), F.lit("s").alias("source"), F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), "event_type").alias("id"),
        F.lit("").alias("title"), F.lit("").alias("agency"), F.col("event_id").cast("string").alias("description"),
        F.col("ts").cast("timestamp").alias("scraped_at"), F.col("event_id").alias("pos"))
    sink = jobs.keyed_ingest_sink(path, KEYWORDS, ["pos"], days=2, exclusions=EXCLUDED)
    for part in range(3):
        rows.filter(F.pmod(F.xxhash64("pos"), F.lit(3)) == part).write.parquet(f"{path}/landed/{part}")
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true")
    for part in range(3):
        landed = stream.parquet(f"{path}/landed/{part}")
        number = part
        jobs.run_available(landed, f"{path}/progress/{part}", lambda batch, _n, number=number: sink(batch, number)).awaitTermination()
    return jobs.stored_records(spark, path).select(
        "rfp_id", F.col("description").alias("event_id"), F.col("scrape_timestamp").cast("timestamp_ntz").alias("ts"))
