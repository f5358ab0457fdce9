"""State written batch by batch: a commit record per batch, dated memory, buckets replaced one by one.

A batch has a name.  Its files go to folders of that name and count once its commit record is there, which
is written last and put in place by one rename.  A batch that was lost has no record, and nothing of it is read; it is
repeated under its name and replaces what it left.  A finished batch that runs again does not read its own files, so
it writes the same ones.
"""
import json
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oppflow.schema import SEEN_SCHEMA
from oppflow.sources.store import _files, exists

COMMIT_SCHEMA = "batch string, number bigint, at timestamp, keep_from timestamp, mark timestamp, buckets array<int>, rows bigint"


class Commits:
    """Commit records, one JSON file per finished batch; ``number`` counts them up."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root}/_commits"

    def read(self) -> DataFrame:
        """One row per finished batch."""
        if not exists(self.spark, self.root):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).json(self.root)

    def before(self, batch: str) -> DataFrame:
        """The batches that count for ``batch``: those finished before it first was, or all if it never was."""
        done = self.read()
        own = done.filter(F.col("batch") == batch).select("number").first()
        return done.filter(F.col("batch") != batch) if own is None else done.filter(F.col("number") < own.number)

    def next_number(self, batch: str) -> int:
        done = self.read()
        found = done.agg(F.max(F.when(F.col("batch") == batch, F.col("number"))).alias("own"), F.max("number").alias("last")).first()
        return found.own if found.own is not None else (found.last or 0) + 1

    def write(self, batch: str, **values) -> None:
        """Put the record in place; its rename makes the batch count."""
        record = json.dumps({"batch": batch, "number": self.next_number(batch), **{k: v for k, v in values.items() if v is not None}})
        name = quote(batch, safe="")
        fs, folder = _files(self.spark, self.root)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(folder)
        written, final = path(folder, f"_{name}.writing"), path(folder, f"c-{name}.json")
        out = fs.create(written, True)
        out.write(bytearray(record.encode()))
        out.close()
        fs.delete(final, False)
        if not fs.rename(written, final):
            raise OSError(f"commit of {batch} was not put in place")


def committed(rows: DataFrame, batches: DataFrame) -> DataFrame:
    """The rows of these batches; the list has a row per run and prunes folders."""
    return rows.join(F.broadcast(batches.select("batch")), "batch", "left_semi")


class DatedMemory:
    """Hashes that were seen, in a folder per day of first sighting and batch.

    A run writes its own hashes and nothing else.  What it forgets is a bound in its commit record; whole days behind the
    bound of the run before are dropped as folders, as a repeated run still reads from that bound on.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.commits = Commits(spark, root)

    def read(self, batch: str | None = None) -> DataFrame:
        """(hash, first_seen, title, state) known to ``batch``, or to a next one."""
        batches = self.commits.read() if batch is None else self.commits.before(batch)
        last = batches.agg(F.max_by("keep_from", "number").alias("keep_from")).first().keep_from
        if last is None or not exists(self.spark, f"{self.root}/days"):
            return self.spark.createDataFrame([], SEEN_SCHEMA)
        rows = self.spark.read.schema(SEEN_SCHEMA + ", day date, batch string").parquet(f"{self.root}/days")
        kept = rows.filter((F.col("day") >= F.lit(last).cast("date")) & (F.col("first_seen") >= F.lit(last)))
        return committed(kept, batches).select("hash", "first_seen", "title", "state")

    def append(self, fresh: DataFrame, batch: str, now, days: int) -> None:
        """Add the hashes of a run at ``now`` and finish the batch; hashes first seen more than ``days`` before it are forgotten."""
        at = self.spark.range(1).select(
            now.cast("timestamp").alias("at"), (now.cast("timestamp") - F.make_dt_interval(F.lit(days))).alias("keep_from"), F.date_format(now, "yyyy-MM-dd").alias("day"),
            now.cast("timestamp").cast("string").alias("at_text"), (now.cast("timestamp") - F.make_dt_interval(F.lit(days))).cast("string").alias("keep_text")).first()
        folder = f"{self.root}/days/day={at.day}/batch={quote(batch, safe='')}"
        fresh.select("hash", F.lit(at.at).alias("first_seen"), "title", "state").write.mode("overwrite").parquet(folder)
        self.commits.write(batch, at=at.at_text, keep_from=at.keep_text)
        before = self.commits.before(batch).agg(F.date_format(F.max_by("keep_from", "number"), "yyyy-MM-dd").alias("day")).first().day
        if before is not None:
            self.drop_days(before)

    def days(self) -> list[str]:
        fs, folder = _files(self.spark, f"{self.root}/days")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(n.removeprefix("day=") for n in names if n.startswith("day="))

    def drop_days(self, first: str) -> None:
        for day in self.days():
            if day < first:
                fs, folder = _files(self.spark, f"{self.root}/days/day={day}")
                fs.delete(folder, True)


class BucketState:
    """A keyed table of ``buckets`` parts, of which a batch replaces those it touches.

    A bucket is read from the last finished batch that wrote it.  Batch folders that no bucket is read from are removed.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, keys: list[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.keys, self.buckets = spark, root, schema, keys, buckets
        self.commits = Commits(spark, root)

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def read(self, batch: str | None = None, only: list[int] | None = None) -> DataFrame:
        """The rows known to ``batch``, or to a next one; of the buckets ``only``, if given."""
        batches = self.commits.read() if batch is None else self.commits.before(batch)
        places = batches.select(F.explode("buckets").alias("bucket"), "number", "batch").groupBy("bucket").agg(
            F.max_by("batch", "number").alias("batch"))
        if not exists(self.spark, f"{self.root}/rows"):
            return self.spark.createDataFrame([], self.schema)
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema.fields]
        rows = self.spark.read.schema(self.schema + ", batch string, bucket int").parquet(f"{self.root}/rows")
        if only is not None:
            rows = rows.filter(F.col("bucket").isin(only))
        return rows.join(F.broadcast(places), ["batch", "bucket"], "left_semi").select(*names)

    def merge(self, rows: DataFrame, batch: str, fold, **record) -> None:
        """Replace the buckets of ``rows`` by ``fold`` of what they held and the new rows, and finish the batch."""
        # at most ``buckets`` numbers
        touched = sorted(r.b for r in rows.select(self.bucket().alias("b")).distinct().collect())
        names = self.spark.createDataFrame([], self.schema).columns
        merged = fold(self.read(batch, touched).unionByName(rows.select(*names)))
        placed = merged.withColumn("bucket", self.bucket())
        # a bucket is one file: its rows meet in one task, whose share shrinks with the number of buckets
        placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/rows/batch={quote(batch, safe='')}")
        self.commits.write(batch, buckets=touched, **record)
        self.trim()

    def trim(self) -> None:
        """Remove the folders of finished batches that no bucket is read from any more, but for the last two."""
        done = self.commits.read().select("batch", "number", F.explode_outer("buckets").alias("bucket"))
        used = done.groupBy("bucket").agg(F.max("number").alias("number")).select("number").distinct()
        last = self.commits.read().orderBy(F.desc("number")).limit(2).select("number")
        unused = self.commits.read().select("batch", "number").join(used.union(last), "number", "left_anti")
        for row in unused.select("batch").collect():  # a row per batch whose buckets were all replaced since
            fs, folder = _files(self.spark, f"{self.root}/rows/batch={quote(row.batch, safe='')}")
            fs.delete(folder, True)
