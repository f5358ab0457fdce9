"""Stored records and the versioned state tables kept between runs."""
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oppflow.schema import PREFERENCE_SCHEMA, RFP_SCHEMA, SEEN_SCHEMA, SNAPSHOT_SCHEMA


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _files(spark, path)
    return fs.exists(hadoop)


def read_rfps(spark: SparkSession, path: str) -> DataFrame:
    """The stored records, empty before the first run; a date filter prunes folders."""
    if not exists(spark, path):
        return spark.createDataFrame([], RFP_SCHEMA)
    return spark.read.schema(RFP_SCHEMA).parquet(path)


def append_rfps(rfps: DataFrame, path: str) -> None:
    """Add records under their date.  A run has one date, so tasks write side by side
    without a shuffle by date, which would put the whole run into one task."""
    rfps.write.mode("append").option("compression", "snappy").partitionBy("scrape_date").parquet(path)


def write_batch(rfps: DataFrame, path: str, batch: str) -> None:
    """Write one run under its own name; running it again replaces only that run."""
    rfps.write.mode("overwrite").partitionBy("scrape_date").parquet(f"{path}/batch={batch}")


class StateTable:
    """A table written as whole versions; readers always see a finished one.

    A new version goes to its own folder and counts from its ``_SUCCESS`` marker on,
    so the version being read is never overwritten and a lost run leaves no trace.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root, schema

    def versions(self) -> list[int]:
        fs, hadoop = _files(self.spark, self.root)
        if not fs.exists(hadoop):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
        numbers = sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())
        return [n for n in numbers if exists(self.spark, f"{self.root}/v{n}/_SUCCESS")]

    def read(self) -> DataFrame:
        done = self.versions()
        if not done:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/v{done[-1]}")

    def write(self, df: DataFrame) -> int:
        number = (self.versions() or [0])[-1] + 1
        df.write.mode("overwrite").parquet(f"{self.root}/v{number}")
        return number


def seen_table(spark: SparkSession, root: str) -> StateTable:
    return StateTable(spark, root, SEEN_SCHEMA)


def preference_log(spark: SparkSession, path: str) -> DataFrame:
    """The append-only operation log of keyword preferences."""
    if not exists(spark, path):
        return spark.createDataFrame([], PREFERENCE_SCHEMA)
    return spark.read.schema(PREFERENCE_SCHEMA).parquet(path)


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All term snapshots; a run that cannot be read in full is left out as a whole."""
    return _snapshot_rows(spark, path).drop("run_rows").join(F.broadcast(damaged_snapshots(spark, path)), "run_ts", "left_anti")


def damaged_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Runs of which not all could be read: run_ts, rows found and rows written.

    How many rows a run has is in its commit record, apart from the file that it counts; where there is none, in the rows.
    """
    from oppflow.sources.commits import Commits

    found = _snapshot_rows(spark, path).groupBy("run_ts").agg(F.count("*").alias("found"), F.max("run_rows").alias("own"))
    known = Commits(spark, path).read().select(F.col("at").alias("run_ts"), "rows")
    both = found.join(known, "run_ts", "full").select(
        "run_ts", F.coalesce("found", F.lit(0)).cast("long").alias("found"), F.coalesce("rows", "own").alias("run_rows"))
    return both.filter("run_rows is not null and found <> run_rows")


def _snapshot_rows(spark: SparkSession, path: str) -> DataFrame:
    schema = SNAPSHOT_SCHEMA + ", run_rows bigint"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(path)


def append_snapshot(snapshot: DataFrame, path: str) -> None:
    """Add a run; a commit record, and every row, says how many rows it has."""
    from oppflow.sources.commits import Commits

    counted = snapshot.withColumn("run_rows", F.count("*").over(Window.partitionBy("run_ts")))
    counted.coalesce(1).write.mode("append").parquet(path)
    runs = snapshot.groupBy(F.col("run_ts").cast("string").alias("at")).agg(F.count("*").alias("n"))
    for run in runs.collect():  # one
        Commits(snapshot.sparkSession, path).write(run.at, at=run.at, rows=run.n)


def write_sections(sections: dict[str, DataFrame], path: str) -> None:
    """One JSON folder per dashboard or report section."""
    for name, df in sections.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def sortable(df: DataFrame, column: str):
    """A column as a text that sorts as the column does: whole numbers shifted above 0 and padded, texts as they are."""
    kind = df.schema[column].dataType.simpleString()
    value = F.col(column)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.lpad((value.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return value.cast("string")


def placed(df: DataFrame) -> DataFrame:
    """``payload_ord`` as text and ``item_ord`` as number, from the order columns that a source has."""
    names = [c for c in ("payload_ord", "page_id", "page_ord") if c in df.columns]
    payload = F.concat_ws("/", *[F.coalesce(sortable(df, c), F.lit("")) for c in names])
    item = F.col("item_ord").cast("bigint") if "item_ord" in df.columns else F.lit(0).cast("bigint")
    return df.withColumns({"payload_ord": payload, "item_ord": item})


def union_sources(sources: list) -> tuple[DataFrame | None, list[str]]:
    """All sources one after the other, each row with its place: ``source_ord``, ``payload_ord``, ``item_ord``.

    The three are a total order over all sources, whatever each orders its payloads by: ``payload_ord`` becomes a text that sorts
    as the source's own order columns do.

    ``sources`` holds ``(name, build)`` with ``build() -> DataFrame``.  A source that
    cannot be analysed is left out and reported; the others go on.
    """
    from pyspark.errors import AnalysisException

    union, failed = None, []
    for number, (name, build) in enumerate(sources):
        try:
            df = build()
            df.schema
        except AnalysisException as error:
            failed.append(f"{name}: {error.getCondition() or error}")
            continue
        df = placed(df).withColumn("source_ord", F.lit(number))
        union = df if union is None else union.unionByName(df, allowMissingColumns=True)
    return union, failed
