"""Session settings the jobs are written for."""
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}


def local_session(cores: int | str = 8, app: str = "oppflow", **settings: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    chosen = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **settings,
    }
    for key, value in chosen.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for cut lineage: the cluster's, or a local one where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    folder = os.path.join(tempfile.gettempdir(), f"oppflow-{spark.sparkContext.applicationId}")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    What was written survives a lost executor and is read column by column.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_in_tasks(df: DataFrame, tasks: int) -> DataFrame:
    """``cut`` with that many tasks after each shuffle, whatever number the session has.

    For sums over keys that grow with the input: partial sums are formed before the shuffle, which ``repartition`` would
    not do, and the keys that a task holds after it stay few.  The session's settings are as before afterwards.
    """
    conf = df.sparkSession.conf
    own = {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: conf.get(name) for name in own}
    try:
        for name, value in own.items():
            conf.set(name, value)
        return cut(df)
    finally:
        for name, value in before.items():
            conf.set(name, value)


def spread(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """One task per core at least, and where ``rows`` is given, tasks of about that many rows at most.

    A row group is in one task, whatever number of splits its file has, so the rows of each task are counted (of a
    Parquet file, its footer is read).  Input whose tasks are many, alike and small enough is left where it is.
    Without keys, rows are dealt by their place.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    held = [r.n for r in df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    tasks = max(cores, -(-sum(held) // rows)) if rows else cores
    if len(held) >= cores and max(held) <= 2 * (rows or sum(held) / cores):
        return df
    if keys:
        return df.repartition(tasks, *keys)
    return df.withColumn("_place", F.monotonically_increasing_id()).repartition(tasks, "_place").drop("_place")


def small_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``spread`` for rows that memory or time grows with; few tasks are left as they are where they are small."""
    return df if df.limit(2 * rows + 1).count() <= 2 * rows else spread(df, rows=rows)
