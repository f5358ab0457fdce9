"""Keyword preferences: an append-only log of form responses, folded per member."""
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oppflow.functions.scalars import parse_list
from oppflow.functions.text import strip
from oppflow.operators.matching import small

FORM_COLUMNS = ["timestamp", "email", "answer_1", "answer_2", "add", "remove", "other"]
FORM_SCHEMA = ", ".join(f"`{c}` string" for c in FORM_COLUMNS)
# --- fixed values: timestamp layouts of the form export -------------------
TIMESTAMP_FORMATS = ["M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss"]


def read_responses(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The form export; rows with fewer than six fields are dropped.

    A blank field, quoted or not, is an empty text.  A row without exactly the seven fields is
    kept raw by the reader; its fields are counted outside of quotes.
    """
    raw = spark.read.csv(
        path, schema=f"{FORM_SCHEMA}, _raw string", header=header, multiLine=True, escape='"', emptyValue="",
        mode="PERMISSIVE", enforceSchema=True, columnNameOfCorruptRecord="_raw",
    )
    commas = F.regexp_count(F.regexp_replace("_raw", r'"(?:[^"]|"")*+"', ""), F.lit(","))
    filled = [F.coalesce(c, F.lit("")).alias(c) for c in FORM_COLUMNS]
    return raw.filter(F.col("_raw").isNull() | (commas >= 5)).select(*filled, F.monotonically_increasing_id().alias("seq"))


def response_time(text: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(strip(text), F.lit(f)) for f in TIMESTAMP_FORMATS])


def timed(responses: DataFrame) -> DataFrame:
    return responses.withColumn("ts", response_time(F.col("timestamp")))


def newer_than(responses: DataFrame, mark: Column) -> DataFrame:
    """Responses after the high-water mark; all of them where there is no mark yet."""
    return responses.withColumn("_mark", mark).filter(
        F.col("_mark").isNull() | (F.col("ts") > F.col("_mark"))
    ).drop("_mark")


def high_water_mark(responses: DataFrame) -> DataFrame:
    """Latest time of any well-formed response, also of unknown senders and empty ones."""
    return responses.agg(F.max("ts").alias("mark"))


def resolve_email(responses: DataFrame, members: DataFrame, aliases: DataFrame) -> DataFrame:
    """Add ``member``: the member with that address, else the one it is an alias of."""
    known = members.select(F.lower(strip("email")).alias("member_email")).distinct()
    via = aliases.select(
        F.lower(strip("login_email")).alias("login"), F.lower(strip("email")).alias("alias_of")
    ).join(known, F.col("alias_of") == F.col("member_email"), "left_semi")
    via = via.groupBy("login").agg(F.min("alias_of").alias("alias_of"))  # one row per login, or responses would double
    sent = responses.withColumn("sender", F.lower(strip("email")))
    # one sender may write most of the responses, so the member side travels where it is small
    return (
        sent.join(small(known, "member_email"), F.col("sender") == F.col("member_email"), "left")
        .join(small(via, "login"), F.col("sender") == F.col("login"), "left")
        .withColumn("member", F.coalesce("member_email", "alias_of"))
        .drop("member_email", "login", "alias_of", "sender")
    )


def rejected(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("member").isNull())


def change_history(resolved: DataFrame) -> DataFrame:
    """One row per response that changes something: what was added and removed."""
    parsed = resolved.filter(F.col("member").isNotNull()).select(
        F.col("member").alias("email"), "ts", "seq",
        parse_list(F.col("add")).alias("added"), parse_list(F.col("remove")).alias("removed"),
        strip("add").alias("raw_add"), strip("remove").alias("raw_remove"),
    )
    return parsed.filter((F.size("added") > 0) | (F.size("removed") > 0))


def operations(history: DataFrame) -> DataFrame:
    """``(email, kw, op, ts, seq)``: one row per keyword added or removed."""
    def side(column: str, op: str) -> DataFrame:
        return history.select("email", F.explode(column).alias("kw"), F.lit(op).alias("op"), "ts", "seq")

    return side("added", "add").unionByName(side("removed", "remove"))


def fold(ops: DataFrame) -> DataFrame:
    """The last operation of every member and keyword; within a response removal wins.

    The last is by time, where operations carry one, and then by ``seq``, which only orders the rows
    of one file.  Only the last row per key and task is shuffled, so one busy member does not
    weigh on one task.  Folded state keeps the time and is fed back in as it is.
    """
    time = ["ts"] if "ts" in ops.columns else []
    last = F.row_number().over(
        Window.partitionBy("email", "kw").orderBy(*[F.desc_nulls_last(c) for c in time], F.desc("seq"), F.desc("op"))
    )
    return ops.withColumn("_last", last).filter("_last = 1").select("email", "kw", "op", *time, "seq")


def effective_patterns(members: DataFrame, folded: DataFrame) -> DataFrame:
    """``(email, pattern)``: base patterns plus additions minus removals.

    A member without any operation keeps the base list as written; with operations
    the base is lower-cased first.  Rows, not arrays: lists of any length stay spread.
    """
    base = members.select(F.lower(strip("email")).alias("email"), F.explode("patterns").alias("pattern"))
    changed = folded.select("email").distinct().withColumn("changed", F.lit(True))
    flagged = base.join(changed, "email", "left").select(
        "email",
        F.when(F.col("changed"), F.lower("pattern")).otherwise(F.col("pattern")).alias("pattern"),
    )
    adds = folded.filter("op = 'add'").select("email", F.col("kw").alias("pattern"))
    known = members.select(F.lower(strip("email")).alias("email")).distinct()
    removals = folded.filter("op = 'remove'").select("email", F.col("kw").alias("pattern"))
    merged = flagged.unionByName(adds.join(known, "email", "left_semi")).distinct()
    return merged.join(removals, ["email", "pattern"], "left_anti")


def merge_lists(base: Column, additions: Column, removals: Column) -> Column:
    """The same rule on the short arrays of one member, sorted."""
    lowered = F.transform(base, lambda p: F.lower(p))
    return F.array_sort(F.array_except(F.array_union(lowered, additions), removals))
