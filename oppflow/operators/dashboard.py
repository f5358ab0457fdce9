"""What a reader asks of the dashboard: search, facets, pages, map and bars."""
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oppflow.fixed_values import PAGE_ROWS
from oppflow.functions.text import strip
from oppflow.schema import or_empty

MAP_BUCKETS = 9
_LISTED = [
    "url", "source", "posted_date", "close_date", "amount", "recipient", "recipient_state", "pi_name",
]


def full_database(rfps: DataFrame, *keep: str) -> DataFrame:
    """The listing of all records; sort it with ``newest_first``."""
    return rfps.select(
        *keep,
        F.left(or_empty("title"), F.lit(120)).alias("title"), or_empty("state").alias("state"),
        F.left(or_empty("agency"), F.lit(80)).alias("agency"),
        *[or_empty(c).alias(c) for c in _LISTED if c in rfps.columns],
        F.coalesce("keyword_match", F.lit(False)).alias("keyword_match"),
    )


def newest_first(rfps: DataFrame, when: str, tie: str) -> DataFrame:
    """The tie-break also lets the range sort split a day that holds many records."""
    return rfps.orderBy(F.desc(when), F.asc(tie))


def page(listing: DataFrame, order: list[Column], number: int, rows: int = PAGE_ROWS) -> DataFrame:
    """Page ``number`` (from 0) of a listing."""
    return listing.orderBy(*order).offset(number * rows).limit(rows)


def page_after(listing: DataFrame, order: list[tuple[str, bool]], last: dict | None = None, rows: int = PAGE_ROWS) -> DataFrame:
    """The ``rows`` that follow the row with the values ``last``; the first page without it.

    ``order`` holds (column, ascending), most significant first, together unique.  The first column's bound is a
    condition of its own, so that a scan leaves out the files before it; any page costs what the first one does.
    """
    if last is not None:
        follows = F.lit(False)
        for i, (name, ascending) in enumerate(order):
            later = F.col(name) > F.lit(last[name]) if ascending else F.col(name) < F.lit(last[name])
            for before, _ in order[:i]:
                later = later & (F.col(before) == F.lit(last[before]))
            follows = follows | later
        name, ascending = order[0]
        bound = F.col(name) >= F.lit(last[name]) if ascending else F.col(name) <= F.lit(last[name])
        listing = listing.filter(bound & follows)
    return listing.orderBy(*[F.asc(c) if up else F.desc(c) for c, up in order]).limit(rows)


def search(rfps: DataFrame, query: str = "", state: str = "", source: str = "", matches_only: bool = False) -> DataFrame:
    """Filters combine; the query is a case-insensitive literal over five fields."""
    if state:
        rfps = rfps.filter(F.col("state") == state)
    if source:
        rfps = rfps.filter(F.col("source") == source)
    if matches_only:
        rfps = rfps.filter("keyword_match")
    wanted = query.strip().lower()
    if wanted:
        hay = F.concat_ws(" ", *[or_empty(c) for c in ("title", "agency", "state", "source", "recipient") if c in rfps.columns])
        rfps = rfps.filter(F.contains(F.lower(hay), F.lit(wanted)))
    return rfps


def search_recipients(recipients: DataFrame, query: str) -> DataFrame:
    hay = F.concat_ws(" ", "name", "location", "pi_names")
    return recipients.filter(F.contains(F.lower(hay), F.lit(query.strip().lower())))


def facets(rfps: DataFrame, column: str) -> DataFrame:
    """Distinct non-empty values, sorted."""
    return rfps.filter(or_empty(column) != "").select(column).distinct().orderBy(column)


def map_buckets(states: DataFrame) -> DataFrame:
    """Colour bucket 0-8 of each state on a log scale; null where there is no value.

    ``states`` is the state breakdown: its bounds are scalars of the same small table.
    """
    valued = states.filter((F.col("state") != "Federal") & (F.col("per_capita") > 0))
    bounds = valued.agg(
        F.struct(F.log(F.min("per_capita")).alias("lo"), F.log(F.max("per_capita")).alias("hi"))
    ).scalar()
    span = F.when(F.col("b.hi") == F.col("b.lo"), F.lit(1.0)).otherwise(F.col("b.hi") - F.col("b.lo"))
    ratio = (F.log("per_capita") - F.col("b.lo")) / span
    bucket = F.least(F.floor(ratio * MAP_BUCKETS), F.lit(MAP_BUCKETS - 1)).cast("int")
    return (
        states.withColumn("b", bounds)
        .withColumn("bucket", F.when((F.col("per_capita") > 0) & (F.col("state") != "Federal"), bucket))
        .select("state", "per_capita", "total", "matches", "bucket")
    )


def share_of_max(df: DataFrame, value: str, alias: str = "pct") -> DataFrame:
    """Bar length in percent of the longest, one decimal; the maximum is a scalar."""
    longest = df.agg(F.max(value)).scalar()
    return df.withColumn(alias, F.round(F.col(value) / longest * 100, 1))
