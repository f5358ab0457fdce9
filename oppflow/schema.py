"""The canonical record and the state tables kept between runs."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RFP_TEXT_COLUMNS = [
    "rfp_id", "hash", "source", "state", "title", "agency", "status",
    "posted_date", "close_date", "url", "description", "amount",
    "recipient", "recipient_state", "pi_name",
]
RFP_SCHEMA = (
    ", ".join(f"{c} string" for c in RFP_TEXT_COLUMNS)
    + ", keyword_match boolean, matched_keywords string, key_terms string"
    + ", scrape_date string, scrape_timestamp timestamp"
)
RFP_COLUMNS = RFP_TEXT_COLUMNS + [
    "keyword_match", "matched_keywords", "key_terms", "scrape_date", "scrape_timestamp",
]

# what a source normaliser returns; awards also fill the last three
RAW_COLUMNS = [
    "state", "source", "id", "title", "agency", "status", "posted_date",
    "close_date", "url", "description", "amount", "recipient",
    "recipient_state", "pi_name",
]

SEEN_SCHEMA = "hash string, first_seen timestamp, title string, state string"
SNAPSHOT_SCHEMA = "run_ts timestamp, kind string, rank int, term string, score double"
PREFERENCE_SCHEMA = "email string, kw string, op string, ts timestamp, seq bigint"


def or_empty(column: Column | str) -> Column:
    """Null becomes the empty string; everything is text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def raw_record(df: DataFrame, keep: list[str] = (), **fields: Column) -> DataFrame:
    """Project ``fields`` on the raw-record columns; absent ones are empty."""
    return df.select(
        *keep,
        *[or_empty(fields.get(c, F.lit(""))).alias(c) for c in RAW_COLUMNS],
    )


def canonical(df: DataFrame, scrape_timestamp: Column) -> DataFrame:
    """Tagged raw records -> the 20 stored columns.

    Expects ``hash``, ``keyword_match``, ``matched_kw`` and ``key_terms_arr``
    beside the raw-record columns.
    """
    named = df.withColumn("rfp_id", F.col("id")) if "rfp_id" not in df.columns else df
    present = set(named.columns)
    return named.select(
        *[
            (or_empty(c) if c in present else F.lit("")).alias(c)
            for c in RFP_TEXT_COLUMNS
        ],
        F.coalesce("keyword_match", F.lit(False)).alias("keyword_match"),
        F.array_join("matched_kw", ", ").alias("matched_keywords"),
        F.array_join("key_terms_arr", ", ").alias("key_terms"),
        F.date_format(scrape_timestamp, "yyyy-MM-dd").alias("scrape_date"),
        scrape_timestamp.alias("scrape_timestamp"),
    )
