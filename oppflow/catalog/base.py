"""Registry and the views that map the standard tables to records.

A view exists twice, as a DataFrame and as SQL text, written independently.
"""
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oppflow.fixed_values import STOP_WORDS
from oppflow.operators.tagging import tag
from oppflow.session import shared_dir, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# test dictionaries: phrases that occur in the synthetic text
KEYWORDS = ["ononst", "inoran", "inoran orantion", "rewh", "rewhan", "hehely", "that the", "der"]
EXCLUDED = ["worthless", "tionblees"]
MEMBERS = [
    ("Ada Park", "a@example.org", ["ononst", "rewh"]),
    ("Bo Lind", "b@example.org", ["hehely"]),
    ("Cy Moss", "c@example.org", ["zzzzzz"]),
]
AS_OF = "2024-01-20"


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its counterpart."""
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ records
def rfps(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as records."""
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("rfp_id"),
        F.col("lang").alias("state"), "source", F.col("source").alias("agency"),
        F.left(F.substring_index("text", "\n", 1), F.lit(120)).alias("title"),
        F.col("text").alias("description"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")), "yyyy-MM-dd").alias("scrape_date"),
        F.col("doc_id").alias("pos"),
    )
    return spread(docs, "pos")


RFPS = r"""v_rfp as (
  select cast(doc_id as varchar) as rfp_id, lang as state, source, source as agency,
         left(split_part(text, chr(10), 1), 120) as title, text as description,
         strftime(date '2024-01-01' + cast(doc_id % 30 as integer), '%Y-%m-%d') as scrape_date,
         doc_id as pos
  from documents)"""


def tagged(spark: SparkSession, folder: str) -> DataFrame:
    return tag(rfps(spark, folder), KEYWORDS, EXCLUDED)


_ANY_KEYWORD = "(?i)(?:" + "|".join(KEYWORDS) + ")"
_ANY_EXCLUDED = "(?i)(?:" + "|".join(EXCLUDED) + ")"
TAGGED = RFPS + rf""",
v_found as (
  select *, list_transform(regexp_extract_all(concat_ws(' ', title, description, agency), '{_ANY_KEYWORD}'),
                           lambda x: lower(x)) as hits,
         regexp_matches(concat_ws(' ', title, description, agency), '{_ANY_EXCLUDED}') as is_excluded
  from v_rfp),
v_tag as (
  select * exclude (hits, is_excluded),
         case when is_excluded then [] else list_filter(hits, lambda x, i: list_position(hits, x) = i) end as matched_kw,
         (not is_excluded) and len(hits) > 0 as keyword_match
  from v_found)"""


# ------------------------------------------------------------------- awards
def awards(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as awards; customers are recipients."""
    orders, customer, nation = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("pos"), F.col("c_name").alias("recipient"),
            F.col("n_name").alias("recipient_state"), F.col("n_name").alias("state"),
            F.col("c_mktsegment").alias("source"), F.col("o_orderpriority").alias("pi_name"),
            F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("amount"),
            (F.col("o_orderstatus") == "F").alias("keyword_match"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("scrape_date"),
        )
    )


AWARDS = r"""v_award as (
  select o_orderkey as pos, c_name as recipient, n_name as recipient_state, n_name as state,
         c_mktsegment as source, o_orderpriority as pi_name,
         '$' || format('{:,.2f}', o_totalprice) as amount, o_orderstatus = 'F' as keyword_match,
         strftime(o_orderdate, '%Y-%m-%d') as scrape_date, o_totalprice
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""


# ------------------------------------------------------------------- events
def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
        F.date_format("ts", "yyyy-MM-dd").alias("scrape_date"),
        (F.col("event_type") == "purchase").alias("keyword_match"),
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("hash"),
    )


EVENTS = r"""v_event as (
  select event_id, ts, user_id, event_type, strftime(ts, '%Y-%m-%d') as scrape_date,
         event_type = 'purchase' as keyword_match, user_id || '-' || event_type as hash
  from events)"""


# ----------------------------------------------------------- SQL text pieces
def sql_list(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


STOP_SQL = sql_list(STOP_WORDS)


def sql_strip(expr: str) -> str:
    return rf"regexp_replace({expr}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


_SAME = f"lower({sql_strip('description')}) = lower({sql_strip('title')})"
_SHORT = sql_strip("concat_ws(' ', title, '', agency)")
_LONG = sql_strip("concat_ws(' ', title, description, agency)")
COMBINED = f"case when {_SAME} then {_SHORT} else {_LONG} end"


def with_sql(*ctes: str, select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select
