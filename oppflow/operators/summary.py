"""Dashboard sections; each is one aggregation over the stored records."""
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oppflow.fixed_values import STATES
from oppflow.functions.scalars import parse_money
from oppflow.functions.text import strip
from oppflow.operators.ranking import ranked, top_per_group
from oppflow.session import cut

TOP_RECIPIENTS = 30
TOP_KEYWORDS = 20
NAMES_SHOWN = 3


def totals():
    """Rows with a known match flag, and how many of those match."""
    return [F.count("keyword_match").alias("total"), F.count_if("keyword_match").alias("matches")]


def populations(spark: SparkSession) -> DataFrame:
    """State -> population in millions, 50 rows."""
    return spark.createDataFrame(
        [(code, float(millions)) for code, _, millions in STATES], "state string, millions double"
    )


def counts_cube(rfps: DataFrame) -> DataFrame:
    """Counts per state, source and day; small enough to roll up again and again."""
    return rfps.groupBy("state", "source", "scrape_date").agg(
        F.count("*").alias("n"), *totals()
    )


def overview(rfps: DataFrame) -> DataFrame:
    """Counts first, distinct values after: the distincts run over the cube, not the rows."""
    return counts_cube(rfps).agg(
        F.sum("n").alias("total_rfps"),
        F.sum("matches").alias("keyword_matches"),
        F.countDistinct("state").alias("states_covered"),
        F.countDistinct("source").alias("sources_active"),
        F.max("scrape_date").alias("scrape_date"),
    )


def corpus_header(rfps: DataFrame) -> DataFrame:
    return overview(rfps).select(
        "total_rfps", F.col("states_covered").alias("states"), F.col("sources_active").alias("sources"),
        F.col("keyword_matches").alias("matched"),
        F.round(F.col("keyword_matches") / F.col("total_rfps") * 100, 1).alias("match_pct"),
    )


def state_breakdown(rfps: DataFrame, population: DataFrame) -> DataFrame:
    """Counts, match rate and records per million people; 0 where no population is known."""
    by_state = rfps.filter(F.col("state").isNotNull()).groupBy("state").agg(*totals())
    # the population table is one row per state of a fixed list
    return by_state.join(F.broadcast(population), "state", "left").select(
        "state", "total", "matches",
        F.bround(F.col("matches") / F.col("total") * 100, 1).alias("match_rate"),
        F.coalesce(F.bround(F.col("total") / F.col("millions"), 1), F.lit(0.0)).alias("per_capita"),
    )


def source_performance(rfps: DataFrame) -> DataFrame:
    return rfps.filter(F.col("source").isNotNull()).groupBy("source").agg(*totals())


def daily_counts(rfps: DataFrame) -> DataFrame:
    return rfps.filter(F.col("scrape_date").isNotNull()).groupBy("scrape_date").agg(
        F.count("keyword_match").alias("new_rfps"), F.count_if("keyword_match").alias("new_matches")
    )


def cumulative_counts(daily: DataFrame) -> DataFrame:
    """Running totals; the single-task window sees one row per day and nothing else."""
    to_date = Window.orderBy("scrape_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "scrape_date", "new_rfps", "new_matches",
        F.sum("new_rfps").over(to_date).alias("cumulative_rfps"),
        F.sum("new_matches").over(to_date).alias("cumulative_matches"),
    )


def top_recipients(awards: DataFrame, k: int = TOP_RECIPIENTS, pos: str = "pos") -> DataFrame:
    """Recipients by number of awards, with amount, first place by ``pos`` and the three smallest names.

    One pass over the awards adds them up per recipient and name (partial sums and minima, so a recipient with a third of
    all awards sends a row per name and task); everything else is a roll-up of that table, written once.
    """
    named = awards.filter(F.coalesce(F.col("recipient"), F.lit("")) != "")
    placed = F.col("recipient_state").isNotNull()
    each = cut(named.groupBy("recipient", F.coalesce("pi_name", F.lit("")).alias("pi_name")).agg(
        F.count("*").alias("n"), F.sum(parse_money(F.col("amount"))).alias("money"),
        F.min(F.when(placed, F.struct(F.col(pos).alias("pos"), F.col("recipient_state").alias("place")))).alias("first")))
    winners = each.groupBy("recipient").agg(
        F.sum("n").alias("count"), F.sum("money").alias("total"), F.min("first")["place"].alias("place"),
    ).orderBy(F.desc("count"), "recipient").limit(k)
    # the winners are ``k`` rows
    theirs = each.join(F.broadcast(winners.select("recipient")), "recipient", "left_semi").filter(strip("pi_name") != "")
    shown = (
        top_per_group(theirs, ["recipient"], [F.asc("pi_name")], NAMES_SHOWN)
        .groupBy("recipient")
        .agg(F.array_join(F.sort_array(F.collect_list("pi_name")), "; ").alias("pi_names"))
    )
    return winners.join(shown, "recipient", "left").select(
        F.left("recipient", F.lit(80)).alias("name"), "count",
        F.round("total", 2).alias("total_amount"),
        F.coalesce("place", F.lit("")).alias("location"),
        F.coalesce("pi_names", F.lit("")).alias("pi_names"),
    )


def keyword_counts(rfps: DataFrame) -> DataFrame:
    """How often each keyword was matched, from the stored comma-separated list."""
    each = rfps.filter("keyword_match").select(
        F.explode(F.split("matched_keywords", ",")).alias("keyword")
    )
    return each.select(strip("keyword").alias("keyword")).filter("keyword <> ''").groupBy("keyword").agg(
        F.count("*").alias("count")
    )


def keyword_frequency(rfps: DataFrame, k: int = TOP_KEYWORDS) -> DataFrame:
    return ranked(keyword_counts(rfps), [F.desc("count"), F.asc("keyword")], k)


def snapshot_slices(snapshot: DataFrame) -> DataFrame:
    """What the dashboard shows of the last run: 20 terms, 15 gaps, 15 phrases."""
    shown = F.when(F.col("kind") == "tfidf", 20).otherwise(15)
    return snapshot.filter(F.col("rank") <= shown).select(
        "kind", "rank", "term", F.round("score", 6).alias("score")
    )
