"""Daily and personal digests as tables."""
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oppflow.fixed_values import DIGEST_ORDER, STATES
from oppflow.functions.text import match_text
from oppflow.operators.matching import phrase_hits, small
from oppflow.schema import or_empty
from oppflow.session import cut

DASH = "—"
UNLISTED = 1_000_000
GROUP = 256  # records, or members, of one group that a list holds
TASK_PAIRS = 4_000_000  # pairs of a member and a record that one task writes out


def state_labels(spark: SparkSession) -> DataFrame:
    """State, label and place in the digest for the 20 listed states."""
    names = {code: name for code, name, _ in STATES}
    rows = [(s, names.get(s, s), i) for i, s in enumerate(DIGEST_ORDER)]
    return spark.createDataFrame(rows, "state string, label string, ord int")


def on_day(rfps: DataFrame, day: str) -> DataFrame:
    """Matched records of one day; the filter prunes partitions of the store."""
    return rfps.filter((F.col("scrape_date") == F.lit(day)) & F.col("keyword_match"))


def past_week(rfps: DataFrame, day: str) -> DataFrame:
    """Matched records from seven days before ``day`` on: eight dates with ``day``."""
    since = F.date_format(F.date_sub(F.lit(day).cast("date"), 7), "yyyy-MM-dd")
    return rfps.filter((F.col("scrape_date") >= since) & F.col("keyword_match"))


def _labelled(df: DataFrame, labels: DataFrame) -> DataFrame:
    # 20 fixed rows
    return df.join(F.broadcast(labels), "state", "left").select(
        *df.columns,
        F.coalesce("label", "state").alias("label"),
        F.coalesce("ord", F.lit(UNLISTED)).alias("ord"),
    )


def state_counts(rfps: DataFrame, labels: DataFrame, *by: str) -> DataFrame:
    """Records per state with label and place; sort by ``ord, state``."""
    return _labelled(rfps.groupBy(*by, "state").agg(F.count("*").alias("n")), labels)


def counts_line(counts: DataFrame, *by: str) -> DataFrame:
    """``5 Federal, 3 Texas``: one entry per state, listed states first."""
    entry = F.struct("ord", "state", F.concat_ws(" ", F.col("n").cast("string"), "label").alias("text"))
    parts = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["text"])
    return counts.groupBy(*by).agg(
        F.sum("n").alias("n"), F.coalesce(F.nullif(F.array_join(parts, ", "), F.lit("")), F.lit("0")).alias("summary")
    )


def group_flags(rfps: DataFrame) -> DataFrame:
    """Per state: rows, and whether any row has a recipient or a name."""
    return rfps.groupBy("state").agg(
        F.count("*").alias("group_rows"),
        F.bool_or(or_empty("recipient") != "").alias("has_recipient"),
        F.bool_or(or_empty("pi_name") != "").alias("has_pi"),
    )


def digest_rows(rfps: DataFrame, labels: DataFrame, *keep: str) -> DataFrame:
    """The rows of the digest with section label, place and section flags.

    Section totals are one row per state.  They are written first, so their size is known where
    they are joined back: as small as they are, they go to the records, and no record is shuffled.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.nullif(or_empty(name), F.lit("")), F.lit(DASH)).alias(name)

    place = F.when(
        (or_empty("recipient") != "") & (or_empty("recipient_state") != ""),
        F.concat_ws(", ", "recipient", "recipient_state"),
    ).otherwise(F.coalesce(F.nullif(or_empty("recipient"), F.lit("")), F.lit(DASH)))
    flagged = _labelled(rfps.join(cut(group_flags(rfps)), "state"), labels)
    return flagged.select(
        *keep, "ord", "state", "label", "group_rows", "has_recipient", "has_pi",
        shown("rfp_id"), shown("title"), shown("agency"),
        F.when(F.col("has_recipient"), place).alias("recipient_shown"),
        F.when(F.col("has_pi"), F.coalesce(F.nullif(or_empty("pi_name"), F.lit("")), F.lit(DASH))).alias("pi_shown"),
        shown("status"), shown("posted_date"), shown("close_date"), shown("url"),
    )


def plain_entry() -> Column:
    """A record as the lines of a plain-text digest."""
    def part(name: str, default: str = DASH) -> Column:
        return F.coalesce(F.col(name), F.lit(default))

    recipient = F.when(
        or_empty("recipient") != "",
        F.concat(
            F.lit("  Recipient: "), F.col("recipient"),
            F.when(or_empty("recipient_state") != "", F.concat(F.lit(" ("), F.col("recipient_state"), F.lit(")"))).otherwise(""),
            F.lit("\n"),
        ),
    ).otherwise("")
    name = F.when(or_empty("pi_name") != "", F.concat(F.lit("  PI: "), F.col("pi_name"), F.lit("\n"))).otherwise("")
    return F.concat(
        F.lit("["), F.col("state"), F.lit("] "), part("title", "Untitled"), F.lit("\n  ID: "), part("rfp_id"),
        F.lit("  |  Agency: "), part("agency"), F.lit("\n  Status: "), part("status"),
        F.lit("  |  Closes: "), part("close_date"), F.lit("\n"), recipient, name,
        F.lit("  "), or_empty("url"), F.lit("\n"),
    )


@dataclass
class Interests:
    """Which groups of records go to which groups of members.

    Records that hold the same patterns are one group, and so are members who look for the same patterns, as far as any
    record holds them.  Members share base patterns and records common words, so groups are few where pairs are many:
    a group's pairs are decided once, and only a result that lists every pair has a row for it.
    """
    records: DataFrame  # (key, held), one row per key
    members: DataFrame  # (email, wanted), one row per member
    pairs: DataFrame  # (held, wanted), distinct


def interests(rfps: DataFrame, key: str, patterns: DataFrame) -> Interests:
    """Search records for the patterns of all members.

    ``patterns(email, pattern)`` holds effective patterns.  Records are searched for the distinct patterns;
    a member without patterns, or without a record, is in no group.
    """
    lowered = cut(patterns.select("email", F.lower("pattern").alias("phrase")).filter("phrase <> ''").distinct())
    texts = rfps.select(key, F.lower(match_text()).alias("text"))
    hits = cut(phrase_hits(texts, key, "text", lowered.select("phrase").distinct()))
    met = hits.select("phrase").distinct()
    records = cut(_by_phrases(hits, key, "held"))
    members = cut(_by_phrases(lowered.join(small(met, "phrase"), "phrase", "left_semi"), "email", "wanted"))
    held, wanted = (
        cut(rows.select(name, "phrases").distinct()).select(name, F.explode("phrases").alias("phrase"))
        for rows, name in ((records, "held"), (members, "wanted"))
    )
    # many groups can share a phrase; the patterns of the members' groups are sent to the records' where they are small
    pairs = held.join(small(wanted, "phrase"), "phrase").select("held", "wanted").distinct()
    return Interests(records.drop("phrases"), members.drop("phrases"), cut(pairs))


def _by_phrases(rows: DataFrame, key: str, group: str) -> DataFrame:
    """``(key, phrases, group)``: all phrases of a key; keys with the same phrases are one group, named by their digest."""
    sets = rows.groupBy(key).agg(F.sort_array(F.collect_set("phrase")).alias("phrases"))
    return sets.withColumn(group, F.sha2(F.to_json("phrases"), 256))


def _blocks(rows: DataFrame, group: str, values: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``(group, <name>_part, name)``: the rows of a group in lists of about ``GROUP``; and the size of each group."""
    sizes = cut(rows.groupBy(group).agg(F.count("*").alias(f"{name}_n")))
    part = F.pmod(F.xxhash64(*values), F.ceil(F.col(f"{name}_n") / GROUP)).alias(f"{name}_part")
    each = rows.join(small(sizes, group), group).select(group, part, F.struct(*values).alias("row"))
    return each.groupBy(group, f"{name}_part").agg(F.collect_list("row").alias(name)), sizes


def personal_rows(found: Interests, records: DataFrame, *keep: str) -> DataFrame:
    """``(email, *keep)``: the rows of each member, from records with their group ``held``.

    Lists of records meet lists of members, and these pairs of lists are dealt by the number of rows that they stand for;
    a list of pairs is written out where it is, so the pairs themselves are not shuffled.
    """
    theirs, held = _blocks(records, "held", list(keep), "theirs")
    whose, wanted = _blocks(found.members, "wanted", ["email"], "whose")
    counted = found.pairs.join(held, "held").join(wanted, "wanted")
    n = counted.agg(F.sum(F.col("theirs_n") * F.col("whose_n"))).first()[0] or 0
    tasks = max(records.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_PAIRS))
    met = found.pairs.join(theirs, "held").join(whose, "wanted")
    met = met.repartition(tasks, "held", "theirs_part", "wanted", "whose_part")
    each = met.select(F.col("whose.email").alias("emails"), F.inline("theirs"))
    return each.select(F.explode("emails").alias("email"), *keep)


def personal_hits(rfps: DataFrame, key: str, patterns: DataFrame) -> DataFrame:
    """Pairs ``(email, key)``: members and the records one of their patterns occurs in; distinct."""
    found = interests(rfps, key, patterns)
    return personal_rows(found, found.records, key)


def personal_digest(rfps: DataFrame, key: str, patterns: DataFrame, *keep: str) -> DataFrame:
    """``(email, key, *keep)``: the same with columns of the records; every record of a key that is there twice."""
    found = interests(rfps, key, patterns)
    return personal_rows(found, rfps.select(key, *keep).join(found.records, key), key, *keep)


def first_name(name: Column) -> Column:
    return F.get(F.split(F.trim(name), r"\s+"), 0)


def subject(kind: str, n: Column, day: str, name: Column | None = None) -> Column:
    """Subject line of the daily or the personal digest."""
    shown = F.date_format(F.lit(day).cast("date"), "MMMM dd, yyyy")
    if kind == "daily":
        return F.concat(F.lit("RFP Alert: "), n.cast("string"), F.lit(f" New Matches {DASH} "), shown)
    parts = [F.lit("Weekly RFP Digest: "), n.cast("string"), F.lit(" Matches for "), first_name(name), F.lit(f" {DASH} "), shown]
    return reduce(lambda a, b: F.concat(a, b), parts)


def personal_headers(found: Interests, rfps: DataFrame, key: str, members: DataFrame, labels: DataFrame, day: str) -> DataFrame:
    """One header per member with matches: first name, count, counts line, subject.  Records are counted by group."""
    states = rfps.select(key, "state").join(found.records, key).groupBy("held", "state").agg(F.count("*").alias("n"))
    counts = found.pairs.join(states, "held").groupBy("wanted", "state").agg(F.sum("n").alias("n"))
    lines = cut(counts_line(_labelled(counts, labels), "wanted"))
    own = found.members.join(small(lines, "summary"), "wanted")
    return own.join(small(members.select("email", "name"), "email"), "email").select(
        "email", first_name(F.col("name")).alias("first_name"), "n", "summary",
        subject("weekly", F.col("n"), day, F.col("name")).alias("subject"),
    )
