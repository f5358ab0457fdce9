"""Host-level quality rules, in DataFrame functions only.

Every document is measured and judged by base rules.  Failures are summed per host (partial sums,
so a host with a third of all documents costs no more than another), each rule's failure rate is
shrunk towards the rate of all hosts by a beta prior fitted to the hosts by moments, and a host whose
shrunk rate exceeds the rule's limit is rejected.  The verdict is joined back to its documents.

Words are runs of anything but space and the control characters 9 to 13.  Null or empty texts have
no words and fail the base.  Documents without a host are judged by the base alone.  Repeated rows
count each; other columns are ignored.  An empty table gives an empty result.
"""
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oppflow.llm.shared import SPACE
from oppflow.session import cut

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class HostLimits:
    """Largest shrunk failure rate a host may have, by rule."""
    limits: dict[str, float] = field(default_factory=lambda: {"few_words": 0.7, "repeats": 0.5, "symbols": 0.5, "dup_lines": 0.5, "word_length": 0.5})


def failures() -> dict[str, Column]:
    """The rules over the measures; ``few_words`` and ``repeats`` are the base."""
    n = F.col("n_words")
    return {
        "few_words": n < 50,
        "repeats": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": (n > 0) & (10 * F.col("n_dup_lines") > n),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
    }


def repeat_words() -> Column:
    """Word positions inside 3-word windows that occur at least twice.

    ``sorted`` has the windows in order with their positions; equal windows are neighbours.  Each
    repeated window covers three positions less what the next one covers again.
    """
    z = F.col("sorted")
    again = F.transform(z, lambda x, i: F.when(
        ((i > 0) & (F.get(z, i - 1)["w"] == x["w"])) | F.coalesce(F.get(z, i + 1)["w"] == x["w"], F.lit(False)), x["i"]))
    return F.sort_array(F.filter(again, lambda x: x.isNotNull()))


def covered(at: Column) -> Column:
    steps = F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda acc, x: F.struct(
        (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last")))
    return F.coalesce(steps["n"], F.lit(0)).cast("long")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(k, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every row."""
    base = docs.select(F.col(key).alias("k"), F.col(host).cast("string").alias("host"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    words = F.filter(F.split("t", SPACE + "+"), lambda x: x != "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = base.select(
        "k", "host", words.alias("words"), F.length(F.regexp_replace("t", SPACE + "+", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), lines.alias("lines"))
    base = base.select(
        "k", "host", "word_chars", "n_symbols", F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") > 3, F.arrays_zip(
            F.col("words").alias("a"), F.slice("words", F.lit(2), F.size("words")).alias("b"), F.slice("words", F.lit(3), F.size("words")).alias("c"))).alias("z"))
    windows = F.transform(F.slice("z", F.lit(1), F.size("z") - 2), lambda x, i: F.struct(
        F.concat_ws(" ", x["a"], x["b"], x["c"]).alias("w"), i.alias("i")))
    base = base.withColumn("windows", windows).drop("z")
    # most texts repeat no window and need no sort
    unique = F.size(F.array_distinct(F.transform("windows", lambda x: x["w"]))) == F.size("windows")
    base = base.withColumn("sorted", F.when(F.col("windows").isNull() | unique, None).otherwise(F.sort_array("windows"))).drop("windows")
    base = base.withColumn("again", repeat_words())
    return base.select("k", "host", *[c for c in MEASURES[:4]], covered(F.col("again")).alias("n_repeat_words"))


def shrunk_rates(hosts: DataFrame, rules: list[str]) -> DataFrame:
    """Per host: ``rate_<rule>`` = (failures + a) / (documents + a + b), with a and b fitted to the hosts by moments.

    ``hosts`` has ``n`` and the failures per rule.  Where the hosts vary no more than chance allows,
    the prior is as strong as ``MAX_STRENGTH`` documents.
    """
    rate = {r: F.col(r) / F.col("n") for r in rules}
    moments = hosts.agg(
        F.avg(1 / F.col("n")).alias("inverse"),
        *[F.avg(rate[r]).alias(f"m_{r}") for r in rules], *[F.var_pop(rate[r]).alias(f"v_{r}") for r in rules]).first()
    out = hosts
    for r in rules:
        m, v = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        # variance between hosts = variance of the rates less what sampling adds
        between = max(v - m * (1 - m) * (moments["inverse"] or 0.0), 1e-9)
        strength = max(min(m * (1 - m) / between - 1, MAX_STRENGTH), MIN_STRENGTH)
        out = out.withColumn(f"rate_{r}", (F.col(r) + m * strength) / (F.col("n") + strength))
    return out.select("host", *[f"rate_{r}" for r in rules])


MIN_STRENGTH, MAX_STRENGTH = 2.0, 200.0


def judge(docs: DataFrame, limits: HostLimits | None = None, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: key, the measures, base_failed, kept."""
    limits = limits or HostLimits()
    rules = failures()
    rows = cut(measured(docs, key, text, host))  # measured once, read for the sums and for the verdicts
    hosts = rows.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(c.cast("long")).alias(r) for r, c in rules.items()])
    rates = shrunk_rates(cut(hosts), list(rules))
    bad = F.lit(False)
    for rule, limit in limits.limits.items():
        bad = bad | (F.col(f"rate_{rule}") > limit)
    verdicts = cut(rates.select("host", bad.alias("host_rejected")))
    base_failed = rules["few_words"] | rules["repeats"]
    return rows.join(verdicts, "host", "left").select(
        F.col("k").alias(key), *MEASURES, base_failed.alias("base_failed"),
        (~base_failed & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"), F.coalesce("host_rejected", F.lit(False)).alias("host_rejected"))
