"""Mixing sources to target weights: budgets down a domain - language - source tree, then token prefixes.

The token budget is divided among siblings by their weights.  No node gets more than its documents
give in ``max_epochs`` passes; what one cannot use goes to its siblings in proportion to their
weights, and only what the whole group cannot use is left to the level above, because a group's
own limit is the sum of its leaves'.  (Water filling, by cumulative sums over the siblings.)

A leaf's tokens are read in epochs; each epoch is the leaf's documents in a seeded order of its own.
The leaf takes the prefix of that sequence up to its budget: full epochs take every document, the
last one those that start before the budget is used up.  The prefix sum runs over ``bins`` of the order and
then inside the one bin where it ends, so that the largest leaf is spread over many tasks.

Null domains, languages and sources are nodes named ``unknown``; unnamed weights are 1, negative ones
0.  Documents without tokens are taken with their epoch at no cost.  Ties in the order are broken by
text and then doc_id.  Repeated rows are different documents to the budget.  Empty input gives an empty result.
"""
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oppflow.llm.shared import free_names, word_count
from oppflow.session import cut

LEVELS = ("domain", "language", "source")


@dataclass(frozen=True)
class Mix:
    """``share`` of all tokens is the budget; weights by level and node name."""
    share: float = 0.8
    max_epochs: int = 2
    seed: int = 17
    bins: int = 4096
    domains: int = 4
    weights: dict[str, dict[str, float]] = field(default_factory=lambda: {
        "domain": {"d0": 2.0, "d1": 1.5}, "language": {"en": 4.0, "de": 2.0, "fr": 2.0}, "source": {"src0": 1.0}})


def domain(source: Column, n: int) -> Column:
    """Sources fall into ``n`` domains by the number at the end of their name."""
    number = F.regexp_extract(source, r"(\d{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("d"), (number.cast("long") % n).cast("string")))


def weight(level: str, mix: Mix) -> Column:
    out = F.lit(1.0)
    for name, value in mix.weights.get(level, {}).items():
        out = F.when(F.col(level) == name, float(max(0.0, value))).otherwise(out)
    return out


def fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``budget`` of each of the siblings (``parent_budget``, ``w``, ``cap``, ``name``): weighted shares, none above its cap.

    Siblings in order of cap per weight: the first ones are full; from the first that its share
    does not fill, all get the same amount per weight.
    """
    group = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    order = group.orderBy(F.col("ratio"), F.col(name))
    rows = nodes.withColumn("ratio", F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(F.lit(float("inf"))))
    rows = rows.withColumn("use", F.when(F.col("w") > 0, F.col("cap")).otherwise(0.0))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("left", F.col("parent_budget") - F.coalesce(F.sum("use").over(before), F.lit(0.0)))
    rows = rows.withColumn("w_left", F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)))
    rows = rows.withColumn("level", F.when(F.col("w_left") > 0, F.greatest(F.col("left"), F.lit(0.0)) / F.col("w_left")))
    # per weight, what the first sibling that is not full gets (levels fall from there); all after it get as much
    rows = rows.withColumn("line", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(group))
    share = F.least("cap", F.coalesce(F.col("w") * F.col("line"), F.col("cap")))
    return rows.withColumn("budget", F.when(F.col("w") > 0, share).otherwise(0.0)).drop("ratio", "use", "left", "w_left", "level", "line", "parent_budget")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``budget`` of every leaf of (domain, language, source, tokens); they add up to the target or to all that leaves can give."""
    # a leaf that its own weight or one above it rules out gives nothing, so no ancestor may count on it
    usable = F.lit(True)
    for level in LEVELS:
        usable = usable & (weight(level, mix) > 0)
    leaves = leaves.withColumn("cap", F.when(usable, F.col("tokens") * mix.max_epochs).otherwise(0).cast("double"))
    top = leaves.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("all"))
    top = top.withColumn("w", weight("domain", mix)).withColumn("parent_budget", F.sum("all").over(W.partitionBy(F.lit(0))) * mix.share)
    top = fill(top, [], "domain").select("domain", F.col("budget").alias("parent_budget"))
    middle = leaves.groupBy("domain", "language").agg(F.sum("cap").alias("cap")).join(top, "domain").withColumn("w", weight("language", mix))
    middle = fill(middle, ["domain"], "language").select("domain", "language", F.col("budget").alias("parent_budget"))
    low = leaves.join(middle, ["domain", "language"]).withColumn("w", weight("source", mix))
    return fill(low, ["domain", "language"], "source").select(*LEVELS, "tokens", "budget")


def with_plan(docs: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """Two tables: documents as (leaf, key, tokens, o, bin) and the leaves' budgets with the last epoch's border."""
    key = F.xxhash64("doc_id", "text")
    rows = docs.select(
        F.coalesce(domain(F.col("source"), mix.domains), F.lit("unknown")).alias("domain"), F.coalesce("lang", F.lit("unknown")).alias("language"),
        F.coalesce("source", F.lit("unknown")).alias("source"), "doc_id", key.alias("key"), word_count(F.col("text")).alias("tokens"))
    rows = cut(rows)
    leaves = cut(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")))
    plan = budgets(leaves, mix)
    full = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens") + 1e-9)).otherwise(F.lit(1)).cast("long")
    plan = plan.withColumn("full", full)
    plan = cut(plan.withColumn("rest", F.when(F.col("tokens") > 0, F.greatest(F.col("budget") - F.col("full") * F.col("tokens"), F.lit(0.0))).otherwise(0.0)))
    return rows, plan


def copies(docs: DataFrame, mix: Mix) -> DataFrame:
    """(doc_id, key, domain, language, source, tokens, copies) of every document; copies may be 0."""
    rows, plan = with_plan(docs, mix)
    ranked = rows.join(plan.select(*LEVELS, "full", "rest"), list(LEVELS))
    # the order of the epoch after the full ones: a seeded hash, cut into bins
    o = F.pmod(F.xxhash64(F.lit(mix.seed), F.col("full"), F.col("doc_id"), F.col("key")), F.lit(2**40))
    ranked = ranked.withColumn("o", o).withColumn("bin", F.floor(F.col("o") * mix.bins / 2**40).cast("int"))
    open_ = ranked.where("rest > 0")
    sums = open_.groupBy(*LEVELS, "rest", "bin").agg(F.sum("tokens").alias("t"))
    before = W.partitionBy(*LEVELS).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("t").over(before), F.lit(0)))
    # the bin in which the prefix ends; bins before it are taken whole
    border = cut(starts.where("start < rest").groupBy(*LEVELS).agg(F.max(F.struct("bin", "start")).alias("last")).select(
        *LEVELS, F.col("last.bin").alias("border"), F.col("last.start").alias("border_start")))
    placed = ranked.join(border, list(LEVELS), "left")
    inside = placed.where("bin = border and rest > 0")
    here = W.partitionBy(*LEVELS).orderBy("o", "key", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    inside = inside.withColumn("at", F.col("border_start") + F.coalesce(F.sum("tokens").over(here), F.lit(0)))
    chosen = inside.select("doc_id", "key", *LEVELS, "tokens", (F.col("full") + (F.col("at") < F.col("rest")).cast("long")).alias("copies"))
    others = placed.where("border is null or rest = 0 or bin <> border").select(
        "doc_id", "key", *LEVELS, "tokens", (F.col("full") + F.coalesce((F.col("rest") > 0) & (F.col("bin") < F.col("border")), F.lit(False)).cast("long")).alias("copies"))
    return chosen.unionByName(others)


def mixed(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """One row per chosen document: doc_id, domain, language, source, tokens, copies (epochs that take it)."""
    return copies(docs, mix or Mix()).where("copies > 0").drop("key")


def apply_mix(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """The documents with all their columns, each as often as epochs take it."""
    name, key, number, own, epoch = free_names(docs, "mix_id", "mix_key", "mix_copies", "mix_own", "mix_epoch")
    taken = copies(docs, mix or Mix()).where("copies > 0").groupBy(F.col("doc_id").alias(name), F.col("key").alias(key)).agg(F.max("copies").alias(number))
    tagged = docs.withColumn(own, F.xxhash64("doc_id", "text"))
    joined = tagged.join(taken, (F.col(own) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(name)))
    return joined.withColumn(epoch, F.explode(F.sequence(F.lit(1), F.col(number)))).select(*docs.columns)
