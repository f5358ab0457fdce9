"""How far sources of a language diverge in their words: sparse merges of sorted count arrays per pair of groups.

1. One pass over the texts counts terms per (language, source) in the task; partial counts are added up by a shuffle on
   the term.  A language keeps the terms of enough of its documents; kept terms are numbered in sorted order.
2. A group's counts become sorted (term id, count) arrays, one per chunk of ids, so no array grows with the vocabulary.
3. The groups of a language are dealt into blocks, and a task prices the unordered pairs of two blocks in one chunk:
   galloping finds the common ids of the two arrays, and overlaps, terms of one side and absent terms are priced with
   the two groups' weights.  The price is the same both ways; chunks are added up.
4. Terms that a group uses more than its language are priced against the language's weight, and the first ones stay.

A weight is ``1 + floor(scale * (count + smoothing) / (N + smoothing * V))`` and a price ``floor((p - q) ** 2 / (p + q))``;
both are whole numbers, so results do not depend on partitioning.  Counts may reach 2.8e14.

Null text, language and source count as ''.  A group without terms still takes part.  Rows with the same doc_id count
each.  Very long texts are read whole; only one text and ``held`` counted bytes or entries are in memory.  Ties are ordered by item.
Other columns are ignored.  An empty table gives an empty result.
"""
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oppflow.session import cut

# A-Z become a-z, a-z and every byte of a non-ASCII character stay, all else separates
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
SCALE = 10**9
_FIRST = 32_000  # SCALE in two factors, so that products stay within 63 bits


@dataclass(frozen=True)
class Audit:
    """``chunk_bits``: ids of a chunk; ``block``: groups of a block; ``held`` and ``entries`` bound what a task counts before it gives it on."""
    least_documents: int = 10
    top_terms: int = 10
    smoothing: int = 2
    chunk_bits: int = 14
    block: int = 16
    held: int = 64 * 2**20
    entries: int = 400_000


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split()


def term_counts(docs: DataFrame, p: Audit) -> DataFrame:
    """(lang, source, term, n, d): occurrences and documents; the row with a null term says that the group occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences, documents, size, rows = defaultdict(Counter), defaultdict(Counter), 0, Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            for group, found in occurrences.items():
                held, names = documents[group], list(found)
                for at in range(0, len(names), 20_000):
                    part = names[at: at + 20_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([group[0]] * len(part), pa.string()), pa.array([group[1]] * len(part), pa.string()),
                        pa.array([t.decode("utf-8", "surrogatepass") for t in part], pa.string()),
                        pa.array([found[t] for t in part], pa.int64()), pa.array([held[t] for t in part], pa.int64()),
                    ], names=["lang", "source", "term", "n", "d"])
            occurrences.clear()
            documents.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                group = lang, source
                rows[group] += 1
                terms = terms_of(text)
                occurrences[group].update(terms)
                documents[group].update(set(terms))
                size += len(text)
                if size > p.held:
                    yield from flush()
                    size = 0
            if sum(map(len, occurrences.values())) > p.entries:
                yield from flush()
                size = 0
            if len(rows) > p.entries:
                yield seen(rows)
                rows.clear()
        yield from flush()
        if rows:
            yield seen(rows)

    def seen(rows: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([g[0] for g in rows], pa.string()), pa.array([g[1] for g in rows], pa.string()), pa.nulls(len(rows), pa.string()),
            pa.array([0] * len(rows), pa.int64()), pa.array(rows.values(), pa.int64()),
        ], names=["lang", "source", "term", "n", "d"])

    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    partial = plain.mapInArrow(count, "lang string, source string, term string, n long, d long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


# ------------------------------------------------------------- prices
def weights(counts: np.ndarray, mass: int, p: Audit) -> np.ndarray:
    """``1 + floor(SCALE * (count + smoothing) / mass)``, SCALE multiplied in two steps."""
    high, rest = np.divmod((counts + p.smoothing) * _FIRST, mass)
    return 1 + high * (SCALE // _FIRST) + rest * (SCALE // _FIRST) // mass


def price(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a - b) ** 2 // (a + b)


STEP = 256


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in both sorted arrays of their common values.

    A few values of the shorter array at a time, the bracket in the longer one is doubled until it holds them and then searched.
    """
    if len(short) > len(long):
        right, left = gallop(long, short)
        return left, right
    left, right, low = [], [], 0
    for at in range(0, len(short), STEP):
        wanted = short[at: at + STEP]
        width = STEP
        while low + width < len(long) and long[low + width - 1] < wanted[-1]:
            width *= 2
        window = long[low: low + width]
        if not len(window):
            break
        place = np.searchsorted(window, wanted)
        hit = np.flatnonzero(window[np.minimum(place, len(window) - 1)] == wanted)
        left.append(hit + at)
        right.append(place[hit] + low)
        low += int(place[-1])
    if not left:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(left), np.concatenate(right)


@dataclass
class Side:
    """A group in one chunk: ids and weights of its terms, and the weight of a term it does not have."""
    source: str
    block: int
    ids: np.ndarray
    weight: np.ndarray
    absent: int


def pair_price(a: Side, b: Side, terms: int) -> int:
    """Summed prices over the ``terms`` ids of a chunk, of which the arrays hold some."""
    in_a, in_b = gallop(a.ids, b.ids)
    both = int(price(a.weight[in_a], b.weight[in_b]).sum())
    only_a = int(price(a.weight, np.int64(b.absent)).sum() - price(a.weight[in_a], np.int64(b.absent)).sum())
    only_b = int(price(b.weight, np.int64(a.absent)).sum() - price(b.weight[in_b], np.int64(a.absent)).sum())
    nowhere = terms - len(a.ids) - len(b.ids) + len(in_a)
    return both + only_a + only_b + nowhere * ((a.absent - b.absent) ** 2 // (a.absent + b.absent))


def pair_prices(cells: DataFrame, p: Audit) -> DataFrame:
    """(lang, a, b, value) of the unordered pairs a < b; a cell is a group in one chunk, replicated once per block of its language."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = cells.withColumn("other", other).select(
        "lang", "chunk", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "source", "mass", "terms", "ids", "counts")

    def task(frame: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for row in frame.itertuples(index=False):
            mass = int(row.mass)
            if mass:
                absent = int(weights(np.zeros(1, dtype=np.int64), mass, p)[0])
                weight = weights(np.asarray(row.counts, dtype=np.int64), mass, p)
            else:
                absent, weight = 1, np.zeros(0, dtype=np.int64)
            sides.append(Side(row.source, row.block, np.asarray(row.ids, dtype=np.int64), weight, absent))
        terms, within = int(frame["terms"].iat[0]), frame["i"].iat[0] == frame["j"].iat[0]
        out = []
        for k, x in enumerate(sides):
            for y in sides[:k]:
                if within or x.block != y.block:
                    a, b = sorted((x.source, y.source))
                    out.append((a, b, pair_price(x, y, terms)))
        out = pd.DataFrame(out, columns=["a", "b", "value"])
        out.insert(0, "lang", frame["lang"].iat[0])
        return out

    parts = dealt.groupBy("lang", "chunk", "i", "j").applyInPandas(task, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def sql_weight(count: str, mass: str, p: Audit) -> F.Column:
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * ({count} + {p.smoothing})) div {mass}")


def audit(docs: DataFrame, p: Audit | None = None) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows against every other source, ``term`` rows against the language."""
    p = p or Audit()
    counts = cut(term_counts(docs, p))
    groups = counts.where("term is null").select("lang", "source")
    found = counts.where("term is not null")
    kept = found.groupBy("lang", "term").agg(F.sum("d").alias("d"), F.sum("n").alias("total")).where(F.col("d") >= p.least_documents)
    # sorted first: a later id is a later term
    kept = cut(kept.drop("d").sort("lang", "term").withColumn("id", F.monotonically_increasing_id())
               .withColumn("chunk", F.shiftright("id", p.chunk_bits)))
    used = cut(found.join(kept, ["lang", "term"]).select("lang", "source", "term", "id", "chunk", "n", "total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    members = groups.groupBy("lang").agg(F.ceil(F.count("*") / p.block).alias("blocks"))
    masses = used.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    masses = groups.join(masses, ["lang", "source"], "left").join(langs, "lang", "left").join(members, "lang").select(
        "lang", "source", "blocks", F.pmod(F.xxhash64("source"), "blocks").alias("block"),
        (F.coalesce("own", F.lit(0)) + p.smoothing * F.coalesce("v", F.lit(0))).alias("mass"),
        (F.coalesce("lang_n", F.lit(0)) + p.smoothing * F.coalesce("v", F.lit(0))).alias("lang_mass"))
    masses = cut(masses)

    chunks = kept.groupBy("lang", "chunk").agg(F.count("*").alias("terms"))
    arrays = used.groupBy("lang", "source", "chunk").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("x"))
    none = F.array().cast("array<long>")
    cells = masses.join(chunks, "lang", "left").join(arrays, ["lang", "source", "chunk"], "left").select(
        "lang", "source", "blocks", "block", "mass", F.coalesce("chunk", F.lit(-1)).alias("chunk"), F.coalesce("terms", F.lit(0)).alias("terms"),
        F.coalesce("x.id", none).alias("ids"), F.coalesce("x.n", none).alias("counts"))
    pairs = cut(pair_prices(cells, p))
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))

    weighed = used.join(masses, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), sql_weight("n", "mass", p).alias("p"), sql_weight("total", "lang_mass", p).alias("q"))
    terms = weighed.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank")).unionByName(
        terms.withColumn("rank", rank).where(F.col("rank") <= p.top_terms).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
