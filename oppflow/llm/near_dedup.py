"""Near-duplicate groups: MinHash minima, banding, verification, connected components.

1. One pass over the texts makes a digest per document: size and fingerprint of its shingle set, one bucket key
   per band of ``rows`` universal hash minima, and a sketch.
2. Documents with the same set form a class, represented by its smallest id; later steps see only
   representatives, so any number of copies costs one row each.
3. A document meets the smallest ids of the buckets it is in, the ``heads`` that it shares most buckets with,
   never all members.  Pairs whose sketches cannot reach the threshold are dropped (four standard deviations
   of slack); the rest are confirmed on full sets, for which the texts of both are read again.
4. Confirmed links are joined into components by alternating large-star and small-star.
5. Buckets that still hold two components are worked off exactly: their members outside the bucket's
   largest component are held against every member of another component, by sketch, in blocks of bounded
   size; a pair counts in the first bucket it shares.  So no candidate link between different components
   stays unconfirmed, and components are those of all candidate pairs.

A pair at the threshold misses all bands with probability ``(1 - 0.8 ** rows) ** bands``, 2e-5 for
5 rows and 27 bands.

Documents without words or text have an empty set, link with nothing and stay.  Rows with the same
doc_id are one document; a null doc_id stays alone with a null component.  Other columns are ignored.
"""
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oppflow.llm.shared import free_names
from oppflow.session import cut

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 2**64)


@dataclass(frozen=True)
class MinHash:
    """``heads`` bounds the pairs of a document in the first round, not the links found; ``block`` the rows of a block."""
    words: int = 5
    bands: int = 27
    rows: int = 5
    percent: int = 80
    heads: int = 3
    slack: float = 0.055
    block: int = 512
    seed: int = 7

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit numbers, so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal(text: str) -> bytes:
    """Lower-case A-Z, words joined by one space."""
    return b" ".join(text.encode("utf-8", "surrogatepass").lower().split())


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of a normalised text.

    A shingle is a byte range of the text, so its hash is a difference of prefix sums.
    """

    def __init__(self, words: int):
        self.words = words
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def __call__(self, body: bytes) -> np.ndarray:
        if not body:
            return np.zeros(0, dtype=np.uint64)
        data = np.frombuffer(body, dtype=np.uint8)
        if len(data) + 1 > len(self.up) or len(self.up) > 2**21 > 2 * len(data):
            size = max(2**16, 2 ** (len(data) + 1).bit_length())
            self.up, self.down = powers(_BASE, size), powers(_INVERSE, size)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * self.up[: len(data)], out=sums[1:])
        gaps = np.flatnonzero(data == 0x20)
        starts = np.concatenate(([0], gaps + 1))
        ends = np.concatenate((gaps, [len(data)]))
        span = min(self.words, len(starts))
        starts, ends = starts[: len(starts) - span + 1], ends[span - 1:]
        return np.unique(mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)))


class Signer:
    """Minima of universal hash functions ``a * x + b mod 2**32`` over a set of 64-bit numbers."""

    def __init__(self, p: MinHash):
        rng = np.random.default_rng(p.seed)
        self.p = p
        self.a = (rng.integers(0, 2**31, p.hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 2**32, p.hashes, dtype=np.uint32)[:, None]

    def __call__(self, items: np.ndarray) -> np.ndarray:
        least = np.full(self.p.hashes, 2**32 - 1, dtype=np.uint32)
        short = (items >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(short), 512):
            np.minimum(least, (self.a * short[None, at: at + 512] + self.b).min(axis=1), out=least)
        return least.astype(np.uint64)

    def keys(self, least: np.ndarray) -> np.ndarray:
        """One signed 64-bit bucket key per band."""
        key = np.arange(1, self.p.bands + 1, dtype=np.uint64)
        for column in least.reshape(self.p.bands, self.p.rows).T:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column + np.uint64(1))
        return key.view(np.int64)


BINS = 2048  # of the one-permutation sketch


def sketch(items: np.ndarray) -> bytes:
    """Which bins of the hash range hold an item, and a bit of each bin's smallest one.

    ``items`` are sorted, so the smallest of a bin is where the bin number changes.
    """
    bins = (items >> np.uint64(53)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    both = np.zeros((2, BINS), dtype=np.uint8)
    both[0, bins[first]] = 1
    both[1, bins[first]] = (items[first] & np.uint64(1)).astype(np.uint8)
    return np.packbits(both.reshape(-1)).tobytes()


def known(docs: DataFrame) -> DataFrame:
    """Id, text and a hash of the text of the documents that have an id."""
    text = F.col("text").cast("string")
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))


def digests(docs: DataFrame, p: MinHash) -> DataFrame:
    """(doc_id, t, n, f1, f2, keys, bits): hash of the text, size and fingerprint of its set, bucket keys, sketch."""

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, sign = Shingler(p.words), Signer(p)
        for batch in batches:
            out = []
            for text in batch["text"]:
                items = shingle(normal(text) if isinstance(text, str) else b"")
                if not len(items):
                    out.append((0, 0, 0, None, None))
                    continue
                f1, f2 = items.sum(dtype=np.uint64), mixed(items ^ np.uint64(0x5555555555555555)).sum(dtype=np.uint64)
                out.append((len(items), int(f1.view(np.int64)), int(f2.view(np.int64)), sign.keys(sign(items)), sketch(items)))
            frame = pd.DataFrame(out, columns=["n", "f1", "f2", "keys", "bits"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            frame.insert(1, "t", batch["t"].to_numpy())
            yield frame

    return known(docs).mapInPandas(one, "doc_id long, t long, n long, f1 long, f2 long, keys array<long>, bits binary")


def words_of(sketches: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), dtype=np.uint64).reshape(len(sketches), BINS // 32)


def may_link(n_a: np.ndarray, bits_a: np.ndarray, n_b: np.ndarray, bits_b: np.ndarray, p: MinHash) -> np.ndarray:
    """Neither the sizes nor the sketches rule the threshold out.

    Of the bins that either set fills, those whose smallest item is common agree in their bit; of the others
    that both fill, half do.  So (both - 2 * different) / either estimates the similarity.  At 0.8 its standard
    deviation is 0.011 for sets of 100 to 1000 items and 0.0133 at most; more than four are left as slack, and some items more for small sets.
    """
    half = BINS // 64
    fill_a, fill_b = bits_a[..., :half], bits_b[..., :half]
    shared = fill_a & fill_b
    either = np.bitwise_count(fill_a | fill_b).sum(axis=-1, dtype=np.int64)
    both = np.bitwise_count(shared).sum(axis=-1, dtype=np.int64)
    different = np.bitwise_count((bits_a[..., half:] ^ bits_b[..., half:]) & shared).sum(axis=-1, dtype=np.int64)
    return (np.minimum(n_a, n_b) * 100 >= np.maximum(n_a, n_b) * p.percent) & (
        both - 2 * different >= (p.percent / 100 - p.slack) * either - 12 / np.sqrt(either))


SETS = 2**22  # shingles that a task keeps from pair to pair


def confirmed(near: DataFrame, docs: DataFrame, one: DataFrame, p: MinHash) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold."""
    involved = cut(near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().join(one.select("doc_id", "t"), "doc_id"))
    texts = known(docs).join(involved, ["doc_id", "t"]).dropDuplicates(["doc_id", "t"]).select("doc_id", "text")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "body": [packer.compress(normal(t)) for t in batch["text"]]})

    bodies = cut(texts.mapInPandas(pack, "doc_id long, body binary"))
    both = near.join(bodies.select(F.col("doc_id").alias("a"), F.col("body").alias("t_a")), "a")
    both = both.join(bodies.select(F.col("doc_id").alias("b"), F.col("body").alias("t_b")), "b")

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, unpack, sets, held = Shingler(p.words), zstandard.ZstdDecompressor(), {}, 0
        for batch in batches:
            keep = []
            for row in batch.itertuples(index=False):
                for number, body in ((row.a, row.t_a), (row.b, row.t_b)):
                    if number not in sets:
                        if held > SETS:
                            sets, held = {k: sets[k] for k in (row.a, row.b) if k in sets}, 0
                        sets[number] = shingle(unpack.decompress(body))
                        held += len(sets[number])
                x, y = sets[row.a], sets[row.b]
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= p.percent * (len(x) + len(y) - common))
            yield batch.loc[np.array(keep, dtype=bool), ["a", "b"]]

    return cut(both.mapInPandas(test, "a long, b long"))


# ------------------------------------------------------------- components
def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written first: a plain table on this side lets adaptive execution split the rows of a hub
    least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = cut(down.groupBy("u").agg(F.min("v").alias("m")))
    return down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component) of every node in ``links`` (a, b) that is not its component's smallest."""
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        edges = cut(small_star(large_star(edges)))
        # a fixed point is a set of stars: its edges no longer change
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component"))
        before = now


def near_duplicates(docs: DataFrame, p: MinHash | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    p = p or MinHash()
    digest = cut(digests(docs, p))
    same = ["n", "f1", "f2"]
    # of rows that share a doc_id the largest set, then the larger fingerprint, stands for the document
    one = cut(digest.groupBy("doc_id").agg(F.max(F.struct(*same, "t")).alias("s")).select("doc_id", "s.*"))
    words = one.where("n > 0")
    classes = cut(words.groupBy(*same).agg(F.min_by("t", "doc_id").alias("t"), F.min("doc_id").alias("doc_id")))
    signed = cut(digest.select("doc_id", "t", "keys").join(classes.select("doc_id", "t"), ["doc_id", "t"]).dropDuplicates(["doc_id", "t"]).select("doc_id", "keys"))
    banded = signed.select("doc_id", F.explode("keys").alias("key"))
    heads = cut(banded.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").select("key", "a"))
    shared = cut(banded.join(heads, "key"))
    # keys and sketches of the documents that share a bucket
    wanted = shared.select("doc_id").distinct().join(classes.select("doc_id", "t"), "doc_id")
    sides = cut(digest.join(cut(wanted), ["doc_id", "t"]).dropDuplicates(["doc_id", "t"]).select("doc_id", "n", "keys", "bits"))
    links = confirmed(first_pairs(shared, sides, p), docs, one, p)
    stars = components(links)
    rest = leftover(shared, stars, sides, p)
    if not rest.isEmpty():
        links = links.unionByName(confirmed(rest, docs, one, p))
        stars = components(links)
    member = words.join(classes.withColumnRenamed("doc_id", "rep"), same).select("doc_id", "n", "rep")
    labelled = member.join(stars.select(F.col("doc_id").alias("rep"), "component"), "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    empty = one.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    nameless = docs.where("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return labelled.unionByName(empty).unionByName(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def first_pairs(shared: DataFrame, sides: DataFrame, p: MinHash) -> DataFrame:
    """Every document with the heads it shares most buckets with, as far as sketches allow a link."""
    met = shared.where("doc_id <> a").groupBy("a", F.col("doc_id").alias("b")).agg(F.count("*").alias("n"))
    order = W.partitionBy("b").orderBy(F.desc("n"), "a")
    top = cut(met.withColumn("i", F.row_number().over(order)).where(F.col("i") <= p.heads).select("a", "b"))
    pairs = top
    for x in ("a", "b"):
        pairs = pairs.join(sides.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"s_{x}")), x)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.loc[may_link(batch["n_a"].to_numpy(), words_of(batch["s_a"]), batch["n_b"].to_numpy(), words_of(batch["s_b"]), p), ["a", "b"]]

    return cut(pairs.mapInPandas(near, "a long, b long"))


def leftover(shared: DataFrame, stars: DataFrame, sides: DataFrame, p: MinHash) -> DataFrame:
    """Pairs of one bucket but different components, each with a side outside the bucket's largest component.

    Members of the largest component and the others are dealt into blocks, and every block of others meets every
    block.  Groups are named (main block, other block), or (other block, -1 - other block) for two of others.
    """
    named = cut(shared.select("key", "doc_id").join(stars, "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("c")))
    split = cut(named.groupBy("key").agg(F.min("c").alias("c"), F.max("c").alias("z")).where("c < z").select("key"))
    narrow = cut(named.join(split, "key"))
    sizes = narrow.groupBy("key", "c").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "c")).alias("m"), F.sum("n").alias("n")).select(
        "key", F.col("m.c").alias("main"), F.ceil(F.col("m.n") / p.block).alias("p_main"), F.ceil((F.col("n") - F.col("m.n")) / p.block).alias("p_odd"))
    odd, hashed = F.col("c") != F.col("main"), F.xxhash64("doc_id", "key")
    dealt = narrow.join(cut(main), "key").withColumn("odd", odd).withColumn("q", F.pmod(hashed, F.when(odd, F.col("p_odd")).otherwise(F.col("p_main"))))
    others = F.sequence(F.lit(0).cast("long"), F.col("p_odd") - 1)
    with_main = F.transform(F.sequence(F.lit(0).cast("long"), F.col("p_main") - 1), lambda i: F.struct(i.alias("i"), F.col("q").alias("j")))
    with_odd = F.transform(F.filter(others, lambda i: i != F.col("q")), lambda i: F.struct(F.least(i, "q").alias("i"), (-1 - F.greatest(i, "q")).alias("j")))
    groups = F.when(odd, F.concat(with_main, with_odd)).otherwise(F.transform(others, lambda j: F.struct(F.col("q").alias("i"), j.alias("j"))))
    placed = dealt.withColumn("g", F.explode(groups)).select("key", "g.i", "g.j", "doc_id", "c", "odd", "q")
    # sketches come last: they are wide, and a document is in many buckets
    rows = cut(placed).join(sides, "doc_id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def pairs(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        key, i, j = group["key"].iat[0], group["i"].iat[0], group["j"].iat[0]
        number, c, is_odd, n = (group[x].to_numpy() for x in ("doc_id", "c", "odd", "n"))
        bits, keys, q = words_of(group["bits"]), np.stack(group["keys"].to_list()), group["q"].to_numpy()
        band, out = int(np.flatnonzero(keys[0] == key)[0]), []
        for x in np.flatnonzero(is_odd if j >= 0 else q == i):
            if j < 0:
                other = q != i
            elif i == 0:
                other = ~is_odd | (number > number[x])
            else:
                other = ~is_odd
            y = np.flatnonzero(other & (c != c[x]))
            y = y[may_link(n[x], bits[x], n[y], bits[y], p)]
            y = y[(keys[y, :band] != keys[x, :band]).all(axis=1)]
            out.append(np.stack([np.minimum(number[x], number[y]), np.maximum(number[x], number[y])]))
        found = np.concatenate(out, axis=1) if out else np.zeros((2, 0), dtype=np.int64)
        return found[0], found[1]

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(batch):
                continue
            ids = batch[["key", "i", "j"]].to_numpy()
            starts = np.concatenate(([0], np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1))
            # the last group may go on in the next batch
            for at, end in zip(starts[:-1], starts[1:], strict=True):
                yield pd.DataFrame(dict(zip("ab", pairs(batch.iloc[at:end]), strict=True)))
            rest = batch.iloc[starts[-1]:]
        if rest is not None and len(rest):
            yield pd.DataFrame(dict(zip("ab", pairs(rest), strict=True)))

    return cut(rows.mapInPandas(near, "a long, b long"))


def own_ids(docs: DataFrame, key: str) -> DataFrame | None:
    """(doc_id, text hash, key) of the rows whose id does not name one text: those without id, and those that share it with other texts.

    ``key`` is a number that no document has as its id.  None if there are no such rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("t"))
    texts = rows.groupBy("doc_id").agg(F.min("t").alias("t"), F.max("t").alias("z"))
    shared = texts.where("doc_id is null or t <> z").select("doc_id")
    found = cut(rows.join(shared, rows["doc_id"].eqNullSafe(shared["doc_id"]), "left_semi").distinct().withColumn("n", F.monotonically_increasing_id()))
    if found.isEmpty():
        return None
    ends = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = ends.low or 0, ends.high or 0
    if high < 2**62:
        return found.select("doc_id", "t", (F.col("n") + F.lit(max(high, -1) + 1)).alias(key))
    if low > -(2**62):
        return found.select("doc_id", "t", (F.lit(min(low, 0) - 1) - F.col("n")).alias(key))
    raise ValueError("document ids fill the whole range of numbers and do not name one text each: number the rows first")


def without_copies(docs: DataFrame, p: MinHash | None = None) -> DataFrame:
    """The documents with all their columns, one of each near-duplicate group.

    Rows that share an id but not the text are documents of their own here, compared by their own texts, and so are rows
    without an id, one for each different text.  Of rows with the same id and text one stays.
    """
    key, hashed, number = free_names(docs, "own_id", "own_hash", "own_number")
    odd = own_ids(docs, number)
    rows = docs.withColumn(key, F.col("doc_id").cast("long"))
    if odd is not None:
        odd = odd.select(F.col("doc_id").alias("i"), F.col("t").alias("h"), F.col(number))
        rows = docs.withColumn(hashed, F.xxhash64(F.col("text").cast("string"))).join(
            odd, F.col("doc_id").cast("long").eqNullSafe(F.col("i")) & (F.col(hashed) == F.col("h")), "left"
        ).withColumn(key, F.coalesce(F.col(number), F.col("doc_id").cast("long"))).select(*docs.columns, key)
    kept = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), p).where("kept").select(F.col("doc_id").alias(key))
    return rows.join(cut(kept), key).dropDuplicates([key]).select(*docs.columns)
