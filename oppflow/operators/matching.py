"""Literal-phrase joins and joins against a key that a third of all rows share."""
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oppflow.session import cut

BROADCAST_PHRASES = 5000
BROADCAST_CHARS = 1_000_000
PIECES = {16: 8, 8: 4, 4: 1, 2: 1, 1: 1}  # bytes of a piece, and how far apart the places are where texts are read for it
LONG = 16  # pieces of phrases that meet their places in a shuffle
TRIES = 8  # pieces of a phrase that one is chosen from
CELL = 1024  # bytes of a text that are read together
BLOCK = 512  # bytes of a phrase that are compared beside its piece
BUCKETS = 1 << 20
WORDS = 2  # of 64 bits, in each bucket
SHORT_PHRASES = 50_000  # shorter phrases that are looked for in one reading of the texts


def fits(df: DataFrame, column: str, rows: int = BROADCAST_PHRASES, chars: int = BROADCAST_CHARS) -> bool:
    """Whether ``df`` stays below a row and a text bound; reads at most ``rows + 1`` rows of it."""
    n, size = (
        df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(F.length(column)), F.lit(0))).first()
    )
    return n <= rows and size <= chars


def small(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a broadcast hint where it is below the bound, else as it is.

    Without the hint the join shuffles, and adaptive execution splits its hot keys.
    """
    return F.broadcast(df) if fits(df, column) else df


def phrase_hits(texts: DataFrame, key: str, text: str, phrases: DataFrame) -> DataFrame:
    """Pairs ``(key, phrase)`` where the phrase occurs in the text; both lower case.

    ``phrases(phrase)`` is distinct and of any size.  Texts and phrases are compared as bytes.  Of every phrase a span is
    indexed, as long as a piece of the longest size of ``PIECES`` that it has room for, read at one of the step's places.
    It lies around the piece that the texts hold least often, so phrases with common starts do not meet at it.
    Texts are read in cells, at the places of each step only; where a piece of a span is met, the spans that it can be
    part of are looked up, and what goes on holds as many bytes around a span as phrases of that size have, never its text.
    Places of long phrases are shuffled to the index then, those of shorter ones, which are many, are compared where they
    are: the texts are read once for each ``SHORT_PHRASES`` of them.
    Only phrases longer than a block are compared with whole texts, where their first block was found.
    Empty phrases and null texts have no hits.
    """
    index = cut(spans(rarest_pieces(phrases, texts, text)))
    after = F.length("head") - F.col("place") - F.length("span")
    sizes = index.groupBy(F.length("piece").alias("size")).agg(F.count("*").alias("n"), F.max("place").alias("before"), F.max(after).alias("after"))
    sizes = sizes.collect()  # at most a row for each of PIECES
    short = F.length("piece") < LONG
    rounds = -(-sum(r.n for r in sizes if r.size < LONG) // SHORT_PHRASES)
    shorts = [index.filter(short & (F.pmod(F.xxhash64("phrase"), F.lit(rounds)) == i)) for i in range(rounds)]
    found = [near_places(texts, key, text, part, [r for r in sizes if r.size < LONG]).join(F.broadcast(part), "span") for part in shorts]
    if longs := [r for r in sizes if r.size >= LONG]:
        part = index.filter(~short)
        found.append(near_places(texts, key, text, part, longs).join(part, "span"))
    if not found:
        return texts.select(key, F.lit("").alias("phrase")).filter(F.lit(False))
    begin = F.col("skip") - F.col("place")
    same = (begin >= 0) & (F.substring("near", begin + 1, F.length("head")) == F.col("head"))
    met = reduce(DataFrame.unionByName, [rows.filter(same).select(key, "phrase") for rows in found]).distinct()
    whole = F.octet_length("phrase") <= BLOCK
    if index.filter(~whole).isEmpty():
        return met
    met = cut(met)
    long = met.filter(~whole).join(texts.select(key, text), key).filter(F.contains(F.col(text), F.col("phrase")))
    return met.filter(whole).unionByName(long.select(key, "phrase").distinct())


def near_places(texts: DataFrame, key: str, text: str, index: DataFrame, sizes: list) -> DataFrame:
    """``(key, span, skip, near)``: where a span of the index is, after ``skip`` bytes of ``near``.

    ``sizes`` has the most bytes that phrases of a size have before and after their span.
    """
    held = F.explode(_by_size(lambda size: F.array(*[F.lit(i) for i in range(PIECES[size])]))).alias("skip")
    pieces = index.select("span", F.length("piece").alias("size")).select("span", "size", held)
    pieces = pieces.select(F.substring("span", F.col("skip") + 1, F.col("size")).alias("piece"))
    places = indexed(read(texts, key, text, {r.size: PIECES[r.size] for r in sizes}), pieces, "piece")
    places = places.select(key, "window", "size", "at", held).withColumn("start", F.col("at") - F.col("skip")).filter("start >= 0")
    places = places.withColumn("span", F.substring("window", F.col("start") + 1, _by_size(_reach)))
    places = indexed(places, index, "span")
    before, after = {r.size: r.before for r in sizes}, {r.size: r.after for r in sizes}
    first = F.greatest(F.col("start") - _by_size(lambda size: before.get(size, 0)), F.lit(0))
    n = F.col("start") - first + F.length("span") + _by_size(lambda size: after.get(size, 0))
    return places.select(key, "span", (F.col("start") - first).alias("skip"), F.substring("window", first + 1, n).alias("near"))


def _reach(size: int) -> int:
    """Bytes of a span: wherever it is in a text, one of the step's places has a piece of that size in it."""
    return size + PIECES[size] - 1


def _by_size(value) -> Column:
    """``value`` of the size that a row has; no null."""
    *others, smallest = PIECES
    return reduce(lambda rest, n: F.when(F.col("size") == n, value(n)).otherwise(rest), reversed(others), F.lit(value(smallest)))


def rarest_pieces(phrases: DataFrame, texts: DataFrame, text: str) -> DataFrame:
    """``(phrase, head, piece, place)``: of ``TRIES`` pieces of each phrase's head, the one that the texts hold least often.

    Texts are counted at every position that the longest size divides, which finds all positions of a piece equally often
    in the long run, and in ``BUCKETS`` numbers.  The counts choose the piece and nothing else.
    """
    heads = cut(phrases.filter("phrase <> ''")).select("phrase", F.substring(F.col("phrase").cast("binary"), 1, BLOCK).alias("head"))
    size = F.coalesce(*[F.when(F.length("head") >= _reach(n), n) for n in PIECES])
    last = F.length("head") - size  # the first and the last piece are always among those tried
    tried = F.least(last + 1, F.lit(TRIES))
    steps = F.transform(F.sequence(F.lit(0), tried - 1), lambda i: F.floor(i * last / F.greatest(tried - 1, F.lit(1))).cast("int"))
    pieces = heads.select("phrase", "head", size.alias("size"), F.explode(steps).alias("place"))
    pieces = pieces.select("phrase", "head", F.substring("head", F.col("place") + 1, F.col("size")).alias("piece"), "place")
    places = read(texts.select(text), text, text, {n: max(PIECES) for n in PIECES if n >= 4})  # shorter ones are whole phrases
    seen = indexed(places.select("piece"), pieces, "piece")
    seen = seen.groupBy(_bucket(F.xxhash64("piece")).alias("bucket")).agg(F.count("*").alias("n"))
    # at most BUCKETS rows
    counted = pieces.withColumn("bucket", _bucket(F.xxhash64("piece"))).join(F.broadcast(seen), "bucket", "left")
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece", "place", "head")).alias("best")
    return counted.groupBy("phrase").agg(best).select("phrase", "best.head", "best.piece", "best.place")


def spans(pieces: DataFrame) -> DataFrame:
    """``(phrase, head, piece, span, place)``: around each piece as many bytes as are read for; ``place`` is the span's."""
    at = F.least(F.col("place"), F.length("head") - F.col("reach"))
    each = pieces.withColumn("size", F.length("piece")).withColumn("reach", _by_size(_reach)).withColumn("place", at)
    return each.select("phrase", "head", "piece", F.substring("head", F.col("place") + 1, F.col("reach")).alias("span"), "place")


def read(texts: DataFrame, key: str, text: str, steps: dict[int, int]) -> DataFrame:
    """``(key, window, at, size, piece)``: the places of each text where pieces of a size are looked up, a step apart.

    ``window`` is a cell with a block on each side, and the piece begins after ``at`` bytes of it.
    (An outer ``explode`` does not cut every text once more, to drop those without places before.)
    """
    whole = texts.select(key, F.col(text).cast("binary").alias("bytes"))
    cells = F.when(F.length("bytes") > 0, F.sequence(F.lit(0), F.length("bytes") - 1, F.lit(CELL)))
    each = whole.select(key, "bytes", F.explode_outer(cells).alias("cell")).filter("cell is not null")
    before = F.least(F.col("cell"), F.lit(BLOCK))
    window = F.substring("bytes", F.col("cell") - before + 1, before + CELL + BLOCK)
    n = F.least(F.length("bytes") - F.col("cell"), F.lit(CELL))
    each = each.select(key, window.alias("window"), before.alias("before"), n.alias("n"))
    each = each.select("*", F.explode(F.array(*[F.struct(F.lit(size).alias("size"), F.lit(step).alias("step")) for size, step in steps.items()])).alias("of"))
    places = F.explode_outer(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1, F.col("of.step")))
    each = each.select(key, "window", F.col("of.size").alias("size"), places.alias("at"))
    return each.withColumn("piece", F.substring("window", F.col("at") + 1, F.col("size")))


def _bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS))


def indexed(rows: DataFrame, index: DataFrame, name: str) -> DataFrame:
    """Rows whose value of ``name`` may be one of the index: a broadcast of at most ``BUCKETS`` rows, however large the index.

    A bucket has ``WORDS`` of 64 bits, and a value sets four bits of one; so with several values in every word few others pass.
    """
    hashed = F.col("hashed")
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(hashed, 20 + 6 * i).bitwiseAND(63).cast("int")) for i in range(4)]
    mask = reduce(lambda a, b: a.bitwiseOR(b), bits)
    word = F.shiftright(hashed, 44).bitwiseAND(WORDS - 1)
    known = index.select(F.xxhash64(name).alias("hashed")).groupBy(_bucket(hashed).alias("bucket"))
    known = known.agg(*[F.coalesce(F.bit_or(F.when(word == i, mask)), F.lit(0)).alias(f"bits_{i}") for i in range(WORDS)])
    asked = rows.withColumn("hashed", F.xxhash64(name)).withColumn("bucket", _bucket(hashed)).join(F.broadcast(known), "bucket")
    own = F.coalesce(*[F.when(word == i, F.col(f"bits_{i}")) for i in range(WORDS)])
    return asked.filter(own.bitwiseAND(mask) == mask).select(*rows.columns)


def covered_by(term, phrases: list[str]):
    """True where ``term`` is part of a phrase or a phrase is part of ``term``."""
    dictionary = F.split(F.lit("\n".join(sorted({p.lower() for p in phrases if p}))), "\n")
    if not any(phrases):
        return F.lit(False)
    return F.exists(dictionary, lambda p: F.contains(p, term) | F.contains(term, p))


def join_hot(rows: DataFrame, lookup: DataFrame, key: str, weight: str, hot: int = 1000) -> DataFrame:
    """Inner join on ``key`` to a lookup that is unique per key, safe for hot keys.

    The ``hot`` heaviest keys by ``weight`` are at most that many rows, so they are
    broadcast; each other key then holds less than a ``1/hot`` share of the weight
    and the rest is an ordinary shuffle join.  Rows that met a hot key take a key
    that matches nothing and spreads them, and carry their value through.
    """
    values = [c for c in lookup.columns if c not in (key, weight)]
    heavy = lookup.orderBy(F.desc(weight), key).limit(hot)
    heavy = heavy.select(F.col(key).alias("_k"), F.lit(True).alias("_hot"), *[F.col(v).alias(f"_h_{v}") for v in values])
    marked = rows.join(F.broadcast(heavy), F.col(key) == F.col("_k"), "left").drop("_k")
    others = [F.col(c) for c in rows.columns]
    # a settled row is keyed by its own content and its key is null for the match
    marked = marked.withColumn(
        "_spread", F.when(F.col("_hot"), F.xxhash64(*others)).otherwise(F.xxhash64(key))
    ).withColumn("_match", F.when(F.col("_hot").isNull(), F.col(key)))
    cold = lookup.select(
        F.xxhash64(key).alias("_spread"), F.col(key).alias("_match"), F.lit(True).alias("_found"), *[F.col(v).alias(f"_c_{v}") for v in values]
    )
    joined = marked.join(cold, ["_spread", "_match"], "left")
    return joined.filter(F.coalesce("_hot", "_found", F.lit(False))).select(
        *rows.columns,
        *[F.when(F.col("_hot"), F.col(f"_h_{v}")).otherwise(F.col(f"_c_{v}")).alias(v) for v in values],
    )
