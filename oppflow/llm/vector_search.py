"""Nearest neighbours by cosine: inverted lists, scanned by column blocks with early abandoning.

Vectors are brought to unit length and rotated by a random orthogonal matrix, so that any first ``m``
of ``d`` components hold about ``m / d`` of a squared distance.  k-means on a bounded sample gives the
centres of the lists; every vector is put into the list of its nearest centre.  A query probes the
lists of its nearest centres.  How many is measured in each run: for a bounded set of its queries the true neighbours are
found among all vectors, and the fewest lists that hold the share ``recall`` of them are probed, never fewer than
``probe`` and ``least_probes`` say.  Inside a list, distances are summed block of columns by block of
columns; after each, a candidate is abandoned when its partial distance, scaled to all columns, exceeds the
current fifth-best by more than a hypothesis test allows (``epsilon`` standard deviations).  Candidates that
are left get their exact cosine from the original vectors.

Lists are cut into blocks of ``block`` vectors and the queries of a list into chunks, so that one large
list is many tasks of bounded size.  Every vector is indexed; only the centres come from a sample.

Vectors that are null, zero, or hold null or non-finite components take no part, nor rows without vec_id.  Vectors of one length are
compared with each other, each length by an index of its own.  Ties go to the smaller vec_id.  Every row is a vector of its own,
also where rows share a vec_id: each is a query, and a candidate of the others.  A query with fewer than ``k`` candidates in
its probed lists probes more, so it gets all candidates if there are fewer than ``k``.  Other columns are ignored.  An empty
table gives an empty result.
"""
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oppflow.session import cut


@dataclass(frozen=True)
class Search:
    """``sample`` bounds the vectors that k-means sees, ``most_lists`` the centres, ``measured`` the queries whose true
    neighbours are looked up.  ``recall`` is the share of those that the probed lists must hold; abandoning takes a little of it.
    """
    k: int = 5
    sample: int = 8192
    most_lists: int = 1024
    probe: float = 0.25
    least_probes: int = 8
    columns: int = 16
    epsilon: float = 2.1
    block: int = 2048
    seed: int = 23
    measured: int = 256
    recall: float = 0.95


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, v, d): the vectors that take part, as doubles, their number of components, and a number for the row."""
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("v").isNotNull() & whole & F.exists("v", lambda x: x != 0))
    return cut(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", F.size("v").alias("d")))  # written, so that a row keeps its number


def unit(m: np.ndarray) -> np.ndarray:
    top = np.abs(m).max(axis=1, keepdims=True)  # first by the largest component: squares of extreme values overflow
    m = m / top
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def rotation(d: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None, :], 0)


def centres(points: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """Lloyd's k-means on the sample; an empty cell keeps its centre."""
    rng = np.random.default_rng(seed)
    points = points[np.lexsort(points.T[::-1])]
    different = np.unique(points, axis=0)
    out = different[rng.permutation(len(different))[:lists]].copy()
    for _ in range(10):
        nearest = distances(points, out).argmin(axis=1)
        sums = np.zeros_like(out)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(out))
        filled = counts > 0
        out[filled] = sums[filled] / counts[filled, None]
    return out


def scan(query: np.ndarray, vectors: np.ndarray, bound: float, s: Search) -> np.ndarray:
    """Indices of the candidates that no test has abandoned.

    ``vectors`` are the rotated unit vectors, stored by column; ``bound`` is a squared distance known to be enough.
    """
    d = len(query)
    alive = np.arange(vectors.shape[1])
    partial = np.zeros(len(alive))
    for at in range(0, d, s.columns):
        to = min(at + s.columns, d)
        gap = vectors[at:to, alive] - query[at:to, None]
        partial = partial + np.einsum("ij,ij->j", gap, gap)
        if np.isfinite(bound) and len(alive):
            allowed = bound * (to / d) * (1 + s.epsilon / np.sqrt(to)) ** 2 if to < d else bound
            keep = partial <= allowed * (1 + 1e-9) + 1e-12
            alive, partial = alive[keep], partial[keep]
    return alive


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows with one vector, each summed in the same order."""
    dot = (a * b[None, :]).sum(axis=1)
    return dot / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum()))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_block(queries: pd.DataFrame, vectors: pd.DataFrame, turn: np.ndarray, s: Search) -> pd.DataFrame:
    """The ``k`` best candidates of one block for each of its queries."""
    empty = pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("asker", "int64"), ("query_id", "int64"), ("row", "int64"), ("vec_id", "int64"), ("score", "float64"))})
    if not len(queries) or not len(vectors):
        return empty
    raw, asked = np.array(vectors["v"].tolist()), np.array(queries["v"].tolist())
    rows, ids = vectors["row"].to_numpy(), vectors["vec_id"].to_numpy()
    turned = np.ascontiguousarray((unit(raw) @ turn).T)
    starts = unit(asked) @ turn
    out = []
    for own, name, original, q in zip(queries["row"].to_numpy(), queries["vec_id"].to_numpy(), asked, starts, strict=True):
        # the bound: the k-th best of the first candidates, exactly
        first = np.flatnonzero(rows[: 4 * s.k] != own)
        bound = np.inf
        if len(first) >= s.k:
            gaps = turned[:, first] - q[:, None]
            bound = float(np.partition(np.einsum("ij,ij->j", gaps, gaps), s.k - 1)[s.k - 1])
        left = np.arange(0)
        # chunks of candidates, so that the bound falls while the block is scanned
        for at in range(0, len(ids), 256):
            alive = scan(q, turned[:, at: at + 256], bound, s) + at
            left = np.concatenate((left, alive[rows[alive] != own]))
            if len(left) >= s.k:
                gaps = turned[:, left] - q[:, None]
                far = np.einsum("ij,ij->j", gaps, gaps)
                bound = min(bound, float(np.partition(far, s.k - 1)[s.k - 1]))
                left = left[far <= bound * (1 + 1e-9) + 1e-12]
        scores = cosine(raw[left], original)
        top = best(ids[left], scores, s.k)
        out.append(pd.DataFrame({"asker": own, "query_id": name, "row": rows[left][top], "vec_id": ids[left][top], "score": scores[top]}))
    return pd.concat(out, ignore_index=True) if out else empty


def true_lists(listed: DataFrame, queries: pd.DataFrame, s: Search) -> pd.DataFrame:
    """(asker, list) of the ``k`` nearest of all vectors, for a bounded number of queries, named by their row.

    A task keeps ``k`` rows a query, so what is dealt out does not grow with its vectors.
    """
    names, asked = queries["row"].to_numpy(), unit(np.array(queries["v"].tolist()))

    def scores_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            if not len(batch):
                continue
            rows, ids, found = batch["row"].to_numpy(), batch["vec_id"].to_numpy(), unit(np.array(batch["v"].tolist())) @ asked.T
            parts = [kept] if kept is not None else []
            for i, name in enumerate(names):
                others = np.flatnonzero(rows != name)
                top = others[best(ids[others], found[others, i], s.k)]
                parts.append(pd.DataFrame({"asker": name, "vec_id": ids[top], "list": batch["list"].to_numpy()[top], "score": found[top, i]}))
            kept = pd.concat(parts).sort_values(["asker", "score", "vec_id"], ascending=[True, False, True]).groupby("asker").head(s.k)
        if kept is not None:
            yield kept

    found = listed.mapInPandas(scores_of, "asker long, vec_id long, list int, score double")
    order = W.partitionBy("asker").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.k).select("asker", "list").toPandas()


def probes_for(true: pd.DataFrame, queries: pd.DataFrame, middle: np.ndarray, s: Search) -> int:
    """The fewest nearest lists that hold the share ``recall`` of the true neighbours."""
    near = np.argsort(distances(unit(np.array(queries["v"].tolist())), middle), axis=1, kind="stable")
    turn_of = dict(zip(queries["row"], np.argsort(near, axis=1), strict=True))  # place of every list in a query's order
    places = np.sort([turn_of[q][i] for q, i in zip(true["asker"], true["list"], strict=True)])
    return int(places[max(int(np.ceil(s.recall * len(places))) - 1, 0)]) + 1 if len(places) else 1


def nearest(df: DataFrame, is_query: Column, s: Search | None = None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for the rows where ``is_query`` (over vec_id) holds."""
    s = s or Search()
    rows = usable(df, key, vector)
    # one row per length of vectors; lengths without queries need no index
    lengths = rows.groupBy("d").agg(F.count("*").alias("n"), F.count_if(is_query).alias("asked")).orderBy("d").collect()
    out = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for length in lengths:
        if length.asked:
            out = out.unionByName(nearest_of_length(rows.where(F.col("d") == length.d), length.n, is_query, s))
    return out


def nearest_of_length(rows: DataFrame, n: int, is_query: Column, s: Search) -> DataFrame:
    """``nearest`` among ``n`` vectors (row, vec_id, v) of one length."""
    spark = rows.sparkSession
    share = min(1.0, 1.5 * s.sample / n)
    order = F.pmod(F.xxhash64(F.lit(s.seed), "vec_id", "v"), F.lit(2**40))
    drawn = rows.where(order < int(share * 2**40) + 1).orderBy(order, "vec_id", "row").limit(s.sample).toPandas()
    points = unit(np.array(drawn["v"].tolist()))
    middle = centres(points, int(min(s.most_lists, max(1, round(n**0.5 / 4)))), s.seed)
    turn = rotation(points.shape[1], s.seed)

    @F.pandas_udf("int")
    def list_of(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype="int32")
        return pd.Series(distances(unit(np.array(v.tolist())), middle).argmin(axis=1).astype("int32"))

    listed = cut(rows.select("row", "vec_id", "v", list_of("v").alias("list")))
    sizes = {r.list: r.n for r in listed.groupBy("list").agg(F.count("*").alias("n")).collect()}  # a row per list
    filled = np.array([sizes.get(i, 0) for i in range(len(middle))])
    probes = min(len(middle), max(s.least_probes, round(s.probe * len(middle))))
    if probes < len(middle):
        known = rows.where(is_query).orderBy(order, "vec_id", "row").limit(s.measured).toPandas()
        if len(known):
            probes = max(probes, probes_for(true_lists(listed, known, s), known, middle, s))

    @F.pandas_udf("array<int>")
    def probed(v: pd.Series) -> pd.Series:
        out = []
        for line in np.argsort(distances(unit(np.array(v.tolist())), middle), axis=1, kind="stable") if len(v) else ():
            enough = int(np.searchsorted(np.cumsum(filled[line]), s.k + 1)) + 1
            out.append(line[: max(probes, enough)].astype("int32"))
        return pd.Series(out, dtype=object)

    asked = cut(rows.where(is_query).select("row", "vec_id", "v", F.explode(probed("v")).alias("list")))
    askers = {r.list: r.n for r in asked.groupBy("list").agg(F.count("*").alias("n")).collect()}
    pieces = {i: (-(-sizes.get(i, 0) // s.block), -(-askers.get(i, 0) // s.block)) for i in range(len(middle))}
    plan = spark.createDataFrame([(i, a, b) for i, (a, b) in pieces.items() if a and b], "list int, blocks int, chunks int")
    plan = F.broadcast(plan)  # at most most_lists rows
    salt = F.xxhash64("row", F.lit(s.seed))

    def dealt(table: DataFrame, own: str, other: str, at: str, all_: str) -> DataFrame:
        return table.join(plan, "list").withColumn(at, F.pmod(salt, F.col(own)).cast("int")).withColumn(
            all_, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select("row", "vec_id", "v", "list", "block", "chunk")

    keys = ["list", "block", "chunk"]
    vectors = dealt(listed, "blocks", "chunks", "block", "chunk").groupBy(*keys)
    queries = dealt(asked, "chunks", "blocks", "chunk", "block").groupBy(*keys)

    def one(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        return search_block(q, v, turn, s)

    found = queries.cogroup(vectors).applyInPandas(one, "asker long, query_id long, row long, vec_id long, score double")
    order = W.partitionBy("asker").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.k).select("query_id", "rank", "vec_id", "score")
