"""Vector search against brute force."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from oppflow.llm.vector_search import Search, nearest, rotation, scan

QUERY = "vec_id % 50 = 0"


def brute(rows, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = min(good[i], v) if i in good else v
    names = sorted(good)
    m = np.array([good[i] for i in names], dtype=float)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    out = {}
    for at, i in enumerate(names):
        if i % 50 == 0:
            s = m @ m[at]
            out[i] = [(names[j], s[j]) for j in np.lexsort((names, -np.round(s, 12))) if j != at][:k]
    return out


def found(df, s=None):
    out = {}
    for r in nearest(df, F.expr(QUERY), s).collect():
        out.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    return {q: [x[i] for i in range(1, len(x) + 1)] for q, x in out.items()}


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_on_the_tables(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    got = found(df)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    exact = {(q, i): s for q, x in want.items() for i, s in x}
    assert all(abs(exact[q, i] - s) < 1e-12 for q, x in got.items() for i, s in x if (q, i) in exact)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit("x")).withColumn("score", F.lit(1))


def test_exact_where_all_lists_are_probed(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=20).astype("float32")]) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(2000, [2 * x for x in rows[3][1]])]
    got = found(frame(spark, rows), Search(probe=1.0, block=64, epsilon=50.0))
    want = brute(rows)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


def test_vectors_that_take_no_part(spark):
    good = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (50, [1e-30, 1e-30]), (3, [3e38, 3e38])]
    bad = [(4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (100, None)]
    got = found(frame(spark, good + bad + [(1, [1.0, 0.1])]))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {0: [1, 1, 3, 50, 2], 50: [3, 1, 1, 0, 2]}
    assert abs(got[50][0][1] - 1) < 1e-12


def test_each_length_has_its_index(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8 if i < 300 else 16)]) for i in range(500)]
    got = found(frame(spark, rows), Search(probe=1.0))
    want = brute(rows[:300]) | {q: x for q, x in brute(rows[300:]).items()}
    assert got.keys() == set(range(0, 500, 50))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


def test_rows_that_share_an_id_are_vectors_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.2]), (2, [0.3, 1.0])]
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 3)) for r in nearest(frame(spark, rows), F.expr(QUERY)).collect())
    assert got == [(0, 1, 1, 0.981), (0, 1, 2, 0.958), (0, 2, 1, 0.196), (0, 2, 2, 0.287), (0, 3, 0, 0.0), (0, 3, 0, 0.0)]


def test_one_common_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 5000)]
    got = found(frame(spark, rows), Search(block=256))
    assert len(got) == 100
    assert all([i for i, _ in x] == [i for i in range(7) if i != q][:5] for q, x in got.items())


def test_empty_tables(spark):
    df = frame(spark, [(1, [1.0, 2.0])])
    assert found(df) == {} and found(df.limit(0)) == {} and found(frame(spark, [(0, [1.0])])) == {}


def test_scan_keeps_all_that_is_near_enough():
    rng = np.random.default_rng(1)
    turn = rotation(64, 1)
    assert np.allclose(turn @ turn.T, np.eye(64))
    v = rng.normal(size=(64, 3000))
    v /= np.sqrt((v * v).sum(axis=0))
    lost = total = 0
    for q in v.T[:40]:
        far = ((v - q[:, None]) ** 2).sum(axis=0)
        bound = np.partition(far, 20)[20]
        left = scan(q, v, bound, Search())
        total += 21
        lost += 21 - int((far[left] <= bound * (1 + 1e-9)).sum())
        assert len(left) < 200
    assert lost <= 0.03 * total


def test_recall_on_a_larger_table(spark):
    """40000 isotropic vectors: most lists hold true neighbours, so a fixed quarter of them is not enough."""
    m = np.random.default_rng(7).normal(size=(40_000, 64))
    rows = [(i, v) for i, v in enumerate(m.tolist())]
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    want = brute([(i, v) for i, v in rows])
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
