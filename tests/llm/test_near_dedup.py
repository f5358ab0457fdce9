"""Near-duplicate groups against all pairs of full shingle sets."""
import random
import re

import numpy as np
import pytest

from oppflow.llm.near_dedup import MinHash, Shingler, components, near_duplicates, normal, without_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i: i + n]) for i in range(max(1, len(words) - n + 1))}


def brute(rows, n, percent=80):
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed, groups=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, number = [], 0
    for _ in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 8, 40, 120, 300]))]
        for _ in range(rng.choice([1, 2, 3, 9])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(words) // 30])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((number, rng.choice([" ", "  ", "\n"]).join(words)))
            number += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,words", [(1, 4), (2, 5)])
def test_equals_all_pairs(docs, seed, words):
    rows = [*corpus(seed), (1000, None), (1001, ""), (1002, " \n"), (1003, "Only Three Words"), (1004, "only three words"), (1005, "word")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs(rows), MinHash(words=words)).collect()}
    assert got == brute(rows, words)


def test_chain_and_bucket_rest(docs):
    """A chain of drifting copies whose ends are far apart is one component."""
    rng = random.Random(5)
    words, rows = [f"c{i}" for i in range(200)], []
    for i in range(40):
        rows.append((100 - i, " ".join(words)))
        words[rng.randrange(200)] = f"x{i}"
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(rows), MinHash(words=4)).collect()}
    assert got == {i: c for i, (_, c, _) in brute(rows, 4).items()}


@pytest.mark.parametrize("block", [1, 3])
def test_blocks_of_a_hot_bucket(docs, block):
    """Copies drifting from one another in one bucket, dealt into blocks of few rows, lose no link."""
    rng = random.Random(8)
    base, rows = [f"c{i}" for i in range(150)], []
    for i in range(36):
        words = list(base)
        for _ in range(rng.choice([0, 2, 4, 6])):
            words[rng.randrange(150)] = f"x{rng.randrange(6)}"
        rows.append((i, " ".join(words)))
    p = MinHash(words=4, rows=1, heads=1, block=block)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(rows), p).collect()}
    assert got == {i: c for i, (_, c, _) in brute(rows, 4).items()}


def test_repeated_rows_null_ids_and_extra_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text, "a"), (5, text, "a"), (7, text, "b"), (None, text, "c"), (None, None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string").withColumn("component_id", near_duplicates_literal())
    got = sorted(near_duplicates(df).collect(), key=repr)
    assert [(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is not None] == [(5, 5, True), (7, 5, False)]
    assert sum(r.doc_id is None and r.kept for r in got) == 2
    left = without_copies(df)
    assert left.columns == df.columns
    kept = [(r.doc_id or 0, r.text, r.kept) for r in left.collect()]
    assert len(kept) == 2 and (0, None, "d") in kept  # one row of the group of equal texts, and the row without text


def test_texts_that_share_an_id_or_have_none(spark):
    """Every different text stays, whatever its id; rows with the same id, or none, and the same text are one document."""
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    df = spark.createDataFrame([(1, a), (1, b), (2, b), (None, b), (None, a), (3, ""), (3, "")], "doc_id long, text string").withColumn("place", near_duplicates_literal())
    for parts in (1, 4):
        left = without_copies(df.repartition(parts))
        assert left.columns == df.columns
        assert sorted(r.text for r in left.collect()) == ["", a, b]
    high = spark.createDataFrame([(2**62, a), (2**62, b), (None, b)], "doc_id long, text string")
    assert sorted(r.text for r in without_copies(high).collect()) == [a, b]


def near_duplicates_literal():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_empty_table(docs, spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    assert without_copies(empty).collect() == []


def test_shingle_sets_of_long_and_odd_texts():
    for text in ("A" * 100_000, "x " * 50_000, "Ä ö Ü\tz\x0bq", "\ud800 broken"):
        assert len(Shingler(4)(normal(text))) == len(shingles(text, 4))
    # the same words hash the same wherever they stand
    a, b = Shingler(3)(normal("a b c d e")), Shingler(3)(normal("zz b c d e"))
    assert len(np.intersect1d(a, b)) == 2


def test_components_of_long_paths(spark):
    rng = random.Random(3)
    names = rng.sample(range(10_000), 300)
    edges = [(names[i], names[i + 1]) for i in range(150)] + [(names[i], names[i + 1]) for i in range(151, 299)]
    got = {r.doc_id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    first, second = min(names[:151]), min(names[151:])
    assert got == {n: (first if n in names[:151] else second) for n in names if n not in (first, second)}
