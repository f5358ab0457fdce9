"""Language ID: held-out accuracy, folds, and hard inputs."""
import random
import zlib
from collections import Counter

import numpy as np

from oppflow.llm.language_id import (
    FollowTheLeader, Settings, document_frequencies, gram_counts, identify, labelled_sample, letters, recognised, temperature, train)

FOLDER = "/root/testdata/sf0.01"
PIECES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ei", "ung", "ver"], "cc": ["é", "oi", "eau", "tre"]}


def invented(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(PIECES))
        rows.append((i, " ".join("".join(rng.choice(PIECES[lang]) for _ in range(3)) for _ in range(30)), lang, "s"))
    return rows


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_the_held_fold_do_not_matter(docs):
    rows = invented(120)
    lied = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in rows]
    a, b = ({r.doc_id: (r.lang_pred, round(r.score, 9)) for r in identify(docs(x)).collect()} for x in (rows, lied))
    assert a == b and {x for x, _ in a.values()} == set(PIECES)


def test_hard_inputs(docs):
    long = "".join(random.Random(2).choice("schei ung") for _ in range(300_000))
    odd = [(900, None), (901, ""), (902, "12 34 !!"), (903, "🙂🙂"), (904, long), (905, "a"), (906, "𐐨𐐨 ok"), (None, "kalo mitu kalo", "aa", "s")]
    odd = [(*r[:2], None, "s") if len(r) == 2 else r for r in odd]
    got = {r.doc_id: r for r in identify(docs(invented(120) + odd)).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und"] * 4
    assert got[904].lang_pred == "bb" and got[905].lang_pred in PIECES and got[906].lang_pred in PIECES
    assert got[None].held_out is False and got[None].lang_pred == "aa"


def test_nothing_to_learn_and_empty_table(docs):
    got = identify(docs([(1, "kalo", None, "s"), (2, "mitu", None, "s")])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert identify(docs([(1, "a")]).limit(0)).collect() == []


def test_filter_keeps_columns_and_repeated_rows(docs):
    df = docs(invented(90) + [(500, "kalo mitu tuka lomi", "aa", "s")] * 2 + [(501, "??", "aa", "s")]).selectExpr("*", "'x' as score", "1 as p")
    kept = recognised(df)
    assert kept.columns == df.columns
    names = Counter(r.doc_id for r in kept.collect())
    assert names[500] == 2 and 501 not in names and len(names) >= 88


def test_counts_and_frequencies_equal_plain_ones(docs):
    s = Settings(features=2**12, max_n=2)
    texts = ["Abab, c", "b  b", "éa 1"]
    for t in texts:
        plain = "".join(map(chr, letters(t)))
        assert plain == {"Abab, c": "abab c", "b  b": "b b", "éa 1": "éa "}[t]
        slots, counts = gram_counts(t, s)
        assert counts.sum() == len(plain) + len(plain) - 1 and len(slots) <= len({plain[i: i + n] for n in (1, 2) for i in range(len(plain))})
    seen, n = document_frequencies(docs([(i, t) for i, t in enumerate(texts)]), s)
    want = sum(np.bincount(gram_counts(t, s)[0], minlength=s.features) for t in texts)
    assert n == 3 and (seen == want).all()


def test_temperature_undoes_a_scale():
    rng = np.random.default_rng(1)
    z = rng.normal(size=(4000, 3))
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    labels = [int(rng.choice(3, p=x)) for x in p]
    assert abs(temperature(list(z * 5), labels) - 5) < 0.6


def test_weights_equal_plain_follow_the_leader():
    """Coordinate by coordinate, from all gradients so far: the closed form of the regularised leader."""
    s, rng = Settings(features=16, mix=0.7), np.random.default_rng(4)
    rows = [(np.sort(rng.choice(16, 5, replace=False)), rng.random(5), int(rng.integers(3))) for _ in range(60)]
    fast = FollowTheLeader(3, s, 0.3)
    z, n, w = ([[0.0] * 3 for _ in range(16)] for _ in range(3))
    for slots, values, label in rows:
        scores = [sum(v * w[i][c] for i, v in zip(slots, values)) for c in range(3)]
        e = [np.exp(x - max(scores)) for x in scores]
        for i, v in zip(slots, values):
            for c in range(3):
                g = v * (e[c] / sum(e) - (c == label))
                sigma = ((n[i][c] + g * g) ** 0.5 - n[i][c] ** 0.5) / s.alpha
                z[i][c] += g - sigma * w[i][c]
                n[i][c] += g * g
        for i in slots:
            for c in range(3):
                x, l1, l2 = z[i][c], 0.3 * 0.7, 0.3 * (1 - 0.7)
                size = max(abs(x) - l1, 0) / ((s.beta + n[i][c] ** 0.5) / s.alpha + l2)
                w[i][c] = -size if x > 0 else size
        fast.learn(slots, values, label)
    got = fast.weights(slice(None))
    assert np.allclose(got, w) and 0 < np.count_nonzero(got) < got.size


def test_penalties_prune_and_keep_accuracy(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    free, ours = train(df, Settings(strengths=(0.0,))), train(df, Settings())
    assert np.count_nonzero(ours.weights) < 0.5 * np.count_nonzero(free.weights)
    assert len(ours.weights) < len(free.weights) and not ours.weights[-1].any()


def test_dirty_labels_are_bounded(docs):
    rows = invented(120) + [(1000 + i, "kalo mitu", f"x{i}", "s") for i in range(300)]
    got = {r.lang_pred for r in identify(docs(rows), Settings(labels=3)).collect()}
    assert got <= set(PIECES)


def test_the_sample_reaches_the_driver_as_columns(docs):
    """Four bytes a number, not a Python object each, and the grams of the rows themselves."""
    s, rows = Settings(sample=30), invented(120)
    drawn = labelled_sample(docs(rows), s)
    assert Counter(r.lang for r in drawn) == Counter({x: 10 for x in PIECES})
    known = {(slots.tobytes(), counts.tobytes()) for slots, counts in (gram_counts(t, s) for _, t, _, _ in rows)}
    for r in drawn:
        assert r.slots.dtype.itemsize == r.counts.dtype.itemsize == 4 and r.slots.base is not None
        assert (r.slots.astype(np.int64).tobytes(), r.counts.astype(np.int64).tobytes()) in known
    assert labelled_sample(docs(rows).limit(0), s) == []
