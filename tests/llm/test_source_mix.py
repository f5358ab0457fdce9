"""Source mix: budgets against a step-by-step division, prefixes against sorted leaves."""
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from oppflow.llm.source_mix import Mix, apply_mix, budgets, copies, mixed


def divide(total, nodes):
    """{name: (weight, cap)} -> {name: budget}, by handing shortages to the siblings again and again."""
    out, open_ = {n: 0.0 for n in nodes}, {n for n, (w, c) in nodes.items() if w > 0}
    left = min(total, sum(c for w, c in nodes.values() if w > 0))
    while open_ and left > 1e-9:
        weight = sum(nodes[n][0] for n in open_)
        full = {n for n in open_ if nodes[n][1] - out[n] <= left * nodes[n][0] / weight + 1e-12}
        if not full:
            for n in open_:
                out[n] += left * nodes[n][0] / weight
            break
        for n in full:
            left -= nodes[n][1] - out[n]
            out[n] = nodes[n][1]
        open_ -= full
    return out


def tree_budgets(leaves, mix):
    def weight(level, name):
        return max(0.0, mix.weights.get(level, {}).get(name, 1.0))

    def usable(leaf):
        return all(weight(level, name) > 0 for level, name in zip(("domain", "language", "source"), leaf, strict=True))

    def capped(items):
        return sum(t * mix.max_epochs for leaf, t in items if usable(leaf))
    total = mix.share * sum(leaves.values())
    by_domain = defaultdict(list)
    for (d, lang, s), t in leaves.items():
        by_domain[d].append(((d, lang, s), t))
    out = {}
    for d, b in divide(total, {d: (weight("domain", d), capped(x)) for d, x in by_domain.items()}).items():
        by_lang = defaultdict(list)
        for leaf, t in by_domain[d]:
            by_lang[leaf[1]].append((leaf, t))
        for lang, b2 in divide(b, {n: (weight("language", n), capped(x)) for n, x in by_lang.items()}).items():
            out |= divide(b2, {leaf: (weight("source", leaf[2]), t * mix.max_epochs if usable(leaf) else 0) for leaf, t in by_lang[lang]})
    return out


@pytest.mark.parametrize("seed", range(4))
def test_budgets(spark, seed):
    rng = random.Random(seed)
    mix = Mix(share=rng.choice([0.3, 0.8, 1.5, 5.0]), max_epochs=rng.choice([1, 3]),
              weights={"domain": {"d0": 3.0, "d2": 0.5}, "language": {"en": 5.0, "xx": 0.0}, "source": {"s1": 10.0, "s2": -1.0}})
    leaves = {(f"d{rng.randrange(3)}", rng.choice(["en", "de", "xx"]), f"s{rng.randrange(5)}"): rng.choice([0, 1, 50, 700, 9000]) for _ in range(25)}
    df = spark.createDataFrame([(*k, t) for k, t in leaves.items()], "domain string, language string, source string, tokens long")
    got = {(r.domain, r.language, r.source): r.budget for r in budgets(df, mix).collect()}
    want = tree_budgets(leaves, mix)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 * (1 + want[k]) for k in want)
    can = sum(t * mix.max_epochs for (d, lang, s), t in leaves.items() if lang != "xx" and s != "s2")
    assert abs(sum(got.values()) - min(mix.share * sum(leaves.values()), can)) < 1e-6 * (1 + can)


def test_what_a_ruled_out_leaf_cannot_use_goes_on(spark):
    leaves = [("d0", "de", "a", 9000), ("d0", "en", "a", 1000), ("d1", "en", "b", 2000)]
    df = spark.createDataFrame(leaves, "domain string, language string, source string, tokens long")
    mix = Mix(share=0.9, max_epochs=2, weights={"domain": {"d0": 100.0}, "language": {"de": 0.0}})
    got = {(r.domain, r.language): r.budget for r in budgets(df, mix).collect()}
    assert got == {("d0", "de"): 0.0, ("d0", "en"): 2000.0, ("d1", "en"): 4000.0}


def corpus():
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.choice([1, 5, 30, 200])), rng.choice(["en", "en", "de", None]), rng.choice(["src0", "src0", "src1", "src2", "odd", None])) for i in range(300)]
    return rows + [(900, None, "en", "src1"), (901, "", "en", "src1"), (902, "w " * 5000, "de", "src2")]


@pytest.mark.parametrize("bins", [1, 7, 4096])
def test_prefix_of_every_leaf(docs, bins):
    mix = Mix(bins=bins, share=0.9)
    df = docs(corpus())
    order = F.pmod(F.xxhash64(F.lit(mix.seed), F.col("full"), F.col("doc_id"), F.xxhash64("doc_id", "text")), F.lit(2**40))
    rows = copies(df, mix).collect()
    leaves = defaultdict(list)
    for r in rows:
        leaves[r.domain, r.language, r.source].append(r)
    want = tree_budgets({k: sum(r.tokens for r in v) for k, v in leaves.items()}, mix)
    assert len(rows) == 303 and {r.copies for r in rows} >= {0, 1, 2}
    for leaf, members in leaves.items():
        tokens = sum(r.tokens for r in members)
        full = int(want[leaf] / tokens + 1e-9) if tokens else 1
        ids = {r.o: r for r in df.select("doc_id", F.lit(full).cast("long").alias("full"), "text").select("doc_id", order.alias("o")).collect()}
        by_id = {r.doc_id: r for r in members}
        rest, at = (want[leaf] - full * tokens if tokens else 0), 0
        for o in sorted(ids):
            r = by_id.get(ids[o].doc_id)
            if r:
                assert r.copies == full + (rest > 1e-6 and at < rest)
                at += r.tokens


def test_rows_of_the_documents(docs):
    df = docs(corpus() + [(5, "w w", "en", "src0")] * 2).selectExpr("*", "1 as copies", "'x' as domain", "2 as tokens")
    out = apply_mix(df)
    assert out.columns == df.columns
    want = {r.doc_id: r.copies for r in mixed(df).collect()}
    got = Counter(r.doc_id for r in out.collect())
    assert all(got[i] == n for i, n in want.items() if i != 5) and set(got) == set(want)


def test_empty_table_and_no_tokens(docs):
    df = docs([(1, None, None, None), (None, "", "en", "src1")])
    assert apply_mix(df).count() == 2
    assert apply_mix(df.limit(0)).collect() == [] and mixed(df.limit(0)).collect() == []
