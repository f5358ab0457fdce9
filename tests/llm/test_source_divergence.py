"""The audit against plain whole-number arithmetic over every term."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from oppflow.llm import source_divergence
from oppflow.llm.source_divergence import Audit, audit, gallop, price, terms_of, weights

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=10):
    documents, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = WORD.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        documents[lang].update(set(words))
        counts[lang, source].update(words)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= least]
        v = len(kept)

        def weigh(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * v) for t in kept}

        of = {s: weigh(counts[lang, s]) for s in sources}
        total = Counter()
        for s in sources:
            total.update(counts[lang, s])
        base = weigh(total)
        cost = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(o, sum(cost(of[s][t], of[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, cost(of[s][t], base[t])) for t in kept if counts[lang, s][t] and of[s][t] > base[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1) if part == "pair" or rank <= top]
    return sorted(out)


def corpus(rng, n):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Ünï", "É", "中文", "ÀB", "Ab", "aB"]
    rows = []
    for _ in range(n):
        source = rng.choice(["s1"] * 5 + ["s2", "s3", "é", "", None, "Z"])
        lang = rng.choice(["en", "en", "de", None])
        text = rng.choice([None, "", "1 2 3"] + [" ".join(rng.choices(words[: 60 + 10 * len(source or "")], k=rng.randrange(1, 30)))] * 8)
        rows.append((text, lang, source))
    return rows + [("lonely words here", "xx", "only"), (None, "yy", "a"), ("", "yy", "b"), (None, "en", "silent")]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, None) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, chunk int").repartition(3)


@pytest.mark.parametrize("settings", [{}, {"chunk_bits": 3, "block": 2, "entries": 20, "held": 100}, {"least_documents": 1, "block": 1}])
def test_equals_brute_force(spark, settings):
    rows = corpus(random.Random(len(settings)), 400)
    p = Audit(**settings)
    got = sorted(tuple(r) for r in audit(frame(spark, rows), p).collect())
    assert got == brute(rows, p.least_documents)
    assert {r[2] for r in got} == {"pair", "term"}


def test_empty_table_and_single_group(spark):
    assert audit(frame(spark, [("a b", "en", "s")]).limit(0)).collect() == []
    assert audit(frame(spark, [("a b", "en", "s")])).collect() == []


def test_terms():
    for text in ("Ab1c_d É\u00a0x\u0085y", "\u007f[a]`b{c}~", "ſK中", "İI", "a\u2028b", ""):
        assert [t.decode() for t in terms_of(text)] == WORD.findall(text.translate(LOWER))


def test_gallop_finds_what_sets_share(monkeypatch):
    rng = np.random.default_rng(5)
    for step in (1, 2, 7, 256):
        monkeypatch.setattr(source_divergence, "STEP", step)
        for a, b in ((0, 5), (1, 1), (3, 900), (500, 500), (40, 3000)):
            x, y = (np.sort(rng.choice(4000, n, replace=False)) for n in (a, b))
            i, j = gallop(x, y)
            assert (x[i] == y[j]).all() and x[i].tolist() == sorted(set(x.tolist()) & set(y.tolist()))


def test_weights_stay_exact_for_large_counts():
    rng = random.Random(1)
    p = Audit()
    for _ in range(500):
        mass = rng.randrange(4, 2 * 10**14)
        counts = [rng.randrange(0, mass - 2) for _ in range(5)]
        assert weights(np.array(counts), mass, p).tolist() == [1 + 10**9 * (c + 2) // mass for c in counts]
    assert price(np.array([10**9 + 1]), np.array([1])).tolist() == [10**18 // (10**9 + 2)]
