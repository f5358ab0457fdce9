"""Host rules: measures against plain Python, verdicts against the formula."""
import random
import re
from collections import Counter

from oppflow.llm.host_rules import MAX_STRENGTH, MIN_STRENGTH, HostLimits, judge

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    t = text or ""
    words = WORD.findall(t)
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if counts[w] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def failures(m):
    n, chars, symbols, dup, repeat = m
    return {"few_words": n < 50, "repeats": 100 * repeat > 50 * n, "symbols": 10 * symbols > n, "dup_lines": n > 0 and 10 * dup > n,
            "word_length": chars < 2 * n or chars > 15 * n}


def verdicts(rows):
    limits = HostLimits().limits
    hosts = {}
    for _, text, _, host in rows:
        if host is not None:
            hosts.setdefault(host, []).append(failures(plain(text)))
    out = {h: False for h in hosts}
    for rule, limit in limits.items():
        rates = {h: sum(f[rule] for f in x) / len(x) for h, x in hosts.items()}
        m = sum(rates.values()) / len(rates)
        v = sum((r - m) ** 2 for r in rates.values()) / len(rates)
        inverse = sum(1 / len(x) for x in hosts.values()) / len(hosts)
        strength = max(min(m * (1 - m) / max(v - m * (1 - m) * inverse, 1e-9) - 1, MAX_STRENGTH), MIN_STRENGTH)
        for h, x in hosts.items():
            out[h] |= (sum(f[rule] for f in x) + m * strength) / (len(x) + strength) > limit
    return out


def corpus():
    rng = random.Random(8)
    rows = []
    for i in range(240):
        host = rng.choice(["good", "good", "bad", "mixed", "rare"])
        n = 5 if rng.random() < {"good": 0.1, "bad": 0.97, "mixed": 0.5, "rare": 0.0}[host] else 80
        words = [rng.choice(["aa", "b#b", "cé", "dddd", "🙂", "$"]) if rng.random() < 0.1 else f"w{rng.randrange(999)}" for _ in range(n)]
        rows.append((i, rng.choice([" ", "\n", "  \t", " \n"]).join(words), "en", host))
    rows += [(900, None, "en", "good"), (901, "", "en", "good"), (902, "x " * 20_000, "en", "good"), (903, "a b c a b c a b c a b c " * 5, "en", None),
             (904, "\n\n a\n a\n a", "en", None), (905, "\xa0a b c", "en", "one"), (905, "\xa0a b c", "en", "one"), (None, "q " * 60, None, None)]
    return rows


def test_equals_plain_python(docs):
    rows = corpus()
    reject = verdicts(rows)
    assert reject["bad"] and not reject["good"]
    want = sorted(((r[0], *plain(r[1]), (f := failures(plain(r[1])))["few_words"] or f["repeats"],
                    not (f["few_words"] or f["repeats"]) and not reject.get(r[3], False)) for r in rows), key=repr)
    df = docs(rows).selectExpr("*", "1 as host", "'x' as t", "'y' as words", "0 as kept")
    got = judge(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_no_python_in_the_plan(docs):
    plan = judge(docs(corpus()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_table_and_no_hosts(docs):
    df = docs([(1, "a b", "en", None)])
    assert [(r.n_words, r.kept) for r in judge(df).collect()] == [(2, False)]
    assert judge(df.limit(0)).collect() == []
