"""Tagging, key terms, phrases: golden cases and brute force."""
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from oppflow.fixed_values import EXCLUSIONS, STOP_WORDS
from oppflow.functions.phrases import load_phrases, phrase_pattern
from oppflow.functions.text import combined_text
from oppflow.operators import rake
from oppflow.operators.tagging import key_terms, tag

WORDS = ["economic analysis", "fiscal impact", "econometric", "opioid", "opioid use disorder", "CDFI", "cost-benefit", "e-government"]


def record(spark, title, description="", agency=""):
    return spark.createDataFrame([(title, description, agency)], "title string, description string, agency string")


@pytest.mark.parametrize("title, expected", [
    ("Economic analysis conference", []),
    ("Opioid exposure study", []),
    ("Opioid use disorder grant", ["opioid"]),
    ("Fiscal impact and fiscal IMPACT, econometric", ["fiscal impact", "econometric"]),
    ("Cost-Benefit of E-Government cdfi", ["cost-benefit", "e-government", "cdfi"]),
    ("nothing here", []),
])
def test_tag(spark, title, expected):
    row = tag(record(spark, title), WORDS).first()
    assert (row.keyword_match, row.matched_kw) == (bool(expected), expected)


def test_null_fields_do_not_stop_a_run(spark):
    assert tag(record(spark, "opioid", None, None), WORDS).first().matched_kw == ["opioid"]


def test_pattern_equals_plain_alternation():
    rng = random.Random(7)
    for _ in range(300):
        phrases = ["".join(rng.choice("ab -.") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))]
        text = "".join(rng.choice("abAB -.") for _ in range(60))
        plain = re.compile("|".join(re.escape(p) for p in phrases), re.IGNORECASE)
        compact = re.compile(phrase_pattern(phrases).replace("(?iu)", "(?i)"))
        assert plain.findall(text) == compact.findall(text)


def test_fixed_lists():
    assert len(EXCLUSIONS) == 48 and len(STOP_WORDS) == 214


def test_dictionary_file(spark, tmp_path):
    (tmp_path / "words.txt").write_text("# comment\nopioid\n\n cost-benefit \n")
    assert load_phrases(spark, str(tmp_path / "words.txt")) == ["opioid", "cost-benefit"]


@pytest.mark.parametrize("title, description, expected", [
    ("RFP Stormwater", "", ["stormwater"]),
    ("Stormwater Rehabilitation", "", ["stormwater rehabilitation"]),
    ("Road Salt", "  ROAD SALT ", ["road salt"]),
    ("the of 123 ab", "", []),
    ("", "", []),
])
def test_key_terms(spark, title, description, expected):
    got = record(spark, title, description).select(key_terms(combined_text()).alias("k")).first().k
    assert got == expected


def test_key_terms_brute_force(spark):
    rng = random.Random(3)
    vocab = ["water", "sewer", "bridge", "the", "12", "x9", "école", "road_1", "ab", "salt"]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 80))) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.k for r in df.select("i", key_terms(F.col("text")).alias("k")).collect()}
    for i, text in enumerate(texts):
        words = [w for w in re.findall(r"\w{3,}", text.lower()) if not w.isdigit() and w not in STOP_WORDS]
        pairs = Counter(" ".join(p) for p in zip(words, words[1:]))
        ranked = sorted(pairs, key=lambda p: (-pairs[p], p))[:10]
        assert got[i] == (ranked if len(words) > 1 else words)


def test_phrases_brute_force(spark):
    rng = random.Random(5)
    vocab = ["water", "sewer", "bridge", "the", "of", ",", ".", "road", "salt", "|"]
    texts = [" ".join(rng.choice(vocab) for _ in range(60)) for _ in range(12)]
    df = spark.createDataFrame([(t, "", "") for t in texts], "title string, description string, agency string")
    runs = []
    for text in texts:
        run = []
        for word in text.split() + ["."]:
            if word in STOP_WORDS or not word.isalnum():
                runs.append(run)
                run = []
            else:
                run.append(word)
    runs = [r for r in runs if 2 <= len(r) <= 4]
    degree, freq = Counter(), Counter()
    for r in runs:
        for w in r:
            degree[w] += len(r)
            freq[w] += 1
    best = {}
    for r in runs:
        bag = tuple(sorted(r))
        best[bag] = max(best.get(bag, ""), " ".join(r))
    expected = {p: round(sum(degree[w] / freq[w] for w in p.split()), 6) for p in best.values()}
    got = {r.phrase: r.score for r in rake.phrase_scores(rake.phrases(df)).collect()}
    assert got == pytest.approx(expected)


def test_too_few_long_texts_give_no_phrases(spark):
    df = spark.createDataFrame([("water bridge " * 20, "", "")] * 4, "title string, description string, agency string")
    assert rake.phrases(df).count() == 0
