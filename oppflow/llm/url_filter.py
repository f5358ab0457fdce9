"""URL filter by a weighted vocabulary, matched with one Aho-Corasick automaton per task.

A term counts where no ASCII letter or digit touches it, so ``sex`` does not fire in ``essex``.
A url is rejected on one strict term, or when at least ``min_soft`` different soft terms are found
and their weights reach ``min_weight``.  Host rules come before the vocabulary: the longest rule
whose host is the url's host or a parent domain of it, and whose path starts the url's path, decides.

Null urls and urls without ``://`` have an empty host and path, fit no rule and, where they hold no
term, are allowed.  Repeated rows are judged each; other columns of the input are ignored.
"""
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oppflow.llm.shared import lower_ascii

# production vocabulary: terms of adult, gambling, piracy and link-farm sites
STRICT_TERMS = ("porn", "porno", "xxx", "hentai", "camgirls", "escorts", "casino", "warez", "keygen", "malware", "phishing")
SOFT_TERMS = {
    "sex": 1.0, "adult": 0.8, "nude": 1.0, "dating": 0.6, "bet": 0.8, "betting": 1.0, "poker": 1.0, "slots": 0.8,
    "spam": 1.0, "farm": 0.4, "ads": 0.8, "track": 0.6, "tracker": 0.8, "popup": 0.8, "crack": 0.8, "torrent": 0.8,
    "pills": 0.8, "viagra": 1.0, "loan": 0.6, "payday": 0.8, "free": 0.4, "download": 0.4, "click": 0.6, "banner": 0.6,
}


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case; soft terms carry a weight."""
    strict: tuple[str, ...] = STRICT_TERMS
    soft: dict[str, float] = field(default_factory=lambda: dict(SOFT_TERMS))
    min_soft: int = 2
    min_weight: float = 1.2


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(term, (number, len(term)))
    if terms:
        found.make_automaton()
    return found


def _plain(char: str) -> bool:
    return char.isascii() and char.isalnum()


def hits(url: str, search: ahocorasick.Automaton) -> set[int]:
    """Numbers of the terms that stand free in the lower-cased ``url``."""
    seen = set()
    for end, (number, size) in search.iter(url):
        start = end - size + 1
        if number in seen or (start and _plain(url[start - 1])) or (end + 1 < len(url) and _plain(url[end + 1])):
            continue
        seen.add(number)
    return seen


def term_hits(vocabulary: Vocabulary):
    """A column function from lower-cased url to struct (n_strict, n_soft, soft_weight); the automaton is built once per task."""
    strict, soft = list(dict.fromkeys(vocabulary.strict)), dict(vocabulary.soft)
    terms = strict + [t for t in soft if t not in set(strict)]

    @F.pandas_udf("n_strict long, n_soft long, soft_weight double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        search = automaton(terms)
        for urls in batches:
            found = [hits(u, search) if terms and isinstance(u, str) and u else () for u in urls]
            yield pd.DataFrame({
                "n_strict": [sum(i < len(strict) for i in x) for x in found],
                "n_soft": [sum(i >= len(strict) for i in x) for x in found],
                "soft_weight": [float(round(sum(soft[terms[i]] for i in sorted(x) if i >= len(strict)), 6)) for x in found],
            })
    return judge


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: list[HostRule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest comes last and so wins
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def judge_urls(df: DataFrame, rules: list[HostRule], vocabulary: Vocabulary | None = None, key: str = "page_id",
               url: str = "url") -> DataFrame:
    """One row per input row: key, host, path, rule, verdict, n_strict, n_soft, soft_weight."""
    vocabulary = vocabulary or Vocabulary()
    host, path = host_and_path(F.col("u"))
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parts = df.select(F.col(key).alias("k"), F.col(url).alias("u")).select("k", host.alias("host"), path.alias("path"), lower_ascii(F.col("u")).alias("u"))
    rejected = (F.col("n_strict") > 0) | ((F.col("n_soft") >= vocabulary.min_soft) & (F.col("soft_weight") >= vocabulary.min_weight))
    return parts.select("k", "host", "path", term_hits(vocabulary)("u").alias("h")).select("k", "host", "path", "h.*").select(
        F.col("k").alias(key), "host", "path", text.alias("rule"),
        F.coalesce(verdict, F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        "n_strict", "n_soft", "soft_weight",
    )
