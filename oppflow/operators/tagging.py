"""Dictionary tagging and per-record key terms; both stay inside the row."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oppflow.fixed_values import EXCLUSIONS, KEY_TERMS_PER_RECORD, STOP_WORDS
from oppflow.functions.phrases import phrase_pattern
from oppflow.functions.text import bigrams, bind, combined_text, match_text, tokens, top_terms


def excluded(text: Column, exclusions: list[str] = EXCLUSIONS) -> Column:
    """True where an exclusion occurs anywhere, also inside a longer word."""
    return text.rlike(phrase_pattern(exclusions))


def keywords_in(text: Column, keywords: list[str]) -> Column:
    """Distinct keywords in order of appearance, lower case, leftmost and non-overlapping."""
    found = F.regexp_extract_all(text, F.lit(phrase_pattern(keywords)), F.lit(0))
    return F.array_distinct(F.transform(found, lambda k: F.lower(k)))


def tag(df: DataFrame, keywords: list[str], exclusions: list[str] = EXCLUSIONS) -> DataFrame:
    """Add ``matched_kw`` and ``keyword_match``; no row is dropped."""
    text = match_text()
    none = F.expr("cast(array() as array<string>)")
    found = F.when(excluded(text, exclusions), none).otherwise(keywords_in(text, keywords))
    return df.withColumn("matched_kw", found).withColumn("keyword_match", F.size("matched_kw") > 0)


def key_terms(text: Column, stop_words: list[str] = STOP_WORDS, k: int = KEY_TERMS_PER_RECORD) -> Column:
    """Up to ``k`` key terms: the most frequent word pairs, or the only word there is.

    With two or more words every single word is part of a pair, and words that are
    part of a pair are not listed on their own.
    """
    return bind(
        tokens(text, stop_words),
        lambda words: F.when(F.size(words) < 2, words).otherwise(top_terms(bigrams(words), k)),
    )


def add_key_terms(df: DataFrame, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    return df.withColumn("key_terms_arr", key_terms(combined_text(), stop_words))
