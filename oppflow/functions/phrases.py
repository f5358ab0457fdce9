"""Phrase dictionaries as one literal regular expression.

Alternation tries its branches in order at every character, so several hundred
phrases written side by side cost several hundred attempts per character.  The
pattern here branches on one character at a time instead.  Phrases that differ
at a character can never both match there, so only the order *within* one
prefix matters, and that order is kept: the earlier phrase of the list wins.
"""
import re

from pyspark.sql import SparkSession


def load_phrases(spark: SparkSession, path: str) -> list[str]:
    """A dictionary file, one phrase per line, ``#`` starts a comment."""
    lines = (row.value.strip() for row in spark.read.text(path).toLocalIterator())
    return [line for line in lines if line and not line.startswith("#")]


def _branches(phrases: list[str]) -> str:
    # a phrase that ends here beats every later phrase it is a prefix of
    ends = next((i for i, p in enumerate(phrases) if not p), None)
    alive = phrases if ends is None else phrases[:ends]
    by_head: dict[str, list[str]] = {}
    for phrase in alive:
        by_head.setdefault(phrase[0], []).append(phrase[1:])
    parts = [re.escape(head) + _branches(tails) for head, tails in by_head.items()]
    if ends is not None:
        parts.append("")
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"


def phrase_pattern(phrases: list[str]) -> str:
    """A case-insensitive pattern that finds what ``a|b|c`` of the list finds."""
    lowered = [p.lower() for p in dict.fromkeys(phrases) if p]
    if not lowered:
        return r"(?!)"
    return "(?iu)" + _branches(lowered)
