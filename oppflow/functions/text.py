"""Text building blocks; every one is a Column expression on a whole text."""
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from oppflow.fixed_values import STOP_WORDS

WORD = r"[\p{L}\p{N}_]"
# three or more word characters that are not all digits
_TOKEN = rf"(?!\p{{Nd}}+(?!{WORD})){WORD}{{3,}}"
# a word made of ASCII letters only
_ALPHA_TOKEN = rf"(?<!{WORD})[a-z]{{3,}}+(?!{WORD})"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, however often that reads it."""
    return F.get(F.transform(F.array(value), use), 0)


def strip(column: Column | str) -> Column:
    """Trim any whitespace, not only spaces."""
    return F.regexp_replace(column, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def strip_long(text: Column) -> Column:
    """``strip`` for whole texts: only one that starts or ends with whitespace is scanned."""
    return bind(
        text,
        lambda t: F.when(
            F.concat(F.left(t, F.lit(1)), F.right(t, F.lit(1))).rlike(r"[\s\p{Z}]"), strip(t)
        ).otherwise(t),
    )


def match_text(title="title", description="description", agency="agency") -> Column:
    """The text keywords are looked up in."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in (title, description, agency)])


def combined_text(title="title", description="description", agency="agency") -> Column:
    """The text terms are mined from; a description that repeats the title is left out."""
    t, d, a = (F.coalesce(F.col(c), F.lit("")) for c in (title, description, agency))
    repeated = F.lower(strip_long(d)) == F.lower(strip(t))
    return strip_long(F.concat_ws(" ", t, F.when(repeated, "").otherwise(d), a))


def tokens(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Lower-case words of three or more characters, no numbers, no stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(stop_words))


def alpha_tokens(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Lower-case purely alphabetic words of three or more letters, no stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(_ALPHA_TOKEN), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(stop_words))


def bigrams(words: Column) -> Column:
    """Neighbouring pairs; the words must be bound or a stored column."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), pairs),
        F.slice(words, F.lit(2), pairs),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def unigrams_and_bigrams(words: Column) -> Column:
    return bind(words, lambda w: F.concat(w, bigrams(w)))


def runs(values: Column) -> Column:
    """Distinct values of an array with their counts, as array<struct<n, term>>.

    Sorting brings equal values together, so one record costs n log n and never
    leaves its row: no explode, no shuffle of every word of the corpus.
    """

    def count(ordered: Column) -> Column:
        positions = F.sequence(F.lit(1), F.size(ordered))
        starts = F.filter(
            positions,
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )
        return bind(
            starts,
            lambda first: F.zip_with(
                first,
                F.concat(
                    F.slice(first, F.lit(2), F.greatest(F.size(first) - 1, F.lit(0))),
                    F.array(F.size(ordered) + 1),
                ),
                lambda here, after: F.struct(
                    (after - here).alias("n"), F.get(ordered, here - 1).alias("term")
                ),
            ),
        )

    empty = F.expr("cast(array() as array<struct<n:int,term:string>>)")
    return bind(
        F.sort_array(values),
        lambda ordered: F.when(F.size(ordered) == 0, empty).otherwise(count(ordered)),
    )


def top_terms(values: Column, k: int) -> Column:
    """The ``k`` most frequent values, ties in alphabetical order."""
    ranked = F.transform(runs(values), lambda r: F.struct((-r["n"]).alias("neg"), r["term"].alias("term")))
    return F.transform(F.slice(F.sort_array(ranked), 1, k), lambda r: r["term"])
