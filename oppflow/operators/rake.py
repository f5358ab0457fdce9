"""Key phrases of the corpus: runs of two to four words between stop words."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oppflow.fixed_values import MIN_GROUP_ROWS, MIN_PHRASE_TEXT, STOP_WORDS, TOP_PHRASES
from oppflow.functions.text import bind, combined_text
from oppflow.operators.ranking import ranked
from oppflow.session import cut

HOT_WORDS = 100_000  # words whose scores every task holds


def candidate_phrases(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Word runs of one text, two to four words each, as array<string>."""
    marked = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_\s]+", " | "), r"\s+")
    broken = F.transform(marked, lambda w: F.when(w.isin(stop_words), "|").otherwise(w))
    spans = F.transform(F.split(F.array_join(broken, " "), r"\|"), lambda s: F.trim(s))
    return F.filter(
        spans,
        lambda p: (p != "") & F.length(F.translate(p, " ", "")).between(F.length(p) - 3, F.length(p) - 1),
    )


def phrases(rfps: DataFrame, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """``(phrase, n)``: every distinct phrase with its number of occurrences.

    Only texts of 80 characters or more are read, and none where fewer than five
    records have such a text.
    """
    rich = rfps.filter(F.length(combined_text()) >= MIN_PHRASE_TEXT).select(F.lit(1))
    # stops at the first partitions that hold five such records
    enough = len(rich.take(MIN_GROUP_ROWS)) == MIN_GROUP_ROWS
    found = bind(
        combined_text(),
        lambda t: F.when(F.length(t) >= MIN_PHRASE_TEXT, candidate_phrases(t, stop_words)),
    )
    each = rfps.filter(F.lit(enough)).select(F.explode(found).alias("phrase"))
    return each.groupBy("phrase").agg(F.count("*").alias("n"))


def word_scores(counted: DataFrame) -> DataFrame:
    """``(word, freq, score)``: the mean length of the phrases a word occurs in.

    Degree over frequency is that mean, so one aggregation over the distinct
    phrases, weighted by their counts, replaces the co-occurrence matrix.
    """
    split = counted.select("n", F.split("phrase", " ").alias("words"))
    words = split.select("n", F.size("words").alias("len"), F.explode("words").alias("word"))
    return words.groupBy("word").agg(
        F.sum("n").alias("freq"), (F.sum(F.col("n") * F.col("len")) / F.sum("n")).alias("score")
    )


def one_per_bag(counted: DataFrame) -> DataFrame:
    """``(bag, phrase)``: one phrase for every set of words whatever their order, the last alphabetically.

    Phrases of the same words have the same score, so this can come before scoring.  Hardly any phrases share a bag, so
    they are brought together as they are, and sorted once.
    """
    bag = F.array_join(F.sort_array(F.split("phrase", " ")), " ")
    return counted.select(bag.alias("bag"), "phrase").repartition("bag").groupBy("bag").agg(F.max("phrase").alias("phrase"))


def hot_words(scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words of highest frequency, at most ``HOT_WORDS``, and the others; words of one frequency stay together."""
    left, least = HOT_WORDS, None
    for freq, n in scores.groupBy("freq").agg(F.count("*").alias("n")).orderBy(F.desc("freq")).toLocalIterator():
        left -= n
        if left < 0:
            break
        least = freq
    hot = F.lit(False) if least is None else F.col("freq") >= least
    return scores.filter(hot), scores.filter(~hot)


def phrase_scores(counted: DataFrame) -> DataFrame:
    """``(phrase, score)`` for one phrase per bag of words; a phrase sums its words.

    Phrase counts and word scores are written once.  Hot words are looked up and summed where their phrase is; only
    what a phrase has besides them is shuffled, by words that are rare.
    """
    counted = cut(counted)
    hot, rare = hot_words(cut(word_scores(counted)))
    words = one_per_bag(counted).select("bag", "phrase", F.explode(F.split("phrase", " ")).alias("word"))
    met = words.join(F.broadcast(hot.select("word", "score")), "word", "left")
    own = cut(met.groupBy("bag", "phrase").agg(
        F.coalesce(F.sum("score"), F.lit(0.0)).alias("score"), F.count_if(F.col("score").isNull()).alias("rest")
    ).select("phrase", "score", "rest"))
    whole = own.filter("rest = 0").select("phrase", "score")
    rest = own.filter("rest > 0").select("phrase", "score", F.explode(F.split("phrase", " ")).alias("word"))
    looked_up = rest.join(F.broadcast(hot.select("word")), "word", "left_anti").join(
        rare.select("word", F.col("score").alias("more")), "word")
    summed = looked_up.groupBy("phrase").agg((F.max("score") + F.sum("more")).alias("score"))
    return whole.unionByName(summed).select("phrase", F.round("score", 6).alias("score"))


def top_phrases(rfps: DataFrame, stop_words: list[str] = STOP_WORDS, k: int = TOP_PHRASES) -> DataFrame:
    scores = phrase_scores(phrases(rfps, stop_words))
    return ranked(scores, [F.desc("score"), F.desc("phrase")], k)
