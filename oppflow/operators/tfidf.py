"""Term weights over the corpus.

The text is read once: its words are written as a table.  One pass over them counts terms; only
term totals are shuffled.  A second weighs documents with a vocabulary of at most 5000 terms, which
every task holds, so a document is weighed and normalised inside its row.  That pass adds each weight
to the sums of all its groups (the corpus, its state, its source, ...) at once; one vector per group
and task is shuffled, and every section of a report is read off the resulting table of sums.
"""
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oppflow.fixed_values import (
    MAX_DOCUMENT_SHARE, MIN_DOCUMENTS_PER_TERM, MIN_GROUP_ROWS, STOP_WORDS, TOP_TERMS,
    TOP_TERMS_PER_GROUP, VOCABULARY_SIZE,
)
from oppflow.functions.text import alpha_tokens, combined_text, runs, unigrams_and_bigrams
from oppflow.operators.ranking import ranked, top_per_group
from oppflow.session import cut, cut_in_tasks, small_tasks

CORPUS = "corpus"  # the group of all documents
TASK_ROWS = 5000  # documents whose distinct terms a task holds; twice as many at most


def with_terms(rfps: DataFrame, stop_words: list[str] = STOP_WORDS, *keep: str) -> DataFrame:
    """Add ``terms``: words and word pairs of the combined text."""
    terms = unigrams_and_bigrams(alpha_tokens(combined_text(), stop_words))
    return small_tasks(rfps, TASK_ROWS).select(*keep, terms.alias("terms"))


def read_once(rfps: DataFrame, stop_words: list[str] = STOP_WORDS, *keep: str) -> DataFrame:
    """``with_terms`` over words that are written once; pairs are formed again wherever they are read."""
    words = cut(rfps.select(*keep, alpha_tokens(combined_text(), stop_words).alias("words")))
    return small_tasks(words, TASK_ROWS).select(*keep, unigrams_and_bigrams(F.col("words")).alias("terms"))


def _totals(docs: DataFrame) -> DataFrame:
    """``(term, tf, df)`` over all documents, one shuffle of term totals.

    A document becomes two rows, all its terms and its distinct terms, so both
    totals come from the same partial aggregation.
    """
    lists = F.array(
        F.struct(F.col("terms").alias("t"), F.lit(0).alias("doc")),
        F.struct(F.array_distinct("terms").alias("t"), F.lit(1).alias("doc")),
    )
    each = docs.select(F.inline(lists)).select("doc", F.explode("t").alias("term"))
    return each.groupBy("term").agg(F.sum(1 - F.col("doc")).alias("tf"), F.sum("doc").alias("df"))


def _tasks(docs: DataFrame) -> int:
    """Shuffle tasks for what the documents hold, as many documents to each as a task reads before the shuffle."""
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-docs.select(F.lit(1)).count() // TASK_ROWS))


def term_counts(docs: DataFrame) -> DataFrame:
    """``(term, tf, df)`` over all documents, written once."""
    return cut_in_tasks(_totals(docs), _tasks(docs))


def vocabulary(docs: DataFrame, n_docs: Column | int) -> DataFrame:
    """``(term, tf, df, idf)`` of the terms that are kept, at most 5000, written once."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    kept = _totals(docs).filter(
        (F.col("df") >= MIN_DOCUMENTS_PER_TERM) & (F.col("df") <= n * MAX_DOCUMENT_SHARE)
    )
    top = kept.orderBy(F.desc("tf"), "term").limit(VOCABULARY_SIZE)
    return cut_in_tasks(top.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1), _tasks(docs))


@dataclass
class TfidfModel:
    """A fitted vocabulary; ``terms`` and ``idf`` have at most 5000 entries."""

    spark: SparkSession
    terms: list[str]
    idf: list[float]
    n_docs: int

    def weigh(self, docs: DataFrame) -> DataFrame:
        """Add ``weight``: counts times idf, scaled to length one; drops ``terms``."""
        if not self.terms:
            raise ValueError("empty vocabulary")
        counts = CountVectorizerModel.from_vocabulary(self.terms, "terms", "_counts")
        scale = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="_counts", outputCol="_scaled"
        )
        unit = Normalizer(inputCol="_scaled", outputCol="weight", p=2.0)
        return unit.transform(scale.transform(counts.transform(docs))).drop("_counts", "_scaled", "terms")

    def sums(self, docs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """``(section, value, n, total)``: documents and summed weights of the corpus and of every group.

        ``section`` is ``corpus`` or a column of ``by``; records without a value are in no group of that column.
        Sums are formed map-side, so a group that holds a third of all documents sends one vector per task like any
        other, and a task sends as many vectors as the columns have values, not as there are combinations of them.
        """
        if not self.terms:
            return self.spark.createDataFrame([], "section string, value string, n bigint, total array<double>")
        groups = F.array(
            F.struct(F.lit(CORPUS).alias("section"), F.lit("").alias("value")),
            *[F.struct(F.lit(c).alias("section"), F.col(c).cast("string").alias("value")) for c in by],
        )
        member = self.weigh(docs.select("terms", F.filter(groups, lambda g: g["value"].isNotNull()).alias("groups")))
        each = member.select("weight", F.inline("groups"))
        summed = each.groupBy("section", "value").agg(F.count("*").alias("n"), Summarizer.sum(F.col("weight")).alias("total"))
        return summed.withColumn("total", vector_to_array("total"))

    def mean_scores(self, docs: DataFrame, by: str | None = None) -> DataFrame:
        """``([by,] n, term, score)``: mean weight over all documents, or over those of each group."""
        return Weighing(self, self.sums(docs, [by] if by else [])).scores(by)


@dataclass
class Weighing:
    """A weighed corpus: its vocabulary and its few sums."""

    model: TfidfModel
    sums: DataFrame

    def scores(self, by: str | None = None) -> DataFrame:
        """``([by,] n, term, score)`` of the corpus, or of the groups of one column."""
        names = F.split(F.lit("\n".join(self.model.terms)), "\n")
        own = self.sums.filter(F.col("section") == (by or CORPUS))
        each = own.select("value", "n", F.inline(F.arrays_zip(names.alias("term"), F.col("total").alias("total"))))
        group = [F.col("value").alias(by)] if by else []
        return each.select(*group, "n", "term", (F.col("total") / F.col("n")).alias("score"))


def fit(docs: DataFrame) -> TfidfModel:
    """Count the corpus and bring its vocabulary (at most 5000 rows) to the driver."""
    n_docs = docs.select(F.lit(1)).count()
    rows = vocabulary(docs, n_docs).select("term", "idf").orderBy("term").collect()
    return TfidfModel(docs.sparkSession, [r.term for r in rows], [r.idf for r in rows], n_docs)


def weigh_once(docs: DataFrame, by: Sequence[str] = ()) -> Weighing:
    """Fit and weigh; the sums are written once, whatever number of sections reads them."""
    model = fit(docs)
    return Weighing(model, cut(model.sums(docs, by)))


def weights(docs: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    """The same weights as rows ``(key, term, weight)`` for a given vocabulary table.

    Terms are counted inside the row; the vocabulary (at most 5000 rows) is broadcast.  The rows of a document are
    brought together once more, as a key may have several; in tasks of a bounded number of documents.
    """
    counted = docs.select(key, F.inline(runs(F.col("terms"))))
    raw = counted.join(F.broadcast(vocab.select("term", "idf")), "term").select(
        key, "term", (F.col("n") * F.col("idf")).alias("raw")
    ).repartition(_tasks(docs), key)
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("raw") / norm).alias("weight"))


def _score(score: str = "score") -> Column:
    return F.round(F.col(score), 6)


def corpus_scores(scores: DataFrame) -> DataFrame:
    """``(term, score)``, rounded."""
    return scores.select("term", _score().alias("score"))


def top_corpus_terms(scores: DataFrame, k: int = TOP_TERMS) -> DataFrame:
    return ranked(scores.select("term", "score"), [F.desc("score"), F.asc("term")], k)


def top_group_terms(scores: DataFrame, by: str, k: int = TOP_TERMS_PER_GROUP) -> DataFrame:
    """Top terms of every group of five or more records.  ``scores([by], n, term, score)``."""
    kept = scores.filter((F.col("n") >= MIN_GROUP_ROWS) & (F.col("score") > 0)).withColumn("score", _score())
    return top_per_group(kept, [by], [F.desc("score"), F.asc("term")], k)


def matched_versus_rest(means: DataFrame, k: int = TOP_TERMS_PER_GROUP) -> DataFrame:
    """Terms whose mean differs most between matched and unmatched records.  ``means`` by ``keyword_match``."""
    both = means.groupBy("term").agg(
        *[
            F.max(F.when(F.col("keyword_match") == side, F.col(col))).alias(f"{col}_{side}")
            for side in ("true", "false")
            for col in ("n", "score")
        ]
    )
    diff = both.filter(
        (F.col("n_true") >= MIN_GROUP_ROWS) & (F.col("n_false") >= MIN_GROUP_ROWS)
    ).select("term", F.round(F.col("score_true") - F.col("score_false"), 6).alias("diff"))
    enriched = ranked(diff.filter("diff > 0"), [F.desc("diff"), F.asc("term")], k)
    depleted = ranked(diff.filter("diff < 0"), [F.asc("diff"), F.asc("term")], k)
    return enriched.select(F.lit("matched").alias("side"), "rank", "term", "diff").unionByName(
        depleted.select(F.lit("unmatched").alias("side"), "rank", "term", "diff")
    )
