"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased and everything but letters becomes a space; n-grams of 1 to ``max_n``
characters are hashed into ``features`` slots.  Weights are learned by follow-the-regularised-leader
with elastic-net penalties: of ``strengths``, a share ``mix`` of which is the L1 and the rest the L2 penalty, the
strongest is taken whose log loss on a part of the training sample that the weights have not seen is at most
``tolerance`` above the least.  Slots whose weights are all zero are not stored or sent.  A temperature fitted on the same
part turns scores into probabilities.

Document frequencies come from all documents of the training folds, the weights from a sample of at
most ``sample`` labelled documents, spread over the labels.  Learned are the ``labels`` most frequent labels (ties: the
alphabetically first), which bounds the driver's memory however dirty ``lang`` is.  A document is held out where
``crc32(doc_id) mod folds = held_fold``; neither frequencies nor weights see it.

Null texts and texts without a letter are ``und`` with score 0; so is everything where nothing could
be learned.  A null doc_id is not learned from and not held out.  Ties between labels go to the
alphabetically first.  Repeated rows are predicted each; other columns are ignored.  Very long texts are read
whole, in their row.  An empty table gives an empty result.
"""
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    features: int = 2**16
    max_n: int = 3
    sample: int = 3000
    folds: int = 4
    held_fold: int = 2
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    strengths: tuple[float, ...] = (2.0, 0.2, 0.02)
    mix: float = 0.5
    tolerance: float = 0.01
    labels: int = 128
    seed: int = 11


_KINDS: list[np.ndarray] = []


def lower_letters() -> np.ndarray:
    """For code points of the basic plane: themselves where they are letters, a space elsewhere."""
    if not _KINDS:
        _KINDS.append(np.array([c if chr(c).isalpha() else 32 for c in range(0x10000)], dtype=np.uint32))
    return _KINDS[0]


def letters(text: str) -> np.ndarray | None:
    """Code points of the lower-cased text with runs of anything but letters as one space; None without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    known = lower_letters()
    if len(points) and points.max() < 0x10000:
        points = known[points]
    else:  # rare scripts beyond the basic plane
        points = np.array([p if chr(p).isalpha() else 32 for p in points.tolist()], dtype=np.uint32)
    blank = points == 32
    if blank.all():
        return None
    double = blank[1:] & blank[:-1]
    if double.any():
        points = points[np.concatenate(([True], ~double))]
    return points


def gram_counts(text: str, s: Settings) -> tuple[np.ndarray, np.ndarray] | None:
    """(slots, counts) of the hashed n-grams of a text."""
    points = letters(text)
    if points is None:
        return None
    total = np.zeros(s.features, dtype=np.int64)
    shift = np.uint32(32 - (s.features.bit_length() - 1))
    code = np.zeros(len(points), dtype=np.uint32)
    for n in range(1, min(s.max_n, len(points)) + 1):
        code = code[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1:] + np.uint32(n)
        total += np.bincount((code * np.uint32(0x9E3779B1)) >> shift, minlength=s.features)
    slots = np.flatnonzero(total)
    return slots, total[slots]


def training_rows(docs: DataFrame, s: Settings) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % s.folds
    return docs.where(fold.isNotNull() & (fold != s.held_fold) & F.col("text").isNotNull())


def document_frequencies(docs: DataFrame, s: Settings) -> tuple[np.ndarray, int]:
    """Documents per slot over all of ``docs``; at most ``features`` rows reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(s.features, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                found = gram_counts(text, s)
                if found:
                    seen[found[0]] += 1
                    n += 1
        slots = np.flatnonzero(seen)
        yield pd.DataFrame({"slot": np.append(slots, -1), "n": np.append(seen[slots], n)})

    rows = docs.select("text").mapInPandas(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slots, n = rows["slot"].to_numpy(), rows["n"].to_numpy()
    out = np.zeros(s.features)
    out[slots[slots >= 0]] = n[slots >= 0]
    return out, int(n[slots < 0].sum())


def weighed(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of unit length; counts are damped."""
    slots, counts = found
    values = (1 + np.log(counts)) * idf[slots]
    norm = np.sqrt((values * values).sum())
    return slots, values / norm if norm else values


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


class FollowTheLeader:
    """Per-coordinate FTRL-proximal for a softmax, with L1 and L2 penalties."""

    def __init__(self, labels: int, s: Settings, strength: float):
        self.s, self.l1, self.l2 = s, strength * s.mix, strength * (1 - s.mix)
        self.z = np.zeros((s.features, labels))
        self.n = np.zeros((s.features, labels))

    def weights(self, slots) -> np.ndarray:
        z, n, s = self.z[slots], self.n[slots], self.s
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / ((s.beta + np.sqrt(n)) / s.alpha + self.l2)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        slope = softmax(values @ w)
        slope[label] -= 1
        g = values[:, None] * slope[None, :]
        before = self.n[slots]
        after = before + g * g
        self.z[slots] += g - (np.sqrt(after) - np.sqrt(before)) / self.s.alpha * w
        self.n[slots] = after


def log_loss(scores: list[np.ndarray], labels: list[int], t: float) -> float:
    """Mean log loss of the scores at a temperature."""
    if not scores:
        return 0.0
    z = np.array(scores) / t
    z = z - z.max(axis=1, keepdims=True)
    return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(labels)), labels]).mean())


def temperature(scores: list[np.ndarray], labels: list[int]) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm."""
    if not scores:
        return 1.0

    def loss(log_t: float) -> float:
        return log_loss(scores, labels, np.exp(log_t))

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    rows: np.ndarray  # per slot its row of ``weights``; the last row is zero and shared by all slots without weights
    weights: np.ndarray
    temperature: float

    def predict(self, text, s: Settings) -> tuple[str, float]:
        found = gram_counts(text, s) if isinstance(text, str) and self.labels else None
        if not found:
            return UNKNOWN, 0.0
        slots, values = weighed(found, self.idf)
        p = softmax(values @ self.weights[self.rows[slots]] / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


class Sampled(NamedTuple):
    lang: str
    o: int
    slots: np.ndarray
    counts: np.ndarray


def labelled_sample(rows: DataFrame, s: Settings) -> list[Sampled]:
    """At most ``sample`` rows (lang, order, slots, counts), the same share for every label where it has that many.

    They reach the driver as Arrow columns and are read where they are: as Python numbers they take several times the memory.
    """
    common = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(s.labels)
    sizes = {r.lang: r.n for r in common.collect()}
    if not sizes:
        return []
    quota = max(1, s.sample // len(sizes))
    order = F.pmod(F.xxhash64(F.lit(s.seed), F.col("doc_id")), F.lit(2**40))
    limit = F.lit(0.0)
    for lang, n in sizes.items():
        # somewhat more than the share, as the draw is random; what is over is cut below
        limit = F.when(F.col("lang") == lang, min(1.0, (quota + 4 * quota**0.5) / n)).otherwise(limit)

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [gram_counts(t, s) or (None, None) for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "o": batch["o"], "slots": [f[0] for f in found], "counts": [f[1] for f in found]})

    drawn = rows.select("lang", "text", order.alias("o"), limit.alias("limit")).where(F.col("o") < F.col("limit") * 2**40)
    table = drawn.select("lang", "text", "o").mapInPandas(featurise, "lang string, o long, slots array<int>, counts array<int>").where("slots is not null").toArrow()
    found = [
        Sampled(lang.as_py(), o.as_py(), slots.values.to_numpy(), counts.values.to_numpy())
        for lang, o, slots, counts in zip(*(table[c] for c in ("lang", "o", "slots", "counts")), strict=True)
    ]
    out, taken = [], {}
    for row in sorted(found, key=lambda r: (r.o, r.lang)):
        taken[row.lang] = taken.get(row.lang, 0) + 1
        if taken[row.lang] <= quota:
            out.append(row)
    return out


def learn(sample: list, labels: int, s: Settings, strength: float) -> np.ndarray:
    """Weights after ``epochs`` passes over the sample, each in another seeded order."""
    model, rng = FollowTheLeader(labels, s, strength), np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for i in rng.permutation(len(sample)):
            (slots, values), label = sample[i]
            model.learn(slots, values, label)
    return model.weights(slice(None))


def train(docs: DataFrame, s: Settings) -> Model:
    rows = training_rows(docs, s)
    frequencies, n = document_frequencies(rows, s)
    idf = np.log((1 + n) / (1 + frequencies)) + 1
    sample = labelled_sample(rows.where("lang is not null"), s)
    labels = sorted({r.lang for r in sample})
    at = {lang: i for i, lang in enumerate(labels)}
    ready = [(weighed((r.slots, r.counts), idf), at[r.lang]) for r in sample]
    held = [x for i, x in enumerate(ready) if i % 5 == 4]
    learned = [x for i, x in enumerate(ready) if i % 5 != 4]
    truth = [label for _, label in held]
    tried = []
    for strength in sorted(s.strengths, reverse=True):
        weights = learn(learned, len(labels), s, strength)
        scores = [values @ weights[slots] for (slots, values), _ in held]
        t = temperature(scores, truth)
        tried.append((log_loss(scores, truth, t), t, weights))
    least = min(x[0] for x in tried)
    _, t, weights = next(x for x in tried if x[0] <= least + s.tolerance)
    used = np.flatnonzero(weights.any(axis=1))
    at_row = np.full(s.features, len(used), dtype=np.int32)
    at_row[used] = np.arange(len(used))
    return Model(labels, idf, at_row, np.vstack([weights[used], np.zeros((1, len(labels)))]), t)


def predictor(model: Model, spark: SparkSession, s: Settings):
    """A column function from text to struct (lang_pred, score)."""
    shared = spark.sparkContext.broadcast(model)  # bounded by features times labels

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t, s) for t in texts], columns=["lang_pred", "score"])
    return predict


def identify(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    s = s or Settings()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    predict = predictor(train(rows, s), docs.sparkSession, s)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % s.folds == s.held_fold, F.lit(False))
    return rows.select("doc_id", predict("text").alias("p")).select("doc_id", held.alias("held_out"), "p.lang_pred", "p.score")


def recognised(docs: DataFrame, min_score: float = 0.5, s: Settings | None = None) -> DataFrame:
    """The documents, with all their columns, whose language is known with at least ``min_score``."""
    s = s or Settings()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    p = predictor(train(rows, s), docs.sparkSession, s)(docs["text"].cast("string"))
    return docs.where((p["lang_pred"] != UNKNOWN) & (p["score"] >= min_score))
