"""Token counts of a unigram tokenizer, by dynamic programming shared along a trie of pre-tokens.

A text is split at white space; each word with a leading word mark is a pre-token.  A Python worker gathers the distinct
pre-tokens of a block of texts that it does not know yet and walks their trie in sorted order: the stack holds
the forward scores of the current path, so a prefix that words of the block share is scored once, and a node that ends a
pre-token stores its number of tokens.  Counting a text is then a look-up per word.  A block is texts of one Arrow batch
of at most ``block`` characters together, or one longer text.  Known counts are kept
from task to task of the worker, up to ``memory`` pre-tokens, and then forgotten, so memory is bounded by
that, the block and the largest text; a new worker counts afresh.

The forward score of a prefix is the best sum of piece scores over all ways to cut it; ties take fewer
tokens.  A character that no piece covers becomes its UTF-8 bytes.  Scores come from the public
vocabulary, whose pieces are ranked by frequency: log probability by Zipf's law over the ranks.

Null and empty texts count 0.  Repeated rows are counted each; other columns are ignored.
"""
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache, cached_property
from os.path import commonprefix

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"

@dataclass(frozen=True)
class Unigram:
    """Piece scores; ``byte_score`` is that of one byte of an uncovered character."""
    scores: dict[str, float]
    byte_score: float
    longest: int = field(default=0)

    @cached_property
    def endings(self) -> dict[str, float]:
        """Every ending of a piece with its score, minus infinity if it is no piece itself.

        Read backwards from one position, the pieces that end there lie on one path; it stops at the first text that is no ending.
        """
        out = {piece[i:]: -math.inf for piece in self.scores for i in range(len(piece))}
        out.update(self.scores)
        return out


def zipf_scores(model_file: str) -> Unigram:
    """Scores from the ranks of a public piece vocabulary."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    scores = {piece: -math.log(r) - total for r, piece in enumerate(pieces, 1)}
    return Unigram(scores, -math.log(len(pieces)) - total, max(map(len, pieces), default=1))


@cache
def remembered(model_file: str) -> tuple[Unigram, dict[bytes, int]]:
    """The scores and the known counts of this Python worker."""
    return zipf_scores(model_file), {}


def forward(word: str, scores: list[float], counts: list[int], model: Unigram) -> None:
    """Extend the forward scores of a prefix to all of ``word``; position i is the prefix of i characters."""
    known, byte, endings = model.scores, model.byte_score, model.endings
    for end in range(len(scores), len(word) + 1):
        char = word[end - 1]
        best, n = -math.inf, 0
        for start in range(end - 1, -1, -1):
            score = endings.get(word[start:end])
            if score is None:
                break
            score += scores[start]
            if score > best or (score == best and counts[start] + 1 < n):
                best, n = score, counts[start] + 1
        if char not in known:
            size = len(char.encode("utf-8", "surrogatepass"))
            score = scores[end - 1] + size * byte
            if score > best or (score == best and counts[end - 1] + size < n):
                best, n = score, counts[end - 1] + size
        scores.append(best)
        counts.append(n)


def trie_counts(words: list[str], model: Unigram) -> dict[str, int]:
    """Tokens of each word; the words' trie is walked depth first, which is their sorted order."""
    out: dict[str, int] = {}
    scores, counts, before = [0.0], [0], ""
    for word in sorted(words):
        depth = len(commonprefix((before, word)))
        del scores[depth + 1:], counts[depth + 1:]
        forward(word, scores, counts, model)
        out[word] = counts[-1]
        before = word
    return out


def blocks(texts: Iterable, size: int) -> Iterator[list]:
    """Texts in order, at most ``size`` characters together; a longer text is a block of its own."""
    out, held = [], 0
    for text in texts:
        n = len(text) if isinstance(text, str) else 0
        if out and held + n > size:
            yield out
            out, held = [], 0
        out.append(text)
        held += n
    if out:
        yield out


def block_counts(texts: list, model: Unigram, known: dict[bytes, int], memory: int) -> list[int]:
    """Tokens of each text; what the block's words add is learned in one walk of their trie."""
    # bytes split at the ASCII white space alone
    split = [text.encode("utf-8", "surrogatepass").split() if isinstance(text, str) else [] for text in texts]
    distinct = set().union(*split)
    if len(known) > memory:
        known.clear()
    plain = {w: MARK + w.decode("utf-8", "surrogatepass") for w in distinct.difference(known)}
    counted = trie_counts(list(plain.values()), model)
    known.update((w, counted[p]) for w, p in plain.items())
    return [sum(map(known.__getitem__, words)) for words in split]


def counter(model_file: str, memory: int = 600_000, block: int = 2**21):
    """A column function from text to its number of tokens."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, known = remembered(model_file)
        for texts in batches:
            out = [n for part in blocks(texts, block) for n in block_counts(part, model, known, memory)]
            yield pd.Series(out, dtype="int64")
    return count


def token_counts(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_pretokens, n_tokens."""
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    words = F.coalesce(F.regexp_count("t", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return rows.select(F.col("k").alias(key), words.alias("n_pretokens"), counter(model_file)("t").alias("n_tokens"))
