"""How two tokenizers cut the same texts: exact-text deduplication, one alignment per distinct text.

1. Rows are shuffled by their full text; a distinct text keeps its number of rows and a SHA-256 as its name.
2. Each distinct text is tokenised by both tokenizers and aligned once.  Byte offsets where tokens of both end cut the tokens
   into groups; every stretch between two neighbouring ends of either side is one link, the overlap of one token of
   each.  A task gathers texts into blocks of bounded size and numbers a block's distinct id pairs, so a text keeps
   its links as small numbers and a block gives on every pair once, with the rows that hold it.
3. Pair counts over the corpus are added up from blocks, weighted by multiplicity, and the highest count of each first id taken.
4. A block's texts and its pairs' corpus counts meet in a co-group and give the measures of each text, which are joined to rows
   by name.  Texts that hold more than a thousandth of the rows are at most a thousand and are sent to every task instead,
   so no row of a hot text is shuffled to one place.

The first tokenizer reads a space and the text, the second the text, to which it adds the space itself.  Strings of special tokens
inside a text are plain text.  A text is without tokens - all measures 0, groups '' - if it is null or empty, or if the
tokens of either side do not join to a space and the text.

A row is a document, whether its id is null or repeated; rows with the same text get the same measures.  Very long texts are
aligned whole; memory grows with the longest text and the block.  Ties for the highest count all count.  Other columns
are ignored.  An empty table gives an empty result.
"""
import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oppflow.llm.packing import Encoder, Packing
from oppflow.session import cut

ALIGNED = ("block long, name binary, m long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary, "
           "code int, pair long, rows long")
HOT = 1000  # a text with more than 1 / HOT of the rows is sent to every task; there are at most HOT of them


@dataclass(frozen=True)
class Tokenizers:
    """``ranks`` and ``pattern`` of the byte-level side, ``pieces`` of the piece side; ``block`` bounds the distinct links of a block's texts."""
    ranks: str
    pattern: str
    pieces: str
    block: int = 2**22


class ByteSide:
    """Ids of a space and the text, and the length in bytes of every id."""

    def __init__(self, t: Tokenizers):
        self.encode = Encoder(Packing(ranks=t.ranks, pattern=t.pattern))
        with open(t.ranks, "rb") as file:
            known = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
        self.bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [self.encode(" " + text) for text in texts]


class PieceSide:
    """Ids of the text with the space that the model adds, and the bytes of every piece."""

    def __init__(self, t: Tokenizers):
        self.model = sentencepiece.SentencePieceProcessor(model_file=t.pieces)
        n = self.model.get_piece_size()
        self.bytes = [self.of(i) for i in range(n)]
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)

    def of(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token, second token) of every link, and the common ends of two cuts of the same bytes."""
    both = np.sort(np.concatenate((ends_a, ends_b)), kind="stable")
    twice = both[1:] == both[:-1]
    ends = both[np.concatenate((~twice, [True]))]
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends), both[1:][twice]


class GroupText:
    """Groups as ``a1,a2|b1;a3|b2,b3``: the tokens of both sides in writing order, each with the sign after it."""

    def __init__(self, ids: int):
        self.signed = [f"{i}{sign}" for i in range(ids) for sign in ",|;"]

    def __call__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, common: np.ndarray) -> str:
        last_a, last_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
        sign_a, sign_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        sign_a[last_a], sign_b[last_b] = 1, 2
        # before a token stand the groups before its own, and of its own the earlier tokens and, for the second side, the first side
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        to_b, to_a = np.concatenate(([0], last_b + 1)), last_a + 1
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + to_b[group_a]] = a * 3 + sign_a
        order[np.arange(len(b)) + to_a[group_b]] = b * 3 + sign_b
        return "".join(map(self.signed.__getitem__, order.tolist()))[:-1]


class Block:
    """Distinct id pairs of the texts gathered so far, numbered as they come, and the rows that hold each."""

    def __init__(self, number: int):
        self.number, self.links = number, 0
        self.pairs = self.codes = np.zeros(0, dtype=np.int64)  # sorted pairs and the number of each
        self.rows = np.zeros(0, dtype=np.int64)  # by number

    def add(self, texts: list[np.ndarray], times: list[int]) -> list[np.ndarray]:
        """The numbers of each text's distinct pairs."""
        new = np.setdiff1d(np.concatenate(texts), self.pairs)
        if len(new):
            known = np.concatenate((self.pairs, new))
            codes = np.concatenate((self.codes, np.arange(len(self.codes), len(known))))
            order = np.argsort(known, kind="stable")
            self.pairs, self.codes = known[order], codes[order]
            self.rows = np.concatenate((self.rows, np.zeros(len(new), dtype=np.int64)))
        out = []
        for pairs, m in zip(texts, times, strict=True):
            codes = self.codes[np.searchsorted(self.pairs, pairs)]
            self.rows[codes] += m
            self.links += len(codes)
            out.append(codes)
        return out

    def given_on(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.pairs), 50_000):
            pairs, codes = self.pairs[at: at + 50_000], self.codes[at: at + 50_000]
            yield batch_of(len(pairs), block=[self.number] * len(pairs), code=codes.astype(np.int32), pair=pairs, rows=self.rows[codes])


_TYPES = {"block": pa.int64(), "name": pa.binary(), "m": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
          "groups": pa.string(), "links": pa.binary(), "code": pa.int32(), "pair": pa.int64(), "rows": pa.int64()}


def batch_of(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in _TYPES.items()], names=list(_TYPES))


def packed_links(codes: np.ndarray, times: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    order = np.argsort(codes)
    steps = np.diff(codes[order], prepend=0)
    return packer.compress(np.concatenate((steps, times[order])).astype("<u4").tobytes())


def unpacked_links(links: bytes, unpacker: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray]:
    steps, times = np.frombuffer(unpacker.decompress(links), dtype="<u4").astype(np.int64).reshape(2, -1)
    return np.cumsum(steps), times


CHUNK = 128  # texts tokenised at a time


def alignments(texts: DataFrame, t: Tokenizers) -> DataFrame:
    """ALIGNED: a row per text (name, text, m) whose tokens join to it, and a row per pair of a block, whose name is null."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, packer = ByteSide(t), PieceSide(t), zstandard.ZstdCompressor(level=3)
        text_of = GroupText(max(len(first.bytes), len(second.bytes)))
        number = TaskContext.get().partitionId() << 32
        block = Block(number)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                names, texts, times = (c.to_pylist() for c in batch.slice(at, CHUNK).columns)
                rows, distinct, repeats = [], [], []
                for name, text, m, ids_a, ids_b in zip(names, texts, times, first(texts), second(texts), strict=True):
                    raw = b" " + text.encode("utf-8", "surrogatepass")
                    if b"".join(map(first.bytes.__getitem__, ids_a)) != raw or b"".join(map(second.bytes.__getitem__, ids_b)) != raw:
                        continue
                    a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
                    ends_a, ends_b = np.cumsum(first.lengths[a]), np.cumsum(second.lengths[b])
                    in_a, in_b, common = overlaps(ends_a, ends_b)
                    pairs, n = np.unique((a[in_a] << 32) | b[in_b], return_counts=True)
                    distinct.append(pairs)
                    repeats.append(n)
                    rows.append((name, m, len(a), len(b), len(common), len(in_a), text_of(a, b, ends_a, ends_b, common)))
                if not rows:
                    continue
                codes = block.add(distinct, [r[1] for r in rows])
                columns = dict(zip(("name", "m", "n_a", "n_b", "n_groups", "n_links", "groups"), map(list, zip(*rows, strict=True)), strict=True))
                links = [packed_links(c, n, packer) for c, n in zip(codes, repeats, strict=True)]
                yield batch_of(len(rows), block=[block.number] * len(rows), links=links, **columns)
                if block.links >= t.block:
                    yield from block.given_on()
                    number += 1
                    block = Block(number)
        yield from block.given_on()

    return texts.select("name", "text", "m").mapInArrow(align, ALIGNED)


def block_measures(texts: DataFrame, priced: DataFrame) -> DataFrame:
    """The texts of every block with n_best and count_sum, from the corpus counts of the block's pairs."""
    keep = ["name", "m", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def measure(texts: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        unpacker = zstandard.ZstdDecompressor()
        count, best = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=bool)
        count[pairs["code"]], best[pairs["code"]] = pairs["n"], pairs["best"]
        out = texts[keep].copy()
        linked = [unpacked_links(x, unpacker) for x in texts["links"]]
        out["n_best"] = [int(times[best[codes]].sum()) for codes, times in linked]
        out["count_sum"] = [int((times * count[codes]).sum()) for codes, times in linked]
        return out

    schema = "name binary, m long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    return texts.groupBy("block").cogroup(priced.groupBy("block")).applyInPandas(measure, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): rows that hold an id pair linked, and whether no other pair of its first id has more."""
    counts = cut(aligned.where("name is null").groupBy("pair").agg(F.sum("rows").alias("n")))
    first = F.shiftright("pair", 32).alias("first")
    # one row per id of the first vocabulary
    highest = F.broadcast(counts.groupBy(first).agg(F.max("n").alias("most")))
    return counts.withColumn("first", first).join(highest, "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned_documents(docs: DataFrame, t: Tokenizers, groups: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``groups`` says what is kept of a text's groups, which are several times as long as the text; '' stays ''.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    name = F.unhex(F.sha2("text", 256)).alias("name")
    texts = rows.where("text <> ''").groupBy("text").agg(F.count("*").alias("m")).select(name, "text", "m")
    aligned = cut(alignments(texts, t).withColumn("groups", groups(F.col("groups"))))
    priced = aligned.where("name is null").select("block", "code", "pair").join(pair_counts(aligned), "pair").select(
        F.col("block").alias("block"), F.col("code").alias("code"), "n", "best")  # named anew, as both sides of the co-group come from one table
    measured = cut(block_measures(aligned.where("name is not null"), priced))

    total = aligned.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("s")).first().s
    hot = F.col("m") * HOT > F.lit(total)
    shown = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    named = rows.select("doc_id", F.when(F.col("text") != "", name).alias("name"))
    near = F.broadcast(measured.where(hot).select(F.col("name").alias("hot_name"), F.struct(*shown, "groups").alias("h")))
    named = named.join(near, F.col("name") == F.col("hot_name"), "left")
    # rows that need nothing more look for a name that no text has, each its own
    spare = F.concat(F.lit("-").cast("binary"), F.monotonically_increasing_id().cast("string").cast("binary"))
    named = named.withColumn("name", F.when(F.col("h").isNotNull() | F.col("name").isNull(), spare).otherwise(F.col("name")))
    rest = measured.where(~hot).select("name", F.struct(*shown, "groups").alias("r"))
    both = named.join(rest, "name", "left").withColumn("x", F.coalesce("h", "r"))
    return both.select("doc_id", *(F.coalesce(f"x.{c}", F.lit(0)).cast("long").alias(c) for c in shown), F.coalesce("x.groups", F.lit("")).alias("groups"))
