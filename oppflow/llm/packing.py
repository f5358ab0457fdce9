"""Packing documents into sequences by dynamic programming over cut positions.

Documents keep the order of their file; each is its tokens and a closing id.  The concatenation of a
stretch of documents is cut into windows of at most ``length`` tokens.  A window may end after a
document, after a sentence, or - where a sentence is longer than a window - after any multiple of ``length`` in it.
The cost of a window is its padding plus a penalty if its end truncates a document, higher inside a
sentence.  Padding brings a window to ``length`` unless its size is a power of two, which needs none.

``best[j] = penalty[j] + min(best[i] + padding(at[j] - at[i]))`` over cuts ``i`` less than a window
away.  With linear padding the minimum is that of ``best[i] + at[i]`` over a sliding window, kept in a
monotone queue; the few windows of a power-of-two size are looked up.  So the cost is linear in the
number of cuts.

Each task packs the documents of its partition, in stretches of about ``stretch`` tokens, so memory
does not grow with the data; a stretch ends with a document and at most one window per stretch is short.  A sequence is named by partition and number, and a repeated
task gives the same rows.

Null and empty texts are the closing id alone.  Repeated rows are packed each.  Other columns
are ignored.  An empty table gives an empty result.
"""
import base64
import re
import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTPUT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "padding long")


@dataclass(frozen=True)
class Packing:
    """``sentence_penalty`` and ``word_penalty`` are in tokens of padding."""
    ranks: str
    pattern: str
    length: int = 1024
    closing_id: int = 0
    sentence_penalty: float = 8.0
    word_penalty: float = 64.0
    stretch: int = 400_000
    special_tokens: tuple[tuple[str, int], ...] = ()


class Encoder:
    """Token ids of the public byte-level vocabulary.  The special tokens of the settings are one id each wherever a text holds
    their string; other special strings are ordinary text.

    The pattern's look-ahead only matters where two white spaces follow each other; without it the splitting is
    much faster and, on all other texts, the same.
    """

    def __init__(self, p: Packing):
        with open(p.ranks, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        special = dict(p.special_tokens)
        make = {"mergeable_ranks": ranks, "special_tokens": special}
        self.exact = tiktoken.Encoding("exact", pat_str=p.pattern, **make)
        self.fast = tiktoken.Encoding("fast", pat_str=p.pattern.replace(r"\s+(?!\S)|", ""), **make)
        self.double = re.compile("|".join([r"\s\s", r"\s\Z", *map(re.escape, special)]))
        ends = [i for token, i in ranks.items() if re.search(rb"[.!?][\"')\]]*$|\n", token)]
        self.ends = np.zeros(max([*ranks.values(), *special.values()]) + 2, dtype=bool)
        self.ends[ends] = True

    def __call__(self, text: str) -> list[int]:
        return (self.exact if self.double.search(text) else self.fast).encode(text, allowed_special="all", disallowed_special=())


def cuts_of(ids: np.ndarray, ends: np.ndarray, bounds: np.ndarray, p: Packing) -> tuple[np.ndarray, np.ndarray]:
    """(positions, penalties) of the allowed cuts in a stretch; position 0 is the first, its end the last.

    ``bounds`` are the positions after each document.
    """
    penalty = np.full(len(ids) + 1, -1.0)
    penalty[np.flatnonzero(ends[ids]) + 1] = p.sentence_penalty
    penalty[bounds] = 0.0
    penalty[0] = 0.0
    at = np.flatnonzero(penalty >= 0)
    gaps = np.flatnonzero(np.diff(at) > p.length)
    for i in gaps:
        penalty[np.arange(at[i] + p.length, at[i + 1], p.length)] = p.word_penalty
    if len(gaps):
        at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def padding(size: int, length: int) -> int:
    return 0 if size & (size - 1) == 0 else length - size


def best_cuts(at: list[int], penalty: list[float], length: int) -> list[int]:
    """Indices of the chosen cuts, first and last included."""
    n = len(at)
    best, came = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(float(at[0]), 0)])
    index = {x: i for i, x in enumerate(at)}
    sizes = [2**k for k in range(length.bit_length()) if 2**k <= length]
    for j in range(1, n):
        here = at[j]
        while at[queue[0][1]] < here - length:
            queue.popleft()
        value, i = queue[0]
        value += length - here
        for size in sizes:
            k = index.get(here - size)
            if k is not None and best[k] < value:
                value, i = best[k], k
        best[j], came[j] = value + penalty[j], i
        key = best[j] + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    out = [n - 1]
    while out[-1]:
        out.append(came[out[-1]])
    return out[::-1]


def pack_stretch(ids: np.ndarray, bounds: np.ndarray, ends: np.ndarray, p: Packing) -> list[tuple[int, int, int, int, int]]:
    """(document number, start in it, length, window number, offset in it) of every piece."""
    at, penalty = cuts_of(ids, ends, bounds, p)
    chosen = at[best_cuts(at.tolist(), penalty.tolist(), p.length)]
    borders = np.union1d(chosen, bounds)
    starts = np.concatenate(([0], bounds[:-1]))
    out, window = [], 0
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        if a >= chosen[window + 1]:
            window += 1
        document = bisect_left(bounds, b)
        out.append((document, a - int(starts[document]), b - a, window, a - int(chosen[window])))
    return out


def packed(docs: DataFrame, p: Packing) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its sequence's padding."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first = Encoder(p), TaskContext.get().partitionId() << 40
        names, arrays, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal first
            ids = np.concatenate(arrays)
            bounds = np.cumsum([len(a) for a in arrays])
            pieces = pack_stretch(ids, bounds, encode.ends, p)
            frame = pd.DataFrame(pieces, columns=["document", "start", "length", "window", "offset"])
            used = frame.groupby("window")["length"].sum()
            pads = np.array([padding(int(u), p.length) for u in used])
            at = bounds[frame["document"]] - np.array([len(arrays[d]) for d in frame["document"]]) + frame["start"]
            raw = ids.astype("<u4")
            frame["crc"] = [zlib.crc32(raw[a: a + n].tobytes()) for a, n in zip(at, frame["length"], strict=True)]
            out = pa.RecordBatch.from_arrays([
                pa.array([names[d] for d in frame["document"]], pa.int64()), pa.array(frame["start"], pa.int64()), pa.array(frame["length"], pa.int64()),
                pa.array(frame["crc"], pa.int64()), pa.array([len(arrays[d]) for d in frame["document"]], pa.int64()),
                pa.array(frame["window"] + first, pa.int64()), pa.array(frame["offset"], pa.int64()), pa.array(pads[frame["window"]], pa.int64()),
            ], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padding"])
            first += len(used)
            return out

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(p.closing_id)
                arrays.append(np.array(ids, dtype=np.int64))
                names.append(name.as_py())
                size += len(ids)
                if size >= p.stretch:
                    yield flush()
                    names, arrays, size = [], [], 0
        if size:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(pack, OUTPUT)
