"""Packing: exact round trip, contract of the pieces, and cuts against a quadratic dynamic program."""
import random
import zlib
from collections import defaultdict
from dataclasses import replace

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from oppflow.llm.packing import Encoder, best_cuts, packed, padding
from oppflow.llm.queries import contract_packing, packing_settings

SETTINGS = packing_settings()


def cost(at, penalty, cuts, length):
    return sum(padding(at[b] - at[a], length) + penalty[b] for a, b in zip(cuts, cuts[1:]))


def slow_best(at, penalty, length):
    best = [0.0] + [float("inf")] * (len(at) - 1)
    for j in range(1, len(at)):
        best[j] = min(best[i] + padding(at[j] - at[i], length) + penalty[j] for i in range(j) if at[j] - at[i] <= length)
    return best[-1]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_the_cheapest(seed):
    rng = random.Random(seed)
    length = rng.choice([8, 16, 64])
    at = [0]
    for _ in range(rng.randrange(1, 60)):
        at.append(at[-1] + rng.randrange(1, length + 1))
    penalty = [float(rng.choice([0, 0, 2, 9])) for _ in at]
    cuts = best_cuts(at, penalty, length)
    assert cuts[0] == 0 and cuts[-1] == len(at) - 1 and all(at[b] - at[a] <= length for a, b in zip(cuts, cuts[1:]))
    assert cost(at, penalty, cuts, length) == slow_best(at, penalty, length)


def texts():
    rng = random.Random(4)
    words = ["Is", "thea", "nonde.", "ör", "émen!", "\n", "  two", "12.5", "🙂", "don't"]
    made = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 5, 60, 400, 900, 2500, 30, 7, 80)]
    return [None, "", " ", "a\n\n b ", "x" * 9000, "<|endoftext|> here", *made]


def test_round_trip(docs):
    rows = list(enumerate(texts()))
    small = replace(SETTINGS, stretch=3000)
    pieces = packed(docs(rows, parts=2), small).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for number, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for p in sorted(by_doc.pop(number), key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at: at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert not by_doc
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= 1024 and {p.padding for p in members} == {padding(at, 1024)}


def test_order_and_little_padding(docs):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["thea", "ond.", "ing", "er,"]) for _ in range(rng.choice([20, 200, 900])))) for i in range(300)]
    pieces = packed(docs(rows, parts=1), SETTINGS).collect()
    order = [p.doc_id for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset))]
    first = list(dict.fromkeys(order))
    assert order == sorted(order, key=first.index)  # a document's pieces follow each other
    pads = {p.sequence_id: p.padding for p in pieces}
    assert sum(pads.values()) < 0.03 * sum(p.length for p in pieces)


def test_null_ids_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b")], "doc_id long, text string")
    assert len(packed(df, SETTINGS).collect()) == 3
    assert packed(df.limit(0), SETTINGS).collect() == []


def test_both_splittings_agree():
    encode, tokenizer = Encoder(SETTINGS), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    for text in [t for t in texts() if t] + ["a ", " a", "a\n", "a b", "a  b", "\t", "a  ", "\r\nb"]:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


SPECIAL = ["a<|endoftext|>b", "<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>\n\n<|endoftext|>  b ", "<|endoftext|><|endoftext|>", "<|endoftext|", "x\n<|endoftext|>" * 3]


def test_special_token_of_the_vocabulary(docs):
    """What op6_packing and the pipeline pack with gives the ids of byte_bpe_50k.json as it is."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [tokenizer.encode(text, add_special_tokens=False).ids for text in SPECIAL]
    assert want[0] == [64, 50256, 65]
    encode = Encoder(contract_packing())
    assert [encode(text) for text in SPECIAL] == want
    for text in (t for t in texts() if t):
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
    pieces = packed(docs(list(enumerate(SPECIAL))), contract_packing()).collect()
    for p in pieces:
        ids = np.array([*want[p.doc_id], 0], dtype="<u4")
        assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start: p.start + p.length].tobytes())
    assert sum(p.length for p in pieces) == sum(len(ids) + 1 for ids in want)
