"""Alignment against plain loops over the two public tokenizers."""
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oppflow.llm import token_alignment
from oppflow.llm.queries import alignment_settings, op11_token_alignment
from oppflow.llm.token_alignment import Block, GroupText, aligned_documents, overlaps

TEXTS = ["The tokens of these two differ, don't they?", "naïve café 中文 🙂 ﬁn", "a  b\n\n\tc \r\n", "<|endoftext|> and <s> </s> <unk>", " leading",
         "x" * 700, "mark ▁ inside", "nul \x00 byte", "\xa0\u2003wide", "1234567890" * 5, "é", "\n"]


def byte_of():
    """Byte values of the characters that a byte-level vocabulary is written in."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def brute():
    """Measures of a list of texts, by every pair of tokens."""
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    table = byte_of()

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("\u2581", " ").encode()

    def one(text):
        if not text:
            return None
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        bytes_a = [bytes(table[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [piece(i) for i in b]
        raw = (" " + text).encode()
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            return None
        spans = []
        for parts in (bytes_a, bytes_b):
            at, out = 0, []
            for p in parts:
                out.append((at, at + len(p)))
                at += len(p)
            spans.append(out)
        links = [(x, y) for x, s in zip(a, spans[0], strict=True) for y, t in zip(b, spans[1], strict=True) if s[0] < t[1] and t[0] < s[1]]
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = []
        for low, high in zip([0, *common], common, strict=False):
            groups.append("|".join(",".join(str(i) for i, s in zip(ids, sp, strict=True) if low < s[1] <= high) for ids, sp in ((a, spans[0]), (b, spans[1]))))
        return len(a), len(b), len(groups), links, ";".join(groups)

    def all_of(texts):
        found = [one(t) for t in texts]
        counts = Counter(link for f in found if f for link in set(f[3]))
        highest = {}
        for (x, _), n in counts.items():
            highest[x] = max(highest.get(x, 0), n)
        out = []
        for f in found:
            if f is None:
                out.append((0, 0, 0, 0, 0, 0, ""))
            else:
                n = [counts[link] for link in f[3]]
                best = sum(c == highest[link[0]] for c, link in zip(n, f[3], strict=True))
                out.append((f[0], f[1], f[2], len(f[3]), best, sum(n), hashlib.sha256(f[4].encode()).hexdigest()))
        return out
    return all_of


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


def run(docs, **more):
    return aligned_documents(docs, alignment_settings(**more), lambda g: F.sha2(g, 256)).withColumnRenamed("groups", "groups_sha256")


@pytest.mark.parametrize("block", [2**22, 40])
def test_equals_brute_force(docs, brute, block):
    """Hot, repeated, null, empty and broken texts; a small block makes many blocks a task."""
    texts = TEXTS + [TEXTS[0]] * 5 + [None, "", TEXTS[1]]
    got = rows(run(docs(list(enumerate(texts))), block=block))
    assert got == sorted(((i, *m) for i, m in enumerate(brute(texts))), key=repr)


def test_texts_beside_hot_ones(docs, brute, monkeypatch):
    """With a bound of three hot texts, the others go through the shuffled join."""
    monkeypatch.setattr(token_alignment, "HOT", 3)
    texts = [TEXTS[0]] * 20 + TEXTS
    assert rows(run(docs(list(enumerate(texts))))) == sorted(((i, *m) for i, m in enumerate(brute(texts))), key=repr)


def test_test_tables(spark, brute):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/documents.parquet").where("length(text) < 1500")  # the brute force is quadratic
    plain = table.select("doc_id", "text").collect()
    assert rows(run(table)) == sorted(((r.doc_id, *m) for r, m in zip(plain, brute([r.text for r in plain]), strict=True)), key=repr)
    assert op11_token_alignment(spark, folder).count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_groups_null_ids_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(None, "to be", 1, "x"), (1, "to be", 2, "y"), (1, "no", 3, None)], "doc_id long, text string, n_a int, name string")
    got = aligned_documents(df, alignment_settings()).collect()
    assert len(got) == 3 and {r.groups for r in got if r.doc_id is None} == {r.groups for r in got if r.n_groups == 2}
    assert all(g.count("|") == 1 for r in got for g in r.groups.split(";"))
    assert aligned_documents(df.limit(0), alignment_settings()).collect() == []


def test_random_cuts():
    rng = random.Random(3)
    text = GroupText(60)
    for _ in range(200):
        n = rng.randrange(1, 40)
        ends = [np.array(sorted({*rng.sample(range(1, n + 1), rng.randrange(0, n)), n})) for _ in "ab"]
        ids = [np.array([rng.randrange(60) for _ in e]) for e in ends]
        in_a, in_b, common = overlaps(*ends)
        starts = [np.concatenate(([0], e[:-1])) for e in ends]
        want = [(i, j) for i in range(len(ends[0])) for j in range(len(ends[1]))
                if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
        assert sorted(zip(in_a.tolist(), in_b.tolist(), strict=True)) == want
        groups, low = [], 0
        for high in common:
            groups.append("|".join(",".join(str(x) for x, e in zip(i, s, strict=True) if low < e <= high) for i, s in zip(ids, ends, strict=True)))
            low = high
        assert text(*ids, *ends, common) == ";".join(groups)


def test_block_numbers_pairs_once():
    block = Block(7)
    a = block.add([np.array([5, 9]), np.array([1, 9])], [3, 1])
    b = block.add([np.array([1, 2, 5])], [10])
    known = {c: int(p) for p, c in zip(block.pairs, block.codes, strict=True)}
    assert [[known[c] for c in codes] for codes in a + b] == [[5, 9], [1, 9], [1, 2, 5]]
    assert {known[c]: int(block.rows[c]) for c in known} == {1: 11, 2: 10, 5: 13, 9: 4}
