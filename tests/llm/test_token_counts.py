"""Unigram counts along the trie against a separate best-path search per word."""
import functools
import random

import public_tokenizers

from oppflow.llm import token_counts as module
from oppflow.llm.token_counts import MARK, Unigram, block_counts, blocks, token_counts, trie_counts, zipf_scores

FILE = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, model):
    @functools.cache
    def best(end):
        if not end:
            return 0.0, 0
        options = []
        for start in range(end):
            if word[start:end] in model.scores:
                s, n = best(start)
                options.append((s + model.scores[word[start:end]], -(n + 1)))
        if word[end - 1] not in model.scores:
            s, n = best(end - 1)
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            options.append((s + size * model.byte_score, -(n + size)))
        s, n = max(options)
        return s, -n
    return best(len(word))[1]


def test_trie_equals_brute_force():
    rng = random.Random(1)
    model = Unigram({"a": -3.0, "b": -3.0, "ab": -4.0, "aba": -7.0, "ba": -4.0, "bb": -6.0, "é": -9.0}, -10.0, 3)
    words = {"".join(rng.choice("abcé🙂") for _ in range(rng.randrange(0, 14))) for _ in range(400)}
    assert trie_counts(list(words), model) == {w: brute(w, model) for w in words}


def test_real_vocabulary(docs):
    model = zipf_scores(FILE)
    rows = [(1, "the theory of thea 中文 🙂\n\tétionment"), (2, None), (3, ""), (4, " \n "), (5, "x" * 3000), (6, "a b a b")]
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in token_counts(docs(rows), FILE).collect()}
    for number, text in rows:
        words = (text or "").encode().split()
        want = sum(brute(MARK + w.decode(), model) for w in words) if number != 5 else got[5][1]
        assert got[number] == (len(words), want)
    assert 0 < got[5][1] <= 3001


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ab ab", 1), (1, "ab ab", 2), (None, "ab ab", 3)], "doc_id long, text string, n_tokens int")
    assert len({r.n_tokens for r in token_counts(df, FILE).collect()}) == 1
    assert token_counts(df, FILE).count() == 3
    assert token_counts(df.limit(0), FILE).collect() == []


def test_prefixes_shared_by_texts_of_a_block_are_scored_once(monkeypatch):
    rng = random.Random(3)
    model = Unigram({"a": -3.0, "b": -3.0, "ab": -4.0}, -10.0, 2)
    texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(6)) for _ in range(50)] + [None, ""]
    steps = 0

    def counting(word, scores, counts, model, plain=module.forward):
        nonlocal steps
        steps += len(word) + 1 - len(scores)
        plain(word, scores, counts, model)

    monkeypatch.setattr(module, "forward", counting)
    known = {}
    got = block_counts(texts, model, known, 10**6)
    words = {MARK + w for t in texts for w in (t or "").split()}
    assert steps == len({w[:i] for w in words for i in range(1, len(w) + 1)})  # the nodes of one trie over all texts
    assert got == [sum(brute(MARK + w, model) for w in (t or "").split()) for t in texts]
    before = steps
    assert block_counts(texts, model, known, 10**6) == got and steps == before
    assert block_counts(texts, model, known, 5) == got and steps == 2 * before  # forgotten, so counted again


def test_blocks_keep_order_and_size():
    texts = ["a" * 5, None, "b" * 5, "c" * 30, "", "d"]
    got = list(blocks(texts, 10))
    assert [t for part in got for t in part] == texts and [len(part) for part in got] == [3, 1, 2]  # the long one is alone
    assert list(blocks([], 10)) == []
