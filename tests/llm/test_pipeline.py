"""The pipeline stage by stage on the smallest tables, and the queries' registration."""
import inspect
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from check import rows
from oppflow.llm.queries import ORACLES, QUERIES
from test_near_dedup import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage gets and gives."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        result.write.parquet(f"{folder}/{name}")
        out[name] = (docs, spark.read.parquet(f"{folder}/{name}"))
        docs = out[name][1]
    return out


def test_stages_keep_the_columns(stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns


def test_language_stage_keeps_clean_documents(stages):
    before, after = stages["language_id"]
    clean = {r.doc_id for r in before.collect() if r.text and sum(c.isalpha() for c in r.text) > 40}
    assert len(clean - {r.doc_id for r in after.collect()}) <= 0.02 * len(clean)


def test_dedup_stage_equals_all_pairs(stages):
    before, after = stages["near_dedup"]
    want = {i for i, (_, _, kept) in brute([(r.doc_id, r.text) for r in before.collect()], 5).items() if kept}
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)


def test_pii_stage(stages):
    before, after = stages["pii"]
    old, new = ({r.doc_id: r.text for r in x.collect()} for x in (before, after))
    assert old.keys() == new.keys()
    assert not any("@mail" in t and ".example.com" in t and t == old[i] for i, t in new.items())


def test_mixing_stage(stages):
    before, after = stages["source_mix"]
    texts = {r.doc_id: r.text for r in before.collect()}
    got = after.collect()
    assert all(texts[r.doc_id] == r.text for r in got) and max(Counter(r.doc_id for r in got).values()) <= 2


def test_packing_stage(stages):
    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = before.collect()
    pieces = defaultdict(Counter)
    for p in after.collect():
        pieces[p.doc_id][p.start, p.length, p.ids_crc32] += 1
    for i, n in Counter(r.doc_id for r in docs).items():
        ids = np.array([*tokenizer.encode(next(r.text for r in docs if r.doc_id == i) or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert sum(length * c for (_, length, _), c in pieces[i].items()) == n * len(ids)
        assert all(zlib.crc32(ids[a: a + length].tobytes()) == crc for a, length, crc in pieces[i])


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == stages["packing"][1].columns
    assert got.select("length").groupBy().sum().first()[0] == stages["packing"][1].select("length").groupBy().sum().first()[0]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(FOLDER):
        db.execute(f"create view {file.split('.')[0]} as select * from '{FOLDER}/{file}'")
    df = QUERIES[name](spark, FOLDER)
    cursor = db.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())


def test_registration():
    names = entry.queries()
    assert [n for n in names if n.startswith("op")] == list(QUERIES) and names["pipeline"] is corpus_pipeline.run
    assert all(list(inspect.signature(f).parameters)[:1] == ["spark"] for f in QUERIES.values())
