"""State with commit records: lost and repeated runs, late records, syncs, damaged snapshots."""
import itertools
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oppflow.operators import dashboard, preferences
from oppflow.plans import ingest
from oppflow.plans.preference_sync import PreferenceStore, sync
from oppflow.sources import api, pages, store
from oppflow.sources.commits import BucketState, Commits, DatedMemory
from oppflow.streaming import jobs

RAW = "state string, source string, id string, title string, agency string, description string, pos bigint"


def at(text):
    return F.lit(text).cast("timestamp")


def raw(spark, *titles):
    return spark.createDataFrame([("TX", "s", str(i), t, "a", "", i) for i, t in enumerate(titles)], RAW)


def test_dated_memory_expires_and_writes_its_own_hashes(spark, tmp_path):
    memory, path = DatedMemory(spark, f"{tmp_path}/seen"), f"{tmp_path}/rfps"

    def run(when, *titles, **more):
        return ingest.run(raw(spark, *(titles or ("Water main", "Road salt"))), memory, path, ["water"], at(when), ["pos"], **more).first().new_rfps

    assert run("2024-01-01") == 2 and run("2024-01-02") == 0
    assert run("2024-01-03", "Water main", "Road salt", "New pump") == 1
    assert memory.days() == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert spark.read.parquet(f"{memory.root}/days/day=2024-01-03").count() == 1
    # an expired hash still blocks the run that forgets it, is let in by the next
    assert run("2024-04-15") == 0 and memory.read().count() == 0
    assert run("2024-04-16") == 2 and memory.days() == ["2024-04-15", "2024-04-16"]
    assert ingest.committed_rfps(memory, path).count() == 5


def test_a_lost_run_is_not_read_and_repeats_without_duplicates(spark, tmp_path, monkeypatch):
    memory, path = DatedMemory(spark, f"{tmp_path}/seen"), f"{tmp_path}/rfps"
    run = lambda name: ingest.run(raw(spark, "Water main", "Road salt"), memory, path, ["water"], at("2024-01-01"), ["pos"], batch=name).first().new_rfps
    with monkeypatch.context() as m:
        m.setattr(Commits, "write", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run("one")
    assert memory.read().count() == 0 and ingest.committed_rfps(memory, path).count() == 0
    # another name: what the lost run left stays unread
    assert run("two") == 2 and run("two") == 2
    assert ingest.committed_rfps(memory, path).count() == 2 and memory.read().count() == 2
    assert run("three") == 0


def test_bucket_state_replaces_touched_buckets(spark, tmp_path):
    state = BucketState(spark, f"{tmp_path}/state", "email string, kw string, op string, seq bigint", ["email"], 8)
    rows = lambda *r: spark.createDataFrame(list(r), state.schema)
    everyone = [(f"m{i}", "a", "add", i) for i in range(40)]
    state.merge(rows(*everyone), "b1", preferences.fold)
    for _ in range(2):
        state.merge(rows(("m3", "a", "remove", 100), ("m3", "b", "add", 101)), "b2", preferences.fold)
    written = [f for f in os.listdir(f"{tmp_path}/state/rows/batch=b2") if f.startswith("bucket=")]
    assert len(written) == 1
    got = sorted(tuple(r) for r in state.read().collect())
    assert got == sorted([r for r in everyone if r[0] != "m3"] + [("m3", "a", "remove", 100), ("m3", "b", "add", 101)])
    assert state.read("b2").count() == 40  # what a repeated b2 starts from
    for n in range(3, 6):
        state.merge(rows(*[(f"m{i}", "a", "add", 1000 + n) for i in range(40)]), f"b{n}", preferences.fold)
    assert sorted(os.listdir(f"{tmp_path}/state/rows")) == ["batch=b4", "batch=b5"]
    assert state.read().count() == 41
    empty = BucketState(spark, f"{tmp_path}/none", state.schema, ["email"])
    assert empty.read().count() == 0
    empty.merge(rows().limit(0), "b0", preferences.fold)
    assert empty.read().count() == 0


def plan_of(sightings, days):
    """What one batch of all sightings stores: (title, time, pos)."""
    out = {}
    for title in {t for t, *_ in sightings}:
        last = None
        first = {}
        for _, when, pos in sorted((s for s in sightings if s[0] == title), key=lambda s: (s[1], s[2])):
            first.setdefault(when, pos)
        for when, pos in sorted(first.items()):
            if last is None or when > last + timedelta(days=days):
                out[title, when] = pos
                last = when
    return sorted((t, str(w), p) for (t, w), p in out.items())


@pytest.mark.parametrize("number", [1, 3, 6])
def test_late_records_give_the_rows_of_one_batch(spark, tmp_path, number):
    rng = random.Random(number)
    start = datetime(2024, 1, 1)
    sightings = [(t, start + timedelta(days=rng.randrange(0, 400)), i) for i, t in enumerate(rng.choices(["salt", "pump", "ink"], k=40))]
    sightings += [("salt", sightings[0][1], 100), ("late", start + timedelta(days=152), 101), ("late", start, 102)]
    order = sightings[:]
    rng.shuffle(order)
    schema = "state string, source string, id string, title string, agency string, description string, scraped_at timestamp, pos bigint"
    sink = jobs.keyed_ingest_sink(f"{tmp_path}/s", ["salt"], ["pos"])
    size = -(-len(order) // number)
    for b in range(number):
        part = spark.createDataFrame([("TX", "s", "1", t, "a", str(i), w, i) for t, w, i in order[b * size: (b + 1) * size]], schema)
        for _ in range(1 + (b == 1)):  # a repeated batch changes nothing
            sink(part, b)
    stored = jobs.stored_records(spark, f"{tmp_path}/s").collect()
    assert sorted((r.title, str(r.scrape_timestamp), int(r.description)) for r in stored) == plan_of(sightings, 90)
    assert all(r.keyword_match == (r.title == "salt") for r in stored)


def test_an_empty_batch_writes_nothing(spark, tmp_path):
    schema = "state string, id string, title string, source string, agency string, description string, scraped_at timestamp, pos bigint"
    jobs.keyed_ingest_sink(f"{tmp_path}/s", ["x"], ["pos"])(spark.createDataFrame([], schema), 0)
    assert jobs.stored_records(spark, f"{tmp_path}/s").count() == 0


def test_a_lost_snapshot_run_is_named(spark, tmp_path):
    path = f"{tmp_path}/snap"
    for day in ("2024-01-01", "2024-01-02"):
        rows = spark.createDataFrame([("tfidf", i, f"t{i}", 0.5) for i in range(1, 4)], "kind string, rank int, term string, score double")
        store.append_snapshot(rows.select(at(day).alias("run_ts"), "*"), path)
    files = {spark.read.parquet(f"{path}/{f}").first().run_ts.day: f for f in os.listdir(path) if f.endswith(".parquet")}
    with open(f"{path}/{files[1]}", "r+b") as file:
        file.truncate(os.path.getsize(f"{path}/{files[1]}") // 2)
    for name in os.listdir(path):
        if name.endswith(".crc"):
            os.remove(f"{path}/{name}")
    assert [(r.run_ts.day, r.found, r.run_rows) for r in store.damaged_snapshots(spark, path).collect()] == [(1, 0, 3)]
    assert {r.run_ts.day for r in store.snapshots(spark, path).collect()} == {2}


def test_sync_reads_what_is_above_the_mark(spark, tmp_path):
    kept = PreferenceStore(spark, f"{tmp_path}/p", 4)
    members = spark.createDataFrame([("a@x.org", "Ada", ["water"])], "email string, name string, patterns array<string>")
    aliases = spark.createDataFrame([("ada@home.org", "a@x.org")], "login_email string, email string")
    schema = "timestamp string, email string, add string, remove string, seq bigint"
    one = [("1/1/2024 10:00:00", "A@x.org", "salt", "", 0), ("1/2/2024 10:00:00", "who@x.org", "ink", "", 1)]
    two = [*one, ("1/3/2024 10:00:00", "ada@home.org", "ink", "salt, water", 2), ("bad time", "a@x.org", "never", "", 3)]
    first = sync(kept, spark.createDataFrame(one, schema), members, aliases, "1").first()
    second = sync(kept, spark.createDataFrame(two, schema), members, aliases, "2").first()
    assert (first.responses, first.rejected, first.changes, second.responses) == (2, 1, 1, 1)
    assert {(r.kw, r.op) for r in kept.state.read().collect()} == {("salt", "remove"), ("ink", "add"), ("water", "remove")}
    assert kept.history().count() == 2 and kept.rejected().count() == 1
    assert {r.pattern for r in preferences.effective_patterns(members, kept.state.read()).collect()} == {"ink"}
    assert sync(kept, spark.createDataFrame(two, schema), members, aliases, "3").first().responses == 0


def test_lines_and_files_have_places_of_their_own(spark, tmp_path):
    for name, lines in (("a.json", ["one", "two"]), ("b.json", ["three"]), ("page-10.json", ["x"] * 3), ("page-9.json", ["y"])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = api.read_bodies(spark, str(tmp_path), whole_files=False).repartition(5).orderBy("payload_ord").collect()
    assert [r.body for r in rows] == ["one", "two", "three", "y", "x", "x", "x"]
    assert len({r.payload_ord for r in rows}) == 7
    assert len({r.payload_ord for r in api.read_bodies(spark, str(tmp_path)).collect()}) == 4


def test_sortable_numbers_and_texts(spark):
    numbers = [-(2**63), -10, -9, 0, 5, 10, 2**63 - 1]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    assert [r.n for r in df.orderBy(store.sortable(df, "n")).collect()] == numbers


def test_portal_of_a_page(spark):
    known = spark.createDataFrame([
        ("g", "AA", "Start", "https://one.org/bids/"), ("g", "BB", "Deep", "https://one.org/bids/list/start.aspx"), ("g", "CC", "Other", "http://two.org"),
    ], "platform string, state string, label string, base string")
    urls = ["https://ONE.org/bids/9", "https://one.org/bids/list/page?x=/start.aspx", "https://one.org/", "https://two.org/a/b", "https://three.org/bids", None, ""]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.state for r in pages.with_portal(df, known).collect()}
    assert got == {0: "AA", 1: "BB", 2: "AA", 3: "CC"}


def test_paging_by_key(spark, tmp_path):
    rows = [(f"2024-01-{d:02d}", i) for d, i in itertools.product(range(1, 6), range(7))]
    spark.createDataFrame(rows, "scrape_date string, pos bigint").write.partitionBy("scrape_date").parquet(f"{tmp_path}/t")
    listing = spark.read.schema("pos bigint, scrape_date string").parquet(f"{tmp_path}/t").select("scrape_date", "pos")
    order, last, got = [("scrape_date", False), ("pos", True)], None, []
    while True:
        page = dashboard.page_after(listing, order, last, 4)
        found = [(r.scrape_date, r.pos) for r in page.collect()]
        if not found:
            break
        got += found
        last = {"scrape_date": found[-1][0], "pos": found[-1][1]}
    assert got == sorted(sorted(rows, key=lambda r: r[1]), key=lambda r: r[0], reverse=True)
    plan = dashboard.page_after(listing, order, {"scrape_date": "2024-01-02", "pos": 3}, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Offset" not in plan and "scrape_date" in plan.split("PartitionFilters: ")[1].split("]")[0]
