"""Form exports, streams cut into batches, snapshots, landed folders, and markup that portals send."""
import itertools

from pyspark.sql import functions as F

from oppflow.functions import html as H
from oppflow.functions.scalars import first_filled
from oppflow.operators import preferences
from oppflow.sources import api, pages, store
from oppflow.streaming import jobs

RAW = "state string, source string, id string, title string, agency string, description string, scraped_at timestamp, pos bigint"


def test_form_rows_with_blanks(spark, tmp_path):
    (tmp_path / "form.csv").write_text(
        "1/2/2024 3:04:05,a@x.org,,,water,,\n"  # add only
        '1/2/2024 3:04:05,b@x.org,"","","water","",""\n'
        "1/2/2024 3:04:05,c@x.org,,,,salt,\n"  # remove only
        "1/2/2024 3:04:05,short\n"
        '1/2/2024 3:04:05,d@x.org,,,"road, ""x""\ny",\n'  # six fields
        "1/2/2024 3:04:05,e@x.org,,,one,two,three,four\n"
        "1/2/2024 3:04:05,five,,,x\n"
    )
    rows = preferences.read_responses(spark, str(tmp_path / "form.csv"), header=False).collect()
    assert sorted((r.email, r.add, r.remove) for r in rows) == [
        ("a@x.org", "water", ""), ("b@x.org", "water", ""), ("c@x.org", "", "salt"), ("d@x.org", 'road, "x"\ny', ""), ("e@x.org", "one", "two")]


def test_fold_goes_by_time(spark):
    ops = spark.createDataFrame([("a", "k", "remove", "2024-02-01", 0), ("a", "k", "add", "2024-01-01", 9)], "email string, kw string, op string, t string, seq long")
    ops = ops.withColumn("ts", F.col("t").cast("timestamp"))
    assert [r.op for r in preferences.fold(ops).collect()] == ["remove"]
    first = preferences.fold(ops.filter("seq = 0"))
    assert [r.op for r in preferences.fold(first.unionByName(ops.filter("seq = 9").select(first.columns))).collect()] == ["remove"]


def test_two_aliases_of_one_login(spark):
    members = spark.createDataFrame([("A", "a@x.org", ["p"])], "name string, email string, patterns array<string>")
    aliases = spark.createDataFrame([("h@y.org", "a@x.org"), ("H@y.org ", "A@x.org")], "login_email string, email string")
    sent = spark.createDataFrame([("h@y.org",)], "email string")
    assert [r.member for r in preferences.resolve_email(sent, members, aliases).collect()] == ["a@x.org"]


def test_stream_does_not_depend_on_the_cut(spark, tmp_path):
    """Sightings over a year, in 1, 3 and 12 batches."""
    days = [f"2024-{m:02d}-01 00:00:00" for m in range(1, 13)]
    rows = [("TX", "s", "1", t, "a", "", d, i) for i, (d, t) in enumerate(itertools.product(days, ("water", "salt"))) if (i % 5) or t == "salt"]
    df = spark.createDataFrame([(*r[:6], None, r[7]) for r in rows], RAW).drop("scraped_at").join(
        spark.createDataFrame([(r[7], r[6]) for r in rows], "pos bigint, t string"), "pos").withColumn("scraped_at", F.to_timestamp("t")).drop("t")
    results = []
    for number in (1, 3, 12):
        path, size = f"{tmp_path}/{number}", 12 // number
        sink = jobs.ingest_sink(path, ["water"], ["pos"])
        for b in range(number):
            months = days[b * size: (b + 1) * size]
            sink(df.filter(F.col("scraped_at").isin([F.lit(m).cast("timestamp") for m in months])), b)
        results.append(sorted((r.title, str(r.scrape_timestamp)) for r in spark.read.parquet(path).collect()))
    assert results[0] == results[1] == results[2]
    assert [t[:7] for k, t in results[0] if k == "salt"] == ["2024-01", "2024-04", "2024-07", "2024-10"]


def test_damaged_snapshot_is_left_out_whole(spark, tmp_path):
    path = f"{tmp_path}/snap"
    for day in ("2024-01-01", "2024-01-02"):
        rows = spark.createDataFrame([("tfidf", i, f"t{i}", 0.5) for i in range(1, 4)], "kind string, rank int, term string, score double")
        store.append_snapshot(rows.select(F.lit(day).cast("timestamp").alias("run_ts"), "*"), path)
    assert store.snapshots(spark, path).count() == 6 and store.damaged_snapshots(spark, path).count() == 0
    part = spark.read.parquet(path).filter("run_ts = '2024-01-01' and rank > 1 or run_ts = '2024-01-02'")
    part.coalesce(1).write.parquet(f"{tmp_path}/cut")
    assert {str(r.run_ts)[:10] for r in store.snapshots(spark, f"{tmp_path}/cut").collect()} == {"2024-01-02"}
    assert [(r.found, r.run_rows) for r in store.damaged_snapshots(spark, f"{tmp_path}/cut").collect()] == [(2, 3)]


def test_landed_award_groups(spark, tmp_path):
    for group in ("Grants", "Contracts"):
        (tmp_path / f"award_group={group}").mkdir()
        (tmp_path / f"award_group={group}" / "1.json").write_text('{"results": [{"Award ID": "%s1", "Award Amount": 0.00}]}' % group[0])
    rows = api.usaspending(api.read_bodies(spark, str(tmp_path))).collect()
    assert sorted((r.id, r.source, r.amount) for r in rows) == [("C1", "USAspending (Contracts)", ""), ("G1", "USAspending (Grants)", "")]


def test_zero_amounts(evaluate):
    for zero in ("0", "0.00", "0e0", "-0", "", None):
        assert evaluate(first_filled(F.col("a"), F.col("b")), a=zero, b="7") == "7"
    assert evaluate(first_filled(F.col("a"), F.col("b")), a="$0 or more", b="7") == "$0 or more"


def test_visible_text(evaluate):
    for markup, text in [
        ("Road<br>salt supply", "Road salt supply"), ("<p>Road</p><p>salt</p>", "Road salt"), ("<b>Ro</b>ad", "Road"), ("caf&eacute; &#8211; &rsquo;s &#x41;&nbsp;b", "café – ’s A b"),
        ("&amp;lt; &unknown; &#0; & x", "&lt; &unknown; &#0; & x"), ("&#128512;", "😀"),
    ]:
        assert evaluate(H.visible(F.col("a")), a=markup) == text


def test_rows_cells_and_links(evaluate):
    page = "<table><thead><tr><td>Bid number</td></tr></thead><tr><td>a<td>b<tr><td>c</td><td>d</td></tr></table>"
    rows = evaluate(F.transform(H.table_rows(F.col("a")), H.row_cells), a=page)
    assert rows == [["a", "b"], ["c", "d"]]
    links = evaluate(H.links(H.markup(F.col("a"))), a="<!-- <a href='/no'>no</a> --><a class=x href=/bid/1>One</a><a href='/2'>Two</a><script><a href=\"/3\">3</a></script>")
    assert [(x.href, x.text) for x in links] == [("/bid/1", "One"), ("/2", "Two")]


def test_commented_links_are_no_records(spark):
    page = "<!-- <a href='/bid/9'>A commented bid link</a> --><a href=/bid/1>Road salt supply bid</a>"
    df = spark.createDataFrame([(1, "https://p.org/x", page, "TX", "P")], "page_id long, url string, html string, state string, label string")
    assert [r.url for r in pages.portal_links(df).collect()] == ["https://p.org/bid/1"]


def test_labels_are_read_in_any_block(spark):
    html = (
        "<div class='row'><div><strong>Status:</strong> Open</div><p><strong>Due Date:</strong> 1/2/2025</p>"
        "<ul><li><strong>Due Time:</strong> 2 PM</li></ul><div>" + "long <b>text</b> " * 60_000 + "</div>"
        "<div><strong>Budget:</strong> $5</div></div>"
    )
    labels = ["Status", "Due Date", "Due Time", "Budget", "Agency"]
    page = spark.createDataFrame([(html,)], "html string").select(H.paragraphs(F.col("html")).alias("parts"))
    got = page.select(*[H.labelled(F.col("parts"), x).alias(x) for x in labels]).first()
    assert list(got) == ["Open", "1/2/2025", "2 PM", "$5", ""]
