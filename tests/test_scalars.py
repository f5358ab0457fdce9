"""Hand-computed cases of the small rules."""
import hashlib
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from oppflow.functions import scalars as S
from oppflow.operators.identity import record_hash


@pytest.mark.parametrize("text, date", [
    ("2025-01-02", True), ("1/2/25", True), ("Closes 01-02-2025 5 PM", True), ("2025", False), ("", False),
])
def test_date_like(evaluate, text, date):
    assert evaluate(S.looks_like_date(F.col("a")), a=text) is date


@pytest.mark.parametrize("text, amount", [
    ("2024", True), ("202", False), ("about $5", True), ("1,000.50", True), ("n/a", False), (" 1234 ", True), ("12a4", False),
])
def test_amount_like(evaluate, text, amount):
    assert evaluate(S.looks_like_amount(F.col("a")), a=text) is amount


@pytest.mark.parametrize("text, value", [
    ("$1,234.50", 1234.5), ("n/a", 0.0), ("1d", 0.0), ("", 0.0), (None, 0.0), ("1e3", 1000.0), (" 7 ", 7.0), ("-5", -5.0), ("1.2.3", 0.0),
])
def test_money(evaluate, text, value):
    assert evaluate(S.parse_money(F.col("a")), a=text) == value


@pytest.mark.parametrize("raw, items", [
    ("A, b\nc", ["a", "b\nc"]), ("A\nb", ["a", "b"]), ("", []), (None, []), (" , ,x", ["x"]),
])
def test_lists(evaluate, raw, items):
    assert evaluate(S.parse_list(F.col("a")), a=raw) == items


@pytest.mark.parametrize("value, shown", [
    (0.0, "—"), (999.5, "$999.5"), (1500.0, "$2K"), (1234567.0, "$1.2M"), (1250000.0, "$1.3M"), (2.5e9, "$2.5B"), (500.0, "$500"),
])
def test_show_money(spark, value, shown):
    assert spark.range(1).select(S.show_money(F.lit(value))).first()[0] == shown


@pytest.mark.parametrize("url, ident", [
    ("/x?id=A1&b=2", "A1"), ("/x?bidId=77", "77"), ("/a/b/9?x=1", "9"), ("/a/default.aspx", ""), ("", ""), ("/a/b/", "b"),
    ("/x?number=N5", "N5"),
])
def test_id_from_url(evaluate, url, ident):
    assert evaluate(S.id_from_url(F.col("a")), a=url) == ident


@pytest.mark.parametrize("href", [
    "/a/b", "c/d", "https://z.org/1", "//h.org/x", "?q=1", "../up/x", "./here", "a/../b?x=../y", "#frag",
])
@pytest.mark.parametrize("base", ["https://p.org/bids/list?x=1", "https://p.org/bids/", "https://p.org"])
def test_absolute_url_like_urljoin(evaluate, base, href):
    assert evaluate(S.absolute_url(F.col("b"), F.col("h")), b=base, h=href) == urljoin(base, href)


def test_hash_is_sha256_prefix(evaluate):
    got = evaluate(record_hash(), state="TX", id="é-1", title="Ünïcode")
    assert got == hashlib.sha256("TX-é-1-Ünïcode".encode()).hexdigest()[:16]


def test_hash_treats_null_as_empty(evaluate):
    got = evaluate(record_hash(), state="TX", id=None, title="t")
    assert got == hashlib.sha256(b"TX--t").hexdigest()[:16]
