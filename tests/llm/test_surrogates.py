"""Surrogates: what is found, what replaces it, and that different stays different."""
import re

import pytest
from pyspark.sql import functions as F

from oppflow.llm import surrogates
from oppflow.llm.surrogates import assigned, pseudonymised

TEXTS = {
    1: "Write to Jo.Doe@Mail.example.com or jo.doe@mail.example.com, not to no@body or a@b.",
    2: "Call +1 (132) 555-1352 or +1 (132) 555.1352; (132) 555-1352; 132-555-1352.",
    3: "Cards 4785380592391139 and 4785-3805-9239-1139, id 78-05-1120 078-05-1120, host 152.143.123.131.",
    4: 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"### TOKEN = "24BE64439E3E49CF46B2D7C90F3602A3D0B907FF"',
    5: "Mr. John Smith met Frau Müller. Mrs Smith and John Smith left; Господин Иванов and Anna Müller stayed.",
    6: "Clean text, 12345678 things, version 1.2.3, 2024-01-02, 3.14; Mary had 10 000 000 lambs. The Smith.",
    7: None, 8: "", 9: "jo.doe@mail.example.com", 10: "x" * 50_000 + " 4785380592391139 " + "9" * 40_000,
    11: "жанна@почта.рф é.ü@mail.example.com",
}


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, len(t or "")) for i, t in TEXTS.items()] + [(9, TEXTS[9], 23), (None, TEXTS[9], 23)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int").withColumn("mention", F.lit("m")).withColumn("k", F.lit(1)).repartition(3)
    out = pseudonymised(df, "key", count="n")
    assert out.columns == [*df.columns, "n"]
    got = out.collect()
    assert len(got) == len(rows)
    return got


def of(rows, i):
    return next(r.text for r in rows if r.doc_id == i)


def test_clean_texts_stay(texts):
    for i in (6, 7, 8):
        assert of(texts, i) == TEXTS[i]
    assert {r.doc_id: r.n for r in texts if r.doc_id in (1, 3, 6, 7)} == {1: 2, 3: 4, 6: 0, 7: 0}
    assert all(r.n_chars == len(r.text or "") for r in texts)


def test_formats(texts):
    assert re.fullmatch(r"Write to [A-Z][a-z]\.[a-z]{3}@mail\w+\.example\.\w{3} or [a-z]{2}\.[a-z]{3}@mail\w+\.example\.\w{3}, not to no@body or a@b\.", of(texts, 1))
    assert re.fullmatch(r"Call \+1 \(\d{3}\) \d{3}-\d{4} or \+1 \(\d{3}\) \d{3}\.\d{4}; \(\d{3}\) \d{3}-\d{4}; \d{3}-\d{3}-\d{4}\.", of(texts, 2))
    assert re.fullmatch(r"Cards \d{16} and \d{4}-\d{4}-\d{4}-\d{4}, id 78-05-1120 9\d\d-\d\d-\d{4}, host 2[45]\d(\.\d{1,3}){3}\.", of(texts, 3))
    assert re.fullmatch(r'token = "[a-f0-9]{40}"### TOKEN = "[A-F0-9]{40}"', of(texts, 4))
    assert not re.search("139|24be|1352|131|doe", " ".join(of(texts, i).lower() for i in (1, 2, 3, 4)))
    card = re.search(r"\d{16}", of(texts, 3))[0]
    assert sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(card))) % 10 == 0


def test_coreference(texts):
    first, second = re.findall(r"\S+@mail\S+?(?=[ ,])", of(texts, 1))
    assert first.lower() == second.lower() == of(texts, 9)
    a, b = re.findall(r"\+1 \(\d{3}\) \d{3}.\d{4}", of(texts, 2))
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
    c, d = re.search(r"Cards (\d+) and ([\d-]+)", of(texts, 3)).groups()
    assert c == d.replace("-", "") and f" {c} " in of(texts, 10)
    assert len({r.text for r in texts if r.doc_id in (9, None)}) == 1


def test_names_keep_gender_and_script(texts):
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Frau (\w+)\. Mrs (\w+) and (\w+) (\w+) left; Господин (\w+) and ([\w-]+) (\w+) stayed\.", of(texts, 5))
    john, smith, mueller, smith2, john2, smith3, ivanov, anna, mueller2 = m.groups()
    assert smith == smith2 == smith3 and john == john2 and mueller == mueller2 and smith != mueller and "John" != john
    from oppflow.llm.surrogates import FIRST_NAMES
    assert john in FIRST_NAMES["latin", "m"].split() and set(anna.split("-")) <= set(FIRST_NAMES["latin", "f"].split())
    assert re.fullmatch("[А-Яа-я]+", ivanov) and ivanov != "Иванов"


def test_scripts_of_addresses(texts):
    a, b = of(texts, 11).split(" ")
    assert re.fullmatch(r"[а-яё]{5}@mail\w+\.example\.\w+", a) and re.fullmatch(r"[a-z]\.[a-z]@mail\w+\.example\.\w+", b)


def test_collisions_are_drawn_again(spark):
    """Far more first names than the pool has: all stay different, none is an entity of the corpus."""
    names = [f"name{i}" for i in range(800)] + ["james", "john"]
    df = spark.createDataFrame([("first_m_latin", n) for n in names] + [("ssn", f"{i:09d}") for i in range(200)], "type string, canon string")
    rows = assigned(df, "k").collect()
    assert len(rows) == 1002 and len({(r.type, r.canon) for r in rows}) == 1002
    assert len({(r.type, r.other) for r in rows}) == 1002
    assert not {r.other for r in rows} & set(names)


def test_key_decides(spark):
    df = spark.createDataFrame([(1, TEXTS[3])], "doc_id long, text string")
    a, b, c = (pseudonymised(df, k).first().text for k in ("k1", "k1", "k2"))
    assert a == b != c


def test_empty_table_and_plan(spark):
    df = spark.createDataFrame([(1, TEXTS[3])], "doc_id long, text string")
    assert pseudonymised(df.limit(0), "k").collect() == []
    assert not re.search("Python|Pandas|Arrow", pseudonymised(df, "k")._jdf.queryExecution().toString())


FORMATS = [
    *["+49 30 12345678", "+44 7911 123456", "+49 170 1234567", "+33 1 23 45 67 89", "+1 (415) 5551234", "+1-800-5551234", "+49 (30) 123456", "555 123 4567",
      "0171 2345678", "030/1234567", "(030) 123456", "+49 (0)30 123456", "0049 30 123456", "01 23 45 67 89", "020 7946 0958"],
    "3782 822463 10005", "3782-822463-10005", "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "NO93 8601 1117 947",
    "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "2a02:8108::4d7", "fe80::1:2", "xoxb-123456789012-abcdefABCDEF", "eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0.SflKxwRJSMeKKF2QT4",
]
KEYED = ["password=hunter2!", "DB_PASSWORD='correct horse'".replace(" ", ""), 'api_key: "Zk3v-Qq81"', "client_secret=q7W_e1R9", "pwd: tr0ub4dor&x"]
CLEAN = ["12345678 things", "10 000 000 lambs", "1 234 567", "3.14159265", "+3.14159265 V", "2024-01-02", "01/02/2024", "01.02.2024 10:30", "version 10.2.13", "12:30:45",
         "std::vector<int>", "a::b", "Password: required", "token: string", "id 78-05-1120", "DE 89", "ISBN 978-3-16-148410-0", "0.1234567", "page 012 of 345"]


def test_more_formats(spark):
    texts = [f"before {x}, after." for x in [*FORMATS, *KEYED, *CLEAN]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    out = {r.doc_id: r for r in pseudonymised(df, "key", count="n").collect()}
    for i, x in enumerate([*FORMATS, *KEYED, *CLEAN]):
        text = out[i].text
        if x in CLEAN:
            assert (text, out[i].n) == (texts[i], 0)
            continue
        assert out[i].n == 1 and text.startswith("before ") and text.endswith(", after." if "&" not in x else "&x, after.") and x not in text, (x, text)
        if i < 20:  # numbers keep their format
            assert re.sub(r"[0-9]", "9", text[7: 7 + len(x)]) == re.sub(r"[0-9]", "9", x) or x.startswith("GB")
        if x in KEYED:
            key = re.match(r"\w+[=: ]+", x)[0]
            assert key in text and x[len(key):].strip("\"'").split("&")[0] not in text


def test_spellings_of_one_address_and_account(spark):
    df = spark.createDataFrame([(1, "2A02:8108::4D7 2a02:8108:0:0:0:0:0:04d7"), (2, "DE89 3704 0044 0532 0130 00; DE89370400440532013000")], "doc_id long, text string")
    a, b = (r.text for r in pseudonymised(df, "key").orderBy("doc_id").collect())
    assert len({x.lower() for x in a.split(" ")}) == 1 and a.lower().startswith("2001:db8:")
    spaced, dense = b.split("; ")
    assert spaced.replace(" ", "") == dense and dense.startswith("DE00") and len(dense) == 22


PERSONS = {
    1: "Mr Smith called. Later Smith left, and Smith's car too. Smithson and Blacksmith stayed.",
    2: "Frau Müller, Müller GmbH. Prof. Dr. Anna Weber and Weber.",
    3: "Dr Παπαδόπουλος spoke; Κύριος Παπαδόπουλος left. Μαρία Νικολάου stayed with Νικολάου.",
    4: "Martin Luther King Day in Martin Luther King Street, Rue Pierre Curie, version 1.2.3.4, v1.2.3.4, host 152.143.123.131.",
    5: "Smith and Müller without a title.",
    6: "Priya Sharma met Wei Zhang; Sharma agreed. Mrs Smith-Jones knew Mr Smith: Smith-Jones and Smith.",
    7: "Peter The first. The end.",
    8: "Mr O'Brien's house. O'Brien sold it.",
}


def test_bare_surnames_follow_their_person(spark):
    df = spark.createDataFrame(list(PERSONS.items()), "doc_id long, text string").repartition(3)
    out = {r.doc_id: r for r in pseudonymised(df, "key", count="n").collect()}
    a, b, c = re.fullmatch(r"Mr (\w+) called\. Later (\w+) left, and (\w+)'s car too\. Smithson and Blacksmith stayed\.", out[1].text).groups()
    assert a == b == c != "Smith" and out[1].n == 1
    m, m2, w, w2 = re.fullmatch(r"Frau (\w+), (\w+) GmbH\. Prof\. Dr\. [\w-]+ (\w+) and (\w+)\.", out[2].text).groups()
    assert m == m2 != "Müller" and w == w2 != "Weber"
    greek = re.fullmatch(r"Dr (\w+) spoke; Κύριος (\w+) left\. [\w-]+ (\w+) stayed with (\w+)\.", out[3].text).groups()
    assert greek[0] == greek[1] and greek[2] == greek[3] and all(re.fullmatch("[Α-ώ]+", x) for x in greek)
    assert "Παπαδόπουλος" not in out[3].text and "Νικολάου" not in out[3].text
    head, ip = out[4].text.rsplit(" ", 1)
    assert head == PERSONS[4].rsplit(" ", 1)[0] and ip != "152.143.123.131." and out[4].n == 1
    assert out[5].text == PERSONS[5]
    s, z, s2, j, k, j2, k2 = re.fullmatch(r"[\w-]+ (\w+) met [\w-]+ (\w+); (\w+) agreed\. Mrs (\w+) knew Mr (\w+): (\w+) and (\w+)\.", out[6].text).groups()
    assert s == s2 != z and j == j2 and k == k2 == a and len({"Sharma", "Zhang", "Smith", s, z, j, k}) == 7
    assert out[7].text.endswith(" first. The end.")
    o, o2 = re.fullmatch(r"Mr (\w+)'s house\. (\w+) sold it\.", out[8].text).groups()
    assert o == o2


def test_a_document_of_many_persons(spark):
    """Two thousand surnames, each named once and then bare: none is left."""
    names = [f"N{a}{b}{c}ov" for a in "aeiouyäöüé" for b in "bcdfghklmnprst" for c in "aeiouyäöüéabcd"[:14]][:2000]
    text = ". ".join(f"Mr {n} came" for n in names) + ". " + " and ".join(names) + "."
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = pseudonymised(df, "key").first().text
    words = re.findall(r"\w+", got)
    new = [words[i + 1] for i, w in enumerate(words) if w == "Mr"]
    assert not set(names) & set(words) and [w for w in words[3 * len(names):] if w != "and"] == new and len(set(new)) == len(set(names))


def test_guards_change_no_mention(spark):
    """The guarded pattern finds what its parts side by side find."""
    plain = "|".join(surrogates.PATTERNS.values())
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").union(spark.createDataFrame([
        ("Dr Smith, a.b@x.de, +49 170 1234567abc@x.de ::1 fe80::1 10.0.0.1 version 1.2.3.4 password=hunter22",), ("x" * 100 + "@mail.de",)], "text string"))
    found = [F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (plain, surrogates.MENTION)]
    assert df.where(found[0] != found[1]).count() == 0 and df.where(F.size(found[1]) > 0).count() >= 2
