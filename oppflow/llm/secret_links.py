"""Secrets in texts, and multipart credentials: weak candidates count where complementary parts stand next to them.

1. One pass over the texts finds spans.  Base ones count for themselves: ``assign`` (a value after a word like
   ``password``), ``access`` (access identifiers with a known prefix) and ``hex`` (long hexadecimal runs).  Weak ones say little alone:
   ``weak_id`` (a value after words like ``user``), ``weak_secret`` (a mixed run of letters and digits, a value after words
   like ``pwd``) and ``endpoint`` (an address, a value after words like ``host``).
2. A text with weak candidates gives its parts: identifiers (``access``, ``weak_id``), secrets (``assign``, ``hex``, ``weak_secret``)
   and endpoints, each with its scope, the stretch between two blank lines.
3. Parts meet in an interval join per text and scope: bins as wide as the reach, each bin's parts first reduced
   to the last end on its left and the first start on its right, so a candidate meets at most 18 rows and no pairs are listed.
4. A weak identifier or secret is reported if the other of the two is near and strong (``access``, ``assign``), or if both other
   parts are near.  An endpoint needs both other parts.

Near means a gap of at most ``reach`` code points inside one scope.  Positions are code points, the end exclusive.

Null text counts as empty.  Every row is judged for itself, repeated ones and those without an id too; other columns are ignored.
A weak candidate that overlaps a base span of its text, or one found before it, is dropped; of weak ones the earlier start, then the longer, stays.
Very long texts are searched whole, by patterns whose time is linear in the text.  An empty table gives an empty result.
"""
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oppflow.session import cut

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a shorter run holds no match either, as matches are whole runs
WEAK_ID = re.compile(r"(?<![a-z0-9])(?:access[_-]?key[_-]?id|client[_-]?id|account[_-]?id|user(?:name)?|login)" + _VALUE + r"[a-z0-9._@+-]{3,}", re.IGNORECASE | re.ASCII)
WEAK_VALUE = re.compile(r"(?<![a-z0-9])(?:pwd|pass|passphrase|credentials?|private[_-]?key|access[_-]?key|signature)" + _VALUE + r"[a-z0-9+/_.=@!#%-]{4,}", re.IGNORECASE | re.ASCII)
WEAK_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
ADDRESS = re.compile(r"""(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{1,19}://[^\s"'<>]+""", re.IGNORECASE | re.ASCII)
HOST = re.compile(r"(?<![a-z0-9])(?:host(?:name)?|endpoint|server|bucket|database)" + _VALUE + r"[a-z0-9][a-z0-9.:/_-]{2,}", re.IGNORECASE | re.ASCII)
BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")

KINDS = ["assign", "access", "hex", "weak_id", "weak_secret", "endpoint"]
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "weak_id": "identifier", "weak_secret": "secret", "endpoint": "endpoint"}
STRONG = {"assign", "access"}
SPAN = "struct<kind:string,start:long,end:long>"
FOUND = f"rid long, doc_id long, base array<{SPAN}>, parts array<struct<kind:string,start:long,end:long,scope:long>>"


@dataclass(frozen=True)
class Linking:
    reach: int = 200


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def mixed(run: str) -> bool:
    """Letters of both cases and digits, most characters different: no word, number or path."""
    return any(c.isdigit() for c in run) and any(c.islower() for c in run) and any(c.isupper() for c in run) and 2 * len(set(run[:64])) > min(len(run), 64)


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak candidates that overlap neither a base span nor an earlier one of them."""
    found = [("weak_id", *m.span()) for m in WEAK_ID.finditer(text)]
    found += [("weak_secret", *m.span()) for m in WEAK_VALUE.finditer(text)]
    found += [("weak_secret", *m.span()) for m in WEAK_RUN.finditer(text) if mixed(m.group())]
    found += [("endpoint", *m.span()) for m in ADDRESS.finditer(text)]
    found += [("endpoint", *m.span()) for m in HOST.finditer(text)]
    if not found:
        return []
    taken = []  # base spans as disjoint stretches
    for _, start, end in base:
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    starts, out, last = [s for s, _ in taken], [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        before = bisect_left(starts, end) - 1
        if start >= last and (before < 0 or taken[before][1] <= start):
            out.append((kind, start, end))
            last = end
    return out


def spans(docs: DataFrame) -> DataFrame:
    """FOUND: base spans, and where there are weak candidates all parts with their scope.  ``rid`` numbers the rows of a task."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        schema = pa.schema([
            ("rid", pa.int64()), ("doc_id", pa.int64()),
            ("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
            ("parts", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int64())])))])
        for batch in batches:
            all_base, all_parts = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                weak = weak_spans(text, base)
                parts = []
                if weak:
                    blank = [m.start() for m in BLANK_LINE.finditer(text)]
                    parts = [(k, s, e, bisect_right(blank, s)) for k, s, e in base + weak]
                all_base.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
                all_parts.append([{"kind": k, "start": s, "end": e, "scope": c} for k, s, e, c in parts])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(range(rid, rid + n), pa.int64()), batch.column(0),
                pa.array(all_base, schema.field("base").type), pa.array(all_parts, schema.field("parts").type)], schema=schema)
            rid += n

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(find, FOUND)


def named(kind: Column, values: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*pairs)[kind]


def linked(found: DataFrame, p: Linking) -> DataFrame:
    """(rid, kind, start, end) of the weak candidates with complementary parts in reach."""
    parts = found.where(F.size("parts") > 0).select("rid", F.explode("parts").alias("p")).select("rid", "p.*")
    parts = parts.withColumn("role", named(F.col("kind"), ROLE)).withColumn("strong", F.col("kind").isin(*STRONG))
    parts = parts.withColumn("first", F.expr(f"start div {p.reach}")).withColumn("last", F.expr(f"(end - 1) div {p.reach}"))
    # a part lies in its own bins, left of the bin after its last, right of the bin before its first
    places = F.concat(
        F.transform(F.sequence("first", "last"), lambda b: F.struct(b.alias("bin"), F.lit("in").alias("side"))),
        F.array(F.struct((F.col("last") + 1).alias("bin"), F.lit("left").alias("side")), F.struct((F.col("first") - 1).alias("bin"), F.lit("right").alias("side"))))
    near = parts.select("rid", "scope", "role", "strong", "start", "end", F.explode(places).alias("at")).groupBy(
        "rid", "scope", F.col("at.bin").alias("bin"), F.col("at.side").alias("side"), "role", "strong").agg(
        F.max("end").alias("near_end"), F.min("start").alias("near_start"))
    weak = parts.where(~F.col("kind").isin("assign", "access", "hex")).select(
        "rid", "scope", "kind", "start", "end", F.col("role").alias("own"), F.explode(F.sequence("first", "last")).alias("bin"))
    in_reach = (F.col("side") == "in") | ((F.col("side") == "left") & (F.col("near_end") >= F.col("start") - p.reach)) | (
        (F.col("side") == "right") & (F.col("near_start") <= F.col("end") + p.reach))
    met = weak.join(near, ["rid", "scope", "bin"]).where(in_reach & (F.col("role") != F.col("own")))
    judged = met.groupBy("rid", "kind", "own", "start", "end").agg(
        F.size(F.collect_set("role")).alias("roles"), F.bool_or("strong").alias("strong"))
    return judged.where((F.col("roles") == 2) | (F.col("strong") & (F.col("own") != "endpoint"))).select("rid", "kind", "start", "end")


def find_secrets(docs: DataFrame, p: Linking | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and weak spans, each in order of start, then kind."""
    p = p or Linking()
    found = cut(spans(docs))
    reported = linked(found, p).groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("w"))
    none = F.array().cast(f"array<{SPAN}>")
    weak = F.transform("w", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    alone = found.where(F.size("parts") == 0).select("doc_id", "base", none.alias("weak"))
    judged = found.where(F.size("parts") > 0).join(reported, "rid", "left").select("doc_id", "base", F.coalesce(weak, none).alias("weak"))
    return alone.unionByName(judged)


def as_text(of: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined by start, then kind in the order of KINDS."""
    keyed = F.transform(of, lambda x: F.struct(
        x["start"].alias("s"), F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("k"), x["end"].alias("e"), x["kind"].alias("n")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: F.concat_ws(":", x["n"], x["s"], x["e"])), ",")


def report(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans as text."""
    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.concat("base", "weak")).alias("spans"))
