"""Secret scan with DataFrame functions only.

Base kinds are regular expressions. Positions come from lengths: the pieces between matches and the
matches themselves alternate, so the start of a match is the sum of what lies before it.
The method adds ``entropy`` spans: over each candidate string a window of ``window`` characters
slides by one. Each step needs the window's counts of two characters only, the one that leaves and
the one that comes, and moves the sum of c*log2(c) by their change, so a step costs the same
wherever it is and a string costs in proportion to its length. A candidate is reported when some
window's entropy reaches its character class's threshold and nothing on the allow list fits it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: a run is matched whole, so its least length may stand in the pattern; an assignment's short value must still be consumed
KINDS = {"assign": (ASSIGN, 1, 8), "access": (r"(AKIA[A-Z0-9]{12,})", 1, 16), "hex": (r"([0-9a-f]{32,})", 1, 32)}
CANDIDATE = r"([A-Za-z0-9+/_=-]{20,})"
#: class -> (pattern of the whole candidate, bits a character); the first that fits counts
CLASSES = {
    "hex": (r"^[0-9a-fA-F]+$", 3.0),
    "lower": (r"^(?=.*[0-9])[a-z0-9]+$", 3.6),
    "upper": (r"^(?=.*[0-9])[A-Z0-9]+$", 3.6),
    "mixed": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])", 3.9),
    "letters": (r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z+/=]+$", 4.1),
}
#: digits only, one character repeated, UUIDs, placeholders
ALLOW = [r"^[0-9]+$", r"^(.)\1+$", r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$", r"(?i)example|placeholder|xxxx|0123456789"]
#: what words in one case or with one capital each, joined by signs, never hold; a pattern of repeated words would recurse once a word
NOT_WORDS = r"[^A-Za-z/_=+-]|[a-z][A-Z]|[A-Z][A-Z][a-z]"
CHUNK = 256


def _prefilter(text: Column) -> dict[str, Column]:
    return {"assign": text.rlike(ASSIGN), "access": text.contains("AKIA"), "hex": text.rlike(r"[0-9a-f]{32}"), "entropy": text.rlike(r"[A-Za-z0-9+/_=-]{20}")}


def _once(value: Column, f) -> Column:
    """f(value) with value computed once, however often f reads it."""
    return F.get(F.transform(F.array(value), f), 0)


def _spans(kind: str, pattern: str, group: int, least: int) -> Column:
    """array<struct<s, e, kind, v>> of one kind; code points, end exclusive.

    Starts are running sums; they are kept in two levels of CHUNK matches, so that long lists cost
    little more than their length.
    """
    empty = F.array().cast("array<struct<s:int,e:int,kind:string,v:string>>")
    gaps, hits, values = F.split("t", pattern, -1), F.regexp_extract_all("t", F.lit(pattern), 0), F.regexp_extract_all("t", F.lit(pattern), group)
    rows = F.zip_with(F.zip_with(hits, values, lambda h, v: F.struct(F.length(h).alias("h"), v.alias("v"))), gaps, lambda x, g: F.struct(F.length(g).alias("g"), x["h"].alias("h"), x["v"].alias("v")))

    def within(at: Column, part: Column) -> Column:
        def step(a, x):
            start = a["at"] + x["g"]
            return F.struct((start + x["h"]).alias("at"), F.concat(a["out"], F.array(F.struct(start.alias("s"), (start + x["h"]).alias("e"), F.lit(kind).alias("kind"), x["v"].alias("v")))).alias("out"))

        return F.aggregate(part, F.struct(at.alias("at"), empty.alias("out")), step, lambda a: a["out"])

    def cut(all_rows: Column) -> Column:
        last = F.greatest(F.floor((F.size(all_rows) - 1) / CHUNK).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(all_rows, b * CHUNK + 1, CHUNK))

    def joined(parts: Column) -> Column:
        sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x["g"] + x["h"]))
        starts = F.aggregate(sums, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
        return F.flatten(F.zip_with(parts, starts, lambda p, at: F.when(p.isNull(), empty).otherwise(within(at, p))))

    whole = _once(F.filter(rows, lambda x: x["h"].isNotNull()), lambda r: _once(cut(r), joined))
    return F.filter(whole, lambda x: F.length(x["v"]) >= least)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """One row per input row: id_col, n_assign, n_access, n_hex, base_sha256, spans, n_entropy.

    A null or empty text has no spans (base_sha256 is that of the empty string). Spans are ordered
    by start, then kind in the order assign, access, hex, entropy. Repeated rows repeat, an empty
    table gives an empty result, other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), common.text_of(text_col).alias("t"))
    none = F.expr("CAST(array() AS array<struct<s:int,e:int,kind:string,v:string>>)")
    first = _prefilter(F.col("t"))
    for kind, (pattern, group, least) in KINDS.items():
        rows = rows.withColumn(kind, F.when(first[kind], _spans(kind, pattern, group, least)).otherwise(none))
    rows = rows.withColumn("found", F.when(first["entropy"], _spans("entropy", CANDIDATE, 1, window)).otherwise(none))
    bits = lambda v: F.coalesce(*[F.when(v.rlike(p), F.lit(b)) for p, b in CLASSES.values()])
    allowed = lambda v: F.array_contains(F.array(*[v.rlike(p) for p in ALLOW], ~v.rlike(NOT_WORDS)), True)
    rows = rows.withColumn("entropy", F.filter("found", lambda x: bits(x["v"]).isNotNull() & ~allowed(x["v"]) & (window_entropy(x["v"], window) >= bits(x["v"]))))
    order = {"assign": 0, "access": 1, "hex": 2, "entropy": 3}
    key = lambda names: F.array_sort(F.transform(F.concat(*names), lambda x: F.struct(x["s"].alias("s"), F.coalesce(*[F.when(x["kind"] == k, F.lit(n)) for k, n in order.items()]).alias("o"), F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string")).alias("txt"))))
    joined = lambda names: F.array_join(F.transform(key(names), lambda x: x["txt"]), ",")
    return rows.select(
        F.col("id").alias(id_col), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(list(KINDS)).cast("binary"), 256).alias("base_sha256"), joined([*KINDS, "entropy"]).alias("spans"), F.size("entropy").cast("long").alias("n_entropy"),
    )


def window_entropy(value: Column, window: int = 20) -> Column:
    """The highest entropy of ``window`` neighbouring characters of a string; -infinity if it is shorter."""
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])  # c*log2(c) by c

    def best(chars: Column, f: Column) -> Column:
        # place i (from 1) leaves the window, place i + window comes; what lies between stays
        def step(s: Column, i: Column) -> Column:
            return _once(F.slice(chars, i + 1, window - 1), lambda stays: change(s, stays, F.get(chars, i - 1), F.get(chars, i + window - 1)))

        def change(a: Column, stays: Column, old: Column, new: Column) -> Column:
            gone = F.size(F.filter(stays, lambda c: c == old))
            come = F.size(F.filter(stays, lambda c: c == new))
            s = a["s"] + F.get(f, gone) - F.get(f, gone + 1) + F.get(f, come + 1) - F.get(f, come)
            return F.struct(s.alias("s"), F.least(a["low"], s).alias("low"))

        first = F.slice(chars, 1, window)
        start = F.aggregate(F.array_distinct(first), F.lit(0.0), lambda s, c: s + F.get(f, F.size(F.filter(first, lambda x: x == c))))
        steps = F.when(F.size(chars) > window, F.sequence(F.lit(1), F.size(chars) - window)).otherwise(F.array().cast("array<int>"))
        low = _once(start, lambda s: F.aggregate(steps, F.struct(s.alias("s"), s.alias("low")), step, lambda a: a["low"]))
        return F.when(F.size(chars) < window, F.lit(float("-inf"))).otherwise(math.log2(window) - low / window)

    return _once(F.struct(F.filter(F.split(value, ""), lambda c: c != "").alias("c"), weight.alias("f")), lambda x: best(x["c"], x["f"]))
