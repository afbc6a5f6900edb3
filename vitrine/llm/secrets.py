"""Secret scan: key patterns, and Shannon entropy of sliding windows.  DataFrame functions only.

Base patterns, leftmost and non-overlapping for each kind: an assignment to a
secret-like name, an access key, a long lower-case hex string.  Their spans stay
whatever the entropy says.

Entropy spans are added: a candidate string is a run of one character class (hex
or base64) of at least one window.  A window of ``w`` characters slides over it,
and the sum of ``c * log2(c)`` over the counts ``c`` in it is kept up to date by the two counts that
change with each step.  The entropy is ``log2(w) - sum / w``; the logarithms are
integers (millionths), so the result does not depend on the order of additions.
Windows at or above the class's threshold are merged to spans.  Candidates that
an allow-list pattern covers, and spans that overlap a base span, are suppressed.

Everything is a map over the rows: no shuffle, no join.  Positions count code
points.  They come from the texts between the matches (``split`` with the same
pattern), some matches at a time, so that the cost of a text grows with its length.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns (kind, pattern, group that is measured, fewest characters), in their order.
BASE = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    # The same as AKIA[A-Z0-9]+ of 16 characters or more and [0-9a-f]+ of 32 or more: a match that fails holds no
    # longer one that starts later.  (For assignments it may, so there the length is tested after the match.)
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]


class CharClass(NamedTuple):
    """A candidate is a run of at least `window` characters of `alphabet`."""
    kind: str
    pattern: str
    alphabet: str
    window: int
    bits: float


_HEX = "0123456789abcdefABCDEF"
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CLASSES = [CharClass("entropy_hex", "[0-9A-Fa-f]", _HEX, 20, 2.9),
           CharClass("entropy_base64", "[A-Za-z0-9+/_-]", _BASE64, 20, 3.8)]
#: Candidates that are no secrets: without a digit, without a letter, a UUID, words and numbers joined
#: by single marks (paths, identifiers), a stated example.
ALLOW = [r"^[^0-9]+$", r"^[^A-Za-z]+$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
         # (the repeated group is possessive: it has one way to match, and a greedy one recurses once a repetition)
         r"^(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[-_/+]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*+[-_/+]*$", r"(?i)example|placeholder"]
UNIT = 1_000_000
#: Matches of a text whose places are worked out in one array, which is copied with each of them.
PIECE = 256

_SPAN = "array<struct<start:int,end:int>>"


def _c_log_c(window: int) -> list[int]:
    return [0] + [round(UNIT * c * math.log2(c)) for c in range(1, window + 1)]


def _limit(c: CharClass) -> int:
    """Largest sum of c * log2(c) at which a window's entropy reaches the threshold."""
    return math.floor(UNIT * c.window * (math.log2(c.window) - c.bits))


def _locate(df: DataFrame, out: str, pattern: str, group: int = 0, least: int = 1) -> DataFrame:
    """Adds `out`: start, end and text of every match whose group has `least` characters."""
    df = df.withColumn("_m", F.regexp_extract_all("_t", F.lit(pattern), F.lit(0)))
    some = F.size("_m") > 0
    df = df.withColumns({"_gap": F.when(some, F.split("_t", pattern, -1)),
                         "_g": F.when(some, F.regexp_extract_all("_t", F.lit(pattern), F.lit(group))) if group else F.col("_m")})
    none = F.array().cast("array<struct<start:int,end:int,text:string,n:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["_gap"])
        end = start + F.length(x["_m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["_m"].alias("text"), F.length(x["_g"]).alias("n"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def piece(acc: Column, first: Column) -> Column:
        zero = F.struct(F.element_at(acc, -1)["at"].alias("at"), none.alias("out"))
        return F.concat(acc, F.array(F.aggregate(F.slice("_zip", first + 1, PIECE), zero, step)))

    zipped = F.arrays_zip(F.slice("_gap", F.lit(1), F.size("_m")), "_m", "_g").cast("array<struct<_gap:string,_m:string,_g:string>>")
    df = df.withColumn("_zip", F.when(some, zipped))
    firsts = F.sequence(F.lit(0), F.greatest(F.size("_m") - 1, F.lit(0)), F.lit(PIECE))
    pieces = F.aggregate(firsts, F.array(F.struct(F.lit(0).alias("at"), none.alias("out"))), piece, lambda a: F.flatten(F.transform(a, lambda p: p["out"])))
    return df.withColumn(out, F.when(some, F.filter(pieces, lambda s: s["n"] >= least))).drop("_m", "_gap", "_g", "_zip")


def _windows(candidate: Column, c: CharClass) -> Column:
    """Merged spans (relative, in code points) of the windows of `candidate` that reach the threshold."""
    table = F.array(*[F.lit(x) for x in _c_log_c(c.window)])
    w, size = c.window, len(c.alphabet)
    chars = F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(c.alphabet), ch))
    # Each step adds one place; from step w on the character w places back leaves.
    back = F.slice(F.concat(F.array_repeat(F.lit(0), w), chars), F.lit(1), F.length(candidate))
    pairs = F.arrays_zip(chars, back).cast("array<struct<come:int,go:int>>")
    moves = F.transform(pairs, lambda m, i: F.struct(m["come"].alias("come"), m["go"].alias("go"), i.alias("i")))
    zero = F.struct(F.array_repeat(F.lit(0), size).alias("n"), F.lit(0).cast("long").alias("sum"),
                    F.lit(-1).alias("lo"), F.lit(-1).alias("hi"), F.array().cast(_SPAN).alias("out"))

    def step(a: Column, m: Column) -> Column:
        go, come = m["go"], m["come"]
        before = F.when(go > 0, F.element_at(a["n"], F.greatest(go, F.lit(1)))).otherwise(0)
        down = F.when(go > 0, F.element_at(table, before) - F.element_at(table, before + 1)).otherwise(0)
        held = F.element_at(a["n"], come) - F.when(go == come, 1).otherwise(0)
        up = F.element_at(table, held + 2) - F.element_at(table, held + 1)
        total = (a["sum"] + down + up).cast("long")
        counts = F.transform(a["n"], lambda n, j: n + F.when(j + 1 == come, 1).otherwise(0) - F.when(j + 1 == go, 1).otherwise(0))
        end = m["i"] + 1
        hit = (end >= w) & (total <= _limit(c))
        joins = hit & (a["hi"] >= end - w)
        closed = hit & ~joins & (a["lo"] >= 0)
        return F.struct(counts.alias("n"), total.alias("sum"),
                        F.when(joins, a["lo"]).when(hit, end - w).otherwise(a["lo"]).alias("lo"),
                        F.when(hit, end).otherwise(a["hi"]).alias("hi"),
                        F.when(closed, F.concat(a["out"], F.array(F.struct(a["lo"].alias("start"), a["hi"].alias("end")))))
                        .otherwise(a["out"]).alias("out"))

    return F.aggregate(moves, zero, step, lambda a: F.when(
        a["lo"] >= 0, F.concat(a["out"], F.array(F.struct(a["lo"].alias("start"), a["hi"].alias("end"))))).otherwise(a["out"]))


def _entropy_spans(df: DataFrame, c: CharClass, allow: list[str]) -> DataFrame:
    """Adds `_kind`: spans of windows that reach the threshold, without those that touch a span of `_base`."""
    name = f"_{c.kind}"

    def shifted(s: Column) -> Column:
        return F.transform(_windows(s["text"], c), lambda x: F.struct(
            (s["start"] + x["start"]).alias("start"), (s["start"] + x["end"]).alias("end")))

    def suspect(s: Column) -> Column:
        return ~reduce(lambda a, b: a | b, [s["text"].rlike(p) for p in allow])

    def apart(s: Column) -> Column:
        return ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    df = _locate(df, name, f"{c.pattern}{{{c.window},}}").withColumn(name, F.filter(name, suspect))
    df = df.withColumn(name, F.when(F.size(name) > 0, F.flatten(F.transform(name, shifted))))
    return df.withColumn(name, F.filter(name, apart))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, classes: list[CharClass] = CLASSES, allow: list[str] = ALLOW) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy, found.

    ``found`` is the array of spans (start, rank, kind, end), in order of start and
    then of kind.  NULL and empty texts have none.  Very long texts and runs are read whole.  Repeated rows give
    a row each.  Other columns are ignored.  An empty table gives an empty result.
    """
    df = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("_t"))
    for kind, pattern, group, least in BASE:
        df = _locate(df, kind, pattern, group, least)
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")

    def named(spans: Column, rank: int, kind: str) -> Column:
        return F.coalesce(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"))), none)

    df = df.withColumn("_base", F.array_sort(F.concat(*[named(F.col(k), i, k) for i, (k, *_) in enumerate(BASE)])))
    for c in classes:
        df = _entropy_spans(df, c, allow)
    extra = F.concat(*[named(F.col(f"_{c.kind}"), len(BASE) + i, c.kind) for i, c in enumerate(classes)])
    df = df.withColumn("_extra", extra).withColumn("found", F.array_sort(F.concat("_base", "_extra")))
    count = lambda k: F.coalesce(F.size(F.col(k)), F.lit(0)).cast("long")
    return df.select("doc_id", *[F.when(F.col(k).isNull(), F.lit(0)).otherwise(count(k)).cast("long").alias(f"n_{k}") for k, *_ in BASE],
                     F.sha2(_text(F.col("_base")), 256).alias("base_sha256"), _text(F.col("found")).alias("spans"),
                     F.size("_extra").cast("long").alias("n_entropy"), "found")
