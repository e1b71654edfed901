"""Secret scans: fixed patterns, and sliding-window Shannon entropy per character class.

Everything is a JVM expression over one row, so the scan needs no shuffle and a document never leaves its
task. Positions come from splitting a text at the matches: a match starts where the lengths of the parts
and matches before it end. Both are counted in code points.

Candidate strings of the entropy scan are maximal runs of token characters. A candidate's class is hex, alnum
(one letter case) or base64. A window slides over it one character at a time; the counts change by the
character that enters and the one that leaves, and the entropy by the same two terms. A candidate is a span
where its highest window entropy reaches the class's threshold (a higher one without a letter and a digit),
unless an allow-list pattern matches it or a base span holds it. Cost is linear in a text's length, and in its
matches but for a share of 1 / CHUNK.

Defined cases: null and empty texts have no spans (the digest is that of the empty string); rows are
independent, so repeated rows and null ids come back as they are; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern, group whose length counts, least length. In the order in which kinds are listed. Runs of one
#: class are taken whole, so a least length inside the pattern finds the same matches as a test after it;
#: assign's does not, as a match that is too short still uses up its text.
BASE = [("assign", ASSIGN, 2, 6), ("access", r"AKIA[A-Z0-9]{16,}", 0, 20), ("hex", r"[0-9a-f]{24,}", 0, 24)]

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Class, the pattern that a whole candidate of it matches, least window entropy in bits where it holds a letter and
#: a digit, and where it doesn't. The first class that fits counts. The least ones are what 1 in 200 windows of
#: random characters of the class stay under, the others what half of them do.
CLASSES = [
    ("entropy_hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 2.84, 3.38),
    ("entropy_alnum", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 3.34, 3.88),
    ("entropy_base64", r"^[A-Za-z0-9+/_=-]+$", 3.58, 4.02),
]
#: Candidates that look random and are no secrets.
ALLOWED = [
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # UUID
    r"^(?:[A-Za-z]*[_/=+-])+[A-Za-z]*[0-9]{0,4}$",  # words joined by punctuation: paths, slugs, rules
]
#: The same of what follows a candidate's last separator: a name before it allows nothing.
ALLOWED_VALUES = [r"(?i)example|placeholder|changeme|dummy", r"(?i)0123456789|abcdefghij|qwertyuiop"]

#: Matches whose positions are summed up together.
CHUNK = 256


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once: a lambda would compute an outer expression for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _positions(text: Column, matches: Column, pattern: str) -> Column:
    """An array of (start, end), one for each match: running sums of the lengths of what lies between, by chunks and then over chunks."""
    gaps, lens = F.transform(F.split(text, pattern, -1), F.length), F.transform(matches, F.length)
    steps = F.zip_with(F.slice(gaps, 1, F.size(matches)), lens, lambda gap, n: F.struct(gap.alias("gap"), n.alias("n")))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        return F.struct((start + x["n"]).alias("at"), F.concat(acc["spans"], F.array(F.struct(start.alias("start"), (start + x["n"]).alias("end")))).alias("spans"))

    def chunks(s: Column) -> Column:
        first = F.sequence(F.lit(0), F.floor((F.size(s) - 1) / CHUNK).cast("int"))
        return F.transform(first, lambda c: F.aggregate(F.slice(s, c * CHUNK + 1, CHUNK), F.struct(F.lit(0).alias("at"), none.alias("spans")), step))

    def placed(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(parts, start, lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")))["starts"]
        moved = lambda x, by: F.transform(x["spans"], lambda p: F.struct((p["start"] + by).alias("start"), (p["end"] + by).alias("end")))
        return F.flatten(F.zip_with(parts, starts, moved))

    return F.when(F.size(matches) > 0, _let(steps, lambda s: _let(chunks(s), placed)))


def max_window_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits, of any ``window`` successive characters (ASCII).

    A step changes the counts of two characters, that which enters and that which leaves; their counts are
    those in the window before, so a step costs the same however long the candidate is.
    """
    term = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])

    def lowest(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            enters, leaves = F.get(codes, i), F.when(i >= window, F.get(codes, i - window)).otherwise(-1)
            count = lambda code: F.size(F.filter(acc["held"], lambda c: c == code))
            out, into = count(leaves), count(enters)
            change = F.when(leaves < 0, 0.0).otherwise(F.get(term, out - 1) - F.get(term, out)) + F.get(term, into + 1) - F.get(term, into)
            s = F.when(enters == leaves, acc["s"]).otherwise(acc["s"] + change)
            held = F.concat(F.when(leaves < 0, acc["held"]).otherwise(F.slice(acc["held"], 2, window)), F.array(enters))
            return F.struct(held.alias("held"), s.alias("s"), F.when(i >= window - 1, F.least(acc["low"], s)).otherwise(acc["low"]).alias("low"))

        state = F.struct(F.array().cast("array<int>").alias("held"), F.lit(0.0).alias("s"), F.lit(math.inf).alias("low"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), state, step)["low"]

    low = _let(F.transform(F.split(candidate, ""), lambda c: F.ascii(c)), lowest)
    return F.lit(math.log2(window)) - low / window


def entropy_kind(candidate: Column, window: int = WINDOW) -> Column:
    """The class of a candidate with a window of high entropy; else null."""
    mixed = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]")
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(pattern)
    value = F.regexp_replace(candidate, r"^.*[=/_-](?=[A-Za-z0-9+])", "")
    for pattern in ALLOWED_VALUES:
        allowed = allowed | value.rlike(pattern)
    name = least = None
    for kind, pattern, bits, plain in CLASSES:
        fits, asked = candidate.rlike(pattern), F.when(mixed, bits).otherwise(plain)
        name = F.when(fits, kind) if name is None else name.when(fits, kind)
        least = F.when(fits, asked) if least is None else least.when(fits, asked)
    return F.when(~allowed, F.when(max_window_entropy(candidate, window) >= least, name))


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base and found: arrays of (start, order, end, kind), each sorted; ``found`` holds the base spans too."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    for kind, pattern, group, _ in BASE:
        df = df.withColumn(kind, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        if group:
            df = df.withColumn(f"{kind}_value", F.when(F.size(kind) > 0, F.regexp_extract_all("text", F.lit(pattern), F.lit(group))))
    df = df.withColumn("candidate", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    df = df.withColumn("candidate_kind", F.transform("candidate", lambda c: entropy_kind(c)))
    spans = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        df = df.withColumn(f"{kind}_at", _positions(F.col("text"), F.col(kind), pattern))
        value = f"{kind}_value" if group else kind
        spans.append(F.coalesce(F.array_compact(F.transform(f"{kind}_at", _long_enough(F.col(value), least, order, kind))), F.array()))
    df = df.withColumn("base", F.array_sort(F.concat(*spans)))
    some = F.exists("candidate_kind", lambda k: k.isNotNull())
    df = df.withColumn("candidate_at", F.when(some, _positions(F.col("text"), F.col("candidate"), CANDIDATE)))
    inside = lambda p: F.exists("base", lambda b: (b["start"] <= p["start"]) & (p["end"] <= b["end"]))
    more = F.transform("candidate_at", lambda p, i: F.when(F.get(F.col("candidate_kind"), i).isNotNull() & ~inside(p), _span(p, len(BASE), F.get(F.col("candidate_kind"), i))))
    df = df.withColumn("found", F.array_sort(F.concat("base", F.coalesce(F.array_compact(more), F.array()))))
    return df.select("doc_id", "text", "base", "found")


def _long_enough(values: Column, least: int, order: int, kind: str) -> Callable[[Column, Column], Column]:
    return lambda p, i: F.when(F.length(F.get(values, i)) >= least, _span(p, order, F.lit(kind)))


def _span(p: Column, order: int, kind: Column) -> Column:
    return F.struct(p["start"].alias("start"), F.lit(order).alias("order"), p["end"].alias("end"), kind.alias("kind"))


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda s: F.when(s["kind"] == kind, True)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    found = secret_spans(docs)
    counts = [F.size(F.array_compact(F.transform("base", _is(kind)))).cast("long").alias(f"n_{kind}") for kind, *_ in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
