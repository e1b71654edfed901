"""Predicates over names, cells, headers and paths. All are JVM expressions; a null input gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Shapes of names that are codes or labels, a whole trimmed name each.
CODE_SHAPES = (
    r"^[A-Za-z]{1,10}(?:[-_ ]?[A-Za-z]{0,4})?[-_ ]?[0-9]+(?:[-_][A-Za-z0-9]+)*$",
    r"^(?=.{3,6}$)(?=.*[A-Z])[A-Za-z]+$",
    r"^[0-9]+[A-Za-z]$",
    r"^[A-Z][A-Z0-9-]*(?:/[A-Z][A-Z0-9-]*)+$",
)
BLEND_SHAPE = CODE_SHAPES[3]
#: Words of material classes, of names, of what names a material by its origin, and what doesn't belong in a name.
CLASS_WORDS = r"(?i)\b(?:blend|blends|composite|composites)\b|(?:ゴム|樹脂|高分子)"
NAME_WORDS = r"(?i)\b(?:homo|co)?poly[a-z0-9'-]*\b|\b(?:polymer|resin|rubber)\b"
ORIGIN_WORDS = r"(?i)\b(?:based\s+on|derived\s+from|prepared\s+from|synthesized\s+from)\b|\b[A-Za-z0-9'-]+-based\b"
STATE_WORDS = r"(?i)(?:\b(?:dried|precipitated|crosslinked|vulcanized|film|sheet|specimen|sample)\b|\b[0-9]+(?:\.[0-9]+)?\s*(?:phr|mm|cm|µm|μm)\b)"
#: Headers of properties that are measured in series.
SERIES_HEADERS = r"(?:\btg\b|\bt\s+[gm]\b|\bmn\b|\bmw\b|\bm\s+[nw]\b|glass\s+trans(?:ition|formation)|melting\s+temperature)"


def is_code_like(name: Column) -> Column:
    """A code, a short abbreviation, a numbered label or a blend of codes."""
    shapes = [F.trim(name).rlike(p) for p in CODE_SHAPES]
    return shapes[0] | shapes[1] | shapes[2] | shapes[3]


def wraps_code(name: Column, code: Column) -> Column:
    """Whether a name holds a code as a word of its own, whatever the case; a class word beside a blend's code makes it a name."""
    quoted = F.concat(F.lit(r"(?i)(?<![A-Za-z0-9])\Q"), F.replace(code, F.lit(r"\E"), F.lit("")), F.lit(r"\E(?![A-Za-z0-9])"))
    return F.rlike(name, quoted) & ~(code.rlike(BLEND_SHAPE) & name.rlike(CLASS_WORDS))


def names_material(name: Column) -> Column:
    return name.rlike(NAME_WORDS) | name.rlike(CLASS_WORDS)


def name_rank(name: Column) -> Column:
    """What the better of two names is told by: whether it names an origin, its words, its length."""
    trimmed = F.trim(name)
    return F.struct(trimmed.rlike(ORIGIN_WORDS).cast("int").alias("origin"), F.size(F.split(trimmed, r"\s+")).alias("words"), F.length(trimmed).alias("length"))


def is_contaminated(name: Column) -> Column:
    """A name that holds a state, a shape or a quantity."""
    return name.rlike(STATE_WORDS)


def looks_mathematical(text: Column) -> Column:
    return text.rlike(r"[/\\$*^_{}±∓×°βδχρηΦφ]") | F.trim(text).rlike(r"^[A-Z][A-Za-z0-9]{0,3}$")


def is_anchorable(text: Column) -> Column:
    """Any letter or number: a cell that can be found again."""
    return text.rlike(r"[\p{L}\p{N}]")


def is_series_header(text: Column) -> Column:
    """A header of a series property, unless it names a material by a molar mass."""
    words = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))
    named = words.rlike(r"\b(?:polymer|poly|blend|copolymer|resin)\b") & words.rlike(r"\bmw\s*[0-9]")
    return ~named & words.rlike(SERIES_HEADERS)


def is_plain_name(path: Column) -> Column:
    """One segment: no separators, not empty, not a dot or two."""
    return path.rlike(r"^[^/\\]+$") & ~path.isin(".", "..")


def stays_inside(path: Column) -> Column:
    """A relative path whose segments never climb above where it starts."""
    plain = F.regexp_replace(path, r"\\", "/")
    steps = F.filter(F.split(plain, "/"), lambda s: (s != "") & (s != "."))
    depth = F.aggregate(steps, F.struct(F.lit(0).alias("now"), F.lit(0).alias("low")), _walk)
    return ~plain.rlike("^(?:/|[A-Za-z]:)") & (depth["low"] >= 0)


def _walk(acc: Column, step: Column) -> Column:
    now = acc["now"] + F.when(step == "..", -1).otherwise(1)
    return F.struct(now.alias("now"), F.least(acc["low"], now).alias("low"))


def holds_text(query: Column, *fields: Column) -> Column:
    """Whether the fields, joined, hold the query, whatever the case; an empty query is held by all."""
    return F.contains(F.lower(F.concat_ws(" ", *fields)), F.lower(F.trim(query)))


def confidence_tag(score: Column) -> Column:
    """undefined, high (0.9 and over), medium (0.75 and over) or low: the bands of lists, unlike those of reports."""
    return F.when(score.isNull(), "undefined").when(score >= 0.9, "high").when(score >= 0.75, "medium").otherwise("low")
