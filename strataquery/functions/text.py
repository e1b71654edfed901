"""Text rules as JVM expressions, and those that need Unicode tables as Arrow functions."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: How inequalities are shown.
INEQUALITIES = {"ca": "ca. ", "lt": "<", "gt": ">", "le": "≤", "ge": "≥"}
#: Unit words that may stand beside a number in a value.
UNIT_WORDS = (
    "c", "k", "pa", "kpa", "mpa", "gpa", "hz", "khz", "mhz", "ghz", "s", "sec", "min", "h", "m", "mm", "cm", "nm", "um", "kg", "g", "mg", "mol", "mmol",
    "l", "ml", "dl", "j", "kj", "w", "kw", "wt", "vol", "ppm", "ppb", "x", "times", "e", "d",
)
#: LaTeX commands that only set type or stand beside numbers.
LATEX_FORMAT = ("pm", "mp", "circ", "degree", "times", "cdot", "sim", "approx", "leq", "geq", "ll", "gg", "mathrm", "mathbf", "mathit", "text", "rm", "it", "bf", "left", "right", ",", ";", ":", "!", r"\s")


def heading_key(text: Column) -> Column:
    """Lower case without leading numbering, trailing punctuation and repeated space."""
    bare = F.regexp_replace(F.lower(F.trim(text)), r"^[0-9ivx]+(?:\.[0-9]+)*[.)]?\s+", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"[\s:.;,]+$", ""), r"\s+", " "))


def alnum_key(text: Column) -> Column:
    """Lower-case letters a-z, digits and CJK ideographs only."""
    return F.regexp_replace(F.lower(text), r"[^0-9a-z一-鿿]+", "")


def canonical_name(text: Column, aliases: dict[str, str] | None = None) -> Column:
    """Lower-case words joined by single spaces, then an alias where one is given."""
    name = F.trim(F.regexp_replace(F.lower(text), r"[^0-9a-z]+", " "))
    if not aliases:
        return name
    pairs = F.create_map(*[F.lit(x) for kv in sorted(aliases.items()) for x in kv])
    return F.coalesce(pairs[name], name)


def strip_tags(text: Column) -> Column:
    """Text of HTML: scripts, styles, comments and tags become spaces, and runs of space one."""
    bare = F.regexp_replace(text, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"\s+", " "))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def has_number(text: Column) -> Column:
    return text.rlike("[0-9]")


def looks_like_identifier(text: Column) -> Column:
    return F.trim(text).rlike(r"^[A-Za-z]{1,8}[-_]?[0-9]+(?:[-_][0-9]+)*$")


def is_value_like(text: Column, words: tuple[str, ...] = UNIT_WORDS) -> Column:
    """A number with unit words only: no ratio of numbers, no identifier, no other words, no variable with a subscript or command."""
    bare = F.regexp_replace(text, r"(?i)\\(?:" + "|".join(LATEX_FORMAT) + ")", " ")
    named = F.regexp_extract_all(F.lower(bare), F.lit("[a-z]+"), F.lit(0))
    among = lambda allowed: F.forall(named, lambda w: w.isin(*allowed))
    ratio = F.contains(text, F.lit(":")) & (F.size(F.regexp_extract_all(text, F.lit(r"[0-9]+(?:\.[0-9]+)?"), F.lit(0))) >= 2)
    formula = F.contains(text, F.lit("_")) | F.contains(text, F.lit("\\"))
    return has_number(text) & ~ratio & ~looks_like_identifier(F.replace(text, F.lit(" "), F.lit(""))) & among(words) & (~formula | among(("times", "e", "d")))


def shown_value(inequality: Column, low: Column, high: Column) -> Column:
    """An inequality sign and one number, or two with a dash; a dash alone without numbers. A sign that has no other form is shown as it is."""
    known = F.create_map(*[F.lit(x) for kv in INEQUALITIES.items() for x in kv])
    sign = F.coalesce(known[F.lower(inequality)], inequality, F.lit(""))
    one = F.concat(sign, F.coalesce(low, high))
    return F.when(low.isNull() & high.isNull(), F.lit("-")).when(low != high, F.concat(sign, low, F.lit("–"), high)).otherwise(one)


def display_id(name: Column, prefix: str = "PL") -> Column:
    """A stable id: 32-bit FNV-1a over the code units of the normalised (ASCII) name."""
    codes = F.transform(F.split(F.lower(F.trim(name)), ""), lambda c: F.ascii(c).cast("long"))
    h = F.aggregate(codes, F.lit(2166136261).cast("long"), lambda acc, c: (acc.bitwiseXOR(c) * F.lit(16777619)).bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.concat(F.lit(f"{prefix}-"), F.lpad(F.hex(h), 8, "0"))


def _unescaped(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", html.unescape(t)))


def unescape_nfkc(text: Column) -> Column:
    """HTML entities resolved, then NFKC. Neither exists in the JVM functions."""
    return F.pandas_udf(_unescaped, "string")(text)


def evidence_key(text: Column) -> Column:
    """What two texts are compared by: no tags, dashes alike, split decimals joined, one space, lower case."""
    x = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", " ")
    x = F.regexp_replace(x, r"<[^>]*>", " ")
    x = F.regexp_replace(x, "[‐-―−]", "-")
    x = F.regexp_replace(x, r"([0-9])\s*\.\s*(?=[0-9])", "$1.")
    x = F.regexp_replace(x, r"\s*([/(),;:])\s*", "$1")
    return F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))
