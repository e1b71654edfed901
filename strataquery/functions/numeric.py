"""Numeric rules: ratios of nothing, bands, intervals, units, exact money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a ratio over nothing is, and to how many digits others are rounded (None: not at all).
RATIO_RULES = {"audit": (None, 6), "rate": (0.0, 4), "complete": (1.0, None), "safe": (None, None)}


def ratio(part: Column, whole: Column, rule: str) -> Column:
    """part / whole under one of RATIO_RULES."""
    empty, digits = RATIO_RULES[rule]
    value = part.cast("double") / whole
    value = value if digits is None else F.round(value, digits)
    return F.when(whole > 0, value).otherwise(F.lit(empty).cast("double"))


def f1_metrics(matched: Column, differing: Column, only_truth: Column, only_found: Column) -> list[Column]:
    """precision, recall and f1 of an alignment: a pair whose values differ counts against both."""
    precision = matched / F.nullif(matched + differing + only_found, F.lit(0))
    recall = matched / F.nullif(matched + differing + only_truth, F.lit(0))
    f1 = 2 * matched / F.nullif(2 * matched + 2 * differing + only_truth + only_found, F.lit(0))
    return [F.coalesce(F.round(x, 4), F.lit(0.0)).alias(n) for n, x in (("precision", precision), ("recall", recall), ("f1", f1))]


def confidence_band(score: Column) -> Column:
    """missing, high (0.8 and over), medium (0.5 and over) or low."""
    return F.when(score.isNull(), "missing").when(score >= 0.8, "high").when(score >= 0.5, "medium").otherwise("low")


def intervals_match(low: Column, high: Column, other_low: Column, other_high: Column) -> Column:
    """Whether two intervals overlap within 1e-6 or one hundredth of either lower end."""
    slack = F.greatest(F.lit(1e-6), 0.01 * F.abs(low), 0.01 * F.abs(other_low))
    return (low <= other_high + slack) & (other_low <= high + slack)


def value_range(text: Column) -> Column:
    """struct(low, high) of the first number, or of two joined by a dash or "to"; null without one."""
    number = r"([-+]?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)"
    both = rf"{number}\s*(?:-|–|~|to)\s*{number}"
    paired = F.regexp_extract(text, both, 2) != ""
    low = F.when(paired, F.regexp_extract(text, both, 1)).otherwise(F.regexp_extract(text, number, 1))
    high = F.when(paired, F.regexp_extract(text, both, 2)).otherwise(low)
    value = F.struct(low.try_cast("double").alias("low"), high.try_cast("double").alias("high"))
    return F.when(low != "", value)


def unit_of_header(header: Column) -> Column:
    """The unit of a column header: the last one in brackets, else what follows the last slash or comma."""
    bracketed = F.regexp_extract(header, r"[(\[]([^()\[\]]+)[)\]]\s*$", 1)
    tail = F.trim(F.regexp_extract(header, r"(?:\s/\s*|,\s*)([^/,]+)$", 1))
    return F.when(bracketed != "", F.trim(bracketed)).when(tail != "", tail)


def token_cost(tokens: Column, per_million: Column) -> Column:
    """Exact cost: tokens at a price per million, as a decimal."""
    return (tokens.cast("decimal(20,0)") * per_million.cast("decimal(18,6)") / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(38,10)")


#: Spellings of units in headers, lower case, and the unit that each stands for.
UNIT_ALIASES = {
    "°c": "°C", "oc": "°C", "℃": "°C", "\\circ c": "°C", "deg c": "°C", "k": "K",
    "mpa": "MPa", "gpa": "GPa", "kpa": "kPa", "pa": "Pa",
    "j/m": "J/m", "kj/m": "kJ/m", "j/m2": "J/m²", "kj/m2": "kJ/m²", "j/m^2": "J/m²", "kj/m^2": "kJ/m²",
    "s/cm": "S/cm", "s/m": "S/m", "ohm*cm": "Ω·cm", "ohm cm": "Ω·cm", "ω·cm": "Ω·cm", "ωcm": "Ω·cm", "ohm*m": "Ω·m", "ω·m": "Ω·m", "1/(ohm*cm)": "S/cm", "s cm-1": "S/cm", "scm-1": "S/cm",
    "dl/g": "dL/g", "dlg-1": "dL/g", "dl g-1": "dL/g", "dl/g-1": "dL/g", "ml/g": "mL/g",
    "g/cm3": "g/cm³", "g/cm^3": "g/cm³", "gcm-3": "g/cm³", "mj/m2": "mJ/m²", "mj/m^2": "mJ/m²", "mn/m": "mN/m", "dyn/cm": "dyn/cm",
    "j/g": "J/g", "kj/mol": "kJ/mol", "kcal/mol": "kcal/mol", "kcal/g": "kcal/g", "kj/g": "kJ/g", "cal/g": "cal/g", "j/mol": "J/mol", "j/(g k)": "J/(g·K)",
    "g/mol": "g/mol", "gmol-1": "g/mol", "kg/mol": "kg/mol", "%": "%", "wt%": "wt%", "vol%": "vol%", "mol%": "mol%",
    "nm": "nm", "μm": "μm", "um": "μm", "mm": "mm", "cm": "cm", "å": "Å", "hz": "Hz", "mhz": "MHz", "khz": "kHz",
}
#: Spellings that become others before units are looked for, in this order.
UNIT_SPELLINGS = (("\\%", "%"), ("\\,", " "), ("\\;", " "), ("^\\circ", "°"), ("\\circ", "°"), ("^o", "°"))
UNIT_SYMBOLS = (("\\Omega", "ohm"), ("Ω", "ω"), ("·", "*"), ("⋅", "*"), ("$", ""), ("{", ""), ("}", ""))


def unit_text(header: Column) -> Column:
    """A header in one spelling: no LaTeX, one sign for degrees and ohms, inverse exponents as a slash, lower case."""
    x = header
    for _ in range(3):  # wrappers may be nested
        x = F.regexp_replace(x, r"\\(?:text|mathrm|mathit|rm|it|bf)\s*\{([^{}]*)\}", "$1")
    for was, now in UNIT_SPELLINGS:
        x = F.replace(x, F.lit(was), F.lit(now))
    x = F.regexp_replace(x, r"(?i)°\s*([a-z])", "°$1")
    for was, now in UNIT_SYMBOLS:
        x = F.replace(x, F.lit(was), F.lit(now))
    x = F.when(x.rlike("[a-zμω]"), F.regexp_replace(x, r"(?i)\s*([a-zμω]+)\s*(?:\^\s*)?(?:-\s*1|⁻¹)(?![0-9.])", "/$1")).otherwise(x)
    return F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))


def unit_token(part: Column) -> Column:
    """A part without the brackets and marks around it."""
    bare = F.regexp_replace(F.trim(part), r"^[（）()\[\]]+|[（）()\[\]]+$", "")
    return F.trim(F.regexp_replace(F.trim(bare), r"^[,.;:·*]+|[,.;:·*]+$", ""))


def unit_parts(header: Column) -> Column:
    """All parts of a header in one spelling that may be its unit, likelier ones first."""
    found = lambda s, p: F.nullif(F.regexp_extract(s, p, 1), F.lit(""))

    def tails(s: Column) -> Column:
        words = F.split(F.trim(s), r"\s+")
        last = F.when((F.size(words) > 1) & ~F.element_at(words, -2).rlike("[0-9]$"), F.element_at(words, -1))
        return F.array_compact(F.array(found(s, r"^[^/]*/(.*)$"), found(s, r"^.*\^([^^]*)$"), found(s, r"^[^^]*\^(.*)$"), found(s, r"(?<![0-9])\s*(°\s*[a-z]?\.?)\s*$"), last))

    bare = F.trim(F.regexp_replace(header, r"[（(\[][^）)\]]*[）)\]]", " "))
    parts = F.concat(F.regexp_extract_all(header, F.lit(r"[（(\[]([^）)\]]*)[）)\]]"), F.lit(1)), F.array(header, bare), F.split(bare, "[,，;；]"))
    return F.concat(parts, F.flatten(F.transform(F.concat(F.array(bare, header), parts), tails)))


def unit_of_headers(headers: Column) -> Column:
    """The unit that the levels of a column's header name, the last level first; null where no part is a known spelling."""
    known = F.create_map(*[F.lit(x) for kv in UNIT_ALIASES.items() for x in kv])
    of = lambda h: F.get(F.filter(F.transform(unit_parts(unit_text(h)), lambda p: F.try_element_at(known, unit_token(p))), lambda u: u.isNotNull()), F.lit(0))
    levels = F.reverse(F.filter(headers, lambda h: F.trim(h) != ""))
    return F.get(F.filter(F.transform(levels, of), lambda u: u.isNotNull()), F.lit(0))
