"""Surface text: finding what a source says for a candidate, the sentence around it, and keys that fold notation.

JVM expressions; a null input gives null. Patterns built from a row's own text are quoted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: LaTeX commands and the characters they stand for.
LATEX_SIGNS = {
    r"\pm": "±", r"\mp": "∓", r"\times": "×", r"\cdot": "·", r"\%": "%", r"\mu": "μ", r"\eta": "η", r"\delta": "δ", r"\Delta": "Δ", r"\chi": "χ", r"\alpha": "α", r"\beta": "β", r"\gamma": "γ",
    r"\lambda": "λ", r"\sigma": "σ", r"\rho": "ρ", r"\theta": "θ", r"\omega": "ω",
}
#: Spellings that a comparison takes as one, in this order.
COMPARED = {r"\$\pm\$": "±", r"\pm": "±", r"\mp": "∓", r"^{\circ}": "°", r"^\circ": "°", r"\mathrm{C}": "C", r"\delta": "δ", r"\chi": "χ", r"\eta": "η", "$": ""}
#: Where a sentence ends.
SENTENCE_END = r"[.!?。！？]\s+|\n+"
#: Names of types, and what a name says where no type is given.
TYPE_LABELS = {"homopolymer": "Homopolymer", "copolymer": "Copolymer", "random_copolymer": "Random copolymer", "block_copolymer": "Block copolymer", "graft_copolymer": "Graft copolymer", "terpolymer": "Terpolymer", "blend": "Polymer blend", "composite": "Composite"}


def quoted(text: Column) -> Column:
    """A pattern that finds the text as it is."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def comparison_key(text: Column) -> Column:
    for was, now in COMPARED.items():
        text = F.replace(text, F.lit(was), F.lit(now))
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def folded_latex(text: Column) -> Column:
    """Text without LaTeX wrappers, degrees and signs as characters, and no other marks of it."""
    x = F.regexp_replace(text, r"\\mathrm\s*\{([^{}]*)\}|\\text(?:rm|bf|it)?\s*\{([^{}]*)\}", "$1$2")
    x = F.regexp_replace(x, r"\^\s*\{?\s*\\circ\s*\}?", "°")
    for was, now in LATEX_SIGNS.items():
        x = F.replace(x, F.lit(was), F.lit(now))
    return F.regexp_replace(x, r"[\\${}]", " ")


def joined_numbers(text: Column) -> Column:
    """Numbers that were taken apart (0 . 0 6 3) in one piece, where a point or comma shows that they are one; two numbers side by side stay two."""
    parts = F.regexp_extract_all(text, F.lit(r"(?<![\w.])([0-9](?:\s*[0-9])*\s*[.,]\s*[0-9](?:\s*[0-9.,])*)(?!\w)"), F.lit(1))
    return F.aggregate(F.array_distinct(parts), text, lambda t, p: F.replace(t, p, F.regexp_replace(p, r"\s+", "")))


def formula_key(text: Column) -> Column:
    """Letters and digits without LaTeX commands, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, r"\\[A-Za-z]+", ""), r"[^\p{L}\p{N}]", ""))


def compact_formula(text: Column) -> Column:
    """ASCII letters and digits without tags and LaTeX commands, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", ""), r"\\[A-Za-z]+", ""), "[^A-Za-z0-9]+", ""))


def unit_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[\s()]+", "")


def found_spaced(source: Column, candidate: Column) -> Column:
    """What the source says for a candidate if white space counts for nothing; null where it does not hold it."""
    letters = F.split(F.regexp_replace(candidate, r"\s+", ""), "")
    pattern = F.array_join(F.transform(letters, lambda c: F.concat(F.lit(r"\Q"), c, F.lit(r"\E"))), r"\s*")
    return F.when(F.trim(candidate) != "", F.regexp_substr(source, pattern))


def found_surface(source: Column, candidate: Column) -> Column:
    """What the source says for a candidate: as it is, in another case, or with other white space and hyphens; null where it does not hold it."""
    exact = F.when(F.contains(source, candidate), candidate)
    cased = F.regexp_substr(source, F.concat(F.lit("(?i)"), quoted(candidate)))
    words = F.filter(F.split(candidate, r"[\s‐-―−-]+"), lambda w: w != "")
    loose = F.regexp_substr(source, F.concat(F.lit("(?i)"), F.array_join(F.transform(words, quoted), r"[\s‐-―−-]*")))
    return F.when(candidate != "", F.coalesce(exact, cased, F.when(F.size(words) > 0, loose)))


def found_token(source: Column, candidate: Column) -> Column:
    """What the source says for a candidate that stands as a word of its own."""
    return F.regexp_substr(source, F.concat(F.lit("(?i)(?<![A-Za-z0-9])"), quoted(candidate), F.lit("(?![A-Za-z0-9])")))


def sentence_around(text: Column, anchor: Column, most: int) -> Column:
    """The sentence of the first place of an anchor, cut to a window of so many characters that begins half of them before the anchor; null where it is not held."""
    at = F.instr(text, anchor)
    before, after = F.substring(text, F.lit(1), at - 1), F.substring(text, at + F.length(anchor), F.length(text))
    start = F.length(F.regexp_extract(before, rf"(?s)\A(.*(?:{SENTENCE_END}))", 1))
    stop = F.regexp_instr(after, F.lit(SENTENCE_END))
    end = F.when(stop > 0, at - 1 + F.length(anchor) + stop).otherwise(F.length(text))
    raw = F.substring(text, start + 1, end - start)
    sentence = F.regexp_replace(raw, r"\A\s+|\s+\z", "")
    left = F.greatest(F.instr(sentence, anchor) - 1 - most // 2, F.lit(0))
    right = F.least(F.length(sentence), left + most)
    window = F.regexp_replace(F.substring(sentence, F.greatest(right - most, F.lit(0)) + 1, right - F.greatest(right - most, F.lit(0))), r"\A\s+|\s+\z", "")
    return F.when(at > 0, F.when(F.length(sentence) <= most, sentence).otherwise(window))


def label_parts(label: Column) -> Column:
    """The filled parts of a row label between slashes with space around them."""
    return F.filter(F.transform(F.split(label, r"\s+/\s+"), lambda t: F.trim(t)), lambda p: p != "")


def figure_label(caption: Column, number: Column) -> Column:
    """Fig. and the number of a caption, else the group's own."""
    found = F.regexp_extract(F.coalesce(caption, F.lit("")), r"(?i)\b(?:fig(?:ure)?\.?)\s*([A-Za-z]?[0-9]+[A-Za-z]?)", 1)
    return F.when(found != "", F.concat(F.lit("Fig. "), found)).otherwise(F.concat(F.lit("图组 "), number.cast("string")))


def reference_id(name: Column) -> Column:
    """The reference a file name or id stands for; null where it is none."""
    stem = F.regexp_replace(F.regexp_extract(F.trim(name), "[^/]*$", 0), r"(?<=.)\.[^.]*$", "")
    ref = F.regexp_replace(stem, "_document$", "")
    return F.when(ref.rlike(r"^reference_no_[0-9]+$"), ref)


def data_id(name: Column, most: int = 117) -> Column:
    """A readable id of a file: its stem in safe characters, and the first ten hex digits of the SHA-1 of its name."""
    stem = F.regexp_replace(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), "[^A-Za-z0-9_.-]+", "_")
    safe = F.regexp_replace(stem, r"^[_.-]+|[_.-]+$", "")
    return F.concat(F.substring(F.when(safe == "", "document").otherwise(safe), 1, most), F.lit("-"), F.substring(F.sha1(name), 1, 10))


def joined_text(parts: Column) -> Column:
    """The filled ones of several texts, trimmed, with semicolons between; null of none."""
    filled = F.filter(F.transform(parts, lambda t: F.trim(t)), lambda p: p != "")
    return F.nullif(F.array_join(filled, "; "), F.lit(""))


def map_text(values: Column, between: str = "; ") -> Column:
    """``key: value`` of the filled entries of a map in its order, underscores of keys as space; null of none."""
    filled = F.filter(F.map_entries(values), lambda e: F.trim(e["value"]) != "")
    return F.nullif(F.array_join(F.transform(filled, lambda e: F.concat(F.replace(e["key"], F.lit("_"), F.lit(" ")), F.lit(": "), F.trim(e["value"]))), between), F.lit(""))


def type_label(kind: Column, name: Column, known_homopolymer: Column) -> Column:
    """The label of a type, else what the name says."""
    n = F.lower(F.coalesce(name, F.lit("")))
    said = F.when(n.rlike("blend|composite|/"), "Blend / composite").when(F.contains(n, F.lit("terpolymer")), "Terpolymer").when(F.contains(n, F.lit("copolymer")), "Copolymer").when(known_homopolymer, "Homopolymer").otherwise("待确认")
    labels = F.create_map(*[F.lit(x) for kv in TYPE_LABELS.items() for x in kv])
    return F.coalesce(F.try_element_at(labels, F.coalesce(kind, F.lit(""))), said)


def highlight_terms(fields: Column) -> Column:
    """Texts of two characters or more, each once, longest first; of one length in the order given."""
    some = F.array_distinct(F.filter(fields, lambda t: F.length(t) > 1))
    keyed = F.transform(some, lambda t, i: F.struct((-F.length(t)).alias("n"), i.alias("i"), t.alias("t")))
    return F.transform(F.array_sort(keyed), lambda x: x["t"])


def cells_match(cell: Column, asked: Column) -> Column:
    """Whether a cell is what a locator names: equal once tags, dollar signs and case are gone; or one holds the other, where neither is a number and both have three letters or digits."""
    bare = lambda t: F.lower(F.trim(F.regexp_replace(F.replace(F.regexp_replace(t, "<[^>]*>", " "), F.lit("$"), F.lit("")), r"\s+", " ")))
    a, b = bare(cell), bare(asked)
    number = lambda t: t.rlike(r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$")
    letters = lambda t: F.length(F.regexp_replace(t, r"[^\p{L}\p{N}]", ""))
    some = (a != "") & (b != "")
    return some & ((a == b) | (~number(a) & ~number(b) & (F.least(letters(a), letters(b)) >= 3) & (F.contains(a, b) | F.contains(b, a))))


def glued_coverage(needle: Column, haystack: Column) -> Column:
    """The share of needle's words, with repetition, that haystack has; a word of letters alone may also be part of such a word there, digits never. Arguments are arrays of words."""
    count = lambda words, w: F.size(words) - F.size(F.array_remove(words, w))

    def share(x: Column) -> Column:
        def hits(acc: Column, w: Column) -> Column:
            n, m = count(x["a"], w), count(x["b"], w)
            glued = F.when(~w.rlike("[0-9]") & F.exists(x["b"], lambda y: ~y.rlike("[0-9]") & F.contains(y, w)), n)
            return acc + F.greatest(F.least(n, m), F.coalesce(glued, F.lit(0)))

        return F.when(F.size(x["a"]) > 0, F.aggregate(F.array_distinct(x["a"]), F.lit(0), hits) / F.size(x["a"])).otherwise(0.0)

    # computed once: in a lambda an outer expression is computed for each element
    return F.get(F.transform(F.array(F.struct(needle.alias("a"), haystack.alias("b"))), share), F.lit(0))
