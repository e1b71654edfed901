"""Rules for what documents carry: counts, decimals, lists, maps, JSON text, cache keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRINGS = "array<string>"


def count_of(value: Column) -> Column:
    """A whole number of at least 0; anything else is 0."""
    return F.greatest(F.coalesce(value.cast("string").try_cast("long"), F.lit(0)), F.lit(0).cast("long"))


def usage_of(body: Column, shape: str) -> Column:
    """struct(input_tokens, output_tokens, cache_creation, cache_read) from a response's JSON, by the shape of its API."""
    at = lambda *keys: count_of(F.coalesce(*[F.get_json_object(body, f"$.usage.{k}") for k in keys]))
    if shape == "messages":
        parts = (at("input_tokens"), at("output_tokens"), at("cache_creation_input_tokens"), at("cache_read_input_tokens"))
    else:
        zero = F.lit(0).cast("long")
        parts = (at("prompt_tokens", "input_tokens"), at("completion_tokens", "output_tokens"), zero, zero)
    return F.struct(*[p.alias(n) for p, n in zip(parts, ("input_tokens", "output_tokens", "cache_creation", "cache_read"), strict=True)])


def decimal_of(value: Column) -> Column:
    """An exact decimal, null where the text is none."""
    return F.trim(value).try_cast("decimal(38,10)")


def reference_number(value: Column, digits: int = 7) -> Column:
    """A number that a sheet may hold as 123.0, in so many digits at least; other text as it is, trimmed."""
    whole = F.regexp_extract(F.trim(value.cast("string")), r"^([0-9]+)(?:\.0+)?$", 1)
    return F.when(whole != "", F.when(F.length(whole) < digits, F.lpad(whole, digits, "0")).otherwise(whole)).otherwise(F.trim(value.cast("string")))


def duration(started: Column, ended: Column) -> Column:
    """Seconds between, to the millisecond; null while one is missing."""
    return F.round(ended.cast("double") - started.cast("double"), 3)


def is_unique_list(values: Column) -> Column:
    return F.size(values) == F.size(F.array_distinct(values))


def series_references(one: Column, many: Column) -> Column:
    """A single reference and a list of them as one list, each once, the list first."""
    return F.array_distinct(F.concat(F.coalesce(many, F.array().cast(_STRINGS)), F.array_compact(F.array(one))))


def set_keys(*values: Column) -> Column:
    """The filled ones of several texts as lower-case keys, each once."""
    keys = F.transform(F.array(*values), lambda v: F.lower(F.trim(v)))
    return F.array_distinct(F.filter(keys, lambda k: k.isNotNull() & (k != "")))


def clean_map(values: Column) -> Column:
    """A map with trimmed keys and values and without empty ones."""
    trimmed = F.map_from_entries(F.transform(F.map_entries(F.map_filter(values, lambda k, v: F.trim(k) != "")), lambda e: F.struct(F.trim(e["key"]), F.trim(e["value"]))))
    return F.map_filter(trimmed, lambda _, v: F.coalesce(v, F.lit("")) != "")


def keys_within(inner: Column, outer: Column) -> Column:
    return F.size(F.array_except(F.map_keys(inner), F.map_keys(outer))) == 0


def scores_hold(scores: Column) -> Column:
    return F.forall(F.map_values(scores), lambda v: v.between(0, 1))


def merged_layers(*layers: Column) -> Column:
    """One map of several, later layers winning key by key; null layers count for nothing."""
    entries = F.flatten(F.transform(F.array(*[F.map_entries(F.coalesce(m, F.map_from_arrays(F.array().cast(_STRINGS), F.array().cast(_STRINGS)))) for m in layers]), lambda x: x))
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]
    return F.map_from_arrays(keys, F.transform(keys, last))


def layers_used(**layers: Column) -> Column:
    """The names of the layers that hold anything, in the order given."""
    return F.array_compact(F.array(*[F.when(F.size(m) > 0, F.lit(n)) for n, m in layers.items()]))


def unsupported_keys(values: Column, source: Column) -> Column:
    """The keys, sorted, whose values the source doesn't hold, both normalised alike before."""
    return F.array_sort(F.map_keys(F.map_filter(values, lambda _, v: ~F.contains(source, v))))


# --- JSON text ----------------------------------------------------------------------------------------------


def _is_object(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull() & F.trim(text).startswith("{")


def escaped_backslashes(text: Column) -> Column:
    """JSON text whose backslashes all begin an escape: one that doesn't is doubled."""
    return F.regexp_replace(text, r'((?<!\\)(?:\\\\)*\\)(?!["\\/bfnrtu])', r"$1\\")


def unfenced(text: Column) -> Column:
    """What stands in the first fence of code, else all."""
    inner = F.regexp_extract(text, r"(?is)```(?:json)?\s*(.*?)\s*```", 1)
    return F.trim(F.when(text.rlike(r"(?is)```(?:json)?\s*.*?\s*```"), inner).otherwise(text))


def braced(text: Column) -> Column:
    """From the first opening to the last closing brace; null without both."""
    cut = F.regexp_extract(text, r"(?s)^[^{]*(\{.*\})[^}]*$", 1)
    return F.when(cut != "", cut)


#: Malformed separators that were seen, and what they stand for. The first two are mended where they stand once.
SEPARATORS = {',"},"confidence"': '},"confidence"', ',","confidence"': ',"confidence"'}
EXTRA_CLOSE = ('}}}]},{"confidence"', '}}]},{"confidence"')
MISSING_CLOSE = (r'("source_sentence"\s*:\s*"(?:\\.|[^"\\])*")\s*,\s*"confidence"\s*:', '$1},"confidence":')


def mended(text: Column) -> Column:
    """JSON text with the malformations that were seen put right."""
    for bad, good in SEPARATORS.items():
        once = F.length(text) - F.length(F.replace(text, F.lit(bad), F.lit(""))) == len(bad)
        text = F.when(once, F.replace(text, F.lit(bad), F.lit(good))).otherwise(text)
    text = F.replace(text, F.lit(EXTRA_CLOSE[0]), F.lit(EXTRA_CLOSE[1]))
    return escaped_backslashes(F.regexp_replace(text, *MISSING_CLOSE))


def json_object(text: Column) -> Column:
    """struct(json, how): the object in a text, and whether it stood there plain, in a fence, in braces, or was mended; null and ``truncated`` or ``none`` otherwise."""
    inner = unfenced(text)
    cut = braced(inner)
    fixed = mended(cut)
    plain, sliced, healed = _is_object(inner), _is_object(cut), _is_object(fixed)
    how = (
        F.when(plain, F.when(inner == F.trim(text), "plain").otherwise("fenced"))
        .when(F.coalesce(sliced, F.lit(False)), "braced")
        .when(F.coalesce(healed, F.lit(False)), "mended")
        .when(F.contains(inner, F.lit("{")), "truncated")
        .otherwise("none")
    )
    found = F.when(plain, inner).when(F.coalesce(sliced, F.lit(False)), cut).when(F.coalesce(healed, F.lit(False)), fixed)
    return F.struct(found.alias("json"), how.alias("how"))


# --- cache keys ---------------------------------------------------------------------------------------------


def text_hash(content: Column) -> Column:
    """SHA-256 of a text with line feeds alone at line ends."""
    return F.sha2(F.regexp_replace(content, "\r\n?", "\n"), 256)


def cache_key(**parts: Column) -> Column:
    """SHA-256 of the parts as canonical JSON: sorted names, nulls kept."""
    return F.sha2(F.to_json(F.struct(*[parts[n].alias(n) for n in sorted(parts)]), {"ignoreNullFields": "false"}), 256)


def without_defaults(config: Column, defaults: Mapping[str, str]) -> Column:
    """A map of settings without those that have their default: what older keys were made of."""
    usual = F.create_map(*[F.lit(x) for kv in sorted(defaults.items()) for x in kv])
    return F.map_filter(config, lambda k, v: ~F.coalesce(usual[k] == v, F.lit(False)))
