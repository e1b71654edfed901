"""Rules over flat tables that give issue rows, in a strict and a preview mode.

An issue is (document_id, code, object_id, severity, message). A rule says what severity it has in strict
mode; in preview mode rules about representation become warnings, and what is wrong with an object isolates
that object.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataquery.functions.numeric import ratio
from strataquery.functions.payload import unsupported_keys
from strataquery.functions.text import evidence_key
from strataquery.operators.evidence import match_ladder
from strataquery.operators.graph import cyclic_nodes
from strataquery.operators.salvage import salvage

ISSUE = ("document_id", "code", "object_id", "severity", "message")


@dataclass(frozen=True)
class Rule:
    """A condition that rows of a table must meet (null counts as met)."""

    code: str
    table: str
    key: str
    holds: Column
    message: str = ""
    #: Whether preview mode treats it as a warning.
    relaxed: bool = False


@dataclass(frozen=True)
class Reference:
    """A column whose values must be keys of another table in the same document."""

    code: str
    table: str
    key: str
    column: str
    target: str
    target_key: str
    relaxed: bool = False


def _severity(relaxed: bool, mode: str) -> str:
    if mode not in ("strict", "preview"):
        raise ValueError(f"unknown mode {mode!r}")
    return "warning" if relaxed and mode == "preview" else "error"


def _issues(rows: DataFrame, code: str, key: str, severity: str, message: str) -> DataFrame:
    return rows.select("document_id", F.lit(code).alias("code"), F.col(key).cast("string").alias("object_id"), F.lit(severity).alias("severity"), F.lit(message).alias("message"))


def check_rules(tables: Mapping[str, DataFrame], rules: Sequence[Rule], mode: str) -> list[DataFrame]:
    return [_issues(tables[r.table].where(~F.coalesce(r.holds, F.lit(True))), r.code, r.key, _severity(r.relaxed, mode), r.message or r.code) for r in rules]


def check_references(tables: Mapping[str, DataFrame], references: Sequence[Reference], mode: str) -> list[DataFrame]:
    out = []
    for r in references:
        known = tables[r.target].select("document_id", F.col(r.target_key).alias(r.column))
        lost = tables[r.table].where(F.col(r.column).isNotNull()).join(known, ["document_id", r.column], "left_anti")
        out.append(_issues(lost, r.code, r.key, _severity(r.relaxed, mode), f"{r.column} names no {r.target}"))
    return out


def check_unique(table: DataFrame, key: str, code: str) -> DataFrame:
    twice = table.groupBy("document_id", key).agg(F.count("*").alias("n")).where("n > 1")
    return _issues(twice, code, key, "error", f"{key} is not unique")


def issues(parts: Sequence[DataFrame]) -> DataFrame:
    """All issues, each once."""
    return reduce(DataFrame.unionByName, parts).dropDuplicates(["document_id", "code", "object_id", "message"])


def verdicts(documents: DataFrame, found: DataFrame) -> DataFrame:
    """document_id, error_count, warning_count, status: passed where there is no error."""
    per = found.groupBy("document_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    zero = F.lit(0).cast("long")
    out = documents.select("document_id").join(per, "document_id", "left").select("document_id", F.coalesce("errors", zero).alias("error_count"), F.coalesce("warnings", zero).alias("warning_count"))
    return out.withColumn("status", F.when(F.col("error_count") == 0, "passed").otherwise("failed"))


def quality_metrics(rows: DataFrame, metrics: Mapping[str, tuple[Column, Column]], *group: str) -> DataFrame:
    """metric, complete, total, ratio for each (in scope, complete) pair; 1.0 of nothing."""
    counts = rows.groupBy(*group).agg(*[c for n, (scope, done) in metrics.items() for c in (F.count_if(scope).alias(f"{n}_total"), F.count_if(scope & done).alias(f"{n}_complete"))])
    packed = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"{n}_complete").alias("complete"), F.col(f"{n}_total").alias("total")) for n in metrics]))
    flat = counts.select(*group, packed.alias("m")).select(*group, "m.*")
    return flat.withColumn("ratio", ratio(F.col("complete"), F.col("total"), "complete"))


def all_or_none(*columns: str) -> Column:
    """Either all columns are null or none is."""
    given = sum((F.col(c).isNotNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNotNull().cast("int"))
    return given.isin(0, len(columns))


def exactly_one(*columns: str) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNotNull().cast("int")) == 1


def scope_holds(status: Column, one: Column, many: Column) -> Column:
    """resolved has one subject, multi_resolved several different ones, unresolved none."""
    several = F.coalesce(F.size(F.array_distinct(many)), F.lit(0))
    return (
        F.when(status == "resolved", one.isNotNull() & (several == 0))
        .when(status == "multi_resolved", one.isNull() & (several >= 2) & (several == F.size(many)))
        .when(status == "unresolved", one.isNull() & (several == 0))
        .otherwise(F.lit(False))
    )


def coverage_holds(expected: Column, covered: Column, missing: Column, skipped: Column, share: Column) -> Column:
    """The parts add up, and the share is theirs (1.0 of nothing) within 1e-9."""
    return (expected == covered + missing + skipped) & (F.abs(share - F.when(covered + missing > 0, covered / (covered + missing)).otherwise(1.0)) <= 1e-9)


def totals_hold(total: Column, *parts: Column) -> Column:
    return total == sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0)))


# --- more rules ---------------------------------------------------------------------------------------------


def cost_holds(status: Column, *amounts: Column) -> Column:
    """calculated: every amount, none below 0; unavailable: none; not_applicable: none but 0."""
    every, none, zero = F.lit(True), F.lit(True), F.lit(True)
    for a in amounts:
        every, none, zero = every & F.coalesce(a >= 0, F.lit(False)), none & a.isNull(), zero & (F.coalesce(a, F.lit(0)) == 0)
    return F.when(status == "calculated", every).when(status == "unavailable", none).when(status == "not_applicable", zero).otherwise(F.lit(False))


def payload_holds(kind: Column, needs: Mapping[str, Column]) -> Column:
    """Each kind has what it needs, and nothing that belongs to another kind; a kind without an entry needs nothing."""
    rule = F.lit(True)
    for name, column in needs.items():
        rule = rule & F.when(kind == name, column.isNotNull()).otherwise(column.isNull())
    return rule


def several_holds(values: Column) -> Column:
    """A list is missing, or has two values at least, each once."""
    return values.isNull() | ((F.size(values) >= 2) & (F.size(values) == F.size(F.array_distinct(values))))


def stated_holds(status: Column, *values: Column) -> Column:
    """stated: some value; not_stated: none."""
    some = F.lit(False)
    for v in values:
        some = some | v.isNotNull()
    return F.when(status == "stated", some).when(status == "not_stated", ~some).otherwise(F.lit(False))


def only_for(kind: Column, kinds: Sequence[str], column: Column) -> Column:
    """A column stands with some kinds alone."""
    return column.isNull() | F.coalesce(kind.isin(*kinds), F.lit(False))


def all_null_when(when: Column, *columns: Column) -> Column:
    none = F.lit(True)
    for c in columns:
        none = none & c.isNull()
    return ~when | none


def share_holds(share: Column, part: Column, whole: Column, digits: int = 9) -> Column:
    """A share is that of its counts (1.0 of nothing) within a unit of the last digit."""
    return F.abs(share - ratio(part, whole, "complete")) <= 10.0**-digits


def verdict_holds(status: Column, errors: Column) -> Column:
    return (status == "passed") == (errors == 0)


def point_holds(status: Column, value: Column, evidence: Column) -> Column:
    """covered: a value and evidence; missing and not_applicable: no value."""
    return F.when(status == "covered", value.isNotNull() & (F.size(evidence) > 0)).when(status.isin("missing", "not_applicable"), value.isNull()).otherwise(F.lit(False))


def check_parents(table: DataFrame, key: str, parent: str) -> DataFrame:
    """Issues of a parent graph in each document: unknown_parent, self_parent, parent_cycle."""
    rows = table.where(F.col(parent).isNotNull()).select("document_id", key, parent)
    unknown = rows.join(table.select("document_id", F.col(key).alias(parent)), ["document_id", parent], "left_anti")
    own = rows.where(F.col(key) == F.col(parent))
    node = lambda c: F.concat_ws("\x1f", F.col("document_id").cast("string"), F.col(c).cast("string"))
    others = rows.where(F.col(key) != F.col(parent))
    cyclic = cyclic_nodes(others.select(node(key).alias("a"), node(parent).alias("b")))
    on_cycle = others.join(cyclic, node(key) == F.col("node"), "left_semi")
    return reduce(DataFrame.unionByName, [_issues(unknown, "unknown_parent", key, "error", f"{parent} is unknown"), _issues(own, "self_parent", key, "error", f"{parent} is the object itself"), _issues(on_cycle, "parent_cycle", key, "error", f"{parent} leads into a cycle")])


def check_steps(samples: DataFrame, steps: DataFrame, cycles: bool = True) -> DataFrame:
    """Issues of a process graph: unknown_sample, in_and_out, several_producers and, unless left out, step_cycle.

    samples: document_id, sample_id; steps: document_id, step_id, inputs, outputs (lists). Steps meet the samples of their
    document as one list, so samples travel by document alone.
    """
    side = lambda c: steps.select("document_id", "step_id", F.explode(c).alias("sample_id")).distinct()
    none = F.array().cast(steps.schema["inputs"].dataType)
    known = samples.groupBy("document_id").agg(F.collect_set("sample_id").alias("__known"))
    named = F.array_union(F.coalesce("inputs", none), F.coalesce("outputs", none))
    met = steps.select("document_id", "step_id", named.alias("__named")).join(known, "document_id", "left")
    unknown = met.where(F.size(F.array_except("__named", F.coalesce("__known", none))) > 0).select("document_id", "step_id").distinct()
    both = steps.where(F.size(F.array_intersect("inputs", "outputs")) > 0)
    outputs = side("outputs")
    many = outputs.groupBy("document_id", "sample_id").agg(F.count_distinct("step_id").alias("n")).where("n > 1")
    found = [_issues(unknown, "unknown_sample", "step_id", "error", "a sample is unknown"), _issues(both, "in_and_out", "step_id", "error", "a sample goes in and comes out"), _issues(many, "several_producers", "sample_id", "error", "several steps make it")]
    if cycles:
        name = lambda c: F.concat_ws("\x1f", F.col("document_id").cast("string"), F.col(c).cast("string"))
        links = side("inputs").select("document_id", "step_id", F.col("sample_id").alias("a")).join(outputs.select("document_id", "step_id", F.col("sample_id").alias("b")), ["document_id", "step_id"]).where("a <> b")
        cyclic = cyclic_nodes(links.select(name("a").alias("a"), name("b").alias("b")))
        looped = samples.join(cyclic, name("sample_id") == F.col("node"), "left_semi")
        found.append(_issues(looped, "step_cycle", "sample_id", "error", "steps lead into a cycle"))
    return reduce(DataFrame.unionByName, found)


def check_owners(items: DataFrame, owners: DataFrame) -> DataFrame:
    """Issues of ownership told from both ends: not_listed (the owner doesn't list the item), not_owned (a listed item names another owner or is unknown).

    items: document_id, item_id, owner_id; owners: document_id, owner_id, listed (item ids).
    """
    told = items.where("owner_id IS NOT NULL").select("document_id", "item_id", "owner_id")
    listed = owners.select("document_id", F.explode("listed").alias("item_id"), "owner_id").distinct()
    keys = ["document_id", "item_id", "owner_id"]
    return _issues(told.join(listed, keys, "left_anti"), "not_listed", "item_id", "error", "its owner does not list it").unionByName(_issues(listed.join(told, keys, "left_anti"), "not_owned", "item_id", "error", "listed, but not owned"))


def check_evidence(evidence: DataFrame, blocks: DataFrame) -> DataFrame:
    """Issues of evidence (document_id, object_id, block_id, page, source_type, sentence): unknown_block, page_mismatch, type_mismatch, evidence_not_in_source, and found_elsewhere (a warning) where one other block of the document holds the sentence.

    blocks: document_id, block_id, page, type, text.
    """
    at = blocks.select("document_id", "block_id", F.col("page").alias("__page"), F.col("type").alias("__type"), F.col("text").alias("__text"))
    met = evidence.join(at, ["document_id", "block_id"], "left")
    known = F.col("__type").isNotNull()
    unknown = met.where(~known)
    page = met.where(known & ~F.col("page").eqNullSafe(F.col("__page")))
    kind = met.where(known & ~F.col("source_type").eqNullSafe(F.col("__type")))
    lost = met.where(known & (match_ladder(F.col("sentence"), F.col("__text")) == "unresolved")).select("document_id", "object_id", "block_id", "sentence").distinct()
    # other blocks of the same document alone
    others = lost.join(blocks.select("document_id", F.col("block_id").alias("__other"), evidence_key(F.col("text")).alias("__b")), "document_id").where("__other <> block_id")
    held = others.where(F.contains("__b", evidence_key(F.col("sentence")))).groupBy("document_id", "object_id", "block_id", "sentence").agg(F.count("*").alias("n")).where("n = 1")
    gone = lost.join(held, ["document_id", "object_id", "block_id", "sentence"], "left_anti")
    made = [("unknown_block", unknown, "error"), ("page_mismatch", page, "error"), ("type_mismatch", kind, "error"), ("evidence_not_in_source", gone, "error"), ("found_elsewhere", held, "warning")]
    return reduce(DataFrame.unionByName, [_issues(df, code, "object_id", severity, code) for code, df, severity in made])


def check_support(objects: DataFrame, key: str, values: str, source: str) -> DataFrame:
    """Warnings where values of a map don't stand in the source text."""
    normal = F.transform_values(values, lambda _, v: evidence_key(v))
    lost = objects.withColumn("__lost", unsupported_keys(normal, evidence_key(F.col(source)))).where(F.size("__lost") > 0)
    return _issues(lost, "unsupported_specific_value", key, "warning", "a value does not stand in the source")


def check_made(samples: DataFrame, steps: DataFrame, first: Column) -> DataFrame:
    """Advisories: sample_without_entity, and not_produced for samples that are not first and that no step makes."""
    made = steps.select("document_id", F.explode("outputs").alias("__made")).groupBy("document_id").agg(F.collect_set("__made").alias("__made"))
    alone = samples.where("entity_id IS NULL")
    lost = samples.where(~F.coalesce(first, F.lit(False))).join(made, "document_id", "left")
    lost = lost.where(~F.coalesce(F.array_contains("__made", F.col("sample_id")), F.lit(False))).drop("__made")
    return _issues(alone, "sample_without_entity", "sample_id", "warning", "no entity").unionByName(_issues(lost, "not_produced", "sample_id", "warning", "no step makes it"))


def check_methods(properties: DataFrame, derived: DataFrame) -> DataFrame:
    """Advisories: missing_method for properties (document_id, property_id, sample_id) that no method of their sample lists (document_id, sample_id, property_id)."""
    return _issues(properties.join(derived, ["document_id", "sample_id", "property_id"], "left_anti"), "missing_method", "property_id", "warning", "no method of its sample lists it")


def merged(documents: DataFrame, found: DataFrame, objects: DataFrame, links: DataFrame, mode: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Verdicts, and what is published: in strict mode all objects of documents without errors, in preview mode what salvage leaves of all documents without errors of their own.

    objects and links are those of salvage, objects with document_id; an issue's object_id names an object.
    """
    severity = _severity(False, mode)
    errors = found.where(F.col("severity") == severity).select("document_id", "object_id", "code", "message")
    if mode == "strict":
        blocked = errors.select("document_id").distinct()
        kept = objects.join(blocked, "document_id", "left_anti")
        rejected = objects.join(blocked, "document_id", "left_semi").select("object_id", "object_type", F.array(F.lit("document_blocked")).alias("codes"))
        names = kept.select("object_id")
        result = {"published": kept.select("object_id", "object_type"), "rejected": rejected, "links": links.join(names, "object_id", "left_semi"), "pruned": links.limit(0), "document_errors": errors.drop("document_id")}
        return verdicts(documents, found), result
    result = salvage(objects, links, errors.drop("document_id"))
    known = objects.select("object_id").distinct()
    whole = errors.join(known, "object_id", "left_anti").select("document_id").distinct()
    open_errors = found.where(F.col("severity") == severity).join(known, "object_id", "left_semi").withColumn("severity", F.lit("warning"))
    rest = found.join(known, "object_id", "left_anti").unionByName(found.where(F.col("severity") != severity).join(known, "object_id", "left_semi")).unionByName(open_errors)
    blocked = objects.join(whole, "document_id", "left_semi").select("object_id")
    return verdicts(documents, rest), {**result, "published": result["published"].join(blocked, "object_id", "left_anti")}
