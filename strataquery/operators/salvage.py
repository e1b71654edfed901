"""Salvage: what can be published of objects when some are wrong.

Objects are rows (object_id, object_type) of one flat table, whatever their kind; what they need of each other
is rows of links. An error is bound to an object where it names one, and isolates it. References to isolated
objects are then cleaned, or isolate their owners, until nothing changes:

* ``required``: an owner falls with any reference of the field that is gone;
* ``any``: it falls when no reference of the field is left; gone ones are pruned before;
* ``optional``: gone references are pruned;
* ``parent``: a child falls with its parent, and a parent that has had children when it has none left.

Each object has one verdict with all its codes. What goes in equals what is published and what is isolated.

Objects that have one parent and that nothing names, such as the points of a series, can be given as members instead: rows
(parent_id, object_type, code, and columns that make the member's key). Those of one parent without an error of their own
share its fate, so rounds need no more of them than whether a parent has had some and has some left.

Defined cases: a member without a parent, or with one that is no object, falls by its own errors alone; null references are none; an error without an object, or with an unknown one, belongs to the
document; repeated errors and links count once; empty tables give empty ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataquery.functions.numeric import ratio
from strataquery.sources.shared import drop_cut, settle

RULES = ("required", "any", "optional", "parent")
MISSING, ORPHAN, EMPTY = "missing_required_reference", "parent_rejected", "without_valid_members"
#: Rules of rows (ref_id alone) that stand in the links for all members of a parent: some are without an error, or none is.
LIVE, SPENT = "live_members", "spent_members"


def partition_errors(errors: DataFrame, objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Errors (object_id, code, message) that name an object, and those that don't."""
    known = objects.select("object_id").distinct()
    return errors.join(known, "object_id", "left_semi"), errors.join(known, "object_id", "left_anti")


def prune_links(links: DataFrame, objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Optional links whose target exists (with all other links), and the dangling ones: a method is not wrong for what it once derived."""
    known = objects.select(F.col("object_id").alias("ref_id")).distinct()
    gone = links.where("rule = 'optional' AND ref_id IS NOT NULL").join(known, "ref_id", "left_anti").select(links.columns)
    return links.where("rule <> 'optional' OR ref_id IS NULL").union(links.where("rule = 'optional'").join(known, "ref_id", "left_semi").select(links.columns)), gone


def _fallen(alive: DataFrame, links: DataFrame) -> DataFrame:
    """object_id, code of what falls first."""
    here = alive.select("object_id")
    own = links.join(here, "object_id", "left_semi")
    known = here.select(F.col("object_id").alias("ref_id"), F.lit(True).alias("held"))
    met = own.join(known, "ref_id", "left").withColumn("held", F.coalesce("held", F.lit(False)))
    per = met.groupBy("object_id", "field", "rule").agg(F.count_if("held").alias("held"), F.count("*").alias("all"))
    broken = per.where("(rule IN ('required', 'parent') AND held < `all`) OR (rule = 'any' AND held = 0)")
    falls = broken.select("object_id", F.when(F.col("rule") == "parent", ORPHAN).otherwise(MISSING).alias("code"))
    # parents that have had members
    parents = links.where(f"rule IN ('parent', '{LIVE}', '{SPENT}')").select(F.col("ref_id").alias("object_id")).distinct().join(here, "object_id", "left_semi")
    kept = own.where("rule = 'parent'").union(links.where(F.col("rule") == LIVE)).select(F.col("ref_id").alias("object_id")).distinct()
    return falls.union(parents.join(kept, "object_id", "left_anti").select("object_id", F.lit(EMPTY).alias("code")))


def _follow(alive: DataFrame, links: DataFrame, gone: DataFrame) -> DataFrame:
    """object_id, code of what falls after the objects that went in the last round: only what they held or belonged to can."""
    here = alive.select("object_id")
    lost = links.join(gone.select(F.col("object_id").alias("ref_id")).distinct(), "ref_id", "left_semi").join(here, "object_id", "left_semi")
    falls = lost.where("rule IN ('required', 'parent')").select("object_id", F.when(F.col("rule") == "parent", ORPHAN).otherwise(MISSING).alias("code"))
    some = links.where("rule = 'any'").join(lost.where("rule = 'any'").select("object_id", "field").distinct(), ["object_id", "field"], "left_semi")
    left = some.join(here.withColumnRenamed("object_id", "ref_id"), "ref_id", "left_semi").select("object_id", "field")
    falls = falls.union(some.select("object_id", "field").distinct().join(left, ["object_id", "field"], "left_anti").select("object_id", F.lit(MISSING).alias("code")))
    members = links.where("rule = 'parent'").select("object_id", "ref_id")
    parents = members.join(gone.select("object_id"), "object_id", "left_semi").select(F.col("ref_id").alias("object_id")).distinct().join(here, "object_id", "left_semi")
    kept = members.join(parents.withColumnRenamed("object_id", "ref_id"), "ref_id", "left_semi").join(here, "object_id", "left_semi").select(F.col("ref_id").alias("object_id"))
    kept = kept.union(links.where(F.col("rule") == LIVE).select("ref_id"))
    return falls.union(parents.join(kept, "object_id", "left_anti").select("object_id", F.lit(EMPTY).alias("code")))


def each_member(members: DataFrame) -> DataFrame:
    """Each member once, with wrong: how many of its rows have a code. Members of one parent lie together."""
    return members.repartition("parent_id").groupBy(*[c for c in members.columns if c != "code"]).agg(F.count("code").alias("wrong"))


def salvage(objects: DataFrame, links: DataFrame, errors: DataFrame, members: DataFrame | None = None) -> dict[str, DataFrame]:
    """published, rejected (object_id, object_type, codes), links (those left), pruned (those cut), document_errors, fallen
    (object_id of what was rejected) and members (parent_id, object_type, members, live: without an error, fell: with the parent).

    objects: object_id, object_type; links: object_id, field, ref_id, rule; errors: object_id, code, message. Rounds
    are the longest chain of references at most; each is joins of flat tables, written to cut the lineage.
    Members are counted by parent first; objects, links and errors are written once. Rounds after the first follow what
    the last one took, and drop its tables; what was shuffled for a table is deleted when it stands.
    """
    if members is None:
        held = objects.where(F.lit(False)).select(F.col("object_id").alias("parent_id"), "object_type", F.lit(0).cast("long").alias("members"), F.lit(0).cast("long").alias("live"))
    else:
        held = settle(each_member(members).groupBy("parent_id", "object_type").agg(F.count("*").alias("members"), F.count_if(F.col("wrong") == 0).alias("live")))
    objects = settle(objects.select("object_id", "object_type"))
    links = settle(links.where("ref_id IS NOT NULL").select("object_id", "field", "ref_id", "rule").distinct())
    bound, unbound = partition_errors(errors, objects)
    bound = settle(bound.select("object_id", "code").distinct())
    firm = links.where("rule <> 'optional'")
    optional, dangling = prune_links(links.where("rule = 'optional'"), objects)
    weak = firm.where("rule = 'any'").union(settle(optional))
    nothing = lambda name: F.lit(None).cast(links.schema[name].dataType).alias(name)
    stand = held.groupBy("parent_id").agg(F.max("live").alias("live")).select(nothing("object_id"), nothing("field"), F.col("parent_id").alias("ref_id"), F.when(F.col("live") > 0, LIVE).otherwise(SPENT).alias("rule"))
    tied = firm if members is None else firm.union(stand.where("ref_id IS NOT NULL"))
    verdicts = [bound]
    alive = settle(objects.join(bound, "object_id", "left_anti"))
    falls = settle(_fallen(alive, tied))
    while not falls.isEmpty():
        verdicts.append(falls)
        before, alive = alive, settle(alive.join(falls, "object_id", "left_anti"))
        drop_cut(before)
        falls = settle(_follow(alive, tied, falls))
    fallen = reduce(DataFrame.unionByName, verdicts)
    codes = fallen.groupBy("object_id").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    here = alive.select("object_id")
    there = here.withColumnRenamed("object_id", "ref_id")
    # an owner that is left has all its required references and parents
    own = links.join(here, "object_id", "left_semi")
    kept = own.where("rule IN ('required', 'parent')").union(own.where("rule NOT IN ('required', 'parent')").join(there, "ref_id", "left_semi").select(links.columns))
    pruned = weak.join(there, "ref_id", "left_anti").select(links.columns).union(dangling.select(links.columns)).join(here, "object_id", "left_semi").select(links.columns)
    gone = fallen.select(F.col("object_id").alias("parent_id"), F.lit(True).alias("gone")).distinct()
    held = held.join(gone, "parent_id", "left").select("parent_id", "object_type", "members", "live", F.when(F.col("gone"), F.col("live")).otherwise(0).alias("fell"))
    return {"published": alive, "rejected": objects.join(codes, "object_id"), "links": kept, "pruned": pruned, "document_errors": unbound, "fallen": fallen.select("object_id"), "members": held}


def published_members(members: DataFrame, result: dict[str, DataFrame]) -> DataFrame:
    """Members without an error whose parent has not fallen; the columns of their key."""
    whole = each_member(members).where("wrong = 0").drop("wrong")
    return whole.join(result["fallen"].select(F.col("object_id").alias("parent_id")), "parent_id", "left_anti").select(whole.columns)


def object_counts(objects: DataFrame) -> DataFrame:
    return objects.groupBy("object_type").agg(F.count("*").alias("n"))


def publication_summary(objects: DataFrame, result: dict[str, DataFrame]) -> DataFrame:
    """object_type, input, published, rejected, pruned (references cut from what is published) and conserved."""
    names = ("input", "published", "rejected", "pruned")
    parts = [("input", objects), ("published", result["published"]), ("rejected", result["rejected"]), ("pruned", result["pruned"].join(result["published"], "object_id"))]
    n = lambda name, part: (F.col("n") if name == part else F.lit(0).cast("long")).alias(name)
    rows = [object_counts(df).select("object_type", *[n(name, part) for name in names]) for part, df in parts]
    members = result["members"].select("object_type", F.col("members").alias("input"), (F.col("live") - F.col("fell")).alias("published"), (F.col("members") - F.col("live") + F.col("fell")).alias("rejected"), F.lit(0).cast("long").alias("pruned"))
    counts = reduce(DataFrame.unionByName, [*rows, members]).groupBy("object_type").agg(*[F.sum(name).alias(name) for name in names])
    return counts.withColumn("conserved", F.col("input") == F.col("published") + F.col("rejected"))


def used_only(evidence: DataFrame, links: DataFrame, key: str = "evidence_id") -> DataFrame:
    """Evidence that a published object still names."""
    return evidence.join(links.select(F.col("ref_id").alias(key)).distinct(), key, "left_semi")


def series_coverage(points: DataFrame, *group: str) -> DataFrame:
    """covered, missing, not_applicable, expected (the first two) and ratio (1.0 of nothing) of points (coverage_status, ..)."""
    counts = [F.count_if(F.col("coverage_status") == s).alias(s) for s in ("covered", "missing", "not_applicable")]
    rows = points.groupBy(*group).agg(*counts).withColumn("expected", F.col("covered") + F.col("missing"))
    return rows.withColumn("ratio", ratio(F.col("covered"), F.col("expected"), "complete"))


def single_or_several(references: Column) -> tuple[Column, Column]:
    """One reference as a single one, two or more as a list; neither of none."""
    distinct = F.array_distinct(F.coalesce(references, F.array().cast("array<string>")))
    return F.when(F.size(distinct) == 1, F.get(distinct, F.lit(0))), F.when(F.size(distinct) >= 2, distinct)


def salvage_warnings(result: dict[str, DataFrame]) -> DataFrame:
    """object_id, code: a warning for each code of an isolated object and each field that was cleaned."""
    rejected = result["rejected"].select("object_id", F.explode("codes").alias("code")).select("object_id", F.concat(F.lit("rejected_"), "code").alias("code"))
    return rejected.union(result["pruned"].select("object_id", F.lit("reference_pruned").alias("code"))).distinct()
