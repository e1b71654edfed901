"""Projections of documents: typed blocks and their text, evidence with its place, references by id, public views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataquery.functions.numeric import ratio
from strataquery.operators.refs import numbered_id

#: The letter that a block's id begins with by its type; all others have the last.
BLOCK_LETTERS = {"table": "T", "image": "I", "equation": "E", "references": "R", "footnote": "F"}
OTHER_LETTER = "P"


def block_ids(blocks: DataFrame) -> DataFrame:
    """Blocks (document_id, type, page, position) with block_id: the letter of the type, the page and the place on it, from 0."""
    letters = F.create_map(*[F.lit(x) for kv in BLOCK_LETTERS.items() for x in kv])
    place = F.row_number().over(Window.partitionBy("document_id", "page").orderBy("position")) - 1
    return blocks.withColumn("block_id", F.concat_ws("_", F.coalesce(F.try_element_at(letters, F.col("type")), F.lit(OTHER_LETTER)), F.col("page").cast("string"), place.cast("string")))


def caption(*keys: Column) -> Column:
    """The first list of captions that says anything, its filled ones joined by spaces."""
    told = [F.nullif(F.trim(F.array_join(F.array_compact(k), " ")), F.lit("")) for k in keys]
    return F.coalesce(*told)


def rich_text(pieces: Column) -> Column:
    """struct(text, inline): pieces (type, content) in a row, inline equations between dollar signs, and where these stand; other types say nothing."""
    shown = F.transform(pieces, lambda p: F.when(p["type"] == "equation_inline", F.concat(F.lit("$"), p["content"], F.lit("$"))).when(p["type"] == "text", p["content"]).otherwise(""))
    places = F.filter(F.transform(pieces, lambda p, i: F.when((p["type"] == "equation_inline") & p["content"].isNotNull(), i)), lambda i: i.isNotNull())
    return F.struct(F.array_join(F.transform(shown, lambda t: F.coalesce(t, F.lit(""))), "").alias("text"), places.alias("inline"))


def input_text(kind: Column, text: Column, told: Column, body: Column) -> Column:
    """A block's text for the first stage: of a table its caption and body, trimmed, the filled ones in lines; of others their trimmed text."""
    lines = F.filter(F.array(F.trim(told), F.trim(body)), lambda t: t != "")
    return F.when(kind == "table", F.array_join(lines, "\n")).otherwise(F.trim(F.coalesce(text, F.lit(""))))


def source_text(kind: Column, text: Column, told: Column, body: Column, joined: bool = True) -> Column:
    """A block's text as evidence: of a table its caption and body in lines (not ``joined``: the body, and the caption where it is empty), of an image its caption, of others their text."""
    both = F.concat_ws("\n", F.nullif(told, F.lit("")), F.nullif(body, F.lit("")))
    table = both if joined else F.coalesce(F.nullif(body, F.lit("")), told, F.lit(""))
    return F.when(kind == "table", table).when(kind == "image", F.coalesce(told, F.lit(""))).otherwise(F.coalesce(text, F.lit("")))


def supported(blocks: DataFrame, kinds: Sequence[str], dropped: Sequence[str] = ("references",)) -> tuple[DataFrame, DataFrame]:
    """(blocks of the kinds asked for, warnings (document_id, code, n)): dropped and unsupported ones are counted."""
    code = F.when(F.col("type").isin(*dropped), "dropped_type").when(~F.col("type").isin(*kinds) | F.col("type").isNull(), "unsupported_type")
    marked = blocks.withColumn("__code", code)
    return marked.where("__code IS NULL").drop("__code"), marked.where("__code IS NOT NULL").groupBy("document_id", F.col("__code").alias("code")).agg(F.count("*").alias("n"))


def first_pages(blocks: DataFrame, pages: int = 2) -> DataFrame:
    """document_id, text: the filled texts of a document's first pages, in order, in lines."""
    some = blocks.where((F.col("page") < pages) & (F.trim("text") != ""))
    return some.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "position", F.trim("text").alias("t")))), lambda x: x["t"]), "\n").alias("text"))


def located(evidence: DataFrame, blocks: DataFrame) -> DataFrame:
    """Evidence with page, bbox and source_type of its block."""
    return evidence.join(blocks.select("document_id", "block_id", "page", "bbox", F.col("type").alias("source_type")), ["document_id", "block_id"], "left")


def materialised(tables: Mapping[str, tuple[DataFrame, str, str, str]], references: Sequence[tuple[str, str, str]]) -> dict[str, DataFrame]:
    """Tables (rows, key, order, prefix) with new ids by position in each document, and references (table, column, target) under the new ids; a reference that names nothing stays as it is.

    A reference is a text or a list of texts.
    """
    renamed: dict[str, DataFrame] = {}
    ids: dict[str, DataFrame] = {}
    for name, (df, key, order, prefix) in tables.items():
        n = F.row_number().over(Window.partitionBy("document_id").orderBy(order))
        numbered = df.withColumn("__new", numbered_id(prefix, n, 3))
        ids[name] = numbered.select("document_id", F.col(key).alias("__old"), "__new")
        renamed[name] = numbered.drop(key).withColumnRenamed("__new", key)
    for name, column, target in references:
        df = renamed[name]
        if dict(df.dtypes)[column].startswith("array"):
            known = ids[target].groupBy("document_id").agg(F.map_from_entries(F.collect_list(F.struct("__old", "__new"))).alias("__ids"))
            df = df.join(known, "document_id", "left").withColumn(column, F.transform(column, lambda v: F.coalesce(F.try_element_at(F.col("__ids"), v), v))).drop("__ids")
        else:
            known = ids[target].withColumnRenamed("__old", column)
            df = df.join(known, ["document_id", column], "left").withColumn(column, F.coalesce("__new", column)).drop("__new")
        renamed[name] = df
    return renamed


def evidence_by_id(objects: DataFrame, key: str, evidence: DataFrame, ids: DataFrame) -> DataFrame:
    """Objects with evidence_ids, their evidence (object key, position, digest) as ids (digest, evidence_id), each once, in order."""
    named = evidence.join(ids.select("digest", "evidence_id"), "digest")
    lists = named.groupBy(key).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("position", "evidence_id"))), lambda x: x["evidence_id"])).alias("evidence_ids"))
    return objects.join(lists, key, "left").withColumn("evidence_ids", F.coalesce("evidence_ids", F.array().cast("array<string>")))


def merged_ids(old: Column, new: Column) -> Column:
    """Two lists of ids as one, each once, the old ones first; nulls are empty."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(old, none), F.coalesce(new, none)))


def union_collections(parts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows of several collections in one, with the stage they are from; columns that one lacks are null there."""
    out = None
    for stage, df in parts:
        df = df.withColumn("stage", F.lit(stage))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def renamed_collections(names: Column, aliases: Mapping[str, str]) -> Column:
    """Names of collections under their proper ones."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(aliases.items()) for x in kv]), names), names)


def warning_rows(warnings: DataFrame, default_stage: Column) -> DataFrame:
    """Warnings in one shape: stage, code, message trimmed, with defaults for blank ones, and a null object for a blank one."""
    given = lambda c, default: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), default).alias(c)
    return warnings.select("document_id", given("stage", default_stage), given("code", F.lit("upstream_warning")), given("message", F.lit("an upstream stage warned")), F.nullif(F.trim("object_id"), F.lit("")).alias("object_id"))


def stage_billing(provenance: DataFrame, stages: Sequence[str]) -> DataFrame:
    """A row for each document and stage: calls (chunks where none are given), tokens, cost and its status; what has no record is unavailable."""
    everything = provenance.select("document_id").distinct().withColumn("stage", F.explode(F.array(*[F.lit(s) for s in stages])))
    met = everything.join(provenance, ["document_id", "stage"], "left")
    return met.select("document_id", "stage", F.coalesce("call_count", "chunk_count").alias("call_count"), "tokens", "cost", F.when(F.col("cost").isNull(), "unavailable").otherwise("calculated").alias("status"))


def flattened_process(rows: DataFrame) -> DataFrame:
    """document_id, kind, value of process columns, one row for each that says anything; a list gives a row for each of its parts."""
    kinds = [c for c in rows.columns if c != "document_id"]
    lists = [F.struct(F.lit(c).alias("kind"), (F.col(c) if dict(rows.dtypes)[c].startswith("array") else F.array(F.col(c).cast("string"))).alias("values")) for c in kinds]
    flat = rows.select("document_id", F.explode(F.array(*lists)).alias("x")).select("document_id", "x.kind", F.explode("x.values").alias("value"))
    return flat.where(F.trim("value") != "").select("document_id", "kind", F.trim("value").alias("value"))


def task_views(stages: DataFrame) -> DataFrame:
    """task_id, progress (percent of stages complete), current_stage, result_ready (the last is complete) of stages (task_id, position, stage, status)."""
    last = F.max_by("status", "position")
    done = F.count_if(F.col("status") == "complete")
    running = F.min_by(F.when(F.col("status") == "running", F.col("stage")), F.when(F.col("status") == "running", F.col("position")))
    return stages.groupBy("task_id").agg(F.round(done * 100 / F.count("*")).cast("int").alias("progress"), running.alias("current_stage"), (last == "complete").alias("result_ready"))


def overview(tables: Mapping[str, DataFrame], key: str = "document_id") -> DataFrame:
    """For each document how many rows it has in each table, 0 where it has none in one."""
    rows = None
    for name, df in tables.items():
        part = df.select(key, F.lit(name).alias("__name"))
        rows = part if rows is None else rows.union(part)
    return rows.groupBy(key).agg(*[F.count_if(F.col("__name") == n).alias(n) for n in tables])


def aligned_types(samples: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples with the types of their entity, those that changed): a subtype stands with copolymers alone; an entity without a type changes nothing."""
    known = entities.where("type IS NOT NULL").select("document_id", "entity_id", F.col("type").alias("__type"), F.when(F.col("type") == "copolymer", F.col("subtype")).alias("__sub"))
    met = samples.join(known, ["document_id", "entity_id"], "left")
    given = F.col("__type").isNotNull()
    changed = met.where(given & ~(F.col("type").eqNullSafe(F.col("__type")) & F.col("subtype").eqNullSafe(F.col("__sub")))).select("document_id", "sample_id", "entity_id", F.col("__type").alias("type"), F.col("__sub").alias("subtype"))
    out = met.withColumns({"type": F.when(given, F.col("__type")).otherwise(F.col("type")), "subtype": F.when(given, F.col("__sub")).otherwise(F.col("subtype"))})
    return out.drop("__type", "__sub"), changed


def failure_rows(attempts: DataFrame) -> DataFrame:
    """document_id, stage, error_class, error_code of failed attempts: the first code along the chain of causes (a list of class, code, outermost first)."""
    coded = F.filter("causes", lambda c: c["code"].isNotNull())
    return attempts.where("status = 'failed'").select("document_id", "stage", F.get("causes", F.lit(0))["class"].alias("error_class"), F.get(coded, F.lit(0))["code"].alias("error_code"))


def first_points(polymers: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key, with the ids of all its rows' samples in order and how many there are."""
    rest = [c for c in polymers.columns if c not in (key, "sample_id", order)]
    per = polymers.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("__first"), F.array_sort(F.collect_set("sample_id")).alias("sample_ids"))
    return per.select(key, "__first.*", "sample_ids", F.size("sample_ids").alias("n_samples"))


def compact_scores(scores: Column) -> tuple[Column, Column]:
    """A map of paths to scores and reasons as scores alone, and the paths whose other parts were dropped, in order."""
    kept = F.map_filter(scores, lambda k, _: F.element_at(F.split(k, r"\."), -1) == "score")
    return kept, F.array_sort(F.array_except(F.map_keys(scores), F.map_keys(kept)))


def share_of(part: Column, whole: Column) -> Column:
    """A percentage to one digit; null of nothing."""
    return F.round(ratio(part, whole, "safe") * 100, 1)
