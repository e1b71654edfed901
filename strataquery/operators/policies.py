"""Policies: what types texts and steps say, who owns a mention, samples between steps, references between objects.

All are expressions or joins of flat tables; an audit row says what changed and why.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataquery.functions.surface import compact_formula
from strataquery.operators.graph import inherit
from strataquery.operators.refs import numbered_id

#: Words of a formulation, of regioregularity, and of copolymers.
FORMULATION = r"(?i)\b(?:composite(?:s)?|reinforced|reinforcement|filler|filled)\b"
REGIO = r"(?i)\bregio(?:regular|random)\b|\bR[gn]\s*\("
COPOLYMER = r"(?i)\bco-?polymer\b|\bterpolymer\b"
#: Words of fillers and of other components.
COMPOSITE = r"(?i)\b(?:reinforced|reinforcement|filler|filled)\b|\bcarbon\s+(?:fibers?|fibres?|black)\b|\bcCF\b|\b[0-9]+(?:\.[0-9]+)?\s*(?:wt|vol)\s*%\s*CB\b|\b[A-Z]+/CB[0-9]*\b"
COMPOUND = r"(?i)\b(?:dopant|doped|doping|plasticizer|plasticised|plasticized|additive|electrolyte(?:\s+salt)?|masterbatch)\b|\bLiClO\s*4\b|\blithium\s+perchlorate\b"
#: Steps that keep a composition, steps that change it, and samples that need no step.
PRESERVING = ("casting", "film_formation", "extrusion", "molding", "pressing", "annealing", "hydration", "drying", "hot_pressing", "electrospinning", "specimen_preparation", "cutting", "punching")
CHANGING = ("blending", "compounding", "mixing")
INITIAL = ("synthesis_batch", "commercial_batch")


def ruled_types(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities with types that their text (name, names and evidence) does not rule out, what changed: entity_id, was, now, reason).

    A formulation is no proof of a homopolymer; regioregularity is none of an alternating copolymer.
    """
    loose = (F.col("type") == "homopolymer") & F.col("text").rlike(FORMULATION)
    regio = (F.col("type") == "copolymer") & (F.col("subtype") == "alt") & F.col("text").rlike(REGIO) & ~F.col("text").rlike(COPOLYMER)
    reason = F.when(F.coalesce(loose, F.lit(False)), "formulation").when(F.coalesce(regio, F.lit(False)), "regioregular")
    marked = entities.withColumn("reason", reason)
    now = F.when(F.col("reason").isNull(), F.col("type")).when(F.col("reason") == "regioregular", "homopolymer")
    changed = marked.where("reason IS NOT NULL").select("document_id", "entity_id", F.col("type").alias("was"), now.alias("now"), "reason")
    return marked.withColumns({"type": now, "subtype": F.when(F.col("reason").isNull() | (F.col("reason") == "formulation"), F.col("subtype"))}).drop("reason"), changed


def material_of(text: Column) -> Column:
    """composite where a text names a filler, compound where it names another component; null where it names none."""
    return F.when(text.rlike(COMPOSITE), "composite").when(text.rlike(COMPOUND) | F.contains(compact_formula(text), F.lit("liclo4")), "compound")


def material_types(samples: DataFrame, steps: DataFrame) -> DataFrame:
    """document_id, sample_id, material, reason: the material of each sample.

    In turn: what is given; what its text says; what a composition-changing step that makes it says (its sentence and the
    texts of all its samples: composite where any names a filler, else compound), which also turns a composite without
    such evidence into a compound; what the inputs of composition-preserving steps agree on, to a fixpoint.

    samples: document_id, sample_id, material, text; steps: document_id, step_id, kind, sentence, inputs, outputs.
    """
    said = samples.withColumn("said", F.coalesce("material", material_of(F.col("text"))))
    changing = steps.where(F.col("kind").isin(*CHANGING))
    around = changing.select("document_id", "step_id", F.explode(F.concat("inputs", "outputs")).alias("sample_id")).distinct().join(samples.select("document_id", "sample_id", "text"), ["document_id", "sample_id"])
    filled = around.where(F.col("text").rlike(COMPOSITE)).select("document_id", "step_id").distinct().withColumn("filled", F.lit(True))
    made = changing.join(filled, ["document_id", "step_id"], "left").withColumn("of_step", F.when(F.coalesce("filled", F.col("sentence").rlike(COMPOSITE), F.lit(False)), "composite").otherwise("compound"))
    # of several steps that make a sample the first counts
    per = made.select("document_id", "step_id", F.explode("outputs").alias("sample_id"), "of_step").groupBy("document_id", "sample_id").agg(F.min_by("of_step", "step_id").alias("of_step"))
    met = said.join(per, ["document_id", "sample_id"], "left")
    lower = (F.col("said") == "composite") & (F.col("of_step") == "compound")
    now = F.when(F.col("said").isNull() | lower, F.coalesce("of_step", "said")).otherwise(F.col("said"))
    reason = F.when(F.col("of_step").isNotNull() & (F.col("said").isNull() | lower), "step").when(F.col("material").isNotNull(), "given").when(F.col("said").isNotNull(), "text")
    met = met.withColumns({"now": now, "reason": reason})
    name = lambda c: F.concat_ws("\x1f", F.col("document_id").cast("string"), F.col(c).cast("string"))
    keeping = steps.where(F.col("kind").isin(*PRESERVING)).select("document_id", F.explode("inputs").alias("i"), "outputs").select("document_id", "i", F.explode("outputs").alias("o"))
    links = keeping.select(name("i").alias("a"), name("o").alias("b")).where("a <> b").distinct()
    rows = met.withColumn("node", name("sample_id"))
    final = inherit(rows.select("node", F.col("now").alias("value")), links).select("node", F.col("value").alias("final"))
    out = rows.join(final, "node")
    return out.select("document_id", "sample_id", F.col("final").alias("material"), F.when(F.col("now").isNull() & F.col("final").isNotNull(), "inherited").otherwise(F.col("reason")).alias("reason"))


def mention_owners(claims: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(claims left, mentions that stay unresolved, entities left without a mention) where several entities claim a mention.

    The one entity that has the mention's text and block in its own evidence keeps it; without one nobody does.
    claims: document_id, entity_id, mention_id, text, block_id; evidence: document_id, entity_id, block_id, name.
    """
    many = claims.groupBy("document_id", "mention_id").agg(F.count_distinct("entity_id").alias("n")).where("n > 1").select("document_id", "mention_id")
    own = claims.join(many, ["document_id", "mention_id"], "left_semi").join(evidence, ["document_id", "entity_id", "block_id"]).where(F.lower("text") == F.lower("name"))
    keeper = own.groupBy("document_id", "mention_id").agg(F.count_distinct("entity_id").alias("n"), F.min("entity_id").alias("entity_id")).where("n = 1").select("document_id", "mention_id", "entity_id")
    left = claims.join(many, ["document_id", "mention_id"], "left_anti").select("document_id", "entity_id", "mention_id").union(keeper.select("document_id", "entity_id", "mention_id")).distinct()
    open_mentions = many.join(keeper, ["document_id", "mention_id"], "left_anti")
    emptied = claims.select("document_id", "entity_id").distinct().join(left, ["document_id", "entity_id"], "left_anti")
    return left, open_mentions, emptied


def nested_pairs(mentions: DataFrame) -> DataFrame:
    """document_id, inner, outer: mentions of one block and sentence of which the shorter stands inside the longer wherever it stands in the sentence.

    mentions: document_id, mention_id, block_id, sentence, text. Only mentions of one sentence meet.
    """
    keys = ["document_id", "block_id", "sentence"]
    a = mentions.select(*keys, F.col("mention_id").alias("inner"), F.col("text").alias("short"))
    b = mentions.select(*keys, F.col("mention_id").alias("outer"), F.col("text").alias("long"))
    met = a.join(b, keys).where((F.length("short") < F.length("long")) & F.contains("long", F.col("short")))
    rest = F.replace(F.col("sentence"), F.col("long"), F.lit(""))
    return met.where(~F.contains(rest, F.col("short")) & F.contains("sentence", F.col("long"))).select("document_id", "inner", "outer")


def between_steps(steps: DataFrame, samples: DataFrame) -> DataFrame:
    """document_id, step_id, sample_id: a new sample between two successive steps of which the second is a drying or a pressing that repeats the first's samples, numbered after the document's samples.

    After an extraction: its outputs are the second's inputs and outputs. After a casting: both steps have the same inputs
    and outputs (a drying only with the same evidence). One sample for each output.
    steps: document_id, step_id, position, kind, inputs, outputs, evidence (a key of it).
    """
    w = Window.partitionBy("document_id").orderBy("position")
    before = steps.withColumns({f"p_{c}": F.lag(c).over(w) for c in ("kind", "inputs", "outputs", "evidence")})
    same = (F.col("p_inputs") == F.col("inputs")) & (F.col("p_outputs") == F.col("outputs")) & (F.size("p_outputs") > 0)
    extracted = (F.col("p_kind") == "solvent_extraction") & (F.size("p_outputs") > 0) & (F.col("p_outputs") == F.col("inputs")) & (F.col("inputs") == F.col("outputs")) & (F.size("p_inputs") == F.size("p_outputs"))
    cast_dried = (F.col("p_kind") == "casting") & same & (F.size("outputs") == F.size("inputs")) & (F.col("p_evidence") == F.col("evidence"))
    cast_pressed = (F.col("p_kind") == "casting") & (F.col("kind") == "pressing") & same
    hit = before.where(F.col("kind").isin("drying", "pressing") & (extracted | cast_dried | cast_pressed))
    flat = hit.select("document_id", "step_id", "position", F.posexplode("outputs").alias("at", "of_sample"))
    last = samples.groupBy("document_id").agg(F.max(F.regexp_extract("sample_id", "^s([0-9]+)$", 1).try_cast("long")).alias("last"))
    n = F.row_number().over(Window.partitionBy("document_id").orderBy("position", "at"))
    return flat.join(last, "document_id", "left").select("document_id", "step_id", "of_sample", numbered_id("s", n + F.coalesce("last", F.lit(0)), 3).alias("sample_id"))


def subject_scope(one: Column, many: Column, status: Column) -> tuple[Column, Column, Column]:
    """(one, many, status) in their proper form: a list of one is that one, an empty list none, a list of several is multi_resolved, nothing is unresolved."""
    distinct = F.array_distinct(F.coalesce(many, F.array().cast("array<string>")))
    single = F.coalesce(F.when(F.size(distinct) == 1, F.get(distinct, F.lit(0))), F.when(F.size(distinct) == 0, one))
    several = F.when(F.size(distinct) >= 2, distinct)
    now = F.when(several.isNotNull(), "multi_resolved").when(single.isNotNull(), "resolved").otherwise("unresolved")
    return single, several, F.when(status.eqNullSafe(now), status).otherwise(now)


def moved_references(owners: DataFrame, listed: str, series: DataFrame) -> DataFrame:
    """Owners (document_id, owner_id) with the ids of series moved from a list of derived objects to ``series_ids``."""
    known = series.groupBy("document_id").agg(F.collect_set("series_id").alias("__series"))
    none = F.array().cast("array<string>")
    met = owners.join(known, "document_id", "left").withColumn("__series", F.coalesce("__series", none))
    return met.withColumn("series_ids", F.array_distinct(F.concat(F.coalesce("series_ids", none), F.array_intersect(listed, "__series")))).withColumn(listed, F.array_except(listed, "__series")).drop("__series")


def metadata_status(*fields: Column) -> Column:
    """complete with all fields filled, failed with none, else partial."""
    filled = sum((F.coalesce(F.trim(f) != "", F.lit(False)).cast("int") for f in fields[1:]), F.coalesce(F.trim(fields[0]) != "", F.lit(False)).cast("int"))
    return F.when(filled == len(fields), "complete").when(filled == 0, "failed").otherwise("partial")


def longest_alias(texts: DataFrame, aliases: DataFrame, key: str = "text_id") -> DataFrame:
    """text_id, names, surface: the names whose alias a text holds as words of its own, and the longest such alias.

    A text meets aliases on their first word alone.
    """
    words = lambda c: F.transform(F.split(F.lower(F.trim(c)), r"[^\p{L}\p{N}]+"), lambda w: w)
    asked = texts.select(key, F.concat(F.lit(" "), F.array_join(words("text"), " "), F.lit(" ")).alias("t"), F.explode(F.array_distinct(words("text"))).alias("w")).where("w <> ''")
    known = aliases.select("name", "alias", F.concat(F.lit(" "), F.array_join(words("alias"), " "), F.lit(" ")).alias("a"), F.get(F.filter(words("alias"), lambda w: w != ""), F.lit(0)).alias("w"))
    met = asked.join(known, "w").where(F.expr("contains(t, a)"))
    return met.groupBy(key).agg(F.array_sort(F.collect_set("name")).alias("names"), F.max_by("alias", F.struct(F.length("alias"), F.col("alias"))).alias("surface"))


def expanded_scope(methods: DataFrame, samples: DataFrame, pattern: str) -> DataFrame:
    """document_id, method_id, sample_id: a method whose sentence names all of a kind belongs to every sample of that kind in its document."""
    every = methods.where(F.col("sentence").rlike(pattern)).select("document_id", "method_id")
    return every.join(samples.where(F.col("kind") == INITIAL[0]).select("document_id", "sample_id"), "document_id")


def unused(objects: DataFrame, key: str, references: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Objects that no reference of their document names."""
    left = objects
    for df, column in references:
        left = left.join(df.select("document_id", F.col(column).alias(key)).distinct(), ["document_id", key], "left_anti")
    return left
