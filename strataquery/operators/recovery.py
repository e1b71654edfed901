"""Recovery of table cells that no observation represents: who a row is about, what it measures, new observations and their migration.

Everything is joins of flat tables. Labels are compared by their key (lower-case letters, digits and ideographs).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataquery.functions.text import alnum_key, evidence_key
from strataquery.operators.refs import numbered_id

#: Words of a row label that name more than one thing.
MIXTURES = ("blend", "mixture", "composite", "共混", "混合", "复合")
#: Where a label may stand, best first.
BASES = ("table_locator_row_label", "row_cell_direct", "row_cell_filled_up")


def aliases(entities: DataFrame, samples: DataFrame) -> DataFrame:
    """document_id, entity_id, alias (a key): names of entities (name, names) and labels of the samples that refer to them."""
    named = entities.select("document_id", "entity_id", F.explode(F.array_compact(F.concat(F.array("name"), F.coalesce("names", F.array().cast("array<string>"))))).alias("text"))
    known = entities.select("document_id", "entity_id")
    labels = samples.join(known, ["document_id", "entity_id"], "left_semi").select("document_id", "entity_id", F.explode(F.array_compact(F.array("label", "name"))).alias("text"))
    return named.union(labels).select("document_id", "entity_id", alnum_key(F.col("text")).alias("alias")).where("alias <> ''").distinct()


def row_labels(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """target_id, label, basis for targets (target_id, table_id, row_index, column_index): the texts left of a target in its row, and for columns that are blank there the nearest text above."""
    at = targets.select("target_id", "table_id", F.col("row_index").alias("y"), F.col("column_index").alias("x"))
    left = at.join(cells.select("table_id", "row_index", "row_span", "column_index", F.trim("text").alias("text")), "table_id").where("column_index < x AND text <> ''")
    here, above = F.expr("row_index <= y AND y < row_index + row_span"), F.expr("row_index + row_span <= y")
    # rows stay where their table's are: groups lie within it
    per = left.where(here | above).groupBy("table_id", "target_id", "column_index").agg(F.collect_list(F.when(here, F.col("text"))).alias("direct"), F.max_by(F.when(above, F.col("text")), F.when(above, F.col("row_index"))).alias("filled"))
    told = F.when(F.size("direct") > 0, F.col("direct")).otherwise(F.array("filled"))
    basis = F.when(F.size("direct") > 0, BASES[1]).otherwise(BASES[2])
    return per.select("target_id", "column_index", F.explode(told).alias("label"), basis.alias("basis"))


def row_entities(rows: DataFrame, names: DataFrame, samples: DataFrame, bound: DataFrame) -> DataFrame:
    """row_id, entity_id, basis: what a row is about, the first of these that gives one entity.

    rows: row_id, document_id, table_id, headers (texts), labels (texts left of the value, unfiltered); names: aliases();
    samples: document_id, entity_id; bound: document_id, table_id, entity_id that the table is already about. In turn:
    a header equals an alias; the longest alias of three characters or more that a header holds or that holds a header
    (unless the row names a mixture); for rows without headers the one entity of all samples, then of the table; the one
    entity of the document; an unfiltered label equals an alias.

    A header meets the aliases of its document alone.
    """
    text = F.col("headers")
    parts = rows.select("row_id", "document_id", F.explode(F.array_distinct(F.transform(text, alnum_key))).alias("part")).where("part <> ''")
    bare = rows.join(parts.select("row_id").distinct(), "row_id", "left_anti")
    one = lambda df: df.groupBy("row_id").agg(F.count_distinct("entity_id").alias("n"), F.min("entity_id").alias("entity_id")).where("n = 1").select("row_id", "entity_id")
    exact = one(parts.join(names.withColumnRenamed("alias", "part"), ["document_id", "part"]))
    held = parts.join(names, "document_id").where((F.length("alias") >= 3) & (F.expr("contains(part, alias) OR contains(alias, part)")))
    held = held.withColumn("score", F.least(F.length("alias"), F.length("part")))
    best = held.withColumn("best", F.max("score").over(Window.partitionBy("row_id"))).where("score = best")
    mixed = F.lower(F.array_join("headers", " "))
    plain = rows.where(~F.coalesce(_any(mixed, MIXTURES), F.lit(False))).select("row_id")
    longest = one(best).join(plain, "row_id", "left_semi")
    single = lambda df, keys: df.groupBy(*keys).agg(F.count_distinct("entity_id").alias("n"), F.min("entity_id").alias("entity_id")).where("n = 1").select(*keys, "entity_id")
    by_samples = bare.join(single(samples.where("entity_id IS NOT NULL"), ["document_id"]), "document_id").select("row_id", "entity_id")
    by_table = bare.join(single(bound, ["document_id", "table_id"]), ["document_id", "table_id"]).select("row_id", "entity_id")
    by_document = rows.join(single(names, ["document_id"]), "document_id").select("row_id", "entity_id")
    extra = rows.select("row_id", "document_id", F.explode(F.array_except(F.transform("labels", alnum_key), F.transform(text, alnum_key))).alias("part")).where("part <> ''")
    by_label = one(extra.join(names.withColumnRenamed("alias", "part"), ["document_id", "part"]))
    tiers = [(exact, "row_label_exact_entity_alias"), (longest, "row_label_longest_entity_alias"), (by_samples, "document_samples_single_entity"), (by_table, "table_existing_entity"), (by_document, "document_single_entity"), (by_label, "row_cell_exact_entity_alias")]
    out = None
    for i, (df, basis) in enumerate(tiers):
        df = df.select("row_id", F.struct(F.lit(i).alias("tier"), "entity_id", F.lit(basis).alias("basis")).alias("found"))
        out = df if out is None else out.union(df)
    first = out.groupBy("row_id").agg(F.min("found").alias("found"))
    any_entity = names.select("document_id", F.lit(True).alias("some")).distinct()
    nothing = F.when(F.col("some"), "entity_ambiguous").otherwise("entity_not_found")
    return rows.select("row_id", "document_id").join(first, "row_id", "left").join(any_entity, "document_id", "left").select("row_id", "found.entity_id", F.coalesce("found.basis", nothing).alias("basis"))


def _any(text: Column, words: Sequence[str]) -> Column:
    found = F.contains(text, F.lit(words[0]))
    for w in words[1:]:
        found = found | F.contains(text, F.lit(w))
    return found


def row_sentences(cells: DataFrame) -> DataFrame:
    """table_id, row_index, sentence: the filled cells of a row, joined by bars."""
    filled = cells.where(F.trim("text") != "")
    return filled.groupBy("table_id", "row_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("column_index", F.trim("text").alias("t")))), lambda x: x["t"]), " | ").alias("sentence"))


def bind_samples(unresolved: DataFrame, labels: DataFrame, samples: DataFrame, filled_up: bool = False) -> DataFrame:
    """item_id, sample_id, basis, status: accepted where all labels of an item lead to one sample of its entity; a label filled up from above waits for review unless allowed.

    unresolved: item_id, document_id, entity_id; labels: item_id, label, basis; samples: document_id, sample_id, entity_id, label.
    """
    order = F.create_map(*[F.lit(x) for i, b in enumerate(BASES) for x in (b, i)])
    asked = labels.select("item_id", alnum_key(F.col("label")).alias("key"), "basis").where("key <> ''").join(unresolved, "item_id")
    known = samples.select("document_id", "sample_id", F.col("entity_id").alias("of"), alnum_key(F.col("label")).alias("key"))
    met = asked.join(known, ["document_id", "key"]).where("of IS NULL OR entity_id IS NULL OR of = entity_id")
    per = met.groupBy("item_id").agg(F.count_distinct("sample_id").alias("n"), F.min("sample_id").alias("sample_id"), F.min_by("basis", order[F.col("basis")]).alias("basis"))
    waits = (F.col("basis") == BASES[2]) & F.lit(not filled_up)
    status = F.when(F.col("n").isNull(), "not_found").when(F.col("n") > 1, "ambiguous").when(waits, "filled_up_pending_review").otherwise("accepted")
    one = F.col("n") == 1
    return unresolved.select("item_id").join(per, "item_id", "left").select("item_id", F.when(one, F.col("sample_id")).alias("sample_id"), F.when(one, F.col("basis")).alias("basis"), status.alias("status"))


def recovered(missing: DataFrame, existing: DataFrame, cells: DataFrame, entities: DataFrame, unit: Column) -> tuple[DataFrame, DataFrame]:
    """(new observations, skipped): an unresolved observation for each missing cell whose row has an entity, numbered after the existing ones of its document; and (cell_id, reason) of the others.

    missing: document_id, table_id, cell_id, row_index, column_index, property, text, column_headers; existing: document_id,
    unresolved_id, cell_id; entities: row_entities() by row_id = cell_id.
    """
    known = existing.select("cell_id").distinct()
    fresh = missing.join(known, "cell_id", "left_anti").join(entities.withColumnRenamed("row_id", "cell_id"), "cell_id", "left")
    skipped = missing.join(known, "cell_id", "left_semi").select("cell_id", F.lit("already_present").alias("reason"))
    skipped = skipped.union(fresh.where("entity_id IS NULL").select("cell_id", F.coalesce("basis", F.lit("entity_not_found"))))
    told = fresh.where("entity_id IS NOT NULL").join(row_sentences(cells), ["table_id", "row_index"], "left")
    last = existing.groupBy("document_id").agg(F.max(F.regexp_extract("unresolved_id", "^uprop([0-9]+)$", 1).try_cast("long")).alias("last"))
    place = F.row_number().over(Window.partitionBy("document_id").orderBy("table_id", "row_index", "column_index", "cell_id"))
    rows = told.join(last, "document_id", "left").withColumn("unresolved_id", numbered_id("uprop", place + F.coalesce("last", F.lit(0)), 3))
    return rows.select("document_id", "unresolved_id", "entity_id", "property", F.col("text").alias("value_raw"), unit.alias("unit_raw"), "cell_id", "sentence", "basis"), skipped


def migrated(unresolved: DataFrame, bindings: DataFrame, properties: DataFrame, conditions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(left unresolved, properties with the accepted ones, one new condition for each): ids go on after the existing ones of the document."""
    accepted = bindings.where("status = 'accepted'").select(F.col("item_id").alias("unresolved_id"), "document_id", "sample_id")
    left = unresolved.join(accepted, ["document_id", "unresolved_id"], "left_anti")
    place = F.row_number().over(Window.partitionBy("document_id").orderBy("unresolved_id"))
    after = lambda df, key, prefix: df.groupBy("document_id").agg(F.max(F.regexp_extract(key, f"^{prefix}([0-9]+)$", 1).try_cast("long")).alias(f"last_{prefix}"))
    moved = unresolved.join(accepted, ["document_id", "unresolved_id"]).withColumn("place", place)
    moved = moved.join(after(properties, "property_id", "prop"), "document_id", "left").join(after(conditions, "condition_id", "mc"), "document_id", "left")
    number = lambda prefix: numbered_id(prefix, F.col("place") + F.coalesce(f"last_{prefix}", F.lit(0)), 3)
    moved = moved.withColumns({"property_id": number("prop"), "condition_id": number("mc")})
    more = moved.select("document_id", "property_id", "sample_id", "condition_id")
    return left, properties.select(more.columns).union(more), conditions.select("document_id", "condition_id").union(moved.select("document_id", "condition_id"))


def match_cells(locators: DataFrame, cells: DataFrame) -> DataFrame:
    """locator_id, status, cell_id, by for locators (locator_id, table_id, cell_id, row_index, column_index, cell_value) by a ladder.

    By cell id; else by row and column; else by the value, where one cell alone has it; else by its parts, where each part
    between commas is a cell. A named cell must hold the value: as it is (matched), normalised, or both empty.
    """
    key, value = evidence_key, F.col("cell_value")
    held = cells.select("table_id", F.col("cell_id").alias("id"), F.col("row_index").alias("y"), F.col("column_index").alias("x"), F.trim("text").alias("text"))
    named = locators.where("cell_id IS NOT NULL")
    placed = locators.where("cell_id IS NULL AND row_index IS NOT NULL AND column_index IS NOT NULL")
    free = locators.where("cell_id IS NULL AND (row_index IS NULL OR column_index IS NULL)")
    compare = (
        F.when(F.col("id").isNull(), "unresolved").when(value.isNull(), F.when(F.col("text") == "", "matched").otherwise("unresolved"))
        .when(F.trim(value) == F.col("text"), "matched").when(key(value) == key(F.col("text")), "normalised").otherwise("unresolved")
    )
    by_id = named.join(held.select("table_id", F.col("id").alias("cell_id"), "id", "text"), ["table_id", "cell_id"], "left").select("locator_id", compare.alias("status"), "id", F.lit("cell_id").alias("by"))
    at = (F.col("row_index") == F.col("y")) & (F.col("column_index") == F.col("x"))
    by_place = placed.alias("l").join(held.alias("c"), (F.col("l.table_id") == F.col("c.table_id")) & at, "left").select("locator_id", compare.alias("status"), "id", F.lit("place").alias("by"))
    asked = free.where(F.trim("cell_value") != "").select("locator_id", "table_id", key(value).alias("v"), "cell_value")
    texts = held.select("table_id", "id", key(F.col("text")).alias("v")).groupBy("table_id", "v").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    found = asked.join(texts, ["table_id", "v"]).groupBy("locator_id").agg(F.sum("n").alias("n"), F.min("id").alias("id"))
    parts = asked.select("locator_id", "table_id", F.explode(F.filter(F.transform(F.split("cell_value", ","), lambda t: F.trim(t)), lambda p: p != "")).alias("p"))
    several = parts.withColumn("v", key(F.col("p"))).join(texts, ["table_id", "v"], "left").groupBy("locator_id").agg((F.count("*") >= 2).alias("several"), F.bool_and(F.col("n").isNotNull()).alias("all_held"))
    told = free.select("locator_id").join(found, "locator_id", "left").join(several, "locator_id", "left")
    status = F.when(F.col("n") == 1, "normalised").when(F.col("n") > 1, "ambiguous").when(F.col("several") & F.col("all_held"), "parts").otherwise("unresolved")
    by_value = told.select("locator_id", status.alias("status"), F.when(F.col("n") == 1, F.col("id")).alias("id"), F.lit("value").alias("by"))
    return by_id.union(by_place).union(by_value).select("locator_id", "status", F.when(F.col("status") != "unresolved", F.col("id")).alias("cell_id"), "by")


def represented(refs: DataFrame, numeric: DataFrame) -> DataFrame:
    """cell_id and the roles (value, coordinate, condition) in which observations name numeric cells."""
    return refs.join(numeric.select("cell_id"), "cell_id", "left_semi").groupBy("cell_id").agg(F.array_sort(F.collect_set("role")).alias("roles"))


def table_entities(refs: DataFrame) -> DataFrame:
    """document_id, table_id, entity_ids that observations bind to a table, in order."""
    return refs.where("entity_id IS NOT NULL").groupBy("document_id", "table_id").agg(F.array_sort(F.collect_set("entity_id")).alias("entity_ids"))


def status_counts(rows: DataFrame, *group: str) -> DataFrame:
    """A map from status to how many rows have it."""
    per = rows.groupBy(*group, "status").agg(F.count("*").alias("n"))
    return per.groupBy(*group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("counts"))


def settings_map(values: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(values.items()) for x in kv])
