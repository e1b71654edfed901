"""Registered queries of surface texts and document projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataquery.functions import surface, text
from strataquery.operators import project
from strataquery.plans.register import query
from strataquery.sources.documents import table

_KEYS = r"'x $\pm$ y \pm z^{\circ}\mathrm{C} \delta $', 'T_g \mathrm{max} {a}\times 3', 'a 0 . 0 6 3 b 394 446 c 1 , 5', '<b>A</b>\text{x}-1 µ', '^\circ C \eta', ' (a) / b '"


@query(r"""
    WITH t AS (SELECT p_partkey, p_name, p_partkey % 6 AS k, [""" + _KEYS + r"""][p_partkey % 6 + 1] AS x FROM part)
    SELECT p_partkey, ['x ± y ± z°c δ', 't_g \mathrm{max} {a}\times 3', 'a 0 . 0 6 3 b 394 446 c 1 , 5', '<b>a</b>\text{x}-1 µ', '° c η', '(a) / b'][k + 1] AS compared, [' x   ±   y ± z° C δ   ', 'T_g max  a × 3', 'a 0 . 0 6 3 b 394 446 c 1 , 5', '<b>A</b>x-1 µ', '°C η', ' (a) / b '][k + 1] AS folded,
        ['x $\pm$ y', 'T_g', 'a 0.063 b 394 446 c 1,5', '<b>', '^\circ C \eta', ' (a) / b '][k + 1] AS joined, ['xyzcδ', 'tgmaxa3', 'a0063b394446c15', 'babx1µ', 'c', 'ab'][k + 1] AS formula FROM t WHERE k IN (2, 4, 5)""")
def q131_text_keys(spark: SparkSession, d: str) -> DataFrame:
    x = F.get(F.array(*[F.lit(t) for t in (r"x $\pm$ y \pm z^{\circ}\mathrm{C} \delta $", r"T_g \mathrm{max} {a}\times 3", "a 0 . 0 6 3 b 394 446 c 1 , 5", r"<b>A</b>\text{x}-1 µ", r"^\circ C \eta", " (a) / b ")]), (F.col("p_partkey") % 6).cast("int"))
    rows = table(spark, d, "part").where("p_partkey % 6 IN (2, 4, 5)").select("p_partkey", x.alias("x"))
    x = F.col("x")
    return rows.select("p_partkey", surface.comparison_key(x).alias("compared"), surface.folded_latex(x).alias("folded"), surface.joined_numbers(x).alias("joined"), surface.formula_key(x).alias("formula"))


@query("""
    WITH t AS (SELECT doc_id, lang, text, upper(regexp_extract(text, '([a-z]+ [a-z]+)', 1)) AS said, replace(regexp_extract(text, '([a-z]+ [a-z]+)', 1), ' ', '') AS glued, regexp_extract(text, '([a-z]+ [a-z]+)', 1) AS plain FROM documents)
    SELECT doc_id, plain <> '' AS has_pair, CASE WHEN plain <> '' THEN lower(plain) END AS cased, CASE WHEN plain <> '' THEN true END AS spaced FROM t WHERE regexp_matches(lang, 'en')""")
def q132_surfaces(spark: SparkSession, d: str) -> DataFrame:
    plain = F.regexp_extract("text", "([a-z]+ [a-z]+)", 1)
    rows = table(spark, d, "documents").where("lang = 'en'").select("doc_id", "text", plain.alias("plain"))
    cased = surface.found_surface(F.col("text"), F.upper("plain"))
    spaced = surface.found_spaced(F.col("text"), F.replace("plain", F.lit(" "), F.lit("")))
    same = F.regexp_replace(spaced, r"\s+", "") == F.replace("plain", F.lit(" "), F.lit(""))
    return rows.select("doc_id", (F.col("plain") != "").alias("has_pair"), F.lower(cased).alias("cased"), same.alias("spaced"))


@query(r"""
    WITH s AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?。！？]\s+|\n+')) AS s, generate_subscripts(string_split_regex(text, '[.!?。！？]\s+|\n+'), 1) AS i FROM documents WHERE n_chars < 3000),
         f AS (SELECT doc_id, i, trim(s) AS s, string_split(trim(s), ' ')[2] AS w FROM s WHERE length(s) < 400),
         p AS (SELECT f.doc_id, min(i) AS i FROM f WHERE w IS NOT NULL AND length(w) > 6 AND regexp_full_match(w, '[a-z]+') GROUP BY 1)
    SELECT f.doc_id, w AS anchor, true AS held FROM f JOIN p USING (doc_id, i)""")
def q133_sentences(spark: SparkSession, d: str) -> DataFrame:
    pieces = F.transform(F.split("text", surface.SENTENCE_END), lambda t: F.trim(t))
    fit = lambda s: (F.length(s) < 400) & F.coalesce(F.length(F.get(F.split(s, " "), F.lit(1))) > 6, F.lit(False)) & F.get(F.split(s, " "), F.lit(1)).rlike("^[a-z]+$")
    rows = table(spark, d, "documents").where("n_chars < 3000").select("doc_id", "text", F.get(F.filter(pieces, fit), F.lit(0)).alias("s")).where("s IS NOT NULL")
    anchor = F.get(F.split("s", " "), F.lit(1))
    # the first place of the word may be an earlier one: the sentence holds it wherever it is, and no sentence ends inside
    around = surface.sentence_around(F.col("text"), anchor, 500)
    return rows.select("doc_id", anchor.alias("anchor"), (F.contains(around, anchor) & (F.length(around) <= 500)).alias("held"))


@query("""
    SELECT p_partkey, 'Fig. ' || p_size AS figure, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'reference_no_' || p_size END AS ref, p_name || '|' || p_type AS parts, regexp_replace(p_name, '[^A-Za-z0-9_.-]+', '_', 'g') AS slug, CASE WHEN p_partkey % 2 = 0 THEN p_name || '; ' || p_type ELSE p_type END AS joined,
        'a b: ' || p_name || '; size: ' || p_size AS shown, CASE WHEN p_partkey % 4 = 0 THEN 'Copolymer' WHEN p_partkey % 4 = 1 THEN 'Blend / composite' WHEN p_partkey % 4 = 2 THEN 'Homopolymer' ELSE '待确认' END AS label FROM part""")
def q134_labels(spark: SparkSession, d: str) -> DataFrame:
    key, size, name = F.col("p_partkey"), F.col("p_size").cast("string"), F.col("p_name")
    caption = F.concat(F.lit("see figure "), size, F.lit(" and Fig. 2"))
    file = F.when(key % 3 == 0, F.lit("paper_1.pdf")).when(key % 3 == 1, F.concat(F.lit(" reference_no_"), size, F.lit(".pdf"))).otherwise(F.concat(F.lit("x/reference_no_"), size, F.lit("_document.json ")))
    blank = F.when(key % 2 == 0, name).otherwise("  ")
    kind = F.when(key % 4 == 0, "copolymer")
    said = F.when(key % 4 == 1, F.concat(name, F.lit(" Blend"))).otherwise(name)
    return table(spark, d, "part").select(
        "p_partkey", surface.figure_label(caption, key).alias("figure"), surface.reference_id(file).alias("ref"), F.array_join(surface.label_parts(F.concat(name, F.lit(" / "), F.col("p_type"), F.lit(" /  "))), "|").alias("parts"), F.regexp_extract(surface.data_id(F.concat(name, F.lit(".pdf"))), "^(.*)-[0-9a-f]{10}$", 1).alias("slug"),
        surface.joined_text(F.array(blank, F.col("p_type"))).alias("joined"), surface.map_text(F.create_map(F.lit("a_b"), name, F.lit("none"), F.lit(" "), F.lit("size"), size)).alias("shown"), surface.type_label(kind, said, key % 4 == 2).alias("label"),
    )


@query("""
    SELECT p_partkey, array_to_string(list_transform(list_sort(list_transform(list_distinct([p_name, p_type, p_brand]), lambda t: [-length(t)::BIGINT, CASE WHEN t = p_name THEN 0 WHEN t = p_type THEN 1 ELSE 2 END])), lambda x: CASE x[2] WHEN 0 THEN p_name WHEN 1 THEN p_type ELSE p_brand END), '|') AS terms,
        true AS same_cell, p_size >= 100 AS number_cell, length(p_name) >= 3 AS held_cell, CASE WHEN p_partkey % 2 = 0 THEN 1.0 ELSE 0.5 END AS coverage FROM part""")
def q135_terms_and_cells(spark: SparkSession, d: str) -> DataFrame:
    name, size = F.col("p_name"), F.col("p_size").cast("string")
    words = F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("alphabeta"), F.lit("446"))).otherwise(F.array(F.lit("xalphax"), F.lit("44")))
    return table(spark, d, "part").select(
        "p_partkey", F.array_join(surface.highlight_terms(F.array(name, F.col("p_type"), F.col("p_brand"), F.lit("x"))), "|").alias("terms"), surface.cells_match(F.concat(F.lit("<b>$"), F.upper(name), F.lit("$</b>")), name).alias("same_cell"),
        surface.cells_match(F.concat(size, F.lit("0")), size).alias("number_cell"), surface.cells_match(F.concat(F.lit("the "), name, F.lit(" one")), name).alias("held_cell"), surface.glued_coverage(F.array(F.lit("alpha"), F.lit("446")), words).alias("coverage"),
    )


# --- projections --------------------------------------------------------------------------------------------

_DOCS = """
    WITH b AS (SELECT conv_id AS document_id, turn AS position, turn // 3 AS page, CASE turn % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'table' WHEN 2 THEN 'image' WHEN 3 THEN 'references' ELSE 'odd' END AS type, text, CASE WHEN turn % 2 = 0 THEN role ELSE '' END AS cap, CASE WHEN turn % 3 = 0 THEN '' ELSE 'body ' || turn END AS body FROM conversations)"""


def _docs(spark: SparkSession, d: str) -> DataFrame:
    turn = F.col("turn").cast("int")
    kind = F.when(turn % 5 == 0, "text").when(turn % 5 == 1, "table").when(turn % 5 == 2, "image").when(turn % 5 == 3, "references").otherwise("odd")
    return table(spark, d, "conversations").select(
        F.col("conv_id").alias("document_id"), turn.alias("position"), F.floor(turn / 3).alias("page"), kind.alias("type"), "text", F.when(turn % 2 == 0, F.col("role")).otherwise("").alias("cap"), F.when(turn % 3 == 0, "").otherwise(F.concat(F.lit("body "), turn.cast("string"))).alias("body"), F.array(turn, turn + 1).alias("bbox")
    )


@query(_DOCS + """
    SELECT document_id, CASE type WHEN 'table' THEN 'T' WHEN 'image' THEN 'I' WHEN 'references' THEN 'R' ELSE 'P' END || '_' || page || '_' || (row_number() OVER (PARTITION BY document_id, page ORDER BY position) - 1) AS block_id,
        sha256(CASE WHEN type = 'table' THEN concat_ws(chr(10), nullif(trim(cap), ''), nullif(trim(body), '')) ELSE trim(text) END) AS input, sha256(CASE WHEN type = 'table' THEN concat_ws(chr(10), nullif(cap, ''), nullif(body, '')) WHEN type = 'image' THEN cap ELSE text END) AS joined,
        sha256(CASE WHEN type = 'table' THEN coalesce(nullif(body, ''), cap) WHEN type = 'image' THEN cap ELSE text END) AS body_first FROM b""")
def q136_blocks(spark: SparkSession, d: str) -> DataFrame:
    rows = project.block_ids(_docs(spark, d))
    columns = [F.col(c) for c in ("type", "text", "cap", "body")]
    return rows.select("document_id", "block_id", F.sha2(project.input_text(*columns), 256).alias("input"), F.sha2(project.source_text(*columns), 256).alias("joined"), F.sha2(project.source_text(*columns, joined=False), 256).alias("body_first"))


@query(_DOCS + """
    SELECT document_id, 'pages' AS kind, sha256(string_agg(trim(text), chr(10) ORDER BY page, position)) AS value FROM b WHERE page < 2 AND trim(text) <> '' GROUP BY 1
    UNION ALL SELECT document_id, CASE WHEN type = 'references' THEN 'dropped_type' ELSE 'unsupported_type' END, CAST(count(*) AS VARCHAR) FROM b WHERE type IN ('references', 'odd') GROUP BY 1, 2 UNION ALL SELECT document_id, 'kept', CAST(count(*) AS VARCHAR) FROM b WHERE type NOT IN ('references', 'odd') GROUP BY 1""")
def q137_pages_and_types(spark: SparkSession, d: str) -> DataFrame:
    rows = _docs(spark, d)
    kept, warned = project.supported(rows, ["text", "table", "image"])
    out = project.first_pages(rows).select("document_id", F.lit("pages").alias("kind"), F.sha2("text", 256).alias("value"))
    return out.union(warned.select("document_id", "code", F.col("n").cast("string"))).union(kept.groupBy("document_id").agg(F.count("*").cast("string").alias("v")).select("document_id", F.lit("kept"), "v"))


@query("""
    SELECT o_orderkey, o_orderpriority || '$' || o_orderstatus || '$' || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '!' END AS text, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || ' ' || o_orderstatus WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS caption FROM orders""")
def q138_rich_text(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    piece = lambda kind, content: F.struct(F.lit(kind).alias("type"), content.alias("content"))
    pieces = F.array(piece("text", F.col("o_orderpriority")), piece("equation_inline", F.col("o_orderstatus")), piece("odd", F.lit("no")), piece("text", F.when(key % 2 != 0, "!")))
    none = F.array().cast("array<string>")
    first = F.when(key % 3 == 0, F.array(F.col("o_orderpriority"), F.lit(None), F.col("o_orderstatus"))).otherwise(none)
    second = F.when(key % 3 == 1, F.array(F.lit(" "), F.col("o_orderstatus"))).otherwise(F.array(F.lit(" ")))
    return table(spark, d, "orders").select("o_orderkey", project.rich_text(pieces)["text"].alias("text"), project.caption(first, second).alias("caption"))


@query("""
    WITH o AS (SELECT o_custkey AS d, o_orderkey, 's' || printf('%03d', row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC)) AS id FROM orders), l AS (SELECT DISTINCT o_custkey AS d, l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey), m AS (SELECT d, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY d ORDER BY l_orderkey * 10 + l_linenumber) AS n FROM l)
    SELECT m.d AS document_id, 'p' || printf('%03d', n) AS property_id, id AS sample_id, id || ',x' AS both FROM m JOIN o ON o.d = m.d AND o.o_orderkey = m.l_orderkey""")
def q139_materialised(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("document_id"), F.col("o_orderkey").cast("string").alias("sample_id"), (-F.col("o_orderkey")).alias("at"))
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    name = F.col("l_orderkey").cast("string")
    place = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    properties = lines.select(F.col("o_custkey").alias("document_id"), place.cast("string").alias("property_id"), place.alias("place"), name.alias("sample_id"), F.array(name, F.lit("x")).alias("both")).dropDuplicates(["document_id", "property_id"])
    made = project.materialised({"samples": (orders, "sample_id", "at", "s"), "properties": (properties, "property_id", "place", "p")}, [("properties", "sample_id", "samples"), ("properties", "both", "samples")])
    return made["properties"].select("document_id", "property_id", "sample_id", F.array_join("both", ",").alias("both"))


@query("""
    WITH e AS (SELECT l_orderkey AS k, l_linenumber * 100000 + l_partkey AS position, sha256('b' || l_suppkey) AS digest, 'ev' || l_suppkey AS id FROM lineitem WHERE l_suppkey % 4 <> 0), f AS (SELECT k, id, min(position) AS p FROM e GROUP BY 1, 2)
    SELECT o_orderkey, coalesce((SELECT string_agg(id, ',' ORDER BY p, id) FROM f WHERE k = o_orderkey), '') AS ids FROM orders""")
def q140_evidence_ids(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    digest = F.sha2(F.concat(F.lit("b"), F.col("l_suppkey").cast("string")), 256).alias("digest")
    evidence = lines.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_linenumber") * 100000 + F.col("l_partkey")).alias("position"), digest)
    ids = lines.where("l_suppkey % 4 <> 0").select(digest, F.concat(F.lit("ev"), F.col("l_suppkey").cast("string")).alias("evidence_id")).distinct()
    made = project.evidence_by_id(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", evidence, ids)
    return made.select("o_orderkey", F.array_join("evidence_ids", ",").alias("ids"))


@query("""
    WITH w AS (SELECT o_orderkey AS document_id, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE ' s' || o_orderstatus END AS stage, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'c ' END AS code, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS message, CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE 'x' END AS object_id FROM orders)
    SELECT document_id, coalesce(nullif(trim(stage), ''), 'stage0') AS stage, coalesce(nullif(trim(code), ''), 'upstream_warning') AS code, coalesce(nullif(trim(message), ''), 'an upstream stage warned') AS message, nullif(trim(object_id), '') AS object_id FROM w""")
def q141_warning_rows(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        key.alias("document_id"), F.when(key % 3 == 0, " ").otherwise(F.concat(F.lit(" s"), "o_orderstatus")).alias("stage"), F.when(key % 4 != 0, "c ").alias("code"), F.when(key % 5 == 0, "").otherwise(F.col("o_orderpriority")).alias("message"), F.when(key % 2 == 0, " ").otherwise("x").alias("object_id")
    )
    return project.warning_rows(rows, F.lit("stage0"))


@query("""
    WITH s AS (SELECT l_orderkey AS document_id, CASE WHEN l_linenumber % 2 = 0 THEN 'stage1' ELSE 'stage2' END AS stage, max(CASE WHEN l_linenumber > 2 THEN l_linenumber END) AS call_count, max(l_linenumber) AS chunk_count, CAST(sum(l_quantity) AS BIGINT) AS tokens, CASE WHEN max(l_partkey) % 3 = 0 THEN NULL ELSE max(l_partkey) END AS cost FROM lineitem GROUP BY 1, 2), d AS (SELECT DISTINCT document_id FROM s)
    SELECT d.document_id, x.stage, coalesce(call_count, chunk_count) AS call_count, tokens, cost, CASE WHEN cost IS NULL THEN 'unavailable' ELSE 'calculated' END AS status FROM d CROSS JOIN (VALUES ('stage1'), ('stage2'), ('stage3')) x(stage) LEFT JOIN s ON s.document_id = d.document_id AND s.stage = x.stage""")
def q142_stage_billing(spark: SparkSession, d: str) -> DataFrame:
    number = F.col("l_linenumber")
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("document_id"), F.when(number % 2 == 0, "stage1").otherwise("stage2").alias("stage")).agg(F.max(F.when(number > 2, number)).alias("call_count"), F.max(number).alias("chunk_count"), F.sum("l_quantity").cast("long").alias("tokens"), F.max("l_partkey").alias("top"))
    return project.stage_billing(rows.withColumn("cost", F.when(F.col("top") % 3 != 0, F.col("top"))).drop("top"), ["stage1", "stage2", "stage3"])


@query("""
    SELECT p_partkey AS document_id, 'type' AS kind, p_type AS value FROM part UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_partkey, 'blend', unnest([p_brand, 'b' || p_size]) FROM part WHERE p_partkey % 3 = 0""")
def q143_flat_process(spark: SparkSession, d: str) -> DataFrame:
    blend = F.when(F.col("p_partkey") % 3 == 0, F.array(F.col("p_brand"), F.lit(" "), F.concat(F.lit("b"), F.col("p_size").cast("string")))).otherwise(F.array(F.lit("")))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("document_id"), F.concat(F.lit(" "), "p_type").alias("type"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("size"), blend.alias("blend"))
    return project.flattened_process(rows)


@query("""
    WITH s AS (SELECT l_orderkey AS task_id, l_linenumber AS position, CASE WHEN bool_and(l_linestatus = 'F') THEN 'complete' ELSE 'running' END AS status FROM lineitem GROUP BY 1, 2)
    SELECT task_id, CAST(round(count(*) FILTER (status = 'complete') * 100 / count(*)) AS INTEGER) AS progress, 'st' || min(position) FILTER (status = 'running') AS current_stage, arg_max(status, position) = 'complete' AS result_ready FROM s GROUP BY 1""")
def q144_task_views(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("task_id"), F.col("l_linenumber").alias("position")).agg(F.when(F.bool_and(F.col("l_linestatus") == "F"), "complete").otherwise("running").alias("status"))
    return project.task_views(rows.withColumn("stage", F.concat(F.lit("st"), F.col("position").cast("string"))))


@query("""
    SELECT c_custkey AS document_id, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS finished FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def q145_overview(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").withColumn("document_id", F.col("o_custkey"))
    return project.overview({"orders": orders, "finished": orders.where("o_orderstatus = 'F'")})


@query("""
    WITH e AS (SELECT p_partkey AS entity_id, CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN 'copolymer' ELSE 'homopolymer' END AS type, CASE WHEN p_size % 2 = 0 THEN 'block' END AS subtype FROM part),
         s AS (SELECT DISTINCT l_orderkey AS sample_id, l_partkey AS entity_id, CASE WHEN l_partkey % 4 = 0 THEN 'copolymer' END AS type, CAST(NULL AS VARCHAR) AS subtype FROM lineitem), m AS (SELECT s.*, e.type AS t, CASE WHEN e.type = 'copolymer' THEN e.subtype END AS u FROM s LEFT JOIN e USING (entity_id))
    SELECT 'aligned' AS kind, coalesce(t, type) AS type, CASE WHEN t IS NULL THEN subtype ELSE u END AS subtype, count(*) AS n FROM m GROUP BY 2, 3 UNION ALL SELECT 'changed', t, u, count(*) FROM m WHERE t IS NOT NULL AND (type IS DISTINCT FROM t OR subtype IS DISTINCT FROM u) GROUP BY 2, 3""")
def q146_aligned_types(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    entities = table(spark, d, "part").select(F.lit("d").alias("document_id"), F.col("p_partkey").alias("entity_id"), F.when(size % 3 == 1, "copolymer").when(size % 3 == 2, "homopolymer").alias("type"), F.when(size % 2 == 0, "block").alias("subtype"))
    samples = table(spark, d, "lineitem").select(F.lit("d").alias("document_id"), F.col("l_orderkey").alias("sample_id"), F.col("l_partkey").alias("entity_id"), F.when(F.col("l_partkey") % 4 == 0, "copolymer").alias("type"), F.lit(None).cast("string").alias("subtype")).distinct()
    aligned, changed = project.aligned_types(samples, entities)
    count = lambda df, kind: df.groupBy("type", "subtype").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "type", "subtype", "n")
    return count(aligned, "aligned").union(count(changed, "changed"))


@query("""
    SELECT event_id AS document_id, event_type AS stage, 'outer' AS error_class, CASE WHEN event_id % 3 = 0 THEN 'c' || user_id WHEN event_id % 3 = 1 THEN 'inner' END AS error_code FROM events WHERE event_id % 2 = 0""")
def q147_failures(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("event_id")
    cause = lambda name, code: F.struct(F.lit(name).alias("class"), code.cast("string").alias("code"))
    causes = F.array(cause("outer", F.lit(None)), cause("middle", F.when(key % 3 == 0, F.concat(F.lit("c"), F.col("user_id").cast("string")))), cause("root", F.when(key % 3 < 2, "inner")))
    rows = table(spark, d, "events").select(key.alias("document_id"), F.col("event_type").alias("stage"), F.when(key % 2 == 0, "failed").otherwise("succeeded").alias("status"), causes.alias("causes"))
    return project.failure_rows(rows)


@query("""
    WITH p AS (SELECT p_brand, p_partkey, p_name, p_size, p_type || '' AS sample FROM part)
    SELECT p_brand, arg_min(p_name, p_partkey) AS p_name, array_to_string(list_sort(list(DISTINCT sample)), ',') AS sample_ids, CAST(count(DISTINCT sample) AS INTEGER) AS n_samples FROM p GROUP BY 1""")
def q148_grouped_views(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_brand", "p_partkey", "p_name", F.col("p_type").alias("sample_id"))
    return project.first_points(rows, "p_brand", "p_partkey").withColumn("sample_ids", F.array_join("sample_ids", ","))


@query("""
    WITH o AS (SELECT 'stage4' AS stage, o_orderkey AS id, o_orderstatus AS a, CAST(NULL AS VARCHAR) AS b FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'stage5', o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderkey % 3 = 0)
    SELECT stage, a, b, count(*) AS n, CASE WHEN stage = 'stage4' THEN 'material_mentions' ELSE 'stage5' END AS collection, CASE WHEN stage = 'stage4' THEN 'ev1,ev2' ELSE 'ev2' END AS ids FROM o GROUP BY 1, 2, 3""")
def q149_union(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    both = project.union_collections([("stage4", orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("a"))), ("stage5", orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("b")))])
    rows = both.groupBy("stage", "a", "b").agg(F.count("*").alias("n"))
    old = F.when(F.col("stage") == "stage4", F.array(F.lit("ev1")))
    return rows.select("stage", "a", "b", "n", project.renamed_collections(F.col("stage"), {"stage4": "material_mentions"}).alias("collection"), F.array_join(project.merged_ids(old, F.array(F.lit("ev2"))), ",").alias("ids"))


@query("""
    SELECT b.conv_id AS document_id, b.turn AS block_id, b.turn // 3 AS page, b.role AS source_type, b.turn + 1 AS box_end FROM conversations b WHERE b.turn % 2 = 0 UNION ALL SELECT DISTINCT conv_id, 99, NULL::BIGINT, NULL, NULL FROM conversations""")
def q150_located(spark: SparkSession, d: str) -> DataFrame:
    turn = F.col("turn").cast("int")
    blocks = table(spark, d, "conversations").select(F.col("conv_id").alias("document_id"), turn.alias("block_id"), F.floor(turn / 3).alias("page"), F.array(turn, turn + 1).alias("bbox"), F.col("role").alias("type"))
    evidence = blocks.where("block_id % 2 = 0").select("document_id", "block_id").union(blocks.select("document_id", F.lit(99)).distinct())
    return project.located(evidence, blocks).select("document_id", "block_id", "page", "source_type", F.get("bbox", F.lit(1)).alias("box_end"))


@query(r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents) SELECT doc_id, len(w) AS n_words, len(list_distinct(w)) AS n_distinct FROM w""")
def q151_words(spark: SparkSession, d: str) -> DataFrame:
    words = text.tokens(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(words).cast("long").alias("n_words"), F.size(F.array_distinct(words)).cast("long").alias("n_distinct"))
