"""Registered queries of policies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataquery.operators import policies
from strataquery.plans.register import query
from strataquery.sources.documents import table


@query("""
    WITH e AS (SELECT p_partkey AS id, CASE p_size % 3 WHEN 0 THEN 'homopolymer' WHEN 1 THEN 'copolymer' END AS type, CASE WHEN p_size % 2 = 0 THEN 'alt' END AS sub, p_name || CASE p_partkey % 4 WHEN 0 THEN ' with filler' WHEN 1 THEN ' regioregular' WHEN 2 THEN ' regiorandom co-polymer' ELSE '' END AS text FROM part),
         r AS (SELECT *, CASE WHEN type = 'homopolymer' AND id % 4 = 0 THEN 'formulation' WHEN type = 'copolymer' AND sub = 'alt' AND id % 4 = 1 THEN 'regioregular' END AS reason FROM e)
    SELECT id AS entity_id, CASE reason WHEN 'formulation' THEN NULL WHEN 'regioregular' THEN 'homopolymer' ELSE type END AS type, CASE WHEN reason = 'regioregular' THEN NULL ELSE sub END AS subtype, reason FROM r""")
def q152_ruled_types(spark: SparkSession, d: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    said = F.when(key % 4 == 0, " with filler").when(key % 4 == 1, " regioregular").when(key % 4 == 2, " regiorandom co-polymer").otherwise("")
    rows = table(spark, d, "part").select(F.lit("d").alias("document_id"), key.alias("entity_id"), F.when(size % 3 == 0, "homopolymer").when(size % 3 == 1, "copolymer").alias("type"), F.when(size % 2 == 0, "alt").alias("subtype"), F.concat("p_name", said).alias("text"))
    out, changed = policies.ruled_types(rows)
    return out.join(changed.select("entity_id", "reason"), "entity_id", "left").select("entity_id", "type", "subtype", "reason")


@query("""
    WITH s AS (SELECT o_custkey AS d, o_orderkey AS s, CASE WHEN o_orderkey % 10 = 0 THEN 'composite' END AS m, CASE o_orderkey % 7 WHEN 0 THEN 'filled' WHEN 1 THEN 'doped' ELSE 'plain' END AS t, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
         x AS (SELECT *, coalesce(m, CASE t WHEN 'filled' THEN 'composite' WHEN 'doped' THEN 'compound' END) AS said FROM s),
         p AS (SELECT x.*, y.t AS it FROM x LEFT JOIN s y ON y.d = x.d AND y.n = x.n - 1), q AS (SELECT *, CASE WHEN it IS NOT NULL AND n % 3 = 2 THEN CASE WHEN it = 'filled' OR t = 'filled' THEN 'composite' ELSE 'compound' END END AS st FROM p),
         f AS (SELECT *, CASE WHEN said IS NULL OR said = 'composite' AND st = 'compound' THEN coalesce(st, said) ELSE said END AS now, CASE WHEN st IS NOT NULL AND (said IS NULL OR said = 'composite' AND st = 'compound') THEN 'step' WHEN m IS NOT NULL THEN 'given' WHEN said IS NOT NULL THEN 'text' END AS reason FROM q),
         g AS (SELECT a.*, b.now AS up1, c.now AS up2, b.n % 3 AS k1 FROM f a LEFT JOIN f b ON b.d = a.d AND b.n = a.n - 1 LEFT JOIN f c ON c.d = a.d AND c.n = a.n - 2),
         h AS (SELECT *, CASE WHEN now IS NOT NULL THEN now WHEN n = 1 THEN NULL WHEN n % 3 = 0 THEN up1 WHEN n % 3 = 1 THEN coalesce(up1, up2) END AS final FROM g)
    SELECT s AS sample_id, final AS material, CASE WHEN now IS NULL AND final IS NOT NULL THEN 'inherited' ELSE reason END AS reason FROM h""")
def q153_material_types(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    n = F.expr("row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("document_id"), key.alias("sample_id"), F.when(key % 10 == 0, "composite").alias("material"), F.when(key % 7 == 0, "filled").when(key % 7 == 1, "doped").otherwise("plain").alias("text"), n.alias("n"), F.expr("lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)").alias("before"))
    steps = rows.where("before IS NOT NULL").select("document_id", F.col("n").alias("step_id"), F.when(F.col("n") % 3 == 2, "mixing").otherwise("drying").alias("kind"), F.lit("").alias("sentence"), F.array("before").alias("inputs"), F.array("sample_id").alias("outputs"))
    return policies.material_types(rows.select("document_id", "sample_id", "material", "text"), steps).select("sample_id", "material", "reason")


@query("""
    WITH c AS (SELECT DISTINCT l_orderkey AS d, l_suppkey AS e, l_partkey % 5 AS m, 'b' || l_linenumber % 2 AS b FROM lineitem), v AS (SELECT DISTINCT l_orderkey AS d, l_suppkey AS e, 'b' || l_linenumber % 2 AS b, 'T' || l_partkey % 5 AS name FROM lineitem WHERE l_quantity > 25),
         many AS (SELECT d, m FROM c GROUP BY 1, 2 HAVING count(DISTINCT e) > 1), k AS (SELECT c.d, c.m, min(c.e) AS e FROM c JOIN v ON v.d = c.d AND v.e = c.e AND v.b = c.b AND lower(v.name) = 't' || c.m WHERE (c.d, c.m) IN (SELECT (d, m) FROM many) GROUP BY 1, 2 HAVING count(DISTINCT c.e) = 1),
         l AS (SELECT DISTINCT d, e, m FROM c WHERE (d, m) NOT IN (SELECT (d, m) FROM many) UNION SELECT d, e, m FROM k)
    SELECT 'claims' AS kind, count(*) AS n FROM l UNION ALL SELECT 'open', count(*) FROM many WHERE (d, m) NOT IN (SELECT (d, m) FROM k) UNION ALL SELECT 'emptied', count(*) FROM (SELECT DISTINCT d, e FROM c) WHERE (d, e) NOT IN (SELECT (d, e) FROM l)""")
def q154_mention_owners(spark: SparkSession, d: str) -> DataFrame:
    number = (F.col("l_partkey") % 5).cast("string")
    block = F.concat(F.lit("b"), (F.col("l_linenumber") % 2).cast("string")).alias("block_id")
    lines = table(spark, d, "lineitem").withColumnsRenamed({"l_orderkey": "document_id", "l_suppkey": "entity_id"})
    claims = lines.select("document_id", "entity_id", number.alias("mention_id"), F.concat(F.lit("t"), number).alias("text"), block).distinct()
    evidence = lines.where("l_quantity > 25").select("document_id", "entity_id", block, F.concat(F.lit("T"), number).alias("name")).distinct()
    left, lost, emptied = policies.mention_owners(claims, evidence)
    count = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(left, "claims").union(count(lost, "open")).union(count(emptied, "emptied"))


@query("""
    WITH m AS (SELECT p_brand AS d, p_partkey AS id, p_name || ' and ' || CASE WHEN p_partkey % 2 = 0 THEN split_part(p_name, ' ', 1) ELSE 'x' END AS s, unnest([p_name, split_part(p_name, ' ', 1)]) AS t, unnest([1, 2]) AS k FROM part)
    SELECT d AS document_id, id * 10 + 2 AS "inner", id * 10 + 1 AS "outer" FROM m WHERE k = 1 AND id % 2 = 1 AND NOT contains(replace(s, t, ''), split_part(t, ' ', 1)) AND split_part(t, ' ', 1) <> t""")
def q155_nested_mentions(spark: SparkSession, d: str) -> DataFrame:
    first = F.substring_index("p_name", " ", 1)
    sentence = F.concat("p_name", F.lit(" and "), F.when(F.col("p_partkey") % 2 == 0, first).otherwise("x"))
    rows = table(spark, d, "part").select(F.col("p_brand").alias("document_id"), F.col("p_partkey").alias("block_id"), sentence.alias("sentence"), F.posexplode(F.array(F.col("p_name"), first)).alias("k", "text"))
    return policies.nested_pairs(rows.withColumn("mention_id", F.col("block_id") * 10 + F.col("k") + 1))


@query("""
    WITH o AS (SELECT o_custkey AS d, o_orderkey AS s, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
         h AS (SELECT d, s, n FROM o WHERE n % 4 = 2 OR n % 4 = 0)
    SELECT d AS document_id, s AS step_id, 's' || printf('%03d', 5 + row_number() OVER (PARTITION BY d ORDER BY n)) AS sample_id FROM h""")
def q156_between_steps(spark: SparkSession, d: str) -> DataFrame:
    n = F.expr("row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("document_id"), F.col("o_orderkey").alias("step_id"), n.alias("position"))
    turn = F.col("position") % 4
    kind = F.when(turn == 1, "casting").when(turn == 2, "drying").when(turn == 3, "solvent_extraction").otherwise("pressing")
    inputs = F.when(turn.isin(1, 2), F.array(F.lit("a"))).when(turn == 3, F.array(F.lit("c"))).otherwise(F.array(F.lit("b")))
    steps = rows.select("document_id", "step_id", "position", kind.alias("kind"), inputs.alias("inputs"), F.array(F.lit("b")).alias("outputs"), F.lit("e").alias("evidence"))
    samples = rows.select("document_id", F.lit("s005").alias("sample_id")).distinct()
    return policies.between_steps(steps, samples).select("document_id", "step_id", "sample_id")


@query("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'x' END AS one, CASE WHEN o_orderkey % 4 = 2 THEN 'a,b' ELSE '' END AS many, CASE o_orderkey % 4 WHEN 2 THEN 'multi_resolved' WHEN 3 THEN 'unresolved' ELSE 'resolved' END AS status, CASE o_orderkey % 3 WHEN 0 THEN 'complete' WHEN 1 THEN 'partial' ELSE 'failed' END AS metadata,
        CASE WHEN o_orderkey % 2 = 0 THEN 's1' ELSE '' END AS series, 'p1' AS derived FROM orders""")
def q157_scopes(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    many = F.when(key % 4 == 0, F.array(F.lit("a"), F.lit("a"))).when(key % 4 == 2, F.array(F.lit("a"), F.lit("b"), F.lit("a"))).when(key % 4 == 3, F.array().cast("array<string>"))
    one, several, status = policies.subject_scope(F.when(key % 4 == 1, "x"), many, F.lit("unresolved"))
    blank = F.when(key % 3 == 1, " ")
    metadata = policies.metadata_status(F.when(key % 3 == 0, "t").otherwise(blank), F.when(key % 3 < 2, "u"))
    rows = table(spark, d, "orders").select("o_orderkey", one.alias("one"), F.coalesce(F.array_join(several, ","), F.lit("")).alias("many"), status.alias("status"), metadata.alias("metadata"))
    owners = table(spark, d, "orders").select(key.alias("document_id"), key.alias("owner_id"), F.array(F.lit("p1"), F.lit("s1")).alias("derived"), F.lit(None).cast("array<string>").alias("series_ids"))
    moved = policies.moved_references(owners, "derived", owners.where("document_id % 2 = 0").select("document_id", F.lit("s1").alias("series_id")))
    shown = moved.select(F.col("owner_id").alias("o_orderkey"), F.array_join("series_ids", ",").alias("series"), F.array_join(F.array_except("derived", F.when(F.col("document_id") % 2 != 0, F.array(F.lit("s1"))).otherwise(F.array().cast("array<string>"))), ",").alias("derived"))
    return rows.join(shown, "o_orderkey")


@query("""
    WITH a AS (SELECT DISTINCT p_type AS name, p_name AS alias FROM part WHERE p_partkey < 60 UNION SELECT DISTINCT 'first', split_part(p_name, ' ', 1) FROM part WHERE p_partkey < 20), t AS (SELECT p_partkey AS text_id, 'the ' || upper(p_name) || ', tested' AS text FROM part),
         m AS (SELECT text_id, name, alias FROM t JOIN a ON contains(' ' || lower(replace(text, ',', '')) || ' ', ' ' || lower(alias) || ' '))
    SELECT text_id, array_to_string(list_sort(list(DISTINCT name)), ',') AS names, arg_max(alias, (length(alias), alias)) AS surface FROM m GROUP BY 1""")
def q158_method_names(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part")
    aliases = parts.where("p_partkey < 60").select(F.col("p_type").alias("name"), F.col("p_name").alias("alias")).union(parts.where("p_partkey < 20").select(F.lit("first"), F.substring_index("p_name", " ", 1))).distinct()
    texts = parts.select(F.col("p_partkey").alias("text_id"), F.concat(F.lit("the "), F.upper("p_name"), F.lit(", tested")).alias("text"))
    return policies.longest_alias(texts, aliases).withColumn("names", F.array_join("names", ","))


@query("""
    SELECT 'scope' AS kind, count(*) AS n FROM (SELECT s_suppkey, s_nationkey FROM supplier WHERE s_suppkey % 4 = 0) m JOIN (SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 3 = 0) s ON s_nationkey = c_nationkey
    UNION ALL SELECT 'unused', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def q159_scope_and_unused(spark: SparkSession, d: str) -> DataFrame:
    sentence = F.when(F.col("s_suppkey") % 4 == 0, "all synthesized polymers were dried").otherwise("the polymer was dried")
    methods = table(spark, d, "supplier").select(F.col("s_nationkey").alias("document_id"), F.col("s_suppkey").alias("method_id"), sentence.alias("sentence"))
    customers = table(spark, d, "customer")
    samples = customers.select(F.col("c_nationkey").alias("document_id"), F.col("c_custkey").alias("sample_id"), F.when(F.col("c_custkey") % 3 == 0, "synthesis_batch").otherwise("film").alias("kind"))
    scoped = policies.expanded_scope(methods, samples, r"(?i)\ball\s+(?:the\s+)?synthesi[sz]ed\s+polymers\b")
    objects = customers.select(F.lit(0).alias("document_id"), F.col("c_custkey").alias("key"))
    left = policies.unused(objects, "key", [(table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.lit(0).alias("document_id"), "o_custkey"), "o_custkey")])
    count = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(scoped, "scope").union(count(left, "unused"))
