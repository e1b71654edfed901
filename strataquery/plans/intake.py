"""Registered queries of scans and sinks: what is listed, chosen, paired, recovered, published and layered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataquery.sources import scans, sinks
from strataquery.sources.documents import table
from strataquery.plans.register import query


@query("""
    WITH a AS (SELECT 's' || s_suppkey AS ref, s_nationkey FROM supplier), l AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN '# note' WHEN c_custkey % 5 = 0 THEN ' ' ELSE ' s' || (c_custkey * 3 % 120) || ' ' END AS value, c_custkey AS place FROM customer WHERE c_custkey < 150),
         r AS (SELECT trim(value) AS ref, min(place) AS place, count(*) AS times FROM l WHERE trim(value) <> '' AND NOT starts_with(trim(value), '#') GROUP BY 1)
    SELECT 'chosen' AS kind, ref, CAST(place AS BIGINT) AS n FROM (SELECT ref, place FROM r JOIN a USING (ref) ORDER BY place LIMIT 40) UNION ALL SELECT 'missing', ref, 0 FROM r WHERE ref NOT IN (SELECT ref FROM a) UNION ALL SELECT 'twice', ref, times FROM r WHERE times > 1""")
def q120_document_selection(spark: SparkSession, d: str) -> DataFrame:
    available = table(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("ref"))
    key = F.col("c_custkey")
    value = F.when(key % 7 == 0, "# note").when(key % 5 == 0, " ").otherwise(F.concat(F.lit(" s"), (key * 3 % 120).cast("string"), F.lit(" ")))
    lines = table(spark, d, "customer").where("c_custkey < 150").select(value.alias("value"), key.alias("at"))
    requested, twice = scans.request_list(lines)
    chosen, missing = scans.select_documents(available, requested, 40)
    rows = chosen.select(F.lit("chosen").alias("kind"), "ref", F.col("at").alias("n")).union(missing.select(F.lit("missing"), "ref", F.lit(0).cast("long")))
    return rows.union(twice.select(F.lit("twice"), "ref", F.col("times")))


@query("""
    WITH f AS (SELECT l_orderkey AS ref, ['md', 'list', 'pdf', 'img'][l_linenumber % 4 + 1] AS kind, l_partkey || '.' || l_linenumber AS name FROM lineitem), c AS (SELECT ref, count(*) FILTER (kind = 'md') AS md, count(*) FILTER (kind = 'list') AS list, count(*) FILTER (kind = 'img') AS img FROM f GROUP BY 1),
         x AS (SELECT ref, unnest(['md', 'list', 'img']) AS rule, unnest([md, list, img]) AS n, unnest([md <> 1, list <> 1, img > 1]) AS broken FROM c)
    SELECT ref, rule, n FROM x WHERE broken""")
def q121_artifact_cardinality(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("l_linenumber") % 4
    files = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ref"), kind.alias("kind"))
    return scans.cardinality(files, ["ref"], {"md": (F.col("kind") == 0, 1, 1), "list": (F.col("kind") == 1, 1, 1), "img": (F.col("kind") == 3, 0, 1)})


@query("""
    WITH f AS (SELECT l_orderkey AS ref, l_returnflag || l_partkey || '.md' AS name, '/x/' || l_partkey AS path, CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_returnflag = 'A' THEN 1 END AS rank FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY ref ORDER BY rank, name, path) AS n FROM f WHERE rank IS NOT NULL)
    SELECT ref, path, CAST(rank AS INTEGER) AS rank FROM r WHERE n = 1""")
def q122_preferred_file(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ref"), F.concat("l_returnflag", F.col("l_partkey").cast("string"), F.lit(".md")).alias("name"), F.concat(F.lit("/x/"), F.col("l_partkey").cast("string")).alias("path"))
    return scans.preferred_file(files, ["ref"], [F.col("name").startswith("R"), F.col("name").startswith("A")])


@query("""
    WITH s AS (SELECT o_custkey % 300 AS batch_id, o_orderkey AS modified, 'p' || l_partkey AS ref, CASE WHEN l_linestatus = 'F' THEN 'done' ELSE 'running' END AS state FROM orders JOIN lineitem ON o_orderkey = l_orderkey), r AS (SELECT *, row_number() OVER (PARTITION BY ref ORDER BY modified DESC, batch_id DESC, state DESC) AS n FROM s)
    SELECT ref, batch_id FROM r WHERE n = 1 AND state = 'done' AND batch_id % 4 <> 0""")
def q123_batch_context(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    result = F.struct(F.concat(F.lit("p"), F.col("l_partkey").cast("string"), F.lit(".pdf")).alias("file_name"), F.when(F.col("l_linestatus") == "F", "done").otherwise("running").alias("state"))
    statuses = rows.groupBy((F.col("o_custkey") % 300).alias("batch_id"), F.col("o_orderkey").alias("modified")).agg(F.collect_list(result).alias("results"))
    manifests = statuses.where("batch_id % 4 <> 0").select("batch_id")
    return scans.batch_context(statuses, manifests)


@query("""
    WITH w AS (SELECT o_orderkey AS ref, unnest([1, 2]) AS stage FROM orders), s AS (SELECT ref, stage, '{"s":' || ref || '}' AS payload FROM w WHERE (ref + stage) % 3 = 0), f AS (SELECT ref, stage FROM w WHERE (ref + stage) % 3 = 1)
    SELECT w.ref, w.stage, CASE WHEN s.ref IS NOT NULL THEN 'success' WHEN f.ref IS NOT NULL THEN CASE WHEN w.ref % 2 = 0 THEN 'recovered' ELSE 'failed' END ELSE 'missing' END AS state, coalesce(payload, CASE WHEN f.ref IS NOT NULL AND w.ref % 2 = 0 THEN '{"r":' || w.ref || '}' END) AS payload, f.ref IS NOT NULL AS open
    FROM w LEFT JOIN s USING (ref, stage) LEFT JOIN f USING (ref, stage)""")
def q124_stage_sources(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "orders").select(F.col("o_orderkey").alias("ref"), F.explode(F.array(F.lit(1), F.lit(2))).alias("stage"))
    text = F.col("ref").cast("string")
    successes = wanted.where("(ref + stage) % 3 = 0").withColumn("payload", F.concat(F.lit('{"s":'), text, F.lit("}")))
    raw = F.when(F.col("ref") % 2 == 0, F.concat(F.lit('Sure:\n```json\n{"r":'), text, F.lit("}\n```"))).otherwise(F.concat(F.lit('{"r":'), text))
    failures = wanted.where("(ref + stage) % 3 = 1").withColumn("raw", raw)
    left = scans.open_failures(failures, successes).select("ref", "stage", F.lit(True).alias("open"))
    return scans.stage_sources(wanted, successes, failures).join(left, ["ref", "stage"], "left").withColumn("open", F.coalesce("open", F.lit(False)))


@query("""
    WITH a AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_quantity > 30), b AS (SELECT DISTINCT s_suppkey AS k FROM supplier WHERE s_nationkey < 20), p AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 2 = 0), w AS (SELECT o_orderkey AS k, o_orderpriority AS v FROM orders WHERE o_orderkey % 3 = 0), q AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 5 < 3)
    SELECT 'paired' AS kind, CAST(count(*) AS VARCHAR) AS value, 0 AS n FROM a JOIN b USING (k) UNION ALL SELECT 'right', CAST(k AS VARCHAR), 0 FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT 'left', CAST(k AS VARCHAR), 0 FROM b WHERE k NOT IN (SELECT k FROM a)
    UNION ALL SELECT 'file', v, count(*) FROM p WHERE k IN (SELECT k FROM q) GROUP BY v UNION ALL SELECT 'workbook', v, count(*) FROM w WHERE k IN (SELECT k FROM q) AND k NOT IN (SELECT k FROM p) GROUP BY v UNION ALL SELECT 'lacking', '', count(*) FROM q WHERE k NOT IN (SELECT k FROM p) AND k NOT IN (SELECT k FROM w)""")
def q125_pairs_and_fallbacks(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "lineitem").where("l_quantity > 30").select(F.col("l_suppkey").alias("k")).distinct()
    b = table(spark, d, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").alias("k"))
    both, lost = scans.paired(a, b, ["k"])
    orders, zero = table(spark, d, "orders"), F.lit(0).cast("long")
    found, lacking = scans.with_fallback(
        orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v")), orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("v")), "k", orders.where("o_orderkey % 5 < 3").select(F.col("o_orderkey").alias("k"))
    )
    rows = both.agg(F.count("*").cast("string").alias("value")).select(F.lit("paired").alias("kind"), "value", zero.alias("n")).union(lost.select("missing", F.col("k").cast("string"), zero))
    return rows.union(found.groupBy("lineage", "v").agg(F.count("*"))).union(lacking.agg(F.count("*").alias("n")).select(F.lit("lacking"), F.lit(""), "n"))


@query("""
    SELECT p_partkey, '{"p_brand":' || CASE WHEN p_size % 2 = 0 THEN 'null' ELSE '"' || p_brand || '"' END || CASE WHEN p_size % 3 = 0 THEN '' ELSE ',"p_type":"' || p_type || '"' END || '}' AS payload FROM part""")
def q126_payload_shape(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 2 != 0, F.col("p_brand")).alias("p_brand"), F.when(F.col("p_size") % 3 != 0, F.col("p_type")).alias("p_type"))
    return rows.select("p_partkey", sinks.payload(["p_brand"], ["p_type"]).alias("payload"))


@query("""
    WITH v AS (SELECT o_orderkey AS document_id, CASE WHEN o_orderstatus = 'F' THEN 'passed' ELSE 'failed' END AS status, o_orderkey % 2 = 0 AS degraded FROM orders)
    SELECT 'written' AS kind, document_id, CASE WHEN degraded THEN 'late' ELSE '' END AS codes FROM v WHERE status = 'passed' UNION ALL SELECT 'withdrawn', document_id, '' FROM v WHERE status <> 'passed'""")
def q127_publication(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("document_id"), "o_orderstatus")
    verdicts = orders.select("document_id", F.when(F.col("o_orderstatus") == "F", "passed").otherwise("failed").alias("status"), F.when(F.col("document_id") % 2 == 0, F.array(F.lit("late"))).alias("degraded_codes"))
    out, gone = sinks.published(orders, verdicts, preview=True)
    return out.select(F.lit("written").alias("kind"), "document_id", F.array_join("degraded_codes", ",").alias("codes")).union(gone.select(F.lit("withdrawn"), "document_id", F.lit("")))


@query("""
    WITH b AS (SELECT p_partkey AS k, p_name AS v FROM part WHERE p_partkey % 10 <> 0), r AS (SELECT p_partkey AS k, p_type AS v FROM part WHERE p_partkey % 4 = 0), l AS (SELECT k, v, 'recovered' AS layer FROM r UNION ALL SELECT k, v, 'base' FROM b WHERE k NOT IN (SELECT k FROM r))
    SELECT coalesce(l.k, b.k) AS k, layer, sha256(b.v) AS before_hash, sha256(l.v) AS after_hash, CASE WHEN b.k IS NULL THEN 'added' WHEN l.k IS NULL THEN 'removed' WHEN b.v = l.v THEN 'same' ELSE 'changed' END AS change FROM l FULL JOIN b ON l.k = b.k""")
def q128_layers_and_changes(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part")
    base = parts.where("p_partkey % 10 <> 0").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("v"))
    recovered = parts.where("p_partkey % 4 = 0").select(F.col("p_partkey").alias("k"), F.col("p_type").alias("v"))
    top = sinks.layered(base, recovered, "k")
    return sinks.change_manifest(base, top, "k", "v").join(top.select("k", "layer"), "k", "left")


@query(r"""
    SELECT page_id, replace(replace(replace(url, chr(38), chr(92) || 'u0026'), '<', chr(92) || 'u003c'), '>', chr(92) || 'u003e') AS escaped, 'img/' || page_id || '/' || regexp_extract(url, '[^/]+$') AS moved FROM pages""")
def q129_escapes_and_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", sinks.embedded(F.col("url")).alias("escaped"), sinks.moved_path(F.col("url"), F.lit("img"), F.col("page_id").cast("string")).alias("moved"))


@query("""
    WITH t AS (SELECT event_id AS task_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE ts END AS created_at FROM events), l AS (SELECT n, CASE WHEN n < 26 THEN chr(CAST(65 + n AS INTEGER)) ELSE chr(CAST(64 + n // 26 AS INTEGER)) || chr(CAST(65 + n % 26 AS INTEGER)) END AS letters FROM (SELECT p_partkey % 700 AS n FROM part))
    SELECT 'task' AS kind, CAST(task_id AS VARCHAR) AS value FROM (SELECT * FROM t WHERE created_at IS NOT NULL ORDER BY created_at DESC, task_id LIMIT 100) UNION ALL SELECT letters, CAST(n AS VARCHAR) FROM l""")
def q130_tasks_and_columns(spark: SparkSession, d: str) -> DataFrame:
    tasks = table(spark, d, "events").select(F.col("event_id").alias("task_id"), F.when(F.col("event_id") % 9 != 0, F.col("ts")).alias("created_at"))
    letter = lambda c: F.char(c + 65)
    n = F.col("p_partkey") % 700
    letters = F.when(n < 26, letter(n)).otherwise(F.concat(letter(F.floor(n / 26) - 1), letter(n % 26)))
    columns = table(spark, d, "part").select(letters.alias("kind"), scans.column_number(letters).cast("string").alias("value"))
    return scans.task_list(tasks, 5000).select(F.lit("task").alias("kind"), F.col("task_id").cast("string").alias("value")).union(columns)
