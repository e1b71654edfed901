"""The registered queries of the engine: each operator family over the driver's tables, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataquery.functions import numeric, text
from strataquery.operators import align, evidence, graph, grid, ordered, refs, runlog
from strataquery.plans.register import ORACLE_SQL, QUERIES, query
from strataquery.sources.documents import table
from strataquery.sources.shared import cut, shared_folder
from strataquery.streaming.ingest import event_stream, run_available

def total(column: str) -> Column:
    """An exact sum of money or quantities, whatever the order of addition."""
    return F.sum(F.col(column).cast("decimal(20,4)")).cast("double")


@query("""
    WITH i AS (SELECT o_orderstatus, o_custkey IN (SELECT c_custkey FROM customer) AS cust,
                      o_orderkey IN (SELECT l_orderkey FROM lineitem) AS line, o_totalprice > 100000 AS priced FROM orders)
    SELECT o_orderstatus, count(*) AS total, count(*) FILTER (cust) AS customer_bound, count(*) FILTER (line) AS line_bound, count(*) FILTER (priced) AS priced,
           round(count(*) FILTER (cust) / count(*), 4) AS customer_bound_rate, round(count(*) FILTER (line) / count(*), 4) AS line_bound_rate, round(count(*) FILTER (priced) / count(*), 4) AS priced_rate
    FROM i GROUP BY o_orderstatus""")
def q01_binding_completeness(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("cust"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("line", F.lit(True))
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").join(customers, "o_custkey", "left").join(lines, "o_orderkey", "left")
    return refs.binding_rates(rows, ["o_orderstatus"], {"customer_bound": F.col("cust").isNotNull(), "line_bound": F.col("line").isNotNull(), "priced": F.col("o_totalprice") > 100000})


@query("""
    WITH per AS (SELECT p_brand, count(*) FILTER (l_returnflag = 'R') AS covered, count(*) FILTER (l_quantity > 49) AS expected FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
    SELECT p_brand, covered, expected,
        CASE WHEN expected > 0 THEN round(covered / expected, 6) END AS audit, CASE WHEN expected > 0 THEN round(covered / expected, 4) ELSE 0.0 END AS rate,
        CASE WHEN expected > 0 THEN covered / expected ELSE 1.0 END AS complete, CASE WHEN expected > 0 THEN covered / expected END AS safe FROM per
    UNION ALL SELECT 'all', CAST(sum(covered) AS BIGINT), CAST(sum(expected) AS BIGINT), CASE WHEN sum(expected) > 0 THEN round(sum(covered) / sum(expected), 6) END,
        CASE WHEN sum(expected) > 0 THEN round(sum(covered) / sum(expected), 4) ELSE 0.0 END, CASE WHEN sum(expected) > 0 THEN sum(covered) / sum(expected) ELSE 1.0 END, CASE WHEN sum(expected) > 0 THEN sum(covered) / sum(expected) END FROM per""")
def q02_micro_macro_ratio(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    per = rows.groupBy("p_brand").agg(F.count_if(F.col("l_returnflag") == "R").alias("covered"), F.count_if(F.col("l_quantity") > 49).alias("expected"))
    both = per.union(per.agg(F.sum("covered"), F.sum("expected")).select(F.lit("all"), "*"))
    return both.select("*", *[numeric.ratio(F.col("covered"), F.col("expected"), rule).alias(rule) for rule in numeric.RATIO_RULES])


@query("""
    SELECT 'part_without_line' AS kind, p_partkey AS key FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)
    UNION ALL SELECT 'line_without_part', l_partkey FROM (SELECT DISTINCT l_partkey FROM lineitem) WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'order_without_line', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'line_without_order', l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'supplier_without_line', s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem)""")
def q03_dangling_refs(spark: SparkSession, d: str) -> DataFrame:
    lines, parts, orders, suppliers = (table(spark, d, t) for t in ("lineitem", "part", "orders", "supplier"))
    found = [
        ("part_without_line", refs.dangling(parts, "p_partkey", lines, "l_partkey")), ("line_without_part", refs.dangling(lines, "l_partkey", parts, "p_partkey")),
        ("order_without_line", refs.dangling(orders, "o_orderkey", lines, "l_orderkey")), ("line_without_order", refs.dangling(lines, "l_orderkey", orders, "o_orderkey")),
        ("supplier_without_line", refs.dangling(suppliers, "s_suppkey", lines, "l_suppkey")),
    ]
    out = [df.select(F.lit(kind).alias("kind"), "key") for kind, df in found]
    return out[0].union(out[1]).union(out[2]).union(out[3]).union(out[4])


@query("""
    WITH t AS (SELECT p_brand || '/' || p_size AS label, count(DISTINCT p_partkey) AS n, min(p_partkey) AS id FROM part GROUP BY 1),
         l AS (SELECT DISTINCT 'Brand#' || CAST(l_suppkey % 60 AS VARCHAR) || '/' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS label FROM lineitem)
    SELECT l.label, CASE WHEN n = 1 THEN id END AS bound_id, CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status FROM l LEFT JOIN t ON l.label = t.label""")
def q04_unique_label_binding(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("name"))
    labels = table(spark, d, "lineitem").select(F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 60).cast("string"), F.lit("/"), F.col("l_quantity").cast("int").cast("string")).alias("name"))
    return refs.unique_binding(labels, "name", parts, "name", "p_partkey")


@query("""
    WITH k AS (SELECT sha256(text) AS key, min(doc_id) AS first FROM documents GROUP BY 1)
    SELECT key, first, 'ev' || printf('%07d', row_number() OVER (ORDER BY first, key)) AS ref_id FROM k""")
def q05_first_seen_ids(spark: SparkSession, d: str) -> DataFrame:
    return refs.first_seen_ids(table(spark, d, "documents"), F.sha2("text", 256), "doc_id", "ev", 7)


@query("SELECT user_id, event_type, min(event_id) AS first_order, count(*) AS times FROM events GROUP BY user_id, event_type")
def q06_issue_dedup(spark: SparkSession, d: str) -> DataFrame:
    return refs.dedup_issues(table(spark, d, "events"), ["user_id", "event_type"], "event_id")


@query("""
    WITH l AS (SELECT l_orderkey, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY 1)
    SELECT o_orderkey, low, high, (o_totalprice * 0.2 <= high + greatest(1e-6, 0.01 * abs(o_totalprice * 0.2), 0.01 * abs(low)) AND low <= o_totalprice * 0.4 + greatest(1e-6, 0.01 * abs(o_totalprice * 0.2), 0.01 * abs(low))) AS fits
    FROM orders JOIN l ON o_orderkey = l_orderkey""")
def q07_interval_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    spans = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))
    rows = table(spark, d, "orders").join(spans, F.col("o_orderkey") == F.col("l_orderkey"))
    fits = numeric.intervals_match(F.col("o_totalprice") * 0.2, F.col("o_totalprice") * 0.4, F.col("low"), F.col("high"))
    return rows.select("o_orderkey", "low", "high", fits.alias("fits"))


@query("""
    WITH p AS (SELECT lang, quality, CAST(n_chars > 1500 AS INTEGER) AS guess FROM documents JOIN labels USING (doc_id)),
         c AS (SELECT lang, count(*) FILTER (quality = 1 AND guess = 1) AS tp, count(*) FILTER (quality <> 1 AND guess = 1) AS fp, count(*) FILTER (quality = 1 AND guess <> 1) AS fn, count(*) FILTER (guess IS NULL) AS abstained FROM p GROUP BY lang)
    SELECT *, coalesce(round(tp / nullif(tp + fp, 0), 4), 0.0) AS precision, coalesce(round(tp / nullif(tp + fn, 0), 4), 0.0) AS recall, coalesce(round(2 * tp / nullif(2 * tp + fp + fn, 0), 4), 0.0) AS f1 FROM c""")
def q08_precision_recall_f1(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").withColumn("guess", (F.col("n_chars") > 1500).cast("int"))
    return align.evaluate_labels(rows, "quality", "guess", "lang")


@query("""
    WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(20,4))) AS DOUBLE) AS total FROM orders GROUP BY 1)
    SELECT month, total, round(total - lag(total) OVER (ORDER BY month), 2) AS delta FROM m""")
def q09_lag_delta(spark: SparkSession, d: str) -> DataFrame:
    months = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(total("o_totalprice").alias("total"))
    return months.withColumn("delta", F.round(F.col("total") - F.lag("total").over(Window.orderBy("month")), 2))


@query("""
    SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM conversations""")
def q10_section_carry(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", "role", ordered.carried(F.when(F.col("role") == "user", F.col("turn")), ["conv_id"], ["turn"]).alias("section"))


@query("""
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM events""")
def q11_fill_up(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", ordered.carried(F.when(F.col("event_type") == "purchase", F.col("event_id")), ["user_id"], ["event_id"]).alias("filled"))


@query("""
    WITH g AS (SELECT user_id, event_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
         i AS (SELECT *, CAST(sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS island FROM g)
    SELECT user_id, island, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM i GROUP BY user_id, island""")
def q12_gaps_islands(spark: SparkSession, d: str) -> DataFrame:
    before = F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    rows = table(spark, d, "events").select("user_id", "event_id", "ts").withColumn("starts", before.isNull() | (F.col("ts") > before + F.expr("INTERVAL 6 HOURS")))
    runs = ordered.islands(rows, F.col("starts"), ["user_id"], ["ts", "event_id"])
    return runs.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("""
    WITH m AS (SELECT o_custkey, o_orderkey, CAST(o_orderstatus <> 'F' AS INTEGER) AS gone FROM orders),
         n AS (SELECT *, sum(gone) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nth FROM m)
    SELECT o_custkey, o_orderkey, CASE WHEN gone = 0 THEN 'complete' WHEN nth = 1 THEN 'running' ELSE 'pending' END AS status FROM n""")
def q13_running_first_missing(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return ordered.first_missing(rows, F.col("o_orderstatus") != "F", ["o_custkey"], ["o_orderkey"]).drop("o_orderstatus")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC LIMIT 25")
def q14_topk_latest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(F.desc("o_orderdate"), F.desc("o_totalprice"), F.desc("o_orderkey")).limit(25)


@query("""
    SELECT l_orderkey, l_linenumber AS best_line FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_extendedprice DESC, l_linenumber, l_partkey DESC, l_suppkey DESC) AS r FROM lineitem) WHERE r = 1""")
def q15_max_by_tiebreak(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").withColumn("best_line", F.col("l_linenumber"))
    return ordered.best_of(lines, ["l_orderkey"], [F.col("l_quantity"), F.col("l_extendedprice"), -F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")], "best_line")


@query("""
    SELECT doc_id, regexp_replace(lower(text), '[^0-9a-z]+', '', 'g') AS key, trim(regexp_replace(lower(text), '[^0-9a-z]+', ' ', 'g')) AS name FROM documents""")
def q16_text_normalise(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents")
    return rows.select("doc_id", F.regexp_replace(F.lower("text"), "[^0-9a-z]+", "").alias("key"), text.canonical_name(F.col("text")).alias("name"))


@query(r"""
    SELECT page_id, length(t) AS n_chars, md5(t) AS digest FROM (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM pages)""")
def q17_html_strip(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pages").select("page_id", text.strip_tags(F.col("html")).alias("t"))
    return rows.select("page_id", F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("digest"))


@query("""
    WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents),
         e AS (SELECT doc_id, unnest(w) AS word FROM d), f AS (SELECT word, count(*) AS times, count(DISTINCT doc_id) AS docs FROM e GROUP BY word),
         b AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM benchmark), c AS (SELECT item_id, word, count(*) AS n FROM b GROUP BY 1, 2)
    SELECT item_id, CAST(sum(n) AS BIGINT) AS words, CAST(sum(least(n, coalesce(times, 0))) AS BIGINT) AS covered, round(sum(least(n, coalesce(times, 0))) / sum(n), 6) AS coverage FROM c LEFT JOIN f USING (word) GROUP BY item_id""")
def q18_token_multiset_coverage(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select(F.explode(text.tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("times"))
    asked = table(spark, d, "benchmark").select("item_id", F.explode(text.tokens(F.col("text"))).alias("word")).groupBy("item_id", "word").agg(F.count("*").alias("n"))
    hits = F.sum(F.least("n", F.coalesce("times", F.lit(0))))
    return asked.join(words, "word", "left").groupBy("item_id").agg(F.sum("n").alias("words"), hits.alias("covered"), F.round(hits / F.sum("n"), 6).alias("coverage"))


@query(r"""
    WITH n AS (SELECT item_id AS sentence_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(text, '([0-9])\s*\.\s*([0-9])', '\1.\2', 'g'), '\s*([/(),;:])\s*', '\1', 'g'), '\s+', ' ', 'g'))) AS s FROM benchmark),
         b AS (SELECT doc_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(text, '([0-9])\s*\.\s*([0-9])', '\1.\2', 'g'), '\s*([/(),;:])\s*', '\1', 'g'), '\s+', ' ', 'g'))) AS b FROM documents),
         m AS (SELECT sentence_id, count(doc_id) AS matches, min(doc_id) AS first FROM n LEFT JOIN b ON contains(b, s) GROUP BY sentence_id)
    SELECT sentence_id, matches, CASE WHEN matches = 1 THEN first END AS block_id, CASE WHEN matches = 1 THEN 'recovered' WHEN matches > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status FROM m""")
def q19_unique_block_recovery(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("sentence_id"), F.col("text").alias("sentence"))
    return evidence.recover_block(asked, table(spark, d, "documents").select(F.col("doc_id").alias("block_id"), "text"))


@query(r"""
    WITH t AS (SELECT doc_id, unnest(string_split(text, ' ')) AS tok FROM documents)
    SELECT doc_id, count(*) FILTER (regexp_matches(tok, '[0-9]')) AS with_number, count(*) FILTER (regexp_matches(trim(tok), '^[A-Za-z]{1,8}[-_]?[0-9]+(?:[-_][0-9]+)*$')) AS identifiers FROM t GROUP BY doc_id""")
def q20_numeric_predicates(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("tok"))
    return words.groupBy("doc_id").agg(F.count_if(text.has_number(F.col("tok"))).alias("with_number"), F.count_if(text.looks_like_identifier(F.col("tok"))).alias("identifiers"))


#: Shapes of personal data and secrets that the scan counts.
SENSITIVE = (r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+", r"[0-9a-f]{32,}", r"(?i)(?:password|secret|token|api_?key)[\x22']?\s*[:=]")


@query(r"""
    SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+')) + len(regexp_extract_all(text, '[0-9a-f]{32,}')) + len(regexp_extract_all(text, '(?i)(?:password|secret|token|api_?key)[\x22'']?\s*[:=]')) AS INTEGER) AS hits FROM documents""")
def q21_sensitive_scan(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", evidence.sensitive_spans(F.col("text"), SENSITIVE).alias("hits"))


@query("""
    SELECT c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'missing' WHEN c_acctbal / 10000 >= 0.8 THEN 'high' WHEN c_acctbal / 10000 >= 0.5 THEN 'medium' ELSE 'low' END AS band, count(*) AS n FROM customer GROUP BY 1, 2""")
def q22_confidence_bands(spark: SparkSession, d: str) -> DataFrame:
    score = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 10000)
    return table(spark, d, "customer").groupBy("c_mktsegment", numeric.confidence_band(score).alias("band")).agg(F.count("*").alias("n"))


@query("""
    SELECT l_returnflag, count(*) AS calls, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS tokens, round(CAST(sum(CASE WHEN l_tax > 0 THEN CAST(l_quantity AS DECIMAL(12,0)) * 17 END) AS DOUBLE) / 1000000, 10) AS cost,
        count(*) FILTER (NOT coalesce(l_tax > 0, false)) AS unpriced, CASE WHEN count(*) FILTER (NOT coalesce(l_tax > 0, false)) > 0 THEN 'partial' ELSE 'complete' END AS status FROM lineitem GROUP BY l_returnflag""")
def q23_decimal_cost(spark: SparkSession, d: str) -> DataFrame:
    calls = table(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").cast("long").alias("tokens"), F.when(F.col("l_tax") > 0, numeric.token_cost(F.col("l_quantity"), F.lit(17))).alias("cost"))
    return runlog.cost_summary(calls, "l_returnflag").withColumn("cost", F.round(F.col("cost").cast("double"), 10))


HEADERS = ["Tg (K)", "Mn / kDa", "Yield, wt%", "Strain [%]", "Sample", "E' (GPa)"]


@query(r"""
    WITH h(header) AS (VALUES ('Tg (K)'), ('Mn / kDa'), ('Yield, wt%'), ('Strain [%]'), ('Sample'), ('E'' (GPa)')),
         u AS (SELECT header, regexp_extract(header, '[(\[]([^()\[\]]+)[)\]]\s*$', 1) AS b, trim(regexp_extract(header, '(?:\s/\s*|,\s*)([^/,]+)$', 1)) AS t FROM h)
    SELECT header, CASE WHEN b <> '' THEN trim(b) WHEN t <> '' THEN t END AS unit FROM u""")
def q24_unit_inference(spark: SparkSession, d: str) -> DataFrame:
    headers = spark.createDataFrame([(h,) for h in HEADERS], "header string")
    return headers.select("header", numeric.unit_of_header(F.col("header")).alias("unit"))


@query("""
    SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1, 2""")
def q25_json_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.get_json_object("props", "$.k").try_cast("int").alias("k")).agg(F.count("*").alias("n"))


@query("SELECT sha256(lang || chr(31) || source || chr(31) || text) AS digest, count(*) AS copies, min(doc_id) AS first_doc FROM documents GROUP BY 1")
def q26_canonical_hash(spark: SparkSession, d: str) -> DataFrame:
    digest = F.sha2(F.concat_ws("\x1f", "lang", "source", "text"), 256)
    return table(spark, d, "documents").groupBy(digest.alias("digest")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"))


@query("""
    WITH e AS (SELECT DISTINCT 'nation:' || n_nationkey AS a, 'region:' || n_regionkey AS b, 'in_region' AS kind FROM nation
               UNION ALL SELECT DISTINCT 'customer:' || c_custkey, 'nation:' || c_nationkey, 'in_nation' FROM customer UNION ALL SELECT DISTINCT 'customer:' || c_custkey, 'order:' || o_orderkey, 'placed' FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT kind, count(*) AS edges, count(DISTINCT a) AS sources, count(DISTINCT b) AS targets FROM e GROUP BY kind
    UNION ALL SELECT 'nodes', (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders), 0, 0""")
def q27_graph_nodes_edges(spark: SparkSession, d: str) -> DataFrame:
    region, nation, customer, orders = (table(spark, d, t) for t in ("region", "nation", "customer", "orders"))
    made = graph.edges([
        ("in_region", nation, "nation", "n_nationkey", "region", "n_regionkey"), ("in_nation", customer, "customer", "c_custkey", "nation", "c_nationkey"),
        ("placed", orders.join(customer, F.col("o_custkey") == F.col("c_custkey")), "customer", "c_custkey", "order", "o_orderkey"),
    ])
    stats = made.groupBy("kind").agg(F.count("*").alias("edges"), F.count_distinct("a").alias("sources"), F.count_distinct("b").alias("targets"))
    all_nodes = graph.nodes([("region", region, "r_regionkey", "r_name"), ("nation", nation, "n_nationkey", "n_name"), ("customer", customer, "c_custkey", "c_name"), ("order", orders, "o_orderkey", "o_orderstatus")])
    zero = F.lit(0).cast("long")
    return stats.union(all_nodes.agg(F.count("*").alias("edges")).select(F.lit("nodes"), "edges", zero, zero))


@query("""
    SELECT o_custkey, s_nationkey, count(DISTINCT l_suppkey) AS members FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""")
def q28_projected_edges(spark: SparkSession, d: str) -> DataFrame:
    steps = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    return graph.projected_edges(steps.join(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")), "o_custkey", "l_suppkey", "s_nationkey")


@query("""
    WITH RECURSIVE e AS (SELECT DISTINCT s_suppkey AS a, (s_suppkey * 7 + 3) % 31 AS b FROM supplier),
        r(start, node, path) AS (SELECT a, b, [b] FROM e UNION ALL SELECT start, e.b, list_append(path, e.b) FROM r JOIN e ON r.node = e.a WHERE node <> start AND NOT list_contains(path, e.b)),
        c AS (SELECT DISTINCT start AS node FROM r WHERE node = start)
    SELECT DISTINCT start AS node FROM r WHERE node IN (SELECT node FROM c) UNION SELECT node FROM c""")
def q29_cycle_check(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "supplier").select(F.col("s_suppkey").alias("a"), ((F.col("s_suppkey") * 7 + 3) % 31).alias("b"))
    return graph.cyclic_nodes(links)


def _salvage(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    tables = {t: table(spark, d, t) for t in ("region", "nation", "supplier", "lineitem")}
    bad = spark.createDataFrame([(2,)], "key int")
    links = [("nation", "n_regionkey", "region", "r_regionkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey")]
    return tables, refs.cascade(tables, links, {"region": bad})


@query("""
    SELECT s_suppkey, count(*) AS kept_lines FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 2 GROUP BY s_suppkey""")
def q30_fixpoint_salvage(spark: SparkSession, d: str) -> DataFrame:
    _, kept = _salvage(spark, d)
    return kept["lineitem"].groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("kept_lines"))


@query("""
    WITH r AS (SELECT r_regionkey FROM region WHERE r_regionkey <> 2), n AS (SELECT * FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM r)), s AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)), l AS (SELECT * FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM s)),
         c(object_type, input, published) AS (SELECT 'region', (SELECT count(*) FROM region), (SELECT count(*) FROM r) UNION ALL SELECT 'nation', (SELECT count(*) FROM nation), (SELECT count(*) FROM n) UNION ALL SELECT 'supplier', (SELECT count(*) FROM supplier), (SELECT count(*) FROM s) UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM l))
    SELECT *, input - published AS rejected FROM c""")
def q31_conservation(spark: SparkSession, d: str) -> DataFrame:
    return refs.conservation(*_salvage(spark, d))


@query("""
    SELECT p.p_partkey AS node, b.p_brand AS value FROM part p LEFT JOIN part b ON b.p_partkey = p.p_partkey - ((p.p_partkey - 1) % 16 + 16) % 16""")
def q32_type_inheritance(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("node"), F.when(F.col("p_partkey") % 16 == 1, F.col("p_brand")).alias("value"))
    steps = table(spark, d, "part").select(F.col("p_partkey").alias("a"), (F.col("p_partkey") + 1).alias("b"))
    return graph.inherit(parts, steps)


@query("""
    WITH l AS (SELECT user_id AS attempt_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events GROUP BY 1)
    SELECT attempt_id, CASE WHEN event_type <> 'purchase' AND ts < (SELECT max(ts) FROM events) - INTERVAL 10 DAY THEN 'interrupted_uncertain' WHEN event_type = 'purchase' THEN 'done' ELSE 'running' END AS status FROM l""")
def q33_stale_leases(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    end = events.agg(F.max("ts").alias("now"))
    log = events.select(F.col("user_id").alias("attempt_id"), F.struct("ts", "event_id").alias("at"), F.when(F.col("event_type") == "purchase", "done").otherwise("running").alias("status"), (F.col("ts") + F.expr("INTERVAL 10 DAYS")).alias("lease_until"))
    return runlog.attempt_states(log.crossJoin(F.broadcast(end)), F.col("now")).select("attempt_id", "status")


@query("""
    SELECT o_orderpriority, count(*) AS documents, count(*) FILTER (o_orderstatus <> 'F') AS blocking, count(*) > 0 AND count(*) FILTER (o_orderstatus <> 'F') = 0 AS accepted FROM orders GROUP BY o_orderpriority""")
def q34_acceptance(spark: SparkSession, d: str) -> DataFrame:
    return runlog.acceptance(table(spark, d, "orders").select("o_orderpriority", F.col("o_orderstatus").alias("status")), "F", "o_orderpriority")


@query("""
    WITH l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), o AS (SELECT o_custkey, count(*) AS orders, CAST(sum(coalesce(n, 0)) AS BIGINT) AS lines, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS order_ids FROM orders LEFT JOIN l ON o_orderkey = l_orderkey GROUP BY 1)
    SELECT c_custkey, coalesce(orders, 0) AS orders, coalesce(lines, 0) AS lines, coalesce(order_ids, '') AS order_ids FROM customer LEFT JOIN o ON c_custkey = o_custkey""")
def q35_nested_rebuild(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    orders = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_custkey", F.struct("o_orderkey", F.coalesce("n", F.lit(0)).alias("n")).alias("o"))
    nested = table(spark, d, "customer").join(orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o")).alias("children")), F.col("c_custkey") == F.col("o_custkey"), "left")
    children = F.coalesce("children", F.array().cast("array<struct<o_orderkey:bigint,n:bigint>>"))
    return nested.select("c_custkey", F.size(children).cast("long").alias("orders"), F.aggregate(children, F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("lines"), F.array_join(F.transform(children, lambda x: x["o_orderkey"].cast("string")), ",").alias("order_ids"))


@query("""
    WITH e AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
    SELECT CAST(vec_id AS VARCHAR) || ':' || CAST(i AS VARCHAR) AS id, vec_id, CAST(i AS INTEGER) AS place, x AS value FROM e WHERE x > 0.4""")
def q36_explode_flatten(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("place", "value")).where(F.col("value") > 0.4)
    return rows.select(F.concat_ws(":", F.col("vec_id").cast("string"), F.col("place").cast("string")).alias("id"), "vec_id", "place", "value")


@query("""
    WITH a AS (SELECT DISTINCT p_partkey AS key FROM part WHERE p_size < 30), b AS (SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_quantity > 45)
    SELECT 'only_left' AS side, key FROM (SELECT key FROM a EXCEPT SELECT key FROM b) UNION ALL SELECT 'only_right', key FROM (SELECT key FROM b EXCEPT SELECT key FROM a)""")
def q37_symmetric_difference(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "part").where("p_size < 30").select(F.col("p_partkey").alias("key"))
    b = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("key"))
    return a.subtract(b).select(F.lit("only_left").alias("side"), "key").union(b.subtract(a).select(F.lit("only_right"), "key"))


@query("""
    WITH t AS (SELECT source, doc_id, CASE WHEN lang = 'de' AND n_chars > 4000 THEN 1 WHEN lang = 'de' THEN 2 ELSE 3 END AS tier FROM documents), m AS (SELECT source, min(tier) AS tier FROM t GROUP BY source)
    SELECT source, tier, count(*) AS n FROM t JOIN m USING (source, tier) GROUP BY source, tier""")
def q38_tiered_fallback(spark: SparkSession, d: str) -> DataFrame:
    tier = F.when((F.col("lang") == "de") & (F.col("n_chars") > 4000), 1).when(F.col("lang") == "de", 2).otherwise(3)
    rows = table(spark, d, "documents").select("source", tier.alias("tier")).groupBy("source", "tier").agg(F.count("*").alias("n"))
    return rows.groupBy("source").agg(F.min(F.struct("tier", "n")).alias("best")).select("source", "best.tier", "best.n")


@query("""
    WITH RECURSIVE t AS (SELECT conv_id, turn, length(text) + 160 AS cost, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations),
        f AS (SELECT conv_id, turn, r, cost AS used, 0 AS chunk FROM t WHERE r = 1 UNION ALL
              SELECT t.conv_id, t.turn, t.r, CASE WHEN f.used + t.cost > 2000 THEN t.cost ELSE f.used + t.cost END, f.chunk + CASE WHEN f.used + t.cost > 2000 THEN 1 ELSE 0 END FROM f JOIN t ON t.conv_id = f.conv_id AND t.r = f.r + 1)
    SELECT conv_id, turn, CAST(chunk AS INTEGER) AS chunk FROM f""")
def q39_chunk_budget(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    return ordered.chunk_by_budget(rows, "conv_id", "turn", "n", 2000).select("conv_id", "turn", "chunk")


PROPERTIES = {"glass_transition": r"\btg\b", "melting_point": r"\btm\b|melting", "molar_mass": r"\bm[nw]\b", "yield": "yield"}


def _bodies(spark: SparkSession, d: str) -> DataFrame:
    """A table body for each order with lines: HTML with spans for even keys, Markdown for odd ones; a row for each line."""
    row = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    quantity = lambda x: x["l_quantity"].cast("int").cast("string")
    time = lambda x: F.when(x["l_returnflag"] == "N", "").otherwise(F.concat(x["l_linenumber"].cast("string"), F.lit(" h")))
    label = lambda x: F.concat(F.lit("PE-"), x["l_partkey"].cast("string"))
    html = F.array_join(F.transform("rows", lambda x: F.concat(F.lit("<tr><td>"), label(x), F.lit("</td><td>"), quantity(x), F.lit("<br> MPa</td><td>"), time(x), F.lit("</td></tr>"))), "")
    markdown = F.array_join(F.transform("rows", lambda x: F.concat(F.lit("\n| "), label(x), F.lit(" | "), quantity(x), F.lit(" MPa | "), time(x), F.lit(" |"))), "")
    head = F.lit("<table><tr><th rowspan=2>Sample</th><th colspan='2'>Thermal</th></tr><tr><th>Tg (MPa)</th><th>Time (h)</th></tr>")
    body = F.when(F.col("l_orderkey") % 2 == 0, F.concat(head, html, F.lit("</table>"))).otherwise(F.concat(F.lit("| Sample | Tg (MPa) | Time (h) |\n|---|:---:|---|"), markdown))
    return rows.select(F.col("l_orderkey").cast("string").alias("block_id"), body.alias("table_body"))


_CELLS = """
    WITH r AS (SELECT l_orderkey, l_partkey, l_quantity, l_returnflag, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag) - 1 + CASE WHEN l_orderkey % 2 = 0 THEN 2 ELSE 1 END AS y FROM lineitem),
         h AS (SELECT DISTINCT l_orderkey FROM lineitem),
         c AS (SELECT l_orderkey, y, unnest([0, 1, 2]) AS x, 1 AS row_span, 1 AS column_span, unnest(['PE-' || l_partkey, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' MPa', CASE WHEN l_returnflag = 'N' THEN '' ELSE l_linenumber || ' h' END]) AS text, false AS is_header FROM r
               UNION ALL SELECT l_orderkey, unnest([0, 0, 1, 1]), unnest([0, 1, 1, 2]), unnest([2, 1, 1, 1]), unnest([1, 2, 1, 1]), unnest(['Sample', 'Thermal', 'Tg (MPa)', 'Time (h)']), true FROM h WHERE l_orderkey % 2 = 0
               UNION ALL SELECT l_orderkey, 0, unnest([0, 1, 2]), 1, 1, unnest(['Sample', 'Tg (MPa)', 'Time (h)']), true FROM h WHERE l_orderkey % 2 = 1),
         cells AS (SELECT CAST(l_orderkey AS VARCHAR) AS block_id, l_orderkey || printf(':r%04d:c%04d', y, x) AS cell_id, y AS row_index, x AS column_index, row_span, column_span, text, is_header FROM c)"""


@query(_CELLS + " SELECT * FROM cells")
def q40_table_grid(spark: SparkSession, d: str) -> DataFrame:
    return grid.table_cells(_bodies(spark, d))


_AUDIT = _CELLS + """,
    n AS (SELECT block_id, cell_id, column_index, column_index = 1 AS wanted, (row_index + CAST(block_id AS BIGINT)) % 3 = 0 AS hit FROM cells WHERE NOT is_header AND regexp_matches(text, '[0-9]'))"""


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return grid.classify(grid.table_context(_bodies(spark, d)), PROPERTIES, r"\btime\b|temperature")


def _audited(spark: SparkSession, d: str) -> DataFrame:
    cells = cut(_classified(spark, d).select("block_id", "cell_id", "row_index", "role"))
    return grid.recall_audit(cells, cells.where((F.col("row_index") + F.col("block_id").cast("long")) % 3 == 0))


@query(_AUDIT + """
    SELECT block_id, count(*) AS numeric_cells, count(*) FILTER (hit) AS represented, count(*) FILTER (wanted) AS candidates, count(*) FILTER (wanted AND hit) AS covered, coalesce(string_agg(cell_id, ',' ORDER BY cell_id) FILTER (wanted AND NOT hit), '') AS missing,
        round(count(*) FILTER (hit) / count(*), 6) AS representation, round(count(*) FILTER (wanted AND hit) / count(*) FILTER (wanted), 6) AS coverage, round(count(*) FILTER (wanted AND hit) / count(*) FILTER (wanted), 6) < 0.8 AS needs_recovery FROM n GROUP BY block_id""")
def q41_recall_audit(spark: SparkSession, d: str) -> DataFrame:
    return _audited(spark, d).withColumn("missing", F.array_join("missing", ","))


@query(_AUDIT + """
    SELECT count(DISTINCT block_id) AS tables, count(*) AS numeric_cells, count(*) FILTER (hit) AS represented, count(*) FILTER (wanted) AS candidates, count(*) FILTER (wanted AND hit) AS covered, round(count(*) FILTER (hit) / count(*), 6) AS representation, round(count(*) FILTER (wanted AND hit) / count(*) FILTER (wanted), 6) AS coverage FROM n""")
def q41b_batch_audit(spark: SparkSession, d: str) -> DataFrame:
    return grid.batch_audit(_audited(spark, d))


@query(_AUDIT + """
    SELECT column_index, CASE WHEN column_index = 0 THEN 'identifier' WHEN column_index = 1 THEN 'property' ELSE 'condition' END AS role, CASE WHEN column_index = 1 THEN 'glass_transition' END AS property, count(*) AS n FROM n GROUP BY 1""")
def q41c_cell_roles(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d).groupBy("column_index", "role", "property").agg(F.count("*").alias("n"))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("group_id"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"), F.col("o_totalprice").alias("low"), F.col("o_totalprice").alias("high"), F.lit(None).cast("string").alias("unit"))
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    found = lines.select(F.col("o_custkey").alias("group_id"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"), F.col("o_orderstatus").alias("name"), (F.col("l_extendedprice") * 3).alias("low"), (F.col("l_extendedprice") * 4).alias("high"), F.lit(None).cast("string").alias("unit"))
    return align.align(orders, found)


@query()
def q42_greedy_alignment(spark: SparkSession, d: str) -> DataFrame:
    return align.measures(_pairs(spark, d), "name")


@query(r"""
    SELECT doc_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(l, '^[0-9ivx]+(?:\.[0-9]+)*[.)]?\s+', ''), '[\s:.;,]+$', ''), '\s+', ' ', 'g'))) AS heading
    FROM (SELECT doc_id, lower(trim(string_split(text, chr(10))[1])) AS l FROM documents)""")
def q43_surface_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.heading_key(F.split("text", "\n")[0]).alias("heading"))


@query(r"""
    WITH x AS (SELECT 's' AS side, item_id AS id, text FROM benchmark UNION ALL SELECT 'b', doc_id, text FROM documents),
         y AS (SELECT *, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[‐-―−]', '-', 'g'), '([0-9])\s*\.\s*([0-9])', '\1.\2', 'g'), '\s*([/(),;:])\s*', '\1', 'g'), '\s+', ' ', 'g'))) AS key FROM x),
         w AS (SELECT side, id, word, count(*) AS n FROM (SELECT side, id, unnest(regexp_extract_all(key, '[a-z0-9]+')) AS word FROM y) GROUP BY 1, 2, 3), t AS (SELECT id, sum(n) AS words FROM w WHERE side = 's' GROUP BY 1),
         h AS (SELECT s.id AS sentence_id, b.id AS block_id, sum(least(s.n, b.n)) AS hits FROM w s JOIN w b ON s.word = b.word AND s.side = 's' AND b.side = 'b' GROUP BY 1, 2),
         p AS (SELECT sentence_id, block_id, CASE WHEN contains(b.text, s.text) THEN 'strict' WHEN contains(b.key, s.key) THEN 'normalised' WHEN hits / words >= 0.98 THEN 'near' WHEN hits / words >= 0.9 THEN 'partial' END AS status
               FROM h JOIN t ON t.id = sentence_id JOIN y s ON s.side = 's' AND s.id = sentence_id JOIN y b ON b.side = 'b' AND b.id = block_id)
    SELECT * FROM p WHERE status IS NOT NULL""")
def q44_evidence_ladder(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("sentence_id"), F.col("text").alias("sentence"))
    return evidence.match_all(asked, table(spark, d, "documents").select(F.col("doc_id").alias("block_id"), "text"))


@query()
def q45_nfkc_unescape(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.sha2(text.unescape_nfkc(text.strip_tags(F.col("html"))), 256).alias("digest"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def q46_streaming_ingest(spark: SparkSession, d: str) -> DataFrame:
    out = f"{shared_folder(spark)}/events-{uuid.uuid4().hex}"
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    run_available(event_stream(spark, d, "events.parquet", schema, "ts").dropDuplicates(["event_id"]), f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("""
    SELECT p_partkey, 'PL-' || upper(lpad(printf('%x', list_reduce(list_prepend(2166136261::BIGINT, list_transform(string_split(lower(trim(p_brand)), ''), lambda c: ascii(c)::BIGINT)), lambda h, c: (xor(h, c) * 16777619) & 4294967295)), 8, '0')) AS display_id FROM part""")
def q47_display_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.display_id(F.col("p_brand")).alias("display_id"))


@query("""
    SELECT l_orderkey, CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 END) AS BIGINT) AS "O", CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 END) AS BIGINT) AS "F" FROM lineitem GROUP BY l_orderkey""")
def q48_series_pivot(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_orderkey").pivot("l_linestatus", ["O", "F"]).agg(F.count(F.lit(1)))


@query("""
    SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(20,4))) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4))) AS DOUBLE) AS sum_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY 1, 2""")
def q49_pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").where("l_shipdate <= TIMESTAMP_NTZ '1998-09-02 00:00:00'")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(total("l_quantity").alias("sum_qty"), total("l_extendedprice").alias("sum_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))
