"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import exact_top_k

    return exact_top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id % 20 = 0", k=20)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlfilter import dated_list, dated_pages, judge

    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return judge(dated_pages(pages), dated_list(pages)).select("page_id", "url", "fetched_on", "blocked", "action", "pattern", "category", "listed_on")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), n=3, percent=90).select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack, tokenize

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pack(tokenize(docs, public_tokenizers.path("byte_bpe_50k.json"))).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    mixed = mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import nearest

    return nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id % 50 = 0", k=5)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import held_out, predict, train

    model = train(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return predict(table(spark, sf_dir, "documents", "doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linededup import EXACT_DOCS, drop_recurring_lines

    kept = drop_recurring_lines(table(spark, sf_dir, "documents", "doc_id", "text"), exact_docs=EXACT_DOCS)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import secret_report

    return secret_report(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_source_mixing": op6_source_mixing,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_secret_scan": op10_secret_scan,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op3_url_filter": """
        WITH u AS (
            SELECT page_id, url, CASE WHEN page_id IS NOT NULL THEN DATE '2023-01-01' + CAST(((page_id * 37) % 730 + 730) % 730 AS INTEGER) END AS fetched_on,
                lower(regexp_extract(url, '^[\\x00-\\x20]*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\\[[^\\]/?#]*\\]|[^/?#:@]*?)\\.*(?:[:/?#]|$)', 1)) AS host,
                regexp_extract(url, '^[\\x00-\\x20]*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)/', 1) AS segment
            FROM pages
        ), v AS (
            SELECT row_number() OVER () AS r, page_id, url, fetched_on, host, CASE WHEN segment = '' THEN '' ELSE host || '/' || segment || '/' END AS prefix FROM u
        ), h AS (SELECT pattern, md5(pattern) AS h FROM (SELECT DISTINCT host AS pattern FROM v WHERE host <> '')),
        p AS (SELECT pattern, md5(pattern) AS h FROM (SELECT DISTINCT prefix AS pattern FROM v WHERE prefix <> '')),
        e AS (
            SELECT * FROM (VALUES ('host', 'spam-farm.example.org', 'block', 'spam', DATE '2023-02-01'), ('host', 'spam-farm.example.org', 'remove', NULL, DATE '2023-08-01'),
                ('host', 'spam-farm.example.org', 'block', 'spam', DATE '2024-01-15'), ('host', 'cheap-pills.example.com', 'block', 'pharma', DATE '2023-04-10'),
                ('host', 'casino.example.net', 'block', 'gambling', DATE '2023-06-01')) AS t(kind, pattern, action, category, listed_on)
            UNION ALL SELECT 'host', pattern, 'block', 'hashed', DATE '2023-01-01' + CAST('0x' || substr(h, 2, 2) AS INTEGER) FROM h WHERE substr(h, 1, 1) IN ('0', '1', '2', '3')
            UNION ALL SELECT 'host', pattern, 'remove', NULL, DATE '2023-01-01' + CAST('0x' || substr(h, 2, 2) AS INTEGER) + CAST('0x' || substr(h, 4, 2) AS INTEGER) + 1 FROM h WHERE substr(h, 1, 1) IN ('0', '1', '2', '3') AND substr(h, 6, 1) < '8'
            UNION ALL SELECT 'prefix', pattern, 'allow', 'trusted', DATE '2023-01-01' + CAST('0x' || substr(h, 2, 2) AS INTEGER) FROM p WHERE substr(h, 1, 1) IN ('e', 'f')
        ), d AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind, pattern, listed_on ORDER BY CASE action WHEN 'block' THEN 2 WHEN 'allow' THEN 1 ELSE 0 END DESC, category DESC) AS n FROM e) WHERE n = 1
        ), i AS (SELECT *, coalesce(lead(listed_on) OVER (PARTITION BY kind, pattern ORDER BY listed_on), DATE '9999-12-31') AS valid_to FROM d),
        m AS (
            SELECT r, action, pattern, category, listed_on, row_number() OVER (PARTITION BY r ORDER BY kind = 'prefix' DESC, length(pattern) DESC, pattern DESC) AS n
            FROM v JOIN i ON action <> 'remove' AND fetched_on >= listed_on AND fetched_on < valid_to
                AND (kind = 'prefix' AND pattern = prefix OR kind = 'host' AND (pattern = host OR ends_with(host, '.' || pattern)) AND (contains(pattern, '.') OR pattern = host))
        )
        SELECT page_id, url, fetched_on, coalesce(action = 'block', false) AS blocked, action, pattern, category, listed_on FROM v LEFT JOIN (SELECT * FROM m WHERE n = 1) USING (r)""",
}
