"""URL filters by a temporal list join.

A list is dated entries: from its day on, a pattern has an action (block or allow), or none after a
removal. The entries of a pattern become validity intervals; each capture asks for the patterns that could
cover its URL (every suffix of its host, and its host with the first path segment) and joins the interval
that holds at its fetch day. So a capture is judged by the list as it stood when it was fetched. Of several
active entries the most specific wins: a path prefix before a host, a longer pattern before a shorter one.

The join is an equality on the pattern with a range on the day. Intervals of one pattern are disjoint, so a
capture meets each of its patterns once; a hot host is rows of one key on the capture side alone, which
Spark splits (or joins by broadcast where the written list is small enough by its own size).

User information, ports, dots after a host and blanks before a URL change nothing; patterns are written without
them. Captures of one URL on one day are judged once.

Defined cases: a capture without a URL, host or fetch day, and any capture on an empty list, matches
nothing and is not blocked; of entries of one pattern on one day the last in the order remove, allow, block
counts; entries with a null in pattern, kind or day are ignored; repeated captures come back once each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FOREVER = "9999-12-31"
ACTIONS = {"remove": 0, "allow": 1, "block": 2}


#: Up to the authority; blanks and control characters before a URL don't count.
_SCHEME = r"^[\x00-\x20]*[A-Za-z][A-Za-z0-9+.-]*://"


def url_host(url: Column) -> Column:
    """The host in lower case, without user information, port and dots at its end; else empty."""
    return F.lower(F.regexp_extract(url, _SCHEME + r"(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@]*?)\.*(?:[:/?#]|$)", 1))


def url_prefix(url: Column) -> Column:
    """host/segment/ of the first path segment, which a slash must end; else empty."""
    segment = F.regexp_extract(url, _SCHEME + r"[^/?#]+/([^/?#]+)/", 1)
    return F.when(segment == "", "").otherwise(F.concat(url_host(url), F.lit("/"), segment, F.lit("/")))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """kind, pattern, action, category, valid_from, valid_to (exclusive) for entries (kind, pattern, action, category, listed_on)."""
    order = F.coalesce(*[F.when(F.col("action") == a, n) for a, n in ACTIONS.items()])
    entries = entries.where("kind IS NOT NULL AND pattern IS NOT NULL AND listed_on IS NOT NULL").withColumn("order", order).where("order IS NOT NULL")
    day = entries.groupBy("kind", "pattern", "listed_on").agg(F.max(F.struct("order", "action", "category")).alias("e"))
    following = F.lead("listed_on").over(Window.partitionBy("kind", "pattern").orderBy("listed_on"))
    spans = day.select("kind", "pattern", "e.action", "e.category", F.col("listed_on").alias("valid_from"), F.coalesce(following, F.lit(FOREVER).cast("date")).alias("valid_to"))
    return spans.where("action <> 'remove'")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Adds blocked, action, pattern, category and listed_on to captures (url, fetched_on, ...), which keep their columns."""
    asked = captures.select(F.col("url").alias("__url"), F.col("fetched_on").alias("__day")).where("__day IS NOT NULL").distinct()
    url, key = F.col("__url"), ["__url", "__day"]
    host, labels = url_host(url), F.split(url_host(url), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda k: F.struct(F.lit("host").alias("kind"), F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("pattern")))
    prefix = F.struct(F.lit("prefix").alias("kind"), url_prefix(url).alias("pattern"))
    asks = asked.where(host != "").select(*key, F.explode(F.concat(suffixes, F.array(prefix))).alias("ask"))
    asks = asks.select(*key, F.col("ask.kind").alias("kind"), F.col("ask.pattern").alias("pattern")).where("pattern <> ''")
    spans = written(validity_intervals(entries), "intervals")
    held = asks.alias("a").join(spans.alias("v"), (F.col("a.kind") == F.col("v.kind")) & (F.col("a.pattern") == F.col("v.pattern")) & (F.col("a.__day") >= F.col("v.valid_from")) & (F.col("a.__day") < F.col("v.valid_to")))
    specific = F.struct((F.col("v.kind") == "prefix").alias("by_prefix"), F.length("v.pattern").alias("length"), F.col("v.pattern").alias("pattern"), F.col("v.action").alias("action"), F.col("v.category").alias("category"), F.col("v.valid_from").alias("listed_on"))
    best = held.groupBy("__url", "__day").agg(F.max(specific).alias("__best"))
    out = captures.join(best, (F.col("url") == F.col("__url")) & (F.col("fetched_on") == F.col("__day")), "left").drop(*key)
    picked = [F.col(f"__best.{c}").alias(c) for c in ("action", "pattern", "category", "listed_on")]
    kept = [c for c in out.columns if c != "__best" and c not in ("blocked", "action", "pattern", "category", "listed_on")]
    return out.select(*kept, F.coalesce(F.col("__best.action") == "block", F.lit(False)).alias("blocked"), *picked)


#: A dated list of known hosts: kind, pattern, action, category, day.
SPAM_HOSTS = [
    ("host", "spam-farm.example.org", "block", "spam", "2023-02-01"),
    ("host", "spam-farm.example.org", "remove", None, "2023-08-01"),
    ("host", "spam-farm.example.org", "block", "spam", "2024-01-15"),
    ("host", "cheap-pills.example.com", "block", "pharma", "2023-04-10"),
    ("host", "casino.example.net", "block", "gambling", "2023-06-01"),
]


def dated_pages(pages: DataFrame) -> DataFrame:
    """Captures of the pages table, which has no fetch times: two years of days dealt by page_id."""
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(730)).cast("int"))
    return pages.select("page_id", "url", F.when(F.col("page_id").isNotNull(), day).alias("fetched_on"))


def dated_list(pages: DataFrame) -> DataFrame:
    """A dated list that grows with the table: fixed spam hosts, and histories for hosts and path prefixes by the MD5 of their names."""
    spark = pages.sparkSession
    fixed = spark.createDataFrame(SPAM_HOSTS, "kind string, pattern string, action string, category string, day string")
    fixed = fixed.select("kind", "pattern", "action", "category", F.col("day").cast("date").alias("listed_on"))
    hosts = pages.select(url_host(F.col("url")).alias("pattern")).where("pattern <> ''").distinct().withColumn("h", F.md5("pattern"))
    prefixes = pages.select(url_prefix(F.col("url")).alias("pattern")).where("pattern <> ''").distinct().withColumn("h", F.md5("pattern"))

    def number(at: int) -> Column:
        return F.conv(F.substring("h", at, 2), 16, 10).cast("int")

    start = F.date_add(F.lit("2023-01-01").cast("date"), number(2))
    end = F.date_add(start, number(4) + 1)

    def rows(df: DataFrame, kind: str, action: str, category: str | None, on: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), "pattern", F.lit(action).alias("action"), F.lit(category).cast("string").alias("category"), on.alias("listed_on"))

    listed = hosts.where("substring(h, 1, 1) IN ('0', '1', '2', '3')")
    freed = listed.where("substring(h, 6, 1) < '8'")
    trusted = prefixes.where("substring(h, 1, 1) IN ('e', 'f')")
    return fixed.union(rows(listed, "host", "block", "hashed", start)).union(rows(freed, "host", "remove", None, end)).union(rows(trusted, "prefix", "allow", "trusted", start))
