"""Evidence: whether a sentence stands in a source text, and in which."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataquery.functions.text import evidence_key, tokens
from strataquery.sources.shared import cut


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once: in a lambda an outer expression is computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_coverage(needle: Column, haystack: Column) -> Column:
    """The share of needle's words, with repetition, that haystack has; null without words. Arguments are arrays of words."""
    count = lambda words, w: F.size(words) - F.size(F.array_remove(words, w))
    hits = lambda x: F.aggregate(F.array_distinct(x["a"]), F.lit(0), lambda acc, w: acc + F.least(count(x["a"], w), count(x["b"], w)))
    share = lambda x: F.when(F.size(x["a"]) > 0, hits(x) / F.size(x["a"]))
    return bound(F.struct(needle.alias("a"), haystack.alias("b")), share)


def match_ladder(sentence: Column, source: Column) -> Column:
    """strict, normalised, near (98 % of the words), partial (90 %) or unresolved."""
    coverage = word_coverage(tokens(evidence_key(sentence)), tokens(evidence_key(source)))
    return (
        F.when(F.contains(source, sentence), "strict")
        .when(F.contains(evidence_key(source), evidence_key(sentence)), "normalised")
        .when(coverage >= 0.98, "near")
        .when(coverage >= 0.9, "partial")
        .otherwise("unresolved")
    )


def match_all(sentences: DataFrame, blocks: DataFrame) -> DataFrame:
    """sentence_id, block_id, status for pairs that are not unresolved.

    A block that holds 90 % of a sentence's words, or all but two (a contained sentence can miss its first and last
    word there), holds one of its rarest tenth and two more: sentences (the stated query set) meet blocks on these
    words alone. Pairs that meet count the sentence's words that the block has, each as often as the sentence asks, and
    only those that can still reach 90 % or miss two meet the texts and climb the ladder. Words are compared by hashes
    there, which can only let more pairs pass; a block with tags counts with the words in them too, as a sentence can
    stand there as it is, but a pair without a common word outside tags is none. Sentences of three words or fewer, or
    without Latin words, are looked for as they are, block by block.
    """
    keyed = cut(sentences.select("sentence_id", "sentence", evidence_key(F.col("sentence")).alias("s")).distinct().withColumn("asked", F.monotonically_increasing_id())).withColumn("words", tokens(F.col("s")))
    asked = cut(keyed.select("asked", F.size("words").alias("n"), F.explode("words").alias("word")).groupBy("asked", "n", "word").agg(F.count("*").alias("times")))
    wanted = cut(asked.select("word", F.hash("word").alias("h")).distinct())
    asked = asked.groupBy("asked", "n", F.hash("word").alias("h")).agg(F.sum("times").alias("times"))
    plainly = tokens(evidence_key(F.col("text")))
    words = F.when(F.col("text").rlike("<[^>]*>"), F.concat(plainly, tokens(F.col("text")))).otherwise(plainly)
    held = cut(blocks.select("block_id", F.explode(F.array_distinct(words)).alias("word")).join(wanted, "word").select("block_id", "h"))
    often = held.groupBy("h").agg(F.count("*").alias("df"))
    rare = F.sum("times").over(Window.partitionBy("asked").orderBy(F.coalesce("df", F.lit(0)), "h").rowsBetween(Window.unboundedPreceding, -1))
    probes = asked.join(often, "h", "left").withColumn("before", F.coalesce(rare, F.lit(0))).where(F.col("before") <= F.floor(0.1 * F.col("n")) + 2)
    near = probes.select("asked", "h").join(held, "h").select("asked", "block_id").distinct()
    hits = near.join(asked, "asked").join(held, ["block_id", "h"]).groupBy("asked", "block_id", "n").agg(F.sum("times").alias("hits"))
    may = cut(hits.where("10 * (n - hits) <= greatest(n, 20)").select("asked", "block_id"))
    short = keyed.where(F.size("words") <= 3).where("s <> ''").select("sentence_id", "sentence", "s")
    found = blocks.join(may, "block_id").join(keyed.select("asked", "sentence_id", "sentence", "words"), "asked")
    found = found.where(F.arrays_overlap("words", plainly)).select("sentence_id", "block_id", "sentence", "text")
    plain = short.join(blocks.select("block_id", "text", evidence_key(F.col("text")).alias("b")), F.expr("contains(b, s)")).select("sentence_id", "block_id", "sentence", "text")
    pairs = found.union(plain)
    return pairs.select("sentence_id", "block_id", match_ladder(F.col("sentence"), F.col("text")).alias("status")).where("status <> 'unresolved'").distinct()


def recover_block(sentences: DataFrame, blocks: DataFrame, probe_words: int = 6) -> DataFrame:
    """sentence_id, matches, block_id (where one block holds the sentence) and status.

    Sentences (sentence_id, sentence) are normalised, and so are blocks (block_id, text). Candidates come from
    an equality on the hash of the sentence's inner words (its first and last may be parts of longer words
    there), at most ``probe_words`` of them, with the runs of as many words of a block, and the containment is
    tested on them. Only sentences of two words or fewer, which have no inner word, are looked for block by block.
    """
    words = lambda c: F.split(F.col(c), " ")
    asked = sentences.select("sentence_id", evidence_key(F.col("sentence")).alias("s")).where("s <> ''")
    inner = F.slice(words("s"), 2, F.least(F.lit(probe_words), F.greatest(F.size(words("s")) - 2, F.lit(0))))
    asked = cut(asked.withColumn("n", F.size(inner)).withColumn("probe", F.when(F.col("n") > 0, F.xxhash64("n", inner))))
    lengths = [r["n"] for r in asked.where("n > 0").select("n").distinct().collect()]  # probe_words numbers at most
    texts = blocks.select("block_id", evidence_key(F.col("text")).alias("b"))
    run = lambda w, n: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.xxhash64(F.lit(n), F.slice(w, i, n))))
    all_runs = lambda w: F.array_distinct(F.flatten(F.array_compact(F.array(*[run(w, n) for n in lengths]))))
    runs = bound(words("b"), all_runs) if lengths else F.array().cast("array<bigint>")
    probed = asked.where("probe IS NOT NULL").join(texts.select("block_id", F.explode(runs).alias("probe")), "probe").select("sentence_id", "s", "block_id").distinct()
    short = asked.where("probe IS NULL").select("sentence_id", "s").join(texts.select("block_id", "b"), F.expr("contains(b, s)")).select("sentence_id", "block_id")
    held = probed.join(texts.select("block_id", "b"), "block_id").where(F.expr("contains(b, s)")).select("sentence_id", "block_id").union(short)
    per = held.distinct().groupBy("sentence_id").agg(F.count("*").alias("matches"), F.min("block_id").alias("first"))
    out = sentences.select("sentence_id").join(per, "sentence_id", "left")
    n = F.coalesce("matches", F.lit(0))
    return out.select("sentence_id", n.alias("matches"), F.when(n == 1, F.col("first")).alias("block_id"), F.when(n == 1, "recovered").when(n > 1, "ambiguous").otherwise("unresolved").alias("status"))


def sensitive_spans(text: Column, patterns: Sequence[str]) -> Column:
    """How many matches of any pattern a text has."""
    return sum((F.size(F.regexp_extract_all(text, F.lit(p), F.lit(0))) for p in patterns[1:]), F.size(F.regexp_extract_all(text, F.lit(patterns[0]), F.lit(0))))
