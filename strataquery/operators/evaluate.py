"""Evaluation against reference rows: summaries, conflicts, histograms, baselines, document scopes, collections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataquery.functions.numeric import ratio


def reference_summary(rows: DataFrame, document: str, name: str, *labels: str) -> DataFrame:
    """kind, value, n: rows, documents, distinct (document, name), and a histogram of each label column."""
    totals = rows.agg(F.count("*").alias("rows"), F.count_distinct(document).alias("documents"), F.count_distinct(document, name).alias("names"))
    flat = totals.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit("").alias("value"), F.col(k).alias("n")) for k in ("rows", "documents", "names")])).alias("x")).select("x.*")
    for label in labels:
        flat = flat.union(rows.where(F.col(label).isNotNull()).groupBy(F.lit(label).alias("kind"), F.col(label).cast("string").alias("value")).agg(F.count("*").alias("n")))
    return flat


def conflicts(rows: DataFrame, key: Sequence[str], label: str) -> DataFrame:
    """Keys with several labels, and these in order."""
    per = rows.groupBy(*key).agg(F.array_sort(F.collect_set(label)).alias("labels"))
    return per.where(F.size("labels") > 1)


def departures(summary: DataFrame, frozen: Mapping[str, int]) -> DataFrame:
    """kind, n, expected where a summary departs from frozen numbers; kinds that it lacks count 0."""
    spark = summary.sparkSession
    wanted = spark.createDataFrame([*frozen.items()], "kind string, expected long")
    met = wanted.join(summary.where("value = ''").select("kind", "n"), "kind", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return met.where("n <> expected")


def classification(rows: DataFrame, truth: str, predicted: str, *group: str) -> DataFrame:
    """total, answered, abstained, correct, accuracy (of all), precision (of those answered, null of nothing), majority and its share: what always saying the commonest label would reach."""
    keys = list(group)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("total"), F.count(predicted).alias("answered"), F.count_if(F.col(truth) == F.col(predicted)).alias("correct"))
    per = rows.groupBy(*keys, truth).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max(F.struct("n", truth)).alias("best"))
    met = counts.join(per, keys) if keys else counts.crossJoin(per)
    return met.select(
        *keys, "total", "answered", (F.col("total") - F.col("answered")).alias("abstained"), "correct", ratio(F.col("correct"), F.col("total"), "audit").alias("accuracy"), ratio(F.col("correct"), F.col("answered"), "audit").alias("precision"),
        F.col(f"best.{truth}").alias("majority"), ratio(F.col("best.n"), F.col("total"), "audit").alias("majority_share"),
    )


def detection(truth: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """tp, fp, fn, precision and recall (null of nothing) of a set of documents against another."""
    t, p = truth.select(key, F.lit(1).alias("t")).distinct(), predicted.select(key, F.lit(1).alias("p")).distinct()
    both = t.join(p, key, "full").agg(F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count_if(F.col("t").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    return both.select("*", ratio(F.col("tp"), F.col("tp") + F.col("fp"), "safe").alias("precision"), ratio(F.col("tp"), F.col("tp") + F.col("fn"), "safe").alias("recall"))


def first_names(rows: DataFrame, group: Sequence[str], name: str, n: int = 6) -> DataFrame:
    """The first n distinct names in order, and how many there are."""
    per = rows.where(F.col(name).isNotNull()).groupBy(*group).agg(F.array_sort(F.collect_set(name)).alias("names"))
    return per.select(*group, F.slice("names", 1, n).alias("first_names"), F.size("names").alias("n_names"))


def verification(checks: DataFrame, *group: str) -> DataFrame:
    """passed, failed, accepted (some checks, all passed) of rows (passed boolean; null has failed)."""
    ok = F.coalesce("passed", F.lit(False))
    counts = checks.groupBy(*group).agg(F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed"))
    return counts.withColumn("accepted", (F.col("passed") > 0) & (F.col("failed") == 0))


def terminal(states: DataFrame, ended: Sequence[str], *group: str) -> DataFrame:
    """For each group how many items are in each state (a map), and whether all have ended."""
    per = states.groupBy(*group, "state").agg(F.count("*").alias("n"))
    histogram = F.map_from_entries(F.array_sort(F.collect_list(F.struct("state", "n"))))
    return per.groupBy(*group).agg(histogram.alias("states"), F.bool_and(F.col("state").isin(*ended)).alias("finished"))


def collection_summary(documents: DataFrame, group: str, sums: Sequence[str], overrides: DataFrame | None = None) -> DataFrame:
    """Sums of a collection's documents; an override (kind of 0 counts as none) stands in their place."""
    rows = documents.groupBy(group).agg(F.count("*").alias("documents"), *[F.sum(c).alias(c) for c in sums])
    if overrides is None:
        return rows
    names = [c for c in sums if c in overrides.columns]
    given = overrides.select(group, *[F.col(c).alias(f"__{c}") for c in names])
    met = rows.join(given, group, "left")
    return met.select(group, "documents", *[F.coalesce(F.nullif(f"__{c}", F.lit(0)), F.col(c)).alias(c) if c in names else F.col(c) for c in sums])


def collapsed(rows: DataFrame, owner: str, member: str, least: int) -> DataFrame:
    """Members of owners that have so many at least: (owner, n, members in order)."""
    per = rows.groupBy(owner).agg(F.count_distinct(member).alias("n"), F.array_sort(F.collect_set(member)).alias("members"))
    return per.where(F.col("n") >= least)


def paired_evidence(evidence: DataFrame, full_table: Column) -> DataFrame:
    """Evidence grouped by its source: one group for a whole table, else one for each sentence of a block; (block_id, sentence, n, locators in order)."""
    sentence = F.when(full_table, F.lit(None).cast("string")).otherwise(F.col("sentence"))
    return evidence.groupBy("block_id", sentence.alias("sentence")).agg(F.count("*").alias("n"), F.array_sort(F.collect_set("locator")).alias("locators"))
