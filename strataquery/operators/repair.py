"""Deterministic rewrites of flat child tables; each gives the table and how often it changed a document's rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataquery.operators.refs import numbered_id

Repair = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def _count(rows: DataFrame, code: str) -> DataFrame:
    return rows.groupBy("document_id").agg(F.count("*").alias("n")).select("document_id", F.lit(code).alias("code"), "n")


def rewrite(code: str, column: str, when: Column, value: Column) -> Repair:
    """Sets a column where a condition holds."""
    hit = F.coalesce(when, F.lit(False))
    return lambda df: (df.withColumn(column, F.when(hit, value).otherwise(F.col(column))), _count(df.where(hit), code))


def drop_rows(code: str, when: Column) -> Repair:
    hit = F.coalesce(when, F.lit(False))
    return lambda df: (df.where(~hit), _count(df.where(hit), code))


def in_order(df: DataFrame, repairs: Sequence[Repair]) -> tuple[DataFrame, DataFrame]:
    """The table after all repairs in turn, and (document_id, code, n) of what they did."""
    counts = []
    for repair in repairs:
        df, n = repair(df)
        counts.append(n)
    return df, reduce(DataFrame.unionByName, counts)


def first_filled(*columns: str) -> Column:
    """The first column that is not blank: aliases of one field."""
    return F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in columns])


def clear_partial(code: str, columns: Sequence[str]) -> Repair:
    """Controlled fields stand all together or not at all."""
    given = sum((F.col(c).isNotNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNotNull().cast("int"))
    partial = (given > 0) & (given < len(columns))
    return lambda df: (df.withColumns({c: F.when(~partial, F.col(c)) for c in columns}), _count(df.where(partial), code))


def map_unique(df: DataFrame, vocabulary: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Fills name from the vocabulary where its key has one name there."""
    one = vocabulary.groupBy(*on).agg(F.count_distinct(name).alias("__n"), F.min(name).alias("__name")).where("__n = 1").drop("__n")
    return df.join(one, list(on), "left").withColumn(name, F.coalesce(name, "__name")).drop("__name")


def drop_overlap(code: str, inputs: str, outputs: str) -> Repair:
    """An input list without repeats and without what the outputs hold."""
    cleaned = F.array_except(F.array_distinct(F.col(inputs)), F.col(outputs))
    return lambda df: (df.withColumn(inputs, cleaned), _count(df.where(F.size(cleaned) < F.size(inputs)), code))


def single_producer(code: str, steps: DataFrame, step: str, outputs: str) -> tuple[DataFrame, DataFrame]:
    """Outputs that several steps of a document claim belong to none; steps left without outputs go."""
    flat = steps.select("document_id", step, F.explode(outputs).alias("__out"))
    claimed = flat.groupBy("document_id", "__out").agg(F.count_distinct(step).alias("n")).where("n > 1")
    gone = flat.join(claimed, ["document_id", "__out"], "left_semi").groupBy("document_id", step).agg(F.collect_set("__out").alias("__gone"))
    joined = steps.join(gone, ["document_id", step], "left").withColumn(outputs, F.array_except(outputs, F.coalesce("__gone", F.array().cast("array<string>")))).drop("__gone")
    return joined.where(F.size(outputs) > 0), _count(claimed, code)


def renumber(df: DataFrame, order: str, prefix: str, digits: int = 3, key: str = "new_id") -> DataFrame:
    """Ids by position in each document: prefix001, prefix002, ..., and more digits past 999."""
    n = F.row_number().over(Window.partitionBy("document_id").orderBy(order))
    return df.withColumn(key, numbered_id(prefix, n, digits))


def number_after(df: DataFrame, existing: DataFrame, column: str, order: str, prefix: str, digits: int = 3, key: str = "new_id") -> DataFrame:
    """Ids that go on after the highest number that a document's existing ids of the prefix have."""
    last = existing.select("document_id", F.regexp_extract(column, f"^{prefix}([0-9]+)$", 1).try_cast("long").alias("n")).groupBy("document_id").agg(F.max("n").alias("__last"))
    n = F.row_number().over(Window.partitionBy("document_id").orderBy(order)) + F.coalesce("__last", F.lit(0))
    return df.join(last, "document_id", "left").withColumn(key, numbered_id(prefix, n, digits)).drop("__last")


def remap(df: DataFrame, column: str, ids: DataFrame, old: str, new: str) -> DataFrame:
    """An array of ids under their new names; unknown ones stay. Each array is remapped once, whatever the rows that hold it."""
    lists = df.select("document_id", F.col(column).alias("__old")).where("__old IS NOT NULL").distinct()
    flat = lists.select("document_id", "__old", F.posexplode("__old").alias("__at", "__id"))
    named = flat.join(ids.select("document_id", F.col(old).alias("__id"), F.col(new).alias("__new")), ["document_id", "__id"], "left")
    back = named.groupBy("document_id", "__old").agg(F.array_sort(F.collect_list(F.struct("__at", F.coalesce("__new", "__id").alias("v")))).alias("__list"))
    back = back.select(F.col("document_id").alias("__doc"), "__old", "__list")
    met = df.join(back, (F.col("document_id") == F.col("__doc")) & (F.col(column) == F.col("__old")), "left")
    return met.withColumn(column, F.coalesce(F.transform("__list", lambda x: x["v"]), F.col(column))).drop("__doc", "__old", "__list")


def inherit_confidence(series: DataFrame, points: DataFrame, cap: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """A series without a score takes the least of its points; a point without one the series', at most ``cap``."""
    least = points.groupBy("document_id", "series_id").agg(F.min("score").alias("__low"))
    filled = series.join(least, ["document_id", "series_id"], "left").withColumn("score", F.coalesce("score", "__low")).drop("__low")
    of = filled.select("document_id", "series_id", F.col("score").alias("__series"))
    return filled, points.join(of, ["document_id", "series_id"], "left").withColumn("score", F.coalesce("score", F.least("__series", F.lit(cap)))).drop("__series")


def infer_blends(samples: DataFrame, steps: DataFrame, changing: Sequence[str]) -> DataFrame:
    """Samples whose type is unknown and that a composition-changing step makes from two entities or more are blends.

    samples: document_id, sample_id, entity_id, type; steps: document_id, step_id, kind, inputs, outputs.
    """
    made = steps.where(F.col("kind").isin(*changing))
    inputs = made.select("document_id", "step_id", F.explode("inputs").alias("sample_id")).join(samples, ["document_id", "sample_id"])
    mixed = inputs.groupBy("document_id", "step_id").agg(F.count_distinct("entity_id").alias("n")).where("n >= 2")
    blends = made.join(mixed, ["document_id", "step_id"], "left_semi").select("document_id", F.explode("outputs").alias("sample_id")).distinct().withColumn("__blend", F.lit("blend"))
    return samples.join(blends, ["document_id", "sample_id"], "left").withColumn("type", F.coalesce("type", "__blend")).drop("__blend")


def repair_warnings(counts: DataFrame, messages: DataFrame) -> DataFrame:
    """Warning rows of (document_id, code, n) with the text of each code."""
    return counts.where("n > 0").join(messages, "code", "left").select("document_id", "code", "n", F.coalesce("message", "code").alias("message"))
