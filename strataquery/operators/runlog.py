"""Run logs: the state of attempts, stale leases, acceptance, cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataquery.operators.ordered import latest


def attempt_states(transitions: DataFrame, now: Column) -> DataFrame:
    """The last state of each attempt (attempt_id, at, status, lease_until); a running one whose lease is over is interrupted."""
    last = latest(transitions, ["attempt_id"], ["at"])
    stale = (F.col("status") == "running") & (F.col("lease_until") < now)
    return last.withColumn("status", F.when(stale, "interrupted_uncertain").otherwise(F.col("status")))


def acceptance(documents: DataFrame, expected: str, *group: str) -> DataFrame:
    """documents, blocking (other states) and accepted: some documents, all in the expected state."""
    blocking = F.count_if(~F.col("status").eqNullSafe(F.lit(expected)))
    return documents.groupBy(*group).agg(F.count("*").alias("documents"), blocking.alias("blocking")).withColumn("accepted", (F.col("documents") > 0) & (F.col("blocking") == 0))


def cost_summary(calls: DataFrame, *group: str) -> DataFrame:
    """Exact cost and tokens of calls (tokens, cost decimal or null); partial where a cost is missing."""
    unpriced = F.count_if(F.col("cost").isNull())
    return calls.groupBy(*group).agg(F.count("*").alias("calls"), F.sum("tokens").alias("tokens"), F.sum("cost").alias("cost"), unpriced.alias("unpriced")).withColumn("status", F.when(F.col("unpriced") > 0, "partial").otherwise("complete"))


def snapshot(documents: DataFrame, attempts: DataFrame, run: str) -> DataFrame:
    """Documents of one run with their attempts, in order: ref_no, status, attempts (a list of structs by time)."""
    rest = [c for c in attempts.columns if c not in ("run_id", "ref_no", "at")]
    tried = attempts.where(F.col("run_id") == run).groupBy("ref_no").agg(F.array_sort(F.collect_list(F.struct("at", *rest))).alias("attempts"))
    return documents.where(F.col("run_id") == run).join(tried, "ref_no", "left").orderBy("ref_no")


#: Ways in which an attempt is billed.
BILLING = ("free", "charged", "unknown")


def billing(attempts: DataFrame) -> DataFrame:
    """Adds billing and reason to attempts (source, status, cost, tokens, artifact_at, started_at).

    What came from a cache or a replay is free. An artifact older than the attempt, a cost that is none or below 0, and a
    cost of 0 for tokens are unknown.
    """
    reason = (
        F.when(F.col("source").isin("cached", "replayed"), "not_called")
        .when(F.col("artifact_at") < F.col("started_at"), "stale_artifact")
        .when(F.col("cost").isNull(), "no_cost")
        .when(F.col("cost") < 0, "bad_cost")
        .when((F.col("cost") == 0) & (F.col("tokens") > 0), "free_tokens")
        .otherwise("called")
    )
    kind = F.when(reason == "not_called", "free").when(reason == "called", "charged").otherwise("unknown")
    return attempts.withColumns({"billing": kind, "reason": reason})


def run_summary(attempts: DataFrame, *group: str) -> DataFrame:
    """Attempts by outcome, seconds, exact cost and tokens, prices, and the one currency (the first used; costs in others don't count).

    attempts: status, started_at, ended_at, cost, tokens, price, currency, billing.
    """
    keys = list(group)
    first = attempts.where("currency IS NOT NULL").groupBy(*keys).agg(F.min_by("currency", F.struct("started_at", "currency")).alias("run_currency"))
    met = attempts.join(first, keys, "left") if keys else attempts.crossJoin(first)
    counted = F.when(F.col("currency") == F.col("run_currency"), F.col("cost"))
    return met.groupBy(*keys, "run_currency").agg(
        F.count("*").alias("attempts"), F.count_if(F.col("status") == "succeeded").alias("succeeded"), F.count_if(F.col("status") != "succeeded").alias("others"), F.round(F.sum(F.col("ended_at") - F.col("started_at")), 3).alias("seconds"),
        F.sum(counted).alias("cost"), F.sum("tokens").alias("tokens"), F.array_sort(F.collect_set("price")).alias("prices"), *[F.count_if(F.col("billing") == b).alias(b) for b in BILLING],
    )


def usage_rollup(calls: DataFrame, *group: str) -> DataFrame:
    """Sums of several calls' tokens and cost; no amount where any call lacks one."""
    whole = lambda c: F.when(F.count_if(F.col(c).isNull()) == 0, F.sum(c)).alias(c)
    known = F.count_if(F.col("tokens").isNull() | F.col("cost").isNull()) == 0
    return calls.groupBy(*group).agg(F.count("*").alias("calls"), whole("tokens"), whole("cost"), F.when(known, "complete").otherwise("unavailable").alias("status"))


def warning_columns(warnings: DataFrame, code: str) -> DataFrame:
    """column, documents, times for the columns that warnings of one code name, over all documents."""
    flat = warnings.where(F.col("code") == code).select("document_id", F.explode("columns").alias("column"))
    return flat.groupBy("column").agg(F.count_distinct("document_id").alias("documents"), F.count("*").alias("times"))


def claims(documents: DataFrame, workers: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """ref_no, worker_id: open documents of a run in order, dealt to the run's workers in order, one each.

    Both sides have run_id; a run never gives a document twice, as numbers within a run are distinct.
    """
    place = lambda order: F.row_number().over(Window.partitionBy("run_id").orderBy(order))
    waiting = documents.where(F.col("status").isin(*allowed)).select("run_id", "ref_no", place("ref_no").alias("n"))
    free = workers.select("run_id", "worker_id", place("worker_id").alias("n"))
    return waiting.join(free, ["run_id", "n"]).select("run_id", "ref_no", "worker_id")


def upserted(current: DataFrame, changes: DataFrame, key: tuple[str, ...], order: str) -> DataFrame:
    """The table after changes: the last row of each key by the order column, a change before what stood there."""
    columns = [c for c in current.columns if c not in key]
    rows = current.withColumn("__new", F.lit(0)).unionByName(changes.select(current.columns).withColumn("__new", F.lit(1)))
    best = F.max(F.struct(order, "__new", *[c for c in columns if c != order])).alias("row")
    return rows.groupBy(*key).agg(best).select(*key, "row.*").select(current.columns)


def stage_window(stages: DataFrame, start: int) -> DataFrame:
    """Stages of each document from ``start`` on, and whether all before it have their output: document_id, stage, ready."""
    before = stages.where(F.col("stage") < start).groupBy("document_id").agg(F.bool_and(F.col("done")).alias("__done"))
    return stages.where(F.col("stage") >= start).join(before, "document_id", "left").select("document_id", "stage", F.coalesce("__done", F.lit(start == 0)).alias("ready"))


def final_status(stages: DataFrame) -> DataFrame:
    """document_id, status: failed where a stage failed, partial where one is missing, else published."""
    per = stages.groupBy("document_id").agg(F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") != "succeeded").alias("open"))
    return per.select("document_id", F.when(F.col("failed") > 0, "failed").when(F.col("open") > 0, "partial").otherwise("published").alias("status"))
