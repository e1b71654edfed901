"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the expected number of copies of each of its documents. The whole part
is taken outright; the rest is a probability per document, rounded dependently: two fractional documents
exchange mass (words) in a random direction, with chances that keep both expectations, until one of them
becomes integral. A source's words stay where they are on the way, and only its last residual moves them, by
less than one document.

With ``trials`` of 1 that residual is drawn by its own probability, and every document's expected copies are its
source's ratio. With more, as in the query and the pipeline, a source's last group is folded that often, the fold
with the least residual counts, and the residual goes to the nearer side: taken words come much nearer to small
sources' targets, at the price of a bias within each source's last group.

Pairs meet in a reduction tree: hashed groups of about ``fan_in`` documents of a source fold into one
residual each, residuals meet in the next level, and so on; a level is a fan_in-th of the one below, and no
task ever holds more than some groups. Within a group large documents go first, which leaves small
residuals. Random numbers are hashes of source, ids, level and seed: reruns agree.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null source is a source, last in
order; repeated rows count as one item of that multiplicity, whose copies its rows share as evenly as they
can; null ids are kept; an empty table, or one without words, gives targets of 0; further columns are kept
where an operator returns documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, words_in, written

FAN_IN = 128
MOST_COPIES = 3
#: Foldings of a source's last group, of which the one with the least residual counts.
TRIALS = 16
SEED = 20240501
WEIGHTS = (1, 2, 3)

ITEM = "struct<doc_id:bigint,size:bigint,rows:bigint,whole:bigint,p:double>"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target for (source, size) rows.

    Sources by code point, null last, take the weights in turn. A target is the smaller of ``most`` times
    the size and weight times one common level; the level is the water level at which targets add up to all
    sizes, found by running sums over sources in the order in which they fill up. This is where repeated
    resharing of the excess ends.
    """
    exact = "decimal(30,6)"
    by_name = [F.col("source").asc_nulls_last()]
    per = _running(sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1)), by_name, "one")
    weight = F.element_at(F.array(*[F.lit(w).cast(exact) for w in weights]), (F.col("one_before") % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).cast(exact).alias("full"))
    per = _running(per.withColumn("fills", F.col("full").cast("double") / F.col("weight").cast("double")), [F.col("fills"), *by_name], "full", "weight")
    total = per.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    left, above = (F.col("all_size") - F.col("full_before")).cast("double"), (F.col("all_weight") - F.col("weight_before")).cast("double")
    per = per.crossJoin(F.broadcast(total)).withColumn("level", left / above).withColumn("weight", F.col("weight").cast("double")).withColumn("full", F.col("full").cast("double"))
    # levels rise until the first source that is not full at its own, and fall from there on
    levels = per.agg(F.max(F.when(F.col("level") * F.col("weight") <= F.col("full"), F.col("level"))).alias("open"), F.max("level").alias("highest"))
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(F.col("full"), F.coalesce("open", "highest") * F.col("weight")))
    # one row of totals beside each source
    return per.crossJoin(F.broadcast(levels)).select("source", "source_size", target.alias("target"))


def _running(rows: DataFrame, order: list[Column], *columns: str) -> DataFrame:
    """Adds to each row the sums of exact columns over all rows before it (``.._before``), by running sums in ranges of the order and then over ranges, so no task holds all rows."""
    ranges = shuffle_partitions(rows.sparkSession)
    placed = written(rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each range
    starts = placed.groupBy("range").agg(*[F.sum(c).alias(c) for c in columns])
    starts = starts.select("range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_start") for c in columns])
    local = placed.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_local") for c in columns])
    joined = local.join(F.broadcast(starts), "range")
    return joined.select(*rows.columns, *[(F.col(f"{c}_start") + F.col(f"{c}_local")).alias(f"{c}_before") for c in columns])


def _chance(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _fold(items: Column, level: int, seed: int, trial: Column) -> Column:
    """Folds items, large first, into struct(last: the residual, done: the items made integral)."""

    def settle(item: Column, p: Column | float) -> Column:
        return F.struct(*[item[k].alias(k) for k in ("doc_id", "size", "rows", "whole")], (F.lit(p) if isinstance(p, float) else p).alias("p"))

    def step(acc: Column, b: Column) -> Column:
        a = acc["last"]
        pa, pb, wa, wb = a["p"], b["p"], a["size"].cast("double"), b["size"].cast("double")
        up, down = F.least(wa * (1 - pa), wb * pb), F.least(wa * pa, wb * (1 - pb))
        lift = _chance(F.col("source"), a["doc_id"], a["size"], b["doc_id"], b["size"], F.lit(level), F.lit(seed), trial) * (up + down) < down
        a_done = F.when(lift, wa * (1 - pa) <= wb * pb).otherwise(wa * pa <= wb * (1 - pb))
        moved = F.when(lift, up).otherwise(-down)
        done = F.when(a_done, settle(a, F.when(lift, 1.0).otherwise(0.0))).otherwise(settle(b, F.when(lift, 0.0).otherwise(1.0)))
        last = F.when(a_done, settle(b, F.least(F.greatest(pb - moved / wb, F.lit(0.0)), F.lit(1.0)))).otherwise(settle(a, F.least(F.greatest(pa + moved / wa, F.lit(0.0)), F.lit(1.0))))
        return F.struct(last.alias("last"), F.concat(acc["done"], F.array(done)).alias("done"))

    first = F.struct(F.get(items, F.lit(0)).cast(ITEM).alias("last"), F.array().cast(f"array<{ITEM}>").alias("done"))
    return F.aggregate(F.slice(items, 2, F.size(items)), first, step)


def _residual(item: Column) -> Column:
    """Words by which a source misses its target if this item is its last."""
    return F.abs(item["p"] - F.round(item["p"])) * item["size"]


def _best_fold(items: Column, level: int, seed: int, trials: Column) -> Column:
    """Of so many independent foldings the one with the least residual."""
    folds = F.transform(F.sequence(F.lit(0), trials - 1), lambda t: _fold(items, level, seed, t))
    keyed = F.transform(folds, lambda f, t: F.struct(_residual(f["last"]).alias("r"), t.alias("t"), f.alias("f")))
    return F.array_min(keyed)["f"]


def _large_first(items: Column) -> Column:
    key = F.transform(items, lambda x: F.struct((-x["size"]).alias("k"), F.xxhash64(x["doc_id"]).alias("h"), x.alias("x")))
    return F.transform(F.array_sort(key), lambda x: x["x"])


def round_copies(items: DataFrame, fan_in: int = FAN_IN, seed: int = SEED, trials: int = TRIALS) -> DataFrame:
    """Adds copies to (source, doc_id, size, rows, ideal): whole numbers whose words per source add up to the ideal ones, but for one residual document."""
    items = items.withColumn("whole", F.floor("ideal").cast("long")).withColumn("p", F.col("ideal") - F.col("whole"))
    plain = ["source", "doc_id", "size", "rows"]
    items = written(items.select(*plain, "whole", "p"), "items")
    rounds = F.col("p").between(1e-9, 1 - 1e-9) & (F.col("size") > 0)
    done = [items.where(~rounds).select(*plain, (F.col("whole") + F.round("p").cast("long")).alias("copies"))]
    open_items = items.where(rounds).select("source", F.struct("doc_id", "size", "rows", "whole", "p").cast(ITEM).alias("item"))
    level = 0
    while True:
        groups = open_items.groupBy("source").agg(F.ceil(F.count("*") / fan_in).cast("long").alias("groups"))
        groups = written(groups, "groups")
        most = groups.agg(F.max("groups")).first()[0]
        if most is None:
            break
        same = F.col("g.source").eqNullSafe(F.col("o.source"))
        dealt = open_items.alias("o").join(groups.alias("g"), same).select("o.source", "o.item", F.pmod(F.xxhash64("o.item.doc_id", "o.item.size", F.lit(level), F.lit(seed)), "g.groups").alias("bucket"), "g.groups")
        grouped = dealt.groupBy("source", "bucket", "groups").agg(F.collect_list("item").alias("items")).select("source", "groups", _large_first(F.col("items")).alias("items"))
        folded = grouped.select("source", _best_fold(F.col("items"), level, seed, F.when(F.col("groups") == 1, trials).otherwise(1)).alias("f"))
        folded = written(folded, f"level-{level}")
        done.append(folded.select("source", F.explode("f.done").alias("x")).select("source", "x.doc_id", "x.size", "x.rows", (F.col("x.whole") + F.round("x.p").cast("long")).alias("copies")))
        open_items = folded.select("source", F.col("f.last").alias("item"))
        level += 1
        if most == 1:
            # the residual of each source
            drawn = _chance(F.col("source"), F.col("item.doc_id"), F.col("item.size"), F.lit("last"), F.lit(seed)) < F.col("item.p") if trials == 1 else F.col("item.p") >= 0.5
            done.append(open_items.select("source", "item.doc_id", "item.size", "item.rows", (F.col("item.whole") + drawn.cast("long")).alias("copies")))
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _item_copies(docs: DataFrame, weights: Sequence[int], most: int, fan_in: int, seed: int, trials: int) -> tuple[DataFrame, DataFrame]:
    """(source, doc_id, size, rows, copies) for each kind of row, with copies for all rows of it together; and the targets."""
    sizes = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words_in(F.col("text")).alias("size"))
    items = written(sizes.groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows")), "sizes")
    targets = written(source_targets(items.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, most), "targets")
    ratio = F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(0.0)
    joined = items.alias("i").join(targets.alias("t"), F.col("i.source").eqNullSafe(F.col("t.source")))
    # equal rows are one item: rows times the ratio, in words of one row
    ideal = joined.select("i.source", "i.doc_id", "i.size", "i.rows", (F.least(ratio, F.lit(float(most))) * F.col("i.rows")).alias("ideal"))
    return round_copies(ideal, fan_in, seed, trials), targets


def _share(row: Column) -> Column:
    """The copies of the row-th (from 0) of an item's rows."""
    return F.expr("copies div rows") + (row < F.col("copies") % F.col("rows")).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, fan_in: int = FAN_IN, seed: int = SEED, trials: int = TRIALS) -> DataFrame:
    """doc_id, source, size, source_size, target and copies for each row of docs (doc_id, text, source)."""
    items, targets = _item_copies(docs, weights, most, fan_in, seed, trials)
    copies = items.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    out = copies.select("source", "doc_id", "size", _share(F.col("row")).alias("copies"))
    same = F.col("c.source").eqNullSafe(F.col("t.source"))
    return out.alias("c").join(targets.alias("t"), same).select("c.doc_id", "c.source", "c.size", "t.source_size", "t.target", "c.copies")


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, fan_in: int = FAN_IN, seed: int = SEED, trials: int = TRIALS) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with their columns.

    How often is settled on hashes of rows, so texts travel once, to the rows that are taken. Of rows that differ in
    nothing the first in any order are taken more often.
    """
    items, _ = _item_copies(docs, weights, most, fan_in, seed, trials)
    plain = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = docs.select(F.xxhash64(*plain).alias("__hash"), words_in(F.col("text")).alias("__size"), F.struct(*docs.columns).alias("__row"))
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_in(F.col("text")).alias("size"), F.xxhash64(*plain).alias("hash")]
    alike = docs.select(*key).groupBy("doc_id", "source", "size", "hash").agg(F.count("*").alias("alike"))
    # the rows of an item take its copies in the order of their hashes
    earlier = F.coalesce(F.sum("alike").over(Window.partitionBy("doc_id", "source", "size").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    met = alike.withColumn("earlier", earlier).alias("d").join(items.where("copies > 0").alias("i"), F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")) & F.col("d.source").eqNullSafe(F.col("i.source")) & (F.col("d.size") == F.col("i.size")))
    more = F.least(F.greatest(F.col("i.copies") % F.col("i.rows") - F.col("d.earlier"), F.lit(0)), F.col("d.alike"))
    times = met.select(F.col("d.hash").alias("__hash"), F.col("d.size").alias("__size"), "alike", (F.col("alike") * F.expr("i.copies div i.rows") + more).alias("times"))
    times = written(times.where("times > 0").groupBy("__hash", "__size").agg(F.sum("alike").alias("__alike"), F.sum("times").alias("__times")), "times")
    taken = rows.join(times, ["__hash", "__size"])
    place = F.row_number().over(Window.partitionBy("__hash", "__size").orderBy("__hash")) - 1
    share = F.expr("__times div __alike") + (place < F.col("__times") % F.col("__alike")).cast("long")
    taken = taken.select("__row", share.cast("int").alias("__n"))
    return taken.select("__row", F.explode(F.array_repeat(F.lit(0), F.col("__n"))).alias("__copy")).select("__row.*")
