"""N-gram Jaccard join in the metric space of Jaccard distance.

The first pivots are one-shingle sets. A document's distance from {s} is 1 - 1/size where it holds s and 1
elsewhere, so its nearest pivots are its own shingles; a global order breaks the tie, and the first one's
Voronoi region is its home. A document within the radius shares all but a bounded part of its shingles, so
the window in which such a neighbour's home can lie is the document's first size - least overlap + 1
shingles, and with k - 1 more than these, k shingles of the window are shared: it is replicated to those regions,
and one that has a neighbour stays in k of them. The order puts shingles that few documents hold first, by a
sketch of fixed size over all documents; its noise is the same mean everywhere, so what is far more frequent
than the square root of that mean stands out at any scale.

A region counts where two sets of near sizes enter it; of regions with one member set one is enough. Sizes and class counts of shingles (a contraction of the metric,
with classes in proportion to a set's size) leave members that may link; what they connect is a group, so that
a member's set travels to one group only.

Groups join by pivot documents, recursively. Each member goes home to its nearest pivot within a ball, or to
the remainder, and is replicated to earlier pivots whose region may hold a partner by the triangle inequality;
a pair meets in the region of the earlier home, once (masks rule out pairs of replicas). In a pivot's region
members are kept as their difference from the pivot, so near copies shrink to what sets them apart. A group that
fits a task does this there; a larger one is dealt to regions in slices with its pivots, level by level. What
does not shrink is joined as pairs of blocks, so a task's memory is bounded and no pair is lost.

In a region a pair links for certain where both are near enough to the pivot, and can't where their distances
from it differ too much; all others are compared exactly. Links are counted for each class; a task returns
counts and links that span what it found. Components come from these by alternating stars.

Defined cases: null texts and texts without words have no shingles and are linked with nothing; repeated
rows belong to one class and are returned each; a class of null ids alone is linked with nothing and has a
null id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap_of, drop_written, held, in_bitmap, low_bits, relieve, tidy, written
from .components import connected_components
from .shingles import mix, set_key, shingle_sets

SKETCH_BITS = 20
#: Shingles that the members of a region may hold together, and members, for one task; a member counts as some shingles by itself.
REGION_SHINGLES = 1_000_000
REGION_MEMBERS = 8_000
MEMBER_SHINGLES = 8
#: Members from which a large region's pivots are picked.
CANDIDATES = 64
#: A region is stuck if one level leaves more than this share of its shingles in one part.
STUCK = 0.7
#: Classes of shingles whose counts make a signature: the least and the most, and the shingles that a class holds at least on average in between.
CLASSES, MOST_CLASSES, CLASS_SHINGLES = 64, 4096, 4
#: Members that a region has at most for all their signatures to be compared in one task; bytes of signatures that travel together, about.
SIGNED_MEMBERS = 2000
SIGNED_BYTES = 8_000_000
#: Regions that two sets share at least if they link (small sets fewer), and rounds in which sets with fewer are taken out.
LEAST_SHARED, SHARED_ROUNDS = 6, 2
#: Classes of sizes that a mask tells apart.
SIZE_BITS = 63
#: Bits of the filters that carry shared pivots and wanted documents to passes over all documents; they let more pass, never fewer.
PIVOT_BITS, FILTER_BITS = 27, 24
#: The mask bits of the two blocks of a pair; lower bits belong to levels.
BLOCK_BITS = (1 << 61, 1 << 62)
EDGE = 1e-9

MEMBERS = "region long, c long, size long, delta binary, mask long, was long"


def least_overlap(size: int, percent: int) -> int:
    """Shingles that a set of this size shares at least with any that it links to."""
    return -(-percent * size // 100)


def _texts(batch: pa.RecordBatch) -> pa.StringArray:
    return pc.fill_null(batch.column("text"), "").cast(pa.string())


def signature(values: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles by class of their hash; large sets have more classes.

    Two sets share at most the sum of the smaller counts, in the classes of either: a metric that never exceeds
    the Jaccard distance.
    """
    bits = min(max(len(values) // CLASS_SHINGLES, CLASSES), MOST_CLASSES).bit_length() - 1
    return np.bincount((values >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the highest needs, 1, 2 or 4, which the first byte tells."""
    width = 1 if (top := counts.max()) < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + counts.astype(f"u{width}").tobytes()


def classes_of(data: bytes) -> int:
    return (len(data) - 1) // data[0]


def folded(data: bytes, classes: int) -> np.ndarray:
    """A packed signature with so many classes, which are fewer."""
    return np.frombuffer(data, f"u{data[0]}", offset=1).reshape(classes, -1).sum(1, dtype=np.uint32)


def describe(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, size, a and b of each row (kind 0), and parts of each task's sketch (kind 1: a is the part, data its counters)."""
    names = ["kind", "doc_id", "size", "a", "b", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # what other operators have left in the worker goes
        held("jaccard", dict)
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            size, a, b = [], [], []
            for x in shingle_sets(_texts(batch), n):
                np.add.at(sketch, low_bits(x, SKETCH_BITS), 1)
                k = set_key(x)
                size.append(len(x))
                a.append(k[0])
                b.append(k[1])
            columns = [pa.array(np.zeros(len(size), np.int32)), batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(size), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
        if sketch.any():
            parts = np.minimum(sketch, (1 << 32) - 1).astype(np.uint32).reshape(64, -1)
            none = pa.nulls(len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(parts), np.int32)), none, none, pa.array(np.arange(len(parts))), none, pa.array([p.tobytes() for p in parts], pa.binary())], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(run), "kind int, doc_id long, size long, a long, b long, data binary")


def sketch_of(described: DataFrame) -> np.ndarray:
    """The counters of all documents; their number is fixed, whatever the corpus."""

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"a": [key[0]], "data": [sum(np.frombuffer(c, np.uint32).astype(np.int64) for c in rows["data"]).tobytes()]})

    parts = described.where("kind = 1").groupBy("a").applyInPandas(add, "a long, data binary").orderBy("a").collect()
    return np.concatenate([np.frombuffer(p["data"], np.int64) for p in parts]) if parts else np.zeros(1 << SKETCH_BITS, np.int64)


def windows(docs: DataFrame, n: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """pivot, a, b, size: the regions that each document's set enters, once a task."""
    sent = docs.sparkSession.sparkContext.broadcast(np.minimum(sketch, (1 << 32) - 1).astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("jaccard", dict)
        counts = sent.value
        given: set[tuple[int, int]] = set()
        for batch in batches:
            pivots, keys = [], []
            for x in shingle_sets(_texts(batch), n):
                if len(x) and (key := set_key(x)) not in given:
                    given.add(key)
                    order = np.lexsort((x, counts[low_bits(x, SKETCH_BITS)]))
                    least = least_overlap(len(x), percent)
                    pivots.append(x[order[: len(x) - least + min(LEAST_SHARED, least)]].view(np.int64))
                    keys.append((*key, len(x)))
            if pivots:
                times = np.fromiter(map(len, pivots), np.int64, len(pivots))
                rest = np.repeat(np.array(keys, np.int64), times, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(pivots)), *(pa.array(rest[:, i].copy()) for i in range(3))], ["pivot", "a", "b", "size"])

    return docs.select(F.col("text").cast("string")).mapInArrow(tidy(run), "pivot long, a long, b long, size long")


# --- groups of members that may link ------------------------------------------------------------------------


def _starts(region: np.ndarray) -> np.ndarray:
    """Where each region of sorted rows begins, with the end."""
    return np.r_[np.flatnonzero(np.r_[True, region[1:] != region[:-1]]), len(region)]


def _plausible_links(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For a batch of regions pairs (a, b) that join all members which may link by the bound that sizes and signatures give."""

    def of_region(keys: np.ndarray, size: np.ndarray, data: list[bytes], left: list[np.ndarray], right: list[np.ndarray]) -> None:
        """Rows are sorted by size, so their signatures have more and more classes."""
        label, classes = np.arange(len(keys)), np.fromiter(map(classes_of, data), np.int64, len(data))
        counts = np.empty((0, 0), np.uint32)
        for i in range(len(keys) - 1):
            if counts.shape[1] != classes[i]:
                # what follows, in the classes of this row
                counts, first = np.stack([folded(x, int(classes[i])) for x in data[i:]]), i
            # sizes rise, so partners stand in a run after i; those that are joined already need no pair
            others = np.arange(i + 1, i + 1 + int(np.searchsorted(percent * size[i + 1 :], 100 * size[i], side="right")))
            others = others[label[others] != label[i]]
            most = np.minimum(counts[i - first], counts[others - first]).sum(1, dtype=np.int64)
            others = others[100 * most >= percent * (size[i] + size[others] - most)]
            if len(others):
                _, one = np.unique(label[others], return_index=True)
                left.append(np.full(len(one), keys[i]))
                right.append(keys[others[one]])
                label[np.isin(label, label[others])] = label[i]

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["region", "size"])
        keys, size, data, at = rows["c"].to_numpy(np.int64), rows["size"].to_numpy(np.int64), rows["data"].tolist(), _starts(rows["region"].to_numpy())
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            of_region(keys[a:b], size[a:b], data[a:b], left, right)
        return pd.DataFrame({"a": np.concatenate(left), "b": np.concatenate(right)})

    return links


def _homes(distance: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For distances of members from pivots (rows, columns) the home of each member (the number of pivots: the remainder) and the earlier pivots it is replicated to.

    A home lies within two radii. A partner of a region's own member is within three radii of the pivot, and at
    most two radii farther from it than from its own home.
    """
    radius = 1 - percent / 100
    nearest = distance.min(1)
    home = np.where(nearest <= 2 * radius + EDGE, distance.argmin(1), distance.shape[1])
    reach = np.minimum(3 * radius, np.where(home < distance.shape[1], nearest + 2 * radius, 3 * radius)) + EDGE
    return home, (distance <= reach[:, None]) & (np.arange(distance.shape[1]) < home[:, None])


def _signed_distance(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    most = np.minimum(x, y).sum(1, dtype=np.int64)
    return 1 - most / (sizes + size - most)


def _separated(found: list[int], order: list[int], distance: Callable[[int, int], float], least: float) -> list[int]:
    """Of candidates in order those that are farther than ``least`` from all picked before."""
    for i in order:
        if all(distance(i, j) > least for j in found):
            found.append(i)
    return found


def _signed_regions(signed: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """For large regions pairs (a, b) of members and the pivots whose windows hold them, and the members of the remainders, as regions of pairs of blocks.

    All members of a pivot's region and window become one group, which is more than may link, never less; so
    near copies, whatever their number, cost a comparison with each pivot.
    """
    radius = 1 - percent / 100
    bucket = F.pmod(F.xxhash64("c", "region"), F.lit(CANDIDATES))
    first = signed.groupBy("region", bucket.alias("k")).agg(F.min_by(F.struct("c", "size", "data"), F.xxhash64("c")).alias("p"))
    slices = signed.groupBy("region").agg(F.ceil(F.sum(F.length("data")) / SIGNED_BYTES).cast("long").alias("slices"))

    def pick(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        counts, size = np.stack([folded(x, CLASSES) for x in rows["data"]]), rows["size"].to_numpy(np.int64)
        kept = _separated([], list(range(len(rows))), lambda i, j: float(_signed_distance(counts[[i]], size[[i]], counts[j], size[j])[0]), 2 * radius)
        return rows.iloc[kept][["region", "c", "size", "data"]]

    pivots = written(first.select("region", "k", "p.*").groupBy("region").applyInPandas(pick, "region long, c long, size long, data binary"), "signed-pivots")
    sent = pivots.join(slices.select("region", F.col("slices").alias("n")), "region").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    sent = sent.select(F.col("region").alias("of"), "slice", "c", "size", "data")
    rows = signed.join(slices, "region").withColumn("slice", F.pmod(F.xxhash64("c", F.lit(1)), "slices"))

    def near(members: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        out = {"region": [], "a": [], "b": [], "size": [], "data": []}
        if len(members) and len(pivots):
            pivots = pivots.sort_values("c")
            counts, size = np.stack([folded(x, CLASSES) for x in members["data"]]), members["size"].to_numpy(np.int64)
            d = np.stack([_signed_distance(counts, size, folded(p.data, CLASSES), p.size_) for p in pivots.rename(columns={"size": "size_"}).itertuples()], axis=1)
            home, replica = _homes(d, percent)
            replica[home < d.shape[1], home[home < d.shape[1]]] = True
            i, k = np.nonzero(replica)
            c, left = members["c"].to_numpy(np.int64), np.flatnonzero(home == d.shape[1])
            out["region"] = [None] * len(i) + members["region"].iloc[left].tolist()
            out["a"], out["b"] = [*c[i].tolist(), *c[left].tolist()], [*pivots["c"].to_numpy(np.int64)[k].tolist(), *[None] * len(left)]
            out["size"], out["data"] = [None] * len(i) + size[left].tolist(), [None] * len(i) + members["data"].iloc[left].tolist()
        return pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in out.items()})

    schema = "region long, a long, b long, size long, data binary"
    told = written(rows.groupBy("region", "slice").cogroup(sent.groupBy("of", "slice")).applyInPandas(near, schema), "signed-told")
    # what is left: pairs of blocks, of one class of sizes or of two that follow each other
    left = told.where("region IS NOT NULL").select("region", F.col("a").alias("c"), "size", "data", _size_class(F.col("size"), percent).alias("of"))
    blocks = written(left.groupBy("region", "of").agg(F.ceil(F.count("*") * 2 / SIGNED_MEMBERS).cast("long").alias("blocks")), "signed-blocks")
    left = left.join(blocks, ["region", "of"]).withColumn("block", F.pmod(F.xxhash64("c", F.lit(2)), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1))
    within = left.withColumn("others", F.col("blocks")).withColumn("o", other).select(F.xxhash64("region", "of", F.least("block", "o"), F.greatest("block", "o")).alias("region"), "c", "size", "data")
    parts = [within]
    for shift in (1, -1):
        beside = blocks.select("region", (F.col("of") - shift).alias("of"), F.col("blocks").alias("others"))
        key = ("of", "block", "o") if shift == 1 else (F.col("of") - 1, "o", "block")
        parts.append(left.join(beside, ["region", "of"]).withColumn("o", other).select(F.xxhash64("region", F.lit("next"), *key).alias("region"), "c", "size", "data"))
    return told.where("region IS NULL").select("a", "b"), functools.reduce(DataFrame.union, parts)


def _distinct_regions(entered: DataFrame) -> DataFrame:
    """region, c, size, m (members) of (region, c, size): of regions with the same members one."""
    seal = entered.groupBy("region").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("c")).alias("x"), F.sum(F.shiftrightunsigned(F.xxhash64("c", F.lit(1)), 24)).alias("s"))
    one = seal.where("m > 1").groupBy("m", "x", "s").agg(F.min("region").alias("region")).select("region", "m")
    return written(entered.join(one, "region").select("region", "c", "size", "m"), "distinct-regions")


def _candidate_groups(kept: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """region, c: each member of distinct regions in the one group that holds all members it may link to, directly or through others; given signatures (c, data)."""
    signed = written(kept.join(signatures.select("c", "data"), "c").select("region", "c", "size", "data", "m"), "signed")
    within = signed.where(F.col("m") <= SIGNED_MEMBERS).drop("m")
    pairs = []
    if not kept.where(F.col("m") > SIGNED_MEMBERS).isEmpty():
        told, blocks = _signed_regions(written(signed.where(F.col("m") > SIGNED_MEMBERS).drop("m"), "signed-large"), percent)
        within, pairs = within.union(blocks), [told]
    batches = max(1, -(-(signed.agg(F.sum(F.length("data"))).first()[0] or 0) // SIGNED_BYTES))
    pairs = [*pairs, within.groupBy(F.pmod(F.xxhash64("region"), F.lit(batches))).applyInPandas(_plausible_links(percent), "a long, b long")]
    groups = written(connected_components(functools.reduce(DataFrame.union, pairs)).select(F.col("node").alias("c"), F.col("root").alias("region")), "groups")
    drop_written(signed)
    return groups


# --- the join of groups by pivot documents ------------------------------------------------------------------


class Members:
    """Sets of one region as rows of codes (elements numbered densely)."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, masks: np.ndarray, lens: np.ndarray, flat: np.ndarray, codes: int):
        self.keys, self.sizes, self.masks, self.lens, self.flat = keys, sizes, masks, lens, flat
        self.ends = np.cumsum(lens)
        self.starts = self.ends - lens
        self.mark = np.zeros(codes, np.int32)

    def row(self, i: int) -> np.ndarray:
        return self.flat[self.starts[i] : self.ends[i]]

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Where the elements of the rows stand, row after row."""
        lens = self.lens[rows]
        ends = np.cumsum(lens)
        return np.repeat(self.starts[rows] - (ends - lens), lens) + np.arange(int(ends[-1]) if len(ends) else 0)

    def shared(self, own: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """How many of the elements ``own`` each row (all by default) holds."""
        self.mark[own] = 1
        lens = self.lens if rows is None else self.lens[rows]
        at = np.concatenate([[0], np.cumsum(self.mark[self.flat if rows is None else self.flat[self.places(rows)]], dtype=np.int64)])
        self.mark[own] = 0
        ends = np.cumsum(lens)
        return at[ends] - at[ends - lens]

    def differing(self, own: np.ndarray) -> np.ndarray:
        """The size of the symmetric difference of each row and ``own``."""
        return self.lens + len(own) - 2 * self.shared(own)

    def relative(self, own: np.ndarray, rows: np.ndarray) -> Members:
        """The rows as their symmetric differences from ``own``."""
        place = np.full(len(self.mark), -1, np.int64)
        place[own] = np.arange(len(own))
        flat, row = self.flat[self.places(rows)], np.repeat(np.arange(len(rows)), self.lens[rows])
        at = place[flat]
        absent = np.ones((len(rows), len(own)), bool)
        absent[row[at >= 0], at[at >= 0]] = False
        row, flat = row[at < 0], flat[at < 0]
        lost, which = np.nonzero(absent)
        row, flat = np.concatenate([row, lost]), np.concatenate([flat, own[which]])
        flat = flat[np.argsort(row, kind="stable")]
        return Members(self.keys[rows], self.sizes[rows], self.masks[rows], np.bincount(row, minlength=len(rows)), flat, len(self.mark))


def _metric(differing: np.ndarray, sizes: np.ndarray, size: int) -> np.ndarray:
    """Jaccard distance from sizes and the size of the symmetric difference."""
    return 2 * differing / np.maximum(sizes + size + differing, 1)


class Links:
    """Counts of links by member, and pairs that span the components found."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.counts, self.label = keys, np.zeros(len(keys), np.int64), np.arange(len(keys))
        self.spanning: list[tuple[int, int]] = []

    def add(self, i: int, others: np.ndarray) -> None:
        self.counts[i] += len(others)
        self.counts[others] += 1
        new = others[self.label[others] != self.label[i]]
        if len(new):
            labels, one = np.unique(self.label[new], return_index=True)
            self.spanning += [(int(self.keys[i]), int(self.keys[j])) for j in new[one]]
            self.label[np.isin(self.label, labels)] = self.label[i]


def _join_ball(m: Members, index: np.ndarray, core: int, percent: int, links: Links) -> None:
    """Links of the first ``core`` rows with all rows after them; rows are kept as differences from one pivot."""
    far, near = 100 + percent, 100 - percent
    for i in range(core):
        j = np.arange(i + 1, len(index))
        j = j[(m.masks[j] & m.masks[i]) == 0]
        most = near * (m.sizes[j] + m.sizes[i])
        may = far * np.abs(m.lens[j] - m.lens[i]) <= most
        j, most = j[may], most[may]
        sure = far * (m.lens[j] + m.lens[i]) <= most
        if not sure.all():
            test = np.flatnonzero(~sure)
            differing = m.lens[j[test]] + m.lens[i] - 2 * m.shared(m.row(i), j[test])
            sure[test] = far * differing <= most[test]
        if sure.any():
            links.add(int(index[i]), index[j[sure]])


def join_members(m: Members, percent: int) -> Links:
    """All links in one region that fits a task: Voronoi regions of pivots that cover it, each with its window."""
    radius, links = 1 - percent / 100, Links(m.keys)
    nearest, home = np.full(len(m.keys), np.inf), np.full(len(m.keys), -1)
    near: list[tuple[int, np.ndarray, np.ndarray]] = []
    for x in np.argsort(mix(m.keys.view(np.uint64)), kind="stable").tolist():
        if nearest[x] > 2 * radius + EDGE:
            d = _metric(m.differing(m.row(x)), m.sizes, int(m.sizes[x]))
            closer = d < nearest
            home[closer], nearest[closer] = len(near), d[closer]
            rows = np.flatnonzero(d <= 3 * radius + EDGE)
            near.append((x, rows, d[rows]))
    for k, (x, rows, d) in enumerate(near):
        core = rows[home[rows] == k]
        window = rows[(home[rows] > k) & (d <= nearest[rows] + 2 * radius + EDGE)]
        if len(core) + len(window) > 1:
            index = np.concatenate([core, window])
            _join_ball(m.relative(m.row(x), index), index, len(core), percent, links)
    return links


def _members(rows: pd.DataFrame, more: list[bytes] | None = None) -> tuple[Members, np.ndarray, list[np.ndarray]]:
    """Rows as members, what each code stands for, and the codes of further sets."""
    sets = [np.frombuffer(x, np.uint64) for x in [*rows["delta"], *(more or [])]]
    values, flat = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_inverse=True)
    lens = np.fromiter(map(len, sets), np.int64, len(sets))
    cut = np.split(flat, np.cumsum(lens)[:-1])
    n = len(rows)
    own = int(lens[:n].sum())
    return Members(rows["c"].to_numpy(np.int64), rows["size"].to_numpy(np.int64), rows["mask"].to_numpy(np.int64), lens[:n], flat[:own], len(values)), values, cut[n:]


def _join_batch(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """a, n (links of a member), and a, b (links that span) of a batch of regions."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int | None, int | None]] = []
        for _, part in rows.groupby("region", sort=False):
            if len(part) > 1:
                links = join_members(_members(part)[0], percent)
                out += [(a, b, None) for a, b in links.spanning]
                held = np.flatnonzero(links.counts)
                out += [(a, None, n) for a, n in zip(links.keys[held].tolist(), links.counts[held].tolist(), strict=True)]
        return pd.DataFrame({k: pd.Series([r[i] for r in out], dtype="Int64") for i, k in enumerate(("a", "b", "n"))})

    return join


def _split_regions(large: DataFrame, parts: DataFrame, percent: int, level: int, limit: int) -> DataFrame:
    """The members of large regions in the regions of their pivots, one level down.

    Pivots are members of least hash that stand apart, up to ``limit`` shingles. They travel once to each slice
    of their region.
    """
    radius, bit = 1 - percent / 100, 1 << level
    bucket = F.pmod(F.xxhash64("c", "region"), F.lit(CANDIDATES))
    first = large.groupBy("region", bucket.alias("k")).agg(F.min_by(F.struct("c", "size", "delta", "mask"), F.xxhash64("c", F.lit(level))).alias("p"))

    def pick(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        rows = rows[(rows["delta"].map(len) // 8 + 1).cumsum().between(0, limit) | (np.arange(len(rows)) == 0)]
        m, _, _ = _members(rows)
        d = np.stack([_metric(m.differing(m.row(i)), m.sizes, int(m.sizes[i])) for i in range(len(rows))])
        return rows.iloc[_separated([], list(range(len(rows))), lambda i, j: float(d[i, j]), 2 * radius)][["region", "c", "size", "delta"]]

    pivots = written(first.select("region", "k", "p.*").groupBy("region").applyInPandas(pick, "region long, c long, size long, delta binary"), "pivots")
    sent = pivots.join(parts.select("region", F.col("parts").alias("slices")), "region").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    sent = sent.select(F.col("region").alias("of"), "slice", "c", "size", "delta")
    rows = large.join(parts, "region").withColumn("slice", F.pmod(F.xxhash64("c", F.lit(-1)), "parts"))

    def assign(members: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = [pd.DataFrame({k: pd.Series([], dtype=object) for k in ("region", "k", "c", "size", "delta", "mask", "was")})]
        if len(members) and len(pivots):
            pivots = pivots.sort_values("c")
            m, values, own = _members(members, pivots["delta"].tolist())
            d = np.stack([_metric(m.differing(p), m.sizes, int(s)) for p, s in zip(own, pivots["size"], strict=True)], axis=1)
            home, replica = _homes(d, percent)
            for k in range(d.shape[1] + 1):
                rows = np.flatnonzero(home == k) if k == d.shape[1] else np.flatnonzero((home == k) | replica[:, k])
                if len(rows):
                    part = m.relative(own[k] if k < len(own) else np.empty(0, np.int64), rows)
                    delta = [values[part.row(i)].tobytes() for i in range(len(rows))]
                    mask = part.masks | np.where(home[rows] == k, 0, bit)
                    out.append(pd.DataFrame({"region": members["region"].iloc[0], "k": k, "c": part.keys, "size": part.sizes, "delta": delta, "mask": mask, "was": members["total"].to_numpy()[rows]}))
        return pd.concat(out)

    split = rows.groupBy("region", "slice").cogroup(sent.groupBy("of", "slice")).applyInPandas(assign, "region long, k long, c long, size long, delta binary, mask long, was long")
    return split.select(F.xxhash64("region", "k", F.lit(level)).alias("region"), "c", "size", "delta", "mask", "was")


def _block_pairs(stuck: DataFrame) -> DataFrame:
    """Members of regions (with ``parts``) once for each pair of blocks: every pair of members meets in one region."""
    blocks = F.col("parts") * 2
    rows = stuck.withColumn("block", F.pmod(F.xxhash64("c", F.lit(3)), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    own = F.when(F.col("block") < F.col("other"), F.lit(BLOCK_BITS[0])).when(F.col("block") > F.col("other"), F.lit(BLOCK_BITS[1])).otherwise(F.lit(0)).cast("long")
    return rows.select(F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other")).alias("region"), "c", "size", "delta", F.col("mask").bitwiseOR(own).alias("mask"), "was")


def join_regions(members: DataFrame, percent: int, limit: int = REGION_SHINGLES, most: int = REGION_MEMBERS) -> DataFrame:
    """a, b, n: links (a, b) that span the components of the members of regions, and the numbers n of links of members a.

    ``members`` has the columns of MEMBERS, ``delta`` being a sorted set.
    """
    found, level, now = [], 0, members
    schema = "a long, b long, n long"
    while True:
        weight = F.length("delta") / 8 + MEMBER_SHINGLES
        sizes = now.groupBy("region").agg(F.sum(weight).cast("long").alias("total"), F.count("*").alias("m"), F.max("was").alias("before"))
        parts = F.greatest(F.ceil(F.col("total") / limit), F.ceil(F.col("m") / most)).cast("long")
        sizes = written(sizes.withColumn("parts", parts), "region-sizes")
        batches = max(1, -(-(sizes.where("parts = 1").agg(F.sum("total")).first()[0] or 0) // limit))
        batch = F.pmod(F.xxhash64("region"), F.lit(batches))
        small = now.join(sizes.where("parts = 1 AND m > 1").select("region"), "region")
        found.append(written(small.groupBy(batch).applyInPandas(_join_batch(percent), schema), "found"))
        large = sizes.where("parts > 1")
        if large.isEmpty():
            return functools.reduce(DataFrame.union, found)
        stuck = (F.col("before") > 0) & (F.col("total") > STUCK * F.col("before")) | F.lit(level >= 60)
        blocks = now.join(large.where(stuck).select("region", "parts"), "region")
        found.append(written(_block_pairs(blocks).groupBy("region").applyInPandas(_join_batch(percent), schema), "found"))
        level += 1
        old, now = now, written(_split_regions(now, large.where(~stuck).select("region", "parts", "total"), percent, level, limit), "members")
        drop_written(old)


#: A mask of classes of sizes, turned by one class either way.
_TURNED = f"((shiftleft(mask, 1) | shiftrightunsigned(mask, {SIZE_BITS - 1})) & {(1 << SIZE_BITS) - 1})"
_TURNED_BACK = f"((shiftrightunsigned(mask, 1) | shiftleft(mask, {SIZE_BITS - 1})) & {(1 << SIZE_BITS) - 1})"


#: A set stays in a region where another is of its class of sizes, or of one beside it.
_NEAR_SIZE = f"n > bit_count(mask) OR (bit & {_TURNED}) <> 0 OR (bit & {_TURNED_BACK}) <> 0"


def _well_shared(entered: DataFrame, percent: int) -> DataFrame:
    """entered (region, c, size) without the sets that are in fewer regions than any partner of theirs would share with them, and without regions that this leaves to one set."""
    # a partner may be smaller, and a small set's window holds fewer shingles
    partner = F.ceil(F.col("size") * percent / 100)
    need = F.least(F.lit(LEAST_SHARED), F.ceil(partner * percent / 100))
    for _ in range(SHARED_ROUNDS):
        old = entered
        held = old.groupBy("c", "size").agg(F.count("*").alias("regions")).where(F.col("regions") >= need).select("c")
        left = old.join(held, "c", "left_semi").withColumn("bit", _size_bit(F.col("size"), percent))
        near = left.groupBy("region").agg(F.bit_or("bit").alias("mask"), F.count("*").alias("n")).where("n > 1")
        entered = written(left.join(near, "region").where(_NEAR_SIZE).select("region", "c", "size"), "entered")
        drop_written(old)
    return entered


def _size_class(size: Column, percent: int) -> Column:
    """Sets whose sizes allow a link are of one class, or of two that follow each other."""
    step = float(np.log(100 / percent * 1.0001)) if percent < 100 else 1e-4
    return F.floor(F.log(size.cast("double")) / step)


def _size_bit(size: Column, percent: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(_size_class(size, percent), F.lit(SIZE_BITS)).cast("int"))


def _of_classes(docs: DataFrame, classes: DataFrame, n: int, make: Callable[[np.ndarray], bytes]) -> DataFrame:
    """c, size, data: what ``make`` makes of the set of each class, from the rows of docs (doc_id, text) with the class's id."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    wanted = written(classes.select("c", "size", "a", "b", F.col("class_id").alias("doc_id")), "wanted")
    sought = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted.select(bit.alias("i")).distinct(), FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(sought.value, batch.column("i").to_numpy())))
            out = [(*set_key(x), make(x)) for x in shingle_sets(_texts(batch), n)]
            columns = [batch.column("doc_id"), *(pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary())))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a", "b", "data"])

    made = docs.withColumn("i", bit).mapInArrow(tidy(run), "doc_id long, a long, b long, data binary")
    # rows of one id and one text: any of them
    return made.join(wanted, ["doc_id", "a", "b"]).groupBy("c", "size").agg(F.first("data").alias("data"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, limit: int = REGION_SHINGLES, most: int = REGION_MEMBERS) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, n_links for each row of docs (doc_id, text).

    Documents link whose sets of n-word shingles have a Jaccard similarity of ``percent`` or more. A class
    holds the documents of one set and is named by its smallest id, a component by the smallest id in it;
    n_links counts the other classes that a document's class links to.
    """
    spark = docs.sparkSession
    relieve()
    described = written(describe(docs, n), "described")
    rows = described.where("kind = 0").select("doc_id", "size", "a", "b")
    classes = rows.where("size > 0").groupBy("a", "b", "size").agg(F.min("doc_id").alias("class_id"))
    classes = written(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    # a set that only rows without an id have could not name a component: it takes no part
    read = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    entered = written(windows(read, n, percent, sketch_of(described)), "windows")
    entered = entered.withColumn("bit", _size_bit(F.col("size"), percent))
    # regions that two sets of near sizes enter at least, or copies in several tasks
    shared = entered.groupBy("pivot").agg(F.bit_or("bit").alias("mask"), F.count("*").alias("n"))
    shared = written(shared.where(f"n > 1 AND (n > bit_count(mask) OR (mask & {_TURNED}) <> 0)"), "shared")
    low = f"pivot & {(1 << PIVOT_BITS) - 1}"
    marked = spark.sparkContext.broadcast(bitmap_of(shared.select(F.expr(low).alias("i")).distinct(), PIVOT_BITS))
    relieve()

    def pass_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(marked.value, low_bits(batch.column("pivot").to_numpy().view(np.uint64), PIVOT_BITS))))

    several = entered.mapInArrow(tidy(pass_shared), entered.schema).join(shared, "pivot").where(_NEAR_SIZE).select("pivot", "a", "b", "size").distinct()
    several = written(several.join(classes.select("a", "b", "size", "c"), ["a", "b", "size"]).select(F.col("pivot").alias("region"), "c", "size"), "entered")
    drop_written(entered)
    drop_written(shared)
    several = _well_shared(several, percent)
    kept = _distinct_regions(several)
    drop_written(several)
    signatures = _of_classes(read, classes.join(kept, "c", "left_semi"), n, lambda x: packed(signature(x)))
    groups = _candidate_groups(kept, signatures, percent)
    drop_written(kept)
    sets = _of_classes(read, classes.join(groups, "c", "left_semi"), n, lambda x: x.tobytes())
    members = groups.join(sets, "c").select("region", "c", "size", F.col("data").alias("delta"), F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("was"))
    members = written(members, "members")
    drop_written(groups)
    found = written(join_regions(members, percent, limit, most), "links")
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("c")).agg(F.sum("n").alias("n_links"))
    roots = connected_components(found.where("b IS NOT NULL").select("a", "b")).select(F.col("node").alias("c"), "root")
    linked = written(classes.select("c", "class_id").join(roots, "c").join(counts, "c", "left"), "linked")
    least = linked.groupBy("root").agg(F.min("class_id").alias("component_id"))
    linked = linked.join(least, "root").select("c", "component_id", "n_links")
    named = written(classes.select("c", "a", "b", "size", "class_id").join(linked, "c", "left"), "components")
    out = rows.alias("r").join(named.alias("c"), (F.col("r.a") == F.col("c.a")) & (F.col("r.b") == F.col("c.b")) & (F.col("r.size") == F.col("c.size")), "left")
    own = F.when(F.col("r.size") == 0, F.col("r.doc_id"))
    links = F.coalesce("c.n_links", F.lit(0)).alias("n_links")
    return out.select("r.doc_id", F.col("r.size").alias("n_shingles"), F.coalesce("c.class_id", own).alias("class_id"), F.coalesce("c.component_id", "c.class_id", own).alias("component_id"), links)
