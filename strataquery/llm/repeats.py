"""Suffix-array dedup: every byte inside a string of ``length`` bytes that also starts elsewhere goes.

Which suffixes need sorting. In every window of ``length`` bytes the first of its least hashed ``GRAM``-byte
strings is its anchor; equal windows have equal anchors at equal places, so it is enough to compare the
surroundings of anchors. A count of anchor hashes (combined before the shuffle) leaves those that occur
twice; a bitmap of fixed size carries them to the second pass, where it may let more pass but never fewer.

The sort. Each task sorts the suffixes that begin at its anchors, cut to what its windows need, into runs;
equal ones with equal left sides are one item with a count. Runs are cut at sampled splitters and exchanged
front-coded: a length of common prefix with the predecessor, and the rest. Ranges are shared out further by
the anchors' hashes where splitters alone would leave them too large. A range's runs are combined with
a loser tree whose players keep the length of the prefix that they share with the last winner: a longer one
wins without a look at a byte, and equal ones are compared from there on. More runs than ``FAN_IN`` are
combined in rounds. The result is the sorted order with the lengths of common prefixes (LCP).

The answer. A window that starts o bytes left of its anchor occurs twice where two items share length - o
bytes to the right (a class of the LCP array) and o bytes to the left (a class of the left sides, sorted in
the group). An anchor so frequent that its group would not fit a task is exchanged as single windows, dealt
by their content: equal ones collapse in each run, others part.

Defined cases: null and empty texts have nothing to remove; matches never cross rows; a repeated row is
another place, so its strings go in both; null ids are kept; an empty table gives no rows. Rows are named by
id and text, so docs may give them in other partitions when read again.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import about, bitmap_of, in_bitmap, low_bits, slices, tidy, written
from .shingles import _bytes_of, _powers, mix, running_hash

LENGTH = 200
GRAM = 50
BITMAP_BITS = 26
#: Items of a run in memory, runs that one loser tree combines, items of a range, about.
RUN_ITEMS = 100_000
FAN_IN = 128
RANGE_ITEMS = 25_000
SPLITTER_SAMPLE = 8192
#: Anchors that occur more often are exchanged as single windows.
HOT = 200_000


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """For each anchor of the texts: text, at (its place in data), lo and hi (the first and last start of windows that it is the anchor of), hash."""
    g = running_hash(data)
    _, inverse = _powers(max(1, len(data)))
    h = mix((g[gram:] - g[: len(g) - gram]) * inverse[: max(0, len(g) - gram)]) if len(data) >= gram else np.empty(0, np.uint64)
    per = length - gram + 1
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("text", "at", "lo", "hi")}
    for t, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        n = b - a - length + 1
        if n < 1:
            continue
        m = b - a - gram + 1
        # the order of grams: the upper half of the hash, then the place; so the first of equal ones is least
        key = (h[a : a + m] & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
        full = np.full(-(-m // per) * per, np.uint64((1 << 64) - 1))
        full[:m] = key
        full = full.reshape(-1, per)
        before = np.minimum.accumulate(full, 1).ravel()
        after = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(after[:n], before[per - 1 : per - 1 + n])
        lo = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        out["at"].append((least[lo] & np.uint64(0xFFFFFFFF)).astype(np.int64) + a)
        out["lo"].append(lo + a)
        out["hi"].append(np.r_[lo[1:], n] - 1 + a)
        out["text"].append(np.full(len(lo), t))
    done = {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in out.items()}
    return done | {"hash": h[done["at"]]}


def _arrow_texts(batch: pa.RecordBatch) -> pa.StringArray:
    return pc.fill_null(batch.column("text"), "").cast(pa.string())


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, text, and what names a row in every evaluation of docs: its id and a hash of its text. Rows that agree in both have the same repeats."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("of"))


def _codes(rows: np.ndarray, lens: np.ndarray | None = None) -> np.ndarray:
    """Rows of a byte matrix as fixed-length strings, for sorting; of rows that differ by the padding alone the shorter comes first."""
    if lens is not None:
        rows = np.concatenate([rows, lens.astype(">u2").view(np.uint8).reshape(-1, 2)], 1)
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def _common(rows: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The length of the prefix that each row shares with the one before."""
    out = np.zeros(len(rows), np.int64)
    for a in range(1, len(rows), 50_000):
        differ = rows[a : a + 50_000] != rows[a - 1 : a - 1 + len(rows[a : a + 50_000])]
        first = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        out[a : a + 50_000] = np.minimum(first, np.minimum(lens[a : a + 50_000], lens[a - 1 : a - 1 + len(first)]))
    return out


def _front_code(rows: np.ndarray, lens: np.ndarray, common: np.ndarray) -> bytes:
    at = np.arange(rows.shape[1])
    return rows[(at >= common[:, None]) & (at < lens[:, None])].tobytes()


def _unfold(data: bytes, lens: np.ndarray, common: np.ndarray) -> list[bytes]:
    out, at, last = [], 0, b""
    for n, c in zip(lens.tolist(), common.tolist(), strict=True):
        last = last[:c] + data[at : at + n - c]
        at += n - c
        out.append(last)
    return out


class RunBuilder:
    """Gathers the surroundings of anchors and gives them out as sorted, front-coded runs."""

    def __init__(self, length: int, gram: int, splitters: np.ndarray, hot: np.ndarray, hot_bits: int, shares: int):
        self.length, self.reach, self.gram = length, length - gram, gram
        self.splitters, self.hot, self.hot_bits, self.shares = splitters, hot, hot_bits, shares
        self.parts = (len(splitters) + 1) * shares
        self.rows: list[dict[str, np.ndarray]] = []
        self.n = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, found: dict[str, np.ndarray], row_ids: np.ndarray, of: np.ndarray) -> None:
        o_max, o_min = found["at"] - found["lo"], found["at"] - found["hi"]
        hot = in_bitmap(self.hot, low_bits(found["hash"], self.hot_bits))
        if hot.any():
            # one item a window
            each = np.where(hot, o_max - o_min + 1, 1)
            pick = np.repeat(np.arange(len(hot)), each)
            step = np.arange(len(pick)) - np.repeat(np.cumsum(each) - each, each)
            found = {k: v[pick] for k, v in found.items()}
            o_max, o_min, hot = o_max[pick], o_min[pick], hot[pick]
            o_min = np.where(hot, o_min + step, o_min)
            o_max = np.where(hot, o_min, o_max)
        for a in range(0, len(hot), 20_000):
            s = slice(a, a + 20_000)
            at, left, right = found["at"][s], o_max[s], self.length - o_min[s]
            grid = np.arange(self.length)
            r = np.where(grid < right[:, None], data[np.minimum(at[:, None] + grid, len(data) - 1)], 0).astype(np.uint8)
            grid = np.arange(self.reach)
            l = np.where(grid < left[:, None], data[np.maximum(at[:, None] - 1 - grid, 0)], 0).astype(np.uint8)  # noqa: E741
            self.rows.append({"r": r, "l": l, "right": right, "left": left, "o_min": o_min[s], "hot": hot[s], "hash": found["hash"][s], "row": row_ids[found["text"][s]], "of": of[found["text"][s]], "at": at - offsets[found["text"][s]]})
            self.n += len(at)

    def flush(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(part, items, places) of one run. Items of a part are sorted by right side, then left side."""
        if not self.n:
            return
        x = {k: np.concatenate([r[k] for r in self.rows]) for k in self.rows[0]}
        self.rows, self.n = [], 0
        ends = [x[side].astype(">u2").view(np.uint8).reshape(-1, 2) for side in ("right", "left")]
        order = np.argsort(_codes(np.concatenate([x["r"], ends[0], x["l"], ends[1]], 1)), kind="stable")
        order = order[np.argsort(x["hot"][order], kind="stable")]
        x = {k: v[order] for k, v in x.items()}
        same = np.zeros(len(order), bool)
        same[1:] = (x["right"][1:] == x["right"][:-1]) & (x["left"][1:] == x["left"][:-1]) & (x["hot"][1:] == x["hot"][:-1]) & (x["r"][1:] == x["r"][:-1]).all(1) & (x["l"][1:] == x["l"][:-1]).all(1)
        first = np.flatnonzero(~same)
        count = np.diff(np.r_[first, len(order)])
        # a range of more items than a task takes is shared out by the anchor's hash: items that may repeat each other have one
        part = np.searchsorted(self.splitters, _codes(x["r"][first][:, : self.gram]), side="right") * self.shares + ((x["hash"][first] >> np.uint64(8)) % np.uint64(self.shares)).astype(np.int64)
        hot = x["hot"][first]
        if hot.any():
            codes = [hashlib.blake2b(r.tobytes() + b"|" + l.tobytes(), digest_size=8).digest() for r, l in zip(x["r"][first][hot], x["l"][first][hot], strict=True)]
            part[hot] = self.parts + np.frombuffer(b"".join(codes), np.uint64).astype(np.int64) % self.parts
        by_part = np.argsort(part, kind="stable")
        for p in np.unique(part):
            mine = by_part[np.searchsorted(part[by_part], p) : np.searchsorted(part[by_part], p, side="right")]
            i = first[mine]
            r, l, right, left = x["r"][i], x["l"][i], x["right"][i], x["left"][i]  # noqa: E741
            common, common_l = _common(r, right), _common(l, left)
            items = {"right": right.astype(np.int16), "left": left.astype(np.int16), "o_min": x["o_min"][i].astype(np.int16), "common": common.astype(np.int16), "common_l": common_l.astype(np.int16), "r": _front_code(r, right, common), "l": _front_code(l, left, common_l), "twice": count[mine] > 1}
            spots = np.repeat(i, count[mine]) + np.arange(int(count[mine].sum())) - np.repeat(np.cumsum(count[mine]) - count[mine], count[mine])
            places = {"count": count[mine], "row": x["row"][spots], "of": x["of"][spots], "at": x["at"][spots]}
            yield int(p), pickle.dumps(items, 5), pickle.dumps(places, 5)


def _shared(a: bytes, b: bytes, h: int) -> int:
    """The length of the common prefix of a and b, which share h bytes at least."""
    n = min(len(a), len(b))
    while h < n:
        x, y = a[h : h + 48], b[h : h + 48]
        if x != y:
            m = min(len(x), len(y))
            d = int.from_bytes(x[:m], "big") ^ int.from_bytes(y[:m], "big")
            return h + m - (d.bit_length() + 7) // 8 if d else h + m
        h += len(x)
    return n


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Combines sorted runs (strings, lengths of the prefix common with the predecessor) with a loser tree.

    Returns, in sorted order, the run and the place in it of each string, and the length of the prefix that
    it has in common with the one before. A player that shares more with the last winner is smaller; bytes
    are compared only between equals, from the known length on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    end = None
    strings = [r[0] for r in runs] + [[]] * (k - len(runs))
    commons = [r[1] for r in runs] + [[]] * (k - len(runs))
    place = [0] * k
    head: list[bytes | None] = [s[0] if s else end for s in strings]
    known = [0] * k  # what the head of each run shares with the last winner
    loser = [0] * k

    def play(a: int, b: int) -> int:
        """The winner of two runs; the loser then knows what it shares with the winner."""
        x, y = head[a], head[b]
        if y is None:
            return a
        if x is None:
            return b
        if known[a] != known[b]:
            return a if known[a] > known[b] else b
        h = _shared(x, y, known[a])
        if h == len(x) or h < len(y) and x[h] < y[h]:
            known[b] = h
            return a
        known[a] = h
        return b

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = build(2 * node), build(2 * node + 1)
        w = play(a, b)
        loser[node] = b if w == a else a
        return w

    w = build(1) if k > 1 else 0
    run_of, at, lcp = [], [], []
    while head[w] is not None:
        run_of.append(w)
        at.append(place[w])
        lcp.append(known[w])
        place[w] += 1
        i = place[w]
        if i < len(strings[w]):
            head[w], known[w] = strings[w][i], commons[w][i]
        else:
            head[w] = end
        node = (w + k) // 2
        while node:
            other = loser[node]
            won = play(w, other)
            if won != w:
                loser[node], w = w, won
            node //= 2
    return run_of, at, lcp


def _padded(strings: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width) if width else np.zeros((len(strings), 0), np.uint8)


def repeated_offsets(lcp: np.ndarray, left: list[bytes], right_len: np.ndarray, left_len: np.ndarray, o_min: np.ndarray, twice: np.ndarray, length: int, gram: int) -> np.ndarray:
    """(items, length - gram + 1): whether the window that starts o bytes left of the anchor occurs elsewhere. Items are in sorted order."""
    n, reach = len(lcp), length - gram
    out = np.zeros((n, reach + 1), bool)
    group = np.cumsum(np.r_[True, lcp[1:] < gram]) - 1 if n else np.empty(0, np.int64)
    size = np.bincount(group, minlength=1)[group] if n else group
    live = np.flatnonzero((size > 1) | twice)
    if not len(live):
        return out
    group, o_lo, o_hi, double = group[live], o_min[live], left_len[live], twice[live]
    # what an item shares with the live one before: groups are live as a whole or single
    r_common = lcp[live].copy()
    r_common[np.r_[True, group[1:] != group[:-1]]] = 0
    sides = _padded([left[i] for i in live.tolist()], reach)
    order = np.argsort(_codes(sides, o_hi), kind="stable") if reach else np.arange(len(live))
    order = order[np.argsort(group[order], kind="stable")]
    l_common = _common(sides[order], o_hi[order])
    l_common[np.r_[True, group[order][1:] != group[order][:-1]]] = -1
    hits = np.zeros((len(live), reach + 1), bool)
    for o in range(reach + 1):
        at = np.flatnonzero((o_lo <= o) & (o <= o_hi))
        if not len(at):
            continue
        right = np.cumsum(r_common < length - o)[at]
        l_class = np.empty(len(live), np.int64)
        l_class[order] = np.cumsum(l_common < o)
        key = right * (len(live) + 1) + l_class[at]
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        weight = count + np.bincount(which, double[at], len(count)).astype(np.int64)
        hits[at, o] = weight[which] > 1
    out[live] = hits
    return out


def _resolve(length: int, gram: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def resolve(rows: pd.DataFrame) -> pd.DataFrame:
        items = [pickle.loads(x) for x in rows["items"]]
        order, cat = _merged(items)
        left = [_unfold(x["l"], x["left"], x["common_l"]) for x in items]
        lefts = [left[r][i] for r, i in zip(order["run"].tolist(), order["at"].tolist(), strict=True)]
        mask = repeated_offsets(order["lcp"], lefts, cat["right"], cat["left"], cat["o_min"], cat["twice"], length, gram)
        out = []
        for r, run in enumerate(rows["run"]):
            mine = order["run"] == r
            bits = np.empty((int(mine.sum()), mask.shape[1]), bool)
            bits[order["at"][mine]] = mask[mine]
            if bits.any():
                out.append((run, rows["part"].iloc[0], np.packbits(bits, axis=1).tobytes()))
        return pd.DataFrame(out, columns=["run", "part", "mask"]).astype({"run": np.int64, "part": np.int64})

    return resolve


def _merged(items: list[dict]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """The sorted order of the items of all runs, and their columns in it. More runs than FAN_IN are combined in rounds."""
    level = []
    for r, x in enumerate(items):
        level.append((_unfold(x["r"], x["right"], x["common"]), x["common"].tolist(), np.full(len(x["right"]), r), np.arange(len(x["right"]))))
    while True:
        following = []
        for a in range(0, len(level), FAN_IN):
            some = level[a : a + FAN_IN]
            run_of, at, lcp = merge_runs([(s, c) for s, c, _, _ in some])
            strings = [some[r][0][i] for r, i in zip(run_of, at, strict=True)] if len(level) > FAN_IN else []
            first = np.cumsum([0, *(len(s[2]) for s in some)])
            spot = first[np.array(run_of, np.int64)] + np.array(at, np.int64)
            following.append((strings, lcp, np.concatenate([s[2] for s in some])[spot], np.concatenate([s[3] for s in some])[spot]))
        level = following
        if len(level) == 1:
            break
    _, lcp, run_of, at = level[0]
    first = np.cumsum([0, *(len(x["right"]) for x in items)])
    spot = first[run_of] + at
    cat = {k: np.concatenate([x[k] for x in items])[spot] for k in ("right", "left", "o_min", "twice")}
    return {"run": run_of, "at": at, "lcp": np.array(lcp, np.int64)}, cat


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_count: int = HOT, run_items: int = RUN_ITEMS, range_items: int = RANGE_ITEMS) -> DataFrame:
    """row, of, starts, ends: byte ranges (they may overlap) of the rows named by _named(docs) that repeats cover."""
    spark = docs.sparkSession
    source = _named(docs).select("row", "of", "text")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _arrow_texts(batch)
            for a, b in slices(np.diff(_bytes_of(texts)[1])):
                data, offsets = _bytes_of(texts.slice(a, b - a))
                found = anchors(data, offsets, length, gram)
                # some starts of suffixes to draw splitters from, by hash: the same ones wherever they stand
                sample = np.flatnonzero(low_bits(found["hash"] >> np.uint64(32), 8) == 0)
                starts = [None] * len(found["at"])
                for i in sample.tolist():
                    starts[i] = data[found["at"][i] : found["at"][i] + gram].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(found["hash"].view(np.int64)), pa.array(starts, pa.binary())], ["hash", "start"])

    counted = source.select("text").mapInArrow(tidy(hashes), "hash long, start binary").groupBy("hash").agg(F.count("*").alias("n"), F.first("start", True).alias("start"))
    counted = written(counted.where("n > 1"), "anchors")
    bitmap = bitmap_of(counted.select(F.expr(f"hash & {(1 << BITMAP_BITS) - 1}").alias("i")).distinct(), BITMAP_BITS)
    hot_bits = 20
    hot = bitmap_of(counted.where(F.col("n") > hot_count).select(F.expr(f"hash & {(1 << hot_bits) - 1}").alias("i")).distinct(), hot_bits)
    total = counted.agg(F.sum("n")).first()[0] or 0
    ranges_wanted = max(1, -(-total // range_items))
    parts = min(SPLITTER_SAMPLE, ranges_wanted)
    shares = -(-ranges_wanted // parts)
    starts = counted.where("start IS NOT NULL").select("hash", "start")
    drawn = sorted(bytes(r["start"]) for r in starts.where(about(F.col("hash"), SPLITTER_SAMPLE, max(1, starts.count()))).collect())
    cuts = [drawn[len(drawn) * i // parts] for i in range(1, parts)] if drawn else []
    splitters = np.array(sorted(set(cuts)), f"S{gram}")
    sent = spark.sparkContext.broadcast((bitmap, hot, splitters))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked, hot_marked, cut = sent.value
        task, made = TaskContext.get().partitionId(), 0
        builder = RunBuilder(length, gram, cut, hot_marked, hot_bits, shares)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            for p, items, places in builder.flush():
                yield pa.RecordBatch.from_arrays([pa.array([(task << 24) + made]), pa.array([p]), pa.array([items], pa.binary()), pa.array([places], pa.binary())], ["run", "part", "items", "places"])
            made += 1

        for batch in batches:
            texts, row_ids, of = _arrow_texts(batch), batch.column("row").to_numpy(), batch.column("of").to_numpy()
            for a, b in slices(np.diff(_bytes_of(texts)[1])):
                data, offsets = _bytes_of(texts.slice(a, b - a))
                found = anchors(data, offsets, length, gram)
                keep = in_bitmap(marked, low_bits(found["hash"], BITMAP_BITS))
                if keep.any():
                    builder.add(data, offsets, {k: v[keep] for k, v in found.items()}, row_ids[a:b], of[a:b])
                if builder.n >= run_items:
                    yield from flush()
        yield from flush()

    made = written(source.mapInArrow(tidy(runs), "run long, part long, items binary, places binary"), "runs")
    masks = made.select("run", "part", "items").groupBy("part").applyInPandas(_resolve(length, gram), "run long, part long, mask binary")
    widths = -(-(length - gram + 1) // 8)

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x, packed in zip(batch["places"], batch["mask"], strict=True):
                places = pickle.loads(x)
                mask = np.unpackbits(np.frombuffer(packed, np.uint8).reshape(-1, widths), axis=1)[:, : length - gram + 1].astype(np.int8)
                edge = np.diff(np.pad(mask, ((0, 0), (1, 1))), axis=1)
                item, low = np.nonzero(edge == 1)
                high = np.nonzero(edge == -1)[1] - 1
                first = np.cumsum(places["count"]) - places["count"]
                n = places["count"][item]
                spot = np.repeat(first[item], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                at = places["at"][spot]
                yield pd.DataFrame({"row": places["row"][spot], "of": places["of"][spot], "start": at - np.repeat(high, n), "end": at - np.repeat(low, n) + length})

    covered = written(made.select("run", "part", "places").join(masks, ["run", "part"]).mapInPandas(ranges, "row long, of long, start long, end long"), "ranges")
    return covered.groupBy("row", "of").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_bytes: bool = False, **sizes: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs (doc_id, text), with the kept bytes on demand."""
    covered = repeated_ranges(docs, length, gram, **sizes)
    joined = _named(docs).join(covered, ["row", "of"], "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "").cast(pa.binary())
            rows = []
            for text, starts, ends in zip(texts, batch.column("starts"), batch.column("ends"), strict=True):
                data, kept, at, removed, spans = text.as_py(), [], 0, 0, 0
                if starts.is_valid:
                    for a, b in _union(starts.values.to_numpy(), ends.values.to_numpy()):
                        kept.append(data[at:a])
                        at, removed, spans = b, removed + b - a, spans + 1
                kept.append(data[at:])
                left = b"".join(kept)
                rows.append((len(data), removed, spans, hashlib.sha256(left).hexdigest(), left))
            columns = [*zip(*rows, strict=True)] or [[]] * 5
            arrays = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(columns[4], pa.binary())] * keep_bytes, names + ["kept"] * keep_bytes)

    return joined.select("doc_id", "text", "starts", "ends").mapInArrow(tidy(cut), schema)


def _union(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """The maximal runs of bytes that ranges cover; ranges that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    yield from zip(starts[first].tolist(), ends[np.r_[first[1:], len(starts)] - 1].tolist(), strict=True)
