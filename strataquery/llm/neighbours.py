"""Approximate nearest neighbours: an NN-descent graph, and greedy search over it.

Equal vectors are one node. Nodes stand in blocks of about ``block_rows``, dealt by a tree of random
hyperplanes that is fitted on a bounded sample of ``SAMPLE`` vectors; a leaf that outgrows a block is split
by hash. A block's state is one row: its vectors and the neighbour lists of its nodes. Every step is a Spark
join of block states with the messages sent to them, so no task holds more than a block and what its nodes
refer to, and nothing but counts reaches the driver.

The graph starts from the best neighbours within the leaves of several trees. A round of NN-descent joins
neighbours of neighbours: each block gathers the forward and backward neighbours of its nodes, asks their
blocks for vectors, compares the neighbours of each node with one another, and sends each the better ones.
A search starts from the lists of the query's own node, expands all new nodes of a beam, has the blocks of
the nodes reached score them, and ends when a beam has nothing new. The nearest found are scored again in
double precision on the original vectors.

Defined cases: rows whose id is null, or whose vector is null, empty, zero or holds a null or non-finite
component, or has another length than most (the longest of the commonest lengths), take no part; equal rows
are found through their node, smaller ids first; repeated rows of one id count as one; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import about, drop_written, written

#: Vectors that the trees are fitted on, about, and the fewest of them in a leaf.
SAMPLE = 16_384
LEAST_IN_LEAF = 8
BLOCK_ROWS = 2000
TREES = 4
NEIGHBOURS = 40
#: Best matches that a local join passes on for each neighbour of a node.
PASSED_ON = 12
ROUNDS = 4
BEAM = 96
SEED = 11

MESSAGE = "block long, payload binary"


def _key(block: np.ndarray | int, slot: np.ndarray) -> np.ndarray:
    return (np.asarray(block, np.int64) << 32) | slot.astype(np.int64)


def _messages(to: np.ndarray, /, **columns: np.ndarray) -> list[tuple[int, bytes]]:
    """A message to each block in ``to``: the rows of the columns for it."""
    if not len(to):
        return []
    order = np.argsort(to, kind="stable")
    blocks, first = np.unique(to[order], return_index=True)
    return [(int(b), pickle.dumps({k: v[rows] for k, v in columns.items()}, 5)) for b, rows in zip(blocks, np.split(order, first[1:]), strict=True)]


def _frame(rows: list[tuple[int, bytes]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["block", "payload"]).astype({"block": np.int64})


def _received(messages: pd.DataFrame, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The rows of all messages, one after the other; without any, empty arrays as in ``like``."""
    got = [pickle.loads(m) for m in messages["payload"]]
    return {k: np.concatenate([g[k] for g in got]) if got else empty for k, empty in like.items()}


PAIRS = {"to": np.empty(0, np.int64), "other": np.empty(0, np.int64), "sim": np.empty(0, np.float32)}


def _best(to: np.ndarray, other: np.ndarray, sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k most similar others of each node, without repetition, sorted by node and similarity."""
    order = np.lexsort((other, -sim, to))
    to, other, sim = to[order], other[order], sim[order]
    # of equal pairs the similarities are equal up to rounding: keep the first of each
    again = np.lexsort((np.arange(len(to)), other, to))
    keep = np.ones(len(to), bool)
    keep[again[1:]] = (to[again][1:] != to[again][:-1]) | (other[again][1:] != other[again][:-1])
    to, other, sim = to[keep], other[keep], sim[keep]
    starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.empty(0, np.int64)
    rank = np.arange(len(to)) - np.repeat(starts, np.diff(np.r_[starts, len(to)]))
    return to[rank < k], other[rank < k], sim[rank < k]


class Trees:
    """Random hyperplane trees: each split sends a vector by its difference from two sample vectors, at the sample's median."""

    def __init__(self, sample: np.ndarray, rows: int, trees: int, block_rows: int, seed: int):
        rng = np.random.default_rng(seed)
        depth = 0
        while rows >> depth > block_rows and len(sample) >> (depth + 1) >= LEAST_IN_LEAF:
            depth += 1
        self.depth, self.trees = depth, []
        for _ in range(trees):
            planes, cuts, parts = [], [], [np.arange(len(sample))]
            for _ in range(depth):
                level = []
                for part in parts:
                    a, b = sample[rng.choice(part, 2, replace=len(part) < 2)] if len(part) else sample[:2]
                    s = sample[part] @ (a - b)
                    cut = np.median(s) if len(s) else 0.0
                    planes.append(a - b)
                    cuts.append(cut)
                    level += [part[s <= cut], part[s > cut]]
                parts = level
            self.trees.append((np.array(planes, np.float32), np.array(cuts, np.float32)))

    def leaves(self, units: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each vector in each tree."""
        out = np.zeros((len(units), len(self.trees)), np.int64)
        for t, (planes, cuts) in enumerate(self.trees):
            node = np.zeros(len(units), np.int64)
            for level in range(self.depth):
                at = (1 << level) - 1 + node
                right = np.einsum("ij,ij->i", units, planes[at]) > cuts[at]
                node = node * 2 + right
            out[:, t] = node
        return out


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and vec (array<double>) of the rows that take part; shorter vectors are filled up with zeros."""
    vec = F.col(vec_col).cast("array<double>")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where(F.col("vec_id").isNotNull() & fine)
    longest = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    return rows.select("vec_id", F.when(F.size("vec") == longest, F.col("vec")).otherwise(F.concat("vec", F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("vec")))).alias("vec"))


def _near_one(vec: Column) -> Column:
    """The vector times the power of two that brings its largest component near 1: no rounding, and no sum of squares leaves the range of doubles."""
    exponent = F.floor(F.log2(F.array_max(F.transform(vec, F.abs))))
    power = F.pow(F.lit(2.0), F.greatest(F.lit(-1000), F.least(F.lit(1000), -exponent)).cast("double"))
    return F.transform(vec, lambda x: x * power)


def _units(payload: pd.Series) -> np.ndarray:
    x = np.stack(payload.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


class NeighbourGraph:
    """The states of all blocks: keys, ids, units, and near and near_sim, a row of neighbours for each node (-1 where there are fewer)."""

    def __init__(self, rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = NEIGHBOURS, rounds: int = ROUNDS, trees: int = TREES, block_rows: int = BLOCK_ROWS, seed: int = SEED):
        self.k = k
        self.rows = written(usable(rows, id_col, vec_col), "vectors")
        # the smallest id stands for all rows of one vector
        nodes = written(self.rows.groupBy("vec").agg(F.min("vec_id").alias("node_id")), "nodes")
        self.nodes = nodes
        n = nodes.count()
        sample = nodes.where(about(F.col("node_id"), SAMPLE, max(1, n))).orderBy("node_id").select("vec").toPandas()
        self.states = None
        if not n:
            return
        fitted = Trees(_units(sample["vec"]), n, trees, block_rows, seed)
        sent = rows.sparkSession.sparkContext.broadcast(fitted)

        def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                units = _units(batch["vec"])
                yield pd.DataFrame({"node_id": batch["node_id"], "unit": [u.tobytes() for u in units], "leaves": [*sent.value.leaves(units)]})

        dealt = written(nodes.mapInPandas(leaves, "node_id long, unit binary, leaves array<long>"), "leaves")
        # a leaf of more than block_rows nodes becomes several blocks
        parts = dealt.groupBy(F.col("leaves")[0].alias("leaf")).agg(F.ceil(F.count("*") / (2 * block_rows)).cast("long").alias("parts"))
        blocks = dealt.join(parts, F.col("leaves")[0] == F.col("leaf")).withColumn("block", F.col("leaf") * 65536 + F.expr("pmod(xxhash64(node_id), parts)"))

        def number(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("node_id")
            keys = _key(key[0], np.arange(len(part)))
            return pd.DataFrame({"key": keys, "node_id": part["node_id"].to_numpy(), "unit": part["unit"].to_numpy(), "leaves": part["leaves"].to_numpy()})

        numbered = written(blocks.groupBy("block").applyInPandas(number, "key long, node_id long, unit binary, leaves array<long>"), "numbered")
        each = numbered.select("key", "unit", F.posexplode("leaves").alias("tree", "leaf"))
        sizes = each.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / (2 * block_rows)).cast("long").alias("parts"))
        each = each.join(sizes, ["tree", "leaf"]).withColumn("part", F.expr("pmod(xxhash64(key), parts)"))
        first = each.groupBy("tree", "leaf", "part").applyInPandas(self._within_leaf(), MESSAGE)
        by_block = numbered.withColumn("block", F.shiftright("key", 32))
        states = by_block.select("block", "key", "node_id", "unit").groupBy("block").cogroup(first.groupBy("block")).applyInPandas(self._begin(), MESSAGE)
        self.states = written(states, "graph-0")
        for r in range(rounds):
            old, self.states = self.states, written(self._round(), f"graph-{r + 1}")
            drop_written(old)
        self.states = written(self._with_backward(), "graph")

    def _within_leaf(self) -> Callable:
        k = self.k

        def join(part: pd.DataFrame) -> pd.DataFrame:
            units = np.stack([np.frombuffer(u, np.float32) for u in part["unit"]])
            keys = part["key"].to_numpy(np.int64)
            n, to, other, sims = min(k, len(keys) - 1), [], [], []
            if n < 1:
                return _frame([])
            for a in range(0, len(keys), 1024):
                s = units[a : a + 1024] @ units.T
                s[np.arange(len(s)), np.arange(a, a + len(s))] = -9
                best = np.argpartition(-s, n - 1, 1)[:, :n]
                to.append(np.repeat(keys[a : a + 1024], n))
                other.append(keys[best].ravel())
                sims.append(np.take_along_axis(s, best, 1).ravel())
            to = np.concatenate(to)
            return _frame(_messages(to >> 32, to=to, other=np.concatenate(other), sim=np.concatenate(sims)))

        return join

    def _begin(self) -> Callable:
        k = self.k

        def state(part: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
            if part.empty:
                return _frame([])
            part = part.sort_values("key")
            units = np.stack([np.frombuffer(u, np.float32) for u in part["unit"]])
            new = {"keys": part["key"].to_numpy(np.int64), "ids": part["node_id"].to_numpy(np.int64), "units": units}
            return _frame([(int(part["block"].iloc[0]), pickle.dumps(_with_lists(new, _received(messages, PAIRS), k), 5))])

        return state

    def _round(self) -> DataFrame:
        """The states after a round of NN-descent."""
        k = self.k

        def backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for payload in batch["payload"]:
                    to, other, sim = _edges(pickle.loads(payload))
                    yield _frame(_messages(other >> 32, to=other, other=to, sim=sim))

        def gather(state: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
            """The neighbours to be joined of each node, forward and backward, and for every block what is asked of it."""
            if state.empty:
                return _frame([]).assign(kind=0)
            block = int(state["block"].iloc[0])
            mine, back = pickle.loads(state["payload"].iloc[0]), _received(messages, PAIRS)
            to, other, sim = _edges(mine)
            b_to, b_other, b_sim = _best(back["to"], back["other"], back["sim"], k)
            pairs = np.unique(np.stack([np.r_[to, b_to], np.r_[other, b_other]], 1), axis=0)
            wanted = np.unique(pairs[:, 1])
            asks = _frame(_messages(wanted >> 32, keys=wanted, back=np.full(len(wanted), block, np.int64)))
            return pd.concat([asks.assign(kind=1), _frame([(block, pickle.dumps(pairs, 5))]).assign(kind=0)])

        def answer(state: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
            """Vectors of the nodes asked for, and the least similarity that would enter their lists."""
            if state.empty:
                return _frame([])
            mine = pickle.loads(state["payload"].iloc[0])
            worst, out = mine["near_sim"].min(1), []
            for m in messages["payload"]:
                ask = pickle.loads(m)
                slot = ask["keys"] & 0xFFFFFFFF
                out.append((int(ask["back"][0]), pickle.dumps({"keys": ask["keys"], "units": mine["units"][slot], "worst": worst[slot]}, 5)))
            return _frame(out)

        def join(lists: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
            if lists.empty or messages.empty:
                return _frame([])
            pairs, got = pickle.loads(lists["payload"].iloc[0]), [pickle.loads(m) for m in messages["payload"]]
            keys = np.concatenate([g["keys"] for g in got])
            order = np.argsort(keys)
            keys, units, worst = keys[order], np.concatenate([g["units"] for g in got])[order], np.concatenate([g["worst"] for g in got])[order]
            at = np.searchsorted(keys, pairs[:, 1])
            to, other, sims = [], [], []
            for own in np.split(at, np.flatnonzero(np.diff(pairs[:, 0])) + 1):
                if len(own) < 2:
                    continue
                x = units[own]
                s = x @ x.T
                np.fill_diagonal(s, -9)
                n = min(PASSED_ON, len(own) - 1)
                best = np.argpartition(-s, n - 1, 1)[:, :n]
                s = np.take_along_axis(s, best, 1)
                i, j = np.nonzero(s > worst[own][:, None])
                to.append(own[i])
                other.append(own[best[i, j]])
                sims.append(s[i, j])
            if not to:
                return _frame([])
            to, other, sim = _best(keys[np.concatenate(to)], keys[np.concatenate(other)], np.concatenate(sims), k)
            return _frame(_messages(to >> 32, to=to, other=other, sim=sim))

        def improve(state: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
            if state.empty:
                return _frame([])
            mine = pickle.loads(state["payload"].iloc[0])
            to, other, sim = _edges(mine)
            got = _received(messages, PAIRS)
            both = {"to": np.r_[to, got["to"]], "other": np.r_[other, got["other"]], "sim": np.r_[sim, got["sim"]]}
            return _frame([(int(state["block"].iloc[0]), pickle.dumps(_with_lists(mine, both, k), 5))])

        of = self.states.groupBy("block")
        gathered = written(of.cogroup(self.states.mapInPandas(backward, MESSAGE).groupBy("block")).applyInPandas(gather, f"{MESSAGE}, kind int"), "gathered")
        answers = of.cogroup(gathered.where("kind = 1").groupBy("block")).applyInPandas(answer, MESSAGE)
        better = gathered.where("kind = 0").groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(join, MESSAGE)
        return of.cogroup(better.groupBy("block")).applyInPandas(improve, MESSAGE)

    def _with_backward(self) -> DataFrame:
        """The states with ``links`` (and ``link_from``): the forward and best backward neighbours of each node."""
        k = self.k

        def backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for payload in batch["payload"]:
                    to, other, sim = _edges(pickle.loads(payload))
                    yield _frame(_messages(other >> 32, to=other, other=to, sim=sim))

        def link(state: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
            if state.empty:
                return _frame([])
            mine, back = pickle.loads(state["payload"].iloc[0]), _received(messages, PAIRS)
            to, other, _ = _edges(mine)
            b_to, b_other, _ = _best(back["to"], back["other"], back["sim"], k)
            pairs = np.unique(np.stack([np.r_[to, b_to], np.r_[other, b_other]], 1), axis=0)
            mine["link_from"] = np.searchsorted(pairs[:, 0] & 0xFFFFFFFF, np.arange(len(mine["keys"]) + 1))
            mine["links"] = pairs[:, 1]
            return _frame([(int(state["block"].iloc[0]), pickle.dumps(mine, 5))])

        of = self.states.groupBy("block")
        return of.cogroup(self.states.mapInPandas(backward, MESSAGE).groupBy("block")).applyInPandas(link, MESSAGE)

    def search(self, queries: DataFrame, beam: int = BEAM, found: int = 16) -> DataFrame:
        """node_id, near_id, sim: up to ``found`` nodes near each node in queries (node_id), by greedy search from its own lists."""

        def begin(state: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            if state.empty or asked.empty:
                return _frame([]).assign(kind=0)
            mine = pickle.loads(state["payload"].iloc[0])
            slots = np.flatnonzero(np.isin(mine["ids"], asked["node_id"].to_numpy(np.int64)))
            n = mine["near"].shape[1]
            to, other, sim = np.repeat(mine["keys"][slots], n), mine["near"][slots].ravel(), mine["near_sim"][slots].ravel()
            live = other >= 0
            q = {"keys": mine["keys"][slots], "ids": mine["ids"][slots], "units": mine["units"][slots], "to": to[live], "other": other[live], "sim": sim[live], "id": np.full(int(live.sum()), -1, np.int64), "done": np.zeros(int(live.sum()), bool)}
            return _asking(int(state["block"].iloc[0]), q)

        def _asking(block: int, q: dict) -> pd.DataFrame:
            """The search state of a block, and for the blocks of new nodes in beams whom to expand. What stands in a beam now is done with."""
            fresh = ~q["done"]
            slot = np.searchsorted(q["keys"], q["to"])
            counts = np.bincount(slot, minlength=len(q["keys"]))
            worst = np.full(len(q["keys"]), 9, np.float32)
            np.minimum.at(worst, slot, q["sim"])
            worst[counts < beam] = -9
            at = slot[fresh]
            sent = _messages(q["other"][fresh] >> 32, query=q["to"][fresh], node=q["other"][fresh], unit=q["units"][at], worst=worst[at])
            q["done"] = np.ones(len(q["done"]), bool)
            return pd.concat([_frame([(block, pickle.dumps(q, 5))]).assign(kind=0), _frame(sent).assign(kind=1)])

        def expand(state: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
            """Sends the query on to the neighbours of each node to expand."""
            if state.empty or messages.empty:
                return _frame([])
            mine, out = pickle.loads(state["payload"].iloc[0]), []
            for m in messages["payload"]:
                ask = pickle.loads(m)
                a, b = mine["link_from"][ask["node"] & 0xFFFFFFFF], mine["link_from"][(ask["node"] & 0xFFFFFFFF) + 1]
                row = np.repeat(np.arange(len(a)), b - a)
                node = mine["links"][np.arange(len(row)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)]
                pairs, first = np.unique(np.stack([ask["query"][row], node], 1), axis=0, return_index=True)
                queries, where = np.unique(ask["query"], return_index=True)
                for block in np.unique(pairs[:, 1] >> 32):
                    here = pairs[pairs[:, 1] >> 32 == block]
                    known = np.unique(here[:, 0])
                    rows = where[np.searchsorted(queries, known)]
                    out.append((int(block), pickle.dumps({"query": here[:, 0], "node": here[:, 1], "known": known, "units": ask["unit"][rows], "worst": ask["worst"][rows]}, 5)))
            return _frame(out)

        def score(state: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
            """Scores each node reached once for each query, and answers where it would enter the beam."""
            if state.empty or messages.empty:
                return _frame([])
            mine, got = pickle.loads(state["payload"].iloc[0]), [pickle.loads(m) for m in messages["payload"]]
            known, first = np.unique(np.concatenate([g["known"] for g in got]), return_index=True)
            units, worst = np.concatenate([g["units"] for g in got])[first], np.concatenate([g["worst"] for g in got])[first]
            pairs = np.unique(np.stack([np.concatenate([g["query"] for g in got]), np.concatenate([g["node"] for g in got])], 1), axis=0)
            out: dict[str, list[np.ndarray]] = {"to": [], "other": [], "sim": [], "id": []}
            for a in range(0, len(pairs), 100_000):
                query, node = pairs[a : a + 100_000].T
                q, slot = np.searchsorted(known, query), node & 0xFFFFFFFF
                sim = np.einsum("ij,ij->i", units[q], mine["units"][slot])
                keep = (sim > worst[q]) & (query != node)
                for name, v in (("to", query), ("other", node), ("sim", sim), ("id", mine["ids"][slot])):
                    out[name].append(v[keep])
            done = {name: np.concatenate(v) for name, v in out.items()}
            return _frame(_messages(done["to"] >> 32, **done))

        def update(state: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
            if state.empty:
                return _frame([]).assign(kind=0)
            q = pickle.loads(state["payload"].iloc[0])
            got = _received(messages, PAIRS | {"id": np.empty(0, np.int64)})
            to, other, sim, ids = (np.r_[q[x], got[x]] for x in ("to", "other", "sim", "id"))
            done = np.r_[q["done"], np.zeros(len(got["to"]), bool)]
            # of a node that came again the one that is done with stays, with the id that the answer told
            order = np.lexsort((~done, other, to))
            to, other, sim, ids, done = to[order], other[order], sim[order], ids[order], done[order]
            start = np.flatnonzero(np.r_[True, (to[1:] != to[:-1]) | (other[1:] != other[:-1])])
            ids = np.maximum.reduceat(ids, start) if len(start) else ids
            to, other, sim, done = to[start], other[start], sim[start], done[start]
            order = np.lexsort((other, -sim, to))
            to, other, sim, ids, done = to[order], other[order], sim[order], ids[order], done[order]
            begin_at = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.empty(0, np.int64)
            keep = np.arange(len(to)) - np.repeat(begin_at, np.diff(np.r_[begin_at, len(to)])) < beam
            q |= {"to": to[keep], "other": other[keep], "sim": sim[keep], "id": ids[keep], "done": done[keep]}
            return _asking(int(state["block"].iloc[0]), q)

        def result(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for payload in batch["payload"]:
                    q = pickle.loads(payload)
                    to, other, sim = _best(q["to"], q["other"], q["sim"], found)
                    yield pd.DataFrame({"node_id": q["ids"][np.searchsorted(q["keys"], to)], "near": other, "sim": sim})

        def name(state: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if state.empty or rows.empty:
                return pd.DataFrame({"node_id": [], "near_id": [], "sim": []})
            ids = pickle.loads(state["payload"].iloc[0])["ids"]
            return pd.DataFrame({"node_id": rows["node_id"], "near_id": ids[rows["near"].to_numpy() & 0xFFFFFFFF], "sim": rows["sim"]})

        of = self.states.groupBy("block")
        # a query's block is that of its node; the few columns of a state's ids serve to find it
        homes = self.states.mapInPandas(_ids, "node_id long, block long")
        asked = homes.join(queries.select("node_id").distinct(), "node_id")
        step = written(of.cogroup(asked.groupBy("block")).applyInPandas(begin, f"{MESSAGE}, kind int"), "search-0")
        turn = 0
        while not (asks := step.where("kind = 1")).isEmpty():
            reached = of.cogroup(asks.groupBy("block")).applyInPandas(expand, MESSAGE)
            scored = of.cogroup(reached.groupBy("block")).applyInPandas(score, MESSAGE)
            turn += 1
            old, step = step, written(step.where("kind = 0").groupBy("block").cogroup(scored.groupBy("block")).applyInPandas(update, f"{MESSAGE}, kind int"), f"search-{turn}")
            drop_written(old)
        rows = step.where("kind = 0").mapInPandas(result, "node_id long, near long, sim double")
        rows = rows.withColumn("block", F.shiftright("near", 32))
        return of.cogroup(rows.groupBy("block")).applyInPandas(name, "node_id long, near_id long, sim double")


def _ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for block, payload in zip(batch["block"], batch["payload"], strict=True):
            yield pd.DataFrame({"node_id": (ids := pickle.loads(payload)["ids"]), "block": np.full(len(ids), block)})


def _edges(state: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    live = state["near"] >= 0
    return np.repeat(state["keys"], live.sum(1)), state["near"][live], state["near_sim"][live]


def _with_lists(state: dict, pairs: dict[str, np.ndarray], k: int) -> dict:
    to, other, sim = _best(pairs["to"], pairs["other"], pairs["sim"].astype(np.float32), k)
    n = len(state["keys"])
    near, near_sim = np.full((n, k), -1, np.int64), np.full((n, k), -9, np.float32)
    slot = to & 0xFFFFFFFF
    rank = np.arange(len(to)) - np.searchsorted(slot, slot)
    near[slot, rank], near_sim[slot, rank] = other, sim
    return state | {"near": near, "near_sim": near_sim}


def nearest(rows: DataFrame, is_query: str, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", **graph: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest cosine found for each row where the SQL condition ``is_query`` holds on vec_id."""
    index = NeighbourGraph(rows, id_col, vec_col, **graph)
    schema = "query_id long, rank int, vec_id long, score double"
    if index.states is None:
        return rows.sparkSession.createDataFrame([], schema)
    # the first ids of each node are all that any answer can show
    own = index.rows.dropDuplicates(["vec_id", "vec"]).join(index.nodes, "vec").select("vec_id", "node_id")
    first = Window.partitionBy("node_id").orderBy("vec_id")
    members = written(own.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1).select("vec_id", "node_id"), "members")
    queries = written(index.rows.where(is_query).dropDuplicates(["vec_id", "vec"]).join(index.nodes, "vec").select(F.col("vec_id").alias("query_id"), "node_id"), "queries")
    found = index.search(queries, found=2 * k + 6).select("node_id", "near_id")
    found = found.union(queries.select("node_id", F.col("node_id").alias("near_id")).distinct())
    vectors = index.nodes.select("node_id", _near_one(F.col("vec")).alias("vec"))
    scored = found.join(vectors, "node_id").join(vectors.select(F.col("node_id").alias("near_id"), F.col("vec").alias("near_vec")), "near_id")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    cosine = dot("vec", "near_vec") / (F.sqrt(dot("vec", "vec")) * F.sqrt(dot("near_vec", "near_vec")))
    scored = scored.select("node_id", "near_id", cosine.alias("score"))
    answers = queries.join(scored, "node_id").select("query_id", "near_id", "score").join(members.withColumnRenamed("node_id", "near_id"), "near_id").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
