"""Exact top-k search by inner product over a bit-sliced index.

Components become integers floor(scale * x). A block of rows is stored as bit slices: for each dimension
and bit one bitmap over the block's rows. A query's score slices come from adding the attribute slices,
each shifted by the bits of the query's component, with carry-save bitmap arithmetic; negative components
add complements. The top rows are then selected from the most significant score slice downward, and rows
that tie at the boundary are resolved exactly, smaller ids first.

Queries and blocks meet as blocks: each task holds one index block and one block of queries, so memory
is bounded by the two block sizes and every query sees every row.

Defined cases: rows whose id is null or whose vector is null or holds a null or non-finite component take
no part; an empty vector scores 0; missing components of a shorter vector count as 0; integers beyond
2**62 in size saturate there; scores are exact, and one beyond a long is given as the nearest long;
repeated rows are candidates once each; of rows with one id the one with the least vector is its query, and
none of them is its candidate; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BLOCK_ROWS = 65_536
QUERY_ROWS = 256
#: Where components saturate (a double), and what a long holds.
LIMIT = float((1 << 62) - 1024)
LONG = 1 << 63


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id long and vec array<double> of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where(F.col("vec_id").isNotNull() & fine)


def quantise(vectors: list, scale: float) -> np.ndarray:
    wide = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), wide))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return np.clip(np.floor(out * scale), -LIMIT, LIMIT).astype(np.int64)


class BitSlices:
    """Bit slices of a block's integers. bits[d] slices of dimension d stand together, lowest first; low[d] is what was subtracted."""

    def __init__(self, values: np.ndarray | None = None):
        if values is None:
            return
        n, wide = values.shape
        self.rows, self.words = n, -(-n // 64)
        self.low = values.min(0) if n else np.zeros(wide, np.int64)
        above = values.view(np.uint64) - self.low.view(np.uint64)
        self.bits = [int(x).bit_length() for x in (above.max(0) if n else [])]
        self.slices = np.zeros((sum(self.bits), self.words * 8), np.uint8)
        k = 0
        for d, bits in enumerate(self.bits):
            for b in range(bits):
                packed = np.packbits(((above[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
                self.slices[k, : len(packed)] = packed
                k += 1
        self.slices = self.slices.view(np.uint64).reshape(-1, self.words)

    def dump(self) -> bytes:
        return np.array([self.rows, len(self.bits), *self.low, *self.bits], np.int64).tobytes() + self.slices.tobytes()

    @classmethod
    def load(cls, data: bytes) -> BitSlices:
        new = cls()
        new.rows, wide = (int(x) for x in np.frombuffer(data, np.int64, 2))
        head = np.frombuffer(data, np.int64, 2 * wide, 16)
        new.low, new.bits, new.words = head[:wide], [int(x) for x in head[wide:]], -(-new.rows // 64)
        new.slices = np.frombuffer(data, np.uint64, -1, 16 * (1 + wide)).reshape(-1, max(1, new.words))
        return new

    def with_complements(self) -> None:
        self.both = np.concatenate([self.slices, ~self.slices])
        self.first = np.cumsum([0, *self.bits])[:-1].astype(int)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Score slices of all rows, lowest first, and the constant that the scores stand above."""
        columns: dict[int, list[int]] = {}
        above = 0
        for d, q in enumerate(query[: len(self.bits)].tolist()):
            above += q * int(self.low[d])
            if q < 0:
                above += q * ((1 << self.bits[d]) - 1)
            at = int(self.first[d]) + (len(self.slices) if q < 0 else 0)
            for j in range(abs(q).bit_length()):
                if abs(q) >> j & 1:
                    for b in range(self.bits[d]):
                        columns.setdefault(j + b, []).append(at + b)
        out: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        c = 0
        while columns or carried:
            x = self.both[columns.pop(c, [])]
            x = np.concatenate([x, *carried]) if carried else x
            carried = []
            while len(x) > 2:
                k = len(x) // 3
                p, q, r = x[:k], x[k : 2 * k], x[2 * k : 3 * k]
                pq = p ^ q
                carried.append((p & q) | (pq & r))
                x = np.concatenate([pq ^ r, x[3 * k :]]) if len(x) % 3 else pq ^ r
            if len(x) == 2:
                carried.append(x[:1] & x[1:])
                x = x[:1] ^ x[1:]
            out.append(x[0] if len(x) else np.zeros(self.words, np.uint64))
            c += 1
        return out, above

    def top(self, query: np.ndarray, k: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best allowed rows (a bitmap); of equal ones the first."""
        slices, above = self.scores(query)
        sure, tied = np.zeros(self.words, np.uint64), allowed
        for s in reversed(slices):
            high = tied & s
            n = int(np.bitwise_count(sure | high).sum())
            if n > k:
                tied = high
            else:
                sure, tied = sure | high, tied & ~s
                if n == k:
                    tied = np.zeros(self.words, np.uint64)
                    break
        rows, rest = _rows(sure), _rows(tied)
        rows = np.concatenate([rows, rest[: max(0, k - len(rows))]])
        bits = [((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) for s in slices]
        if abs(above) + (1 << len(slices)) < LONG:
            return rows, above + sum((b << c for c, b in enumerate(bits)), np.zeros(len(rows), np.int64))
        exact = [above + sum(int(b[i]) << c for c, b in enumerate(bits)) for i in range(len(rows))]
        return rows, np.array([max(-LONG, min(LONG - 1, x)) for x in exact], np.int64)


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _bitmap(flags: np.ndarray, words: int) -> np.ndarray:
    packed = np.zeros(words * 8, np.uint8)
    got = np.packbits(flags.astype(np.uint8), bitorder="little")
    packed[: len(got)] = got
    return packed.view(np.uint64)


def exact_top_k(rows: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 64.0, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest integer inner product for each row where the SQL condition ``is_query`` holds on vec_id."""
    rows = written(usable(rows, id_col, vec_col), "vectors")
    queries = written(rows.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec")), "queries")
    blocks = max(1, -(-rows.count() // block_rows))
    query_blocks = max(1, -(-queries.count() // query_rows))

    def index(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id", kind="stable")
        payload = BitSlices(quantise(part["vec"].tolist(), scale)).dump()
        return pd.DataFrame({"block": [key[0]], "ids": [part["vec_id"].to_numpy(np.int64).tobytes()], "payload": [payload]})

    def search(key: tuple, block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        if block.empty or asked.empty:
            return empty
        slices = BitSlices.load(block["payload"][0])
        slices.with_complements()
        ids = np.frombuffer(block["ids"][0], np.int64)
        out = [empty]
        for q, vec in zip(asked["vec_id"], quantise(asked["vec"].tolist(), scale), strict=True):
            at, score = slices.top(vec, k, _bitmap(ids != q, slices.words))
            out.append(pd.DataFrame({"query_id": np.full(len(at), q, np.int64), "vec_id": ids[at], "score": score}))
        return pd.concat(out)

    dealt = rows.withColumn("block", F.expr(f"pmod(xxhash64(vec_id), {blocks})"))
    made = written(dealt.groupBy("block").applyInPandas(index, "block long, ids binary, payload binary"), "slices")
    # every index block meets every block of the stated queries
    here = made.withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))))
    asked = queries.withColumn("query_block", F.expr(f"pmod(xxhash64(vec_id), {query_blocks})")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    best = here.groupBy("block", "query_block").cogroup(asked.groupBy("block", "query_block")).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
