"""Best-fit packing by length-histogram planning.

Documents become token ids once; from then on only lengths move. The histogram of lengths has at most
``capacity`` entries whatever the corpus holds, so best-fit decreasing runs over counts on the driver:
its cost depends on the capacity, not on the documents. The plan says which ranks of each length go to
which sequences, and pieces take their slots by joining their rank within length against it.

Defined cases: a null or empty text is the end token alone; repeated rows are packed once each; null ids
are kept; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held, slices, tidy, trim, written

CAPACITY = 1024
END_ID = 2
#: Rows that one (length, bucket) window numbers, about, and buckets at most beside one a length; then windows grow.
BUCKET_ROWS = 500
MOST_BUCKETS = 100_000
#: Space-delimited words whose ids a worker remembers; when full it keeps those it has.
CACHE_WORDS = 300_000
#: Fixed value: how this byte-level BPE splits text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Texts that the word cache can't treat: other white space than single spaces and line feeds, the marker.
_RARE = r"[ \n][ \n]|[\t\x0b\f\r\x1c-\x1f\x00]|[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Bytes of text that are looked up at a time: the more, the fewer distinct words a byte; a worker holds about 20 times this.
SLICE = 2_000_000

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def _byte_ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary of a byte-level BPE file as ranks, if its ids stand in the order of its merges; else null."""
    model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"]["".join(m)] for m in merges]
    if ids != sorted(ids) or ids and ids[0] < 256:
        return None
    return {bytes(byte[c] for c in token): n for token, n in model["vocab"].items() if all(c in byte for c in token) and (len(token) == 1 or n <= ids[-1])}


class WordCache:
    """Token ids of texts, through ids remembered for space-delimited words.

    A byte-level BPE splits text before it merges: a single space between two other characters always
    starts a new part with what follows it, so ids of " word" don't depend on the neighbours. Texts with
    other or doubled white space, or with a special token's string, go to the tokenizer as a whole. Words
    are merged by ranks read from the same file where its ids allow that, which gives the same ids faster.
    """

    def __init__(self, path: str, most: int = CACHE_WORDS):
        self.path = path
        self.special = [t["content"] for t in json.loads(Path(path).read_text(encoding="utf-8")).get("added_tokens") or []]
        self.most = most
        self.index: dict[str, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.first = self.count = np.empty(0, np.int64)
        self._words = lambda words: [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        if ranks := _byte_ranks(path):
            import tiktoken

            encode = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self._words = lambda words: [*map(encode, words)]
        # the file as read is some times the ranks
        trim()

    @functools.cached_property
    def tokenizer(self) -> Tokenizer:
        """Read with the first text that needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _rows(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._words([k[1:] if k[:1] == "\0" else " " + k for k in keys])
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum())), count

    def _look_up(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words, one after the other, and how many each has."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        flat, first, count = self.flat, self.first, self.count
        if (gone := np.flatnonzero(at < 0)).size:
            fresh = [distinct[i] for i in gone.tolist()]
            at[gone] = len(first) + np.arange(len(fresh))
            more, n = self._rows(fresh)
            first = np.concatenate([first, len(flat) + np.cumsum(n) - n])
            flat, count = np.concatenate([flat, more]), np.concatenate([count, n])
            if len(first) <= self.most:
                self.index.update(zip(fresh, at[gone].tolist(), strict=True))
                self.flat, self.first, self.count = flat, first, count
        at = at[coded.indices.to_numpy(zero_copy_only=False)]
        n = count[at]
        ends = np.cumsum(n)
        return flat[np.repeat(first[at] - (ends - n), n) + np.arange(int(ends[-1]))], n

    def _whole(self, texts: pa.StringArray) -> np.ndarray:
        odd = "|".join([_RARE, *(re.escape(x) for x in self.special)])
        return pc.match_substring_regex(texts, odd).to_numpy(zero_copy_only=False)

    def ids(self, texts: pa.StringArray) -> list[np.ndarray]:
        """The ids of each text, as uint32."""
        out = [np.empty(0, np.uint32)] * len(texts)
        odd = self._whole(texts)
        if whole := np.flatnonzero(odd).tolist():
            for i, e in zip(whole, self.tokenizer.encode_batch([texts[i].as_py() for i in whole], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, np.uint32)
        plain = np.flatnonzero(~odd & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0))
        if plain.size:
            # the first word has no space before it; the marker keeps it apart from the same word after a space
            parts = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\0"), texts.take(pa.array(plain)), ""), " ")
            flat, n = self._look_up(parts.flatten())
            stops = np.cumsum(n)[np.cumsum(pc.list_value_length(parts).to_numpy()) - 1]
            for i, a, b in zip(plain.tolist(), [0, *stops[:-1]], stops, strict=True):
                out[i] = flat[a:b]
        return out


def word_cache(path: str) -> WordCache:
    """One cache a worker process, which serves its tasks one after the other."""
    return held(("words", path), lambda: WordCache(path))


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens: what is over goes into the first."""
    if n <= capacity:
        return [(0, n)]
    first = n - capacity * ((n - 1) // capacity)
    return [(0, first), *((first + k * capacity, capacity) for k in range((n - first) // capacity))]


def tokenize(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """A row for each piece of each document: doc_id, piece, start, length and ids_crc32, with ``ids`` on demand."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(tokenizer_path)
        for batch in batches:
            texts, keys = pc.fill_null(batch.column("text"), "").cast(pa.string()), batch.column("doc_id")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes, SLICE):
                rows, parts = [], []
                for i, ids in enumerate(cache.ids(texts.slice(a, b - a)), a):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4", copy=False)
                    for k, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                        part = ids[start : start + length]
                        rows.append((i, k, start, length, zlib.crc32(part)))
                        if keep_ids:
                            parts.append(part.astype(np.int32))
                at, piece, start, length, crc = np.array(rows, np.int64).T
                columns = [keys.take(pa.array(at)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(parts, pa.list_(pa.int32()))] if keep_ids else [])], schema.names)

    schema = T.StructType([*PIECES.fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else [])])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(pieces), schema)


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths. Returns slots (length, first rank, ranks, per sequence, first sequence, offset): the ranks from the first on fill consecutive sequences, ``per sequence`` to each, starting at the offset.

    Sequences that hold the same are one group, kept by free room; a length takes the tightest groups
    first and splits at most one. So the work follows the lengths and groups, not the documents.
    """
    groups: dict[int, list[tuple[int, int]]] = {}  # free room: (first sequence, sequences)
    rooms: list[int] = []
    slots, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[k]
            else:
                each = capacity // length
                room, first, n = capacity, sequences, -(-left // each)
                sequences += n
            each = room // length
            if each <= left:
                used = min(n, left // each)
                put(room, first + used, n - used)
            else:
                used, each = 1, left
                put(room, first + 1, n - 1)
            slots.append((length, rank, used * each, each, first, capacity - room))
            put(room - each * length, first, used)
            rank, left = rank + used * each, left - used * each
    return slots


SLOTS = "length long, rank_from long, ranks long, each long, first_sequence long, at long"


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ids_crc32, ...); every piece gets a slot.

    Only the histogram, at most ``capacity`` counts, and the plan reach the driver. Ranks within a length
    come from (length, bucket) counts and a row number inside each bucket, so a length that a third of all
    pieces share is numbered by many tasks.
    """
    spark = pieces.sparkSession
    made = written(pieces, "pieces")
    per = made.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in per}
    rows = max(BUCKET_ROWS, sum(counts.values()) // MOST_BUCKETS)
    buckets = {n: -(-c // rows) for n, c in counts.items()}
    slots = plan_best_fit(counts, capacity)
    plan = spark.createDataFrame(slots or [], SLOTS)
    spread = spark.createDataFrame(sorted(buckets.items()), "length long, buckets long")
    dealt = made.join(F.broadcast(spread), "length").withColumn("bucket", F.expr("pmod(xxhash64(doc_id, piece, ids_crc32), buckets)")).drop("buckets")
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = written(sizes.select("length", "bucket", before.alias("before")), "offsets")
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("own_rank", F.row_number().over(own) - 1)
        .join(offsets, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("own_rank"))
    )
    slot = F.col("rank") - F.col("rank_from")
    return (
        ranked.join(F.broadcast(plan.withColumnRenamed("length", "slot_length")), (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_from") + F.col("ranks")))
        .withColumn("sequence_id", F.col("first_sequence") + F.expr("(rank - rank_from) div each"))
        .withColumn("offset", F.col("at") + slot % F.col("each") * F.col("length"))
        .drop("bucket", "own_rank", "before", "rank", *[c.split()[0] for c in SLOTS.split(", ")[1:]], "slot_length")
    )
