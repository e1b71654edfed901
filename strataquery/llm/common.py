"""What the operators share: reading tables, the shared folder, written intermediate tables."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any, TypeVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: What separates words: ASCII space and the control characters 0x09 to 0x0D.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The columns of a table; the scan reads no others."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset in local mode (tests) a new one."""
    if not (at := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='checkpoints-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them again: lineage ends here, and a lost executor costs no recomputation before this point. Reading also gives the optimiser the table's true size, which is what lets it broadcast small sides only."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Deletes the files behind a table that written() made; nothing may read it later."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if file.startswith(shared_dir(spark).replace("file:///", "file:/")) or file.startswith(shared_dir(spark)):
            path = jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def about(key: Column, rows: int, of: int | Column) -> Column:
    """Whether a row is among about ``rows`` of ``of``, by a hash of its key: the same rows each time, and no task gathers more than its share."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40)) < F.lit(float(1 << 40)) * rows / of


_HELD: dict[Hashable, Any] = {}


def held(key: Hashable, make: Callable[[], T]) -> T:
    """What a worker process keeps between tasks: one thing at a time, so that operators which follow one another don't add up."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def trim() -> None:
    """Gives memory that is no longer needed back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def relieve() -> None:
    """For the driver between steps: drops what only cycles hold, and with it what the JVM keeps for it, and gives memory back to the system."""
    gc.collect()
    trim()


def relieve_executors(spark: SparkSession) -> None:
    """For executors between steps: each JVM collects its heap and gives what is free back to the system, which else stays with it beside its Python workers.

    One short task for each core, all at once, so that each executor gets some; an executor that gets none only keeps its heap.
    """
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).write.format("noop").mode("overwrite").save()


def tidy(run: Callable[[Iterator[Any]], Iterator[Any]]) -> Callable[[Iterator[Any]], Iterator[Any]]:
    """The function of batches, which gives memory back to the system at its end: workers live on between tasks and operators."""

    def tidied(batches: Iterator[Any]) -> Iterator[Any]:
        try:
            yield from run(batches)
        finally:
            trim()

    return tidied


def words_in(text: Column) -> Column:
    """The number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def slices(sizes: Iterable[int], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters or bytes, one text at least: bounds what a worker holds at a time."""
    a = total = i = 0
    for i, n in enumerate(sizes, 1):
        if total and total + n > most:
            yield a, i - 1
            a, total = i - 1, 0
        total += n
    if a < i:
        yield a, i


def bitmap_of(indexes: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size from distinct numbers below 2**bits (column i)."""
    part_bits = bits - 6

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << part_bits, np.uint8)
        flags[rows["i"].to_numpy() & ((1 << part_bits) - 1)] = 1
        return pd.DataFrame({"part": [key[0]], "bits": [np.packbits(flags).tobytes()]})

    parts = indexes.groupBy(F.shiftright("i", part_bits).alias("part")).applyInPandas(fill, "part long, bits binary").collect()
    out = np.zeros((64, (1 << part_bits) // 8), np.uint8)
    for p in parts:
        out[p["part"]] = np.frombuffer(p["bits"], np.uint8)
    return out.ravel()


def in_bitmap(bitmap: np.ndarray, i: np.ndarray) -> np.ndarray:
    return (bitmap[i >> 3] >> (7 - (i & 7)).astype(np.uint8)) & 1 > 0


def low_bits(h: np.ndarray, bits: int) -> np.ndarray:
    return (h & np.uint64((1 << bits) - 1)).astype(np.int64)
