"""Scans and sinks of nested JSON documents and Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType, required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): one JSON object a file. Rejects carry the file and the reason: invalid_json or schema (a required field is null).

    A byte order mark is tolerated by the reader; unreadable files are an error of the scan itself.
    """
    bad = "_corrupt"
    wide = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    rows = spark.read.schema(wide).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).json(path).withColumn("source_file", F.col("_metadata.file_path"))
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    reason = F.when(F.col(bad).isNotNull(), "invalid_json").when(missing, "schema")
    marked = rows.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop(bad, "reason"), marked.where("reason IS NOT NULL").select("source_file", "reason")


def newest(index: DataFrame, name: str, *order: str) -> DataFrame:
    """The one row whose order columns are highest, ties to the higher name."""
    return index.orderBy(*[F.desc(c) for c in (*order, name)]).limit(1)


def write_documents(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """JSON, a line for each row, replacing what stood there."""
    df.write.mode("overwrite").partitionBy(*partition_by).json(path)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """name, size_bytes and sha256 of files: what an index of a collection is checked against."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def manifest_differences(index: DataFrame, actual: DataFrame) -> DataFrame:
    """name and problem: missing, unlisted, size or hash, for (name, size_bytes, sha256) rows."""
    both = index.alias("i").join(actual.alias("a"), F.col("i.name") == F.col("a.name"), "full")
    problem = F.when(F.col("a.name").isNull(), "missing").when(F.col("i.name").isNull(), "unlisted").when(F.col("i.size_bytes") != F.col("a.size_bytes"), "size").when(F.col("i.sha256") != F.col("a.sha256"), "hash")
    return both.select(F.coalesce("i.name", "a.name").alias("name"), problem.alias("problem")).where("problem IS NOT NULL")
