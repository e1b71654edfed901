"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where it is unset in local mode (tests) a new folder that is then set."""
    if not (at := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='checkpoints-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again, which ends their lineage."""
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame) -> DataFrame:
    """cut(), packed closer; what was shuffled for it is deleted with the last row, not when the driver happens to collect its heap."""
    spark, clean = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}", spark.conf.get(clean, "false")
    spark.conf.set(clean, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(clean, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Deletes the files behind a table that cut() made; nothing may read it later."""
    spark = df.sparkSession
    jvm, at = spark.sparkContext._jvm, shared_folder(spark)
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/cut-" in file and (file.startswith(at) or file.startswith(at.replace("file:///", "file:/"))):
            path = jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
