"""Sinks: payloads in their published shape, what is published and what is withdrawn, layers, escapes, paths, archives."""

from __future__ import annotations

import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def payload(always: Sequence[str], others: Sequence[str]) -> Column:
    """JSON of a row: the first columns stand in it even if null, the others only with a value."""
    kept = F.to_json(F.struct(*always), {"ignoreNullFields": "false"})
    rest = F.to_json(F.struct(*others))
    inner = lambda j: F.regexp_replace(j, r"^\{|\}$", "")
    joined = F.concat_ws(",", F.nullif(inner(kept), F.lit("")), F.nullif(inner(rest), F.lit("")))
    return F.concat(F.lit("{"), joined, F.lit("}"))


def published(documents: DataFrame, verdicts: DataFrame, preview: bool) -> tuple[DataFrame, DataFrame]:
    """(documents to write, document ids whose earlier output goes): what passed, stamped with the mode and the codes that were let through.

    verdicts: document_id, status, degraded_codes (a list).
    """
    ok = verdicts.where("status = 'passed'")
    codes = F.coalesce("degraded_codes", F.array().cast("array<string>"))
    out = documents.join(ok.select("document_id", codes.alias("degraded_codes")), "document_id").withColumn("mode", F.lit("preview" if preview else "strict"))
    return (out if preview else out.drop("degraded_codes")), verdicts.where("status <> 'passed'").select("document_id")


def write_new(df: DataFrame, path: str) -> None:
    """Writes to a folder that must not be there yet; an empty input writes nothing and is an error."""
    if df.isEmpty():
        raise ValueError("nothing to publish")
    df.write.mode("errorifexists").parquet(path)


def layered(base: DataFrame, recovered: DataFrame, key: str) -> DataFrame:
    """The recovered row of each key where there is one, else the base row: the base stays as it is, and a second application changes nothing."""
    top = recovered.select(base.columns).dropDuplicates([key])
    return top.withColumn("layer", F.lit("recovered")).unionByName(base.join(top.select(key), key, "left_anti").withColumn("layer", F.lit("base")))


def embedded(json: Column) -> Column:
    """JSON text that may stand in a script element: no tag can end it, no line separator breaks it."""
    for was, now in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e"), ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        json = F.replace(json, F.lit(was), F.lit(now))
    return json


def moved_path(path: Column, folder: Column, ref: Column) -> Column:
    """The name of a file under its document's own folder."""
    return F.concat_ws("/", folder, ref, F.regexp_extract(F.regexp_replace(path, r"\\", "/"), "[^/]+$", 0))


def safe_members(names: Sequence[str]) -> list[str]:
    """Members of an archive; one that would leave the folder it is unpacked to is an error."""
    for n in names:
        parts = Path(n.replace("\\", "/")).parts
        if n.startswith(("/", "\\")) or ".." in parts or (len(n) > 1 and n[1] == ":"):
            raise ValueError(f"unsafe member {n!r}")
    return list(names)


def unpack(archive: str, folder: str) -> list[str]:
    """Unpacks an archive whose members all stay inside the folder, and names them."""
    with zipfile.ZipFile(archive) as z:
        names = safe_members(z.namelist())
        z.extractall(folder)
    return names


def change_manifest(before: DataFrame, after: DataFrame, key: str, text: str) -> DataFrame:
    """key, before_hash, after_hash, change (added, removed, changed, same) of two versions of documents."""
    b, a = before.select(key, F.sha2(text, 256).alias("before_hash")), after.select(key, F.sha2(text, 256).alias("after_hash"))
    change = F.when(F.col("before_hash").isNull(), "added").when(F.col("after_hash").isNull(), "removed").when(F.col("before_hash") == F.col("after_hash"), "same").otherwise("changed")
    return b.join(a, key, "full").withColumn("change", change)
