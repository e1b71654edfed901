"""Scans of document folders, lists, workbooks and vocabularies, and what is chosen among them.

Listings are rows (path, modified, ..) of Spark's binary-file source without contents, so they scale with the
number of files; what is said of files is said by joins and aggregates of these rows.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHEET_ROWS = "file string, row_index int, cells map<string,string>"
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, folder, name, stem, modified, size of the files under a folder whose names fit a glob; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    name = F.regexp_extract("path", "[^/]+$", 0)
    return files.select("path", F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("folder"), name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def require_empty(problems: DataFrame, what: str) -> None:
    """Raises with the first of the problems, if there are any."""
    first = problems.limit(5).collect()
    if first:
        raise ValueError(f"{what}: {[tuple(r) for r in first]}")


def optional_rows(wanted: DataFrame, found: DataFrame, key: Sequence[str], fill: Mapping[str, object]) -> DataFrame:
    """Rows of ``found`` for every wanted key; what is missing or unreadable has the fill."""
    met = wanted.select(*key).distinct().join(found, list(key), "left")
    return met.na.fill(dict(fill))


def request_list(lines: DataFrame, text: str = "value", order: str = "at") -> tuple[DataFrame, DataFrame]:
    """(refs with their first place, refs that came twice) of a list: trimmed, without blank lines and comments."""
    ref = F.trim(text)
    kept = lines.select(ref.alias("ref"), F.col(order).alias("at")).where("ref <> '' AND NOT startswith(ref, '#')")
    per = kept.groupBy("ref").agg(F.min("at").alias("at"), F.count("*").alias("times"))
    return per.select("ref", "at"), per.where("times > 1").select("ref", "times")


def select_documents(available: DataFrame, requested: DataFrame | None = None, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents (ref, ..) with ``at``, missing refs): the requested ones in their order, or all by name; the first ``limit`` of them."""
    if requested is None:
        chosen = available.withColumn("at", F.col("ref"))
        missing = available.select("ref").limit(0)
    else:
        chosen = available.join(requested, "ref")
        missing = requested.select("ref").join(available.select("ref"), "ref", "left_anti")
    return (chosen.orderBy("at").limit(limit) if limit is not None else chosen), missing


def cardinality(files: DataFrame, group: Sequence[str], rules: Mapping[str, tuple[Column, int, int]]) -> DataFrame:
    """Groups whose files break a rule: (group, rule, n) where the count of files that hold its condition is below its least or above its most."""
    counts = files.groupBy(*group).agg(*[F.count_if(c).alias(n) for n, (c, _, _) in rules.items()])
    entry = lambda n: F.struct(F.lit(n).alias("rule"), F.col(n).alias("n"), ((F.col(n) < rules[n][1]) | (F.col(n) > rules[n][2])).alias("broken"))
    flat = counts.select(*group, F.explode(F.array(*[entry(n) for n in rules])).alias("x")).select(*group, "x.*")
    return flat.where("broken").drop("broken")


def preferred_file(files: DataFrame, group: Sequence[str], preference: Sequence[Column]) -> DataFrame:
    """For each group the first file by name of the first preference that any file holds."""
    rank = F.coalesce(*[F.when(p, F.lit(i)) for i, p in enumerate(preference)])
    return files.withColumn("rank", rank).where("rank IS NOT NULL").groupBy(*group).agg(F.min(F.struct("rank", "name", "path")).alias("f")).select(*group, "f.path", "f.rank")


def batch_context(statuses: DataFrame, manifests: DataFrame) -> DataFrame:
    """ref, batch_id of papers by the latest status file that names them, where their state is done and the batch has a manifest.

    statuses: batch_id, modified, results (file_name, state); manifests: batch_id.
    """
    flat = statuses.select("batch_id", "modified", F.explode("results").alias("r")).select("batch_id", "modified", F.regexp_replace("r.file_name", r"\.[^.]*$", "").alias("ref"), "r.state")
    last = flat.groupBy("ref").agg(F.max(F.struct("modified", "batch_id", "state")).alias("l"))
    return last.where("l.state = 'done'").select("ref", F.col("l.batch_id").alias("batch_id")).join(manifests.select("batch_id").distinct(), "batch_id", "left_semi")


def batch_refs(manifests: DataFrame, statuses: DataFrame) -> DataFrame:
    """batch_id, ref, at: the files a manifest lists, else those of the status, each once, in order. Both have batch_id, files."""
    both = manifests.select("batch_id", F.col("files").alias("m")).join(statuses.select("batch_id", F.col("files").alias("s")), "batch_id", "full")
    flat = both.select("batch_id", F.posexplode(F.array_distinct(F.transform(F.coalesce("m", "s"), lambda f: F.regexp_replace(f, r"\.[^.]*$", "")))).alias("at", "ref"))
    return flat.select("batch_id", "ref", "at")


def stage_sources(wanted: DataFrame, successes: DataFrame, failures: DataFrame) -> DataFrame:
    """ref, stage, state, payload: a stage's own output, else the object in a failure's raw response, else missing.

    wanted: ref, stage; successes: ref, stage, payload; failures: ref, stage, raw (JSON text, as it came).
    """
    from strataquery.functions.payload import json_object

    done = successes.select("ref", "stage", F.col("payload").alias("own"))
    lost = failures.select("ref", "stage", json_object(F.col("raw"))["json"].alias("raw"), F.lit(True).alias("failed"))
    met = wanted.join(done, ["ref", "stage"], "left").join(lost, ["ref", "stage"], "left")
    state = F.when(F.col("own").isNotNull(), "success").when(F.col("raw").isNotNull(), "recovered").when(F.col("failed"), "failed").otherwise("missing")
    return met.select("ref", "stage", state.alias("state"), F.coalesce("own", "raw").alias("payload"))


def open_failures(failures: DataFrame, successes: DataFrame) -> DataFrame:
    """Failures of stages that have not succeeded since."""
    return failures.join(successes.select("ref", "stage").distinct(), ["ref", "stage"], "left_anti")


def paired(left: DataFrame, right: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows in both, keys with a missing side: key, missing)."""
    lost = left.select(*key).distinct().join(right, list(key), "left_anti").withColumn("missing", F.lit("right"))
    gone = right.select(*key).distinct().join(left, list(key), "left_anti").withColumn("missing", F.lit("left"))
    return left.join(right, list(key)), lost.unionByName(gone)


def task_list(tasks: DataFrame, limit: int) -> DataFrame:
    """The newest readable tasks, 1 to 100 of them."""
    return tasks.where("created_at IS NOT NULL").orderBy(F.desc("created_at"), "task_id").limit(min(max(limit, 1), 100))


def with_fallback(rows: DataFrame, fallback: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, with the fallback's for keys they lack, and where each came from; wanted keys that neither has)."""
    first = rows.withColumn("lineage", F.lit("file"))
    second = fallback.join(rows.select(key).distinct(), key, "left_anti").withColumn("lineage", F.lit("workbook"))
    both = first.unionByName(second, allowMissingColumns=True).join(wanted.select(key).distinct(), key, "left_semi")
    return both, wanted.select(key).distinct().join(both, key, "left_anti")


# --- workbooks ----------------------------------------------------------------------------------------------


def column_number(letters: Column) -> Column:
    """A sheet's column letters as a number from 0: A is 0, AA 26."""
    codes = F.transform(F.split(F.upper(letters), ""), lambda c: F.ascii(c) - 64)
    return F.aggregate(codes, F.lit(0), lambda acc, c: acc * 26 + c) - 1


def _number(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref.upper())[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _cell(c: ET.Element, shared: list[str]) -> str | None:
    kind, v = c.get("t"), c.find(f"{_NS}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{_NS}t"))
    if v is None or v.text is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "true" if v.text == "1" else "false"
    if kind in ("str", "e"):
        return v.text
    x = float(v.text)
    return str(int(x)) if x.is_integer() else v.text


def sheet_rows(content: bytes, sheet: str) -> list[tuple[int, dict[str, str]]]:
    """(row from 1 on, header to text) of one sheet, read from the zip and XML alone; the first row is the header, blank cells are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        ids = {s.get("name"): s.get(f"{_REL}id") for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{_NS}sheet")}
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = targets[ids[sheet]].lstrip("/")
        root = ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
    rows = [{_number(c.get("r")): _cell(c, shared) for c in row.iter(f"{_NS}c")} for row in root.iter(f"{_NS}row")]
    head = {i: t for i, t in (rows[0] if rows else {}).items() if t}
    return [(n, {head[i]: t for i, t in row.items() if i in head and t is not None}) for n, row in enumerate(rows[1:], 1)]


def read_sheet(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """file, row_index, cells (header to text) of a sheet of each workbook that a path names. A workbook is one row of a task's memory."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p.rsplit("/", 1)[-1], n, cells) for p, content in zip(batch["path"], batch["content"], strict=True) for n, cells in sheet_rows(content, sheet)]
            yield pd.DataFrame(rows, columns=["file", "row_index", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, SHEET_ROWS)


# --- vocabularies, prompts, settings: small texts read on the driver -----------------------------------------


def vocabulary(text: str) -> list[tuple[str, str, str]]:
    """(name, code, category) of lines ``name: [code, category]``; blank lines and comments count for nothing, other shapes and repeated names are errors."""
    out: list[tuple[str, str, str]] = []
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        m = re.fullmatch(r"""\s*["']?(.+?)["']?\s*:\s*\[\s*["']?([^,"']+)["']?\s*,\s*["']?([^\]"']+)["']?\s*\]\s*""", line)
        if not m:
            raise ValueError(f"not a vocabulary line: {line!r}")
        out.append((m[1], m[2].strip(), m[3].strip()))
    if len({n for n, _, _ in out}) < len(out):
        raise ValueError("a name stands twice")
    return out


def pattern_table(aliases: Sequence[tuple[str, str]], names: Sequence[str], least: int = 6) -> list[tuple[str, str]]:
    """(pattern, name) in order: hand-written ones first, whose names must be known, then the names themselves that are long enough."""
    known = set(names)
    if wrong := [n for _, n in aliases if n not in known]:
        raise ValueError(f"unknown names: {wrong}")
    return [*aliases, *((rf"\b{re.escape(n.lower())}\b", n) for n in names if len(n) >= least)]


def first_pattern(text: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """The name of the first pattern that a text fits."""
    return F.coalesce(*[F.when(text.rlike(p), F.lit(n)) for p, n in patterns])


def prompts(texts: DataFrame) -> DataFrame:
    """id, version, body of prompt texts (path, text) whose front matter stands between lines of three dashes; others have a null id."""
    head = F.regexp_extract("text", r"(?s)\A---\n(.*?)\n---\n", 1)
    value = lambda k: F.nullif(F.trim(F.regexp_extract(head, rf"(?m)^{k}:\s*(.+)$", 1)), F.lit(""))
    return texts.select("path", value("id").alias("id"), value("version").alias("version"), F.regexp_replace("text", r"(?s)\A---\n.*?\n---\n", "").alias("body"))


def stage_settings(defaults: Mapping[str, object], overrides: Mapping[str, Mapping[str, object]], stage: str, allowed: Mapping[str, Sequence[object]]) -> dict[str, object]:
    """Defaults with a stage's overrides; a value that isn't allowed for its key is an error."""
    merged = {**defaults, **overrides.get(stage, {})}
    for key, values in allowed.items():
        if key in merged and merged[key] not in values:
            raise ValueError(f"{key}: {merged[key]!r} is none of {list(values)}")
    return merged


def env_settings(text: str, present: Mapping[str, str]) -> dict[str, str]:
    """Settings of lines ``NAME=value`` that are not set yet; quotes around a value go, lines without a name count for nothing."""
    found: dict[str, str] = {}
    for line in text.splitlines():
        m = re.fullmatch(r"\s*(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*", line)
        if m and not line.lstrip().startswith("#") and m[1] not in present:
            found[m[1]] = re.sub(r"""^(["'])(.*)\1$""", r"\2", m[2])
    return found
