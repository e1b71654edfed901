"""Scans and sinks over real files and on literal cases."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from strataquery.sources import scans, sinks

XML = '<?xml version="1.0"?>'
MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def workbook(path):
    rows = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>na</t><t>me</t></is></c><c r="AA1" t="s"><v>1</v></c></row><row r="2"><c r="A2"><v>12.0</v></c><c r="C2"><v>1.5</v></c><c r="AA2" t="b"><v>1</v></c></row><row r="3"><c r="C3" t="str"><v>x &amp; y</v></c></row>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'{XML}<workbook {MAIN}><sheets><sheet name="Data" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{XML}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId7" Target="worksheets/one.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"{XML}<sst {MAIN}><si><t>ref</t></si><si><r><t>is</t></r><r><t>ok</t></r></si></sst>")
        z.writestr("xl/worksheets/one.xml", f"{XML}<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")


def test_sheets(spark, tmp_path):
    workbook(tmp_path / "a.xlsx")
    got = scans.read_sheet(spark, f"file://{tmp_path}/*.xlsx", "Data").orderBy("row_index").collect()
    assert [(r["file"], r["row_index"], r["cells"]) for r in got] == [("a.xlsx", 1, {"ref": "12", "name": "1.5", "isok": "true"}), ("a.xlsx", 2, {"name": "x & y"})]


def test_listings(spark, tmp_path):
    for name in ("b1/reference_no_1/candidate.json", "b1/reference_no_2/other.json", "b2/reference_no_1/candidate.json"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("{}")
    got = scans.listing(spark, f"file://{tmp_path}", "candidate.json").collect()
    assert sorted((r["folder"], r["name"], r["stem"], r["size"]) for r in got) == [("reference_no_1", "candidate.json", "candidate", 2)] * 2


def test_lists_and_selection(spark):
    lines = spark.createDataFrame([(" b ", 1), ("", 2), ("# c", 3), ("a", 4), ("b", 5), (None, 6)], "value string, at int")
    refs, twice = scans.request_list(lines)
    assert [(r["ref"], r["times"]) for r in twice.collect()] == [("b", 2)]
    available = spark.createDataFrame([("a",), ("c",)], "ref string")
    chosen, missing = scans.select_documents(available, refs)
    assert ([r["ref"] for r in chosen.collect()], [r["ref"] for r in missing.collect()]) == (["a"], ["b"])
    assert [r["ref"] for r in scans.select_documents(available, limit=1)[0].collect()] == ["a"]
    with pytest.raises(ValueError, match="missing"):
        scans.require_empty(missing, "missing")
    scans.require_empty(missing.limit(0), "missing")


def test_optional_rows(spark):
    wanted = spark.createDataFrame([("a",), ("b",)], "ref string")
    found = spark.createDataFrame([("a", 5)], "ref string, n int")
    assert sorted(tuple(r) for r in scans.optional_rows(wanted, found, ["ref"], {"n": 0}).collect()) == [("a", 5), ("b", 0)]


def test_batch_refs(spark):
    manifests = spark.createDataFrame([(1, ["b.pdf", "a.pdf", "b.pdf"]), (2, None)], "batch_id int, files array<string>")
    statuses = spark.createDataFrame([(1, ["z.pdf"]), (2, ["y.pdf"]), (3, ["x.v.pdf"])], "batch_id int, files array<string>")
    assert sorted(tuple(r) for r in scans.batch_refs(manifests, statuses).collect()) == [(1, "a", 1), (1, "b", 0), (2, "y", 0), (3, "x.v", 0)]


def test_vocabularies_and_patterns(spark):
    assert scans.vocabulary('# c\nGlass transition: [tg, thermal]\n\n"Yield": ["y", "other"]') == [("Glass transition", "tg", "thermal"), ("Yield", "y", "other")]
    for wrong in ("a: b", "a: [x, y]\na: [z, y]"):
        with pytest.raises(ValueError, match="vocabulary|twice"):
            scans.vocabulary(wrong)
    table = scans.pattern_table([(r"\btg\b", "Glass transition")], ["Glass transition", "Yield", "Melting point"])
    got = spark.createDataFrame([("tg of it",), ("a melting point",), ("yield",)], "t string").select(scans.first_pattern(F.col("t"), table)).collect()
    assert [r[0] for r in got] == ["Glass transition", "Melting point", None]
    with pytest.raises(ValueError, match="unknown"):
        scans.pattern_table([("x", "none")], [])


def test_prompts_and_settings(spark):
    rows = spark.createDataFrame([("a", "---\nid: p1\nversion: 2\n---\nDo it.\n---\n"), ("b", "no head")], "path string, text string")
    assert [tuple(r) for r in scans.prompts(rows).orderBy("path").collect()] == [("a", "p1", "2", "Do it.\n---\n"), ("b", None, None, "no head")]
    assert scans.stage_settings({"effort": "low", "n": 1}, {"s4": {"effort": "high"}}, "s4", {"effort": ["low", "high"]}) == {"effort": "high", "n": 1}
    with pytest.raises(ValueError, match="effort"):
        scans.stage_settings({"effort": "odd"}, {}, "s1", {"effort": ["low"]})
    assert scans.env_settings("# x=1\nA=1\nexport B = 'two'\nnot a line\nC=", {"A": "set"}) == {"B": "two", "C": ""}


def test_publication_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "document_id int, t string")
    out = f"file://{tmp_path}/out"
    sinks.write_new(rows, out)
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_new(rows, out)
    with pytest.raises(ValueError, match="nothing"):
        sinks.write_new(rows.limit(0), f"file://{tmp_path}/none")
    assert not (tmp_path / "none").exists()
    again = sinks.layered(rows, rows.withColumn("t", F.lit("b")), "document_id")
    assert [tuple(r) for r in sinks.layered(again.drop("layer"), rows.withColumn("t", F.lit("b")), "document_id").collect()] == [(1, "b", "recovered")]


def test_escapes_and_archives(spark, tmp_path):
    got = spark.range(1).select(sinks.embedded(F.lit("</script>&\u2028"))).collect()[0][0]
    assert got == "\\u003c/script\\u003e\\u0026\\u2028"
    for wrong in ("../x", "/x", "a/../../x", "C:\\x", "..\\x"):
        with pytest.raises(ValueError, match="unsafe"):
            sinks.safe_members(["fine", wrong])
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/a.txt", "x")
    assert sinks.unpack(str(tmp_path / "a.zip"), str(tmp_path / "to")) == ["d/a.txt"]
    assert (tmp_path / "to/d/a.txt").read_text() == "x"
