"""Run folders, workbooks, raw storage and export packages."""

import io
import json
import zipfile

import pytest

from quillmesh.operators import exports
from quillmesh.sources import runs, sheets


def workbook(rows, sheet="KPI_Dictionary"):
    shared = sorted({c for r in rows for c in r if c})
    at = {s: i for i, s in enumerate(shared)}
    cell = lambda i, j, c: f'<c r="{chr(65 + j)}{i}" t="s"><v>{at[c]}</v></c>' if c else ""
    body = "".join(f'<row r="{i}">' + "".join(cell(i, j, c) for j, c in enumerate(r)) + "</row>" for i, r in enumerate(rows, 1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        link = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
        z.writestr("xl/workbook.xml", f'<workbook {ns} {link}><sheets><sheet name="Notes" r:id="r1"/><sheet name="{sheet}" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


HEADER = ["KPI_Code", "Domain", "Parameter", "Variable_Name", "Definition"]
ROW = ["A01", "Academics", "Programmes", "UG programme count", "Number of undergraduate programmes"]


def test_dictionary(spark, tmp_path):
    (tmp_path / "ok.xlsx").write_bytes(workbook([HEADER, ROW, [None] * 5, ["A02", None, "P", "Other", "x"]]))
    rows = {r.entry["KPI_Code"]: r for r in sheets.dictionary(spark, str(tmp_path / "ok.xlsx")).collect()}
    assert set(rows) == {"A01", "A02"}
    assert rows["A01"].embedding_text == "UG programme count: Number of undergraduate programmes"
    # all columns, also empty ones
    assert rows["A02"].source_row.toPython() == {"KPI_Code": "A02", "Domain": None, "Parameter": "P", "Variable_Name": "Other", "Definition": "x"}
    (tmp_path / "other.xlsx").write_bytes(workbook([HEADER, ROW], "Other_Sheet"))
    with pytest.raises(Exception, match="no sheet"):
        sheets.dictionary(spark, str(tmp_path / "other.xlsx")).collect()
    assert sheets.dictionary(spark, str(tmp_path / "other.xlsx"), sheet="Other_Sheet").count() == 1


def test_values_of_cells_keep_their_types():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    kinds = [("A1", "", "<v>5</v>"), ("B1", "", "<v>2.50</v>"), ("C1", ' t="b"', "<v>1</v>"), ("D1", ' t="str"', "<v>5</v>"), ("E1", ' t="inlineStr"', "<is><t> a &quot;b&quot; </t></is>"), ("F1", "", "<v>007</v>"), ("G1", "", "<v>1E-3</v>"), ("AA1", ' t="e"', "<v>#N/A</v>"), ("H1", "", "")]
    body = "<row>" + "".join(f'<c r="{at}"{kind}>{value}</c>' for at, kind, value in kinds) + "</row>"
    data = io.BytesIO(workbook([["x"]]))
    with zipfile.ZipFile(data) as old:
        parts = {n: old.read(n) for n in old.namelist()}
    parts["xl/worksheets/sheet2.xml"] = f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>".encode()
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in parts.items():
            z.writestr(name, content)
    got = {column: (text, json.loads(value)) for _, column, text, value in sheets.sheet_cells(out.getvalue())}
    assert got == {0: ("5", 5), 1: ("2.50", 2.5), 2: ("True", True), 3: ("5", "5"), 4: ('a "b"', 'a "b"'), 5: ("007", "007"), 6: ("1E-3", 0.001), 26: ("#N/A", "#N/A")}


@pytest.mark.parametrize("rows,error", [([HEADER[:3], ROW[:3]], "missing columns"), ([HEADER], "no rows"), ([HEADER, ROW, ROW], "twice"), ([HEADER, [None] + ROW[1:]], "without a required"), ([HEADER, ROW[:4] + [None]], "without a required"), ([["kpi_code", *HEADER[1:]], ROW], "missing columns")])
def test_bad_dictionaries(spark, tmp_path, rows, error):
    (tmp_path / "bad.xlsx").write_bytes(workbook(rows))
    with pytest.raises(ValueError, match=error):
        sheets.dictionary(spark, str(tmp_path / "bad.xlsx"))


def test_run_folders(spark, tmp_path):
    for run, started in (("r1", "2024-01-01"), ("r2", "2024-02-01"), ("broken", None)):
        folder = tmp_path / "site" / run / "program2"
        folder.mkdir(parents=True)
        text = json.dumps({"run_id": int(run[1]), "status": "SUCCESS", "started_at": started}) if started else "{not json"
        (folder.parent / "manifest.json").write_text(text)
        (folder / "artifacts.json").write_text(json.dumps([{"source_url": "http://a/x y", "content_type": "text/xml", "checksum": "ab"}]))
    assert [r.run_id for r in runs.manifests(spark, str(tmp_path)).collect()] == [2, 1]
    assert {(r.category, r.file_name) for r in runs.artifact_lists(spark, str(tmp_path)).collect()} == {("xml", "x_y.xml")}


def test_raw_storage_is_content_addressed(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = spark.createDataFrame([("http://a", "text/html", b"x"), ("http://b", "text/html", b"x"), ("http://c.pdf", None, b"y"), ("http://d", None, None)], "source_url string, content_type string, content binary")
    exports.write_raw(rows, path)
    exports.write_raw(rows, path)
    assert sorted((r.category, bytes(r.content)) for r in exports.read_raw(spark, path).collect()) == [("html", b"x"), ("pdf", b"y")]


def test_export_package(spark, tmp_path):
    sources = spark.createDataFrame([("u1", "text/html"), ("u2", "text/html")], "source_url string, content_type string")
    evidence = spark.createDataFrame([("u1", "text"), ("u1", "table")], "source_url string, evidence_type string")
    rejected = spark.createDataFrame([("u3", "off-host"), ("u2", "again")], "source_url string, error_message string")
    got = exports.write_package(sources, evidence, rejected, str(tmp_path / "out")).first()
    assert tuple(got) == (3, 2, 2, 1, 2)
    assert spark.read.json(str(tmp_path / "out" / "evidence")).count() == 2
