import datetime as dt
import io
import zipfile

import pytest

from acreage.sources.files import read_exports
from acreage.sources.workbooks import concatenated, read_workbooks, sheet_rows, workbook_bytes, workbook_rows


def export(kind, rows):
    """Rows of an export whose header stands in row 4, 3 or 5."""
    preamble = [["Rolling sales"], [3, 0, "0"], [], ["as of today"], ["all boroughs"]][:(4, 3, 5)[kind]]
    header = ["BOROUGH", " SALE PRICE ", "NOTE"] + (["ZIP CODE"] if kind else [])
    return [*preamble, header, *[r[:len(header)] for r in rows]]


def sales(kind):
    return [[kind + 1, 1000 * i, f"a <b> & {i}" if i % 3 else None, 10000 + i] for i in range(25)]


def test_workbooks_equal_the_same_text_files(spark, tmp_path):
    (tmp_path / "books").mkdir()
    for kind in range(3):
        rows = export(kind, sales(kind))
        (tmp_path / "books" / f"{kind}.xlsx").write_bytes(workbook_bytes({"first": rows, "other": [["not read"]]}))
        text = "\n".join(",".join("" if v is None else str(v) for v in r) for r in rows)
        (tmp_path / f"{kind}.csv").write_text(text + "\n")
    got = read_workbooks(spark, str(tmp_path / "books"))
    want = read_exports(spark, [str(tmp_path / f"{k}.csv") for k in range(3)])
    assert sorted(got.columns) == sorted(want.columns) == ["BOROUGH", "NOTE", "SALE PRICE", "ZIP CODE"]
    columns = [f"`{c}`" for c in want.columns]
    a, b = (sorted(map(str, df.select(*columns).collect())) for df in (got, want))
    assert a == b and len(a) == 75


def test_a_sheet_without_a_header_is_refused(spark):
    files = spark.createDataFrame([("x", bytearray(workbook_bytes({"s": [["SALE PRICE"], [1]]})))], "file string, content binary")
    with pytest.raises(ValueError, match="no 'SALE PRICE' header"):
        concatenated(workbook_rows(files))
    assert concatenated(workbook_rows(files), candidates=(0,)).collect()[0][0] == "1"


def test_cells_of_every_kind():
    rows = [["text", 1.5, dt.date(2024, 2, 29), None, "é & <x>"], [], [None, None, 7] + [None] * 30 + ["far"]]
    with zipfile.ZipFile(io.BytesIO(workbook_bytes({"s": rows}))) as archive:
        got = dict(sheet_rows(archive, "xl/worksheets/sheet1.xml", False))
    assert got[0] == ["text", "1.5", "2024-02-29", None, "é & <x>"][:5]
    assert got[2][2] == "7" and got[2][33] == "far" and 1 not in got
    sheet = ('<worksheet><sheetData><row><c t="inlineStr"><is><r><t>a</t></r><r><t>b</t></r></is></c><c t="b"><v>1</v></c>'
             '<c t="e"><v>#N/A</v></c><c t="str"><v>f</v></c><c s="1"><v>1.5</v></c></row></sheetData></worksheet>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("s.xml", sheet)
        archive.writestr("xl/styles.xml", '<styleSheet><numFmts><numFmt numFmtId="170" formatCode="[Red]yyyy\\-mm hh:mm"/></numFmts>'
                                          '<cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>')
    with zipfile.ZipFile(out) as archive:
        assert list(sheet_rows(archive, "s.xml", True)) == [(0, ["ab", "true", None, "f", "1904-01-02 12:00:00"])]


def test_no_workbooks(spark):
    files = spark.createDataFrame([("x", None)], "file string, content binary")
    assert workbook_rows(files).count() == 0
    every = spark.createDataFrame([("x", bytearray(workbook_bytes({"a": [[1]], "b": [[2]]})))], "file string, content binary")
    assert sorted(r.sheet for r in workbook_rows(every, None).collect()) == ["a", "b"]
