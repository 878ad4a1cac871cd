import io
import zipfile

import pytest
from pyspark.sql import functions as F

from acreage.llm import warc_zip as W

BIG = "é" * 700
ROWS = [(1, "http://a", BIG), (2, None, BIG), (None, "u\r\nv", BIG), (3, "u", ""), (4, "u", None), (5, "v", "short"),
        (6, "v", "short"), (2, "again", BIG), (None, None, None), (7, "w", "x" * 3_000_000)]
SCHEMA = "page_id long, url string, html string"


def pages(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(1) for c in ("digest", "near", "heavy", "n", "bytes")})


def test_records_come_back(spark):
    got = W.round_trip(pages(spark)).collect()
    assert len(got) == len(ROWS)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in got)
    assert kinds == [(0, "response", 0, 0), (0, "revisit", 2, 1400), (1, "revisit", 2, 1400), (2, "response", 0, 1400),
                     (2, "response", 0, 1400), (3, "response", 0, 0), (4, "response", 0, 0), (5, "response", 0, 5),
                     (6, "response", 0, 5), (7, "response", 0, 3_000_000)]


def test_payloads_are_read_by_range(spark, tmp_path):
    packages = W.write_packages(pages(spark), f"file://{tmp_path}/out")
    got = W.read_packages(packages).collect()
    payloads = {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response" and r.page_id}
    assert payloads == {2: BIG, 3: "", 4: "", 5: "short", 6: "short", 7: "x" * 3_000_000}
    assert sum(r.records for r in packages.collect()) == len(ROWS)


def test_empty_table(spark):
    assert W.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("zip64", [False, True])
def test_directory_of_foreign_packages(monkeypatch, zip64):
    if zip64:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
        for i in range(5):
            package.writestr(f"archive/é{i}", bytes([65 + i]) * (50 * i + 1))
        package.comment = b"PK\x05\x06 in a comment"
    file, size = io.BytesIO(out.getvalue()), len(out.getvalue())
    members = W.directory(file, size)
    assert [m.name for m in members] == [f"archive/é{i}" for i in range(5)]
    assert [W.read_at(file, W.data_start(file, m), m.size) for m in members] == [bytes([65 + i]) * (50 * i + 1) for i in range(5)]


def test_broken_packages_are_refused():
    with pytest.raises(ValueError):
        W.directory(io.BytesIO(b"nothing"), 7)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("a", b"a" * 100)
    file = io.BytesIO(out.getvalue())
    with pytest.raises(ValueError):
        W.data_start(file, W.directory(file, len(out.getvalue()))[0])
