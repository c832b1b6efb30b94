"""Headers from the first bytes of files."""

import bz2
import gzip
import io

import pytest
from pyspark.errors import PythonException

from docstrata.sources import first_lines as module
from docstrata.sources.delimited import file_headers, read_delimited_by_name
from docstrata.sources.files import list_files
from docstrata.sources.first_lines import BLOCK, first_line, first_lines


def by_name(found):
    return {r["path"].rsplit("/", 1)[1]: r["header"] for r in found.collect()}


@pytest.mark.parametrize("text, want", [
    (b"", None), (b"\n", ""), (b"a,b\r\n1,2\n", "a,b"), (b"a,b\r1,2", "a,b"), (b"only", "only"), ("größe\n1".encode(), "größe"),
    (b"x" * (BLOCK + 7) + b"\ny", "x" * (BLOCK + 7)),
])
def test_first_line_of_a_stream(text, want):
    assert first_line(io.BytesIO(text)) == want


def test_no_more_than_the_header_is_read():
    stream = io.BytesIO(b"a,b\n" + b"1,2\n" * 1_000_000)
    assert first_line(stream) == "a,b" and stream.tell() == BLOCK


@pytest.fixture
def folder(tmp_path):
    below = tmp_path / "de ep+x" / "t.csv"
    below.mkdir(parents=True)
    (tmp_path / "a b.csv").write_bytes("﻿id,näme\r\n1,x\r\n".encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "blank.csv").write_bytes(b"\n")
    (tmp_path / "note.txt").write_bytes(b"no table\n")
    (tmp_path / "_hidden.csv").write_bytes(b"h\n1\n")
    (below / "part-0.csv").write_bytes(b"id,v\n1,2\n")
    (below / "part-1.csv.gz").write_bytes(gzip.compress(b"v,id\n3,4\n"))
    (below / "part-2.csv.bz2").write_bytes(bz2.compress(b"id\n5\n"))
    return tmp_path


def test_same_first_lines_as_a_scan(spark, folder, monkeypatch):
    opened = first_lines(spark, str(folder)).collect()
    monkeypatch.setattr(module, "_store", lambda root: 1 / 0)  # a store that only Spark opens
    scanned = first_lines(spark, str(folder)).collect()
    plain = lambda rows: sorted((r["path"], r["header"].removeprefix("﻿")) for r in rows)
    assert plain(opened) == plain(scanned) and len(opened) == 6


def test_files_known_or_not_of_a_table_stay_closed(spark, folder):
    first = by_name(file_headers(spark, str(folder)))
    assert set(first) == {"a b.csv", "blank.csv", "part-0.csv", "part-1.csv.gz", "part-2.csv.bz2"} and first["part-1.csv.gz"] == "v,id"
    (folder / "note.gz").write_bytes(b"fails when opened")
    (folder / "de ep+x" / "t.csv" / "part-3.csv.gz").write_bytes(b"fails when opened")
    with pytest.raises(PythonException):
        file_headers(spark, str(folder)).collect()
    known = list_files(spark, str(folder)).where("path LIKE '%/part-3.csv.gz'")
    assert by_name(file_headers(spark, str(folder), known=known)) == first


def test_files_match_by_header(spark, folder):
    (folder / "blank.csv").unlink()
    rows = read_delimited_by_name(spark, str(folder), ["id", "v"], required=["id"]).select("id", "v").collect()
    assert sorted((r["id"], r["v"] or "") for r in rows) == [("1", ""), ("1", "2"), ("4", "3"), ("5", "")]
