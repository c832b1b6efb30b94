"""Nothing is lost without a word: columns, rows, files, fields and values that do not fit."""

import os

import pytest
from pyspark.sql import functions as F

from docstrata import LayoutError, NameClash, load_folder, type_conflicts_with_absence
from docstrata.__main__ import main
from docstrata.operators.drift import group_conflicts
from docstrata.plans.load import folder_tables, two_level_rows
from docstrata.plans.table_sets import json_to_tables
from docstrata.sinks.tables import write_delimited, write_tables
from docstrata.sources.delimited import read_catalogs, read_delimited, read_delimited_by_name
from docstrata.sources.documents import read_document_lists, read_documents, with_origin
from docstrata.sources.files import discover_tables, folder_inventory
from docstrata.streaming.ingest import ingest_documents, ingested_table


def test_columns_far_to_the_right_are_read(spark, tmp_path):
    head = [f"c{i}" for i in range(72)]
    (tmp_path / "wide.csv").write_text(",".join(["Field", "Data Type", *head, "Hierarchy"]) + "\n" + ",".join(["x", "int", *head, "top"]) + "\n")
    assert [tuple(r) for r in read_catalogs(spark, str(tmp_path)).collect()] == [("x", "top", "int", "wide.csv")]


def test_rows_that_look_like_headers_are_rows(spark, tmp_path):
    (tmp_path / "a b+c.csv").write_text("name,note\nb,x\nnote,name\nname,note\n")
    found = {tuple(r) for r in read_delimited_by_name(spark, str(tmp_path)).collect()}
    assert found == {(*row, "a b+c.csv") for row in [("b", "x"), ("note", "name"), ("name", "note")]}


def test_headers_are_checked(spark, tmp_path):
    (tmp_path / "twice.csv").write_text("a,a\n1,2\n")
    with pytest.raises(NameClash):
        read_delimited_by_name(spark, str(tmp_path))
    with pytest.raises(LayoutError):
        read_delimited_by_name(spark, str(tmp_path), ["a", "b"])


def test_one_column_tables_keep_all_rows(spark, tmp_path):
    for name, kind in (("text", "string"), ("number", "int")):
        rows = spark.createDataFrame([("1",), (None,), ("2",), (None,)], "v string").select(F.col("v").cast(kind))
        write_delimited(rows, str(tmp_path / f"{name}.csv"))
        assert sorted(r.v or "" for r in read_delimited(spark, str(tmp_path / f"{name}.csv")).collect()) == ["", "", "1", "2"]


def test_tables_with_hidden_names_are_loaded(spark, tmp_path):
    source = tmp_path / "docs.json"
    source.write_text('{"_id":1,"_embedded":[{"x":1}]}\n')
    json_to_tables(spark, str(source), str(tmp_path / "out"), "docs")
    tables = folder_tables(spark, str(tmp_path / "out"))
    assert sorted(tables) == ["docs_main", "t_embedded"] and tables["t_embedded"].count() == 1
    with pytest.raises(NameClash):
        write_tables({"_a": spark.range(1), "t_a": spark.range(1)}, str(tmp_path / "clash"))


def test_profile_takes_all_files_of_a_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "people.v1.csv").write_text("id\n1\n2\n")
    (tmp_path / "in" / "people.v2.csv").write_text("id\n3\n4\n5\n")
    main(["profile", str(tmp_path / "in"), str(tmp_path / "profile")], spark)
    report = spark.read.option("multiLine", True).json(str(tmp_path / "profile")).collect()
    assert [r.DataFrame_name for r in report] == ["people"] and report[0].column_frequencies.id.integer_count == 5


def test_folders_are_resolved(spark, tmp_path, monkeypatch):
    data = tmp_path / "mydata" / "x" / "my data"
    (data / "sub").mkdir(parents=True)
    (data / "sub" / "t.csv").write_text("a\n1\n")
    relative = os.path.relpath(data)
    for folder in (str(data), f"{data.parent}/../x/my data", relative, f"file:{data}/"):
        assert [r.table_name for r in discover_tables(spark, folder).collect()] == ["t"]
        assert [r.Folder for r in folder_inventory(spark, folder).collect()] == ["sub"]
        assert folder_tables(spark, folder)["t"].count() == 1
    for job in (lambda: load_folder(spark, str(tmp_path / "no")), lambda: discover_tables(spark, str(tmp_path / "no"))):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            job()


def test_fields_are_never_replaced(spark, json_docs, tmp_path):
    with pytest.raises(NameClash):
        with_origin(json_docs('{"_id":1,"Filename":"mine"}'))
    source = tmp_path / "own.json"
    source.write_text('{"_id":1,"Filename":"mine"}\n')
    json_to_tables(spark, str(source), str(tmp_path / "out"), "docs", origin_col="from_file")
    row = read_delimited(spark, str(tmp_path / "out" / "docs_main.csv")).first()
    assert row.Filename == "mine"
    for field in ("ingest_batch", "__rescued"):
        schema = spark.sql(f"SELECT 1L AS _id, 'x' AS {field}").schema
        with pytest.raises(NameClash):
            ingest_documents(spark, str(tmp_path), schema, str(tmp_path / "t"), str(tmp_path / "c"), "docs")


def test_two_level_clashes_are_found_while_planning(spark):
    docs = spark.sql("SELECT 1 AS _id, array(named_struct('n', 1, 'a.b', 2, 'm', array(named_struct('n', 3, 'k', 4)))) AS l")
    with pytest.raises(NameClash):
        two_level_rows(docs, "l", "m", ["n"])
    assert [tuple(r) for r in two_level_rows(docs, "l", "m", ["a.b"], drop=["k"]).collect()] == [(1, 2, 3)]


SPOILT = ['{"_id":1,"a":[{"x":2}]}', '{"_id":2,"a":[{"x":2,"y":1}]}', "not json", '{"_id":"oops"}', '{"_id":5,"newarr":[1]}', '{"_id":6,"a":null}']


def test_what_does_not_fit_a_schema_is_kept(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "d.json").write_text("\n".join(SPOILT) + "\n")
    schema = spark.sql("SELECT 1L AS _id, array(named_struct('x', 1L)) AS a").schema
    kept = {None: set(), True: set()}
    for r in read_documents(spark, str(source), schema, rescued_col="lost").collect():
        kept[None if r.lost is None else True].add(r.lost or r._id)
    assert kept == {None: {1, 6}, True: set(SPOILT[1:5])}
    with pytest.raises(Exception):
        read_documents(spark, str(source), schema, strict=True).collect()
    json_to_tables(spark, str(source), str(tmp_path / "out"), "docs", schema, file_format="parquet")
    lost = {(r.root_id, r.rescued, r.Filename) for r in spark.read.parquet(str(tmp_path / "out" / "docs_rescued.parquet")).collect()}
    assert lost == {(i, line, "d.json") for i, line in zip((2, None, None, 5), SPOILT[1:5])}
    assert {r._id for r in spark.read.parquet(str(tmp_path / "out" / "docs_main.parquet")).collect()} == {1, 2, 5, 6}
    ingest_documents(spark, str(source), schema, str(tmp_path / "taken"), str(tmp_path / "cp"), "docs").awaitTermination()
    assert {r.rescued for r in ingested_table(spark, str(tmp_path / "taken"), "docs_rescued").collect()} == set(SPOILT[1:5])


def test_broken_list_files_stop_or_are_kept(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"_id":1},{"_id":2}]')
    (tmp_path / "bad.json").write_text('[{"_id":3},')
    schema = spark.sql("SELECT 1L AS _id").schema
    rows = {tuple(r) for r in read_document_lists(spark, str(tmp_path), schema, rescued_col="lost").collect()}
    assert rows == {(0, 1, None), (1, 2, None), (None, None, '[{"_id":3},')}
    with pytest.raises(Exception):
        read_document_lists(spark, str(tmp_path), schema).collect()


def test_groups_of_files_say_the_same_as_lists_of_files(spark):
    rows = [("x", "int", f"f{i}") for i in range(6)] + [("y", "int" if i % 2 else "string", f"f{i}") for i in range(5)] + [("z", "int", "f1")]
    catalog = spark.createDataFrame(rows, "Field string, `Data Type` string, filename string")
    conflicts, members = group_conflicts(catalog)
    named = {(r.Field, r["Data Type"], r.filename) for r in conflicts.join(members, "file_group").collect()}
    listed = {(r.Field, r["Data Type"], f) for r in type_conflicts_with_absence(catalog).collect() for f in r.filename}
    assert named == listed
    assert members.select("file_group").distinct().count() == 4
    assert all(r.files == members.where(members.file_group == r.file_group).count() for r in conflicts.collect())
