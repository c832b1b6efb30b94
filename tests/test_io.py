"""Sources, sinks, loading, streaming, null handling and names."""

import json

import pytest
from pyspark.sql import functions as F

from docstrata.__main__ import main
from docstrata import (
    ancestors,
    array_fields,
    empty_to_null,
    fill_missing,
    json_to_tables,
    load_folder,
    mark_nulls,
    schema_catalog,
    schema_tree,
)
from docstrata.functions.names import child_table_name, object_name, parent_path, routed_table
from docstrata.operators.catalog import with_hierarchy
from docstrata.plans.load import two_level_rows
from docstrata.session import scratch_path, settle
from docstrata.sinks.tables import save_table, write_delimited, write_marked, write_schema_tree, write_tables
from docstrata.sources.delimited import read_delimited
from docstrata.sources.documents import read_documents
from docstrata.sources.files import discover_tables, file_count, file_inventory, folder_count, folder_inventory
from docstrata.streaming.ingest import ingest_documents, ingested_table


def test_catalogue_lists_parents_first(spark):
    docs = spark.sql(
        "SELECT named_struct('$oid', 'z') AS _id, array(named_struct('x', 1, 'b', array(named_struct('y', 1.5D)))) AS a, "
        "array(1L) AS p, array(array(1)) AS q, map('k', 1L) AS m"
    )
    found = schema_catalog(docs)
    assert [tuple(r) for r in found.collect()] == [
        ("_id", "root", "struct"), ("_id.$oid", "_id", "string"), ("a", "root", "array<struct>"), ("a.x", "a", "int"),
        ("a.b", "a", "array<struct>"), ("a.b.y", "a.b", "double"), ("p", "root", "array<bigint>"),
        ("q", "root", "array<array<int>>"), ("m", "root", "map<string,bigint>"),
    ]
    assert [r.Field for r in array_fields(found).collect()] == ["a", "a.b"]
    assert [r.Field for r in ancestors(found, "a.b").collect()] == ["a", "a.b"]
    assert [r.Field for r in ancestors(found, ["a", "b", "y"]).collect()] == ["a", "a.b", "a.b.y"]
    again = with_hierarchy(found.drop("Hierarchy"))
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in found.collect()}


def test_ancestors_compare_whole_segments(spark):
    rows = spark.createDataFrame([("a",), ("ab",), ("a.b",), ("a.bc",)], "Field string")
    assert [r.Field for r in ancestors(rows, "a.bc").collect()] == ["a", "a.bc"]


def test_schema_tree(spark, tmp_path):
    docs = spark.sql("SELECT 1 AS a, named_struct('b', 'x') AS s")
    write_schema_tree(docs, str(tmp_path / "tree"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "tree")).collect()]
    assert "\n".join(lines) == schema_tree(docs).rstrip("\n")


def test_names(spark):
    assert child_table_name("a.b-c.d") == "a_bc_d"
    row = spark.range(1).select(
        routed_table(F.lit("My.File.csv"), "lake").alias("a"), object_name(F.lit("a.b[0]")).alias("b"),
        parent_path(F.lit("a.b.c"), "root").alias("c"), parent_path(F.lit("a"), "root").alias("d"),
    ).collect()[0]
    assert tuple(row) == ("lake.my", "a_b_0", "a.b", "root")


def test_null_cleaning(spark):
    rows = spark.createDataFrame([("", 1, "a", ["x", ""]), (None, None, "", None)], "s string, n int, `t.u` string, a array<string>")
    assert [tuple(r) for r in empty_to_null(rows).collect()] == [(None, 1, "a", ["x", ""]), (None, None, None, None)]
    assert [tuple(r) for r in mark_nulls(rows).collect()] == [("", "1", "a", '["x",""]'), ("NULL", "NULL", "", "NULL")]
    assert [r.s for r in fill_missing(rows, {"s": "N/A"}).collect()] == ["", "N/A"]


def test_delimited_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a,b", 'say "x"', None, {"k": 1}), ("", "c", "NULL", None)], "s string, q string, n string, m map<string,int>"
    )
    write_delimited(rows, str(tmp_path / "t.csv"))
    back = sorted([tuple(r) for r in read_delimited(spark, str(tmp_path / "t.csv")).collect()], key=repr)
    assert back == sorted([("a,b", 'say "x"', None, '{"k":1}'), (None, "c", "NULL", None)], key=repr)
    odd = [("two\nlines", "  spaced  "), ('q"\n,"', "back\\slash"), ("\ttab", "é\r\nx")]
    write_delimited(spark.createDataFrame(odd, "a string, b string"), str(tmp_path / "odd.csv"))
    assert {tuple(r) for r in read_delimited(spark, str(tmp_path / "odd.csv")).collect()} == set(odd)
    write_marked(rows.select("s", "n"), str(tmp_path / "marked"))
    text = {r.value for r in spark.read.text(str(tmp_path / "marked")).collect()}
    assert '"a,b",NULL' in text and "s,n" in text


def test_two_level_extraction(json_docs):
    docs = json_docs(
        '{"_id":1,"list":[{"applicant":"p","moves":[{"date":"d","kind":"","n":1},{"date":"d","kind":"k","n":2}]}]}',
        '{"_id":2,"list":[{"applicant":"q","moves":[]}]}', '{"_id":3,"list":[]}',
    )
    found = two_level_rows(docs, "list", "moves", ["applicant"], drop=["date"])
    assert found.columns == ["_id", "applicant", "kind", "n"]
    assert [tuple(r) for r in mark_nulls(found).collect()] == [("1", "p", "NULL", "1"), ("1", "p", "k", "2")]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "sub" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "other").mkdir()
    (tmp_path / "in" / "People.v1.csv").write_text("id,name\n1,ann\n2,\n")
    (tmp_path / "in" / "sub" / "deep" / "places.csv").write_text("id,name\n7,x\n")
    (tmp_path / "in" / "schema_info.csv").write_text("Field,Hierarchy,Data Type\n")
    (tmp_path / "in" / "other" / "notes.txt").write_text("hello")
    return tmp_path / "in"


def test_inventories(spark, folder):
    files = {r.FilePath.rsplit("/", 1)[-1]: r.Size for r in file_inventory(spark, str(folder)).collect()}
    assert files == {"People.v1.csv": 17, "places.csv": 12, "schema_info.csv": 26, "notes.txt": 5}
    assert file_count(spark, str(folder)).collect()[0].FileCount == 4
    assert {r.Folder for r in folder_inventory(spark, str(folder)).collect()} == {"sub", "other"}
    assert folder_count(spark, f"file:{folder}/").collect()[0].FolderCount == 2
    assert file_count(spark, str(folder / "missing")).collect()[0].FileCount == 0
    assert folder_inventory(spark, str(folder / "missing")).count() == 0


def test_discovery_skips_catalogues_and_other_files(spark, folder):
    write_delimited(spark.range(3), str(folder / "made.csv"))
    found = {r.table_name: r.path.rsplit("/in/", 1)[1] for r in discover_tables(spark, str(folder), "lake").collect()}
    assert found == {"lake.people": "People.v1.csv", "lake.places": "sub/deep/places.csv", "lake.made": "made.csv"}


def test_folder_is_loaded_into_tables(spark, folder, tmp_path):
    for name in ("people", "places"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert sorted(load_folder(spark, str(folder), location=str(tmp_path / "wh"))) == ["people", "places"]
    assert [tuple(r) for r in spark.table("people").orderBy("id").collect()] == [("1", "ann"), ("2", None)]
    load_folder(spark, str(folder), location=str(tmp_path / "wh"))
    assert spark.table("people").count() == 4  # appended


def test_saved_table_modes(spark, tmp_path):
    save_table(spark.range(2), "saved_rows", location=str(tmp_path / "saved"))
    save_table(spark.range(3), "saved_rows", mode="overwrite", location=str(tmp_path / "saved"))
    assert spark.table("saved_rows").count() == 3


def test_files_of_one_table_are_matched_by_name(spark, tmp_path):
    for place, text in (("a", "id,name\n1,ann\n"), ("b", "name,id\nbob,2\n"), ("c", "id,age\n3,30\n")):
        (tmp_path / "in" / place).mkdir(parents=True)
        (tmp_path / "in" / place / "crew.csv").write_text(text)
    spark.sql("DROP TABLE IF EXISTS crew")
    assert load_folder(spark, str(tmp_path / "in"), location=str(tmp_path / "wh"), concurrent=2) == ["crew"]
    found = {(r.id, r.name, r.age) for r in spark.table("crew").collect()}
    assert found == {("1", "ann", None), ("2", "bob", None), ("3", None, "30")}


def test_jobs_from_the_command_line(spark, tmp_path):
    source = tmp_path / "docs.json"
    source.write_text('{"_id":1,"a":[{"x":1},{"x":2}]}\n{"_id":2,"a":[]}\n')
    out = tmp_path / "out"
    main(["flatten", str(source), str(out), "docs"], spark)
    assert {p.name for p in out.iterdir()} == {
        "schema_info.csv", "schema_tree.txt", "schema.json", "docs_main.csv", "a.csv"
    }
    later = tmp_path / "later"
    later.mkdir()
    (later / "empty.json").write_text('{"_id":3,"a":[]}\n')
    schema = f"{out}/schema.json"
    main(["flatten", str(later), str(tmp_path / "out2"), "docs", "--schema", schema, "--format", "parquet"], spark)
    assert spark.read.parquet(str(tmp_path / "out2" / "a.parquet")).columns == ["root_id", "a_pos", "x", "Filename"]
    (later / "more.json").write_text('{"_id":4,"a":[{"x":5}]}\n')
    for _ in range(2):
        main(["ingest", str(later), str(tmp_path / "taken"), "docs", "--schema", schema, "--checkpoint", str(tmp_path / "cp")], spark)
    assert [tuple(r) for r in ingested_table(spark, str(tmp_path / "taken"), "a").collect()] == [(4, 0, 5)]
    spark.sql("DROP TABLE IF EXISTS docs_main")
    spark.sql("DROP TABLE IF EXISTS a")
    main(["load", str(out), "--location", str(tmp_path / "wh")], spark)
    assert spark.table("a").count() == 2 and spark.table("docs_main").count() == 2
    main(["profile", str(out), str(tmp_path / "profile"), "--loose"], spark)
    reports = spark.read.text(str(tmp_path / "profile"), wholetext=True).collect()
    assert sum(r.value.count("DataFrame_name") for r in reports) == 2
    (tmp_path / "catalogs").mkdir()
    (tmp_path / "catalogs" / "f1.csv").write_text("Field,Hierarchy,Data Type\nx,root,string\n")
    (tmp_path / "catalogs" / "f2.csv").write_text("Field,Hierarchy,Data Type\nx,root,bigint\ny,root,int\n")
    for flags, fields in (([], {"x"}), (["--absence"], {"x", "y"})):
        main(["drift", str(tmp_path / "catalogs"), str(tmp_path / "drift"), *flags], spark)
        assert {r.Field for r in read_delimited(spark, str(tmp_path / "drift")).collect()} == fields
    main(["list", str(out), str(tmp_path / "folders"), "--folders"], spark)
    assert {r.Folder for r in read_delimited(spark, str(tmp_path / "folders")).collect()} >= {"a.csv", "docs_main.csv"}
    main(["list", str(out), str(tmp_path / "files")], spark)
    assert read_delimited(spark, str(tmp_path / "files")).columns == ["FilePath", "LastModified", "Size"]


@pytest.mark.parametrize("landed", [False, True])
def test_json_to_tables(spark, tmp_path, landed):
    source = tmp_path / "docs.json"
    source.write_text('{"_id":1,"s":{"k":"v"},"a":[{"x":1},{"x":2}]}\n{"_id":2,"a":[]}\n')
    target = str(tmp_path / "out")
    written = json_to_tables(spark, str(source), target, "docs", landing=str(tmp_path / "landing") if landed else None, concurrent=2)
    assert written == ["docs_main", "a"]
    child = [tuple(r) for r in read_delimited(spark, f"{target}/a.csv").collect()]
    assert sorted(child) == [("1", "0", "1", "docs.json"), ("1", "1", "2", "docs.json")]
    catalog = {r.Field for r in read_delimited(spark, f"{target}/schema_info.csv").collect()}
    assert catalog == {"_id", "a", "a.x", "s", "s.k"}


def test_empty_tables_can_be_left_out(spark, tmp_path):
    tables = {"full": spark.range(1), "none": spark.range(0)}
    assert write_tables(tables, str(tmp_path), "parquet", skip_empty=True, rebalance=True) == ["full"]


def test_multiline_and_given_schema(spark, tmp_path):
    (tmp_path / "doc.json").write_text('[\n {"_id": 1,\n  "a": []},\n {"_id": 2, "a": null}\n]')
    inferred = read_documents(spark, str(tmp_path), multiline=True)
    assert inferred.count() == 2
    schema = spark.sql("SELECT 1L AS _id, array(named_struct('x', 1L)) AS a").schema
    given = read_documents(spark, str(tmp_path), schema, multiline=True)
    assert [r.Field for r in array_fields(schema_catalog(given)).collect()] == ["a"]
    assert array_fields(schema_catalog(inferred)).isEmpty()


def test_stream_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    schema = spark.sql("SELECT 1L AS _id, array(named_struct('x', 1L)) AS a").schema

    def deliver(name, *docs):
        (source / name).write_text("\n".join(json.dumps(d) for d in docs) + "\n")

    def run():
        ingest_documents(
            spark, str(source), schema, str(tmp_path / "out"), str(tmp_path / "cp"), "docs", files_per_trigger=1
        ).awaitTermination()
        return sorted(tuple(r) for r in ingested_table(spark, str(tmp_path / "out"), "a").collect())

    deliver("one.json", {"_id": 1, "a": [{"x": 1}, {"x": 2}]})
    deliver("two.json", {"_id": 2, "a": []})
    first = run()
    assert first == [(1, 0, 1), (1, 1, 2)]
    assert run() == first
    deliver("three.json", {"_id": 3, "a": [{"x": 9}]})
    assert run() == [*first, (3, 0, 9)]
    assert ingested_table(spark, str(tmp_path / "out"), "docs_main").count() == 3


def test_settled_result_is_read_from_its_table(spark):
    settled = settle(spark.range(5).selectExpr("id", "cast(id AS string) AS `a b`"), "five")
    assert settled.count() == 5 and settled.columns == ["id", "a b"]
    assert spark.conf.get("spark.checkpoint.dir") in settled.inputFiles()[0]
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
