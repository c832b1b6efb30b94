"""Type drift over catalogue sets."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from docstrata import melt_types, pivot_types, type_conflicts, type_conflicts_with_absence, types_by_file
from docstrata.operators.absence import absence_bitmaps, opened_absences
from docstrata.operators.drift import as_delimited_report, catalog_entries
from docstrata.sinks.tables import write_drift_report
from docstrata.sources.delimited import read_catalogs, read_delimited

ABSENT = "Data Type Not Present"


def catalog(spark, *rows):
    return spark.createDataFrame(list(rows), "Field string, `Data Type` string, filename string")


def listed(df):
    """All names per field and type, whatever rows they were cut into."""
    found = defaultdict(list)
    for row in df.collect():
        found[row.Field, row["Data Type"]] += row.filename
    return {key: sorted(names) for key, names in found.items()}


@pytest.fixture
def two_files(spark):
    return catalog(spark, ("x", "string", "f1"), ("y", "int", "f1"), ("x", "bigint", "f2"))


def test_conflicts(two_files):
    assert listed(type_conflicts(two_files)) == {("x", "string"): ["f1"], ("x", "bigint"): ["f2"]}


def test_conflicts_with_absence(two_files):
    assert listed(type_conflicts_with_absence(two_files)) == {
        ("x", "string"): ["f1"], ("x", "bigint"): ["f2"], ("y", "int"): ["f1"], ("y", ABSENT): ["f2"]
    }


def test_conflict_within_one_file_shows_without_absence_only(spark):
    rows = catalog(spark, ("x", "string", "f1"), ("x", "bigint", "f1"))
    assert listed(type_conflicts(rows)) == {("x", "string"): ["f1"], ("x", "bigint"): ["f1"]}
    assert listed(type_conflicts_with_absence(rows)) == {}


def test_file_is_named_as_often_as_it_lists_a_field(spark):
    rows = catalog(spark, ("x", "string", "f1"), ("x", "string", "f1"), ("x", "int", "f2"))
    assert listed(type_conflicts(rows))["x", "string"] == ["f1", "f1"]
    assert listed(type_conflicts(catalog_entries(rows))) == listed(type_conflicts(rows))


def test_rows_without_field_or_type_do_not_count(spark):
    rows = catalog(spark, ("x", "int", "f1"), ("x", None, "f2"), (None, "int", "f2"), ("null", "int", "f1"), ("null", "NA", "f1"))
    assert listed(type_conflicts(rows)) == {("null", "int"): ["f1"], ("null", "NA"): ["f1"]}
    assert listed(type_conflicts_with_absence(rows)) == {}  # f2 has no typed row and drops out


def test_first_type_by_order(spark):
    rows = spark.createDataFrame(
        [("x", "string", "f1", 1), ("x", "bigint", "f1", 2)], "Field string, `Data Type` string, filename string, n int"
    )
    assert [r["Data Type"] for r in types_by_file(rows, order_col="n").collect()] == ["string"]
    assert [r["Data Type"] for r in types_by_file(rows).collect()] == ["bigint"]


def test_wide_form_and_back(two_files):
    wide = pivot_types(two_files)
    assert {r.Field: (r.f1, r.f2) for r in wide.collect()} == {"x": ("string", "bigint"), "y": ("int", ABSENT)}
    long = {tuple(r) for r in melt_types(wide).collect()}
    assert long == {("x", "f1", "string"), ("x", "f2", "bigint"), ("y", "f1", "int"), ("y", "f2", ABSENT)}
    assert {tuple(r) for r in types_by_file(two_files).collect()} == long


CATALOGS = st.lists(
    st.tuples(st.sampled_from("abcdef"), st.sampled_from(["int", "string", "double"]), st.sampled_from([f"f{i}" for i in range(9)])),
    min_size=1, max_size=60,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=CATALOGS, hot=st.integers(0, 40))
def test_reports_against_brute_force(spark, rows, hot):
    """Short lists, so that every report is cut into parts, and one entry holding many of the rows."""
    rows = rows + [rows[0]] * hot
    found = catalog(spark, *rows)
    by_type = defaultdict(list)
    first = {}
    for field, data_type, file in rows:
        by_type[field, data_type].append(file)
        first[field, file] = min(data_type, first.get((field, file), data_type))
    types = defaultdict(set)
    for field, data_type in by_type:
        types[field].add(data_type)
    expected = {key: sorted(names) for key, names in by_type.items() if len(types[key[0]]) > 1}
    assert listed(type_conflicts(found, files_per_row=3)) == expected

    fields, files = {f for f, _ in first}, {f for _, f in first}
    grid = {(field, file): first.get((field, file), ABSENT) for field in fields for file in files}
    long = {(r.Field, r.filename): r["Data Type"] for r in types_by_file(found, files_per_row=2).collect()}
    assert long == grid
    absent = defaultdict(list)
    for (field, file), data_type in grid.items():
        absent[field, data_type].append(file)
    kinds = defaultdict(set)
    for field, data_type in absent:
        kinds[field].add(data_type)
    assert listed(type_conflicts_with_absence(found, files_per_row=2)) == {
        key: sorted(names) for key, names in absent.items() if len(kinds[key[0]]) > 1
    }


def test_lists_stay_short(spark):
    rows = catalog(spark, *[("x", "int", f"f{i:04d}") for i in range(500)], ("x", "string", "g"), *[("x", "int", "hot")] * 400)
    parts = type_conflicts(rows, files_per_row=50).collect()
    assert max(len(r.filename) for r in parts) < 150
    assert sum(len(r.filename) for r in parts) == 901
    missing = type_conflicts_with_absence(rows, files_per_row=50).collect()
    assert max(len(r.filename) for r in missing) < 100


def test_catalogues_are_merged_by_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text('Field,Hierarchy,Data Type\nx,root,string\n"m",root,"map<string,bigint>"\n')
    (tmp_path / "two.csv").write_text("Data Type,Field,Hierarchy\nbigint,x,root\nint,null,root\n")
    (tmp_path / "skip.txt").write_text("nothing")
    merged = {tuple(r) for r in read_catalogs(spark, str(tmp_path)).collect()}
    assert merged == {
        ("x", "root", "string", "one.csv"), ("m", "root", "map<string,bigint>", "one.csv"),
        ("x", "root", "bigint", "two.csv"), ("null", "root", "int", "two.csv"),
    }


def test_catalogue_without_header_is_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("x,root,string\n")
    with pytest.raises(Exception, match="no header row"):
        read_catalogs(spark, str(tmp_path)).collect()


def test_report_as_delimited_file(spark, two_files, tmp_path):
    write_drift_report(type_conflicts_with_absence(two_files), str(tmp_path / "report.csv"))
    back = {(r.Field, r["Data Type"], r.filename) for r in read_delimited(spark, str(tmp_path / "report.csv")).collect()}
    assert back == {("x", "string", "f1"), ("x", "bigint", "f2"), ("y", "int", "f1"), ("y", ABSENT, "f2")}
    assert as_delimited_report(type_conflicts(two_files)).schema["filename"].dataType.simpleString() == "string"


def names(df):
    return sorted((r.Field, r["Data Type"], r.filename) for r in df.collect())


@pytest.mark.parametrize("per_shelf", [1, 3, 16_384])
def test_bitmaps_name_the_files_of_the_report(spark, per_shelf):
    rows = [(f"x{i % 7}", ("int", "string")[i * i % 5 % 2], f"f{i * 13 % 29}") for i in range(120)]
    rows += [("all", "int", f"f{i}") for i in range(29)] + [("x1", None, "g"), (None, "int", "g"), ("x1", "int", None), rows[0]]
    report = [(f, t, n) for (f, t), found in listed(type_conflicts_with_absence(catalog(spark, *rows[:-2]))).items() for n in found]
    bitmaps, places = absence_bitmaps(catalog(spark, *rows), files_per_shelf=per_shelf)
    assert names(opened_absences(bitmaps, places)) == sorted((f, t, n) for f, t, n in report if n is not None)
    counted = bitmaps.groupBy("Field", "Data Type").agg({"files": "sum"}).collect()
    assert {(r[0], r[1]): r[2] for r in counted} == {(f, t): len(n) for (f, t), n in listed(type_conflicts_with_absence(catalog(spark, *rows[:-2]))).items()}


def test_a_shelf_of_more_files_than_a_bitmap_holds(spark):
    files = spark.range(40_000).selectExpr("'x' AS Field", "'int' AS `Data Type`", "concat('f', id) AS filename")
    bitmaps, places = absence_bitmaps(files.union(catalog(spark, ("y", "int", "f7"))), files_per_shelf=100_000)
    assert places.select("shelf", "bucket").distinct().count() == 2
    assert [(r.Field, r["Data Type"], r.files) for r in bitmaps.orderBy("files").collect()] == [("y", "int", 1), ("y", ABSENT, 39_999)]
    opened = opened_absences(bitmaps, places)
    assert opened.count() == opened.distinct().count() == 40_000
    assert opened.where(opened["Data Type"] == ABSENT).where("filename = 'f7'").isEmpty()


def test_no_catalogue_rows_make_no_bitmaps(spark):
    bitmaps, places = absence_bitmaps(catalog(spark))
    assert bitmaps.isEmpty() and opened_absences(bitmaps, places).isEmpty()
