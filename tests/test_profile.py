"""Column profiles."""

import json

import pytest
from pyspark.sql import types as T

from docstrata import LayoutError, profile_columns, profile_reports, profile_tables
from docstrata.plans.profiles import add_delivery, grown_profile
from docstrata.sinks.tables import write_profile


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "c string")


def profile(df, strict=True):
    return profile_columns(df, "t", strict).collect()


@pytest.mark.parametrize("values, expected", [
    (("12", "", None), "integer"),
    (("1.5", "2"), "decimal"),
    (("a", "1"), "string"),
    (("-3",), "string"),
    ((None, None), "null"),
    (("", None), "null"),
    ((), "null"),
    (("1e5", "+1"), "string"),
    (("1.", ".5"), "string"),
    (("12\n",), "integer"),
])
def test_classes_of_text(spark, values, expected):
    assert profile(texts(spark, *values))[0].column_class == expected


def test_mixed_only_when_not_strict(spark):
    values = texts(spark, "a", "1", "", None)
    assert profile(values)[0].column_class == "string"
    assert profile(values, strict=False)[0].column_class == "mixed"
    assert profile(texts(spark, "a", ""), strict=False)[0].column_class == "string"


def test_counts_add_up(spark):
    row = profile(texts(spark, "12", "1.5", "x", "", None, "7"))[0]
    assert (row.total_count, row.null_count, row.empty_count, row.integer_count, row.decimal_count, row.string_count) == (
        6, 1, 1, 2, 3, 4
    )
    assert row.null_count + row.empty_count + row.string_count == row.total_count


def test_typed_columns_count_like_their_text(spark):
    values = [0.0, -0.0, 1.5, -1.5, 1e-3, 9.99e-4, 1e7, 9999999.0, float("nan"), float("inf"), 5e-324, None]
    numbers = spark.createDataFrame(
        [(v, v, None if v is None or v != v or abs(v) > 1e9 else int(v), v == 1.5) for v in values],
        "d double, f float, i bigint, b boolean",
    ).selectExpr("*", "cast(try_cast(d AS decimal(20, 4)) AS decimal(20,4)) AS m", "date'2020-01-01' AS day", "array(d) AS a")
    plain = numbers.selectExpr(
        "cast(d AS string) d", "cast(f AS string) f", "cast(i AS string) i", "cast(b AS string) b", "cast(m AS string) m",
        "cast(day AS string) day", "to_json(a) a",
    )
    counts = ("total_count", "null_count", "empty_count", "integer_count", "decimal_count", "string_count", "column_class")
    typed = {r.column_name: [r[c] for c in counts] for r in profile(numbers)}
    assert typed == {r.column_name: [r[c] for c in counts] for r in profile(plain)}


def test_several_tables(spark):
    found = profile_tables({"a": texts(spark, "1"), "b": texts(spark, "x", "y")}).collect()
    assert [(r.DataFrame_name, r.total_count, r.column_class) for r in found] == [("a", 1, "integer"), ("b", 2, "string")]
    with pytest.raises(LayoutError):
        profile_tables({})


def test_wide_table_in_one_aggregate(spark):
    wide = spark.range(50).selectExpr(*[f"cast(id AS string) AS c{i}" for i in range(300)])
    found = profile(wide)
    assert len(found) == 300 and {r.column_class for r in found} == {"integer"}


def test_report_layout(spark, tmp_path):
    frame = spark.createDataFrame([("1", None, "a", ""), ("2", "2.5", "b", None)], "i string, d string, s string, n string")
    report = json.loads(profile_reports({"t": frame}).collect()[0].report)
    assert report["DataFrame_name"] == "t"
    assert report["column_names"] == ["i", "d", "s", "n"]
    assert T.StructType.fromJson(report["schema"]) == frame.schema
    assert [report[f"{c}_columns"] for c in ("integer", "decimal", "string", "mixed", "null")] == [["i"], ["d"], ["s"], [], ["n"]]
    assert report["column_frequencies"]["d"] == {
        "null_count": 1, "empty_count": 0, "integer_count": 0, "decimal_count": 1, "string_count": 1
    }
    write_profile({"t": frame}, str(tmp_path / "profile"))
    assert '"DataFrame_name" : "t"' in spark.read.text(str(tmp_path / "profile"), wholetext=True).collect()[0].value


def test_states_of_deliveries_add_up(spark, tmp_path):
    target = str(tmp_path / "state")
    assert grown_profile(spark, target).collect() == []
    first = spark.createDataFrame([("1", 2), ("", None), ("a", 3)], "a string, b int")
    second = spark.createDataFrame([("1.5", 1.5), (None, 2.0)], "a string, c double")
    add_delivery({"t": first, "u": first.limit(0)}, target, "one")
    for _ in range(2):  # a retry replaces
        add_delivery({"t": second}, target, "two")
    whole = profile_tables({"t": first.unionByName(second, allowMissingColumns=True), "u": first.limit(0)}).drop("ordinal")
    assert sorted(grown_profile(spark, target).drop("ordinal").collect()) == sorted(whole.collect())


def test_types_that_changed_are_all_named(spark, tmp_path):
    target = str(tmp_path / "state")
    add_delivery({"t": spark.range(2)}, target, "one")
    add_delivery({"t": spark.range(2).selectExpr("string(id) AS id")}, target, "two")
    row = grown_profile(spark, target).first()
    assert (row.data_type, row.total_count, row.integer_count, row.column_class) == ("bigint|string", 4, 4, "integer")
    with pytest.raises(LayoutError):
        add_delivery({"t": spark.range(2)}, target, "../x")
