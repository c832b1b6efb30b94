"""Catalogues of raw files, schemas that grow, and loads that can be repeated."""

import pytest
from pyspark.sql import functions as F, types as T

from docstrata.errors import LayoutError
from docstrata.functions.schema_walk import schema_entries
from docstrata.functions.shapes import merged_type, settled, shape_type
from docstrata.operators.drift import type_conflicts
from docstrata.operators.file_catalogs import file_catalogs
from docstrata.plans import incremental
from docstrata.plans.incremental import load_new_files, loaded_table, read_ledger
from docstrata.plans.schema_growth import conformed, replayed, widened_schema
from docstrata.sources.documents import read_documents

FILES = {
    "a.json": ['{"_id":1,"v":1,"n":null,"s":{"x":1},"l":[{"q":1},{"r":"t"}],"p":[1,2],"m":[[{"y":1}]]}', '{"_id":2,"v":2,"e":[]}'],
    "b.json": ['{"_id":1,"v":1.5,"s":{"x":true}}', '{"_id":2,"v":7}', "broken {", "[1]", '{"_id":3} x'],
    "c d.json": ['{"odd.name":1,"k`q":{"c:d":2,"a,b":3}, "big":123456789012345678901234567890}'],
    "none.json": ["7", ""],
}


def test_catalogs_of_many_files_equal_those_of_each(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, lines in FILES.items():
        (folder / name).write_text("\n".join(lines) + "\n")
    got = {}
    for r in file_catalogs(spark, str(folder)).collect():
        got.setdefault(r["filename"], set()).add((r["Field"], r["Hierarchy"], r["Data Type"]))
    assert sorted(got) == ["a.json", "b.json", "c d.json"]
    clean = {"b.json": FILES["b.json"][:2]}
    for name in got:
        one = tmp_path / f"one-{name}"
        one.write_text("\n".join(clean.get(name, FILES[name])))
        want = {(e.field, e.hierarchy, e.text) for e in schema_entries(spark.read.json(str(one)).schema)}
        assert got[name] == {(f, h, "decimal(38,0)" if f == "big" else t) for f, h, t in want}
    conflicts = {(r["Field"], r["Data Type"]) for r in type_conflicts(file_catalogs(spark, str(folder))).collect()}
    assert conflicts == {("v", "bigint"), ("v", "double"), ("s.x", "bigint"), ("s.x", "boolean")}


L, D, S, B, N = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.NullType()


def struct(**fields):
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


@pytest.mark.parametrize("a,b,want", [
    (L, D, D), (L, N, L), (N, N, N), (L, B, S), (L, S, S), (T.IntegerType(), L, L), (T.DecimalType(10, 2), L, T.DecimalType(21, 2)), (T.DecimalType(38, 0), D, D),
    (struct(a=L, b=S), struct(b=L, c=B), struct(a=L, b=S, c=B)), (T.ArrayType(struct(a=L)), T.ArrayType(struct(a=D)), T.ArrayType(struct(a=D))),
    (T.ArrayType(N), T.ArrayType(L), T.ArrayType(L)), (struct(a=L), L, S), (T.MapType(S, L), struct(a=D), T.MapType(S, D)), (T.ArrayType(L), struct(a=L), S),
])
def test_least_types(a, b, want):
    assert merged_type(a, b) == want
    assert merged_type(want, a) == want and merged_type(want, b) == want
    back = merged_type(b, a)
    if isinstance(want, T.StructType):
        assert {f.name: f.dataType for f in back.fields} == {f.name: f.dataType for f in want.fields}
    else:
        assert back == want


def test_shapes_are_read_with_their_odd_names():
    found = shape_type("OBJECT<``: BIGINT, `a,b`: ARRAY<VOID>, `k``q`: OBJECT<>, x: DECIMAL(21,1), y: DECIMAL(30,0), z: VARIANT>")
    assert settled(found) == T.StructType([
        T.StructField("", L), T.StructField("a,b", T.ArrayType(S)), T.StructField("k`q", T.StructType([])), T.StructField("x", D), T.StructField("y", T.DecimalType(38, 0)), T.StructField("z", S),
    ])


def test_replay_leaves_nothing_that_the_wider_schema_holds(spark, tmp_path):
    schema = struct(_id=L, v=L, l=T.ArrayType(struct(a=L)))
    lines = ['{"_id":1,"v":1}', '{"_id":2,"v":2.5}', '{"_id":3,"new":{"x":[1]}}', '{"_id":4,"l":[{"a":"t","b":null}]}', "broken", '{"_id":5,"_id":6}']
    (tmp_path / "d.json").write_text("\n".join(lines))
    read = read_documents(spark, str(tmp_path / "d.json"), schema, rescued_col="rest")
    kept = read.where("rest IS NOT NULL").select("rest")
    wide = widened_schema(schema, kept, "rest")
    assert wide == T.StructType([T.StructField("_id", L), T.StructField("v", D), T.StructField("l", T.ArrayType(struct(a=S, b=S))), T.StructField("new", struct(x=T.ArrayType(L)))])
    again = replayed(kept, "rest", wide, "rest")
    assert {r["rest"] for r in again.where("rest IS NOT NULL").collect()} == {"broken", '{"_id":5,"_id":6}'}
    every = conformed(read.where("rest IS NULL").drop("rest"), wide).unionByName(again.where("rest IS NULL").drop("rest"))
    assert sorted((r["_id"], r["v"], r["new"] and r["new"]["x"], r["l"] and r["l"][0]["a"]) for r in every.collect()) == [
        (1, 1.0, None, None), (2, 2.5, None, None), (3, None, [1], None), (4, None, None, "t")]
    assert widened_schema(schema, kept.where("false"), "rest") == schema


def test_loads_take_each_file_once(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "t.csv").write_text("a,b\n1,x\n2,\n")
    assert load_new_files(spark, str(folder), target, "one").files["t"][0].endswith("t.csv")
    assert load_new_files(spark, str(folder), target, "two").files == {}
    (folder / "more").mkdir()
    (folder / "more" / "t.csv").write_text("c,a\ny,3\n")
    (folder / "u.csv").write_text("k\n9\n")
    for _ in range(2):  # a retry replaces its own rows
        assert sorted(load_new_files(spark, str(folder), target, "three").files) == ["t", "u"]
    (folder / "late.csv").write_text("k\n1\n")
    assert sorted(load_new_files(spark, str(folder), target, "three").files) == ["t", "u"]
    rows = sorted(((r["a"], r["b"], r["c"], r["load_id"]) for r in loaded_table(spark, target, "t", with_load=True).collect()), key=repr)
    assert rows == [("1", "x", None, "one"), ("2", None, None, "one"), ("3", None, "y", "three")]
    (folder / "t.csv").write_text("a,b\n1,x\n2,\n5,z\n")
    last = load_new_files(spark, str(folder), target, "four")
    assert [p.rsplit("/", 1)[1] for p in last.changed] == ["t.csv"] and sorted(last.files) == ["late"]
    assert loaded_table(spark, target, "t").count() == 3 and read_ledger(spark, target).count() == 4
    with pytest.raises(LayoutError):
        loaded_table(spark, target, "nothing")
    with pytest.raises(LayoutError):
        load_new_files(spark, str(folder), target, "a/b")


def test_a_load_that_broke_off_shows_nowhere(spark, tmp_path, monkeypatch):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "t.csv").write_text("a\n1\n")
    (folder / "u.csv").write_text("a\n2\n")
    plain, calls = incremental.read_alike, []

    def breaks(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return plain(*args, **kwargs)

    monkeypatch.setattr(incremental, "read_alike", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        load_new_files(spark, str(folder), target, "one")
    with pytest.raises(LayoutError):
        loaded_table(spark, target, "t")
    assert sorted(load_new_files(spark, str(folder), target, "two").files) == ["t", "u"]
    assert [tuple(r) for r in loaded_table(spark, target, "t", with_load=True).select("a", F.col("load_id")).collect()] == [("1", "two")]
