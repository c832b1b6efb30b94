"""Main and child tables on hand-written documents."""

import pytest
from pyspark.sql import functions as F, types as T

from docstrata import LayoutError, NameClash, child_table, child_tables, drop_arrays, expand_structs, main_table
from docstrata.functions.schema_walk import array_paths
from docstrata.operators.extract import batches, row_counts, tables_as_one
from docstrata.plans.table_sets import flatten_documents
from docstrata.workload.shapes import text_docs
from compare import SF_DIR


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_only_documents_with_elements_reach_the_child_table(json_docs):
    docs = json_docs('{"_id":"k1","arr":[{"v":1}]}', '{"_id":"k2","arr":[]}', '{"_id":"k3","arr":null}')
    child = child_table(docs, "arr")
    assert child.columns == ["root_id", "arr_pos", "v"]
    assert rows(child) == [("k1", 0, 1)]
    assert main_table(docs).count() == 3


def test_struct_expansion_is_breadth_first(spark):
    docs = spark.sql(
        "SELECT named_struct('x', 1, 'b', named_struct('y', 2)) AS a, 3 AS c, named_struct('z', 4) AS d"
    )
    assert expand_structs(docs).columns == ["c", "a_x", "d_z", "a_b_y"]
    assert rows(expand_structs(docs)) == [(3, 1, 4, 2)]
    assert expand_structs(docs, prefixed=False).columns == ["c", "x", "z", "y"]


def test_arrays_are_dropped_at_the_top_and_inside_structs(spark):
    docs = spark.sql(
        "SELECT named_struct('x', 1, 'z', array(1)) AS a, array(2) AS r, named_struct('only', array(3)) AS s, "
        "named_struct('deep', named_struct('arr', array(1), 'k', 7), 'gone', named_struct('arr', array(1))) AS t"
    )
    pruned = drop_arrays(docs)
    assert pruned.schema.simpleString() == "struct<a:struct<x:int>,t:struct<deep:struct<k:int>>>"
    assert main_table(docs).columns == ["a_x", "t_deep_k"]


def test_null_struct_stays_null_when_arrays_are_dropped(spark):
    docs = spark.sql("SELECT CAST(NULL AS struct<x:int,z:array<int>>) AS a")
    assert drop_arrays(docs).collect()[0]["a"] is None


def test_struct_key_is_expanded_like_any_struct(json_docs):
    docs = json_docs('{"_id":{"$oid":"z"},"arr":[{"v":1}]}')
    assert child_table(docs, "arr").columns == ["arr_pos", "v", "root_id_$oid"]
    assert main_table(docs).columns == ["_id_$oid"]


def test_repeated_segment_gets_a_full_position_name(json_docs):
    docs = json_docs('{"_id":1,"phone":[{"phone":[{"n":1},{"n":2}]}]}')
    child = child_table(docs, "phone.phone")
    assert child.columns == ["root_id", "phone_pos", "phone_phone_pos", "n"]
    assert rows(child) == [(1, 0, 0, 1), (1, 0, 1, 2)]


def test_position_name_gives_way_to_an_element_field(json_docs):
    docs = json_docs('{"_id":1,"a":[{"b":[{"b_pos":7}]}]}')
    assert child_table(docs, "a.b").columns == ["root_id", "a_pos", "a_b_pos", "b_pos"]


def test_names_differing_in_case_survive(json_docs):
    docs = json_docs('{"_id":0,"a":1,"A":2}')
    assert rows(main_table(docs).select("a", "A")) == [(1, 2)]


def test_clash_after_prefixing_names_both_paths(json_docs):
    docs = json_docs('{"s":{"f":1},"s_f":2}')
    with pytest.raises(NameClash) as caught:
        main_table(docs)
    assert sorted(caught.value.paths) == ["s.f", "s_f"]


def test_clash_of_root_key_with_an_element_field(json_docs):
    with pytest.raises(NameClash):
        child_table(json_docs('{"_id":1,"a":[{"root_id":2}]}'), "a")


def test_null_struct_on_the_way_gives_no_row(json_docs):
    docs = json_docs('{"_id":1,"s":{"arr":[{"v":1}],"k":5}}', '{"_id":2,"s":null}')
    assert rows(child_table(docs, "s.arr")) == [(1, 0, 1)]
    assert rows(main_table(docs)) == [(1, 5), (2, None)]


def test_child_tables_cover_every_array_of_structs(json_docs):
    docs = json_docs(
        '{"_id":1,"a-x":[{"b":[{"y":1},{"y":2}],"n":[1]}],"s":{"c":[{"z":1}]},"t":[5,6],"u":[[1]]}',
        '{"_id":2,"a-x":[{"b":[{"y":3}]},{"b":[]}],"s":{"c":[]}}',
    )
    tables = child_tables(docs)
    assert list(tables) == ["ax", "ax_b", "s_c"]
    assert rows(tables["ax_b"]) == [(1, 0, 0, 1), (1, 0, 1, 2), (2, 0, 0, 3)]
    assert {r.table_name: r.row_count for r in row_counts(tables).collect()} == {"ax": 3, "ax_b": 3, "s_c": 1}
    assert [list(group) for group in batches(tables, 2)] == [["ax", "ax_b"], ["s_c"]]


def test_positions_are_a_key_and_lead_back_to_the_input(spark, json_docs):
    docs = json_docs(
        '{"_id":1,"a":[{"x":"p","b":[{"y":1},{"y":2}]},{"x":"q","b":[{"y":3}]}]}',
        '{"_id":2,"a":[{"x":"r","b":[]}]}',
    )
    inner, outer = child_table(docs, "a.b"), child_table(docs, "a")
    assert inner.select("root_id", "a_pos", "b_pos").distinct().count() == inner.count() == 3
    nested = (
        outer.join(inner, ["root_id", "a_pos"], "left").groupBy("root_id", "a_pos", "x")
        .agg(F.sort_array(F.collect_list(F.when(F.col("b_pos").isNotNull(), F.struct("b_pos", "y")))).alias("b"))
        .groupBy("root_id").agg(F.sort_array(F.collect_list(F.struct("a_pos", "x", F.col("b.y").alias("b")))).alias("a"))
    )
    given = docs.select("_id", F.transform("a", lambda e: F.struct(e["x"].alias("x"), e["b"]["y"].alias("b"))).alias("a"))
    assert {r.root_id: [(e.x, e.b) for e in r.a] for r in nested.collect()} == {
        r._id: [(e.x, e.b) for e in r.a] for r in given.collect()
    }


def test_without_keys(json_docs):
    docs = json_docs('{"a":[{"x":1,"b":[{"y":1}]}]}')
    assert child_table(docs, "a", keys=False).columns == ["x"]
    assert rows(child_table(docs, "a.b", keys=False)) == [(1,)]


def test_missing_key_column_is_reported(json_docs):
    with pytest.raises(LayoutError, match="_id"):
        child_table(json_docs('{"id":1,"a":[{"x":1}]}'), "a")
    assert rows(child_table(json_docs('{"id":1,"a":[{"x":1}]}'), "a", key_col="id")) == [(1, 0, 1)]


def test_unknown_path_is_reported(json_docs):
    with pytest.raises(LayoutError, match="no array of structs"):
        child_table(json_docs('{"_id":1,"a":[1]}'), "a")


def test_dotted_field_names(spark):
    item = T.StructType([T.StructField("v.w", T.IntegerType()), T.StructField("k`", T.IntegerType())])
    schema = T.StructType([
        T.StructField("_id", T.IntegerType()),
        T.StructField("a.b", T.ArrayType(item)),
        T.StructField("a", T.StructType([T.StructField("b", T.ArrayType(item))])),
    ])
    docs = spark.createDataFrame([(1, [(2, 3)], ([(4, 5)],))], schema)
    assert array_paths(schema) == [("a.b",), ("a", "b")]
    with pytest.raises(LayoutError, match="several paths"):
        child_table(docs, "a.b")
    assert rows(child_table(docs, ["a.b"])) == [(1, 0, 2, 3)]
    assert rows(child_table(docs, ["a", "b"])) == [(1, 0, 4, 5)]
    assert child_table(docs, ["a", "b"]).columns == ["root_id", "b_pos", "v.w", "k`"]


def test_tables_with_one_name_clash(spark):
    docs = spark.sql(
        "SELECT 1 AS _id, array(named_struct('x', 1)) AS a_b, named_struct('b', array(named_struct('x', 1))) AS a"
    )
    with pytest.raises(NameClash, match="a_b"):
        child_tables(docs)


def test_origin_column_is_carried(json_docs):
    docs = json_docs('{"_id":1,"a":[{"x":1,"s":{"y":2}}]}', origin=True)
    tables = flatten_documents(docs, "docs", origin_col="Filename")
    assert tables["docs_main"].columns == ["_id", "Filename"]
    assert tables["a"].columns == ["root_id", "a_pos", "x", "s_y", "Filename"]
    assert tables["a"].collect()[0].Filename.startswith("docs-")


def test_stacked_tables_keep_all_rows(json_docs):
    docs = json_docs('{"_id":1,"a":[{"x":1},{"x":2}],"b":[{"y":"u"}]}')
    stacked = tables_as_one(child_tables(docs))
    assert rows(stacked.select("table_name", "root_id", "x", "y")) == [
        ("a", 1, 1, None), ("a", 1, 2, None), ("b", 1, None, "u")
    ]


def test_child_scan_reads_only_its_array(spark, json_docs, tmp_path):
    docs = json_docs('{"_id":1,"big":"text","a":[{"x":1,"b":[{"y":1,"z":2}]}],"c":[{"w":1}]}')
    docs.write.parquet(str(tmp_path / "landed"))
    plan = child_table(spark.read.parquet(str(tmp_path / "landed")), "a.b", stored=True)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_id:bigint,a:array<struct<b:array<struct<y:bigint,z:bigint>>>>>" in plan
    assert "Exchange" not in plan


def _records(**fields):
    """A record type from nested keyword arguments; lists hold records, dicts are structs."""
    def kind(value):
        if isinstance(value, list):
            return T.ArrayType(_records(**value[0]))
        return _records(**value) if isinstance(value, dict) else T.StringType()

    return T.StructType([T.StructField(name, kind(value)) for name, value in fields.items()])


def test_tables_of_a_deep_document_type(spark):
    """An array in an array, one under three structs with another within it, and one name under two parents."""
    reading = {"value": "", "unit": {"sign": ""}}
    schema = _records(
        _id="",
        buoys=[{
            "waves": [reading], "hull": {"bow": {"deck": {"lamps": [{"bulbs": [reading], "colour": ""}]}}},
            "moorings": [{"waves": [reading], "depth": ""}],
        }],
        station={"tides": [reading]},
        north=[{"alarms": [reading]}],
        south=[{"alarms": [reading]}],
    )
    tables = child_tables(spark.createDataFrame([], schema))
    assert list(tables) == [
        "buoys", "buoys_waves", "buoys_hull_bow_deck_lamps", "buoys_hull_bow_deck_lamps_bulbs", "buoys_moorings",
        "buoys_moorings_waves", "station_tides", "north", "north_alarms", "south", "south_alarms",
    ]
    assert tables["buoys_hull_bow_deck_lamps_bulbs"].columns == [
        "root_id", "buoys_pos", "lamps_pos", "bulbs_pos", "value", "unit_sign"
    ]
    assert tables["south_alarms"].columns == ["root_id", "south_pos", "alarms_pos", "value", "unit_sign"]
    assert tables["buoys"].columns == ["root_id", "buoys_pos"]


def test_computed_arrays_are_built_once(spark):
    for df in (text_docs(spark, SF_DIR), text_docs(spark, SF_DIR)):
        plan = child_table(df, "lines.words")._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and ("split(" in line or "transform(" in line)]


def test_arrays_of_plain_values_get_tables_on_request(spark):
    docs = spark.sql("SELECT 1 AS _id, array(5, 6) AS n, array(named_struct('t', array('a'))) AS s")
    tables = child_tables(docs, primitive_arrays=True)
    assert list(tables) == ["n", "s", "s_t"] and list(child_tables(docs)) == ["s"]
    assert [tuple(r) for r in tables["n"].collect()] == [(1, 0, 5), (1, 1, 6)]
    assert [tuple(r) for r in tables["s_t"].collect()] == [(1, 0, 0, "a")]


def test_clashes_follow_the_case_setting_of_the_session(spark):
    docs = spark.sql("SELECT 1 AS s_f, named_struct('F', 2) AS s")
    assert main_table(docs).columns == ["s_f", "s_F"]
    spark.conf.set("spark.sql.caseSensitive", "false")
    try:
        with pytest.raises(NameClash):
            main_table(docs)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "true")


def test_properties_on_the_given_tables(spark):
    docs = text_docs(spark, SF_DIR).cache()
    lines, words = child_table(docs, "lines"), child_table(docs, "lines.words")
    assert main_table(docs).count() == docs.count()
    sizes = docs.select(
        F.sum(F.size("lines")).alias("lines"),
        F.sum(F.aggregate("lines", F.lit(0), lambda n, line: n + F.size(line["words"]))).alias("words"),
    ).collect()[0]
    assert (lines.count(), words.count()) == (sizes.lines, sizes.words)
    assert words.select("root_id", "lines_pos", "words_pos").distinct().count() == sizes.words
    assert words.join(lines, ["root_id", "lines_pos"], "left_anti").isEmpty()
    docs.unpersist()
