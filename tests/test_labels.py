"""Index-labelled flattening on hand-written documents."""

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from docstrata import LayoutError, flatten_labeled, labeled_tables
from docstrata.operators.labels import CHAIN, OWN
from docstrata.sources.documents import read_document_lists

NESTED = '{"id":1,"a":[{"x":1,"b":[{"y":1},{"y":2}]},{"x":2,"b":[]}]}'


def rows(df, *columns):
    return sorted([tuple(r) for r in (df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df).collect()], key=repr)


def test_chained_labels(json_docs):
    flat = flatten_labeled(json_docs(NESTED))
    assert rows(flat, "id", "a_x", "a_b_y", "a_b_index", "a_index") == [
        (1, 1, 1, "a_0_b_0", "a_0"), (1, 1, 2, "a_0_b_1", "a_0"), (1, 2, None, None, "a_1")
    ]


def test_own_labels_keep_dots(json_docs):
    flat = flatten_labeled(json_docs(NESTED), OWN)
    assert rows(flat, "id", "a.x", "a.b.y", "_a_b_index", "_a_index") == [
        (1, 1, 1, "b_0", "a_0"), (1, 1, 2, "b_1", "a_0"), (1, 2, None, None, "a_1")
    ]


def test_index_follows_its_content(spark):
    docs = spark.sql("SELECT 1 AS id, array(named_struct('x', 1, 'b', array(named_struct('y', 2)))) AS a, 9 AS z")
    assert flatten_labeled(docs).columns == ["id", "a_x", "a_b_y", "a_b_index", "a_index", "z"]


def test_documents_without_items_stay(json_docs):
    docs = json_docs('{"_id":"k1","arr":[{"v":1}]}', '{"_id":"k2","arr":[]}', '{"_id":"k3","arr":null}')
    assert rows(flatten_labeled(docs), "_id", "arr_v", "arr_index") == [
        ("k1", 1, "arr_0"), ("k2", None, None), ("k3", None, None)
    ]


def test_struct_levels_do_not_enter_labels(json_docs):
    docs = json_docs('{"s":{"a":[{"t":{"b":[{"v":1}]}}]}}')
    assert rows(flatten_labeled(docs), "s_a_t_b_v", "s_a_t_b_index", "s_a_index") == [(1, "a_0_b_0", "a_0")]


def test_primitive_and_nested_arrays(json_docs):
    docs = json_docs('{"t":[5,6],"u":[[1,2],[3]]}')
    flat = flatten_labeled(docs)
    assert rows(flat, "t", "t_index", "u", "u_index", "u_index2") == sorted(
        [(t, f"t_{i}", u, f"u_{p}", f"u_{p}_u_{q}") for i, t in enumerate((5, 6)) for u, p, q in ((1, 0, 0), (2, 0, 1), (3, 1, 0))],
        key=repr,
    )


def test_siblings_multiply_within_a_document(json_docs):
    docs = json_docs('{"_id":1,"a":[{"x":1},{"x":2}],"b":[{"y":3},{"y":4}]}', '{"_id":2,"a":[{"x":5}],"b":[]}')
    assert rows(flatten_labeled(docs), "_id", "a_x", "b_y") == [
        (1, 1, 3), (1, 1, 4), (1, 2, 3), (1, 2, 4), (2, 5, None)
    ]


def test_one_table_per_array_path(json_docs):
    tables = labeled_tables(json_docs(NESTED, '{"id":2,"a":[{"x":9,"b":null}]}'))
    assert set(tables) == {"a", "a_b"}
    assert rows(tables["a_b"], "a_b_y", "a_b_index") == [(1, "a_0_b_0"), (2, "a_0_b_1")]
    assert rows(tables["a"], "a_x", "a_b_y", "a_b_index", "a_index") == [
        (1, 1, "a_0_b_0", "a_0"), (1, 2, "a_0_b_1", "a_0"), (2, None, None, "a_1"), (9, None, None, "a_0")
    ]
    keyed = labeled_tables(json_docs(NESTED), key_col="id")
    assert keyed["a_b"].columns == ["root_id", "a_b_y", "a_b_index"]


def test_nested_lists_make_one_table_without_duplicates(json_docs):
    tables = labeled_tables(json_docs('{"u":[[{"v":1},{"v":2}],[{"v":3}]]}'))
    assert list(tables) == ["u"]
    assert rows(tables["u"], "u_v", "u_index2", "u_index") == [
        (1, "u_0_u_0", "u_0"), (2, "u_0_u_1", "u_0"), (3, "u_1_u_0", "u_1")
    ]


def test_top_level_list(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"a":[{"x":1}]},\n {"a":[{"x":2},{"x":3}]}]')
    docs = read_document_lists(spark, str(tmp_path))
    flat = flatten_labeled(docs, list_position="list_position")
    assert rows(flat, "a_x", "a_index", "root_index") == [
        (1, "root_0_a_0", "root_0"), (2, "root_1_a_0", "root_1"), (3, "root_1_a_1", "root_1")
    ]
    assert set(labeled_tables(docs, list_position="list_position")) == {"root", "a"}


def test_unknown_style(json_docs):
    with pytest.raises(LayoutError):
        flatten_labeled(json_docs(NESTED), "other")


def test_no_exchange_in_labelled_plans(json_docs):
    plan = flatten_labeled(json_docs(NESTED))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_opened_arrays_are_not_carried_along(spark, json_docs, tmp_path):
    json_docs('{"s":{"k":"v","a":[{"x":1,"b":[{"y":1}]}],"c":[{"z":2}]}}').write.parquet(str(tmp_path / "landed"))
    docs = spark.read.parquet(str(tmp_path / "landed"))
    plan = flatten_labeled(docs)._jdf.queryExecution().optimizedPlan()
    generators = []
    while plan.children().nonEmpty():
        if plan.nodeName() == "Generate":
            generators.append([f.dataType().typeName() for f in _fields(plan.requiredChildOutput())])
        plan = plan.children().head()
    # From the last generator to the first: only the sibling still to be opened travels as an array.
    assert [types.count("array") for types in generators] == [0, 1, 1]
    assert not any("struct" in types for types in generators)


def _fields(attributes):
    return [attributes.apply(i) for i in range(attributes.size())]


def test_ranges_give_the_rows_of_the_product(spark):
    schema = "k int, a array<struct<x:int,in:array<int>>>, s struct<b:array<string>>, c array<int>"
    rows = [
        (1, [(i, [i, i + 1][: i % 3]) for i in range(7)], (["p", None, "q"],), list(range(5))),
        (2, [], (["p"] * 11,), None),
        (3, None, None, []),
        (4, [(1, None)], (["only"],), [None]),
        (4, [(1, None)], (["only"],), [None]),
        (5, [None, (2, [3])], (["p", "q"],), list(range(40))),
    ]
    docs = spark.createDataFrame(rows, schema)
    for style in (OWN, CHAIN):
        expected = spark_rows(flatten_labeled(docs, style))
        for size in (1, 3, 10, 1000):
            assert spark_rows(flatten_labeled(docs, style, rows_per_range=size)) == expected
    assert flatten_labeled(docs.limit(0), rows_per_range=3).count() == 0
    listed = docs.withColumn("place", F.col("k") - 1)
    assert spark_rows(flatten_labeled(listed, CHAIN, "place", 4)) == spark_rows(flatten_labeled(listed, CHAIN, "place"))


def test_one_document_makes_its_rows_in_many_tasks(spark):
    docs = spark.range(1).select(F.sequence(F.lit(1), F.lit(1000)).alias("a"), F.sequence(F.lit(1), F.lit(1000)).alias("b"))
    rows = flatten_labeled(docs, rows_per_range=10_000)
    per_task = rows.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in per_task) == 1_000_000
    assert len(per_task) >= 6 and max(r["count"] for r in per_task) <= 400_000
    assert rows.distinct().count() == 1_000_000


def test_ranges_of_no_rows_are_refused(spark):
    with pytest.raises(LayoutError):
        flatten_labeled(spark.range(1), rows_per_range=0)
