"""Nothing of a delivery is lost under a given schema: the text of all that does not fit is kept, or the job stops."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from docstrata.plans.table_sets import json_to_tables
from docstrata.sources.documents import read_document_lists, read_documents

@pytest.fixture
def schema(spark):
    return T.StructType.fromDDL(
        "_id bigint, s struct<a: bigint>, l array<struct<a: bigint>>, m array<array<struct<x: bigint>>>, k map<string, struct<x: bigint>>, p array<bigint>"
    )


FITTING = ['{"_id":1}', '{"_id":2,"s":{"a":1},"l":[{"a":1},null],"m":[[{"x":1}],[]],"k":{"any":{"x":1}},"p":[1]}', ' {"_id":9,"s":null} ']
SPOILT = [
    '{"_id":1,"newf":5}', '{"_id":1,"s":{"a":1,"y":2}}', '{"_id":1,"l":[{"a":1},{"y":1}]}', '{"_id":1,"m":[[{"x":1,"y":2}]]}', '{"_id":1,"k":{"any":{"y":1}}}',
    '{"_id":3,"_id":4}', '{"_id":1,"s":{"a":1,"a":2}}', '{"_id":5} trailing', '{"_id":5}] x', '{"_id":5},{"_id":6}', '{"_id":5', '{"_id":"x"}', '{"_id":1,"p":["q"]}', '[1]', '7',
]


def lines(tmp_path, texts, name="d.json"):
    (tmp_path / name).write_text("\n".join(texts) + "\n", encoding="utf-8")
    return str(tmp_path / name)


def test_each_spoilt_line_is_kept_and_no_other(spark, tmp_path, schema):
    rows = read_documents(spark, lines(tmp_path, FITTING + SPOILT), schema, rescued_col="rest").collect()
    assert sorted(r["rest"] for r in rows if r["rest"] is not None) == sorted(SPOILT)
    assert sorted(r["_id"] for r in rows if r["rest"] is None) == [1, 2, 9]


@pytest.mark.parametrize("text", SPOILT)
def test_strict_stops_at_every_spoilt_line(spark, tmp_path, schema, text):
    with pytest.raises(Exception, match="does not fit|MALFORMED"):
        read_documents(spark, lines(tmp_path, [*FITTING, text]), schema, strict=True).count()


def test_strict_passes_what_fits(spark, tmp_path, schema):
    assert read_documents(spark, lines(tmp_path, FITTING), schema, strict=True).count() == 3


def test_items_of_lists_are_kept_one_by_one(spark, tmp_path):
    small = T.StructType.fromDDL("_id bigint, a bigint")
    (tmp_path / "l").mkdir()
    files = {"1": '[{"_id":1,"a":1},{"_id":2,"zzz":1},\n null, {"_id":3,"_id":4}]', "2": '{"_id":5,"a":2}', "3": '[{"_id":6}] x', "4": '{"_id":7,"q":1}', "5": "[{]", "6": "[]", "7": '[{"_id":8}]]'}
    for name, text in files.items():
        (tmp_path / "l" / name).write_text(text)
    rows = [(r["list_position"], r["_id"], r["rest"]) for r in read_document_lists(spark, str(tmp_path / "l"), small, rescued_col="rest").collect()]
    assert sorted((p, i) for p, i, rest in rows if rest is None) == [(0, 1), (0, 5)]
    kept = [rest for _, _, rest in rows if rest is not None]
    assert sorted(kept) == sorted(['{"_id":2,"zzz":1}', '{"_id":3,"_id":4}', files["3"], files["4"], files["5"], files["7"]])
    assert {p for p, _, rest in rows if rest in (files["3"], files["5"], files["7"])} == {None}


@pytest.mark.parametrize("multiline", [False, True])
def test_table_sets_keep_unknown_fields(spark, tmp_path, multiline):
    small = T.StructType.fromDDL("_id bigint, a bigint")
    path = str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    texts = ['{"_id":1,"a":1}', '{"_id":2,"newf":5}']
    if multiline:
        (tmp_path / "in" / "one.json").write_text("[\n" + ",\n".join(texts) + "\n]")
    else:
        lines(tmp_path / "in", texts)
    json_to_tables(spark, path, str(tmp_path / "out"), "docs", schema=small, multiline=multiline, file_format="parquet")
    lost = spark.read.parquet(str(tmp_path / "out" / "docs_rescued.parquet")).collect()
    assert [(r["root_id"], json.loads(r["rescued"])) for r in lost] == [(2, {"_id": 2, "newf": 5})]
    assert spark.read.parquet(str(tmp_path / "out" / "docs_main.parquet")).select(F.sum("_id")).first()[0] == 3
    with pytest.raises(Exception, match="does not fit"):
        json_to_tables(spark, path, str(tmp_path / "out2"), "docs", schema=small, multiline=multiline, strict=True)


def test_a_list_is_parsed_once_whatever_its_items(spark, tmp_path):
    small = T.StructType.fromDDL("_id bigint")
    (tmp_path / "l").mkdir()
    for name, first in (("1", 0), ("2", 2000)):
        (tmp_path / "l" / name).write_text("[" + ",\n".join(f'{{"_id":{i}}}' for i in range(first, first + 2000)) + "]")
    items = read_document_lists(spark, str(tmp_path / "l"), small, rescued_col="rest")
    above, _, below = items._jdf.queryExecution().optimizedPlan().toString().partition("Generate ")
    # What parses a list, or carries its text, stands below the generator; above it, it would be done again for every item.
    assert "ArrayType(StringType" not in above and below.count("from_json(ArrayType(StringType") == 2
    assert sorted((r["list_position"], r["_id"], r["rest"]) for r in items.collect()) == sorted((i % 2000, i, None) for i in range(4000))
