"""The pipeline against its stages done by hand, and the registered queries' columns."""

import sys
from pathlib import Path

import numpy as np
import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from docstrata.llm import packing  # noqa: E402
from docstrata.llm.queries import CHECKS, QUERIES  # noqa: E402
from test_corpus import ITEM, roots_by_hand  # noqa: E402
from test_near_copies import similarity_by_hand  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

COLUMNS = {
    "op1": "doc_id item_id n_windows matched_tokens item_tokens reparameterised",
    "op2": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op4": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5": "doc_id fingerprint component_id",
    "op6": "doc_id start end earlier_id earlier_start earlier_end n_words similarity",
    "op7": "doc_id held_out score predicted",
    "op8": "doc_id held_out lang_pred score",
    "op9": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10": "vec_id n_links component_id kept",
    "op11": "doc_id start n_tokens ids_crc32",
    "op12": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13": "anchor_id positive_id rank negative_id positive_score negative_score",
}


def test_every_operator_has_one_query():
    assert sorted(name.split("_")[0] for name in QUERIES) == sorted(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(CHECKS) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_on_the_given_tables(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(found.columns)
    given = spark.read.parquet(f"{SF_DIR}/{'embeddings' if name.startswith('op10') else 'documents'}.parquet").count()
    if name.split("_")[0] in ("op3", "op4", "op5", "op7", "op8", "op9", "op10", "op11"):
        assert found.count() == given
    else:
        assert found.count() >= (given if name.startswith("op2") else 0)


def test_pipeline_matches_its_stages_by_hand(spark, make, prose, tmp_path):
    long = prose(300, 1)
    texts = [long, long, f"{prose(20, 2)} {ITEM} {prose(20, 3)}", "12 34 !", None, f"{prose(30, 4)} token = abcdefgh12 {prose(30, 5)}", prose(90, 6), prose(90, 6), ""]
    ids = [5, 2, 3, 4, 0, 6, 7, 7, None]
    folder = str(tmp_path / "sf")
    make(texts, ids).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    rows = [(i, t) for i, t in zip(ids, texts) if t and any(c.isalpha() for c in t)]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if similarity_by_hand(rows[a][1], rows[b][1]) >= 0.8]
    groups = roots_by_hand(len(rows), links)
    best = {}
    for k, g in enumerate(groups):
        if g not in best or rows[k][0] < rows[best[g]][0]:
            best[g] = k
    left = [rows[k] for k in best.values() if ITEM not in rows[k][1]]
    want = sorted((i, t.replace("token = abcdefgh12", "[redacted]")) for i, t in left)
    assert [i for i, _ in want] == [2, 6, 7]

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, folder), name)
        assert docs.columns == columns
    assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == want
    pieces = corpus_pipeline.run(spark, folder).orderBy("sequence_id", "offset").collect()
    whole = {}
    for p in pieces:
        whole[p["doc_id"]] = whole.get(p["doc_id"], []) + np.frombuffer(p["ids"], "<u4").tolist()
    encoder = packing._encoder(packing.TOKENIZER)
    assert whole == {i: [*np.frombuffer(encoder.encode([t])[0], "<u4").tolist(), 2] for i, t in want}


def test_stage_names_and_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secret_scan", "packing"]
