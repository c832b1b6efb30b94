"""Hard negatives against all scores by hand."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from compare import SF_DIR
from docstrata.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, row string, Dim int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)


def by_hand(rows):
    valid = []
    for n, (i, v, label) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        valid.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label, n))
    out = []
    for i, v, label, n in valid:
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, same == label) for j, w, same, m in valid if m != n and len(w) == len(v)]
        scored.sort(key=lambda s: s[:2])
        for p, pid, _ in [s for s in scored if s[2]][:5]:
            inside = [s for s in scored if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(i, pid, k + 1, s[1], -p, -s[0]) for k, s in enumerate(inside[:10])]
    return sorted(out)


def found(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(df.columns) == sorted(names)
    return sorted(tuple(r[c] for c in names) for r in df.collect())


def vectors(n, dim, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    raw = centres[rng.integers(0, 6, n)] + spread * rng.standard_normal((n, dim))
    return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32).tolist()


@pytest.mark.parametrize("dim,anchors", [(8, 1024), (8, 3), (20, 4)])
def test_all_rows_by_hand(spark, dim, anchors, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", anchors)
    rng, many = random.Random(dim), vectors(900, dim, dim)
    rows = [(k, v, rng.choice([0, 1, 2, 9, None if k % 50 == 3 else 3])) for k, v in enumerate(many)]
    rows += [(1000 + k, many[5], k % 3) for k in range(60)]  # ties
    assert found(hn.hard_negatives(table(spark, rows))) == by_hand(rows)


def test_odd_rows(spark):
    rows = [
        (100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (200, [1.0, 0.5, 0.1], 1), (300, [], 2), (1, [], 2), (2, [], 3), (400, None, 1), (3, [1.0, None], 1),
        (4, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1), (7, [0.9, 0.5], 0), (8, [0.5, 0.2], 2), (9, [0.5, 0.2], None), (10, [0.5, 0.2], 3),
        (-100, [-1.0, -0.5], 1), (500, [0.0, 0.0], 4), (11, [0.0, 0.0], 4), (12, [1000.0, -2000.0], 1), (13, [300.0, 80.0], 5),
    ]
    assert found(hn.hard_negatives(table(spark, rows))) == by_hand(rows)
    assert found(hn.hard_negatives(table(spark, []))) == []
    with pytest.raises(Exception, match="64 bits"):
        hn.hard_negatives(table(spark, [(0, [1e12, 0.0], 1)])).count()


def test_tree_spans_with_parents_first():
    rows = np.array(vectors(200, 6, 1))
    order, parent, edge = hn.spanning_tree(rows)
    assert sorted(order) == list(range(200)) and parent[0] == -1 and (parent[1:] < np.arange(1, 200)).all() and (parent[1:] >= 0).all()
    assert np.allclose(edge[1:], np.linalg.norm(rows[order[1:]] - rows[order[parent[1:]]], axis=1))


def test_bounds_spare_most_scores_among_close_anchors():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((5, 32)) * 40
    near = np.floor(centres[rng.integers(0, 5, 300)] + rng.standard_normal((300, 32)))
    order, parent, edge = hn.spanning_tree(near)
    frame = pd.DataFrame({"dim": 32, "vec": [near[i].astype("<i8").tobytes() for i in order], "parent": parent, "edge": edge, "row": range(300), "label": 0})
    cands = np.floor(rng.standard_normal((1000, 32)) * 40)
    search = hn.PositiveSearch(frame)
    batch = pd.DataFrame({"vec": [c.astype("<i8").tobytes() for c in cands], "row": range(1000, 2000), "id": range(1000), "label": 0, "norm": np.linalg.norm(cands, axis=1)})
    for at in range(0, 1000, 50):
        search.add(batch.iloc[at : at + 50])
    got, every = search.result(), near[order] @ cands.T
    for a in range(300):
        best = sorted(range(1000), key=lambda c: (-every[a, c], c))[:5]
        assert got[got["anchor"] == a]["id"].tolist() == best
    assert search.scored < 0.5 * search.passed


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert found(hn.op13_hard_negatives(spark, SF_DIR)) == by_hand(rows)
