"""The trie of conversations against every prefix by hand."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from compare import SF_DIR
from docstrata.llm import prefix_trie, scans

SCHEMA = "conv_id long, turn long, role string, text string, node string, Depth long, share int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(4)


def trie_by_hand(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, turns in own.items():
        mark = lambda t: hashlib.md5(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest()
        own[conv] = [t[1:] for t in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, mark(t)))]
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        built[conv] = own.get(conv - int(np.fmod(conv, 5)), [])[:h] + turns[h:]
    nodes = {}
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(conv)
    below = {k: [] for k in nodes}
    for k in nodes:
        if k:
            below[k[:-1]].append(k)
    out = []

    def walk(k):
        leaves, saved = (0, 0) if below[k] else (1, 0)
        for child in below[k]:
            more = walk(child)
            leaves, saved = leaves + more[0], saved + more[1]
        if k:
            saved += (len(nodes[k]) - 1) * len(k[-1][1].encode())
        ends = ",".join(str(c) for c in sorted(nodes[k]) if len(built[c]) == len(k))
        parent = min(nodes[k[:-1]]) if k else None
        out.append((min(nodes[k]), len(k), parent, len(nodes[k]), len(below[k]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if nodes:
        walk(())
    return sorted(out, key=repr)


def found(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(df.columns) == sorted(columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_nodes_of_a_small_forest(spark):
    rng, rows = random.Random(3), []
    for conv in [*range(-12, 40), 100_000, 5000, 4096, 4095, -4096]:
        for turn in range(rng.choice([0, 1, 3, 5, 9, 14])):
            rows.append((conv, rng.choice([turn, turn, None, 7]), rng.choice(["user", "bot", None]), rng.choice(["a", "é b", "", None])))
    rows += rows[:20] + [(None, 1, "user", "lost")]
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == trie_by_hand(rows)


def test_long_and_common_conversations(spark):
    rows = [(0, t, "user", f"turn {t % 7}") for t in range(700)]
    rows += [(c, t, "user", f"turn {t}" if t < 6 else f"c {c % 3}") for c in range(1, 9300, 31) for t in range(c % 11)]
    import sys

    sys.setrecursionlimit(5000)
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == trie_by_hand(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")], [(7, None, None, None)], [(3, 1, "a", "b")], [(5, 1, "a", "b"), (5, 1, "a", "b")]])
def test_odd_tables(spark, rows):
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == trie_by_hand(rows)


def test_running_totals_of_a_group_in_many_tasks(spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(g, k, (k * 37 + g) % 1000, k * 2654435761 % (1 << 62)) for g, n in ((1, 3), (4, 900), (5, 1), (9, 40)) for k in range(n)]
        got = scans.scanned(spark.createDataFrame(rows, "g long, k long, s long, x long"), "g", ["k"], sums=("s",), xors=("x",))
        got = {(r["g"], r["k"]): (r["s_run"], r["x_run"]) for r in got.collect()}
        shares = spark.createDataFrame(rows, "g long, k long, s long, x long").repartitionByRange("g", "k").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    total, mixed, last = 0, 0, None
    for g, k, s, x in rows:
        total, mixed = (s, x) if g != last else (total + s, mixed ^ x)
        last = g
        assert got[g, k] == (total, mixed)
    assert len(got) == len(rows) and shares > 3


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(prefix_trie.op12_prefix_trie(spark, SF_DIR)) == trie_by_hand(rows)
