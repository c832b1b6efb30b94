"""Operators over the whole corpus against brute force: leaks, near-duplicates, repeats, passages, embeddings, components."""

import hashlib
import random
from itertools import combinations

import duckdb
import numpy as np
import pytest

from docstrata.llm import checks, decontaminate, embeddings, passages, simhash, suffix_dedup
from docstrata.llm.components import components


def roots_by_hand(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(70, 99)] + [(0, 0), (100, 105), (100, 106)]
    want = roots_by_hand(107, links)
    found = components(spark.createDataFrame([*links, (None, 3)], "u long, v long")).collect()
    assert {r["node"]: r["root"] for r in found} == {i: r for i, r in enumerate(want) if r != i}


def test_no_edges_no_components(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_grid_join_finds_all_near_fingerprints(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for base in list(fps)[:30]:
        for bits in (1, 2, 3, 4):
            fps.add(base ^ sum(1 << b for b in rng.sample(range(64), bits)))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = {(r["u"], r["v"]) for r in simhash.near_pairs(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = {(max(a, b), min(a, b)) for a, b in combinations(signed, 2) if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    assert found == want and len(want) > 60


def fingerprint_by_hand(text):
    import re

    import xxhash

    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_near_duplicates_of_odd_rows(make, prose):
    long = prose(400, 1)
    texts = [long, long + " end", prose(50, 2), None, "", "Word", "É a\x0bb", long, prose(70_000, 3), None]
    ids = [5, 3, 8, 9, 7, 1, 2, 5, 4, None]
    docs = make(texts, ids)
    rows = simhash.simhash_components(docs).collect()
    want = [fingerprint_by_hand(t) for t in texts]
    assert sorted((r["doc_id"] or -1, r["fingerprint"]) for r in rows) == sorted((i or -1, f"{f:016x}") for i, f in zip(ids, want))
    group = {r["doc_id"]: r["component_id"] for r in rows}
    assert group[7] == group[9] == group[None] == 7 and group[8] == 8
    assert (group[5] == 3) == ((want[0] ^ want[1]).bit_count() <= 3)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    left = [r["doc_id"] for r in kept.collect()]
    assert sorted(left) == sorted({group[i] for i in ids}) and 9 not in left and None not in left
    assert simhash.simhash_components(docs.limit(0)).count() == 0


ITEM = "On Monday morning Alice Brown bought 12 kg of apples and 3 kg of pears for 40 dollars at the small market near the river"


def test_leaks_with_other_names_and_numbers(spark, make, prose):
    swapped = ITEM.replace("Alice Brown", "Maria Silva").replace("12", "77").replace("40", "15.5")
    torn = ITEM.replace("Alice", "Maria") + " . Then Alice " + ITEM
    texts = [f"{prose(30, 1)} x {ITEM} {prose(9, 2)}", f"{prose(30, 3)} x {swapped} {prose(9, 4)}", prose(80, 5), None, "", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16", f"zz {ITEM}", f"zz {ITEM}", torn]
    benchmark = spark.createDataFrame([(1, ITEM), (2, "1 2 3 4 5 6 7 8 9"), (3, None), (4, "too short"), (5, "five plain words stand here"), (1, ITEM)], "item_id long, text string")
    docs = make(texts, [0, 1, 2, 3, 4, 5, 6, 6, None])
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(docs, benchmark).collect()}
    # Document 5 holds item 2 word for word; a pattern of other numbers does not count.
    assert set(found) == {(0, 1), (1, 1), (5, 2), (6, 1), (None, 1)}
    assert not found[0, 1]["reparameterised"] and found[1, 1]["reparameterised"]
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4]
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0 == decontaminate.leaks(docs.limit(0), benchmark).count()


def test_slots_must_map_one_to_one(spark, make):
    item = "if the train leaves at 5 and the next train leaves at 5 how long does it take to reach home"
    same, mixed = item.replace("5", "8"), item.replace("5", "8", 1).replace(" 5 ", " 9 ")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate.leaks(make([same, mixed]), benchmark).collect()
    assert [(r["doc_id"], r["reparameterised"]) for r in found] == [(0, True)]


def test_every_exact_copy_is_found(spark, make, prose):
    items = [
        "What is the capital of France?", "Compute 12 + 34 * 56 - 78 please", "\u65e5\u672c\u306e\u9996\u90fd\u306f\u3069\u3053\u3067\u3059\u304b",
        "A farmer has 5 hens and buys some more until the yard is full, then sells all that he can and is left with 5 of them in the end",
        "Al Bo Cy Di Ed Fu Gi Ho Is Jo", "km per hour and miles per hour", "Who knows", "3 4 5 6", "\u0e01\u0e34\u0e19\u0e02\u0e49\u0e32\u0e27",
    ]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [
        f"{prose(20, 1)}. Question: {items[0]} {prose(5, 2)}", f"Now {items[1]} {prose(9, 3)}", f"{items[2]}{items[2]}", items[3].replace("5 of", "6 of"),
        f"said {items[4]} {prose(5, 4)}", f"5 {items[5]}", "who KNOWS", f"Who knows {prose(6, 5)}", "1, 3 4 5 6 7", "9 8 7 6", f"x {items[8]}",
        "Now Compute 13 + 34 * 56 - 78 please",
    ]
    found = sorted((r["doc_id"], r["item_id"], r["reparameterised"]) for r in decontaminate.leaks(make(texts), benchmark).collect())
    assert found == [(0, 0, False), (1, 1, False), (2, 2, False), (3, 3, False), (4, 4, False), (5, 5, False), (6, 6, False), (8, 7, False), (10, 8, False)]


def test_leaks_agree_with_their_sql(spark, make, prose):
    items = [ITEM, "What is 5 km in miles?", "too short", "Compute 1 + 2 - 3 * 4", None, "", "km of road and of rail"]
    benchmark = spark.createDataFrame([*enumerate(items), (0, ITEM)], "item_id long, text string")
    swapped = ITEM.replace("Alice Brown", "Maria Silva").replace("12", "77")
    texts = [ITEM, f"Ask: {items[1]}", "What is 7 mi in miles?", "Too short", "too short a text", f"so {items[3]}", swapped, f"{ITEM} {swapped}", None, "", "5 km of road and of rail", ITEM]
    docs = make(texts)
    con = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", benchmark)):
        con.register(f"{name}_frame", df.toArrow())
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_frame")
    columns = "doc_id, item_id, n_windows, matched_tokens, item_tokens, reparameterised"
    expected = con.execute(f"SELECT {columns} FROM ({checks.OP1})").fetchall()
    assert sorted(map(tuple, decontaminate.leaks(docs, benchmark).select(*columns.split(", ")).collect())) == sorted(expected)
    assert {(r[0], r[1]) for r in expected} >= {(0, 0), (1, 1), (3, 2), (5, 3), (6, 0), (10, 6), (11, 0)}


def test_leaks_without_broadcast(spark, make, prose, monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 0)
    benchmark = spark.createDataFrame([(1, ITEM), (5, "five plain words stand here")], "item_id long, text string")
    docs = make([ITEM, "so five plain words stand here", prose(40, 1)])
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark).collect()) == [(0, 1), (1, 5)]


def repeats_by_hand(rows, length):
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        cover = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                cover[p : p + length] = b"\1" * length
            seen.add(data[p : p + length])
        kept = bytes(c for c, gone in zip(data, cover) if not gone)
        spans = sum(1 for j in range(len(data)) if cover[j] and (j == 0 or not cover[j - 1]))
        out.append((i, len(data), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_texts(prose):
    common, line = prose(60, 9), "Subscribe to our newsletter to read all that we have to say, every week."
    texts = [None, "", prose(80, 1), "x" * 1000, "ab" * 400, "é" * 99, prose(20, 2) + common + prose(5, 3), common[7:], common[:-30] + "é", prose(80, 1)]
    texts += [f"{prose(9, 100 + k)} {line} {prose(9, 200 + k)}" for k in range(12)]
    texts += [prose(6, 300 + k) + common[k * 5 : 150 + k * 3] + line for k in range(12)]
    return texts


@pytest.mark.parametrize("together, block", [(20_000, 1 << 21), (1, 1 << 21), (20_000, 1024)])
def test_repeats_match_brute_force(make, prose, monkeypatch, together, block):
    monkeypatch.setattr(suffix_dedup, "MOST_TOGETHER", together)
    texts = repeated_texts(prose)
    ids = [(i * 7) % len(texts) for i in range(len(texts))]
    if block != suffix_dedup.BLOCK:
        pieces = [p for block_ in suffix_dedup._blocks(iter([(1, texts[6].encode() * 30)]), 100) for p in block_]
        assert all(texts[6].encode() * 30 for _ in pieces)
    rows = suffix_dedup.remove_repeats(make(texts, ids)).collect()
    found = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)
    assert found == repeats_by_hand(sorted(zip(ids, texts)), 100)


def test_repeats_with_repeated_and_null_ids(make, prose):
    text = prose(60, 4)
    docs = make([text, text, text, "short", None, text[:300]], [1, 1, None, None, 2, 0])
    rows = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_removed"]) for r in suffix_dedup.remove_repeats(docs).collect())
    whole = len(text.encode())
    assert [n for _, n in rows] == [0, 300, whole, 0, 0, whole]
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_ranks_order_suffixes():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 300, dtype=np.uint8)
    text = data.tobytes()
    order = sorted({text[i : i + 20] for i in range(len(text))})
    rank = suffix_dedup.ranks(data, 20)
    assert [text[i : i + 20] for i in np.argsort(rank, kind="stable")] == sorted(text[i : i + 20] for i in range(len(text)))
    assert len(np.unique(rank)) == len(order)


def test_compact_windows_partition_all_stretches():
    rng = np.random.default_rng(6)
    values, least = rng.integers(0, 1 << 63, 40, dtype=np.uint64), 5
    low, centre, high = passages.compact_windows(values, np.array([0, 25]), np.array([25, 40]), least)
    own = {}
    for a, c, b in zip(low, centre, high):
        for i in range(a, c + 1):
            for j in range(c, b):
                if j - i + 1 >= least:
                    assert (i, j) not in own
                    own[i, j] = c
    want = {(i, j): i + int(values[i : j + 1].argmin()) for lo, hi in ((0, 25), (25, 40)) for i in range(lo, hi) for j in range(i + least - 1, hi)}
    assert own == want


def test_passages_are_found_and_clean_texts_left(make, prose):
    common = prose(70, 1)
    edited = " ".join("changed" if i == 35 else w for i, w in enumerate(common.split()))
    texts = [f"{prose(60, 2)} {common} {prose(40, 3)}", f"{prose(30, 4)} {common.upper()} {prose(90, 5)}", f"{prose(9, 6)} {edited}", prose(300, 7), None, "", " ".join(common.split()[:30]), common, common]
    rows = passages.near_passages(make(texts, [0, 1, 2, 3, 4, 5, 6, 7, 7])).collect()
    assert {x for r in rows for x in (r["doc_id"], r["earlier_id"])} == {0, 1, 2, 7}
    for r in rows:
        assert r["n_words"] >= 50 and r["similarity"] >= 0.8 and r["earlier_id"] <= r["doc_id"]
    part = next(r for r in rows if r["doc_id"] == 1 and r["earlier_id"] == 0)
    assert texts[1].encode()[part["start"] : part["end"]].decode().lower() == common
    assert passages.near_passages(make(["a"]).limit(0)).count() == 0


def same_runs(texts, n):
    """Pairs of texts that hold the same ``n`` words in a row, by hand."""
    runs = [{tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for w in (t.split() for t in texts)]
    return {(a, b) for a, b in combinations(range(len(texts)), 2) if runs[a] & runs[b]}


@pytest.mark.parametrize("seed", range(3))
def test_passages_made_of_common_lines_are_found(make, prose, seed):
    rng = random.Random(seed)
    lines = [prose(12, 1000 + k) for k in range(40)]
    texts = [" ".join(rng.choice(lines) for _ in range(15)) for _ in range(200)]
    passage = " ".join(rng.choice(lines) for _ in range(5))
    for k in (150, 199):
        texts[k] = f"{texts[k]} {passage} {prose(40, k)}"
    found = {(r["earlier_id"], r["doc_id"]) for r in passages.near_passages(make(texts)).collect()}
    want = same_runs(texts, 50)
    assert (150, 199) in want and want <= found


def test_a_family_whose_first_passages_differ_from_the_others(make, prose):
    rng, base = random.Random(5), prose(60, 2000).split()
    changed = lambda n, k: " ".join(f"w{k}x{i}" if i in at else w for at in [set(rng.sample(range(60), n))] for i, w in enumerate(base))
    # Each of the first holds a third of the passage, and none is like another; the later ones hold all of it, or nearly.
    texts = [f"{prose(50, 10 + k)} {' '.join(base[k % 3 * 20 : k % 3 * 20 + 20])} {prose(50, 500 + k)}" for k in range(30)]
    texts += [f"{prose(30, 900 + k)} {changed(k % 2, k)} {prose(30, 950 + k)}" for k in range(30)]
    texts += [f"{prose(30, 700 + k)} {' '.join(base)}" for k in range(60)]
    rows = passages.near_passages(make(texts)).collect()
    assert not [r for r in rows if r["earlier_id"] < 30]
    roots = roots_by_hand(len(texts), [(r["earlier_id"], r["doc_id"]) for r in rows])
    assert set(roots[30:]) == {30} and len(rows) < 20 * len(texts)


@pytest.mark.parametrize(("size", "changed"), [(51, False), (56, True)])
def test_every_later_document_of_a_passage_has_its_row(make, prose, size, changed):
    # So short a passage lies in large classes only. Each has a row, whichever document stands for a class.
    base = prose(size, 3000).split()
    texts = [prose(120, 6000 + k) for k in range(20)]
    texts += [f"{prose(40, 4000 + k)} {' '.join(f'w{k}x' if changed and i == 35 else w for i, w in enumerate(base))} {prose(40, 5000 + k)}" for k in range(60)]
    rows = passages.near_passages(make(texts)).collect()
    assert {r["doc_id"] for r in rows} == set(range(21, 80))
    assert all(20 <= r["earlier_id"] < r["doc_id"] and r["similarity"] >= 0.8 for r in rows)


def test_passages_of_many_pairs_at_once(prose):
    one, two, other = prose(60, 1), prose(80, 2), prose(90, 3)
    again = " ".join([prose(6, 4)] * 12)
    edited = " ".join("changed" if i == 30 else w for i, w in enumerate(two.split()))
    pairs = [(f"{one} {other} {two}", f"{one} {prose(200, 5)} {edited}"), (other, one), (f"{again} {other}", again.upper()), ("", one), (" ".join(one.split()[:49]), one)]
    found = list(zip(*(x.tolist() for x in passages.passages([(a.encode(), b.encode()) for a, b in pairs]))))
    assert [(int(f[0]), f[5]) for f in sorted(found, key=lambda f: (f[0], f[3]))] == [(0, 60), (0, 80), (2, 72)]
    for i, a_from, a_to, b_from, b_to, n, alike in found:
        a, b = pairs[int(i)][0][int(a_from) : int(a_to)].lower(), pairs[int(i)][1][int(b_from) : int(b_to)].lower()
        first, second = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a.split(), b.split()))
        assert len(b.split()) == n and alike == pytest.approx(len(first & second) / len(first | second))


def links_by_hand(vectors, least=0.95):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    links = []
    for a, b in combinations(range(len(vectors)), 2):
        if ok[a] and ok[b] and len(vectors[a]) == len(vectors[b]):
            x, y = np.array(vectors[a]), np.array(vectors[b])
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links.append((a, b))
    return links


@pytest.mark.parametrize("block", [1024, 3])
def test_embeddings_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(8)
    vectors = [rng.standard_normal(32).tolist() for _ in range(60)]
    for k in range(40):
        vectors.append((np.array(vectors[k % 7]) + rng.standard_normal(32) * 0.15).tolist())
    vectors += [vectors[0]] * 5 + [(3 * np.array(vectors[1])).tolist(), None, [], [0.0] * 32, [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], [1.0, 2.0], [2.0, 4.0], [1.0], [5.0], [-5.0]]
    table = spark.createDataFrame([(1000 - i, v, i) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, row long")
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(table).collect()}
    links = links_by_hand(vectors)
    n = [sum(i in pair for pair in links) for i in range(len(vectors))]
    back = len(vectors) - 1
    root = roots_by_hand(len(vectors), [(back - a, back - b) for a, b in links])
    assert len(found) == len(vectors)
    for i in range(len(vectors)):
        r = found[1000 - i]
        assert r["n_links"] == n[i] and r["component_id"] == 1000 - back + root[back - i] and r["kept"] == (r["component_id"] == r["vec_id"])


def test_embeddings_with_null_ids_and_no_rows(spark):
    table = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (4, [1.0, 0.01]), (4, [0.0, 1.0]), (None, None)], "vec_id long, embedding array<double>")
    rows = sorted((r["vec_id"] or 99, r["n_links"], r["component_id"] or 99, r["kept"]) for r in embeddings.near_duplicates(table).collect())
    assert rows == [(4, 0, 4, True), (4, 2, 4, True), (99, 0, 99, True), (99, 2, 4, False), (99, 2, 4, False)]
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id")
    vectors = [r["embedding"] for r in table.collect()]
    found = sum(r["n_links"] for r in embeddings.near_duplicates(table).collect())
    want = 2 * len(links_by_hand(vectors))
    assert 0.99 * want <= found <= want


@pytest.mark.parametrize("seed", range(4))
def test_fragments_are_sorted_out_alike_however_batches_fall(seed):
    import pandas as pd

    rng = random.Random(seed)
    rows = sorted({(rng.randrange(5), rng.randrange(3), rng.randrange(9), rng.randrange(4)) for _ in range(40)})
    frame = pd.DataFrame(rows, columns=["gram", "content", "ord", "start"]).assign(length=100, kind=0)
    frame.loc[frame.sample(5, random_state=seed).index, "kind"] = 1
    open_ = frame[frame["kind"] == 0]
    first = ~open_.duplicated(["gram", "content"])
    mixed = open_.groupby("gram")["content"].transform("nunique") > 1
    want = {(*r, 1) for r in open_[~first][["gram", "content", "ord", "start"]].itertuples(index=False)}
    want |= {(*r, 0) for r in open_[first & mixed][["gram", "content", "ord", "start"]].itertuples(index=False)}
    want |= {(*r, 1) for r in frame[frame["kind"] == 1][["gram", "content", "ord", "start"]].itertuples(index=False)}
    for size in (1, 2, 3, 7, 100):
        batches = (frame.iloc[i : i + size] for i in range(0, len(frame), size))
        found = [tuple(r) for part in suffix_dedup._by_gram(batches) for r in part[["gram", "content", "ord", "start", "kind"]].itertuples(index=False)]
        assert len(found) == len(want) and set(found) == want
