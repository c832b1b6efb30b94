"""The pipeline's near-duplicate stage against all pairs by hand."""

import random
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from docstrata.llm import near_copies, simhash
from test_corpus import roots_by_hand


def shingles_by_hand(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similarity_by_hand(a, b):
    a, b = shingles_by_hand(a), shingles_by_hand(b)
    return len(a & b) / len(a | b)


def edited(text, edits, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("often", [3, 10**9])
def test_stage_keeps_one_of_each_group_by_all_pairs(spark, make, prose, often, monkeypatch):
    monkeypatch.setattr(near_copies, "OFTEN", often)
    line = prose(30, 99)
    texts = [None, "", " \n", "One two", "one  TWO", "one three", prose(90, 1), prose(90, 1).upper()]
    for k in range(12):
        base = prose(150 + 20 * k, 100 + k)
        texts += [base, *(edited(base, e, 10 * k + e) for e in (1, 2, 3, 4, 6, 9))]
    chain = prose(200, 7)
    for k in range(12):
        texts.append(chain)
        chain = edited(chain, 3, 500 + k)
    texts += [f"{line} {prose(20, 300 + k)}" for k in range(15)] + [edited(texts[8], 2, 700 + k) for k in range(40)]
    random.Random(4).shuffle(texts)
    links = [(a, b) for a, b in combinations(range(len(texts)), 2) if similarity_by_hand(texts[a], texts[b]) >= 0.8]
    want = sorted(set(roots_by_hand(len(texts), links)))
    docs = make(texts)
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == want
    far = [(a, b) for a, b in links if (simhash.fingerprint(texts[a]) ^ simhash.fingerprint(texts[b])).bit_count() > 3]
    assert len(far) > 20 and len(want) < len(texts) - 40


def test_the_grid_of_fingerprints_links_near_copies_by_itself(spark, make, prose, monkeypatch):
    asked, plain = [], near_copies._verified
    none = lambda mixed, *_: mixed.select(mixed["node"].alias("u"), mixed["node"].alias("v")).limit(0)
    monkeypatch.setattr(near_copies, "_star_pairs", none)
    monkeypatch.setattr(near_copies, "_small_pairs", none)
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *a: asked.append(pairs.count()) or plain(pairs, *a))
    texts = [prose(300, 40 + k) for k in range(20)]
    texts += [edited(t, 1, k) for k, t in enumerate(texts)] + [t.upper() for t in texts] + ["one two", "One  two", "one three"]
    near = lambda a, b: ((simhash.fingerprint(texts[a], 5) ^ simhash.fingerprint(texts[b], 5)) % (1 << 64)).bit_count() <= 3
    pairs = [(a, b) for a, b in combinations(range(len(texts)), 2) if similarity_by_hand(texts[a], texts[b]) >= 0.8 and near(a, b)]
    want = sorted(set(roots_by_hand(len(texts), pairs)))
    assert sum(k >= 20 for _, k in pairs) > 10 and 20 < len(want) < len(texts) - 25
    kept = corpus_pipeline.one_of_each_group(spark, make(texts), "").collect()
    assert sorted(r["doc_id"] for r in kept) == want
    assert 0 < asked[0] <= len(texts) and not any(asked[1:])


def group(prose, n, seed):
    """One text of 200 words with one to five words changed, ``n`` times."""
    rng, base = random.Random(seed), prose(200, 5)
    return [edited(base, rng.randint(1, 5), 1000 * seed + k) for k in range(n)]


def test_pairs_grow_with_the_number_of_near_copies(spark, make, prose, monkeypatch):
    counts = []
    for n in (200, 400, 800):
        asked = []
        plain = near_copies._verified
        monkeypatch.setattr(near_copies, "_verified", lambda pairs, *a, asked=asked: asked.append(pairs.count()) or plain(pairs, *a))
        texts = group(prose, n, 3)
        kept = sorted(r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, make(texts), "").collect())
        monkeypatch.setattr(near_copies, "_verified", plain)
        counts.append(sum(asked))
        sets = [shingles_by_hand(t) for t in texts]
        links = [(a, b) for a, b in combinations(range(n), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
        want = sorted(set(roots_by_hand(n, links)))
        gone = set(range(n)) - set(want)
        assert set(want) <= set(kept) and len(gone - set(kept)) >= 0.9 * len(gone)
    assert counts[1] <= 3 * counts[0] and counts[2] <= 3 * counts[1] and counts[2] <= 10 * 800, counts


def test_odd_rows_of_the_stage(spark, make, prose):
    docs = make(["a b", None, "a b", "", prose(70_000, 3)], [3, 5, 3, None, 4])
    assert sorted(r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()) == [3, 4, 5]
    assert corpus_pipeline.one_of_each_group(spark, docs.limit(0), "").count() == 0


def test_shingles_of_texts_beyond_a_block(monkeypatch, prose):
    text = f"{prose(300, 1)} {'x' * 600} {prose(20, 2)}"
    want = {len(shingles_by_hand(text))}
    monkeypatch.setattr(near_copies, "BLOCK", 500)
    found = near_copies.shingle_set(text)
    assert {len(found)} == want and near_copies.alike(found, near_copies.shingle_set(f"{text} end"))
    assert (np.diff(found.astype(object)) > 0).all()


@pytest.mark.parametrize("part", [7, 1024])
def test_large_classes_are_compared_whole(spark, make, prose, monkeypatch, part):
    nothing = lambda texts: texts.select(texts["node"].alias("u"), texts["node"].alias("v")).limit(0)
    for name, value in {"STARS": 0, "OFTEN": 10**9, "grid_pairs": nothing, "PART": part}.items():
        monkeypatch.setattr(near_copies, name, value)
    # All hold one line, and hardly more, so a third of the alike ones share shingles of that line only among those they are dealt by.
    line = prose(30, 4)
    texts = [f"{line} {prose(4, 20 + k)}" for k in range(100)]
    texts += [f"{t} end" for t in texts[10:40]]
    random.Random(1).shuffle(texts)
    links = [(a, b) for a, b in combinations(range(len(texts)), 2) if similarity_by_hand(texts[a], texts[b]) >= 0.8]
    want = sorted(set(roots_by_hand(len(texts), links)))
    kept = corpus_pipeline.one_of_each_group(spark, make(texts), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == want and 80 < len(want) <= 100
