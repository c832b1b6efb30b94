"""Operators that look at each text by itself: language, licences, secrets, quality, packing."""

import base64
import hashlib
import json
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from docstrata.llm import langid, licenses, packing, quality, secrets
from docstrata.llm.common import held_out
from pyspark.sql import functions as F


def test_held_out_fold_is_a_checksum_of_the_id(spark):
    rows = spark.range(50).union(spark.sql("SELECT CAST(NULL AS LONG)")).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (r["id"] is not None and zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def grams_by_hand(text):
    from collections import Counter

    counts = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        framed = f"\x00{word}\x00"
        counts.update(word)
        counts.update(framed[i : i + 2] for i in range(len(framed) - 1))
        counts.update(framed[i : i + 3] for i in range(len(framed) - 2))
    return counts


@pytest.mark.parametrize("text", ["", "a", "Ab, ab! çé", "x1y_z", "one two\nthree", "日本 語", "\U00010428 z"])
def test_grams_match_counting_by_hand(text):
    grams, counts = langid.count_grams(text)
    plain = {}
    for gram, n in zip(grams.tolist(), counts.tolist()):
        codes = [(gram >> shift) & ((1 << 21) - 1) for shift in (42, 21, 0)]
        plain["".join("\x00" if c == 1 else chr(c - 2) for c in codes if c)] = n
    assert plain == dict(grams_by_hand(text))


def test_language_of_odd_rows(spark, make):
    texts = ["the cat and the dog"] * 4 + ["le chat et le chien"] * 4 + [None, "", "12 34 !", "the dog " * 50_000]
    docs = make(texts, langs=["en"] * 4 + ["fr"] * 4 + [None, None, "en", "en"])
    profiles = langid.fit(docs)
    found, name = langid.identify(docs, profiles)
    rows = {r["doc_id"]: r[name] for r in found.collect()}
    assert set(found.columns) == {*docs.columns, name} and len(rows) == 12
    assert [rows[i]["lang_pred"] for i in range(12)] == ["en"] * 4 + ["fr"] * 4 + ["und"] * 3 + ["en"]
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    empty, name = langid.identify(docs.limit(0), langid.fit(docs.limit(0)))
    assert empty.count() == 0
    assert langid.Profiles.of({}).predict("the") == ("und", 0.0)


def base_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [
        (i, label)
        for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(words), sorted(i for i, _ in places), ",".join(sorted({label for _, label in places}))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["CC", "by", "-", "all rights", "Reserved.", "general", "public\n", "license", "É", "x2", "cc by cc by"]), max_size=12).map(" ".join))
def test_base_phrases_match_words_in_turn(text):
    found, (n, places, labels) = licenses.scan_text(text), base_by_hand(text)
    assert (found["n_words"], found["n_base"], found["base_labels"]) == (n, len(places), labels)
    assert found["first_word"] == min(places, default=None) and found["last_word"] == max(places, default=None)
    assert set(labels.split(",")) - {""} <= set(found["labels"].split(","))


@pytest.mark.parametrize("notice, label", [("Licensed undr the Apache Licence, Version 2.0", "apache"), ("Relaesed under the MIT license", "mit")])
def test_notices_with_edits_give_label_and_span(notice, label):
    text = f"Some words. {notice}! And more"
    found = licenses.scan_text(text)
    assert label in found["labels"] and 0 < found["score"] < 1
    span = next(s for s in found["spans"] if s["label"] == label)
    assert text[span["start"] : span["end"]] == notice and span["edits"] > 0


def test_fuzzy_search_misses_nothing_the_matcher_finds_alone():
    import random

    import regex

    rng = random.Random(3)
    for notice, label, firm in licenses.NOTICES:
        edits = len(notice) // licenses.CHARS_PER_EDIT
        spoilt = list(notice)
        at = notice.find(firm) if firm else -2
        places = [i for i in range(len(spoilt)) if not at - 1 <= i <= at + len(firm)]
        for _ in range(edits):
            spoilt[rng.choice(places)] = rng.choice("qxz")
        line = f"aaa bbb {''.join(spoilt)} ccc"
        assert regex.search(f"(?:{regex.escape(notice)}){{e<={edits}}}", line)
        assert any(m.label == label for m in licenses.fuzzy_matches(line))


@pytest.mark.parametrize("text, labels", [
    ("licensed under CC BY-SA 4.0", "cc-by,cc-by-sa"),
    ("licensed under CC BY-ND 4.0", "cc-by,cc-by-nd"),
    ("Licensed under CC BY-NC 3.0", "cc-by,cc-by-nc"),
    ("licensed under CC BY-NC-SA 4.0", "cc-by,cc-by-nc-sa"),
    ("licensed under CC BY-NC-ND 4.0", "cc-by,cc-by-nc-nd"),
    ("licensed under CC BY 4.0", "cc-by"),
    ("Licensed under the Creative Commons Attribution-ShareAlike 4.0 licence", "cc-by-sa"),
    ("Licensed under the Creative Commons Attribution-NonCommercial-NoDerivatives", "cc-by-nc-nd"),
    ("Licensed under the Creative Commons Attribution 4.0 licence", "cc-by"),
    ("Licensed under the Apache License, Version 1.1", "apache-1.1"),
    ("Licensed under the Apache License, Version 2.0", "apache"),
    ("Distributed under the BSD 3-Clause License", "bsd"),
    ("Distributed under the BSD 2-Clause License", "bsd"),
    ("licensed under the GNU GPL", "gpl"),
    ("under the terms of the GNU Lesser General Public License", "gpl,lgpl"),
    ("a licence for all of us", ""),
])
def test_words_that_tell_licences_apart(text, labels):
    assert licenses.scan_text(f"Some words. {text}, and more.")["labels"] == labels


def test_a_text_of_many_notices_is_scanned_once_through():
    text = "licensed under CC BY-SA 4.0 and licensed under the MIT license. " * 5_000
    found = licenses.scan_text(text)
    assert found["labels"] == "cc-by,cc-by-sa,mit" and len(found["spans"]) == 10_000


def test_licences_of_odd_rows(make):
    found, name = licenses.scan_licenses(make([None, "", "all rights reserved " * 30_000, "cc-by", "cc-by"]))
    rows = {r["doc_id"]: r[name] for r in found.collect()}
    assert (rows[0]["n_words"], rows[0]["first_word"], rows[0]["labels"]) == (0, None, "") == (rows[1]["n_words"], rows[1]["first_word"], rows[1]["labels"])
    assert (rows[2]["n_base"], rows[2]["last_word"]) == (30_000, 89_997)
    assert rows[3] == rows[4] and rows[3]["labels"] == "cc-by"


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x82]) + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


KEY = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48")), der(4, bytes(range(1, 90))))
FIELD = lambda x: len(x).to_bytes(4, "big") + x
SSH = secrets.OPENSSH + FIELD(b"none") + FIELD(b"none") + FIELD(b"") + (1).to_bytes(4, "big") + FIELD(b"p" * 30) + FIELD(b"k" * 60)
B64 = lambda x: base64.b64encode(x).decode()
URL = lambda x: base64.urlsafe_b64encode(x).decode().rstrip("=")
TOKEN = f"{URL(json.dumps({'alg': 'HS256'}).encode())}.{URL(json.dumps({'sub': 'x'}).encode())}.c2ln"


@pytest.mark.parametrize("text, kind", [
    (B64(KEY), "der"), (KEY.hex(), "der"), (B64(SSH), "openssh"), (TOKEN, "jwt"),
    (f"-----BEGIN PRIVATE KEY-----\n{B64(KEY)}\n-----END PRIVATE KEY-----", "pem"),
])
def test_structures_are_confirmed_and_spoilt_ones_are_not(text, kind):
    framed = f"see ñ {text} end"
    spans = [s for s in secrets.scan_text(framed)[4].split(",") if s.startswith(kind)]
    assert spans == [f"{kind}:6:{6 + len(text)}"]
    assert "[redacted]" in secrets.redacted_text(framed) and text not in secrets.redacted_text(framed)
    spoilt = B64(KEY[:-1]) if kind != "jwt" else TOKEN.replace(TOKEN[:10], "eyJxxxxxxx")
    assert not any(k in secrets.scan_text(f"see {spoilt} end")[4] for k in ("der", "openssh", "jwt", "pem"))


def base_secrets_by_hand(text):
    spans = []
    for kind, pattern, least in (("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8), ("access", "(AKIA[A-Z0-9]+)", 16), ("hex", "([0-9a-f]+)", 32)):
        spans += [(m.start(), ("assign", "access", "hex").index(kind), m.end(), kind) for m in re.finditer(pattern, text) if len(m[1]) >= least]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["Token", "api_KEY", "secret", "=", ": ", '"', " ", "abcd1234", "AKIA", "ABCDEF012345", "0123456789abcdef" * 2, "ſecret", "K", "x."]), max_size=14).map("".join))
def test_base_spans_match_plain_patterns(text):
    n = secrets.scan_text(text)
    spans = base_secrets_by_hand(text)
    assert n[3] == hashlib.sha256(spans.encode()).hexdigest()
    assert [n[0], n[1], n[2]] == [spans.count(k) for k in ("assign:", "access:", "hex:")]
    assert set(spans.split(",")) <= {*n[4].split(","), ""}


def test_redaction_keeps_rows_and_columns(make):
    docs = make([None, "", "token = abcdefgh1 rest", "plain", "plain", "f" * 40])
    rows = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert secrets.redact(docs).columns == docs.columns and len(rows) == 6
    assert [rows[i]["text"] for i in range(6)] == [None, "", "[redacted] rest", "plain", "plain", "f" * 40]
    assert rows[2]["n_chars"] == len("[redacted] rest")


def test_convolution_sees_every_window_once():
    rng = np.random.default_rng(1)
    weights = quality.start()
    tables = quality.answers(weights)
    for size in (0, 1, 9, 10, 1023, 1024, 1025, 5000):
        data = rng.integers(0, 256, size, dtype=np.uint8)
        padded = np.pad(data, (0, max(0, quality.WIDTH + quality.STEP - size)))
        windows = range(0, len(padded) - quality.WIDTH + 1, quality.STEP)
        plain = np.array([sum(tables[j][padded[w + j]] for j in range(quality.WIDTH)) for w in windows])
        assert np.allclose(quality.convolve(data, tables, weights["bias"]).best.max(axis=0), np.maximum(plain, 0).max(axis=0), atol=1e-4)


def test_gradient_matches_differences():
    rng = np.random.default_rng(2)
    weights = {k: v.astype(np.float64) + (0.3 if k == "bias" else 0) for k, v in quality.start().items()}
    texts, labels = [rng.integers(97, 103, 300, dtype=np.uint8) for _ in range(3)], np.array([1.0, 0.0, 1.0])

    def loss(w):
        p = [quality.probability(quality.features(quality.convolve(t, quality.answers(w), w["bias"])), w) for t in texts]
        return -np.mean([np.log(a if y else 1 - a) for a, y in zip(p, labels)])

    slopes = quality._step(texts, labels, weights)
    for k, at in (("bytes", (98, 3)), ("filters", (2, 4, 5)), ("bias", (3,)), ("unit", (4,)), ("unit", (30,)), ("rest", (0,))):
        up, down = ({**weights, k: weights[k].copy()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert slopes[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=2e-2, abs=1e-6)


def test_quality_learns_and_scores_odd_rows(spark, make, prose):
    texts = [prose(40, i) if i % 2 else "### " * (20 + i) for i in range(60)] + [None, "", "x" * 300_000]
    docs = make(texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (999, 0), (1, None)], "doc_id long, quality int")
    found, name = quality.score(docs, quality.fit(docs, labels))
    rows = {r["doc_id"]: r[name] for r in found.collect()}
    assert len(rows) == 63 and all(0 <= v <= 1 for v in rows.values())
    assert np.mean([(rows[i] >= 0.5) == bool(i % 2) for i in range(60)]) > 0.9
    nothing = quality.fit(docs.limit(0), labels.limit(0))
    assert all((nothing[k] == v).all() for k, v in quality.start().items())


def ids_by_hand(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    plain.encode_special_tokens = True
    return [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


ODD = ["", " ", "It's 3,000 o'clock... «ÀÉ» İstanbul ſ", "áb ë Å\t\n\r\x0b\x1c x", "word— —*** ***é é***", "<|endoftext|> ok", "日本語 テスト ﬁ", "ΑΣ ΣΑΣ.", "don't!! can't.", "x" * 500 + " y"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=30)), min_size=1, max_size=6))
def test_remembered_words_give_the_tokenizers_ids(texts):
    encoder = packing._encoder(packing.TOKENIZER)
    found = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert found == ids_by_hand(texts)


def test_pieces_put_every_id_in_one_place(spark, make, prose):
    texts = [None, "", prose(30, 1), prose(30, 1), prose(2000, 2), "a"]
    ids = [0, 1, 2, 2, 4, None]
    docs = make(texts, ids)
    pieces = packing.pack(docs, window=64).collect()
    want = sorted(zlib.crc32(np.array([*x, 2], "<u4").tobytes()) for x in ids_by_hand(texts))
    whole, line = {}, []
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["sequence_id"] * 64 + p["offset"] == len(line) and p["offset"] + p["length"] <= 64
        line += np.frombuffer(p["ids"], "<u4").tolist()
        assert zlib.crc32(bytes(p["ids"])) == p["ids_crc32"]
    parts, got = [], []
    for i in line:
        parts.append(i)
        if i == 2:
            got.append(zlib.crc32(np.array(parts, "<u4").tobytes()))
            parts = []
    assert sorted(got) == want and not parts
    assert packing.sequences(packing.pack(docs, window=64)).count() == -(-len(line) // 64)
    assert packing.pack(docs.limit(0)).count() == 0
