"""Token files against the tokenizer's own ids, and single documents against whole files."""

import zlib
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from docstrata.llm import token_files, words
from docstrata.session import scratch_path


@cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    plain.encode_special_tokens = True
    return plain


def ids_by_hand(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "don't 'tis we'll I'LL 's'd 're've it's", "a  b \n\n c\t\td \r\n", "x\x1f\x1cy\x85z\xa0 w", "½ ² 3 ٣ é́", "<|endoftext|>", "日本語 テスト 😀", "  ", "'", "1'st 2'nd", "x" * 60 + " y"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(alphabet="a sdtrevlm'\n\t1.é€ ", max_size=25), st.text(max_size=20)), min_size=1, max_size=6))
def test_texts_have_the_tokenizers_ids(texts):
    found = [x.tolist() for x in token_files._encoder(token_files.TOKENIZER).encode(texts)]
    assert found == [ids_by_hand(t) for t in texts]


def test_long_texts_are_cut_where_words_end(monkeypatch, prose):
    monkeypatch.setattr(words, "AT_ONCE", 50)
    texts = [prose(200, 1).replace(" ", "  \n ", 30), "x" * 300, "", prose(100, 2)]
    found = [x.tolist() for x in token_files._encoder(token_files.TOKENIZER).encode(texts)]
    assert found == [ids_by_hand(t) for t in texts]


def test_a_full_memory_of_words_starts_anew(monkeypatch, prose):
    encoder = token_files.ByteEncoder(token_files.TOKENIZER)
    monkeypatch.setattr(words, "KEPT_BYTES", 2000)
    for k in range(6):
        text = prose(150, k) + " " + "Wort" * 10
        assert encoder.encode([text])[0].tolist() == ids_by_hand(text)
        assert encoder.words.count < 400


def written(spark, docs, **options):
    return token_files.write_token_files(docs, scratch_path(spark, "test-tokens"), **options)


@pytest.fixture
def corpus(spark, make, prose):
    texts = [None, "", prose(30, 1), prose(30, 1), prose(900, 2), "a", *(prose(20 + k, 10 + k) for k in range(60)), "last", None]
    ids = [7, 3, 40, 40, -5, None, *range(100, 160), (1 << 63) - 1, None]
    return texts, ids, make(texts, ids)


def expected(texts, ids):
    """(doc_id, start, n_tokens, crc) by hand; equal ids in any order of their texts."""
    rows = sorted(zip(ids, texts), key=lambda r: (r[0] is None, r[0] or 0))
    start, out = 0, []
    for doc_id, text in rows:
        data = np.array([*ids_by_hand(text), 2], "<u4").tobytes()
        out.append((doc_id, start, len(data) // 4, zlib.crc32(data)))
        start += len(data) // 4
    return out


@pytest.mark.parametrize("files", [None, 5])
def test_files_hold_all_documents_in_order(spark, corpus, files):
    texts, ids, docs = corpus
    manifest = written(spark, docs, files=files, frame_ids=64)
    rows = token_files.read_token_files(manifest).collect()
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in rows), key=lambda r: r[1])
    want = expected(texts, ids)
    known = [r for r in want if r[0] is not None]
    assert got[: len(known)] == known
    assert sorted(r[2:] for r in got[len(known) :]) == sorted(r[2:] for r in want[len(known) :]) and {r[0] for r in got[len(known) :]} == {None}
    assert got[-1][1] + got[-1][2] == want[-1][1] + want[-1][2]
    parts = manifest.orderBy("share").collect()
    assert sum(p["n_docs"] for p in parts) == len(texts) and (files is None or len(parts) > 1)
    assert manifest.where("n_frames > 1").count() > 0


def test_any_zstandard_tool_reads_a_file(spark, corpus):
    from zstandard import ZstdDecompressor

    texts, ids, docs = corpus
    part = written(spark, docs, files=1, frame_ids=64).first()
    with open(part["path"].removeprefix("file://"), "rb") as f:
        data = f.read()
    plain = ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert len(data) == part["n_bytes"] and len(plain) == 4 * part["n_tokens"]
    assert zlib.crc32(plain[: 4 * expected(texts, ids)[0][2]]) == expected(texts, ids)[0][3]


def test_a_reader_opens_only_the_frames_it_needs(spark, corpus):
    texts, ids, docs = corpus
    manifest = written(spark, docs, files=1, frame_ids=500)
    reader = token_files._opened(manifest.first()["path"])
    table = reader.documents()
    one = table[table["doc_id"] == 130].iloc[0]
    data = next(reader.read([(int(one["place"]), int(one["n_tokens"]), int(one["frame"]))]))
    assert data == np.array([*ids_by_hand(texts[ids.index(130)]), 2], "<u4").tobytes() and reader.unpacked == 1 < len(reader.entries) - 2
    wanted = spark.createDataFrame([(130,), (130,), (-5,), (None,), (999,)], "doc_id long")
    got = {(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in token_files.read_documents(manifest, wanted).collect()}
    assert got == {r for r in expected(texts, ids) if r[0] in (130, -5)}


def test_spoilt_files_are_refused(spark, corpus, tmp_path):
    part = written(spark, corpus[2], files=1, frame_ids=64).first()
    data = bytearray(open(part["path"].removeprefix("file://"), "rb").read())

    def reader(content):
        path = tmp_path / f"f{len(list(tmp_path.iterdir()))}"
        path.write_bytes(content)
        return token_files._opened(f"file://{path}")

    assert reader(data).frame(0)
    entry = len(data) - 9 - (part["n_frames"] + 1) * 12
    wrong = data.copy()
    wrong[entry + 8] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        reader(wrong).frame(0)
    with pytest.raises(ValueError):
        reader(data[:-3])


def test_no_rows_make_no_files(spark, corpus):
    manifest = written(spark, corpus[2].limit(0))
    assert manifest.count() == 0 and token_files.read_token_files(manifest).count() == 0
    assert token_files.read_documents(manifest, corpus[2]).count() == 0


def test_query_against_the_tokenizer(spark):
    from compare import SF_DIR

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = token_files.op11_token_files(spark, SF_DIR).collect()
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert got == expected([d["text"] for d in docs], [d["doc_id"] for d in docs])
