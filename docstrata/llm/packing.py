"""Packing by concatenation: all documents as one line of tokens, cut into windows of a fixed length.

Two passes. The first turns texts into tokens and notes, per task, each document's place in that task's share and
the share's total. A prefix sum over the totals, one row per task, gives every share its place in the whole. The second
cuts each document where a window ends; the pieces carry window and offset, so they are the boundary records of the
windows. Tokens never move between tasks, only the last window is not full, and no task needs its neighbours.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from docstrata.llm.common import bounded_batches, documents, settle
from docstrata.llm.words import TextEncoder, plain_ids

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
WINDOW = 4096
#: Texts a worker encodes at once.
AT_ONCE = 128
WORD_END = "</w>"

#: Letters up to U+024F without the dotted capital I: one to one in lower case, unchanged by normalisation.
UNUSUAL = re.compile("[^\\x00-\\u012f\\u0131-\\u024f]")
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: What a byte is; bytes of digits and of letters beyond ASCII are neither.
BLANK, LETTER, MARK = 1, 2, 3
KIND = np.zeros(256, np.uint8)
for _kind, _bytes in ((BLANK, b" \t\r\n"), (LETTER, bytes(range(97, 123))), (MARK, PUNCTUATION.encode())):
    KIND[list(_bytes)] = _kind


class Encoder(TextEncoder):
    """Token ids of texts by words.

    The tokenizer drops white space and no token spans it, so a text's ids are its words' ids in turn. Plain letters
    followed by ASCII punctuation are two tokens or more, cut between the two.
    """

    def __init__(self, name: str):
        super().__init__(name)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter((w.isalpha() and not UNUSUAL.search(w) for w in words), bool, len(words))
        many = [w for w, p in zip(words, plain.tolist()) if p]
        # Words of plain letters are one pre-token each, so many of them go into one call and end at the tokens that end a word.
        ids = plain_ids(self.tokenizer, [" ".join(many)])[0]
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(many):
            return super().learn(words)
        ids, sizes = (np.r_[a, b] for a, b in zip((ids, np.diff(ends, prepend=0)), super().learn([w for w, p in zip(words, plain.tolist()) if not p] or [""])))
        order = np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]
        back = np.argsort(order, kind="stable")
        first = np.cumsum(sizes) - sizes
        place = np.repeat(first[back] - (np.cumsum(sizes[back]) - sizes[back]), sizes[back]) + np.arange(sizes[back].sum())
        return ids[place], sizes[back]

    def is_plain(self, text: str) -> bool:
        return True

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low = [t if UNUSUAL.search(t) else t.lower() for t in texts]
        data = np.frombuffer("\n".join(["", *low, ""]).encode(), np.uint8)
        kind = KIND[data]
        here, after = kind[:-1], kind[1:]
        begin = np.flatnonzero((here == BLANK) & (after != BLANK)) + 1
        # Plain letters before the marks that end a word are a word of their own.
        turn = np.flatnonzero((here != after) & (here != BLANK) & (after != BLANK))
        word = np.searchsorted(begin, turn, side="right") - 1
        turn = turn[(np.bincount(word, minlength=1)[word] == 1) & (kind[turn] == LETTER) & (kind[turn + 1] == MARK)]
        begin = np.sort(np.concatenate([begin, turn + 1]))
        used = kind != BLANK
        bounds = np.r_[np.cumsum(used)[begin] - 1, np.count_nonzero(used)]
        sizes = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in low), np.int64, len(low))
        return data[used], bounds, np.searchsorted(begin, np.r_[0, np.cumsum(sizes + 1)])


@cache
def _encoder(name: str) -> Encoder:
    return Encoder(name)


def token_shares(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Per row: ``doc_id``, its ids, their number, the task and the place in its share. Write it before reading it twice."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        share, reached, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4")
        for batch in batches:
            for first in range(0, len(batch), AT_ONCE):
                rows = batch.iloc[first : first + AT_ONCE]
                ids = [np.concatenate([found, end]).astype("<u4").tobytes() for found in _encoder(tokenizer).encode([t or "" for t in rows["text"]])]
                sizes = np.array([len(i) // 4 for i in ids], np.int64)
                starts = reached + np.cumsum(sizes) - sizes
                reached += int(sizes.sum())
                yield pd.DataFrame({"doc_id": rows["doc_id"].array, "share": share, "place": starts, "doc_tokens": sizes, "ids": ids})

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInPandas(encode, "doc_id long, share int, place long, doc_tokens long, ids binary")


def share_offsets(shares: DataFrame) -> DataFrame:
    """Where each task's share begins in the whole: a prefix sum over one row per task."""
    totals = shares.groupBy("share").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("share", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("share_start"))


def _cut(window: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first, size = batch["first"].to_numpy(np.int64), batch["doc_tokens"].to_numpy(np.int64)
            pieces = (first + size - 1) // window - first // window + 1
            row = np.repeat(np.arange(len(batch)), pieces)
            sequence = first[row] // window + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = np.maximum(first[row], sequence * window)
            length = np.minimum(first[row] + size[row], (sequence + 1) * window) - begin
            start = begin - first[row]
            ids = batch["ids"].to_list()
            cuts = [ids[r][4 * a : 4 * (a + n)] for r, a, n in zip(row.tolist(), start.tolist(), length.tolist())]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].array.take(row),
                "start": start,
                "length": length,
                "ids_crc32": [zlib.crc32(piece) for piece in cuts],
                "doc_tokens": size[row],
                "sequence_id": sequence,
                "offset": begin - sequence * window,
                "ids": cuts,
            })

    return cut


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents in windows of ``window`` tokens, with their ids as little-endian 32-bit numbers.

    Null and empty texts are the end id alone. Repeated rows and null ids are packed as they come, each row once;
    columns other than the two named are left out. No rows give no pieces.
    """
    shares = settle(token_shares(docs, text, doc_id, tokenizer, end_id), "token-shares")
    offsets = settle(share_offsets(shares), "share-offsets")
    # One small row per task on the right: Spark broadcasts it as long as its file is below its own limit.
    placed = shares.join(offsets, "share").select("doc_id", (F.col("share_start") + F.col("place")).alias("first"), "doc_tokens", "ids")
    return placed.mapInPandas(_cut(window), f"{PIECE}, ids binary")


def sequences(pieces: DataFrame) -> DataFrame:
    """Each window's pieces in order, ids included. A window holds at most its length in tokens, so a group is small."""
    record = F.struct("offset", "doc_id", "start", "length", "ids")
    return pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(record)).alias("pieces"))


def op2_concat_and_cut(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).drop("ids")
