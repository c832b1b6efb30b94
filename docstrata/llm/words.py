"""Token ids of many texts at once: each distinct word is encoded by the tokenizer once, texts are put together by number.

Texts are cut into words that the tokenizer encodes each by itself. Words of up to 24 bytes are three numbers, looked up all at once in
a table of those met before; the ids of all words lie in one array, so a batch's ids are one gather.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Characters of texts cut at once, and bytes of known words and their ids beyond which a worker starts anew.
AT_ONCE, KEPT_BYTES = 1 << 20, 128 << 20
#: Bytes of a word that is looked up by number, and what a known word costs beside its ids.
SHORT, WORD_COST = 24, 64
#: What keeps the first 0 to 8 bytes of a little-endian number.
FIRST_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class KnownWords:
    """The ids of every word met. ``learn`` gives the ids of new words in one array, and how many each has."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.learn = learn
        self.clear()

    def clear(self) -> None:
        self.count = self.bytes = 0
        self.ids, self.first = np.empty(1 << 16, np.uint32), np.zeros((1 << 14) + 1, np.int64)
        self.key, self.size = np.zeros((1 << 14, 3), np.uint64), np.zeros(1 << 14, np.int64)
        self.table = np.full(1 << 16, -1, np.int32)
        self.long: dict[str, int] = {}

    def _hash(self, key: np.ndarray, size: np.ndarray) -> np.ndarray:
        mixed = key[:, 0] * MIX[0] ^ key[:, 1] * MIX[1] ^ key[:, 2] * MIX[2] ^ size.astype(np.uint64) * MIX[3]
        mixed ^= mixed >> np.uint64(32)
        mixed *= MIX[0]
        return mixed ^ mixed >> np.uint64(29)

    def _place(self, number: np.ndarray) -> None:
        """Put known words into the table, each at the first free slot from its own."""
        last = np.uint64(len(self.table) - 1)
        slot = (self._hash(self.key[number], self.size[number]) & last).astype(np.int64)
        while len(number):
            free = np.flatnonzero(self.table[slot] < 0)
            own, at = np.unique(slot[free], return_index=True)
            self.table[own] = number[free[at]]
            left = np.ones(len(number), bool)
            left[free[at]] = False
            number, slot = number[left], slot[left] + 1 & int(last)

    def _find(self, key: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number of each word of ``size`` bytes at most ``SHORT``, -1 if unknown."""
        last = len(self.table) - 1
        slot = (self._hash(key, size) & np.uint64(last)).astype(np.int64)
        out, left = np.full(len(key), -1, np.int64), np.arange(len(key))
        while len(left):
            met = self.table[slot].astype(np.int64)
            left, slot, met = (x[met >= 0] for x in (left, slot, met))
            same = (self.size[met] == size[left]) & (self.key[met, 0] == key[left, 0]) & (self.key[met, 1] == key[left, 1]) & (self.key[met, 2] == key[left, 2])
            out[left[same]] = met[same]
            left, slot = left[~same], slot[~same] + 1 & last
        return out

    def _room(self, words: int, ids: int) -> None:
        if self.count + words > len(self.size):
            more = max(len(self.size), words)
            self.first = np.concatenate([self.first, np.zeros(more, np.int64)])
            self.key = np.concatenate([self.key, np.zeros((more, 3), np.uint64)])
            self.size = np.concatenate([self.size, np.zeros(more, np.int64)])
        if ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(max(len(self.ids), ids - len(self.ids)), np.uint32)])

    def _add(self, words: list[str], key: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of words that are new, given their keys and sizes in bytes."""
        found, sizes = self.learn(words)
        n, end = self.count, int(self.first[self.count])
        self._room(len(words), end + len(found))
        self.ids[end : end + len(found)] = found
        self.first[n + 1 : n + 1 + len(words)] = end + np.cumsum(sizes)
        self.key[n : n + len(words)], self.size[n : n + len(words)] = key, size
        self.count += len(words)
        self.bytes += 4 * len(found) + WORD_COST * len(words)
        number = np.arange(n, n + len(words))
        if self.count > len(self.table) // 2:
            self.table = np.full(4 * len(self.table), -1, np.int32)
            known = np.arange(self.count)
            self._place(known[self.size[: self.count] <= SHORT])
        else:
            self._place(number[size <= SHORT])
        for i in np.flatnonzero(size > SHORT).tolist():
            self.long[words[i]] = n + i
            self.bytes += int(size[i])
        return number

    def numbers(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if self.bytes > KEPT_BYTES:
            self.clear()
        start, size = bounds[:-1], np.diff(bounds)
        padded = np.concatenate([data, np.zeros(SHORT, np.uint8)])
        eight = np.ndarray((len(data) + SHORT - 7,), "<u8", padded, strides=(1,))
        key = np.empty((len(start), 3), np.uint64)
        for k in range(3):
            key[:, k] = eight[np.minimum(start + 8 * k, len(data))] & FIRST_BYTES[np.clip(size - 8 * k, 0, 8)]
        number = np.full(len(start), -1, np.int64)
        short = np.flatnonzero(size <= SHORT)
        number[short] = self._find(key[short], size[short])
        missing = np.flatnonzero(number < 0)
        if len(missing):
            every = pa.StringArray.from_buffers(len(start), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data))
            coded = every.take(pa.array(missing)).dictionary_encode()
            words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            own = np.fromiter((self.long.get(w, -1) if len(w) > SHORT // 4 else -1 for w in words), np.int64, len(words))
            new = np.flatnonzero(own < 0)
            if len(new):
                example = np.empty(len(words), np.int64)
                example[code[::-1]] = missing[::-1]
                own[new] = self._add([words[i] for i in new.tolist()], key[example[new]], size[example[new]])
            number[missing] = own[code]
        return number

    def gather(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words ``data[bounds[i]:bounds[i + 1]]`` in turn, and where each word's ids begin among them."""
        word = self.numbers(data, bounds)
        first = self.first[word]
        sizes = self.first[word + 1] - first
        begins = np.zeros(len(word) + 1, np.int64)
        np.cumsum(sizes, out=begins[1:])
        return self.ids[np.arange(begins[-1]) + np.repeat(first - begins[:-1], sizes)], begins


def plain_ids(tokenizer, texts: list[str]) -> list[np.ndarray]:
    return [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def loaded(name: str):
    """The named public tokenizer, for which the text of a special token is text like any other."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return tokenizer


#: A place where every word ends: white space after something else.
WORD_ENDS = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \n])")


def pieces(text: str, most: int) -> Iterator[str]:
    """``text`` in parts of about ``most`` characters, cut only where a word ends."""
    at = 0
    while len(text) - at > most:
        cut = WORD_ENDS.search(text, at + most)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class TextEncoder:
    """Ids of whole texts. A subclass says how texts are cut into words and which ones the tokenizer must have whole."""

    def __init__(self, name: str):
        self.tokenizer = loaded(name)
        self.words = KnownWords(self.learn)

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = plain_ids(self.tokenizer, words)
        return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))

    def is_plain(self, text: str) -> bool:
        raise NotImplementedError

    def cut(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the texts' words, where each begins (and the last ends), and the first word of each text (and the end)."""
        raise NotImplementedError

    def _some(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        data, bounds, first = self.cut(texts)
        if len(bounds) < 2:
            return [np.empty(0, np.uint32) for _ in texts]
        ids, begins = self.words.gather(data, bounds)
        ends = begins[first]
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, owner, size = [], [], 0

        def flush() -> None:
            nonlocal held, owner, size
            for i, ids in zip(owner, self._some(held)):
                out[i].append(ids)
            held, owner, size = [], [], 0

        for i, text in enumerate(texts):
            if not self.is_plain(text):
                out[i] = plain_ids(self.tokenizer, [text])
                continue
            for part in pieces(text, AT_ONCE) if len(text) > AT_ONCE else (text,):
                held.append(part)
                owner.append(i)
                size += len(part)
                if size >= AT_ONCE:
                    flush()
        flush()
        return [parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint32) for parts in out]
