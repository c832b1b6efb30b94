"""Token ids in files of independent zstandard frames, so that a reader decompresses only what it was asked for.

A file holds little-endian unsigned 32-bit ids, documents in ascending order, in frames of bounded size that end where
documents end (a document beyond a frame's size has frames of its own). After them come a skippable frame with the documents'
ids and places, and a skippable frame with the seek table of the public zstandard seekable format: compressed size, size and the low
half of the XXH64 of each frame. So any zstandard tool reads the ids of a whole file, and this module reads single documents.

Rows are dealt by ranges of document ids and sorted; each task writes one file under a name of its attempt. Only the manifest, one row
for each file of a task that ended well, says which files count, so lost executors leave nothing that a reader would see.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from docstrata.llm.common import bounded_batches, doc_order, documents, settle
from docstrata.llm.words import TextEncoder
from docstrata.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Ids in a frame, at most, but for the document that fills it; ids of a frame of a longer document.
FRAME_IDS = 1 << 16
LEVEL = 3
#: Fixed values of the public seekable format: skippable frames, its footer, and the mark of a table with checksums.
SKIPPABLE, SEEK_FRAME, SEEKABLE, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
DOCUMENT = np.dtype([("doc_id", "<i8"), ("place", "<u8"), ("known", "?")])
#: Texts a worker encodes at once.
AT_ONCE = 128

LETTER, NUMBER, OTHER, BLANK = 1, 2, 3, 4
#: Characters whose kind is asked of the tokenizer; a text with others goes to it whole.
ASKED = 0x3000
UNASKED = re.compile("[^\\x00-\\u2fff]")


class ByteEncoder(TextEncoder):
    """Ids of texts by the pre-tokens of the byte-level tokenizer: contractions, runs of one kind after a space, white space."""

    def __init__(self, name: str):
        super().__init__(name)
        self.kind = np.full(ASKED, BLANK, np.uint8)
        for kind, before in ((OTHER, "!"), (NUMBER, "1"), (LETTER, "a")):
            line = "".join(f"{before}{chr(c)}\n" for c in range(ASKED))
            begins = np.zeros(len(line), bool)
            begins[[start for _, (start, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(line)]] = True
            self.kind[~begins[1::3]] = kind

    def is_plain(self, text: str) -> bool:
        return text.isascii() or not UNASKED.search(text)

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        line = "".join(texts)
        code = np.frombuffer(line.encode("utf-32-le"), np.uint32)
        starts = np.cumsum([0, *map(len, texts)])
        if not len(code):
            return np.empty(0, np.uint8), np.zeros(1, np.int64), np.zeros(len(starts), np.int64)
        kind = self.kind[code]
        first = np.zeros(len(code) + 1, bool)
        first[starts] = True
        blank = kind == BLANK
        # White space starts a token after something else, and its last character where something follows.
        ends = np.r_[~blank[1:], False] & ~first[1:]
        begins = np.ones(len(code), bool)
        begins[1:] = np.where(blank[1:], ~blank[:-1] | ends[1:], (kind[1:] != kind[:-1]) & (code[:-1] != 32))
        begins |= first[:-1]
        self._contractions(code, kind, first, begins)
        word = np.flatnonzero(begins)
        if line.isascii():
            return code.astype(np.uint8), np.r_[word, len(code)], np.searchsorted(word, starts)
        width = 1 + (code >= 0x80) + (code >= 0x800)
        return np.frombuffer(line.encode(), np.uint8), np.r_[0, np.cumsum(width)][np.r_[word, len(code)]], np.searchsorted(word, starts)

    @staticmethod
    def _contractions(code: np.ndarray, kind: np.ndarray, first: np.ndarray, begins: np.ndarray) -> None:
        """An apostrophe that starts a token takes one or two letters with it, and what follows starts anew."""
        mark = np.flatnonzero((code == ord("'")) & begins)
        mark = mark[~first[mark + 1]]
        one = mark[np.isin(code[mark + 1], [ord(c) for c in "stmd"])]
        two = mark[~first[np.minimum(mark + 2, len(code))]]
        a, b = code[two + 1], code[two + 2]
        two = two[((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))]
        begins[one + 1] = begins[two + 1] = begins[two + 2] = False
        after = np.concatenate([one + 2, two + 3])
        begins[after[after < len(code)]] = True


@cache
def _encoder(name: str) -> ByteEncoder:
    return ByteEncoder(name)


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def _check(plain: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(plain) & 0xFFFFFFFF


class TokenFileWriter:
    """Writes one file to ``out``, a frame at a time."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        from zstandard import ZstdCompressor

        self.out, self.frame_ids = out, frame_ids
        self.packer = ZstdCompressor(level=level, write_checksum=True)
        self.held: list[bytes] = []
        self.waiting = self.ids = self.bytes = 0
        self.frames: list[tuple[int, int, int]] = []
        self.documents: list[np.ndarray] = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def _frame(self, plain: bytes) -> None:
        packed = self.packer.compress(plain)
        self.frames.append((len(packed), len(plain), _check(plain)))
        self._put(packed)

    def _flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
            self.held, self.waiting = [], 0

    def add(self, doc_ids: list[int | None], ids: list[bytes]) -> None:
        """Documents in order, their ids as bytes."""
        sizes = np.fromiter((len(i) // 4 for i in ids), np.int64, len(ids))
        rows = np.zeros(len(ids), DOCUMENT)
        rows["doc_id"], rows["known"] = [0 if d is None else d for d in doc_ids], [d is not None for d in doc_ids]
        rows["place"] = self.ids + np.cumsum(sizes) - sizes
        self.documents.append(rows)
        self.ids += int(sizes.sum())
        for one, size in zip(ids, sizes.tolist()):
            if size > self.frame_ids:
                self._flush()
                for at in range(0, len(one), 4 * self.frame_ids):
                    self._frame(one[at : at + 4 * self.frame_ids])
                continue
            self.held.append(one)
            self.waiting += size
            if self.waiting >= self.frame_ids:
                self._flush()

    def close(self) -> None:
        self._flush()
        index = _skippable(SKIPPABLE, self.packer.compress(b"".join(r.tobytes() for r in self.documents)))
        self._put(index)
        self.frames.append((len(index), 0, _check(b"")))
        table = np.array(self.frames, ENTRY).tobytes()
        self._put(_skippable(SEEK_FRAME, table + struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEKABLE)))
        self.out.close()


class TokenFileReader:
    """Reads one file from ``source``, which can be read at any place. ``unpacked`` counts the frames decompressed."""

    def __init__(self, source, size: int):
        self.source, self.unpacked = source, 0
        entries, kind, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or kind != WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        body = entries * ENTRY.itemsize
        head = struct.unpack("<II", self._at(size - 17 - body, 8))
        if head != (SEEK_FRAME, body + 9):
            raise ValueError("the seek table does not fill its frame")
        self.entries = np.frombuffer(self._at(size - 9 - body, body), ENTRY)
        self.offset = np.r_[0, np.cumsum(self.entries["packed"], dtype=np.int64)]
        self.first = np.r_[0, np.cumsum(self.entries["plain"], dtype=np.int64)] // 4
        self.ids = int(self.first[-1])

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(int(start))
        data = self.source.read(int(size))
        if len(data) != size:
            raise ValueError("the file is shorter than its tables say")
        return bytes(data)

    def frame(self, number: int) -> bytes:
        from zstandard import ZstdDecompressor

        entry = self.entries[number]
        plain = ZstdDecompressor().decompress(self._at(self.offset[number], entry["packed"]), max_output_size=int(entry["plain"]))
        if len(plain) != entry["plain"] or _check(plain) != entry["check"]:
            raise ValueError(f"frame {number} does not have the checksum of the seek table")
        self.unpacked += 1
        return plain

    def documents(self) -> pd.DataFrame:
        """``doc_id``, ``place`` and ``n_tokens`` of every document, and the frame that its ids begin in."""
        from zstandard import ZstdDecompressor

        last = len(self.entries) - 1
        data = self._at(self.offset[last] + 8, self.entries["packed"][last] - 8)
        rows = np.frombuffer(ZstdDecompressor().decompress(data), DOCUMENT)
        place = rows["place"].astype(np.int64)
        frame = np.searchsorted(self.first[1:], place, side="right")
        ids = pd.array(np.where(rows["known"], rows["doc_id"], 0), "Int64")
        ids[~rows["known"]] = pd.NA
        return pd.DataFrame({"doc_id": ids, "place": place, "n_tokens": np.diff(place, append=self.ids), "frame": frame})

    def read(self, places: list[tuple[int, int, int]]) -> Iterator[bytes]:
        """The ids of documents (place, n_tokens, frame) in rising order; each frame that they need is decompressed once."""
        number, plain = -1, b""
        for place, size, frame in places:
            parts = []
            while size > 0:
                if frame != number:
                    number, plain = frame, self.frame(frame)
                at = 4 * (place - int(self.first[frame]))
                part = plain[at : at + 4 * size]
                parts.append(part)
                place, size, frame = place + len(part) // 4, size - len(part) // 4, frame + 1
            yield parts[0] if len(parts) == 1 else b"".join(parts)


def _opened(path: str) -> TokenFileReader:
    from pyarrow.fs import FileSystem

    files, name = FileSystem.from_uri(path)
    source = files.open_input_file(name)
    return TokenFileReader(source, source.size())


MANIFEST = "share int, path string, n_docs long, n_tokens long, n_frames long, n_bytes long, attempt long"


def write_token_files(docs: DataFrame, folder: str, text: str = "text", doc_id: str = "doc_id", tokenizer: str = TOKENIZER, end_id: int = END_ID, frame_ids: int = FRAME_IDS, files: int | None = None) -> DataFrame:
    """Writes ids of all texts below ``folder``, a path or URI that all executors reach, and gives the manifest.

    Files follow each other by ``doc_id``; the manifest says where the ids of each begin in the whole (``start``). Null and empty
    texts are the end id alone; rows that repeat an id stand in the order of their texts' hashes, null ids after all others.
    Other columns are left out. No rows make no files. ``files`` is the number of files; without it Spark deals rows by size.
    """
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        task, end, writer = TaskContext.get(), np.array([end_id], "<u4"), None
        path = f"{folder}/ids-{task.partitionId():06d}-{task.taskAttemptId()}.zst"
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                rows = batch.iloc[at : at + AT_ONCE]
                if writer is None:
                    store, name = FileSystem.from_uri(path)
                    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    writer = TokenFileWriter(store.open_output_stream(name, compression=None), frame_ids)
                    n_docs = 0
                found = _encoder(tokenizer).encode([t or "" for t in rows["text"]])
                known = [None if unknown else int(i) for i, unknown in zip(rows["id"], rows["unknown"])]
                writer.add(known, [np.concatenate([f, end]).astype("<u4").tobytes() for f in found])
                n_docs += len(rows)
        if writer is not None:
            writer.close()
            yield pd.DataFrame([(task.partitionId(), path, n_docs, writer.ids, len(writer.frames) - 1, writer.bytes, task.taskAttemptId())], columns=[c.split()[0] for c in MANIFEST.split(", ")])

    bounded_batches(docs.sparkSession)
    own, body = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    rows = docs.select(doc_order(own).alias("id"), own.isNull().alias("unknown"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("salt"), body.alias("text"))
    order = ["id", "unknown", "salt"]
    dealt = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    written = settle(dealt.sortWithinPartitions(*order).mapInPandas(write, MANIFEST), "token-files-written")
    # One row for each file, so the prefix sum over them is small work for one task.
    before = Window.orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    return settle(written.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "token-files")


FOUND = "doc_id long, start long, n_tokens long, ids binary"


def _by_file(manifest: DataFrame) -> DataFrame:
    """The files of a manifest, one to a task."""
    return manifest.repartitionByRange(max(1, manifest.count()), "share")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """All documents of the files: ``doc_id``, ``start`` in the whole, ``n_tokens`` and the ids as little-endian 32-bit numbers."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"].tolist()):
                reader = _opened(path)
                found = reader.documents()
                for at in range(0, len(found), AT_ONCE):
                    rows = found.iloc[at : at + AT_ONCE]
                    ids = list(reader.read(list(zip(*(rows[c].tolist() for c in ("place", "n_tokens", "frame"))))))
                    yield pd.DataFrame({"doc_id": rows["doc_id"].array, "start": rows["place"].array + start, "n_tokens": rows["n_tokens"].array, "ids": ids})

    return _by_file(manifest).select("path", "start").mapInPandas(read, FOUND)


def document_places(manifest: DataFrame) -> DataFrame:
    """Every document's file, place there, number of ids and first frame, from the files' tables alone."""

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"].tolist()):
                yield _opened(path).documents().assign(path=path, begins=start)

    return _by_file(manifest).select("path", "start").mapInPandas(places, "path string, begins long, doc_id long, place long, n_tokens long, frame long")


def read_documents(manifest: DataFrame, wanted: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents whose id is in ``wanted``, as ``read_token_files`` gives them; only frames that hold one are decompressed."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, reader = None, None
        for batch in batches:
            for own, rows in batch.groupby("path", sort=False):
                if own != path:
                    path, reader = own, _opened(own)
                for at in range(0, len(rows), AT_ONCE):
                    some = rows.iloc[at : at + AT_ONCE]
                    ids = list(reader.read(list(zip(*(some[c].tolist() for c in ("place", "n_tokens", "frame"))))))
                    yield pd.DataFrame({"doc_id": some["doc_id"].array, "start": some["begins"].array + some["place"].array, "n_tokens": some["n_tokens"].array, "ids": ids})

    asked = wanted.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id")).distinct()
    hits = document_places(manifest).join(asked, "doc_id")
    return hits.repartition("path", "frame").sortWithinPartitions("path", "place").mapInPandas(read, FOUND)


def op11_token_files(spark, sf_dir: str) -> DataFrame:
    manifest = write_token_files(documents(spark, sf_dir), scratch_path(spark, "token-files"))
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
