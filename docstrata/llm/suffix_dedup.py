"""Exact substring dedup: bytes of repeated passages go, but for the passage's first place.

A byte goes if some string of ``length`` bytes over it also starts earlier (in a document of smaller id, or before in the
same one). That is the longest-previous-factor array of all texts, asked at one length, and it is found where it matters:

1. Every window of ``length`` bytes chooses one of its ``GRAM``-byte grams by a hash, so equal windows choose alike. The
   windows in a row that choose one gram form a fragment of the text.
2. Fragments are dealt by their gram. Of equal fragments all but the first are copies as a whole. Grams whose
   fragments are all equal, nearly all of them, are done with that.
3. The rest, fragments that agree in part only, are put in suffix order by rank doubling; previous and next
   smaller positions in that order tell for each window whether it has an earlier match of the full length.

Grams known to be frequent are chosen last. A window that reaches over the edge of a passage shared by very many
documents then chooses a rare gram outside it, and windows within it make equal fragments, which each task
reduces to one before any data moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docstrata.llm.common import doc_order, documents, numbered, settle, whole_groups

LENGTH = 100
GRAM = 32
#: Bytes that are hashed at once; longer texts are taken in pieces that overlap by a window.
BLOCK = 1 << 20
PLACE_BITS = 24
#: Documents in which frequent grams are looked for, how often they must occur there, and how many are kept. They only
#: decide which gram a window chooses, never what is found.
SAMPLE, FREQUENT, MOST_FREQUENT = 2000, 4, 200_000
#: Fragments of one gram that are put in suffix order together; grams with more are compared window by window instead.
MOST_TOGETHER = 4_000
#: Bytes of fragments that are put in suffix order at once, if their grams are small enough.
TOGETHER = 1 << 20

COVERED, CANDIDATE = 1, 0


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(1 << 62, dtype=np.uint64)) * 2 + 1


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte, and powers of an odd base and of its inverse modulo 2^64."""
    values = np.random.default_rng(11).integers(1 << 63, size=256, dtype=np.uint64) * 2 + 1
    base = _odd(12)
    up, down = (np.full(BLOCK + 1, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
    up[0] = down[0] = 1
    return values, np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


class Hashed:
    """Hashes of all substrings of at most ``BLOCK`` bytes, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        values, up, self.down = _tables()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=self.sums[1:])

    def grams(self) -> np.ndarray:
        n = len(self.sums) - GRAM
        return _mixed((self.sums[GRAM:] - self.sums[:-GRAM]) * self.down[:n]) if n > 0 else np.empty(0, np.uint64)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = (end - start).astype(np.uint64)
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start] + size * np.uint64(0xD6E8FEB86659FD93))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


class Frequent:
    """Membership in a sorted set of grams, most tests answered by a small table."""

    def __init__(self, grams: np.ndarray):
        self.grams = np.sort(grams)
        self.table = np.zeros(1 << 20, bool)
        self.table[self._slot(self.grams)] = True

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(44)).astype(np.int64)

    def mark(self, grams: np.ndarray) -> np.ndarray:
        """Places of members."""
        if not len(self.grams):
            return np.empty(0, np.int64)
        maybe = np.flatnonzero(self.table[self._slot(grams)])
        at = np.minimum(np.searchsorted(self.grams, grams[maybe]), len(self.grams) - 1)
        return maybe[self.grams[at] == grams[maybe]]


def fragments(data: np.ndarray, ends: np.ndarray, frequent: Frequent, length: int) -> tuple[np.ndarray, ...]:
    """Gram, content hash, start and end of the fragments of texts laid end to end; no window crosses an end."""
    empty = (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    if len(data) < length:
        return empty
    hashed = Hashed(data)
    grams = hashed.grams()
    places = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = ((grams >> np.uint64(1)) & ~low) | places
    keys[frequent.mark(grams)] |= np.uint64(1 << 63)
    chosen = (_least(keys, length - GRAM + 1) & low).astype(np.int64)
    # Windows that reach over the end of their text are out.
    whole = np.ones(len(chosen), bool)
    for end in ends[:-1].tolist():
        whole[max(0, end - length + 1) : end] = False
    windows = np.flatnonzero(whole)
    if not len(windows):
        return empty
    own = chosen[windows]
    cut = np.flatnonzero((own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)) + 1
    first, last = np.r_[0, cut], np.r_[cut, len(windows)] - 1
    start, end = windows[first], windows[last] + length
    return grams[own[first]], hashed.ranges(start, end), start, end


def _blocks(rows: Iterator[tuple[int, bytes]], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts as (order, place, bytes), in lists of about ``BLOCK`` bytes; pieces of one text overlap by a window less one byte."""
    held, size, most = [], 0, BLOCK // 2
    for order, text in rows:
        for at in range(0, max(1, len(text) - length + 1), most - length + 1):
            piece = text[at : at + most]
            if len(piece) < length:
                continue
            if size + len(piece) > BLOCK:
                yield held
                held, size = [], 0
            held.append((order, at, piece))
            size += len(piece)
    if held:
        yield held


FOUND = "gram long, content long, ord long, start int, length int, kind int"


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _candidates(frequent, length: int):
    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((o, (t or "").encode()) for batch in batches for o, t in zip(batch["ord"].tolist(), batch["text"]))
        for block in _blocks(rows, length):
            sizes = np.array([len(piece) for _, _, piece in block])
            ends = np.cumsum(sizes)
            gram, content, start, end = fragments(np.frombuffer(b"".join(p for _, _, p in block), np.uint8), ends, frequent.value, length)
            text = np.searchsorted(ends, start, side="right")
            order = np.array([o for o, _, _ in block], np.int64)[text]
            place = start - (ends - sizes)[text] + np.array([at for _, at, _ in block])[text]
            by = np.lexsort((place, order, content, gram))
            same = np.r_[False, (gram[by][1:] == gram[by][:-1]) & (content[by][1:] == content[by][:-1])]
            gram = _signed(gram).copy()
            gram[by[same]] = order[by[same]] * 31 + place[by[same]]  # copies are done; spread them
            kind = np.zeros(len(by), np.int32)
            kind[by[same]] = COVERED
            yield pd.DataFrame({"gram": gram, "content": _signed(content), "ord": order, "start": place.astype(np.int32), "length": (end - start).astype(np.int32), "kind": kind})

    return candidates


def _by_gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From rows sorted by gram, content, order and place: copies as covered, and grams with several contents as candidates.

    Only the first fragment of the gram at hand is held over from batch to batch.
    """
    first, gram_at_end, content_at_end, several = None, None, None, False
    for batch in batches:
        kind = batch["kind"].to_numpy()
        place = np.flatnonzero(kind == CANDIDATE)
        keep = kind == COVERED
        if len(place):
            gram, text = batch["gram"].to_numpy()[place], batch["content"].to_numpy()[place]
            goes_on = gram_at_end is not None and gram[0] == gram_at_end
            new = np.r_[not goes_on, gram[1:] != gram[:-1]]
            fresh = new | np.r_[text[0] != content_at_end if goes_on else True, text[1:] != text[:-1]]
            group = np.cumsum(new) - new[0]
            mixed = np.zeros(group[-1] + 1, bool)
            mixed[group[fresh & ~new]] = True
            if goes_on and mixed[0] and not several:
                yield first  # only now it is known that the gram has another content
            if goes_on:
                mixed[0] |= several
            kind = kind.copy()
            kind[place[~fresh]] = COVERED
            keep[place[~fresh]] = True
            keep[place[fresh & mixed[group]]] = True
            start = int(np.flatnonzero(group == group[-1])[0])
            if new[start]:
                first = batch.iloc[place[start] : place[start] + 1]
            gram_at_end, content_at_end, several = gram[-1], text[-1], bool(mixed[group[-1]])
        if keep.any():
            yield batch[keep].assign(kind=kind[keep])


def ranks(data: np.ndarray, length: int) -> np.ndarray:
    """For every place the rank of the ``length`` bytes from there, in the order of suffixes; equal strings rank alike."""
    n, done = len(data), min(7, length)
    padded = np.zeros(n + 2 * length, np.int64)
    padded[:n] = data
    rank = np.zeros(n + length, np.int64)
    for j in range(done):
        rank = (rank << 8) | padded[j : j + n + length]
    _, rank = np.unique(rank, return_inverse=True)
    while done < length:
        step = min(done, length - done)
        ahead = np.zeros(len(rank), np.int64)
        ahead[: len(rank) - step] = rank[step:]
        _, rank = np.unique(rank * (int(rank.max()) + 1) + ahead, return_inverse=True)
        done += step
    return rank[:n]


def smaller_before(values: np.ndarray, block: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it in its block with a smaller value, or -1; all chains jump at once."""
    near = np.arange(-1, len(values) - 1)
    near[np.r_[True, block[1:] != block[:-1]]] = -1
    open_ = np.flatnonzero(near >= 0)
    while len(open_):
        open_ = open_[values[near[open_]] >= values[open_]]
        near[open_] = near[near[open_]]
        open_ = open_[near[open_] >= 0]
    return near


def matched_earlier(data: np.ndarray, places: np.ndarray, position: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows at ``places`` have a longest previous factor of ``length`` or more, by ``position``."""
    rank = ranks(data, length)[places]
    order = np.argsort(rank, kind="stable")
    block, value = rank[order], position[order]
    before = smaller_before(value, block) >= 0
    after = smaller_before(value[::-1], block[::-1])[::-1] >= 0
    out = np.zeros(len(places), bool)
    out[order] = before | after
    return out


def _suffix_order(length: int):
    def covered(group: pd.DataFrame) -> pd.DataFrame:
        texts = group["bytes"].to_list()
        sizes = np.array([len(t) for t in texts])
        begin = np.cumsum(sizes) - sizes
        windows = sizes - length + 1
        row = np.repeat(np.arange(len(texts)), windows)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        order, place = group["ord"].to_numpy()[row], group["start"].to_numpy(np.int64)[row] + offset
        by = np.lexsort((place, order))
        position = np.empty(len(by), np.int64)
        position[by] = np.cumsum(np.r_[False, (order[by][1:] != order[by][:-1]) | (place[by][1:] != place[by][:-1])])
        hit = np.flatnonzero(matched_earlier(np.frombuffer(b"".join(texts), np.uint8), begin[row] + offset, position, length))
        if not len(hit):
            return pd.DataFrame({"ord": [], "start": [], "length": []})
        cut = np.flatnonzero((np.diff(hit) != 1) | (row[hit][1:] != row[hit][:-1])) + 1
        first, last = hit[np.r_[0, cut]], hit[np.r_[cut, len(hit)] - 1]
        return pd.DataFrame({"ord": order[first], "start": place[first], "length": last - first + length})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for group in whole_groups(batches, ["gram"]):
            held.append(group)
            size += int(group["bytes"].map(len).sum())
            if size >= TOGETHER:
                yield covered(pd.concat(held))
                held, size = [], 0
        if held:
            yield covered(pd.concat(held))

    return run


def _sampled_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for text in batch["text"]:
            data = np.frombuffer((text or "").encode(), np.uint8)
            pieces = [Hashed(data[at : at + BLOCK]).grams() for at in range(0, len(data), BLOCK - GRAM + 1)]
            if pieces:
                yield pd.DataFrame({"gram": _signed(np.unique(np.concatenate(pieces)))})


def _frequent(texts: DataFrame) -> np.ndarray:
    chosen = texts.select("ord").orderBy(F.xxhash64("ord"), "ord").limit(SAMPLE)
    sample = texts.join(F.broadcast(chosen), "ord").select("text")  # SAMPLE ids
    counts = sample.mapInPandas(_sampled_grams, "gram long").groupBy("gram").agg(F.count("*").alias("n"))
    found = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "gram").limit(MOST_FREQUENT).select("gram").toPandas()
    return found["gram"].to_numpy(np.int64).view(np.uint64)


def _window_by_window(heavy: DataFrame, length: int) -> DataFrame:
    """Covered windows of grams with too many different fragments for one task: the least place of every string, by its digest."""
    places = F.transform(F.sequence(F.lit(0), F.length("bytes") - length), lambda i: F.struct((F.col("start") + i).alias("at"), F.md5(F.substring(F.col("bytes"), i + 1, F.lit(length))).alias("digest")))
    windows = settle(heavy.select("ord", F.inline(places)), "windows")
    first = settle(windows.groupBy("digest").agg(F.min(F.struct("ord", "at")).alias("first")), "first-windows")
    later = windows.join(first, "digest").where(F.struct("ord", "at") > F.col("first"))
    return later.select("ord", F.col("at").alias("start"), F.lit(length).alias("length"))


def stacked(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``ord``, ``doc_id`` and ``text``, where ``ord`` is unique and in the order of the documents.

    Distinct ids are the order themselves, and nothing is written. Else rows are numbered by id, nulls last and equal ids
    by text, and the numbered texts written.
    """
    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    repeated = plain.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count()
    if not repeated:
        return plain.withColumn("ord", F.col("doc_id"))
    rows = settle(numbered(plain, "row"), "numbered-texts")
    ranged = rows.select("row", doc_order(F.col("doc_id")).alias("id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sum")).orderBy("id", "sum", "row")
    # Numbers made by a range sort rise with the order: the part number is in the high bits, the row in the low ones.
    order = settle(ranged.select("row", F.monotonically_increasing_id().alias("ord")), "text-order")
    return settle(rows.join(order, "row").select("doc_id", "text", "ord"), "ordered-texts")


def covered_ranges(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Byte ranges ``ord, start, length`` of ``texts (ord, text)`` whose every window of ``length`` bytes starts earlier, too."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} at least")
    frequent = texts.sparkSession.sparkContext.broadcast(Frequent(_frequent(texts)))  # MOST_FREQUENT numbers
    keys = ["gram", "content", "ord", "start"]
    dealt = texts.select("ord", "text").mapInPandas(_candidates(frequent, length), FOUND).repartition("gram").sortWithinPartitions(*keys)
    found = settle(dealt.mapInPandas(_by_gram, FOUND), "fragments")
    asked = found.where(F.col("kind") == CANDIDATE)
    crowded = settle(asked.groupBy("gram").count().where(F.col("count") > MOST_TOGETHER).select("gram", F.lit(True).alias("heavy")), "crowded-grams")
    by_text = asked.join(crowded, "gram", "left").groupBy("ord").agg(F.collect_list(F.struct("gram", "start", "length", "heavy")).alias("asked"))
    cut = F.transform("asked", lambda a: F.struct(a["gram"].alias("gram"), a["heavy"].alias("heavy"), a["start"].alias("start"), F.substring(F.col("data"), a["start"] + 1, a["length"]).alias("bytes")))
    pieces = texts.select("ord", F.col("text").cast("binary").alias("data")).join(by_text, "ord").select("ord", F.inline(cut))
    pieces = settle(pieces, "fragment-bytes")
    light = pieces.where("heavy IS NULL").select("gram", "ord", "start", "bytes").repartition("gram").sortWithinPartitions("gram")
    ranges = [
        found.where(F.col("kind") == COVERED).select("ord", "start", "length"),
        light.mapInPandas(_suffix_order(length), "ord long, start int, length int"),
        _window_by_window(pieces.where("heavy"), length),
    ]
    return ranges[0].unionByName(ranges[1]).unionByName(ranges[2])


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, ranges in zip(batch["text"], batch["ranges"]):
            data, out, at, removed, spans = (text or "").encode(), [], 0, 0, 0
            reached = -1
            for r in sorted((r["start"], r["start"] + r["length"]) for r in ranges) if ranges is not None else ():
                if r[0] > reached:
                    spans += 1
                    out.append(data[at : r[0]])
                    removed += r[1] - r[0]
                    at = reached = r[1]
                elif r[1] > reached:
                    removed += r[1] - reached
                    at = reached = r[1]
            kept = b"".join([*out, data[at:]])
            rows.append((len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]).assign(doc_id=batch["doc_id"].array)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """One row per document: sizes, the digest of what is kept, and the kept bytes (a cut may fall within a character).

    Null texts are empty, and texts shorter than ``length`` stay whole. Rows of one id are documents of their own, in
    the order of their texts; null ids come last. Other columns are left out.
    """
    texts = stacked(docs, text, doc_id)
    ranges = covered_ranges(texts, length).groupBy("ord").agg(F.collect_list(F.struct("start", "length")).alias("ranges"))
    joined = texts.join(ranges, "ord", "left").select("doc_id", "text", "ranges")
    return joined.mapInPandas(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op4_previous_factors(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("kept")
