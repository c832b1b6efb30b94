"""SimHash near-duplicates by embedding fingerprints into bit counts.

A fingerprint of 64 bits is cut into 32 segments of two bits, and each segment replaced by how many of its bits are
set. The Manhattan distance of two such vectors is never more than the Hamming distance of the fingerprints. Fingerprints
that differ in at most three bits differ in at most one in one of their halves, so in one half their vectors of
16 counts stand in the same or in neighbouring cells of the unit grid. The join by cells finds these pairs; the
distance of the whole vectors sorts most others out, and the fingerprints themselves decide.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docstrata.llm.common import LAST_ID, doc_order, documents, free_name, numbered, settle, with_result
from docstrata.llm.components import components

SEED = 42
SHINGLE = 3
MOST_BITS = 3
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16

COUNTS, FIELDS = 0x5555555555555555, 16
HALF = (1 << 32) - 1


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a text's word shingles, repeats included; 0 without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    shingles = map(b" ".join, zip(*(words[i : i + n] for i in range(size)))) if len(words) >= size else iter([b" ".join(words)])
    set_bits = np.zeros(64, np.int64)
    while block := list(islice(shingles, BLOCK)):
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in block), np.uint64, len(block))
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.int64)[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def with_fingerprint(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a column of fingerprints, and its name. Null and empty texts have fingerprint 0."""
    return with_result(docs, text, _fingerprints, "long", "fingerprint")


def _bit_counts(fp: Column) -> Column:
    """Each pair of bits replaced by its count."""
    low, high = fp.bitwiseAND(F.lit(COUNTS)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(COUNTS))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _manhattan(a: Column, b: Column) -> Column:
    """Of two words of two-bit counts: fields differ by 2 where only the high bits do, else by 1."""
    x = a.bitwiseXOR(b)
    twos = F.shiftrightunsigned(x, 1).bitwiseAND(F.bitwise_not(x)).bitwiseAND(F.lit(COUNTS))
    return F.bit_count(x.bitwiseAND(F.lit(COUNTS))) + 2 * F.bit_count(twos)


def _cells(fps: DataFrame) -> DataFrame:
    """Two rows per fingerprint: the cell that the counts of either half stand in."""
    halves = F.array(
        F.struct(F.lit(0).alias("half"), F.col("counts").bitwiseAND(F.lit(HALF)).alias("at")),
        F.struct(F.lit(1).alias("half"), F.shiftrightunsigned(F.col("counts"), 32).alias("at")),
    )
    return fps.select("fp", "counts", F.inline(halves))


def _reached(cells: DataFrame) -> DataFrame:
    """The own cell, and from cells with an even sum all that differ by one: of two neighbours just one is even."""
    up = F.expr(f"transform(filter(sequence(0, {FIELDS - 1}), i -> ((at >> (2 * i)) & 3L) < 2), i -> at + (1L << (2 * i)))")
    down = F.expr(f"transform(filter(sequence(0, {FIELDS - 1}), i -> ((at >> (2 * i)) & 3L) > 0), i -> at - (1L << (2 * i)))")
    even = F.expr(f"(bit_count(at & {COUNTS}L) + 2 * bit_count((at >> 1) & {COUNTS}L)) % 2 = 0")
    cells_of = F.when(even, F.concat(F.array("at"), up, down)).otherwise(F.array("at"))
    return cells.select(F.col("fp").alias("other"), F.col("counts").alias("other_counts"), "half", F.explode(cells_of).alias("at"))


def near_pairs(fps: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """Pairs ``u, v`` of the distinct fingerprints ``fp`` that differ in one to ``most`` (three at most) bits.

    A fingerprint has at most 43,744 others within three bits, so no group of copies makes more pairs than that for each.
    """
    if not 0 <= most <= MOST_BITS:
        raise ValueError(f"most must be 0 to {MOST_BITS}")
    cells = settle(_cells(fps.select("fp", _bit_counts(F.col("fp")).alias("counts"))), "cells")
    near = (
        (_manhattan(F.col("counts"), F.col("other_counts")) <= most)
        & (F.col("fp") != F.col("other"))
        & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= most)
    )
    return cells.join(_reached(cells), ["half", "at"]).where(near).select(F.greatest("fp", "other").alias("u"), F.least("fp", "other").alias("v"))


def classes(rows: DataFrame, first: Column) -> DataFrame:
    """For every fingerprint of ``rows (fp, ...)`` the least ``first`` of any row that it reaches by links."""
    own = settle(rows.groupBy("fp").agg(F.min(first).alias("least")), "fingerprints")
    linked = components(near_pairs(own))
    root = F.coalesce("root", "fp")
    rooted = settle(own.join(linked, own["fp"] == linked["node"], "left").select("fp", "least", root.alias("root")), "rooted")
    least = settle(rooted.groupBy("root").agg(F.min("least").alias("first")), "least")
    return settle(rooted.join(least, "root").select("fp", "first"), "classes")


def simhash_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id``, one row for each row of ``docs``.

    Null and empty texts share fingerprint 0 and link with each other and with what is near it. Null ids come after all
    others: a component of such rows only has a null id. Repeated rows each get a row. Other columns are left out.
    """
    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found, name = with_fingerprint(plain)
    rows = settle(found.select("doc_id", F.col(name).alias("fp")), "doc-fingerprints")
    joined = rows.join(classes(rows, doc_order(F.col("doc_id"))), "fp")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.nullif("first", F.lit(LAST_ID)).alias("component_id"))


def without_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The row with the smallest id of every component, all its columns as they were.

    Of rows that repeat an id one stays. Columns may have any names.
    """
    row, kept = free_name(docs.columns, "row_"), docs.columns
    found, fp = with_fingerprint(docs, text)
    stored = settle(numbered(found, row), "numbered-docs")
    keys = stored.select(F.col(row).alias("row"), F.col(fp).alias("fp"), F.struct(doc_order(F.col(f"`{doc_id}`")).alias("id"), F.col(row).alias("row")).alias("me"))
    gone = settle(keys.join(classes(keys, F.col("me")), "fp").where("me <> first").select(F.col("row").alias(row)), "near-copies")
    return stored.join(gone, row, "left_anti").select(*(f"`{c}`" for c in kept))


def op5_popcount_grid(spark, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))
