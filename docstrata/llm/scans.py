"""Running totals within groups of any size, without one task for a group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from docstrata.llm.common import settle


def _segmented(values: np.ndarray, starts: np.ndarray, segment: np.ndarray, xor: bool) -> np.ndarray:
    run = (np.bitwise_xor if xor else np.add).accumulate(values)
    before = np.r_[0, run][starts][segment]
    return run ^ before if xor else run - before


def scanned(rows: DataFrame, group: str, order: list[str], sums: tuple[str, ...] = (), xors: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with ``<name>_run`` for each of the named long columns: its sum (or exclusive or) over the group up to the row.

    Rows are dealt by ranges of (group, order), so a large group lies in several tasks. Each runs over its share; what a group
    brings into the next share comes from one row per share. ``group`` must not be null, and ``order`` should name each row of a group.
    """
    names = [*sums, *xors]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        share, now, reached, held, first = TaskContext.get().partitionId(), None, {}, None, True
        for batch in batches:
            if not len(batch):
                continue
            if held is not None:
                yield held
            key = batch[group].to_numpy()
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            segment = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(key)))
            out = batch.assign(share=share, is_first=False, is_last=False)
            for name in names:
                found = _segmented(batch[name].to_numpy(np.int64), starts, segment, name in xors)
                if now is not None and now == key[0]:
                    found[segment == 0] = found[segment == 0] ^ reached[name] if name in xors else found[segment == 0] + reached[name]
                out[f"{name}_run"], reached[name] = found, found[-1]
            if first:
                out.iloc[0, out.columns.get_loc("is_first")], first = True, False
            now = key[-1]
            yield out.iloc[:-1]
            held = out.iloc[-1:]
        if held is not None:
            yield held.assign(is_last=True)

    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    extra = ", ".join(["share int", "is_first boolean", "is_last boolean", *(f"`{n}_run` long" for n in names)])
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # The result's columns stand in the order of the schema, whatever the order of assignment.
    columns = [*rows.columns, "share", "is_first", "is_last", *(f"{n}_run" for n in names)]

    def ordered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in run(batches):
            yield part[columns]

    table = settle(dealt.mapInPandas(ordered, f"{kinds}, {extra}"), "scan")
    # From here on one row for each share.
    ends = table.where("is_last").select("share", F.col(group).alias("g"), *(f"{n}_run" for n in names))
    upto = Window.partitionBy("g").orderBy("share")
    total = [(F.bit_xor if n in xors else F.sum)(f"{n}_run").over(upto).alias(f"{n}_carry") for n in names]
    numbered = ends.select("share", "g", F.row_number().over(Window.orderBy("share")).alias("place"), *total)
    begins = table.where("is_first").select("share", F.col(group).alias("g"))
    places = begins.join(numbered.select("share", "place"), "share").select("share", "g", (F.col("place") - 1).alias("place"))
    carry = settle(places.join(numbered.drop("share"), ["g", "place"]).select("share", F.col("g").alias(group), *(f"{n}_carry" for n in names)), "scan-carry")
    joined = table.drop("is_first", "is_last").join(carry, ["share", group], "left")
    carried = [F.coalesce(f"{n}_carry", F.lit(0)) for n in names]
    runs = [(F.col(f"{n}_run").bitwiseXOR(c) if n in xors else F.col(f"{n}_run") + c).alias(f"{n}_run") for n, c in zip(names, carried)]
    return joined.select(*rows.columns, *runs)
