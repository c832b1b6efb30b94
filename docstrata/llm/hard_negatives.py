"""Hard negatives of anchors, exact, with scores bounded along a spanning tree of the anchors.

Anchors lie in blocks of bounded size; each block has a minimal spanning tree. The score of a child differs from its
parent's by at most the length of the edge times the candidate's norm, so bounds go down the tree, and only candidates whose bounds
reach what an anchor still looks for are scored anew. Candidates come past an anchor block in batches: every row meets every
block of anchors (a stated set of queries against all rows), in cells of one block and one group of rows, and each cell keeps
the few best rows for each anchor. One pass finds the positives, a second one the negatives inside the window that each positive opens.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from docstrata.llm.common import bounded_batches, numbered, settle, whole_groups
from docstrata.llm.scans import scanned

#: Every so many ids one is an anchor; positives of an anchor, and negatives of a positive.
EVERY, POSITIVES, NEGATIVES = 100, 5, 10
#: Percent of a positive's score that its negatives reach at least and at most.
LOWEST, HIGHEST = 30, 90
#: Labels, and which ids have the next one.
LABELS, SHIFTED = 10, 7
SCALE = 256
#: Anchors in a block, and rows of a group at most.
ANCHORS, GROUP = 1024, 1 << 18
#: Share of a batch beyond which an anchor scores all of it.
DENSE = 0.1
#: Bounds are widened by this share, more than rounding can take off.
SLACK = 1 + 1e-9


def quantised(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Rows that take part: ``row`` (a number of its own), ``id``, ``label``, ``dim``, ``vec`` (64-bit numbers) and ``norm``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                exact = np.floor(SCALE * np.stack(rows["vector"].to_list()).astype(np.float64).reshape(len(rows), dim))
                norm = np.sqrt((exact * exact).sum(axis=1))
                if norm.size and norm.max() >= 2**31:
                    raise OverflowError("vectors too long for scores of 64 bits")
                vec = [v.tobytes() for v in exact.astype("<i8")]
                yield pd.DataFrame({"row": rows["row"].array, "id": rows["id"].array, "label": rows["label"].array, "dim": dim, "vec": vec, "norm": norm})

    numbers, own = F.col(f"`{vector}`").cast("array<double>"), F.col(f"`{vec_id}`").cast("long")
    valid = own.isNotNull() & F.col(f"`{label}`").isNotNull() & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    plain = F.col(f"`{label}`").cast("long")
    shifted = F.when(own % SHIFTED == 0, (plain + 1) % LABELS).otherwise(plain)
    rows = numbered(table.where(valid).select(own.alias("id"), shifted.alias("label"), F.size(numbers).alias("dim"), numbers.alias("vector")), "row")
    bounded_batches(table.sparkSession)
    return settle(rows.mapInPandas(cut, "row long, id long, label long, dim int, vec binary, norm double"), "quantised")


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the vectors with parents before children, each one's parent in that order (-1 for the first) and the edge's length.

    Within the order, vectors of the same depth follow each other.
    """
    n = len(vectors)
    parent, edge, depth = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n, np.int64)
    left, at = np.ones(n, bool), 0
    edge[0], parent[0] = 0, -1
    for _ in range(n):
        left[at] = False
        away = np.sqrt(((vectors - vectors[at]) ** 2).sum(axis=1))
        near = left & (away < edge)
        edge[near], parent[near], depth[near] = away[near], at, depth[at] + 1
        if left.any():
            at = int(np.argmin(np.where(left, edge, np.inf)))
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    parent = np.where(parent[order] < 0, -1, place[parent[order]])
    return order, parent, edge[order]


def _vectors(column: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i8").reshape(len(column), dim).astype(np.float64)


ANCHOR = "row long, id long, label long, dim int, vec binary, norm double, block int, pos int, parent int, edge double"


def _grown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in whole_groups(batches, ["dim", "block"]):
        order, parent, edge = spanning_tree(_vectors(rows["vec"], int(rows["dim"].iat[0])))
        yield rows.iloc[order].assign(pos=np.arange(len(rows), dtype=np.int32), parent=parent.astype(np.int32), edge=edge)


def anchor_blocks(rows: DataFrame) -> DataFrame:
    """Anchors in blocks of one length of vectors, ``block`` rising from 0 within each, with their trees."""
    own = rows.where(F.col("id") % EVERY == 0)
    # Neighbours in the order of the signs of their parts lie near each other, which makes short edges.
    start = F.substring("vec", 1, 8 * 16)
    signs = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.when(F.hex(F.substring(start, 8 * k + 8, 1)) >= "80", "-").otherwise("+")), "")
    counted = scanned(own.withColumns({"signs": signs, "one": F.lit(1).cast("long")}), "dim", ["signs", "id"], sums=("one",))
    placed = counted.select("row", "id", "label", "dim", "vec", "norm", F.floor((F.col("one_run") - 1) / F.lit(ANCHORS)).cast("int").alias("block"))
    dealt = placed.repartition("dim", "block").sortWithinPartitions("dim", "block", "id", "row")
    return settle(dealt.mapInPandas(_grown, ANCHOR), "anchors")


class Anchors:
    """A block of anchors that candidates pass, and the best rows met so far for each key."""

    def __init__(self, rows: pd.DataFrame, best: int):
        self.dim, self.best = int(rows["dim"].iat[0]), best
        self.vec = _vectors(rows["vec"], self.dim)
        self.most = float(np.abs(self.vec).max(initial=0))
        self.parent, self.edge = rows["parent"].to_numpy(np.int64), rows["edge"].to_numpy() * SLACK
        self.row, self.label = rows["row"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        depth = np.zeros(len(rows), np.int64)
        for i, p in enumerate(self.parent.tolist()):
            depth[i] = depth[p] + 1 if p >= 0 else 0
        self.levels = np.r_[0, np.flatnonzero(np.diff(depth)) + 1, len(rows)]
        self.scored = self.passed = 0
        self.found = np.empty((0, 4), np.int64)

    def scores(self, vec: np.ndarray, norm: np.ndarray, wanted: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all anchors and candidates, and which of them are exact: all that ``wanted`` (of rows, lower and upper bounds) asks for."""
        whole = self.most * float(np.abs(vec).max(initial=0)) * max(1, self.dim) < 2**53
        low, high = np.empty((2, len(self.vec), len(vec)))
        for a, b in zip(self.levels[:-1], self.levels[1:]):
            parent = self.parent[a:b]
            if parent[0] < 0:
                need = np.ones((b - a, len(vec)), bool)
            else:
                spread = self.edge[a:b, None] * norm
                low[a:b], high[a:b] = low[parent] - spread, high[parent] + spread
                need = wanted(slice(a, b), low[a:b], high[a:b])
            full = np.flatnonzero(need.mean(axis=1) > DENSE)
            low[a + full] = high[a + full] = self.product(self.vec[a + full], vec, whole)
            need[full] = False
            r, c = np.nonzero(need)
            if len(r):
                low[a + r, c] = high[a + r, c] = np.einsum("ij,ij->i", self.vec[a + r], vec[c]) if whole else np.array([self.product(self.vec[a + i : a + i + 1], vec[j : j + 1], False)[0, 0] for i, j in zip(r, c)])
            self.scored += len(r) + len(full) * len(vec)
        self.passed += low.size
        return low, low == high

    @staticmethod
    def product(a: np.ndarray, b: np.ndarray, whole: bool) -> np.ndarray:
        return a @ b.T if whole else (a.astype(np.int64) @ b.astype(np.int64).T)

    def keep(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Keep the best of what is held and what is new, for each key: higher scores, then smaller ids."""
        every = np.concatenate([self.found, np.stack([key, score.astype(np.int64), ids, rows], axis=1)])
        every = every[np.lexsort((every[:, 3], every[:, 2], -every[:, 1], every[:, 0]))]
        starts = np.flatnonzero(np.diff(every[:, 0], prepend=-1))
        nth = np.arange(len(every)) - np.repeat(starts, np.diff(starts, append=len(every)))
        self.found = every[nth < self.best]

    def least(self, keys: int) -> np.ndarray:
        """What a row must reach to be kept, for each key."""
        out = np.full(keys, -np.inf)
        n = np.bincount(self.found[:, 0], minlength=keys)
        full = np.flatnonzero(n == self.best)
        out[full] = self.found[np.cumsum(n)[full] - 1, 1]
        return out


class PositiveSearch(Anchors):
    def __init__(self, rows: pd.DataFrame):
        super().__init__(rows, POSITIVES)

    def add(self, rows: pd.DataFrame) -> None:
        vec, own = _vectors(rows["vec"], self.dim), rows["row"].to_numpy(np.int64)
        may = (self.label[:, None] == rows["label"].to_numpy(np.int64)) & (self.row[:, None] != own)
        least = self.least(len(self.row))[:, None]
        score, exact = self.scores(vec, rows["norm"].to_numpy(), lambda at, low, high: may[at] & (high >= least[at]))
        a, c = np.nonzero(exact & may & (score >= least))
        self.keep(a, score[a, c], rows["id"].to_numpy(np.int64)[c], own[c])

    def result(self) -> pd.DataFrame:
        key, score, ids, rows = self.found.T
        return pd.DataFrame({"anchor": self.row[key], "nth": np.zeros(len(key), np.int32), "score": score, "id": ids, "row": rows})


class NegativeSearch(Anchors):
    def __init__(self, rows: pd.DataFrame):
        super().__init__(rows, NEGATIVES)
        self.low, self.high = np.full((2, len(rows), POSITIVES), np.nan)
        for i, scores in enumerate(rows["scores"]):
            for j, score in enumerate([] if scores is None else map(int, scores)):
                self.low[i, j], self.high[i, j] = -(-LOWEST * score // 100), HIGHEST * score // 100

    def add(self, rows: pd.DataFrame) -> None:
        vec, own, ids = _vectors(rows["vec"], self.dim), rows["row"].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
        may = self.label[:, None] != rows["label"].to_numpy(np.int64)
        floor = np.fmax(self.low, self.least(self.low.size).reshape(self.low.shape))
        floor[np.isnan(self.low)] = np.nan

        def wanted(at: slice, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            out = np.zeros(low.shape, bool)
            for j in range(POSITIVES):
                out |= (high >= floor[at, j, None]) & (low <= self.high[at, j, None])
            return out & may[at]

        score, exact = self.scores(vec, rows["norm"].to_numpy(), wanted)
        exact &= may
        for j in range(POSITIVES):
            a, c = np.nonzero(exact & (score >= floor[:, j, None]) & (score <= self.high[:, j, None]))
            if len(a):
                self.keep(a * POSITIVES + j, score[a, c], ids[c], own[c])

    def result(self) -> pd.DataFrame:
        key, score, ids, rows = self.found.T
        return pd.DataFrame({"anchor": self.row[key // POSITIVES], "nth": (key % POSITIVES).astype(np.int32), "score": score, "id": ids, "row": rows})


def _searched(search: type[Anchors]):
    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, waiting, open_ = None, [], None
        for batch in batches:
            cells = batch[["dim", "block", "group", "kind"]].to_numpy(np.int64)
            cuts = [0, *(np.flatnonzero((np.diff(cells, axis=0) != 0).any(axis=1)) + 1).tolist(), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                own, rows = tuple(cells[a, :3].tolist()), batch.iloc[a:b]
                if own != cell:
                    if open_ is not None:
                        yield open_.result()
                    cell, waiting, open_ = own, [], None
                if cells[a, 3] == 0:
                    waiting.append(rows)
                    continue
                if open_ is None:
                    open_ = search(pd.concat(waiting).sort_values("pos"))
                open_.add(rows)
        if open_ is not None:
            yield open_.result()

    return searched


FOUND = "anchor long, nth int, score long, id long, row long"


def _best_of_cells(anchors: DataFrame, rows: DataFrame, search: type[Anchors], best: int) -> DataFrame:
    """The best ``best`` rows for each anchor and ``nth``, with their ``place`` from 1."""
    spark = rows.sparkSession
    blocks = settle(anchors.groupBy("dim").agg((F.max("block") + 1).alias("blocks")), "blocks-of-dims")
    n_blocks, n_rows = blocks.agg(F.max("blocks")).first()[0] or 1, rows.count()
    groups = max(1, math.ceil(2 * spark.sparkContext.defaultParallelism / n_blocks), math.ceil(n_rows / GROUP))
    spread: Column = F.sequence(F.lit(0), F.lit(groups - 1))
    with_scores = anchors if "scores" in anchors.columns else anchors.withColumn("scores", F.lit(None).cast("array<long>"))
    cell = ["dim", "block", "group", "kind"]
    columns = [*cell, "pos", "parent", "edge", "scores", "row", "id", "label", "vec", "norm"]
    left = with_scores.withColumn("kind", F.lit(0)).withColumn("group", F.explode(spread)).select(*columns)
    # One row for each length of vectors, so the join's right side is small.
    met = rows.join(blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = met.select(
        "dim", "block", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"), F.lit(1).alias("kind"),
        F.lit(0).alias("pos"), F.lit(0).alias("parent"), F.lit(0.0).alias("edge"), F.lit(None).cast("array<long>").alias("scores"),
        "row", "id", "label", "vec", "norm",
    )
    dealt = left.unionByName(right).repartition("dim", "block", "group").sortWithinPartitions("dim", "block", "group", "kind", "pos")
    found = settle(dealt.mapInPandas(_searched(search), FOUND), "best-of-cells")
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id", "row")
    return settle(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= best), "best")


def hard_negatives(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``, exact.

    Rows without id or label, without a vector or with a null or not finite part take no part; vectors of another length than
    an anchor's are not compared with it. Rows that repeat an id are rows of their own, each an anchor if the id is one; ties
    go to the smaller id. Anchors without positives, and positives without negatives, have no row. A vector of a norm of 2**31 or more
    after scaling stops the job, since its scores need more than 64 bits.
    """
    rows = quantised(table, vec_id, vector, label)
    anchors = anchor_blocks(rows)
    positives = _best_of_cells(anchors, rows, PositiveSearch, POSITIVES).select(F.col("anchor"), (F.col("place") - 1).cast("int").alias("nth"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    # Five scores for each anchor at most.
    scores = positives.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "positive_score"))), lambda s: s["positive_score"]).alias("scores"))
    armed = settle(anchors.join(scores.withColumnRenamed("anchor", "row"), "row"), "anchors-with-positives")
    negatives = _best_of_cells(armed, rows, NegativeSearch, NEGATIVES)
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    joined = negatives.join(positives, ["anchor", "nth"]).join(names, "anchor")
    return joined.select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
