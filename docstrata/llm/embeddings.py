"""Embedding near-duplicates by spherical-cap filters.

Directions are structured: each half of the dimensions has a book of random unit vectors, and every pair of one vector
from either book is a filter. A vector's product with a filter is the sum of two products, so all filters beyond a
threshold are decoded from two short lists without going through the product of the books. Vectors that pass a common
filter are compared in double precision. The threshold is the one at which a sample's vectors pass ``PASSED``
filters on average; the books grow with the number of vectors, so that a filter keeps about ``PER_FILTER`` of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docstrata.llm.common import LAST_ID, doc_order, numbered, settle, whole_groups
from docstrata.llm.components import components

COSINE = 0.95
#: Filters a vector passes on average, and at least: its best ones where fewer reach the threshold.
PASSED, LEAST_PASSED = 24, 6
PER_FILTER = 64
SMALLEST_BOOK = 32
#: Vectors whose products set the threshold; all vectors are indexed.
SAMPLE = 4096
#: Rows of a filter that are compared at once; a filter with more is cut into blocks, every two of which meet.
BLOCK = 1024
SEED = 20_240_601


@lru_cache(maxsize=8)
def books(dim: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two books of unit vectors, one for either half of the dimensions; the same wherever they are made."""
    rng = np.random.default_rng([SEED, dim, size])
    drawn = (rng.standard_normal((size, d)) for d in ((dim + 1) // 2, max(1, dim // 2)))
    first, second = (b / np.linalg.norm(b, axis=1, keepdims=True) for b in drawn)
    return first, second


def _products(vectors: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    first, second = books(vectors.shape[1], size)
    half = first.shape[1]
    rest = vectors[:, half:] if vectors.shape[1] > 1 else np.zeros((len(vectors), 1))
    return vectors[:, :half] @ first.T, rest @ second.T


def decode(vectors: np.ndarray, size: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Vector number and filter for all filters at or beyond the threshold, and each vector's few best ones."""
    a, b = _products(vectors, size)
    row, i = np.nonzero(a + b.max(axis=1, keepdims=True) >= threshold)
    found = [np.empty((0, 2), np.int64)]
    for at in range(0, len(row), 4096):
        r, k = row[at : at + 4096], i[at : at + 4096]
        hit, j = np.nonzero(a[r, k][:, None] + b[r] >= threshold)
        found.append(np.stack([r[hit], k[hit] * size + j], axis=1))
    few = min(LEAST_PASSED, size)
    best_a, best_b = (np.argsort(-x, axis=1, kind="stable")[:, :few] for x in (a, b))
    sums = np.take_along_axis(a, best_a, 1)[:, :, None] + np.take_along_axis(b, best_b, 1)[:, None, :]
    top = np.argsort(-sums.reshape(len(vectors), -1), axis=1, kind="stable")[:, :few]
    best = np.take_along_axis(best_a, top // few, 1) * size + np.take_along_axis(best_b, top % few, 1)
    found.append(np.stack([np.repeat(np.arange(len(vectors)), few), best.ravel()], axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pairs[:, 0], pairs[:, 1]


def unit(rows: pd.Series) -> np.ndarray:
    vectors = np.stack(rows.to_list()).astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _threshold(sample: pd.Series, size: int) -> float:
    """The product that a sampled vector has with ``PASSED`` of the filters, on average."""
    a, b = _products(unit(sample), size)
    low, high = -2.0, 2.0
    b.sort(axis=1)
    for _ in range(40):
        middle = (low + high) / 2
        passed = sum(int((size - np.searchsorted(own, middle - more)).sum()) for more, own in zip(a, b))
        low, high = (middle, high) if passed > PASSED * len(a) else (low, middle)
    return high


def _filters(size: int, thresholds: dict[int, float]):
    def filters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                for at in range(0, len(rows), 512):
                    part = rows.iloc[at : at + 512]
                    vectors = unit(part["vector"])
                    row, key = decode(vectors, size, thresholds[dim])
                    cuts = np.searchsorted(row, np.arange(len(part) + 1))
                    lists = [key[a:b] for a, b in zip(cuts, cuts[1:])]
                    yield pd.DataFrame({
                        "row": part["row"].array, "dim": dim, "weight": part["weight"].array,
                        "vector": [v.tobytes() for v in vectors], "filters": lists,
                    })

    return filters


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first of those that each of ``n`` things reaches by the links ``a[i], b[i]``."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if (least == root).all():
            return root
        root = least


LINKS = "row long, links long, root long"


def _verified(least_cosine: float):
    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in whole_groups(batches, ["dim", "filter", "left", "right"]):
            if len(group) < 2:
                continue
            group = group.sort_values("row")
            row, side, weight = (group[c].to_numpy() for c in ("row", "block", "weight"))
            vectors = np.frombuffer(b"".join(group["vector"]), np.float64).reshape(len(group), -1)
            a, b = np.nonzero(np.triu(vectors @ vectors.T >= least_cosine, 1))
            if group["left"].iat[0] != group["right"].iat[0]:
                across = side[a] != side[b]
                a, b = a[across], b[across]
            if not len(a):
                continue
            # A pair counts at its first common filter only.
            own = group["filter"].iat[0]
            lists = group["filters"].to_list()
            below = np.concatenate([x[: np.searchsorted(x, own)] for x in lists])
            if len(below):
                names, at = np.unique(below, return_inverse=True)
                member = np.zeros((len(group), len(names)), np.float32)
                member[np.repeat(np.arange(len(group)), [np.searchsorted(x, own) for x in lists]), at] = 1
                new = (member @ member.T)[a, b] == 0
                a, b = a[new], b[new]
            if not len(a):
                continue
            links = np.zeros(len(group), np.int64)
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            root = _roots(len(group), a, b)
            has = links > 0
            yield pd.DataFrame({"row": row[has], "links": links[has], "root": row[root[has]]})

    return verified


def _sized(vectors: DataFrame) -> tuple[int, dict[int, float]]:
    n = vectors.count()
    size = max(SMALLEST_BOOK, math.ceil(math.sqrt(n * PASSED / PER_FILTER)))
    dims = [r["dim"] for r in vectors.select("dim").distinct().limit(1001).collect()]
    if len(dims) > 1000:
        raise ValueError("vectors of more than 1000 different lengths")
    thresholds = {}
    for dim in dims:
        sample = vectors.where(F.col("dim") == dim).orderBy(F.xxhash64("row")).limit(SAMPLE).select("vector").toPandas()
        thresholds[dim] = _threshold(sample["vector"], size)
    return size, thresholds


def links(vectors: DataFrame, least_cosine: float = COSINE) -> DataFrame:
    """Partial counts of links and, per compared block, the first vector that each linked one reaches there.

    ``vectors`` holds ``row``, ``dim``, ``vector`` and ``weight``, distinct vectors of finite numbers, not all zero.
    """
    size, thresholds = _sized(vectors)
    passed = settle(vectors.mapInPandas(_filters(size, thresholds), "row long, dim int, weight long, vector binary, filters array<long>"), "filters")
    single = passed.select("dim", F.explode("filters").alias("filter"))
    crowd = single.groupBy("dim", "filter").agg(F.count("*").alias("n")).where("n > 1")
    blocks = settle(crowd.select("dim", "filter", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "blocks")
    member = passed.select("row", "dim", "weight", "vector", "filters", F.explode("filters").alias("filter"))
    dealt = member.join(blocks, ["dim", "filter"]).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    pairs = met.select("dim", "filter", F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"), "block", "row", "weight", "vector", "filters")
    keys = ["dim", "filter", "left", "right"]
    return pairs.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_verified(least_cosine), LINKS)


def near_duplicates(table: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", least_cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept``, one row for each row of ``table``.

    Equal vectors are indexed once, with their number. Null, empty and zero vectors and those that hold a null or
    no finite number link with nothing; so do vectors of different lengths with each other. Null ids come after all
    others, and only a component of such rows has a null id; repeated ids are rows of their own.
    """
    numbers = F.col(f"`{vector}`").cast("array<double>")
    valid = (
        (F.size(numbers) > 0)
        & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(numbers, lambda x: x != 0)
    )
    plain = table.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.when(valid, numbers).alias("vector"))
    rows = settle(numbered(plain, "own"), "numbered-vectors")
    some = rows.where("vector IS NOT NULL")
    distinct = settle(some.groupBy("vector").agg(F.min("own").alias("row"), F.count("*").alias("weight"), F.min(doc_order(F.col("vec_id"))).alias("first")), "distinct-vectors")
    found = settle(links(distinct.select("row", F.size("vector").cast("int").alias("dim"), "vector", "weight"), least_cosine), "links")
    reached = components(found.select(F.col("row").alias("u"), F.col("root").alias("v")))
    counted = found.groupBy("row").agg(F.sum("links").alias("links"))
    joined = distinct.join(counted, "row", "left").join(reached.withColumnRenamed("node", "row"), "row", "left")
    one = settle(joined.select("vector", "weight", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "row").alias("root")), "vector-classes")
    least = settle(one.groupBy("root").agg(F.min("first").alias("least")), "least-ids")
    classes = settle(one.join(least, "root").select("vector", (F.col("weight") - 1 + F.col("links")).alias("n_links"), "least"), "classes")
    linked = some.join(classes, "vector").select("vec_id", "n_links", F.nullif("least", F.lit(LAST_ID)).alias("component_id"))
    alone = rows.where("vector IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_cap_filters(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
