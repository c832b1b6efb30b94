"""Quality of a text by a convolutional network over its bytes, in numpy.

Bytes are embedded, filters of eight bytes slide over them in steps of two, and every chunk keeps each filter's largest
answer. Chunks overlap by a filter's length, so no window is missed, and together they cover the whole text. A text's
features are the mean and the largest of its chunks' answers; a logistic unit makes one probability of them.

Training is spread over shards of a bounded sample: in each round every shard goes on from the common weights, and
the new weights are averaged. Only weights come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docstrata.llm.common import documents, held_out, settle, with_result

#: Labelled rows a model learns from at most, by the hash of their id; a bound of the classifier, not of what it scores.
SAMPLE = 4000
SHARDS, ROUNDS, EPOCHS = 4, 5, 2
WIDTH, STEP, FILTERS, EMBEDDING = 8, 2, 24, 8
CHUNK = 1024
BATCH, RATE, DECAY = 16, 0.01, 1e-4
THRESHOLD = 0.7
#: Bytes whose windows are looked up at once.
BLOCK = 1 << 18

Weights = dict[str, np.ndarray]


def start(seed: int = 7) -> Weights:
    rng = np.random.default_rng(seed)
    draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {
        "bytes": draw(0.5, 256, EMBEDDING),
        "filters": draw((WIDTH * EMBEDDING) ** -0.5, EMBEDDING, WIDTH, FILTERS),
        "bias": np.zeros(FILTERS, np.float32),
        "unit": draw(0.1, 2 * FILTERS),
        "rest": np.zeros(1, np.float32),
    }


def answers(weights: Weights) -> np.ndarray:
    """What a byte at each place of a filter adds to the filter's answer: one table per place."""
    return np.einsum("be,ewf->wbf", weights["bytes"], weights["filters"], optimize=True)


@dataclass
class Chunks:
    """Largest answer of each filter in each chunk, and where it was."""

    best: np.ndarray
    at: np.ndarray


def convolve(data: np.ndarray, tables: np.ndarray, bias: np.ndarray, places: bool = False) -> Chunks:
    """Over all windows of ``data``, padded to one window at least. Window starts of a chunk: ``CHUNK`` bytes."""
    if len(data) < WIDTH + STEP:
        data = np.pad(data, (0, WIDTH + STEP - len(data)))
    best, at = [], []
    windows = (len(data) - WIDTH) // STEP + 1
    per_chunk, per_block = CHUNK // STEP, BLOCK // STEP
    for first in range(0, windows, per_block):
        n = min(per_block, windows - first)
        total = np.broadcast_to(bias, (n, FILTERS)).copy()
        for j in range(WIDTH):
            total += tables[j].take(data[first * STEP + j :: STEP][:n], axis=0)
        np.maximum(total, 0, out=total)
        cuts = np.arange(0, n, per_chunk)
        best.append(np.maximum.reduceat(total, cuts, axis=0))
        if places:
            at += [first + c + total[c : c + per_chunk].argmax(axis=0) for c in cuts]
    return Chunks(np.concatenate(best), np.array(at))


def features(chunks: Chunks) -> np.ndarray:
    return np.concatenate([chunks.best.mean(axis=0), chunks.best.max(axis=0)])


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def probability(x: np.ndarray, weights: Weights) -> float:
    return float(1 / (1 + np.exp(-np.clip(x @ weights["unit"] + weights["rest"][0], -30, 30))))


def _step(texts: list[np.ndarray], labels: np.ndarray, weights: Weights) -> Weights:
    """The gradient of a batch's log loss."""
    tables = answers(weights)
    slopes = {k: np.zeros_like(v) for k, v in weights.items()}
    by_table = np.zeros_like(tables)
    columns = np.arange(FILTERS)
    for data, label in zip(texts, labels):
        if len(data) < WIDTH + STEP:
            data = np.pad(data, (0, WIDTH + STEP - len(data)))
        chunks = convolve(data, tables, weights["bias"], places=True)
        x = features(chunks)
        off = (probability(x, weights) - label) / len(labels)
        slopes["unit"] += off * x
        slopes["rest"] += off
        back = np.repeat(off * weights["unit"][None, :FILTERS] / len(chunks.best), len(chunks.best), axis=0)
        back[chunks.best.argmax(axis=0), columns] += off * weights["unit"][FILTERS:]
        back[chunks.best <= 0] = 0
        slopes["bias"] += back.sum(axis=0)
        for j in range(WIDTH):
            np.add.at(by_table[j], (data[chunks.at * STEP + j], columns[None, :]), back)
    slopes["bytes"] += np.einsum("wbf,ewf->be", by_table, weights["filters"], optimize=True)
    slopes["filters"] += np.einsum("wbf,be->ewf", by_table, weights["bytes"], optimize=True)
    return slopes


def train(texts: list[np.ndarray], labels: np.ndarray, weights: Weights, epochs: int, seed: int, rate: float) -> Weights:
    """``epochs`` passes of Adam over the texts, from ``weights``."""
    weights = {k: v.copy() for k, v in weights.items()}
    mean, square = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    rng, t = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for first in range(0, len(order), BATCH):
            part, t = order[first : first + BATCH], t + 1
            for k, slope in _step([texts[i] for i in part], labels[part], weights).items():
                slope += DECAY * weights[k]
                mean[k] += 0.1 * (slope - mean[k])
                square[k] += 0.01 * (slope**2 - square[k])
                weights[k] -= rate * (mean[k] / (1 - 0.9**t)) / (np.sqrt(square[k] / (1 - 0.99**t)) + 1e-7)
    return weights


def _packed(weights: Weights) -> bytes:
    return b"".join(weights[k].astype("<f4").tobytes() for k in weights)


def _unpacked(data: bytes) -> Weights:
    out, at, flat = {}, 0, np.frombuffer(data, "<f4")
    for k, like in start().items():
        out[k] = flat[at : at + like.size].reshape(like.shape).copy()
        at += like.size
    return out


def _learner(common: Weights, number: int):
    def learn(shard: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", kind="stable")
        texts, rate = [as_bytes(t) for t in rows["text"]], RATE * (1 - number / ROUNDS)
        new = train(texts, rows["label"].to_numpy(), common, EPOCHS, 100 * number + int(shard[0]), rate)
        return pd.DataFrame({"n": [len(rows)], "weights": [_packed(new)]})

    return learn


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", sample: int = SAMPLE) -> Weights:
    """Weights learned from at most ``sample`` rows of ``labels`` with a label of 0 or 1, those whose key hashes lowest.

    Keys are joined with ``docs`` as a broadcast of ``sample`` rows. Keys without a document, null keys and other
    labels teach nothing; without any rows the weights are those of the start.
    """
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("double").alias("label"))
    known = known.where("key IS NOT NULL AND label IN (0, 1)").withColumn("place", F.xxhash64("key")).orderBy("place", "label").limit(sample)
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = texts.join(F.broadcast(known), "key").withColumn("shard", F.pmod(F.col("place"), F.lit(SHARDS)).cast("int"))
    stored = settle(rows.select("text", "label", "place", "shard"), "quality-sample")
    weights = start()
    for number in range(ROUNDS):
        parts = stored.groupBy("shard").applyInPandas(_learner(weights, number), "n long, weights binary").collect()  # SHARDS rows
        if not parts:
            return weights
        total = sum(p["n"] for p in parts)
        found = [(p["n"] / total, _unpacked(bytes(p["weights"]))) for p in parts]
        weights = {k: sum(share * w[k] for share, w in found).astype(np.float32) for k in weights}
    return weights


def score(docs: DataFrame, weights: Weights, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a column of probabilities, and its name. Null texts count as empty, and empty ones are padded to one window.

    Each row is scored by itself: repeated rows and other columns don't matter.
    """
    held = docs.sparkSession.sparkContext.broadcast({**weights, "tables": answers(weights)})  # about 0.2 MB

    def scores(texts: pd.Series) -> pd.Series:
        w = held.value
        return pd.Series([probability(features(convolve(as_bytes(t), w["tables"], w["bias"])), w) for t in texts], dtype="float64")

    return with_result(docs, text, scores, "double", "quality_score")


def op7_byte_cnn(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    weights = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    found, name = score(docs, weights)
    return found.select("doc_id", "held_out", F.col(name).alias("score"), (F.col(name) >= THRESHOLD).cast("int").alias("predicted"))
