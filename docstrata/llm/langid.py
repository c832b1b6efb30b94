"""Language identification by rank-order profiles of letter n-grams.

A profile lists the most frequent n-grams of a text or a language by falling count, ties by the n-gram. The distance
of a text to a language sums, over the text's profile, how far each n-gram stands from its place in the language's;
an n-gram the language lacks counts as the profile size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from docstrata.llm.common import bounded_batches, documents, held_out, with_result

UNDETERMINED = "und"
PROFILE_SIZE = 300
#: Characters counted at once in training, and counted n-grams a task holds before it hands them on.
CHUNK = 1 << 18
FLUSH_AT = 250_000
#: Learned values are broadcast as one table; a column with more of them is no language column.
MAX_LANGUAGES = 2_000
#: Parts of a language's n-grams that are ranked apart before the last ranking.
RANK_PARTS = 16

#: An n-gram is one number of three characters of 21 bits, from the left: 0 for none, 1 for the edge of a word.
BITS, EDGE = 21, 1


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def count_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Letter n-grams of one to three characters, words padded with one edge on either side, and their counts.

    The n-grams come in rising order. A text without a letter has none.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.full(len(points) + 2, EDGE, np.int64)
    inner = codes[1:-1]
    np.copyto(inner, points + (EDGE + 1), where=_letters()[points], casting="unsafe")
    letter = codes > EDGE
    first, second, third = codes << (2 * BITS), codes[1:] << BITS, codes[2:]
    pairs = first[:-1] | second
    return np.unique(
        np.concatenate([first[letter], pairs[letter[:-1] | letter[1:]], (pairs[:-1] | third)[letter[1:-1]]]),
        return_counts=True,
    )


def ranked(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE_SIZE) -> np.ndarray:
    """The most frequent n-grams first, equally frequent ones in rising order."""
    return grams[np.lexsort((grams, -counts))[:size]]


@dataclass(frozen=True)
class Profiles:
    """``places[i, k]`` is the rank of ``grams[i]`` in language ``k``, or -1; ``grams`` rise, the last row is for others."""

    languages: list[str]
    grams: np.ndarray
    places: np.ndarray
    size: int

    @staticmethod
    def of(ranks: dict[str, np.ndarray], size: int = PROFILE_SIZE) -> "Profiles":
        languages = sorted(ranks)
        grams = np.unique(np.concatenate([ranks[k] for k in languages])) if languages else np.empty(0, np.int64)
        places = np.full((len(grams) + 1, len(languages)), -1, np.int32)
        for k, language in enumerate(languages):
            places[np.searchsorted(grams, ranks[language]), k] = np.arange(len(ranks[language]))
        return Profiles(languages, grams, places, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and by what part the second is farther; ties go to the first name."""
        top = ranked(*count_grams(text), self.size) if text else ()
        if not len(top) or not len(self.grams):
            return UNDETERMINED, 0.0
        row = np.searchsorted(self.grams, top)
        row[self.grams[np.minimum(row, len(self.grams) - 1)] != top] = len(self.grams)
        places = self.places[row]
        off = np.where(places < 0, self.size, np.abs(places - np.arange(len(top))[:, None]))
        distance = off.sum(axis=0) / (len(top) * self.size)
        best = int(distance.argmin())
        second = float(np.delete(distance, best).min(initial=1.0))
        return self.languages[best], float((second - distance[best]) / second) if second > 0 else 0.0


def _chunks(texts: pd.Series) -> Iterator[str]:
    """Texts joined by line breaks, which no n-gram crosses, in pieces of about ``CHUNK`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text) + 1
        if size >= CHUNK:
            yield "\n".join(held)
            held, size = [], 0
    yield "\n".join(held)


def _partial_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts: list[pd.DataFrame] = []
    for batch in batches:
        for language, texts in batch.groupby("lang")["text"]:
            for chunk in _chunks(texts):
                grams, counts = count_grams(chunk)
                parts.append(pd.DataFrame({"lang": language, "gram": grams, "n": counts}))
                if sum(map(len, parts)) >= FLUSH_AT:
                    yield pd.concat(parts).groupby(["lang", "gram"], as_index=False)["n"].sum()
                    parts = []
    if parts:
        yield pd.concat(parts).groupby(["lang", "gram"], as_index=False)["n"].sum()


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_SIZE) -> Profiles:
    """Profiles of every non-null value of ``lang`` over all rows given. Null texts teach nothing."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    counts = rows.where("lang IS NOT NULL AND text IS NOT NULL").mapInPandas(_partial_counts, "lang string, gram long, n long")
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("part", F.pmod(F.hash("gram"), F.lit(RANK_PARTS)))
    order = Window.partitionBy("lang", "part").orderBy(F.desc("n"), "gram")
    first = total.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    # At most RANK_PARTS * size rows for each language come to the driver, whatever the corpus.
    limit = MAX_LANGUAGES * RANK_PARTS * size
    found = first.select("lang", "gram", "n").limit(limit + 1).toPandas()
    if len(found) > limit:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    ranks = {k: ranked(part["gram"].to_numpy(), part["n"].to_numpy(), size) for k, part in found.groupby("lang")}
    return Profiles.of(ranks, size)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct (lang_pred, score); also returns that struct's name.

    ``lang_pred`` is ``und`` and the score 0 for null texts, texts without a letter, and when nothing was learned.
    Repeated rows each get their own row; other columns stay as they are.
    """
    held = docs.sparkSession.sparkContext.broadcast(profiles)  # MAX_LANGUAGES * PROFILE_SIZE n-grams at most

    def nearest(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([held.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return with_result(docs, text, nearest, "lang_pred string, score double", "language")


def op8_rank_profiles(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    profiles = fit(docs.where(~F.col("held_out")))
    found, name = identify(docs, profiles)
    return found.select("doc_id", "held_out", f"{name}.lang_pred", f"{name}.score")
