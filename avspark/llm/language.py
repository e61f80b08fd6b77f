"""Language ID: nearest-centroid classification of character n-gram vectors.

A text becomes one vector of hashed 1-, 2- and 3-grams of its lower-cased code points (words
framed by one space), weighted by 1 + log(count) and inverse document frequency, and scaled
to length 1. Each language has a few centroids (spherical k-means over a sample); a text gets
the language of the centroid with the largest cosine. A text is rejected when it has no
letter, or when that cosine is below the distance that the sample's own texts keep.

The fit uses a sample bounded by ``fit_rows`` (divided over the languages, smallest hashes
first); prediction reads every whole text, each row alone. The model, a few centroids per
language, is all that tasks share.

Defined results: null text, and text without a letter, gives ``und`` with score 0 and is
rejected; rows without a label are not learned from; without any label every text is
rejected; equal cosines go to the first language in order; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avspark.llm.common import slices, stored, texts

DIMENSIONS = 1 << 12
#: Labelled rows that a fit may use; at least MIN_FIT for each language.
FIT_ROWS = 800
MIN_FIT = 20
CLUSTERS = 3
UNKNOWN = "und"

_STEP = 1 << 16  # code points hashed at once, bounds the memory of very long texts
_letters = np.zeros(0x110000, bool)


def _is_letter() -> np.ndarray:
    if not _letters.any():
        _letters[:] = [chr(i).isalpha() for i in range(0x110000)]
    return _letters


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of the whole text; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[points]
    if not letter.any():
        return None
    # Everything but letters is a space, runs of them are one.
    points = np.where(letter, points, 32)
    points = points[letter | np.concatenate([[False], letter[:-1]])]
    points = np.concatenate([[32], points, [32] if points[-1] != 32 else []]).astype(np.uint64)
    total = np.zeros(DIMENSIONS)
    for at in range(0, len(points), _STEP):
        x = points[at : at + _STEP + 2]
        one = x * np.uint64(0x9E3779B97F4A7C15)
        two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + one[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) + one[2:]
        ends = min(_STEP, len(x))
        grams = [one[:ends], two[:ends], three[:ends]]
        for salt, g in enumerate(grams):
            h = ((g ^ (g >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93 + 2 * salt)) >> np.uint64(65 - DIMENSIONS.bit_length())
            total += np.bincount(h.astype(np.int64), minlength=DIMENSIONS)
    return total


def weighted(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.where(count > 0, 1 + np.log(np.maximum(count, 1)), 0) * idf
    length = np.sqrt((out**2).sum())
    return out / length if length else out


@dataclass
class LanguageModel:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # one row each, length 1
    idf: np.ndarray
    least: np.ndarray  # smallest cosine accepted at each centroid

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine, rejected."""
        count = counts(text) if text else None
        if count is None or not self.languages:
            return UNKNOWN, 0.0, True
        cosine = self.centroids @ weighted(count, self.idf)
        best = int(cosine.argmax())
        return self.languages[best], round(float(cosine[best]), 6), bool(cosine[best] < self.least[best])


def _cluster(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds; deterministic."""
    seeds = [int((rows @ rows.mean(0)).argmax())]
    nearest = rows @ rows[seeds[0]]
    while len(seeds) < min(k, len(rows)):
        seeds.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, rows @ rows[seeds[-1]])
    centroids = rows[seeds]
    for _ in range(10):
        of = (rows @ centroids.T).argmax(1)
        sums = np.stack([rows[of == i].sum(0) if (of == i).any() else centroids[i] for i in range(len(seeds))])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centroids, (rows @ centroids.T).argmax(1)


def fit(docs: DataFrame, learn: Column, fit_rows: int = FIT_ROWS, clusters: int = CLUSTERS) -> LanguageModel:
    """A model of the rows where ``learn`` holds; the driver sees ``fit_rows`` count vectors."""
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = [r[0] for r in labelled.groupBy(F.col("lang").cast("string").alias("lang")).count()
                 .where("lang != 'und'").orderBy("lang").collect()]
    if not languages:
        return LanguageModel([], np.zeros((0, DIMENSIONS)), np.zeros(DIMENSIONS), np.zeros(0))
    each = max(MIN_FIT, fit_rows // len(languages))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
              .withColumn("n", F.row_number().over(order)).where(F.col("n") <= each).select("doc_id", "lang"))
    chosen = stored(chosen.distinct(), "language-sample")  # bounded: ``each`` ids for each language
    sample = texts(docs.where(learn & F.col("text").isNotNull())).join(F.broadcast(chosen), "doc_id")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(lang, c) for lang, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True)
                    if (c := counts(t)) is not None]
            for at in range(0, len(rows), 64):
                part = rows[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in part]), pa.array([c.astype(np.float32).tobytes() for _, c in part])],
                    ["lang", "counts"])

    found = sample.select("text", "lang").mapInArrow(vectors, "lang string, counts binary").collect()
    found = sorted((r.lang, bytes(r.counts)) for r in found)
    table = np.stack([np.frombuffer(c, np.float32) for _, c in found]).astype(np.float64) if found else np.zeros((0, DIMENSIONS))
    idf = np.log((1 + len(table)) / (1 + (table > 0).sum(0))) + 1
    rows = np.stack([weighted(r, idf) for r in table]) if found else table
    labels = np.array([x for x, _ in found])
    names, centres, least = [], [], []
    for lang in languages:
        own = rows[labels == lang]
        if not len(own):
            continue
        centroids, of = _cluster(own, clusters)
        for i, c in enumerate(centroids):
            near = own[of == i] @ c
            names.append(lang)
            centres.append(c)
            # Half the smallest cosine of the cluster's own texts: far outside of what was seen.
            least.append(0.5 * near.min() if len(near) else 0.0)
    return LanguageModel(names, np.stack(centres) if centres else np.zeros((0, DIMENSIONS)), idf, np.array(least))


def identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of ``docs``, then ``lang_pred``, ``lang_score``, ``lang_rejected``.

    Only the text column is read for the prediction. A column of ``docs`` with one of these
    names is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred string, lang_score double, lang_rejected boolean>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            rows = [own.predict(t) for t in batch]
            yield pd.DataFrame(rows, columns=["lang_pred", "lang_score", "lang_rejected"])

    names = ("lang_pred", "lang_score", "lang_rejected")
    told = docs.drop(*names).withColumn("__language", predict(F.col("text").cast("string")))
    return told.select(*[F.col(c) for c in docs.drop(*names).columns],
                       *[F.col("__language")[n].alias(n) for n in names])


