"""A quality classifier: naive Bayes features in a linear support vector machine.

A text is the set of its word unigrams and of the one- to three-grams of its words'
shapes, each hashed to a fixed range. The indicator of a feature is scaled by the log ratio of its
smoothed frequencies in the two classes, and a hinge-loss model is fitted to the scaled
indicators by dual coordinate descent. A logistic curve turns margins into scores.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_of, calibrate, labelled_sample, logistic, of_each_class, prepare, stored

WORD_BITS = SHAPE_BITS = 16
FEATURES = (1 << WORD_BITS) + (1 << SHAPE_BITS)
# Labelled texts of each class whose features are counted, and those that train the margin.
COUNTED_PER_CLASS = 20_000
TRAINED_PER_CLASS = 1_000
SMOOTHING = 1.0
PENALTY = 1.0
# Passes over the rows at most, and the share of the dual value that the duality gap may be at the end.
EPOCHS = 300
MOST_GAP = 1e-3
# Words remembered per worker with their shapes and places.
MEMO_WORDS = 400_000


class Features:
    """Feature numbers of a text; equal for equal texts on every machine."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.shapes: dict[str, str] = {}
        self.grams: dict = {}

    @staticmethod
    def shape(word: str) -> str:
        """Letters become a or A, digits 0, other signs stay; runs of one sign count once."""
        out = "".join("a" if c.islower() else "A" if c.isalpha() else "0" if c.isdigit() else c for c in word)
        return re.sub(r"(.)\1+", r"\1+", out, flags=re.DOTALL)

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.words) > MEMO_WORDS or len(self.grams) > MEMO_WORDS:
            self.__init__()
        tokens = (text or "").split()
        words, shapes, grams = self.words, self.shapes, self.grams
        found = set()
        for word in set(tokens):
            place = words.get(word)
            if place is None:
                words[word] = place = zlib.crc32(word.lower().encode()) & ((1 << WORD_BITS) - 1)
                shapes[word] = self.shape(word)
            found.add(place)
        # A word that repeats the one before it has a shape of its own.
        line = ["=" if a == b else shapes[b] for a, b in zip([None, *tokens], tokens)]
        for gram in {*line, *zip(line, line[1:]), *zip(line, line[1:], line[2:])}:
            place = grams.get(gram)
            if place is None:
                key = gram if isinstance(gram, str) else "\x00".join(gram)
                place = (1 << WORD_BITS) + (zlib.crc32(key.encode()) & ((1 << SHAPE_BITS) - 1))
                grams[gram] = place
            found.add(place)
        return np.fromiter(found, np.int64, len(found))


@dataclass
class QualityModel:
    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def score(self, features: np.ndarray) -> float:
        margin = self.weights[features].sum() / max(1.0, len(features)) ** 0.5 + self.offset
        return float(logistic(np.array(self.slope * margin + self.shift)))


def class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per class the number of texts with each feature, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        counts = np.zeros((2, FEATURES + 1), np.int64)
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[y, features(text)] += 1
                counts[y, FEATURES] += 1
        used = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])], names=["f", "n0", "n1"]
        )

    rows = labelled.mapInArrow(run, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    got = rows.toArrow()
    counts = np.zeros((2, FEATURES + 1))
    for k, name in enumerate(("n0", "n1")):
        counts[k, got["f"].to_numpy()] = got[name].to_numpy()
    return counts[:, :FEATURES], counts[:, FEATURES]


def training_rows(labelled: DataFrame, totals: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature sets and labels of a bounded sample; a set travels as one bit per feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                bits = np.zeros(FEATURES, bool)
                bits[features(text)] = True
                rows.append(zlib.compress(np.packbits(bits).tobytes(), 1))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1), batch.column(2)], names=["b", "y", "h"])

    got = of_each_class(labelled, totals.astype(int).tolist(), TRAINED_PER_CLASS, lambda x: x.mapInArrow(run, "b binary, y int, h long"))
    sets = [
        np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(b), np.uint8))) for b in got["b"].to_pylist()
    ]
    return sets, got["y"].to_numpy()


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights (the last one of a constant feature) that minimise half their square plus the hinge losses.

    It ends when the duality gap is small: no weights can do better by more than that.
    """
    weights = np.zeros(FEATURES + 1)
    alpha = np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            f, v, y = rows[i], values[i], signs[i]
            gradient = y * (v @ weights[f] + weights[FEATURES]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            change = (new - alpha[i]) * y
            if change:
                alpha[i] = new
                weights[f] += change * v
                weights[FEATURES] += change
        margin = np.array([v @ weights[f] for f, v in zip(rows, values)]) + weights[FEATURES]
        norm = weights @ weights
        gap = norm + (cost * np.maximum(0, 1 - signs * margin)).sum() - alpha.sum()
        if gap <= MOST_GAP * max(1.0, alpha.sum() - norm / 2):
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> QualityModel:
    """Train on texts labelled 0 or 1; without labels every score is one half."""
    prepare(docs.sparkSession)
    # Counts and training rows are taken from one stored sample.
    labelled = stored(labelled_sample(docs, labels, label_col, COUNTED_PER_CLASS), "quality-sample")
    counts, totals = class_counts(labelled)
    if not totals.sum():
        return QualityModel(np.zeros(FEATURES), 0.0, 1.0, 0.0)
    smooth = counts + SMOOTHING
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    # A feature of few texts says little, whatever its ratio.
    ratio[counts.sum(axis=0) < 3] = 0.0
    sets, label = training_rows(labelled, totals)
    # Rows are scaled to the square root of their size, so that long texts do not outweigh short ones.
    values = [ratio[s] / max(1.0, len(s)) ** 0.5 for s in sets]
    signs = np.where(label == 1, 1.0, -1.0)
    present = np.bincount(label, minlength=2)
    # A fifth of the sample sees only the logistic curve.
    kept = np.arange(len(sets)) % 5 == 4 if present.min() >= 25 else np.zeros(len(sets), bool)
    part = np.flatnonzero(~kept)
    weights = dual_descent([sets[i] for i in part], [values[i] for i in part], signs[part], np.full(len(part), PENALTY))
    rest = np.flatnonzero(kept) if kept.any() else part
    margin = np.array([values[i] @ weights[sets[i]] + weights[FEATURES] for i in rest])
    weight = (totals / np.maximum(1, present))[label[rest]]
    slope, shift = calibrate(margin, label[rest], weight)
    return QualityModel(weights[:FEATURES] * ratio, float(weights[FEATURES]), slope, shift)


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The quality of every whole text: the id and score (0 to 1, higher: better).

    Null and empty texts have no features and get the score of the constant part.
    Rows are kept as they are; the model is one array of fixed size.
    """
    prepare(docs.sparkSession)
    source = docs.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("score", pa.float64())])
            scores = [model.score(features(text)) for text in batch.column(1).to_pylist()]
            yield batch_of(schema, [batch.column(0), scores])

    schema = T.StructType([source.schema[id_col], T.StructField("score", T.DoubleType())])
    return source.mapInArrow(run, schema)


def with_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", into: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and the score of the text."""
    prepare(docs.sparkSession)

    @F.pandas_udf("double")
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for texts in parts:
            yield pd.Series([model.score(features(t if isinstance(t, str) else None)) for t in texts], dtype=float)

    return docs.withColumn(into, rate(F.col(text_col)))
