"""Language identification with a byte convolutional network.

Bytes are embedded, filters of several widths slide over windows of fixed length, the
largest response of each filter in a window feeds a softmax over the languages. The
network is trained in NumPy on the driver from a sample of labelled windows whose size
is a parameter, and applied in tasks to all windows of every whole text; a text's
probabilities are the mean over its windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_of, prepare

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
# The model's sample: about this many windows of each language, twice as many at most. More languages
# than ``LANGUAGES`` share the windows of so many.
WINDOWS_PER_LANGUAGE = 1200
LANGUAGES = 200
WINDOWS_PER_TEXT = 4
EPOCHS = 6
RATE = 0.01
# Bytes that pass through the network at a time: their lookups stay in the cache.
BYTES_PER_STEP = 1 << 15

PAD = 0


@dataclass
class Network:
    """Trained weights with the embedding folded into the filters.

    The response of a filter of width w at place i is the sum over k < w of
    ``taps[w][k][byte i + k]``, so that two bytes at a time are one lookup.
    """

    languages: list[str]
    taps: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Lookups by a pair of bytes: at the place itself for all filters, two on for the wide ones."""
        first, second = [], []
        zero = np.zeros((1, FILTERS), np.float32)
        for width in WIDTHS:
            tap = self.taps[width]
            first.append((tap[0][:, None] + tap[1][None, :]).reshape(65536, -1))
            if width > 2:
                last = tap[3][None, :] if width > 3 else zero[None]
                second.append(np.broadcast_to(tap[2][:, None] + last, (256, 256, FILTERS)).reshape(65536, -1))
        return np.hstack(first).astype(np.float32), np.hstack(second).astype(np.float32)

    def probabilities(self, windows: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Softmax rows for windows of bytes (rows of ``WINDOW`` + 3, padded)."""
        found = np.empty((len(windows), len(self.out_bias)))
        step = max(1, BYTES_PER_STEP // WINDOW)
        first, second = tables
        for a in range(0, len(windows), step):
            part = windows[a : a + step].astype(np.int32)
            pairs = part[:, :-1] << 8 | part[:, 1:]
            peak = np.empty((len(part), first.shape[1]), np.float32)
            response = first[pairs[:, :WINDOW]]
            response[:, :, FILTERS:] += second[pairs[:, 2 : WINDOW + 2]]
            response.max(axis=1, out=peak)
            hidden = np.maximum(peak + self.bias, 0)
            found[a : a + step] = softmax(hidden @ self.out + self.out_bias)
        return found


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def windows_of(raw: bytes) -> np.ndarray:
    """All windows of a text: rows of ``WINDOW`` bytes and three that follow, zero-padded."""
    count = max(1, -(-len(raw) // WINDOW))
    padded = np.zeros(count * WINDOW + 3, np.uint8)
    padded[: len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + 3)[::WINDOW]


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Fit the network by Adam on cross-entropy; windows are rows of ``WINDOW`` + 3 bytes."""
    rng = np.random.default_rng(seed)
    classes = len(languages)
    weights = {"embedding": rng.normal(0, 0.5, (256, EMBEDDING))}
    for width in WIDTHS:
        weights[f"filter{width}"] = rng.normal(0, (1 / (width * EMBEDDING)) ** 0.5, (width, EMBEDDING, FILTERS))
    features = FILTERS * len(WIDTHS)
    weights["bias"] = np.zeros(features)
    weights["out"] = rng.normal(0, (1 / features) ** 0.5, (features, classes))
    weights["out_bias"] = np.zeros(classes)
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), 64):
            rows = order[a : a + 64]
            grads = gradients(weights, windows[rows], labels[rows])
            step += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                weights[k] -= RATE * move
    taps = {w: np.einsum("be,kef->kbf", weights["embedding"], weights[f"filter{w}"]) for w in WIDTHS}
    return Network(languages, taps, weights["bias"], weights["out"], weights["out_bias"])


def gradients(weights: dict[str, np.ndarray], windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    n = len(windows)
    codes = windows.astype(np.int64)
    embedded = weights["embedding"][codes]
    peaks, places = [], []
    for width in WIDTHS:
        kernel = weights[f"filter{width}"]
        flat = np.lib.stride_tricks.sliding_window_view(embedded, width, axis=1)[:, :WINDOW]
        # (windows, places, embedding, width) against (width, embedding, filters)
        response = flat.reshape(n, WINDOW, -1) @ kernel.transpose(1, 0, 2).reshape(-1, FILTERS)
        place = response.argmax(axis=1)
        places.append(place)
        peaks.append(np.take_along_axis(response, place[:, None], axis=1)[:, 0])
    total = np.concatenate(peaks, axis=1) + weights["bias"]
    hidden = np.maximum(total, 0)
    error = softmax(hidden @ weights["out"] + weights["out_bias"])
    error[np.arange(n), labels] -= 1
    error = (error / n).astype(np.float32)
    grads = {"out": hidden.T @ error, "out_bias": error.sum(axis=0)}
    back = (error @ weights["out"].T) * (total > 0)
    grads["bias"] = back.sum(axis=0)
    grads["embedding"] = np.zeros_like(weights["embedding"])
    rows = np.arange(n)[:, None]
    for k, width in enumerate(WIDTHS):
        kernel = weights[f"filter{width}"]
        part = back[:, k * FILTERS : (k + 1) * FILTERS]
        grad = np.zeros_like(kernel)
        for tap in range(width):
            at = places[k] + tap
            grad[tap] = np.einsum("nfe,nf->ef", embedded[rows, at], part)
            pull = part[:, :, None] * kernel[tap].T[None]
            np.add.at(grads["embedding"], codes[rows, at].ravel(), pull.reshape(-1, EMBEDDING))
        grads[f"filter{width}"] = grad
    return grads


def sample_windows(labelled: DataFrame, text_col: str, label_col: str, id_col: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows of labelled texts for training, bounded per language, and the languages.

    Which texts are taken follows from hashes of id and text, and which of their windows from
    their lengths, so the sample is the same in every run. No language is cut by another, and
    every language that occurs is learned.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(text_col).alias("x"), F.col(label_col).cast("string").alias("y"), F.xxhash64(id_col, text_col).alias("h"))
    rows = rows.where("x IS NOT NULL AND y IS NOT NULL AND length(x) > 0")
    counts = rows.groupBy("y").agg(F.count("*").alias("count"), F.min("h").alias("least"))
    counts = counts.collect()
    languages = sorted(r["y"] for r in counts)
    if not languages:
        return np.zeros((0, WINDOW + 3), np.uint8), np.zeros(0, np.int64), []
    each = min(WINDOWS_PER_LANGUAGE, WINDOWS_PER_LANGUAGE * LANGUAGES // len(languages))
    texts = max(1, each // WINDOWS_PER_TEXT)
    # The expected number of texts taken per language is at most half above the bound.
    shares = [(r["y"], min(1.0, 1.5 * texts / r["count"]), r["least"]) for r in counts]
    chosen = spark.createDataFrame(shares, "y string, share double, least long")
    place = F.pmod(F.col("h"), F.lit(1_000_003)) / 1_000_003
    # Equal rows have one hash: a language of few hashes has its least one at any rate.
    taken = (place < F.col("share")) | (F.col("h") == F.col("least"))
    rows = rows.join(F.broadcast(chosen), "y").where(taken).select("x", "y", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, label, hashes = [], [], []
            for text, y, h in zip(*(batch.column(c).to_pylist() for c in range(3))):
                windows = windows_of(text.encode())
                rng = np.random.default_rng(len(text))
                taken = rng.permutation(len(windows))[:WINDOWS_PER_TEXT]
                found += [windows[k].tobytes() for k in taken]
                label += [y] * len(taken)
                hashes += [h] * len(taken)
            columns = [pa.array(found, pa.binary()), pa.array(label, pa.string()), pa.array(hashes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["w", "y", "h"])

    taken = rows.mapInArrow(run, "w binary, y string, h long")
    # At most this many windows of each language reach the driver: a fixed number of megabytes.
    order = Window.partitionBy("y").orderBy("h", "w")
    taken = taken.withColumn("n", F.row_number().over(order)).where(F.col("n") <= 2 * texts * WINDOWS_PER_TEXT)
    got = taken.select("w", "y").orderBy(F.xxhash64("w"), "w", "y").toArrow()
    windows = np.frombuffer(b"".join(got["w"].to_pylist()), np.uint8).reshape(-1, WINDOW + 3)
    place_of = {y: k for k, y in enumerate(languages)}
    labels = np.array([place_of[y] for y in got["y"].to_pylist()], np.int64)
    return windows, labels, languages


def fit(
    labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id"
) -> Network | None:
    """Train on labelled rows; None where no row has both a text and a language."""
    prepare(labelled.sparkSession)
    windows, labels, languages = sample_windows(labelled, text_col, label_col, id_col)
    return train(windows, labels, languages) if languages else None


def predictor(network: Network | None):
    """A function from lists of texts to predicted languages and their probabilities."""
    tables = None

    def predict(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        nonlocal tables
        labels, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if network is None:
            return labels, scores
        if tables is None:
            tables = network.tables()
        rows = [k for k, text in enumerate(texts) if text and any(map(str.isalpha, text))]
        for lo in range(0, len(rows), 64):
            part = rows[lo : lo + 64]
            raw = [texts[k].encode() for k in part]
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            counts = -(-sizes // WINDOW)
            found = network.probabilities(np.concatenate([windows_of(r) for r in raw]), tables)
            # Every window counts by its bytes; a text's last one is mostly shorter.
            weight = np.full(len(found), float(WINDOW))
            ends = np.cumsum(counts)
            weight[ends - 1] = sizes - (counts - 1) * WINDOW
            mean = np.add.reduceat(found * weight[:, None], ends - counts) / sizes[:, None]
            best = mean.argmax(axis=1)
            for k, b, row in zip(part, best.tolist(), mean):
                labels[k], scores[k] = network.languages[b], min(1.0, float(row[b]))
        return labels, scores

    return predict


def identify(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of every whole text: the id, lang_pred and score (0 to 1).

    ``und`` with score 0 where the text is null or empty or has no letter, or where there was
    nothing to learn from. Ties go to the language that sorts first. Rows are kept as they are;
    the network is a few hundred kilobytes at most, whatever the data.
    """
    prepare(docs.sparkSession)
    source = docs.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = predictor(network)
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("lang_pred", pa.string()), ("score", pa.float64())])
            yield batch_of(schema, [batch.column(0), *predict(batch.column(1).to_pylist())])

    schema = T.StructType(
        [source.schema[id_col], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return source.mapInArrow(run, schema)


def with_language(docs: DataFrame, network: Network | None, text_col: str = "text", into: str = "lang_pred") -> DataFrame:
    """All columns of ``docs`` and a struct column ``into`` of the prediction and its score."""
    prepare(docs.sparkSession)

    @F.pandas_udf("label string, score double")
    def label(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = predictor(network)
        for texts in parts:
            labels, scores = predict([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"label": labels, "score": scores})

    return docs.withColumn(into, label(F.col(text_col)))
