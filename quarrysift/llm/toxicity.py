"""Toxic passages as maximal scoring segments of token log-odds.

Words are weighed by the log-odds ratio of toxic against other texts under a Dirichlet prior
in proportion to their frequency in all labelled texts; words that say nothing by themselves
by their beginnings, which are counted over such words only. A text is the
sequence of its words' weights less a small drift; all its maximal scoring segments are
found in one pass. As for local alignments, the best segment of n words without toxic matter
follows an extreme-value law, so a segment of score s is expected K n exp(-lambda s) times by
chance. Significant segments are the toxic passages, and what they add up to in excess of
chance gives the text's score through a logistic curve.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_of, calibrate, labelled_sample, logistic, of_each_class, prepare, stored

WORD = re.compile(r"\w+")
# Lengths of the word beginnings that are features of their own.
BEGINNINGS = (3, 4, 5, 6)
# Labelled texts of each class that are counted, and those that fit the calibration.
COUNTED_PER_CLASS = 20_000
CALIBRATED_PER_CLASS = 2_000
# Strength of the prior in texts and the least |z| of a feature.
PRIOR_TEXTS = 20.0
LEAST_Z = 3.0
# Taken off every word's weight, so that segments end. This, the least |z| and the beginnings were chosen on labelled rows
# that may be learned from: fitted on two of four parts and compared on a third, never on the one held out.
DRIFT = 0.8
# A passage is significant if as good a one is expected less often by chance.
MOST_EXPECTED = 0.05
MEMO_WORDS = 400_000
FEATURES_PER_FLUSH = 400_000


def beginnings(word: str, lengths: tuple[int, ...] = BEGINNINGS) -> list[str]:
    """The word's beginnings with a mark that no word holds."""
    return [word[:n] + "*" for n in lengths if len(word) >= n]


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, last + 1, score), in linear time.

    Candidates lie on a stack by their sums before and after them. A new positive word is
    joined to the nearest candidate that starts lower, if that one also ends lower.
    """
    rising = np.flatnonzero(weights > 0)
    if not len(rising):
        return []
    total = np.cumsum(weights)
    stack: list[tuple[int, int, float, float, int]] = []
    for i in rising.tolist():
        first, low, high = i, float(total[i] - weights[i]), float(total[i])
        j = len(stack) - 1
        while True:
            # The fifth entry leads to the nearest candidate below with a lower start.
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                break
            first, low = stack[j][0], stack[j][2]
            before = stack[j][4]
            del stack[j:]
            j = before
        stack.append((first, i + 1, low, high, j))
    return [(a, b, high - low) for a, b, low, high, _ in stack]


@dataclass
class ToxicityModel:
    weights: dict[str, tuple[float, float]]
    rate: float
    scale: float
    slope: float
    shift: float
    drift: float = DRIFT
    lengths: tuple[int, ...] = BEGINNINGS

    def weigher(self):
        """A function from words to weights that remembers them."""
        memo: dict[str, float] = {}

        def weigh(words: list[str]) -> np.ndarray:
            if len(memo) > MEMO_WORDS:
                memo.clear()
            found = list(map(memo.get, words))
            if None in found:
                for k, value in enumerate(found):
                    if value is None:
                        word = words[k]
                        if word not in memo:
                            memo[word] = self.weight(word.lower()) - self.drift
                        found[k] = memo[word]
            return np.asarray(found, float)

        return weigh

    def weight(self, word: str) -> float:
        if word in self.weights:
            return self.weights[word][0]
        known = [self.weights[f] for f in beginnings(word, self.lengths) if f in self.weights]
        # Of several beginnings the one that surely weighs most speaks for the word.
        return max(known, key=lambda x: x[1])[0] if known else 0.0

    def evidence(self, count: int, score: float) -> float:
        """Minus the logarithm of how often a segment as good is expected in ``count`` words."""
        return self.rate * score - np.log(self.scale * max(1, count))

    def excess(self, count: int, found: list[tuple[int, int, float]]) -> float:
        """What the significant segments add up to beyond chance."""
        least = -np.log(MOST_EXPECTED)
        values = [self.evidence(count, s) for _, _, s in found]
        return float(sum(v for v in values if v >= least))

    def score(self, excess: float) -> float:
        return float(logistic(np.array(self.slope * np.log1p(excess) + self.shift)))


def feature_counts(
    labelled: DataFrame, known: frozenset[str] | None = None, lengths: tuple[int, ...] = BEGINNINGS
) -> DataFrame:
    """Per feature the number of toxic texts and of other texts that hold it.

    Features are words or, where ``known`` is given, the beginnings of words not in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])

        def flush() -> pa.RecordBatch:
            columns = [list(counts), [c[0] for c in counts.values()], [c[1] for c in counts.values()]]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names=["f", "n0", "n1"]
            )

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set(map(str.lower, WORD.findall(text)))
                if known is not None:
                    found = {f for w in found - known for f in beginnings(w, lengths)}
                for feature in found:
                    counts[feature][y] += 1
                if len(counts) > FEATURES_PER_FLUSH:
                    yield flush()
        yield flush()

    rows = labelled.mapInArrow(run, "f string, n0 long, n1 long")
    return rows.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def telling(counts: DataFrame, texts: tuple[int, int], least_z: float = LEAST_Z) -> dict[str, tuple[float, float]]:
    """The features with firm log-odds: their weight, and the weight less its standard error.

    They come from the texts of the bounded sample, and all of them are kept.
    """
    n0, n1 = texts
    a = F.lit(PRIOR_TEXTS) * (F.col("n0") + F.col("n1")) / F.lit(float(n0 + n1))
    hit1, hit0 = F.col("n1") + a, F.col("n0") + a
    miss1, miss0 = F.lit(n1 + PRIOR_TEXTS) - hit1 + 1e-9, F.lit(n0 + PRIOR_TEXTS) - hit0 + 1e-9
    odds = counts.select(
        "f",
        (F.log(hit1 / miss1) - F.log(hit0 / miss0)).alias("weight"),
        F.sqrt(1 / hit1 + 1 / hit0).alias("error"),
    )
    firm = odds.where(F.abs("weight") >= least_z * F.col("error"))
    return {r["f"]: (r["weight"], r["weight"] - r["error"]) for r in firm.collect()}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    least_z: float = LEAST_Z,
    drift: float = DRIFT,
    lengths: tuple[int, ...] = BEGINNINGS,
) -> ToxicityModel:
    """Learn weights, the extreme-value law and the curve from texts labelled 0 or 1.

    Without labels every text scores one half; with one class only, all score alike.
    """
    prepare(docs.sparkSession)
    labelled = stored(labelled_sample(docs, labels, label_col, COUNTED_PER_CLASS), "toxicity-sample")
    counts = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    if not counts:
        return ToxicityModel({}, 1.0, 1.0, 0.0, 0.0)
    texts = (counts.get(0, 0), counts.get(1, 0))
    words = telling(feature_counts(labelled), texts, least_z)
    parts = telling(feature_counts(labelled, frozenset(words), lengths), texts, least_z)
    model = ToxicityModel({**parts, **words}, 1.0, 1.0, 1.0, 0.0, drift, lengths)

    def seen() -> list[dict]:
        return of_each_class(labelled, texts, CALIBRATED_PER_CLASS, lambda rows: observe(rows, model)).to_pylist()

    # First the law of chance, then, under it, what all segments of the same texts add up to.
    fit_law(model, seen())
    fit_curve(model, seen(), texts)
    return model


def observe(labelled: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per labelled text its number of words, its best segment, the excess of all segments and a histogram of its weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = model.weigher()
        for batch in batches:
            words, best, excess, kinds = [], [], [], []
            for text in batch.column(0).to_pylist():
                weights = weigh(WORD.findall(text))
                words.append(len(weights))
                found = segments(weights)
                best.append(max((s for _, _, s in found), default=0.0))
                excess.append(model.excess(len(weights), found))
                value, count = np.unique(np.round(weights, 1), return_counts=True)
                kinds.append(np.ravel(np.column_stack([value, count])).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array(words, pa.int64()),
                    pa.array(best, pa.float64()),
                    pa.array(excess, pa.float64()),
                    pa.array(kinds, pa.list_(pa.float64())),
                    batch.column(2),
                ],
                names=["y", "words", "best", "excess", "weights", "h"],
            )

    return labelled.mapInArrow(run, "y int, words long, best double, excess double, weights array<double>, h long")


def fit_law(model: ToxicityModel, rows: list[dict]) -> None:
    """Fit the extreme-value law on the clean texts."""
    value: dict[float, float] = defaultdict(float)
    clean = [r for r in rows if r["y"] == 0]
    for row in clean:
        for v, n in zip(row["weights"][::2], row["weights"][1::2]):
            value[v] += n
    if value:
        # One word in all beyond what was seen keeps the law defined where clean texts have no toxic word.
        value[max([w for w, _ in model.weights.values()], default=1.0) - model.drift] += 1.0
        v = np.array(list(value))
        p = np.array(list(value.values()))
        model.rate = karlin_rate(v, p / p.sum())
    # The best segment exceeds s with probability 1 - exp(-K n exp(-rate s)): the mean of
    # exp(-rate s) n over clean texts, whose best segment may be none, gives 1 / K.
    ratio = [r["words"] * np.exp(-model.rate * r["best"]) for r in clean if r["words"]]
    model.scale = float(np.clip(1 / np.mean(ratio), 1e-4, 1.0)) if ratio else 1.0


def fit_curve(model: ToxicityModel, rows: list[dict], texts: tuple[int, int]) -> None:
    """Fit the curve on both classes."""
    excess = np.log1p([r["excess"] for r in rows])
    label = np.array([r["y"] for r in rows])
    present = np.bincount(label, minlength=2)
    weight = (np.array(texts) / np.maximum(1, present))[label]
    model.slope, model.shift = calibrate(excess, label, weight)


def karlin_rate(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive solution of sum(share * exp(rate * value)) = 1; the mean must be negative."""
    if not (values > 0).any() or (values * shares).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (shares * np.exp(high * values)).sum() < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (shares * np.exp(mid * values)).sum() < 1 else (low, mid)
    return max(high, 1e-3)


PASSAGE = "array<struct<start:int,end:int,score:double,expected:double,text:string>>"


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The toxicity of every whole text: the id, score (0 to 1) and passages.

    Passages are the significant segments with their character ranges, their scores and
    how often as good a one is expected by chance. Null and empty texts have none and
    get the score of texts without passages. Rows are kept as they are.
    """
    prepare(docs.sparkSession)
    source = docs.select(id_col, text_col)
    passage = pa.list_(
        pa.struct(
            [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64()), ("text", pa.string())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = model.weigher()
        least = -np.log(MOST_EXPECTED)
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("score", pa.float64()), ("passages", passage)])
            scores, passages = [], []
            for text in batch.column(1).to_pylist():
                words = WORD.findall(text or "")
                found = segments(weigh(words)) if words else []
                count = len(words)
                scores.append(model.score(model.excess(count, found)))
                kept = [(a, b, s, model.evidence(count, s)) for a, b, s in found]
                kept = [x for x in kept if x[3] >= least]
                spans = [m.span() for m in WORD.finditer(text)] if kept else []
                passages.append(
                    [
                        (spans[a][0], spans[b - 1][1], s, float(np.exp(-e)), text[spans[a][0] : spans[b - 1][1]])
                        for a, b, s, e in kept
                    ]
                )
            names = [f.name for f in passage.value_type]
            shaped = [[dict(zip(names, p)) for p in row] for row in passages]
            yield batch_of(schema, [batch.column(0), scores, shaped])

    schema = T.StructType(
        [
            source.schema[id_col],
            T.StructField("score", T.DoubleType()),
            T.StructField("passages", T._parse_datatype_string(PASSAGE)),
        ]
    )
    return source.mapInArrow(run, schema)
