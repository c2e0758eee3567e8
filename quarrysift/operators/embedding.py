"""Turning chunk texts into vectors."""

from __future__ import annotations

import functools
import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import as_float32
from .skew import hot_keys, lookup_join

#: Most texts sent to a model in one request.
MAX_BATCH = 64
#: Most attempts of one request.
MAX_ATTEMPTS = 6

# Letters are counted in this many bytes of text at a time; what that needs is some 40 times as much.
_BYTES_AT_ONCE = 1 << 18
# Keys of texts that a task remembers; those it has forgotten are dropped after the shuffle.
_KEYS_REMEMBERED = 1 << 15

CACHE_SCHEMA = "text_key string, embedding array<float>"


class Embedder:
    """What an embedder offers. Vectors are expected to have unit length.

    Subclasses give either :meth:`add_column`, which stays inside Spark, or
    :meth:`embed`, which runs in tasks on batches of texts. ``memo`` asks for
    equal texts to be embedded once.
    """

    name = "embedder"
    memo = False
    min_interval_ms = 0

    def add_column(self, rows: DataFrame, text: str, **params: Any) -> DataFrame | None:
        return None

    def embed(self, texts: list[str], **params: Any) -> Sequence[Sequence[float]]:
        raise NotImplementedError

    def fingerprint(self, params: dict[str, Any]) -> str:
        return f"{self.name}|{sorted(params.items())}"


class LetterEmbedder(Embedder):
    """Letter frequencies of the lower-cased text, 26 numbers. For tests and demos."""

    name = "letters"

    def add_column(self, rows: DataFrame, text: str, **params: Any) -> DataFrame:
        @F.arrow_udf("array<float>")
        def letters(texts: pa.Array) -> pa.Array:
            shares = _letter_shares(texts).astype(np.float32)
            ends = np.arange(0, shares.size + 1, 26, dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(shares.ravel()))

        return rows.withColumn("embedding", letters(F.col(text)))

    def embed(self, texts: list[str], **params: Any) -> list[np.ndarray]:
        return list(_letter_shares(pa.array(texts, pa.string())))


def _letter_shares(texts: pa.Array) -> np.ndarray:
    """One row of 26 numbers per text, counted over some bytes at a time, however long or many the texts are."""
    counts = np.zeros((len(texts), 26), np.int64)
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    first = 0
    while first < len(texts):
        # As many texts as fit, and one at least.
        last = max(first + 1, int(np.searchsorted(total, total[first] + _BYTES_AT_ONCE, "right")) - 1)
        lower = pc.utf8_lower(texts.slice(first, last - first).fill_null("")).cast(pa.large_binary())
        ends = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset : lower.offset + len(lower) + 1]
        data = np.frombuffer(lower.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        for at in range(0, len(data), _BYTES_AT_ONCE):
            letter = data[at : at + _BYTES_AT_ONCE] - np.uint8(ord("a"))
            kept = letter < 26
            bounds = np.clip(ends - ends[0] - at, 0, len(letter))
            owner = np.repeat(np.arange(len(lower)), np.diff(bounds))[kept]
            found = np.bincount(owner * 26 + letter[kept], minlength=26 * len(lower))
            counts[first:last] += found.reshape(-1, 26)
        first = last
    return counts / np.maximum(np.sqrt((counts * counts).sum(axis=1)), 1e-9)[:, None]


class HashEmbedder(Embedder):
    """Hashed counts of words and identifier parts, scaled to unit length.

    The default where no model is installed. All of it runs inside the JVM on
    sparse vectors, so no text leaves it.
    """

    def __init__(self, dim: int = 256) -> None:
        self.dim = dim
        self.name = f"hash-{dim}"

    def add_column(self, rows: DataFrame, text: str, **params: Any) -> DataFrame:
        apart = F.lower(F.regexp_replace(text, r"(?<=\p{Ll})(?=\p{Lu})", " "))
        words = F.regexp_extract_all(apart, F.lit(r"\p{L}+|\p{N}+"), F.lit(0))
        hashing = HashingTF(
            inputCol="__words", outputCol="__hashed", numFeatures=self.dim
        )
        scaling = Normalizer(inputCol="__hashed", outputCol="__scaled")
        scaled = scaling.transform(hashing.transform(rows.withColumn("__words", words)))
        vector = vector_to_array(F.col("__scaled"), "float32")
        return scaled.withColumn("embedding", vector).drop("__words", "__hashed", "__scaled")


class TransformerEmbedder(Embedder):
    """A local sentence-transformers model, where that package is installed."""

    memo = True

    def __init__(self, model: str) -> None:
        self.model = model.removeprefix("sbert/")
        self.name = f"sentence-transformers/{self.model}"

    def embed(self, texts: list[str], **params: Any) -> Sequence[Sequence[float]]:
        model = _load_model(self.model)
        return model.encode(texts, normalize_embeddings=True, **params)


@functools.lru_cache(maxsize=2)
def _load_model(name: str):
    # Once per Python worker.
    from sentence_transformers import SentenceTransformer

    return SentenceTransformer(name)


# What a service says when it asks for a pause, and the units it uses in seconds.
_PAUSE = re.compile(r"please try again in (?P<amount>[0-9.]+)(?P<unit>ms|s)", re.IGNORECASE)
_UNIT_SECONDS = {"ms": 0.001, "s": 1.0}


def pause_before_retry(fault: str, failures: int) -> float | None:
    """Seconds to wait after ``failures`` earlier ones of the same request; None: do not repeat it.

    Only rate limits are worth a repetition. A pause that the service names comes before
    the own one, half a second and double that after each further failure; both with
    a tenth of a second on top, and never more than ten seconds.
    """
    if "rate limit" not in fault.casefold():
        return None
    named = _PAUSE.search(fault)
    seconds = 0.5 * (1 << failures)
    if named is not None:
        try:
            seconds = float(named["amount"]) * _UNIT_SECONDS[named["unit"].lower()]
        except ValueError:
            pass
    return min(10.0, seconds + 0.1)


class RemoteEmbedder(Embedder):
    """An embedding service behind ``call(texts, **params)``, paced and retried."""

    memo = True

    def __init__(
        self,
        name: str,
        call: Callable[..., Sequence[Sequence[float]]],
        min_interval_ms: int = 5,
        sleep: Callable[[float], None] = time.sleep,
    ) -> None:
        self.name = name
        self.call = call
        self.min_interval_ms = max(0, min_interval_ms)
        self.sleep = sleep

    def embed(self, texts: list[str], **params: Any) -> Sequence[Sequence[float]]:
        for attempt in range(MAX_ATTEMPTS):
            try:
                return self.call(texts, **params)
            except Exception as exc:
                pause = pause_before_retry(str(exc), attempt)
                if pause is None or attempt + 1 == MAX_ATTEMPTS:
                    raise
                self.sleep(pause)
        raise AssertionError("unreachable")


@dataclass(frozen=True)
class Params:
    """Extra arguments of ``embed``: for chunks and for queries.

    ``by_habit`` tells that the query's were not given but are those the model always had.
    """

    indexing: dict[str, Any] = field(default_factory=dict)
    query: dict[str, Any] = field(default_factory=dict)
    by_habit: bool = False


# Accepted parameters per provider.
ACCEPTED_PARAMS = {
    "sentence-transformers": ["prompt_name"],
    "litellm": ["input_type"],
    "hash": [],
    "letters": [],
}

# Query parameters of models that had one before parameters existed.
HABITUAL_QUERY_PARAMS = {
    ("sentence-transformers", "nomic-ai/nomic-embed-code"): {"prompt_name": "query"},
    ("sentence-transformers", "nomic-ai/CodeRankEmbed"): {"prompt_name": "query"},
}

# Recommended parameters as (provider, model pattern, indexing, query); the first match counts.
RECOMMENDED_PARAMS = [
    ("sentence-transformers", r"nomic-ai/CodeRankEmbed", {}, {"prompt_name": "query"}),
    ("sentence-transformers", r"nomic-ai/nomic-embed-code", {}, {"prompt_name": "query"}),
    ("sentence-transformers", r"nomic-ai/nomic-embed-text-v1", {"prompt_name": "passage"}, {"prompt_name": "query"}),
    ("sentence-transformers", r"nomic-ai/nomic-embed-text-v1\.5", {"prompt_name": "passage"}, {"prompt_name": "query"}),
    ("sentence-transformers", r"mixedbread-ai/mxbai-embed-large-v1", {}, {"prompt_name": "query"}),
    ("sentence-transformers", r"Snowflake/snowflake-arctic-embed-.+", {}, {"prompt_name": "query"}),
    (
        "litellm",
        r"cohere/embed-(english|multilingual)(-light)?-v3\.0",
        {"input_type": "search_document"},
        {"input_type": "search_query"},
    ),
    ("litellm", r"voyage/.+", {"input_type": "document"}, {"input_type": "query"}),
    ("litellm", r"nvidia_nim/nvidia/.+", {"input_type": "passage"}, {"input_type": "query"}),
    (
        "litellm",
        r"gemini/(gemini-embedding|text-embedding|embedding)[-\w.]*",
        {"input_type": "RETRIEVAL_DOCUMENT"},
        {"input_type": "RETRIEVAL_QUERY"},
    ),
]


def recommended_params(provider: str, model: str) -> tuple[dict | None, dict | None]:
    """Recommended (indexing, query) parameters; (None, None) for unknown models."""
    for known, pattern, indexing, query in RECOMMENDED_PARAMS:
        if known == provider and re.fullmatch(pattern, model):
            return dict(indexing), dict(query)
    return None, None


def recommended_rules(spark: SparkSession) -> DataFrame:
    """The recommended parameters as a rule table of :func:`quarrysift.operators.rules.match_patterns`."""
    rows = [(n, *entry) for n, entry in enumerate(RECOMMENDED_PARAMS)]
    return spark.createDataFrame(
        rows, "ordinal bigint, provider string, pattern string, indexing map<string,string>, query map<string,string>"
    )


def resolve_params(
    provider: str, model: str, indexing: dict | None = None, query: dict | None = None
) -> Params:
    """The parameters to use, from what the user set; None stands for nothing set at all."""
    accepted = ACCEPTED_PARAMS.get(provider)
    if accepted is None:
        raise ValueError(f"no embedding provider is called {provider!r}")
    faults = [
        f"{side} parameter {name!r} is not one that {provider} takes"
        for side, given in (("indexing", indexing), ("query", query))
        for name in given or {}
        if name not in accepted
    ]
    if faults:
        raise ValueError("; ".join(faults))
    habit = HABITUAL_QUERY_PARAMS.get((provider, model)) if indexing is None and query is None else None
    return Params(indexing=dict(indexing or {}), query=dict(habit or query or {}), by_habit=habit is not None)


def create_embedder(
    provider: str, model: str, call: Callable[..., Sequence[Sequence[float]]] | None = None, min_interval_ms: int | None = None
) -> Embedder:
    """The embedder that settings name. Services need ``call``, the request to make."""
    if provider == "letters":
        return LetterEmbedder()
    if provider == "hash":
        digits = re.search(r"\d+", model or "")
        return HashEmbedder(int(digits[0]) if digits else 256)
    if provider == "sentence-transformers" or model.startswith("sbert/"):
        return TransformerEmbedder(model)
    if provider == "litellm" and call is None:
        call = functools.partial(_call_litellm, model)
    if call is None:
        raise ValueError(f"provider {provider!r} needs the request to make")
    return RemoteEmbedder(f"{provider}/{model}", call, 5 if min_interval_ms is None else min_interval_ms)


def _call_litellm(model: str, texts: list[str], **params: Any) -> list[list[float]]:
    # The package is looked for when a request is made, on the machine that makes it.
    import litellm

    return [row["embedding"] for row in litellm.embedding(model=model, input=texts, **params).data]


def embed_texts(rows: DataFrame, embedder: Embedder, text: str, **params: Any) -> DataFrame:
    """``rows`` with an ``embedding`` column, without any shuffle of its own."""
    column_form = embedder.add_column(rows, text, **params)
    if column_form is not None:
        return column_form
    pause = embedder.min_interval_ms / 1000.0
    if pause:
        # All tasks that can run at once share the rate: each waits that much longer.
        pause *= rows.sparkSession.sparkContext.defaultParallelism

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        next_at = 0.0
        for part in parts:
            vectors: list[np.ndarray] = []
            for i in range(0, len(part), MAX_BATCH):
                if pause:
                    time.sleep(max(0.0, next_at - time.monotonic()))
                    next_at = time.monotonic() + pause
                found = embedder.embed(part.iloc[i : i + MAX_BATCH].tolist(), **params)
                vectors.extend(np.asarray(v, dtype=np.float32) for v in found)
            yield pd.Series(vectors, dtype=object)

    return rows.withColumn("embedding", run(F.col(text)))


def with_text_key(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the key under which the vector of a text is kept."""
    return rows.withColumn("text_key", F.sha2(F.col(text), 256))


def distinct_texts(rows: DataFrame, text: str) -> DataFrame:
    """One row (``text_key``, ``__text``) per key.

    Each task drops what it has seen of late, so a text that many rows share moves a few times
    per task; after the shuffle by key Spark leaves one of each. Neither holds all keys of a task in memory.
    """
    narrow = rows.select("text_key", F.col(text).alias("__text"))
    once = narrow.mapInArrow(_first_seen, narrow.schema)
    # The aggregate takes the shuffle as it is: texts are sorted by key where they have come to, and may spill.
    return once.repartition("text_key").groupBy("text_key").agg(F.any_value("__text").alias("__text"))


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose first column has not been seen of late."""
    seen: set[str] = set()
    for batch in batches:
        fresh = []
        for key in batch.column(0).to_pylist():
            fresh.append(key not in seen)
            seen.add(key)
            if len(seen) >= _KEYS_REMEMBERED:
                seen.clear()
        yield batch.filter(pa.array(fresh, pa.bool_()))


def embed_once(
    rows: DataFrame,
    embedder: Embedder,
    text: str,
    have: DataFrame | None,
    target: str,
    **params: Any,
) -> DataFrame:
    """As :func:`embed_texts` for rows with a ``text_key``, each text once.

    ``have`` holds (``text_key``, ``embedding``) of earlier runs; what it lacks
    is embedded and written to the new folder ``target``. ``rows`` is read several
    times, so it should be a stored table. A text that many rows share is one
    row until the final join, where its hot key is split.
    """
    spark = rows.sparkSession
    missing = distinct_texts(rows, text)
    if have is not None:
        missing = missing.join(have, "text_key", "left_anti")
    new = embed_texts(missing, embedder, "__text", **params).select("text_key", "embedding")
    new.write.mode("overwrite").parquet(target)
    vectors = spark.read.schema(CACHE_SCHEMA).parquet(target)
    if have is not None:
        vectors = have.unionByName(vectors)
    hot = hot_keys(rows, "text_key")
    salt = [c for c in rows.columns if c != text]
    return lookup_join(rows, vectors, "text_key", hot=hot, salt=salt).drop("text_key")


def embed_query(
    spark: SparkSession, embedder: Embedder, query: str, **params: Any
) -> list[float]:
    """The vector of one query text, as stored vectors are: 32-bit floats."""
    if type(embedder).embed is not Embedder.embed:
        return as_float32(embedder.embed([query], **params)[0])
    row = spark.createDataFrame([(query,)], "q string")
    return as_float32(embed_texts(row, embedder, "q", **params).first()["embedding"])


def check_embedder(spark: SparkSession, embedder: Embedder, **params: Any) -> tuple[int | None, str]:
    """(dimension, "") or (None, one-line error); never raises."""
    try:
        return len(embed_query(spark, embedder, "hello world", **params)), ""
    except Exception as exc:
        lines = str(exc).splitlines() or [type(exc).__name__]
        return None, lines[0][:500]
