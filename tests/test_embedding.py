import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrysift.functions.text import rate_limit_delay
from quarrysift.operators import embedding as emb
from quarrysift.operators import skew
from quarrysift.session import scratch_dir


class Counting(emb.Embedder):
    """Vectors by text length; fails on a text it must not see."""

    name = "counting"
    memo = True

    def embed(self, texts, **params):
        assert len(texts) <= emb.MAX_BATCH and "never" not in texts
        return [[float(len(t)), float(params.get("add", 0))] for t in texts]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


def test_python_embedder_batches_and_takes_params(spark):
    rows = emb.embed_texts(frame(spark, ["x" * (i % 90 + 1) for i in range(500)]), Counting(), "t", add=2)
    out = rows.orderBy("i").collect()
    assert [r["embedding"] for r in out] == [[float(i % 90 + 1), 2.0] for i in range(500)]


def test_hash_embedder_has_unit_length_and_meaning(spark):
    texts = ["def fibonacci(n): return n", "compute fibonacciNumbers", "database connection", ""]
    rows = emb.embed_texts(frame(spark, texts), emb.HashEmbedder(128), "t").orderBy("i").collect()
    vectors = np.array([r["embedding"] for r in rows])
    assert vectors.shape == (4, 128)
    assert np.allclose(np.linalg.norm(vectors, axis=1), [1, 1, 1, 0], atol=1e-6)
    query = np.array(emb.embed_query(spark, emb.HashEmbedder(128), "Fibonacci"))
    assert vectors[0] @ query > 0.2 > vectors[2] @ query


def test_letters(spark):
    row = emb.embed_texts(frame(spark, ["aAb"]), emb.LetterEmbedder(), "t").first()
    assert row["embedding"][:3] == pytest.approx([2 / math.sqrt(5), 1 / math.sqrt(5), 0.0])
    assert emb.check_embedder(spark, emb.LetterEmbedder()) == (26, "")


def test_letters_need_little_memory_beside_their_texts():
    texts = pa.array(["abcé z" * 500] * 3_000 + [None, "", "xyzA" * 1_000_000])
    tracemalloc.start()
    shares = emb._letter_shares(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The texts have 14 MB.
    assert peak < 30e6
    assert shares[:3_000, [0, 1, 2, 25]].tolist() == [[0.5] * 4] * 3_000
    assert not shares[3_000:3_002].any() and shares[-1, [0, 23, 24, 25]].tolist() == [0.5] * 4


def test_each_text_is_embedded_once(spark):
    target, second = scratch_dir(spark, "v"), scratch_dir(spark, "v")
    rows = frame(spark, ["aa", "b", "aa", "aa", "ccc"])
    done = emb.embed_once(emb.with_text_key(rows, "t"), Counting(), "t", None, target).orderBy("i").collect()
    assert [r["embedding"][0] for r in done] == [2.0, 1.0, 2.0, 2.0, 3.0]
    cache = spark.read.schema(emb.CACHE_SCHEMA).parquet(target)
    assert cache.count() == 3
    more = frame(spark, ["b", "dddd", "aa"])
    done = emb.embed_once(emb.with_text_key(more, "t"), Counting(), "t", cache, second).orderBy("i").collect()
    assert [r["embedding"][0] for r in done] == [1.0, 4.0, 2.0]
    assert spark.read.parquet(second).count() == 1


def test_distinct_texts_need_no_memory_of_all_keys(spark, monkeypatch):
    monkeypatch.setattr(emb, "_KEYS_REMEMBERED", 3)
    keys = pa.array(["a", "b", "a", "c", "a", "a", None, None])
    batch = pa.RecordBatch.from_arrays([keys], names=["text_key"])
    assert list(emb._first_seen([batch]))[0]["text_key"].to_pylist() == ["a", "b", "c", "a", None]
    monkeypatch.undo()
    # Only dropping what was seen of late runs in Python; what is left of it is dropped by Spark.
    rows = emb.with_text_key(frame(spark, ["x", "y", None, "x", None, "z", "x"]), "t").repartition(3)
    found = emb.distinct_texts(rows, "t")
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(r["__text"] or "" for r in found.collect()) == ["", "x", "y", "z"]


def test_hot_keys_are_split_without_losing_rows(spark):
    rows = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("bigint").alias("k")
    )
    lookup = rows.select("k").distinct().where("k % 7 <> 1").withColumn("v", F.col("k") * 2)
    hot = skew.hot_keys(rows, "k")
    assert hot == [0]
    for how in ("inner", "left"):
        split = skew.lookup_join(rows, lookup, "k", how, hot)
        plain = rows.join(lookup, "k", how)
        assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


@pytest.mark.parametrize(
    "message, attempt, delay",
    [
        ("Rate limit reached. Please try again in 250ms", 0, 0.35),
        ("rate LIMIT: please try again in 2s.", 3, 2.1),
        ("rate limit", 0, 0.6),
        ("rate limit", 3, 4.1),
        ("rate limit", 9, 10.0),
        ("Rate limit. Please try again in 60s", 0, 10.0),
        ("boom", 0, None),
    ],
)
def test_retry_delay(spark, message, attempt, delay):
    assert emb.pause_before_retry(message, attempt) == (None if delay is None else pytest.approx(delay))
    row = spark.range(1).select(rate_limit_delay(F.lit(message), F.lit(attempt))).first()[0]
    assert row == (None if delay is None else pytest.approx(delay))


def test_remote_calls_are_retried():
    waits, calls = [], []

    def call(texts):
        calls.append(texts)
        if len(calls) < 3:
            raise RuntimeError("Rate limit reached. Please try again in 250ms")
        return [[1.0]] * len(texts)

    remote = emb.RemoteEmbedder("r", call, 0, waits.append)
    assert remote.embed(["a", "b"]) == [[1.0], [1.0]] and waits == [0.35, 0.35]

    def broken(texts):
        raise ValueError("bad key\nmore")

    with pytest.raises(ValueError):
        emb.RemoteEmbedder("r", broken, 0, waits.append).embed(["a"])
    assert emb.check_embedder(None, emb.RemoteEmbedder("r", broken)) == (None, "bad key")

    def limited(texts):
        calls.append(1)
        raise RuntimeError("rate limit")

    calls.clear()
    with pytest.raises(RuntimeError):
        emb.RemoteEmbedder("r", limited, 0, waits.append).embed(["a"])
    assert len(calls) == emb.MAX_ATTEMPTS


def test_params():
    known = emb.recommended_params
    assert known("sentence-transformers", "nomic-ai/CodeRankEmbed") == ({}, {"prompt_name": "query"})
    assert known("litellm", "voyage/voyage-code-3") == ({"input_type": "document"}, {"input_type": "query"})
    assert known("litellm", "cohere/embed-english-light-v3.0")[0] == {"input_type": "search_document"}
    assert known("litellm", "nomic-ai/CodeRankEmbed") == (None, None)
    assert known("sentence-transformers", "xnomic-ai/CodeRankEmbed") == (None, None)
    legacy = emb.resolve_params("sentence-transformers", "nomic-ai/CodeRankEmbed")
    assert legacy.query == {"prompt_name": "query"} and legacy.by_habit
    opted_out = emb.resolve_params("sentence-transformers", "nomic-ai/CodeRankEmbed", None, {})
    assert opted_out.query == {} and not opted_out.by_habit
    with pytest.raises(ValueError, match="is not one that litellm takes"):
        emb.resolve_params("litellm", "m", {"prompt_name": "x"})
    with pytest.raises(ValueError, match="no embedding provider"):
        emb.resolve_params("nope", "m")
    assert isinstance(emb.create_embedder("hash", "hash-64"), emb.HashEmbedder)
    assert emb.create_embedder("x", "sbert/abc").model == "abc"
