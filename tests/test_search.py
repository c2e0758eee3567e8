import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrysift.functions.vectors import as_float32, checked_distance, l2_distance, l2_to_score
from quarrysift.operators.search import SearchSpec, report, search, top

SCHEMA = (
    "id bigint, file_path string, language string, content string, start_line int, "
    "end_line int, embedding array<float>"
)
UNITS = np.eye(4).tolist()


@pytest.fixture(scope="module")
def chunks(spark):
    names = [("src/main.py", "python"), ("src/util.py", "python"), ("lib/db.py", "python"), ("lib/api.rs", "rust")]
    rows = [(i, p, lang, f"text {i}", 1, 5, UNITS[i]) for i, (p, lang) in enumerate(names)]
    return spark.createDataFrame(rows, SCHEMA).cache()


def paths(frame):
    return [r["file_path"] for r in frame.collect()]


def test_path_filter_gives_real_distances(chunks):
    rows = top(chunks, SearchSpec(UNITS[0], 10, paths=["src/*"])).collect()
    assert [r["file_path"] for r in rows] == ["src/main.py", "src/util.py"]
    assert rows[0]["distance"] == 0.0 and rows[0]["score"] == 1.0
    assert rows[1]["score"] == pytest.approx(0.0, abs=1e-12)


def test_filters_and_pages(chunks):
    assert paths(top(chunks, SearchSpec(UNITS[2], 5, languages=["python"], paths=["lib/*"]))) == ["lib/db.py"]
    assert paths(top(chunks, SearchSpec(UNITS[3], 4)))[0] == "lib/api.rs"
    assert len(paths(top(chunks, SearchSpec(UNITS[3], 4)))) == 4
    assert paths(top(chunks, SearchSpec(UNITS[3], 4, languages=["rust"]))) == ["lib/api.rs"]
    assert paths(top(chunks, SearchSpec(UNITS[0], 4, languages=["Rust"]))) == []
    assert len(paths(top(chunks, SearchSpec(UNITS[0], 9, languages=[], paths=[])))) == 4
    # Ties at the same distance come in id order, so pages do not overlap.
    pages = [paths(top(chunks, SearchSpec(UNITS[0], 1, offset=i)))[0] for i in range(4)]
    assert pages == ["src/main.py", "src/util.py", "lib/db.py", "lib/api.rs"]
    twice = SearchSpec(UNITS[0], 9, languages=["python", "python"])
    assert len(paths(top(chunks, twice))) == 3


def test_search_returns_the_six_columns(chunks):
    found = search(chunks, SearchSpec(UNITS[1], 2))
    assert found.columns == ["file_path", "language", "content", "start_line", "end_line", "score"]
    assert found.first()["content"] == "text 1"
    empty = search(chunks, SearchSpec(UNITS[1], 2, languages=["none"]))
    assert empty.columns == found.columns and empty.count() == 0
    line = report(search(chunks, SearchSpec(UNITS[1], 2), ranked=True)).first()
    assert line["heading"] == "--- Result 1 (score: 1.000) ---"
    assert line["place"] == "File: src/util.py:1-5 [python]"


@pytest.mark.parametrize("vector", [None, [1.0, 0.0]])
def test_missing_or_short_vectors_fail_loudly(spark, vector):
    rows = spark.createDataFrame([(1, "bad.py", "python", "x", 1, 1, vector)], SCHEMA)
    with pytest.raises(Exception, match="no distance .*bad.py"):
        top(rows, SearchSpec(UNITS[0], 1)).collect()
    distance = l2_distance(F.col("embedding"), F.array(*[F.lit(x) for x in UNITS[0]]))
    with pytest.raises(Exception, match="no distance .*bad.py"):
        rows.select(checked_distance(distance, F.col("file_path"), "knn")).collect()


def test_exact_against_brute_force(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(3000, 48)).astype(np.float32)
    data[100:140] = data[7]  # many equal vectors at the cut
    rows = [(i, f"p{i % 50}/f", f"l{i % 3}", "t", 1, 1, v.tolist()) for i, v in enumerate(data)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    query = (data[7] + rng.normal(size=48) * 0.01).tolist()
    target = np.asarray(as_float32(query))
    distance = np.sqrt(((data.astype(float) - target) ** 2).sum(axis=1))
    for limit, offset, langs in [(10, 0, None), (5, 30, None), (25, 20, ["l1", "l2"])]:
        keep = [i for i in range(3000) if langs is None or f"l{i % 3}" in langs]
        wanted = sorted(keep, key=lambda i: (distance[i], i))[offset : offset + limit]
        found = top(frame, SearchSpec(query, limit, offset, languages=langs or ())).collect()
        assert [r["id"] for r in found] == wanted
        assert np.allclose([r["distance"] for r in found], distance[wanted])


def test_deep_pages(spark):
    rows = spark.range(5000).select(
        "id",
        F.concat(F.lit("p"), "id").alias("file_path"),
        F.lit("x").alias("language"),
        F.array((F.col("id") % 40).cast("float"), F.lit(0).cast("float")).alias("embedding"),
    )
    order = sorted(range(5000), key=lambda i: (i % 40, i))
    for limit, offset in [(300, 0), (150, 2500), (500, 4800), (10, 6000)]:
        page = top(rows.repartition(6), SearchSpec([0.0, 0.0], limit, offset)).collect()
        assert [r["id"] for r in page] == order[offset : offset + limit]


def test_column_forms(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>")
    out = row.select(l2_distance(F.col("a"), F.col("b")), l2_to_score(F.lit(2.0))).first()
    assert out[0] == 5.0 and out[1] == -1.0


def test_plan_prunes_and_pushes_down(spark, chunks, tmp_path):
    random.seed(1)
    chunks.write.partitionBy("language").parquet(str(tmp_path / "c"))
    stored = spark.read.schema(chunks.schema).parquet(str(tmp_path / "c"))
    spec = SearchSpec(UNITS[0], 3, languages=["python"], paths=["src/*"])
    plan = top(stored.select("id", "file_path", "language", "embedding"), spec)
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "StringStartsWith(file_path,src/)" in text and "TakeOrderedAndProject" in text
    assert "PartitionFilters: [isnotnull(language" in text and "content" not in text
    assert "Exchange" not in text


@pytest.mark.parametrize("block", [3, 1000])
def test_a_table_of_queries(spark, monkeypatch, block):
    from quarrysift.functions import vectors

    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rng = np.random.default_rng(block)
    data = rng.integers(-2, 3, (60, 4)).astype(float).tolist()
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(data)] + [(99, None)], "id long, embedding array<float>").repartition(4)
    wanted = spark.createDataFrame([(i, data[i]) for i in range(0, 60, 7)] + [(500, None)], "query_id long, embedding array<float>")
    got = vectors.nearest_batch(rows, wanted, 5).collect()
    away = lambda a, b: float(np.sqrt(((np.array(a) - np.array(b)) ** 2).sum()))
    brute = [
        (q, n, i)
        for q in range(0, 60, 7)
        for n, (_, i) in enumerate(sorted((away(data[q], v), i) for i, v in enumerate(data))[:5], 1)
    ]
    assert sorted((r["query_id"], r["rank"], r["id"]) for r in got) == brute
    assert all(abs(r["score"] - (1 - r["distance"] ** 2 / 2)) < 1e-12 for r in got)
    assert len(vectors.nearest_batch(rows, wanted, 100).collect()) == 9 * 60
    assert vectors.nearest_batch(rows.limit(0), wanted, 5).collect() == [] == vectors.nearest_batch(rows, wanted.limit(0), 5).collect()
    short = rows.unionByName(spark.createDataFrame([(7, [1.0])], rows.schema))
    with pytest.raises(Exception, match="no distance for a stored vector"):
        vectors.nearest_batch(short, wanted, 5).collect()
