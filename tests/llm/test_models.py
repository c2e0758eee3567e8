"""The trained operators: held-out accuracy, odd rows and the parts that can be checked exactly."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarrysift.llm import common, langid, quality, toxicity
from quarrysift.llm.common import calibrate

DATA = "/root/testdata/sf0.01"

ODD = [(1, None), (2, ""), (3, " \n"), (4, "12 34 !!"), (5, "word " * 30_000), (6, "twice"), (6, "twice"), (None, "no id")]


def odd_docs(spark):
    rows = [(k, t, "score of another kind", "lang_pred") for k, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, label string")


def labels_of(spark, column):
    return {r.doc_id: r[column] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}


@pytest.mark.parametrize("name, column, least", [("op4_toxicity", "toxic", 0.9), ("op5_quality", "quality", 0.98)])
def test_held_out_accuracy(spark, name, column, least):
    marks = labels_of(spark, column)
    rows = entry.queries()[name](spark, DATA).collect()
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    seen = [(r.predicted, marks[r.doc_id]) for r in rows if r.held_out and r.doc_id in marks]
    assert len(seen) > 50 and sum(p == y for p, y in seen) / len(seen) >= least
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_languages(spark):
    marks = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = entry.queries()["op10_langid"](spark, DATA).collect()
    seen = [r.lang_pred == marks[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == len(marks) and sum(seen) / len(seen) >= 0.97


def test_language_of_odd_texts(spark):
    docs = spark.createDataFrame(
        [(k, t, y) for k in range(40) for t, y in ((f"the cat {k} and the dog " * 9, "en"), (f"der hund {k} und die katze " * 9, "de"))]
        + [(99, None, "en"), (98, "no language", None)],
        "doc_id long, text string, lang string",
    )
    network = langid.fit(docs)
    assert network.languages == ["de", "en"]
    rows = {(r.doc_id, r.lang_pred): r.score for r in langid.identify(odd_docs(spark), network).collect()}
    assert rows[1, "und"] == rows[2, "und"] == rows[3, "und"] == rows[4, "und"] == 0
    assert len(langid.identify(odd_docs(spark), network).collect()) == len(ODD)
    both = langid.with_language(odd_docs(spark), network).where("doc_id = 4").first()
    assert both.lang_pred.label == "und" and both.label == "lang_pred"
    right = langid.identify(docs.where("lang IS NOT NULL AND text IS NOT NULL"), network)
    good = right.where("lang_pred = 'en'").count(), right.where("lang_pred = 'de'").count()
    assert good == (40, 40)
    nothing = langid.fit(docs.limit(0))
    assert nothing is None
    assert {r.lang_pred for r in langid.identify(odd_docs(spark), nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0), network).collect() == []


def test_folded_tables_equal_the_plain_network():
    rng = np.random.default_rng(1)
    windows = np.concatenate([langid.windows_of(rng.integers(97, 122, 700, dtype=np.uint8).tobytes()) for _ in range(5)])
    network = langid.train(windows, np.arange(len(windows)) % 2, ["a", "b"])
    found = network.probabilities(windows, network.tables())
    for row, window in zip(found, windows):
        peaks = []
        for width in langid.WIDTHS:
            taps = network.taps[width]
            values = [sum(taps[k][window[i + k]] for k in range(width)) for i in range(langid.WINDOW)]
            peaks.append(np.max(values, axis=0))
        hidden = np.maximum(np.concatenate(peaks) + network.bias, 0)
        assert np.allclose(row, langid.softmax((hidden @ network.out + network.out_bias)[None])[0], atol=1e-4)


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_of_odd_texts(spark, module, column):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(60)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(
        [(k, "good words here " * 5 if k % 2 else "bad !!! $$$ words " * 5) for k in range(60)] + [(7, None)],
        "doc_id long, text string",
    )
    model = module.fit(docs, labels)
    rows = module.score(odd_docs(spark), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 6}) == 1
    scores = {r.doc_id: r.score for r in module.score(docs.where("doc_id IN (10, 11)"), model).collect()}
    assert scores[11] > 0.5 > scores[10]
    for none in (labels.limit(0), labels.where("doc_id < 0")):
        assert {r.score for r in module.score(docs, module.fit(docs, none)).collect()} == {0.5}
    assert module.score(docs.limit(0), model).collect() == []


def test_dual_descent_separates():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 50, 9)) for _ in range(200)]
    signs = np.array([1.0 if (r < 10).sum() > 1 else -1.0 for r in rows])
    values = [np.ones(len(r)) for r in rows]
    weights = quality.dual_descent(rows, values, signs, np.full(200, 10.0))
    margins = np.array([v @ weights[r] + weights[-1] for r, v in zip(rows, values)])
    assert ((margins > 0) == (signs > 0)).mean() > 0.95


def all_segments(w):
    """The segment of the highest score, the shortest of such, and then the same on either side."""
    found = []

    def cut(a, b):
        sums = [(sum(w[i:j]), i - j, -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        best = max(sums, default=(0,))
        if best[0] > 0:
            _, _, _, i, j = best
            cut(a, i)
            found.append((i, j, round(best[0], 6)))
            cut(j, b)

    cut(0, len(w))
    return found


def test_segments_against_brute_force():
    random.seed(6)
    for _ in range(800):
        w = [random.choice([-3.1, -2.07, -1.03, 1.01, 2.05, 3.3]) + random.random() * 1e-3 for _ in range(random.randint(0, 12))]
        assert [(a, b, round(s, 6)) for a, b, s in toxicity.segments(np.array(w))] == all_segments(w)


def test_passages_have_their_place(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    clean = [f"calm word{k % 17} talk about tea " * 6 for k in range(200)]
    texts = [t + ("you Vileword now" if k % 2 else "") for k, t in enumerate(clean)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = toxicity.fit(docs, labels)
    row = toxicity.score(docs.where("doc_id = 5"), model).first()
    assert row.passages and all(texts[5][p.start : p.end] == p.text for p in row.passages)
    assert any("Vileword" in p.text for p in row.passages)
    assert toxicity.score(docs.where("doc_id = 4"), model).first().passages == []


def test_rate_of_the_extreme_value_law():
    values, shares = np.array([-1.0, 1.0]), np.array([0.75, 0.25])
    assert toxicity.karlin_rate(values, shares) == pytest.approx(np.log(3))


def test_calibration():
    x = np.linspace(-3, 3, 400)
    y = (np.random.default_rng(1).random(400) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(int)
    slope, shift = calibrate(x, y, np.ones(400))
    assert 1.2 < slope < 3 and -2 < shift < 0


def test_copies_of_one_text_cut_no_class(spark, monkeypatch):
    """Copies of a clean text beyond any limit, which a hash of texts takes whole, leave the toxic ones in."""
    monkeypatch.setattr(toxicity, "CALIBRATED_PER_CLASS", 40)
    monkeypatch.setattr(quality, "TRAINED_PER_CLASS", 40)
    monkeypatch.setattr(langid, "WINDOWS_PER_LANGUAGE", 80)
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / 1_000_003
    alike = spark.range(100_000).select(F.concat(F.lit("calm talk about tea number "), "id").alias("text"))
    alike = alike.where((place < 0.015) & (F.pmod(F.xxhash64("text"), F.lit(999_983)) / 999_983 < 0.02)).first().text
    rows = [(k, alike if k < 1500 else f"calm word{k % 17} talk of tea {k}", 0) for k in range(2000)]
    rows += [(k, f"you vileword now{k % 13} !!! {k}", 1) for k in range(2000, 2300)]
    rows = spark.createDataFrame(rows, "doc_id long, text string, y int")
    labels = rows.select("doc_id", F.col("y").alias("toxic"), F.col("y").alias("quality"))
    for module, column in ((toxicity, "toxic"), (quality, "quality")):
        sample = common.labelled_sample(rows, labels, column, 20_000)
        got = common.of_each_class(sample, (2000, 300), 40, lambda x: x.select("h", "y", "x")).to_pylist()
        assert collections.Counter(r["y"] for r in got) == {0: 40, 1: 40}
        assert 0 < sum(r["x"] == alike for r in got) < 40
        model = module.fit(rows, labels)
        scores = {r.doc_id: r.score for r in module.score(rows.where("doc_id IN (3, 1600, 2100)"), model).collect()}
        assert scores[2100] > 0.5 > max(scores[3], scores[1600])
    tongues = rows.withColumn("lang", F.when(F.col("y") == 1, "vi").otherwise("ca"))
    _, label, names = langid.sample_windows(tongues, "text", "lang", "doc_id")
    assert names == ["ca", "vi"] and 0 < (label == 0).sum() <= 160 and 0 < (label == 1).sum() <= 160


def test_labels_repeated_cut_no_class(spark):
    """An id labelled very often is sampled label by label, and equal rows never empty a class."""
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(200)], "doc_id long, text string")
    labels = [(5, 0)] * 5000 + [(k, k % 2) for k in range(200)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = collections.Counter((r.y, r.x == "text 5") for r in common.labelled_sample(docs, labels, "toxic", 50).collect())
    assert got[0, True] + got[0, False] == 50 and got[0, True] > 30 and got[1, False] + got[1, True] == 50
    same = docs.limit(1).select(F.lit("x").alias("x"), F.lit(1).alias("y"), F.lit(1_000_002).cast("long").alias("h"))
    same = same.crossJoin(spark.range(900).select()).select("x", "y", "h")
    assert len(common.of_each_class(same, (0, 900), 10, lambda x: x)) == 10


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    monkeypatch.setattr(langid, "WINDOWS_PER_LANGUAGE", 60)
    words = {"de": "der hund und die katze ", "en": "the cat and the dog ", "ru": "кот и собака "}
    rows = [(k, f"{w}{k} " * 9, y) for y, w in words.items() for k in range(20 if y == "ru" else 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    windows, label, names = langid.sample_windows(docs, "text", "lang", "doc_id")
    assert names == ["de", "en", "ru"] and set(label.tolist()) == {0, 1, 2} and len(windows) <= 2 * 2 * 60


def test_all_segments_of_a_long_text_count(spark):
    """The curve sees what the score sees, however many segments a text has."""
    model = toxicity.ToxicityModel({"vile": (4.0, 3.5)}, 1.0, 1e-4, 1.0, 0.0)
    text = ("vile " + "plain " * 12) * 400
    rows = spark.createDataFrame([(text, 1, 5), ("plain", 0, 6)], "x string, y int, h long")
    seen = {r["y"]: r for r in toxicity.observe(rows, model).collect()}
    weights = model.weigher()(toxicity.WORD.findall(text))
    found = toxicity.segments(weights)
    assert len(found) == 400 and seen[1]["excess"] == pytest.approx(model.excess(len(weights), found)) and seen[0]["excess"] == 0
    assert seen[1]["best"] == pytest.approx(4.0 - toxicity.DRIFT)


def test_all_firm_features_are_kept(spark):
    counts = spark.range(120_000).select(F.concat(F.lit("w"), "id").alias("f"), F.lit(0).alias("n0"), F.lit(900).alias("n1"))
    assert len(toxicity.telling(counts, (1000, 1000))) == 120_000


def test_no_held_out_label_is_read(spark, tmp_path):
    """Other labels of the rows held out change no score."""
    import shutil

    import __spark_entry__ as entry

    data = "/root/testdata/sf0.001"
    for name in ("documents", "labels"):
        shutil.copy(f"{data}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = sorted(map(tuple, entry.queries()["op4_toxicity"](spark, str(tmp_path)).collect()))
    labels = spark.read.parquet(f"{data}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = tmp_path / "other"
    other.mkdir()
    shutil.copy(f"{data}/documents.parquet", other / "documents.parquet")
    turned.write.parquet(str(other / "labels.parquet"))
    assert sorted(map(tuple, entry.queries()["op4_toxicity"](spark, str(other)).collect())) == first


def plain_toxicity(model, text):
    """The score of a text by its definition: every word weighed, all maximal segments, their evidence beyond chance."""
    weights = []
    for word in toxicity.WORD.findall(text or ""):
        low = word.lower()
        known = [model.weights[low[:n] + "*"] for n in toxicity.BEGINNINGS if low[:n] + "*" in model.weights and len(low) >= n]
        own = model.weights[low][0] if low in model.weights else max(known, key=lambda x: x[1])[0] if known else 0.0
        weights.append(own - toxicity.DRIFT)
    total = 0.0
    for _, _, s in all_segments(weights) if weights else []:
        evidence = model.rate * s - np.log(model.scale * len(weights))
        total += evidence if evidence >= -np.log(toxicity.MOST_EXPECTED) else 0.0
    return 1 / (1 + np.exp(-np.clip(model.slope * np.log1p(total) + model.shift, -40, 40)))


def test_whole_toxicity_scores_by_brute_force(spark):
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{data}/labels.parquet"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if len(r["text"] or "") < 3000}
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all(found[k] == pytest.approx(plain_toxicity(model, t)) for k, t in texts.items()) and len(texts) > 100


def test_whole_shapes_of_long_words():
    shape = quality.Features.shape
    assert shape("aB1-aB1-aB1-aB1") == "aA0-aA0-aA0-aA0" and shape("aB1-aB1-aB1-aB1") != shape("aB1-aB1-aB1-")
    features = quality.Features()
    assert set(features("aB1-aB1-aB1-aB1")) != set(features("aB1-aB1-aB1-xB1"))


def test_dual_descent_closes_the_gap():
    """The dual value reaches the primal one: the optimum, and not just some separation."""
    rng = np.random.default_rng(5)
    sets = [np.sort(rng.choice(60, rng.integers(1, 12), replace=False)) for _ in range(80)]
    values = [rng.normal(size=len(s)) for s in sets]
    signs = np.where(rng.random(80) < 0.5, 1.0, -1.0)
    for penalty in (0.05, 1.0):
        cost = np.full(80, penalty)
        weights = quality.dual_descent(sets, values, signs, cost)
        margin = np.array([v @ weights[s] + weights[quality.FEATURES] for s, v in zip(sets, values)])
        primal = 0.5 * weights @ weights + (cost * np.maximum(0, 1 - signs * margin)).sum()
        x = np.zeros((80, 61))
        for row, (s, v) in enumerate(zip(sets, values)):
            x[row, s], x[row, 60] = v, 1.0
        q = (x * signs[:, None]) @ (x * signs[:, None]).T
        alpha = np.zeros(80)
        for _ in range(4000):
            for i in range(80):
                alpha[i] = np.clip(alpha[i] - (q[i] @ alpha - 1) / q[i, i], 0, penalty)
        best = alpha.sum() - 0.5 * alpha @ q @ alpha
        assert -1e-6 <= primal - best <= 2 * quality.MOST_GAP * max(1.0, best)


def test_languages_named_by_numbers(spark):
    rows = [(i, f"{'der hund und die katze' if i % 2 else 'le chien et le chat'} {i}", i % 2) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang int")
    found = {(r["doc_id"] % 2, r["lang_pred"]) for r in langid.identify(docs, langid.fit(docs, "text", "lang")).collect()}
    assert found == {(0, "0"), (1, "1")}
