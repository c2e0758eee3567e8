import hashlib

import numpy as np
import public_tokenizers
import tokenizers
from test_exact import brute_components, brute_hits

import corpus_pipeline
from quarrysift.llm import decontam, langid, neardup, quality

DATA = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    odd = spark.createDataFrame([(-1, "1234 !!", "en", "s", 7), (-2, None, None, None, None)], docs.schema)
    docs = docs.unionByName(odd)
    left = corpus_pipeline.language(spark, docs, DATA)
    assert left.columns == columns and left.where("doc_id < 0").count() == 0
    assert left.count() >= docs.count() - 4
    good = corpus_pipeline.good_quality(spark, left, DATA)
    marks = spark.read.parquet(f"{DATA}/labels.parquet")
    seen = left.join(marks, "doc_id").join(good.select("doc_id").distinct(), "doc_id", "left_semi")
    assert good.columns == columns and seen.where("quality = 1").count() >= 0.98 * left.join(marks, "doc_id").where("quality = 1").count()
    one = corpus_pipeline.distinct(spark, good, DATA)
    wanted = neardup.deduplicate(good, 5, 80).where("kept").select("doc_id").distinct()
    assert one.columns == columns and {r.doc_id for r in one.collect()} == {r.doc_id for r in wanted.collect()}
    clean = corpus_pipeline.uncontaminated(spark, one, DATA)
    dirty = decontam.contamination(one, spark.read.parquet(f"{DATA}/benchmark.parquet")).where("contaminated")
    assert clean.columns == columns and clean.count() == one.count() - dirty.count()
    assert corpus_pipeline.tokens(spark, clean, DATA).count() == clean.count()


def test_run_and_empty_input(spark):
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "tokens"
    rows = corpus_pipeline.run(spark, DATA)
    assert rows.count() > 100 and "ids_sha256" in rows.columns
    none = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, DATA)
    assert none.collect() == []


def test_repeated_rows_stay_once(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(20)
    assert corpus_pipeline.distinct(spark, docs.union(docs), DATA).count() == corpus_pipeline.distinct(spark, docs, DATA).count()
    assert quality.FEATURES == 1 << 17


def test_texts_of_shared_and_null_ids_stay(spark):
    text = {c: " ".join(f"{c}{k}" for k in range(40)) for c in "ABCDEF"}
    rows = [(5, "A"), (5, "B"), (7, "B"), (3, "C"), (9, "C"), (9, "D"), (None, "E"), (None, "E"), (None, "F"), (None, "D"), (5, "B")]
    schema = spark.read.parquet(f"{DATA}/documents.parquet").schema
    docs = spark.createDataFrame([(k, text[c], "en", f"s{i}", i) for i, (k, c) in enumerate(rows)], schema)
    left = corpus_pipeline.distinct(spark, docs, DATA)
    got = {(r.doc_id, r.text[0], r.source) for r in left.collect()}
    assert left.columns == docs.columns and left.count() == len(got)
    assert got == {(5, "A", "s0"), (5, "B", "s1"), (3, "C", "s3"), (9, "D", "s5"), (None, "E", "s6"), (None, "F", "s8")}


def test_only_dirty_texts_of_an_id_go(spark):
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").where("size(split(text, ' ')) > 12").first().text
    rows = [(1, item), (1, "clean one"), (None, item), (None, "clean two"), (2, "clean three"), (2, None)]
    schema = spark.read.parquet(f"{DATA}/documents.parquet").schema
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], schema)
    left = corpus_pipeline.uncontaminated(spark, docs, DATA)
    assert left.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(str, [rows[1], *rows[3:]]))


def test_cells_take_struct_ids(spark):
    sets = [np.arange(a, a + 20, dtype=np.uint64).tobytes() for a in (0, 1, 90)]
    data = [(1, (False, k, k), (False, k, k), bytearray(z)) for k, z in enumerate(sets)]
    kind = "struct<a: boolean, b: long, c: long>"
    rows = spark.createDataFrame(data, f"cell long, k {kind}, p {kind}, z binary").coalesce(1)
    assert {tuple(sorted((r.a.b, r.b.b))) for r in neardup.link_cells(rows, 80).collect()} == {(0, 1)}


def test_documents_with_letters_stay_without_languages(spark):
    schema = spark.read.parquet(f"{DATA}/documents.parquet").schema
    rows = [(1, "words"), (2, "12 34 !!"), (3, None), (4, "\u0436"), (5, "")]
    docs = spark.createDataFrame([(k, t, None, "s", 1) for k, t in rows], schema)
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, DATA).collect()} == {1, 4}


def test_any_columns_come_through(spark):
    """Columns of any type, and those named as a stage might name its own, stay as they are."""
    text = "the quick words of one text and of the next one and so on without an end at all"
    rows = [(1, text, "en", {"a": 1}, "v", [None]), (2, text, "en", {"b": 2}, "w", [1]), (3, "other words", "en", None, None, None), (1, text, "en", {"a": 0}, "x", [2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, m map<string,int>, _stage_value string, l array<int>")
    for stage in (corpus_pipeline.language, corpus_pipeline.good_quality, corpus_pipeline.distinct, corpus_pipeline.uncontaminated):
        left = stage(spark, docs, DATA)
        assert left.columns == docs.columns
        kept = {(r.doc_id, r._stage_value) for r in left.collect()}
        if stage is corpus_pipeline.distinct:
            assert kept == {(1, "x"), (3, None)}
        if stage is corpus_pipeline.uncontaminated:
            assert len(kept) == 4


def test_rows_of_a_plain_pipeline(spark):
    """All rows of the pipeline by plain Python; only the two models are fitted by Spark, each on what its stage gets."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    labels, scores = langid.predictor(langid.fit(docs))([t for _, t in rows])
    rows = [r for r, y, p in zip(rows, labels, scores) if y != langid.UNKNOWN and p >= corpus_pipeline.LEAST_LANGUAGE_SCORE]

    left = docs.where(docs.doc_id.isin([k for k, _ in rows]))
    model, features = quality.fit(left, spark.read.parquet(f"{DATA}/labels.parquet")), quality.Features()
    rows = [(k, t) for k, t in rows if model.score(features(t)) >= corpus_pipeline.LEAST_QUALITY_SCORE]

    first = {k for k, _, _, kept in brute_components(rows, 5, 80) if kept}
    rows = [(k, t) for k, t in rows if k in first]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    rows = [(k, t) for k, t in rows if not brute_hits(t, items)[1]]

    library = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    library.no_truncation()
    library.no_padding()
    wanted = set()
    for k, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        wanted.add((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, DATA).collect()]
    assert len(got) == len(wanted) > 100 and set(got) == wanted
