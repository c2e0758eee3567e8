"""The corpus pipeline: language, quality, near duplicates, benchmarks, tokens.

Each stage takes the documents its predecessor kept. All but the last return the columns
of ``documents``; the last returns a row of token counts and digests per document left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrysift.llm import bpe, decontam, langid, neardup, quality
from quarrysift.llm.common import prepare, stored, table

# A language is taken as known from this share of the probability on.
LEAST_LANGUAGE_SCORE = 0.4
LEAST_QUALITY_SCORE = 0.5


def free_name(docs: DataFrame) -> str:
    """A name, for what a stage adds and takes away again, that no column of documents has."""
    taken = {c.lower() for c in docs.columns}
    return next(n for n in (f"_stage_value{k or ''}" for k in range(len(taken) + 1)) if n not in taken)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those without letters or with no clear language go.

    Where no document has a language there is none to be unclear, and only those without letters go.
    """
    network = langid.fit(docs, "text", "lang")
    if network is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    added = free_name(docs)
    known = (F.col(f"{added}.label") != langid.UNKNOWN) & (F.col(f"{added}.score") >= LEAST_LANGUAGE_SCORE)
    return langid.with_language(docs, network, "text", added).where(known).drop(added)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of those at hand, takes for good."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    added = free_name(docs)
    return quality.with_quality(docs, model, "text", added).where(F.col(added) >= LEAST_QUALITY_SCORE).drop(added)


def keyed(docs: DataFrame, added: str) -> DataFrame:
    """The documents with a key that equal rows of id and text share; null ids sort last.

    Ids may be null or stand before several texts, so that they name no document by themselves.
    """
    digests = F.xxhash64("text"), F.xxhash64(F.lit(1), "text")
    names = "no_id", "id", "h0", "h1"
    values = F.col("doc_id").isNull(), F.col("doc_id"), *digests
    return docs.withColumn(added, F.struct(*(v.alias(n) for v, n in zip(values, names))))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more.

    The one with the smallest id stays, with a null id only if no other has one. Texts are
    compared whatever their ids: different texts of one id, or without ids, are different documents.
    Rows equal in id and text stay once, the one whose other columns come first as JSON, whatever their types.
    """
    added = free_name(docs)
    rows = keyed(docs, added)
    found = neardup.deduplicate(rows, width=5, percent=80, id_col=added)
    kept = found.where("kept").select(added).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    others = F.to_json(F.struct(F.lit(0).alias(added), *(c for c, name in zip(columns, docs.columns) if name != "text")))
    first = F.min_by(F.struct(*columns), others)
    whole = rows.join(kept, added, "left_semi").groupBy(added).agg(first.alias("row"))
    return whole.select("row.*")


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ten words of a benchmark item.

    Of several texts with one id or none, only those with a passage go.
    """
    added = free_name(docs)
    rows = keyed(docs, added)
    found = decontam.contamination(rows, table(spark, sf_dir, "benchmark"), id_col=added)
    return rows.join(found.where("contaminated").select(added).distinct(), added, "left_anti").drop(added)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every remaining document."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("near_duplicates", distinct),
    ("decontamination", uncontaminated),
    ("tokens", tokens),
]

# Trained models and hashed signatures have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result stored and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
