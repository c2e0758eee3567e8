"""Counts over chunks, files and index actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import suffix_label


def totals(chunks: DataFrame, path: str = "file_path") -> DataFrame:
    """Number of chunks and of distinct files.

    Files are counted in two steps, so that no task sees all paths.
    """
    per_file = chunks.groupBy(path).agg(F.count("*").alias("n"))
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_chunks"),
        F.count("*").alias("total_files"),
    )


def by_language(chunks: DataFrame, language: str = "language") -> DataFrame:
    """Chunks per language, most first."""
    return (
        chunks.groupBy(F.col(language).alias("language"))
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), "language")
    )


def partial_counts(chunks: DataFrame, *groups: str) -> DataFrame:
    """Chunks and files per language, within ``groups`` that no file is in two of. They add up over groups."""
    per_file = chunks.groupBy(*groups, "language", "file_path").agg(F.count("*").alias("n"))
    return per_file.groupBy(*groups, "language").agg(F.sum("n").alias("cnt"), F.count("*").alias("files"))


def summary(counts: DataFrame) -> DataFrame:
    """One row from partial counts: totals and a language map. There are only as many entries as languages."""
    per_language = counts.groupBy("language").agg(F.sum("cnt").alias("cnt"), F.sum("files").alias("files"))
    # A file has one language, so files add up over languages.
    return per_language.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("total_chunks"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("total_files"),
        F.map_from_entries(F.collect_list(F.struct("language", "cnt"))).alias("languages"),
    )


def by_extension(files: DataFrame, path: str = "file_path") -> DataFrame:
    """Files per extension, most first."""
    return (
        files.groupBy(suffix_label(F.col(path)).alias("ext"))
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), "ext")
    )


def action_counters(actions: DataFrame) -> DataFrame:
    """One row of refresh counters from ``action`` values."""

    def count(name: str):
        return F.coalesce(F.sum(F.when(F.col("action") == name, F.col("cnt"))), F.lit(0))

    grouped = actions.groupBy("action").agg(F.count("*").alias("cnt"))
    listed = F.col("action") != "delete"
    return grouped.agg(
        F.coalesce(F.sum(F.when(listed, F.col("cnt"))), F.lit(0)).alias("num_execution_starts"),
        count("add").alias("num_adds"),
        count("delete").alias("num_deletes"),
        count("reprocess").alias("num_reprocesses"),
        count("unchanged").alias("num_unchanged"),
        count("error").alias("num_errors"),
    )
