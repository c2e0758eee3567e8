"""Nearest-chunk search over a chunk table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.globs import search_glob
from ..functions.text import location
from ..functions.vectors import l2_to_score, nearest
from ..schema import RESULT_COLUMNS

@dataclass(frozen=True)
class SearchSpec:
    """What to search for. Empty filters mean no filter."""

    vector: Sequence[float]
    limit: int = 10
    offset: int = 0
    languages: Sequence[str] = field(default_factory=tuple)
    paths: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        if self.limit < 0 or self.offset < 0:
            raise ValueError("limit and offset must not be negative")

    @property
    def shape(self) -> str:
        if self.paths:
            return "path filter"
        return f"languages={list(self.languages)!r}" if self.languages else "unfiltered"


def filters(spec: SearchSpec) -> Column:
    """Language and path conditions: the first prunes directories, the second row groups."""
    keep = F.lit(True)
    if spec.languages:
        keep = keep & F.col("language").isin(sorted(set(spec.languages)))
    if spec.paths:
        keep = keep & search_glob(F.col("file_path"), spec.paths)
    return keep


def top(chunks: DataFrame, spec: SearchSpec) -> DataFrame:
    """The page of nearest rows with ``distance`` and ``score``, nearest first.

    All columns of ``chunks`` but the vector stay, so select what is needed
    before. Equal distances are ordered by ``id``, which keeps pages stable.
    """
    keep = spec.limit + spec.offset
    if "id" not in chunks.columns:
        raise ValueError("chunks need an id column to order equal distances")
    candidates = nearest(chunks.where(filters(spec)), spec.vector, keep, shape=spec.shape)
    tie = [F.col(c) for c in ("id", "file_path") if c in candidates.columns]
    order = [F.col("distance"), *tie]
    # Spark keeps the first rows of each task and merges them: no full sort, no shuffle.
    page = candidates.orderBy(*order).offset(spec.offset).limit(spec.limit)
    return page.withColumn("score", l2_to_score(F.col("distance")))


def search(chunks: DataFrame, spec: SearchSpec, ranked: bool = False) -> DataFrame:
    """The six result columns, nearest first, in two passes; with ``ranked`` also the place in the page.

    The first pass reads keys and vectors only; its result, the ``limit`` keys of the
    page, passes through the driver. The second reads text and lines for these rows: their
    paths and languages go into the scan as literals, so row groups and folders
    without any of them are skipped.
    """
    keys = ["id", "file_path", "language"]
    page = top(chunks.select(*keys, "embedding"), spec).select(*keys, "distance", "score")
    rows = page.collect()
    places = T.StructType([*page.schema, T.StructField("rank", T.IntegerType())])
    winners = chunks.sparkSession.createDataFrame([(*row, n) for n, row in enumerate(rows, 1)], places)
    detail = chunks.where(
        F.col("file_path").isin(sorted({r["file_path"] for r in rows}))
        & F.col("language").isin(sorted({r["language"] for r in rows}))
    ).select(*keys, "content", "start_line", "end_line")
    found = detail.join(winners, keys)
    return found.orderBy("rank").select(*RESULT_COLUMNS, *(["rank"] if ranked else []))


def report(results: DataFrame) -> DataFrame:
    """Printable lines of a result page with its ranks, in the order of the search itself."""
    return results.select(
        "rank",
        F.format_string("--- Result %d (score: %.3f) ---", "rank", "score").alias("heading"),
        location(
            F.col("file_path"), F.col("start_line"), F.col("end_line"), F.col("language")
        ).alias("place"),
        "content",
    )
