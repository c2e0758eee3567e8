"""Exact top-k search by selection on global score histograms.

Vectors are quantised to whole numbers and stored in blocks, as are the queries. A grid of (candidate
block, query block) tasks scores everything. The first pass counts scores in coarse bins
per query; the bin that holds the k-th best score is divided again until it is one
score wide. A last pass keeps the scores above that value, and of those equal to it the
smallest ids. No pass keeps more than k rows of a query per task, whatever the ties.

A task of the grid reads its blocks from the shared folder, so vectors are neither
joined nor broadcast, and any task can be run again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored
from .tokenfiles import open_folder

SCALE = 64
# Vectors in a block, and query blocks that one task takes its candidates through.
BLOCK = 4096
QUERY_BLOCK = 1024
QUERY_BLOCKS_PER_TASK = 4
# Every pass divides a bin by this much.
BINS = 256

LIMIT = (1 << 63) - 1
WIDE = "decimal(38,0)"


def floored(x: Column) -> Column:
    """The floor as a double: that of Spark is a long, which large values overflow."""
    return F.when(F.abs(x) < 1 << 52, F.floor(x).cast("double")).otherwise(x)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """Rows k and v with floor(scale * x) for each component; unfit vectors and null ids are left out.

    Unfit are null vectors and those with null or non-finite components, or with components
    that are no longer finite when scaled.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("k"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scale * x) < float("inf")))
    rows = rows.where(F.col("k").isNotNull() & F.col("v").isNotNull() & finite)
    return rows.select("k", F.transform("v", lambda x: floored(scale * x)).alias("v"))


def write_blocks(rows: DataFrame, size: int, purpose: str) -> DataFrame:
    """Store rows k and v in files of at most ``size`` vectors each."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.files.maxRecordsPerFile", str(size))
    try:
        return stored(rows, purpose)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def as_block(rows: pa.Table) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Ids of a block, and by length of vector their rows and the matrix of their components."""
    ids = rows["k"].to_numpy()
    if not len(ids):
        return ids, {}
    column = pa.concat_arrays(rows["v"].chunks)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    groups = {}
    for n in np.unique(lengths).tolist():
        rows_of = np.flatnonzero(lengths == n)
        groups[n] = (rows_of, values[starts[rows_of, None] + np.arange(n)])
    return ids, groups


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products, exact; beyond the range of a long they stop at its ends."""
    n = queries.shape[1]
    most = max(1, n) * float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0))
    if most < 1 << 24:
        return np.rint(queries.astype(np.float32) @ candidates.T.astype(np.float32)).astype(np.int64)
    if most < 1 << 53:
        return np.rint(queries @ candidates.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(len(m), n) for m in (queries, candidates)]
    exact = whole[0] @ whole[1].T if n else np.zeros((len(queries), len(candidates)), object)
    return np.clip(exact, -LIMIT - 1, LIMIT).astype(np.int64)


def score_blocks(queries, candidates) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query ids, candidate ids and the matrix of their scores, for vectors of equal length."""
    q_ids, q_groups = queries
    c_ids, c_groups = candidates
    for n, (rows, matrix) in q_groups.items():
        if n in c_groups:
            places, others = c_groups[n]
            yield q_ids[rows], c_ids[places], products(matrix, others)


class Grid:
    """Candidate files and query folders whose every pair is one task's work; only numbers travel."""

    def __init__(self, spark, candidates: list[str], queries: str, folders: int) -> None:
        self.spark, self.candidates, self.queries, self.folders = spark, candidates, queries, folders

    def run(self, work, schema: str) -> DataFrame:
        """Apply ``work(query folder number, its queries, candidates)`` to all pairs."""
        candidates, queries, folders = self.candidates, self.queries, self.folders
        groups = -(-folders // QUERY_BLOCKS_PER_TASK)
        total = len(candidates) * groups

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for cell in batch.column(0).to_pylist():
                    c, g = divmod(cell, groups)
                    block = as_block(read_rows(candidates[c], ["k", "v"]))
                    for i in range(g * QUERY_BLOCKS_PER_TASK, min(folders, (g + 1) * QUERY_BLOCKS_PER_TASK)):
                        found = read_rows(f"{queries}/i={i}", ["k", "v"])
                        if found is not None:
                            yield from work(i, as_block(found), block)

        return self.spark.range(0, total, 1, max(1, min(total, 100_000))).mapInArrow(run, schema)


def read_rows(uri: str, columns: list[str]) -> pa.Table | None:
    """A file or all files of a folder; None where there is none."""
    store, path = open_folder(uri)
    if store.get_file_info(path).type.name == "NotFound":
        return None
    return ds.dataset(path, filesystem=store, format="parquet", partitioning=None).to_table(columns=columns)


def read_bounds(root: str, i: int) -> dict[int, tuple[int, int, int]]:
    """Low end, width and count above of the queries of one folder."""
    found = read_rows(f"{root}/i={i}", ["q", "low", "width", "above"])
    if found is None:
        return {}
    rows = zip(*(found[c].to_pylist() for c in ("q", "low", "width", "above")))
    return {q: (int(low), int(width), above) for q, low, width, above in rows}


def in_range(row: np.ndarray, low: int, width: int) -> np.ndarray:
    """How far scores lie above ``low``, for those in the range."""
    offset = row[row >= low].view(np.uint64) - np.uint64(low & ((1 << 64) - 1))
    return offset if width >= 1 << 64 else offset[offset < np.uint64(width)]


def histograms(grid: Grid, first: tuple[int, int], bounds: str | None, k: int) -> DataFrame:
    """Per query (q) and bin (b) the number of scores (n), for the highest bins that can matter.

    The bins divide [low, low + width) of each query: ``first`` at the start, later what ``bounds``
    holds, with the count of scores above. The k-th best of all scores is
    no lower than the k-th best of one task, so a task counts no lower ones.
    """

    def work(i: int, queries, block) -> Iterator[pa.RecordBatch]:
        known = None if bounds is None else read_bounds(bounds, i)
        for q_ids, c_ids, scores in score_blocks(queries, block):
            found_q, found_b, found_n = [], [], []
            for row, q in zip(scores, q_ids.tolist()):
                low, width, above = (*first, 0) if known is None else known.get(q, (0, 0, k))
                if above >= k:
                    continue
                offset = in_range(row[c_ids != q], low, width)
                if len(offset) > k - above:
                    offset = np.partition(offset, len(offset) - k + above)[len(offset) - k + above :]
                bins, counts = np.unique(offset // np.uint64(bin_width(width)), return_counts=True)
                found_q += [q] * len(bins)
                found_b += bins.tolist()
                found_n += counts.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (found_q, found_b, found_n)], names=["q", "b", "n"]
            )

    return grid.run(work, "q long, b long, n long").groupBy("q", "b").agg(F.sum("n").alias("n"))


def bin_width(width: int) -> int:
    return max(1, -(-width // BINS))


def narrow(counts: DataFrame, first: tuple[int, int], bounds: DataFrame | None, k: int) -> DataFrame:
    """The bin of each query that holds its k-th best score, as new bounds.

    A query with fewer than k scores gets the lowest bin it has.
    """
    order = Window.partitionBy("q").orderBy(F.desc("b"))
    rows = counts.select("q", "b", "n", F.sum("n").over(order).alias("total"))
    if bounds is None:
        low, width = (F.lit(str(x)).cast(WIDE) for x in first)
        rows = rows.select("*", low.alias("low"), width.alias("width"), F.lit(0).cast("long").alias("above"))
    else:
        rows = rows.join(bounds.select("q", "low", "width", "above"), "q")
    # The first bin from above that reaches k, else the last one.
    reach = F.col("above") + F.col("total")
    last = Window.partitionBy("q")
    at = F.coalesce(F.max(F.when(reach >= k, F.col("b"))).over(last), F.min("b").over(last))
    rows = rows.select("*", at.alias("at"), reach.alias("reach")).where(F.col("b") == F.col("at"))
    step = F.greatest(F.ceil(F.col("width") / F.lit(BINS).cast(WIDE)), F.lit(1)).cast(WIDE)
    return rows.select(
        "q",
        (F.col("low") + F.col("b").cast("decimal(10,0)") * step.cast("decimal(25,0)")).cast(WIDE).alias("low"),
        step.alias("width"),
        (F.col("reach") - F.col("n")).cast("long").alias("above"),
    )


def best(grid: Grid, bounds: str, k: int) -> DataFrame:
    """Scores at or above each query's bound, at most k a task: the best by score and then by id."""

    def work(i: int, queries, block) -> Iterator[pa.RecordBatch]:
        known = read_bounds(bounds, i)
        for q_ids, c_ids, scores in score_blocks(queries, block):
            found = [np.zeros((3, 0), np.int64)]
            for row, q in zip(scores, q_ids.tolist()):
                if q in known:
                    kept = np.flatnonzero((row >= known[q][0]) & (c_ids != q))
                    if len(kept) > k:
                        kept = kept[np.lexsort((c_ids[kept], ~row[kept]))[:k]]
                    found.append(np.stack([np.full(len(kept), q), c_ids[kept], row[kept]]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(found, axis=1)], names=["q", "c", "s"])

    return grid.run(work, "q long, c long, s long")


def score_range(vectors: DataFrame, queries: DataFrame) -> tuple[int, int]:
    """Low end and width of a range that holds every score, from the longest vectors."""
    square = F.max(F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x)).alias("m")
    longest = [rows.select(square).first()["m"] or 0.0 for rows in (vectors, queries)]
    most = math.sqrt(longest[0]) * math.sqrt(longest[1]) * (1 + 1e-9) + 1
    if not most < LIMIT / 2:
        return -LIMIT - 1, 1 << 64
    return -math.ceil(most), 2 * math.ceil(most) + 1


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k best candidates of each query: query_id, rank from 1, the candidate's id and score.

    The score is the inner product of floor(64 * x) of both vectors, no larger than a long; ties go to
    the smaller id. A query is compared with all rows of other ids and of its own dimension, and gets
    fewer rows if there are fewer. Unfit vectors take no part. Repeated rows are ranked side by
    side as candidates and count once as queries. Tables without fit vectors give no rows.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = write_blocks(quantised(vectors, id_col, vector_col), BLOCK, "candidate-blocks")
    wanted = quantised(queries, id_col, vector_col).dropDuplicates(["k"])
    wanted = stored(wanted, "queries")
    folders = max(1, math.ceil(wanted.count() / QUERY_BLOCK))
    place = F.pmod(F.xxhash64("k"), F.lit(folders))
    blocks = stored(wanted.withColumn("i", place).repartition("i"), "query-blocks", ["i"])
    if not rows.inputFiles() or not blocks.inputFiles():
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long")
    grid = Grid(spark, sorted(rows.inputFiles()), root_of(blocks), folders)
    first = score_range(rows, wanted)
    width, bounds = first[1], None
    while bounds is None or width > 1:
        counts = histograms(grid, first, bounds and root_of(bounds), k)
        found = narrow(counts, first, bounds, k).withColumn("i", F.pmod(F.xxhash64("q"), F.lit(folders)))
        bounds = stored(found.repartition("i"), "bounds", ["i"])
        width = bin_width(width)
        if not bounds.inputFiles():
            return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long")
    found = best(grid, root_of(bounds), k)
    order = Window.partitionBy("q").orderBy(F.desc("s"), "c")
    ranked = found.select("q", "c", "s", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias("query_id"), "rank", F.col("c").alias(id_col), F.col("s").alias("score"))


def root_of(frame: DataFrame) -> str:
    return frame.inputFiles()[0].rsplit("/i=", 1)[0]
