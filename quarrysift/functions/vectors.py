"""Vector columns: distance, score and the exact top-k scan."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def l2_distance(left: Column, right: Column) -> Column:
    """Euclidean distance of two array columns, summed in array order in double.

    Arrays of unequal length give NULL, because ``zip_with`` pads the short one.
    """
    squares = F.zip_with(
        left.cast("array<double>"), right.cast("array<double>"), lambda a, b: (a - b) * (a - b)
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def l2_to_score(distance: Column) -> Column:
    """``1 - d*d/2``: the cosine similarity when both vectors have unit length."""
    return F.lit(1.0) - distance * distance / F.lit(2.0)


def as_float32(vector: Sequence[float]) -> list[float]:
    """The values a vector has after storage as 32-bit floats."""
    return [float(x) for x in np.asarray(vector, dtype=np.float32)]


def checked_distance(distance: Column, file_path: Column, shape: str) -> Column:
    """``distance``, failing the query when it is NULL.

    A NULL means a stored vector is missing or has another dimension than the
    query, which is a fault of the index and not a row to rank last.
    """
    text = F.concat(
        F.lit(f"no distance for a stored vector ({shape}, file_path='"),
        F.coalesce(file_path, F.lit("?")),
        F.lit("')"),
    )
    return F.when(distance.isNull(), F.raise_error(text).cast("double")).otherwise(distance)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used.

    Inside lambdas Spark would otherwise evaluate an expression again for every
    element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def nearest(
    rows: DataFrame,
    query: Sequence[float],
    keep: int,
    *,
    vector: str = "embedding",
    shape: str = "knn",
    path: str = "file_path",
) -> DataFrame:
    """Rows of ``rows`` with ``distance`` in place of the vector column, exactly.

    Each Arrow batch computes its distances with one NumPy pass and forwards
    only rows that can still be among the ``keep`` nearest: everything up to
    the ``keep``-th distance that the task has seen, ties included. Nothing is lost, and
    what leaves the scan is a small fraction of it. The caller orders the rest.
    """
    target = np.asarray(as_float32(query), dtype=np.float64)
    names = [f.name for f in rows.schema.fields if f.name != vector]
    fields = [rows.schema[name] for name in names] + [T.StructField("distance", T.DoubleType())]

    def scan(batches):
        # The smallest distances of the task so far.
        best = np.empty(0)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            column = batch.column(batch.schema.get_field_index(vector))
            sizes = np.diff(column.offsets.to_numpy())
            bad = np.flatnonzero(sizes != target.size)
            if column.null_count:
                bad = np.flatnonzero(column.is_null().to_numpy(zero_copy_only=False))
            if bad.size:
                where = path if path in batch.schema.names else batch.schema.names[0]
                value = batch.column(batch.schema.get_field_index(where))[int(bad[0])].as_py()
                raise RuntimeError(
                    f"no distance for a stored vector ({shape}, {where}={value!r})"
                )
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            delta = flat.reshape(batch.num_rows, target.size) - target
            distance = np.sqrt(np.einsum("ij,ij->i", delta, delta))
            seen = np.concatenate([best, distance[~np.isnan(distance)]])
            if len(seen) > keep:
                seen = np.partition(seen, keep - 1)[:keep] if keep > 0 else seen[:0]
            best = seen
            bound = best.max() if len(best) == keep > 0 else math.inf if keep > 0 else -math.inf
            # Written so that rows without an order (NaN) stay.
            chosen = np.flatnonzero(~(distance > bound))
            index = pa.array(chosen, type=pa.int64())
            arrays = [batch.column(batch.schema.get_field_index(n)).take(index) for n in names]
            arrays.append(pa.array(distance[chosen]))
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "distance"])

    return rows.mapInArrow(scan, T.StructType(fields))


# Rows of a block: a block of queries times a block of vectors is one matrix product.
BLOCK_ROWS = 2048


def blocks(rows: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """Rows packed into blocks: keys, and vectors as one run of 32-bit floats. Null vectors are left out."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(1)
            if (np.diff(column.offsets.to_numpy()) != dim).any():
                raise RuntimeError(f"no distance for a stored vector (batch, {key}): not all have {dim} dimensions")
            keys.append(batch.column(0).to_numpy().astype(np.int64))
            parts.append(column.flatten().to_numpy(zero_copy_only=False).astype(np.float32))
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                yield packed(keys, parts)
                keys, parts, held = [], [], 0
        if held:
            yield packed(keys, parts)

    def packed(keys: list, parts: list) -> pa.RecordBatch:
        columns = [pa.array([np.concatenate(x).tobytes()], pa.binary()) for x in (keys, parts)]
        return pa.RecordBatch.from_arrays(columns, names=["ids", "data"])

    given = rows.where(F.col(vector).isNotNull()).select(F.col(key).cast("bigint"), F.col(vector).cast("array<float>"))
    return given.mapInArrow(pack, "ids binary, data binary")


def nearest_batch(
    rows: DataFrame, queries: DataFrame, keep: int, *, key: str = "id", query_key: str = "query_id", vector: str = "embedding"
) -> DataFrame:
    """The ``keep`` nearest rows for each of a table of queries: query_id, rank, id, distance, score.

    Both sides are packed into blocks, and each pair of blocks is one matrix product in a task; the
    pairs are dealt out, so that queries and rows may both be many. A task remembers the ``keep``-th distance of
    every query it has met and forwards only rows up to it; their distances are then taken exactly, and
    one window per query merges what is left. Equal distances are ordered by id. Keys are whole numbers.
    """
    first = rows.where(F.col(vector).isNotNull()).select(F.size(vector)).head()
    dim = first[0] if first else 0
    left = blocks(queries, query_key, vector, dim).withColumnsRenamed({"ids": "query_ids", "data": "query_data"})
    right = blocks(rows, key, vector, dim)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for query_ids, query_data, ids, data in zip(*(c.to_pylist() for c in batch.columns)):
                a = np.frombuffer(query_data, np.float32).reshape(-1, dim).astype(np.float64)
                b = np.frombuffer(data, np.float32).reshape(-1, dim).astype(np.float64)
                squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
                # Rounding of the product must not cost a row: the bound is a little wider.
                slack = 1e-9 * ((a * a).sum(axis=1) + (b * b).sum(axis=1).max(initial=0))
                best = np.partition(squares, keep - 1, axis=1)[:, :keep] if squares.shape[1] > keep else squares
                # The same queries may come in several blocks of rows.
                seen = bounds.get(query_ids)
                if seen is not None:
                    best = np.concatenate([seen, best], axis=1)
                    best = np.partition(best, keep - 1, axis=1)[:, :keep] if best.shape[1] > keep else best
                bounds[query_ids] = best
                limit = best.max(axis=1) if best.shape[1] >= keep else np.full(len(a), np.inf)
                q, r = np.nonzero(~(squares > (limit + slack)[:, None]))
                exact = np.sqrt(((a[q] - b[r]) ** 2).sum(axis=1))
                columns = [np.frombuffer(query_ids, np.int64)[q], np.frombuffer(ids, np.int64)[r], exact]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "id", "distance"])

    # A pair of blocks at a time: queries are the stated set, in blocks against all rows.
    pairs = left.crossJoin(right).select("query_ids", "query_data", "ids", "data")
    near = pairs.mapInArrow(multiply, "query_id bigint, id bigint, distance double")
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return ranked.select("query_id", "rank", "id", "distance", l2_to_score(F.col("distance")).alias("score"))
