"""Vector compression: integer product codes, with codebooks learned over a trie of distinct parts.

Vectors become integers and are cut into equal parts. Equal parts at one position are counted
once, and the distinct ones are stored in lexicographic order: in that order they are the leaves of
a trie with a dimension per level, met depth first. A walk over it keeps, for every open node,
the vector of squared distances from its prefix to that of every codebook entry; a node adds
one dimension to its parent's vector, so whatever parts have in common is added up once. Leaves take the
nearest entry and add their components, weighted by their counts, to its sums.

A task walks over stored parts in batches and carries the path that is open at a batch's end over to the
next. From a round it returns at most a row per entry and dimension. Codebooks have a fixed size
(entries times dimensions); they alone pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import hot_keys, lookup_join
from .common import forget, prepare, stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Components are limited to this size on either side, so that four bytes hold each.
LIMIT = 1 << 30
LONGEST = (1 << 63) - 1

# One codebook per part position: entries by components.
Books = list[np.ndarray]


@dataclass
class OpenPath:
    """The last leaf that a walk met, and the distances of all nodes above it."""

    leaf: np.ndarray
    distances: list[np.ndarray]


def number_type(*values: np.ndarray) -> type:
    """Machine integers where no distance over these values can overflow them, else Python's."""
    most = max((int(np.abs(v).max()) for v in values if v.size), default=0)
    return np.int64 if (2 * most) ** 2 * values[0].shape[-1] <= LONGEST else object


def walk(leaves: np.ndarray, book: np.ndarray, path: OpenPath | None = None) -> tuple[np.ndarray, OpenPath]:
    """Distances of all leaves, given in lexicographic order, to all entries, and the path left open.

    Out of order fewer nodes are shared, and the distances are the same.
    """
    kind = number_type(leaves, book)
    leaves, book = leaves.astype(kind), book.astype(kind)
    same = np.empty(leaves.shape, bool)
    same[1:] = leaves[1:] == leaves[:-1]
    same[0] = leaves[0] == path.leaf if path is not None else False
    # Below the first dimension in which a leaf differs from the one before, its nodes are new.
    opens = ~np.logical_and.accumulate(same, axis=1)
    above = np.zeros((1, len(book)), kind)
    place = np.zeros(len(leaves), np.int64)
    left: list[np.ndarray] = []
    for level in range(leaves.shape[1]):
        new = np.flatnonzero(opens[:, level])
        added = above[place[new]] + (leaves[new, level][:, None] - book[:, level][None, :]) ** 2
        still_open = path.distances[level][None, :] if path is not None else np.zeros((1, len(book)), kind)
        above = np.concatenate([still_open.astype(kind), added])
        place = np.cumsum(opens[:, level])
        left.append(above[place[-1]])
    return above[place], OpenPath(leaves[-1], left)


def integers(vectors: pa.Array, scale: int) -> np.ndarray:
    """Rows of whole components; all vectors have one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    whole = np.floor(np.clip(flat * scale, -LIMIT, LIMIT)).astype(np.int64)
    return whole.reshape(len(vectors), -1)


def packed(values: np.ndarray) -> pa.Array:
    """Rows as bytes that sort as the rows do."""
    raw = (values + (1 << 31)).astype(">u4").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(4 * values.shape[1]), len(values), [None, pa.py_buffer(raw)]
    ).cast(pa.binary())


def unpacked(column: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), ">u4")
    return raw.reshape(len(column), -1).astype(np.int64) - (1 << 31)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> tuple[DataFrame, int]:
    """Rows i, l, v that can be cut into parts, and their length (0 if there are none)."""
    rows = vectors.select(
        F.col(id_col).alias("i"), F.col(label_col).alias("l"), F.col(vector_col).cast("array<double>").alias("v")
    )
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & ~odd)
    first = rows.orderBy(F.col("i").asc_nulls_last(), "v").select(F.size("v").alias("n")).head()
    length = first["n"] if first else 0
    return rows.where(F.size("v") == length), length


def count_parts(rows: DataFrame, parts: int, scale: int) -> DataFrame:
    """Distinct parts (p, part) with their counts (n), stored as the leaves of a trie in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                whole = integers(batch.column(0), scale)
                for p, values in enumerate(np.split(whole, parts, axis=1)):
                    places = pa.array(np.full(len(values), p, np.int32))
                    yield pa.RecordBatch.from_arrays([places, packed(values)], names=["p", "part"])

    found = rows.select("v").mapInArrow(cut, "p int, part binary")
    counted = found.groupBy("p", "part").agg(F.count(F.lit(1)).alias("n"))
    return stored(counted.repartitionByRange("p", "part").sortWithinPartitions("p", "part"), "trie")


def first_books(rows: DataFrame, parts: int, entries: int, scale: int) -> Books:
    """The parts of the vectors with the smallest ids; of equal ids, the smaller vectors."""
    chosen = rows.orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).select("v").toArrow()
    column = chosen.column(0).combine_chunks()
    return list(np.split(integers(column, scale), parts, axis=1))


def next_books(trie: DataFrame, books: Books) -> Books:
    """One round: all parts go to their nearest entries, which move to their parts' means."""
    width = books[0].shape[1]
    schema = pa.schema([("p", pa.int32()), ("e", pa.int32()), ("d", pa.int32()), ("s", pa.decimal128(38, 0))])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last column counts; Python's integers, as sums over all rows may be longer than machine words.
        sums = [np.zeros((len(book), width + 1), object) for book in books]
        path, open_at = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            places = batch.column(0).to_numpy()
            leaves, counts = unpacked(batch.column(1)), batch.column(2).to_numpy()
            # Stored files may follow each other in any order, so one position can come twice.
            starts = [0, *(np.flatnonzero(np.diff(places)) + 1), len(places)]
            for a, b in zip(starts, starts[1:]):
                p = int(places[a])
                distances, path = walk(leaves[a:b], books[p], path if open_at == p else None)
                open_at = p
                nearest = distances.argmin(axis=1).astype(np.int64)
                weighted = np.column_stack([leaves[a:b], np.ones(b - a, np.int64)])
                heaviest = int(np.abs(weighted).max()) * int(counts[a:b].max()) * (b - a)
                kind = np.int64 if heaviest <= LONGEST else object
                total = np.zeros(sums[p].shape, kind)
                np.add.at(total, nearest, weighted.astype(kind) * counts[a:b].astype(kind)[:, None])
                sums[p] += total.astype(object)
        rows = [(p, e, d, int(s)) for p, part in enumerate(sums) for e, d in np.ndindex(part.shape) if (s := part[e, d])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    found = trie.mapInArrow(assign, "p int, e int, d int, s decimal(38,0)")
    found = found.groupBy("p", "e", "d").agg(F.sum("s").cast("decimal(38,0)").alias("s"))
    sums = [np.zeros((len(book), width + 1), object) for book in books]
    for row in found.collect():
        sums[row["p"]][row["e"], row["d"]] = int(row["s"])
    moved = []
    for book, total in zip(books, sums):
        used = total[:, width] > 0
        new = book.copy()
        new[used] = (total[used, :width] // total[used, width:]).astype(np.int64)
        moved.append(new)
    return moved


def learn(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Books:
    """Codebooks of rows as :func:`usable` gives them."""
    books = first_books(rows, parts, entries, scale)
    trie = count_parts(rows, parts, scale)
    for _ in range(rounds):
        books = next_books(trie, books)
    forget(trie)
    return books


def encode(rows: DataFrame, books: Books, scale: int = SCALE) -> DataFrame:
    """Id (i), label (l), code and error of every row; vectors stay where they are."""
    kept = [f for f in rows.schema.fields if f.name in ("i", "l")]
    out = T.StructType([*kept, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = integers(batch.column(2), scale)
            codes, errors = np.empty((len(whole), len(books)), np.uint8), np.zeros(len(whole), object)
            for p, (part, book) in enumerate(zip(np.split(whole, len(books), axis=1), books)):
                order = np.lexsort(part.T[::-1])
                distances, _ = walk(part[order], book)
                codes[order, p] = distances.argmin(axis=1)
                errors[order] += distances.min(axis=1)
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array([row.tobytes().hex() for row in codes]),
                pa.array([min(int(e), LONGEST) for e in errors], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "l", "code", "error"])

    return rows.select("i", "l", "v").mapInArrow(code, out)


def digest(books: Books) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """Per usable vector: its id, code, error, label_error and codebooks_sha256.

    A component x becomes floor(scale * x), limited to 2**30 on either side. The codebook of a part position starts
    as that part of the vectors with the smallest ids (null ids last, equal ids by vector; all if there are fewer
    than ``entries``, of which there may be 256) and is moved ``rounds`` times; nearest entries by squared distance, ties to the lower
    index; entries without parts stay. ``code`` has two hex digits a part; ``error`` is the sum of
    squared distances and ``label_error`` its sum over rows of one label, null labels together; both
    stop at the largest long. Vectors that are null, hold null or non-finite components, or cannot be
    cut into equal parts are left out, as are those of another length than that of the smallest id.
    Repeated rows count as often as they occur. An empty table gives no rows. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = vectors.sparkSession
    prepare(spark)
    rows, length = usable(vectors, id_col, vector_col, label_col, parts)
    if not length:
        books: Books = [np.zeros((1, 1), np.int64)] * parts
        rows = rows.limit(0)
    else:
        books = learn(rows, parts, entries, rounds, scale)
    # The key of a label is its text, so that null labels are one group too.
    key = F.when(F.col("l").isNull(), "").otherwise(F.concat(F.lit("="), F.col("l").cast("string")))
    codes = stored(encode(rows, books, scale).withColumn("key", key).drop("l"), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    errors = codes.groupBy("key").agg(total.alias("label_error"))
    found = lookup_join(codes, errors, "key", hot=hot_keys(codes, "key"), salt=["i", "code"])
    return found.select(
        F.col("i").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
