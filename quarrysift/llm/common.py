"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, ship_package

# Rows and bytes handed to Python at a time: a batch of long texts must fit beside the JVM.
ROWS_PER_BATCH = 512
BYTES_PER_BATCH = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the code and bound the size of the batches that Python gets."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, purpose: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    The copy is removed when the session's JVM ends.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.partitionBy(*partition_by).parquet(path)
    drop_on_exit(spark, path)
    return spark.read.schema(frame.schema).parquet(path)


def drop_on_exit(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def fold(column: str | Column, parts: int) -> Column:
    """The part of a row by the CRC-32 of its id as text; null ids have none."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column) % parts


def crop(texts: list[str | None], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` characters; no text is cut."""
    start = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def gather_ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices begin[0], begin[0]+1, ... of all ranges, one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - (ends - length), length) + np.arange(total)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, field.type)
        for c, field in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Texts (x) with labels (y, 0 or 1) of at most ``per_class`` labelled ids of each class.

    The ids are chosen in each class by a hash of the id, the same in every run, and broadcast
    to the texts, so no text moves. Null labels, ids and texts are left out; an id labelled
    twice counts twice. The third column (h) is a hash of all but the label, for smaller samples.
    """
    marks = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y"))
    marks = marks.where("k IS NOT NULL AND y IN (0, 1)").groupBy("k", "y").count()
    counts = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.sum("count").alias("n")).collect()}
    # Of an id's labels as many are drawn as fall to it, rounded up or down by a hash; together they are half
    # more than the limit at most, so an id labelled very often is no long list. Each is then ordered by itself.
    shares = [min(1.0, 1.5 * per_class / max(1, counts.get(y, 0))) for y in (0, 1)]
    drawn = F.floor(F.col("count") * F.when(F.col("y") == 0, shares[0]).otherwise(shares[1]) + uniform(F.xxhash64("k")))
    drawn = F.least("count", drawn)
    marks = marks.select("k", "y", F.explode(F.sequence(F.lit(0).cast("long"), drawn)).alias("o")).where("o > 0")
    marks = marks.withColumn("p", F.xxhash64("k", "o"))
    chosen = marks.limit(0)
    for y in sorted(counts):
        chosen = chosen.union(marks.where(F.col("y") == y).orderBy("p", "k", "o").limit(per_class))
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("x")).where("x IS NOT NULL")
    return texts.join(F.broadcast(chosen), "k").select("x", "y", F.xxhash64("k", "o", "x").alias("h"))


def within(hashed: str, most: int, count: int) -> Column:
    """Whether a hash is among the half more than ``most`` of ``count`` rows that a limit is then put on."""
    return uniform(F.col(hashed)) < min(1.0, 1.5 * most / max(1, count))


def uniform(hashed: Column) -> Column:
    """A hash as a number from 0 up to but not 1."""
    return F.pmod(hashed, F.lit(1_000_003)) / 1_000_003


def of_each_class(labelled: DataFrame, totals: Iterable[int], most: int, shaped: Callable[[DataFrame], DataFrame]) -> pa.Table:
    """What ``shaped`` makes of at most ``most`` rows of each class (y), in the order of their hashes (h).

    ``totals`` are the rows of classes 0 and 1, and ``shaped`` has to keep h and y. Each class has
    a limit of its own, so none is cut by another.
    """
    found = []
    for y, count in enumerate(totals):
        rows = labelled.where(F.col("y") == y)
        for part in (rows.where(within("h", most, count)), rows):
            got = shaped(part).orderBy("h").limit(most).toArrow()
            # Equal rows have one hash: a class may consist of few hashes, none of them taken.
            if len(got) or not count:
                break
        found.append(got)
    return pa.concat_tables(found).sort_by([("h", "ascending"), ("y", "ascending")])


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def calibrate(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic fit of labels on margins, by Newton steps."""
    a, b = 1.0, 0.0
    if not len(margin):
        return a, b
    spread = margin.std() or 1.0
    x = margin / spread
    weight = weight / weight.sum()
    for _ in range(50):
        p = logistic(a * x + b)
        # A small penalty keeps the slope finite where the classes do not overlap.
        g = np.array([(weight * (p - label) * x).sum() + 1e-3 * a, (weight * (p - label)).sum() + 1e-5 * b])
        v = weight * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-5]])
        step = np.linalg.solve(h, g)
        size = np.abs(step).max()
        step = step * min(1.0, 2.0 / size) if size else step
        a, b = a - step[0], b - step[1]
        if size < 1e-8:
            break
    return float(a / spread), float(b)


def forget(frame: DataFrame) -> None:
    """Remove the files of a stored frame that nothing reads any more."""
    spark = frame.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
