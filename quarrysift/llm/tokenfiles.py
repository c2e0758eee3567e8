"""Token ids in Arrow files of equal-length sequences.

The ids of all documents, in ascending document order and each with an end id, form one
long stream. Every task writes its part of the stream as an Arrow IPC file whose record
batches hold two fixed-size lists per row: ``ids``, in 16 bits where the vocabulary fits, and
``mask``, one bit each. All values of a list column lie side
by side, so row r of a memory-mapped file is the slice [r * length, (r + 1) * length) of
one buffer: nothing is copied or parsed. Only a file's last row has masked places. A second
Arrow file beside it says where each document starts. The manifest, written by Spark when
a task has succeeded, names the files that count; those of failed or repeated attempts are never read.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import scratch_dir
from .common import ROWS_PER_BATCH, batch_of, crop, drop_on_exit, prepare, stored
from .pieces import Encoder, added_tokens, largest_id

SEQUENCE_LENGTH = 1024
SEQUENCES_PER_BATCH = 256
CHARS_PER_STEP = 1 << 21

MANIFEST = "file string, index string, ids long, rows long, part int"


@functools.lru_cache(maxsize=2)
def library_encoder(path: str) -> Encoder:
    """The tokenizers library behind the shared splitter: each distinct piece is encoded by it once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode_pieces(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((t for ids in found for t in ids), np.int64, int(counts.sum())), counts

    return Encoder(added_tokens(path), encode_pieces)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class SequenceFile:
    """Writes a stream of ids as rows of equal length."""

    def __init__(self, sink, length: int, largest: int) -> None:
        self.length = length
        self.kind = np.uint16 if largest < 1 << 16 else np.uint32
        self.schema = pa.schema(
            [("ids", pa.list_(pa.from_numpy_dtype(self.kind), length)), ("mask", pa.list_(pa.bool_(), length))],
            {b"sequence_length": str(length).encode()},
        )
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.kept: list[np.ndarray] = []
        self.size = self.rows = self.ids = 0

    def add(self, ids: np.ndarray) -> None:
        self.kept.append(ids.astype(self.kind))
        self.size += len(ids)
        self.ids += len(ids)
        step = self.length * SEQUENCES_PER_BATCH
        if self.size >= step:
            # All record batches but the last have the same number of rows.
            flat = np.concatenate(self.kept)
            whole = len(flat) // step * step
            self._write(flat[:whole], np.ones(whole, bool))
            self.kept, self.size = [flat[whole:]], len(flat) - whole

    def _write(self, ids: np.ndarray, mask: np.ndarray) -> None:
        step = self.length * SEQUENCES_PER_BATCH
        for a in range(0, len(ids), step):
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(x[a : a + step]), self.length) for x in (ids, mask)
            ]
            self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
            self.rows += len(columns[0])

    def close(self) -> None:
        flat = np.concatenate(self.kept) if self.kept else np.zeros(0, self.kind)
        if len(flat):
            blank = np.zeros(-len(flat) % self.length, self.kind)
            mask = np.arange(len(flat) + len(blank)) < len(flat)
            self._write(np.concatenate([flat, blank]), mask)
        self.writer.close()


class SequenceReader:
    """Random access to one file: rows, or any range of its stream of ids."""

    def __init__(self, folder: pafs.FileSystem, path: str) -> None:
        if isinstance(folder, pafs.LocalFileSystem):
            self.source = pa.memory_map(path)
        else:
            self.source = folder.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.length = int(self.file.schema.metadata[b"sequence_length"])
        self.last: tuple[int, pa.Array, pa.Array] | None = None

    def close(self) -> None:
        self.source.close()

    def _batch(self, k: int) -> tuple[pa.Array, pa.Array]:
        if self.last is None or self.last[0] != k:
            batch = self.file.get_batch(k)
            self.last = (k, *(batch.column(c).flatten() for c in (0, 1)))
        return self.last[1:]

    def sequence(self, row: int) -> tuple[pa.Array, pa.Array]:
        """Ids and mask of one row: slices of the file's buffers."""
        k, at = divmod(row, SEQUENCES_PER_BATCH)
        part = slice(at * self.length, (at + 1) * self.length)
        ids, mask = self._batch(k)
        return ids[part], mask[part]

    def stream(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, in as many slices as record batches are touched."""
        step = self.length * SEQUENCES_PER_BATCH
        while count > 0:
            k, at = divmod(start, step)
            ids, mask = self._batch(k)
            found = ids[at : at + count].to_numpy()
            if not len(found) or not mask[at + len(found) - 1].as_py():
                raise ValueError("the range ends after the stream")
            yield found
            start, count = start + len(found), count - len(found)


def write_sequences(
    docs: DataFrame,
    path: str,
    folder: str | None = None,
    length: int = SEQUENCE_LENGTH,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    encoder: Callable[[str], Encoder] = library_encoder,
) -> DataFrame:
    """Write all documents' ids and return the manifest with each file's place in the stream.

    ``folder`` must be one that all executors share; by default it is a new one in the
    session's scratch folder. Documents are sorted by id (null ids first, equal ids by
    a hash of the text); a null or empty text has the end id alone. Texts move
    once, in the range partitioning that sorts them. A task holds one batch.
    The manifest has ``start``, the number of ids in earlier files; it is found from one number per
    file, of which there are as many as tasks.
    """
    spark = docs.sparkSession
    prepare(spark)
    if folder is None:
        folder = scratch_dir(spark, "sequences")
        drop_on_exit(spark, folder)
    names = {id_col: "d", text_col: "x"}
    largest = max(end_id, largest_id(path))
    rows = docs.select(id_col, text_col).withColumnsRenamed(names)
    # A hash stands in for the text, so that the sample which finds the ranges holds no texts.
    rows = rows.withColumn("h", F.xxhash64("x")).repartitionByRange("d", "h").sortWithinPartitions("d", "h")
    rows = rows.select("d", "x", F.spark_partition_id().alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        store.create_dir(root, recursive=True)
        name = uuid.uuid4().hex
        sink = index = part = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if sink is None:
                part = batch.column(2)[0].as_py()
                target = store.open_output_stream(f"{root}/{name}.arrow")
                sink = SequenceFile(target, length, largest)
                entries = pa.schema([batch.schema.field(0), ("start", pa.int64()), ("n_tokens", pa.int64())])
                side = store.open_output_stream(f"{root}/{name}.index.arrow")
                index = pa.ipc.new_file(side, entries)
            texts = batch.column(1).to_pylist()
            for lo, hi in crop(texts, CHARS_PER_STEP):
                ids, counts = encoder(path).encode(texts[lo:hi])
                ends = np.cumsum(counts)
                # The end id goes in after each document's ids.
                starts = sink.ids + (ends - counts) + np.arange(len(counts))
                sink.add(np.insert(ids, ends, end_id))
                index.write_batch(batch_of(entries, [batch.column(0).slice(lo, hi - lo), starts, counts + 1]))
        if sink is not None:
            sink.close()
            index.close()
            target.close()
            side.close()
            columns = [[f"{name}.arrow"], [f"{name}.index.arrow"], [sink.ids], [sink.rows], [part]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32()))],
                names=["file", "index", "ids", "rows", "part"],
            )

    manifest = stored(rows.mapInArrow(run, MANIFEST), "sequence-manifest")
    # One row per task: a running sum over them fits in one task.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("ids").over(earlier), F.lit(0))
    return manifest.select(F.lit(folder).alias("folder"), "file", "index", "ids", "rows", start.alias("start"))


def read_documents(manifest: DataFrame, id_type: T.DataType = T.LongType(), id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files alone: its id, start, n_tokens and ids_crc32.

    ``start`` counts the ids of all documents before it. A file is one task's work and is read through
    slices of its buffers, so that memory is bounded by a record batch.
    """
    source = manifest.select("folder", "file", "index", "start")
    files = max(1, source.count())
    source = source.repartition(files)
    names = [id_col, "start", "n_tokens", "ids_crc32"]
    schema = T.StructType([T.StructField(id_col, id_type), *(T.StructField(n, T.LongType()) for n in names[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, root = open_folder(row["folder"])
                reader = SequenceReader(store, f"{root}/{row['file']}")
                with store.open_input_file(f"{root}/{row['index']}") as side:
                    index = pa.ipc.open_file(side)
                    for k in range(index.num_record_batches):
                        entries = index.get_batch(k)
                        starts = entries.column(1).to_numpy()
                        counts = entries.column(2).to_numpy()
                        sums = np.zeros(len(starts), np.int64)
                        for i, (a, n) in enumerate(zip(starts.tolist(), counts.tolist())):
                            value = 0
                            for ids in reader.stream(a, n):
                                value = zlib.crc32(ids.astype("<u4"), value)
                            sums[i] = value
                        yield pa.RecordBatch.from_arrays(
                            [entries.column(0), pa.array(starts + row["start"]), entries.column(2), pa.array(sums)],
                            names=names,
                        )
                reader.close()

    return source.mapInArrow(run, schema)


def read_sequences(manifest: DataFrame) -> DataFrame:
    """All rows of all files: file, row, ids and mask, a batch of rows at a time."""
    source = manifest.select("folder", "file")
    source = source.repartition(max(1, source.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                store, root = open_folder(entry["folder"])
                reader = SequenceReader(store, f"{root}/{entry['file']}")
                first = 0
                for k in range(reader.file.num_record_batches):
                    found = reader.file.get_batch(k)
                    for at in range(0, found.num_rows, ROWS_PER_BATCH):
                        part = found.slice(at, ROWS_PER_BATCH)
                        n = part.num_rows
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([entry["file"]] * n),
                                pa.array(np.arange(first + at, first + at + n)),
                                part.column(0).cast(pa.list_(pa.int64())),
                                part.column(1).cast(pa.list_(pa.int32())),
                            ],
                            names=["file", "row", "ids", "mask"],
                        )
                    first += found.num_rows
                reader.close()

    return source.mapInArrow(run, "file string, row long, ids array<long>, mask array<int>")
