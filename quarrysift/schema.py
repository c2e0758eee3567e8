"""Column layouts shared by the sources, the index and the queries."""

from __future__ import annotations

from pyspark.sql import types as T

#: One row per listed file. Paths are POSIX and relative to the project root.
LISTING = T.StructType(
    [
        T.StructField("file_path", T.StringType(), False),
        T.StructField("length", T.LongType()),
        T.StructField("mtime_us", T.LongType()),
    ]
)

#: One row per file that was read. ``content`` is NULL when ``error`` is set.
FILE = T.StructType(
    [
        T.StructField("file_path", T.StringType(), False),
        T.StructField("length", T.LongType()),
        T.StructField("mtime_us", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)

#: Position inside a text: offsets are 0-based, lines 1-based, columns 0-based.
POSITION = T.StructType(
    [
        T.StructField("byte_offset", T.IntegerType(), False),
        T.StructField("char_offset", T.IntegerType(), False),
        T.StructField("line", T.IntegerType(), False),
        T.StructField("column", T.IntegerType(), False),
    ]
)

#: One row per chunk before embedding. ``nth`` counts equal texts in one file.
CHUNK = T.StructType(
    [
        T.StructField("file_path", T.StringType(), False),
        T.StructField("language", T.StringType(), False),
        T.StructField("chunk_no", T.IntegerType(), False),
        T.StructField("nth", T.IntegerType(), False),
        T.StructField("content", T.StringType(), False),
        T.StructField("start", POSITION, False),
        T.StructField("end", POSITION, False),
    ]
)

#: Stored index rows; the last three are directory levels.
INDEX_ROW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("start_line", T.IntegerType()),
        T.StructField("end_line", T.IntegerType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("run", T.StringType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("language", T.StringType()),
    ]
)

#: Counts of one bucket and language of the index, by the run that wrote them.
COUNTS = T.StructType(
    [
        T.StructField("bucket", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("cnt", T.LongType()),
        T.StructField("files", T.LongType()),
        T.StructField("run", T.StringType()),
    ]
)

#: What the index knows about each file it has processed.
FILE_STATE = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("mtime_us", T.LongType()),
    ]
)

#: What a refresh did with each file.
ACTION = T.StructType([*FILE_STATE.fields, T.StructField("action", T.StringType())])

RESULT_COLUMNS = ["file_path", "language", "content", "start_line", "end_line", "score"]
