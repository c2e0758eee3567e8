"""Splitting file texts into chunks."""

from __future__ import annotations

import importlib
import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, UserDefinedTableFunction

from ..functions.text import decoded, is_not_blank, path_suffix
from ..schema import CHUNK

# Sizes in characters.
CHUNK_SIZE = 1000
MIN_CHUNK_SIZE = 250
CHUNK_OVERLAP = 150

_SPACE = " \t\n\r\f\v"
_ROWS_PER_BATCH = 2_000

# How a top-level definition starts, for languages where a chunk should rather
# begin at one.
_DEFINITION = {
    "python": r"(?:async\s+def|def|class|@)\b|@",
    "rust": r"(?:pub|fn|struct|enum|trait|impl|mod|#\[)",
    "go": r"(?:func|type|var|const)\b",
    "java": r"(?:public|private|protected|class|interface|enum|abstract|final|@)",
    "javascript": r"(?:export|function|class|const|let|var|async)\b",
    "c": r"[A-Za-z_][\w\s*]*\(",
    "ruby": r"(?:def|class|module)\b",
    "php": r"(?:function|class|interface|trait|abstract|final)\b",
    "scala": r"(?:object|class|trait|def|case)\b",
    "sql": r"(?i:create|alter|insert|select|with|update|delete)\b",
    "markdown": r"#",
    "toml": r"\[",
}
_DEFINITION["typescript"] = _DEFINITION["tsx"] = _DEFINITION["javascript"]
_DEFINITION["kotlin"] = _DEFINITION["csharp"] = _DEFINITION["dart"] = _DEFINITION["java"]
_DEFINITION["cpp"] = _DEFINITION["c"]
_DEFINITION = {language: re.compile(start) for language, start in _DEFINITION.items()}


@dataclass(frozen=True)
class Position:
    byte_offset: int
    char_offset: int
    line: int
    column: int


@dataclass(frozen=True)
class Chunk:
    text: str
    start: Position
    end: Position


#: A custom chunker: path and text to a language (None keeps the detected one)
#: and the chunks.
Chunker = Callable[[PurePosixPath, str], tuple[str | None, list[Chunk]]]


def _pieces(text: str, language: str, limit: int) -> list[tuple[int, int]]:
    """(offset, rank) of every place a chunk may start; the higher, the better.

    0: inside a long line, 1: at a line, 2: after a blank line, 3: at a line
    that starts a definition of the language.
    """
    definition = _DEFINITION.get(language)
    long_line = re.compile(rf"(?s).{{1,{limit}}}\Z|.{{0,{limit - 1}}}[ \t\n\r\f\v]|.{{1,{limit}}}")
    places, offset, after_blank = [], 0, False
    for line in text.split("\n"):
        rank = 3 if definition is not None and definition.match(line) else 1 + after_blank
        places.append((offset, rank))
        if len(line) + 1 > limit:
            inner = [offset + m.start() for m in long_line.finditer(line + "\n")]
            places.extend((at, 0) for at in inner[1:])
        after_blank = not line.strip(_SPACE)
        offset += len(line) + 1
    return places


def split_spans(
    text: str,
    language: str = "text",
    size: int = CHUNK_SIZE,
    minimum: int = MIN_CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
) -> list[tuple[int, int]]:
    """Character spans of the default splitter.

    Each step takes up to ``size - overlap`` characters and ends at the best
    place at least ``minimum`` characters on, the last one of equal rank. A
    chunk starts with whole pieces of at most ``overlap`` characters that end
    the one before. Surrounding white space is trimmed, blank chunks go.
    """
    limit = size - overlap
    places = _pieces(text, language, limit)
    starts, n, i = [0], len(places), 0
    while len(text) - places[i][0] > limit:
        base, best, j = places[i][0], None, i + 1
        while j < n and places[j][0] - base <= limit:
            grown = places[j][0] - base >= minimum
            rank = places[j][1] if grown else -1
            if best is None or rank >= best[0]:
                best = (rank, j)
            j += 1
        if best is None:
            break
        i = best[1]
        starts.append(i)
    spans = []
    for k, i in enumerate(starts):
        end = places[starts[k + 1]][0] if k + 1 < len(starts) else len(text)
        begin = i
        while k and begin - 1 > starts[k - 1] and places[i][0] - places[begin - 1][0] <= overlap:
            begin -= 1
        start = places[begin][0]
        body = text[start:end]
        left = len(body) - len(body.lstrip(_SPACE))
        right = len(body.rstrip(_SPACE))
        if right > left:
            spans.append((start + left, start + right))
    return spans


def default_chunks(text: str, language: str, **sizes: int) -> list[Chunk]:
    """Chunks of the default splitter with their positions."""
    seen = (0, 0, 1, 0)

    def position(offset: int) -> Position:
        nonlocal seen
        at, byte, line, line_start = seen
        if offset < at:
            # Overlaps reach back less than one chunk.
            gap = text[offset:at]
            byte -= len(gap.encode())
            line -= gap.count("\n")
            line_start = text.rfind("\n", 0, offset) + 1
        else:
            gap = text[at:offset]
            byte += len(gap.encode())
            line += gap.count("\n")
            last = gap.rfind("\n")
            line_start = line_start if last < 0 else at + last + 1
        seen = (offset, byte, line, line_start)
        return Position(byte, offset, line, offset - line_start)

    chunks = []
    for start, end in split_spans(text, language, **sizes):
        chunks.append(Chunk(text[start:end], position(start), position(end)))
    return chunks


def load_chunker(reference: str) -> Chunker:
    """The callable named by ``module.path:name``."""
    module, _, name = reference.partition(":")
    if not module or not name:
        raise ValueError(f"chunker must be 'module:callable', got {reference!r}")
    found = getattr(importlib.import_module(module), name, None)
    if not callable(found):
        raise ValueError(f"chunker {reference!r} is not callable")
    return found


def chunk_rows(
    path: str, language: str, text: str, chunkers: Mapping[str, Chunker], sizes: Mapping[str, int]
) -> Iterator[tuple]:
    """The chunks of one file as rows of :data:`quarrysift.schema.CHUNK`, without the path."""
    pure = PurePosixPath(path)
    chunker = chunkers.get(pure.suffix)
    if chunker is None:
        found = default_chunks(text, language, **sizes)
    else:
        override, found = chunker(pure, text)
        language = language if override is None else override
    seen: Counter[str] = Counter()
    for number, chunk in enumerate(found):
        yield language, number, seen[chunk.text], chunk.text, vars(chunk.start), vars(chunk.end)
        seen[chunk.text] += 1


def chunk_files(
    texts: DataFrame, chunkers: Mapping[str, Chunker] | None = None, **sizes: int
) -> DataFrame:
    """Chunks of ``texts`` (``file_path``, ``language``, ``content`` as text).

    ``chunkers`` maps a suffix such as ``.toml`` to a custom chunker, which then
    decides alone about sizes, and about the language unless it returns None.
    """
    table = dict(chunkers or {})
    schema = to_arrow_schema(CHUNK)

    def run(batches):
        rows = []
        for batch in batches:
            for path, language, text in zip(*(column.to_pylist() for column in batch.columns)):
                for row in chunk_rows(path, language, text, table, sizes):
                    rows.append(dict(zip(CHUNK.names, (path, *row))))
                    if len(rows) >= _ROWS_PER_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return texts.select("file_path", "language", "content").mapInArrow(run, CHUNK)


def chunk_function(
    chunkers: Mapping[str, Chunker] | None = None, **sizes: int
) -> UserDefinedTableFunction:
    """The chunkers as a table function of path, language and text, for LATERAL joins.

    ``spark.udtf.register("chunks", chunk_function({".toml": my_chunker}))`` makes it known to SQL::

        SELECT f.file_path, c.* FROM files f, LATERAL chunks(f.file_path, f.language, f.content) c

    It gives the columns of :data:`quarrysift.schema.CHUNK` without the path. Whether the arguments are
    texts is checked when the query is analysed. A file without path or text has no chunks; without a
    language it is plain text.
    """
    table = dict(chunkers or {})
    schema = T.StructType([f for f in CHUNK.fields if f.name != "file_path"])

    class ChunkFile:
        @staticmethod
        def analyze(path: AnalyzeArgument, language: AnalyzeArgument, content: AnalyzeArgument) -> AnalyzeResult:
            for name, argument in (("path", path), ("language", language), ("content", content)):
                if argument.isTable or not isinstance(argument.dataType, (T.StringType, T.NullType)):
                    raise ValueError(f"chunk function: {name} must be a string, not {argument.dataType}")
            return AnalyzeResult(schema)

        def eval(self, path: str | None, language: str | None, content: str | None) -> Iterator[tuple]:
            if path is not None and content is not None:
                yield from chunk_rows(path, language or "text", content, table, sizes)

    return F.udtf(ChunkFile, useArrow=True)


def lateral_chunks(texts: DataFrame, function: UserDefinedTableFunction) -> DataFrame:
    """Each file of ``texts`` with its chunks by a table function; its other columns stay beside them."""
    names = {"language": "given_language", "content": "given_content"}
    given = texts.withColumnsRenamed(names)
    chunks = function(*(F.col(name).outer() for name in ("file_path", *names.values())))
    return given.lateralJoin(chunks).drop(*names.values())


def readable(files: DataFrame) -> DataFrame:
    """Files with bytes in ``content`` as text: undecodable and blank ones go."""
    text = files.withColumn("content", decoded(F.col("content")))
    return text.where(F.col("content").isNotNull() & is_not_blank(F.col("content")))


def section_chunks(files: DataFrame, header: str = r"^\[(?!\[)") -> DataFrame:
    """Section chunks of ``files``: the TOML chunker as one projection.

    A section starts at a line that matches ``header`` and ends before the next one; lines before
    the first belong to none. A file without any header is one chunk. Text is trimmed, blank
    sections go. The text is split at headers as a whole, so no line is looked at by itself and nothing moves.
    """
    # Lines end at \n only, also for the anchors of the pattern.
    begins = rf"(?md)(?=[^\n]*?(?:{header}))"
    n_lines = F.size(F.split(F.regexp_replace("content", r"\n\z", ""), "\n", -1))
    split = files.select(
        "file_path",
        n_lines.alias("n_lines"),
        F.split("content", rf"(?md)\n(?=[^\n]*?(?:{header}))", -1).alias("parts"),
        F.regexp_like("content", F.lit(rf"\A{begins}")).alias("at_once"),
    )
    # Lines before each part: one more is added for every part and every break in it.
    inside = F.transform("parts", lambda p: F.length(p) - F.length(F.replace(p, F.lit("\n"), F.lit(""))) + 1)
    starts = F.aggregate(inside, F.array(F.lit(0)), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))
    placed = split.withColumn("starts", starts)
    rows = placed.select(
        "file_path", "n_lines", "starts", "at_once", F.size("parts").alias("n"), F.posexplode("parts").alias("at", "part")
    )
    whole = (F.col("n") == 1) & ~F.col("at_once")
    trimmed = F.regexp_replace(F.regexp_replace("part", r"\A\s+", ""), r"\s+\z", "")
    return (
        rows.where(F.col("at_once") | (F.col("at") > 0) | whole)
        .select(
            "file_path",
            F.when(whole, 1).otherwise(F.col("at") + F.col("at_once").cast("int")).alias("section"),
            (F.get("starts", F.col("at")) + 1).alias("start_line"),
            F.least(F.get("starts", F.col("at") + 1), "n_lines").alias("end_line"),
            F.when(whole, F.col("part")).otherwise(trimmed).alias("content"),
        )
        .where(F.col("content") != "")
    )


def suffix_chunkers(files: DataFrame, chunkers: Mapping[str, Chunker]) -> DataFrame:
    """The files a custom chunker is registered for."""
    return files.where(path_suffix(F.col("file_path")).isin(list(chunkers)))
