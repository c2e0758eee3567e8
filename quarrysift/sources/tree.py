"""Directory trees on storage that every executor mounts at the same path.

The built-in binary file source hides names that begin with ``_`` or ``.``, so
``__init__.py`` would never be seen. Here the tree is listed level by level:
the directories of one level are rows, executors list them in parallel, write
the files and directories they find, and the directories become the next level.
The driver only ever sees counts. Excluded and ignored directories are not
entered. A level that was written survives the loss of any executor.
"""

from __future__ import annotations

import contextlib
import functools
import os
import re
import stat
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import parent_dir
from ..schema import FILE, LISTING
from ..session import scratch_dir
from .ignore import IGNORE_FILE, is_ignored
from .selection import Selection
from .storage import Storage

_LEVEL = (
    "kind string, file_path string, length bigint, mtime_us bigint, rule_dirs array<string>"
)
_ENTRIES_PER_BATCH = 20_000
_BYTES_PER_BATCH = 16 << 20
_DIRS_PER_TASK = 64
_TASKS_PER_CORE = 4
_FILES_PER_TASK = 2_000
_BYTES_PER_TASK = 128 << 20


@functools.lru_cache(maxsize=2048)
def _ignore_text(base: str, directory: str) -> str | None:
    """Text of the ignore file in ``directory``; None where there is none."""
    path = os.path.join(base, directory, IGNORE_FILE)
    if not os.path.isfile(path):
        return None
    with open(path, "rb") as file:
        raw = file.read()
    try:
        return raw.decode()
    except UnicodeDecodeError:
        # What is not text holds no rules.
        return ""


def _stat(path: str) -> tuple[int | None, int | None]:
    try:
        info = os.stat(path)
    except OSError:
        return None, None
    return info.st_size, info.st_mtime_ns // 1000


def _require(base: str) -> None:
    """Fail where the tree is not mounted, instead of finding it empty."""
    if not os.path.isdir(base):
        raise FileNotFoundError(f"{base} is not a directory on this executor")


def _children(base: str, directory: str, rule_dirs: list[str], selection: Selection):
    """Rows for what one directory holds."""
    chain_dirs = list(rule_dirs)
    chain = []
    try:
        # A directory without its rules would let ignored files in.
        has_rules = _ignore_text(base, directory) is not None
        if has_rules:
            chain_dirs.append(directory)
        if selection.ignore_files:
            chain = [(d, _ignore_text(base, d) or "") for d in chain_dirs]
        entries = os.scandir(os.path.join(base, directory))
    except OSError:
        yield "error", directory, None, None, None
        return
    if has_rules:
        yield "rules", directory, None, None, None
    with entries:
        for entry in entries:
            path = f"{directory}/{entry.name}" if directory else entry.name
            try:
                is_dir = entry.is_dir()
            except OSError:
                is_dir = False
            if is_dir:
                if entry.is_symlink() or not selection.dir_passes(path):
                    continue
                if not is_ignored(path, True, chain):
                    yield "dir", path, None, None, chain_dirs
                continue
            if not selection.file_passes(path, None) or is_ignored(path, False, chain):
                continue
            length, mtime = _stat(entry.path)
            if selection.size_passes(length):
                yield "file", path, length, mtime, None


@dataclass
class Walk:
    """A finished listing: the files, and the directories with an ignore file.

    ``unlisted`` has the directories that could not be listed or whose ignore file could not
    be read. All read what was written under ``folder``; call :meth:`release` when done.
    """

    files: DataFrame
    rule_dirs: DataFrame
    unlisted: DataFrame
    folder: str

    def release(self) -> None:
        Storage(self.files.sparkSession, self.folder).delete()


def walk(spark: SparkSession, base: str, selection: Selection, start: str = "") -> Walk:
    """List the files under ``base/start`` that ``selection`` admits.

    Paths are relative to ``base``. When ``start`` itself is excluded nothing
    is listed.
    """
    base = os.path.abspath(base)
    schema = pa.schema(
        [
            ("kind", pa.string()),
            ("file_path", pa.string()),
            ("length", pa.int64()),
            ("mtime_us", pa.int64()),
            ("rule_dirs", pa.list_(pa.string())),
        ]
    )

    def list_level(batches):
        # Workers outlive a walk, and ignore files may have been edited since.
        _ignore_text.cache_clear()
        _require(base)
        rows = []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for directory, rule_dirs in zip(*(c.to_pylist() for c in batch.columns)):
                for row in _children(base, directory, rule_dirs, selection):
                    rows.append(row)
                    if len(rows) >= _ENTRIES_PER_BATCH:
                        yield packed()
                        rows = []
        if rows:
            yield packed()

    # Ignore files between base and start apply as well.
    _ignore_text.cache_clear()
    above = []
    parts = start.split("/") if start else []
    for depth in range(len(parts)):
        directory = "/".join(parts[:depth])
        if _ignore_text(base, directory) is not None:
            above.append(directory)
    chain = [(d, _ignore_text(base, d) or "") for d in above] if selection.ignore_files else []
    entered = not start or (selection.dir_passes(start) and not is_ignored(start, True, chain))

    target = scratch_dir(spark, "walk")
    level, n_dirs = 0, int(entered)
    frontier = spark.createDataFrame([(start, above)], "file_path string, rule_dirs array<string>")
    while n_dirs:
        # A directory may hold any number of files, so a few of them are enough for a task.
        tasks = max(-(-n_dirs // _DIRS_PER_TASK), min(n_dirs, _TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
        if tasks > 1:
            frontier = frontier.repartition(tasks)
        frontier.mapInArrow(list_level, _LEVEL).write.parquet(f"{target}/level={level}")
        frontier = (
            spark.read.schema(_LEVEL)
            .parquet(f"{target}/level={level}")
            .where("kind = 'dir'")
            .select("file_path", "rule_dirs")
        )
        n_dirs = frontier.count()
        level += 1
    if level:
        found = spark.read.schema(_LEVEL).parquet(*[f"{target}/level={n}" for n in range(level)])
    else:
        found = spark.createDataFrame([], _LEVEL)
    return Walk(
        found.where("kind = 'file'").select(*LISTING.names),
        found.where("kind = 'rules'").select("file_path"),
        found.where("kind = 'error'").select("file_path"),
        target,
    )


def single_file(spark: SparkSession, path: str) -> DataFrame:
    """A listing of exactly one file, past every rule and cap."""
    length, mtime = _stat(path)
    return spark.createDataFrame([(os.path.basename(path), length, mtime)], LISTING)


def spread(listing: DataFrame) -> DataFrame:
    """A listing in partitions by file count and bytes, so that neither a huge directory nor many large
    files end up in one task."""
    total = listing.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    tasks = max(
        1, -(-total["n"] // _FILES_PER_TASK), -(-(total["bytes"] or 0) // _BYTES_PER_TASK)
    )
    return listing.repartition(tasks, "file_path")


def content_batches(base: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files of listing rows with their bytes, in batches of bounded size."""
    schema = pa.schema(
        [
            ("file_path", pa.string()),
            ("length", pa.int64()),
            ("mtime_us", pa.int64()),
            ("content", pa.binary()),
            ("error", pa.string()),
        ]
    )
    _require(base)
    rows, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            path = os.path.join(base, row["file_path"])
            row["content"] = row["error"] = None
            try:
                mode = os.stat(path).st_mode
                if not (stat.S_ISREG(mode) or stat.S_ISDIR(mode)):
                    raise OSError("not a regular file")
                with open(path, "rb") as file:
                    row["content"] = file.read()
                size += len(row["content"])
            except OSError as exc:
                row["error"] = str(exc)
            rows.append(row)
            if size >= _BYTES_PER_BATCH or len(rows) >= _ENTRIES_PER_BATCH:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_files(listing: DataFrame, base: str) -> DataFrame:
    """Read the listed files; one that cannot be read gives an ``error`` row."""
    base = os.path.abspath(base)
    return spread(listing.select(*LISTING.names)).mapInArrow(functools.partial(content_batches, base), FILE)


def mounted(location: str) -> str:
    """The path of a folder on a file system that is mounted everywhere."""
    path = re.sub(r"\Afile:(?://)?(?=/)", "", location)
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path):
        raise ValueError(f"{location} is not a mounted directory")
    return path


def write_files(files: DataFrame, base: str) -> None:
    """Write ``content`` to ``file_path`` below ``base``, where tasks run; null rows write nothing.

    A task that runs again replaces its files as a whole. Paths must be relative and stay below ``base``.
    A file is written beside its place, since a rename between directories locks the whole file system.
    """
    base = os.path.abspath(base)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for row in batch.to_pylist():
                if row["file_path"] is None or row["content"] is None:
                    continue
                target = os.path.normpath(os.path.join(base, row["file_path"]))
                if not target.startswith(base + os.sep):
                    raise ValueError(f"{row['file_path']!r} is not below the tree")
                directory = os.path.dirname(target)
                own = os.path.join(directory, f".{uuid.uuid4().hex}")
                os.makedirs(directory, exist_ok=True)
                with open(own, "wb") as file:
                    file.write(row["content"])
                os.replace(own, target)
                done += 1
            yield pa.RecordBatch.from_pydict({"done": pa.array([done], pa.int64())})

    os.makedirs(base, exist_ok=True)
    files.select("file_path", "content").mapInArrow(write, "done bigint").agg(F.sum("done")).first()


def empty_dirs(listing: DataFrame, base: str) -> None:
    """Remove every file in the directories that listed files lie in, a directory in a task; those gone do not count.

    Directories stay. In its own order a directory is emptied far faster than file by file from several tasks.
    """
    base = os.path.abspath(base)

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _require(base)
        for batch in batches:
            for directory in batch.column(0).to_pylist():
                with contextlib.suppress(FileNotFoundError), os.scandir(os.path.join(base, directory)) as entries:
                    for entry in entries:
                        if not entry.is_dir(follow_symlinks=False):
                            with contextlib.suppress(FileNotFoundError):
                                os.unlink(entry.path)
            yield pa.RecordBatch.from_pydict({"done": pa.array([batch.num_rows], pa.int64())})

    dirs = listing.select(parent_dir(F.col("file_path")).alias("dir")).distinct()
    tasks = _TASKS_PER_CORE * listing.sparkSession.sparkContext.defaultParallelism
    dirs.repartition(tasks).mapInArrow(remove, "done bigint").agg(F.sum("done")).first()
