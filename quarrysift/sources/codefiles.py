"""A listed source tree as a data source: ``spark.read.format("codefiles")``.

    register(spark)
    save_listing(walk(spark, base, Selection()).files, listing)
    open_files(spark, base, listing, suffixes=[".py"], max_bytes=1000)

The listing is a Parquet folder that :func:`save_listing` splits by the bytes of the files, so a partition of the
source is a part of it and planning needs only the names of the parts. Prefixes, suffixes and the size cap are
options, and are tested in the listing: a file that they drop is never opened. What cannot be read has an ``error``.

Spark could push the filters of a query into the source by itself, but its version 4.1 then keeps those of one
query for the next one of the same DataFrame, if that has none to push, and rows are missing. So they are options.
"""

from __future__ import annotations

import functools
import json
import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as source

from ..schema import FILE, LISTING
from ..session import ship_package
from .tree import content_batches, spread


def _any(clauses: list[pc.Expression]) -> pc.Expression:
    return functools.reduce(operator.or_, clauses)


@dataclass(frozen=True)
class Wanted:
    """What paths begin with, what they end with, how long files are at most; empty for anything.

    A file whose size is unknown passes the cap.
    """

    prefixes: tuple[str, ...] = ()
    suffixes: tuple[str, ...] = ()
    max_bytes: int | None = None

    def expression(self) -> pc.Expression | None:
        """The test on the listing."""
        path, length = pc.field("file_path"), pc.field("length")
        tests = []
        if self.prefixes:
            tests.append(_any([pc.starts_with(path, p) for p in self.prefixes]))
        if self.suffixes:
            tests.append(_any([pc.ends_with(path, s) for s in self.suffixes]))
        if self.max_bytes is not None:
            tests.append(length.is_null() | (length <= self.max_bytes))
        return functools.reduce(operator.and_, tests) if tests else None


def _opened(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder:
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder.removeprefix("file:")


@dataclass
class ListingPart(source.InputPartition):
    path: str


class CodeFilesReader(source.DataSourceReader):
    def __init__(self, base: str, listing: str, wanted: Wanted) -> None:
        self.base, self.listing, self.wanted = base, listing, wanted

    def partitions(self) -> Sequence[ListingPart]:
        files, folder = _opened(self.listing)
        found = files.get_file_info(pafs.FileSelector(folder))
        return [ListingPart(f.path) for f in sorted(found, key=lambda f: f.path) if f.base_name.endswith(".parquet")]

    def read(self, partition: ListingPart | None) -> Iterator[pa.RecordBatch]:
        # An empty listing is planned as one partition of nothing.
        if partition is None:
            return
        part = ds.dataset(partition.path, format="parquet", filesystem=_opened(self.listing)[0])
        yield from content_batches(self.base, part.to_batches(columns=LISTING.names, filter=self.wanted.expression()))


class CodeFiles(source.DataSource):
    """Files of a listing (``load``) below a directory that all executors mount (option ``base``).

    Options ``prefixes`` and ``suffixes`` are JSON lists, ``maxBytes`` is a number.
    """

    @classmethod
    def name(cls) -> str:
        return "codefiles"

    def schema(self):
        return FILE

    def reader(self, schema) -> CodeFilesReader:
        missing = [name for name in ("base", "path") if not self.options.get(name)]
        if missing:
            raise ValueError(f"codefiles needs {' and '.join(missing)}")
        lists = (tuple(json.loads(self.options.get(name) or "[]")) for name in ("prefixes", "suffixes"))
        cap = self.options.get("maxBytes")
        wanted = Wanted(*lists, max_bytes=int(cap) if cap else None)
        return CodeFilesReader(self.options["base"], self.options["path"], wanted)


def register(spark: SparkSession) -> None:
    """Make the source known to a session."""
    ship_package(spark)
    spark.dataSource.register(CodeFiles)


def open_files(
    spark: SparkSession,
    base: str,
    listing: str,
    prefixes: Sequence[str] = (),
    suffixes: Sequence[str] = (),
    max_bytes: int | None = None,
) -> DataFrame:
    """The files of a stored listing that are wanted, with their bytes."""
    register(spark)
    reader = spark.read.format("codefiles").option("base", base)
    reader = reader.option("prefixes", json.dumps(list(prefixes))).option("suffixes", json.dumps(list(suffixes)))
    if max_bytes is not None:
        reader = reader.option("maxBytes", str(max_bytes))
    return reader.load(listing)


def save_listing(listing: DataFrame, folder: str) -> None:
    """Store a listing in parts of about equal bytes and counts of files."""
    spread(listing.select(*LISTING.names)).write.parquet(folder)
