"""The chunk index: plain Parquet folders, one per bucket of paths.

A path belongs to a bucket by its hash, and a bucket's rows lie in one folder, by language. A refresh
writes the buckets with changed files anew, each as a whole: what stays of it, and the chunks of new and changed
files. Buckets without changes are not touched. A small file, written last and only if no other writer came
first, says which folder each bucket has; so a search during a refresh reads the index as it was,
and a refresh that dies leaves nothing visible. The folders of the snapshot before are kept for readers that
still use them, older ones go.

    snapshots/00000003.json                    where each bucket lies, and settings
    chunks/run=00000003-x/bucket=7/language=y/ rows
    counts/run=00000003-x/                     chunks and files per bucket and language, for status
    state/run=00000003-x/                      what the refresh did with each file, with its fingerprint
    vectors/run=00000003-x/                    vectors by text, for embedders that ask
"""

from __future__ import annotations

import contextlib
import hashlib
import inspect
import json
import math
import re
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import Future
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.languages import language_of
from ..functions.text import ancestor_dirs, parent_dir
from ..operators import chunking, embedding, stats
from ..operators.diff import diff
from ..operators.search import SearchSpec, search
from ..schema import ACTION, COUNTS, FILE, FILE_STATE, INDEX_ROW
from ..sources.storage import Storage
from ..sources.tree import read_files

COUNTERS = [
    "num_execution_starts",
    "num_adds",
    "num_deletes",
    "num_reprocesses",
    "num_unchanged",
    "num_errors",
]

Progress = Callable[[dict[str, int]], None]
#: Gives the files at some paths, or all of them, with their content. A second reading of
#: files that may have changed or gone meanwhile is stored in the folder it is given.
Reader = Callable[[DataFrame | None, str], DataFrame]

# A bucket holds about this many bytes of files.
BUCKET_BYTES = 256 << 20
# A task reads and writes about this many bytes of files, all of one bucket.
TASK_BYTES = 64 << 20
# Buckets are folders that the driver lists; beyond this number they grow and several tasks write each.
MOST_BUCKETS = 1 << 14
# Snapshots whose folders are kept.
KEPT_SNAPSHOTS = 2
# Seconds between two reports on tasks.
REPORT_SECONDS = 0.1

_locks: dict[str, threading.Lock] = {}
_first_runs: dict[str, Future] = {}
_locks_guard = threading.Lock()


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    logic: str = ""
    dim: int = 0
    n_buckets: int = 1
    folders: dict[str, str] = field(default_factory=dict)
    vectors: list[str] = field(default_factory=list)
    state: str = ""
    n_files: int = 0


@dataclass(frozen=True)
class SearchResponse:
    success: bool
    results: list[dict[str, Any]] = field(default_factory=list)
    total_returned: int = 0
    offset: int = 0
    message: str | None = None


class Index:
    """One index at one location."""

    def __init__(
        self,
        spark: SparkSession,
        location: str,
        embedder: embedding.Embedder | None = None,
        params: embedding.Params | None = None,
        overrides: Mapping[str, str] | None = None,
        chunkers: Mapping[str, chunking.Chunker] | None = None,
        sizes: Mapping[str, int] | None = None,
    ) -> None:
        self.spark = spark
        self.location = location.rstrip("/")
        self.storage = Storage(spark, self.location)
        self.embedder = embedder or embedding.HashEmbedder()
        self.params = params or embedding.Params()
        self.overrides = dict(overrides or {})
        self.chunkers = dict(chunkers or {})
        self.sizes = dict(sizes or {})
        with _locks_guard:
            self._lock = _locks.setdefault(self.location, threading.Lock())

    # Snapshots

    def snapshot(self) -> Snapshot | None:
        """The newest snapshot, None before the first refresh has finished."""
        names = self._snapshots()
        return self._load(names[-1]) if names else None

    def _snapshots(self) -> list[str]:
        return [n for n in self.storage.names("snapshots") if re.fullmatch(r"\d+\.json", n)]

    def _load(self, name: str) -> Snapshot:
        return Snapshot(**json.loads(self.storage.read(f"snapshots/{name}")))

    def logic(self) -> str:
        """Changes when stored chunks would come out differently."""
        parts = {
            "embedder": self.embedder.fingerprint(self.params.indexing),
            "sizes": sorted(self.sizes.items()),
            "overrides": sorted(self.overrides.items()),
            "chunkers": [
                (suffix, f"{fn.__module__}:{getattr(fn, '__qualname__', '')}", _source(fn))
                for suffix, fn in sorted(self.chunkers.items())
            ],
        }
        return hashlib.sha256(json.dumps(parts).encode()).hexdigest()

    def _folders(self, kind: str, runs: Sequence[str]) -> list[str]:
        return [f"{self.location}/{kind}/run={run}" for run in runs]

    def chunks(self, snapshot: Snapshot | None = None) -> DataFrame:
        """The rows of a snapshot."""
        snapshot = snapshot or self.snapshot()
        if snapshot is None:
            raise RuntimeError(f"Index not found at {self.location}. Refresh it first.")
        return self._rows(snapshot.folders)

    def _rows(self, folders: Mapping[str, str]) -> DataFrame:
        columns = [c for c in INDEX_ROW.names if c not in ("run", "bucket")]
        if not folders:
            return self.spark.createDataFrame([], INDEX_ROW).select(*columns)
        paths = [f"{self.location}/chunks/run={run}/bucket={bucket}" for bucket, run in folders.items()]
        rows = self.spark.read.schema(INDEX_ROW).option("basePath", f"{self.location}/chunks").parquet(*paths)
        return rows.select(*columns)

    def counts(self, snapshot: Snapshot) -> DataFrame:
        """Chunks and files per bucket and language as the refreshes that wrote the buckets counted them.

        Without its count a snapshot is counted by a scan.
        """
        runs = sorted(set(snapshot.folders.values()))
        known = set(self.storage.names("counts"))
        if not runs or any(f"run={run}" not in known for run in runs):
            return stats.partial_counts(self._rows(snapshot.folders))
        held = self.spark.createDataFrame(list(snapshot.folders.items()), "bucket string, run string")
        read = self.spark.read.schema(COUNTS).option("basePath", f"{self.location}/counts")
        return read.parquet(*self._folders("counts", runs)).join(held, ["run", "bucket"], "left_semi")

    def state(self, snapshot: Snapshot | None = None) -> DataFrame:
        """Fingerprint, size and time of every file that the snapshot has read."""
        snapshot = snapshot or self.snapshot()
        if snapshot is None or not snapshot.state:
            return self.spark.createDataFrame([], FILE_STATE)
        done = self.spark.read.schema(ACTION).parquet(*self._folders("state", [snapshot.state]))
        return done.where("action <> 'delete' AND fingerprint IS NOT NULL").select(*FILE_STATE.names)

    # Refresh

    def refresh(self, files: DataFrame, progress: Progress | None = None) -> dict[str, int]:
        """Bring the index in line with a file table and give the counters.

        ``files`` has the columns of :data:`quarrysift.schema.FILE`, one row per
        path. It is read once for fingerprints, which are made in the scan, so that no text moves to
        be compared, and once for the files that need work. A file whose size and time (if it has
        one) are those of the last refresh is taken as unchanged.

        ``progress`` gets the counters before the work on texts begins, and then, while tasks run, the counters
        with ``tasks`` and ``tasks_done``. Callers that come while the first refresh runs
        get its counters and start none of their own.
        """

        def run() -> dict[str, int]:
            snapshot = self.snapshot()
            current = _marked(files)
            if snapshot is not None and snapshot.logic == self.logic():
                known = self.state(snapshot).where("mtime_us IS NOT NULL")
                known = known.withColumnRenamed("fingerprint", "kept")
                current = current.join(known, ["file_path", "length", "mtime_us"], "left").select(
                    "file_path", F.coalesce("kept", "fingerprint").alias("fingerprint"), "length", "mtime_us"
                )
            return self._apply(snapshot, current, lambda paths, _: _only(files, paths), progress)

        return self._one_at_a_time(run)

    def refresh_tree(
        self,
        listing: DataFrame,
        base: str,
        progress: Progress | None = None,
        unlisted: DataFrame | None = None,
    ) -> dict[str, int]:
        """As :meth:`refresh` for a listed directory tree; unchanged files are not opened.

        ``unlisted`` has the directories (``file_path``) that could not be listed: what the index holds
        of files below them stays, and each of these files counts as an error.
        """

        def run() -> dict[str, int]:
            snapshot = self.snapshot()
            rows, same = listing, None
            if snapshot is not None and snapshot.logic == self.logic():
                marks = ["file_path", "length", "mtime_us"]
                known = self.state(snapshot)
                same = known.join(listing.select(*marks), marks, "left_semi")
                rows = listing.join(known.select(*marks), marks, "left_anti")
            current = _marked(read_files(rows, base))
            if same is not None:
                current = current.unionByName(same)
            if unlisted is not None and snapshot is not None:
                current = current.unionByName(self._below(snapshot, unlisted))

            def read(paths: DataFrame | None, folder: str) -> DataFrame:
                # What was read is kept, so that fingerprint and chunks come from the same bytes.
                read_files(_only(listing, paths), base).write.parquet(folder)
                return self.spark.read.schema(FILE).parquet(folder)

            return self._apply(snapshot, current, read, progress, reread=True)

        return self._one_at_a_time(run)

    def _one_at_a_time(self, run: Callable[[], dict[str, int]]) -> dict[str, int]:
        """One refresh of an index at a time; those that wait for the first one share its outcome."""
        with _locks_guard:
            first = _first_runs.get(self.location)
            mine = None
            if first is None and self.snapshot() is None:
                mine = _first_runs[self.location] = Future()
        if first is not None:
            return dict(first.result())
        with self._lock:
            try:
                counters = run()
            except BaseException as exc:
                if mine is not None:
                    mine.set_exception(exc)
                raise
            else:
                if mine is not None:
                    mine.set_result(counters)
                return counters
            finally:
                if mine is not None:
                    with _locks_guard:
                        del _first_runs[self.location]

    def _below(self, snapshot: Snapshot, unlisted: DataFrame) -> DataFrame:
        """Rows without fingerprint for the indexed files below directories that could not be listed."""
        above = F.explode(ancestor_dirs(parent_dir(F.col("file_path")))).alias("dir")
        held = self.state(snapshot).select("file_path", "length", "mtime_us", above)
        lost = held.join(unlisted.select(F.col("file_path").alias("dir")), "dir", "left_semi")
        lost = lost.select("file_path", "length", "mtime_us").distinct()
        return lost.withColumn("fingerprint", F.lit(None).cast("string"))

    def _apply(
        self,
        snapshot: Snapshot | None,
        current: DataFrame,
        read: Reader,
        progress: Progress | None = None,
        reread: bool = False,
    ) -> dict[str, int]:
        run = f"{(snapshot or Snapshot()).version + 1:08d}-{uuid.uuid4().hex[:8]}"
        done = False
        try:
            counters, new = self._staged(snapshot, current, read, progress, reread, run)
            if new is not None:
                self._commit(new)
                done = True
            return counters
        finally:
            # Whatever a refresh needed on its way goes, and all it wrote when it fails.
            self.storage.delete(f"staging/run={run}")
            if not done:
                for kind in ("state", "chunks", "counts", "vectors"):
                    self.storage.delete(f"{kind}/run={run}")
            else:
                self._clean()

    def _staged(
        self,
        snapshot: Snapshot | None,
        current: DataFrame,
        read: Reader,
        progress: Progress | None,
        reread: bool,
        run: str,
    ) -> tuple[dict[str, int], Snapshot | None]:
        logic = self.logic()
        base = snapshot or Snapshot()
        rebuild = base.logic != logic
        staged = f"{self.location}/staging/run={run}"
        (state,) = self._folders("state", [run])

        # Small columns only. What is written is the new state, and everything after reads it.
        first = f"{staged}/actions" if reread else state
        self._actions(self.state(base if snapshot else None), current, rebuild).write.parquet(first)
        actions = self.spark.read.schema(ACTION).parquet(first)
        counters = stats.action_counters(actions).first().asDict()
        if progress is not None:
            progress(dict(counters))
        n_todo = counters["num_adds"] + counters["num_reprocesses"]
        if snapshot is not None and not rebuild and not n_todo + counters["num_deletes"]:
            return counters, None

        new = replace(base, version=base.version + 1, logic=logic, state=run)
        if rebuild:
            # Files that failed to read this time are left out until they can be read.
            size = actions.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
            buckets = min(MOST_BUCKETS, max(1, math.ceil(size / BUCKET_BYTES)))
            new = replace(new, folders={}, vectors=[], dim=0, n_buckets=buckets)
        files = None
        if n_todo:
            if rebuild:
                dim, problem = embedding.check_embedder(self.spark, self.embedder, **self.params.indexing)
                if not dim:
                    raise RuntimeError(f"embedder {self.embedder.name} failed: {problem}")
                new = replace(new, dim=dim)
            todo = actions.where("action IN ('add', 'reprocess')").select("file_path")
            everything = snapshot is None and not counters["num_errors"]
            files = read(None if everything else todo, f"{staged}/files")
        if reread:
            if files is not None:
                actions = self._after_reading(files, actions, counters)
            actions.write.parquet(state)
            actions = self.spark.read.schema(ACTION).parquet(state)
        with self._reported(counters, progress):
            new = self._write_buckets(new, files, actions, run, staged)
        return counters, replace(new, n_files=counters["num_execution_starts"])

    def _actions(self, known: DataFrame, current: DataFrame, rebuild: bool) -> DataFrame:
        """What is to be done with each file, with its fingerprint, size and time."""
        # Counting paths shares its shuffle and sort with the join that follows.
        per_path = current.groupBy("file_path").agg(
            *(F.any_value(c).alias(c) for c in ("fingerprint", "length", "mtime_us")), F.count("*").alias("n")
        )
        more = F.raise_error(F.concat(F.lit("the file table has a path twice: "), "file_path"))
        checked = F.when(F.col("n") == 1, F.col("fingerprint")).otherwise(more)
        found = diff(known, per_path.withColumn("fingerprint", checked), carry=["fingerprint", "length", "mtime_us"])
        if rebuild:
            again = F.when(F.col("action") == "unchanged", "reprocess").otherwise(F.col("action"))
            unread = F.when(F.col("action") != "error", F.col("fingerprint"))
            found = found.withColumns({"action": again, "fingerprint": unread})
        return found.select(*ACTION.names)

    def _after_reading(self, files: DataFrame, actions: DataFrame, counters: dict[str, int]) -> DataFrame:
        """Actions after the second reading of files.

        The fingerprint is that of the bytes the chunks come from. A file that could not be read
        this time is an error, keeps its earlier rows and is tried again by the next refresh.
        """
        again = _marked(files).select("file_path", F.col("fingerprint").alias("f"), F.lit(True).alias("again"))
        judged = actions.join(again, "file_path", "left")
        lost = F.coalesce(F.col("again") & F.col("f").isNull(), F.lit(False))
        for row in judged.where(lost).groupBy("action").count().collect():
            name = {"add": "num_adds", "reprocess": "num_reprocesses"}[row["action"]]
            counters[name] -= row["count"]
            counters["num_errors"] += row["count"]
        mark = F.when(F.col("again"), F.col("f")).otherwise(F.col("fingerprint"))
        action = F.when(lost, "error").otherwise(F.col("action"))
        return judged.withColumns({"action": action, "fingerprint": mark}).select(*ACTION.names)

    def _write_buckets(
        self, new: Snapshot, files: DataFrame | None, actions: DataFrame, run: str, staged: str
    ) -> Snapshot:
        """Write the buckets of all changed files and say where they are."""
        bucket = F.pmod(F.xxhash64("file_path"), F.lit(new.n_buckets)).cast("int")
        changed = actions.where("action IN ('add', 'reprocess', 'delete')").select("file_path", "length")
        # As many rows as there are buckets.
        sizes = changed.groupBy(bucket.alias("bucket")).agg(F.sum("length").alias("size")).collect()
        touched = {str(r["bucket"]) for r in sizes}
        # Enough tasks for the largest bucket and, if buckets are few, for all cores.
        slices = max(1, math.ceil(max((r["size"] or 0 for r in sizes), default=0) / TASK_BYTES))
        slices = max(slices, self.spark.sparkContext.defaultParallelism // max(1, len(touched)))
        slice_of = F.pmod(F.xxhash64("file_path", F.lit(1)), F.lit(slices))
        numbered = [(int(b), n) for n, b in enumerate(sorted(touched, key=int))]
        numbers = F.broadcast(self.spark.createDataFrame(numbered, "bucket int, number int"))

        def placed(rows: DataFrame) -> DataFrame:
            # A partition for each slice of a bucket: by hash, several buckets would meet in one task.
            rows = rows.withColumn("bucket", bucket).join(numbers, "bucket", "left")
            task = (F.coalesce("number", F.lit(0)) * slices + slice_of).cast("int")
            return rows.repartitionById(max(1, len(touched)) * slices, task).drop("number")

        parts = []
        old = {b: r for b, r in new.folders.items() if b in touched}
        if old:
            kept = self._rows(old).join(changed.select("file_path"), "file_path", "left_anti")
            parts.append(placed(kept))
        if files is not None:
            rows, new = self._chunk_rows(placed(files), new, run, staged)
            parts.append(rows.withColumn("bucket", bucket))
        for k, rows in enumerate(parts):
            # Sorted, so that scans can skip row groups by path.
            ordered = rows.sortWithinPartitions("bucket", "language", "file_path")
            mode = "append" if k else "errorifexists"
            ordered.write.mode(mode).partitionBy("bucket", "language").parquet(*self._folders("chunks", [run]))
        folders = {b: r for b, r in new.folders.items() if b not in touched}
        written = [n.removeprefix("bucket=") for n in self.storage.names(f"chunks/run={run}") if n.startswith("bucket=")]
        if written:
            # Two columns of what was just written; buckets without changes are not counted again.
            fresh = self.spark.read.schema(INDEX_ROW).parquet(*self._folders("chunks", [run]))
            counts = stats.partial_counts(fresh, "bucket").select(*(c for c in COUNTS.names if c != "run"))
            counts.coalesce(1).write.parquet(*self._folders("counts", [run]))
        return replace(new, folders={**folders, **dict.fromkeys(written, run)})

    def _chunk_rows(self, files: DataFrame, new: Snapshot, run: str, staged: str) -> tuple[DataFrame, Snapshot]:
        """Index rows of files that lie with their buckets; files move before they are chunked, so no model is asked twice."""
        texts = chunking.readable(files.withColumn("language", language_of(F.col("file_path"), self.overrides)))
        rows = chunking.chunk_files(texts, self.chunkers, **self.sizes).select(
            F.xxhash64("file_path", "content", "nth").alias("id"),
            "file_path",
            "content",
            F.col("start.line").alias("start_line"),
            F.col("end.line").alias("end_line"),
            "language",
        )
        if self.embedder.memo:
            rows = embedding.with_text_key(rows, "content")
            rows.write.parquet(f"{staged}/chunks")
            rows = self.spark.read.parquet(f"{staged}/chunks")
            have = self._vectors(new.vectors) if new.vectors else None
            target = self._folders("vectors", [run])[0]
            rows = embedding.embed_once(rows, self.embedder, "content", have, target, **self.params.indexing)
            new = replace(new, vectors=[*new.vectors, run])
        else:
            rows = embedding.embed_texts(rows, self.embedder, "content", **self.params.indexing)
        wrong = F.raise_error(F.lit(f"embedder {self.embedder.name}: expected {new.dim} dimensions"))
        checked = F.when(F.size("embedding") == new.dim, F.col("embedding")).otherwise(wrong.cast("array<float>"))
        return rows.withColumn("embedding", checked), new

    @contextlib.contextmanager
    def _reported(self, counters: dict[str, int], progress: Progress | None) -> Iterator[None]:
        """Report the tasks of the jobs that run meanwhile."""
        if progress is None:
            yield
            return
        context, over = self.spark.sparkContext, threading.Event()
        tracker, group = context.statusTracker(), f"refresh-{uuid.uuid4().hex}"
        given = {key: context.getLocalProperty(key) for key in ("spark.jobGroup.id", "spark.job.description")}
        seen: dict[int, tuple[int, int]] = {}

        def report(over: bool = False) -> None:
            for job in tracker.getJobIdsForGroup(group):
                info = tracker.getJobInfo(job)
                for stage in info.stageIds if info else []:
                    if (found := tracker.getStageInfo(stage)) is not None:
                        seen[stage] = (found.numTasks, found.numCompletedTasks)
            tasks, done = (sum(x) for x in zip(*seen.values())) if seen else (0, 0)
            # Tasks of stages that turned out not to be needed never start.
            progress({**counters, "tasks": done if over else tasks, "tasks_done": done})

        def watch() -> None:
            while not over.wait(REPORT_SECONDS):
                report()

        watcher = threading.Thread(target=watch, daemon=True)
        context.setJobGroup(group, f"refresh of {self.location}")
        watcher.start()
        try:
            yield
        finally:
            over.set()
            watcher.join()
            for key, value in given.items():
                context.setLocalProperty(key, value)
        report(over=True)

    def _commit(self, snapshot: Snapshot) -> None:
        try:
            self.storage.create(f"snapshots/{snapshot.version:08d}.json", json.dumps(asdict(snapshot)))
        except FileExistsError as exc:
            raise RuntimeError(f"another refresh of {self.location} finished first") from exc

    def _vectors(self, runs: Sequence[str]) -> DataFrame:
        """Vectors by text. No text is in two runs."""
        return self.spark.read.schema(embedding.CACHE_SCHEMA).parquet(
            *self._folders("vectors", runs)
        )

    def _clean(self) -> None:
        """Remove what neither of the newest snapshots uses."""
        names = self._snapshots()
        kept = [self._load(n) for n in names[-KEPT_SNAPSHOTS:]]
        used = {(run, bucket) for s in kept for bucket, run in s.folders.items()}
        runs = {run for run, _ in used}
        newest = f"{kept[-1].version:08d}"
        for name in self.storage.names("chunks"):
            run = name.removeprefix("run=")
            # A folder of a later version belongs to a refresh that has not finished.
            if run[:8] > newest:
                continue
            if run not in runs:
                self.storage.delete(f"chunks/{name}")
                self.storage.delete(f"counts/{name}")
                continue
            for part in self.storage.names(f"chunks/{name}"):
                if part.startswith("bucket=") and (run, part.removeprefix("bucket=")) not in used:
                    self.storage.delete(f"chunks/{name}/{part}")
        for kind, known in (("state", {s.state for s in kept}), ("vectors", {v for s in kept for v in s.vectors})):
            for name in self.storage.names(kind):
                run = name.removeprefix("run=")
                if run not in known and run[:8] <= newest:
                    self.storage.delete(f"{kind}/{name}")
        for name in names[:-KEPT_SNAPSHOTS]:
            self.storage.delete(f"snapshots/{name}")

    # Queries

    def results(
        self,
        query: str,
        limit: int = 5,
        offset: int = 0,
        languages: Sequence[str] | None = None,
        paths: Sequence[str] | None = None,
    ) -> DataFrame:
        """Result rows for a query text."""
        chunks = self.chunks()
        vector = embedding.embed_query(self.spark, self.embedder, query, **self.params.query)
        spec = SearchSpec(vector, limit, offset, tuple(languages or ()), tuple(paths or ()))
        return search(chunks, spec)

    def search(self, query: str, limit: int = 5, offset: int = 0, **filters: Any) -> SearchResponse:
        """As :meth:`results`, with limits checked and faults turned into a message."""
        try:
            if not 1 <= limit <= 100 or offset < 0:
                raise ValueError("limit must be within 1..100 and offset not negative")
            rows = [r.asDict() for r in self.results(query, limit, offset, **filters).collect()]
        except Exception as exc:
            return SearchResponse(False, offset=offset, message=f"Query failed: {exc}")
        return SearchResponse(True, rows, len(rows), offset)

    def status(self) -> DataFrame:
        """One row of totals from the counts kept; zeros with ``index_exists`` false before the first refresh."""
        snapshot = self.snapshot()
        return stats.summary(self.counts(snapshot or Snapshot())).withColumn("index_exists", F.lit(snapshot is not None))

    def reset(self) -> bool:
        """Delete the index."""
        with self._lock:
            return self.storage.delete()


def _marked(files: DataFrame) -> DataFrame:
    """Fingerprints of files, made where their content is read; unreadable ones have none."""
    return files.select(
        "file_path",
        F.when(F.col("error").isNull(), F.sha2("content", 256)).alias("fingerprint"),
        "length",
        "mtime_us",
    )


def _only(rows: DataFrame, paths: DataFrame | None) -> DataFrame:
    return rows if paths is None else rows.join(paths, "file_path", "left_semi")


def _source(fn: Any) -> str:
    try:
        return inspect.getsource(fn)
    except (OSError, TypeError):
        return ""
