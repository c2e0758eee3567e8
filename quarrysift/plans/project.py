"""A project directory: its settings, its index and its diagnostics."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import SparkSession

from ..operators import stats
from ..operators.chunking import load_chunker
from ..operators.embedding import (
    Embedder,
    HashEmbedder,
    check_embedder,
    create_embedder,
    resolve_params,
)
from ..session import ship_module, ship_package
from ..sources import settings as cfg
from ..sources.tree import walk
from .index import COUNTERS, Index, Progress


@dataclass
class Check:
    """One diagnostic: what it looked at and what went wrong."""

    name: str
    ok: bool
    details: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)


class Project:
    """Ties one source tree to its settings and index.

    Settings are read again by every refresh; custom chunkers are loaded once.
    """

    def __init__(
        self, spark: SparkSession, root: str | Path, embedder: Embedder | None = None
    ) -> None:
        self.spark = spark
        self.root = Path(root).resolve()
        rules = cfg.load_project(self.root)
        params = None
        if embedder is None and cfg.user_file().is_file():
            user = cfg.load_user()
            os.environ.update(user.envs)
            chosen = user.embedding
            embedder = create_embedder(chosen.provider, chosen.model, None, chosen.min_interval_ms)
            params = resolve_params(
                chosen.provider, chosen.model, chosen.indexing_params, chosen.query_params
            )
        chunkers = {f".{ext}": load_chunker(name) for ext, name in rules.chunkers.items()}
        ship_package(spark)
        for chunker in chunkers.values():
            ship_module(spark, chunker.__module__)
        self.index = Index(
            spark,
            cfg.index_location(self.root),
            embedder or HashEmbedder(),
            params,
            rules.language_overrides,
            chunkers,
        )

    def refresh(self, progress: Progress | None = None) -> dict[str, int]:
        rules = cfg.load_project(self.root)
        self.index.overrides = dict(rules.language_overrides)
        found = walk(self.spark, str(self.root), rules.selection())
        try:
            return self.index.refresh_tree(found.files, str(self.root), progress, found.unlisted)
        finally:
            found.release()

    def search(self, query: str, limit: int = 5, offset: int = 0, refresh: bool = True, **filters):
        """Search after bringing the index up to date; a first index is always built."""
        if refresh or self.index.snapshot() is None:
            self.refresh()
        return self.index.search(query, limit, offset, **filters)

    def doctor(self) -> list[Check]:
        return [self._check_files(), self._check_index(), self._check_keys(), self._check_embedder()]

    def _check_keys(self) -> Check:
        given = cfg.load_user().envs if cfg.user_file().is_file() else {}
        details = [f"{name}: from the settings" for name in sorted(given)]
        details += [f"{name}: from the process" for name in cfg.process_only(given)]
        return Check("Keys", True, details or ["none set"])

    def _check_files(self) -> Check:
        try:
            rules = cfg.load_project(self.root)
        except (OSError, ValueError) as exc:
            return Check("File walk", False, errors=[str(exc)])
        found = walk(self.spark, str(self.root), rules.selection())
        counts = stats.by_extension(found.files).collect()
        details = [f"Total matched files: {sum(r['cnt'] for r in counts)}"]
        details += [f"  {r['ext']}: {r['cnt']}" for r in counts]
        n_rules = found.rule_dirs.count()
        if n_rules:
            # The report names every directory; they come one partition at a time.
            named = found.rule_dirs.orderBy("file_path").toLocalIterator()
            details.append("Ignore files in: " + ", ".join(r["file_path"] or "." for r in named))
        found.release()
        return Check("File walk", True, details)

    def _check_index(self) -> Check:
        row = self.index.status().first()
        details = [f"Index: {cfg.shown_path(self.index.location)}"]
        if not row["index_exists"]:
            return Check("Index status", True, [*details, "Index not created yet."])
        details += [f"Chunks: {row['total_chunks']}", f"Files: {row['total_files']}"]
        languages = sorted(row["languages"].items(), key=lambda item: (-item[1], item[0]))
        details += [f"  {name}: {count} chunks" for name, count in languages]
        return Check("Index status", True, details)

    def _check_embedder(self) -> Check:
        embedder, params = self.index.embedder, self.index.params
        check = Check(f"Embedder {embedder.name}", True)
        for side, given in (("indexing", params.indexing), ("query", params.query)):
            dim, problem = check_embedder(self.spark, embedder, **given)
            if dim is None:
                check.ok = False
                check.errors.append(f"{side}: {problem}")
            else:
                check.details.append(f"{side}: {dim} dimensions")
        return check


def describe_counters(counters: dict[str, int]) -> str:
    listed, added, deleted, again, same, errors = (counters[name] for name in COUNTERS)
    return (
        f"{listed} files listed | {added} added, {deleted} deleted, {again} reprocessed, "
        f"{same} unchanged, error: {errors}"
    )
