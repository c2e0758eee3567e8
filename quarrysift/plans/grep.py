"""A grep run over a directory tree or a single file."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.globs import path_glob
from ..operators.structural import GrepRun, grep
from ..session import ship_package
from ..sources import settings as cfg
from ..sources.selection import Selection
from ..sources.tree import read_files, single_file, walk


def grep_path(
    spark: SparkSession,
    pattern: str,
    root: str,
    languages: Sequence[str] | None = None,
    path_filter: str | None = None,
) -> GrepRun:
    """Match under ``root`` with the rules of the project it belongs to.

    Outside a project the default rules hold, anchored at the git checkout if
    there is one. A single file is matched whatever the rules say. Paths in the
    result start with ``root`` as it was given.
    """
    ship_package(spark)
    target = Path(root).resolve()
    project = cfg.find_project_root(target if target.is_dir() else target.parent)
    rules = cfg.load_project(project) if project else None
    overrides = rules.language_overrides if rules else {}
    if target.is_file():
        base = target.parent
        found = single_file(spark, str(target))
        shown, release = F.lit(Path(root).as_posix()), None
    else:
        base = project or cfg.find_git_root(target) or target
        start = target.relative_to(base).as_posix()
        start = "" if start == "." else start
        listing = walk(spark, str(base), rules.selection() if rules else Selection(), start)
        found, release = listing.files, listing.release
        if path_filter:
            found = found.where(path_glob(F.col("file_path"), [path_filter]))
        below = F.substring("file_path", len(start) + 2 if start else 1, 1 << 30)
        prefix = Path(root).as_posix()
        shown = F.concat(F.lit("" if prefix == "." else prefix.rstrip("/") + "/"), below)

    def displayed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("file_path", shown)

    files = displayed(read_files(found, str(base)))
    run = grep(files, pattern, languages, None, overrides, displayed(found))
    return run if release is None else replace(run, release=release)
