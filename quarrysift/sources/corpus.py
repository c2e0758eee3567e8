"""File tables: one row per file, as ``file_path`` plus text or bytes.

The same selection rules as for trees, written as joins and column filters.
Directories are far fewer than files, so everything that concerns a directory
is decided once per directory and then joined to its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ancestor_dirs, decoded, parent_dir
from ..operators.skew import lookup_join
from .ignore import ignored_column, rule_table
from .selection import Selection


def from_table(
    table: DataFrame, path: str = "file_path", content: str = "content"
) -> DataFrame:
    """A file table with the columns of a file source."""
    body = F.col(content).cast("binary")
    mtime = F.col("mtime_us") if "mtime_us" in table.columns else F.lit(None).cast("bigint")
    return table.select(
        F.col(path).alias("file_path"),
        F.octet_length(body).cast("bigint").alias("length"),
        mtime.alias("mtime_us"),
        body.alias("content"),
        F.lit(None).cast("string").alias("error"),
    )


def rule_chains(paths: DataFrame, rule_files: DataFrame) -> DataFrame:
    """The directories of ``paths`` that ignore files apply to.

    ``rule_files`` has ``dir`` and ``rules``. ``chain`` lists the rules of the ignore files
    from the root down, at most one file per path component, and ``closed`` tells
    whether a rule hits the directory or one above it. Rules are parsed once per ignore file; which of them
    match is decided by column expressions.
    """
    leaves = paths.select("dir").distinct()
    above = leaves.select("dir", F.explode(ancestor_dirs(F.col("dir"))).alias("above"))
    by_dir = rule_table(rule_files).withColumnRenamed("dir", "above")
    # Every directory has the root above it, so that key is hot by construction.
    found = lookup_join(above, by_dir, "above", hot=[""])
    entry = F.struct(F.col("above").alias("dir"), "rules")
    chains = found.groupBy("dir").agg(F.array_sort(F.collect_list(entry)).alias("files"))
    rules = F.transform("files", lambda f: F.transform(f["rules"], lambda r: r.withField("dir", f["dir"])))
    chains = chains.select("dir", F.flatten(rules).alias("chain"))
    closed = F.exists(ancestor_dirs(F.col("dir")), lambda one: (one != "") & ignored_column(one, F.col("chain"), True))
    return chains.withColumn("closed", closed)


def select_files(
    files: DataFrame, selection: Selection, rule_files: DataFrame | None = None
) -> DataFrame:
    """The rows of ``files`` (``file_path``, ``length``, ...) a selection admits.

    Ignore files are given as ``rule_files`` (``dir``, ``rules``) or else are
    rows of the table itself, read from ``content``. Globs and the size cap are
    plain filters. Ignore rules are applied to paths alone, and texts meet the
    verdict once, in the last join.
    """
    kept = files.where(selection.file_column(F.col("file_path"), F.col("length")))
    if rule_files is None and selection.ignore_files and "content" in files.columns:
        rule_files = files.where(F.col("file_path").rlike(r"(^|/)\.gitignore\z")).select(
            parent_dir(F.col("file_path")).alias("dir"),
            F.coalesce(decoded(F.col("content")), F.lit("")).alias("rules"),
        )
    if rule_files is None:
        return kept
    narrow = kept.select("file_path", parent_dir(F.col("file_path")).alias("dir"))
    judged = lookup_join(narrow, rule_chains(narrow, rule_files), "dir")
    dropped = judged.where(F.col("closed") | ignored_column(F.col("file_path"), F.col("chain"), False))
    return kept.join(dropped.select("file_path"), "file_path", "left_anti")
