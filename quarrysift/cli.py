"""Command line: init, index, search, grep, status, reset, doctor, version."""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import asdict
from pathlib import Path

from pyspark.sql import SparkSession

from . import __version__
from .operators.embedding import recommended_params
from .operators.structural import render
from .plans.grep import grep_path
from .plans.index import SearchResponse
from .plans.project import Project, describe_counters
from .session import get_session
from .sources import settings as cfg


def echo(text: str = "", err: bool = False) -> None:
    """Print, with a stand-in for characters the terminal cannot show."""
    stream = sys.stderr if err else sys.stdout
    encoding = stream.encoding or "utf-8"
    print(text.encode(encoding, "replace").decode(encoding), file=stream)


def project_root() -> Path:
    root = cfg.find_project_root(Path.cwd())
    if root is None:
        raise SystemExit("Error: not inside an initialized project. Run 'quarrysift init' first.")
    return root


def print_status(project: Project) -> None:
    row = project.index.status().first()
    if not row["index_exists"]:
        echo("\nIndex not created yet.")
        return
    echo(f"\nIndex stats:\n  Chunks: {row['total_chunks']}\n  Files:  {row['total_files']}")
    if row["languages"]:
        echo("  Languages:")
        for name, count in sorted(row["languages"].items(), key=lambda item: (-item[1], item[0])):
            echo(f"    {name}: {count} chunks")


def run_init(args: argparse.Namespace) -> int:
    root = Path.cwd()
    marked = cfg.find_marked_parent(root.parent)
    if marked is not None and not args.force and not cfg.project_file(root).is_file():
        echo(f"Error: {marked} looks like the project root; use -f to go on here.", err=True)
        return 1
    if not cfg.user_file().is_file() or args.model:
        indexing, query = recommended_params(args.provider, args.model or "")
        chosen = cfg.EmbeddingSettings(
            args.model or "hash-256", args.provider, indexing_params=indexing, query_params=query
        )
        echo(f"Settings: {cfg.save_user(cfg.UserSettings(chosen))}")
    known = cfg.load_project(root) if cfg.project_file(root).is_file() else cfg.ProjectSettings()
    wanted = cfg.with_patterns(known, args.include or (), args.exclude or ())
    if not cfg.project_file(root).is_file() or wanted != known:
        cfg.save_project(root, wanted)
    cfg.add_ignore_entry(root)
    echo(f"Project: {cfg.shown_path(root)}")
    return 0


def run_index(spark: SparkSession, args: argparse.Namespace) -> int:
    project = Project(spark, project_root())
    echo(describe_counters(project.refresh(lambda seen: echo(describe_counters(seen)))))
    print_status(project)
    return 0


def print_results(response: SearchResponse) -> None:
    if not response.success:
        echo(f"Search failed: {response.message}", err=True)
    elif not response.results:
        echo("No results found.")
    for rank, row in enumerate(response.results, 1):
        echo(f"\n--- Result {rank} (score: {row['score']:.3f}) ---")
        echo(f"File: {row['file_path']}:{row['start_line']}-{row['end_line']} [{row['language']}]")
        echo(row["content"])


def run_search(spark: SparkSession, args: argparse.Namespace) -> int:
    root = project_root()
    path = args.path or cfg.default_search_glob(root, Path.cwd())
    project = Project(spark, root)
    if args.refresh or project.index.snapshot() is None:
        project.refresh()
    try:
        found = project.index.results(
            " ".join(args.query), args.limit, args.offset, args.lang, [path] if path else None
        )
        rows = [row.asDict() for row in found.collect()]
        response = SearchResponse(True, rows, len(rows), args.offset)
    except Exception as exc:
        response = SearchResponse(False, offset=args.offset, message=str(exc))
    if args.json:
        echo(json.dumps(asdict(response), ensure_ascii=False))
    else:
        print_results(response)
    return 0 if response.success or not args.json else 1


def run_grep(spark: SparkSession, args: argparse.Namespace) -> int:
    if not os.path.exists(args.path):
        echo(f"Error: path not found: {args.path}", err=True)
        return 1
    run = grep_path(spark, args.pattern, args.path, args.lang, args.glob)
    color = not args.no_color and sys.stdout.isatty() and not os.environ.get("NO_COLOR")
    for row in run.language_warnings.collect():
        echo(f"warning: {row['message']}", err=True)
    blocks = render(run.rows, color).select("message", "path", "match_no", "block")
    before = None
    for row in blocks.orderBy("path", "match_no").toLocalIterator():
        if row["message"] is not None:
            echo(f"warning: {row['message']}", err=True)
            continue
        if row["path"] == before:
            echo("\x1b[90m---\x1b[0m" if color else "---")
        else:
            if before is not None:
                echo()
            echo(f"\x1b[35m\x1b[1m{row['path']}\x1b[0m" if color else row["path"])
        echo(row["block"])
        before = row["path"]
    verdict = run.verdict()
    run.release()
    if verdict["unusable"]:
        names = ", ".join(verdict["failed_languages"])
        echo(
            f"Error: the pattern did not compile for any of the languages found ({names}).",
            err=True,
        )
        return 1
    if before is None:
        echo("No matches found.")
    return 0


def run_status(spark: SparkSession, args: argparse.Namespace) -> int:
    root = project_root()
    echo(f"Project: {cfg.shown_path(root)}")
    echo(f"Settings: {cfg.shown_path(cfg.project_file(root))}")
    project = Project(spark, root)
    echo(f"Index: {cfg.shown_path(project.index.location)}")
    print_status(project)
    return 0


def run_reset(spark: SparkSession, args: argparse.Namespace) -> int:
    root = project_root()
    if not args.force:
        if input("Delete the index? [y/N] ").strip().lower() not in ("y", "yes"):
            echo("Aborted.")
            return 0
    removed = Project(spark, root).index.reset()
    echo("Index deleted." if removed else "Nothing to reset.")
    if args.all:
        cfg.project_file(root).unlink(missing_ok=True)
        cfg.remove_ignore_entry(root)
        folder = root / cfg.SETTINGS_DIR
        if folder.is_dir() and not any(folder.iterdir()):
            folder.rmdir()
        echo("Project fully reset.")
    return 0


def run_doctor(spark: SparkSession, args: argparse.Namespace) -> int:
    checks = Project(spark, project_root()).doctor()
    for check in checks:
        echo(f"\n  {'[OK]' if check.ok else '[FAIL]'} {check.name}")
        for line in check.details:
            echo(f"    {line}")
        for line in check.errors:
            echo(f"    ERROR: {line}", err=True)
    return 0 if all(check.ok for check in checks) else 1


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("quarrysift", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    init = commands.add_parser("init", help="write settings for the current directory")
    init.add_argument("--model")
    init.add_argument("--provider", default="hash")
    init.add_argument("--include", action="append", help="a further include pattern")
    init.add_argument("--exclude", action="append", help="a further exclude pattern")
    init.add_argument("-f", "--force", action="store_true")
    commands.add_parser("index", help="bring the index up to date")
    find = commands.add_parser("search", help="find chunks by meaning")
    find.add_argument("query", nargs="+")
    find.add_argument("--lang", action="append")
    find.add_argument("--path")
    find.add_argument("--offset", type=int, default=0)
    find.add_argument("--limit", type=int, default=10)
    find.add_argument("--refresh", action="store_true")
    find.add_argument("--json", action="store_true")
    match = commands.add_parser("grep", help="find code by example")
    match.add_argument("pattern")
    match.add_argument("path", nargs="?", default=".")
    match.add_argument("--lang", action="append")
    match.add_argument("--path", dest="glob")
    match.add_argument("--no-color", action="store_true")
    commands.add_parser("status", help="show index totals")
    reset = commands.add_parser("reset", help="delete the index")
    reset.add_argument("--all", action="store_true", help="also settings and ignore entry")
    reset.add_argument("-f", "--force", action="store_true")
    commands.add_parser("doctor", help="check files, index and embedder")
    commands.add_parser("version", help="print the version")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "version":
        echo(__version__)
        return 0
    if args.command == "init":
        return run_init(args)
    runs = {
        "index": run_index,
        "search": run_search,
        "grep": run_grep,
        "status": run_status,
        "reset": run_reset,
        "doctor": run_doctor,
    }
    return runs[args.command](spark or get_session(), args)


if __name__ == "__main__":
    raise SystemExit(main())
