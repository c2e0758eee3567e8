"""Language names by file extension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import path_suffix

# Languages by suffix.
LANGUAGE_BY_SUFFIX = {
    ".c": "c",
    ".cpp": "cpp",
    ".cc": "cpp",
    ".cxx": "cpp",
    ".h": "cpp",
    ".hpp": "cpp",
    ".hxx": "cpp",
    ".hh": "cpp",
    ".cs": "csharp",
    ".css": "css",
    ".scss": "css",
    ".dart": "dart",
    ".dtd": "dtd",
    ".ex": "elixir",
    ".exs": "elixir",
    ".f": "fortran",
    ".f90": "fortran",
    ".f95": "fortran",
    ".f03": "fortran",
    ".go": "go",
    ".html": "html",
    ".htm": "html",
    ".java": "java",
    ".js": "javascript",
    ".jsx": "javascript",
    ".mjs": "javascript",
    ".cjs": "javascript",
    ".json": "json",
    ".kt": "kotlin",
    ".kts": "kotlin",
    ".lua": "lua",
    ".md": "markdown",
    ".mdx": "markdown",
    ".pas": "pascal",
    ".dpr": "pascal",
    ".php": "php",
    ".py": "python",
    ".pyi": "python",
    ".r": "r",
    ".rb": "ruby",
    ".rs": "rust",
    ".scala": "scala",
    ".sh": "shell",
    ".bash": "shell",
    ".zsh": "shell",
    ".sol": "solidity",
    ".sql": "sql",
    ".svelte": "svelte",
    ".swift": "swift",
    ".txt": "text",
    ".rst": "text",
    ".toml": "toml",
    ".tsx": "tsx",
    ".ts": "typescript",
    ".vue": "vue",
    ".xml": "xml",
    ".yaml": "yaml",
    ".yml": "yaml",
}

# Languages that are detected and indexed but have no token structure to match.
UNMATCHABLE = frozenset({"text", "markdown"})

def _lookup(table: Mapping[str, str], key: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key) if entries else F.lit(None).cast("string")


def language_of(
    path: Column, overrides: Mapping[str, str] | None = None, fallback: str | None = "text"
) -> Column:
    """Override by extension first, then the table, then ``fallback``.

    ``overrides`` maps an extension without dot to a language. Pass
    ``fallback=None`` to get NULL for unknown extensions, as grep wants.
    """
    suffix = path_suffix(path)
    chosen = _lookup({f".{ext}": lang for ext, lang in (overrides or {}).items()}, suffix)
    return F.coalesce(chosen, _lookup(LANGUAGE_BY_SUFFIX, suffix), F.lit(fallback).cast("string"))
