r"""Two glob dialects as regular expressions.

``search_glob``: whole string, case sensitive, ``*`` and ``?`` cross ``/``,
``[a-c]`` is a class and ``[^a]`` its negation. This is the path filter of
search.

``path_glob``: ``*`` and ``?`` stay inside one path segment, ``**`` spans
segments, ``{a,b}`` lists alternatives, ``[!a]`` or ``[^a]`` negates. This is
the dialect of include and exclude patterns and of the grep path filter.

Both give patterns that mean the same in Java and in Python, anchored at the
start and the end, so a column filter and a worker-side check agree.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_NEVER = r"(?!)"
_CLASS_META = set(r"\[]^&~-")


def _quote(char: str) -> str:
    return char if char.isalnum() or char in "_/" or ord(char) > 127 else "\\" + char


def _class(body: str, negated: bool, extra: str = "") -> str:
    """A bracket expression from a glob class body such as ``a-cx``."""
    out, i = [], 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            low, high = body[i], body[i + 2]
            if low <= high:
                out.append("-".join("\\" + c if c in _CLASS_META else c for c in (low, high)))
            i += 3
            continue
        out.append("\\" + body[i] if body[i] in _CLASS_META else body[i])
        i += 1
    if not out:
        return "[^" + extra + "]" if negated and extra else ("." if negated else _NEVER)
    return f"[{'^' if negated else ''}{''.join(out)}{extra if negated else ''}]"


def _class_end(glob: str, start: int, marks: str) -> tuple[int, int, bool] | None:
    """(body start, body end, negated) of the class opened before ``start``."""
    negated = start < len(glob) and glob[start] in marks
    first = start + 1 if negated else start
    close = glob.find("]", first + 1)
    return None if close < 0 else (first, close, negated)


@functools.lru_cache(maxsize=4096)
def search_glob_regex(glob: str) -> str:
    out, i = [], 0
    while i < len(glob):
        char = glob[i]
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif char == "[":
            span = _class_end(glob, i + 1, "^")
            if span is None:
                return _NEVER
            out.append(_class(glob[span[0] : span[1]], span[2]))
            i = span[1]
        else:
            out.append(_quote(char))
        i += 1
    return r"(?s)\A" + "".join(out) + r"\z"


def search_glob_prefix(glob: str) -> str:
    """The literal text every match starts with."""
    return re.split(r"[*?\[]", glob, maxsplit=1)[0]


def search_glob(path: Column, globs: Sequence[str]) -> Column:
    """True where any glob matches; literal prefixes become pushed-down filters."""
    clauses = []
    for glob in globs:
        prefix = search_glob_prefix(glob)
        if prefix == glob:
            clauses.append(path == F.lit(glob))
        elif glob == prefix + "*":
            clauses.append(path.startswith(prefix))
        else:
            clause = path.rlike(search_glob_regex(glob))
            clauses.append(path.startswith(prefix) & clause if prefix else clause)
    return functools.reduce(lambda a, b: a | b, clauses)


@functools.lru_cache(maxsize=4096)
def path_glob_regex(glob: str, braces: bool = True) -> str:
    out, i, depth = [], 0, 0
    while i < len(glob):
        char, rest = glob[i], glob[i:]
        at_segment = i == 0 or glob[i - 1] == "/"
        if rest.startswith("**/") and at_segment:
            out.append("(?:[^/]+/)*")
            i += 3
            continue
        if rest == "**" and at_segment:
            out.append(".+" if i else ".*")
            break
        if char == "*":
            out.append("[^/]*")
            while glob[i + 1 : i + 2] == "*":
                i += 1
        elif char == "?":
            out.append("[^/]")
        elif char == "[":
            span = _class_end(glob, i + 1, "!^")
            if span is None:
                raise ValueError(f"unclosed class in glob: {glob!r}")
            out.append(_class(glob[span[0] : span[1]], span[2], "/"))
            i = span[1]
        elif char == "{" and braces:
            out.append("(?:")
            depth += 1
        elif char == "}" and depth:
            out.append(")")
            depth -= 1
        elif char == "," and depth:
            out.append("|")
        elif char == "\\" and i + 1 < len(glob):
            i += 1
            out.append(_quote(glob[i]))
        else:
            out.append(_quote(char))
        i += 1
    if depth:
        raise ValueError(f"unclosed alternatives in glob: {glob!r}")
    return r"(?s)\A" + "".join(out) + r"\z"


def any_path_glob_regex(globs: Sequence[str]) -> str:
    """One regular expression for a list of path globs; no globs never match."""
    if not globs:
        return _NEVER
    return "|".join(f"(?:{path_glob_regex(g)})" for g in globs)


def path_glob(path: Column, globs: Sequence[str]) -> Column:
    return path.rlike(any_path_glob_regex(globs))


@functools.lru_cache(maxsize=256)
def python_regex(pattern: str) -> re.Pattern[str]:
    """Compile one of this module's patterns with Python's ``re``."""
    return re.compile(pattern.replace("(?s)", "").replace(r"\z", r"\Z"), re.DOTALL)
