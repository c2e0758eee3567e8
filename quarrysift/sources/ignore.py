"""Ignore-file rules.

A rule is tested against one path at a time, relative to the directory that
holds the ignore file; parents are not considered, because whoever lists the
files never enters an ignored directory. The last rule that matches decides.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.globs import path_glob_regex, python_regex

IGNORE_FILE = ".gitignore"


@dataclass(frozen=True)
class Rule:
    regex: str
    keep: bool
    only_dirs: bool


def _body(line: str, nested: bool) -> str:
    """The rule text of one line, empty for blank lines and comments."""
    if nested:
        # In nested files, leading blanks do not count and an escaped first
        # character loses its backslash before negation is looked for.
        if not line.strip() or line.lstrip().startswith("#"):
            return ""
        return (line[1:] if line.startswith(("\\#", "\\!")) else line).rstrip()
    if line.startswith("#"):
        return ""
    text = line.rstrip()
    return text + " " if text.endswith("\\") and len(text) < len(line) else text


@functools.lru_cache(maxsize=8192)
def parse_rules(text: str, nested: bool) -> tuple[Rule, ...]:
    rules = []
    for line in text.splitlines():
        body = _body(line, nested)
        keep = body.startswith("!")
        if keep:
            body = body[1:]
        if nested:
            body = body.strip()
        only_dirs = body.endswith("/")
        # A slash ties a rule to its directory; in nested files a closing one does too.
        tied = "/" in (body if nested else body.rstrip("/"))
        glob = body.strip("/")
        if not glob:
            continue
        try:
            regex = path_glob_regex(glob if tied else f"**/{glob}", braces=False)
        except ValueError:
            continue
        rules.append(Rule(regex, keep, only_dirs))
    return tuple(rules)


def is_ignored(path: str, is_dir: bool, chain: list[tuple[str, str]]) -> bool:
    """Whether ``path`` is ignored by ``chain``.

    ``chain`` lists ``(directory, ignore file text)`` from the root (empty
    string) down to the directory that holds ``path``.
    """
    ignored = False
    for directory, text in chain:
        prefix = f"{directory}/" if directory else ""
        if not path.startswith(prefix):
            continue
        rest = path[len(prefix) :]
        for rule in parse_rules(text, nested=bool(directory)):
            if rule.only_dirs and not is_dir:
                continue
            if rule.keep is ignored and python_regex(rule.regex).search(rest):
                ignored = not rule.keep
    return ignored


RULES = "array<struct<regex:string,keep:boolean,only_dirs:boolean>>"


def rule_table(rule_files: DataFrame) -> DataFrame:
    """The rules of each ignore file (``dir``, ``rules`` as text) in their order, as ``dir`` and an array of structs."""
    kind = pa.list_(pa.struct([("regex", pa.string()), ("keep", pa.bool_()), ("only_dirs", pa.bool_())]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(*(c.to_pylist() for c in batch.columns))
            found = [[asdict(r) for r in parse_rules(text or "", nested=bool(directory))] for directory, text in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["dir", "rules"])

    return rule_files.select("dir", "rules").mapInArrow(parse, f"dir string, rules {RULES}")


def ignored_column(path: Column, rules: Column, is_dir: bool) -> Column:
    """:func:`is_ignored` as a column: ``rules`` are structs with their ``dir``, from the root down.

    All of these directories lie on the way to ``path``; those of its own and below it do not count.
    """

    def hits(rule: Column) -> Column:
        above = F.length(rule["dir"])
        rest = F.substring(path, above + F.when(above > 0, 2).otherwise(1), F.length(path))
        hit = (above < F.length(path)) & F.rlike(rest, rule["regex"])
        return hit if is_dir else ~rule["only_dirs"] & hit

    found = F.filter(rules, hits)
    return (F.size(found) > 0) & ~F.coalesce(F.get(found, F.size(found) - 1)["keep"], F.lit(False))
