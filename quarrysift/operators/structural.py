r"""By-example structural matching of source files.

A pattern is code in which ``\NAME`` stands for one node, ``\(NAME*\)`` for a
run of siblings, ``\_`` and ``\*`` for the same without a name, and
``\{{ P \}}`` for a run of siblings that contains P at any depth. White space
and comments do not count, brackets match in pairs, and a name used twice must
stand for the same tokens both times.

A node is a bracketed group, or a word, number or string with whatever is
attached to it: ``a``, ``(x, y)``, ``a.b``, ``f(x)[0]``. A match is reported for every token it
can start at.

Spark does the selection: language, path and literal filters run in the JVM, so
only files that contain all words of the pattern reach the token matcher, which
works on one file at a time. With a stored table of tokens (:func:`tokenize`) the
matching itself is done by windows over token rows (:mod:`.tokenrows`), except for a
pattern that uses a name twice, since what follows depends on what the name holds.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.globs import path_glob
from ..functions.languages import LANGUAGE_BY_SUFFIX, UNMATCHABLE, language_of
from ..functions.text import decoded, gutter
from .lexing import CLOSER, LINKS, Tokens, is_supported, lexer
from .tokenrows import matches_of, token_lists

MATCH = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("language", T.StringType(), False),
        T.StructField("match_no", T.IntegerType(), False),
        T.StructField("start_line", T.IntegerType(), False),
        T.StructField("end_line", T.IntegerType(), False),
        T.StructField("start_char", T.IntegerType(), False),
        T.StructField("end_char", T.IntegerType(), False),
        T.StructField("start_byte", T.IntegerType(), False),
        T.StructField("end_byte", T.IntegerType(), False),
        T.StructField("start_column", T.IntegerType(), False),
        T.StructField("end_column", T.IntegerType(), False),
        T.StructField("captures", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("lines", T.ArrayType(T.StringType()), False),
        T.StructField("last_line", T.IntegerType(), False),
    ]
)

#: Matches and unreadable files in one stream: the latter have only a message.
ROW = T.StructType(
    [T.StructField("message", T.StringType())]
    + [T.StructField(f.name, f.dataType, f.name not in ("path", "language")) for f in MATCH.fields]
)

_ROWS_PER_BATCH = 2_000
_CHARS_PER_BATCH = 1 << 20

@dataclass(frozen=True)
class Element:
    """One step of a pattern: literal text, a node, a run, or a containment."""

    kind: str
    value: str = ""
    inner: tuple["Element", ...] = ()


#: Most nodes, runs and containments of one pattern: the search goes as deep.
MAX_PARTS = 200

_SIGIL = re.compile(
    r"\\\((?P<run>[A-Za-z_]\w*)?\*\\\)|\\(?P<any_run>\*)|\\(?P<node>[A-Za-z_]\w*)"
    r"|\\(?P<into>\{\{)|\\(?P<out>\}\})|(?P<bad>\\)"
)


class Pattern:
    """A pattern compiled for one language. Invalid ones raise ``ValueError``."""

    def __init__(self, source: str, language: str) -> None:
        if not is_supported(language):
            raise ValueError(f"structural matching does not support {language}")
        self.language = language
        self.words: set[str] = set()
        names: list[tuple[int, str]] = []
        levels: list[list[Element]] = [[]]
        # The containment that each level belongs to; 0 is outside of all.
        inside, parts = [0], 0
        brackets: list[str] = []
        at = 0
        for found in [*_SIGIL.finditer(source), None]:
            stop = found.start() if found else len(source)
            self._literal(source[at:stop], levels[-1], brackets)
            if found is None:
                break
            at = found.end()
            kind = found.lastgroup
            parts += 1
            if kind == "bad":
                raise ValueError(f"stray backslash at offset {found.start()}")
            if kind == "into":
                levels.append([])
                inside.append(parts)
                brackets.append("{{")
            elif kind == "out":
                if len(levels) == 1 or brackets.pop() != "{{":
                    raise ValueError(r"unbalanced \}}")
                inner = levels.pop()
                inside.pop()
                if not inner:
                    raise ValueError(r"empty \{{ \}}")
                levels[-1].append(Element("contain", inner=tuple(inner)))
            elif kind == "node":
                name = "" if found["node"] == "_" else found["node"]
                levels[-1].append(Element("node", name))
                names.append((inside[-1], name))
            else:
                levels[-1].append(Element("run", found["run"] or ""))
                names.append((inside[-1], found["run"] or ""))
        if brackets:
            raise ValueError(f"unbalanced {brackets[-1]} in the pattern")
        self.elements = tuple(levels[0])
        if not self.elements:
            raise ValueError("the pattern is empty")
        if parts > MAX_PARTS:
            raise ValueError(f"the pattern has more than {MAX_PARTS} parts")
        places: dict[str, set[int]] = {}
        for place, name in names:
            places.setdefault(name, set()).add(place)
        for name, found_in in places.items():
            if name and len(found_in) > 1:
                raise ValueError(rf"\{name} stands on both sides of a \{{{{ \}}}}")
        used = [name for _, name in names if name]
        self.repeated = tuple(sorted({name for name in used if used.count(name) > 1}))

    def _literal(self, source: str, into: list[Element], brackets: list[str]) -> None:
        for found in lexer(self.language).finditer(source):
            if found.lastgroup == "comment":
                continue
            token = found[found.lastgroup]
            if found.lastgroup == "open":
                brackets.append(token)
            elif found.lastgroup == "close":
                if not brackets or CLOSER.get(brackets.pop()) != token:
                    raise ValueError(f"unbalanced {token} in the pattern")
            elif found.lastgroup == "word":
                self.words.add(token)
            into.append(Element("literal", token))

    def find(self, tokens: Tokens) -> list[tuple[int, int, dict[str, tuple[int, int]]]]:
        """(first token, end token, captures) of every match, in source order."""
        return _Finder(tokens, self.repeated).all(self.elements)


class _Finder:
    """The search for one pattern in one text.

    Whether elements match at a token depends only on what the repeated names hold
    so far. Every failure is remembered together with that, and no token is scanned
    again for the same element.
    """

    def __init__(self, tokens: Tokens, repeated: tuple[str, ...]) -> None:
        self.tokens = tokens
        self.repeated = repeated
        self.failed: set[tuple] = set()
        self.inner: dict[int, list] = {}

    def all(self, elements) -> list[tuple[int, int, dict[str, tuple[int, int]]]]:
        tokens, first, found = self.tokens, elements[0], []
        for i, token in enumerate(tokens.text):
            if first.kind == "literal" and token != first.value:
                continue
            if first.kind == "node" and i and tokens.text[i - 1] in LINKS:
                continue
            captures: dict[str, tuple[int, int]] = {}
            end = self.match(elements, 0, i, captures)
            if end > i:
                found.append((i, end, captures))
        return found

    def match(self, elements, p: int, i: int, captures: dict) -> int:
        """End of the first match of ``elements[p:]`` at ``i``, or -1."""
        tokens = self.tokens
        while p < len(elements) and elements[p].kind == "literal":
            if i >= len(tokens.text) or tokens.text[i] != elements[p].value:
                return -1
            p, i = p + 1, i + 1
        if p == len(elements):
            return i
        step = elements[p]
        held = tuple(captures.get(name) for name in self.repeated)
        if (id(elements), p, i, held) in self.failed:
            return -1
        # What a run without a repeated name can reach does not depend on where it starts.
        free = step.kind == "run" and step.value not in self.repeated
        tried = []
        for stop in self.stops(step, i, captures):
            if free and stop > i and (id(elements), p, stop, held) in self.failed:
                # An earlier run passed here and found nothing further on.
                break
            tried.append(stop)
            before = captures.get(step.value) if step.value else None
            if before is not None:
                if tokens.text[slice(*before)] != tokens.text[i:stop]:
                    continue
            elif step.value:
                captures[step.value] = (i, stop)
            end = self.match(elements, p + 1, stop, captures)
            if end >= 0:
                return end
            if step.value and before is None:
                del captures[step.value]
        self.failed.add((id(elements), p, i, held))
        if free:
            self.failed.update((id(elements), p, stop, held) for stop in tried)
        return -1

    def stops(self, step: Element, i: int, captures: dict):
        """Where a node, run or containment that starts at ``i`` may end."""
        tokens = self.tokens
        if step.kind == "node":
            yield from tokens.node_ends(i)
        elif step.kind == "run":
            yield i
            while not tokens.closes(i):
                i = tokens.after(i)
                yield i
        else:
            hits = self.inner.get(id(step))
            if hits is None:
                hits = self.inner[id(step)] = self.all(step.inner)
            at = bisect_left(hits, i, key=lambda hit: hit[0])
            nearest = None
            while not tokens.closes(i) and (at < len(hits) or nearest is not None):
                i = tokens.after(i)
                while at < len(hits) and hits[at][0] < i:
                    if nearest is None or hits[at][1] < nearest:
                        nearest = hits[at][1]
                        captures.update(hits[at][2])
                    at += 1
                if nearest is not None and nearest <= i:
                    yield i


def compile_patterns(source: str, languages: Sequence[str]) -> tuple[dict[str, Pattern], dict]:
    """Patterns by language, and the message for each language that rejects it.

    Languages without structure are in neither.
    """
    compiled, rejected = {}, {}
    for language in filter(is_supported, languages):
        try:
            compiled[language] = Pattern(source, language)
        except ValueError as exc:
            rejected[language] = f"pattern invalid for {language}: {exc}"
    return compiled, rejected


def match_text(text: str, pattern: Pattern) -> list[dict]:
    """Matches of one text as dictionaries without path and language."""
    return list(_matches(text, pattern))


def _matches(text: str, pattern: Pattern) -> Iterator[dict]:
    """As :func:`match_text`, one at a time: together, captures and lines may be far longer than the text."""
    tokens = Tokens(text, pattern.language)
    found = pattern.find(tokens)
    if not found:
        return
    starts = [0, *(m.end() for m in re.finditer("\n", text))]
    lines = text.split("\n")
    last_line = max(bisect_right(starts, tokens.end(end - 1) - 1) for _, end, _ in found)
    at = byte = 0
    for number, (first, end, captures) in enumerate(found):
        start, stop = tokens.start[first], tokens.end(end - 1)
        byte += len(text[at:start].encode())
        at = start
        start_line, end_line = bisect_right(starts, start), bisect_right(starts, stop - 1)

        def source(span: tuple[int, int]) -> str:
            low, high = span
            return text[tokens.start[low] : tokens.end(high - 1)] if high > low else ""

        yield {
            "match_no": number + 1,
            "start_line": start_line,
            "end_line": end_line,
            "start_char": start,
            "end_char": stop,
            "start_byte": byte,
            "end_byte": byte + len(text[start:stop].encode()),
            "start_column": start - starts[start_line - 1],
            "end_column": stop - starts[end_line - 1],
            "captures": [(name, source(span)) for name, span in captures.items()],
            "lines": [line.rstrip("\r") for line in lines[start_line - 1 : end_line]],
            "last_line": last_line,
        }


@dataclass
class GrepRun:
    """The parts of a grep run, all lazy.

    ``rows`` is one pass over the files: matches, and unreadable files with a
    ``message``. ``language_warnings`` has one row per language that was met and
    rejected the pattern, ``targets`` one per file that was eligible; neither
    reads a file.
    """

    rows: DataFrame
    language_warnings: DataFrame
    targets: DataFrame
    #: Removes what the listing of a tree has left on scratch storage.
    release: Callable[[], object] = lambda: None

    @property
    def matches(self) -> DataFrame:
        return self.rows.where("message IS NULL").select(*MATCH.names)

    @property
    def warnings(self) -> DataFrame:
        unreadable = self.rows.where("message IS NOT NULL")
        return self.language_warnings.unionByName(
            unreadable.select("message", F.lit(None).cast("string").alias("language"))
        )

    def verdict(self) -> dict:
        """Languages that rejected the pattern, and whether none was left to match."""
        # There are only as many rows as languages.
        failed = [row["language"] for row in self.language_warnings.collect()]
        unusable = bool(failed) and self.targets.limit(1).count() == 0
        return {"failed_languages": sorted(failed), "unusable": unusable}


def grep(
    files: DataFrame,
    pattern: str,
    languages: Sequence[str] | None = None,
    path_filter: str | None = None,
    overrides: Mapping[str, str] | None = None,
    listing: DataFrame | None = None,
    tokens: DataFrame | None = None,
) -> GrepRun:
    """Match ``pattern`` in ``files`` (columns of :data:`quarrysift.schema.FILE`).

    ``listing`` is the same files as paths only, where reading ``files`` for
    their names would mean opening them. ``tokens`` is a stored table of :func:`tokenize`
    for these files, which are then opened only for patterns that repeat a name.
    """
    known = sorted({*LANGUAGE_BY_SUFFIX.values(), *(overrides or {}).values()})
    compiled, rejected = compile_patterns(pattern, known)

    def chosen(rows: DataFrame, among: Mapping) -> DataFrame:
        rows = rows.withColumn("language", language_of(F.col("file_path"), overrides, None))
        rows = rows.where(F.col("language").isin(list(among)) if among else F.lit(False))
        if languages:
            rows = rows.where(F.lower("language").isin([name.lower() for name in languages]))
        if path_filter:
            rows = rows.where(path_glob(F.col("file_path"), [path_filter]))
        return rows

    paths = (files if listing is None else listing).select("file_path")
    messages = F.create_map(*[F.lit(x) for pair in (rejected or {"": ""}).items() for x in pair])
    warned = chosen(paths, rejected).select("language").distinct()
    # Languages that read the pattern alike are matched together.
    alike: dict[tuple, list[str]] = {}
    for name, one in compiled.items():
        if not languages or name.lower() in {asked.lower() for asked in languages}:
            alike.setdefault((one.elements, one.repeated), []).append(name)
    if tokens is not None:
        chosen_tokens = chosen(tokens.withColumnRenamed("path", "file_path"), compiled)
        tokens = chosen_tokens.withColumnRenamed("file_path", "path")
    texts = _texts(chosen(files, compiled))
    keep = F.col("content").isNotNull()
    # Every language needs these words, so files without them need no matching.
    words = set.intersection(*(p.words for p in compiled.values())) if compiled else set()
    for word in sorted(words):
        keep = keep & F.col("content").contains(word)
    texts = texts.where(keep | F.col("error").isNotNull())
    found = []
    for (elements, repeated), names in alike.items():
        among = F.col("language").isin(names)
        if repeated or tokens is None:
            found.append(_match_files(texts.where(among), compiled))
        else:
            for word in sorted(words):
                among = among & F.array_contains("token", word)
            found.append(matches_of(tokens.where(among), elements))
    rows = functools.reduce(DataFrame.unionByName, found) if found else _match_files(texts, {})
    return GrepRun(
        rows.select(*ROW.names),
        warned.select(F.element_at(messages, F.col("language")).alias("message"), "language"),
        chosen(paths, compiled),
    )


def _texts(files: DataFrame) -> DataFrame:
    return files.select("file_path", "language", decoded(F.col("content")).alias("content"), "error")


def tokenize(files: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Tokens of ``files``, to be stored (by language, say) and searched many times."""
    named = files.withColumn("language", language_of(F.col("file_path"), overrides, None))
    return token_lists(_texts(named.where(~F.col("language").isin(list(UNMATCHABLE)))))


def _match_files(texts: DataFrame, compiled: dict[str, Pattern]) -> DataFrame:
    return texts.mapInArrow(functools.partial(_match_batches, compiled), ROW)


def _match_batches(compiled: dict[str, Pattern], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of files as batches of rows of matches, which are bounded by their text as well: one text is in Python at a time."""
    schema = to_arrow_schema(ROW)

    def results(path: str, language: str, text: str | None, error: str | None):
        base = {"path": path, "language": language}
        if text is None:
            yield {**base, "message": f"cannot read {path}: {error}"}
        else:
            for match in _matches(text, compiled[language]):
                yield {**base, **match}

    rows, size = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            for row in results(*(column[i].as_py() for column in batch.columns)):
                rows.append(row)
                size += sum(map(len, row.get("lines", ()))) + sum(len(value) for _, value in row.get("captures", ()))
                if len(rows) >= _ROWS_PER_BATCH or size >= _CHARS_PER_BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _dim(text: Column) -> Column:
    painted = F.concat(F.lit("\x1b[2m"), text, F.lit("\x1b[0m"))
    return F.when(F.length(text) > 0, painted).otherwise(text)


def render(matches: DataFrame, color: bool = False) -> DataFrame:
    """``matches`` with ``block``: its lines with a line-number gutter.

    The gutter is as wide as the last matched line number of the file. With
    ``color``, gutter and unmatched context are dimmed.
    """
    width = F.length(F.col("last_line").cast("string"))

    def line(text: Column, i: Column) -> Column:
        number = gutter(F.col("start_line") + i, width)
        if not color:
            return F.concat(number, text)
        is_first, is_last = i == 0, F.col("start_line") + i == F.col("end_line")
        begin = F.when(is_first, F.least("start_column", F.length(text))).otherwise(F.lit(0))
        stop = F.when(is_last, F.least("end_column", F.length(text))).otherwise(F.length(text))
        gray = F.concat(F.lit("\x1b[90m"), number, F.lit("\x1b[0m"))
        head = F.substring(text, F.lit(1), begin)
        body = F.substring(text, begin + 1, stop - begin)
        tail = F.substring(text, stop + 1, F.length(text))
        return F.concat(gray, _dim(head), body, _dim(tail))

    return matches.withColumn("block", F.array_join(F.transform("lines", line), "\n"))
