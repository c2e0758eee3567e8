r"""Structural matching on tokens as rows.

Python only splits texts into tokens (:func:`token_lists`), one row of arrays per file;
once stored, that table serves any number of patterns. Spark spreads it to one row per
token, and one more for the file's end, which also carries the text. Each row knows the
bracket group it is a sibling in (``grp``), whether a node can start there (``node``), and
which attachments it continues (``chain``: ``a``, ``a.b`` and ``a.b(c)`` end at places of
one chain).

:func:`matches_of` follows a pattern from its end to its start. After the last k parts
every row holds the places of the match of those parts that starts at it, or null, and
each part is a window over the rows of one file in descending order:

* literals compare the following rows,
* a node takes the farthest place of its chain that holds a match,
* a run takes the nearest sibling that does,
* a containment takes the inner match that ends first, then the nearest sibling after it.

Those are the choices that a search with backtracking makes first, so the matches are
the same, at a cost linear in the tokens but for sorting. Files move once, by path, before
they become rows; a path names one file and must not be repeated.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .lexing import LINKS, Tokens

if TYPE_CHECKING:
    from .structural import Element

_PLACE = ["char", "byte", "line", "column"]
#: Where the row's token starts, and where the token before it ends.
_NUMBERS = ["pos", *_PLACE, *(f"end_{name}" for name in _PLACE)]

_ARRAYS = {
    "token": T.StringType(),
    **dict.fromkeys([*_NUMBERS, "grp", "chain"], T.IntegerType()),
    **dict.fromkeys(["node", "linked"], T.BooleanType()),
}

#: One row per file: its tokens and, last, its end as arrays of equal length.
TOKENS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("path", "language", "content", "message")]
    + [T.StructField(name, T.ArrayType(kind)) for name, kind in _ARRAYS.items()]
)

_TOKENS_PER_BATCH = 100_000
#: Longer stretches of literals are compared as one array.
_LAGS = 8


def token_lists(texts: DataFrame) -> DataFrame:
    """Rows of :data:`TOKENS` for files (``file_path, language, content, error``).

    A file without content has a ``message`` and, like an empty text, only its end.
    """
    schema = to_arrow_schema(TOKENS)

    def packed(files: list[tuple], columns: list[dict[str, Sequence]]) -> pa.RecordBatch:
        offsets = pa.array(np.cumsum([0, *(len(one["token"]) for one in columns)]), pa.int32())
        arrays = [pa.array(values, pa.string()) for values in zip(*files)]
        for name in _ARRAYS:
            kind = schema.field(name).type.value_type
            if kind == pa.int32():
                values = pa.array(np.concatenate([one[name] for one in columns]).astype(np.int32))
            else:
                values = pa.array([value for one in columns for value in one[name]], kind)
            arrays.append(pa.ListArray.from_arrays(offsets, values, type=schema.field(name).type))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, columns, size = [], [], 0
        for batch in batches:
            for path, language, text, error in zip(*(column.to_pylist() for column in batch.columns)):
                message = f"cannot read {path}: {error}" if text is None else None
                files.append((path, language, text, message))
                columns.append(_columns(text or "", language))
                size += len(columns[-1]["token"])
                if size >= _TOKENS_PER_BATCH:
                    yield packed(files, columns)
                    files, columns, size = [], [], 0
        if files:
            yield packed(files, columns)

    return texts.select("file_path", "language", "content", "error").mapInArrow(run, TOKENS)


def _columns(text: str, language: str) -> dict[str, Sequence]:
    """The arrays of one text."""
    tokens = Tokens(text, language)
    count = len(tokens.text)
    starts = np.array([*tokens.start, len(text)], np.int64)
    ends = np.array([0, *map(tokens.end, range(count))], np.int64)
    columns: dict[str, Sequence] = {
        "token": [*tokens.text, None],
        "pos": np.arange(count + 1),
        "grp": _siblings(tokens),
        "chain": _chains(tokens),
        "node": [*map(tokens.is_node, range(count)), False],
        "linked": [False, *(token in LINKS for token in tokens.text)],
    }
    columns.update(zip(_PLACE, _places(text, starts, starts)))
    # A token that ends with a line break still ends in the line of its last character.
    columns.update(zip((f"end_{n}" for n in _PLACE), _places(text, ends, np.maximum(ends - 1, 0))))
    return columns


def _places(text: str, at: np.ndarray, within: np.ndarray) -> list[np.ndarray]:
    """Character, byte, line (of ``within``, from 1) and column of places in a text."""
    data = np.frombuffer(text.encode(), np.uint8)
    first = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    breaks = np.searchsorted(first, np.flatnonzero(data == 10))
    line = np.searchsorted(breaks, within, side="left") + 1
    opening = np.append(0, breaks + 1)[line - 1]
    return [values.astype(np.int32) for values in (at, first[at], line, at - opening)]


def _siblings(tokens: Tokens) -> list[int]:
    """The group each place is a sibling in: its open bracket's position, or -1.

    A closing bracket is the end of the group it closes, the text's end that of the top.
    """
    open_groups, groups = [-1], []
    for i in range(len(tokens.text)):
        partner = tokens.partner.get(i, i)
        groups.append(open_groups.pop() if partner < i else open_groups[-1])
        if partner > i:
            open_groups.append(i)
    return [*groups, -1]


def _chains(tokens: Tokens) -> list[int]:
    """The first place of the attachments that each place ends or goes on with."""
    chains = list(range(len(tokens.text) + 1))
    for i in range(len(tokens.text)):
        following = tokens.attached(i)
        if following is not None:
            chains[following] = chains[i]
    return chains


def _steps(elements: Sequence[Element]) -> list[tuple[str, tuple[str, ...], Element]]:
    """Elements with neighbouring literals joined to one step."""
    steps: list[tuple[str, tuple[str, ...], Element]] = []
    for element in elements:
        if element.kind == "literal" and steps and steps[-1][0] == "literal":
            steps[-1] = ("literal", (*steps[-1][1], element.value), steps[-1][2])
        else:
            steps.append((element.kind, (element.value,), element))
    return steps


def _captures(elements: Sequence[Element], at: int = 0) -> tuple[dict[str, int], int]:
    """Names with the index of the place they start at, and the index of the match's end."""
    names: dict[str, int] = {}
    for kind, values, element in _steps(elements):
        if kind in ("node", "run") and values[0]:
            names[values[0]] = at
        at += 1
        if kind == "contain":
            inner, end = _captures(element.inner, at)
            names.update(inner)
            at = end + 1
    return names, at


def _descending(*keys: str):
    return Window.partitionBy(*keys).orderBy(F.desc("pos"))


def _so_far(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _hits(rows: DataFrame, elements: Sequence[Element], name: str) -> DataFrame:
    """``rows`` with ``name``: the places of the match that starts there, or null."""
    state = f"{name}_s"
    rows = rows.withColumn(state, F.array("place"))
    for number, (kind, values, element) in enumerate(reversed(_steps(elements))):
        if kind == "literal":
            rows = _literals(rows, state, values)
        elif kind == "node":
            farthest = F.first(state, ignorenulls=True).over(_so_far(_descending("path", "chain")))
            rows = rows.withColumn(state, farthest)
            following = F.lag(state).over(_descending("path", "grp"))
            rows = rows.withColumn(state, F.when(F.col("node"), F.concat(F.array("place"), following)))
        elif kind == "run":
            nearest = F.last(state, ignorenulls=True).over(_so_far(_descending("path", "grp")))
            rows = rows.withColumn(state, F.concat(F.array("place"), nearest))
        else:
            rows = _contained(rows, state, element.inner, f"{name}_{number}")
    found = F.element_at(state, -1)["pos"] > F.col("pos")
    if elements[0].kind == "node":
        found = found & ~F.col("linked")
    return rows.withColumn(name, F.when(found, F.col(state))).drop(state)


def _literals(rows: DataFrame, state: str, values: Sequence[str]) -> DataFrame:
    window = _descending("path")
    if len(values) <= _LAGS:
        same = F.col("token") == values[0]
        for ahead, value in enumerate(values[1:], 1):
            same = same & (F.lag("token", ahead).over(window) == value)
    else:
        stretch = F.collect_list("token").over(window.rowsBetween(1 - len(values), 0))
        same = stretch == F.array(*map(F.lit, reversed(values)))
    rest = F.lag(state, len(values)).over(window)
    return rows.withColumn(state, F.when(same, F.concat(F.array("place"), rest)))


def _contained(rows: DataFrame, state: str, inner: Sequence[Element], name: str) -> DataFrame:
    """A run of siblings around the match of ``inner`` that ends first."""
    rows = _hits(rows, inner, name)
    ends = F.when(
        F.col(name).isNotNull(),
        F.struct(F.element_at(name, -1)["pos"].alias("end"), "pos", F.col(name).alias("places")),
    )
    rows = rows.withColumn(name, F.min(ends).over(_so_far(_descending("path"))))
    # Every row asks for the nearest sibling with a match from the inner match's end on:
    # it stands twice among its siblings, as itself and there.
    rows = rows.withColumn("asks", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.withColumn("at", F.when(F.col("asks") == 0, F.col("pos")).otherwise(F.col(name)["end"]))
    order = Window.partitionBy("path", "grp").orderBy(F.desc("at"), "asks")
    known = F.when(F.col("asks") == 0, F.col(state))
    rows = rows.withColumn("rest", F.last(known, ignorenulls=True).over(_so_far(order)))
    rows = rows.where("asks = 1").withColumn(
        state,
        F.when(F.col("at").isNotNull(), F.concat(F.array("place"), F.col(name)["places"], F.col("rest"))),
    )
    return rows.drop("asks", "at", "rest", name)


def matches_of(tokens: DataFrame, elements: Sequence[Element]) -> DataFrame:
    """Matches of ``elements``, and one row with only a ``message`` per unreadable file.

    Elements must not repeat a name.
    """
    # Files move as they are, one row each, and become token rows where they arrive.
    files = tokens.repartition("path")
    rows = files.select("path", "language", "content", "message", F.inline(F.arrays_zip(*_ARRAYS)))
    at_end = F.col("token").isNull()
    rows = rows.withColumns(
        {
            "content": F.when(at_end, F.col("content")),
            "message": F.when(at_end, F.col("message")),
            "place": F.struct(*_NUMBERS),
        }
    )
    rows = _hits(rows, elements, "hit").where("hit IS NOT NULL OR content IS NOT NULL OR message IS NOT NULL")
    files = rows.groupBy("path").agg(
        F.first("language").alias("language"),
        F.first("content", ignorenulls=True).alias("content"),
        F.first("message", ignorenulls=True).alias("message"),
        F.sort_array(F.collect_list("hit")).alias("hits"),
    )
    files = files.where("size(hits) > 0 OR message IS NOT NULL").withColumns(
        {"text_lines": F.split("content", "\n"), "data": F.encode("content", "utf-8")}
    )
    names, _ = _captures(elements)
    return files.select(
        "message",
        "path",
        "language",
        F.inline_outer(F.transform("hits", lambda hit, i: _match(hit, i, names))),
    )


def _match(hit: Column, number: Column, names: Mapping[str, int]) -> Column:
    first, last = hit[0], F.element_at(hit, -1)

    def source(i: int) -> Column:
        start, stop = hit[i], hit[i + 1]
        text = F.decode(F.substring("data", start["byte"] + 1, stop["end_byte"] - start["byte"]), "utf-8")
        return F.when(stop["pos"] > start["pos"], text).otherwise("")

    pairs = [part for name, i in names.items() for part in (F.lit(name), source(i))]
    captures = F.create_map(*pairs) if pairs else F.expr("CAST(map() AS map<string,string>)")
    lines = F.slice("text_lines", first["line"], last["end_line"] - first["line"] + 1)
    fields = {
        "match_no": number + 1,
        "start_line": first["line"],
        "end_line": last["end_line"],
        "start_char": first["char"],
        "end_char": last["end_char"],
        "start_byte": first["byte"],
        "end_byte": last["end_byte"],
        "start_column": first["column"],
        "end_column": last["end_column"],
        "captures": captures,
        "lines": F.transform(lines, lambda line: F.regexp_replace(line, "\r+$", "")),
        "last_line": F.array_max(F.transform("hits", lambda h: F.element_at(h, -1)["end_line"])),
    }
    return F.struct(*(value.alias(name) for name, value in fields.items()))
