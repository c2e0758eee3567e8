"""Chat formatting with minimum-cost repair of the roles.

A legal conversation is an optional system turn and then user and assistant in turns, and
ends with the assistant. Four states tell what came last. Each given turn is kept, gets
another role or is merged into the turn before, and empty turns may be put in; the
cheapest way through the states is found by dynamic programming.

What a turn can do to the states depends on its role alone, so a stretch of turns is a 4 x 4 table of
least costs, and stretches combine as such tables do. Rows are sorted over many tasks, a very
long conversation among several. Each task sums its first and last stretch up in a table; from
these, two per task, the driver finds the least costs to go after every stretch, and with them the
tasks tell where each stretch leads. Then every task repairs and renders its own rows. Of
equally cheap ways the one with the smallest state at the first difference is taken, however
a conversation is split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql import types as T

from .common import ROWS_PER_BATCH, prepare, stored
from .tokenfiles import open_folder

ROLES = ("system", "user", "assistant")
# States: nothing yet, and after a turn of each role.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# The state that a turn of each role leads to, by state; -1 where it is not allowed.
NEXT = {"system": (1, -1, -1, -1), "user": (2, 2, -1, 2), "assistant": (-1, -1, 3, -1)}
FINAL = ASSISTANT

# Costs. A turn whose role is none of the three has to get one, which is cheap.
MERGE_SAME, INSERT, RELABEL, MERGE_OTHER, NAME = 1, 2, 3, 4, 1
FAR = 1 << 40


@dataclass(frozen=True)
class Move:
    """How a turn is taken: the empty turns before it, what is done, and the role it ends up in."""

    cost: int
    inserted: tuple[str, ...]
    action: str
    role: str


def insertions() -> dict[tuple[int, int], tuple[str, ...]]:
    """The shortest empty turns that lead from one state to another."""
    ways: dict[tuple[int, int], tuple[str, ...]] = {(s, s): () for s in range(STATES)}
    for _ in range(STATES):
        for (a, b), way in list(ways.items()):
            for role in ROLES:
                c = NEXT[role][b]
                if c >= 0 and len(way) + 1 < len(ways.get((a, c), range(99))):
                    ways[a, c] = (*way, role)
    return ways


def moves(given: str | None) -> list[list[Move | None]]:
    """The cheapest move of a turn for each pair of states; among equal costs the first in order."""
    table: list[list[Move | None]] = [[None] * STATES for _ in range(STATES)]
    for (a, b), way in insertions().items():
        options = []
        for role in ROLES:
            c = NEXT[role][b]
            if c >= 0:
                cost = 0 if role == given else RELABEL if given in ROLES else NAME
                options.append((c, Move(cost, way, "keep" if role == given else "relabel", role)))
        if b != START:
            role = ROLES[b - 1]
            options.append((b, Move(MERGE_SAME if role == given else MERGE_OTHER, way, "merge", role)))
        for c, move in options:
            whole = Move(move.cost + INSERT * len(way), way, move.action, move.role)
            if table[a][c] is None or whole.cost < table[a][c].cost:
                table[a][c] = whole
    return table


CODES = {**{role: k for k, role in enumerate(ROLES)}, None: len(ROLES)}
MOVES = [moves(role) for role in (*ROLES, None)]
COSTS = np.array([[[FAR if m is None else m.cost for m in row] for row in table] for table in MOVES], np.int64)
END_WAYS = {s: way for (s, b), way in insertions().items() if b == FINAL}
END_COSTS = np.array([INSERT * len(END_WAYS[s]) if s != START else FAR for s in range(STATES)], np.int64)


def codes_of(roles: pa.Array) -> np.ndarray:
    """Role numbers; names are compared without case and outer blanks."""
    known = [None if r is None else r.strip().lower() for r in roles.to_pylist()]
    return np.array([CODES.get(r, CODES[None]) for r in known], np.int8)


def summary(codes: np.ndarray) -> np.ndarray:
    """Least costs from state to state over a stretch of turns."""
    total = np.where(np.eye(STATES, dtype=bool), 0, FAR)
    for code in codes.tolist():
        total = np.minimum((total[:, :, None] + COSTS[code][None]).min(axis=1), FAR)
    return total


def path(codes: np.ndarray, start: int, after: np.ndarray) -> list[int]:
    """The states after each turn on the cheapest way from ``start``, given the costs to go after the last."""
    to_go = np.empty((len(codes) + 1, STATES), np.int64)
    to_go[-1] = after
    for i in range(len(codes) - 1, -1, -1):
        to_go[i] = np.minimum((COSTS[codes[i]] + to_go[i + 1]).min(axis=1), FAR)
    states, state = [], start
    for i, code in enumerate(codes.tolist()):
        state = int((COSTS[code][state] + to_go[i + 1]).argmin())
        states.append(state)
    return states


@dataclass
class Stretch:
    """The first or last conversation of a file, as far as it lies there."""

    conversation: object
    table: np.ndarray
    turns: int
    after: list[int] | None = None
    start: int = START
    done: int = 0
    closes: bool = True


def header(role: str) -> str:
    return f"<|im_start|>{role}\n"


CLOSE = "<|im_end|>\n"


def rendered(move: Move, text: str, opened: bool) -> str:
    """A turn's piece: the end of the turn before, empty turns, and its own beginning and text."""
    empty = "".join(header(r) + CLOSE for r in move.inserted)
    if move.action == "merge":
        if not move.inserted:
            return "\n\n" + text
        # What is merged goes into the last of the empty turns.
        empty = "".join(header(r) + CLOSE for r in move.inserted[:-1])
        return (CLOSE if opened else "") + empty + header(move.inserted[-1]) + text
    return (CLOSE if opened else "") + empty + header(move.role) + text


def ending(state: int) -> str:
    return CLOSE + "".join(header(r) + CLOSE for r in END_WAYS[state])


def read_part(uri: str, columns: list[str]) -> Iterator[pa.RecordBatch]:
    store, name = open_folder(uri)
    with store.open_input_file(name) as file:
        yield from pq.ParquetFile(file).iter_batches(batch_size=ROWS_PER_BATCH, columns=columns)


def runs_of(keys: list) -> list[tuple[int, int]]:
    """Ranges of equal neighbours."""
    edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
    return list(zip(edges, edges[1:])) if keys else []


def roles_in(uri: str) -> tuple[list, np.ndarray]:
    keys, codes = [], [np.zeros(0, np.int8)]
    for batch in read_part(uri, ["c", "r"]):
        keys += batch.column(0).to_pylist()
        codes.append(codes_of(batch.column(1)))
    return keys, np.concatenate(codes)


def chains(summaries: list[dict]) -> tuple[list[list[tuple[str, str]]], dict[tuple[str, str], Stretch]]:
    """Stretches by file and side, and which of them follow each other, with their costs to go."""
    parts: dict[tuple[str, str], Stretch] = {}
    found: list[list[tuple[str, str]]] = []
    for row in summaries:
        for side in ("first", "last"):
            if side == "last" and row["single"]:
                continue
            end = row[side]
            part = Stretch(end["c"], np.array(end["table"], np.int64).reshape(STATES, STATES), end["turns"])
            parts[row["file"], side] = part
            goes_on = side == "first" and found and parts[found[-1][-1]].conversation == part.conversation
            if goes_on:
                found[-1].append((row["file"], side))
            else:
                found.append([(row["file"], side)])
    for chain in found:
        after = END_COSTS
        for key in reversed(chain):
            parts[key].after = after.tolist()
            after = np.minimum((parts[key].table + after).min(axis=1), FAR)
        done = 0
        for key in chain:
            parts[key].done, parts[key].closes = done, key == chain[-1]
            done += parts[key].turns
    return found, parts


def format_chats(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Per given turn: its conversation and turn, seq, action, new_role, inserted and piece.

    ``seq`` numbers a conversation's turns from 0 in the order of ``turn``, nulls first, equal turns by a
    hash of role and text. ``inserted`` lists the roles of empty turns put in before it. The pieces of a
    conversation one after the other are its text in the ChatML form; the last piece also holds
    what is put in at the end. Roles other than the three, and null, are given one.
    Null texts are empty; rows with a null conversation are one conversation; repeated rows are
    turns of their own. Other columns are not read.
    """
    spark = turns.sparkSession
    prepare(spark)
    rows = turns.select(
        F.col(id_col).alias("c"), F.col(turn_col).alias("t"), F.col(role_col).alias("r"), F.col(text_col).alias("x")
    )
    rows = rows.withColumn("h", F.xxhash64("r", "x"))
    rows = stored(rows.repartitionByRange("c", "t", "h").sortWithinPartitions("c", "t", "h"), "turns")
    # A task wrote one file, and the tasks' numbers follow their ranges.
    files = sorted(rows.inputFiles(), key=task_order)
    id_type = rows.schema["c"].dataType
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files)))

    side_type = T.StructType(
        [T.StructField("c", id_type), T.StructField("table", T.ArrayType(T.LongType())), T.StructField("turns", T.LongType())]
    )
    schema = T.StructType(
        [T.StructField("file", T.StringType()), T.StructField("single", T.BooleanType()), T.StructField("first", side_type), T.StructField("last", side_type)]
    )

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                keys, codes = roles_in(name)
                if not keys:
                    continue
                found = runs_of(keys)
                ends = [
                    {"c": keys[a], "table": summary(codes[a:b]).ravel().tolist(), "turns": b - a} for a, b in (found[0], found[-1])
                ]
                row = {"file": name, "single": len(found) == 1, "first": ends[0], "last": ends[1]}
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    arrow = pa.schema(
        [("file", pa.string()), ("single", pa.bool_())]
        + [(n, pa.struct([("c", arrow_type(id_type)), ("table", pa.list_(pa.int64())), ("turns", pa.int64())])) for n in ("first", "last")]
    )
    summaries = sorted((r.asDict(True) for r in listed.mapInArrow(sum_up, schema).collect()), key=lambda r: task_order(r["file"]))
    found, parts = chains(summaries)
    afters = {key: parts[key].after for chain in found for key in chain[:-1]}

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for side in ("first", "last"):
                    if (name, side) in afters:
                        keys, codes = roles_in(name)
                        a, b = runs_of(keys)[0 if side == "first" else -1]
                        ends = [path(codes[a:b], s, np.array(afters[name, side]))[-1] for s in range(STATES)]
                        columns = [pa.array([name]), pa.array([side]), pa.array([ends], pa.list_(pa.int32()))]
                        yield pa.RecordBatch.from_arrays(columns, names=["file", "side", "ends"])

    if afters:
        leads = listed.mapInArrow(lead, "file string, side string, ends array<int>").collect()
        ends = {(r["file"], r["side"]): r["ends"] for r in leads}
        for chain in found:
            for before, key in zip(chain, chain[1:]):
                parts[key].start = ends[before][parts[before].start]
    plans: dict[str, dict[str, tuple]] = {}
    for (name, side), part in parts.items():
        plans.setdefault(name, {})[side] = (part.start, part.after, part.done, part.closes)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if name in plans:
                    yield from repair_file(name, plans[name])

    out = T.StructType(
        [
            T.StructField("c", id_type),
            T.StructField("t", rows.schema["t"].dataType),
            T.StructField("seq", T.LongType()),
            T.StructField("action", T.StringType()),
            T.StructField("new_role", T.StringType()),
            T.StructField("inserted", T.ArrayType(T.StringType())),
            T.StructField("piece", T.StringType()),
        ]
    )
    return listed.mapInArrow(repair, out).withColumnsRenamed({"c": id_col, "t": turn_col})


def task_order(file: str) -> tuple[int, str]:
    """Files by the number of the task that wrote them; names alone sort part-100000 before part-99999."""
    return int(re.search(r"part-(\d+)[^/]*$", file)[1]), file


def arrow_type(kind: T.DataType) -> pa.DataType:
    return to_arrow_type(kind)


def repair_file(name: str, ends: dict[str, tuple]) -> Iterator[pa.RecordBatch]:
    """Two readings of one file: the roles decide, then the texts are rendered batch by batch."""
    keys, codes = roles_in(name)
    found = runs_of(keys)
    before, after, number, last = [], [], [], []
    for k, (a, b) in enumerate(found):
        known = ends["first"] if k == 0 else ends["last"] if k == len(found) - 1 else None
        if known is None:
            known = (START, END_COSTS, 0, True)
        start, rest, done, closes = known
        states = path(codes[a:b], start, np.asarray(rest))
        before += [start, *states[:-1]]
        after += states
        number += range(done, done + b - a)
        last += [False] * (b - a - 1) + [closes]
    at = 0
    for batch in read_part(name, ["c", "t", "x"]):
        columns: list[list] = [[], [], [], [], []]
        for text in batch.column(2).to_pylist():
            move = MOVES[codes[at]][before[at]][after[at]]
            piece = rendered(move, text or "", before[at] != START)
            if last[at]:
                piece += ending(after[at])
            for column, value in zip(columns, (number[at], move.action, move.role, list(move.inserted), piece)):
                column.append(value)
            at += 1
        kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            names=["c", "t", "seq", "action", "new_role", "inserted", "piece"],
        )
