"""The trie of conversation prefixes, where conversations borrow their first turns from others.

A conversation c is rebuilt from the head of a base conversation and from what follows its own head. Texts
are never rebuilt. A turn is known by its reference, the place where it is stored, with the SHA-256 of role and
text there. A sequence of turns has a fingerprint in a monoid: the product of (1, t) over its
turns, where (m, x) * (n, y) = (m + n, x + B**m * y) modulo a prime, in three lanes with random B. The prefix products
of every original conversation are stored beside its turns. The products of a rebuilt one follow from three of them:
its base's at the head, its own at the head and its own at the turn in question.

Prefixes with equal depth and fingerprint are a node. Two sequences are equal if they are so without their
last turns and the last turns are equal; so each group's members must agree on their parents' fingerprints and on what
their last turns refer to. Where a group does not, the work is done again with other values of B:
results never rest on luck.

Turns are sorted over all tasks, so one conversation may span many of them: each task folds its
stretches, and the first stretch of a task takes over the product (or the sum) of those before it. Sums over
subtrees need no walk: a node belongs to the smallest conversation through it, so a conversation
owns the end of its path, and every node's sum is over what its members own from its depth on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import hot_keys, lookup_join
from .common import prepare, stored

PRIME = (1 << 31) - 1
LANES = 3
# A digest as four words.
WORDS = ["q0", "q1", "q2", "q3"]
PRODUCTS = [f"h{lane}" for lane in range(LANES)]
BEFORE = [f"g{lane}" for lane in range(LANES)]
NODE = ["d", "f0", "f1"]
SEEDS = 16
# Bytes of ids that are handed on as one piece to the digest of a node's ends.
PIECE_BYTES = 1 << 20


def multipliers(seed: int) -> list[int]:
    """The B of each lane."""
    found = (hashlib.sha256(f"{seed}:{lane}".encode()).digest() for lane in range(LANES))
    return [2 + int.from_bytes(d[:8], "big") % (PRIME - 3) for d in found]


def folded(column: list[str]) -> tuple[Column, Column]:
    """A product's lanes in two words, as keys."""
    a, b, c = (F.col(x) for x in column)
    return a * F.lit(1 << 31) + b, c


def turn_references(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Turns without their texts, sorted: conversation c, digest q and the bytes b of the text."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.select(
        F.col(id_col).cast("long").alias("c"),
        F.col(turn_col).alias("t"),
        F.unhex(F.sha2(content, 256)).alias("q"),
        F.octet_length(text).cast("long").alias("b"),
    ).where("c IS NOT NULL")
    return rows.repartitionByRange("c", "t", "q").sortWithinPartitions("c", "t", "q").select("c", "q", "b")


@dataclass
class Stretch:
    """The conversation that was open at the end of a batch: its turns so far and their product."""

    key: int | None = None
    turns: int = 0
    product: tuple[int, ...] = (0,) * LANES


def fold_turns(keys: np.ndarray, digests: np.ndarray, bases: list[int], powers: np.ndarray, open_: Stretch) -> tuple[np.ndarray, list, list, Stretch]:
    """Positions from 1 in each conversation's stretch, its products with and without each turn, and the open stretch."""
    count = len(keys)
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    start = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    place = np.arange(count) - start[run]
    going_on = open_.key is not None and keys[0] == open_.key
    first = run == 0
    offset = open_.turns if going_on else 0
    with_turn, without = [], []
    for lane, base in enumerate(bases):
        power = powers[lane][place]
        if offset:
            power = np.where(first, power * pow(base, offset, PRIME) % PRIME, power)
        term = (digests[:, lane] % PRIME).astype(np.int64) * power % PRIME
        total = np.cumsum(term)
        total = total - (total[start] - term[start])[run]
        if going_on:
            total = np.where(first, total + open_.product[lane], total)
        with_turn.append(total % PRIME)
        without.append((total - term) % PRIME)
    place = place + 1 + np.where(first, offset, 0)
    return place, with_turn, without, Stretch(int(keys[-1]), int(place[-1]), tuple(int(h[-1]) for h in with_turn))


def power_table(bases: list[int], count: int) -> np.ndarray:
    """B**0, B**1, ... of every lane."""
    table = np.ones((len(bases), count), np.int64)
    for lane, base in enumerate(bases):
        for k in range(1, count):
            table[lane, k] = table[lane, k - 1] * base % PRIME
    return table


def prefix_products(rows: DataFrame, seed: int) -> DataFrame:
    """Stored turns: c, position i in it, digest words, bytes b, products up to (h) and before (g) the turn.

    ``part`` is the task that wrote a turn.
    """
    bases = multipliers(seed)
    names = ["part", "c", "i", *WORDS, "b", *PRODUCTS, *BEFORE]
    schema = ", ".join(f"{n} {'int' if n == 'part' else 'long'}" for n in names)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        powers = power_table(bases, 1)
        open_ = Stretch()
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if n > powers.shape[1]:
                powers = power_table(bases, n)
            digests = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u8").reshape(n, 4).astype(np.uint64)
            place, with_turn, without, open_ = fold_turns(batch.column(0).to_numpy(), digests, bases, powers, open_)
            words = digests.view(np.int64)
            columns = [pa.array(np.full(n, part, np.int32)), batch.column(0), pa.array(place)]
            columns += [pa.array(words[:, k].copy()) for k in range(4)] + [batch.column(2)]
            columns += [pa.array(h) for h in with_turn + without]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    local = stored(rows.mapInArrow(fold, schema), "turn-references")
    return with_earlier_stretches(local, bases)


def with_earlier_stretches(local: DataFrame, bases: list[int]) -> DataFrame:
    """Positions and products over whole conversations from those within tasks.

    Only the first stretch of a task can go on from earlier ones, so at most a row per task is broadcast.
    """
    last = [F.max_by(h, "i").alias(h) for h in PRODUCTS]
    cells = local.groupBy("c", "part").agg(F.max("i").alias("n"), *last)
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("o", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    moves = [f"m{lane}" for lane in range(LANES)]

    def powers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pa.array([pow(b, o, PRIME) for o in batch.column("o").to_pylist()], pa.int64()) for b in bases]
            columns = [batch.column(x) for x in ("c", "part", "o", *PRODUCTS)]
            yield pa.RecordBatch.from_arrays(columns + found, names=["c", "part", "o", *PRODUCTS, *moves])

    types = ", ".join(f"{n} long" for n in ["o", *PRODUCTS, *moves])
    # Conversations in one task need none of this.
    spans = cells.where(F.col("o") > 0).select("c").distinct()
    cells = cells.join(spans, "c", "left_semi").mapInArrow(powers, f"c long, part int, {types}")
    for h, m in zip(PRODUCTS, moves):
        before = F.coalesce(F.sum(F.col(h) * F.col(m) % PRIME).over(earlier), F.lit(0)) % PRIME
        cells = cells.withColumn("before_" + h, before)
    cells = cells.where(F.col("o") > 0).select("c", "part", "o", *moves, *("before_" + h for h in PRODUCTS))
    found = local.join(F.broadcast(cells), ["c", "part"], "left")
    fixed = {"i": F.col("i") + F.coalesce("o", F.lit(0))}
    for h, g, m in zip(PRODUCTS, BEFORE, moves):
        for x in (h, g):
            fixed[x] = F.coalesce((F.col("before_" + h) + F.col(m) * F.col(x) % PRIME) % PRIME, F.col(x))
    return found.withColumns(fixed).select(*local.columns)


def rebuilt_turns(
    turns: DataFrame, base_of: Callable[[Column], Column], head_of: Callable[[Column], Column], most: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations (c, n turns) and their turns.

    A turn has c, depth d, fingerprints of its prefix (f0, f1) and of the prefix before it (p0, p1),
    the reference's digest and bytes, and whether it is the last.
    """
    bases = multipliers(seed)
    # What brings a product from one position to an earlier one, by the difference.
    back = [[pow(pow(b, -1, PRIME), k, PRIME) for k in range(most + 1)] for b in bases]
    head = F.when(F.col("i") <= most, F.struct("i", *WORDS, "b", *PRODUCTS, *BEFORE))
    whole = turns.groupBy("c").agg(F.max("i").alias("n"), F.sort_array(F.collect_list(head)).alias("heads"))
    whole = stored(whole, "conversations")
    convs = whole.select(
        "c", "n", F.col("heads").alias("own"), base_of(F.col("c")).cast("long").alias("base"), head_of(F.col("c")).cast("int").alias("h")
    )
    known = whole.select(F.col("c").alias("base"), "heads")
    convs = lookup_join(convs, known, "base", "left", hot_keys(convs, "base"), ["c"])
    convs = convs.withColumn("borrowed", F.least("h", F.coalesce(F.size("heads"), F.lit(0))))
    convs = convs.withColumn("total", F.col("borrowed") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    for k, h in enumerate(PRODUCTS):
        # Products at the two heads; nothing borrowed and nothing left out are the unit.
        given = F.when(F.col("borrowed") > 0, F.get(F.col("heads"), F.col("borrowed") - 1)[h])
        left = F.when(F.col("h") > 0, F.get(F.col("own"), F.col("h") - 1)[h])
        shift = F.get(F.array(*map(F.lit, back[k])), F.col("h") - F.col("borrowed")).cast("long")
        convs = convs.withColumn(f"given{k}", F.coalesce(given, F.lit(0)).cast("long"))
        convs = convs.withColumn(f"left{k}", F.coalesce(left, F.lit(0)).cast("long")).withColumn(f"shift{k}", shift)
    convs = stored(convs.drop("own"), "rebuilt-conversations")

    keys = [x.alias(n) for x, n in zip((*folded(PRODUCTS), *folded(BEFORE)), ("f0", "f1", "p0", "p1"))]
    shown = ["c", "d", *keys, *WORDS, "b", (F.col("d") == F.col("total")).alias("is_last")]
    heads = convs.select("c", "total", F.explode(F.slice("heads", F.lit(1), F.col("borrowed"))).alias("turn"))
    heads = heads.select("c", "total", F.col("turn.i").alias("d"), "turn.*").select(*shown)

    # Every stretch gets its conversation's values, so that a long conversation is not one key.
    values = [f"{x}{k}" for x in ("given", "left", "shift") for k in range(LANES)]
    stretches = turns.select("c", "part").distinct().join(convs.select("c", "h", "borrowed", "total", *values), "c")
    rest = turns.join(stretches, ["c", "part"]).where("i > h").withColumn("d", F.col("i") - F.col("h") + F.col("borrowed"))
    for k in range(LANES):
        for x in (PRODUCTS[k], BEFORE[k]):
            ahead = F.pmod(F.col(x) - F.col(f"left{k}"), F.lit(PRIME)) * F.col(f"shift{k}")
            rest = rest.withColumn(x, (F.col(f"given{k}") + ahead % PRIME) % PRIME)
    found = heads.unionByName(rest.select(*shown))
    return convs.select("c", F.col("total").alias("n")), stored(found, "rebuilt-turns")


def group_nodes(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Nodes with members (n), smallest member (c), parent (p0, p1) and bytes (b), and whether all groups are of equal sequences."""
    checked = ["p0", "p1", *WORDS]
    ends = [f(x).alias(a + x) for x in checked for f, a in ((F.min, "least_"), (F.max, "most_"))]
    nodes = rows.groupBy(*NODE).agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("n"), F.max("b").alias("b"), *ends)
    equal = F.lit(True)
    for x in checked:
        equal = equal & (F.col("least_" + x) == F.col("most_" + x))
    nodes = nodes.select(*NODE, "c", "n", "b", F.col("least_p0").alias("p0"), F.col("least_p1").alias("p1"), equal.alias("equal"))
    nodes = stored(nodes, "nodes")
    return nodes.drop("equal"), nodes.where(~F.col("equal")).isEmpty()


def sums_from_below(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Of each node, the sums of ``values`` over its conversation's own nodes from its depth on."""
    names = ["part", "c", "d", *values]
    schema = "part int, " + ", ".join(f"{n} long" for n in names[1:])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        key, before = None, [0] * len(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            new = np.concatenate([[True], keys[1:] != keys[:-1]])
            start = np.flatnonzero(new)
            run = np.cumsum(new) - 1
            sums = []
            for k in range(len(values)):
                given = batch.column(2 + k).to_numpy()
                total = np.cumsum(given)
                total = total - (total[start] - given[start])[run]
                sums.append(total + np.where(run == 0, before[k], 0) if key == keys[0] else total)
            key, before = keys[-1], [s[-1] for s in sums]
            columns = [pa.array(np.full(len(keys), part, np.int32)), batch.column(0), batch.column(1), *map(pa.array, sums)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    deepest_first = [F.col("c"), F.col("d").desc()]
    ordered = nodes.select("c", "d", *values).repartitionByRange(*deepest_first).sortWithinPartitions(*deepest_first)
    local = stored(ordered.mapInArrow(add, schema), "sums")
    # At most a row per task, as for the products.
    cells = local.groupBy("c", "part").agg(*(F.max(v).alias("own_" + v) for v in values))
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("c", "part", *(F.sum("own_" + v).over(earlier).alias("below_" + v) for v in values))
    cells = cells.where(F.col("below_" + values[0]).isNotNull())
    found = local.join(F.broadcast(cells), ["c", "part"], "left")
    return found.select("c", "d", *((F.col(v) + F.coalesce("below_" + v, F.lit(0))).alias(v) for v in values))


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """Per node the SHA-256 of the ids (c) that end there, ascending and joined by commas.

    Tasks write neighbouring ids as pieces of bounded size; only pieces of a node come together, and they are
    read as a stream.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            pieces: list[list] = []
            size = 0
            for *node, c in rows:
                text = str(c)
                if pieces and pieces[-1][:3] == node and size < PIECE_BYTES:
                    pieces[-1][4].append(text)
                    size += len(text) + 1
                else:
                    pieces.append([*node, c, [text]])
                    size = len(text)
            if pieces:
                columns = list(zip(*([*p[:4], ",".join(p[4])] for p in pieces)))
                kinds = [pa.int64()] * 4 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*NODE, "c", "ids"])

    def hash_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def closed() -> pa.RecordBatch:
            columns = [pa.array([x], pa.int64()) for x in node] + [pa.array([state.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, names=[*NODE, "ends"])

        for batch in batches:
            for *key, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node:
                    if node is not None:
                        yield closed()
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if node is not None:
            yield closed()

    order = [*NODE, "c"]
    longs = ", ".join(f"{n} long" for n in order)
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, longs + ", ids string")
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*order).select(*NODE, "ids")
    return pieces.mapInArrow(hash_up, ", ".join(f"{n} long" for n in NODE) + ", ends string")


def parents(nodes: DataFrame) -> DataFrame:
    """The conversation of the parent (up) of those nodes (c, d) below depth 1 where another conversation begins."""
    above = nodes.select("c", (F.col("d") + 1).alias("d"))
    firsts = nodes.where("d > 1").join(above, ["c", "d"], "left_anti")
    firsts = stored(firsts.select("c", "d", F.concat_ws(":", F.col("d") - 1, "p0", "p1").alias("node")), "first-nodes")
    owners = nodes.select(F.concat_ws(":", *NODE).alias("node"), F.col("c").alias("up"))
    return lookup_join(firsts, owners, "node", "inner", hot_keys(firsts, "node"), ["c"]).select("c", "d", "up")


def prefix_trie(
    turns: DataFrame,
    base_of: Callable[[Column], Column],
    head_of: Callable[[Column], Column],
    most: int,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    seeds: int = SEEDS,
) -> DataFrame:
    """A row per distinct prefix (node) of the rebuilt conversations.

    ``base_of`` and ``head_of`` give, for an id, the conversation that its first turns come from and how
    many are replaced (0 to ``most``). Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, all as in the trie's definition; the root has depth 0 and no parent.

    Ids are whole numbers; rows with a null id are left out. Turns go by ``turn``, nulls first, equal ones by the SHA-256 of
    role and text; null roles and texts are empty. Repeated rows are turns of their own. An absent base lends nothing.
    A conversation without any turn left is a member of the root and ends there. Without
    conversations there is no row, not even a root. Other columns are not read.
    """
    prepare(turns.sparkSession)
    references = turn_references(turns, id_col, turn_col, role_col, text_col)
    for seed in range(seeds):
        given = prefix_products(references, seed)
        convs, rows = rebuilt_turns(given, base_of, head_of, most, seed)
        nodes, exact = group_nodes(rows)
        if exact:
            break
    else:
        raise RuntimeError(f"{seeds} sets of multipliers have fingerprints in common; give more seeds")

    children = nodes.groupBy((F.col("d") - 1).alias("d"), F.col("p0").alias("f0"), F.col("p1").alias("f1"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, NODE, "left").fillna(0, ["n_children"])
    nodes = nodes.withColumn("saved", (F.col("n") - 1) * F.col("b")).withColumn("leaves", (F.col("n_children") == 0).cast("long"))
    nodes = stored(nodes, "trie-nodes")

    # Members above their own nodes add all that they own; hot conversations are split.
    owned = nodes.groupBy("c").agg(F.min("d").alias("from"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    lower = lookup_join(rows.select(*NODE, "c"), owned, "c", "inner", hot_keys(rows, "c"), ["d"]).where(F.col("d") < F.col("from"))
    lower = lower.groupBy(*NODE).agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
    own = sums_from_below(nodes, ["saved", "leaves"]).withColumnsRenamed({"saved": "own_saved", "leaves": "own_leaves"})
    ends = digests_of_ends(rows.where("is_last"))
    nothing = hashlib.sha256(b"").hexdigest()
    root = convs.agg(F.min("c").alias("root")).where("root IS NOT NULL")

    found = nodes.join(own, ["c", "d"]).join(lower, NODE, "left").join(ends, NODE, "left").join(parents(nodes), ["c", "d"], "left")
    below = found.join(F.broadcast(root)).select(
        F.col("c").alias("conv_id"),
        F.col("d").alias("depth"),
        F.coalesce("up", F.when(F.col("d") == 1, F.col("root")).otherwise(F.col("c"))).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        (F.col("own_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("own_saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
    )
    zero = F.lit(0).cast("long")
    empty = convs.where("n = 0").select(*(zero.alias(x) for x in NODE), "c")
    all_nodes = nodes.agg(
        F.coalesce(F.sum((F.col("d") == 1).cast("long")), zero).alias("n_children"),
        F.greatest(F.coalesce(F.sum("leaves"), zero), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved"), zero).alias("saved_tokens"),
    )
    members = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    top = members.join(all_nodes).join(digests_of_ends(empty).select("ends"), how="left").select(
        "conv_id",
        zero.alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
    )
    return below.unionByName(top)
