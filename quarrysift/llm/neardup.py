"""Near-duplicate documents by MinHash, banding, and exact confirmation.

A document is the set of its word shingles, held as 64-bit hashes. Documents with equal
sets form a class, of which one goes on. Many universal hash functions each give the
minimum over the set; bands of several minima bring similar documents together. Work then goes in two
rounds, neither of which lists all pairs of a group:

1. Each bucket's smallest document is paired with the others. Pairs whose signatures agree often
   enough are confirmed on the full sets, and links grow into components.
2. In buckets whose documents are still in several components, every pair across
   components is compared on the full sets, in cells of bounded size, until nothing more joins.

So every pair that shares a bucket is either confirmed, refuted or already connected.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, prepare, stored
from .components import connected

ROWS_PER_BAND = 4
# The chance that a pair at the threshold shares no bucket.
MISS = 1e-7
# Signatures must agree to within so many standard deviations below the threshold.
DEVIATIONS = 6.0
# Shingle hashes that one task compares at a time in the second round.
CELL_SHINGLES = 1 << 18
MEMO_WORDS = 400_000


def bands_for(similarity: float) -> int:
    """So many bands that a pair at the threshold is missed with probability ``MISS``."""
    return math.ceil(math.log(MISS) / math.log(1 - similarity**ROWS_PER_BAND))


class Shingler:
    """Sets of hashed word shingles; words are bytes between ASCII white space, A-Z lowered."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.memo: dict[bytes, int] = {}
        rng = np.random.default_rng(5)
        self.factors = rng.integers(1 << 62, 1 << 63, width, dtype=np.uint64) | np.uint64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        found = list(map(memo.get, words))
        if None in found:
            for k, value in enumerate(found):
                if value is None:
                    word = words[k]
                    found[k] = memo[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.array(found, np.uint64)
        width = min(self.width, len(hashes))
        count = len(hashes) - width + 1
        total = np.full(count, width, np.uint64)
        for k in range(width):
            mixed = (total ^ hashes[k : k + count]) * self.factors[k]
            total = mixed ^ (mixed >> np.uint64(31))
        total *= np.uint64(0x9E3779B97F4A7C15)
        return np.unique(total ^ (total >> np.uint64(32)))


class Signer:
    """Minima of many multiply-add hash functions, of which the upper halves are kept."""

    def __init__(self, count: int) -> None:
        rng = np.random.default_rng(13)
        self.a = (rng.integers(0, 1 << 63, count, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.b = rng.integers(0, 1 << 63, count, dtype=np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        # A block of shingles by all functions stays in the cache.
        for k in range(0, len(shingles), 512):
            part = shingles[k : k + 512]
            np.minimum(least, (part[None] * self.a[:, None] + self.b[:, None]).min(axis=1), out=least)
        return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame, width: int, count: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id (k), the set's size (n), its class (c1, c2) and signature (s; none if empty)."""
    source = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(width), Signer(count)
        for batch in batches:
            sizes, first, second, signs = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingler(text)
                digest = hashlib.md5(found).digest()
                sizes.append(len(found))
                first.append(int.from_bytes(digest[:8], "little", signed=True))
                second.append(int.from_bytes(digest[8:], "little", signed=True))
                signs.append(signer(found) if len(found) else None)
            columns = [pa.array(c, pa.int64()) for c in (sizes, first, second)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(signs, pa.list_(pa.int32()))], names=["k", "n", "c1", "c2", "s"]
            )

    fields = [T.StructField(n, T.LongType()) for n in ("n", "c1", "c2")]
    schema = T.StructType([source.schema["k"], *fields, T.StructField("s", T.ArrayType(T.IntegerType()))])
    return source.mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """Per row of (k, x): the id and its shingles, eight bytes each, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            sets = [shingler(text).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["k", "z"])

    schema = T.StructType([docs.schema["k"], T.StructField("z", T.BinaryType())])
    return docs.select("k", "x").mapInArrow(run, schema)


def confirm(pairs: DataFrame, percent: int) -> DataFrame:
    """Keep the pairs (a, b) whose sets (za, zb) are similar enough, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(left.as_buffer(), np.uint64)
                y = np.frombuffer(right.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(kept))

    source = pairs.select("a", "b", "za", "zb")
    return source.mapInArrow(run, T.StructType([source.schema["a"], source.schema["b"]]))


def join_cell(nodes: list, parts: list, sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Links between different components of one cell, as few as connect what is connected.

    Every node outside the largest component is compared with all nodes at once, by
    marking its shingles and counting the marks in each set.
    """
    names = {p: i for i, p in enumerate(dict.fromkeys(parts))}
    part = np.array([names[p] for p in parts])
    if len(names) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    marks = np.zeros(len(values), bool)
    links = []
    largest = np.bincount(part).argmax()
    for i in np.flatnonzero(part != largest):
        if (part == part[i]).all():
            break
        own = place[starts[i] : starts[i] + sizes[i]]
        marks[own] = True
        both = np.add.reduceat(marks[place], starts, dtype=np.int64)
        marks[own] = False
        similar = (100 * both >= percent * (sizes[i] + sizes - both)) & (part != part[i])
        for j in np.flatnonzero(similar):
            if part[j] != part[i]:
                links.append((nodes[i], nodes[j]))
                part[part == part[j]] = part[i]
    return links


def link_cells(rows: DataFrame, percent: int) -> DataFrame:
    """Links found within cells: rows of (cell, k, p, z) that come cell by cell."""
    source = rows.select("cell", "k", "p", "z")
    kind = source.schema["k"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}

        def finish() -> pa.RecordBatch:
            keys = list(held)
            found = join_cell([k for k, _ in keys], [p for p, _ in held.values()], [z for _, z in held.values()], percent)
            ends = [[dict(x[c]) if isinstance(x[c], tuple) else x[c] for x in found] for c in (0, 1)]
            columns = [pa.array(e, t) for e, t in zip(ends, types)]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            types = [batch.schema.field(1).type] * 2
            for name, k, p, z in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if isinstance(k, dict):
                    # Ids of several fields: dictionaries cannot be keys.
                    k, p = tuple(k.items()), tuple(p.items())
                if name != cell:
                    if len(held) > 1:
                        yield finish()
                    cell, held = name, {}
                if z:
                    # A row that comes twice counts once.
                    held[(k, z if len(z) < 64 else hashlib.md5(z).digest())] = (p, np.frombuffer(z, np.uint64))
        if len(held) > 1:
            yield finish()

    return source.mapInArrow(run, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))


def deduplicate(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: the id, n_shingles, component_id and kept.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of
    shingles of ``width`` words; one with fewer words has its whole sequence as its one shingle.
    ``component_id`` is the smallest id reachable, ``kept`` whether that is the row's own.
    Null texts and texts without words have no shingles and no links. A row with a null id
    is linked with nothing and not kept; its component is null. Rows that share an id are
    one document with several texts. Repeated rows are kept as they are. Other columns are not read.
    An id may be a flat struct; it counts as null only if it is null as a whole.
    """
    prepare(docs.sparkSession)
    bands = bands_for(percent / 100)
    count = bands * ROWS_PER_BAND
    rows = stored(signatures(docs, width, count, id_col, text_col), "signatures")
    usable = rows.where("n > 0 AND k IS NOT NULL")

    # Equal sets: counted before they move, so a class of any size is one row per task.
    classes = usable.groupBy("c1", "c2").agg(F.min("k").alias("r"), F.min_by("s", "k").alias("s"))
    classes = stored(classes, "classes")
    member = rows.select("k", "n", "c1", "c2").join(classes.select("c1", "c2", "r"), ["c1", "c2"], "left")
    member = member.select("k", "n", F.when(F.col("n") > 0, F.col("r")).otherwise(F.col("k")).alias("r"))

    # Buckets with at least two classes, each with its smallest member.
    band = F.posexplode(
        F.transform(
            F.sequence(F.lit(0), F.lit(bands - 1)),
            lambda i: F.xxhash64(i, F.slice("s", i * ROWS_PER_BAND + 1, ROWS_PER_BAND)),
        )
    ).alias("band", "bucket")
    placed = classes.select(F.col("r").alias("k"), band).select("k", "bucket")
    buckets = placed.groupBy("bucket").agg(F.min("k").alias("lead"), F.count("*").alias("size")).where("size > 1")
    placed = stored(placed.join(buckets, "bucket"), "buckets")

    # Round one: each bucket's smallest member with the others.
    pairs = placed.where("k <> lead").select(F.col("lead").alias("a"), F.col("k").alias("b")).distinct()
    sign = classes.select(F.col("r").alias("k"), "s")
    pairs = pairs.join(sign.select(F.col("k").alias("a"), F.col("s").alias("sa")), "a")
    pairs = pairs.join(sign.select(F.col("k").alias("b"), F.col("s").alias("sb")), "b")
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)
    j = percent / 100
    least = count * (j - DEVIATIONS * math.sqrt(j * (1 - j) / count))
    pairs = stored(pairs.where(agree >= least).select("a", "b"), "pairs")

    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("x"))
    wanted = placed.select("k").distinct()
    sets = stored(shingle_sets(texts.join(wanted, "k", "left_semi"), width), "sets")
    both = pairs.join(sets.select(F.col("k").alias("a"), F.col("z").alias("za")), "a")
    both = both.join(sets.select(F.col("k").alias("b"), F.col("z").alias("zb")), "b")
    # Texts that share an id: their classes are one document, each tied to the smallest.
    shared = member.where("k IS NOT NULL").groupBy("k").agg(F.min("r").alias("a"), F.max("r").alias("b"))
    shared = shared.where("a <> b").select("k", "a").join(member.select("k", F.col("r").alias("b")), "k")
    shared = shared.where("a <> b").select("a", "b").distinct()
    links = stored(confirm(both, percent).union(shared), "confirmed")
    parts = stored(connected(links), "components")

    # Round two: larger buckets that are still in several parts.
    open_rows = placed.where("size > 2").join(parts, F.col("k") == F.col("node"), "left")
    open_rows = open_rows.select("bucket", "k", F.coalesce("component", "k").alias("p"))
    bytes_of = sets.groupBy("k").agg(F.sum(F.octet_length("z") / 8).cast("long").alias("m"))
    open_rows = stored(open_rows.join(bytes_of, "k"), "open")
    split = open_rows.groupBy("bucket").agg(
        F.min("p").alias("p0"), F.max("p").alias("p1"), F.ceil(2 * F.sum("m") / CELL_SHINGLES).alias("pieces")
    )
    split = split.where("p0 <> p1").select("bucket", "pieces")
    inside = open_rows.join(split, "bucket")
    piece = F.pmod(F.xxhash64("k", F.lit(3)), F.col("pieces"))
    # A bucket of several pieces is compared piece by piece: a cell holds two of them.
    cells = inside.select(
        "k",
        "p",
        "bucket",
        "pieces",
        piece.alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("o"),
    ).where("i <> o OR pieces = 1")
    cells = cells.select(F.xxhash64("bucket", F.least("i", "o"), F.greatest("i", "o")).alias("cell"), "k", "p")
    cells = cells.distinct().join(sets, "k")
    cells = cells.repartition("cell").sortWithinPartitions("cell")
    more = stored(link_cells(cells, percent), "confirmed-across")
    spanning = parts.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    whole = stored(connected(spanning.union(more)), "components")

    # The smallest id of a component: classes go by their smallest id already.
    found = member.join(whole, F.col("r") == F.col("node"), "left")
    component = F.when(F.col("k").isNotNull(), F.coalesce("component", "r"))
    result = found.select("k", "n", component.alias("m"))
    result = result.select(
        F.col("k").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("m").alias("component_id"),
        F.coalesce(F.col("k") == F.col("m"), F.lit(False)).alias("kept"),
    )
    for frame in (placed, pairs, sets, links, parts, open_rows, more):
        forget(frame)
    return result
