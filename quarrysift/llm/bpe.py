"""Byte-pair encoding and decoding by speculation: propose, verify, repair.

A piece of text is first cut greedily into the longest tokens. In byte-pair encoding a
sequence of reachable tokens is the encoding of its text if and only if each adjacent
pair is the encoding of the pair's own text, so all pairs of a batch are tested at
once, and only pieces with a failing pair go through the merges one by one.

A pair (left, right) holds if no merge ever joins the two sides. While the merges
run, the token that touches the border from the left walks up the right edge of left's merge
tree, and from the right up the left edge of right's. Some merge joins them exactly if
two tokens that touch the border at the same time have a merge of their own that comes first.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import batch_of, crop, gather_ranges, prepare
from .pieces import Encoder, added_tokens

NEVER = 1 << 40
# Pieces of up to this many bytes are worked on together; longer ones singly.
SHORT_PIECE = 48
# Characters encoded at a time within a batch.
CHARS_PER_STEP = 1 << 21


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file.

    Printable bytes stand for themselves; the others are numbered from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in printable}
    rest = [b for b in range(256) if b not in set(printable)]
    letters.update({chr(256 + k): b for k, b in enumerate(rest)})
    return letters


class Lookup:
    """Many lookups at once of non-negative integers in a fixed table; -1 where missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(len(keys) * 2.5).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int64)
        slot, todo = self._home(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            self.keys[slot[free]] = keys[free]
            self.values[slot[free]] = values[free]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._home(keys)
        seen = self.keys[slot]
        found = np.where(seen == keys, self.values[slot], -1)
        todo = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            seen = self.keys[slot[todo]]
            hit = seen == keys[todo]
            found[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (seen >= 0)]
        return found


class Vocabulary:
    """A byte-level BPE vocabulary with its merges as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        names: dict[str, int] = model["vocab"]
        self.added = added_tokens(path)
        self.size = max([*names.values(), *self.added.values()]) + 1
        self.texts = [b""] * self.size
        for name, k in names.items():
            self.texts[k] = bytes(map(letters.__getitem__, name))
        for content, k in self.added.items():
            self.texts[k] = content.encode()

        # Of each token: the merge that makes it and that merge's two sides.
        self.rank = np.full(self.size, -1, np.int64)
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.empty(len(merges), np.int64)
        made = np.empty(len(merges), np.int64)
        for k, (a, b) in enumerate(merges):
            i, j, t = names[a], names[b], names[a + b]
            keys[k], made[k] = i * self.size + j, t
            if self.rank[t] < 0:
                self.rank[t], self.left[t], self.right[t] = k, i, j
        self.rank_of = Lookup(keys, np.arange(len(merges)))
        self.made = made
        self.merge_of = dict(zip(keys.tolist(), zip(range(len(merges)), made.tolist())))

        self.byte_token = [-1] * 256
        for k in names.values():
            if len(self.texts[k]) == 1:
                self.byte_token[self.texts[k][0]] = k
        self._find_reachable(names.values())

    def _find_reachable(self, tokens) -> None:
        """Keep for proposals the tokens that merging their own text gives back."""
        merged = np.flatnonzero(self.rank >= 0)
        holds = np.ones(self.size, bool)
        holds[merged] = self.pairs_hold(self.left[merged], self.right[merged], self.rank[merged])
        for t in merged[np.argsort(self.rank[merged])]:
            holds[t] &= holds[self.left[t]] and holds[self.right[t]]
        self.ids = {self.texts[k]: k for k in tokens if holds[k]}
        # A trie over the proposable tokens: (node, byte) to node, and each node's token.
        edges: dict[int, int] = {}
        token_at = [-1]
        for text, token in self.ids.items():
            node = 0
            for byte in text:
                node = edges.setdefault(node << 8 | byte, len(token_at))
                if node == len(token_at):
                    token_at.append(-1)
            token_at[node] = token
        self.child = Lookup(
            np.fromiter(edges.keys(), np.int64, len(edges)), np.fromiter(edges.values(), np.int64, len(edges))
        )
        self.edges, self.token_at = edges, np.asarray(token_at)

    def pairs_hold(self, left: np.ndarray, right: np.ndarray, until: np.ndarray | int = NEVER) -> np.ndarray:
        """Whether no merge before ``until`` joins the two sides, for many pairs at once."""
        holds = np.ones(len(left), bool)
        live = np.arange(len(left))
        a, b = np.asarray(left), np.asarray(right)
        a_end = np.broadcast_to(np.asarray(until, np.int64), len(live)).copy()
        b_end = a_end - 1  # at the first step both sides last until the cutoff
        while len(live):
            rank = self.rank_of(a * self.size + b)
            rank[rank < 0] = NEVER
            # A merge of equal rank to the left of this one comes first, to the right later.
            fails = (rank < a_end) & (rank <= b_end)
            holds[live[fails]] = False
            a_rank, b_rank = self.rank[a], self.rank[b]
            go = ~fails & ((a_rank >= 0) | (b_rank >= 0))
            live, a, b, a_end, b_end = live[go], a[go], b[go], a_end[go], b_end[go]
            a_rank, b_rank = a_rank[go], b_rank[go]
            down_left = a_rank > b_rank
            a_end = np.where(down_left, a_rank, a_end)
            b_end = np.where(down_left, b_end, b_rank)
            a, b = np.where(down_left, self.right[a], a), np.where(down_left, b, self.left[b])
        return holds

    def propose(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest tokens from left to right in each of many byte ranges: ids and counts."""
        live, at = np.arange(len(begin)), begin.copy()
        words, found = [], []
        while len(live):
            stop, node, step = end[live], np.zeros(len(live), np.int64), at.copy()
            best, best_end = np.full(len(live), -1), at.copy()
            walk = np.arange(len(live))
            while len(walk):
                node = self.child(node << 8 | text[step[walk]])
                ok = node >= 0
                walk, node = walk[ok], node[ok]
                step[walk] += 1
                token = self.token_at[node]
                whole = token >= 0
                best[walk[whole]] = token[whole]
                best_end[walk[whole]] = step[walk[whole]]
                ok = step[walk] < stop[walk]
                walk, node = walk[ok], node[ok]
            words.append(live)
            found.append(best)
            go = best_end < stop
            live, at = live[go], best_end[go]
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.argsort(np.concatenate(words), kind="stable")
        counts = np.bincount(np.concatenate(words), minlength=len(begin))
        return np.concatenate(found)[order], counts

    def propose_one(self, word: bytes) -> list[int]:
        found, i, n = [], 0, len(word)
        while i < n:
            node, j, best, best_end = 0, i, -1, i
            while j < n:
                node = self.edges.get(node << 8 | word[j], -1)
                if node < 0:
                    break
                j += 1
                if self.token_at[node] >= 0:
                    best, best_end = int(self.token_at[node]), j
            found.append(best)
            i = best_end
        return found

    def merge(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run the merges in each of many byte ranges, in every round the next of each range."""
        counts = end - begin
        word = np.repeat(np.arange(len(begin)), counts)
        token = np.asarray(self.byte_token)[text[gather_ranges(begin, counts)]]
        done_word, done_token = [], []
        while len(word):
            rank = np.full(len(word), NEVER)
            inner = np.flatnonzero(word[1:] == word[:-1])
            got = self.rank_of(token[inner] * self.size + token[inner + 1])
            rank[inner] = np.where(got < 0, NEVER, got)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            idle = least == NEVER
            done_word.append(word[idle])
            done_token.append(token[idle])
            # The leftmost pair of the least rank in each word; pairs of equal tokens may overlap.
            hit = np.flatnonzero((rank == least) & ~idle)
            hit = hit[np.append(True, word[hit[1:]] != word[hit[:-1]])] if len(hit) else hit
            token[hit] = self.made[rank[hit]]
            keep = ~idle
            keep[hit + 1] = False
            word, token = word[keep], token[keep]
        if not done_word:
            return np.zeros(0, np.int64), np.zeros(len(begin), np.int64)
        word, token = np.concatenate(done_word), np.concatenate(done_token)
        return token[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(begin))

    def merge_one(self, word: bytes) -> list[int]:
        """The merges of one long piece, lowest rank first and leftmost among equals."""
        tokens = [self.byte_token[b] for b in word]
        merge_of, size = self.merge_of, self.size
        following = [*range(1, len(tokens)), -1]
        previous = [*range(-1, len(tokens) - 1)]
        queue = []
        for i in range(len(tokens) - 1):
            m = merge_of.get(tokens[i] * size + tokens[i + 1])
            if m is not None:
                queue.append((m[0], i, tokens[i], tokens[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = following[i]
            if tokens[i] != a or j < 0 or tokens[j] != b:
                continue
            tokens[i], tokens[j] = made, -1
            following[i] = k = following[j]
            if k >= 0:
                previous[k] = i
            for x, y in ((previous[i], i), (i, k)):
                if x >= 0 and y >= 0:
                    m = merge_of.get(tokens[x] * size + tokens[y])
                    if m is not None:
                        heapq.heappush(queue, (m[0], x, tokens[x], tokens[y], m[1]))
        return [t for t in tokens if t >= 0]

    def encode_pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Propose for every piece, verify all adjacent pairs, repair the failing pieces."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ids, counts = np.zeros(0, np.int64), np.zeros(len(raw), np.int64)
        short = np.flatnonzero(sizes <= SHORT_PIECE)
        text = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        end = np.cumsum(sizes)
        begin = end - sizes
        ids, counts[short] = self.propose(text, begin[short], end[short])
        word = np.repeat(short, counts[short])
        single = {}
        for k in np.flatnonzero(sizes > SHORT_PIECE).tolist():
            single[k] = self.propose_one(raw[k])
        ids, word, counts = self._with(ids, word, counts, single)

        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(ids[inner] * self.size + ids[inner + 1], return_inverse=True)
        holds = self.pairs_hold(pairs // self.size, pairs % self.size)[back]
        failing = np.unique(word[inner[~holds]])
        if not len(failing):
            return ids, counts

        bad = np.zeros(len(raw), bool)
        bad[failing] = True
        ids, word = ids[~bad[word]], word[~bad[word]]
        short = failing[sizes[failing] <= SHORT_PIECE]
        repaired, counts[short] = self.merge(text, begin[short], end[short])
        ids = np.concatenate([ids, repaired])
        word = np.concatenate([word, np.repeat(short, counts[short])])
        single = {k: self.merge_one(raw[k]) for k in failing[sizes[failing] > SHORT_PIECE].tolist()}
        ids, word, counts = self._with(ids, word, counts, single)
        return ids, counts

    @staticmethod
    def _with(ids, word, counts, single: dict[int, list[int]]):
        """Add single pieces' ids and put all into the order of the pieces."""
        for k, found in single.items():
            counts[k] = len(found)
        extra = [t for found in single.values() for t in found]
        ids = np.concatenate([ids, np.asarray(extra, np.int64)])
        word = np.concatenate([word, np.repeat(np.asarray(list(single), np.int64), [len(f) for f in single.values()])])
        order = np.argsort(word, kind="stable")
        return ids[order], word[order], counts


class Decoder:
    """Turns ids back into bytes by gathering the tokens' bytes."""

    def __init__(self, texts: list[bytes]) -> None:
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.length = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begin = np.cumsum(self.length) - self.length

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes one after the other, and the number of bytes of each id."""
        length = self.length[ids]
        return self.bytes[gather_ranges(self.begin[ids], length)], length


@functools.lru_cache(maxsize=2)
def speculative(path: str) -> tuple[Vocabulary, Encoder, Decoder]:
    """One encoder per process and vocabulary file."""
    vocabulary = Vocabulary(path)
    return vocabulary, Encoder(vocabulary.added, vocabulary.encode_pieces), Decoder(vocabulary.texts)


def readable(raw: bytes) -> bytes:
    """UTF-8 of the text that the bytes stand for; broken sequences become U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: the id, n_tokens and tokens (array of int).

    A null or empty text has no tokens. Rows are kept as they are, repeated ones and
    those with a null id included; columns other than the two named are not read.
    Added tokens in a text become their own ids.
    """
    prepare(docs.sparkSession)
    source = docs.select(id_col, text_col)
    out = pa.schema([("n", pa.int64()), ("t", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder, _ = speculative(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in crop(texts, CHARS_PER_STEP):
                ids, counts = encoder.encode(texts[lo:hi])
                offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(counts), tokens],
                    names=[id_col, *out.names],
                )

    schema = T.StructType(
        [
            source.schema[id_col],
            T.StructField("n", T.LongType()),
            T.StructField("t", T.ArrayType(T.IntegerType())),
        ]
    )
    return source.mapInArrow(run, schema).withColumnsRenamed({"n": "n_tokens", "t": "tokens"})


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Texts of the token ids that :func:`encode` gives; null tokens decode to an empty text."""
    prepare(tokens.sparkSession)
    source = tokens.select(id_col, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, decoder = speculative(path)
        for batch in batches:
            texts = []
            for ids in batch.column(1):
                flat = ids.values.to_numpy() if ids.is_valid and len(ids) else np.zeros(0, np.int64)
                texts.append(readable(decoder.decode(flat)[0].tobytes()).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "x"])

    schema = T.StructType([source.schema[id_col], T.StructField("x", T.StringType())])
    return source.mapInArrow(run, schema).withColumnRenamed("x", "text")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text in one pass and return digests of both.

    Per row: the id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit
    integers) and decoded_sha256 (of the decoded text in UTF-8). Null counts as
    empty. No shuffle; memory is bounded by a batch and the pieces remembered.
    """
    prepare(docs.sparkSession)
    source = docs.select(id_col, text_col)
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    types = [pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder, decoder = speculative(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            schema = pa.schema([batch.schema.field(0), *zip(names, types)])
            for lo, hi in crop(texts, CHARS_PER_STEP):
                ids, counts = encoder.encode(texts[lo:hi])
                ends = np.append(0, np.cumsum(counts))
                raw, sizes = decoder.decode(ids)
                byte_ends = np.append(0, np.cumsum(sizes))[ends]
                packed, raw = ids.astype("<u4"), raw.tobytes()
                coded = [hashlib.sha256(packed[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]
                plain = [
                    hashlib.sha256(readable(raw[a:b])).hexdigest() for a, b in zip(byte_ends, byte_ends[1:])
                ]
                yield batch_of(schema, [batch.column(0).slice(lo, hi - lo), counts, coded, plain])

    schema = T.StructType(
        [
            source.schema[id_col],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return source.mapInArrow(run, schema)
