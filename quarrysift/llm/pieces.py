"""Splits texts into the pieces that a byte-level BPE vocabulary encodes one by one.

The split is that of the vocabulary's pattern: contractions, runs of letters, of digits
and of other signs, each with one space before it, and white space. It is computed
for a whole batch of texts at once from the class of each character, and equal pieces
are encoded once.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from itertools import repeat

import numpy as np
import pyarrow as pa

from .common import gather_ranges

SIGN, LETTER, DIGIT, SPACE, NONE = range(5)

# The code points with the Unicode property White_Space.
WHITE_SPACE = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003,
    0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]

# Distinct pieces kept per worker before the memory of them starts anew.
MEMO_PIECES = 600_000

_classes: np.ndarray | None = None


def character_classes() -> np.ndarray:
    """The class of every code point, built once per process."""
    global _classes
    if _classes is None:
        first = {"L": LETTER, "N": DIGIT}
        found = np.fromiter(
            (first.get(unicodedata.category(chr(c))[0], SIGN) for c in range(sys.maxunicode + 1)),
            np.uint8,
            sys.maxunicode + 1,
        )
        found[WHITE_SPACE] = SPACE
        _classes = found
    return _classes


def piece_starts(points: np.ndarray, segments: np.ndarray) -> np.ndarray:
    """Where pieces begin in code points; ``segments`` holds each text's first index.

    No piece crosses a segment. Segments are not empty.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = character_classes()[points]
    first = np.zeros(n + 1, bool)
    first[segments] = True
    first[n] = True
    before = np.empty(n, np.uint8)
    before[1:] = kind[:-1]
    before[first[:-1]] = NONE
    after = np.empty(n, np.uint8)
    after[:-1] = kind[1:]
    after[first[1:]] = NONE
    blank_before = np.zeros(n, bool)
    blank_before[1:] = points[:-1] == 0x20
    blank_before[first[:-1]] = False

    # A run of white space gives its last character to what follows.
    in_space = kind == SPACE
    start = np.where(
        in_space,
        (before != SPACE) | (after < SPACE),
        (before != kind) & ~blank_before,
    )
    quotes = np.flatnonzero((points == 0x27) & start)
    if len(quotes):
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        edge = np.concatenate([first, np.ones(3, bool)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        inside_one = ~edge[quotes + 1]
        inside_two = inside_one & ~edge[quotes + 2]
        short = inside_one & np.isin(one, [ord(c) for c in "stmd"])
        pair = one.astype(np.int64) << 32 | two
        long = inside_two & np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])
        start[quotes[short | long] + 1] = False
        start[quotes[long] + 2] = False
        ends = np.concatenate([quotes[short] + 2, quotes[long] + 3])
        start[ends[ends < n]] = True
    return np.flatnonzero(start)


def piece_hashes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece: the sum of mixed (character, place) values."""
    lengths = np.diff(np.append(starts, len(points)))
    place = np.arange(len(points)) - np.repeat(starts, lengths)
    mixed = points.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(21)) + np.uint64(1)
    for factor, shift in ((0x9E3779B97F4A7C15, 29), (0xBF58476D1CE4E5B9, 32)):
        mixed *= np.uint64(factor)
        mixed ^= mixed >> np.uint64(shift)
    return np.add.reduceat(mixed, starts)


class Encoder:
    """Encodes batches of texts, given a function that encodes distinct pieces.

    ``encode_pieces`` takes a list of strings, none with an added token, and returns
    their ids one after the other and the number of ids of each.
    """

    def __init__(self, added: dict[str, int], encode_pieces) -> None:
        self.added = added
        self.encode_pieces = encode_pieces
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        self.forget()

    def forget(self) -> None:
        self.rows: dict[int, int] = {}
        self.ids = np.zeros(0, np.int64)
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each; null is empty."""
        parts: list[str] = []
        owner: list[int] = []
        marks: list[tuple[int, int]] = []
        for k, text in enumerate(texts):
            if not text:
                continue
            if any(token in text for token in self.added):
                for part in self.cut.split(text):
                    if part in self.added:
                        marks.append((len(parts), self.added[part]))
                        parts.append("\x00")
                        owner.append(k)
                    elif part:
                        parts.append(part)
                        owner.append(k)
            else:
                parts.append(text)
                owner.append(k)
        if not parts:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        joined = "".join(parts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        segments = np.cumsum(sizes) - sizes
        starts = piece_starts(points, segments)
        rows = self._rows(joined, points, starts)
        length = self.length[rows]
        begin = self.begin[rows]
        ids = None
        if marks:
            where = np.searchsorted(starts, segments[[m for m, _ in marks]])
            length = length.copy()
            length[where] = 1
            at = np.cumsum(length) - length
            ids = self.ids[gather_ranges(begin, length)]
            ids[at[where]] = [i for _, i in marks]
        else:
            ids = self.ids[gather_ranges(begin, length)]
        part_of = np.repeat(np.arange(len(parts)), np.diff(np.append(np.searchsorted(starts, segments), len(starts))))
        counts = np.bincount(np.asarray(owner)[part_of], weights=length, minlength=len(texts))
        return ids, counts.astype(np.int64)

    def _rows(self, joined: str, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        coded = pa.array(piece_hashes(points, starts)).dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False)
        if len(self.rows) > MEMO_PIECES:
            self.forget()
        keys = coded.dictionary.to_numpy().tolist()
        rows = np.fromiter(map(self.rows.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(rows < 0)
        if len(new):
            seen_at = np.empty(len(keys), np.int64)
            seen_at[place[::-1]] = np.arange(len(place) - 1, -1, -1)
            ends = np.append(starts[1:], len(points))
            at = seen_at[new]
            words = [joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            ids, counts = self.encode_pieces(words)
            known = len(self.length)
            self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(counts) - counts])
            self.length = np.concatenate([self.length, counts])
            self.ids = np.concatenate([self.ids, ids])
            rows[new] = np.arange(known, known + len(new))
            self.rows.update(zip(map(keys.__getitem__, new.tolist()), range(known, known + len(new))))
        return rows[place]


def added_tokens(path: str) -> dict[str, int]:
    """Contents and ids of a tokenizer file's added tokens."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens", [])
    for token in tokens:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token {token['content']!r} uses an option that is not supported")
    return {token["content"]: token["id"] for token in tokens}


def largest_id(path: str) -> int:
    """The largest id of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    return max([*model["vocab"].values(), *added_tokens(path).values()])
