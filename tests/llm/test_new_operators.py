"""License scans, the prefix trie and vector codes against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrysift.llm import licenses, prefixtrie, veccodes

# License scans


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_licenses(text, templates, gram=3, cover=60, near=8):
    own, base, labels, score = words(text), [], set(), 0.0
    for label, other, exact in templates:
        w = words(other)
        if not w:
            continue
        n, m = len(w), min(gram, len(w))
        votes = collections.defaultdict(set)
        for p in range(len(own) - m + 1):
            for q in range(n - m + 1):
                if own[p : p + m] == w[q : q + m]:
                    votes[p - q].add(q)
        if exact:
            for d, qs in votes.items():
                if len(qs) == n - m + 1:
                    base.append((d, label))
                    labels.add(label)
                    score = 1.0
            continue
        group = []
        for d in [*sorted(votes), None]:
            if group and (d is None or d - group[-1] > min(near, n // 4)):
                covered = {q + j for x in group for q in votes[x] for j in range(m)}
                if len(covered) * 100 >= n * cover:
                    labels.add(label)
                    score = max(score, len(covered) / n)
                group = []
            group.append(d)
    starts = [d for d, _ in base]
    return (
        len(own),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({x for _, x in base})),
        ",".join(sorted(labels)),
        score,
    )


ODD_TEXTS = [
    None,
    "",
    "...",
    "CC BY",
    "cc by cc by cc-by",
    "All rights reserved. General Public License, ALL RIGHTS RESERVED",
    "all rights all rights reserved reserved",
    "Licensed under the MIT License. " * 3,
    "x " * 5000 + "This work is licensed under the GNU General Public License, version 3.",
    licenses.TEMPLATES[4][1].replace("without restriction", "with no other restriction at all").upper(),
    "é " + licenses.TEMPLATES[1][1] + " ünd mehr " + licenses.TEMPLATES[1][1],
    " ".join(licenses.TEMPLATES[4][1].split()[:30]),
]


def test_licenses_of_odd_texts(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD_TEXTS)] + [(3, ODD_TEXTS[5], "y"), (3, ODD_TEXTS[3], "y"), (None, "cc by", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = licenses.scan_licenses(docs).collect()
    templates = [(a, b, False) for a, b in licenses.TEMPLATES] + [(a, b, True) for a, b in licenses.PHRASES]
    key = lambda rows: sorted(map(repr, rows))
    assert key(map(tuple, got)) == key((i, *brute_licenses(t, templates)) for i, t, _ in rows)


def test_licenses_of_random_words(spark, monkeypatch):
    monkeypatch.setattr(licenses, "GRAMS_PER_BLOCK", 7)
    random.seed(4)
    text = lambda n: " ".join(random.choice("abc") for _ in range(n))
    templates = [(f"t{i}", text(random.choice([1, 2, 5, 12])), i % 2 == 0) for i in range(12)] + [("none", "", True)]
    docs = [(i, text(random.choice([0, 1, 3, 30]))) for i in range(40)]
    table = spark.createDataFrame([(n, *t) for n, t in enumerate(templates)], "tid int, label string, text string, exact boolean")
    got = licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), table)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((i, *brute_licenses(t, templates)) for i, t in docs), key=str)


def test_licenses_spans_and_nothing(spark):
    docs = spark.createDataFrame([(1, "so: released under the mit license and more")], "doc_id long, text string")
    _, spans = licenses.license_spans(docs)
    found = {(r["label"], r["start"], r["end"]) for r in spans.collect()}
    assert ("mit", 1, 6) in found
    assert licenses.scan_licenses(docs.limit(0)).collect() == []
    none = licenses.template_table(spark, licenses.TEMPLATES, licenses.PHRASES).limit(0)
    assert [r["labels"] for r in licenses.scan_licenses(docs, none).collect()] == [""]


def test_licenses_run_without_python(spark):
    frame = licenses.scan_licenses(spark.createDataFrame([(1, "cc by")], "doc_id long, text string"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Pandas" not in plan


# The prefix trie


def brute_trie(rows, parts=5, heads=9):
    """Nodes of the trie as the operator's rows; rows are (conv_id, turn, role, text)."""
    turns = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            content = (r or "", x or "")
            digest = hashlib.sha256(f"{len(content[0].encode())}:{content[0]}{content[1]}".encode()).digest()
            turns[c].append(((t is not None, t or 0), digest, content))
    turns = {c: [x[2] for x in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % heads
        rebuilt[c] = turns.get(c - c % parts, [])[:h] + own[h:]
    members = collections.defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaf = lambda n: not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)
        ends = ",".join(str(c) for c in sorted(own) if len(rebuilt[c]) == len(node))
        out.append(
            (
                min(own),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(own),
                sum(1 for n in members if len(n) == len(node) + 1 and n[: len(node)] == node),
                sum(1 for n in below if leaf(n)),
                sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(map(repr, out))


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(spark, rows):
    schema = "conv_id long, turn int, role string, text string, c string, part int"
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], schema).repartition(3)
    return prefixtrie.prefix_trie(turns, lambda c: c - c % 5, lambda c: F.crc32(c.cast("string")) % 9, 8).select(*COLUMNS)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_random_conversations(spark, monkeypatch, seed):
    monkeypatch.setattr(prefixtrie, "PIECE_BYTES", 4)
    random.seed(seed)
    rows = []
    for c in [*range(24), 31, 33, 102, 1007]:
        for t in range(random.choice([1, 2, 4, 11])):
            rows.append((c, random.choice([None, t, t]), random.choice(["user", None]), random.choice(["a", "b", "é", None])))
    rows += [(None, 1, "user", "a"), rows[0], rows[0]]
    assert sorted(map(repr, map(tuple, trie(spark, rows).collect()))) == brute_trie(rows)


def test_trie_of_one_long_conversation(spark):
    """Stretches of it lie in several tasks and are put together, and batches end within it."""
    rows = [(5, t, "user", f"{t % 7} " * (t % 3)) for t in range(900)] + [(6, t, "user", f"{t % 7} " * (t % 3)) for t in range(3)]
    partitions = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        found = trie(spark, rows)
        found = sorted(map(repr, map(tuple, found.collect())))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", partitions)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert found == brute_trie(rows)


def test_trie_turns_to_other_fingerprints(spark, monkeypatch):
    """Multipliers under which all sequences of one depth look alike are found out."""
    real = prefixtrie.multipliers
    monkeypatch.setattr(prefixtrie, "multipliers", lambda seed: [prefixtrie.PRIME - 1] * 3 if seed == 0 else real(seed))
    asked = []
    group = prefixtrie.group_nodes
    monkeypatch.setattr(prefixtrie, "group_nodes", lambda rows: asked.append(group(rows)) or asked[-1])
    rows = [(10, t, "u", x) for t, x in enumerate("abab")] + [(20, t, "u", x) for t, x in enumerate("baba")]
    rows += [(30, t, "u", x) for t, x in enumerate("abba")] + [(40, t, "u", x) for t, x in enumerate("ccaa")]
    rows += [(c, t, "u", x) for c, s in ((50, "acab"), (60, "abac")) for t, x in enumerate(s)]
    rows = [(c, t, r, x * 2) for c, t, r, x in rows]
    assert sorted(map(repr, map(tuple, trie(spark, rows).collect()))) == brute_trie(rows)
    assert [exact for _, exact in asked][-1] and len(asked) > 1


def test_trie_of_nothing_and_of_no_turns_left(spark):
    assert trie(spark, []).collect() == []
    # Their heads are longer than they are and their bases do not exist.
    short = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9][:4]
    rows = [(c, 1, "user", "a") for c in short]
    assert sorted(map(repr, map(tuple, trie(spark, rows).collect()))) == brute_trie(rows)


# Vector codes


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    fine = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    last = (1 << 70,)
    kept = sorted([r for r in rows if fine(r[1]) and len(r[1]) and len(r[1]) % parts == 0], key=lambda r: ((r[0],) if r[0] is not None else last, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    limit = 1 << 30
    whole = [[int(np.floor(max(-limit, min(limit, x * scale)))) for x in v] for _, v, _ in kept]
    if not kept:
        return []
    w = len(whole[0]) // parts
    cut = [[tuple(v[p * w : p * w + w]) for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min(range(len(book)), key=lambda j: (away(x, book[j]), j))
    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for v in cut:
                groups[near(v[p], books[p])].append(v[p])
            books[p] = [tuple(sum(x) // len(groups[j]) for x in zip(*groups[j])) if j in groups else e for j, e in enumerate(books[p])]
    codes = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(away(v[p], books[p][c]) for p, c in enumerate(code)) for v, code in zip(cut, codes)]
    totals = collections.Counter()
    for (_, _, label), e in zip(kept, errors):
        totals[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most = (1 << 63) - 1
    return sorted(
        repr((r[0], "".join(f"{c:02x}" for c in code), min(e, most), min(totals[r[2]], most), digest))
        for r, code, e in zip(kept, codes, errors)
    )


@pytest.mark.parametrize("scale,count", [(1.0, 70), (1e4, 40), (1e9, 30), (0.1, 7)])
def test_vector_codes(spark, scale, count):
    random.seed(count)
    rows = [(i, [scale * random.choice([-1.0, 0.0, 0.25, 0.3, 1.0]) for _ in range(24)], random.choice([1, 2, None])) for i in range(count)]
    rows += [rows[1], rows[1], (None, rows[2][1], 1), (3, rows[4][1], 2)]
    rows += [(90, None, 1), (91, [None] * 24, 1), (92, [float("nan")] * 24, 1), (93, [float("inf")] * 24, 1), (94, [], 1), (95, [0.5] * 16, 1), (96, [0.5] * 3, 1)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, code string").repartition(3)
    got = veccodes.compress(frame)
    assert sorted(map(repr, map(tuple, got.collect()))) == brute_codes(rows)


def test_vector_codes_of_nothing(spark):
    frame = spark.createDataFrame([(1, [0.5])], "vec_id long, embedding array<float>").withColumn("label", F.lit("a"))
    assert veccodes.compress(frame).collect() == []
    assert veccodes.compress(frame.limit(0)).collect() == []


def test_walk_shares_and_carries_its_path():
    rng = np.random.default_rng(3)
    leaves = np.array(sorted(map(tuple, rng.integers(-3, 3, (60, 4)))))
    book = rng.integers(-3, 3, (5, 4))
    plain = ((leaves[:, None, :] - book[None]) ** 2).sum(axis=2)
    whole, _ = veccodes.walk(leaves, book)
    assert (whole == plain).all()
    path, found = None, []
    for a in range(0, 60, 7):
        part, path = veccodes.walk(leaves[a : a + 7], book, path)
        found.append(part)
    assert (np.concatenate(found) == plain).all()
