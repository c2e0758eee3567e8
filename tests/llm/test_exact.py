"""Exact operators against SQL or brute force."""

import collections
import itertools
import random
import re

import duckdb
import numpy as np
import pyarrow.fs as pafs
import pytest

import __spark_entry__ as entry
from quarrysift.llm import chat, decontam, neardup, topk, warc
from quarrysift.llm.components import connected

DATA = "/root/testdata/sf0.001"
TABLES = "documents benchmark pages conversations embeddings labels".split()


@pytest.mark.parametrize("name", ["op1_chat", "op3_topk", "op6_decontam", "op8_warc"])
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    frame = entry.queries()[name](spark, DATA)
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    wanted = [dict(zip(columns, row)) for row in cursor.fetchall()]
    order = sorted(columns)
    key = lambda rows: sorted((str([r[c] for c in order]) for r in rows))
    assert key(r.asDict() for r in frame.collect()) == key(wanted)


# Top-k search


def brute_top(rows, queries, k):
    whole = lambda v: [int(np.floor(64 * x)) for x in v]
    fit = [(i, whole(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in {i: v for i, v in fit if i in queries}.items():
        long = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
        scores = [(-long(sum(a * b for a, b in zip(v, w))), i) for i, w in fit if i != q and len(w) == len(v)]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e12])
def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    random.seed(8)
    rows = [(i, [scale * random.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)]) for i in range(60)]
    rows += [(61, None), (62, [None, 1.0, 1.0]), (63, [float("nan")] * 3), (64, [float("inf")] * 3), (65, []), (66, [1.0])]
    rows += [(None, [1.0] * 3), rows[3]]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = topk.search(frame, frame.where("vec_id % 5 = 0"), 4)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, set(range(0, 100, 5)), 4)


def test_top_k_of_nothing(spark):
    frame = spark.createDataFrame([(1, [0.5])], "vec_id long, embedding array<float>")
    for vectors, queries in ((frame.limit(0), frame), (frame, frame.limit(0)), (frame, frame)):
        assert topk.search(vectors, queries, 3).collect() == []


# Decontamination


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(text, items, size=10):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        w = words(other)
        n = min(size, len(w))
        for i in range(max(1, len(w) - size + 1) if w and item is not None else 0):
            for s in range(len(own) - n + 1):
                if own[s : s + n] == w[i : i + n]:
                    hit |= set(range(s, s + n))
                    found.add(str(item))
    return len(own), len(hit), len(found), ",".join(sorted(found))


def test_contamination_of_odd_texts(spark):
    random.seed(9)
    few = [random.choice(["a", "B", "ça", "d1"]) for _ in range(400)]
    items = [(1, "a b a b a b a b a b a b"), (2, "Short item"), (3, None), (4, "..."), (10, " ".join(few[50:80])), (2, "é"), (None, "a")]
    texts = [None, "", "...", " ".join(few), "x short   ITEM, é!", "short item short item", "a-b-" * 40, "İé É", "z " * 5000 + " ".join(few[60:72])]
    rows = list(enumerate(texts)) + [(3, " ".join(few)), (4, "same id, short item"), (None, "short item")]
    docs = spark.createDataFrame([(k, t, "q") for k, t in rows], "doc_id long, text string, w string")
    bench = spark.createDataFrame([(k, t, "q") for k, t in items], "item_id long, text string, item string")
    got = decontam.contamination(docs, bench).collect()
    wanted = [(k, *brute_hits(t, items)) for k, t in rows]
    from hashlib import sha256

    wanted = [(k, n, h, i, sha256(s.encode()).hexdigest(), h > 0) for k, n, h, i, s in wanted]
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    assert decontam.contamination(docs.limit(0), bench).collect() == []
    clean = decontam.contamination(docs, bench.limit(0)).collect()
    assert len(clean) == len(rows) and not any(r.contaminated for r in clean)


def test_plan_is_native_and_texts_stay(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    plan = decontam.contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)
    index = decontam.build_index(docs, items)
    assert "text" not in index.postings.columns and index.postings.count() > 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "c b a x"), (2, "a " + "x " * 9 + "b c"), (3, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c")], "item_id long, text string")
    found = decontam.proximity_matches(decontam.build_index(docs, items, size=3))
    assert {r.k for r in found.collect()} == {1}


# Archives


def test_archives_of_odd_pages(spark):
    long = "x" * 150
    rows = [(5, "u", long), (3, "v\r\nX-Page: 9", long), (9, None, long), (4, "w", None), (6, "w", ""), (7, "w", "y" * 99), (8, "w", "y" * 99)]
    rows += [(10, "w", "WARC/1.1\r\n\r\n\x1f\u008b\x08" * 50), (3, "v", long), (None, "w", long), (11, "é", "ü" * 60), (12, "é", "ü" * 60)]
    pages = spark.createDataFrame([(k, u, h, "q") for k, u, h in rows], "page_id long, url string, html string, digest string")
    got = sorted(map(tuple, warc.round_trip(pages).collect()), key=str)
    first = {}
    for k, _, h in rows:
        if k is not None and len((h or "").encode()) >= 100:
            first[h] = min(k, first.get(h, k))
    from hashlib import sha256

    wanted = []
    for k, _, h in rows:
        raw = (h or "").encode()
        again = h in first and k != first[h]
        wanted.append((k, len(raw), sha256(raw).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    assert got == sorted(wanted, key=str)
    assert warc.round_trip(pages.limit(0)).collect() == []


@pytest.mark.parametrize("size", [1, 37, 1000, 1 << 20])
def test_every_record_belongs_to_one_range(tmp_path, size):
    random.seed(size)
    datas = []
    for k in range(30):
        # Payloads that hold the magic, and whole gzip members of other kinds.
        payload = random.choice([b"\x1f\x8b\x08" * 20, warc.packed(b"not a record"), bytes(random.choices(range(256), k=300))])
        datas.append(warc.record(str(k), None, payload, "0", None))
    raw = b"".join(warc.packed(d) for d in datas[:20]) + b"junk\x1f\x8b\x08junk" + b"".join(warc.packed(d) for d in datas[20:])
    path = tmp_path / "a.warc.gz"
    path.write_bytes(raw)
    found = []
    with pafs.LocalFileSystem().open_input_file(str(path)) as file:
        for start in range(0, len(raw), size):
            found += [d for _, d in warc.members(warc.Source(file, len(raw), start), start, start + size)]
    assert found == datas


def test_a_cut_archive_gives_its_whole_records(tmp_path):
    datas = [warc.record(str(k), None, b"x" * 500, "0", None) for k in range(3)]
    raw = b"".join(map(warc.packed, datas))[:-9]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(raw)
    with pafs.LocalFileSystem().open_input_file(str(path)) as file:
        assert [d for _, d in warc.members(warc.Source(file, len(raw), 0), 0, len(raw))] == datas[:2]


@pytest.mark.parametrize("place", [-9, 40])
def test_a_damaged_archive_of_a_manifest_is_an_error(spark, tmp_path, place):
    pages = spark.createDataFrame([(k, f"http://x/{k}", f"page {k} " * 90) for k in range(5)], "page_id long, url string, html string")
    manifest, folder = warc.write_archives(warc.plan_records(pages.coalesce(1)), f"file://{tmp_path}/warc")
    assert warc.read_archives(manifest, folder).count() == 5
    path = tmp_path / "warc" / manifest.first().file
    raw = path.read_bytes()
    path.write_bytes(raw[:place] + (bytes(200) + raw[place + 200 :] if place > 0 else b""))
    with pytest.raises(ValueError, match="4 whole records of 5"):
        warc.read_archives(manifest, folder)
    assert warc.read_archives(manifest.drop("records"), folder).count() == 4


# Near duplicates


def brute_components(rows, width, percent):
    sets, by_id = [], collections.defaultdict(list)
    for n, (k, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets.append({b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
        if k is not None:
            by_id[k].append(n)
    parent = {k: k for k in by_id}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (m, (a, _)), (n, (b, _)) in itertools.combinations(enumerate(rows), 2):
        both = len(sets[m] & sets[n])
        if a is not None and b is not None and sets[m] and sets[n] and 100 * both >= percent * (len(sets[m]) + len(sets[n]) - both):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return sorted(((k, len(s), top(k) if k is not None else None, k is not None and top(k) == k) for (k, _), s in zip(rows, sets)), key=str)


@pytest.mark.parametrize("width, percent, cell", [(3, 85, 1 << 20), (5, 80, 1 << 20), (3, 85, 256)])
def test_near_duplicates_of_odd_texts(spark, monkeypatch, width, percent, cell):
    monkeypatch.setattr(neardup, "CELL_SHINGLES", cell)
    random.seed(11)
    base = [random.choice("abcdefghijklmnopqrst") * random.randint(1, 3) for _ in range(90)]
    rows = [(100, " ".join(base))]
    for k in range(40):
        own = list(base)
        for _ in range(random.randint(0, 6)):
            own[random.randrange(90)] = f"w{random.random()}"
        rows.append((random.randint(0, 10**6), " ".join(own)))
    rows += [(1, None), (2, ""), (3, " \t"), (4, "One"), (5, "one "), (6, "one two"), (7, "ÉTÉ x y z"), (8, "été x y z"), (None, " ".join(base))]
    rows += [(4, "One"), (5, "something else here now"), (9, "q " * 20_000), (10, "Q\x0bq " * 3)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, component_id string")
    wanted = brute_components(rows, width, percent)
    # Rows that share an id are one document.
    five = min(c for k, _, c, _ in wanted if k in (4, 5))
    wanted = sorted(((k, n, five if k in (4, 5) else c, kept) for k, n, c, kept in wanted), key=str)
    assert sorted(map(tuple, neardup.deduplicate(docs, width, percent).collect()), key=str) == wanted
    assert neardup.deduplicate(docs.limit(0), width, percent).collect() == []


def test_an_id_ties_all_its_texts(spark):
    texts = {c: " ".join(f"{c}{k}" for k in range(30)) for c in "ABCD"}
    rows = [(1, "A"), (2, "B"), (3, "C"), (9, "A"), (9, "B"), (9, "C"), (9, "C"), (4, "D")]
    docs = spark.createDataFrame([(k, texts[c]) for k, c in rows], "doc_id long, text string")
    found = sorted((r.doc_id, r.component_id, r.kept) for r in neardup.deduplicate(docs).collect())
    assert found == [(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), *[(9, 1, False)] * 4]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (60, 100), (7, 7), (None, 3)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 100: 50}


def test_bands_catch_what_they_should():
    for similarity in (0.8, 0.85):
        assert (1 - similarity**neardup.ROWS_PER_BAND) ** neardup.bands_for(similarity) <= neardup.MISS


# Chats


def cheapest(roles):
    """Least cost by trying every single step."""
    import heapq

    queue, best = [(0, 0, chat.START)], {}
    while queue:
        cost, i, state = heapq.heappop(queue)
        if (i, state) in best:
            continue
        best[i, state] = cost
        if i == len(roles) and state == chat.FINAL:
            return cost
        for role in chat.ROLES:
            after = chat.NEXT[role][state]
            if after >= 0:
                heapq.heappush(queue, (cost + chat.INSERT, i, after))
                if i < len(roles):
                    own = 0 if role == roles[i] else chat.RELABEL if roles[i] in chat.ROLES else chat.NAME
                    heapq.heappush(queue, (cost + own, i + 1, after))
        if i < len(roles) and state != chat.START:
            same = chat.ROLES[state - 1] == roles[i]
            heapq.heappush(queue, (cost + (chat.MERGE_SAME if same else chat.MERGE_OTHER), i + 1, state))


def test_repair_costs_least():
    for n in range(1, 5):
        for roles in itertools.product([*chat.ROLES, "tool"], repeat=n):
            codes = np.array([chat.CODES.get(r, chat.CODES[None]) for r in roles])
            states = chat.path(codes, chat.START, chat.END_COSTS)
            steps = zip(codes, [chat.START, *states[:-1]], states)
            cost = sum(chat.MOVES[c][a][b].cost for c, a, b in steps) + chat.END_COSTS[states[-1]]
            assert cost == (chat.summary(codes)[chat.START] + chat.END_COSTS).min() == cheapest(roles)


def chats(frame):
    parts = collections.defaultdict(list)
    for r in chat.format_chats(frame).collect():
        parts[r.conv_id].append((r.seq, r.piece))
    assert all([s for s, _ in sorted(p)] == list(range(len(p))) for p in parts.values())
    return {k: "".join(piece for _, piece in sorted(p)) for k, p in parts.items()}


def test_chats_are_legal_and_do_not_depend_on_the_split(spark):
    random.seed(12)
    names = ["system", "user", "assistant", " User ", "tool", None]
    rows = [(c, i, random.choice(names), f"t{i}", "x") for c in range(30) for i in range(random.choice([1, 2, 5]))]
    rows += [(77, i, random.choice(names), f"h{i}", "x") for i in range(400)]
    rows += [(78, 0, "user", None, "x"), (78, 0, "user", None, "x"), (None, None, "user", "n", "x"), (79, None, "system", "", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        one = chats(frame)
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert chats(frame) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(one) == 34
    for text in one.values():
        state = chat.START
        for role in re.findall(r"<\|im_start\|>(\w+)\n", text):
            state = chat.NEXT[role][state]
            assert state > 0
        assert state == chat.FINAL and text.count("<|im_end|>") == text.count("<|im_start|>")
    assert chat.format_chats(frame.limit(0)).collect() == []


def test_odd_ids_and_long_urls_of_archives(spark):
    ids = [" a ", "b\r\nX-Page: z", "50%25", "", "é \t", None]
    rows = [(k, "http://x/" + "y" * (1 << 21 if n == 0 else n), f"payload {n}" * 40 * (n % 2) + "z" * 200) for n, k in enumerate(ids)]
    rows += [(" b", "u", "z" * 200)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()}
    assert set(got) == {*ids, " b"} and all(got[k][0] == len(h) for k, _, h in rows)
    same = sorted(k for k, _, h in rows if h == "z" * 200 and k is not None)
    assert {k: got[k][2] for k in same} == {k: (None if k == same[0] else same[0]) for k in same}


def test_files_follow_their_tasks():
    names = [f"file:/a/part-7/part-{n:05d}-0f-c000.snappy.parquet" for n in (0, 9, 99_999, 100_000, 1_234_567)]
    assert sorted(reversed(names), key=chat.task_order) == names


def test_chats_with_other_id_types(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "b"), (1, 1, "assistant", "c")]
    for kind in ("smallint", "decimal(5,0)", "double"):
        turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
        turns = turns.withColumn("conv_id", turns["conv_id"].cast(kind))
        found = chat.format_chats(turns)
        assert found.schema["conv_id"].dataType == turns.schema["conv_id"].dataType and found.count() == 3
