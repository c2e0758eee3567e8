import random

import pytest
from pyspark.sql import functions as F

from quarrysift.operators.chunking import (
    Chunk,
    Position,
    chunk_files,
    chunk_function,
    default_chunks,
    lateral_chunks,
    load_chunker,
    readable,
    section_chunks,
    split_spans,
    suffix_chunkers,
)

TOML = "# head\n[package]\nname = 'x'\n\n[deps]\na = 1\n[[bin]]\nb = 2\n"


def sections_of(path, content):
    """A chunker as a user would write it."""
    at = Position(0, 0, 1, 0)
    return "toml", [Chunk(part, at, at) for part in content.split("[") if part.strip()]


def nothing(path, content):
    return None, []


def texts(spark, rows):
    return spark.createDataFrame(rows, "file_path string, language string, content string")


@pytest.mark.parametrize("seed", range(40))
def test_default_splitter_invariants(seed):
    rng = random.Random(seed)
    words = ["word ", "x", "\n", "\n\n", "def f():\n", "    ret\n", "é" * 30, "y" * 1200, "\t", "z\r\n"]
    text = "".join(rng.choice(words) for _ in range(rng.randrange(1, 400)))
    spans = split_spans(text, rng.choice(["python", "text", "go"]))
    covered = [False] * len(text)
    for k, (start, end) in enumerate(spans):
        assert 0 < end - start <= 1000
        assert text[start:end].strip(" \t\n\r\f\v") == text[start:end]
        if k:
            assert start >= spans[k - 1][0] and spans[k - 1][1] - start <= 150
        covered[start:end] = [True] * (end - start)
    assert all(c or text[i].isspace() for i, c in enumerate(covered))
    for chunk in default_chunks(text, "python"):
        for at in (chunk.start, chunk.end):
            before = text[: at.char_offset]
            assert at.line == 1 + before.count("\n")
            assert at.byte_offset == len(before.encode())
            assert at.column == at.char_offset - (before.rfind("\n") + 1)
        assert text[chunk.start.char_offset : chunk.end.char_offset] == chunk.text


def test_definitions_start_chunks():
    body = "".join(f"    x{i} = {i} * {i}\n" for i in range(25))
    text = "".join(f"def fn{i}(a):\n{body}\n" for i in range(4))
    chunks = default_chunks(text, "python")
    assert all(c.text.startswith(("def fn", "x", "}")) or "def fn" in c.text for c in chunks)
    assert sum("def fn" in c.text for c in chunks) == 4
    assert default_chunks("short", "python")[0].text == "short"
    assert default_chunks(" \n ", "python") == []


def test_custom_chunkers_and_language(spark):
    rows = texts(
        spark,
        [("a.toml", "text", TOML), ("b.py", "python", "x = 1\n"), ("c.skip", "text", "gone")],
    )
    found = chunk_files(rows, {".toml": sections_of, ".skip": nothing}).collect()
    by_path = {}
    for row in found:
        by_path.setdefault(row["file_path"], []).append(row)
    assert len(by_path["a.toml"]) == 4 and {r["language"] for r in by_path["a.toml"]} == {"toml"}
    assert [r["content"] for r in by_path["b.py"]] == ["x = 1"] and "c.skip" not in by_path
    assert [r[0] for r in suffix_chunkers(rows, {".toml": nothing}).collect()] == ["a.toml"]


def test_equal_chunks_in_one_file_are_numbered(spark):
    def twice(path, content):
        at = Position(0, 0, 1, 0)
        return None, [Chunk("same", at, at), Chunk("other", at, at), Chunk("same", at, at)]

    rows = chunk_files(texts(spark, [("a.x", "text", "t")]), {".x": twice}).orderBy("chunk_no")
    assert [(r["content"], r["nth"]) for r in rows.collect()] == [("same", 0), ("other", 0), ("same", 1)]


def test_section_chunks(spark):
    rows = texts(spark, [("a.toml", "toml", TOML), ("b.toml", "toml", "x = 1\ny = 2\n"), ("c", "", "[a]\n[b]\nq")])
    found = section_chunks(rows).orderBy("file_path", "section").collect()
    assert [(r["file_path"], r["start_line"], r["end_line"], r["content"]) for r in found] == [
        ("a.toml", 2, 4, "[package]\nname = 'x'"),
        ("a.toml", 5, 8, "[deps]\na = 1\n[[bin]]\nb = 2"),
        ("b.toml", 1, 2, "x = 1\ny = 2\n"),
        ("c", 1, 1, "[a]"),
        ("c", 2, 3, "[b]\nq"),
    ]


def test_unreadable_and_blank_files_give_no_rows(spark):
    files = spark.createDataFrame(
        [("a", b"\xff\xfe"), ("b", b" \n\t"), ("c", b"x"), ("d", None)], "file_path string, content binary"
    )
    assert [r["file_path"] for r in readable(files).collect()] == ["c"]


def test_load_chunker():
    assert load_chunker("os.path:join")("a", "b") == "a/b"
    for bad in ("os.path", "os:sep", "os:none_such"):
        with pytest.raises(ValueError):
            load_chunker(bad)


def test_sizes_can_be_set(spark):
    rows = texts(spark, [("a", "text", "word " * 100)])
    sizes = chunk_files(rows, size=100, minimum=20, overlap=10).select(F.length("content"))
    assert 90 > max(r[0] for r in sizes.collect()) > 20


def test_chunkers_as_a_table_function(spark):
    rows = texts(
        spark,
        [("a.toml", "text", TOML), ("b.py", "python", "x = 1\n" * 400), ("c.skip", "text", "gone"), ("d.md", None, "d"), (None, "text", "n"), ("e.py", "python", None)],
    ).withColumn("size", F.length("content"))
    chunkers = {".toml": sections_of, ".skip": nothing}
    function = chunk_function(chunkers, size=500, minimum=100, overlap=50)
    found = lateral_chunks(rows, function)
    assert found.columns == ["file_path", "size", "language", "chunk_no", "nth", "content", "start", "end"]
    given = rows.where("file_path IS NOT NULL AND content IS NOT NULL").fillna("text", ["language"])
    wanted = chunk_files(given, chunkers, size=500, minimum=100, overlap=50)
    key = lambda frame: sorted(map(str, frame.select(*wanted.columns).collect()))
    assert key(found) == key(wanted) and len({r["file_path"] for r in found.collect()}) == 3

    spark.udtf.register("chunks_of", function)
    rows.createOrReplaceTempView("files_to_chunk")
    sql = "SELECT f.file_path, c.* FROM files_to_chunk f, LATERAL chunks_of(f.file_path, f.language, f.content) c"
    assert key(spark.sql(sql)) == key(wanted)
    with pytest.raises(Exception, match="content must be a string"):
        spark.sql("SELECT * FROM chunks_of('a.py', 'python', 1)").collect()


def test_sections_of_odd_texts(spark):
    rows = ["", "\n", "[a]", "[a]\n", "\n[a]\n\n[b]", "x\r\n[a]\r\ny", "[[no]]\nz", "q [a]\n[c] d\n", "[a]\n[a]\n\n"]
    got = section_chunks(texts(spark, [(str(i), "", t) for i, t in enumerate(rows)])).collect()
    found = {}
    for r in got:
        found.setdefault(int(r["file_path"]), []).append((r["section"], r["start_line"], r["end_line"], r["content"]))
    assert {k: sorted(v) for k, v in found.items()} == {
        1: [(1, 1, 1, "\n")],
        2: [(1, 1, 1, "[a]")],
        3: [(1, 1, 1, "[a]")],
        4: [(1, 2, 3, "[a]"), (2, 4, 4, "[b]")],
        5: [(1, 2, 3, "[a]\r\ny")],
        6: [(1, 1, 2, "[[no]]\nz")],
        7: [(1, 2, 2, "[c] d")],
        8: [(1, 1, 1, "[a]"), (2, 2, 3, "[a]")],
    }
