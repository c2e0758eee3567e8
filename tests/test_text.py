from pathlib import PurePath

from pyspark.sql import functions as F

from quarrysift.functions import text
from quarrysift.functions.languages import LANGUAGE_BY_SUFFIX, language_of


def values(spark, rows, column):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("x")), "i").collect()]


def test_suffix_is_that_of_a_path(spark):
    names = ["a.py", "a/b.tar.gz", ".env", "a/.env", "x", "a.b/c", "A.PY", "..x", "a/.b.c"]
    assert values(spark, names, text.path_suffix) == [PurePath(n).suffix for n in names]
    assert values(spark, ["x", "a.py"], text.suffix_label) == ["(no ext)", ".py"]


def test_blank_is_what_strip_leaves_empty(spark):
    rows = ["", " \n\t", " ", "\x85", " ", "\x1c\x1f", "a", "​", " x "]
    assert values(spark, rows, text.is_not_blank) == [bool(r.strip()) for r in rows]


def test_lines_and_offsets(spark):
    rows = ["", "a", "a\nb", "a\r\nb\r\n", "\n\n", "x y\nz\r\r"]
    wanted = [[line.rstrip("\r") for line in r.split("\n")] for r in rows]
    assert values(spark, rows, text.lines_of) == wanted
    starts = [[0] + [i + 1 for i, c in enumerate(r) if c == "\n"] for r in rows]
    assert values(spark, rows, text.line_offsets) == starts


def test_ancestors(spark):
    rows = ["", "a", "a/b/c"]
    assert values(spark, rows, text.ancestor_dirs) == [[""], ["", "a"], ["", "a", "a/b", "a/b/c"]]
    assert values(spark, ["a", "x/a", "x/y/a"], text.parent_dir) == ["", "x", "x/y"]


def test_undecodable_is_null(spark):
    frame = spark.createDataFrame([(b"\xff\xfe",), ("é".encode(),)], "b binary")
    assert [r[0] for r in frame.select(text.decoded(F.col("b"))).collect()] == [None, "é"]


def test_languages(spark):
    rows = ["a.py", "x/b.inc", "c.zzz", ".py", "d.RS"]
    found = values(spark, rows, lambda c: language_of(c, {"inc": "php"}))
    assert found == ["python", "php", "text", "text", "text"]
    found = values(spark, rows, lambda c: language_of(c, fallback=None))
    assert found == ["python", None, None, None, None]
    assert LANGUAGE_BY_SUFFIX[".hh"] == "cpp" and "" not in LANGUAGE_BY_SUFFIX
