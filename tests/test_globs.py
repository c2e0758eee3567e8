import random
import re
import sqlite3

import pytest

from quarrysift.functions import globs


def test_search_glob_agrees_with_sqlite():
    con = sqlite3.connect(":memory:")
    rng = random.Random(7)
    parts = ["*", "?", "a", "b", "/", ".", "[ab]", "[^a]", "[a-c]", "[]a]", "[", "é", "+", "(", "^"]
    texts = ["".join(rng.choice("abc/.é+(^[]") for _ in range(rng.randrange(7))) for _ in range(60)]
    for _ in range(400):
        glob = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
        regex = globs.python_regex(globs.search_glob_regex(glob))
        for value in texts:
            wanted = con.execute("SELECT ? GLOB ?", (value, glob)).fetchone()[0]
            assert bool(regex.search(value)) == bool(wanted), (glob, value)


@pytest.mark.parametrize(
    "glob, yes, no",
    [
        ("**/*.py", ["a.py", "x/y/a.py"], ["a.pyc", "a.py/b"]),
        ("sub/**", ["sub/b.py", "sub/x/y"], ["sub", "asub/b"]),
        ("*.py", ["a.py"], ["x/a.py"]),
        ("**/.*", [".git", "a/.env"], ["a/b", "a.b"]),
        ("a/**/b", ["a/b", "a/x/y/b"], ["ab", "a/xb"]),
        ("f.{js,ts}", ["f.js", "f.ts"], ["f.c"]),
        ("[!a]?", ["bc"], ["ab", "b/"]),
        ("**/build/assets", ["build/assets", "x/build/assets"], ["build/assets/y"]),
    ],
)
def test_path_glob(glob, yes, no):
    regex = globs.python_regex(globs.path_glob_regex(glob))
    assert all(regex.search(p) for p in yes)
    assert not any(regex.search(p) for p in no)


def test_path_glob_rejects_unclosed():
    for bad in ("a[b", "{a,b"):
        with pytest.raises(ValueError):
            globs.path_glob_regex(bad)


def test_column_and_worker_agree(spark):
    paths = ["a.py", "x/é.py", "x/y/[z].py", "sub/b", ".git/config", "a+b.py"]
    rows = spark.createDataFrame([(p,) for p in paths], "file_path string")
    for glob in ["**/*.py", "x/*", "**/.*", "a[+]b.*", "**"]:
        found = {r[0] for r in rows.where(globs.path_glob(rows.file_path, [glob])).collect()}
        regex = globs.python_regex(globs.path_glob_regex(glob))
        assert found == {p for p in paths if regex.search(p)}
    for glob in ["x/*", "*.py", "a.py", "a?b*", "x[/]*"]:
        found = {r[0] for r in rows.where(globs.search_glob(rows.file_path, [glob])).collect()}
        pattern = re.compile(globs.search_glob_regex(glob).replace(r"\z", r"\Z"))
        assert found == {p for p in paths if pattern.search(p)}


def test_prefix_is_pushed_down(spark, tmp_path):
    spark.createDataFrame([("src/a",)], "file_path string").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    plan = rows.where(globs.search_glob(rows.file_path, ["src/*"]))
    assert "StringStartsWith(file_path,src/)" in plan._jdf.queryExecution().toString()
