import os

import pytest
from helpers import write_tree

from quarrysift.sources import codefiles, tree
from quarrysift.sources.selection import Selection

FILES = {"a/x.py": "one", "a/y.rs": "three", "b/__init__.py": "", "b/z.py": b"\xff\x00", "_u.py": "é" * 50}


@pytest.fixture
def opened(spark, tmp_path):
    base, listing = str(tmp_path / "t"), str(tmp_path / "l")
    write_tree(tmp_path / "t", FILES)
    walk = tree.walk(spark, base, Selection())
    codefiles.save_listing(walk.files, listing)
    walk.release()
    return lambda **wanted: codefiles.open_files(spark, base, listing, **wanted)


def paths(frame):
    return {r["file_path"] for r in frame.select("file_path").collect()}


def test_reads_all_files_whole(opened):
    found = {r["file_path"]: bytes(r["content"]) for r in opened().where("error IS NULL").collect()}
    assert found == {p: c if isinstance(c, bytes) else c.encode() for p, c in FILES.items()}


def test_files_that_are_not_wanted_are_not_opened(opened, tmp_path):
    # A file that is gone is an error if it is opened.
    os.remove(tmp_path / "t" / "a" / "y.rs")
    rest = opened(suffixes=[".py"], max_bytes=60)
    assert {r["file_path"]: r["error"] for r in rest.collect()} == dict.fromkeys(["a/x.py", "b/__init__.py", "b/z.py"])
    assert paths(opened().where("error IS NOT NULL")) == {"a/y.rs"}
    assert paths(opened(prefixes=["b/", "_"])) == {"b/__init__.py", "b/z.py", "_u.py"}
    assert paths(opened(prefixes=["b/"], suffixes=["z.py", ".rs"])) == {"b/z.py"}
    assert paths(opened(max_bytes=0)) == {"b/__init__.py"}
    assert paths(opened(prefixes=["none"])) == set()


def test_filters_of_one_query_do_not_stay_for_the_next(opened):
    files = opened()
    assert paths(files.where("length = 0")) == {"b/__init__.py"}
    assert paths(files.where("length = 0 OR file_path = 'a/x.py'")) == {"b/__init__.py", "a/x.py"}
    assert files.count() == len(FILES)


def test_parts_follow_the_bytes(spark, opened, tmp_path, monkeypatch):
    monkeypatch.setattr(tree, "_BYTES_PER_TASK", 10)
    listing = spark.read.parquet(str(tmp_path / "l"))
    codefiles.save_listing(listing, str(tmp_path / "more"))
    files = codefiles.open_files(spark, str(tmp_path / "t"), str(tmp_path / "more"))
    assert files.rdd.getNumPartitions() > 1
    assert paths(files) == set(FILES)


def test_empty_listing_and_missing_options(spark, tmp_path):
    os.makedirs(tmp_path / "t")
    os.makedirs(tmp_path / "l")
    assert codefiles.open_files(spark, str(tmp_path / "t"), str(tmp_path / "l")).count() == 0
    with pytest.raises(Exception, match="codefiles needs base"):
        spark.read.format("codefiles").load(str(tmp_path / "l")).collect()


def test_written_trees_come_back(spark, tmp_path):
    rows = spark.createDataFrame([("a/b.py", b"x"), ("a/b.py", b"x"), (None, b"y"), ("n.py", None)], "file_path string, content binary")
    tree.write_files(rows, str(tmp_path / "w"))
    found = tree.walk(spark, str(tmp_path / "w"), Selection(["**/*"], [])).files.collect()
    assert [(r["file_path"], r["length"]) for r in found] == [("a/b.py", 1)]
    with pytest.raises(Exception, match="not below the tree"):
        tree.write_files(spark.createDataFrame([("../x", b"")], rows.schema), str(tmp_path / "w"))


def test_only_mounted_folders():
    assert tree.mounted("file:/a/b") == tree.mounted("file:///a/b") == tree.mounted("/a/b") == "/a/b"
    with pytest.raises(ValueError, match="mounted"):
        tree.mounted("s3://bucket/a")
