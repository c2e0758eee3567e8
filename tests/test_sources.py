import os
from pathlib import Path

import pytest
from helpers import write_tree
from pyspark.sql import functions as F

from quarrysift.sources import corpus, settings
from quarrysift.sources.selection import Selection
from quarrysift.sources.tree import empty_dirs, read_files, single_file, walk


def listed(spark, root, selection, start=""):
    return {r["file_path"] for r in walk(spark, str(root), selection, start).files.collect()}


def test_inverted_ignore_file_keeps_directories_open(spark, tmp_path):
    rules = "# nothing but Go\n*\n!*/\n!*.go\n!go.mod\nscratch/\n"
    kept = {"main.go", "go.mod", "cmd/serve/run.go", "cmd/serve/deep/go.mod"}
    lost = {"Makefile", "cmd/serve/run.txt", "scratch/try.go", "cmd/scratch/deep/try.go"}
    write_tree(tmp_path, {".gitignore": rules, **dict.fromkeys(kept | lost, "package x")})
    assert listed(spark, tmp_path, Selection(["**/*"], ["**/.*"])) == kept


def test_size_cap_is_inclusive_and_keeps_broken_links(spark, tmp_path):
    write_tree(tmp_path, {f"n{size}.py": "#" * size for size in (0, 9, 10, 11, 200)})
    os.symlink(tmp_path / "nowhere", tmp_path / "dangling.py")
    kept = {"n0.py", "n9.py", "n10.py", "dangling.py"}
    assert listed(spark, tmp_path, Selection(["**/*.py"], [], 10)) == kept


def test_underscore_and_dot_names_are_seen(spark, tmp_path):
    names = ["__pkg__/__init__.py", "_u.py", ".hid/c.py", ".d.py", "a.py"]
    write_tree(tmp_path, dict.fromkeys(names, "x"))
    assert listed(spark, tmp_path, Selection(["**/*.py"], [])) == set(names)


def test_excluded_directories_are_not_entered(spark, tmp_path):
    names = ["keep.py", "skip/hidden.py", "a/node_modules/x/y.py", "vendor/lib/z.py", ".v/q.py"]
    write_tree(tmp_path, dict.fromkeys(names, "x"))
    rules = Selection(exclude=[*Selection().exclude, "**/skip"])
    assert listed(spark, tmp_path, rules) == {"keep.py"}


def test_nested_ignore_files(spark, tmp_path):
    write_tree(
        tmp_path,
        {
            ".gitignore": "ignored.py\nignored_dir/\n*.tmp.py\n!important.py\n",
            "ignored.py": "x",
            "important.py": "x",
            "ignored_dir/a.py": "x",
            "sub/.gitignore": "/only_here.py\nany.py\nbuild/\n\\!odd.py\n# c\n",
            "sub/only_here.py": "x",
            "sub/deep/only_here.py": "x",
            "sub/deep/any.py": "x",
            "sub/build/a.py": "x",
            "sub/deep/build/a.py": "x",
            "sub/b.tmp.py": "x",
        },
    )
    rules = Selection(["**/*.py"], [])
    wanted = {"important.py", "sub/deep/only_here.py", "sub/deep/build/a.py"}
    assert listed(spark, tmp_path, rules) == wanted
    assert listed(spark, tmp_path, rules, "sub") == wanted - {"important.py"}
    assert listed(spark, tmp_path, rules, "ignored_dir") == set()
    dirs = walk(spark, str(tmp_path), rules).rule_dirs
    assert {r[0] for r in dirs.collect()} == {"", "sub"}


def test_tree_and_table_select_the_same_files(spark, tmp_path):
    files = {".gitignore": "*.md\n!keep.md\nd2/\n", "d1/.gitignore": "x*.py\n!d3/xa.py\n*/q/\n"}
    for top in ("", "d1/", "d2/", "d1/d3/", "d4/q/", "d1/d3/q/", "d4/skip/"):
        for name in ("a.py", "xa.py", "n.md", "keep.md", "big.py", ".hid.py", "other.bin"):
            files[top + name] = "x" * (500 if name == "big.py" else 5)
    write_tree(tmp_path, files)
    rows = [(path, text.encode()) for path, text in files.items()]
    table = corpus.from_table(spark.createDataFrame(rows, "file_path string, content binary"))
    rules = Selection(["**/*.py", "**/*.md"], ["**/.*", "**/skip"], 100)
    found = {r["file_path"] for r in corpus.select_files(table, rules).collect()}
    assert found == listed(spark, tmp_path, rules)
    assert "d1/xa.py" not in found and "d1/d3/a.py" in found and "d2/a.py" not in found


def test_many_directories_and_one_huge(spark, tmp_path):
    names = [f"hot/f{i}.py" for i in range(700)] + [f"d{i}/e/f.py" for i in range(150)]
    write_tree(tmp_path, dict.fromkeys(names, "x"))
    rows = walk(spark, str(tmp_path), Selection()).files
    assert rows.count() == 850 and rows.distinct().count() == 850
    content = read_files(rows, str(tmp_path))
    assert content.where(F.col("content") == b"x").count() == 850


def test_unreadable_and_single_files(spark, tmp_path):
    os.symlink(tmp_path / "missing", tmp_path / "gone.py")
    write_tree(tmp_path, {"a.bin": b"\xff\x00"})
    rows = read_files(walk(spark, str(tmp_path), Selection(["**"], [])).files, str(tmp_path))
    by_path = {r["file_path"]: r for r in rows.collect()}
    assert by_path["gone.py"]["content"] is None and "No such file" in by_path["gone.py"]["error"]
    one = read_files(single_file(spark, str(tmp_path / "a.bin")), str(tmp_path)).first()
    assert bytes(one["content"]) == b"\xff\x00" and one["length"] == 2


def test_a_missing_tree_is_an_error_and_not_empty(spark, tmp_path):
    with pytest.raises(Exception, match="is not a directory on this executor"):
        walk(spark, str(tmp_path / "none"), Selection())


def test_ignore_files_are_read_again_by_the_next_walk(spark, tmp_path):
    write_tree(tmp_path, {"a.py": "x", "b.py": "x", ".gitignore": "a.py\n"})
    assert listed(spark, tmp_path, Selection()) == {"b.py"}
    write_tree(tmp_path, {".gitignore": "b.py\n"})
    assert listed(spark, tmp_path, Selection()) == {"a.py"}


def test_listing_can_be_released(spark, tmp_path):
    write_tree(tmp_path, {"a.py": "x"})
    found = walk(spark, str(tmp_path), Selection())
    assert found.files.count() == 1 and os.path.isdir(found.folder.removeprefix("file:"))
    found.release()
    assert not os.path.exists(found.folder.removeprefix("file:"))


@pytest.mark.parametrize(
    "value, size",
    [
        (1048576, 1048576),
        ("2048", 2048),
        ("500KB", 512000),
        ("500 kb", 512000),
        ("1MB", 1 << 20),
        ("1.5MB", 3 << 19),
        ("2GB", 2 << 30),
        ("512B", 512),
        (10.9, 10),
    ],
)
def test_sizes(value, size):
    assert settings.parse_size(value) == size


@pytest.mark.parametrize("value", ["", "   ", "abc", "10XB", 0, -1, True, None, [], "0", "-5KB"])
def test_bad_sizes(value):
    with pytest.raises(ValueError):
        settings.parse_size(value)


def test_settings_round_trip(tmp_path, monkeypatch):
    monkeypatch.setenv(settings.USER_DIR_ENV, str(tmp_path / "user"))
    project = settings.ProjectSettings(["**/*.inc"], ["x"], {"inc": "php"}, {"toml": "m:f"}, 512)
    settings.save_project(tmp_path, project)
    assert settings.load_project(tmp_path) == project
    assert settings.find_project_root(tmp_path / "a" / "b") == tmp_path
    user = settings.UserSettings(settings.EmbeddingSettings("m", "hash", query_params={}))
    settings.save_user(user)
    assert settings.load_user() == user and user.embedding.indexing_params is None
    settings.user_file().write_text("embedding: {model: m, indexing_params: null}\n")
    assert settings.load_user().embedding.indexing_params == {}
    settings.user_file().write_text("")
    with pytest.raises(ValueError):
        settings.load_user()
    with pytest.raises(FileNotFoundError):
        settings.load_project(tmp_path / "none")


def test_ignore_entry_is_idempotent(tmp_path):
    settings.add_ignore_entry(tmp_path)
    assert not (tmp_path / ".gitignore").exists()
    (tmp_path / ".git").mkdir()
    (tmp_path / ".gitignore").write_text("*.log")
    settings.add_ignore_entry(tmp_path)
    settings.add_ignore_entry(tmp_path)
    assert (tmp_path / ".gitignore").read_text().count(settings.GITIGNORE_ENTRY) == 1
    settings.remove_ignore_entry(tmp_path)
    assert (tmp_path / ".gitignore").read_text() == "*.log\n"


def test_paths(tmp_path, monkeypatch):
    pairs = settings.parse_mappings("/a=/b, /a/c=/d")
    assert settings.map_path(pairs, "/a/c/x") == "/b/c/x"
    assert settings.map_path(pairs, "/b/x", reverse=True) == "/a/x"
    assert settings.map_path(pairs, "/ab") == "/ab" and settings.map_path(pairs, "a/x") == "a/x"
    with pytest.raises(ValueError):
        settings.parse_mappings("a=/b")
    monkeypatch.setenv(settings.INDEX_MAPPING_ENV, f"{tmp_path}=/elsewhere")
    assert settings.index_location(tmp_path / "p") == "/elsewhere/p/index"
    assert settings.default_search_glob(tmp_path, tmp_path) is None
    assert settings.default_search_glob(tmp_path, tmp_path / "lib") == "lib/*"
    assert settings.default_search_glob(tmp_path / "x", tmp_path) is None
    (tmp_path / "w" / "x").mkdir(parents=True)
    (tmp_path / "w" / ".git").write_text("gitdir: elsewhere")
    assert settings.find_git_root(tmp_path / "w" / "x") == tmp_path / "w"


def test_patterns_are_appended_once():
    start = settings.ProjectSettings(["a"], ["x"])
    more = settings.with_patterns(start, ["b", "a"], ["y", "y"])
    assert (more.include_patterns, more.exclude_patterns) == (["a", "b"], ["x", "y"])
    assert start.include_patterns == ["a"]


def test_variables_of_the_process_alone(monkeypatch):
    monkeypatch.setenv("ONE_API_KEY", "1")
    monkeypatch.setenv("TWO_API_KEY", "2")
    found = settings.process_only({"TWO_API_KEY": "other"})
    assert "ONE_API_KEY" in found and "TWO_API_KEY" not in found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rules_as_columns_decide_as_the_walk_does(spark, seed):
    import random

    from quarrysift.sources import corpus
    from quarrysift.sources.ignore import is_ignored
    from quarrysift.sources.selection import Selection

    rng = random.Random(seed)
    names = ["a", "b", "c.py", "d+x"]
    dirs = ["", *(f"{x}" for x in names[:2]), *(f"{x}/{y}" for x in names[:2] for y in names[:2]), "a/b/a"]
    files = sorted({f"{d}/{n}".lstrip("/") for d in dirs for n in ("c.py", "d+x", "a.txt", "[q].py")})
    lines = ["a/", "*.py", "!c.py", "/b", "b/a", "**/d+x", "!a/", "# no", "", "\\!x", "*", "!*/", "*.txt ", "[[]q].py"]
    rules = [(d, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 4)))) for d in rng.sample(dirs, 4)]

    def kept(path):
        above = path.split("/")[:-1]
        chain = [(d, t) for d, t in sorted(rules) if d == "" or path.startswith(d + "/")]
        closed = any(is_ignored("/".join(above[:n]), True, chain) for n in range(1, len(above) + 1))
        return not closed and not is_ignored(path, False, chain)

    table = spark.createDataFrame([(f, 1) for f in files], "file_path string, length long")
    given = spark.createDataFrame(rules, "dir string, rules string")
    found = corpus.select_files(table, Selection((), ()), given)
    assert sorted(r["file_path"] for r in found.collect()) == [f for f in files if kept(f)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_directories_are_listed_and_emptied_by_several_tasks(spark, tmp_path):
    write_tree(tmp_path, {f"d{i}/f{j}.py": "x" for i in range(12) for j in range(3)} | {"d0/left.xyz": "x"})
    found = walk(spark, str(tmp_path), Selection())
    assert found.files.count() == 36
    # The twelve directories are one level.
    assert len(list(Path(found.folder.removeprefix("file:"), "level=1").glob("part-*.parquet"))) > 4
    (tmp_path / "d1/f1.py").unlink()
    empty_dirs(found.files, str(tmp_path))
    assert sorted(p.name for p in tmp_path.rglob("*")) == sorted(f"d{i}" for i in range(12))
    found.release()
