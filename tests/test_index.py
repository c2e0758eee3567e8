import os
import re
import threading

import pytest
from helpers import write_tree
from pyspark.sql import functions as F
from test_embedding import Counting

from quarrysift.operators.embedding import LetterEmbedder
from quarrysift.plans import index as index_module
from quarrysift.plans.index import Index
from quarrysift.plans.project import Project, describe_counters
from quarrysift.sources import corpus, settings, tree
from quarrysift.sources.selection import Selection
from quarrysift.sources.tree import walk
from quarrysift.streaming.refresh import notices, refresh_on


def table(spark, files):
    rows = [(path, text.encode() if isinstance(text, str) else text) for path, text in files.items()]
    return corpus.from_table(spark.createDataFrame(rows, "file_path string, content binary"))


def contents(index):
    return {(r["file_path"], r["language"]): r["content"] for r in index.chunks().collect()}


def nonzero(counters):
    return {k.removeprefix("num_"): v for k, v in counters.items() if v}


def test_life_of_a_table_index(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder(), overrides={"inc": "php"})
    assert not index.status().first()["index_exists"] and index.status().first()["total_chunks"] == 0
    with pytest.raises(RuntimeError, match="Index not found"):
        index.results("x")
    assert index.search("x").message.startswith("Query failed: Index not found")

    files = {"a.py": "alpha", "b.py": "beta", "c.inc": "gamma", "d.txt": " \n", "e.txt": b"\xff\xfe"}
    assert nonzero(index.refresh(table(spark, files))) == {"execution_starts": 5, "adds": 5}
    first = {("a.py", "python"): "alpha", ("b.py", "python"): "beta", ("c.inc", "php"): "gamma"}
    assert contents(index) == first
    ids = {r["file_path"]: r["id"] for r in index.chunks().collect()}
    assert nonzero(index.refresh(table(spark, files))) == {"execution_starts": 5, "unchanged": 5}
    assert index.snapshot().version == 1

    before = index.chunks()
    files.update({"a.py": "omega", "f.rs": "new", "d.txt": "filled"})
    del files["b.py"]
    counters = index.refresh(table(spark, files))
    assert nonzero(counters) == {
        "execution_starts": 5, "adds": 1, "deletes": 1, "reprocesses": 2, "unchanged": 2,
    }
    assert describe_counters(counters).startswith("5 files listed | 1 added, 1 deleted, 2 reproc")
    now = {("a.py", "python"): "omega", ("c.inc", "php"): "gamma", ("f.rs", "rust"): "new"}
    now["d.txt", "text"] = "filled"
    assert contents(index) == now
    # A reader of the older snapshot still gets it, and untouched rows keep their id.
    assert {(r["file_path"], r["language"]): r["content"] for r in before.collect()} == first
    assert {r["file_path"]: r["id"] for r in index.chunks().collect()}["c.inc"] == ids["c.inc"]
    row = index.status().first()
    assert (row["total_chunks"], row["total_files"]) == (4, 4)
    assert row["languages"] == {"python": 1, "php": 1, "rust": 1, "text": 1}

    # Going blank, coming back and going again in later runs.
    for text in ("", "back", "b\xe4ck", ""):
        files["a.py"] = text
        index.refresh(table(spark, files))
        wanted = {**now, ("a.py", "python"): text}
        if not text:
            del wanted["a.py", "python"]
        assert contents(index) == wanted
    # Two snapshots and their checksums; one folder per bucket and snapshot.
    assert len(os.listdir(tmp_path / "i" / "snapshots")) <= 4
    assert len(os.listdir(tmp_path / "i" / "chunks")) <= 2 and len(os.listdir(tmp_path / "i" / "state")) == 2

    changed = Index(spark, str(tmp_path / "i"), LetterEmbedder(), overrides={"inc": "sql"})
    assert nonzero(changed.refresh(table(spark, files)))["reprocesses"] == 5
    assert ("c.inc", "sql") in contents(changed) and len(contents(changed)) == len(wanted)
    assert changed.reset() and not changed.reset()


def test_unreadable_files_keep_their_rows(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())
    index.refresh(table(spark, {"a.py": "alpha", "b.py": "beta"}))
    files = table(spark, {"a.py": "new", "b.py": "x"})
    failing = files.withColumn("error", F.when(F.col("file_path") == "b.py", "no"))
    assert nonzero(index.refresh(failing)) == {"execution_starts": 2, "reprocesses": 1, "errors": 1}
    assert contents(index) == {("a.py", "python"): "new", ("b.py", "python"): "beta"}
    assert nonzero(index.refresh(files)) == {"execution_starts": 2, "reprocesses": 1, "unchanged": 1}
    assert contents(index)["b.py", "python"] == "x"


def test_a_file_that_vanishes_between_readings(spark, tmp_path, monkeypatch):
    root = tmp_path / "tree"
    write_tree(root, {"a.py": "alpha", "b.py": "beta", "deep/c.py": "gamma"})
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())

    def refresh():
        found = walk(spark, str(root), Selection())
        return nonzero(index.refresh_tree(found.files, str(root), None, found.unlisted))

    real, calls = index_module.read_files, []

    def second_reading_fails(listing, base):
        calls.append(1)
        rows = real(listing, base)
        if len(calls) < 2:
            return rows
        lost = F.col("file_path") == "a.py"
        return rows.withColumns({"error": F.when(lost, "gone"), "content": F.when(~lost, F.col("content"))})

    monkeypatch.setattr(index_module, "read_files", second_reading_fails)
    assert refresh() == {"execution_starts": 3, "adds": 2, "errors": 1}
    assert {k for k, _ in contents(index)} == {"b.py", "deep/c.py"}
    monkeypatch.setattr(index_module, "read_files", real)
    assert refresh() == {"execution_starts": 3, "adds": 1, "unchanged": 2}
    assert {k for k, _ in contents(index)} == {"a.py", "b.py", "deep/c.py"}
    assert not (tmp_path / "i" / "staging").exists() or not os.listdir(tmp_path / "i" / "staging")

    # A directory that cannot be listed keeps its rows.
    unlisted = spark.createDataFrame([("deep",)], "file_path string")
    listing = walk(spark, str(root), Selection()).files.where("file_path NOT LIKE 'deep/%'")
    assert nonzero(index.refresh_tree(listing, str(root), None, unlisted)) == {
        "execution_starts": 3, "unchanged": 2, "errors": 1,
    }
    assert ("deep/c.py", "python") in contents(index)
    assert refresh() == {"execution_starts": 3, "unchanged": 3}


def test_unlistable_directory_is_an_error(tmp_path, monkeypatch):
    write_tree(tmp_path, {"a.py": "x"})
    monkeypatch.setattr(os, "scandir", lambda path: (_ for _ in ()).throw(PermissionError(path)))
    assert [r[0] for r in tree._children(str(tmp_path), "", [], Selection())] == ["error"]


def test_no_text_moves_for_fingerprints(spark, tmp_path, monkeypatch):
    rows = [(f"d{i}/f{i}.py", b"x" * i, i) for i in range(50)]
    frame = spark.createDataFrame(rows, "file_path string, content binary, mtime_us bigint")
    frame.write.parquet(str(tmp_path / "files"))
    files = corpus.from_table(spark.read.parquet(str(tmp_path / "files")))
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())
    index.refresh(files)
    seen = []
    monkeypatch.setattr(Index, "_apply", lambda self, manifest, current, *rest, **more: seen.append(current) or {})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index.refresh(files)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        text = seen[0]._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
    assert moved and not any("content" in columns for columns in moved)


def test_a_path_may_occur_once(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())
    files = table(spark, {"a.py": "alpha"})
    with pytest.raises(Exception, match="a path twice: a.py"):
        index.refresh(files.unionByName(files))
    assert index.snapshot() is None
    seen = []
    index.refresh(files, seen.append)
    counters = {"execution_starts": 1, "adds": 1}
    assert nonzero(seen[0]) == counters
    # The last report has seen all tasks end.
    assert seen[-1]["tasks"] == seen[-1]["tasks_done"] > 0


def test_vectors_are_kept_by_text(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"), Counting())
    index.refresh(table(spark, {"a.py": "same", "b.py": "same", "c.py": "other!"}))
    index.refresh(table(spark, {"a.py": "same", "b.py": "other!", "c.py": "fresh text"}))
    found = {r["file_path"]: r["embedding"][0] for r in index.chunks().collect()}
    assert found == {"a.py": 4.0, "b.py": 6.0, "c.py": 10.0}
    runs = index.snapshot().vectors
    assert [spark.read.parquet(p).count() for p in index._folders("vectors", runs)] == [2, 1]
    files = {"a.py": "other!", "d.py": "fresh text", "e.py": "one more text"}
    index.refresh(table(spark, files))
    found = {r["file_path"]: r["embedding"][0] for r in index.chunks().collect()}
    assert found == {"a.py": 6.0, "d.py": 10.0, "e.py": 13.0}


def test_times_spare_hashing(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())

    def refresh(files):
        rows = [(path, text.encode(), time) for path, (text, time) in files.items()]
        schema = "file_path string, content binary, mtime_us bigint"
        return nonzero(index.refresh(corpus.from_table(spark.createDataFrame(rows, schema))))

    files = {"a.py": ("one", 1), "b.py": ("two", 1)}
    assert refresh(files) == {"execution_starts": 2, "adds": 2}
    files["a.py"] = ("eno", 1)  # same size and time
    assert refresh(files) == {"execution_starts": 2, "unchanged": 2}
    files["a.py"] = ("eno", 2)
    files["b.py"] = ("two", 2)
    assert refresh(files) == {"execution_starts": 2, "reprocesses": 1, "unchanged": 1}
    assert contents(index)["a.py", "python"] == "eno"


class WrongSize(Counting):
    name = "wrong"

    def embed(self, texts, **params):
        return [[0.0] * (3 if t == "hello world" else 2) for t in texts]


def test_wrong_dimension_leaves_the_index_as_it_was(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())
    index.refresh(table(spark, {"a.py": "alpha"}))
    other = Index(spark, str(tmp_path / "i"), WrongSize())
    with pytest.raises(Exception, match="expected 3 dimensions"):
        other.refresh(table(spark, {"a.py": "beta"}))
    assert contents(index) == {("a.py", "python"): "alpha"} and index.snapshot().version == 1


def test_a_late_writer_is_refused(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())
    stale = index.snapshot()
    index.refresh(table(spark, {"a.py": "alpha"}))
    with pytest.raises(RuntimeError, match="finished first"):
        current = table(spark, {"z.py": "z"}).select(
            "file_path", F.lit("f").alias("fingerprint"), "length", "mtime_us"
        )
        index._apply(stale, current, lambda changed, folder: table(spark, {"z.py": "z"}))
    assert contents(index) == {("a.py", "python"): "alpha"}


def test_concurrent_refreshes_run_one_after_the_other(spark, tmp_path):
    files = table(spark, {"a.py": "alpha", "b.py": "beta"})
    results = []

    def run():
        results.append(Index(spark, str(tmp_path / "i"), LetterEmbedder()).refresh(files))

    threads = [threading.Thread(target=run) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    # Whoever came while the first refresh ran got its counters.
    assert 2 in {r["num_adds"] for r in results} <= {0, 2}
    assert index_module._first_runs == {} and len(contents(Index(spark, str(tmp_path / "i"), LetterEmbedder()))) == 2


def test_callers_share_the_first_run(spark, tmp_path, monkeypatch):
    files, index = table(spark, {"a.py": "alpha"}), Index(spark, str(tmp_path / "i"), LetterEmbedder())
    started, go, runs, results = threading.Event(), threading.Event(), [], []
    real = Index._apply

    def slow(self, *rest, **more):
        runs.append(1)
        started.set()
        go.wait(60)
        if len(runs) == 1:
            raise OSError("no disk")
        return real(self, *rest, **more)

    monkeypatch.setattr(Index, "_apply", slow)

    def call():
        try:
            results.append(index.refresh(files)["num_adds"])
        except OSError as exc:
            results.append(str(exc))

    for wanted, n_runs in ((["no disk"] * 3, 1), ([1] * 3, 2)):
        threads = [threading.Thread(target=call) for _ in range(3)]
        threads[0].start()
        started.wait(60)
        [t.start() for t in threads[1:]]
        while len(index_module._first_runs) < 1:
            pass
        threads[1].join(0.5), threads[2].join(0.5)
        go.set()
        [t.join() for t in threads]
        assert results == wanted and len(runs) == n_runs
        started.clear(), go.clear(), results.clear()


def test_only_buckets_with_changes_are_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_module, "BUCKET_BYTES", 40)
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())
    files = {f"f{i}.{'py' if i % 2 else 'rs'}": f"text {i} " * 3 for i in range(20)}
    index.refresh(table(spark, files))
    first = index.snapshot()
    assert first.n_buckets > 5 and set(first.folders.values()) == {first.state}
    files["f3.py"] = "other words"
    del files["f4.rs"]
    index.refresh(table(spark, files))
    now = index.snapshot()
    assert 1 <= sum(run == now.state for run in now.folders.values()) <= 2 < len(now.folders)
    assert {k[0]: v for k, v in contents(index).items()} == {k: v.strip() for k, v in files.items()}
    # The last file of a bucket goes, and the bucket with it.
    index.refresh(table(spark, {"f3.py": files["f3.py"]}))
    assert len(index.snapshot().folders) == 1 and len(contents(index)) == 1
    index.refresh(table(spark, {}))
    assert index.snapshot().folders == {} and contents(index) == {}


def test_a_task_has_one_slice_of_a_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_module, "BUCKET_BYTES", 120)
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())
    index.refresh(table(spark, {f"f{i}.py": f"text {i} " * 3 for i in range(60)}))
    buckets = {}
    for path in (tmp_path / "i/chunks").rglob("part-*.parquet"):
        buckets.setdefault(re.match(r"part-\d+", path.name)[0], set()).add(path.parent.parent.name)
    # There are more buckets than shuffle partitions, which hashing would fill with several each.
    assert len(buckets) > 8 and all(len(names) == 1 for names in buckets.values())
    assert len(contents(index)) == 60


def test_reports_rise_while_tasks_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_module, "REPORT_SECONDS", 0.01)
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())
    seen = []
    index.refresh(table(spark, {f"{i}.py": f"text {i}" for i in range(200)}).repartition(20), seen.append)
    done = [s["tasks_done"] for s in seen[1:]]
    assert done == sorted(done) and len(set(done)) > 2 and done[-1] == seen[-1]["tasks"]


def test_tree_refresh_reads_only_what_may_have_changed(spark, tmp_path):
    root = tmp_path / "src"
    write_tree(root, {"a.py": "alpha", "b/c.py": "beta", "big.py": "x" * 500})
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder())

    def refresh():
        listing = walk(spark, str(root), Selection(max_bytes=100)).files
        return nonzero(index.refresh_tree(listing, str(root)))

    assert refresh() == {"execution_starts": 2, "adds": 2}
    # Same size and time: taken as unchanged although the bytes differ.
    stat = os.stat(root / "a.py")
    (root / "a.py").write_text("alphA")
    os.utime(root / "a.py", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert refresh() == {"execution_starts": 2, "unchanged": 2}
    # New time, same bytes: read, and then unchanged.
    (root / "a.py").write_text("alpha")
    os.utime(root / "a.py", ns=(1, 1_000_000_000))
    assert refresh() == {"execution_starts": 2, "unchanged": 2}
    (root / "a.py").write_text("gamma!")
    (root / "b" / "c.py").unlink()
    write_tree(root, {"d.rs": "delta"})
    wanted = {"execution_starts": 2, "adds": 1, "deletes": 1, "reprocesses": 1}
    assert refresh() == wanted
    assert contents(index) == {("a.py", "python"): "gamma!", ("d.rs", "rust"): "delta"}


FIB = "def fibonacci(n):\n    '''Fibonacci numbers.'''\n    return n if n < 2 else fibonacci(n - 1)\n"
DB = "class Connection:\n    '''Database connection.'''\n    def connect(self):\n        pass\n"


@pytest.fixture
def project(spark, tmp_path, monkeypatch):
    monkeypatch.setenv(settings.USER_DIR_ENV, str(tmp_path / "user"))
    root = tmp_path / "p"
    write_tree(root, {"main.py": FIB, "utils.py": "def parse_csv(path):\n    pass\n", "lib/database.py": DB})
    settings.save_project(root, settings.ProjectSettings())
    return Project(spark, root)


def first_path(response):
    assert response.success, response.message
    return response.results[0]["file_path"]


def test_project_end_to_end(spark, project):
    assert first_path(project.search("fibonacci calculation")) == "main.py"
    assert first_path(project.search("database connection", refresh=False)) == "lib/database.py"
    write_tree(project.root, {"app.js": "function handleRequest(request) { return request; }\n"})
    assert first_path(project.search("handle request")) == "app.js"
    inside = project.search("fibonacci", paths=["lib/*"])
    assert [r["file_path"] for r in inside.results] == ["lib/database.py"]
    assert set(inside.results[0]) == {
        "file_path", "language", "content", "start_line", "end_line", "score",
    }
    assert project.search("x", limit=0).success is False
    assert project.search("x", limit=101).success is False
    checks = {c.name: c for c in project.doctor()}
    assert "Total matched files: 4" in checks["File walk"].details
    assert "Files: 4" in checks["Index status"].details
    assert all(c.ok for c in checks.values())
    snapshot = project.index.snapshot()
    assert snapshot.dim == 256 and snapshot.n_files == 4


def test_notices_trigger_one_refresh(spark, project, tmp_path):
    inbox, checkpoint = tmp_path / "inbox", str(tmp_path / "cp")
    inbox.mkdir()
    seen = []

    def run():
        query = refresh_on(notices(spark, str(inbox)), project.refresh, checkpoint, done=seen.append)
        query.awaitTermination()

    run()
    assert seen == []
    for i in range(3):
        (inbox / f"{i}.json").write_text('{"reason": "edit", "at_us": 1}\n')
    run()
    assert [nonzero(s) for s in seen] == [{"execution_starts": 3, "adds": 3}]
    (project.root / "main.py").write_text("changed = 1\n")
    (project.root / "utils.py").unlink()
    (inbox / "next.json").write_text('{"reason": "edit", "at_us": 2}\n')
    run()
    assert nonzero(seen[1]) == {
        "execution_starts": 2, "deletes": 1, "reprocesses": 1, "unchanged": 1,
    }


def test_status_comes_from_the_counts_of_written_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_module, "BUCKET_BYTES", 64)
    index = Index(spark, str(tmp_path / "i"), LetterEmbedder(), overrides={"inc": "php"})
    files = {f"d{n}/f{n}.{('py', 'rs', 'inc')[n % 3]}": f"text {n} " * (n + 1) for n in range(12)}

    def scanned():
        rows = index.chunks().collect()
        languages = [r["language"] for r in rows]
        return len(rows), len({r["file_path"] for r in rows}), {x: languages.count(x) for x in set(languages)}

    def told():
        row = index.status().first()
        return row["total_chunks"], row["total_files"], row["languages"]

    index.refresh(table(spark, files))
    assert index.snapshot().n_buckets > 1
    assert told() == scanned()
    # One bucket changes; the others keep the counts of the first run.
    files["d3/f3.py"] = "x"
    del files["d4/f4.rs"]
    index.refresh(table(spark, files))
    assert len(set(index.snapshot().folders.values())) == 2
    assert told() == scanned()
    read = index.status().inputFiles()
    assert read and all("/counts/" in name for name in read)
    # Without its counts an index is scanned, and an empty one has zeros.
    index.storage.delete("counts")
    assert told() == scanned()
    index.refresh(table(spark, {}))
    assert told() == (0, 0, {})
