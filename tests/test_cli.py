import json

import pytest
from helpers import write_tree

from quarrysift import __version__
from quarrysift.cli import main
from quarrysift.sources import settings

DEF = r"def \NAME(\(ARGS*\)):"


@pytest.fixture
def root(tmp_path, monkeypatch):
    monkeypatch.setenv(settings.USER_DIR_ENV, str(tmp_path / "user"))
    project = tmp_path / "p"
    write_tree(
        project,
        {
            ".git/HEAD": "x",
            "main.py": "def fibonacci(n):\n    return n\n\n\ndef greet(name):\n    pass\n",
            "lib/db.py": "def connect(url):\n    pass\n",
            "c.rs": "fn main() {}\n",
        },
    )
    monkeypatch.chdir(project)
    return project


def test_session(spark, root, capsys, monkeypatch):
    def run(*argv):
        code = main(list(argv), spark)
        out = capsys.readouterr()
        return code, out.out, out.err

    assert run("version") == (0, __version__ + "\n", "")
    with pytest.raises(SystemExit, match="not inside an initialized project"):
        main(["index"], spark)
    assert run("init")[0] == 0
    assert settings.GITIGNORE_ENTRY in (root / ".gitignore").read_text()
    assert "Index not created yet." in run("status")[1]
    code, out, _ = run("index")
    assert code == 0 and "3 added" in out and "python: 2 chunks" in out
    code, out, _ = run("search", "fibonacci", "--limit", "1")
    assert "--- Result 1 (score: " in out and "File: main.py:1-6 [python]" in out
    code, out, _ = run("search", "connect", "url", "--lang", "python", "--json")
    found = json.loads(out)
    assert found["success"] and found["total_returned"] == 2
    assert found["results"][0]["file_path"] == "lib/db.py"
    monkeypatch.chdir(root / "lib")
    assert "main.py" not in run("search", "fibonacci")[1]
    monkeypatch.chdir(root)
    assert "No results found." in run("search", "x", "--path", "none/*")[1]
    assert "[OK] File walk" in run("doctor")[1]
    code, out, _ = run("grep", DEF)
    assert out == (
        "lib/db.py\n1| def connect(url):\n\nmain.py\n1| def fibonacci(n):\n---\n5| def greet(name):\n"
    )
    assert run("grep", "nope()")[:2] == (0, "No matches found.\n")
    assert run("grep", DEF, "missing")[0] == 1
    code, out, err = run("grep", r"def \NAME \{{ return")
    assert code == 1 and "pattern invalid for python" in err and "did not compile for any" in err
    code, out, _ = run("grep", r"\N(\*)", ".", "--lang", "rust")
    assert "c.rs" in out and ".py" not in out
    monkeypatch.setattr("builtins.input", lambda _: "n")
    assert "Aborted." in run("reset")[1]
    assert "Index deleted." in run("reset", "-f")[1]
    assert "Nothing to reset." in run("reset", "-f")[1]
    assert "fully reset" in run("reset", "-f", "--all")[1]
    assert not settings.project_file(root).exists()
    assert settings.GITIGNORE_ENTRY not in (root / ".gitignore").read_text()
