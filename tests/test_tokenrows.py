"""Token rows against the search in one text, which stays for patterns that repeat a name."""

import random

import pytest

from quarrysift.operators import structural
from quarrysift.operators.lexing import Tokens
from quarrysift.operators.structural import MATCH, Pattern, match_text
from quarrysift.sources import corpus

PATTERNS = [
    r"f(\(A*\))",
    r"\X",
    r"\X b",
    r"a \(R*\) b",
    r"\F(\(*\)) \Y",
    r"f(\(A*\), \(B*\))",
    r"\{{ a \}} b",
    r"f(\{{ \X b \}})",
    r"\(R*\) \{{ (\(I*\)) \}} \N",
    r"a . b",
]


def wanted(texts, pattern, language="python"):
    found = []
    for path, text in texts:
        for match in match_text(text or "", Pattern(pattern, language)):
            row = {"path": path, "language": language, **match, "captures": dict(match["captures"])}
            found.append([row[name] for name in MATCH.names])
    return found


def plain(rows):
    def flat(value):
        if isinstance(value, dict):
            return tuple(sorted(value.items()))
        return tuple(value) if isinstance(value, list) else value

    return sorted(tuple(flat(value) for value in row) for row in rows)


def files(spark, texts):
    return corpus.from_table(spark.createDataFrame(texts, "path string, text string"), "path", "text")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    made = []
    for i in range(120):
        text = "".join(rng.choice("ffab.,()[]{} \n\"é#") for _ in range(rng.randrange(60)))
        made.append((f"r{i}.py", text))
    nested = "f((a b), c) f(x.y b) f([q, (z b)]) (1) b\nf(a, g(b)) n (f(b) a) b\na . b a.b"
    return [*made, ("nested.py", nested), ("empty.py", ""), ("long.py", "f(" + "a, " * 3000 + "b)\n" + "x.y(1)" * 300)]


@pytest.fixture(scope="module")
def table(spark, texts, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tokens") / "t")
    structural.tokenize(files(spark, texts)).write.partitionBy("language").parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("pattern", PATTERNS)
def test_rows_find_what_the_search_finds(spark, texts, table, pattern):
    found = structural.grep(files(spark, texts), pattern, tokens=table).matches.collect()
    assert plain(found) == plain(wanted(texts, pattern)) and found


def test_without_a_stored_table(spark, texts):
    given = files(spark, texts)
    for tokens in (None, structural.tokenize(given)):
        found = structural.grep(given, r"f(\{{ b \}})", tokens=tokens).matches.collect()
        assert plain(found) == plain(wanted(texts, r"f(\{{ b \}})"))
    none = given.limit(0)
    assert structural.grep(none, r"\X", tokens=structural.tokenize(none)).rows.count() == 0


def test_long_literals_and_line_ends(spark):
    words = " ".join(f"w{i}" for i in range(40))
    texts = [("a.py", f"é\r\n{words}\r\n'''x\n'''\n{words}"), ("b.py", words[:-1])]
    for pattern in (words, r"\A w0 w1", "'''x\n''' w0"):
        given = files(spark, texts)
        found = structural.grep(given, pattern, tokens=structural.tokenize(given)).matches.collect()
        assert plain(found) == plain(wanted(texts, pattern)) and found


def test_a_plan_without_python_for_a_stored_table(spark, texts, table):
    run = structural.grep(files(spark, texts), r"f(\{{ \X b \}})", tokens=table)
    plan = run.rows._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_chains_and_groups():
    tokens = Tokens("a.b(c)[0] d", "python")
    assert tokens.node_ends(0) == [9, 6, 3, 1] and tokens.node_ends(4) == [5] and tokens.attached(9) is None
