import re

import pytest

from quarrysift.operators import embedding, rules

RULES = "ordinal bigint, source string, target string"


def mapped(spark, paths, moves):
    rows = spark.createDataFrame([(n, p) for n, p in enumerate(paths)], "whole int, file_path string")
    found = rules.map_prefixes(rows, spark.createDataFrame(moves, RULES))
    assert found.columns == ["whole", "file_path", "shown"]
    return [r["shown"] for r in sorted(found.collect())]


def test_first_prefix_counts_and_whole_components_only(spark):
    moves = [(2, "a", "/one"), (1, "a/b", "/two"), (3, "a/b/c", "/never"), (0, "", "/root"), (5, "x/", "/x"), (4, None, "/n")]
    paths = ["a", "a/b", "a/b/c", "ab/c", "a/bc", "/etc/x", "", None, "a/b/c", "x//y", "x/y", "x/", "é/a"]
    assert mapped(spark, paths, moves) == [
        "/one", "/two", "/two/c", "ab/c", "/one/bc", "/root/etc/x", "/root", None, "/two/c", "/x/y", "x/y", "/x", "é/a",
    ]


def test_prefix_rules_without_rows_or_rules(spark):
    assert mapped(spark, [], [(1, "a", "b")]) == []
    assert mapped(spark, ["a/b", None], []) == ["a/b", None]


def test_prefix_rules_as_by_brute_force(spark):
    moves = [(n * 7 % 101, "/".join("abc"[(n // 3**k) % 3] for k in range(1 + n % 3)), f"/t{n}") for n in range(300)]
    paths = ["/".join("abcd"[(n // 4**k) % 4] for k in range(1 + n % 4)) for n in range(400)]

    def plain(path):
        hits = [m for m in moves if path == m[1] or path.startswith(m[1] + "/")]
        return min(hits)[2] + path[len(min(hits)[1]) :] if hits else path

    assert mapped(spark, paths, moves) == [plain(p) for p in paths]


@pytest.mark.parametrize("into", ["rule", "provider"])
def test_patterns_match_whole_values_within_their_group(spark, into):
    table = spark.createDataFrame(
        [(2, "p", "a.*", 1), (1, "p", "ab", 2), (1, "p", "a[bc]", 3), (0, "q", "a|b", 4), (0, None, ".*", 5), (None, "p", ".*", 6)],
        "ordinal bigint, provider string, pattern string, say int",
    )
    values = [("p", "ab"), ("p", "ac"), ("p", "abc"), ("p", "ba"), ("q", "b"), ("q", "bb"), (None, "ab"), ("p", None), ("p", "ab")]
    rows = spark.createDataFrame([(n, *v) for n, v in enumerate(values)], "of int, provider string, value string")
    found = sorted(rules.match_patterns(rows, table, "provider", "value", into).collect(), key=lambda r: r["of"])
    # Of equal ordinals the pattern that comes first.
    assert [r[into] and r[into]["say"] for r in found] == [3, 3, 1, None, 4, None, None, None, 3]


def test_recommended_parameters_as_rules(spark):
    names = ["nomic-ai/CodeRankEmbed", "nomic-ai/nomic-embed-text-v1", "voyage/x", "voyage/", "cohere/embed-english-v3.0", "Snowflake/snowflake-arctic-embed-m"]
    pairs = [(p, m) for p in ("litellm", "sentence-transformers", "none") for m in names]
    rows = spark.createDataFrame(pairs, "provider string, model string")
    for row in rules.match_patterns(rows, embedding.recommended_rules(spark), "provider", "model").collect():
        wanted = embedding.recommended_params(row["provider"], row["model"])
        assert (row["rule"] and (row["rule"]["indexing"], row["rule"]["query"]) or (None, None)) == wanted


def test_languages_by_suffix(spark):
    table = spark.createDataFrame([(2, ".h", "cpp"), (1, ".h", "c"), (1, ".py", "python"), (1, ".x", None)], "ordinal int, suffix string, language string")
    rows = spark.createDataFrame([(".h",), (".py",), (".x",), (None,), ("",)], "suffix string")
    found = rules.language_by_suffix(rows, table).collect()
    assert {r["suffix"]: r["language"] for r in found} == {".h": "c", ".py": "python", ".x": None, None: None, "": None}


def test_any_number_of_rules_is_one_plan(spark):
    rows = spark.createDataFrame([("a/b",)], "file_path string")

    def shape(n):
        table = spark.range(n).selectExpr("id AS ordinal", "concat('r', id) AS source", "'/t' AS target")
        plan = rules.map_prefixes(rows, table)._jdf.queryExecution().optimizedPlan().toString()
        return re.sub(r"#\d+L?|\d+", "", plan)

    assert shape(2) == shape(5000)
