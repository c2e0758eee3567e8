"""Rule tables: the first rule that fits a row, found by joins.

Rules are rows with an ``ordinal``; of those that fit, the lowest counts, and of equal ordinals the one whose
text comes first. Any number of rules makes the same plan. Rules are joined to the distinct values of a table,
not to its rows: rows that repeat a value are compared once, and no hot value meets many rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def component_prefixes(path: Column) -> Column:
    """All beginnings of a path that end with a whole component, the path itself last."""
    parts = F.split(path, "/", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def _joined(rows: DataFrame, found: DataFrame, keys: dict[str, str], value: Column, into: str) -> DataFrame:
    """``rows`` with the column ``into``; ``found`` has one row per value that a rule fits."""
    on = [F.col(f"l.`{mine}`") == F.col(f"r.`{theirs}`") for mine, theirs in keys.items()]
    kept = [F.col(f"l.`{c}`") for c in rows.columns if c.lower() != into.lower()]
    return rows.alias("l").join(found.alias("r"), on, "left").select(*kept, value.alias(into))


def map_prefixes(rows: DataFrame, rules: DataFrame, path: str = "file_path", into: str = "shown") -> DataFrame:
    """``rows`` with ``path`` rewritten by the first rule (``ordinal``, ``source``, ``target``) that fits.

    A rule fits paths that are its source or lie below it, whole components only. Other paths stay, null
    stays null, and a rule with a null never fits.
    """
    # One rule per source: none has more partners than there are paths below it.
    usable = rules.where("ordinal IS NOT NULL AND source IS NOT NULL AND target IS NOT NULL")
    best = usable.groupBy("source").agg(F.min(F.struct("ordinal", "source", "target")).alias("rule"))
    paths = rows.select(F.col(f"`{path}`").alias("whole")).where("whole IS NOT NULL").distinct()
    starts = paths.select("whole", F.explode(component_prefixes(F.col("whole"))).alias("source"))
    first = starts.join(best, "source").groupBy("whole").agg(F.min("rule").alias("rule"))
    rest = F.substring(F.col("whole"), F.length("rule.source") + 1, F.length("whole"))
    found = first.select("whole", F.concat("rule.target", rest).alias("moved"))
    return _joined(rows, found, {path: "whole"}, F.coalesce(F.col("r.moved"), F.col(f"l.`{path}`")), into)


def match_patterns(rows: DataFrame, rules: DataFrame, by: str, value: str, into: str = "rule") -> DataFrame:
    """``rows`` with the first rule of their group whose ``pattern`` matches the whole value, as a struct.

    Rules have ``ordinal``, the column ``by``, ``pattern`` and whatever they say. Null where none fits. The work is
    the distinct values of a group times its rules.
    """
    usable = rules.where(F.col("ordinal").isNotNull() & F.col("pattern").isNotNull())
    packed = usable.select(F.col(f"`{by}`").alias("of"), F.struct(*(F.col(f"`{c}`") for c in rules.columns)).alias("rule"))
    values = rows.select(F.col(f"`{by}`").alias("of"), F.col(f"`{value}`").alias("whole")).distinct()
    whole = F.concat(F.lit(r"\A(?:"), F.col("rule.pattern"), F.lit(r")\z"))
    hits = values.join(packed, "of").where(F.regexp_like(F.col("whole"), whole))
    order = F.struct("rule.ordinal", "rule.pattern")
    found = hits.groupBy("of", "whole").agg(F.min_by("rule", order).alias("rule"))
    return _joined(rows, found, {by: "of", value: "whole"}, F.col("r.rule"), into)


def language_by_suffix(rows: DataFrame, rules: DataFrame, suffix: str = "suffix", into: str = "language") -> DataFrame:
    """``rows`` with the language that the first rule (``ordinal``, ``suffix``, ``language``) gives a suffix."""
    usable = rules.where("ordinal IS NOT NULL AND suffix IS NOT NULL AND language IS NOT NULL")
    best = usable.groupBy(F.col("suffix").alias("end")).agg(F.min(F.struct("ordinal", "language")).alias("rule"))
    return _joined(rows, best, {suffix: "end"}, F.col("r.rule.language"), into)
