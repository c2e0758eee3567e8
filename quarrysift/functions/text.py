"""Text, path and label expressions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A character Python's str.strip() would keep: not white space in the Unicode
# sense and not one of the four ASCII separators.
NON_BLANK = r"(?U)[^\s\x1c-\x1f]"


def decoded(content: Column) -> Column:
    """Text of a binary column, NULL where the bytes are not UTF-8."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text)


def is_not_blank(text: Column) -> Column:
    return text.rlike(NON_BLANK)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_dir(path: Column) -> Column:
    """Directory part of a relative path, empty for the root."""
    return F.regexp_replace(path, r"(^|/)[^/]*$", "")


def ancestor_dirs(directory: Column) -> Column:
    """All directories above and including ``directory``, the root (empty) first."""
    parts = F.split(directory, "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )
    root = F.array(F.lit(""))
    return F.when(directory == "", root).otherwise(F.concat(root, prefixes))


def path_suffix(path: Column) -> Column:
    """Last suffix with its dot and case; empty for none and for dotfiles."""
    return F.regexp_extract(file_name(path), r"(?<=.)(\.[^./]+)$", 1)


def suffix_label(path: Column) -> Column:
    return F.coalesce(F.nullif(path_suffix(path), F.lit("")), F.lit("(no ext)"))


def lines_of(text: Column) -> Column:
    """Lines split at ``\\n`` only, each without trailing carriage returns."""
    return F.transform(F.split(text, "\n", -1), lambda line: F.regexp_replace(line, r"\r+$", ""))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _line_offsets(texts: pd.Series) -> pd.Series:
    """Places after each ``\\n``: one search per text over its code points."""
    found = []
    for text in texts:
        if text is None:
            found.append(None)
            continue
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        found.append(np.append(0, np.flatnonzero(points == 10) + 1).astype(np.int32))
    return pd.Series(found, dtype=object)


def line_offsets(text: Column) -> Column:
    """0-based character offset of each line start, counting ``\\n`` only.

    A running sum over an array costs Spark's functions the square of the lines.
    """
    return _line_offsets(text)


def gutter(line_no: Column, width: Column) -> Column:
    """Right-aligned line number, a bar and one space."""
    return F.concat(F.lpad(line_no.cast("string"), width, F.lit(" ")), F.lit("| "))


def location(path: Column, start: Column, end: Column, language: Column) -> Column:
    return F.format_string("File: %s:%d-%d [%s]", path, start, end, language)


def short_id(path: Column) -> Column:
    return F.substring(F.md5(path.cast("binary")), 1, 12)


def map_prefix(path: Column, mappings: Sequence[tuple[str, str]]) -> Column:
    """Rewrite the first matching path prefix, whole components only."""
    result = F.lit(None).cast("string")
    for source, target in reversed(list(mappings)):
        hit = (path == source) | path.startswith(source + "/")
        moved = F.concat(F.lit(target), F.substring(path, F.lit(len(source) + 1), F.length(path)))
        result = F.when(hit, moved).otherwise(result)
    return F.coalesce(result, path)


def epoch_micros(moment: Column) -> Column:
    """Microseconds since 1970 of a time without zone, whatever the session's zone."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", start, moment.cast("timestamp_ntz"))


def rate_limit_delay(message: Column, attempt: Column) -> Column:
    """Seconds to wait before the next request, NULL when not rate limited."""
    hint = r"(?i)Please try again in ([0-9.]+)(ms|s)"
    value = F.regexp_extract(message, hint, 1).try_cast("double")
    unit = F.lower(F.regexp_extract(message, hint, 2))
    asked = F.when(unit == "ms", value / 1000.0).when(unit == "s", value)
    backoff = F.least(F.lit(0.5) * F.pow(F.lit(2.0), attempt), F.lit(10.0))
    delay = F.least(F.coalesce(asked, backoff) + 0.1, F.lit(10.0))
    return F.when(F.lower(message).contains("rate limit"), delay)
