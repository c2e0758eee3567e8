"""Snapshot comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff(
    old: DataFrame,
    new: DataFrame,
    key: str = "file_path",
    mark: str = "fingerprint",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every key of both snapshots with its ``action``.

    Keys are unique on both sides, so the full outer join has no hot key. A new
    row with NULL mark could not be read and counts as an error. Columns named in ``carry`` come along from
    the new row, or from the old one where the new one is missing or could not be read.
    """
    sides = []
    for rows, side, there in ((old, "old", "was"), (new, "new", "now")):
        more = [F.col(c).alias(f"{side}_{c}") for c in carry]
        sides.append(rows.select(key, F.col(mark).alias(f"{side}_mark"), F.lit(True).alias(there), *more))
    before, after = sides
    fresh = F.col("new_mark").isNotNull() | F.col("was").isNull()
    action = (
        F.when(F.col("now").isNull(), "delete")
        .when(F.col("new_mark").isNull(), "error")
        .when(F.col("was").isNull(), "add")
        .when(F.col("old_mark") != F.col("new_mark"), "reprocess")
        .otherwise("unchanged")
    )
    carried = [F.when(fresh, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c) for c in carry]
    return before.join(after, key, "full_outer").select(key, action.alias("action"), *carried)
