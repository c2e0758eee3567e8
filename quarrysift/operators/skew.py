"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_SHARE of the rows. There can be
# at most HOT_SHARE such keys, whatever the size of the data.
HOT_SHARE = 512

# Spreading one hot key over this many parts brings a key with a third of all
# rows below the share of an ordinary shuffle partition.
SALT_PARTS = 256


def hot_keys(rows: DataFrame, key: str, share: int = HOT_SHARE) -> list:
    """The keys that hold more than ``1/share`` of the rows: at most ``share``.

    Counting reads the key column only and combines inside each task before
    the shuffle. Give it a stored table.
    """
    total = rows.count()
    counts = rows.groupBy(key).count()
    hot = counts.where((F.col("count") * share > total) & F.col(key).isNotNull())
    return [row[key] for row in hot.select(key).collect()]


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    hot: list | None = None,
    salt: list[str] | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which has one row per key, without a hot task.

    Spark picks broadcast or shuffle by size as for any join; with the shuffle,
    a skewed partition of ``rows`` is split at run time by AQE. Pass ``hot``
    (see :func:`hot_keys`) to split known hot keys beforehand: their rows are
    spread by a hash of the ``salt`` columns, and the few lookup rows are
    repeated once per part, so no task depends on run-time detection. A hash and
    not a random number, so that a repeated task sends each row to the same place.
    """
    if not hot:
        return rows.join(lookup, key, how)
    is_hot = F.col(key).isin(hot)
    part = "__part"
    salted = rows.withColumn(
        part,
        F.when(is_hot, F.pmod(F.xxhash64(*(salt or rows.columns)), F.lit(SALT_PARTS))).otherwise(F.lit(0)),
    )
    parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALT_PARTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    spread = lookup.withColumn(part, F.explode(parts.cast("array<bigint>")))
    return salted.join(spread, [key, part], how).drop(part)
