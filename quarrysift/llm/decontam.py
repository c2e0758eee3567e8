"""Benchmark decontamination with a positional inverted index.

Every test item is cut into windows of consecutive words. A first pass counts how often each
test term occurs in the training texts. For each window its rarest terms are its anchors.
A second pass stores the anchors' postings (term, document, position), and with those of
each window's rarest term the words around it. Lists are then intersected
from the rarest term on, after each position is moved back by the term's offset in its window, so that
a common start remains; what is left is compared word for word with the stored surroundings.

All of it is DataFrame code. Texts are read twice and never move: what moves are postings
of rare terms. Only terms go into broadcasts, in blocks of bounded size.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

WINDOW = 10
# Lists that are intersected before the comparison word for word.
ANCHORS = 2
# Terms broadcast at a time; every further block is one more pass over the texts.
TERMS_PER_BLOCK = 50_000
# ASCII characters that are neither digits nor lower-case letters separate words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Words with A-Z in lower case; there may be one empty word at either end."""
    column = F.col(text)
    ascii_only = F.octet_length(column) == F.char_length(column)
    other = F.translate(column, string.ascii_uppercase, string.ascii_lowercase)
    return F.split(F.coalesce(F.when(ascii_only, F.lower(column)).otherwise(other), F.lit("")), SEPARATORS, -1)


def word_count(words: Column) -> Column:
    ends = (F.element_at(words, 1) == "").cast("int") + (F.element_at(words, -1) == "").cast("int")
    return F.greatest(F.size(words) - ends, F.lit(0)).cast("long")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id (k), a hash of the text (h) and the words (ws): rows with one id may differ in text."""
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("x"))
    return rows.select("k", F.xxhash64("x").alias("h"), words_of("x").alias("ws"))


@dataclass
class PhraseIndex:
    """Windows (w, ww, n), whose they are (w, item), their anchors (w, r, o, t) and the postings."""

    windows: DataFrame
    owners: DataFrame
    anchors: DataFrame
    postings: DataFrame


def cut_windows(items: DataFrame, item_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows of all items, and which items have them. Items without words have none."""
    words = items.select(F.col(item_col).cast("string").alias("item"), words_of(text_col).alias("ws"))
    words = words.select("item", F.filter("ws", lambda x: x != "").alias("ws")).where("size(ws) > 0")
    last = F.greatest(F.size("ws") - size + 1, F.lit(1))
    cut = words.select("item", "ws", F.explode(F.sequence(F.lit(1), last)).alias("i"))
    cut = cut.select("item", F.slice("ws", F.col("i"), size).alias("ww"))
    cut = stored(cut.select(F.xxhash64("ww").alias("w"), "ww", "item"), "windows")
    return cut.select("w", "ww", F.size("ww").alias("n")).distinct(), cut.select("w", "item").distinct()


def build_index(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> PhraseIndex:
    """Count the test terms in ``docs``, choose each window's anchors and store their postings."""
    prepare(docs.sparkSession)
    windows, owners = cut_windows(items, item_col, item_text_col, size)
    windows = stored(windows, "distinct-windows")
    rows = keyed(docs, id_col, text_col)

    places = stored(windows.select("w", F.posexplode("ww").alias("o", "t")), "window-terms")
    terms = stored(places.select("t").distinct(), "terms")
    counts = rows.select(F.explode("ws").alias("t")).join(terms, "t").groupBy("t").count()
    counts = stored(counts, "term-counts")

    # A window with a term that no text has cannot occur; the others go by their rarest terms.
    known = places.join(counts, "t", "left")
    whole = known.groupBy("w").agg(F.min(F.coalesce("count", F.lit(0))).alias("c")).where("c > 0").select("w")
    order = Window.partitionBy("w").orderBy("count", "o")
    anchors = known.join(whole, "w", "left_semi").select("w", "o", "t", F.row_number().over(order).alias("r"))
    anchors = stored(anchors.where(F.col("r") <= ANCHORS), "anchors")

    wanted = stored(anchors.groupBy("t").agg(F.min("r").alias("first")), "anchor-terms")
    blocks = max(1, math.ceil(wanted.count() / TERMS_PER_BLOCK))
    postings = None
    radius = size - 1
    tokens = rows.select("k", "h", "ws", F.posexplode("ws").alias("p", "t"))
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("t", F.lit(1)), F.lit(blocks)) == block)
        low = F.greatest(F.col("p") - radius, F.lit(0))
        near = F.when(F.col("first") == 1, F.slice("ws", low + 1, 2 * radius + 1))
        found = tokens.join(F.broadcast(part), "t").select("t", "k", "h", "p", low.alias("low"), near.alias("near"))
        postings = found if postings is None else postings.unionByName(found)
    return PhraseIndex(windows, owners, anchors, stored(postings, "postings"))


def phrase_matches(index: PhraseIndex) -> DataFrame:
    """Exact occurrences of windows: k and h of the text, window (w), start (s) and length (n)."""
    lists = index.postings.select("t", "k", "h", "p").join(index.anchors, "t")
    lists = lists.select("w", "k", "h", (F.col("p") - F.col("o")).alias("s"), "r").where("s >= 0")
    # A start that all lists of the window share.
    met = lists.groupBy("w", "k", "h", "s").agg(F.bit_or(F.expr("shiftleft(1, r - 1)")).alias("seen"))
    lengths = index.windows.select("w", "n", "ww")
    met = met.join(lengths, "w").where(F.expr(f"seen = shiftleft(1, least(n, {ANCHORS})) - 1"))
    first = index.anchors.where("r = 1").select("w", "o")
    met = met.join(first, "w").select("w", "k", "h", "s", "n", "ww", (F.col("s") + F.col("o")).alias("p"))
    around = index.postings.where("near IS NOT NULL").select("k", "h", "p", "low", "near")
    same = (met["k"].eqNullSafe(around["k"])) & (met["h"] == around["h"]) & (met["p"] == around["p"])
    found = met.join(around, same).select("w", met["k"], met["h"], "s", "n", "ww", "low", "near")
    equal = F.slice("near", F.col("s") - F.col("low") + 1, F.col("n")) == F.col("ww")
    return found.where((F.col("s") >= F.col("low")) & equal).select("k", "h", "w", "s", "n").distinct()


def proximity_matches(index: PhraseIndex) -> DataFrame:
    """Places where all words of a window stand near its rarest one, in any order.

    Near is less than a window's length to either side. Returns k and h of the text, the window and the
    rarest word's position (p).
    """
    first = index.anchors.where("r = 1").join(index.windows, "w").select("t", "w", "ww")
    found = index.postings.where("near IS NOT NULL").join(first, "t")
    found = found.where(F.size(F.array_except("ww", "near")) == 0)
    return found.select("k", "h", "w", "p").distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: the id, n_words, n_hit, n_items, items_sha256 and contaminated.

    ``n_hit`` counts words inside any occurrence of a window, ``n_items`` the items with
    occurring windows, and the digest is of their ids as strings, sorted and joined by commas.
    Null and empty texts have no words. Repeated rows are kept as they are; rows that share
    an id count by themselves; items without words or with a null id take no part. Other columns
    are not read.
    """
    items = items.where(F.col(item_col).isNotNull())
    index = build_index(docs, items, size, id_col, text_col, item_col, item_text_col)
    matches = stored(phrase_matches(index), "matches")

    # Words covered by a text's matches, from left to right.
    spans = matches.groupBy("k", "h", "s").agg(F.max(F.col("s") + F.col("n")).alias("e"))
    before = Window.partitionBy("k", "h").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("e").over(before), F.lit(0))
    fresh = F.greatest(F.col("e") - F.greatest("s", reached), F.lit(0))
    hits = spans.select("k", "h", fresh.alias("c")).groupBy("k", "h").agg(F.sum("c").alias("n_hit"))
    owned = matches.select("k", "h", "w").distinct().join(index.owners, "w").select("k", "h", "item").distinct()
    owned = owned.groupBy("k", "h").agg(F.sort_array(F.collect_list("item")).alias("items"))
    same = hits["k"].eqNullSafe(owned["k"]) & (hits["h"] == owned["h"])
    found = hits.join(owned, same).select(hits["k"].alias("fk"), hits["h"].alias("fh"), "n_hit", "items")

    rows = keyed(docs, id_col, text_col).select("k", "h", word_count(F.col("ws")).alias("n_words"))
    rows = rows.join(found, F.col("k").eqNullSafe(F.col("fk")) & (F.col("h") == F.col("fh")), "left")
    none = F.lit(0).cast("long")
    return rows.select(
        F.col("k").alias(id_col),
        "n_words",
        F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce(F.size("items").cast("long"), none).alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", none) > 0).alias("contaminated"),
    )
