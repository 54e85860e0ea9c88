"""Operator 4: test items inside documents, by containment search. DataFrame functions only.

Items are short and documents long, so the similarity of the two sets says nothing; what
counts is the share of an item's 5-word shingles that the document has. Each item gets a
bottom-k min-hash sketch whose length follows from its size partition: with n shingles, a
document holding the asked share lacks at most n - ceil(share n) of them, so one more than
that many min-hashed shingles always include one the document has. Every whole document is
then searched for any sketch entry (recall 1, not an estimate), and the candidates are
verified on the words of all shingles of the item. Items below five words make partitions
of their own, one for each length: their whole word sequence is their only shingle, and
documents are searched by windows of that length, if such items exist.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatledger.llm.components import stored
from seatledger.llm.text import ascii_lower, words

WIDTH = 5
PERCENT = 75
#: Bytes of an item table that may be broadcast; beyond, joins shuffle.
BROADCAST_BYTES = 32 << 20


def _windows(w: Column, widths: Sequence[int], one: Callable[[list[Column]], Column]) -> Column:
    """``one`` of every so many consecutive words, for each of the ``widths`` one after the other.

    The outer transform binds the words to a variable. Written into the inner lambda they
    would be split from the text again for every window.
    """

    def windows(v: Column) -> Column:
        def of(width: int) -> Column:
            every = F.transform(F.sequence(F.lit(0), F.size(v) - width), lambda i: one([F.get(v, i + k) for k in range(width)]))
            return F.when(F.size(v) >= width, every).otherwise(F.slice(F.transform(v, lambda x: one([x])), 1, 0))

        return F.concat(*(of(n) for n in widths)) if len(widths) > 1 else of(widths[0])

    return F.get(F.transform(F.array(w), windows), F.lit(0))


def shingle_hashes(w: Column, widths: Sequence[int] = (WIDTH,)) -> Column:
    """Hash of every window of the ``widths``; empty without any."""
    return _windows(w, widths, lambda own: F.xxhash64(*own))


def shingle_words(w: Column, widths: Sequence[int] = (WIDTH,)) -> Column:
    """The same windows as text, words joined by blanks."""
    return _windows(w, widths, lambda own: F.concat_ws(" ", *own))


def _small(df: DataFrame, size: Column) -> DataFrame:
    """``df`` marked for broadcast when its measured bytes allow."""
    found = df.agg(F.sum(size + 32)).first()[0] or 0
    return F.broadcast(df) if found <= BROADCAST_BYTES else df


def contained_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_found`` for every document that holds at least
    ``percent`` percent of an item's distinct shingles (words lower-cased in A-Z).

    Items without words are found nowhere. An item of fewer than ``width`` words has one
    shingle, its whole word sequence, and is found wherever a document has these words in
    a row. Rows without id on either side are left out; rows repeating an id count as one
    text with the shingles of all. Null and empty documents hold nothing. Empty tables give
    no rows.
    """
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), words(ascii_lower(F.col("text"))).alias("_w"))
    items = items.where("item_id is not null and size(_w) > 0").withColumn("width", F.least(F.size("_w"), F.lit(width)))
    whole = F.array(F.concat_ws(" ", "_w"))
    own = F.when(F.col("width") < width, whole).otherwise(shingle_words(F.col("_w"), [width]))
    entries = stored(items.select("item_id", "width", F.explode(own).alias("shingle")).distinct(), "items")
    # At most ``width`` numbers: the lengths that occur among items, ``width`` standing for all from there on.
    widths = sorted({r["width"] for r in entries.select("width").distinct().collect()} | {width})
    sizes = entries.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    order = Window.partitionBy("item_id").orderBy(F.xxhash64(F.lit("sketch"), "shingle"), "shingle")
    length = F.col("n_shingles") - F.floor((F.col("n_shingles") * percent + 99) / 100) + 1
    ranked = entries.join(sizes, "item_id").withColumn("_rank", F.row_number().over(order))
    parts = F.split("shingle", " ")
    hashed = F.coalesce(*(F.when(F.size(parts) == n, F.xxhash64(*(F.get(parts, F.lit(k)) for k in range(n)))) for n in widths))
    sketch = stored(ranked.where(F.col("_rank") <= length).select(hashed.alias("h"), "item_id"), "sketch")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")
    lowered = docs.select("doc_id", words(ascii_lower(F.col("text"))).alias("_w"))
    searched = lowered.select("doc_id", F.explode(shingle_hashes(F.col("_w"), widths)).alias("h"))
    found = searched.join(_small(sketch, F.lit(16)), "h").select("doc_id", "item_id").distinct()
    candidates = stored(found, "candidates")

    wanted = docs.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    held = wanted.select("doc_id", F.explode(F.array_distinct(shingle_words(words(ascii_lower(F.col("text"))), widths))).alias("shingle"))
    known = _small(entries.select("item_id", "shingle"), F.octet_length("shingle"))
    matched = held.join(known, "shingle").select("doc_id", "item_id", "shingle").distinct()
    counted = matched.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_found"))
    verified = counted.join(candidates, ["doc_id", "item_id"], "left_semi").join(sizes, "item_id")
    return verified.where(F.col("n_found") * 100 >= F.col("n_shingles") * percent).select("doc_id", "item_id", "n_shingles", "n_found")


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; rows without id stay."""
    dirty = contained_items(docs, items).select(F.col("doc_id").alias("_dirty")).distinct()
    return docs.join(dirty, docs["doc_id"].cast("bigint") == dirty["_dirty"], "left_anti")
