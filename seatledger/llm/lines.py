"""Operator 2: drop lines that an earlier document already has. DataFrame functions only.

Lines are exploded with their position and reduced to a 128-bit hash of their key; that
narrow table is written once and read twice. Counting takes one record for each (task,
hash), so a line of a third of all documents costs nothing; the join that finds the lines to
drop has the hot hash on one side only and is split by Spark. Texts move once, to meet the
positions they lose, and are put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatledger.llm.components import stored
from seatledger.llm.text import SPACE, ascii_lower

LEAST_CHARS = 10
LEAST_DOCS = 2


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def deduplicate_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` per row; ``kept`` joins the remaining lines by \\n.

    A key of at least ``least_chars`` code points found in ``least_docs`` documents or more
    keeps its lines in the smallest doc_id that has it and loses all others. Null and empty
    texts are one empty line. Rows without id keep everything and count for nobody. Rows
    repeating an id are one document; a position lost by one of them is lost by all. Other
    columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    split = docs.where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = split.select("doc_id", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= least_chars)
    lines = stored(
        keys.select("doc_id", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")), "lines"
    )
    if least_docs == 2:
        counted = lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
        shared = counted.where("_first < _last")
    else:
        each = lines.select("h1", "h2", "doc_id").distinct()
        counted = each.groupBy("h1", "h2").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_docs"))
        shared = counted.where(F.col("_docs") >= least_docs)
    lost = lines.join(shared.select("h1", "h2", "_first"), ["h1", "h2"]).where("doc_id > _first")
    gone = lost.groupBy("doc_id").agg(F.collect_list("pos").alias("_gone"))
    keyed = docs.where("doc_id is not null").join(gone, "doc_id", "left")
    rest = docs.where("doc_id is null").withColumn("_gone", F.lit(None).cast("array<int>"))
    both = keyed.unionByName(rest).withColumn("_lines", F.split("text", "\n", -1))
    n = F.size("_lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.coalesce("_gone", F.array().cast("array<int>")))
    kept = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        # The lines are bound to a variable, lest each position splits the text again.
        F.get(F.transform(F.array("_lines"), lambda v: F.array_join(F.transform(stay, lambda i: F.get(v, i)), "\n")), F.lit(0))
    )
    return both.select(
        "doc_id",
        n.cast("bigint").alias("n_lines"),
        F.coalesce(F.size(F.array_distinct("_gone")), F.lit(0)).cast("bigint").alias("n_dropped"),
        kept.alias("kept"),
    )
