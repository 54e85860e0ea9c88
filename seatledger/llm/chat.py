"""Operator 7: collapse logged conversation snapshots and render the rest. DataFrame functions only.

A logger that saves a conversation after every turn leaves prefixes of the longest version.
Each turn gets the hash of all turns up to it; a conversation whose last hash equals an
inner hash of another is a prefix of it and goes by an anti-join. Equal conversations keep
the smallest id.

The prefix hash is a running sum of position-dependent turn hashes. Sums need no state
beyond a number, so a conversation with a very large share of all turns is cut into chunks
of ``CHUNK`` turn numbers that are summed apart and put together by running chunk totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatledger.llm.components import stored

CHUNK = 256
#: Fixed values of the rendered format.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _wrapped(total: Column) -> Column:
    """A sum of 64-bit hashes as a number below 2**62."""
    return F.pmod(total, F.lit(1 << 62).cast("decimal(20,0)")).cast("bigint")


def _turns(turns: DataFrame) -> DataFrame:
    """Distinct turns under a conversation key that is never null.

    Rows without conv_id are conversations of one turn each, keyed by their content.
    """
    one = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(-1)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    key = F.coalesce(F.col("conv_id").cast("string"), F.concat(F.lit("-"), F.sha2(F.concat_ws("\x00", "turn", "role", "text"), 256)))
    return one.withColumn("_key", key).withColumn("_chunk", F.floor(F.col("turn") / CHUNK)).distinct()


def _prefixed(turns: DataFrame) -> DataFrame:
    """Turns with ``position`` (from 1) and the two prefix hashes up to and including them."""
    inside = Window.partitionBy("_key", "_chunk").orderBy("turn", "role", "text")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    counts = turns.groupBy("_key", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_key", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = turns.join(before, ["_key", "_chunk"]).withColumn("position", F.row_number().over(inside) + F.col("_before"))
    # The sums of two independent turn hashes tell 2**124 prefixes apart.
    own = placed.select(
        "*",
        F.xxhash64("position", "role", "text").cast("decimal(20,0)").alias("_a"),
        F.xxhash64("text", F.lit(7), "role", "position").cast("decimal(20,0)").alias("_b"),
    )
    sums = own.groupBy("_key", "_chunk").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    earlier_sums = sums.select(
        "_key", "_chunk", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_a", "_b"))
    )
    return own.join(earlier_sums, ["_key", "_chunk"]).select(
        "_key", "conv_id", "role", "text", "position",
        _wrapped(F.sum("_a").over(upto) + F.col("_a_before")).alias("h1"),
        _wrapped(F.sum("_b").over(upto) + F.col("_b_before")).alias("h2"),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, position, role, text, n_turns, n_copies`` of every turn of the conversations
    that no other conversation extends; ``n_copies`` counts equal conversations.

    Turns are ordered by turn, role and text; exact repetitions of a row count once. A null
    turn comes first, null roles and texts are empty, rows without conv_id are conversations
    of their own. Prefixes compare role and text. An empty table gives no rows.
    """
    prefixed = stored(_prefixed(_turns(turns)), "prefixes")
    lengths = prefixed.groupBy("_key").agg(F.max("position").alias("n_turns"))
    marked = prefixed.join(lengths, "_key")
    hashed = ["position", "h1", "h2"]
    inner = marked.where("position < n_turns").select(*hashed).distinct()
    last = marked.where("position = n_turns").select("_key", "conv_id", *hashed)
    # Numeric ids first and in numeric order, then the keyless ones. Equal conversations become
    # one row, combined before the shuffle, before they meet the prefixes.
    first = F.min(F.struct(F.col("conv_id").isNull().alias("_void"), "conv_id", "_key")).alias("_first")
    chosen = last.groupBy(*hashed).agg(first, F.count(F.lit(1)).alias("n_copies"))
    kept = chosen.join(inner, hashed, "left_anti").select(F.col("_first._key").alias("_key"), F.col("position").alias("n_turns"), "n_copies")
    return prefixed.join(kept, "_key").select("conv_id", "_key", "position", "role", "text", "n_turns", "n_copies")


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def format_conversations(turns: DataFrame, piece_turns: int = CHUNK) -> DataFrame:
    """``conv_id, piece, n_turns, n_copies, rendered``: the maximal conversations as text.

    A conversation is rendered in pieces of ``piece_turns`` turns, numbered from 0, which
    concatenate to the whole; only conversations longer than that have more than one.
    """
    kept = maximal_conversations(turns).withColumn("piece", F.floor((F.col("position") - 1) / piece_turns))
    line = F.struct("position", render_turn(F.col("role"), F.col("text")).alias("_t"))
    grouped = kept.groupBy("_key", "conv_id", "piece", "n_turns", "n_copies").agg(F.sort_array(F.collect_list(line)).alias("_l"))
    return grouped.select(
        "conv_id", "piece", F.col("n_turns").cast("bigint"), "n_copies", F.concat_ws("", F.col("_l._t")).alias("rendered")
    )
