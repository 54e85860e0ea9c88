"""Operator 11: the prefix trie of rebuilt conversations, totalled by depth bands.

A node is a distinct sequence of first turns. Each turn of a conversation gets a running
hash of all turns up to it, which names its node; nodes and their members are then plain
aggregates. Subtree totals take neither a step for each depth nor a row for each pair of
node and ancestor:

* Depths are cut into bands of ``HEIGHT``. A node adds its values to its ancestors inside
  its own band only, so it explodes to at most ``HEIGHT`` rows.
* The tops of the bands form a smaller trie, whose values are the totals inside each band;
  it is totalled in the same way, its depths cut into bands again. The number of rounds is
  the logarithm of the depth to the base ``HEIGHT``.
* Each completed top is then added to its ancestors in the band above it, again at most
  ``HEIGHT`` rows, which completes every total.

Rows are ordered by ranges of (conversation, turn), so a conversation with a large share of
all turns lies in many tasks; positions and running hashes are put together from one small
record for each task it crosses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatledger.llm.components import stored

HEIGHT = 16
#: Conversations of one family start like that whose number is divisible by ``FAMILY``; up to ``SHARED - 1`` turns.
FAMILY, SHARED = 20, 4
#: Conversation ids in one piece of a list that is hashed.
PIECE_IDS = 4_096

_KEY = ["k1", "k2"]
_TURN = ["t1", "t2"]


def _xor(*columns: str) -> list[Column]:
    return [F.bit_xor(c).alias(c) for c in columns]


def _ordered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as hashes in order, and one row for each (conversation, range) with its place.

    Equal rows differ by an arrival number, so many copies of one row still spread over
    ranges. Texts end here; a turn goes on as two hashes and its number of words.
    """
    text = F.coalesce("text", F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("arrival"),
    )
    order = ["conv_id", "turn", "role", "text", "arrival"]
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    slim = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id",
        F.xxhash64("role", "text").alias("t1"),
        F.xxhash64("text", F.lit(7), "role").alias("t2"),
        F.when(F.col("text") == "", 0).otherwise(words).cast("bigint").alias("words"),
        F.spark_partition_id().alias("range"),
        F.monotonically_increasing_id().alias("place"),
    )
    slim = stored(slim, "turns")
    pieces = slim.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return slim, stored(pieces.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "pieces")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, depth, k1, k2, p1, p2, words) of the rebuilt turns and (conv_id, depth, k1, k2) of their ends.

    k names the node of the turn, p that of the turn before; the root is (0, 0).
    """
    slim, pieces = _ordered(turns)
    inside = Window.partitionBy("conv_id", "range").orderBy("place")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    h = F.crc32(F.col("conv_id").cast("string")) % SHARED

    # The first turns of the families' heads, at most three each.
    heads = pieces.where((F.col("conv_id") % FAMILY == 0) & (F.col("before") < SHARED - 1))
    first = slim.join(heads, ["conv_id", "range"]).withColumn("position", F.row_number().over(inside) + F.col("before"))
    shown = F.struct("position", *_TURN, "words")
    first = first.where(F.col("position") < SHARED).groupBy("conv_id").agg(F.sort_array(F.collect_list(shown)).alias("head"))
    own = pieces.groupBy("conv_id").agg(F.sum("n").alias("n")).select("conv_id", "n", base.alias("base"), h.alias("h"))
    taken = F.filter(F.coalesce("head", F.array().cast(first.schema["head"].dataType)), lambda t: t["position"] <= F.col("h"))
    convs = own.join(first.withColumnRenamed("conv_id", "base"), "base", "left").select("conv_id", "n", "h", taken.alias("head"))
    convs = stored(convs, "conversations")

    # A turn's share of the running hash: its own hashes and its depth. XOR needs no order to add up.
    def share(depth: Column) -> list[Column]:
        return [F.xxhash64(depth, *_TURN).alias("s1"), F.xxhash64("t2", depth, F.lit(3), "t1").alias("s2")]

    borrowed = convs.select("conv_id", F.inline("head")).select(
        "conv_id", F.lit(-1).alias("range"), F.col("position").cast("bigint").alias("depth"), *_TURN, "words"
    )
    # A piece knows its conversation's shift, so rows meet one row for each (conversation, range).
    lies = pieces.join(convs.select("conv_id", "h", F.size("head").alias("taken")), "conv_id")
    placed = slim.join(lies, ["conv_id", "range"]).withColumn("position", F.row_number().over(inside) + F.col("before"))
    kept = placed.where(F.col("position") > F.col("h")).select(
        "conv_id", "range", (F.col("position") - F.col("h") + F.col("taken")).cast("bigint").alias("depth"), *_TURN, "words"
    )
    both = kept.unionByName(borrowed).select("conv_id", "range", "depth", "words", *share(F.col("depth")))
    upto = Window.partitionBy("conv_id", "range").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = stored(both.select("*", *(F.bit_xor(f"s{i}").over(upto).alias(f"k{i}") for i in (1, 2))), "local")
    sums = local.groupBy("conv_id", "range").agg(*_xor("s1", "s2"), F.max("depth").alias("last"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "conv_id", "range", "last", *(F.coalesce(F.bit_xor(f"s{i}").over(earlier), F.lit(0).cast("bigint")).alias(f"c{i}") for i in (1, 2))
    )
    carried = stored(carried, "carried")
    whole = [F.col(f"k{i}").bitwiseXOR(F.col(f"c{i}")) for i in (1, 2)]
    rows = local.join(carried.drop("last"), ["conv_id", "range"]).select(
        "conv_id", "depth", "words", *(w.alias(k) for w, k in zip(whole, _KEY)),
        *(w.bitwiseXOR(F.col(f"s{i}")).alias(f"p{i}") for i, w in enumerate(whole, 1)),
    )
    rows = stored(rows, "prefixes")
    depths = carried.groupBy("conv_id").agg(F.max("last").alias("depth"))
    full = rows.join(depths, ["conv_id", "depth"]).select("conv_id", "depth", *_KEY)
    none = F.lit(0).cast("bigint")
    bare = convs.select("conv_id").join(depths, "conv_id", "left_anti").select("conv_id", none.alias("depth"), *(none.alias(k) for k in _KEY))
    return rows, stored(full.unionByName(bare), "ends")


def _node(k1: Column, k2: Column) -> Column:
    return F.struct(k1.alias("k1"), k2.alias("k2"))


def _chains(rows: DataFrame, unit: int, height: int) -> DataFrame:
    """(k1, k2, depth, top, chain): each node whose depth ``unit`` divides, and its band.

    ``chain`` names the node's ancestors of such depths in its band, the node itself
    included. A node that begins a band comes a second time as ``top``, then with the
    chain of the band above it.
    """
    band = unit * height
    own = F.floor(F.col("depth") / band)
    begins = F.col("depth") % band == 0
    here = F.struct(own.alias("band"), F.lit(False).alias("top"))
    above = F.struct((own - 1).alias("band"), F.lit(True).alias("top"))
    some = rows.where(F.col("depth") % unit == 0).select("conv_id", "depth", *_KEY, begins.alias("begins"))
    dealt = some.select("*", F.explode(F.when(F.col("begins"), F.array(here, above)).otherwise(F.array(here))).alias("x"))
    # A conversation has at most height + 1 rows in a band.
    window = Window.partitionBy("conv_id", "x.band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    nodes = F.collect_list(_node(F.col("k1"), F.col("k2"))).over(window)
    root = F.array(_node(F.lit(0).cast("bigint"), F.lit(0).cast("bigint")))
    chain = F.when(F.col("x.band") == 0, F.concat(root, F.col("nodes"))).otherwise(F.col("nodes"))
    chain = F.when(F.col("x.top"), F.slice(chain, 1, F.size(chain) - 1)).otherwise(chain)
    linked = dealt.withColumn("nodes", nodes).select(*_KEY, "depth", F.col("x.top").alias("top"), chain.alias("chain"))
    return linked.groupBy(*_KEY, "depth", "top").agg(F.first("chain").alias("chain"))


def _totals(rows: DataFrame, values: DataFrame, names: list[str], deepest: int, unit: int, height: int) -> DataFrame:
    """``values`` (k1, k2, names) summed over the subtree of every node whose depth ``unit`` divides."""
    sums = [F.sum(n).alias(n) for n in names]
    added = [F.col("a.k1").alias("k1"), F.col("a.k2").alias("k2")]
    chains = stored(_chains(rows, unit, height), "chains")
    root = values.where("k1 = 0 and k2 = 0")
    inner = values.join(chains.where("not top"), _KEY).select(F.explode("chain").alias("a"), *names).select(*added, *names)
    inside = inner.unionByName(root.select(*_KEY, *names)).groupBy(*_KEY).agg(*sums)
    if deepest < unit * height:
        return inside
    inside = stored(inside, "inside")
    tops = chains.where("top").select(*_KEY, "chain")
    upper = inside.join(tops.select(*_KEY), _KEY, "left_semi").unionByName(inside.where("k1 = 0 and k2 = 0"))
    done = _totals(rows, upper, names, deepest, unit * height, height)
    handed = done.join(tops, _KEY).select(F.explode("chain").alias("a"), *names).select(*added, *names)
    return inside.unionByName(handed).groupBy(*_KEY).agg(*sums)


def prefix_trie(turns: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Nodes ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens`` and the
    members that end at them, ``conv_id, depth, end_conv_id``.

    A node is known by its smallest member and its depth. Turns are ordered by turn (null
    first), role and text; rows that repeat are turns that repeat. Null roles and texts are
    empty. Rows without conv_id belong to no conversation and are left out. Conversations
    whose rebuilt form has no turn are members of the root alone. Node names are 128-bit
    hashes. Other columns are ignored; an empty table has no nodes, not even a root.
    """
    rows, ends = _rebuilt(turns)
    root = ends.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    zero = F.lit(0).cast("bigint")
    root = root.select(*(zero.alias(c) for c in (*_KEY, "depth", "words")), *(F.lit(None).cast("bigint").alias(c) for c in ("p1", "p2")), "n_convs", "conv_id")
    inner = rows.groupBy(*_KEY, "depth").agg(
        F.first("words").alias("words"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
    )
    nodes = stored(inner.unionByName(root), "nodes")
    below = nodes.where("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(below, _KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    own = nodes.select(
        "*", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    )
    own = stored(own, "nodes")
    deepest = own.agg(F.max("depth")).first()[0] or 0
    names = ["n_leaves", "saved_tokens"]
    totals = stored(_totals(rows, own.select(*_KEY, *names), names, deepest, 1, height), "totals")
    parents = own.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    full = own.drop(*names).join(totals, _KEY).join(parents, ["p1", "p2"], "left")
    named = ends.withColumnRenamed("conv_id", "end_conv_id").join(own.select(*_KEY, "conv_id"), _KEY)
    return (
        full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *names),
        named.select("conv_id", "depth", "end_conv_id"),
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, depth, end_conv_id) to comma-joined pieces of one node each."""
    for batch in batches:
        out, node, held = [], None, []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:2] != node or len(held) == PIECE_IDS:
                if held:
                    out.append((*node, held[0], ",".join(map(str, held))))
                node, held = row[:2], []
            held.append(row[2])
        if held:
            out.append((*node, held[0], ",".join(map(str, held))))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["conv_id", "depth", "first", "ids"]
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest for each node; a node's pieces pass by one at a time."""
    node, state = None, None

    def row(nodes: list[tuple], digests: list[str]) -> pa.RecordBatch:
        convs, depths = ([n[i] for n in nodes] for i in (0, 1))
        return pa.RecordBatch.from_arrays(
            [pa.array(convs, pa.int64()), pa.array(depths, pa.int64()), pa.array(digests, pa.string())],
            names=["conv_id", "depth", "ends_sha256"],
        )

    for batch in batches:
        nodes, digests = [], []
        for conv, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv, depth) == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                nodes.append(node)
                digests.append(state.hexdigest())
            node, state = (conv, depth), hashlib.sha256(ids.encode())
        if nodes:
            yield row(nodes, digests)
    if node is not None:
        yield row([node], [state.hexdigest()])


def end_digests(ends: DataFrame) -> DataFrame:
    """``conv_id, depth, ends_sha256`` of the nodes at which members end.

    Ids are joined to pieces where the ranges of (node, id) lie, so a node with very many
    ends comes to its one hash, which has no other order, as few long pieces.
    """
    order = ["conv_id", "depth", "end_conv_id"]
    ranged = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(_pieces, "conv_id bigint, depth bigint, first bigint, ids string")
    dealt = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return dealt.mapInArrow(_digests, "conv_id bigint, depth bigint, ends_sha256 string")
