"""Operator 5: near duplicates by fast similarity sketches, banding and exact checks.

1. Every text becomes a set of hashed 5-word shingles and a *fast similarity sketch*: in
   round i every shingle falls into one of ``coordinates`` bins with a value in [i, i+1);
   a bin keeps its least value. Rounds stop when all bins are filled; after
   ``coordinates`` random rounds, round ``coordinates + j`` sends everything into bin j,
   so every coordinate is filled for certain. Two sketches agree in a coordinate with the
   probability of the sets' similarity, with concentration like independent min-hashes.
2. Equal sets collapse into classes by a 128-bit fingerprint, whatever their number.
3. ``ROWS`` coordinates make one band. Members of a bucket are compared with its least
   member only (their commonest pivot); classes that this links are contracted.
4. The members of buckets that still hold several components are searched again, by an
   index on their full sets: rarest shingles first, as many as a link has to meet in. No
   link is lost to the choice of pivots, and a family of documents that share a template
   without being near makes no candidates.
5. Links are confirmed on full sets throughout; components come from star contraction.

With 72 bands of 6 rows a pair at exactly 0.75 is missed with a chance below 1e-6.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatledger.llm.components import components, stored
from seatledger.llm.text import LOWERED, ROWS_AT_ONCE, blocks, mix, window_hashes, window_rows, word_hashes, word_spans
from seatledger.session import small_batches

WIDTH = 5
PERCENT = 75
BANDS, ROWS = 72, 6
_U = np.uint64


def shingle_sets(data: np.ndarray, borders: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, concatenated, and the rows' borders.

    A row with fewer words than ``width`` has its whole word sequence as its only shingle.
    """
    data = LOWERED[data]
    starts, ends, firsts = word_spans(data, borders)
    hashes = word_hashes(data, starts, ends)
    at, rows = window_rows(firsts, width, len(hashes))
    values = window_hashes(hashes, width)[at] if len(at) else np.zeros(0, _U)
    counts = np.diff(firsts)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = np.zeros(len(short), _U)
        for k in range(width - 1):
            there = counts[short] > k
            whole[there] = mix(whole[there] + hashes[firsts[short][there] + k] + _U(k + 1))
        values, rows = np.concatenate([values, whole]), np.concatenate([rows, short])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[fresh], rows[fresh]
    return values, np.searchsorted(rows, np.arange(len(borders)))


def sketches(values: np.ndarray, firsts: np.ndarray, coordinates: int) -> np.ndarray:
    """Fast similarity sketch of every row's set; rows without values keep unfilled bins."""
    n, t = len(firsts) - 1, coordinates
    rows = np.repeat(np.arange(n), np.diff(firsts))
    sketch = np.full(n * t, np.iinfo(np.uint64).max, _U)
    low = _U(0xFFFFFFFF)
    left = np.diff(firsts) > 0
    for i in range(2 * t):
        if not left.any():
            break
        live = left[rows]
        own, row = values[live], rows[live]
        h = mix(own + _U((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        bins = (((h >> _U(32)) * _U(t)) >> _U(32)).astype(np.int64) if i < t else i - t
        np.minimum.at(sketch, row * t + bins, (_U(i) << _U(32)) | (h & low))
        if i < 8 or i % 8 == 7 or i >= t:
            left &= (sketch.reshape(n, t) == np.iinfo(np.uint64).max).any(axis=1)
    return sketch.reshape(n, t)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(sketch), bands), _U) + np.arange(1, bands + 1, dtype=_U)
    for k in range(rows):
        keys = mix(keys * _U(0xD1342543DE82EF95) + sketch[:, k::rows][:, :bands])
    return keys


def fingerprints(values: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each row's set."""
    out = []
    for salt in (0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03):
        sums = np.zeros(len(values) + 1, _U)
        np.cumsum(mix(values ^ _U(salt)), out=sums[1:])
        out.append(mix(sums[firsts[1:]] - sums[firsts[:-1]]))
    return out[0], out[1]


def _signatures(width: int, bands: int, rows: int):
    kind = pa.struct([("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("keys", pa.list_(pa.int64()))])

    @F.arrow_udf("n bigint, f1 bigint, f2 bigint, keys array<bigint>")
    def signature(texts: pa.Array) -> pa.Array:
        parts = []
        for _, data, borders in blocks(texts, rows=ROWS_AT_ONCE):
            values, firsts = shingle_sets(data, borders, width)
            f1, f2 = fingerprints(values, firsts)
            n = np.diff(firsts)
            keys = band_keys(sketches(values, firsts, bands * rows), bands, rows)
            ends = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[n > 0].ravel().view(np.int64)))
            parts.append(
                pa.StructArray.from_arrays(
                    [pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), lists], fields=list(kind)
                )
            )
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return signature


def _full_sets(width: int):
    @F.arrow_udf("array<bigint>")
    def full_set(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.list_(pa.int64()))]
        for _, data, borders in blocks(texts, rows=ROWS_AT_ONCE):
            values, firsts = shingle_sets(data, borders, width)
            parts.append(pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(values.view(np.int64))))
        return pa.concat_arrays(parts)

    return full_set


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity. ``b`` is met by few pairs and
    gets its set first; a hot ``a`` is left to the join's splitting."""
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_right"))
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_left"))
    m, n = F.size("_left"), F.size("_right")
    joined = pairs.join(right, "b").where(F.size("_right") > 0).join(left, "a")
    near = joined.where((m * 100 >= n * percent) & (n * 100 >= m * percent))
    common = F.size(F.array_intersect("_left", "_right"))
    return near.withColumn("_common", common).where(F.col("_common") * 100 >= (m + n - F.col("_common")) * percent).select("a", "b")


def _first_pairs(buckets: DataFrame) -> DataFrame:
    """Each node with the pivot it shares most buckets with."""
    shared = buckets.where("node <> pivot").groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("_c"))
    best = F.max(F.struct("_c", (-F.col("pivot")).alias("_p")))
    return shared.groupBy("node").agg(best.alias("_best")).select((-F.col("_best._p")).alias("a"), F.col("node").alias("b"))


def _open_members(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (node, root) of the buckets that hold several components."""
    own = roots.withColumnRenamed("root", "_root")
    members = stored(buckets.join(own, "node", "left").select("key", "node", F.coalesce("_root", "node").alias("root")), "members")
    still = members.groupBy("key").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo < _hi")
    return members.join(still.select("key"), "key").select("node", "root").distinct()


def _cross_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) for near pairs between different components of ``members``.

    An index on the full sets. Shingles stand in one order for all sets: first those that a
    single component holds, then by the number of sets that hold them. A near pair shares a
    shingle among the first quarter (100 - percent) of the larger set and among the first
    seventh of the smaller, by the overlap that their sizes ask for. Sets of one template
    below the similarity have more than that of their own in front of the template's
    shingles, so such a family makes no pairs, whatever its size. Among the sets that meet at
    a shingle, those of the largest component are not compared with each other.
    """
    p = percent
    held = members.join(sets, "node").select("node", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    holders = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("_c"), F.min("root").alias("_lo"), F.max("root").alias("_hi"))
    # Counts are written before they are joined: a join that isn't planned with their aggregate can be split.
    holders = stored(holders.where("_lo < _hi").select("shingle", "_c"), "holders")
    shared = held.join(holders, "shingle")
    ranked = Window.partitionBy("node").orderBy("_c", "shingle")
    at = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("node")) + F.row_number().over(ranked) - 1
    front = shared.withColumn("at", at).where(f"at <= n - (n * {p} + 99) div 100")
    front = front.withColumn("early", F.expr(f"at <= n - (2 * {p} * n + {99 + p}) div {100 + p}"))
    entries = stored(front.select("shingle", "node", "root", "n", "at", "early"), "entries")

    parts = entries.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("_n"))
    largest = parts.groupBy("shingle").agg(F.max(F.struct("_n", "root")).alias("_top"), F.count(F.lit(1)).alias("_parts"))
    largest = stored(largest.where("_parts > 1").select("shingle", F.col("_top.root").alias("_main")), "largest")
    met = entries.join(largest, "shingle")
    met = stored(met.withColumn("minor", F.col("root") != F.col("_main")).drop("_main"), "met")
    x = met.where("early").select("shingle", *(F.col(c).alias(f"{c}_x") for c in ("node", "root", "n", "at", "minor")))
    y = met.select("shingle", *(F.col(c).alias(f"{c}_y") for c in ("node", "root", "n", "at", "minor")))
    smaller = F.struct("n_x", "node_x") < F.struct("n_y", "node_y")
    room = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))
    fits = (F.col("n_y") * p <= F.col("n_x") * 100) & (room * (100 + p) >= (F.col("n_x") + F.col("n_y")) * p)
    meeting = [x.where("minor_x").join(y, "shingle"), x.where("not minor_x").join(y.where("minor_y"), "shingle")]
    pairs = meeting[0].unionByName(meeting[1]).where((F.col("root_x") != F.col("root_y")) & smaller & fits)
    return pairs.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = WIDTH
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * common >= percent * union over their shingle sets.
    Null and empty texts, and texts of white space only, have an empty set and no links.
    A row without id has a null component, is linked with nothing and is kept. Rows that
    repeat an id follow their own text each. Other columns of ``docs`` are ignored; an
    empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signed = docs.select("doc_id", _signatures(width, BANDS, ROWS)("text").alias("_s"))
    signed = stored(signed.select("doc_id", "_s.*"), "signatures")
    known = signed.where("doc_id is not null and n > 0")
    classes = known.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"))
    first = classes.withColumnRenamed("rep", "doc_id")
    nodes = known.join(first, ["f1", "f2", "doc_id"], "left_semi").select(F.col("doc_id").alias("node"), "keys")
    banded = nodes.select("node", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("_last"))
    shared = shared.where("pivot < _last").select("key", "pivot")
    buckets = stored(banded.join(shared, "key").select("key", "node", "pivot"), "buckets")

    wanted = buckets.select(F.col("node").alias("doc_id")).distinct()
    sets = stored(
        docs.join(wanted, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), _full_sets(width)("text").alias("shingles")),
        "sets",
    )
    links = stored(_confirmed(_first_pairs(buckets), sets, percent), "links")
    roots = stored(components(links), "roots")

    open_ones = stored(_open_members(buckets, roots), "open")
    more = stored(_confirmed(_cross_pairs(open_ones, sets, percent), sets, percent), "links")
    if not more.isEmpty():
        joined = more.unionByName(links)
        roots = stored(components(joined), "roots")

    labels = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "f1", "f2", F.coalesce("root", "rep").alias("_root")
    )
    # Written first, so that the join below is a stage of its own and can be split where copies abound.
    labels = stored(labels, "labels")
    out = signed.select("doc_id", "n", *(F.when(F.col("n") > 0, F.col(c)).alias(c) for c in ("f1", "f2")))
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    settled = out.where(~alone).join(labels, ["f1", "f2"]).select("doc_id", "n", "_root")
    single = out.where(alone).select("doc_id", "n", F.col("doc_id").alias("_root"))
    return settled.unionByName(single).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("_root").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("_root"), F.lit(True)).alias("kept"),
    )


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, of one document in each group: its smallest id.

    Rows without id stay; of rows that repeat an id the one with the least text stays.
    """
    found = near_duplicates(docs).where("doc_id is not null and kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    found = stored(found.select(F.col("doc_id").alias("_kept"), "_n"), "kept")
    stay = docs.alias("d").join(found.alias("f"), F.col("d.doc_id").cast("bigint") == F.col("f._kept"), "left_semi")
    if not found.where("_n > 1").isEmpty():
        several = found.where("_n > 1").select(F.col("_kept").alias("_again"))
        again = stay.join(several, stay["doc_id"].cast("bigint") == several["_again"], "left_semi")
        once = stay.join(several, stay["doc_id"].cast("bigint") == several["_again"], "left_anti")
        # Of rows with the least text, any may stay: other columns have no order.
        least = again.groupBy(F.col("doc_id").alias("_id")).agg(F.min("text").alias("_text"))
        first = again.join(least, (again["doc_id"] == least["_id"]) & again["text"].eqNullSafe(least["_text"]), "left_semi")
        stay = once.unionByName(first.dropDuplicates(["doc_id"]))
    return stay.unionByName(docs.where("doc_id is null"))
