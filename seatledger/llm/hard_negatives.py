"""Operator 12: hard negatives from anchor-clustered shared lists with certified early ends.

Anchors close to each other share one list: for a cluster with centroid c and largest
angle t to a member, a candidate v reaches at most |u| |v| cos(max(0, angle(v, c) - t))
with any member u. Candidates are sorted by that bound once for each cluster; members walk
the list together and leave it as soon as the bound falls below what they still need.
The bound is proven, so every answer is exact and recall is 1 whatever the clusters;
only the clusters' centroids come from a bounded sample.

Candidates lie in blocks of a bounded number of rows, dealt by a hash of their id inside
each label, so a label with a third of all rows is simply more blocks. Anchors come in
parts of bounded size. A task meets one block with one part: it holds both, and returns at
most the wanted number of rows for each anchor of the part. Positives look only into
blocks of their own label and are settled first; their scores are the borders between
which negatives are looked for, so that the second walk starts with a known end.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatledger.llm.components import stored

STEP = 50
SCALE = 256
LABELS = 10
POSITIVES, NEGATIVES = 5, 3
LOWEST, HIGHEST = 50, 95

#: Most rows of a block of candidates and of a part of anchors, and most bytes of either: they bound a task's memory.
BLOCK, PART, HELD = 16_384, 8_192, 32 << 20
#: Members that walk together, whatever the size of their cluster.
TOGETHER = 512
#: Anchors that fit the centroids, members of a cluster on average, and the most clusters.
SAMPLE, MEMBERS, CLUSTERS = 4_096, 64, 256

_FAR = (1 << 63) - 1


def quantised(vectors: np.ndarray) -> np.ndarray:
    """Components as whole numbers, exact in double precision."""
    return np.floor(SCALE * np.clip(vectors.astype(np.float64), -1e300, 1e300))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Quantised rows, filled up with zeros to ``width`` components."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return quantised(flat.reshape(len(sizes), width))
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - (np.cumsum(sizes) - sizes)[rows]] = flat
    return quantised(out)


def _width(*lists: pa.Array) -> int:
    return max([0, *(int(x.value_lengths().to_numpy(zero_copy_only=False).max()) for x in lists if len(x))])


def angles(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angle of every row to ``centre``; rows of length zero have none and count as zero."""
    lengths = np.linalg.norm(rows, axis=1) * np.linalg.norm(centre)
    cosine = np.divide(rows @ centre, lengths, out=np.ones(len(rows)), where=lengths > 0)
    return np.arccos(np.clip(cosine, -1, 1))


def cluster_bounds(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """The most that any anchor of unit length can score with each candidate."""
    lengths = np.linalg.norm(anchors, axis=1, keepdims=True)
    centre = np.divide(anchors, lengths, out=np.zeros_like(anchors), where=lengths > 0).mean(axis=0)
    reach = angles(anchors, centre).max() if centre.any() else np.pi
    between = np.maximum(angles(candidates, centre) - reach, 0) if centre.any() else np.zeros(len(candidates))
    # Rounding errors of the angles are far below the added margin.
    return np.linalg.norm(candidates, axis=1) * (np.cos(between) + 1e-6)


def shared_walk(
    anchors: np.ndarray, own: np.ndarray, lower: np.ndarray, upper: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """The first ``k`` candidates of every question, by score and then by smaller id.

    ``lower`` and ``upper`` (Python integers) hold one question in each column: whole scores
    that an answer must keep to. The candidate whose id is the anchor's ``own`` never answers.
    ``candidates`` are in ascending order of ``ids``. Returns anchor, question, candidate
    and score of all answers.
    """
    n, questions = lower.shape
    base = 1 << max(1, len(ids)).bit_length()
    # A score and an id make one number, so that no two candidates tie. Numbers beyond double
    # precision are Python's, and have no bound that could end a walk early.
    exact = (np.abs(anchors).sum(axis=1).max() * np.abs(candidates).max(initial=0) + 2) * base < 2**52
    lengths = np.linalg.norm(anchors, axis=1) if exact else np.ones(n)
    bounds = cluster_bounds(anchors, candidates) if exact else np.full(len(ids), np.inf)
    listed = np.argsort(-bounds, kind="stable")
    kind = np.float64 if exact else object
    whole = (lambda x: x) if exact else (lambda x: np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape))
    left, right = whole(anchors * 1.0), whole(candidates)
    edge = 2**52 if exact else 1 << 200
    # The outermost long stands for no border at all.
    floor = np.where(lower <= -_FAR, -edge, np.clip(lower * base, -edge, edge)).astype(kind)
    ceiling = np.where(upper >= _FAR, edge, np.clip(upper * base + (base - 1), -edge, edge)).astype(kind)
    tie = np.array([base - 1 - r for r in range(len(ids))], dtype=kind)
    best = [np.zeros((0, 3), dtype=kind) for _ in range(questions)]
    need = floor.copy()
    active = np.flatnonzero((floor <= ceiling).any(axis=1))
    at, step = 0, 64
    while at < len(listed) and len(active):
        chunk = listed[at : at + step]
        keys = (left[active] @ right[chunk].T) * base + tie[chunk]
        keys[own[active][:, None] == ids[chunk][None, :]] = -2 * edge
        for q in range(questions):
            hit = (keys >= need[active, q][:, None]) & (keys <= ceiling[active, q][:, None])
            a, c = np.nonzero(hit)
            if not len(a):
                continue
            fresh = np.empty((len(a), 3), dtype=kind)
            fresh[:, 0], fresh[:, 1], fresh[:, 2] = active[a], chunk[c], keys[a, c]
            both = np.concatenate([best[q], fresh])
            both = both[np.argsort(-both[:, 2], kind="stable")]
            both = both[np.argsort(both[:, 0].astype(np.int64), kind="stable")]
            row = both[:, 0].astype(np.int64)
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            best[q] = both[rank < k]
            full = rank == k - 1
            need[row[full], q] = both[full, 2]
        at, step = at + step, min(2 * step, 4096)
        if at < len(listed):
            still = (bounds[listed[at]] * lengths[active] + 1)[:, None] * base >= need[active].astype(np.float64)
            active = active[(still & (need[active] <= ceiling[active])).any(axis=1)]
    found = [(x[:, 0].astype(np.int64), np.full(len(x), q), x[:, 1].astype(np.int64), x[:, 2]) for q, x in enumerate(best)]
    row, question, at, keys = (np.concatenate(parts) for parts in zip(*found))
    return row, question, at, [min(max(int(v) // base, -_FAR), _FAR) for v in keys]


def _spherical_centres(rows: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centroids of ``count`` clusters of unit rows, seeded by rows far from each other."""
    picked, nearest = [0], rows @ rows[0]
    while len(picked) < min(count, len(rows)):
        picked.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[picked[-1]])
    centres = rows[picked]
    for _ in range(rounds):
        owner = np.argmax(rows @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, rows)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(lengths > 0, sums / np.maximum(lengths, 1e-300), centres)
    return centres


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def _fit_centres(anchors: DataFrame, total: int) -> np.ndarray:
    """Centroids from at most ``SAMPLE`` anchors, chosen by a hash of their id."""
    sample = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
    if not len(sample):
        return np.zeros((1, 0))
    return _spherical_centres(_unit(_matrix(sample, _width(sample))), min(CLUSTERS, -(-total // MEMBERS)))


def _nearest_centre(centres: np.ndarray, vector: Column) -> Column:
    @F.arrow_udf("int")
    def nearest(lists: pa.Array) -> pa.Array:
        rows = _unit(_matrix(lists, max(_width(lists), centres.shape[1])))
        scores = rows[:, : centres.shape[1]] @ centres.T
        return pa.array(np.argmax(scores, axis=1).astype(np.int32))

    return nearest(vector)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, embedding`` of the rows that take part, one for each id, labels shifted."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull()).where(finite)
    label = F.col(label_col).cast("bigint")
    one = rows.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.when(F.col(id_col).cast("bigint") % 7 == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        x.alias("embedding"),
    )
    repeated = one.groupBy("vec_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("vec_id")
    first = one.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("_r"))
    return one.join(repeated, "vec_id", "left_anti").unionByName(first.select("vec_id", "_r.*"))


def _dealt(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a number inside their label, about ``size`` rows each, and the (label, number) there are."""
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    shares = stored(counts.select("label", F.ceil(F.col("_n") / size).cast("int").alias("_shares")), "shares")
    number = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.col("_shares")).cast("int")
    each = shares.select("label", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias(name))
    return rows.join(shares, "label").withColumn(name, number).drop("_shares"), each


_FOUND = "anchor_id bigint, question int, vec_id bigint, score bigint"
_MEETING = ["label", "block", "part"]


def _meeting(k: int) -> Callable[[pa.Table], pa.Table]:
    """Task over one block and one part: every cluster of the part walks its own list of the block."""

    def meet(group: pa.Table) -> pa.Table:
        isnt = group.column("lower").combine_chunks().is_null().to_numpy(zero_copy_only=False)
        block, part = group.filter(pa.array(isnt)), group.filter(pa.array(~isnt))
        out = [[], [], [], []]
        if block.num_rows and part.num_rows:
            block = block.sort_by("vec_id")
            lists = [t.column("embedding").combine_chunks() for t in (block, part)]
            width = _width(*lists)
            candidates, anchors = (_matrix(x, width) for x in lists)
            ids, own = block.column("vec_id").to_numpy(), part.column("vec_id").to_numpy()
            lower, upper = (
                np.array(part.column(c).to_pylist(), dtype=object).reshape(part.num_rows, -1) for c in ("lower", "upper")
            )
            cluster = part.column("cluster").to_numpy()
            members = np.argsort(cluster, kind="stable")
            cuts = np.flatnonzero(np.diff(cluster[members])) + 1
            for walkers in np.split(members, cuts):
                for rows in np.split(walkers, range(TOGETHER, len(walkers), TOGETHER)):
                    a, q, at, score = shared_walk(anchors[rows], own[rows], lower[rows], upper[rows], candidates, ids, k)
                    for column, values in zip(out, (own[rows][a], q, ids[at], score)):
                        column.extend(values)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(x, t) for x, t in zip(out, kinds)], names=["anchor_id", "question", "vec_id", "score"])

    return meet


def _met(candidates: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """The first k candidates of every question; both frames name the meetings they go to."""
    none = F.lit(None).cast("array<bigint>")
    left = candidates.select(*_MEETING, "vec_id", "embedding", F.lit(0).alias("cluster"), none.alias("lower"), none.alias("upper"))
    right = anchors.select(*_MEETING, "vec_id", "embedding", "cluster", "lower", "upper")
    met = left.unionByName(right).groupBy(*_MEETING).applyInArrow(_meeting(k), _FOUND)
    order = Window.partitionBy("anchor_id", "question").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    step: int = STEP, positives: int = POSITIVES, negatives: int = NEGATIVES, block: int = BLOCK, part: int = PART,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows with a null id, label or vector, or a null or non-finite component, take no part.
    Of rows that repeat an id the least (label, vector) stands for it. Where vectors differ
    in length, missing components are zero; an empty vector scores zero. Scores beyond
    64 bits are held at the largest one. Ties go to the smaller id. An anchor without
    positives, or a positive without negatives between its borders, gives no row, and so
    does an empty table. Other columns are ignored.
    """
    rows = stored(usable(vectors, id_col, vector_col, label_col), "vectors")
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 1
    block, part = (max(1, min(size, HELD // (8 * width))) for size in (block, part))
    candidates, blocks = _dealt(rows, block, "block")
    candidates = stored(candidates, "blocks")
    chosen = rows.where(F.col("vec_id") % step == 0)
    total = chosen.count()
    anchors, parts = _dealt(chosen, part, "part")
    anchors = stored(anchors.withColumn("cluster", _nearest_centre(_fit_centres(chosen, total), F.col("embedding"))), "anchors")

    # Positives: the parts and blocks of one label meet. One row of ``own`` stands for a meeting.
    own = blocks.join(parts, "label")
    free = [F.array(F.lit(x).cast("bigint")).alias(c) for x, c in ((-_FAR, "lower"), (_FAR, "upper"))]
    asking = anchors.join(own, ["label", "part"]).select(*_MEETING, "vec_id", "embedding", "cluster", *free)
    close = stored(_met(candidates.join(own, ["label", "block"]), asking, positives), "positives")

    # 50 p <= 100 n <= 95 p in whole numbers; a negative p leaves nothing between them.
    p = F.col("score").cast("decimal(22,0)")
    lower, upper = F.ceil(p * LOWEST / 100).cast("bigint"), F.floor(p * HIGHEST / 100).cast("bigint")
    own_order = F.sort_array(F.collect_list(F.struct("rank", lower.alias("l"), upper.alias("u"))))
    wanted = close.groupBy("anchor_id").agg(own_order.alias("_q"))
    # Every anchor has as many questions; one without a positive asks for scores from 1 to 0.
    borders = [
        F.array(*(F.coalesce(F.get(f"_q.{c}", F.lit(i)), F.lit(none).cast("bigint")) for i in range(positives))).alias(name)
        for c, none, name in (("l", 1, "lower"), ("u", 0, "upper"))
    ]
    # Negatives: every block meets every part, now over all labels, but for anchors of its own label.
    lots = max(1, -(-total // part))
    lot = F.pmod(F.xxhash64("vec_id", F.lit(13)), F.lit(lots)).cast("int")
    every = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    told = anchors.join(wanted.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select(
        F.col("label").alias("_own"), lot.alias("part"), "vec_id", "embedding", "cluster", *borders
    )
    asking = told.join(every, "part").where(F.col("_own") != F.col("label"))
    found = _met(candidates.join(every, ["label", "block"]), asking, negatives)
    named = close.select(
        "anchor_id", (F.col("rank") - 1).alias("question"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return found.join(named, ["anchor_id", "question"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
