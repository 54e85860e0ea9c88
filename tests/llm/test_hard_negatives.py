"""Operator 12 against all pairs."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from seatledger.llm import hard_negatives as hn

SCHEMA = "label int, vec_id bigint, embedding array<double>, cluster int, block string, _n int, lower int"


def plain(rows, step=50):
    best = {}
    for label, i, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        best[i] = min(best.get(i, (label, v)), (label, v))
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in best.items()}
    out = Counter()
    for a, (label, u) in q.items():
        if a % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(u, w)), i, other) for i, (other, w) in q.items() if i != a)
        for s, p, _ in [t for t in scored if t[2] == label][:5]:
            fits = [t for t in scored if t[2] != label and 50 * -s <= 100 * -t[0] <= 95 * -s]
            for rank, (n, i, _) in enumerate(fits[:3], 1):
                out[a, p, rank, i, -s, -n] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(label, i, v, 7, "x", 1, 2) for label, i, v in rows], SCHEMA)


def result(df):
    return Counter(tuple(r) for r in df.collect())


def clustered(rng, n, dims=6, labels=3):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    return [(rng.randrange(labels), i, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("block,part", [(16_384, 8_192), (37, 3)])
def test_random_vectors_match_all_pairs(spark, block, part):
    rows = clustered(random.Random(block), 700)
    assert result(hn.hard_negatives(frame(spark, rows), step=5, block=block, part=part)) == plain(rows, 5)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(4)
    same = [1.0, 0.5, -0.25]
    rows = clustered(rng, 120, 3) + [(1, 200 + k, same) for k in range(60)] + [(2, 300 + k, [0.9 * x for x in same]) for k in range(60)]
    rows += [
        (None, 400, same), (1, None, same), (1, 401, None), (1, 402, [1.0, None]), (1, 450, [nan, 1.0]), (1, 403, [inf]),
        (1, 404, []), (2, 500, [0.0, 0.0, 0.0]), (3, 550, [-1.0, -1.0, -1.0]), (1, 405, [1.0]), (1, 406, [1.0, 0.5, -0.25, 9.0]),
        *[rows[0]] * 3, (2, 50, [3.0, 1.0, 1.0]), (2, 50, [1.0, 1.0, 1.0]),
    ]
    for block in (16_384, 11):
        assert result(hn.hard_negatives(frame(spark, rows), step=10, block=block, part=block)) == plain(rows, 10)
    none = hn.hard_negatives(frame(spark, []))
    assert none.count() == 0
    assert none.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    alone = frame(spark, [(1, 0, same), (2, 1, same)])
    assert hn.hard_negatives(alone).count() == 0


def test_numbers_beyond_double_precision(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(2), i, [rng.uniform(1e5, 3e5) * 2**k for k in (0, 3, 5)]) for i in range(80)]
    got = result(hn.hard_negatives(frame(spark, rows), step=10))
    assert got == plain(rows, 10) and got


def test_walks_end_early_and_stay_exact():
    """Members of a narrow cluster leave the list once the bound certifies their answers."""
    rng = np.random.default_rng(1)
    far = rng.normal(size=(20_000, 8)) * 64
    centre = np.full(8, 90.0)
    anchors = np.floor(centre + rng.normal(size=(20, 8)))
    candidates = np.floor(np.concatenate([far, centre + rng.normal(size=(200, 8)) * 4]))
    ids = np.arange(len(candidates))
    bounds = hn.cluster_bounds(anchors, candidates)
    assert (anchors @ candidates.T <= np.linalg.norm(anchors, axis=1)[:, None] * bounds[None, :] + 1e-6).all()
    free = np.full((20, 1), -(2**63) + 1, dtype=object), np.full((20, 1), 2**63 - 1, dtype=object)
    seen = []
    original = np.nonzero
    try:
        np.nonzero = lambda hit: (seen.append(hit.shape), original(hit))[1]
        a, q, at, score = hn.shared_walk(anchors, np.full(20, -1), *free, candidates, ids, 5)
    finally:
        np.nonzero = original
    assert sum(math.prod(s) for s in seen if len(s) == 2) < 0.2 * anchors.shape[0] * len(candidates)
    exact = anchors @ candidates.T
    for k in range(20):
        order = np.lexsort((ids, -exact[k]))[:5]
        assert sorted(at[a == k]) == sorted(order)
    assert score == [int(exact[x, y]) for x, y in zip(a, at)]
