"""Operator 13 against plain versions of the hash, the fingerprint and the links."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import LOWER, words
from seatledger.llm import simhash


def plain_fingerprint(text):
    w = words((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """(id, fingerprint, least id reachable) of rows (id, fingerprint); null ids stay alone."""
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, f in rows:
        if i is not None:
            holders.setdefault(f, []).append(i)
    for f in holders:
        parent[f] = f
    marks = sorted(holders)
    for k, a in enumerate(marks):
        for b in marks[:k]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for f, ids in holders.items():
        least[find(f)] = min(least.get(find(f), ids[0]), *ids)
    return Counter((i, f"{f:016x}", None if i is None else least[find(f)]) for i, f in rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=150), max_size=30), st.integers(0, 2**32))
def test_hash_equals_the_library(pieces, seed):
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    got = simhash.xxh64(np.frombuffer(b"".join(pieces), np.uint8), ends - sizes, ends, seed)
    assert [int(h) for h in got] == [xxhash.xxh64_intdigest(p, seed) for p in pieces]


def test_edges_match_brute_force(spark, edge, empty):
    got = Counter(tuple(r) for r in simhash.simhash_near_duplicates(edge).collect())
    assert got == plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in edge.collect()])
    assert simhash.simhash_near_duplicates(empty).count() == 0
    assert simhash.simhash_near_duplicates(empty).columns == ["doc_id", "fingerprint", "component_id"]


def test_whole_documents_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = Counter(tuple(r) for r in simhash.simhash_near_duplicates(docs).collect())
    assert got == plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()])


def test_crowded_postings_are_split_without_loss(spark):
    """Families within a few bits, far over the limit of a posting, at every level of splitting."""
    rng = random.Random(5)
    marks = {rng.getrandbits(64) for _ in range(300)}
    for bits in (6, 12, 24, 40):
        centre = rng.getrandbits(64)
        spots = rng.sample(range(64), bits)
        for _ in range(250):
            marks.add(centre ^ sum(1 << p for p in rng.sample(spots, rng.randint(0, min(bits, 9)))))
    rows = [(k - (k >> 63 << 64),) for k in sorted(marks)]
    entries = spark.createDataFrame(rows, "fp bigint")
    from seatledger.llm.components import components

    for limit in (8, 64):
        links = simhash.linked_fingerprints(entries, limit)
        assert all(((r.a ^ r.b) & (1 << 64) - 1) for r in links.collect())
        roots = {r.node % (1 << 64): r.root % (1 << 64) for r in components(links).collect()}
        groups = {}
        for f in marks:
            groups.setdefault(roots.get(f, f), set()).add(f)
        parent = plain_components([(f, f) for f in marks])
        expected = {}
        for f, _, top in parent:
            expected.setdefault(top, set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_a_posting_gives_no_more_rows_than_entries():
    rng = random.Random(2)
    entries = np.array(sorted({rng.getrandbits(64) & 0x3FF for _ in range(900)}), np.uint64)
    root = simhash.posting_groups(entries)
    assert set(root) == {0} and len(root) == len(entries)


def test_masks_meet_every_pair():
    rng = random.Random(3)
    for _ in range(3000):
        differ = sum(1 << p for p in rng.sample(range(64), rng.randint(1, 3)))
        masks = [m for m in simhash.first_masks() if not m & differ]
        assert masks
        while masks and masks[0].bit_count() < 52:
            for m in masks:
                assert any(not w & differ for w in simhash.next_masks(m))
            masks = [w for w in simhash.next_masks(masks[0]) if not w & differ]
