"""Operator 11 against a trie built in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brute import words
from seatledger.llm import prefix_trie as trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, k1 string, range int, words int"


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(c - 20 * int(c / 20)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s, m in members.items():
        value = (len(m) - 1) * len(words(s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in children
            saved[s[:d]] += value
    out = Counter()
    for s, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if built[c] == s)
        parent = min(members[s[:-1]]) if s else None
        out[min(m), len(s), parent, len(m), children[s], leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def got(spark, rows, height):
    turns = spark.createDataFrame([(*r, 1, "k", 2, 3) for r in rows], SCHEMA)
    nodes, ends = trie.prefix_trie(turns, height)
    joined = nodes.join(trie.end_digests(ends), ["conv_id", "depth"], "left")
    digest = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    return Counter(
        tuple(r) for r in joined.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest
        ).collect()
    )


@pytest.mark.parametrize("height", [2, 3, 16])
def test_random_conversations(spark, height):
    rng = random.Random(height)
    rows = []
    for c in [*range(0, 130), -40, -37, -3, 10**12]:
        if c % 17:
            rows += [(c, t, rng.choice(["user", None]), rng.choice(["a b", "a", " \t", None, "c d e"])) for t in range(rng.choice([1, 2, 3, 9, 20]))]
    rng.shuffle(rows)
    assert got(spark, rows, height) == plain(rows)


def test_edges(spark):
    rows = [
        (1, None, "user", "x"), (1, 0, None, None), (1, 0, "user", "y"), (1, 0, "user", "y"), (1, None, "user", "x"),
        (None, 0, "user", "x"), (None, None, None, None), (20, 5, "user", "first turn"), (21, 5, "user", "first turn"),
        (23, 1, "user", "only"), (24, 1, "user", "only"), (25, 1, "user", "only"), (26, 1, "user", "only"),
        (80, 0, "user", "word " * 50_000), (81, 0, "user", "word " * 50_000),
    ]
    assert got(spark, rows, 16) == plain(rows)
    assert got(spark, [], 16) == Counter()
    assert got(spark, [(None, 1, "a", "b")], 16) == Counter()
    assert got(spark, [(23, 1, "user", "only")], 16) == plain([(23, 1, "user", "only")])


def test_one_conversation_with_most_turns(spark):
    """A long conversation crosses ranges and bands; another ends in its middle."""
    rows = [(7, None if t < 3 else t // 2, "user", f"turn {t // 4}") for t in range(1_500)]
    rows += [(140, t, "user", "same") for t in range(300)] + [(c, t, "user", "same") for c in range(141, 200) for t in range(40)]
    for height in (4, 16):
        assert got(spark, rows, height) == plain(rows)


def test_digest_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_IDS", 3)
    ends = spark.range(1000).select((F.col("id") % 2 * 5).alias("conv_id"), (F.col("id") % 3).alias("depth"), F.col("id").alias("end_conv_id"))
    expected = {}
    for k in range(1000):
        expected.setdefault((k % 2 * 5, k % 3), []).append(str(k))
    found = {(r.conv_id, r.depth): r.ends_sha256 for r in trie.end_digests(ends).collect()}
    assert found == {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in expected.items()}
