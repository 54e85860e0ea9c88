"""Operator 13: SimHash near duplicates by a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Fingerprints that differ in at most three bits
differ in at most three bytes, so a pair shares at least ``SHARED`` = 5 positional bytes.

1. Equal fingerprints collapse into one entry, whatever their number.
2. The index is keyed by three positional bytes at a time. Any five of the eight positions
   hold three of the first four or three of the last four, so eight keys for an entry meet
   every pair that reaches the minimum, while a posting holds 2**-24 of the entries
   instead of the 1/256 of a single byte.
3. A posting with more than ``LIMIT`` entries is split by further bytes, then half bytes,
   that a link must share: of those left, one among the first four always is. When only 12
   bits are free a posting can't hold more than 4,096 entries, so every posting ends
   bounded and none is dropped.
4. Inside a posting the shared positional bytes of each pair are tallied; pairs that reach
   the minimum are verified by their differing bits. A posting gives one row for each
   linked entry, to the least of its group, and so never more rows than entries.
5. Components come from star contraction over the entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatledger.llm.components import components, stored
from seatledger.llm.text import IS_SPACE, LOWERED, PIECE, blocks, word_spans

WIDTH = 3
BITS = 3
SHARED = 8 - BITS
LIMIT = 4096
SEED = 42

_U = np.uint64
#: The five primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    _U(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
    )
)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(state + lane * _P2, 31) * _P1


def _xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.array(np.ndarray(len(data) + 1, "<u8", padded, strides=(1,)))
    at, sizes = starts.copy(), (ends - starts).astype(_U)
    h = np.full(len(starts), _U(seed) + _P5)
    wide = np.flatnonzero(sizes >= 32)
    if len(wide):
        first = np.array([seed], _U)
        state = [np.repeat(s, len(wide)) for s in (first + _P1 + _P2, first + _P2, first, first - _P1)]
        stripes = (ends - starts)[wide] // 32
        live = np.arange(len(wide))
        for s in range(int(stripes.max())):
            live = live[stripes[live] > s]
            for k in range(4):
                state[k][live] = _round(state[k][live], lanes[starts[wide[live]] + 32 * s + 8 * k])
        joined = _turn(state[0], 1) + _turn(state[1], 7) + _turn(state[2], 12) + _turn(state[3], 18)
        for part in state:
            joined = (joined ^ _round(np.zeros_like(part), part)) * _P1 + _P4
        h[wide] = joined
        at[wide] += 32 * stripes
    h += sizes
    live = np.flatnonzero(ends - at >= 8)
    while len(live):
        h[live] = _turn(h[live] ^ _round(np.zeros(len(live), _U), lanes[at[live]]), 27) * _P1 + _P4
        at[live] += 8
        live = live[ends[live] - at[live] >= 8]
    live = np.flatnonzero(ends - at >= 4)
    h[live] = _turn(h[live] ^ (lanes[at[live]] & _U(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
    at[live] += 4
    live = np.flatnonzero(ends > at)
    while len(live):
        h[live] = _turn(h[live] ^ (lanes[at[live]] & _U(0xFF)) * _P5, 11) * _P1
        at[live] += 1
        live = live[ends[live] > at[live]]
    h = (h ^ (h >> _U(33))) * _P2
    h = (h ^ (h >> _U(29))) * _P3
    return h ^ (h >> _U(32))


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many byte ranges with ascending starts and ends, about ``PIECE`` bytes at a time."""
    out = np.empty(len(starts), _U)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + PIECE, "right")))
        first = starts[lo]
        out[lo:hi] = _xxh64(data[first : ends[hi - 1]], starts[lo:hi] - first, ends[lo:hi] - first, seed)
        lo = hi
    return out


def _majority(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Bits set in over half of the hashes of each row; rows without hashes are zero.

    Four counters of 16 bits share a number; a step has too few hashes to overflow one.
    """
    counts = np.diff(firsts)
    sums = np.zeros((len(counts), 64), np.int64)
    step, lanes = (1 << 16) - 1, _U(0x0001000100010001)
    for lo in range(0, len(hashes), step):
        part = hashes[lo : lo + step]
        cuts = np.clip(firsts, lo, lo + len(part)) - lo
        rows = np.flatnonzero(np.diff(cuts))
        upto = np.zeros(len(part) + 1, _U)
        for k in range(16):
            np.cumsum((part >> _U(k)) & lanes, out=upto[1:])
            four = upto[cuts[rows + 1]] - upto[cuts[rows]]
            for j in range(4):
                sums[rows, k + 16 * j] += ((four >> _U(16 * j)) & _U(0xFFFF)).astype(np.int64)
    return np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(data: np.ndarray, borders: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Fingerprint of every row of a byte column."""
    data = LOWERED[data]
    starts, ends, firsts = word_spans(data, borders)
    # The words of all rows with one space behind each: shingles are byte ranges of that.
    sizes = ends - starts
    after = np.cumsum(sizes + 1)
    joined = np.full(int(after[-1]) if len(after) else 0, 32, np.uint8)
    letters = np.ones(len(joined), bool)
    letters[after - 1] = False
    joined[letters] = data[~IS_SPACE[data]]
    words = np.diff(firsts)
    own = np.where(words > 0, np.maximum(words - width + 1, 1), 0)
    edges = np.concatenate([[0], np.cumsum(own)])
    rows = np.repeat(np.arange(len(own)), own)
    begin = np.arange(edges[-1]) - edges[rows] + firsts[rows]
    last = np.minimum(begin + width, firsts[rows + 1]) - 1
    return _majority(xxh64(joined, (after - sizes - 1)[begin], after[last] - 1), edges)


def simhash(text: Column, width: int = WIDTH) -> Column:
    """64-bit SimHash of a whole text as a long; null counts as empty."""

    @F.arrow_udf("bigint")
    def sign(texts: pa.Array) -> pa.Array:
        parts = [fingerprints(data, borders, width) for _, data, borders in blocks(texts)]
        return pa.array(np.concatenate([np.zeros(0, _U), *parts]).view(np.int64))

    return sign(text)


def _near(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Matrix of links: tally the shared positional bytes, verify the pairs that share enough."""
    differ = np.bitwise_xor.outer(left, right)
    tally = np.zeros(differ.shape, np.int8)
    for k in range(8):
        tally += (differ & _U(0xFF << 8 * k)) == 0
    near = tally >= SHARED
    near[near] = np.bitwise_count(differ[near]) <= BITS
    return near


def posting_groups(entries: np.ndarray) -> np.ndarray:
    """Position of the least entry that each entry of one sorted posting is connected with."""
    n = len(entries)
    root = np.arange(n)
    todo = np.arange(n)
    while len(todo):
        group, todo = todo[:1], todo[1:]
        edge = group
        while len(edge) and len(todo):
            hit = _near(entries[edge[:256]], entries[todo]).any(axis=0)
            edge = np.concatenate([edge[256:], todo[hit]])
            root[todo[hit]] = group[0]
            todo = todo[~hit]
    return root


def _posting_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        entries = lists.flatten().to_numpy().view(_U)
        sizes = lists.value_lengths().to_numpy()
        firsts = np.cumsum(sizes) - sizes
        a, b = [np.zeros(0, _U)], [np.zeros(0, _U)]
        pairs = firsts[sizes == 2]
        near = np.bitwise_count(entries[pairs] ^ entries[pairs + 1]) <= BITS
        a.append(entries[pairs[near]])
        b.append(entries[pairs[near] + 1])
        for k in np.flatnonzero(sizes > 2):
            own = np.sort(entries[firsts[k] : firsts[k] + sizes[k]])
            root = posting_groups(own)
            tied = root != np.arange(len(own))
            a.append(own[root[tied]])
            b.append(own[tied])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
        )


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def first_masks() -> list[int]:
    """Three positions of the lower or of the upper four bytes."""
    half = [sum(0xFF << 8 * k for k in range(4) if k != left) for left in range(4)]
    return [m << shift for m in half for shift in (0, 32)]


def next_masks(mask: int) -> list[int]:
    """Masks with one more unit, such that a link inside the posting of ``mask`` keeps to one of them.

    Below five bytes the unit is a byte: with u bytes free, a link shares at least u - 3 of
    them, so of any four it shares one. Then it is a half byte, with at most three unlike.
    """
    width = 8 if mask.bit_count() < 8 * SHARED else 4
    unit = (1 << width) - 1
    free = [k for k in range(0, 64, width) if not mask >> k & unit]
    return [mask | unit << k for k in free[: BITS + 1]]


def linked_fingerprints(entries: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column ``fp``) with their near ones."""
    masks = first_masks()
    rows = entries.select("fp", F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("mask"))
    found = []
    while True:
        rows = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
        sizes = stored(rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "postings")
        final = masks[0].bit_count() >= 52
        small = rows.join(sizes if final else sizes.where(F.col("n") <= limit), ["mask", "value"])
        posting = small.groupBy("mask", "value").agg(F.collect_list("fp").alias("fps"))
        found.append(stored(posting.select("fps").mapInArrow(_posting_links, "a bigint, b bigint"), "links"))
        large = sizes.where(F.col("n") > limit)
        if final or large.isEmpty():
            return reduce(DataFrame.unionByName, found).distinct()
        wider = F.create_map(*(
            x for m in masks for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(w)) for w in next_masks(m))))
        ))
        again = rows.join(large, ["mask", "value"]).select("fp", F.explode(wider[F.col("mask")]).alias("mask"))
        rows = stored(again.distinct(), "split")
        masks = sorted({w for m in masks for w in next_masks(m)})


def simhash_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, limit: int = LIMIT
) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` has 16 hex digits; ``component_id`` is the least doc_id reachable over
    fingerprints that differ in at most three bits. Texts that are null, empty or white
    space only have fingerprint zero and link like any other; texts of fewer words than
    ``width`` have their whole word sequence as one shingle. A row without id gets a
    fingerprint and a null component, and links nothing. Rows that repeat an id follow
    their own text each. Other columns are ignored; an empty table gives an empty result.
    """
    signed = stored(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), simhash(F.col(text_col), width).alias("fp")), "signed")
    entries = stored(signed.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least")), "entries")
    roots = stored(components(linked_fingerprints(entries, limit)), "roots")
    owned = entries.join(roots.withColumnRenamed("node", "fp"), "fp").select("fp", "root", "least")
    groups = owned.groupBy("root").agg(F.min("least").alias("component_id"))
    tied = roots.join(groups, "root").select(F.col("node").alias("fp"), "component_id")
    labels = entries.join(tied, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    named = signed.join(stored(labels, "labels"), "fp", "left")
    return named.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
