"""Words and rolling hashes shared by the operators.

A word is a maximal run without the six ASCII white-space bytes; lower-casing touches A-Z
only. Both work on UTF-8 bytes, so whole Arrow columns are hashed with a few numpy passes
instead of one Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes hashed at a time; longer texts are taken in pieces that end at white space.
PIECE = 1 << 20

#: Rows taken at a time where each costs memory of its own, however short its text.
ROWS_AT_ONCE = 1000

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses modulo 2**64
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WINDOW = _U(0xD1342543DE82EF95)
IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACE.encode(), np.uint8))
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; texts of ASCII alone take the quick way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (one-to-one)."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        _POWERS["up"], _POWERS["down"] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _POWERS["up"], _POWERS["down"]


def byte_column(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and the borders of the rows; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, borders, data = texts.buffers()
    borders = np.frombuffer(borders, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def blocks(texts: pa.Array, size: int = PIECE, rows: int | None = None) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``size`` bytes, at most ``rows``: their slice, bytes and borders."""
    data, borders = byte_column(texts)
    lo = 0
    while lo < len(borders) - 1:
        hi = max(lo + 1, int(np.searchsorted(borders, borders[lo] + size, "right")) - 1)
        hi = min(hi, lo + rows) if rows else hi
        yield slice(lo, hi), data[borders[lo] : borders[hi]], borders[lo : hi + 1] - borders[lo]
        lo = hi


def word_spans(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of each row (with a closing entry)."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(IS_SPACE[data], out=inside[1:-1])
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cut = borders[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    starts[cut] = inside[cut + 1]  # a row's first byte starts a word whatever stands before it
    ends[cut - 1] = inside[cut]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, borders)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: a polynomial in its bytes, by prefix sums, then mixed."""
    out = np.empty(len(starts), _U)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + PIECE, "right")))
        first, last = starts[lo], ends[hi - 1]
        up, down = _power_table(int(last - first) + 1)
        sums = np.zeros(last - first + 1, _U)
        np.cumsum((data[first:last].astype(_U) + _U(1)) * up[: last - first], out=sums[1:])
        a, b = starts[lo:hi] - first, ends[lo:hi] - first
        out[lo:hi] = mix((sums[b] - sums[a]) * down[a])
        lo = hi
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive words, as if all words were one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    up, down = _power_table(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, _U)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[width:] - sums[:n]) * down[:n] * _WINDOW)


def window_rows(firsts: np.ndarray, width: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the windows that lie inside one row, and the row of each."""
    counts = np.diff(firsts)
    rows = np.repeat(np.arange(len(counts)), np.maximum(counts - width + 1, 0))
    before = np.concatenate([[0], np.cumsum(np.maximum(counts - width + 1, 0))[:-1]])
    at = np.arange(len(rows)) - before[rows] + firsts[:-1][rows] if len(rows) else np.zeros(0, np.int64)
    return at, rows
