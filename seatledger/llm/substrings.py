"""Operator 10: remove passages that an earlier document already has.

Every 13-word window of a text has a Rabin-Karp hash. The windows are counted in Spark:
each map task keeps, for every hash of a block of texts, the least document that holds it
and packs (hash, document) into arrays, one row for each bucket of hashes. That combine
bounds what a window found in a third of all documents sends, and packing costs 8 bytes a
window and no row overhead. A bucket finds the hashes with several documents and sends the hashes
that each later document must drop on to a bucket of documents, packed again; those marks
meet the texts by doc_id, where overlapping windows merge into maximal intervals.

Occurrences that lose already inside their block are known to go and travel as marks,
dealt over the buckets in turn, so they gather nowhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatledger.llm.text import blocks, mix, window_hashes, window_rows, word_hashes, word_spans

WIDTH = 13
#: Bytes of text whose windows share a bucket; a bucket is sorted in one task's memory.
BUCKET_BYTES = 16 << 20

_U = np.uint64
_ENTRIES = pa.schema(
    [("bucket", pa.int32()), ("marks", pa.bool_()), ("docs", pa.list_(pa.int64())), ("runs", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64()))]
)
_MARKS = pa.schema([("doc_id", pa.int64()), ("gone", pa.list_(pa.int64()))])


def _runs(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run-length form of document ids."""
    at = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if len(docs) else np.zeros(0, np.int64)
    return docs[at], np.diff(np.concatenate([at, [len(docs)]]))


def _least(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Split occurrences into the least document of each hash and the rest; one per (hash, document)."""
    order = np.lexsort((docs, hashes))
    h, d = hashes[order], docs[order]
    new_hash = np.ones(len(h), bool)
    new_hash[1:] = h[1:] != h[:-1]
    new_pair = new_hash.copy()
    new_pair[1:] |= d[1:] != d[:-1]
    rest = new_pair & ~new_hash
    return h[new_hash], d[new_hash], h[rest], d[rest]


def _windows(data: np.ndarray, borders: np.ndarray, width: int):
    starts, ends, firsts = word_spans(data, borders)
    hashes = word_hashes(data, starts, ends)
    at, rows = window_rows(firsts, width, len(hashes))
    return window_hashes(hashes, width)[at] if len(at) else np.zeros(0, _U), at, rows, starts, ends, firsts


def _packed(buckets: int, width: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId() * 7919
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for rows, data, borders in blocks(batch.column("text"), 8 << 20):
                found, _, row, *_ = _windows(data, borders, width)
                h, d, rest_h, rest_d = _least(found, ids[rows][row])
                bucket = (((h >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int32)
                order = np.lexsort((d, bucket))
                h, d, bucket = h[order], d[order], bucket[order]
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                out: list[list] = [[], [], [], [], []]
                pieces = [(k, False, d[a:b], h[a:b]) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
                if len(rest_h):
                    order = np.argsort(rest_d, kind="stable")
                    rest_h, rest_d = rest_h[order], rest_d[order]
                    turn += 1
                    pieces.append((turn % buckets, True, rest_d, rest_h))
                for k, marks, docs, hashes in pieces:
                    own, runs = _runs(docs)
                    for column, value in zip(out, (k, marks, own, runs.astype(np.int32), hashes.view(np.int64)), strict=True):
                        column.append(value)
                if pieces:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, _ENTRIES, strict=True)], schema=_ENTRIES)

    return pack


def _flat(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Documents and hashes of packed rows, one entry per occurrence."""
    column = lambda name: pa.chunked_array(part.column(name)).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.repeat(column("docs"), column("runs")), column("hashes").view(_U)


def _losers(buckets: int):
    """Of one bucket of hashes, every document after the first with a repeated window,
    packed into one row for each bucket of documents."""

    def lose(table: pa.Table) -> pa.Table:
        is_mark = table.column("marks").combine_chunks()
        d, h = _flat(table.filter(pc.invert(is_mark)))
        known_d, known_h = _flat(table.filter(is_mark))
        _, _, rest_h, rest_d = _least(h, d)
        d, h = np.concatenate([known_d, rest_d]), np.concatenate([known_h, rest_h])
        bucket = (mix(d.view(_U)) % _U(buckets)).astype(np.int32)
        order = np.lexsort((d, bucket))
        d, h, bucket = d[order], h[order], bucket[order]
        own, at = np.unique(bucket, return_index=True)
        cuts = np.append(at, len(bucket))
        runs = [_runs(d[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        columns = [own, np.ones(len(own), bool), [r[0] for r in runs], [r[1].astype(np.int32) for r in runs]]
        columns.append([h[a:b].view(np.int64) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ENTRIES, strict=True)], schema=_ENTRIES)

    return lose


def _marks(table: pa.Table) -> pa.Table:
    """The packed marks of one bucket of documents as one row for each document."""
    d, h = _flat(table)
    order = np.argsort(d, kind="stable")
    own, runs = _runs(d[order])
    ends = np.concatenate([[0], np.cumsum(runs)])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h[order].view(np.int64)))
    return pa.table([pa.array(own, pa.int64()), lists], schema=_MARKS)


def _removal(width: int):
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))])

    @F.arrow_udf("n_words bigint, n_removed bigint, kept string, spans array<struct<first bigint, last bigint>>")
    def removal(texts: pa.Array, gone: pa.Array) -> pa.Array:
        lists = gone.to_pylist() if gone.null_count == len(gone) else gone
        parts = [pa.array([], kind)]
        for rows, data, borders in blocks(texts, 4 << 20):
            found, at, row, starts, ends, firsts = _windows(data, borders, width)
            counts = np.diff(firsts)
            cover = np.zeros(len(starts) + 1, np.int64)
            cuts = np.searchsorted(row, np.arange(len(counts) + 1))
            for k in range(len(counts)):
                marks = lists[rows.start + k]
                marks = None if marks is None or isinstance(lists, list) or not marks.is_valid else marks.values
                if marks is not None and len(marks):
                    own = slice(cuts[k], cuts[k + 1])
                    hit = at[own][np.isin(found[own], marks.to_numpy(zero_copy_only=False).view(_U))]
                    np.add.at(cover, hit, 1)
                    np.add.at(cover, hit + width, -1)
            gone_word = np.cumsum(cover)[:-1] > 0
            raw = data.tobytes()
            out = []
            for k, n in enumerate(counts):
                text = raw[borders[k] : borders[k + 1]].split()
                own = gone_word[firsts[k] : firsts[k + 1]]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                spans = [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                if spans:
                    text = [w for w, x in zip(text, own.tolist(), strict=True) if not x]
                out.append({"n_words": int(n), "n_removed": int(own.sum()), "kept": b" ".join(text).decode(), "spans": spans})
            parts.append(pa.array(out, kind))
        return pa.concat_arrays(parts)

    return removal


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, spans`` per row: the words outside every window of
    ``width`` words that also starts in a document with a smaller id.

    ``kept`` joins the remaining words by single spaces; ``spans`` holds the removed word
    intervals, maximal and inclusive. Windows are judged on the input. Null and empty texts
    have no words. A row without id takes no part: it loses nothing and counts for nobody.
    Rows repeating an id count as one document and lose the same windows. Two different
    windows share a 64-bit hash with odds of 2**-64 a pair.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(shuffles, -(-size // BUCKET_BYTES))
    entries = docs.where("doc_id is not null and text is not null").mapInArrow(
        _packed(buckets, width), "bucket int, marks boolean, docs array<bigint>, runs array<int>, hashes array<bigint>"
    )
    lost = entries.groupBy("bucket").applyInArrow(_losers(buckets), entries.schema)
    gone = lost.groupBy("bucket").applyInArrow(_marks, "doc_id bigint, gone array<bigint>")
    keyed = docs.where("doc_id is not null").join(gone, "doc_id", "left")
    rest = docs.where("doc_id is null").withColumn("gone", F.lit(None).cast("array<bigint>"))
    return keyed.unionByName(rest).select("doc_id", _removal(width)("text", "gone").alias("_r")).select("doc_id", "_r.*")
