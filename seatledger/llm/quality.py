"""Operator 1: quality scores from histogram gradient-boosted trees over document statistics.

The statistics of whole texts are computed in Arrow batches on the executors. Trees are
fitted on the driver from at most ``SAMPLE`` labelled documents (chosen by a hash of their
id, so the choice is the same in every run); that bound is the only one. The fitted trees
are complete binary trees stored level by level in flat arrays: walking one level is a
gather and a comparison over all documents and trees of a batch at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatledger.llm.text import ROWS_AT_ONCE, blocks, window_hashes, window_rows, word_hashes, word_spans
from seatledger.session import small_batches

#: Most labelled documents used for fitting.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_WEIGHT = 80, 5, 64, 0.15, 1.0, 3.0
FOLDS = 5
ACCEPT = 0.3

STATISTICS = (
    "bytes words mean_word max_word sd_word upper lower digit non_ascii space newline symbols bangs commas stops other "
    "entropy distinct_words top_word repeated_words lines distinct_lines words_per_line capitalised shouted ended"
).split()


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.asarray(b) > 0)


def _repeats(values: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the number of distinct values and the largest count; per value, whether it repeats in its row."""
    if not len(values):
        return np.zeros(n), np.zeros(n), np.zeros(0, bool)
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    first = np.ones(len(v), bool)
    first[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(v)))
    top = np.zeros(n)
    np.maximum.at(top, r[at], counts)
    again = np.zeros(len(v), bool)
    again[order] = np.repeat(counts > 1, counts)
    return np.bincount(r[at], minlength=n).astype(float), top, again


def statistics(data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` for every text of a block."""
    n = len(borders) - 1
    starts, ends, firsts = word_spans(data, borders)
    counts = np.diff(firsts).astype(float)
    rows = np.repeat(np.arange(n), np.diff(firsts))
    lengths = (ends - starts).astype(float)
    total = np.bincount(rows, lengths, n)
    squares = np.bincount(rows, lengths**2, n)
    longest = np.zeros(n)
    np.maximum.at(longest, rows, lengths)
    mean = _share(total, counts)
    hashes = word_hashes(data, starts, ends)
    distinct, top, _ = _repeats(hashes, rows, n)
    at, own = window_rows(firsts, 5, len(hashes))
    _, _, again = _repeats(window_hashes(hashes, 5)[at] if len(at) else np.zeros(0, np.uint64), own, n)
    cover = np.zeros(len(starts) + 1)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + 5, -1)
    covered = np.bincount(rows, np.cumsum(cover)[:-1] > 0, n)
    upper_byte = (data >= 65) & (data <= 90)
    uppers = np.concatenate([[0], np.cumsum(upper_byte)])
    capital = np.bincount(rows, upper_byte[starts], n) if len(starts) else np.zeros(n)
    shout = np.bincount(rows, ((uppers[ends] - uppers[starts]) * 2 > lengths) & (lengths > 1), n)

    table = np.zeros((n, 256))
    lines, kinds, ended = np.ones(n), np.ones(n), np.zeros(n)
    raw = data.tobytes()
    for k in range(n):
        a, b = borders[k], borders[k + 1]
        table[k] = np.bincount(data[a:b], minlength=256)
        own_lines = [x for x in raw[a:b].split(b"\n") if x.strip()]
        lines[k], kinds[k] = len(own_lines), len(set(own_lines))
        ended[k] = sum(x.rstrip()[-1:] in b".!?" for x in own_lines)
    size = table.sum(axis=1)
    of = lambda chars: _share(table[:, list(chars)].sum(axis=1), size)
    p = _share(table.ravel(), np.repeat(np.maximum(size, 1), 256)).reshape(n, 256)
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    punctuation = {*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)}
    named = set(b"#*$%&|<>!?,.")
    columns = [
        np.log1p(size), np.log1p(counts), mean, longest, np.sqrt(np.maximum(_share(squares, counts) - mean**2, 0)),
        of(range(65, 91)), of(range(97, 123)), of(range(48, 58)), of(range(128, 256)), of(b" \t\r\x0b\x0c"), of(b"\n"),
        of(b"#*$%&|<>"), of(b"!?"), of(b","), of(b"."), of(punctuation - named), entropy,
        _share(distinct, counts), _share(top, counts), _share(covered, counts),
        np.log1p(lines), _share(kinds, lines), np.log1p(_share(counts, lines)),
        _share(capital, counts), _share(shout, counts), _share(ended, lines),
    ]
    return np.stack(columns, axis=1)


def _all_statistics(texts: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros((0, len(STATISTICS))), *(statistics(d, b) for _, d, b in blocks(texts, rows=ROWS_AT_ONCE))])


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def document_statistics(texts: pa.Array) -> pa.Array:
    found = _all_statistics(texts)
    ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))


@dataclass
class Trees:
    """Complete trees of one depth: node k has the children 2k+1 and 2k+2."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # the same; a value above it goes right
    value: np.ndarray  # (trees, leaves)
    prior: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        trees, inner = self.feature.shape
        if not trees:
            return 1 / (1 + np.exp(-total))
        flat_feature, flat_threshold = self.feature.ravel(), self.threshold.ravel()
        base = np.arange(trees) * inner
        for lo in range(0, len(x), 4096):
            part = x[lo : lo + 4096]
            node = np.zeros((len(part), trees), np.int64)
            rows = np.arange(len(part))[:, None]
            for _ in range(int(np.log2(inner + 1))):
                at = node + base
                node = 2 * node + 1 + (part[rows, flat_feature[at]] > flat_threshold[at])
            total[lo : lo + 4096] += self.value[np.arange(trees), node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost logistic loss with trees grown level by level from histograms of binned values.

    Without rows the trees are empty and every score is 0.5; with a single class the prior
    alone remains.
    """
    inner, leaves = 2**depth - 1, 2**depth
    rate = (y.sum() + 0.5) / (len(y) + 1)
    prior = float(np.log(rate / (1 - rate)))
    none = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), prior)
    if not len(y) or y.min() == y.max():
        return none
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    # cell of a value in the (feature, bin) histogram
    cell = binned + np.arange(m) * BINS
    score = np.full(n, prior)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        split_bin = np.full(inner, BINS)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            slot = ((node - first)[:, None] * (m * BINS) + cell).ravel()
            shape = (width, m, BINS)
            g = np.bincount(slot, np.repeat(gradient, m), width * m * BINS).reshape(shape).cumsum(axis=2)
            h = np.bincount(slot, np.repeat(weight, m), width * m * BINS).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(h < LEAST_WEIGHT) | (all_h - h < LEAST_WEIGHT)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                j, b = divmod(int(best[k]), BINS)
                if gain[k, j, b] > 1e-9 and b < len(cuts[j]):
                    feature[first + k], threshold[first + k], split_bin[first + k] = j, cuts[j][b], b
            node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > split_bin[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, weight, leaves) + RIDGE)
        score += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.stack(features), np.stack(thresholds), np.stack(values), prior)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id's digits divides by FOLDS. False without id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_sample(labels: DataFrame, label_col: str, sample: int = SAMPLE, seed: int = 1) -> DataFrame:
    """At most ``sample`` rows (doc_id, label) outside the held-out fold, chosen by hash.

    Null ids and labels are left out; several labels of one document are averaged and
    count as 1 from a half on.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    known = known.where("doc_id is not null and label is not null").where(~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg((F.avg(F.least(F.col("label"), F.lit(1.0))) >= 0.5).cast("double").alias("label"))
    return one.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fit on the labelled documents among ``docs``; the sample's ids are few enough to broadcast.

    A document that comes in several rows trains by its least text, so the driver gets no
    more rows than the sample has ids, in whatever order the table lies.
    """
    small_batches(docs.sparkSession)
    chosen = F.broadcast(training_sample(labels, "quality", sample))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    one = texts.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = one.select("doc_id", "label", document_statistics("text").alias("_x")).toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    x = rows.column("_x").combine_chunks().flatten().to_numpy().reshape(-1, len(STATISTICS))
    return fit_trees(x[order], rows.column("label").to_numpy()[order])


def quality_score(model: Trees, text: Column) -> Column:
    """Probability of quality label 1 for every whole text; null counts as empty."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.probability(_all_statistics(texts)))

    return score(text)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    ``predicted`` is 1 from a score of 0.3 on. Labels train only from documents outside the
    held-out fold; a table without usable labels scores 0.5 everywhere. Texts may be null
    or empty; rows without id are scored and never held out; repeated rows score alike.
    Other columns are ignored.
    """
    model = fit_quality(docs, labels)
    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), quality_score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier accepts."""
    model = fit_quality(docs, labels)
    return docs.where(quality_score(model, F.col("text")) >= ACCEPT)
