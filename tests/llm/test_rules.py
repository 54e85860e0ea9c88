"""Operator 6's verdicts against thresholds worked out in plain Python."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brute import rule_measures, words
from seatledger.llm import rules

MARKS = {chr(c) for c in range(33, 127) if not chr(c).isalnum()}


def values(text):
    n, chars, *_ = rule_measures(text)
    marks = sum(c in MARKS for c in text)
    top = max(Counter(words(text)).values())
    return {
        "symbol_share": marks * 100_000 // chars,
        "word_share": int(max(top - 2 * math.sqrt(top), 0.0) * 100_000 / n),
        "word_length": (chars - marks) * 1000 // n,
        "capital_share": sum("A" <= c <= "Z" for c in text) * 100_000 // chars,
    }


def bin_of(v):
    step = v.bit_length() - 6
    return v if v < 64 else step * 32 + (v >> step)


def top_of(b):
    return b if b < 64 else ((b % 32 + 33) << (b // 32 - 1)) - 1


def quantile(weights, q):
    total, upto = sum(weights.values()), 0
    for b in sorted(weights):
        before, upto = upto, upto + weights[b]
        if upto >= total * (q / 1000):
            bottom = top_of(b - 1) + 1 if b else 0
            return bottom + (total * (q / 1000) - before) / weights[b] * (top_of(b) - bottom)


def leaning(own, larger):
    out = Counter({b: n * rules.UNIT for b, n in own.items()})
    for b, n in larger.items():
        out[b] += n * rules.PRIOR * rules.UNIT // sum(larger.values())
    return out


def level(weights):
    low, centre = quantile(weights, rules.LOW), quantile(weights, rules.CENTRE)
    return centre + (centre - low) * rules.FENCE, low, centre


def plain_kept(rows):
    """rows: (doc_id, text, lang, source) -> {doc_id: (kept, failed measures)} and the thresholds."""
    good = {}
    for i, text, lang, source in rows:
        if not rule_measures(text)[-1]:
            good[i] = (lang or "?", source or "?", values(text))
    by_source, by_lang, every = (defaultdict(Counter) for _ in range(3))
    for lang, source, own in good.values():
        for m, v in own.items():
            by_source[lang, source, m][bin_of(v)] += 1
            by_lang[lang, m][bin_of(v)] += 1
            every[m][bin_of(v)] += 1
    limits = {}
    for (lang, source, m), own in by_source.items():
        whole = level({b: n * rules.UNIT for b, n in every[m].items()})
        of_lang = level(leaning(by_lang[lang, m], every[m]))
        bound = min(of_lang[0], whole[0]) if of_lang[1] <= whole[2] else of_lang[0]
        mine = level(leaning(own, by_lang[lang, m]))
        limits[lang, source, m] = min(mine[0], bound) if mine[1] <= of_lang[2] else mine[0]
    out = {i: (False, ()) for i, *_ in rows}
    for i, (lang, source, own) in good.items():
        failed = tuple(m for m in rules.MEASURES if own[m] > limits[lang, source, m])
        out[i] = (not failed, failed)
    return out, limits


def test_verdicts_match_plain_thresholds(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    want, limits = plain_kept([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()])
    got = {r.doc_id: (r.kept, tuple(r.failed)) for r in rules.apply_rules(docs).collect()}
    assert got == want
    for m in rules.MEASURES:
        assert len({v for (*_, k), v in limits.items() if k == m}) > 20


def test_verdicts_of_edge_rows(spark, edge):
    rows = [r for r in edge.collect() if r.doc_id is not None]
    want, _ = plain_kept([(k, r.text, r.lang, r.source) for k, r in enumerate(rows)])
    df = spark.createDataFrame([(k, r.text, r.lang, r.source) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    assert {r.doc_id: (r.kept, tuple(r.failed)) for r in rules.apply_rules(df).collect()} == want


@pytest.mark.parametrize("value", [0, 1, 63, 64, 65, 127, 128, 4095, 4096, 10**9])
def test_bins_match_the_plain_ones(spark, value):
    b = rules.sketch_bin(F.lit(value))
    assert tuple(spark.range(1).select(b, rules.bin_top(b)).first()) == (bin_of(value), top_of(bin_of(value)))


def test_labels_of_the_smallest_tables(spark, sf_dir):
    """Most of what is labelled bad goes, nearly all that is labelled good stays."""
    folder = sf_dir.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality is not null").dropDuplicates(["doc_id"])
    kept = rules.apply_rules(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id")
    found = {(r.quality, r.kept): r["count"] for r in kept.groupBy("quality", "kept").count().collect()}
    assert found[0, False] >= 0.97 * (found[0, False] + found.get((0, True), 0))
    assert found[1, True] >= 0.95 * (found[1, True] + found[1, False])
