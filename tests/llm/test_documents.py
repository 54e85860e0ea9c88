"""Operators 1, 2, 5, 6, 9 and 10 on edge cases and against plain versions."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seatledger.llm import lines, near_dedup, quality, rules, substrings, text, token_files
from seatledger.llm.components import components
from seatledger.llm.queries import tokenizer_path
from seatledger.session import scratch_path, small_batches


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def with_id(counter):
    return Counter({k: v for k, v in counter.items() if k[0] is not None})


def test_word_hashes_do_not_depend_on_the_block():
    one, two = "aa b  cc\x1cd e", "b aa"
    spans = []
    for column in (pa.array([one, None, two]), pa.array([two, one])):
        data, borders = text.byte_column(column)
        starts, ends, firsts = text.word_spans(data, borders)
        h = text.word_hashes(data, starts, ends)
        spans.append([h[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:], strict=True)])
    assert spans[0] == [spans[1][1], [], spans[1][0]]
    assert len(spans[0][0]) == 3 and spans[0][0][:2] == spans[0][2][::-1]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(201)} | {1000 + k: 1000 for k in range(50)}


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    common, own = rng.integers(0, 1 << 63, 600, dtype=np.uint64), rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.sort(np.concatenate([common, own[:100]])), np.sort(np.concatenate([common, own[100:]])), common[:1]]
    firsts = np.cumsum([0] + [len(s) for s in sets])
    sketch = near_dedup.sketches(np.concatenate(sets), firsts, 432)
    assert (sketch != np.iinfo(np.uint64).max).all()
    assert abs((sketch[0] == sketch[1]).mean() - 0.75) < 0.1


def test_near_duplicates_edges(edge, empty):
    got = bag(near_dedup.near_duplicates(edge), "doc_id", "n_shingles", "component_id", "kept")
    assert with_id(got) == brute.near_duplicates([r for r in rows_of(edge) if r[0] is not None])
    assert got[None, 16, None, True] == 1 and got[None, 0, None, True] == 1
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_duplicates_of_random_edits(spark):
    rng = random.Random(5)
    words = [f"t{k}" for k in range(400)]
    bases = [[rng.choice(words) for _ in range(rng.randint(20, 80))] for _ in range(6)]
    docs = []
    for i in range(240):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        docs.append((i, " ".join(w)))
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = bag(near_dedup.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute.near_duplicates(docs)
    stay = near_dedup.representatives(df)
    assert {r.doc_id for r in stay.collect()} == {k[0] for k in got if k[3]}


def template_family(n, shared=150, own=50):
    body = " ".join(f"s{k}" for k in range(shared))
    return [(i, body + "".join(f" o{i}x{k}" for k in range(own))) for i in range(n)]


def test_a_family_of_one_template_makes_no_candidates(spark):
    docs = template_family(300)
    docs += [(1000 + i, t.replace(f"o{i}x49", "edit")) for i, t in docs[:5]]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert got == {i: i % 1000 for i, _ in docs}
    sets = df.select(F.col("doc_id").alias("node"), near_dedup._full_sets(5)("text").alias("shingles"))
    members = df.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("root"))
    pairs = near_dedup._cross_pairs(members, sets, 75).collect()
    assert {(r.a, r.b) for r in pairs} == {(i, 1000 + i) for i in range(5)}


@pytest.mark.parametrize("percent", [60, 75, 90])
def test_index_on_full_sets_meets_every_near_pair(spark, percent):
    rng = random.Random(percent)
    base = list(range(60))
    sets = [sorted({*rng.sample(base, rng.randint(30, 60)), *rng.sample(range(60, 200), rng.randint(0, 12))}) for _ in range(150)]
    root = [rng.randrange(40) for _ in sets]
    near = {
        (i, j) for i in range(150) for j in range(i + 1, 150)
        if root[i] != root[j] and 100 * len({*sets[i]} & {*sets[j]}) >= percent * len({*sets[i]} | {*sets[j]})
    }
    given = spark.createDataFrame(list(enumerate(sets)), "node bigint, shingles array<bigint>")
    members = spark.createDataFrame(list(enumerate(root)), "node bigint, root bigint")
    found = {(r.a, r.b) for r in near_dedup._cross_pairs(members, given, percent).collect()}
    # Two sets of the largest component at a shingle are never in question: their roots are equal.
    assert near and near <= found


def test_representatives_keep_columns_and_one_row(edge):
    stay = near_dedup.representatives(edge)
    assert stay.columns == edge.columns
    ids = [r.doc_id for r in stay.collect()]
    assert ids.count(None) == 2 and ids.count(3) == 1 and 4 not in ids and 6 not in ids


def test_line_dedup_edges(edge, empty):
    found = lines.deduplicate_lines(edge).withColumn("h", F.sha2("kept", 256))
    got = bag(found, "doc_id", "n_lines", "n_dropped", "h")
    assert with_id(got) == brute.line_dedup([r for r in rows_of(edge) if r[0] is not None])
    assert got[None, 1, 0, brute.sha("")] == 1
    assert lines.deduplicate_lines(empty).count() == 0
    assert lines.deduplicate_lines(edge, least_docs=99).agg(F.sum("n_dropped")).first()[0] == 0


def test_repeated_passages_edges(edge, empty):
    found = substrings.repeated_passages(edge).withColumn("h", F.sha2("kept", 256))
    got = bag(found, "doc_id", "n_words", "n_removed", "h")
    assert with_id(got) == brute.repeated_windows([r for r in rows_of(edge) if r[0] is not None])
    assert any(k[2] for k in got)
    assert substrings.repeated_passages(empty).count() == 0


def test_repeated_passages_merge_into_maximal_spans(spark):
    a = [f"a{k}" for k in range(40)]
    b = ["x", *a[5:25], "y", "z", *a[:13]]
    df = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id bigint, text string")
    got = {r.doc_id: r for r in substrings.repeated_passages(df).collect()}
    assert got[1].n_removed == 0 and got[1].spans == []
    assert [tuple(s) for s in got[2].spans] == [(1, 20), (23, 35)] and got[2].kept == "x y z"


def test_rule_measures_edges(edge, empty):
    got = bag(rules.apply_rules(edge), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == Counter((i, *brute.rule_measures(t)) for i, t in rows_of(edge))
    assert rules.apply_rules(empty).count() == 0


def test_rule_thresholds_adapt_to_the_group(spark):
    rng = random.Random(3)

    def doc(i, source, symbols):
        words = [f"{rng.choice('abcdef')}{rng.randrange(10_000)}" for _ in range(60)]
        return i, " ".join(w + "#" * symbols for w in words), "en", source

    docs = [doc(i, "plain", 0) for i in range(300)] + [doc(1000 + i, "maths", 1) for i in range(300)] + [doc(5000, "plain", 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    gone = {r.doc_id: r.failed for r in rules.apply_rules(df).where("not kept").collect()}
    assert gone == {5000: ["symbol_share"]}


@pytest.mark.parametrize(("percent", "others"), [(12, True), (30, True), (50, True), (70, True), (30, False), (50, False)])
def test_rules_drop_the_junk_of_a_hot_source(spark, percent, others):
    rng = random.Random(7)

    def doc(i, source, symbols):
        words = [f"{rng.choice('abcdef')}{rng.randrange(10_000)}" for _ in range(60)]
        return i, " ".join(w + "#" * symbols for w in words), "en", source

    junk = {k for k in range(300) if k < 3 * percent}
    docs = [doc(i, "hot", 2 if i in junk else 0) for i in range(300)]
    docs += [doc(1000 + i, f"other{i % 3}", 0) for i in range(900 if others else 0)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    gone = {r.doc_id: r.failed for r in rules.apply_rules(df).where("not kept").collect()}
    assert set(gone) == junk and all("symbol_share" in f for f in gone.values())


@pytest.mark.parametrize("value", [0, 1, 31, 32, 33, 47, 48, 63, 64, 1000, 4095, 4096, 10**9])
def test_sketch_bins_are_tight(spark, value):
    b, top = spark.range(1).select(rules.sketch_bin(F.lit(value)).alias("b"), rules.bin_top(rules.sketch_bin(F.lit(value)))).first()
    assert value <= top <= value + value // 16


def test_quality_learns_and_holds_out(spark, sf_dir, edge, empty):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.score_quality(docs, labels)
    rows = scored.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.9
    # Labels of the held-out fold change nothing.
    twisted = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert bag(quality.score_quality(docs, twisted), "doc_id", "score") == bag(scored, "doc_id", "score")
    assert quality.score_quality(edge, labels.limit(0)).where("score <> 0.5").count() == 0
    assert quality.score_quality(edge, labels).where("score is null or held_out is null").count() == 0
    assert quality.score_quality(empty, labels).count() == 0


def test_flat_trees_agree_with_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    model = quality.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float), trees=12, depth=3)
    for row, p in zip(x[:50], model.probability(x[:50]), strict=True):
        total = model.prior
        for f, t, v in zip(model.feature, model.threshold, model.value, strict=True):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + int(row[f[k]] > t[k])
            total += v[k - len(f)]
        assert abs(p - 1 / (1 + np.exp(-total))) < 1e-12
    assert ((model.probability(x) > 0.5) == (x[:, 0] * x[:, 1] > 0)).mean() > 0.9


def test_token_files_round_trip(spark, edge, empty):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    odd = spark.createDataFrame([(90, "<|endoftext|> Don't <|ENDOFTEXT|>'S x<|startoftext|>y"), (91, "é ́a ΑΣ Σ b\x1cc 12½")], "doc_id bigint, text string")
    docs = edge.select("doc_id", "text").unionByName(odd)
    folder = scratch_path(spark, "tokens")
    parts = token_files.write_token_files(docs, folder, path)
    got = bag(token_files.read_token_files(spark, folder), "doc_id", "start", "n_tokens", "ids_crc32")
    want, at = Counter(), 0
    order = sorted(rows_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    for i, t in order:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want[i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    assert got == want
    assert parts.agg(F.sum("n_ids")).first()[0] == at
    nothing = scratch_path(spark, "tokens")
    token_files.write_token_files(empty, nothing, path)
    assert token_files.read_token_files(spark, nothing).count() == 0


def test_encoder_beyond_its_memory(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    encoder = token_files.WordEncoder(tokenizer_path())
    for _ in range(2):
        ids, counts = encoder.encode([b"some words in a text", b"", b"a longer text of other words"], 1)
        whole = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in ("some words in a text", "", "a longer text of other words")]
        assert ids.tolist() == sum(whole, []) and counts.tolist() == [len(w) for w in whole]
    assert len(encoder.place) == 3


def test_the_closing_id_is_kept_with_the_words():
    """It is entry 0 of what an encoder remembers, so a batch needn't copy all ids to add it."""
    encoder = token_files.WordEncoder(tokenizer_path())
    for end in (1, 7):
        ids, counts = encoder.encode([b"some words", b"", b"words"], end)
        assert ids.tolist() == sum(([*encoder.tokenizer.encode(t, add_special_tokens=False).ids, end] for t in ("some words", "", "words")), [])
        assert counts.sum() == len(ids) and encoder.ids[0] == end


def test_a_word_is_encoded_once_whatever_marks_follow():
    """Only what is new goes to the tokenizer, and offsets, dearer than ids, are asked only where words hold more than letters."""
    asked = []

    class Encoding:
        def __init__(self, done):
            self.ids, self.word_ids, self._offsets = done.ids, done.word_ids, done.offsets

        @property
        def offsets(self):
            asked.append("offsets")
            return self._offsets

    class Tokenizer:
        def encode(self, joined, **options):
            asked.append(sorted(joined.split()))
            return Encoding(tokenizer.encode(joined, **options))

    encoder = token_files.WordEncoder(tokenizer_path(), split_marks=True)
    tokenizer, encoder.tokenizer = encoder.tokenizer, Tokenizer()
    texts = [b"Word gr\xc3\xb6\xc3\x9fer word, (word) word; word...", b"word"]
    ids, counts = encoder.encode(texts, 1)
    assert asked == [["größer", "word"], ["(word", ")", ",", "...", ";"], "offsets"]
    whole = [[*tokenizer.encode(t.decode(), add_special_tokens=False).ids, 1] for t in texts]
    assert ids.tolist() == sum(whole, []) and counts.tolist() == [len(w) for w in whole]
    encoder.encode([b"word; word", b"w\xc3\xb6rd,"], 1)
    assert asked[3:] == [["wörd"]]


@pytest.mark.parametrize("split_marks", [False, True])
def test_encoder_equals_the_tokenizer_on_odd_texts(split_marks):
    signs = [chr(k) for k in (*range(1, 127), *range(0xA0, 0x180), 0x301, 0x338, 0x3A3, 0x3C2, 0x200D, 0x2026, 0x1100, 0x1161, 0x11A8, 0x6F22, 0xAC00, 0x1F600)]
    texts = ["", " ", ".", "<", "|", *(f"a{x} {x}b 7{x}. '{x}'s {x}{x}" for x in signs), *(a + b for a in "aZ0é'." for b in signs)]
    texts += ["don't. it's, we'll! x'.s 's. a'. 3.5, e.g.:", "a. <|endoftext|>. b. A.", "<", "|x.", "İ.", "각 A\u030a.", "x" * 9000 + ". " + "yz " * 5000]
    encoder = token_files.WordEncoder(tokenizer_path(), split_marks)
    for part in (texts, texts[::-1]):
        ids, counts = encoder.encode([t.encode() for t in part], 1)
        whole = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in part]
        assert counts.tolist() == [len(w) for w in whole] and ids.tolist() == sum(whole, [])


def test_token_files_split_rows_of_one_id(spark):
    """Rows without id and rows of one id spread over parts; files that no part names are not read."""
    texts = [f"{k:04d} {'word ' * 40}{k}" for k in range(600)]
    docs = spark.createDataFrame([(None if k % 2 else 7, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    folder = scratch_path(spark, "tokens")
    parts = token_files.write_token_files(docs, folder, tokenizer_path())
    sizes = [r["n_docs"] for r in parts.collect()]
    assert len(sizes) >= 6 and max(sizes) < 200
    place = folder.removeprefix("file:")
    for kind in ("ids", "idx"):  # what a lost attempt leaves
        with open(f"{place}/part-00000-lost.{kind}", "wb") as file:
            file.write(b"\1\2\3")
    read = token_files.read_token_files(spark, folder).collect()
    assert Counter(r["doc_id"] for r in read) == {None: 300, 7: 300}
    read.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in read] == [None] * 300 + [7] * 300
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(read, read[1:], strict=False))


def test_blocks_of_short_texts_are_bounded_in_rows(spark):
    texts = pa.array([f"one two three four five {k}" for k in range(10_000)])
    taken = list(text.blocks(texts, rows=text.ROWS_AT_ONCE))
    assert [s.stop - s.start for s, _, _ in taken] == [1000] * 10
    assert b"".join(d.tobytes() for _, d, _ in taken) == "".join(texts.to_pylist()).encode()
    for measured, most in ((near_dedup._signatures(5, near_dedup.BANDS, near_dedup.ROWS).func, 30), (quality._all_statistics, 20)):
        tracemalloc.start()
        assert len(measured(texts)) == len(texts)
        peak = tracemalloc.get_traced_memory()[1] / 2**20
        tracemalloc.stop()
        assert peak < most


def test_python_gets_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for given, then in (("10000", "1000"), ("0", "1000"), ("70", "70")):
            spark.conf.set(key, given)
            small_batches(spark)
            assert spark.conf.get(key) == then
        spark.conf.set(key, "10000")
        near_dedup.near_duplicates(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"))
        assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.set(key, before)


def test_a_writer_need_not_leave_its_words_in_the_worker(tmp_path, monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(token_files, "TaskContext", Task)
    token_files._encoder.cache_clear()
    batch = pa.record_batch([pa.array([1, 2]), pa.array(["a word", None])], names=["doc_id", "text"])
    found = []
    for keep in (False, True):
        (row,) = token_files._writer(str(tmp_path), tokenizer_path(), 1, 2, keep)(iter([batch]))
        found.append((tmp_path / f"{row.column('file')[0]}.ids").read_bytes())
        assert token_files._encoder.cache_info().currsize == keep
    assert found[0] == found[1]
    token_files._encoder.cache_clear()
