"""Operators 3, 4, 7 and 8, the pipeline and the registered queries."""

from __future__ import annotations

import random
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from compare import difference, duck
from seatledger.llm import chat, decontaminate, mixing, near_dedup, quality, toxicity
from seatledger.llm.oracles import llm_oracles
from seatledger.llm.queries import MIX_WEIGHTS, llm_queries, mix_levels


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, sf_dir, name):
    assert difference(llm_queries()[name](spark, sf_dir), duck(sf_dir), llm_oracles()[name]) is None


def test_native_plans_run_no_python(spark, sf_dir, capsys):
    for name in ("op2_line_dedup", "op4_benchmark_decontamination", "op7_chat_formatting"):
        llm_queries()[name](spark, sf_dir).explain("formatted")
        plan = capsys.readouterr().out
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_contained_items_edges(spark, edge, empty):
    items = [
        (1, "beta gamma delta epsilon zeta eta THETA iota"), (2, "one two"), (3, None), (4, ""), (None, "one two"),
        (5, "mu nu xi omicron pi rho sigma tau upsilon nowhere"), (6, "none of these words is anywhere at all"),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_found) for r in decontaminate.contained_items(edge, bench).collect()}
    assert got == {
        **{(d, 1): (4, 4) for d in (3, 4, 5, 6)}, **{(d, 5): (6, 5) for d in (3, 4, 6)}, (9, 2): (1, 1), (10, 2): (1, 1),
    }
    # Short items are found inside longer documents, by windows of their own length.
    short = spark.createDataFrame([(1, "Number One"), (2, "repeats"), (3, "one number"), (4, "own line number one")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained_items(edge, short).collect()}
    assert got == {(12, 1), (12, 2), (12, 4), (13, 2)}
    stay = decontaminate.without_items(edge, bench)
    assert stay.columns == edge.columns
    assert Counter(r.doc_id for r in stay.collect()) == Counter(r.doc_id for r in edge.collect() if r.doc_id not in {3, 4, 5, 6, 9, 10})
    assert decontaminate.contained_items(empty, bench).count() == 0
    assert decontaminate.contained_items(edge, bench.limit(0)).count() == 0


def test_conversations_edges(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, position int"
    a = [(1, 0, "user", "hi", 0), (1, 1, "assistant", "yes", 0)]
    rows = [
        *a, *[(2, *r[1:]) for r in a], (2, 2, "user", "more", 0), (3, 0, "user", "hi", 0), (3, 0, "user", "hi", 0),
        *[(4, *r[1:]) for r in a], (5, 0, "user", "hi", 0), (5, 1, "assistant", "no", 0), (None, 0, "user", "hi", 0),
        (None, None, None, None, None), (6, 0, None, None, 0), *[(7, *r[1:]) for r in a], (7, 2, "user", "more", 0),
    ]
    got = {(r.conv_id, r.piece): r for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {(2, 0), (5, 0), (6, 0)}
    assert got[2, 0].n_copies == 2 and got[2, 0].n_turns == 3 and got[6, 0].n_copies == 2
    assert got[5, 0].rendered == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nno<|im_end|>\n"
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_long_conversation_spans_chunks(spark):
    turns = [(1, k, "user", f"t{k}") for k in range(700)] + [(2, k, "user", f"t{k}") for k in range(600)] + [(3, k, "user", f"t{k}") for k in range(1, 600)]
    got = chat.format_conversations(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))
    assert Counter((r.conv_id, r.piece) for r in got.collect()) == Counter([(1, 0), (1, 1), (1, 2), (3, 0), (3, 1), (3, 2)])


def plain_quotas(leaves, weights, budget, depth=0):
    """Budget a tree by repeated proportional shares, in fractions."""
    children = defaultdict(dict)
    for path, cap in leaves.items():
        children[path[depth]][path] = cap
    caps = {k: sum(v.values()) for k, v in children.items()}
    given, live, left = {}, set(caps), min(budget, sum(caps.values()))
    weight = lambda k: weights[depth].get(k, weights[depth].get("*", 1))
    while live:
        total = sum(weight(k) for k in live)
        full = {k for k in live if caps[k] * total <= weight(k) * left}
        if not full:
            given |= {k: left * weight(k) / total for k in live}
            break
        given |= {k: caps[k] for k in full}
        left, live = left - sum(caps[k] for k in full), live - full
    if depth == 2:
        return {p: given[p[2]] for p in leaves}
    return {p: q for k, v in children.items() for p, q in plain_quotas(v, weights, given[k], depth + 1).items()}


def test_mixture_meets_the_tree_of_budgets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    taken = mixing.mix(docs, MIX_WEIGHTS, mix_levels(), share=0.5, epochs=2).cache()
    keys = ["_domain", "_lang", "_source"]
    levels = mix_levels()
    every = docs.select(*(F.coalesce(levels[k].cast("string"), F.lit("?")).alias(f"_{k}") for k in levels), mixing.token_count(F.col("text")).alias("t"))
    leaves = {tuple(r[:3]): r.t for r in every.groupBy(*keys).agg(F.sum("t").alias("t")).collect()}
    budget = sum(leaves.values()) // 2
    want = plain_quotas({k: 2 * v for k, v in leaves.items()}, [MIX_WEIGHTS[k] for k in ("domain", "lang", "source")], budget)
    got = {tuple(r[:3]): r.t for r in taken.groupBy(*keys).agg(F.sum("_take").alias("t")).collect()}
    assert sum(got.values()) == budget
    assert all(abs(got.get(k, 0) - q) <= 3 for k, q in want.items())
    # Every document at most once an epoch, whole epochs whole, one cut document a leaf at most.
    assert taken.groupBy("doc_id", "_epoch").count().where("count > 1").isEmpty()
    assert taken.where("_take < _tokens").groupBy(*keys).count().where("count > 1").isEmpty()
    sizes = {k: n for *k, n in every.groupBy(*keys).count().collect() for k in [tuple(k)]}
    for r in taken.where("_epoch = 1").select(*keys).distinct().collect():
        assert taken.where("_epoch = 0").where(" and ".join(f"{k} = '{v}'" for k, v in r.asDict().items())).count() == sizes[tuple(r)]
    again = mixing.mix(docs.repartition(5), MIX_WEIGHTS, mix_levels(), share=0.5, epochs=2)
    assert Counter((r.doc_id, r._epoch, r._take) for r in again.collect()) == Counter((r.doc_id, r._epoch, r._take) for r in taken.collect())


def test_mixture_edges(edge, empty):
    taken = mixing.mix(edge, {}, mix_levels(), share=1.0, epochs=1)
    assert Counter(r.doc_id for r in taken.collect()) == Counter(r.doc_id for r in edge.collect())
    assert mixing.mix(edge, {}, mix_levels(), budget=0).where("_take > 0").count() == 0
    assert mixing.mix(empty, {}, mix_levels()).count() == 0


def test_stages_keep_columns_of_any_name(spark, sf_dir):
    own = ["_domain", "_Bucket", "_tokens", "_order", "_left", "_before", "_take", "_epoch", "_kept", "_dirty", "_again", "h", "node", "item_id"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in own})
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, sf_dir)
        assert left.columns == docs.columns
        left = spark.createDataFrame(left.collect(), docs.schema)
        assert left.count() and all(r[c] == f"{c}{r.doc_id}" for r in left.collect() for c in own)
    taken = mixing.mix(docs, {}, mix_levels())
    assert len({c.lower() for c in taken.columns}) == len(taken.columns) and "_order" in taken.columns


def test_pipeline_of_an_empty_table(spark, sf_dir):
    left = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        left = spark.createDataFrame(stage(spark, left, sf_dir).collect(), stage(spark, left, sf_dir).schema)
    assert left.count() == 0


def test_chain_feeds_out_of_fold_predictions():
    """Against a chain written out model by model, each fitted by plain gradient steps."""
    import numpy as np

    rng = np.random.default_rng(2)
    x = (rng.random((300, 6)) < 0.4).astype(float)
    first = ((x[:, 0] + x[:, 1]) > rng.random(300)).astype(float)
    labels = np.column_stack([first, ((first + x[:, 2]) > 2 * rng.random(300)).astype(float)])
    fold = np.arange(300) % toxicity.FOLDS

    def plain(x, y):
        x, w = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
        ridge = np.array([toxicity.RIDGE] * (len(w) - 1) + [1e-3])
        for _ in range(20_000):
            w -= 0.01 * (x.T @ (1 / (1 + np.exp(-x @ w)) - y) + ridge * w)
        return w

    chain = toxicity.fit_chain(["a", "b"], {}, x, labels, fold)
    outside = np.zeros(300)
    for k in range(toxicity.FOLDS):
        w = plain(x[fold != k], labels[fold != k, 0])
        outside[fold == k] = 1 / (1 + np.exp(-(x[fold == k] @ w[:-1] + w[-1])))
    assert np.abs(chain.weights[0] - plain(x, labels[:, 0])).max() < 1e-3
    assert np.abs(chain.weights[1] - plain(np.column_stack([x, outside]), labels[:, 1])).max() < 1e-3
    given = chain.predict(x)
    alone = 1 / (1 + np.exp(-(x @ chain.weights[0][:-1] + chain.weights[0][-1])))
    assert np.allclose(given[0], alone)
    assert np.allclose(given[1], 1 / (1 + np.exp(-(np.column_stack([x, alone]) @ chain.weights[1][:-1] + chain.weights[1][-1]))))


def test_toxicity_learns_and_chains(spark, edge, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, labels)
    held = scored.join(labels.withColumnRenamed("toxic", "label"), "doc_id").where(quality.held_out(F.col("doc_id"))).collect()
    assert sum(r.toxic == r.label for r in held) / len(held) > 0.9
    chain = toxicity.train(docs, labels)
    assert chain.names == ["terms_1", "terms_2", "toxic"]
    assert [len(w) for w in chain.weights] == [len(chain.words) + 1 + j for j in range(3)]
    assert toxicity.score_toxicity(edge, labels).where("p_toxic is null").count() == 0
    assert toxicity.score_toxicity(edge, labels.limit(0)).where("p_toxic <> 0.5").count() == 0
    assert toxicity.score_toxicity(empty, labels).count() == 0


def toxic_texts(spark):
    """Every language has its own toxic stem; the small one's compounds are all different."""
    rng = random.Random(4)
    stems = {"en": ("vile", 400), "fr": ("réeux", 160), "es": ("boco", 90)}
    docs, labels = [], []
    for lang, (stem, size) in stems.items():
        for _ in range(size):
            i, bad = len(docs), rng.random() < 0.3
            words = [f"{lang}{rng.randrange(300)}" for _ in range(30)]
            if bad:
                words[3:5] = [f"{stem}{rng.choice('aeiou')}{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}" for _ in range(2)]
            docs.append((i, " ".join(words), lang))
            labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity_recall_by_language(spark):
    docs, labels = toxic_texts(spark)
    held = toxicity.score_toxicity(docs, labels).join(labels.withColumnRenamed("toxic", "label"), "doc_id").join(docs, "doc_id")
    rows = held.where(quality.held_out(F.col("doc_id"))).collect()
    for lang in ("en", "fr", "es"):
        toxic = [r.toxic for r in rows if r.lang == lang and r.label]
        assert len(toxic) >= 3 and sum(toxic) >= 0.9 * len(toxic)
    assert sum(r.toxic for r in rows if not r.label) <= 1


def test_narrower_categories_come_from_the_sample(spark):
    """Two kinds of toxic texts without any English word; each category finds one of them in each language."""
    rng = random.Random(8)
    kinds = {"fr": (["réeux", "réeau"], ["ouvil", "ouvain"]), "es": (["boco", "bome"], ["tonti", "tonta"])}
    docs, labels = [], []
    for lang, stems in kinds.items():
        for i in range(400):
            kind = (0 if i % 5 else 1) if i % 2 else None
            words = [f"{lang}{rng.randrange(300)}" for _ in range(30)]
            if kind is not None:
                words[3:5] = stems[kind]
            docs.append((len(docs), " ".join(words), lang, kind))
            labels.append((len(labels), int(kind is not None)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, kind int")
    scored = toxicity.score_toxicity(df, spark.createDataFrame(labels, "doc_id bigint, toxic int")).join(df, "doc_id")
    for r in scored.where(quality.held_out(F.col("doc_id"))).collect():
        assert (r.p_terms_1 >= 0.5, r.p_terms_2 >= 0.5) == (r.kind == 0, r.kind == 1)


def test_pipeline_applies_every_decision(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    ids = lambda df, c="doc_id": {r[c] for r in df.collect()}
    left = docs
    kept = [ids(docs)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, sf_dir)
        assert out.columns == docs.columns
        left = spark.createDataFrame(out.collect(), docs.schema)
        kept.append(ids(left))
    one = ids(quality.score_quality(docs, labels).where("predicted = 1"))
    assert kept[1] == one
    two = ids(near_dedup.near_duplicates(docs.where(F.col("doc_id").isin(list(one)))).where("kept"))
    assert kept[2] == two
    assert kept[3] == two - ids(decontaminate.contained_items(docs, bench))
    assert kept[4] <= kept[3]
    final = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in final) == Counter(r.doc_id for r in left.collect())
    starts = sorted((r.start, r.n_tokens) for r in final)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(len(starts))]


def test_pipeline_takes_edge_rows(spark, sf_dir, edge):
    left = edge
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, left, sf_dir)
        left = spark.createDataFrame(out.collect(), out.schema)
    assert left.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_registered_only_with_the_package():
    assert set(llm_queries()) | {"pipeline"} <= set(contract.queries())
    assert "seatledger.llm" in sys.modules
