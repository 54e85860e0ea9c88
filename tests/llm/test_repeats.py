"""One document id in very many rows: bounded training samples and definite representatives."""

from __future__ import annotations

from pyspark.sql import functions as F

from seatledger.llm import near_dedup, quality, toxicity


def repeated(spark):
    """Document 2 a hundred thousand times, each time with another text."""
    few = spark.createDataFrame([(1, "a clean text about nothing at all"), (3, "grim words here")], "doc_id bigint, text string")
    many = spark.range(100_000).select(F.lit(2).cast("bigint").alias("doc_id"), F.concat(F.lit("text number "), F.col("id") + 100_000).alias("text"))
    docs = few.unionByName(many).withColumn("lang", F.lit("en"))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 1)], "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_training_takes_one_row_for_each_id(spark, monkeypatch):
    docs, labels = repeated(spark)
    seen = []
    original = quality.fit_trees
    monkeypatch.setattr(quality, "fit_trees", lambda x, y: (seen.append(len(x)), original(x, y))[1])
    quality.fit_quality(docs, labels)
    used = labels.where(~quality.held_out(F.col("doc_id"))).count()
    assert seen == [used]
    fitted = toxicity.train(docs, labels)
    assert fitted.names


def test_representatives_keep_the_least_text(spark):
    rows = [(5, "b second"), (5, "a first"), (5, None), (6, "z"), (6, "y"), (None, "n"), (7, "same"), (7, "same")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, _kept string, _n int")
    got = sorted(((r.doc_id or 0), r.text) for r in near_dedup.representatives(docs).collect())
    assert got == [(0, "n"), (5, "a first"), (6, "y"), (7, "same")]
