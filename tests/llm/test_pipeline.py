"""The pipeline's stages, one by one and together."""

from __future__ import annotations

import collections

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from lendrisk.llm import bagminhash, fertility, queries, soft_mixing

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = queries.table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rules = corpus_pipeline.quality_rules(spark, docs, SF)
    kept = {r.doc_id for r in fertility.fertility_rules(docs).where("kept").collect()}
    assert rules.columns == docs.columns and {r.doc_id for r in rules.collect()} == kept
    good = corpus_pipeline.quality_classifier(spark, rules, SF)
    left = {r.doc_id for r in good.collect()}
    assert good.columns == docs.columns
    clean = [i for i in kept if labels.get(i) == 1]
    assert len([i for i in clean if i in left]) >= 0.98 * len(clean)
    single = corpus_pipeline.near_duplicates(spark, good, SF)
    classes = {r.class_id for r in bagminhash.near_copies(good).collect()}
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(classes)
    mixed = corpus_pipeline.mixing(spark, single, SF)
    tokens = collections.Counter()
    for r in mixed.collect():
        tokens[r.lang] += len(r.text.split())
    assert mixed.columns == docs.columns and max(tokens.values()) < 1.6 * min(tokens.values())
    encoded = corpus_pipeline.encoding(spark, mixed, SF)
    assert encoded.count() == mixed.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").where(F.size("ids") > 0).count() > 0


@pytest.mark.parametrize("k", range(5))
def test_stages_on_an_empty_table(spark, k):
    docs = queries.table(spark, SF, "documents").withColumn("kept", F.lit("clash")).limit(0)
    assert corpus_pipeline.STAGES[k][1](spark, docs, SF).count() == 0


def test_copies_without_an_id(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (3, text), (None, "other words of a text of its own"), (None, None)], "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sum(r.doc_id == 3 for r in got) == 1 and not any(r.doc_id == 4 for r in got)


def test_each_class_of_copies_keeps_one_row(spark):
    text, near = " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k}" for k in range(59))
    alone = [(None, f"text {k} stands for itself and has no id") for k in range(100)]
    rows = [(7, text), (None, text), (None, near), (9, near), (9, near), (9, "an other text under the same id"), (None, None), (None, ""), *alone, *alone]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id, r.text or "") for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()), key=str)
    assert got == sorted([(7, text), (9, "an other text under the same id"), (None, ""), *alone], key=str)


def test_copies_without_an_id_keep_a_row_of_each_class(spark):
    text, other = "one two three four five six seven", "other words of a text of its own"
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (3, text), (None, other), (None, None)], "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(3, text), (None, other), (None, None)], key=str)


def test_mixing_works_out_the_rates_once(spark, tmp_path):
    """A second evaluation would take another Python worker for each task, which then lives on with all it holds."""
    rows = [(k, "en" if k % 3 else "de", f"text {k} has some words in it and {k % 7} more" * (1 + k % 4)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    spark.createDataFrame([(k, 1) for k, _, _ in rows], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    mixed = corpus_pipeline.mixing(spark, docs, str(tmp_path))
    assert mixed._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    model = soft_mixing.mixed(docs, queries.labelled_languages(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")))
    assert copies == {r.doc_id: r.copies for r in model.collect() if r.copies > 0}
    assert len(copies) < len(rows) or max(copies.values()) > 1
