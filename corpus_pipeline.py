"""From raw documents to token ids: quality rules, quality classifier, near copies, mixing, encoding.

``run`` applies the stages to the documents table. Each stage reads what the stage before it kept, stored as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendrisk.llm import bagminhash, bpe, fertility, neighbour_vote, soft_mixing
from lendrisk.llm.queries import labelled_languages
from lendrisk.llm.scratch import discard, importable, written

#: SQL can't express the tokenisers, the classifiers or the signatures; the stages are tested against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the fertility rules keep."""
    importable(spark)
    # the whole row in one column, so that none of its columns meets a measure of the same name
    rows = docs.select(F.struct("*").alias("_doc"), "text", "lang")
    return fertility.fertility_rules(rows, keep_text=False).where("kept").select("_doc.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the vote of labelled neighbours scores 0.5 or more."""
    importable(spark)
    voters = neighbour_vote.fit_voters(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return neighbour_vote.scored(docs, voters, score_col="_score").where("_score >= 0.5").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of near copies: that of its least id, and of that id's texts the one of least digest.

    A row without an id stays only if no row of its class has one. Of rows that repeat the kept id and text one stays.
    """
    importable(spark)
    firsts = written(bagminhash.first_rows(docs).select(F.struct("id", "digest").alias("_key")))
    # null parts of a struct equal each other; repeated rows go before the join, which then finds the rows dealt out by key
    key = F.struct(F.col("doc_id").alias("id"), bagminhash.digest_of(F.col("text")).alias("digest"))
    once = docs.withColumn("_key", key).dropDuplicates(["_key"])
    return once.join(firsts, "_key", "left_semi").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as its rate says, so that the languages' expected tokens are equal.

    A document of rate 1.4 is taken once or, with a probability of 0.4, twice; one of rate 0.4 may fall out.
    """
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = docs.select(F.struct("*").alias("_doc"), "doc_id", "text")
    rates = soft_mixing.mixed(rows, labelled_languages(docs, labels), keep_text=False)
    # no copies explode into no row; a filter on them would work out the rates twice, in two more Python workers a task
    return rates.select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("_doc.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids."""
    importable(spark)
    return bpe.encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        kept = written(stage(spark, docs, sf_dir))
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
