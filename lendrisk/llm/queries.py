"""The operators over the provided tables, whole, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendrisk.llm import (
    bagminhash,
    bpe,
    cover_codes,
    fertility,
    keyed_ids,
    multi_index,
    neighbour_vote,
    reversed_search,
    sliced_simhash,
    soft_mixing,
    tag_paths,
    trie_counts,
    url_filter,
)
from lendrisk.llm.scratch import importable, shared_folder

#: (verdict, host, path prefix) of the rules that ``op4_url_filter`` judges by.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"))


def op2_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_copies(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract_pages(table(spark, sf_dir, "pages"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def labelled_languages(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled documents' languages, as domains to learn."""
    return documents.join(labels.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", F.col("lang").alias("domain"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    domains = labelled_languages(documents, table(spark, sf_dir, "labels"))
    rates = soft_mixing.mixed(documents.select("doc_id", "text"), domains, keep_text=False)
    return rates.select("doc_id", "n_tokens", "domain", "rate", "copies")


def op7_keyed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    keyed_ids.write_ids(table(spark, sf_dir, "documents"), folder)
    return keyed_ids.read_ids(spark, folder)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_counts.token_counts(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    voters = neighbour_vote.fit_voters(documents, table(spark, sf_dir, "labels"))
    found = neighbour_vote.scored(documents, voters)
    return found.select(
        "doc_id", neighbour_vote.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return fertility.fertility_rules(documents, keep_text=False).drop("lang")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.ranked(spark, table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books, length = cover_codes.coded(table(spark, sf_dir, "embeddings"))
    sha = F.lit(cover_codes.digest(books, length)).alias("codebooks_sha256")
    return cover_codes.label_errors(codes).select(F.col("id").alias("vec_id"), "code", "error", "label_error", sha)


def op13_simhash_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliced_simhash.near_copies(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe,
        op2_near_copies,
        op3_main_text,
        op4_url_filter,
        op5_nearest,
        op6_mixing,
        op7_keyed_ids,
        op8_token_counts,
        op9_quality,
        op10_quality_rules,
        op11_ranked_search,
        op12_vector_codes,
        op13_simhash_copies,
    )
}
