"""From raw documents to packed training sequences in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.llm import decontam, near_dedup, packing, quality, suffix_dedup
from recordlens.llm.common import reach_package, stored, table

BPE = "byte_bpe_50k.json"


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject as junk or toxic."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    judged = quality.verdict(model)("text", "lang", "source", F.col("n_chars").cast("long"))
    return docs.filter(judged["keep"])


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the smallest id.

    Rows without an id stay. Rows that share an id stay if one of them does, one for each text.
    """
    found = near_dedup.near_duplicates(docs)
    kept = found.filter("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").withColumn("_mark", F.xxhash64("text"))
    return named.dropDuplicates(["doc_id", "_mark"]).drop("_mark").unionAll(docs.filter("doc_id is null"))


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 400 bytes and the passages of over 50 words that start more than once."""
    return suffix_dedup.remove(docs, words=51)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; rows are told apart by id and text."""
    marked = docs.withColumn("_mark", F.xxhash64("doc_id", "text"))
    leaks = decontam.passages(marked, table(spark, sf_dir, "benchmark"), id_col="_mark")
    return marked.join(leaks.select(F.col("doc_id").alias("_mark")).distinct(), "_mark", "left_anti").drop("_mark")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    reach_package(spark)
    return packing.pack(docs, public_tokenizers.path(BPE), keep=False)


STAGES = [
    ("quality classifier", good),
    ("near-duplicates", distinct),
    ("repeated strings", unrepeated),
    ("benchmark decontamination", clean),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
