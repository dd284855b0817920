"""The corpus pipeline: quality, line dedup, near-duplicate documents, source mix, tokens.

Every stage works on all that the one before it kept, written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import line_dedup, mixing, ngram_join, quality, sentencepiece_trie
from cadastra.llm.shared import Scratch, checked_broadcast

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of its training folds, doesn't reject. Null, empty and blank ones go: they
    score 0. Without labels of both classes all stay. The score is joined to nothing: it is computed beside the row, so repeated rows and
    null ids fare like others; an empty table gives an empty one."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, quality.train(docs, labels)).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that another kept line repeats; documents that had lines and lost them all go. Null and blank texts stay as
    they are; rows repeated with equal doc_id and text stay as often, for the next stage; an empty table gives an empty one."""
    out = line_dedup.line_dedup(docs.select(*COLUMNS))
    left = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "") != ""
    return out.where((F.col("n_dropped") == 0) | left).withColumn(
        "n_chars", F.char_length("text").cast("long")
    ).select(*COLUMNS)


def drop_near_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of rows linked at five-word shingles and Jaccard 0.8 one row: the one with the smallest doc_id (nulls last), then
    the smallest text hash. Rows are told apart by doc_id and text, so a row that shares just its doc_id with a near copy stays, and rows
    repeated with both equal are one group; rows without words link with nothing and stay. An empty table gives an empty one."""
    scratch = Scratch(spark, "near_documents")
    found = ngram_join.grouped(docs, words=5, percent=80).where("group is not null")
    found = scratch.put(found.select("group", F.struct(F.col("doc_id").isNull().alias("_n"), "doc_id", "th").alias("_near")), "groups")
    kept = scratch.put(found.groupBy("group").agg(F.min("_near").alias("_keep")), "kept")
    ruled = found.join(checked_broadcast(kept, 64), "group").groupBy("_near").agg(F.max(F.col("_near") == F.col("_keep")).alias("_stays"), F.count(F.lit(1)).alias("_times"))
    ruled = scratch.put(ruled.where("not _stays or _times > 1"), "ruled")
    scratch.keep(ruled)
    me = F.struct(F.col("doc_id").cast("long").isNull().alias("_n"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"))
    rows = docs.select(*COLUMNS).withColumn("_me", me).join(checked_broadcast(ruled, 96), F.col("_me") == F.col("_near"), "left")
    single = rows.where("_near is null").select(*COLUMNS)
    # rows that are repeated as they are: one of them, the smallest
    again = rows.where("_stays").groupBy("_me").agg(F.min(F.struct(*COLUMNS)).alias("_row"))
    return single.unionByName(again.select("_row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document as often as its epochs say, the one on a source's boundary once more with only its first missing words.
    Documents without words are taken 0 times; null sources are one source; an empty table gives an empty one."""
    return mixing.emit(docs, COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to the text again; null texts have null ids; repeated rows come back each."""
    return sentencepiece_trie.encode(docs.select("doc_id", "source", "text"), sentencepiece_trie.MODEL)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_documents),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]

#: A trained classifier, MinHash and a tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
    return docs
