"""Exact dedup by distributed most-significant-byte radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, checked_broadcast

#: Bytes that the first level looks at, and how many times more each later level looks at.
FIRST, FACTOR = 32, 8


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The byte string of a text is its length followed by its UTF-8 bytes. Groups start as (length, first 32 bytes) and are split by
    the following 256, 2048, ... bytes; a row leaves as soon as its group is a singleton or the text has ended. Equality therefore
    rests on the bytes themselves; the digest is only reported. Group sizes are counted with map-side combination, and rows get
    their group by an equi-join that AQE splits, so no group of copies ever meets in one task.

    Null texts count as empty. Of equal texts the row with the largest doc_id stays (nulls last); of rows repeated with the same
    doc_id and text exactly one is kept. A null doc_id is kept in its own column as null. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "exact_dedup")
    src = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
        .withColumn("bytes", F.col("t").cast("binary"))
        .withColumn("len", F.octet_length("bytes"))
        .withColumn("block", F.substring("bytes", 1, FIRST))
    )
    heads = scratch.put(
        src.groupBy("len", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("len", "block", F.monotonically_increasing_id().alias("gid")),
        "heads",
    )
    rows = scratch.put(
        src.join(checked_broadcast(heads, 128), ["len", "block"], "left").select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            F.unhex(F.sha2("t", 256)).alias("sha"),
            "gid",
            "len",
            F.when(F.col("gid").isNotNull() & (F.col("len") > FIRST), F.expr(f"substring(bytes, {FIRST + 1})")).alias("rest"),
        ),
        "level0",
    )
    out = ["doc_id", "sha", "rid"]
    done, seen, width, active = [], FIRST, FIRST, rows
    while True:
        more = active.where(f"gid is not null and len > {seen}")
        end = more.isEmpty()
        # rows whose group is known leave, without their texts, so that a level's texts can go
        known = active.where(f"gid is null or len <= {seen}").select(*out, F.lit(len(done)).alias("level"), "gid")
        done.append(scratch.put(known, "done"))
        if end:
            break
        width *= FACTOR
        more = more.withColumn("block", F.substring("rest", 1, width)).withColumn("rest", F.expr(f"substring(rest, {width + 1})"))
        groups = scratch.put(
            more.groupBy("gid", "block")
            .agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1")
            .select("gid", "block", F.monotonically_increasing_id().alias("next")),
            "groups",
        )
        active = scratch.put(
            more.join(groups, ["gid", "block"], "left").select("rid", "doc_id", "sha", F.col("next").alias("gid"), "len", "rest"),
            "level",
        )
        scratch.keep(active, *done)
        seen += width
    all_ = reduce(DataFrame.unionAll, done)
    same, alone = all_.where("gid is not null"), all_.where("gid is null")
    kept = scratch.put(
        same.groupBy("level", "gid").agg(F.max(F.struct("doc_id", "rid")).alias("k"), F.count(F.lit(1)).alias("group_size")), "kept"
    )
    scratch.keep(kept, *done)
    same = same.join(checked_broadcast(kept, 96), ["level", "gid"]).select(
        "doc_id", F.col("k.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("k.rid")).alias("kept"), "sha"
    )
    alone = alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    return same.unionAll(alone).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
