"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import Scratch, checked_broadcast

#: A word, everywhere here.
WORD = r"[^\x20\x09-\x0D]+"
#: At most so many times may a source (and so a document) be repeated.
MOST = 3
#: Key ranges of a source, in three nested levels of so many each.
FAN = 256


def size_of(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Weight above 0 of a text: highest for prose of about six characters a word, lower the farther the mean is from that."""
    mean = F.char_length(F.coalesce(text, F.lit(""))).cast("double") / F.greatest(size, F.lit(1)).cast("double")
    return F.greatest(F.lit(0.25), F.lit(1.0) / (F.lit(1.0) + F.abs(mean - F.lit(6.0)) / F.lit(6.0)))


def uniform(seed: str, *parts: Column) -> Column:
    """A reproducible number in (0, 1) from 52 bits of an MD5 of the seed and parts."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target from sources(source, source_size), one row per source.

    Water-filling in closed form: with the sources sorted by cap / weight, the level is the largest of (total - caps before) /
    (weight - weights before), and a target is the smaller of cap and level x weight. The windows run over one row per source, the
    only single-task step here.
    """
    w = sizes.withColumn("w", (F.lit(1) + (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % 3).cast("long"))
    w = w.withColumn("cap", F.lit(MOST).cast("long") * F.col("source_size"))
    order = W.orderBy((F.col("cap").cast("double") / F.col("w")), F.col("source").asc_nulls_last())
    before, all_ = order.rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total, weight = F.sum("source_size").over(all_), F.sum("w").over(all_)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / (
        weight - F.coalesce(F.sum("w").over(before), F.lit(0))
    ).cast("double")
    return w.withColumn("level", level).withColumn(
        "target", F.least(F.col("cap").cast("double"), F.max("level").over(all_) * F.col("w").cast("double"))
    ).select("source", "source_size", "target")


def mix(docs: DataFrame, seed: str = "mix", weight: Column | None = None, text_col: str = "text", carry: list[str] = []) -> DataFrame:  # noqa: B006
    """One row per input row: doc_id, source, size, source_size, target, taken.

    A source takes floor(target / source_size) complete epochs of all its documents; the words still missing come from documents in
    the order of their exponential keys -ln(u) / weight, whose running sum of sizes is cut at the budget: the document on the
    boundary gives just the missing words, so that each source takes floor(target) words.

    No source is sorted in one task: keys fall into 256^3 nested ranges, whose sums (combined on the map side) show in which range
    the budget ends; only that range's documents are sorted. The per-source bounds join back as a checked broadcast.

    Null or empty texts have size 0 and are taken 0 times; null sources form one source, last in order. u comes from the seed,
    doc_id and size, so reruns agree; rows equal in these tie and share a source's order arbitrarily among themselves. An empty
    table gives an empty result. carry: names of further columns to pass through.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    text = F.col(text_col)
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), size_of(text).alias("size"), text.alias("t"), *carry)
    rows = rows.withColumn("weight", quality_weight(F.col("t"), F.col("size")) if weight is None else weight)
    key = -F.ln(uniform(seed, F.col("doc_id"), F.col("size"))) / F.col("weight")
    rows = rows.select("doc_id", "source", "size", key.alias("key"), *carry)
    rows = rows.withColumn("range", F.least(F.floor(F.col("key") / (F.col("key") + 1.0) * FAN**3), F.lit(FAN**3 - 1)).cast("long"))
    rows = scratch.put(rows, "rows")
    ranges = scratch.put(rows.groupBy("source", "range").agg(F.sum("size").alias("s")), "ranges")
    targets = scratch.put(source_targets(ranges.groupBy("source").agg(F.sum("s").alias("source_size"))), "targets")
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST))).otherwise(0).cast("long")
    missing = F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    bounds = targets.withColumn("epochs", epochs).withColumn("left", F.greatest(missing, F.lit(0)))
    bounds = bounds.withColumn("lo", F.lit(0).cast("long"))
    for width in (FAN**2, FAN, 1):  # go down to the range in which the budget ends; at most FAN rows a source and level
        b = checked_broadcast(bounds, 256, alias=lambda x: x.select(F.col("source").alias("src"), "lo", "left"))
        inside = (
            ranges.join(b, F.col("source").eqNullSafe(F.col("src")))
            .where((F.col("range") >= F.col("lo")) & (F.col("range") < F.col("lo") + FAN * width))
            .groupBy("src", "lo", "left", F.floor((F.col("range") - F.col("lo")) / width).alias("part"))
            .agg(F.sum("s").alias("s"))
        )
        before = F.coalesce(F.sum("s").over(W.partitionBy("src").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        at = (
            inside.withColumn("before", before)
            .where("before <= left")
            .groupBy("src")
            .agg(F.max(F.struct("part", "before")).alias("m"))
            .select("src", "m.part", "m.before")
        )
        bounds = scratch.put(
            bounds.join(at, F.col("source").eqNullSafe(F.col("src")), "left").select(
                "source",
                "source_size",
                "target",
                "epochs",
                (F.col("left") - F.coalesce("before", F.lit(0))).alias("left"),
                (F.col("lo") + F.coalesce("part", F.lit(0)) * width).alias("lo"),
            ),
            "bounds",
        )
    scratch.keep(rows, bounds)
    b = checked_broadcast(bounds, 256, alias=lambda x: x.withColumnRenamed("source", "src"))
    all_ = rows.join(b, F.col("source").eqNullSafe(F.col("src"))).drop("src")
    order = W.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    edge = all_.where("range = lo").withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    edge = edge.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("before"))))
    rest = all_.where("range <> lo").withColumn("extra", F.when(F.col("range") < F.col("lo"), F.col("size")).otherwise(0))
    cols = ["doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("extra")).cast("long").alias("taken"), *carry]
    return edge.select(*cols).unionAll(rest.select(*cols))


def emit(docs: DataFrame, columns: list[str], seed: str = "mix") -> DataFrame:
    """The mixed corpus, with the given columns of docs(doc_id, source, text, ...): a row for each complete take of a document, and
    one with its first words where a take is partial (the document on its source's boundary); there n_chars, if asked for, is
    counted anew. Rows repeated with equal doc_id, source and text share their words evenly, rounded down. Empty texts are taken 0
    times. Words join back to the texts by doc_id, source and text hash."""
    scratch = Scratch(docs.sparkSession, "mixed")
    ident = F.xxhash64("text")
    taken = mix(docs.select("doc_id", "source", "text", ident.alias("_mix_th")), seed, carry=["_mix_th"]).where("taken > 0")
    taken = taken.groupBy("doc_id", "source", "_mix_th").agg(F.max("size").alias("size"), F.floor(F.sum("taken") / F.count(F.lit(1))).alias("words"))
    taken = scratch.put(taken.select(F.struct("doc_id", "source", "_mix_th", "size", "words").alias("_mix")), "taken")
    same = F.col("doc_id").eqNullSafe(F.col("_mix.doc_id")) & F.col("source").eqNullSafe(F.col("_mix.source")) & (ident == F.col("_mix._mix_th"))
    rows = docs.select(*dict.fromkeys([*columns, "doc_id", "source", "text"])).join(checked_broadcast(taken, 96), same)
    epochs, rest = F.floor(F.col("_mix.words") / F.col("_mix.size")).cast("int"), F.col("_mix.words") % F.col("_mix.size")
    scratch.keep(taken)
    whole = rows.where(epochs > 0).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), epochs))).select(*columns)
    pieces = F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(F.col("text").rlike(r"\A[\x20\x09-\x0D]"), 1).otherwise(0)
    part = rows.where(rest > 0).withColumn("text", F.array_join(F.slice(pieces, F.lit(1), (rest + lead).cast("int")), ""))
    if "n_chars" in columns:
        part = part.withColumn("n_chars", F.char_length("text").cast("long"))
    return whole.unionByName(part.select(*columns))


#: The same mix in SQL. Arithmetic is in the same order, so targets and cuts agree to the last bit.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         length(coalesce(text, ''))::DOUBLE AS chars
  FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5)
                / 4503599627370496.0)
            / greatest(0.25, 1.0 / (1.0 + abs(chars / greatest(size, 1)::DOUBLE - 6.0) / 6.0)) AS key
  FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::BIGINT AS w, 3 * source_size AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER o, 0))::DOUBLE AS level
  FROM w WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * w::DOUBLE) AS target FROM l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS epochs FROM t),
r AS (
  SELECT k.*, e.source_size, e.target, e.epochs, greatest(floor(e.target)::BIGINT - e.epochs * e.source_size, 0) AS remaining,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target, (epochs * size + greatest(0, least(size, remaining - before)))::BIGINT AS taken FROM r
"""
