"""Hand-written rule files: read with all their errors at once, a template to fill in, a sample to review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import digits, norm_text
from ..operators.relational import hash_sample

# What says yes and no.
YES, NO = "S SIM TRUE T 1 PERMITIDO".split(), "N NAO FALSE F 0 PROIBIDO".split()


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def zoning_rules(df: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """zone, prefix, allowed, source of a rule file with ZONA, CNAE_PREFIXO, PERMITIDO, FONTE (read by read_csv). One bad line refuses the
    whole file: the ValueError lists every error with its line. Lines without zone and prefix are blanks of a template. A rule file is
    written by hand and read by one task, which numbers its lines."""
    x = df.coalesce(1).withColumn("line", F.monotonically_increasing_id() + 2)
    x = x.select("line", _text("ZONA").alias("zone"), digits("CNAE_PREFIXO").alias("prefix"), F.col("CNAE_PREFIXO").alias("given"), norm_text("PERMITIDO").alias("word"), F.col("PERMITIDO").alias("said"), _text("FONTE").alias("source"))
    x = x.where("zone <> '' or prefix <> ''")
    known = x.withColumn("known", F.lit(True))
    if zones is not None:
        known = x.join(zones.select("zone").distinct().withColumn("known", F.lit(True)), "zone", "left")
    again = F.row_number().over(W.partitionBy("zone", "prefix").orderBy("line")) > 1
    said = lambda *parts: F.concat(*(F.coalesce(p, F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts))
    errors = F.array(
        F.when(F.col("known").isNull(), said("zone '", F.col("zone"), "' is not in the zoning layer")),
        F.when(~F.length("prefix").between(2, 7), said("prefix '", F.col("given"), "' needs 2 to 7 digits")),
        F.when(~F.coalesce(F.col("word"), F.lit("")).isin(*YES, *NO), said("'", F.col("said"), "' is neither yes nor no")),
        F.when(F.col("source") == "", F.lit("no source")),
        F.when(again, said("rule repeated for ", F.col("zone"), " x ", F.col("prefix"))),
    )
    checked = known.withColumn("errors", F.filter(errors, lambda e: e.isNotNull()))
    bad = checked.select("line", F.posexplode("errors").alias("k", "error")).orderBy("line", "k").collect()
    if bad:
        raise ValueError("\n".join(f"line {r.line}: {r.error}" for r in bad))
    return checked.select("zone", "prefix", F.col("word").isin(*YES).alias("allowed"), "source")


def rule_template(firms: DataFrame, zones: DataFrame, divisions: DataFrame, rules: DataFrame) -> DataFrame:
    """zone, prefix, allowed (S, N or empty), source, note for every zone and division with active firms: firms(zone, division, active),
    zones(zone, name), divisions(division, name), the rules so far. Order: zone, most firms, division."""
    n = firms.where("active and zone is not null and division is not null").groupBy("zone", "division").agg(F.count(F.lit(1)).alias("n"))
    x = n.join(zones.groupBy("zone").agg(F.max("name").alias("zn")), "zone", "left").join(divisions.groupBy("division").agg(F.max("name").alias("dn")), "division", "left")
    x = x.join(rules.select("zone", F.col("prefix").alias("division"), "allowed", "source"), ["zone", "division"], "left")
    word = F.when(F.col("allowed").isNull(), "").when(F.col("allowed"), "S").otherwise("N")
    note = F.concat_ws(" | ", F.coalesce("zn", F.lit("")), F.coalesce("dn", F.lit("")), F.concat(F.col("n").cast("string"), F.lit(" active")))
    return x.orderBy("zone", F.col("n").desc(), "division").select("zone", F.col("division").alias("prefix"), word.alias("allowed"), F.coalesce("source", F.lit("")).alias("source"), note.alias("note"))


def review_sample(uses: DataFrame, n: int) -> DataFrame:
    """n of the active firms whose use is not allowed, uses(key, active, allowed, ...), the same in every run, with two empty columns to fill
    in."""
    chosen = hash_sample(uses.where("active and allowed = false"), "key", "", n)
    return chosen.withColumns({"agrees": F.lit(""), "remark": F.lit("")})
