"""Security incidents: files to facts, streets placed within districts, monthly counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import any_date, hour
from ..functions.text import category, norm_text
from .geo import interior_point, polygon_hits, representative_points, rings_of
from .relational import dimension


def yes(c: str | Column) -> Column:
    # What says yes.
    return F.upper(F.trim(c)).isin("S", "SIM", "1", "T", "TRUE", "Y")


def facts(raw: DataFrame, districts: DataFrame, natures: int = 5) -> DataFrame:
    """code, date, hour, district, region, street, natures, categories, civil_defence, equipment, flagrant: one row per code of raw rows
    with code, date, hour, district, region, street, equipment, flagrant and n1, d1, n2, d2, ... (a nature and whether it is civil defence).
    The earliest row of a code gives its facts, all of its rows the natures. Rows without a code get the hash of all columns. Categories are
    distinct and sorted, with `fisico` for civil defence; districts(name) give the spelling. Hours outside 0 to 23 are null."""
    code = F.coalesce(F.nullif(F.trim("code"), F.lit("")), F.md5(F.to_json(F.struct(*raw.columns))))
    line = raw.withColumn("code", code)
    each = F.array(*(F.struct(F.trim(f"n{k}").alias("n"), yes(f"d{k}").alias("d")) for k in range(1, natures + 1)))
    nat = line.select("code", F.explode(each).alias("x")).where("x.n <> ''")
    nat = nat.groupBy("code").agg(F.array_sort(F.collect_set("x.n")).alias("natures"), F.bool_or(F.coalesce("x.d", F.lit(False))).alias("civil"))
    day = any_date("date")
    rest = [c for c in ("hour", "district", "region", "street", "equipment", "flagrant")]
    fact = line.groupBy("code").agg(F.min(F.struct(day.isNull().alias("_n"), day.alias("date"), *rest)).alias("f")).select("code", "f.date", *(f"f.{c}" for c in rest))
    names = districts.select(norm_text("name").alias("_k"), "name").groupBy("_k").agg(F.min("name").alias("_name"))
    x = fact.join(nat, "code", "left").join(dimension(names), norm_text("district") == F.col("_k"), "left")
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    kinds = F.concat(F.coalesce(F.transform("natures", lambda n: category(n)), F.array().cast("array<string>")), F.array(F.when(F.col("civil"), F.lit("fisico"))))
    kinds = F.array_sort(F.array_distinct(F.filter(kinds, lambda c: c.isNotNull())))
    return x.select(
        "code", "date", hour("hour").alias("hour"), F.coalesce("_name", F.upper(blank("district"))).alias("district"), F.upper(blank("region")).alias("region"), blank("street").alias("street"),
        "natures", F.when(F.size(kinds) > 0, kinds).alias("categories"), F.coalesce("civil", F.lit(False)).alias("civil_defence"), blank("equipment").alias("equipment"), yes("flagrant").alias("flagrant"),
    )


def locate_streets(wanted: DataFrame, census: DataFrame, districts: DataFrame, cell: float) -> DataFrame:
    """street, district, level, x, y for wanted(street, district), both as keys: the address of census(street, x, y) in the district that
    is closest to the centre of the street's addresses there (logradouro_no_bairro), else a point inside the district (bairro), else
    nothing (nao_localizado). districts(district, ring or rings). Only addresses of streets asked for are tested against districts."""
    wanted = wanted.select(F.coalesce("street", F.lit("")).alias("street"), F.coalesce("district", F.lit("")).alias("district")).distinct()
    asked = wanted.where("street <> ''")
    points = census.join(asked.select("street").distinct(), "street", "left_semi").select(F.struct("street", "x", "y").alias("id"), "x", "y").distinct()
    inside = polygon_hits(points, districts, "district", cell).select("id.street", "district", "id.x", "id.y").join(asked, ["street", "district"], "left_semi")
    inside = inside.select(F.struct("street", "district").alias("pair"), F.struct("x", "y").alias("id"), "x", "y")
    best = representative_points(inside, "pair").select("pair.street", "pair.district", F.struct("x", "y").alias("a"))
    own = districts.select("district", interior_point(rings_of(districts)).alias("b"))
    out = wanted.join(best, ["street", "district"], "left").join(dimension(own), "district", "left")
    level = F.when(F.col("a").isNotNull(), "logradouro_no_bairro").when(F.col("b").isNotNull(), "bairro").otherwise("nao_localizado")
    at = F.coalesce("a", "b")
    return out.select("street", "district", level.alias("level"), at["x"].alias("x"), at["y"].alias("y"))


def monthly(incidents: DataFrame) -> DataFrame:
    """source, district, month, category, n of incidents(source, district, date, categories): one in several categories counts in each, one
    without any as `outros`."""
    kinds = F.coalesce("categories", F.array(F.lit("outros")))
    x = incidents.where("date is not null").select("source", "district", F.trunc("date", "month").alias("month"), F.explode(kinds).alias("category"))
    return x.groupBy("source", "district", "month", "category").agg(F.count(F.lit(1)).alias("n"))
