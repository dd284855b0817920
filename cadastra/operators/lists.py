"""Public lists, contracts, requests, stops: rollups onto companies and places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import dimension, or_empty


def list_rollup(entries: DataFrame, firms: DataFrame, specs: DataFrame) -> DataFrame:
    """key, list, via, n, value, last, labels (first five distinct, joined). entries(list, cnpj, root, date, value, label), firms(key, root),
    specs(list, level, rule): lists of establishments join by full number, of companies by root. value is the sum, mean or last period's
    sum by the list's rule, null for `nenhum`.

    Entries are summed by (list, number or root, date) and their labels made distinct before they meet firms, so what fans out is one row
    per list and root, not one per entry."""
    e = entries.join(dimension(specs), "list").withColumn("by", F.when(F.col("level") == "establishment", F.col("cnpj").cast("string")).otherwise(F.col("root").cast("string")))
    day = e.groupBy("list", "level", "rule", "by", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"), F.count("value").alias("c"), F.collect_set("label").alias("labels")
    )
    g = day.groupBy("list", "level", "rule", "by").agg(
        F.sum("n").alias("n"), F.sum("s").alias("total"), F.sum("c").alias("c"), F.max(F.struct("date", "s")).alias("m"),
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.slice(F.array_sort("labels"), 1, 5))))), 1, 5).alias("labels"),
    )
    value = F.when(F.col("rule") == "soma", F.col("total")).when(F.col("rule") == "media", F.col("total") / F.nullif(F.col("c"), F.lit(0)))
    value = value.when((F.col("rule") == "ultimo") & F.col("m.date").isNotNull(), F.col("m.s"))
    g = g.select("list", "level", "by", "n", value.alias("value"), F.col("m.date").alias("last"), F.array_join("labels", "|").alias("labels"))
    out = ["key", "list", "via", "n", "value", "last", "labels"]
    f = firms.select("key", F.col("key").cast("string").alias("k"), F.col("root").cast("string").alias("r"))
    direct = g.where("level = 'establishment'").join(f, F.col("by") == F.col("k")).withColumn("via", F.lit("cnpj"))
    roots = g.where("level = 'company'").join(f, F.col("by") == F.col("r"))
    # of lists by root, the companies that an entry names themselves
    named = e.where("level = 'company'").select("list", F.col("cnpj").cast("string").alias("k")).where("k is not null").distinct().withColumn("named", F.lit(True))
    roots = roots.join(named, ["list", "k"], "left").withColumn("via", F.when(F.col("named"), "cnpj").otherwise("raiz"))
    return direct.select(*out).unionAll(roots.select(*out))


def contracts_rollup(items: DataFrame, key: str, contract: str, value: str, day: str, as_of: str) -> DataFrame:
    """key, items, contracts (distinct), running (distinct, not ended), total."""
    running = F.when(F.col(day) >= F.to_date(F.lit(as_of)), F.col(contract))
    return items.groupBy(key).agg(
        F.count(F.lit(1)).alias("items"), F.count_distinct(contract).alias("contracts"), F.count_distinct(running).alias("running"), F.round(F.sum(value), 2).alias("total")
    )


def requests_rollup(requests: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, answered, median days to the answer of requests(opened, answered_on, ...)."""
    days = F.datediff("answered_on", "opened")
    return requests.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count("answered_on").alias("answered"), F.percentile(days, F.lit(0.5)).alias("median_days"))


def stops_rollup(departures: DataFrame) -> DataFrame:
    """cell, stops, routes (the most at one stop), departures of departures(stop, route, cell)."""
    s = departures.groupBy("stop", "cell").agg(F.count(F.lit(1)).alias("d"), F.count_distinct("route").alias("r"))
    return s.groupBy("cell").agg(F.count(F.lit(1)).alias("stops"), F.max("r").alias("routes"), F.sum("d").alias("departures"))


def buildings_rollup(buildings: DataFrame) -> DataFrame:
    """cell, buildings, footprint and floor area of buildings(cell, area, floors, height): floors, else height over three metres (one at
    least), else one."""
    floors = F.when(F.col("floors") > 0, F.col("floors").cast("double")).when(F.col("height").isNotNull(), F.greatest(F.col("height") / 3.0, F.lit(1.0))).otherwise(1.0)
    return buildings.groupBy("cell").agg(
        F.count(F.lit(1)).alias("buildings"), F.round(F.sum("area"), 1).alias("footprint"), F.round(F.sum(F.col("area") * floors), 1).alias("floor_area")
    )


def facilities(raw: DataFrame) -> DataFrame:
    """One row per code of raw(code, name, theme, kind, subkind, authority, morning, afternoon, night, all_day, street, number, district,
    region), blanks as null, with shifts: which of manha, tarde, noite, 24h it is open, joined."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    on = lambda c, word: F.when(F.upper(c).isin("S", "SIM", "1", "TRUE"), F.lit(word))
    shifts = F.concat_ws(",", on("morning", "manha"), on("afternoon", "tarde"), on("night", "noite"), on("all_day", "24h"))
    cols = ["name", "theme", "kind", "subkind", "authority"]
    place = ["street", "number", "district", "region"]
    x = raw.select(blank("code").alias("code"), *(blank(c).alias(c) for c in cols), F.nullif(shifts, F.lit("")).alias("shifts"), *(blank(c).alias(c) for c in place))
    return x.where("code is not null").groupBy("code").agg(F.min(F.struct(*cols, "shifts", *place)).alias("r")).select("code", "r.*")


def signals(firms: DataFrame, contracts: DataFrame | None, debts: DataFrame | None, sanctions: DataFrame | None) -> DataFrame:
    """key, contract_value, debt_value, sanctioned; a source that isn't there gives nulls. Facts are reduced to firms by semi-joins before
    they are grouped."""
    spark = firms.sparkSession
    c, d, s = or_empty(contracts, spark, "key string, value double"), or_empty(debts, spark, "key string, value double"), or_empty(sanctions, spark, "key string, active boolean")
    keys = firms.select("key")
    c = c.join(keys, "key", "left_semi").groupBy("key").agg(F.sum("value").alias("contract_value"))
    d = d.join(keys, "key", "left_semi").groupBy("key").agg(F.sum("value").alias("debt_value"))
    s = s.join(keys, "key", "left_semi").groupBy("key").agg(F.bool_or("active").alias("sanctioned"))
    return keys.join(c, "key", "left").join(d, "key", "left").join(s, "key", "left")


def incidents(raw: DataFrame, natures: list[str], code: str, civil: str) -> DataFrame:
    """code and its sorted distinct categories of raw incident rows: all nature columns as rows, grouped by code; rows of civil defence
    natures add `fisico`. Rows without a code get the hash of their columns."""
    from ..functions.text import category

    ident = F.coalesce(F.nullif(F.trim(code), F.lit("")), F.md5(F.concat_ws("|", *(F.coalesce(F.col(c), F.lit("")) for c in raw.columns))))
    cats = F.filter(F.array(*map(category, natures), F.when(F.nullif(F.trim(civil), F.lit("")).isNotNull(), F.lit("fisico"))), lambda c: c.isNotNull())
    x = raw.select(ident.alias("code"), F.explode(F.when(F.size(cats) == 0, F.array(F.lit("outros"))).otherwise(cats)).alias("category"))
    return x.groupBy("code").agg(F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"))
