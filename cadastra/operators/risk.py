"""Closure hazard with shrinkage, back-testing, lead score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import completed_years
from .relational import auc, cut, deciles

#: Pseudo-observations towards the wider group, for hazards and for districts.
K_GROUP, K_DISTRICT = 50.0, 20.0
# Points of each criterion.
WEIGHTS = {
    "porte_epp": 10, "porte_demais": 15, "nao_mei": 5, "idade_2a": 10, "ponto_comercial": 10, "rede": 10, "fornecedor_publico": 15,
    "lista_exportadora": 10, "lista_credito": 10, "lista_outras": 5, "alvara_ok": 5, "hexagono_crescendo": 5, "risco_baixo": 10,
    "divida_pgfn": -10, "sancao": -30,
}


def band(age: Column) -> Column:
    """Age in completed years as 0-1, 1-2, 2-3, 3-5, 5-10, 10+."""
    out = F.when(age < 1, "0-1").when(age < 2, "1-2").when(age < 3, "2-3").when(age < 5, "3-5").when(age < 10, "5-10")
    return out.otherwise("10+")


def january(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def exposure(firms: DataFrame, first: int, last: int) -> DataFrame:
    """key, year, division, small, district, band, event: one row per firm and year in which it stood on 1 January; event: it closed in
    that year. firms(key, division, small, district, start, active, changed). Years come from a generated sequence, not a join."""
    x = firms.where("division is not null").withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    x = x.where((F.col("start") < january(F.col("year"))) & (F.col("active") | (F.col("changed") >= january(F.col("year")))))
    event = ~F.col("active") & (F.col("changed") < january(F.col("year") + 1))
    return x.select("key", "year", "division", "small", "district", band(completed_years("start", january(F.col("year")))).alias("band"), F.coalesce(event, F.lit(False)).cast("int").alias("event"))


def fit(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Hazards: overall, by (band, small) shrunk to it, by (division, band, small) shrunk to that, and the district multiplier."""
    cell = rows.groupBy("division", "band", "small", "district").agg(F.count(F.lit(1)).alias("n"), F.sum("event").alias("e"))
    hg = cell.agg(F.coalesce(F.sum("e") / F.sum("n").cast("double"), F.lit(0.0)).alias("hg"))
    h0 = cell.groupBy("band", "small").agg(F.sum("n").alias("n"), F.sum("e").alias("e")).crossJoin(F.broadcast(hg))
    h0 = h0.select("band", "small", ((F.col("e") + K_GROUP * F.col("hg")) / (F.col("n") + K_GROUP)).alias("h0"))
    h1 = cell.groupBy("division", "band", "small").agg(F.sum("n").alias("n"), F.sum("e").alias("e")).join(h0, ["band", "small"])
    h1 = h1.select("division", "band", "small", ((F.col("e") + K_GROUP * F.col("h0")) / (F.col("n") + K_GROUP)).alias("h1"))
    m = cell.where("district is not null").join(h1, ["division", "band", "small"]).groupBy("district")
    mult = m.agg(((F.sum("e") + K_DISTRICT) / (F.sum(F.col("n") * F.col("h1")) + K_DISTRICT)).alias("mult"))
    return hg, h0, h1, mult


def predict(rows: DataFrame, model: tuple[DataFrame, DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """rows with risk: the finest hazard there is times the district's multiplier, 1 at most."""
    hg, h0, h1, mult = model
    x = rows.join(h1, ["division", "band", "small"], "left").join(h0, ["band", "small"], "left").join(mult, "district", "left").crossJoin(F.broadcast(hg))
    return x.withColumn("risk", F.least(F.lit(1.0), F.coalesce("h1", "h0", "hg") * F.coalesce("mult", F.lit(1.0)))).drop("h1", "h0", "hg", "mult")


def current_risk(firms: DataFrame, base: int, as_of: str) -> DataFrame:
    """key, division, risk of active firms at a date, from the five years before the base year."""
    model = fit(exposure(firms, base - 5, base - 1))
    day = F.to_date(F.lit(as_of))
    now = firms.where("active and division is not null").select("key", "division", "small", "district", band(completed_years("start", day)).alias("band"))
    return predict(now, model).select("key", "division", F.round("risk", 4).alias("risk"))


def backtest(firms: DataFrame, target: int) -> DataFrame:
    """key, risk, event of one year, from the five years before it."""
    model = fit(exposure(firms, target - 5, target - 1))
    return predict(exposure(firms, target, target), model).select("key", "risk", "event")


def validation(firms: DataFrame, base: int, years: int = 3) -> tuple[DataFrame, DataFrame]:
    """Back-tests of the years before the base year, each from the five years before it: (year, n, events, observed, predicted, auc) and
    the calibration (year, decile, n, predicted, observed). Rates are rounded half to even, four decimals; tied risks order by key."""
    rates, tables = [], []
    for year in range(base - years, base):
        found = cut(backtest(firms, year))
        sums = found.agg(F.count(F.lit(1)).alias("n"), F.sum("event").alias("events"), F.avg("event").alias("observed"), F.avg("risk").alias("predicted")).where("n > 0")
        score = auc(found, "risk", "event").select("auc")
        rates.append(sums.join(score, F.lit(True)).select(F.lit(year).alias("year"), "n", "events", F.bround("observed", 4).alias("observed"), F.bround("predicted", 4).alias("predicted"), "auc"))
        slices = deciles(found, [F.col("risk"), F.col("key")]).groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.avg("risk").alias("p"), F.avg("event").alias("o"))
        tables.append(slices.select(F.lit(year).alias("year"), "decile", "n", F.bround("p", 4).alias("predicted"), F.bround("o", 4).alias("observed")))
    return reduce(DataFrame.unionAll, rates), reduce(DataFrame.unionAll, tables)


def lead_score(firms: DataFrame, criteria: dict[str, Column], weights: dict[str, int] = WEIGHTS) -> DataFrame:
    """key, score from 0 to 100, criteria that hold (joined, most points first, then by name). All in one projection: no unpivot and no
    join back. Criteria that are null don't count."""
    each = F.array(
        *(
            F.when(ok, F.struct(F.lit(-weights[name]).alias("p"), F.lit(name).alias("c")))
            for name, ok in criteria.items()
        )
    )
    held = F.array_sort(F.filter(each, lambda x: x.isNotNull()))
    points = F.aggregate(held, F.lit(0), lambda t, x: t - x["p"])
    return firms.select(
        "key",
        F.greatest(F.lit(0), F.least(F.lit(100), points)).alias("score"),
        F.array_join(F.transform(held, lambda x: x["c"]), ",").alias("criteria"),
    )
