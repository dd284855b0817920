"""Signals of firms from their permits, the criteria of the lead score, score bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import or_empty, percentiles
from .risk import WEIGHTS, lead_score

# The lists that count as other public lists.
OTHER_LISTS = "cadastur cnes mapa_sif anp_revendas anatel_scm ibama_ctf iat_licencas emec".split()


def at_shop(profile_type: str = "point_type", registered: str = "registered_only") -> Column:
    """At a commercial or mixed point that isn't a mere registered office."""
    return F.coalesce(F.col(profile_type).isin("commercial", "mixed"), F.lit(False)) & ~F.coalesce(F.col(registered), F.lit(False))


def permit_signals(firms: DataFrame, matches: DataFrame, permits: DataFrame, profile: DataFrame, as_of: str) -> DataFrame:
    """key, permit, has_permit, active_without_permit, permit_of_closed, expired, other_activity, permit_activity, arrived. firms(key, active,
    activity, start), matches(permit, firm), permits(permit, activity, start, expiry), profile(key, point_type, registered_only). An activity
    differs if its first five digits do; arrived is the permit's start where that is later than the firm's."""
    p = permits.select("permit", F.col("activity").alias("permit_activity"), F.col("start").alias("p_start"), "expiry")
    x = firms.join(matches.select(F.col("firm").alias("key"), "permit"), "key", "left").join(p, "permit", "left")
    x = x.join(profile.select("key", "point_type", "registered_only"), "key", "left")
    has = F.col("permit").isNotNull()
    same = F.left("permit_activity", F.lit(5)).eqNullSafe(F.left("activity", F.lit(5)))
    return x.select(
        "key", "permit", has.alias("has_permit"), (F.col("active") & ~has & at_shop()).alias("active_without_permit"), (~F.col("active") & has).alias("permit_of_closed"),
        (F.col("expiry") < F.to_date(F.lit(as_of))).alias("expired"), (has & ~same).alias("other_activity"), "permit_activity",
        F.when(F.col("p_start") > F.col("start"), F.col("p_start")).alias("arrived"),
    )


def median_risk(risk: DataFrame) -> DataFrame:
    """division, median of risk(key, division, risk)."""
    return percentiles(risk.where("risk is not null"), ["division"], "risk", {"median": 0.5})


def lead_criteria(
    firms: DataFrame, as_of: str, profile: DataFrame | None = None, signals: DataFrame | None = None, permits: DataFrame | None = None, contracts: DataFrame | None = None,
    momentum: DataFrame | None = None, risk: DataFrame | None = None, lists: DataFrame | None = None,
) -> tuple[DataFrame, dict[str, Column]]:
    """Active firms(key, size, mei, start, division, cell, active) with all that the criteria look at, and the criteria. Steps that didn't run
    give empty tables: profile(key, point_type, registered_only, active_of_root), signals(key, contracts, debts, sanctions: counts),
    permits(key, has_permit, expired), contracts(key), momentum(cell, momentum), risk(key, division, risk), lists(key, list)."""
    spark = firms.sparkSession
    profile = or_empty(profile, spark, "key string, point_type string, registered_only boolean, active_of_root long")
    signals = or_empty(signals, spark, "key string, contracts long, debts long, sanctions long")
    permits = or_empty(permits, spark, "key string, has_permit boolean, expired boolean")
    contracts = or_empty(contracts, spark, "key string").select("key").distinct().withColumn("supplier", F.lit(True))
    momentum = or_empty(momentum, spark, "cell string, momentum long").select("cell", "momentum")
    risk = or_empty(risk, spark, "key string, division string, risk double")
    lists = or_empty(lists, spark, "key string, list string").groupBy("key").agg(F.collect_set("list").alias("lists"))
    x = firms.where("active")
    for t in (profile.select("key", "point_type", "registered_only", "active_of_root"), signals.select("key", "contracts", "debts", "sanctions"), permits.select("key", "has_permit", "expired"), contracts, lists, risk.select("key", "risk")):
        x = x.join(t, "key", "left")
    x = x.join(momentum, "cell", "left").join(median_risk(risk), "division", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    return x, {
        "porte_epp": F.col("size") == "03",
        "porte_demais": F.col("size") == "05",
        "nao_mei": F.coalesce("mei", F.lit("N")) != "S",
        "idade_2a": F.col("start") <= F.add_months(F.to_date(F.lit(as_of)), -24),
        "ponto_comercial": at_shop(),
        "rede": F.coalesce("active_of_root", F.lit(0)) > 1,
        "fornecedor_publico": yes("supplier") | n("contracts"),
        "lista_exportadora": F.array_contains("lists", "mdic_exportadoras"),
        "lista_credito": F.array_contains("lists", "bndes_operacoes"),
        "lista_outras": F.arrays_overlap("lists", F.array(*map(F.lit, OTHER_LISTS))),
        "alvara_ok": yes("has_permit") & ~yes("expired"),
        "hexagono_crescendo": F.col("momentum") > 0,
        "risco_baixo": F.col("risk") < F.col("median"),
        "divida_pgfn": n("debts"),
        "sancao": n("sanctions"),
    }


def leads(firms: DataFrame, as_of: str, weights: dict[str, int] = WEIGHTS, **tables: DataFrame) -> DataFrame:
    """key, score, criteria of all active firms."""
    x, criteria = lead_criteria(firms, as_of, **tables)
    return lead_score(x, criteria, weights)


def score_bands(scored: DataFrame, parts: int = 5) -> DataFrame:
    """band (1 to `parts` over 0 to 100, 100 in one of its own), n, lowest and highest score."""
    band = F.width_bucket(F.col("score").cast("double"), F.lit(0.0), F.lit(100.0), F.lit(parts)).alias("band")
    return scored.groupBy(band).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"))
