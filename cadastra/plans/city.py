"""Queries of the product's larger operators: geocoding, permits, leads, profiles of areas, incidents, lists, timetables, back-tests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import geo, graph, indicators, leads, lists, relational, resolve, risk, security
from ..sources import public_lists
from .catalog import AS_OF, CELL, GEO, HAZ, LIFE, TRI, firms, hazard_firms, haversine, located, placed, register, t, zones

def key() -> Column:
    return F.col("key")


def pick(values: list, i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))


# -- geocoding

CENSUS = """c AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 > 0 THEN s_nationkey::VARCHAR END AS cep, ['ALFA', 'BETA', 'ALFABETO', 'GAMA'][s_suppkey % 4 + 1] AS street,
  ['ALFA', 'BETA', 'ALFABETO', 'GAMA'][s_suppkey % 4 + 1] || ' ' || (s_suppkey % 3) AS "full", CASE WHEN s_suppkey % 6 > 0 THEN (s_suppkey * 7) % 200 + 1 END::INTEGER AS number,
  -25.4 - s_nationkey * 0.01 - (s_suppkey % 5) * 0.0004 AS lat, -49.2 - s_nationkey * 0.01 - (s_suppkey % 7) * 0.0003 AS lon FROM supplier)"""
TARGETS = """t AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 9 > 0 THEN c_nationkey::VARCHAR END AS cep, ['ALFA', 'BETA', 'ALFABETO', 'GAMA', 'ALFABETA'][c_custkey % 5 + 1] AS street,
  ['ALFA', 'BETA', 'ALFABETO', 'GAMA', 'ALFABETA'][c_custkey % 5 + 1] || ' ' || (c_custkey % 4) AS "full", CASE WHEN c_custkey % 8 > 0 THEN c_custkey % 200 + 1 END::INTEGER AS number,
  CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::VARCHAR END AS district FROM customer)"""


def census(spark, d) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    street = pick(["ALFA", "BETA", "ALFABETO", "GAMA"], k % 4)
    return t(spark, d, "supplier").select(
        k.alias("id"), F.when(k % 4 > 0, n.cast("string")).alias("cep"), street.alias("street"), F.concat_ws(" ", street, (k % 3).cast("string")).alias("full"),
        F.when(k % 6 > 0, (k * 7) % 200 + 1).cast("int").alias("number"), F.lit(None).cast("string").alias("name"),
        (F.lit(-25.4) - n * 0.01 - (k % 5) * 0.0004).alias("lat"), (F.lit(-49.2) - n * 0.01 - (k % 7) * 0.0003).alias("lon"),
    )


def targets(spark, d) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    street = pick(["ALFA", "BETA", "ALFABETO", "GAMA", "ALFABETA"], k % 5)
    return t(spark, d, "customer").select(
        k.alias("id"), F.lit(None).cast("string").alias("name"), F.when(k % 9 > 0, n).alias("cep"), street.alias("street"), F.concat_ws(" ", street, (k % 4).cast("string")).alias("full"),
        F.when(k % 8 > 0, k % 200 + 1).cast("int").alias("number"), F.when(k % 11 > 0, n).alias("district"),
    )


def places(spark, d) -> DataFrame:
    n = F.col("n_nationkey")
    return t(spark, d, "nation").where(n % 3 != 0).select(n.cast("string").alias("district"), (F.lit(-25.0) - n).alias("lat"), (F.lit(-49.0) - n).alias("lon"))


def _centre(keys: str, where: str, extent: float | None) -> str:
    wide = "sqrt(pow((max(lon) - min(lon)) * 111320.0 * cos(radians(avg(lat))), 2) + pow((max(lat) - min(lat)) * 111320.0, 2))"
    return f"SELECT {keys}, avg(lat) AS lat, avg(lon) AS lon FROM c WHERE {where} GROUP BY {keys}" + (f" HAVING {wide} < {extent}" if extent else "")


@register(f"""WITH {CENSUS}, {TARGETS},
a AS ({_centre('cep, street, number', 'number IS NOT NULL AND cep IS NOT NULL', None)}), b AS ({_centre('"full", number', 'number IS NOT NULL', 300.0)}),
s AS ({_centre('cep, street', 'cep IS NOT NULL', None)}), f AS ({_centre('"full"', 'TRUE', 1500.0)}), z AS ({_centre('cep', 'cep IS NOT NULL', 1500.0)}),
n3 AS (SELECT t.id, a.lat, a.lon, row_number() OVER (PARTITION BY t.id ORDER BY abs(t.number - a.number), a.number) AS r FROM t JOIN a USING (cep, street)
  WHERE abs(t.number - a.number) <= 30 AND t.number % 2 = a.number % 2),
g5 AS (SELECT *, {TRI.format('street')} AS g FROM s), t5 AS (SELECT id, cep, {TRI.format('street')} AS g FROM t),
n5 AS (SELECT id, lat, lon, row_number() OVER (PARTITION BY id ORDER BY sim DESC, street) AS r FROM (SELECT t5.id, street, lat, lon,
  (len(list_intersect(t5.g, g5.g))::DOUBLE / (len(t5.g) + len(g5.g) - len(list_intersect(t5.g, g5.g))))::FLOAT AS sim FROM t5 JOIN g5 USING (cep)) WHERE sim >= 0.6),
j AS (SELECT t.id, [CASE WHEN a.lat IS NOT NULL THEN {{'l': 'endereco', 'lat': a.lat, 'lon': a.lon}} END, CASE WHEN b.lat IS NOT NULL THEN {{'l': 'endereco_sem_cep', 'lat': b.lat, 'lon': b.lon}} END,
  CASE WHEN n3.lat IS NOT NULL THEN {{'l': 'numero_proximo', 'lat': n3.lat, 'lon': n3.lon}} END, CASE WHEN s.lat IS NOT NULL THEN {{'l': 'logradouro', 'lat': s.lat, 'lon': s.lon}} END,
  CASE WHEN n5.lat IS NOT NULL THEN {{'l': 'logradouro_aproximado', 'lat': n5.lat, 'lon': n5.lon}} END, CASE WHEN f.lat IS NOT NULL THEN {{'l': 'logradouro_sem_cep', 'lat': f.lat, 'lon': f.lon}} END,
  CASE WHEN z.lat IS NOT NULL THEN {{'l': 'cep', 'lat': z.lat, 'lon': z.lon}} END, CASE WHEN n_nationkey IS NOT NULL THEN {{'l': 'bairro', 'lat': -25.0 - n_nationkey, 'lon': -49.0 - n_nationkey}} END] AS x
  FROM t LEFT JOIN a USING (cep, street, number) LEFT JOIN b USING ("full", number) LEFT JOIN n3 ON n3.id = t.id AND n3.r = 1 LEFT JOIN s USING (cep, street)
  LEFT JOIN n5 ON n5.id = t.id AND n5.r = 1 LEFT JOIN f USING ("full") LEFT JOIN z USING (cep) LEFT JOIN nation ON n_nationkey::VARCHAR = district AND n_nationkey % 3 <> 0),
y AS (SELECT id, list_filter(x, lambda v: v IS NOT NULL)[1] AS v FROM j)
SELECT id, coalesce(v.l, 'nao_localizado') AS level, round(v.lat, 7) AS lat, round(v.lon, 7) AS lon FROM y""")
def geocode_cascade(spark, d):
    got = resolve.geocode(targets(spark, d), census(spark, d), places(spark, d))
    return got.select("id", "level", F.round("lat", 7).alias("lat"), F.round("lon", 7).alias("lon"))


@register()
def geocode_evaluation(spark, d):
    """Errors of hidden addresses, by level; tests hold its parts against brute force."""
    return resolve.evaluate_geocoding(census(spark, d), places(spark, d), 50, "seed")


@register("""WITH e AS (SELECT ['endereco', 'cep', 'bairro'][o_orderkey % 3 + 1] AS level, o_totalprice / 100 AS metres FROM orders)
SELECT level, count(*) AS n, round(quantile_cont(metres, 0.5), 1) AS median, round(quantile_cont(metres, 0.9), 1) AS p90,
  round(100 * avg((metres <= 50)::INTEGER), 1) AS within_50, round(100 * avg((metres <= 250)::INTEGER), 1) AS within_250 FROM e GROUP BY 1""")
def geocode_errors(spark, d):
    o = t(spark, d, "orders").select(pick(["endereco", "cep", "bairro"], F.col("o_orderkey") % 3).alias("level"), (F.col("o_totalprice") / 100).alias("metres"))
    return resolve.geocode_error(o)


# -- permits and leads

SIM = "(len(list_intersect({0}, {1}))::DOUBLE / (len({0}) + len({1}) - len(list_intersect({0}, {1}))))::FLOAT"
BEST = f"greatest({', '.join('coalesce(' + SIM.format(a, b) + ', 0)' for a in ('p.g', 'p.h') for b in ('f.g', 'f.h'))})"


@register(f"""WITH x AS (SELECT p_partkey AS id, p_brand AS cep, p_size % 10 AS street, p_partkey % 7 AS number, p_size AS activity, p_partkey % 11 AS start, {TRI.format('p_name')} AS g, {TRI.format('p_type')} AS h FROM part),
j AS (SELECT p.id AS permit, f.id AS firm, p.number = f.number AS same, {BEST} AS sim, p.activity = f.activity AS act, p.start = f.start AS beg FROM x p JOIN x f USING (cep, street)
  WHERE p.id % 2 = 0 AND f.id % 2 = 1 AND (p.number = f.number OR p.activity = f.activity OR p.start = f.start)),
s AS (SELECT permit, firm, round((0.5::DOUBLE * sim::DOUBLE + 0.25::DOUBLE * act::INTEGER + 0.25::DOUBLE * beg::INTEGER) * CASE WHEN same THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END, 3) AS score,
  CASE WHEN same THEN 'mesmo_endereco' ELSE 'mesma_rua' END AS method FROM j),
r AS (SELECT *, row_number() OVER (PARTITION BY permit ORDER BY score DESC, firm) AS a, row_number() OVER (PARTITION BY firm ORDER BY score DESC, permit) AS b FROM s WHERE score >= 0.5)
SELECT permit, firm, score, method FROM r WHERE a = 1 AND b = 1""")
def permit_matching(spark, d):
    k = F.col("p_partkey")
    x = t(spark, d, "part").select(
        k.alias("id"), F.col("p_brand").alias("cep"), (F.col("p_size") % 10).alias("street"), (k % 7).alias("number"), F.col("p_name").alias("name"), F.col("p_type").alias("trade"), F.col("p_size").alias("activity"), (k % 11).alias("start")
    )
    return resolve.match_permits(x.where("id % 2 = 0").withColumnRenamed("id", "permit"), x.where("id % 2 = 1").withColumnRenamed("id", "firm"))


PROFILE = "['commercial', 'mixed', 'residential', 'unknown'][key % 4 + 1] AS point_type, key % 7 = 0 AS registered_only, key % 3 AS active_of_root"


def profile(f: DataFrame) -> DataFrame:
    return f.select("key", pick(["commercial", "mixed", "residential", "unknown"], key() % 4).alias("point_type"), (key() % 7 == 0).alias("registered_only"), (key() % 3).alias("active_of_root"))


@register(LIFE + f""", f AS (SELECT key, active, s, key % 2 AS activity, {PROFILE} FROM firm), p AS (SELECT key, 'P' || key AS permit, ((key // 2) % 2)::VARCHAR AS permit_activity, s + (key % 50 - 25)::INTEGER AS ps, s + 1500 AS expiry FROM firm WHERE key % 3 > 0)
SELECT f.key, permit, permit IS NOT NULL AS has_permit, active AND permit IS NULL AND point_type IN ('commercial', 'mixed') AND NOT registered_only AS active_without_permit,
  NOT active AND permit IS NOT NULL AS permit_of_closed, expiry < DATE '2001-08-01' AS expired, permit IS NOT NULL AND permit_activity IS DISTINCT FROM activity::VARCHAR AS other_activity, permit_activity,
  CASE WHEN ps > s THEN ps END AS arrived FROM f LEFT JOIN p USING (key)""")
def permit_signals(spark, d):
    f = firms(spark, d)
    own = f.select("key", "active", (key() % 2).cast("string").alias("activity"), F.col("s").alias("start"))
    p = f.where(key() % 3 > 0).select(
        "key", F.concat(F.lit("P"), key().cast("string")).alias("permit"), (F.floor(key() / 2) % 2).cast("string").alias("activity"), F.expr("date_add(s, cast(key % 50 - 25 as int))").alias("start"), F.date_add("s", 1500).alias("expiry")
    )
    return leads.permit_signals(own, p.select("permit", F.col("key").alias("firm")), p, profile(f), AS_OF)


@register(LIFE + """SELECT c_mktsegment AS division, quantile_cont(((key * 37) % 1000) / 1000.0::DOUBLE, 0.5) AS median FROM firm WHERE key % 10 > 0 GROUP BY 1""")
def median_risk(spark, d):
    return leads.median_risk(firms(spark, d).select("key", F.col("c_mktsegment").alias("division"), F.when(key() % 10 > 0, ((key() * 37) % 1000) / F.lit(1000.0)).alias("risk")))


POINTS = ", ".join(f"('{n}', {p})" for n, p in risk.WEIGHTS.items())
LEADS = f""", p(c, w) AS (VALUES {POINTS}),
mom AS (SELECT c_nationkey, count(*) FILTER (s > DATE '2000-08-01' AND s <= DATE '2001-08-01') - count(*) FILTER (NOT active AND e > DATE '2000-08-01' AND e <= DATE '2001-08-01') AS m FROM firm GROUP BY 1),
f0 AS (SELECT *, CASE WHEN key % 10 > 0 THEN ((key * 37) % 1000) / 1000.0::DOUBLE END AS risk, {PROFILE} FROM firm),
med AS (SELECT c_mktsegment, quantile_cont(risk, 0.5) AS md FROM f0 GROUP BY 1),
x AS (SELECT key, unnest([
  {{'n': 'porte_epp', 'ok': key % 5 = 1}}, {{'n': 'porte_demais', 'ok': key % 5 = 2}}, {{'n': 'nao_mei', 'ok': key % 6 > 0}}, {{'n': 'idade_2a', 'ok': s <= DATE '1999-08-01'}},
  {{'n': 'ponto_comercial', 'ok': point_type IN ('commercial', 'mixed') AND NOT registered_only}}, {{'n': 'rede', 'ok': active_of_root > 1}}, {{'n': 'fornecedor_publico', 'ok': key % 8 = 0 OR key % 14 > 12}},
  {{'n': 'lista_exportadora', 'ok': key % 4 = 0}}, {{'n': 'lista_credito', 'ok': key % 4 = 1}}, {{'n': 'lista_outras', 'ok': key % 4 = 2}}, {{'n': 'alvara_ok', 'ok': key % 3 > 0 AND key % 6 <> 1}},
  {{'n': 'hexagono_crescendo', 'ok': m > 0}}, {{'n': 'risco_baixo', 'ok': risk < md}}, {{'n': 'divida_pgfn', 'ok': key % 15 = 0}}, {{'n': 'sancao', 'ok': key % 13 = 0}}]) AS v
  FROM f0 JOIN mom USING (c_nationkey) JOIN med USING (c_mktsegment) WHERE active),
h AS (SELECT key, v.n AS c, w FROM x JOIN p ON v.n = p.c WHERE v.ok),
lead AS (SELECT f.key, greatest(0, least(100, coalesce(sum(w), 0)))::INTEGER AS score, coalesce(string_agg(c, ',' ORDER BY w DESC, c), '') AS criteria FROM (SELECT key FROM firm WHERE active) f LEFT JOIN h USING (key) GROUP BY 1)"""


def all_leads(spark, d) -> DataFrame:
    f = firms(spark, d)
    own = f.select("key", pick(["01", "03", "05", "01", "01"], key() % 5).alias("size"), F.when(key() % 6 == 0, "S").otherwise("N").alias("mei"), F.col("s").alias("start"), F.col("c_mktsegment").alias("division"), F.col("c_nationkey").alias("cell"), "active")
    mom = indicators.momentum(f.select(F.col("c_nationkey").alias("cell"), "active", F.col("s").alias("start"), F.col("e").alias("end")), "cell", AS_OF)
    signals = f.select("key", F.greatest(F.lit(0), key() % 14 - 12).alias("contracts"), F.when(key() % 15 == 0, 2).alias("debts"), F.when(key() % 13 == 0, 1).otherwise(0).alias("sanctions"))
    permits = f.select("key", (key() % 3 > 0).alias("has_permit"), (key() % 6 == 1).alias("expired"))
    hazard = f.select("key", F.col("c_mktsegment").alias("division"), F.when(key() % 10 > 0, ((key() * 37) % 1000) / F.lit(1000.0)).alias("risk"))
    entries = f.select("key", pick(["mdic_exportadoras", "bndes_operacoes", "cnes", "unknown"], key() % 4).alias("list"))
    return leads.leads(own, AS_OF, profile=profile(f), signals=signals, permits=permits, contracts=f.where(key() % 8 == 0).select("key"), momentum=mom, risk=hazard, lists=entries)


@register(LIFE + LEADS + " SELECT key, score, criteria FROM lead")
def lead_criteria(spark, d):
    return all_leads(spark, d)


@register(LIFE + LEADS + " SELECT CASE WHEN score >= 100 THEN 6 ELSE score // 20 + 1 END::BIGINT AS band, count(*) AS n, min(score) AS lo, max(score) AS hi FROM lead GROUP BY 1")
def lead_bands(spark, d):
    return leads.score_bands(all_leads(spark, d))


# -- areas

ZONE = "z AS (SELECT i AS zone, (i % 5) * 6000.0::DOUBLE AS x0, (i // 5) * 6000.0::DOUBLE AS y0, 1000.0 + i * 10 AS people, 300.0 + i AS dwellings, CASE WHEN i % 4 > 0 THEN 1500.0 + i END::DOUBLE AS income FROM range(25) r(i))"


def sectors(spark) -> DataFrame:
    i = F.col("id")
    z = zones(spark).select(F.substring("code", 2, 2).cast("long").alias("id"), "ring")
    return z.select(i.alias("zone"), (1000.0 + i * 10).alias("people"), (300.0 + i).alias("dwellings"), F.when(i % 4 > 0, 1500.0 + i).alias("income"), "ring")


def box(spark, x0, y0, x1, y1) -> DataFrame:
    corner = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    return spark.range(1).select(F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0)).alias("ring"))


AREA = "least(x0 + 6200, {x1}) - greatest(x0, {x0})"
SHARED = "greatest(least(x0 + 6200, 16000) - greatest(x0, 3000), 0) * greatest(least(y0 + 6200, 15000) - greatest(y0, 4000), 0)"
IN = "x BETWEEN 3000 AND 16000 AND y BETWEEN 4000 AND 15000"


@register(f"""WITH p AS ({CELL}), {ZONE},
h AS (SELECT c_custkey AS id, floor(x / 6000)::BIGINT % 5 + 5 * (floor(y / 6000)::BIGINT % 5) AS zone, x, y FROM p WHERE c_custkey % 3 > 0),
n AS (SELECT zone, count(*) FILTER (zone % 6 > 0) AS homes, count(*) FILTER ({IN}) AS inside FROM h GROUP BY 1),
w AS (SELECT z.*, CASE WHEN coalesce(homes, 0) > 0 THEN inside::DOUBLE / homes ELSE {SHARED} / (6200.0 * 6200.0) END AS p FROM z LEFT JOIN n USING (zone) WHERE {SHARED} > 0),
m AS (SELECT round(sum(people * p)) AS residents FROM w),
f AS (SELECT c_mktsegment AS activity, count(*) FILTER ({IN}) AS n, count(*) AS n_city FROM p WHERE c_custkey % 4 > 0 AND c_custkey % 6 > 0 AND c_custkey % 3 <> 2 GROUP BY 1)
SELECT activity, n, n_city, round(n / 143.0, 1) AS per_km2, round(n_city / 900.0, 1) AS per_km2_city, round(100 * (n / 143.0) / (n_city / 900.0), 0) AS index, round(1000 * (n / residents), 2) AS per_1000,
  round(100 * (n / residents) / (n_city / (SELECT sum(people) FROM z)::DOUBLE), 0) AS index_residents, residents FROM f, m WHERE n > 0""")
def area_report(spark, d):
    """Firms, homes and sectors against a rectangle; sectors without homes count with their share of land."""
    p = placed(spark, d).withColumnRenamed("c_custkey", "id")
    k = F.col("id")
    f = p.select("id", "x", "y", F.col("c_mktsegment").alias("activity"), (k % 4 > 0).alias("active"), (k % 6 == 0).alias("registered_only"), pick(["endereco", "numero_proximo", "cep"], k % 3).alias("level"))
    zone = (F.floor(F.col("x") / 6000) % 5 + 5 * (F.floor(F.col("y") / 6000) % 5)).alias("zone")
    h = p.where(k % 3 > 0).select("id", zone, "x", "y")
    n = h.where("zone % 6 > 0").groupBy("zone").agg(F.count(F.lit(1)).alias("homes"))
    z = sectors(spark).join(n, "zone", "left")
    out = indicators.area_report(f, z, h, box(spark, 3000, 4000, 16000, 15000), 900.0, 3000.0)
    return out.select("activity", "n", "n_city", "per_km2", "per_km2_city", "index", "per_1000", "index_residents", "residents")


@register(f"""WITH {ZONE}, o AS (SELECT i AS o, (i % 7) * 4500.0 - 1000 AS a0, (i // 7) * 4300.0 - 700 AS b0 FROM range(49) r(i)),
s AS (SELECT zone AS a_id, o AS b_id, greatest(least(x0 + 6200, a0 + 4000) - greatest(x0, a0), 0) * greatest(least(y0 + 6200, b0 + 5000) - greatest(y0, b0), 0) AS area FROM z, o)
SELECT a_id, b_id, round(area, 3) AS area FROM s WHERE area > 0""")
def polygon_overlap(spark, d):
    i = F.col("id")
    x, y = (i % 7) * 4500.0 - 1000, F.floor(i / 7) * 4300.0 - 700
    corner = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    other = spark.range(49).select(i.alias("b_id"), F.array(corner(0.0, 0.0), corner(4000.0, 0.0), corner(4000.0, 5000.0), corner(0.0, 5000.0), corner(0.0, 0.0)).alias("ring"))
    got = geo.polygon_overlap(sectors(spark).select(F.col("zone").alias("a_id"), "ring"), other, 3000.0)
    return got.select("a_id", "b_id", F.round("area", 3).alias("area"))


@register(f"""WITH p AS ({CELL}), {ZONE}, i0 AS (SELECT c_custkey AS id, min(zone) AS district FROM p LEFT JOIN z ON x BETWEEN x0 AND x0 + 6200 AND y BETWEEN y0 AND y0 + 6200 GROUP BY 1),
i1 AS (SELECT c_custkey AS id, CASE WHEN {IN} THEN 'centre' END AS region FROM p) SELECT id, 'D' || lpad(district::VARCHAR, 2, '0') AS district, region FROM i0 JOIN i1 USING (id)""")
def territory_layers(spark, d):
    region = box(spark, 3000, 4000, 16000, 15000).select(F.lit(None).cast("string").alias("code"), F.lit("centre").alias("name"), "ring")
    p = placed(spark, d).select(F.col("c_custkey").alias("id"), "x", "y")
    return geo.territory(p, {"district": zones(spark), "region": region}, 3000.0).select("id", "district", "region")


@register(f"""WITH p AS ({CELL}), s AS (SELECT s_suppkey AS k, (s_suppkey * 3571 % 1009) * 29.0 AS x1, (s_suppkey * 7907 % 1013) * 29.0 AS y1 FROM supplier), e AS (SELECT *, x1 + (k % 9) * 100 AS x2, y1 + (k % 4) * 150 AS y2 FROM s),
q AS (SELECT p.*, e.*, greatest(0, least(1, coalesce(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0))) AS u FROM p, e)
SELECT DISTINCT c_custkey AS id FROM q WHERE sqrt(pow(x - x1 - u * (x2 - x1), 2) + pow(y - y1 - u * (y2 - y1), 2)) <= 400""")
def near_streets(spark, d):
    k = F.col("k")
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("k")).withColumns({"x1": (k * 3571 % 1009) * 29.0, "y1": (k * 7907 % 1013) * 29.0})
    s = s.withColumns({"x2": F.col("x1") + (k % 9) * 100, "y2": F.col("y1") + (k % 4) * 150})
    return geo.near_segments(placed(spark, d).select(F.col("c_custkey").alias("id"), "x", "y"), s, 400.0)


@register(f"""WITH p AS (SELECT c_custkey AS a_id, {GEO} AS lat, ((c_custkey * 104729) % 10009)::DOUBLE / 100090.0 - 49.3 AS lon FROM customer),
s AS (SELECT s_suppkey AS b_id, -25.5 + (s_suppkey % 3) * 0.5 AS lat, -49.3 + (s_suppkey % 5) * 0.3 AS lon FROM supplier WHERE s_suppkey % 9 = 1),
j AS (SELECT a_id, b_id, {haversine('p.lat', 'p.lon', 's.lat', 's.lon')} AS metres FROM p, s)
SELECT a_id, b_id, round(metres, 3) AS metres FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY metres, b_id) AS r FROM j) WHERE r = 1""")
def nearest_any(spark, d):
    k = F.col("s_suppkey")
    b = t(spark, d, "supplier").where(k % 9 == 1).select(k.alias("b_id"), (F.lit(-25.5) + (k % 3) * 0.5).alias("lat"), (F.lit(-49.3) + (k % 5) * 0.3).alias("lon"))
    return geo.nearest_any(located(spark, d).withColumnRenamed("c_custkey", "a_id"), b, 1000.0).withColumn("metres", F.round("metres", 3))


@register()
def bus_reach(spark, d):
    """What a bus passenger reaches from a corner of a grid of streets in 25 minutes; tests hold it against brute force."""
    n = 12
    at = spark.range(n * n).select((F.col("id") % n).alias("i"), F.floor(F.col("id") / n).alias("j"))
    place = lambda i, j: ((-49.3 + i * 0.002), (-25.5 + j * 0.002))
    i, j = F.col("i"), F.col("j")
    seg = []
    for di, dj in ((1, 0), (0, 1)):
        (a, b), (c, e) = place(i, j), place(i + di, j + dj)
        seg.append(at.where((i + di < n) & (j + dj < n)).select(a.alias("lon1"), b.alias("lat1"), c.alias("lon2"), e.alias("lat2"), F.lit(210.0).alias("w")))
    nodes, edges = graph.network(seg[0].unionAll(seg[1]))
    s = F.col("s")
    stops = spark.range(6).select(F.col("id").alias("s")).select(s.cast("string").alias("stop_id"), (F.lit(-25.5) + s * 0.004).alias("lat"), (F.lit(-49.3) + s * 0.004).alias("lon"))
    st = t(spark, d, "conversations").where("turn < 6").select(F.col("conv_id").cast("string").alias("trip_id"), F.col("turn").alias("seq"), F.col("turn").cast("string").alias("stop_id"), (28800 + F.col("conv_id") % 40 * 60 + F.col("turn") * 90).alias("arr"))
    conns = graph.connections(st.withColumn("dep", F.col("arr") + 10), 28800, 36000)
    return graph.reach(nodes, edges, (-25.5, -49.3), 25.0, stops, conns, 28800).select("node", F.round("cost", 3).alias("cost"))


# -- incidents

EVENT_WORDS = {"view": "Roubo", "click": "Furto", "signup": "Queda de árvore", "purchase": "Acidente com moto", "error": "outra"}
EVENT_KIND = {"view": "violento", "click": "patrimonial", "signup": "fisico", "purchase": "transito", "error": "outros"}


def raw_incidents(spark, d) -> DataFrame:
    e, k = t(spark, d, "events"), F.col("event_id")
    word = F.element_at(F.create_map(*(F.lit(x) for p in EVENT_WORDS.items() for x in p)), F.col("event_type"))
    return e.select(
        F.when(k % 50 > 0, F.floor(k / 2).cast("string")).alias("code"), F.date_format("ts", "dd/MM/yyyy").alias("date"), F.date_format("ts", "HH:mm").alias("hour"),
        pick(["d 1", " D  2", "elsewhere", ""], F.floor(k / 2) % 4).alias("district"), F.lit(" norte ").alias("region"), F.concat(F.lit("R "), (k % 5).cast("string")).alias("street"), F.lit("").alias("equipment"),
        F.when(k % 2 == 0, "sim").alias("flagrant"), word.alias("n1"), F.when(k % 9 == 0, "S").otherwise("N").alias("d1"), F.when(k % 7 == 0, "Furto").alias("n2"), F.lit(None).cast("string").alias("d2"), k.alias("event"),
    )


@register(f"""WITH w(t, v, c) AS (VALUES {', '.join(f"('{a}', '{b}', '{EVENT_KIND[a]}')" for a, b in EVENT_WORDS.items())}),
e AS (SELECT event_id AS k, (event_id // 2)::VARCHAR AS code, ts::DATE AS date, v, c FROM events JOIN w ON t = event_type WHERE event_id % 50 > 0 AND (event_id // 2 * 2) % 50 > 0),
n AS (SELECT code, unnest([v, CASE WHEN k % 7 = 0 THEN 'Furto' END]) AS nature, unnest([c, CASE WHEN k % 7 = 0 THEN 'patrimonial' END]) AS cat, k % 9 = 0 AS civil FROM e),
g AS (SELECT code, string_agg(DISTINCT nature, '|' ORDER BY nature) AS natures FROM n WHERE nature IS NOT NULL GROUP BY 1),
m AS (SELECT code, string_agg(DISTINCT cat, ',' ORDER BY cat) AS categories FROM (SELECT code, cat FROM n WHERE cat IS NOT NULL UNION ALL SELECT code, 'fisico' FROM n WHERE civil) GROUP BY 1)
SELECT code, min(date) AS date, CASE (code::BIGINT) % 4 WHEN 0 THEN 'D 1' WHEN 1 THEN 'D 2' WHEN 2 THEN 'ELSEWHERE' END AS district, 'NORTE' AS region, natures, categories, bool_or(k % 9 = 0) AS civil_defence
FROM e JOIN g USING (code) JOIN m USING (code) GROUP BY code, natures, categories""")
def security_facts(spark, d):
    """Rows in pairs of one code; those without a code are left to a test."""
    districts = spark.createDataFrame([("D 1",), ("D 2",)], "name string")
    raw = raw_incidents(spark, d).where("event % 50 > 0 and (cast(event / 2 as long) * 2) % 50 > 0").drop("event")
    got = security.facts(raw, districts, natures=2)
    return got.select("code", "date", "district", "region", F.array_join("natures", "|").alias("natures"), F.array_join("categories", ",").alias("categories"), "civil_defence")


@register("""SELECT event_type AS source, (user_id % 5)::VARCHAR AS district, date_trunc('month', ts)::DATE AS month, c AS category, count(*) AS n
FROM (SELECT *, unnest(CASE WHEN event_id % 3 = 0 THEN ['a', 'b'] WHEN event_id % 3 = 1 THEN ['b'] ELSE ['outros'] END) AS c FROM events) GROUP BY ALL""")
def monthly_incidents(spark, d):
    k = F.col("event_id")
    kinds = F.when(k % 3 == 0, F.array(F.lit("a"), F.lit("b"))).when(k % 3 == 1, F.array(F.lit("b")))
    e = t(spark, d, "events").select(F.col("event_type").alias("source"), (F.col("user_id") % 5).cast("string").alias("district"), F.col("ts").cast("date").alias("date"), kinds.alias("categories"))
    return security.monthly(e)


@register(f"""WITH p AS ({CELL}), {ZONE}, zz AS (SELECT *, 'D' || lpad(zone::VARCHAR, 2, '0') AS district FROM z WHERE zone < 20), w AS (SELECT s AS street, 'D' || lpad(i::VARCHAR, 2, '0') AS district FROM (SELECT unnest(['BUILDING', 'MACHINERY', 'NOWHERE', '']) AS s), range(30) r(i)),
i AS (SELECT DISTINCT c_mktsegment AS street, district, x, y FROM p JOIN zz ON x BETWEEN x0 AND x0 + 6200 AND y BETWEEN y0 AND y0 + 6200),
c AS (SELECT street, district, avg(x) AS cx, avg(y) AS cy FROM i GROUP BY 1, 2),
b AS (SELECT street, district, x, y, row_number() OVER (PARTITION BY street, district ORDER BY (x - cx) ** 2 + (y - cy) ** 2, x, y) AS r FROM i JOIN c USING (street, district))
SELECT w.street, w.district, CASE WHEN b.x IS NOT NULL THEN 'logradouro_no_bairro' WHEN zz.zone IS NOT NULL THEN 'bairro' ELSE 'nao_localizado' END AS level, coalesce(b.x, x0 + 3100) AS x, coalesce(b.y, y0 + 3100) AS y
FROM w LEFT JOIN b ON b.street = w.street AND b.district = w.district AND r = 1 LEFT JOIN zz ON zz.district = w.district""")
def street_in_district(spark, d):
    wanted = spark.range(30).select(F.explode(F.array(*map(F.lit, ["BUILDING", "MACHINERY", "NOWHERE", ""]))).alias("street"), F.format_string("D%02d", F.col("id")).alias("district"))
    districts = zones(spark).where("code < 'D20'").select(F.col("code").alias("district"), "ring")
    return security.locate_streets(wanted, placed(spark, d).select(F.col("c_mktsegment").alias("street"), "x", "y"), districts, 3000.0)


# -- lists, names, facilities

NUMBERS = ["11222333000181", "00000000000191", "123456000149", "11444777000161", "abc", "11.222.333/0002-62"]


@register(f"""WITH v(i, n, root) AS (VALUES (0, '11222333000181', '11222333'), (1, '00000000000191', '00000000'), (2, '00123456000149', '00123456'), (3, '11444777000161', '11444777'), (5, '11222333000262', '11222333'))
SELECT 'anp_revendas' AS list, n AS cnpj, root, ['GASOLINA', 'DIESEL'][c_custkey % 2 + 1] AS label, make_date((2000 + c_custkey % 20)::INTEGER, 1, 1) AS date, (c_custkey % 100)::DOUBLE AS value,
  CASE WHEN root = '00000000' THEN '{{}}' ELSE '{{"UF":"S' || c_nationkey || '"}}' END AS attributes, count(*) AS n
FROM customer JOIN v ON c_custkey % 6 = i WHERE n IN ('11222333000181', '00000000000191', '11222333000262') GROUP BY ALL""")
def list_entries(spark, d):
    k = F.col("c_custkey")
    x = t(spark, d, "customer").select(
        pick(NUMBERS, k % 6).alias("CNPJ_DA_REVENDA"), F.col("c_name").alias("RAZAO"), F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("UF"), pick(["GASOLINA", "DIESEL"], k % 2).alias("PRODUTO_X"),
        pick(["GASOLINA", "DIESEL"], k % 2).alias("BANDEIRA"), (2000 + k % 20).cast("string").alias("DATA_COLETA"), (k % 100).cast("string").alias("VALOR_DE_VENDA"),
    ).drop("PRODUTO_X")
    f = spark.createDataFrame([("11222333000181", "11222333", False), ("00000000000191", "00000000", True), ("11222333000262", "11222333", False)], "key string, root string, person boolean")
    got = public_lists.entries(x, "anp_revendas", f)
    attributes = F.when(F.col("attributes") == "{}", F.lit("{}")).otherwise(F.to_json(F.map_filter(F.from_json("attributes", "map<string,string>"), lambda key, v: key == "UF")))
    return got.withColumn("attributes", attributes).groupBy("list", "cnpj", "root", "label", "date", "value", "attributes").agg(F.count(F.lit(1)).alias("n"))


@register("""WITH f AS (SELECT 'N' || (c_custkey % 400) AS name, c_custkey % 900 AS root, c_custkey % 3 = 0 AS head, c_custkey AS key FROM customer),
o AS (SELECT name, coalesce(min(CASE WHEN head THEN key END), min(key)) AS key FROM f GROUP BY 1 HAVING min(root) = max(root))
SELECT s_suppkey AS brand, key FROM supplier JOIN o ON name = 'N' || (s_suppkey * 5 % 450)""")
def match_by_name(spark, d):
    k = F.col("c_custkey")
    f = t(spark, d, "customer").select(F.concat(F.lit("N"), (k % 400).cast("string")).alias("name"), (k % 900).alias("root"), (k % 3 == 0).alias("head"), k.alias("key"))
    b = t(spark, d, "supplier").select(F.col("s_suppkey").alias("brand"), F.concat(F.lit("N"), (F.col("s_suppkey") * 5 % 450).cast("string")).alias("name"))
    return resolve.match_by_name(b, f)


@register("""SELECT s_suppkey::VARCHAR AS code, s_name AS name, nullif(concat_ws(',', CASE WHEN s_suppkey % 2 = 0 THEN 'manha' END, CASE WHEN s_suppkey % 3 = 0 THEN 'tarde' END, CASE WHEN s_suppkey % 5 = 0 THEN '24h' END), '') AS shifts FROM supplier""")
def facility_shifts(spark, d):
    k = F.col("s_suppkey")
    none = F.lit(" ")
    flag = lambda n: F.when(k % n == 0, "Sim").otherwise("N")
    raw = t(spark, d, "supplier").select(
        F.concat(F.lit(" "), k.cast("string")).alias("code"), F.col("s_name").alias("name"), *(none.alias(c) for c in ("theme", "kind", "subkind", "authority")), flag(2).alias("morning"), flag(3).alias("afternoon"),
        F.lit("n").alias("night"), flag(5).alias("all_day"), *(none.alias(c) for c in ("street", "number", "district", "region")),
    )
    return lists.facilities(raw.unionAll(raw)).select("code", "name", "shifts")


# -- timetables

@register("""WITH t AS (SELECT conv_id AS trip, turn AS seq, role || (turn % 3) AS stop, CASE WHEN turn % 5 <> 2 THEN 28800 + conv_id % 100 * 30 + turn * 60 END AS arr FROM conversations),
u AS (SELECT *, CASE WHEN seq % 4 <> 1 THEN arr + 20 END AS dep FROM t), v AS (SELECT trip, seq, stop, coalesce(arr, dep) AS arr, coalesce(dep, arr) AS dep FROM u WHERE coalesce(dep, arr) IS NOT NULL),
w AS (SELECT trip, dep, lead(arr) OVER o AS arr, stop AS a, lead(stop) OVER o AS b FROM v WINDOW o AS (PARTITION BY trip ORDER BY seq))
SELECT trip, dep, arr, a, b FROM w WHERE b IS NOT NULL AND dep BETWEEN 29000 AND 31000""")
def timetable_connections(spark, d):
    turn = F.col("turn")
    arr = F.when(turn % 5 != 2, 28800 + F.col("conv_id") % 100 * 30 + turn * 60)
    st = t(spark, d, "conversations").select(F.col("conv_id").alias("trip_id"), turn.alias("seq"), F.concat("role", (turn % 3).cast("string")).alias("stop_id"), arr.alias("arr"), F.when(turn % 4 != 1, arr + 20).alias("dep"))
    return graph.connections(st, 29000, 31000)


@register("""SELECT 's' || s_suppkey AS service_id FROM supplier WHERE (s_suppkey % 2 = 1 AND s_suppkey % 3 <> 0 AND s_suppkey % 7 <> 0) OR (s_suppkey % 5 = 0 AND s_suppkey % 7 <> 0)""")
def services_of_a_day(spark, d):
    """A Wednesday: odd services run, multiples of 3 outside their range; multiples of 5 are added, of 7 removed."""
    k = F.col("s_suppkey")
    s = t(spark, d, "supplier").withColumn("service_id", F.concat(F.lit("s"), k.cast("string")))
    days = {n: F.when(k % 2 == (1 if n == "wednesday" else 0), "1").otherwise("0") for n in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")}
    cal = s.select("service_id", *(c.alias(n) for n, c in days.items()), F.lit("20240101").alias("start_date"), F.when(k % 3 == 0, "20240301").otherwise("20241231").alias("end_date"))
    on = lambda n, kind: s.where(k % n == 0).select("service_id", F.lit("20240515").alias("date"), F.lit(kind).alias("exception_type"))
    return graph.active_services(cal, on(5, "1").unionAll(on(7, "2")), "2024-05-15")


# -- back-tests

def _year(target: int) -> str:
    """SQL: the model of the five years before a year, and that year's exposed firms with their risk."""
    model = HAZ.format(target - 5, target - 1)
    part = model[model.index(", y AS") : model.index(",\nhg AS")].replace(f"range({target - 5}, {target - 1} + 1)", f"range({target}, {target} + 1)")
    part = re.sub(r"\b(y|x0|x)\b(?= AS \(| WHERE| \)|\)|$)|(?<=FROM )\b(y|x0|x)\b", lambda m: m[0] + "_t", part)
    return f"""{model}{part},
risk_t AS (SELECT key, event, least(1.0, coalesce(h1, h0, hg) * coalesce(mult, 1.0)) AS risk FROM x_t LEFT JOIN h1 USING (division, band, small) LEFT JOIN h0 USING (band, small) LEFT JOIN mult USING (district), hg),
rank_t AS (SELECT *, rank() OVER (ORDER BY risk) + (count(*) OVER (PARTITION BY risk) - 1) / 2.0 AS rk, row_number() OVER (ORDER BY risk, key) AS i, count(*) OVER () AS total FROM risk_t)"""


@register(_year(2000) + """, s AS (SELECT count(*) AS n, sum(event)::BIGINT AS positives, sum(CASE WHEN event = 1 THEN rk END) AS r FROM rank_t)
SELECT n, positives, round((r - positives * (positives + 1) / 2.0) / (positives * (n - positives)), 4)::DOUBLE AS auc FROM s""")
def backtest_hazard(spark, d):
    """n, positives and AUC of the hazard model for 2000. Equal risks must tie, so they are compared at twelve decimals in both engines."""
    x = risk.backtest(hazard_firms(spark, d), 2000)
    return relational.auc(x.withColumn("risk", F.round("risk", 12)), "risk", "event").withColumn("auc", F.col("auc").cast("double"))


@register(" UNION ALL ".join(f"""SELECT * FROM ({_year(y)} SELECT {y} AS year, count(*) AS n, sum(event)::BIGINT AS events, round(avg(event), 6) AS observed, round(avg(risk), 6) AS predicted FROM rank_t)""" for y in (1998, 1999, 2000)))
def validation_rates(spark, d):
    found = []
    for year in (1998, 1999, 2000):
        x = risk.backtest(hazard_firms(spark, d), year)
        found.append(x.agg(F.lit(year).alias("year"), F.count(F.lit(1)).alias("n"), F.sum("event").alias("events"), F.round(F.avg("event"), 6).alias("observed"), F.round(F.avg("risk"), 6).alias("predicted")))
    return found[0].unionAll(found[1]).unionAll(found[2])


@register()
def validation_calibration(spark, d):
    """Deciles of three years' back-tests; tests hold them against the rates."""
    return risk.validation(hazard_firms(spark, d), 2001)[1]


# -- building blocks

@register("""SELECT c_mktsegment, '{' || string_agg('"' || c_nationkey || '":' || n, ',' ORDER BY c_nationkey::VARCHAR) || '}' AS o FROM (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2) GROUP BY 1""")
def json_objects(spark, d):
    n = t(spark, d, "customer").groupBy("c_mktsegment", F.col("c_nationkey").cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("c_mktsegment").agg(relational.json_object("k", "n").alias("o"))


@register("""SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.9) AS p90 FROM orders GROUP BY 1""")
def grouped_percentiles(spark, d):
    return relational.percentiles(t(spark, d, "orders"), ["o_orderpriority"], "o_totalprice", {"q1": 0.25, "median": 0.5, "p90": 0.9})


@register("""WITH s AS (SELECT c_custkey FROM customer ORDER BY md5(c_custkey::VARCHAR || 'part'), c_custkey LIMIT 200)
SELECT c_custkey, 'rest' AS part FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM s) UNION ALL SELECT c_custkey, 'sample' FROM s""")
def sample_and_rest(spark, d):
    sample, rest = relational.split_sample(t(spark, d, "customer").select("c_custkey"), "c_custkey", "part", 200)
    return rest.withColumn("part", F.lit("rest")).unionAll(sample.withColumn("part", F.lit("sample")))


@register(f"""WITH x AS (SELECT c_custkey, {TRI.format("c_name || ' ' || c_mktsegment")} AS a, {TRI.format('c_mktsegment')} AS b, {TRI.format("n_name || ' BUILDING'")} AS c FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey, greatest({SIM.format('a', 'c')}, {SIM.format('b', 'c')})::DOUBLE AS sim FROM x""")
def best_similarity(spark, d):
    n = t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.concat("n_name", F.lit(" BUILDING")).alias("other"))
    x = t(spark, d, "customer").join(relational.dimension(n), "c_nationkey").withColumn("full", F.concat_ws(" ", "c_name", "c_mktsegment"))
    return x.select("c_custkey", text.best_similarity(["full", "c_mktsegment"], ["other"]).cast("double").alias("sim"))
