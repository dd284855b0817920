"""One query per operator over the test tables, and the equivalent SQL where SQL can say it.

Roles: nation = territory, market segment or part type = activity, customer = company, orders = openings and events, supplier = second
registry, events = readings. Reference dates are literals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import parse, text
from ..operators import geo, graph, indicators, lists, relational, resolve, risk
from ..sources import files, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def customers(spark: SparkSession, d: str) -> DataFrame:
    """Customers with their nation's name; the nation table has a fixed 25 rows."""
    n = t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t(spark, d, "customer").join(F.broadcast(n), "c_nationkey")


AS_OF = "2001-08-01"


@register("""
WITH x AS (SELECT n_name, c_mktsegment, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT n_name, c_mktsegment, n,
       round((n::DOUBLE / sum(n) OVER (PARTITION BY n_name)) / (sum(n) OVER (PARTITION BY c_mktsegment)::DOUBLE / sum(n) OVER ()), 3) AS ql
FROM x""")
def location_quotient(spark, d):
    return indicators.location_quotient(customers(spark, d), "n_name", "c_mktsegment")


LIFE = """WITH life AS (SELECT c_custkey AS key, c_mktsegment, c_nationkey, min(o_orderdate)::DATE AS s, max(o_orderdate)::DATE AS e
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
firm AS (SELECT *, e >= DATE '2001-01-01' AS active, CASE WHEN e < DATE '2001-01-01' THEN e END AS closed FROM life)"""


def firms(spark, d) -> DataFrame:
    """Customers as companies: from the first to the last order, closed if that is before 2001."""
    life = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.min("o_orderdate").cast("date").alias("s"), F.max("o_orderdate").cast("date").alias("e"))
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_mktsegment", "c_nationkey", "c_acctbal")
    x = life.join(c, "key").withColumn("active", F.col("e") >= F.lit("2001-01-01").cast("date"))
    return x.withColumn("closed", F.when(~F.col("active"), F.col("e")))


@register(LIFE + """
SELECT year(s)::INTEGER AS cohort, c_mktsegment, count(*) AS n,
  CASE WHEN year(s) + 1 < 2001 THEN round(100 * (count(*) FILTER (closed IS NULL OR closed >= s + INTERVAL 1 YEAR))::DOUBLE / count(*), 1) END AS alive_1,
  CASE WHEN year(s) + 3 < 2001 THEN round(100 * (count(*) FILTER (closed IS NULL OR closed >= s + INTERVAL 3 YEAR))::DOUBLE / count(*), 1) END AS alive_3,
  CASE WHEN year(s) + 5 < 2001 THEN round(100 * (count(*) FILTER (closed IS NULL OR closed >= s + INTERVAL 5 YEAR))::DOUBLE / count(*), 1) END AS alive_5
FROM firm GROUP BY GROUPING SETS ((year(s), c_mktsegment), (year(s)))""")
def cohort_survival(spark, d):
    x = firms(spark, d).select(F.col("s").alias("start"), F.col("closed").alias("end"), "c_mktsegment")
    return indicators.cohort_survival(x, "c_mktsegment", 2001)


XY = "((c_custkey * 7919) % 10007)::DOUBLE * 3.0"
CELL = f"""SELECT c_custkey, c_mktsegment, {XY} AS x, ((c_custkey * 104729) % 10009)::DOUBLE * 3.0 AS y FROM customer"""
HEX = """h AS (SELECT *, (sqrt(3.0) / 3.0 * x - 1.0 / 3.0 * y) / 500.0 AS q, 2.0 / 3.0 * y / 500.0 AS r FROM p),
g AS (SELECT *, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor(-q - r + 0.5) AS rs FROM h),
k AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - (-q - r)) AS ds FROM g),
c AS (SELECT *, (CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END)::BIGINT || '_' ||
             (CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END)::BIGINT AS cell FROM k)"""


def placed(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return t(spark, d, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal", ((k * 7919) % 10007).cast("double").__mul__(3.0).alias("x"), ((k * 104729) % 10009).cast("double").__mul__(3.0).alias("y")
    )


@register(f"WITH p AS ({CELL}), {HEX} SELECT c_custkey, cell FROM c")
def cell_index(spark, d):
    return placed(spark, d).select("c_custkey", geo.hex_cell(F.col("x"), F.col("y"), 500.0).alias("cell"))


@register(f"WITH p AS ({CELL}), {HEX} SELECT cell, c_mktsegment, count(*) AS n FROM c GROUP BY GROUPING SETS ((cell, c_mktsegment), (cell))")
def density_grouping_sets(spark, d):
    x = placed(spark, d).select(geo.hex_cell(F.col("x"), F.col("y"), 500.0).alias("cell"), "c_mktsegment")
    return indicators.density_with_totals(x, "cell", "c_mktsegment")


SNAP = """s AS (SELECT date_trunc('month', o_orderdate)::DATE AS period, o_custkey AS key, max(o_orderkey) AS o FROM orders GROUP BY 1, 2),
snap AS (SELECT period, key, o_orderstatus <> 'F' AS open, o_orderpriority AS place, o_orderstatus AS activity FROM s JOIN orders ON o_orderkey = o)"""


@register(f"""WITH {SNAP},
m AS (SELECT period, lag(period) OVER (ORDER BY period) AS prior FROM (SELECT DISTINCT period FROM snap)),
a AS (SELECT snap.* FROM snap JOIN m USING (period) WHERE prior IS NOT NULL),
b AS (SELECT m.period, key, open, place, activity FROM snap JOIN m ON m.prior = snap.period),
j AS (SELECT coalesce(a.period, b.period) AS period, coalesce(a.key, b.key) AS key, a.key IS NOT NULL AS is_, b.key IS NOT NULL AS was,
        a.open AS ao, b.open AS bo, a.place AS ap, b.place AS bp, a.activity AS aa, b.activity AS ba
      FROM a FULL JOIN b ON a.period = b.period AND a.key = b.key)
SELECT period, key, 'opened' AS event FROM j WHERE is_ AND NOT was AND ao UNION ALL
SELECT period, key, 'closed' FROM j WHERE is_ AND was AND bo AND NOT ao UNION ALL
SELECT period, key, 'left' FROM j WHERE was AND NOT is_ UNION ALL
SELECT period, key, 'reopened' FROM j WHERE is_ AND was AND NOT bo AND ao UNION ALL
SELECT period, key, 'moved' FROM j WHERE is_ AND was AND ap IS DISTINCT FROM bp UNION ALL
SELECT period, key, 'changed_activity' FROM j WHERE is_ AND was AND aa IS DISTINCT FROM ba""")
def snapshot_events(spark, d):
    o = t(spark, d, "orders").withColumn("period", F.trunc("o_orderdate", "month"))
    last = o.groupBy("period", F.col("o_custkey").alias("key")).agg(F.max(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority")).alias("m"))
    snap = last.select("period", "key", (F.col("m.o_orderstatus") != "F").alias("open"), F.col("m.o_orderpriority").alias("place"), F.col("m.o_orderstatus").alias("activity"))
    return indicators.snapshot_events(snap)


@register(LIFE + """, x AS (SELECT key, active, c_nationkey || ':' || c_mktsegment AS address, key % 300 AS root, key % 7 = 0 AS head FROM firm)
SELECT key, count(*) FILTER (active) OVER a AS active_here, count(*) FILTER (active) OVER a >= 20 AS registered_only,
  count(*) FILTER (active) OVER r AS active_of_root, coalesce(bool_or(head AND active) OVER r, FALSE) AS head_active, NOT head AS is_branch
FROM x WINDOW a AS (PARTITION BY address), r AS (PARTITION BY root)""")
def address_profile(spark, d):
    x = firms(spark, d).select(
        "key", "active", F.concat_ws(":", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("address"), (F.col("key") % 300).alias("root"), (F.col("key") % 7 == 0).alias("head")
    )
    return indicators.address_profile(x, "address", "root")


def completed(a: str, b: str) -> str:
    return f"(year({b}) - year({a}) - CASE WHEN (month({b}), day({b})) < (month({a}), day({a})) THEN 1 ELSE 0 END)"


@register(LIFE + f""", g AS (SELECT c_nationkey * 10 + key % 10 AS site, count(*) AS total, count(*) FILTER (active) AS open, count(*) FILTER (NOT active) AS closed,
  min(s) AS first_opening, max(closed) AS last_closing FROM firm GROUP BY 1)
SELECT site, total, open, closed, first_opening, last_closing,
  round(closed::DOUBLE / greatest(1, {completed('first_opening', "DATE '2001-08-01'")}), 3) AS churn_per_year,
  open = 0 AND coalesce(last_closing >= DATE '1998-08-01', FALSE) AS vacant FROM g""")
def site_history(spark, d):
    x = firms(spark, d).select((F.col("c_nationkey") * 10 + F.col("key") % 10).cast("long").alias("site"), "active", F.col("s").alias("start"), F.col("closed").alias("end"))
    return indicators.site_history(x, "site", AS_OF)


PREFIXES = [("STANDARD", "yes"), ("STANDARD POL", "no"), ("SMALL", "yes"), ("SMALL PLATED ", "limited"), ("PROMO B", "no"), ("ECONOMY ANODIZED STEEL", "limited"), ("LARGE", "yes")]


@register(f"""WITH r(prefix, allowed) AS (VALUES {', '.join(str(p) for p in PREFIXES)})
SELECT p_partkey, p_type, arg_max(prefix, length(prefix)) AS prefix, arg_max(allowed, length(prefix)) AS allowed
FROM part LEFT JOIN r ON starts_with(p_type, prefix) GROUP BY ALL""")
def longest_prefix_rule(spark, d):
    rules = spark.createDataFrame(PREFIXES, "prefix string, allowed string")
    p = t(spark, d, "part").select(F.col("p_partkey").alias("_id"), "p_partkey", "p_type")
    return relational.longest_prefix(p, "p_type", rules, "prefix", 2, 24).drop("_id")


PAIRS = """pairs AS (SELECT c_custkey, s_suppkey, round(1 / (1 + abs(c_acctbal - s_acctbal)), 6) AS score
  FROM customer JOIN supplier ON c_nationkey = s_nationkey)"""


@register(f"""WITH {PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY score DESC, s_suppkey) AS a,
  row_number() OVER (PARTITION BY s_suppkey ORDER BY score DESC, c_custkey) AS b FROM pairs)
SELECT c_custkey, s_suppkey, score FROM r WHERE a = 1 AND b = 1""")
def mutual_best_match(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation"))
    s = t(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    # the score is rounded: it belongs to gaps up to that of half a step less
    reach = lambda x: F.when(x > 5e-7, 1 / (x - 5e-7) - 1).otherwise(float("inf"))
    return relational.mutual_closest(c, s, "c_custkey", "s_suppkey", ["nation"], "balance", lambda gap: F.round(1 / (1 + gap), 6), reach)


@register("""SELECT c_custkey AS left_id, s_suppkey AS right_id FROM customer JOIN supplier
ON (c_nationkey = s_nationkey AND c_custkey % 50 = s_suppkey % 50) OR (c_custkey = s_suppkey)""")
def or_join_candidates(spark, d):
    a = t(spark, d, "customer").select(F.col("c_custkey").alias("left_id"), F.col("c_nationkey").alias("nation"), (F.col("c_custkey") % 50).alias("m"), F.col("c_custkey").alias("k"))
    b = t(spark, d, "supplier").select(F.col("s_suppkey").alias("right_id"), F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 50).alias("m"), F.col("s_suppkey").alias("k"))
    return relational.candidates(a, b, [["nation", "m"], ["k"]])


TRI = """list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''),
  lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"""


@register(f"""WITH x AS (SELECT p_partkey, list_sort({TRI.format('p_name')}) AS g FROM part),
r AS (SELECT *, p_partkey = min(p_partkey) OVER (PARTITION BY g) AS head FROM x)
SELECT a.p_partkey AS left_id, b.p_partkey AS right_id,
  (len(list_intersect(a.g, b.g))::DOUBLE / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))))::FLOAT::DOUBLE AS sim
FROM (FROM r WHERE head) a JOIN r b ON (b.head OR a.g = b.g) AND a.p_partkey < b.p_partkey
WHERE (len(list_intersect(a.g, b.g))::DOUBLE / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))))::FLOAT >= 0.6""")
def trigram_similarity(spark, d):
    """Similar names of the whole table. Rows with the same trigrams are a class, headed by its smallest key: pairs of heads that meet the
    threshold, and each head with every other row of its class (1, or NaN without any trigram), from which all other pairs follow."""
    # letters as lower() of the SQL has them, words as it splits them
    name = F.trim(F.regexp_replace(F.lower(F.translate("p_name", "İ", "i")), "[^a-z0-9]+", " "))
    p = t(spark, d, "part").select("p_partkey", name.alias("name")).where("name is not null")
    names = p.groupBy("name").agg(F.min("p_partkey").alias("id")).withColumn("g", F.array_sort(text.trigrams("name")))
    names = relational.cut(names.withColumn("left_id", F.min("id").over(W.partitionBy("g"))))
    heads = names.groupBy("g", "left_id").agg(F.min("name").alias("name"))
    often = heads.select(F.explode("g").alias("g")).groupBy("g").count().orderBy(F.desc("count"), "g").limit(1000).collect()
    heads = heads.select("left_id", F.lit(0).alias("block"), "name")
    links = resolve.fuzzy_pairs(heads, heads.withColumnRenamed("left_id", "right_id"), "block", 0.6, ascending=True, often=[r.g for r in often])
    copies = p.join(names.select("name", "left_id"), "name").where("left_id < p_partkey")
    one = F.when(F.col("name") == "", float("nan")).otherwise(1.0)
    return links.withColumn("sim", F.col("sim").cast("double")).unionByName(copies.select("left_id", F.col("p_partkey").alias("right_id"), one.alias("sim")))


@register("""WITH l AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'), p AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'A')
SELECT x.l_orderkey, x.l_linenumber, CASE WHEN l.l_partkey IS NOT NULL THEN 'part_supplier' WHEN p.l_partkey IS NOT NULL THEN 'part' WHEN s.s_suppkey IS NOT NULL THEN 'supplier' END AS level,
  CASE WHEN l.l_partkey IS NOT NULL THEN x.l_partkey * 1000 + x.l_suppkey WHEN p.l_partkey IS NOT NULL THEN x.l_partkey WHEN s.s_suppkey IS NOT NULL THEN x.l_suppkey END AS at
FROM lineitem x LEFT JOIN l ON x.l_partkey = l.l_partkey AND x.l_suppkey = l.l_suppkey LEFT JOIN p ON x.l_partkey = p.l_partkey
LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = x.l_suppkey WHERE x.l_returnflag = 'N'""")
def cascade_lookup(spark, d):
    line = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    both = line.where("l_returnflag = 'R'").select("l_partkey", "l_suppkey").distinct().withColumn("at", F.col("l_partkey") * 1000 + F.col("l_suppkey"))
    part = line.where("l_returnflag = 'A'").select("l_partkey").distinct().withColumn("at", F.col("l_partkey"))
    supp = t(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_suppkey").alias("at"))
    x = line.where("l_returnflag = 'N'").withColumn("id", F.struct("l_orderkey", "l_linenumber"))
    levels = [("part_supplier", both, ["l_partkey", "l_suppkey"]), ("part", part, ["l_partkey"]), ("supplier", supp, ["l_suppkey"])]
    return relational.cascade(x, "id", levels, "at").select("id.l_orderkey", "id.l_linenumber", "level", "at")


@register("""WITH j AS (SELECT a.p_partkey AS id, b.p_partkey AS near, abs(a.p_partkey - b.p_partkey) AS gap FROM part a JOIN part b
  ON a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey AND abs(a.p_partkey - b.p_partkey) <= 30 AND a.p_partkey % 2 = b.p_partkey % 2)
SELECT id, near, gap FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY gap, near) AS r FROM j) WHERE r = 1""")
def nearest_same_parity(spark, d):
    """Candidates meet in buckets of 30 numbers, the own and both next to it, never a whole brand against itself."""
    p = t(spark, d, "part").select("p_partkey", "p_brand", F.floor(F.col("p_partkey") / 30).alias("b"))
    a = p.select(F.col("p_partkey").alias("id"), "p_brand", F.explode(F.array(F.col("b") - 1, F.col("b"), F.col("b") + 1)).alias("b"), (F.col("p_partkey") % 2).alias("odd"))
    c = p.select(F.col("p_partkey").alias("near"), "p_brand", "b", (F.col("p_partkey") % 2).alias("odd"))
    gap = F.abs(F.col("id") - F.col("near"))
    x = a.join(c, ["p_brand", "b", "odd"]).where((F.col("id") != F.col("near")) & (gap <= 30))
    return x.groupBy("id").agg(F.min(F.struct(gap.alias("gap"), "near")).alias("m")).select("id", "m.near", "m.gap")


@register(f"""WITH p AS (SELECT c_nationkey, c_custkey AS id, {XY} AS x, ((c_custkey * 104729) % 10009)::DOUBLE * 3.0 AS y FROM customer),
c AS (SELECT c_nationkey, avg(x) AS cx, avg(y) AS cy, count(*) AS n FROM p GROUP BY 1),
r AS (SELECT p.*, n, row_number() OVER (PARTITION BY p.c_nationkey ORDER BY (x - cx) ** 2 + (y - cy) ** 2, id) AS r FROM p JOIN c USING (c_nationkey))
SELECT c_nationkey, id, x, y, n FROM r WHERE r = 1""")
def representative_point(spark, d):
    return geo.representative_points(placed(spark, d).withColumnRenamed("c_custkey", "id"), "c_nationkey")


@register("SELECT c_custkey FROM customer ORDER BY md5(c_custkey::VARCHAR || 'seed-1'), c_custkey LIMIT 100")
def hash_sample(spark, d):
    return relational.hash_sample(t(spark, d, "customer").select("c_custkey"), "c_custkey", "seed-1", 100)


@register("""SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def distinct_on_latest(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return relational.first_by(o, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc()])


@register("""SELECT o_orderpriority, count(*) AS n, quantile_cont(date_diff('day', o_orderdate::DATE, l_shipdate::DATE), 0.5) AS median,
  quantile_cont(date_diff('day', o_orderdate::DATE, l_shipdate::DATE), 0.9) AS p90 FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def percentile_median(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    x = t(spark, d, "lineitem").select("l_orderkey", "l_shipdate").join(o, "l_orderkey").withColumn("days", F.datediff("l_shipdate", "o_orderdate"))
    return x.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.percentile("days", F.lit(0.5)).alias("median"), F.percentile("days", F.lit(0.9)).alias("p90"))


@register("""WITH pl AS (SELECT i AS place, 1.0 + i % 7 AS km2, 10 + i AS firms FROM range(0, 40) r(i)), kd(kind) AS (VALUES ('view'), ('click'), ('signup'), ('purchase'), ('error')),
n AS (SELECT user_id % 40 AS place, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2),
x AS (SELECT pl.place, kind, coalesce(n, 0) AS n, coalesce(n, 0)::DOUBLE / km2 AS per_km2, 1000 * coalesce(n, 0)::DOUBLE / firms AS per_1000 FROM pl CROSS JOIN kd LEFT JOIN n USING (place, kind)),
y AS (SELECT *, round(100 * percent_rank() OVER (PARTITION BY kind ORDER BY CASE WHEN kind = 'purchase' THEN coalesce(per_1000, 0) ELSE per_km2 END ASC NULLS LAST), 1) AS percentile FROM x)
SELECT place, kind, n, round(per_km2, 4) AS per_km2, round(per_1000, 4) AS per_1000, percentile,
  round(avg(CASE WHEN kind IN ('purchase', 'error', 'click') THEN percentile END) OVER (PARTITION BY place), 1) AS index FROM y""")
def risk_percent_rank(spark, d):
    places = spark.range(40).select(F.col("id").alias("place"), (1.0 + F.col("id") % 7).alias("km2"), (10 + F.col("id")).alias("firms"))
    e = t(spark, d, "events").select((F.col("user_id") % 40).alias("place"), F.col("event_type").alias("kind"))
    return indicators.risk_index(e, places, ["view", "click", "signup", "purchase", "error"], ["purchase"], ["purchase", "error", "click"])


@register("""WITH l AS (SELECT date_trunc('month', max(o_orderdate::DATE))::DATE AS m FROM orders WHERE o_orderdate::DATE <= DATE '2000-06-15')
SELECT date_trunc('month', o_orderdate)::DATE AS month, o_orderstatus, count(*) AS n FROM orders, l
WHERE o_orderdate::DATE >= m - INTERVAL 11 MONTH AND o_orderdate::DATE < m + INTERVAL 1 MONTH GROUP BY 1, 2""")
def trailing_window(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")
    w = indicators.trailing_window(o, "day", "2000-06-15")
    return w.groupBy(F.trunc("day", "month").alias("month"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


WORDS = [("Roubo a pedestre", 1), ("FURTO qualificado", 2), ("Alarme disparado: roubo", 3), ("Queda de árvore", 4), ("Acidente de trânsito", 5), ("Perturbação do sossego", 6), ("outra coisa", 7), ("  ", 8), (None, 9)]


@register("""WITH v(v, i) AS (VALUES ('violento', 1), ('patrimonial', 2), ('outros', 3), ('fisico', 4), ('transito', 5), ('ordem_publica', 6), ('outros', 7), (NULL, 8), (NULL, 9))
SELECT v AS category, count(*) AS n FROM customer JOIN v ON c_custkey % 9 + 1 = i GROUP BY 1""")
def first_match_category(spark, d):
    w = spark.createDataFrame(WORDS, "t string, i long")
    x = t(spark, d, "customer").select((F.col("c_custkey") % 9 + 1).alias("i")).join(F.broadcast(w), "i")
    return x.groupBy(text.category("t").alias("category")).agg(F.count(F.lit(1)).alias("n"))


HAZ = LIFE + f""", y AS (SELECT key, c_mktsegment AS division, key % 3 = 0 AS small, c_nationkey AS district, s, active, e,
   unnest(range({{0}}, {{1}} + 1))::INTEGER AS year FROM firm),
x0 AS (SELECT *, make_date(year, 1, 1) AS j FROM y),
x AS (SELECT key, year, division, small, district, (NOT active AND e < make_date(year + 1, 1, 1))::INTEGER AS event,
  CASE WHEN a < 1 THEN '0-1' WHEN a < 2 THEN '1-2' WHEN a < 3 THEN '2-3' WHEN a < 5 THEN '3-5' WHEN a < 10 THEN '5-10' ELSE '10+' END AS band
  FROM (SELECT *, {completed('s', 'j')} AS a FROM x0 WHERE s < j AND (active OR e >= j))),
hg AS (SELECT coalesce(avg(event), 0)::DOUBLE AS hg FROM x),
h0 AS (SELECT band, small, (sum(event) + 50.0 * hg) / (count(*) + 50.0) AS h0 FROM x, hg GROUP BY band, small, hg),
h1 AS (SELECT division, band, small, (sum(event) + 50.0 * h0) / (count(*) + 50.0) AS h1 FROM x JOIN h0 USING (band, small) GROUP BY division, band, small, h0),
mult AS (SELECT district, (sum(event) + 20.0) / (sum(h1) + 20.0) AS mult FROM x JOIN h1 USING (division, band, small) GROUP BY 1)"""


def hazard_firms(spark, d) -> DataFrame:
    return firms(spark, d).select(
        "key", F.col("c_mktsegment").alias("division"), (F.col("key") % 3 == 0).alias("small"), F.col("c_nationkey").alias("district"), F.col("s").alias("start"), "active", F.col("e").alias("changed")
    )


@register(HAZ.format(1996, 2000) + f""", n AS (SELECT DISTINCT key, division, small, district, {completed('s', "DATE '2001-08-01'")} AS a FROM y WHERE active),
b AS (SELECT *, CASE WHEN a < 1 THEN '0-1' WHEN a < 2 THEN '1-2' WHEN a < 3 THEN '2-3' WHEN a < 5 THEN '3-5' WHEN a < 10 THEN '5-10' ELSE '10+' END AS band FROM n)
SELECT key, b.division, round(least(1.0, coalesce(h1, h0, hg) * coalesce(mult, 1.0)), 4) AS risk
FROM b LEFT JOIN h1 USING (division, band, small) LEFT JOIN h0 USING (band, small) LEFT JOIN mult USING (district), hg""")
def hazard_shrinkage(spark, d):
    return risk.current_risk(hazard_firms(spark, d), 2001, AS_OF)


@register("""WITH x AS (SELECT n_chars, quality FROM documents JOIN labels USING (doc_id)),
r AS (SELECT *, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS rk FROM x),
s AS (SELECT count(*) AS n, sum(quality)::BIGINT AS positives, sum(CASE WHEN quality = 1 THEN rk END) AS r FROM r)
SELECT n, positives, round((r - positives * (positives + 1) / 2.0) / (positives * (n - positives)), 4)::DOUBLE AS auc FROM s""")
def backtest_auc(spark, d):
    x = t(spark, d, "documents").select("doc_id", "n_chars").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    return relational.auc(x, "n_chars", "quality").withColumn("auc", F.col("auc").cast("double"))


@register("""WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS i, count(*) OVER () AS n FROM orders)
SELECT ceil(10.0 * i / n)::INTEGER AS decile, count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM r GROUP BY 1""")
def calibration_decile(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    x = relational.deciles(o, [F.col("o_totalprice"), F.col("o_orderkey")])
    return x.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))


@register(LIFE + """, c AS (SELECT key, unnest([
  CASE WHEN c_acctbal > 5000 THEN {'p': -15, 'c': 'porte_demais'} END, CASE WHEN c_acctbal BETWEEN 1000 AND 5000 THEN {'p': -10, 'c': 'porte_epp'} END,
  CASE WHEN s <= DATE '1999-08-01' THEN {'p': -10, 'c': 'idade_2a'} END, CASE WHEN c_mktsegment = 'BUILDING' THEN {'p': -10, 'c': 'ponto_comercial'} END,
  CASE WHEN key % 5 = 0 THEN {'p': -15, 'c': 'fornecedor_publico'} END, CASE WHEN key % 11 = 0 THEN {'p': 10, 'c': 'divida_pgfn'} END,
  CASE WHEN key % 13 = 0 THEN {'p': 30, 'c': 'sancao'} END]) AS x FROM firm JOIN customer ON c_custkey = key WHERE active)
SELECT f.key, greatest(0, least(100, -coalesce(sum(x.p), 0)))::INTEGER AS score, coalesce(string_agg(x.c, ',' ORDER BY x.p, x.c), '') AS criteria
FROM (SELECT key FROM firm WHERE active) f LEFT JOIN c ON c.key = f.key AND x IS NOT NULL GROUP BY 1""".replace("firm JOIN customer", "(SELECT * FROM firm) f0 JOIN (SELECT c_custkey, c_acctbal FROM customer) k").replace("ON c_custkey = key WHERE", "ON c_custkey = key WHERE"))
def lead_score(spark, d):
    k = F.col("key")
    criteria = {
        "porte_demais": F.col("c_acctbal") > 5000, "porte_epp": F.col("c_acctbal").between(1000, 5000), "idade_2a": F.col("s") <= F.lit("1999-08-01").cast("date"),
        "ponto_comercial": F.col("c_mktsegment") == "BUILDING", "fornecedor_publico": k % 5 == 0, "divida_pgfn": k % 11 == 0, "sancao": k % 13 == 0,
    }
    return risk.lead_score(firms(spark, d).where("active"), criteria)


@register(LIFE + """SELECT c_nationkey, count(*) FILTER (s > DATE '2000-08-01' AND s <= DATE '2001-08-01') AS openings,
  count(*) FILTER (NOT active AND e > DATE '2000-08-01' AND e <= DATE '2001-08-01') AS closings,
  count(*) FILTER (s > DATE '2000-08-01' AND s <= DATE '2001-08-01') - count(*) FILTER (NOT active AND e > DATE '2000-08-01' AND e <= DATE '2001-08-01') AS momentum FROM firm GROUP BY 1""")
def momentum(spark, d):
    x = firms(spark, d).select("c_nationkey", "active", F.col("s").alias("start"), F.col("e").alias("end"))
    return indicators.momentum(x, "c_nationkey", AS_OF)


@register("""WITH m AS (SELECT *, date_trunc('month', o_orderdate)::DATE AS month FROM orders), l AS (SELECT o_custkey, max(month) AS last FROM m GROUP BY 1)
SELECT m.o_custkey, last, round(sum(o_totalprice), 2) AS total FROM m JOIN l ON m.o_custkey = l.o_custkey AND month = last GROUP BY 1, 2""")
def latest_period_sum(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("month"))
    return indicators.latest_period_sum(o, "o_custkey", "month", "o_totalprice").withColumn("total", F.round("total", 2))


@register("""WITH e AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'export' ELSE 'credit' END AS list, o_custkey AS cnpj, o_custkey % 200 AS root, o_orderdate::DATE AS date, o_totalprice AS value, o_orderpriority AS label FROM orders),
f AS (SELECT c_custkey AS key, c_custkey % 200 AS root FROM customer),
x AS (SELECT key, list, cnpj, date, value, label FROM e JOIN f ON cnpj = key WHERE list = 'export' UNION ALL SELECT key, list, cnpj, date, value, label FROM e JOIN f USING (root) WHERE list = 'credit'),
y AS (SELECT *, max(date) OVER (PARTITION BY key, list) AS last FROM x)
SELECT key, list, CASE WHEN bool_or(cnpj = key) THEN 'cnpj' ELSE 'raiz' END AS via, count(*) AS n,
  round(CASE WHEN list = 'export' THEN sum(value) ELSE sum(CASE WHEN date = last THEN value END) END, 2) AS value, max(last) AS last,
  array_to_string((list_sort(list_distinct(list(label))))[1:5], '|') AS labels FROM y GROUP BY key, list""")
def list_rollup(spark, d):
    o = t(spark, d, "orders")
    e = o.select(
        F.when(F.col("o_orderkey") % 2 == 0, "export").otherwise("credit").alias("list"), F.col("o_custkey").alias("cnpj"), (F.col("o_custkey") % 200).alias("root"),
        F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("value"), F.col("o_orderpriority").alias("label"),
    )
    f = t(spark, d, "customer").select(F.col("c_custkey").alias("key"), (F.col("c_custkey") % 200).alias("root"))
    specs = spark.createDataFrame([("export", "establishment", "soma"), ("credit", "company", "ultimo")], "list string, level string, rule string")
    return lists.list_rollup(e, f, specs).withColumn("value", F.round("value", 2))


@register("""SELECT l_suppkey, count(*) AS items, count(DISTINCT l_orderkey) AS contracts, count(DISTINCT CASE WHEN l_shipdate::DATE >= DATE '2000-01-01' THEN l_orderkey END) AS running,
  round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1""")
def contracts_rollup(spark, d):
    x = t(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_extendedprice", F.col("l_shipdate").cast("date").alias("day"))
    return lists.contracts_rollup(x, "l_suppkey", "l_orderkey", "l_extendedprice", "day", "2000-01-01")


@register("""SELECT date_trunc('month', o_orderdate)::DATE AS month, o_orderpriority AS kind, count(*) AS n, count(a) AS answered,
  quantile_cont(date_diff('day', o_orderdate::DATE, a), 0.5) AS median_days
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate)::DATE AS a FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def requests_rollup(spark, d):
    a = t(spark, d, "lineitem").where("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").cast("date").alias("answered_on"))
    r = t(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("opened"), F.trunc("o_orderdate", "month").alias("month"), F.col("o_orderpriority").alias("kind"))
    return lists.requests_rollup(r.join(a, "o_orderkey", "left"), ["month", "kind"])


@register("""SELECT c_mktsegment, sum(CASE WHEN c_acctbal >= 0 THEN c_acctbal END * (c_custkey % 17)) / nullif(sum(CASE WHEN c_acctbal >= 0 THEN c_custkey % 17 END), 0) AS mean FROM customer GROUP BY 1""")
def weighted_mean_null(spark, d):
    v = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    return t(spark, d, "customer").groupBy("c_mktsegment").agg(relational.weighted_mean(v, F.col("c_custkey") % 17).alias("mean"))


@register("""WITH r AS (SELECT c_nationkey AS place, count(*) AS residents FROM customer GROUP BY 1),
s AS (SELECT c_nationkey AS place, c_mktsegment AS class, count(*) AS n FROM customer WHERE c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') GROUP BY 1, 2),
c AS (SELECT class, sum(n) AS all_n FROM s GROUP BY 1), g AS (SELECT place, class, coalesce(n, 0) AS n, residents * all_n::DOUBLE / (SELECT sum(residents) FROM r) AS e FROM r CROSS JOIN c LEFT JOIN s USING (place, class))
SELECT place, class, n, round(e, 3) AS expected, round(e - n, 3) AS gap, round(100 * n / e, 0) AS index FROM g""")
def expected_gap(spark, d):
    c = t(spark, d, "customer").select(F.col("c_nationkey").alias("place"), F.col("c_mktsegment").alias("class"), "c_acctbal")
    residents = c.groupBy("place").agg(F.count(F.lit(1)).alias("residents"))
    supply = c.where("c_acctbal > 0").groupBy("place", "class").agg(F.count(F.lit(1)).alias("n"))
    return indicators.supply_gap(supply, residents, ["BUILDING", "MACHINERY", "FURNITURE"])


@register("""WITH w AS (SELECT user_id % 50 AS zone, sum(value) FILTER (event_type = 'view') AS age_0_14, sum(value) FILTER (event_type = 'click') AS age_15_29, sum(value) FILTER (event_type = 'signup') AS age_30_59,
  sum(value) FILTER (event_type = 'purchase') AS age_60, sum(value) FILTER (event_type = 'error') AS people FROM events GROUP BY 1)
SELECT zone, age_0_14, age_15_29, age_30_59, age_60, people, people AS residents, round(people / (1.0 + zone % 5), 2) AS density,
  round(100 * (age_0_14 + age_60) / nullif(age_15_29 + age_30_59, 0), 2) AS dependency, round(100 * age_60 / nullif(age_0_14, 0), 2) AS ageing FROM w""")
def pivot_long_mapping(spark, d):
    long = t(spark, d, "events").select((F.col("user_id") % 50).alias("zone"), F.col("event_type").alias("variable"), "value")
    area = spark.range(50).select(F.col("id").alias("zone"), (1.0 + F.col("id") % 5).alias("km2"))
    mapping = {"view": "age_0_14", "click": "age_15_29", "signup": "age_30_59", "purchase": "age_60", "error": "people"}
    return indicators.demography(long, mapping, area)


@register("""WITH x AS (SELECT user_id % 20 AS station, date_trunc('hour', ts) AS h, max(value) AS v, max(value) - 1 AS lo FROM events GROUP BY 1, 2)
SELECT station, (h - INTERVAL 3 HOUR)::DATE AS day, round_even(sum(v), 7) AS rain, count(*) FILTER (v > 0) AS rain_hours, round_even(avg(v), 7) AS mean, max(v) AS max, min(lo) AS min, count(v) AS n FROM x GROUP BY 1, 2""")
def daily_climate(spark, d):
    e = t(spark, d, "events").select((F.col("user_id") % 20).alias("station"), F.date_trunc("hour", "ts").alias("ts"), F.col("value").alias("rain"), F.col("value").alias("temp"), (F.col("value") - 1).alias("low"))
    return indicators.daily_climate(e, places=7)


@register("""WITH s AS (SELECT l_partkey, l_partkey % 97 AS cell, count(*) AS d, count(DISTINCT l_suppkey) AS r FROM lineitem GROUP BY 1)
SELECT cell, count(*) AS stops, max(r) AS routes, sum(d)::BIGINT AS departures FROM s GROUP BY 1""")
def stops_rollup(spark, d):
    x = t(spark, d, "lineitem").select(F.col("l_partkey").alias("stop"), F.col("l_suppkey").alias("route"), (F.col("l_partkey") % 97).alias("cell"))
    return lists.stops_rollup(x)


@register("""SELECT p_size AS cell, count(*) AS buildings, round(sum(p_retailprice), 1) AS footprint,
  round(sum(p_retailprice * CASE WHEN p_partkey % 4 > 0 THEN (p_partkey % 4)::DOUBLE WHEN p_partkey % 8 = 0 THEN greatest(p_size / 3.0::DOUBLE, 1.0) ELSE 1.0 END), 1) AS floor_area FROM part GROUP BY 1""")
def buildings_rollup(spark, d):
    k = F.col("p_partkey")
    x = t(spark, d, "part").select(F.col("p_size").alias("cell"), F.col("p_retailprice").alias("area"), (k % 4).alias("floors"), F.when(k % 8 == 0, F.col("p_size").cast("double")).alias("height"))
    return lists.buildings_rollup(x)


GEO = "((c_custkey * 7919) % 10007)::DOUBLE / 100070.0 - 25.5"


def located(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return t(spark, d, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("activity"), (((k * 7919) % 10007).cast("double") / 100070.0 - 25.5).alias("lat"), (((k * 104729) % 10009).cast("double") / 100090.0 - 49.3).alias("lon")
    )


def haversine(a: str, b: str, c: str, e: str) -> str:
    return f"2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({e} - {b}) / 2), 2))))"


@register(f"""WITH p AS (SELECT c_mktsegment AS activity, {GEO} AS lat, ((c_custkey * 104729) % 10009)::DOUBLE / 100090.0 - 49.3 AS lon FROM customer),
g AS (SELECT activity, count(*) FILTER ({haversine('lat', 'lon', '-25.45', '-49.25')} <= 2000) AS n, count(*) AS n_city FROM p GROUP BY 1)
SELECT activity, n, n_city, round(n / (pi() * 4), 1) AS per_km2, round(n_city / 111.0, 1) AS per_km2_city, round(100 * (n / (pi() * 4)) / (n_city / 111.0), 0) AS index,
  round(1000 * (n / 5000.0::DOUBLE), 2) AS per_1000, round(100 * (n / 5000.0::DOUBLE) / (n_city / 60000.0::DOUBLE), 0) AS index_residents FROM g WHERE n > 0""")
def radius_profile(spark, d):
    inside = geo.within(F.col("lat"), F.col("lon"), -25.45, -49.25, 2000.0)
    return indicators.radius_profile(located(spark, d), inside, 3.141592653589793 * 4, 111.0, 5000.0, 60000.0)


@register(f"""WITH p AS (SELECT c_custkey AS id, {GEO} AS lat, ((c_custkey * 104729) % 10009)::DOUBLE / 100090.0 - 49.3 AS lon FROM customer),
s AS (SELECT s_suppkey AS id, ((s_suppkey * 3571) % 1009)::DOUBLE / 10090.0 - 25.5 AS lat, ((s_suppkey * 7907) % 1013)::DOUBLE / 10130.0 - 49.3 AS lon FROM supplier),
j AS (SELECT p.id AS a_id, s.id AS b_id, {haversine('p.lat', 'p.lon', 's.lat', 's.lon')} AS metres FROM p, s)
SELECT a_id, b_id, round(metres, 3) AS metres FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY metres, b_id) AS r FROM j WHERE metres <= 1500) WHERE r = 1""")
def nearest_within(spark, d):
    k = F.col("s_suppkey")
    b = t(spark, d, "supplier").select(k.alias("b_id"), (((k * 3571) % 1009).cast("double") / 10090.0 - 25.5).alias("lat"), (((k * 7907) % 1013).cast("double") / 10130.0 - 49.3).alias("lon"))
    return geo.nearest(located(spark, d).withColumnRenamed("c_custkey", "a_id"), b, 1500.0).withColumn("metres", F.round("metres", 3))


def zones(spark) -> DataFrame:
    """25 districts of 1200 by 1200 that overlap by 200, and one zone around four of them."""
    x0, y0 = (F.col("id") % 5) * 6000.0, F.floor(F.col("id") / 5) * 6000.0
    corner = lambda dx, dy: F.struct((x0 + dx).alias("x"), (y0 + dy).alias("y"))
    ring = F.array(corner(0.0, 0.0), corner(6200.0, 0.0), corner(6200.0, 6200.0), corner(0.0, 6200.0), corner(0.0, 0.0))
    return spark.range(25).select(F.format_string("D%02d", F.col("id")).alias("code"), F.format_string("district %02d", F.col("id")).alias("name"), ring.alias("ring"))


@register(f"""WITH p AS ({CELL}), z AS (SELECT 'D' || lpad(i::VARCHAR, 2, '0') AS code, 'district ' || lpad(i::VARCHAR, 2, '0') AS name, (i % 5) * 6000.0 AS x0, (i // 5) * 6000.0 AS y0 FROM range(25) r(i)),
j AS (SELECT c_custkey AS id, code, name, row_number() OVER (PARTITION BY c_custkey ORDER BY code, name) AS r FROM p LEFT JOIN z ON x BETWEEN x0 AND x0 + 6200 AND y BETWEEN y0 AND y0 + 6200)
SELECT id, code, name FROM j WHERE r = 1""")
def territory_key(spark, d):
    return geo.polygon_join(placed(spark, d).select(F.col("c_custkey").alias("id"), "x", "y"), zones(spark), 3000.0)


@register(f"""WITH p AS ({CELL}), {HEX}, h2 AS (SELECT c_custkey % 30 AS zone, cell, count(*) AS homes FROM c GROUP BY 1, 2), a AS (SELECT zone, sum(homes) AS t FROM h2 GROUP BY 1),
f AS (SELECT cell, zone, homes::DOUBLE / t AS p FROM h2 JOIN a USING (zone) UNION ALL SELECT 'inside', i, 1.0 FROM range(30, 33) r(i))
SELECT cell, round(sum((100 + zone * 10) * p), 4) AS residents FROM f GROUP BY 1""")
def dasymetric(spark, d):
    """Zones 30 to 32 have no homes and go whole to the cell of a point inside them."""
    h = placed(spark, d).select((F.col("c_custkey") % 30).alias("zone"), geo.hex_cell(F.col("x"), F.col("y"), 500.0).alias("cell")).groupBy("zone", "cell").agg(F.count(F.lit(1)).alias("homes"))
    z = spark.range(33).select(F.col("id").alias("zone"), (100 + F.col("id") * 10).alias("residents"))
    inside = spark.range(28, 33).select(F.col("id").alias("zone"), F.lit("inside").alias("cell"))
    return indicators.dasymetric(h, z, ["residents"], inside)


@register()
def connected_components(spark, d):
    """Parts and suppliers that line items tie together: parts have even node ids, suppliers odd ones. Recursive SQL tries all pairs of
    nodes, too many over the whole table; tests hold it against brute force."""
    return graph.connected(t(spark, d, "lineitem").select((2 * F.col("l_partkey")).alias("u"), (2 * F.col("l_suppkey") + 1).alias("v")))


WALKS = "SELECT s_suppkey % 40 AS u, (s_suppkey * 7 + 3) % 40 AS v, 1 + s_suppkey % 9 AS w FROM supplier"


@register(f"""WITH RECURSIVE e AS (SELECT u, v, min(w) AS w FROM (SELECT * FROM ({WALKS}) UNION ALL SELECT v, u, w FROM ({WALKS})) GROUP BY 1, 2),
r(node, cost) AS (SELECT 1::BIGINT, 0::BIGINT UNION SELECT e.v, r.cost + e.w FROM r JOIN e ON e.u = r.node WHERE r.cost + e.w <= 15)
SELECT node, min(cost)::DOUBLE AS cost FROM r GROUP BY 1""")
def shortest_path_cutoff(spark, d):
    k = F.col("s_suppkey")
    e = t(spark, d, "supplier").select((k % 40).alias("u"), ((k * 7 + 3) % 40).alias("v"), (1 + k % 9).cast("double").alias("w"))
    return graph.shortest(e, spark.range(1).select(F.lit(1).cast("long").alias("node"), F.lit(0.0).alias("cost")), 15.0)


@register()
def earliest_arrival(spark, d):
    """Earliest arrivals over a timetable made of all conversations, one turn after another, the first ones within an hour."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    at = 28800 + turn * 120 + (conv * 30) % 3600
    st = t(spark, d, "conversations").select(conv.cast("string").alias("trip_id"), F.col("turn").alias("seq"), (conv * 3 + turn * 5).alias("stop"), at.alias("arr"), (at + 20).alias("dep"))
    conns = graph.connections(st.withColumn("stop_id", F.col("stop").cast("string")), 28800, 36000)
    last = st.agg(F.max("stop")).first()[0] or 0
    walks = spark.range(last + 1).select(F.col("id").cast("string").alias("a"), (F.col("id") + 1).cast("string").alias("b"), F.lit(180.0).alias("seconds"))
    origins = spark.range(3).select(F.concat(F.lit("q"), F.col("id").cast("string")).alias("query"), (F.col("id") * 7).cast("string").alias("stop"), F.lit(28800.0).alias("time"))
    return graph.earliest_arrivals(conns, walks, origins)


@register("""SELECT user_id, event_id, ts AS dep, lead(ts) OVER w AS arr, event_type AS a, lead(event_type) OVER w AS b FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id) QUALIFY lead(ts) OVER w IS NOT NULL""")
def timetable_pairs(spark, d):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    e = t(spark, d, "events").select("user_id", "event_id", F.col("ts").alias("dep"), F.lead("ts").over(w).alias("arr"), F.col("event_type").alias("a"), F.lead("event_type").over(w).alias("b"))
    return e.where("arr is not null")


def values(spark: SparkSession, d: str, rows: list, name: Callable[[Column], Column]) -> DataFrame:
    """A parser over literal inputs, one per customer modulo their number, counted by input and output."""
    v = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "i long, input string")
    x = t(spark, d, "customer").select((F.col("c_custkey") % len(rows)).alias("i")).join(F.broadcast(v), "i")
    return x.groupBy("input").agg(F.count(F.lit(1)).alias("n")).select("input", name(F.col("input")).alias("output"), "n")


def expected(pairs: list[tuple], kind: str = "VARCHAR") -> str:
    q = lambda v: "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    rows = ", ".join(f"({k}, {q(a)}, {q(b)}::{kind})" for k, (a, b) in enumerate(pairs))
    return f"WITH v(i, input, output) AS (VALUES {rows}) SELECT input, output, count(*) AS n FROM customer JOIN v ON c_custkey % {len(pairs)} = i GROUP BY 1, 2"


def parser(name: str, f: Callable[[Column], Column], pairs: list[tuple], kind: str = "VARCHAR") -> None:
    QUERIES[name] = lambda spark, d: values(spark, d, [a for a, _ in pairs], f)
    ORACLES[name] = expected(pairs, kind)


parser("norm_txt", text.norm_text, [("  Água-da  Boa! ", "AGUA DA BOA"), ("Ærø ßtraße", "AERO SSTRASSE"), ("--", None), ("", None), (None, None), ("N.º 12ª", "N O 12A")])
parser("street_key", text.street_key, [("R DR MOURA", "MOURA"), ("RUA DOUTOR MOURA", "MOURA"), ("Al. Nove de Julho", "NOVE JULHO"), ("R NSRA DA GUIA", "GUIA"), ("RUA", "RUA"), ("ALAMEDA RUA", "RUA"), ("TRAVESSA DAS", "DAS"), ("", None), (None, None)])
parser("street_full_key", text.street_full_key, [("R DR MOURA", "DOUTOR MOURA"), ("R S PEDRO", "SAO PEDRO"), ("R NSRA DA GUIA", "NOSSA SENHORA GUIA"), ("RUA", "RUA"), ("R PEDRO", "PEDRO"), ("TRAVESSA DAS", "DAS"), ("", None)])
parser("norm_name", text.company_name, [("OFICINA ROSA AZUL LTDA - ME", "OFICINA ROSA AZUL"), ("Livraria São Bento S/A", "LIVRARIA SAO BENTO"), ("RUI DE MELO 98765432100", "RUI MELO"), ("LTDA", None), (None, None)])
parser("house_number", text.house_number, [("1234", 1234), ("1234-A", 1234), ("S/N", None), ("0", None), ("", None), ("KM 12", 12), ("1234567890", 123456)], "INTEGER")
parser("postal_code", text.postal_code, [("80.010-000", "80010000"), ("80010000", "80010000"), ("00000000", None), ("8001", None), (None, None)])
parser("activity_code", text.activity_code, [("4711-3/01", "4711301"), ("47113", None), (None, None)])
parser("mask_cpf", lambda c: text.masked_person_id(text.person_id_in(c)), [("RUI DE MELO 98765432100", "***.654.321-**"), ("RUI 987.654.321-00", "***.654.321-**"), ("LIA 987654321001234", None), ("OFICINA LTDA", None), (None, None)])
parser("redact_cpf", text.redacted, [("tel de 123.456.789-01 hoje", "tel de *** hoje"), ("x 123456789012", "x 123456789012"), (None, None)])
parser("check_digits", text.company_id, [("11.222.333/0001-81", "11222333000181"), ("11222333000182", None), ("191", None), ("00000000000191", "00000000000191"), ("000000000191", None), ("123456000149", None), ("00.000.000/0000-00", None), ("11222333", None), (None, None)])
parser("check_digits_padded", lambda c: text.company_id(c, only_companies=True), [("11.222.333/0001-81", "11222333000181"), ("000000000191", "00000000000191"), ("123456000149", "00123456000149"), ("00000000000000", None), ("000000000", None), ("11222333", "11222333"), ("1122233", None), ("11222333000182", None), (None, None)])
parser("parse_compact_date", parse.compact_date, [("20230115", "2023-01-15"), ("20230231", None), ("00000000", None), ("2023011", None), ("abcdefgh", None), (None, None)], "DATE")
parser("parse_dates", parse.any_date, [("05/05/2020", "2020-05-05"), ("2020-05-05 10:00", "2020-05-05"), ("20200505", "2020-05-05"), ("31/02/2020", None), ("x", None), (None, None)], "DATE")
parser("parse_list_dates", parse.list_date, [("2021", "2021-01-01"), ("202103", "2021-03-01"), ("2021-03", "2021-03-01"), ("05/06/2021", "2021-06-05"), ("2021-13", None)], "DATE")
parser("parse_br_number", lambda c: parse.amount(c).cast("double"), [("1.234,56", 1234.56), ("1234.5", 1234.5), ("R$ 10,00", 10), ("1.234", 1234), ("4,599", 4.599), ("12.345.678", 12345678), ("abc", None), ("", None)], "DOUBLE")
parser("parse_hour", parse.hour, [("14:35", 14), ("às 7:05h", 7), ("9", 9), ("99", None), ("25:00", None), ("", None)], "INTEGER")
parser("clock_seconds", parse.clock_seconds, [("08:00:10", 28810), ("25:01:00", 90060), ("x", None), (None, None)], "INTEGER")


@register("""SELECT 'c_mktsegment' AS "column", 0::BIGINT AS bad UNION ALL SELECT 'c_name', count(*) FILTER (regexp_matches(c_name, '(^|[^0-9])[0-9]{3}\\.?[0-9]{3}\\.?[0-9]{3}-?[0-9]{2}([^0-9]|$)')) FROM customer""")
def pii_gate(spark, d):
    return sinks.privacy_gate(t(spark, d, "customer").select("c_name", "c_mktsegment"))


@register(LIFE + """SELECT key FROM firm WHERE active AND key % 4 <> 0 AND key % 6 <> 0 AND key % 5 IN (0, 1) AND key % 3 < 2""")
def publication_cut(spark, d):
    k = F.col("key")
    x = firms(spark, d).select(
        "key", "active", (k % 4 == 0).alias("person"), (k % 6 == 0).alias("mei"),
        F.element_at(F.array(*map(F.lit, ["commercial", "mixed", "residential", "unknown", "unknown"])), (k % 5 + 1).cast("int")).alias("point_type"),
        F.element_at(F.array(*map(F.lit, ["endereco", "numero_proximo", "cep"])), (k % 3 + 1).cast("int")).alias("level"),
    )
    return sinks.publication_cut(x).select("key")


@register("""SELECT 'event_id' AS "column", count(event_id) AS filled, round(100.0 * count(event_id) / count(*), 1) AS percent FROM events UNION ALL
SELECT 'value', count(value), round(100.0 * count(value) / count(*), 1) FROM events UNION ALL SELECT 'props', count(props), round(100.0 * count(props) / count(*), 1) FROM events""")
def column_profile(spark, d):
    return files.profile(t(spark, d, "events").select("event_id", "value", "props")).drop("interest").withColumn("percent", F.col("percent").cast("double"))


@register("""WITH o AS (SELECT c_custkey AS id, c_custkey % 5 AS rev, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS name FROM customer WHERE c_custkey % 4 <> 0),
n AS (SELECT c_custkey AS id, c_custkey % 7 AS rev, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS name FROM customer WHERE c_custkey % 3 <> 1),
j AS (SELECT coalesce(o.id, n.id) AS id, o.rev AS r0, n.rev AS r1, o.name AS n0, n.name AS n1, n.id IS NOT NULL AND (o.rev IS NULL OR n.rev >= o.rev) AS newer FROM o FULL JOIN n ON o.id = n.id)
SELECT id, CASE WHEN newer THEN coalesce(r1, r0) ELSE r0 END AS rev, CASE WHEN newer THEN coalesce(n1, n0) ELSE n0 END AS name FROM j""")
def upsert_latest(spark, d):
    c, k = t(spark, d, "customer"), F.col("c_custkey")
    old = c.where(k % 4 != 0).select(k.alias("id"), (k % 5).alias("rev"), F.when(k % 3 > 0, F.col("c_name")).alias("name"))
    new = c.where(k % 3 != 1).select(k.alias("id"), (k % 7).alias("rev"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("name"))
    return relational.upsert(old, new, ["id"], "rev")


@register("""WITH x AS (SELECT CASE c_custkey % 3 WHEN 0 THEN 'endereco' WHEN 1 THEN 'cep' ELSE 'bairro' END AS level, CASE WHEN c_custkey % 11 > 0 THEN c_nationkey END AS a, (c_nationkey + (c_custkey % 5) // 4) % 25 AS b FROM customer)
SELECT level, count(*) AS n, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS compared, count(*) FILTER (a = b) AS same,
  round(100.0 * count(*) FILTER (a = b) / nullif(count(*) FILTER (a IS NOT NULL AND b IS NOT NULL), 0), 1) AS percent FROM x GROUP BY 1""")
def agreement_by_level(spark, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("long")
    level = F.when(k % 3 == 0, "endereco").when(k % 3 == 1, "cep").otherwise("bairro")
    x = t(spark, d, "customer").select(level.alias("level"), F.when(k % 11 > 0, n).alias("declared"), ((n + F.expr("(c_custkey % 5) div 4")) % 25).alias("computed"))
    return resolve.agreement(x).withColumn("percent", F.col("percent").cast("double"))


@register("""WITH g AS (SELECT CASE c_custkey % 3 WHEN 0 THEN 'endereco' WHEN 1 THEN 'cep' ELSE 'bairro' END AS level, count(*) AS n FROM customer GROUP BY 1),
o AS (SELECT *, CASE level WHEN 'endereco' THEN 1 WHEN 'cep' THEN 2 ELSE 3 END AS p FROM g)
SELECT level, n, round(100.0 * n / sum(n) OVER (), 1) AS percent, round(100.0 * sum(n) OVER (ORDER BY p) / sum(n) OVER (), 1) AS cumulative FROM o""")
def level_report(spark, d):
    k = F.col("c_custkey")
    x = t(spark, d, "customer").select(F.when(k % 3 == 0, "endereco").when(k % 3 == 1, "cep").otherwise("bairro").alias("level"))
    return resolve.level_report(x).withColumns({c: F.col(c).cast("double") for c in ("percent", "cumulative")})


@register("""SELECT c_custkey AS key, c FROM (SELECT c_custkey, sum(o_totalprice) AS c FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)""".replace("SELECT c_custkey AS key, c FROM", "SELECT c_custkey AS key, round(c, 2) AS contract_value, NULL::DOUBLE AS debt_value, NULL::BOOLEAN AS sanctioned FROM"))
def cross_signals(spark, d):
    f = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    c = t(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("key"), F.col("o_totalprice").alias("value"))
    out = lists.signals(f, c, None, None)
    return out.select(F.col("key").cast("long").alias("key"), F.round("contract_value", 2).alias("contract_value"), "debt_value", "sanctioned")


@register("""SELECT c_custkey, key, value FROM (SELECT c_custkey, 'c_name' AS key, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer)""")
def unpivot_columns(spark, d):
    return relational.unpivot(t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_custkey"], ["c_name", "c_mktsegment"])


@register("""SELECT * FROM (SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0) UNION ALL SELECT c_custkey, -1.0 FROM customer WHERE c_custkey % 2 = 1""")
def insert_ignore(spark, d):
    """The new rows hold every customer twice."""
    c = t(spark, d, "customer").select("c_custkey", "c_acctbal")
    new = c.withColumn("c_acctbal", F.explode(F.array(F.lit(-1.0), F.lit(5.0))))
    return relational.insert_ignore(c.where("c_custkey % 2 = 0"), new, ["c_custkey"])


from . import city  # noqa: E402, F401  (registers its queries, with the helpers above)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
