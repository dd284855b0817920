"""Entity resolution: blocked fuzzy joins, permits against firms, addresses against an address census."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import set_similarity, trigrams
from .geo import distance
from .relational import cut, dimension, percentiles, split_sample

#: From most to least precise.
LEVELS = [
    "estabelecimento", "endereco", "endereco_sem_cep", "numero_proximo", "logradouro", "logradouro_aproximado", "logradouro_sem_cep",
    "cep", "bairro", "nao_localizado",
]


def fuzzy_pairs(left: DataFrame, right: DataFrame, block: str, threshold: float, ascending: bool = False, often: Sequence[str] = ()) -> DataFrame:
    """left_id, right_id, sim of the pairs of a block whose names reach a trigram similarity above 0; of a table with itself only those
    with left_id < right_id (ascending). left(left_id, block, name), right alike. often: frequent trigrams, the most frequent first, which
    come last in the order below, so that fewer classes meet; any list gives the same pairs.

    Equal names of a block are compared once, as a class, and the pairs of classes are dealt out to their rows at the end. In one order of
    all trigrams (by hash) two sets that reach the threshold share one of their first n - ceil(threshold n) + 1: classes meet by an
    equi-join on block and such a trigram, so a hot block never meets itself as a whole; a pair comes out at the first trigram that both
    have there, and only if their sizes can reach the threshold. Trigrams take more room than Spark expects: no side is broadcast."""
    t = F.lit(threshold - 1e-6)
    last = F.create_map(*(F.lit(v) for k, g in enumerate(often) for v in (g, (1 << 62) - k))) if often else None
    place = lambda g: F.xxhash64(g) if last is None else F.coalesce(F.try_element_at(last, g), F.shiftright(F.xxhash64(g), 2))

    def side(df: DataFrame, key: str, x: str) -> tuple[DataFrame, DataFrame]:
        df = df.select(key, F.col(block).alias(f"b{x}"), "name").where(F.col(f"b{x}").isNotNull() & F.col("name").isNotNull())
        classes = df.groupBy(f"b{x}", "name").agg(F.min(key).alias(f"c{x}"), F.max(key).alias(f"m{x}"))
        rows = df.join(classes.drop(f"m{x}"), [f"b{x}", "name"]).select(key, f"c{x}")
        sets = classes.select(f"b{x}", f"c{x}", f"m{x}", trigrams("name").alias(f"t{x}"))
        order = F.array_sort(F.transform(f"t{x}", place))
        prefix = F.slice(order, F.lit(1), (F.size(f"t{x}") - F.ceil(t * F.size(f"t{x}")) + 1).cast("int"))
        sets = sets.withColumn(f"p{x}", F.when(F.size(f"t{x}") > 0, prefix))
        return sets.withColumn(f"k{x}", F.explode(f"p{x}")), rows

    (a, rows_a), (b, rows_b) = side(left, "left_id", "a"), side(right, "right_id", "b")
    sizes = F.least(F.size("ta"), F.size("tb")) >= t * F.greatest(F.size("ta"), F.size("tb"))
    once = F.array_min(F.array_intersect("pa", "pb")) == F.col("ka")
    on = (F.col("ba") == F.col("bb")) & (F.col("ka") == F.col("kb")) & sizes & once
    if ascending:
        on &= F.col("ca") < F.col("mb")
    sim = set_similarity(F.col("ta"), F.col("tb"))
    alike = a.join(b.hint("merge"), on).select("ca", "cb", sim.alias("sim")).where(F.col("sim") >= F.lit(threshold))
    pairs = alike.join(rows_a, "ca").join(rows_b, "cb")
    return (pairs.where(F.col("left_id") < F.col("right_id")) if ascending else pairs).select("left_id", "right_id", "sim")


def permit_score(sim: Column, same_activity: Column, same_start: Column, same_number: Column) -> Column:
    """0.5 name + 0.25 activity + 0.25 start, times 0.8 where only the street agrees, three decimals."""
    base = 0.5 * sim.cast("double") + 0.25 * same_activity.cast("int") + 0.25 * same_start.cast("int")
    return F.round(base * F.when(same_number, 1.0).otherwise(0.8), 3)


def match_permits(permits: DataFrame, firms: DataFrame, accept: float = 0.5) -> DataFrame:
    """permit, firm, score, method of mutually best pairs. permits(permit, cep, street, number, name, trade, activity, start) and firms
    alike (name and trade name, of which the best pair counts; a missing trade column is null); pairs share postal code and street, and
    number, activity or start: less can't reach the acceptance level.

    Rows of a street with the same names are a class, and classes are compared, not rows. The score never falls when more agrees. So a
    permit's best firm is the best over the seven sets of what may agree, each with the firms that agree in at least that; of the firms
    of a class that are equal in such a set only the smallest id can be it, and permits alike in class and set share it."""
    agree, names = ["number", "activity", "start"], ["cep", "street", "name", "trade"]
    every = lambda conditions: reduce(Column.__and__, conditions)

    def side(df: DataFrame, key: str, x: str) -> tuple[DataFrame, DataFrame]:
        """Classes with trigrams; rows, once for each set k in which they can agree, with null for what is not in it."""
        df = df.where("cep is not null and street is not null")
        df = df.select(key, *agree, "cep", "street", *(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("name", "trade")))
        classes = df.groupBy(*(F.col(c).alias(f"_{c}") for c in names)).agg(F.min(key).alias(f"c{x}"))
        rows = df.join(classes, every(F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names))
        sets = []
        for k in range(1, 8):
            own = [c for i, c in enumerate(agree) if k >> i & 1]
            value = F.struct(F.lit(k).alias("k"), *(F.when(F.lit(c in own), F.col(c)).alias(f"{c}{x}") for c in agree))
            sets.append(F.when(every(F.col(c).isNotNull() for c in own), value))
        rows = rows.select(key, f"c{x}", "cep", "street", F.explode(F.array_compact(F.array(*sets))).alias("_v")).select(key, f"c{x}", "cep", "street", "_v.*")
        return classes.select(F.col("_cep").alias("cep"), F.col("_street").alias("street"), f"c{x}", trigrams("_name").alias(f"t{x}"), trigrams("_trade").alias(f"u{x}")), rows

    (a, rows_a), (b, rows_b) = side(permits, "permit", "a"), side(firms, "firm", "b")
    group = lambda x: [f"c{x}", "k", *(f"{c}{x}" for c in agree)]
    each = [F.when(F.col(p).isNotNull() & F.col(f).isNotNull(), set_similarity(F.col(p), F.col(f))) for p in ("ta", "ua") for f in ("tb", "ub")]
    alike = a.join(b, ["cep", "street"]).select("ca", "cb", F.greatest(F.lit(0.0).cast("float"), *each).alias("sim"))
    has = [F.col("k").bitwiseAND(F.lit(1 << i)) != 0 for i in range(3)]
    scored = alike.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(7)))).withColumn("score", permit_score(F.col("sim"), has[1], has[2], has[0]))
    scored = scored.where(F.col("score") >= accept).drop("sim")
    # where almost any name will do, rows that agree meet first, else names
    loose = [k for k in range(1, 8) if (accept / (1.0 if k & 1 else 0.8) - 0.25 * (k >> 1 & 1) - 0.25 * (k >> 2)) / 0.5 < 0.3]
    few = F.col("k").isin(loose)
    one = rows_a.groupBy(*group("a")).agg(F.min("permit").alias("permit"), F.first("cep").alias("cep"), F.first("street").alias("street"))
    other = rows_b.groupBy(*group("b")).agg(F.min("firm").alias("firm"), F.first("cep").alias("_cep"), F.first("street").alias("_street")).withColumnsRenamed({"cb": "_c", "k": "_k"})
    same = (F.col("k") == F.col("_k")) & every(F.col(f"{c}a").eqNullSafe(F.col(f"{c}b")) for c in agree)
    cols = [*group("a"), *group("b")[:1], *group("b")[2:], "permit", "firm", "score"]
    tight = scored.where(~few).join(one.drop("cep", "street"), ["ca", "k"]).join(other, (F.col("cb") == F.col("_c")) & same).select(cols)
    wide = one.where(few).join(other, (F.col("cep") == F.col("_cep")) & (F.col("street") == F.col("_street")) & same).withColumnRenamed("_c", "cb")
    found = cut(tight.unionByName(wide.join(scored.where(few), ["ca", "cb", "k"]).select(cols)))

    def best(rows: DataFrame, key: str, x: str, mate: str) -> DataFrame:
        """key and _m, its best mate with score and method."""
        g = found.groupBy(*(F.col(c).alias(f"_{c}") for c in group(x))).agg(F.min(F.struct((-F.col("score")).alias("w"), mate, (~has[0]).alias("far"))).alias("_m"))
        return rows.join(g, every(F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group(x))).groupBy(key).agg(F.min("_m").alias(f"_m{x}"))

    p, f = best(rows_a, "permit", "a", "firm"), best(rows_b, "firm", "b", "permit")
    both = p.join(f, (F.col("_ma.firm") == F.col("firm")) & (F.col("_mb.permit") == F.col("permit")))
    return both.select("permit", "firm", (-F.col("_ma.w")).alias("score"), F.when(F.col("_ma.far"), "mesma_rua").otherwise("mesmo_endereco").alias("method"))


def centre(points: DataFrame, keys: list[str], extent: float | None) -> DataFrame:
    """keys, lon, lat: mean place of each key's points, only where they spread over fewer metres than the extent."""
    g = points.groupBy(*keys).agg(
        F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.min("lon").alias("x0"), F.max("lon").alias("x1"), F.min("lat").alias("y0"), F.max("lat").alias("y1")
    )
    if extent is not None:
        wide = F.sqrt(
            F.pow((F.col("x1") - F.col("x0")) * 111_320.0 * F.cos(F.radians("lat")), F.lit(2.0)) + F.pow((F.col("y1") - F.col("y0")) * 111_320.0, F.lit(2.0))
        )
        g = g.where(wide < extent)
    return g.select(*keys, F.struct("lon", "lat").alias("at"))


def geocode(targets: DataFrame, census: DataFrame, districts: DataFrame) -> DataFrame:
    """id, level, lon, lat of targets(id, name, cep, street, full, number, district) against census(cep, street, full, number, name, lon,
    lat): ten levels, the first that matches wins. street: short key (used with a postal code), full: long key (used without one).

    Exact levels are left joins on grouped lookups. The three levels that rank candidates (establishment names, nearest number of the
    same parity, similar street names) run only on targets that no better level caught, on postal-code blocks, and keep the best by
    grouped minimum, so no target's candidates need sorting in one place.
    """
    numbered = census.where("number is not null")
    address, anywhere = centre(numbered, ["cep", "street", "number"], None), centre(numbered, ["full", "number"], 300.0)
    street, street_any = centre(census, ["cep", "street"], None), centre(census, ["full"], 1500.0)
    cep = centre(census, ["cep"], 1500.0)
    t = targets.select("id", "name", "cep", "street", "full", "number", "district")

    # establishment: similar name at the same postal code (0.7, or 0.5 in the same street)
    shops = census.where("name is not null and length(name) >= 4").select(
        "cep", F.col("street").alias("s"), F.col("number").alias("n"), F.col("name").alias("shop"), trigrams("name").alias("tb"), "lon", "lat"
    )
    near = t.where("length(name) >= 4").select("id", "cep", "street", "number", trigrams("name").alias("ta")).join(shops, "cep")
    sim = set_similarity(F.col("ta"), F.col("tb"))
    in_street = F.coalesce(F.col("street") == F.col("s"), F.lit(False))
    near = near.withColumn("sim", sim).where((F.col("sim") >= F.lit(0.7)) | (in_street & (F.col("sim") >= F.lit(0.5))))
    near = near.groupBy("id").agg(
        F.min(F.struct((~F.col("number").eqNullSafe(F.col("n"))).alias("a"), (-F.col("sim")).alias("b"), "shop", "n", "lon", "lat")).alias("m")
    )
    out = t.join(near.select("id", F.struct("m.lon", "m.lat").alias("p0")), "id", "left")
    out = out.join(address.withColumnRenamed("at", "p1"), ["cep", "street", "number"], "left")
    out = out.join(anywhere.withColumnRenamed("at", "p2"), ["full", "number"], "left")
    out = out.join(street.withColumnRenamed("at", "p4"), ["cep", "street"], "left")
    out = out.join(street_any.withColumnRenamed("at", "p6"), ["full"], "left").join(cep.withColumnRenamed("at", "p7"), ["cep"], "left")
    out = out.join(districts.select("district", F.struct("lon", "lat").alias("p8")), ["district"], "left")
    open_ = out.where("p0 is null and p1 is null and p2 is null")
    other = address.select("cep", "street", F.col("number").alias("n"), "at")
    gap = F.abs(F.col("number") - F.col("n"))
    beside = open_.where("number is not null").select("id", "cep", "street", "number").join(other, ["cep", "street"])
    beside = beside.where((gap <= 30) & (F.pmod("number", F.lit(2)) == F.pmod("n", F.lit(2))))
    beside = beside.groupBy("id").agg(F.min(F.struct(gap.alias("g"), "n", "at")).alias("m")).select("id", F.col("m.at").alias("p3"))
    names = street.select("cep", F.col("street").alias("s"), trigrams("street").alias("tb"), "at")
    alike = open_.where("p4 is null").select("id", "cep", trigrams("street").alias("ta")).join(names, "cep").withColumn("sim", sim)
    alike = alike.where(F.col("sim") >= F.lit(0.6)).groupBy("id").agg(F.min(F.struct((-F.col("sim")).alias("g"), "s", "at")).alias("m"))
    out = out.join(beside, "id", "left").join(alike.select("id", F.col("m.at").alias("p5")), "id", "left")
    at = F.coalesce(*(F.col(f"p{k}") for k in range(9)))
    level = F.coalesce(*(F.when(F.col(f"p{k}").isNotNull(), F.lit(LEVELS[k])) for k in range(9)), F.lit(LEVELS[9]))
    return out.select("id", level.alias("level"), at["lon"].alias("lon"), at["lat"].alias("lat"))


def level_report(found: DataFrame, order: list[str] = LEVELS) -> DataFrame:
    """level, n, percent, cumulative percent in order of precision; the window runs over one row per level."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("level"))
    g = found.groupBy("level").agg(F.count(F.lit(1)).alias("n")).withColumn("place", place)
    total = F.sum("n").over(W.partitionBy())
    run = F.sum("n").over(W.orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow))
    return g.select("level", "n", F.round(100.0 * F.col("n") / total, 1).alias("percent"), F.round(100.0 * run / total, 1).alias("cumulative"))


def agreement(found: DataFrame) -> DataFrame:
    """level, n, compared, same, percent of found(level, declared, computed)."""
    g = found.groupBy("level").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("declared").isNotNull() & F.col("computed").isNotNull()).alias("compared"),
        F.count_if(F.col("declared") == F.col("computed")).alias("same"),
    )
    return g.withColumn("percent", F.round(100.0 * F.col("same") / F.nullif(F.col("compared"), F.lit(0)), 1))


def geocode_error(found: DataFrame) -> DataFrame:
    """level, n, median and p90 of the error in metres, share within 50 and 250 m of found(level, metres)."""
    g = found.groupBy("level").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(100 * F.avg((F.col("metres") <= 50).cast("int")), 1).alias("within_50"),
        F.round(100 * F.avg((F.col("metres") <= 250).cast("int")), 1).alias("within_250"),
    )
    p = percentiles(found, ["level"], "metres", {"median": 0.5, "p90": 0.9})
    return g.join(p, "level", "left").select("level", "n", F.round("median", 1).alias("median"), F.round("p90", 1).alias("p90"), "within_50", "within_250")


def evaluate_geocoding(census: DataFrame, districts: DataFrame, n: int, seed: str) -> DataFrame:
    """geocode_error of n addresses of census(id, cep, street, full, number, name, lon, lat) that are hidden, geocoded by all others and
    compared with where they are; the same sample in every run."""
    sample, rest = split_sample(census.where("cep is not null and number is not null and street is not null"), "id", seed, n)
    rest = census.join(dimension(sample.select("id")), "id", "left_anti")
    targets = sample.withColumn("district", F.lit(None).cast("string")).select("id", "name", "cep", "street", "full", "number", "district")
    found = geocode(targets, rest, districts).withColumnsRenamed({"lon": "lon2", "lat": "lat2"}).join(sample.select("id", "lon", "lat"), "id")
    return geocode_error(found.select("level", distance(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")).alias("metres")))


def match_by_name(brands: DataFrame, firms: DataFrame) -> DataFrame:
    """brand, key: by normalised name where it belongs to exactly one root; the head office if there is one, else the smallest key.
    brands(brand, name), firms(key, root, head, name)."""
    one = firms.groupBy("name").agg(
        F.min("root").alias("r0"), F.max("root").alias("r1"), F.min(F.when(F.col("head"), F.col("key"))).alias("hq"), F.min("key").alias("any_key")
    )
    return brands.join(one.where("r0 = r1"), "name").select("brand", F.coalesce("hq", "any_key").alias("key"))
