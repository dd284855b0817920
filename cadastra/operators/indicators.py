"""Territorial indicators. Ratios are computed in double precision and rounded last; dates of reference are arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.parse import completed_years
from .geo import polygon_hits, polygon_overlap, rings_of, signed_area
from .relational import cut, dimension


def ratio(a: Column, b: Column) -> Column:
    """a / b in double precision, null for b = 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def location_quotient(df: DataFrame, territory: str, activity: str) -> DataFrame:
    """territory, activity, n, ql: the activity's share in the territory against its share overall. One pass over the rows; totals are
    sums of the grouped counts."""
    n = df.where(F.col(territory).isNotNull() & F.col(activity).isNotNull()).groupBy(territory, activity).agg(F.count(F.lit(1)).alias("n"))
    by_t = n.groupBy(territory).agg(F.sum("n").alias("nt"))
    by_a = n.groupBy(activity).agg(F.sum("n").alias("na"))
    total = n.agg(F.sum("n").alias("total"))
    joined = n.join(by_t, territory).join(by_a, activity).crossJoin(F.broadcast(total))
    return joined.select(territory, activity, "n", F.round(ratio(F.col("n"), F.col("nt")) / ratio(F.col("na"), F.col("total")), 3).alias("ql"))


def cohort_survival(df: DataFrame, group: str, as_of_year: int, years: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """cohort, group (null: all), n and the percentage still open after so many years; null while the cohort is too young. df has start,
    end (null: open) and the group, which must not be null. Both groupings come from one pass (GROUPING SETS)."""
    alive = [(F.col("end").isNull() | (F.col("end") >= F.add_months("start", 12 * k))).cast("int").alias(f"a{k}") for k in years]
    x = df.where(F.col("start").isNotNull() & F.col(group).isNotNull()).select(F.year("start").alias("cohort"), F.col(group).alias("g"), *alive)
    agg = [F.count(F.lit(1)).alias("n"), *(F.sum(f"a{k}").alias(f"a{k}") for k in years)]
    out = x.groupingSets([["cohort", "g"], ["cohort"]], "cohort", "g").agg(*agg)
    pct = [F.when(F.col("cohort") + k < as_of_year, F.round(100 * ratio(F.col(f"a{k}"), F.col("n")), 1)).alias(f"alive_{k}") for k in years]
    return out.select("cohort", F.col("g").alias(group), "n", *pct)


def density_with_totals(df: DataFrame, cell: str, activity: str) -> DataFrame:
    """cell, activity (null: all), n."""
    return df.where(F.col(cell).isNotNull() & F.col(activity).isNotNull()).groupingSets([[cell, activity], [cell]], cell, activity).agg(F.count(F.lit(1)).alias("n"))


def snapshot_events(snaps: DataFrame) -> DataFrame:
    """period, key, event between each period and the one before it that exists. snaps: one row per (period, key) with open (boolean),
    place and activity. Events: opened, closed, left, reopened, moved, changed_activity; a key can have several."""
    periods = snaps.select("period").distinct()
    before = periods.select("period", F.lag("period").over(W.orderBy("period")).alias("prior")).where("prior is not null")
    now = snaps.join(dimension(before), "period")
    then = snaps.withColumnRenamed("period", "prior").join(dimension(before), "prior")
    a, b = now.alias("a"), then.alias("b")
    both = a.join(b, (F.col("a.period") == F.col("b.period")) & (F.col("a.key") == F.col("b.key")), "full")
    was, is_ = F.col("b.key").isNotNull(), F.col("a.key").isNotNull()
    differs = lambda c: was & is_ & ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    events = F.array(
        F.when(is_ & ~was & F.col("a.open"), F.lit("opened")),
        F.when(was & is_ & F.col("b.open") & ~F.col("a.open"), F.lit("closed")),
        F.when(was & ~is_, F.lit("left")),
        F.when(was & is_ & ~F.col("b.open") & F.col("a.open"), F.lit("reopened")),
        F.when(differs("place"), F.lit("moved")),
        F.when(differs("activity"), F.lit("changed_activity")),
    )
    out = both.select(F.coalesce("a.period", "b.period").alias("period"), F.coalesce("a.key", "b.key").alias("key"), F.explode(events).alias("event"))
    return out.where("event is not null")


def point_type(has_home: Column, has_shop: Column) -> Column:
    """mixed, commercial, residential or unknown."""
    return (
        F.when(has_home & has_shop, F.lit("mixed")).when(has_shop, F.lit("commercial")).when(has_home, F.lit("residential")).otherwise(F.lit("unknown"))
    )


def address_profile(df: DataFrame, address: str, root: str, crowd: int = 20) -> DataFrame:
    """key, active_here, registered_only (at least `crowd` active at the address), active_of_root, head_active, is_branch. Both counts are
    grouped and joined back, so a hot address never meets in one task."""
    here = df.where("active").groupBy(address).agg(F.count(F.lit(1)).alias("active_here"))
    firm = df.groupBy(root).agg(F.count_if("active").alias("active_of_root"), F.bool_or(F.col("head") & F.col("active")).alias("head_active"))
    out = df.join(here, address, "left").join(firm, root, "left")
    n = F.coalesce("active_here", F.lit(0))
    return out.select("key", n.alias("active_here"), (n >= crowd).alias("registered_only"), "active_of_root", "head_active", (~F.col("head")).alias("is_branch"))


def site_history(df: DataFrame, site: str, as_of: str) -> DataFrame:
    """site, total, open, closed, first_opening, last_closing, churn_per_year, vacant (nothing open, last closing within three years)."""
    day = F.to_date(F.lit(as_of))
    g = df.groupBy(site).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("active").alias("open"),
        F.count_if(~F.col("active")).alias("closed"),
        F.min("start").alias("first_opening"),
        F.max(F.when(~F.col("active"), F.col("end"))).alias("last_closing"),
    )
    years = F.greatest(F.lit(1), completed_years("first_opening", day))
    recent = F.col("last_closing") >= F.add_months(day, -36)
    return g.select(
        site, "total", "open", "closed", "first_opening", "last_closing",
        F.round(ratio(F.col("closed"), years), 3).alias("churn_per_year"),
        ((F.col("open") == 0) & F.coalesce(recent, F.lit(False))).alias("vacant"),
    )


def momentum(df: DataFrame, cell: str, as_of: str) -> DataFrame:
    """cell, openings, closings, momentum of the twelve months up to a date."""
    day, back = F.to_date(F.lit(as_of)), F.add_months(F.to_date(F.lit(as_of)), -12)
    within = lambda c: (F.col(c) > back) & (F.col(c) <= day)
    g = df.groupBy(cell).agg(F.count_if(within("start")).alias("openings"), F.count_if(~F.col("active") & within("end")).alias("closings"))
    return g.select(cell, "openings", "closings", (F.col("openings") - F.col("closings")).alias("momentum"))


def trailing_window(df: DataFrame, day: str, as_of: str, months: int = 12) -> DataFrame:
    """Rows of the months that end with the last month that has data up to a date; later dates only don't move the end."""
    last = df.where(F.col(day) <= F.to_date(F.lit(as_of))).agg(F.trunc(F.max(day), "month").alias("last"))
    w = last.select(F.add_months("last", 1 - months).alias("lo"), F.add_months("last", 1).alias("hi"))
    return df.join(F.broadcast(w), (F.col(day) >= F.col("lo")) & (F.col(day) < F.col("hi"))).drop("lo", "hi")


def risk_index(incidents: DataFrame, places: DataFrame, kinds: Sequence[str], by_firms: Sequence[str], in_index: Sequence[str]) -> DataFrame:
    """place, kind, n, per_km2, per_1000, percentile, and the place's index: the mean of the percentiles of the kinds in the index. Every
    place meets every kind (both small: places(place, km2, firms)); by_firms kinds rank by per_1000, others by per_km2."""
    spark = incidents.sparkSession
    grid = places.crossJoin(F.broadcast(spark.range(1).select(F.explode(F.array(*map(F.lit, kinds))).alias("kind"))))
    n = incidents.groupBy("place", "kind").agg(F.count(F.lit(1)).alias("n"))
    x = grid.join(n, ["place", "kind"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    x = x.withColumn("per_km2", ratio(F.col("n"), F.col("km2"))).withColumn("per_1000", ratio(1000 * F.col("n"), F.col("firms")))
    rate = F.when(F.col("kind").isin(*by_firms), F.coalesce("per_1000", F.lit(0.0))).otherwise(F.col("per_km2"))
    pct = F.round(100 * F.percent_rank().over(W.partitionBy("kind").orderBy(rate.asc_nulls_last())), 1)
    x = x.withColumn("percentile", pct)
    index = F.round(F.avg(F.when(F.col("kind").isin(*in_index), F.col("percentile"))).over(W.partitionBy("place")), 1)
    return x.select("place", "kind", "n", F.round("per_km2", 4).alias("per_km2"), F.round("per_1000", 4).alias("per_1000"), "percentile", index.alias("index"))


def supply_gap(supply: DataFrame, residents: DataFrame, classes: Sequence) -> DataFrame:
    """place, class, n, expected, gap, index: what the city's rate per resident would give each place. supply(place, class, n),
    residents(place, residents); all places with residents meet all classes."""
    spark = supply.sparkSession
    r = residents.where("residents > 0")
    s = supply.where(F.col("class").isin(*classes)).join(r.select("place"), "place", "left_semi")
    city = s.groupBy("class").agg(F.sum("n").alias("all_n"))
    total = r.agg(F.sum("residents").alias("all_r"))
    grid = r.crossJoin(F.broadcast(spark.range(1).select(F.explode(F.array(*map(F.lit, classes))).alias("class")))).crossJoin(F.broadcast(total))
    x = grid.join(dimension(city), "class").join(s, ["place", "class"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    expected = F.col("residents") * F.col("all_n").cast("double") / F.col("all_r")
    return x.select("place", "class", "n", F.round(expected, 3).alias("expected"), F.round(expected - F.col("n"), 3).alias("gap"), F.round(100 * F.col("n") / expected, 0).alias("index"))


def dasymetric(homes: DataFrame, zones: DataFrame, measures: Sequence[str], inside: DataFrame | None = None) -> DataFrame:
    """cell and the measures of zones(zone, measures...) spread over cells in proportion to their homes(zone, cell, homes). Zones without
    homes go whole to the cell of a point inside them, inside(zone, cell)."""
    all_ = homes.groupBy("zone").agg(F.sum("homes").alias("all_homes")).where("all_homes > 0")
    spread = homes.join(all_, "zone").select("zone", "cell", ratio(F.col("homes"), F.col("all_homes")).alias("_part"))
    if inside is not None:
        spread = spread.unionByName(inside.join(all_, "zone", "left_anti").select("zone", "cell", F.lit(1.0).alias("_part")))
    part, x = F.col("_part"), spread.join(zones, "zone")
    return x.groupBy("cell").agg(*(F.round(F.sum(F.col(m) * part), 4).alias(m) for m in measures))


def radius_profile(points: DataFrame, inside: Column, km2_radius: float, km2_city: float, residents: Column | float, city_residents: float) -> DataFrame:
    """activity, n in the radius, n in the city, densities, index, per thousand residents and its index; busiest first is the caller's
    order. points(activity, ...) are read once: counts in the radius and overall come from one grouping."""
    res = residents if isinstance(residents, Column) else F.lit(float(residents))
    g = points.groupBy("activity").agg(F.count_if(inside).alias("n"), F.count(F.lit(1)).alias("n_city")).where("n > 0")
    d, dc = F.col("n") / F.lit(km2_radius), F.col("n_city") / F.lit(km2_city)
    m, mc = ratio(F.col("n"), res), ratio(F.col("n_city"), F.lit(float(city_residents)))
    return g.select(
        "activity", "n", "n_city", F.round(d, 1).alias("per_km2"), F.round(dc, 1).alias("per_km2_city"), F.round(100 * d / dc, 0).alias("index"),
        F.round(1000 * m, 2).alias("per_1000"), F.round(100 * m / mc, 0).alias("index_residents"),
    )


def precise(firms: DataFrame) -> DataFrame:
    """Active firms located to the block that aren't mere registered offices: firms(active, registered_only, level, ...)."""
    level = F.col("level").isin("estabelecimento", "endereco", "endereco_sem_cep", "numero_proximo")
    return firms.where(F.col("active") & ~F.coalesce("registered_only", F.lit(False)) & level)


def residents_within(zones: DataFrame, homes_inside: DataFrame, touched: DataFrame) -> DataFrame:
    """One row: residents, dwellings and the mean income of heads within an area. zones(zone, people, dwellings, income, homes) count with
    the share of their homes that homes_inside(zone), a row each, shows inside; zones without homes with their share of land.
    touched(zone, share): the zones that the area touches."""
    n = homes_inside.groupBy("zone").agg(F.count(F.lit(1)).alias("n"))
    x = zones.join(touched.select("zone", "share"), "zone").join(n, "zone", "left")
    part = F.when(F.col("homes") > 0, F.coalesce("n", F.lit(0)) / F.col("homes").cast("double")).otherwise(F.col("share"))
    x = x.withColumn("p", part)
    weight = F.sum(F.when(F.col("income").isNotNull(), F.col("dwellings") * F.col("p")))
    return x.agg(
        F.round(F.sum(F.col("people") * F.col("p"))).alias("residents"), F.round(F.sum(F.col("dwellings") * F.col("p"))).alias("dwellings"),
        F.round(F.sum(F.col("income") * F.col("dwellings") * F.col("p")) / F.nullif(weight, F.lit(0.0)), 2).alias("income"),
    )


def area_report(firms: DataFrame, zones: DataFrame, homes: DataFrame, area: DataFrame, city_km2: float, cell: float) -> DataFrame:
    """The profile of any area, area(ring or rings) of one row in planar metres: by activity the firms inside and in the city, densities,
    index, residents, firms per thousand of them and that index; most firms first. firms(id, x, y, activity, active, registered_only,
    level), zones(zone, people, dwellings, income, homes, ring or rings), homes(id, zone, x, y). A radius is a circle's ring."""
    one = area.select(F.lit("area").alias("a"), rings_of(area).alias("rings")).limit(1)
    inside = lambda points: polygon_hits(points.select("id", "x", "y"), one, "a", cell).select("id")
    shapes = zones.select(F.col("zone").alias("b_id"), rings_of(zones).alias("rings"))
    land = shapes.select(F.col("b_id").alias("zone"), F.abs(signed_area(F.col("rings"))).alias("land"))
    touched = polygon_overlap(one.withColumnRenamed("a", "a_id"), shapes, cell).select(F.col("b_id").alias("zone"), "area")
    touched = touched.join(land, "zone").select("zone", ratio(F.col("area"), F.col("land")).alias("share"))
    home = homes.join(inside(homes), "id", "left_semi").select("zone")
    people = residents_within(zones.select("zone", "people", "dwellings", "income", "homes"), home, touched).first().residents
    city = zones.agg(F.sum("people")).first()[0]
    km2 = one.select(F.abs(signed_area(F.col("rings"))) / 1e6).first()[0]
    f = cut(precise(firms))
    f = f.join(inside(f).withColumn("in", F.lit(True)), "id", "left")
    null = F.lit(None).cast("double")
    found = radius_profile(f, F.coalesce(F.col("in"), F.lit(False)), km2, city_km2, F.lit(float(people)) if people else null, float(city) if city else 0.0)
    return found.withColumn("residents", F.lit(people)).orderBy(F.col("n").desc(), "activity")


def demography(long: DataFrame, mapping: dict[str, str], area: DataFrame) -> DataFrame:
    """zone, the mapped variables, residents, density, dependency, ageing from long(zone, variable, value) by one conditional pass;
    area(zone, km2). Mapped names used: people, men, women, age_0_14, age_15_29, age_30_59, age_60."""
    m = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    names = list(dict.fromkeys(mapping.values()))
    x = long.withColumn("name", F.element_at(m, F.col("variable"))).where("name is not null")
    w = x.groupBy("zone").agg(*(F.sum(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names)).join(area, "zone", "left")
    c = lambda n: F.col(n) if n in names else F.lit(None).cast("double")
    people = F.coalesce(c("people"), c("men") + c("women"))
    return w.select(
        "zone", *names, people.alias("residents"), F.round(ratio(people, F.col("km2")), 2).alias("density"),
        F.round(100 * ratio(c("age_0_14") + c("age_60"), c("age_15_29") + c("age_30_59")), 2).alias("dependency"),
        F.round(100 * ratio(c("age_60"), c("age_0_14")), 2).alias("ageing"),
    )


def daily_climate(hourly: DataFrame, hours: int = -3, missing: float = -9999.0, places: int = 1) -> DataFrame:
    """station, day, rain, rain_hours (hours with rain), mean, min, max, n (hours with a reading) of hourly(station, ts, rain, temp, low,
    high): days in local time; the same hour in several files counts once (of several the largest rain, then temperature). Hourly extremes
    that are missing are the temperature itself. A day without a reading of rain has null rain and null hours. Means are rounded half to
    even."""
    cols = ["rain", "temp", "low", "high"]
    x = hourly.select("station", "ts", *(F.when(F.col(c) != missing, F.col(c)).alias(c) if c in hourly.columns else F.lit(None).cast("double").alias(c) for c in cols))
    x = x.groupBy("station", "ts").agg(F.max(F.struct(*cols)).alias("r")).select("station", "ts", "r.*")
    x = x.withColumn("day", F.to_date(F.col("ts") + F.make_interval(hours=F.lit(hours))))
    return x.groupBy("station", "day").agg(
        F.bround(F.sum("rain"), places).alias("rain"), F.when(F.count("rain") > 0, F.count_if(F.col("rain") > 0)).alias("rain_hours"), F.bround(F.avg("temp"), places).alias("mean"),
        F.min(F.coalesce("low", "temp")).alias("min"), F.max(F.coalesce("high", "temp")).alias("max"), F.greatest(F.count("rain"), F.count("temp")).alias("n"),
    )


def latest_period_sum(df: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """key, last day, and the sum of the values of that day only: two grouped passes, no window over a key's rows."""
    last = df.groupBy(key).agg(F.max(day).alias("last"))
    return df.join(last, key).where(F.col(day) == F.col("last")).groupBy(key, "last").agg(F.sum(value).alias("total"))


def location_quotient_report(df: DataFrame, n: int = 10) -> DataFrame:
    """The n largest quotients."""
    return df.orderBy(F.col("ql").desc(), *df.columns[:2]).limit(n)
