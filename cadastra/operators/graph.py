"""Walking and transit networks: components, shortest paths with a limit, timetables, reach."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .geo import distance_join, near_segments, nearest_any
from .relational import cut, dimension

#: Metres walked a minute, longest transfer walk, detour of streets against the straight line.
WALK, TRANSFER, DETOUR = 80.0, 300.0, 1.3


def connected(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of the component) for edges(u, v). Every round gives each node the smallest label around it and then
    that label's own label, so long paths halve; it ends when no label changed."""
    both = cut(edges.where("u <> v").select("u", "v").unionAll(edges.where("u <> v").select(F.col("v"), F.col("u"))).distinct())
    labels = cut(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("root")))
    alone = edges.select(F.col("u").alias("node")).unionAll(edges.select("v")).distinct()
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy(F.col("u").alias("node")).agg(F.min("root").alias("m"))
        step = labels.join(near, "node").select("node", "root", F.least("root", "m").alias("new"))
        jump = step.select(F.col("node").alias("j"), F.col("new").alias("far"))
        step = cut(step.join(jump, F.col("new") == F.col("j"), "left").select("node", "root", F.least("new", "far").alias("new")))
        labels = step.select("node", F.col("new").alias("root"))
        if step.where("root <> new").isEmpty():
            break
    return alone.join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def main_component(edges: DataFrame) -> DataFrame:
    """node, main: whether the node is in the largest component (then the one with the smallest root)."""
    c = connected(edges)
    top = c.groupBy("root").count().orderBy(F.col("count").desc(), "root").limit(1)
    return c.join(F.broadcast(top.select(F.col("root").alias("top"))), F.lit(True)).select("node", (F.col("root") == F.col("top")).alias("main"))


def network(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, lon, lat) and edges (u, v, w) of segments(lon1, lat1, lon2, lat2, w): ends are equal at seven decimals; loops go. A
    node's id is a hash of its rounded place, so no global numbering is needed."""
    r = segments.select(*(F.round(c, 7).alias(c) for c in ("lon1", "lat1", "lon2", "lat2")), "w")
    key = lambda a, b: F.xxhash64(F.col(a), F.col(b))
    edges = r.select(key("lon1", "lat1").alias("u"), key("lon2", "lat2").alias("v"), "w").where("u <> v")
    ends = r.select(F.col("lon1").alias("lon"), F.col("lat1").alias("lat")).unionAll(r.select("lon2", "lat2")).distinct()
    return ends.select(key("lon", "lat").alias("id"), "lon", "lat"), edges


def shortest(edges: DataFrame, start: DataFrame, limit: float) -> DataFrame:
    """node, cost of the nodes within a cost limit of start(node, cost), over edges(u, v, w) in both directions. Relaxes the nodes that
    got cheaper, all at once, until none does: an equi-join and a grouped minimum a round."""
    both = cut(edges.select("u", "v", "w").unionAll(edges.select(F.col("v"), F.col("u"), "w")).groupBy("u", "v").agg(F.min("w").alias("w")))
    best = cut(start.where(F.col("cost") <= limit).groupBy("node").agg(F.min("cost").alias("cost")))
    live = best
    while not live.isEmpty():
        tried = live.join(both, live["node"] == both["u"]).select(F.col("v").alias("node"), (F.col("cost") + F.col("w")).alias("c")).where(F.col("c") <= limit)
        tried = tried.groupBy("node").agg(F.min("c").alias("c"))
        live = cut(tried.join(best, "node", "left").where("cost is null or c < cost").select("node", F.col("c").alias("cost")))
        best = cut(best.unionAll(live).groupBy("node").agg(F.min("cost").alias("cost")))
    return best


def reached_edges(edges: DataFrame, reached: DataFrame) -> DataFrame:
    """Edges with both ends reached."""
    r = reached.select("node")
    return edges.join(r, edges["u"] == r["node"], "left_semi").join(r, edges["v"] == r["node"], "left_semi")


def active_services(calendar: DataFrame | None, exceptions: DataFrame, day: str, services: DataFrame | None = None) -> DataFrame:
    """service_id of the services that run on a date: the weekday's flag within the range, then added (1) and removed (2) dates. Without a
    calendar all of services(service_id) run."""
    if calendar is None:
        return services.select("service_id").distinct()
    date = F.to_date(F.lit(day))
    names = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    flag = F.element_at(F.array(*(F.col(n).cast("int") for n in names)), F.weekday(date) + 1)
    compact = F.date_format(date, "yyyyMMdd")
    runs = calendar.where((flag == 1) & (F.col("start_date") <= compact) & (F.col("end_date") >= compact)).select("service_id")
    on = exceptions.where(F.col("date") == compact)
    add, less = on.where("exception_type = '1'").select("service_id"), on.where("exception_type = '2'").select("service_id")
    return runs.unionAll(add).distinct().join(less, "service_id", "left_anti")


def connections(stop_times: DataFrame, start: int, end: int) -> DataFrame:
    """trip, dep, arr, a, b of consecutive timed stops whose departure lies in the window; stop_times(trip_id, seq, stop_id, arr, dep) in
    seconds, a missing arrival or departure being the other one, untimed stops left out."""
    t = stop_times.select("trip_id", "seq", "stop_id", F.coalesce("arr", "dep").alias("arr"), F.coalesce("dep", "arr").alias("dep")).where("dep is not null")
    w = W.partitionBy("trip_id").orderBy("seq")
    t = t.withColumn("b", F.lead("stop_id").over(w)).withColumn("next", F.lead("arr").over(w)).where("b is not null")
    return t.where(F.col("dep").between(start, end)).select(F.col("trip_id").alias("trip"), "dep", F.col("next").alias("arr"), F.col("stop_id").alias("a"), "b")


def transfers(stops: DataFrame) -> DataFrame:
    """a, b, seconds of walks between stops(stop_id, lat, lon) no farther apart than TRANSFER, with the detour of streets."""
    a, b = stops.withColumnRenamed("stop_id", "a_id"), stops.withColumnRenamed("stop_id", "b_id")
    d = distance_join(a, b, TRANSFER).where("a_id <> b_id")
    return d.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), (F.col("metres") * DETOUR / WALK * 60).alias("seconds"))


def scan(connections: Iterable[tuple], walks: dict, arrival: dict) -> dict:
    """Earliest arrivals by one scan over connections (dep, arr, a, b, trip) sorted by departure: a trip is boarded once or where one is
    already there; each arrival is followed by one walk."""
    on: set = set()
    for dep, arr, a, b, trip in connections:
        if trip in on or arrival.get(a, float("inf")) <= dep:
            on.add(trip)
            if arr < arrival.get(b, float("inf")):
                arrival[b] = arr
                for c, seconds in walks.get(b, ()):
                    if arr + seconds < arrival.get(c, float("inf")):
                        arrival[c] = arr + seconds
    return arrival


def scan_all(dep: np.ndarray, arr: np.ndarray, a: np.ndarray, b: np.ndarray, trip: np.ndarray, walks: dict[int, list], best: np.ndarray) -> np.ndarray:
    """scan() for many queries at once: best holds a row of arrivals by stop for each; connections come sorted by departure."""
    on = np.zeros((len(best), int(trip.max(initial=-1)) + 1), bool)
    for k in range(len(dep)):
        go = on[:, trip[k]] | (best[:, a[k]] <= dep[k])
        if go.any():
            on[:, trip[k]] = go
            better = np.flatnonzero(go & (arr[k] < best[:, b[k]]))
            if len(better):
                best[better, b[k]] = arr[k]
                for c, seconds in walks.get(int(b[k]), ()):
                    best[better, c] = np.minimum(best[better, c], arr[k] + seconds)
    return best


def earliest_arrivals(conns: DataFrame, walks: DataFrame, origins: DataFrame, span: float = 3600.0, budget: float = 14_400.0, block: int = 64) -> DataFrame:
    """query, stop, arrival for each query of origins(query, stop, time), over connections that depart within `budget` seconds of the end
    of its window.

    Queries are dealt into windows of `span` seconds by their first time, and windows into blocks of about `block` queries. A connection
    goes to the windows that it serves, a walk to those where its stop occurs, all by equi-joins; the sequential scan runs once a block,
    for its queries at once. So a task holds the connections of one window, however many queries there are."""
    per = origins.groupBy("query").agg(F.floor(F.min("time") / span).alias("w"))
    many = per.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    per = cut(per.join(dimension(many), "w").withColumn("blk", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int")).select("query", "w", "blk"))
    groups = per.select("w", "blk").distinct()
    first = F.ceil((F.col("dep") - budget) / span) - 1
    c = conns.withColumn("w", F.explode(F.sequence(first, F.floor(F.col("dep") / span)))).join(dimension(groups), "w")
    c = c.select("w", "blk", F.lit("c").alias("kind"), F.lit(None).cast("string").alias("query"), "trip", "a", "b", F.col("dep").cast("double").alias("x"), F.col("arr").cast("double").alias("y"))
    o = origins.join(per, "query").select("w", "blk", F.lit("o").alias("kind"), "query", F.lit(None).cast("string").alias("trip"), F.col("stop").alias("a"), F.lit(None).cast("string").alias("b"), F.col("time").cast("double").alias("x"), F.lit(0.0).alias("y"))
    used = c.select("w", "blk", F.col("b").alias("a")).unionAll(o.select("w", "blk", "a")).distinct()
    f = walks.join(used, "a").select("w", "blk", F.lit("w").alias("kind"), F.lit(None).cast("string").alias("query"), F.lit(None).cast("string").alias("trip"), "a", "b", F.col("seconds").cast("double").alias("x"), F.lit(0.0).alias("y"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        rides, feet, begin = (part[part["kind"] == k] for k in "cwo")
        rides = rides.sort_values(["x", "y", "trip"], kind="stable")
        stops, at = np.unique(np.concatenate([part["a"].to_numpy(str), part["b"][part["kind"] != "o"].to_numpy(str)]), return_inverse=True)
        place = dict(zip(stops.tolist(), range(len(stops))))
        number = lambda col: col.map(place).to_numpy(np.int64)
        near: dict[int, list] = {}
        for u, v, t in zip(number(feet["a"]).tolist(), number(feet["b"]).tolist(), feet["x"].tolist()):
            near.setdefault(u, []).append((v, t))
        names, row = np.unique(begin["query"].to_numpy(str), return_inverse=True)
        best = np.full((len(names), len(stops)), np.inf)
        for r, s, t in zip(row.tolist(), number(begin["a"]).tolist(), begin["x"].tolist()):
            best[r, s] = min(best[r, s], t)
        for r, s, t in zip(row.tolist(), number(begin["a"]).tolist(), begin["x"].tolist()):
            for v, walk in near.get(s, ()):
                best[r, v] = min(best[r, v], t + walk)
        _, trip = np.unique(rides["trip"].to_numpy(str), return_inverse=True)
        best = scan_all(rides["x"].to_numpy(), rides["y"].to_numpy(), number(rides["a"]), number(rides["b"]), trip, near, best)
        r, s = np.nonzero(np.isfinite(best))
        return pd.DataFrame({"query": names[r], "stop": stops[s], "arrival": best[r, s]})

    return c.unionAll(o).unionAll(f).groupBy("w", "blk").applyInPandas(run, "query string, stop string, arrival double")


def snapped(places: DataFrame, nodes: DataFrame, metres: float = 300.0) -> DataFrame:
    """id, node, metres: for each of places(id, lat, lon) the nearest of nodes(id, lat, lon), however far."""
    a, b = places.withColumnRenamed("id", "a_id"), nodes.select(F.col("id").alias("b_id"), "lat", "lon")
    return nearest_any(a, b, metres).select(F.col("a_id").alias("id"), F.col("b_id").alias("node"), "metres")


def reach(nodes: DataFrame, edges: DataFrame, origin: tuple[float, float], minutes: float, stops: DataFrame | None = None, conns: DataFrame | None = None, start: int = 0) -> DataFrame:
    """node, cost (metres of walking that the time is worth) within so many minutes of a place (lat, lon), on foot or, with stops(stop_id,
    lat, lon) and connections, by bus leaving at `start` (seconds of the day): walk to stops, ride and change by earliest arrivals, walk
    on from each stop with the time that is left. Places snap to the nearest node of the network's main component."""
    spark, limit = nodes.sparkSession, minutes * WALK
    main = nodes.join(main_component(edges).where("main").select(F.col("node").alias("id")), "id", "left_semi")
    here = spark.range(1).select(F.lit("origin").alias("id"), F.lit(float(origin[0])).alias("lat"), F.lit(float(origin[1])).alias("lon"))
    begin = cut(snapped(here, main).select("node", F.col("metres").alias("cost")))
    on_foot = shortest(edges, begin, limit)
    if stops is None:
        return on_foot
    used = conns.select(F.col("a").alias("stop_id")).unionAll(conns.select("b")).distinct()
    at = cut(snapped(stops.join(used, "stop_id", "left_semi").select(F.col("stop_id").alias("id"), "lat", "lon"), main))
    boarded = at.join(on_foot, "node").where(F.col("cost") + F.col("metres") <= limit)
    asked = boarded.select(F.lit("q").alias("query"), F.col("id").alias("stop"), (start + (F.col("cost") + F.col("metres")) / WALK * 60).alias("time"))
    known = stops.join(at.select(F.col("id").alias("stop_id")), "stop_id", "left_semi")
    got = earliest_arrivals(conns.where(F.col("dep").between(start, start + minutes * 60)), transfers(known), asked, span=86_400.0)
    off = got.join(at, F.col("stop") == F.col("id")).select("node", ((F.col("arrival") - start) / 60 * WALK + F.col("metres")).alias("cost"))
    return shortest(edges, begin.unionAll(off), limit)


def reached_area(points: DataFrame, nodes: DataFrame, edges: DataFrame, reached: DataFrame, margin: float = 40.0) -> DataFrame:
    """id of the points(id, x, y) inside the area of a reach: at most `margin` from an edge with both ends reached. nodes(id, x, y) in the
    points' planar metres."""
    e = reached_edges(edges, reached).select("u", "v")
    a, b = (nodes.select(F.col("id").alias(k), F.col("x").alias(f"x{n}"), F.col("y").alias(f"y{n}")) for k, n in (("u", 1), ("v", 2)))
    return near_segments(points, e.join(a, "u").join(b, "v"), margin)
