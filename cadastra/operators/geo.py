"""Points, polygons and cells as plain columns: distance, containment, spatial equi-joins by grid cell, hexagons."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import cut, dimension

#: Metres in a degree of latitude, and the mean radius of the Earth.
DEGREE, RADIUS = 111_320.0, 6_371_008.8


def distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres (haversine; within 0.5 % of the ellipsoid's)."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0)
    )
    return 2 * RADIUS * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def planar(lat: Column, lon: Column, lat0: float, lon0: float) -> tuple[Column, Column]:
    """Local metres east and north of an origin."""
    return (lon - lon0) * (DEGREE * math.cos(math.radians(lat0))), (lat - lat0) * DEGREE


def within(lat: Column, lon: Column, lat0: float, lon0: float, metres: float) -> Column:
    """Whether a point lies within a radius of one given point: a box that scans can push down, then the distance."""
    dlat = metres / DEGREE * 1.01
    dlon = dlat / max(math.cos(math.radians(lat0)), 1e-6)
    box = lat.between(lat0 - dlat, lat0 + dlat) & lon.between(lon0 - dlon, lon0 + dlon)
    return box & (distance(lat, lon, F.lit(lat0), F.lit(lon0)) <= metres)


def _lon_cells(band: Column, dlat: float) -> Column:
    """Into how many equal cells a band of latitude is cut, each at least dlat wide in metres; one at the poles."""
    top = F.least(F.greatest(F.abs(band), F.abs(band + 1)) * dlat, F.lit(90.0))
    return F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(top)) / dlat)).cast("long")


def distance_join(a: DataFrame, b: DataFrame, metres: float) -> DataFrame:
    """Pairs of a(a_id, lat, lon) and b(b_id, lat, lon) at most so far apart, with their distance, at any latitude and across 180 degrees.
    Both meet by an equi-join on grid cells about as wide as the radius: bands of latitude, each cut into its own number of cells. Only
    a's points are copied to the cells that their radius touches."""
    dlat = metres / DEGREE * 1.01
    band = F.floor(F.col("lat") / dlat)
    left = a.select("a_id", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"), band.alias("b0"))
    edge = F.least(F.greatest(F.abs(F.col("b0") - 1), F.abs(F.col("b0") + 2)) * dlat, F.lit(89.999))
    left = left.withColumn("reach", F.least(F.lit(180.0), dlat / F.cos(F.radians(edge))))
    left = left.withColumn("i", F.explode(F.array(F.col("b0") - 1, F.col("b0"), F.col("b0") + 1))).withColumn("n", _lon_cells(F.col("i"), dlat))
    at = lambda x: F.floor((x + 180.0) * F.col("n") / 360.0)
    # as many cells as there are, at most
    last = F.least(at(F.col("lon1") + F.col("reach")), at(F.col("lon1") - F.col("reach")) + F.col("n") - 1)
    cells = F.transform(F.sequence(at(F.col("lon1") - F.col("reach")), last), lambda j: F.pmod(j, F.col("n")))
    left = left.select("a_id", "lat1", "lon1", "i", F.explode(cells).alias("j"))
    right = b.select("b_id", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), band.alias("i"))
    right = right.withColumn("n", _lon_cells(F.col("i"), dlat)).withColumn("j", F.pmod(at(F.col("lon2")), F.col("n"))).drop("n")
    d = distance(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return left.join(right, ["i", "j"]).select("a_id", "b_id", d.alias("metres")).where(F.col("metres") <= metres)


#: Pairs for each point that a first round of a search for the nearest may look at, on average.
PAIRS = 32


def _first_radius(a: DataFrame, b: DataFrame, metres: float) -> float:
    """The largest of metres, metres / 4, metres / 16, ... at which a and b share few cells: counted cell by cell, at all radii at once."""
    radii = [metres / 4**k for k in range(9)]

    def cells(df: DataFrame, n: str) -> DataFrame:
        own = [F.struct(F.lit(k).alias("k"), F.floor(F.col("lat") / (r / DEGREE)).alias("i"), F.floor(F.col("lon") * F.cos(F.radians("lat")) / (r / DEGREE)).alias("j")) for k, r in enumerate(radii)]
        return df.select(F.explode(F.array(*own)).alias("c")).groupBy("c.k", "c.i", "c.j").agg(F.count(F.lit(1)).alias(n))

    pairs = cells(a, "n").join(cells(b, "m"), ["k", "i", "j"]).groupBy("k").agg(F.sum(F.col("n").cast("double") * F.col("m") * 9).alias("pairs"))
    pairs, rows = {r.k: r.pairs for r in pairs.collect()}, a.count()
    return next((r for k, r in enumerate(radii) if pairs.get(k, 0) <= PAIRS * rows), radii[-1])


def _search(a: DataFrame, b: DataFrame, first: float, last: float) -> DataFrame:
    """nearest by growing radius: each round takes four times the radius for the points that have found nothing yet. Of all b at one
    place only the one with the smallest id can be it; where no more than PAIRS places are left, all points meet all of them at once."""
    b = b.groupBy("lat", "lon").agg(F.min("b_id").alias("b_id"))
    best = lambda pairs: pairs.groupBy("a_id").agg(F.min(F.struct("metres", "b_id")).alias("m")).select("a_id", "m.b_id", "m.metres")
    if b.limit(PAIRS + 1).count() <= PAIRS:
        d = distance(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
        pairs = a.crossJoin(F.broadcast(b.select("b_id", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))))
        return best(pairs.select("a_id", "b_id", d.alias("metres")).where(F.col("metres") <= last))
    r, out, left = _first_radius(a, b, first), None, a
    while True:
        found = best(distance_join(left, b, r))
        if r >= last:
            return found if out is None else out.unionAll(found)
        found = cut(found)
        out = found if out is None else out.unionAll(found)
        left = cut(left.join(found.select("a_id"), "a_id", "left_anti"))
        if left.isEmpty():
            return out
        r = min(4 * r, last)


def nearest(a: DataFrame, b: DataFrame, metres: float) -> DataFrame:
    """For each a its nearest b within a radius (then the smaller id): a_id, b_id, metres."""
    return _search(a, b, metres, metres)


def nearest_any(a: DataFrame, b: DataFrame, metres: float) -> DataFrame:
    """For each a its nearest b however far (then the smaller id): a search that goes on beyond the given radius."""
    if b.isEmpty():
        return a.sparkSession.createDataFrame([], a.select("a_id").schema).join(b.select("b_id"), F.lit(False)).withColumn("metres", F.lit(0.0))
    return _search(a, b, metres, max(metres, 1.1 * math.pi * RADIUS))


def edges_of(rings: Column) -> Column:
    """The edges (p, q) of closed rings (arrays of struct x, y; first = last)."""
    pair = lambda p, q: F.struct(p.alias("p"), q.alias("q"))
    return F.flatten(F.transform(rings, lambda r: F.zip_with(F.slice(r, F.lit(1), F.size(r) - 1), F.slice(r, F.lit(2), F.size(r) - 1), pair)))


def in_area(x: Column, y: Column, rings: Column) -> Column:
    """Whether a point lies in the area of rings, outer ones, holes and islands by the even-odd rule, boundaries included."""
    edges = edges_of(rings)

    def on(e: Column) -> Column:
        ax, ay, bx, by = e["p"]["x"], e["p"]["y"], e["q"]["x"], e["q"]["y"]
        flat = (bx - ax) * (y - ay) - (by - ay) * (x - ax) == 0
        return flat & (x >= F.least(ax, bx)) & (x <= F.greatest(ax, bx)) & (y >= F.least(ay, by)) & (y <= F.greatest(ay, by))

    def crosses(e: Column) -> Column:
        ax, ay, bx, by = e["p"]["x"], e["p"]["y"], e["q"]["x"], e["q"]["y"]
        return ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / F.when(by == ay, F.lit(1.0)).otherwise(by - ay) + ax)

    return F.exists(edges, on) | (F.size(F.filter(edges, crosses)) % 2 == 1)


def signed_area(rings: Column) -> Column:
    """Planar area of rings (shoelace); rings that run the other way count against."""
    return F.aggregate(edges_of(rings), F.lit(0.0), lambda t, e: t + e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]) / 2


def oriented(ring: Column, outer: Column) -> Column:
    """A ring that runs counter-clockwise if it is an outer one, else clockwise, so that signed areas add up."""
    return F.when((signed_area(F.array(ring)) >= 0) == outer, ring).otherwise(F.reverse(ring))


def interior_point(rings: Column) -> Column:
    """A point (x, y) inside an area: the middle of its widest part along the line halfway up."""
    ys = F.transform(F.flatten(rings), lambda p: p["y"])
    y = (F.array_min(ys) + F.array_max(ys)) / 2
    hit = F.filter(edges_of(rings), lambda e: (e["p"]["y"] > y) != (e["q"]["y"] > y))
    xs = F.array_sort(F.transform(hit, lambda e: e["p"]["x"] + (e["q"]["x"] - e["p"]["x"]) * (y - e["p"]["y"]) / (e["q"]["y"] - e["p"]["y"])))
    spans = F.transform(
        F.filter(F.sequence(F.lit(1), F.size(xs) - 1), lambda k: k % 2 == 1),
        lambda k: F.struct((F.element_at(xs, k) - F.element_at(xs, k + 1)).alias("w"), ((F.element_at(xs, k) + F.element_at(xs, k + 1)) / 2).alias("x")),
    )
    return F.when(F.size(xs) >= 2, F.struct(F.array_min(spans)["x"].alias("x"), y.alias("y")))


def rings_of(polygons: DataFrame) -> Column:
    """The rings of a table of polygons: its column rings, or its one ring."""
    return F.col("rings") if "rings" in polygons.columns else F.array("ring")


def _cells(polygons: DataFrame, key: str, cell: float) -> DataFrame:
    """key, box (x0, y0, x1, y1) and the grid cells (i, j) of each polygon's box."""
    points = F.flatten(rings_of(polygons))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    box = [F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1")]
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    return polygons.select(key, *box).withColumn("i", F.explode(span("x0", "x1"))).withColumn("j", F.explode(span("y0", "y1")))


def polygon_hits(points: DataFrame, polygons: DataFrame, key: str, cell: float) -> DataFrame:
    """id, key of the points(id, x, y) in each polygon(key, ring or rings), boundaries included. Points meet the cells of the polygons'
    boxes, which carry no outline; outlines join in once for the pairs whose box holds the point."""
    p = points.select("id", "x", "y", F.floor(F.col("x") / cell).alias("i"), F.floor(F.col("y") / cell).alias("j"))
    near = p.join(_cells(polygons, key, cell), ["i", "j"]).where("x between x0 and x1 and y between y0 and y1").select("id", "x", "y", key)
    shapes = polygons.select(key, rings_of(polygons).alias("_rings"))
    return near.join(dimension(shapes), key).where(in_area(F.col("x"), F.col("y"), F.col("_rings"))).select("id", key)


def polygon_join(points: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """For each point(id, x, y) the polygon(code, name, ring or rings) that contains it, boundary included; of several the smallest, then
    by code (nulls last) and name."""
    own = F.struct(F.col("code").isNull().alias("_n"), "code", "name")
    named = polygons.select(F.xxhash64(F.to_json(own), F.to_json(rings_of(polygons))).alias("_p"), "code", "name", rings_of(polygons).alias("rings"))
    labels = named.select("_p", F.struct(F.abs(signed_area(F.col("rings"))).alias("area"), own.alias("own")).alias("m"))
    hit = polygon_hits(points, named, "_p", cell).join(dimension(labels), "_p")
    best = hit.groupBy("id").agg(F.min("m").alias("m"))
    return points.join(best, "id", "left").select("id", F.col("m.own.code").alias("code"), F.col("m.own.name").alias("name"))


def territory(points: DataFrame, layers: dict[str, DataFrame], cell: float, hexagons: dict[str, float] = {}) -> DataFrame:  # noqa: B006
    """points(id, x, y) with, for each layer, the code (or name, without one) of its polygon, and the hexagon of each given size."""
    out = points
    for name, polygons in layers.items():
        key = polygon_join(points, polygons, cell).select("id", F.coalesce("code", "name").alias(name))
        out = out.join(key, "id", "left")
    return out.withColumns({name: hex_cell(F.col("x"), F.col("y"), size) for name, size in hexagons.items()}) if hexagons else out


def overlap_area(one: list[np.ndarray], other: list[np.ndarray]) -> float:
    """Area that two sets of closed rings share, each by the even-odd rule: the plane is cut into slabs at every corner and crossing, and
    within a slab both are trapezoids."""

    def edges(rings):
        e = np.concatenate([np.concatenate([r[:-1], r[1:]], axis=1) for r in rings]) if rings else np.zeros((0, 4))
        e = e[e[:, 1] != e[:, 3]]
        return np.where((e[:, 1] < e[:, 3])[:, None], e, e[:, [2, 3, 0, 1]])  # upwards

    a, b = edges(one), edges(other)
    if not len(a) or not len(b):
        return 0.0
    d, e = a[:, None, 2:] - a[:, None, :2], b[None, :, 2:] - b[None, :, :2]
    gap, cross = b[None, :, :2] - a[:, None, :2], d[..., 0] * e[..., 1] - d[..., 1] * e[..., 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        s = (gap[..., 0] * e[..., 1] - gap[..., 1] * e[..., 0]) / cross
        t = (gap[..., 0] * d[..., 1] - gap[..., 1] * d[..., 0]) / cross
        y = a[:, None, 1] + s * d[..., 1]
    meets = (cross != 0) & (s >= 0) & (s <= 1) & (t >= 0) & (t <= 1)
    ys = np.unique(np.concatenate([a[:, 1], a[:, 3], b[:, 1], b[:, 3], y[meets]]))
    ys, total = ys[(ys >= max(a[:, 1].min(), b[:, 1].min())) & (ys <= min(a[:, 3].max(), b[:, 3].max()))], 0.0

    def spans(e, y):
        e = e[(e[:, 1] <= y) & (e[:, 3] > y)]
        return np.sort(e[:, 0] + (e[:, 2] - e[:, 0]) * (y - e[:, 1]) / (e[:, 3] - e[:, 1]))

    for lo, hi in zip(ys[:-1], ys[1:]):
        p, q = spans(a, (lo + hi) / 2), spans(b, (lo + hi) / 2)
        if len(p) and len(q):
            shared = np.minimum(p[1::2][:, None], q[1::2][None, :]) - np.maximum(p[0::2][:, None], q[0::2][None, :])
            total += float(np.maximum(shared, 0).sum() * (hi - lo))
    return total


def polygon_overlap(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    """a_id, b_id, area shared by polygons a(a_id, ring or rings) and b(b_id, ...) that overlap. Boxes meet by an equi-join on grid cells
    (a pair counts in the first cell that both have); outlines are clipped pair by pair in Arrow batches."""
    other = _cells(b, "b_id", cell).select("b_id", "i", "j", *(F.col(c).alias(f"b_{c}") for c in ("x0", "y0", "x1", "y1")))
    first = (F.floor(F.greatest("x0", "b_x0") / cell) == F.col("i")) & (F.floor(F.greatest("y0", "b_y0") / cell) == F.col("j"))
    pairs = _cells(a, "a_id", cell).join(other, ["i", "j"]).where(first & F.expr("x0 < b_x1 and b_x0 < x1 and y0 < b_y1 and b_y0 < y1")).select("a_id", "b_id")
    pairs = pairs.join(dimension(a.select("a_id", rings_of(a).alias("ra"))), "a_id").join(dimension(b.select("b_id", rings_of(b).alias("rb"))), "b_id")

    def clip(batches):
        for batch in batches:
            as_rings = lambda c: [[np.array([(p["x"], p["y"]) for p in r]) for r in rings] for rings in batch.column(c).to_pylist()]
            area = [overlap_area(x, y) for x, y in zip(as_rings(2), as_rings(3))]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(area, pa.float64())], ["a_id", "b_id", "area"])

    kinds = dict(pairs.dtypes)
    return pairs.select("a_id", "b_id", "ra", "rb").mapInArrow(clip, f"a_id {kinds['a_id']}, b_id {kinds['b_id']}, area double").where("area > 0")


def circle(x: float, y: float, radius: float, corners: int = 64) -> list[tuple[float, float]]:
    """A ring around a point, as a polygon of the same area as the circle."""
    r = radius * math.sqrt(2 * math.pi / corners / math.sin(2 * math.pi / corners))
    out = [(x + r * math.cos(2 * math.pi * k / corners), y + r * math.sin(2 * math.pi * k / corners)) for k in range(corners)]
    return [*out, out[0]]


def segment_distance(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Planar distance of a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    along = ((x - x1) * dx + (y - y1) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    k = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    return F.sqrt(F.pow(x - x1 - k * dx, F.lit(2.0)) + F.pow(y - y1 - k * dy, F.lit(2.0)))


def near_segments(points: DataFrame, segments: DataFrame, margin: float) -> DataFrame:
    """id of the points(id, x, y) at most `margin` from one of segments(x1, y1, x2, y2): the area that a union of buffers around them
    covers, as a membership test. Segments go to the cells of their widened box, points to their own."""
    size = 4.0 * margin
    span = lambda a, b: F.sequence(F.floor((F.least(a, b) - margin) / size), F.floor((F.greatest(a, b) + margin) / size))
    s = segments.select("x1", "y1", "x2", "y2", F.explode(span("x1", "x2")).alias("i")).withColumn("j", F.explode(span("y1", "y2")))
    p = points.select("id", "x", "y", F.floor(F.col("x") / size).alias("i"), F.floor(F.col("y") / size).alias("j"))
    return p.join(s, ["i", "j"]).where(segment_distance(*(F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2"))) <= margin).select("id").distinct()


def planarised(segments: DataFrame, cell: float) -> DataFrame:
    """id, part, x1, y1, x2, y2: segments(id, x1, y1, x2, y2) cut where they cross or touch others. Segments meet by an equi-join on the
    grid cells of their boxes; parallel ones don't cut each other."""
    span = lambda a, b: F.sequence(F.floor(F.least(a, b) / cell), F.floor(F.greatest(a, b) / cell))
    s = segments.select("id", "x1", "y1", "x2", "y2", F.explode(span("x1", "x2")).alias("i")).withColumn("j", F.explode(span("y1", "y2")))
    o = s.select("i", "j", F.col("id").alias("other"), *(F.col(c).alias(f"o{c}") for c in ("x1", "y1", "x2", "y2")))
    dx, dy, ex, ey = (F.col(f"{p}{b}") - F.col(f"{p}{a}") for p, a, b in (("", "x1", "x2"), ("", "y1", "y2"), ("o", "x1", "x2"), ("o", "y1", "y2")))
    turn = F.nullif(dx * ey - dy * ex, F.lit(0.0))
    gx, gy = F.col("ox1") - F.col("x1"), F.col("oy1") - F.col("y1")
    t, u = (gx * ey - gy * ex) / turn, (gx * dy - gy * dx) / turn
    cuts = s.join(o, ["i", "j"]).where("id <> other").select("id", t.alias("t"), u.alias("u")).where("t > 1e-12 and t < 1 - 1e-12 and u >= 0 and u <= 1")
    cuts = cuts.groupBy("id").agg(F.array_sort(F.collect_set(F.round("t", 12))).alias("ts"))
    ts = F.concat(F.array(F.lit(0.0)), F.coalesce("ts", F.array().cast("array<double>")), F.array(F.lit(1.0)))
    x = segments.join(cuts, "id", "left").withColumn("ts", ts)
    x = x.select("id", "x1", "y1", "x2", "y2", "ts", F.explode(F.sequence(F.lit(1), F.size("ts") - 1)).alias("part"))
    a, b = F.element_at("ts", F.col("part")), F.element_at("ts", F.col("part") + 1)
    at = lambda k, p, q: F.when(k == 0, F.col(p)).when(k == 1, F.col(q)).otherwise(F.col(p) + k * (F.col(q) - F.col(p)))
    return x.select("id", "part", at(a, "x1", "x2").alias("x1"), at(a, "y1", "y2").alias("y1"), at(b, "x1", "x2").alias("x2"), at(b, "y1", "y2").alias("y2"))


def box_overlap(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """Area that two boxes (x0, y0, x1, y1) share."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def hex_cell(x: Column, y: Column, size: float) -> Column:
    """Id `q_r` of the pointy-top hexagon (edge length `size`) that holds a point in planar metres; axial coordinates, cube rounding."""
    q = (F.lit(math.sqrt(3.0) / 3.0) * x - F.lit(1.0 / 3.0) * y) / size
    r = F.lit(2.0 / 3.0) * y / size
    s = -q - r
    rq, rr, rs = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(s + 0.5)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    cq = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    cr = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    return F.concat_ws("_", cq.cast("long").cast("string"), cr.cast("long").cast("string"))


def hex_boundary(cell: str, size: float) -> list[tuple[float, float]]:
    """Corners of a cell, first = last, in planar metres."""
    q, r = map(int, cell.split("_"))
    x, y = size * math.sqrt(3) * (q + r / 2), size * 1.5 * r
    corners = [(x + size * math.cos(math.radians(60 * k - 30)), y + size * math.sin(math.radians(60 * k - 30))) for k in range(6)]
    return [*corners, corners[0]]


def representative_points(points: DataFrame, key: str) -> DataFrame:
    """Of each key's points(key, id, x, y) the one closest to their centroid, then the smaller id. Two passes of grouped sums and minima,
    no group is gathered."""
    centre = points.groupBy(key).agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.count(F.lit(1)).alias("n"))
    d = F.pow(F.col("x") - F.col("cx"), F.lit(2.0)) + F.pow(F.col("y") - F.col("cy"), F.lit(2.0))
    return (
        points.join(centre, key)
        .groupBy(key)
        .agg(F.min(F.struct(d.alias("d"), "id", "x", "y")).alias("m"), F.max("n").alias("n"))
        .select(key, "m.id", "m.x", "m.y", "n")
    )
