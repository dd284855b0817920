"""Small scenarios with literal answers."""

import datetime
import zipfile

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.functions import parse, text
from cadastra.operators import geo, graph, indicators, leads, lists, relational, resolve, risk, security
from cadastra.plans import catalog, city, stages
from cadastra.sources import files, public_lists, rules, sinks
from cadastra.streaming import events as streams


def most_rows(spark, run):
    """The most rows that a step of any plan gave out while run() went on."""
    store = spark._jsparkSession.sharedState().statusStore()
    seen, number = store.executionsCount(), lambda v: int(v.replace(",", "")) if v.replace(",", "").isdigit() else 0
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    most, new = 0, store.executionsList(seen, 1000)
    for k in range(new.size()):
        e = new.apply(k)
        values = store.executionMetrics(e.executionId())
        for i in range(e.metrics().size()):
            m = e.metrics().apply(i)
            if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                most = max(most, number(values.apply(m.accumulatorId())))
    return most


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "v string").select(f("v").alias("o")).first().o


@pytest.mark.parametrize(
    "a, b",
    [("R DR MOURA", "RUA DOUTOR MOURA"), ("AL. NOVE DE JULHO", "Alameda Nove de Julho"), ("R. MONS. BENTO", "Rua Monsenhor Bento"), ("TRV DA GUIA", "TRAVESSA DA GUIA"), ("R S PEDRO", "RUA SAO PEDRO")],
)
def test_same_keys(spark, a, b):
    for f in (text.street_key, text.street_full_key):
        assert one(spark, f, a) == one(spark, f, b)


@pytest.mark.parametrize("a, b", [("R SAO PEDRO", "R PEDRO"), ("AV GOV LIMA", "AV LIMA"), ("R DR RAUL", "R RAUL")])
def test_short_key_only(spark, a, b):
    assert one(spark, text.street_key, a) == one(spark, text.street_key, b)
    assert one(spark, text.street_full_key, a) != one(spark, text.street_full_key, b)


def test_similarity_ties(spark):
    df = spark.createDataFrame([("word", "two words"), ("", ""), ("abc", "abc")], "a string, b string")
    got = [r.s for r in df.select(text.similarity("a", "b").alias("s")).collect()]
    assert got[0] == pytest.approx(4 / 11, abs=1e-6) and got[1:] == [0.0, 1.0]


def test_completed_years(spark):
    df = spark.createDataFrame([(datetime.date(2024, 2, 29), datetime.date(2025, 2, 28)), (datetime.date(2020, 1, 5), datetime.date(2023, 1, 5))], "a date, b date")
    assert [r.y for r in df.select(parse.completed_years("a", "b").alias("y")).collect()] == [0, 3]


def test_permits(spark):
    p = "permit string, cep string, street string, number int, name string, activity string, start string"
    permits = spark.createDataFrame(
        [("A1", "80010000", "FAIVRE", 10, "PADARIA SOL", "4711301", "2020-01-01"), ("A2", "80010000", "FAIVRE", 99, "OFICINA X", "1", "x"), ("B1", "80010000", "FAIVRE", None, "PADARIA SOL", "4711301", "2019-01-01")], p
    )
    firms = spark.createDataFrame([("F1", "80010000", "FAIVRE", 10, "PADARIA DO SOL", "4711301", "2020-01-01"), ("F2", "80010000", "FAIVRE", 12, "BAR LUA", "5", "y")], p.replace("permit", "firm"))
    got = {(r.permit, r.firm, r.method) for r in resolve.match_permits(permits, firms).collect()}
    assert got == {("A1", "F1", "mesmo_endereco")}


def test_permits_by_class(spark):
    """Many rows with few names against all pairs by hand, with nulls, ties and a second name; names are compared once a class."""
    import random

    rnd, names, kinds = random.Random(5), ["PADARIA SOL", "PADARIA DO SOL", "BAR LUA", "BAR DA LUA", "", None], ["PADARIA", "BAR", "BAR LUA", None]
    row = lambda i: (i, rnd.choice(["80", "81", None]), rnd.choice(["A", "B"]), rnd.choice([1, 2, 3, None]), rnd.choice(names), rnd.choice(kinds), rnd.choice(["x", "y", "z", None]), rnd.choice([1, 2, 3, None]))
    permits, firms = [row(i) for i in range(150)], [row(i) for i in range(130)]
    p = "permit long, cep string, street string, number int, name string, trade string, activity string, start int"
    grams = lambda s: {f"  {w} "[i : i + 3] for w in s.lower().split() for i in range(len(w) + 1)}
    alike = lambda a, b: float(np.float32(len(a & b) / len(a | b))) if a | b else 0.0
    a, b, method = {}, {}, {}
    for m in permits:
        for f in firms:
            number, activity, start = (m[k] is not None and m[k] == f[k] for k in (3, 6, 7))
            if m[1] and m[1:3] == f[1:3] and (number or activity or start):
                sim = max([0.0, *(alike(grams(m[i]), grams(f[j])) for i in (4, 5) for j in (4, 5) if m[i] is not None and f[j] is not None)])
                score = round((0.5 * sim + 0.25 * activity + 0.25 * start) * (1.0 if number else 0.8), 3)
                if score >= 0.5:
                    a[m[0]], b[f[0]] = min(a.get(m[0], (0, 0)), (-score, f[0])), min(b.get(f[0], (0, 0)), (-score, m[0]))
                    method[m[0], f[0]] = "mesmo_endereco" if number else "mesma_rua"
    want = {(m, f, -w, method[m, f]) for m, (w, f) in a.items() if b[f][1] == m}
    got = resolve.match_permits(spark.createDataFrame(permits, p), spark.createDataFrame(firms, p.replace("permit", "firm")))
    assert {(r.permit, r.firm, r.score, r.method) for r in got.collect()} == want and len(want) > 20


def test_permits_pairs(spark):
    """4000 permits and firms of one street with two names are compared as classes: nothing reads 4 million pairs."""
    x = spark.range(4000).select(F.col("id"), *(F.lit("1").alias(c) for c in ("cep", "street")), (F.col("id") % 1999).alias("number"), F.concat(F.lit("BAR "), F.floor(F.col("id") / 2) % 2).alias("name"), F.lit("a").alias("activity"), (F.col("id") % 1997).alias("start"))
    found = lambda: resolve.match_permits(x.where("id % 2 = 0").withColumnRenamed("id", "permit"), x.where("id % 2 = 1").withColumnRenamed("id", "firm")).collect()
    assert 2000 <= most_rows(spark, found) < 100_000


def test_mutual_nearest(spark):
    """3000 by 3000 rows with few distinct values give the pairs of the plain way, and no step gives out the 9 million pairs."""
    a = spark.range(3000).select((F.col("id") * 7 % 3001).alias("a_id"), (F.col("id") % 2).alias("g"), F.when(F.col("id") % 50 < 49, F.col("id") % 50 * 1.5).alias("x"))
    b = spark.range(3000).select((F.col("id") * 11 % 3001).alias("b_id"), (F.col("id") % 3).alias("g"), (F.col("id") % 40 * 2.0).alias("y"))
    score, got = F.round(1 / (1 + F.abs(F.col("x") - F.col("y"))), 2), []
    assert most_rows(spark, lambda: got.extend(relational.mutual_nearest(a, b, "a_id", "b_id", ["g"], score).collect())) < 20_000
    few = lambda df, k: df.where(F.col(k) < 400)
    want = relational.mutual_best(few(a, "a_id").join(few(b, "b_id"), "g").select("a_id", "b_id", score.alias("score")), "a_id", "b_id", "score")
    few_got = relational.mutual_nearest(few(a, "a_id"), few(b, "b_id"), "a_id", "b_id", ["g"], score)
    assert sorted(map(tuple, few_got.collect())) == sorted(map(tuple, want.collect())) and got and few_got.count()


def test_mutual_best_pairs(spark, tmp_path):
    """The query itself on 2000 customers and suppliers of one nation with ten balances."""
    one = lambda p, k: spark.range(2000).select(F.col("id").alias(f"{p}_{k}key"), F.lit(1).alias(f"{p}_nationkey"), (F.col("id") % 10 * 3.25).alias(f"{p}_acctbal"))
    one("c", "cust").write.parquet(f"{tmp_path}/customer.parquet")
    one("s", "supp").write.parquet(f"{tmp_path}/supplier.parquet")
    got = []
    assert most_rows(spark, lambda: got.extend(catalog.mutual_best_match(spark, str(tmp_path)).collect())) < 10_000
    assert sorted(map(tuple, got)) == [(k, k, 1.0) for k in range(10)]


def test_mutual_best_distinct(spark, tmp_path):
    """3000 by 3000 different balances of one nation, more of nations whose sides are far apart (many equal scores), without mates, with
    null, NaN or infinite balances: the pairs of the SQL, and no step gives out the 9 million pairs."""
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1e300, -1e300, 5.0, 5.0, 4e6]
    c = [(k * 7 % 3001, 1, (k * 7919 % 1000003) / 100) for k in range(3000)] + [(4000 + k * 7 % 307, 2, k / 64) for k in range(300)]
    c += [(5000 + k, 3 + k // 11, odd[k % 11]) for k in range(33)] + [(6000, 6, None), (6001, 7, None), (6002, 8, 1.0), (6003, None, 1.0), (6004, 9, 3.0), (6005, 9, None)]
    s = [(k * 11 % 3001, 1, (k * 104729 % 1000003) / 100) for k in range(3000)] + [(4000 + k * 11 % 307, 2, 9000 + k / 64) for k in range(300)]
    s += [(5000 + k, 3, odd[10 - k]) for k in range(11)] + [(5020, 4, 5.0), (5021, 4, 1e300), (5030, 5, None), (5031, 5, 7.0)]
    s += [(6000, 6, None), (6001, 6, 2.0), (6002, 7, 2.0), (6003, 7, 1.0), (6004, None, 1.0), (6005, 9, None), (6006, 9, None)]
    spark.createDataFrame(c, "c_custkey long, c_nationkey long, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(s, "s_suppkey long, s_nationkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    got = []
    assert most_rows(spark, lambda: got.extend(catalog.mutual_best_match(spark, str(tmp_path)).collect())) < 100_000
    want = compare.duck_rows(catalog.ORACLES["mutual_best_match"], str(tmp_path))[1]
    assert sorted(repr(tuple(map(compare.plain, r))) for r in got) == sorted(map(repr, want)) and len(got) > 700


def test_nearest_any_copies(spark):
    """2000 points and 2000 copies of two places: the smallest id of a place is found without all 4 million pairs."""
    a = spark.range(2000).select(F.col("id").alias("a_id"), (F.lit(-25.0) + F.col("id") * 1e-6).alias("lat"), F.lit(-49.0).alias("lon"))
    b = spark.range(2000).select((F.lit(2000) - F.col("id")).alias("b_id"), (F.lit(-25.001) + F.col("id") % 2 * 0.2).alias("lat"), F.lit(-49.0).alias("lon"))
    got = []
    assert most_rows(spark, lambda: got.extend(geo.nearest_any(a, b, 1000.0).collect())) < 100_000
    assert {r.a_id: r.b_id for r in got} == {k: 2 for k in range(2000)}


def test_nearest_dense(spark):
    """2500 by 2500 points within one radius, an empty corner and a point too far off, against brute force: no step gives out all pairs."""
    x, y = F.col("id") % 50, F.floor(F.col("id") / 50)
    a = spark.range(2500).select(F.col("id").alias("a_id"), (F.lit(-25.0) + x * 1e-4 + F.when(F.col("id") == 7, 1.0).otherwise(0.0)).alias("lat"), (F.lit(-49.0) + y * 1.1e-4).alias("lon"))
    b = spark.range(2500).where((x < 30) | (y < 20)).select((F.lit(9000) - F.col("id")).alias("b_id"), (F.lit(-25.0) + x * 1.003e-4).alias("lat"), (F.lit(-49.0) + y * 1.107e-4).alias("lon"))
    got = []
    assert most_rows(spark, lambda: got.extend(geo.nearest(a, b, 1500.0).collect())) < 500_000
    p, q = np.array(sorted(map(tuple, a.collect()))), np.array(sorted(map(tuple, b.collect())))
    f, g = np.radians(p[:, None, 1:]), np.radians(q[None, :, 1:])
    h = np.sin((g - f)[..., 0] / 2) ** 2 + np.cos(f[..., 0]) * np.cos(g[..., 0]) * np.sin((g - f)[..., 1] / 2) ** 2
    metres = 2 * geo.RADIUS * np.arcsin(np.sqrt(h))
    found = {r.a_id: (r.b_id, r.metres) for r in got}
    assert set(found) == set(range(2500)) - {7}
    at = {int(k): i for i, k in enumerate(q[:, 0])}
    for k, (m, d) in found.items():
        assert abs(metres[k].min() - d) < 1e-6 and abs(metres[k, at[m]] - d) < 1e-6


def test_fuzzy_pairs_copies(spark):
    """Rows of few names in one block: every pair of ids comes out once, its names are compared once a class, no side is broadcast."""
    names = ["rose blue green", "rose blue grey", "blue rose green", "lemon", "", None]
    row = F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 6 + 1).cast("int"))
    a = spark.range(300).select(F.col("id").alias("left_id"), F.when(F.col("id") < 294, "x").alias("block"), row.alias("name"))
    df = resolve.fuzzy_pairs(a, a.withColumnRenamed("left_id", "right_id"), "block", 0.6, ascending=True)
    grams = lambda s: {f"  {w} "[i : i + 3] for w in s.split() for i in range(len(w) + 1)}
    g = [grams(n) if n else set() for n in names]
    want = {(i, j) for i in range(294) for j in range(i + 1, 294) if g[i % 6] and len(g[i % 6] & g[j % 6]) / len(g[i % 6] | g[j % 6] or {0}) >= 0.6}
    got = [(r.left_id, r.right_id) for r in df.collect()]
    assert len(got) == len(set(got)) and set(got) == want and (0, 2) in want and (0, 6) in want
    other = a.select((F.col("left_id") + 1000).alias("right_id"), "block", "name")
    assert {(r.left_id, r.right_id) for r in resolve.fuzzy_pairs(a, other, "block", 0.99).collect()} == {(i, j + 1000) for i in range(294) for j in range(294) if g[i % 6] and g[i % 6] == g[j % 6]}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    compared = next(x for x in plan.split("Join Inner")[1:] if "array_intersect(p" in x.split("\n")[0])
    assert "Aggregate" in compared and "strategy=merge" in compared.split("\n")[0]


def test_trigram_whole_table(spark, tmp_path):
    """Similar names of other brands and sizes are found, names without trigrams, copies and other letters come out as in the SQL, and
    heads with their classes give all pairs of the table."""
    names = ["cold plate", "old plate", "Old  PLATE!", "plate old", "old plates", "red bolt", "red bolts", "café bar", "caf bar", "", "--", "木", None, "İron rod", "iron rod", "a1 b2", "A1-b2"]
    rows = [(k * 37 % 101, names[k % 17], f"Brand#{k % 5}" if k % 7 else None, k % 3 or None) for k in range(60)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = [tuple(map(compare.plain, r)) for r in catalog.trigram_similarity(spark, str(tmp_path)).collect()]
    want = compare.duck_rows(catalog.ORACLES["trigram_similarity"], str(tmp_path))[1]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    grams = lambda s: frozenset(f"  {w} "[i : i + 3] for w in "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in s.replace("İ", "i").lower()).split() for i in range(len(w) + 1))
    g = {k: grams(n) for k, n, _, _ in rows if n is not None}
    head = {k: k for k in g} | {b: a for a, b, s in got if s != s or s == 1.0}
    linked = {(a, b) for a, b, s in got if s < 1.0}
    for a in g:
        for b in g:
            if a < b:
                x, y = sorted((head[a], head[b]))
                assert (x == y or (x, y) in linked) == (not g[a] | g[b] or len(g[a] & g[b]) >= 0.6 * len(g[a] | g[b]))
    assert linked and len({head[k] for k in g if not g[k]}) == 1


def test_geocode_cascade(spark):
    census = [("80000001", "FLORES", "FLORES", n, None, -49.0 + n * 1e-5, -25.0) for n in range(2, 100, 2)]
    census += [("80000001", "FLORES", "FLORES", 10, "MERCADO CENTRAL", -49.0, -25.0), ("80000002", "PEDRAS", "PEDRAS", 5, None, -49.1, -25.1)]
    census = spark.createDataFrame(census, "cep string, street string, full string, number int, name string, lon double, lat double")
    targets = spark.createDataFrame(
        [
            (1, "MERCADO CENTRAL", "80000001", "FLORES", "FLORES", 10, None),
            (2, "X", "80000001", "FLORES", "FLORES", 20, None),
            (3, "X", "99999999", "PEDRAS", "PEDRAS", 5, None),
            (4, "X", "80000001", "FLORES", "FLORES", 110, None),
            (5, "X", "80000001", "FLORES", "FLORES", None, None),
            (6, "X", "80000001", "FLORE", "FLORE", 1, None),
            (7, "X", "99999999", "PEDRAS", "PEDRAS", None, None),
            (8, "X", "80000002", "ZZZ", "ZZZ", 1, None),
            (9, "X", "99999999", "ZZZ", "ZZZ", 1, "CENTRO"),
            (10, "X", "99999999", "ZZZ", "ZZZ", 1, None),
        ],
        "id int, name string, cep string, street string, full string, number int, district string",
    )
    districts = spark.createDataFrame([("CENTRO", -49.2, -25.2)], "district string, lon double, lat double")
    got = {r.id: r.level for r in resolve.geocode(targets, census, districts).collect()}
    assert [got[k] for k in range(1, 11)] == resolve.LEVELS


def test_polygon_ties(spark):
    ring = lambda x0, x1: [(x0, 0.0), (x1, 0.0), (x1, 2.0), (x0, 2.0), (x0, 0.0)]
    polygons = spark.createDataFrame([("B", "b", ring(2.0, 4.0)), ("A", "a", ring(0.0, 2.0)), (None, "big", ring(0.0, 8.0))], "code string, name string, ring array<struct<x: double, y: double>>")
    points = spark.createDataFrame([(1, 2.0, 1.0), (2, 5.0, 1.0), (3, 9.0, 9.0)], "id long, x double, y double")
    for _ in range(2):
        got = {r.id: (r.code, r.name) for r in geo.polygon_join(points, polygons, 1.5).collect()}
        assert got == {1: ("A", "a"), 2: (None, "big"), 3: (None, None)}


def test_graph(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (3, 4, 5.0), (7, 8, 1.0)], "u long, v long, w double")
    assert {r.node: r.root for r in graph.connected(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7}
    assert {r.node: r.main for r in graph.main_component(edges).collect()}[7] is False
    start = spark.createDataFrame([(1, 0.0)], "node long, cost double")
    assert {r.node: r.cost for r in graph.shortest(edges, start, 6.0).collect()} == {1: 0.0, 2: 1.0, 3: 2.0}
    assert graph.scan([(10, 20, "a", "b", "t"), (30, 40, "b", "c", "u"), (15, 17, "b", "d", "v")], {"b": [("e", 5)]}, {"a": 0}) == {"a": 0, "b": 20, "e": 25, "c": 40}


def test_calendar(spark):
    cal = spark.createDataFrame([("wk", *"1111100", "20240101", "20241231"), ("we", *"0000011", "20240101", "20241231")], "service_id string, monday string, tuesday string, wednesday string, thursday string, friday string, saturday string, sunday string, start_date string, end_date string")
    exc = spark.createDataFrame([("wk", "20240501", "2"), ("we", "20240501", "1")], "service_id string, date string, exception_type string")
    assert [r[0] for r in graph.active_services(cal, exc, "2024-05-01").collect()] == ["we"]
    assert [r[0] for r in graph.active_services(cal, exc, "2024-05-02").collect()] == ["wk"]


def test_auc_and_hazard(spark):
    rows = lambda x: spark.createDataFrame(x, "s double, p int")
    assert relational.auc(rows([(0.1, 0), (0.9, 1)]), "s", "p").first().auc == 1.0
    assert relational.auc(rows([(0.5, 0), (0.5, 1)]), "s", "p").first().auc == 0.5
    assert relational.auc(rows([(0.5, 1)]), "s", "p").first().auc is None


def test_csv(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes("Código;Nome;Valor R$\n1;José;\n2;\"a;b\";3\n".encode("cp1252"))
    got = files.read_csv(spark, str(p), ["CODIGO"])
    assert got.columns == ["CODIGO", "NOME", "VALOR_R"] and sorted(map(tuple, got.collect())) == [("1", "José", None), ("2", "a;b", "3")]
    with pytest.raises(ValueError, match="NADA"):
        files.read_csv(spark, str(p), ["NADA"])
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/a.csv", "A,B\n1,2\n")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.zip")).collect()] == [("1", "2")]
    (tmp_path / "w.csv").write_text("station;x\nCURITIBA;y\nData;Hora;T\n2024/01/01;0000 UTC;1,5\n")
    assert files.read_csv(spark, str(tmp_path / "w.csv"), ["DATA"], skip=2).first().T == "1,5"
    assert files.pick(got, ["CODIGO", "X"]).columns == ["CODIGO", "X"]


def test_census(spark):
    df = spark.createDataFrame([("4106902001P", "1,5", "X", "7"), ("9", "1", "1", "1")], "CD_SETOR string, AREA_KM2 string, V0001 string, V0002 string")
    assert sorted(map(tuple, files.census_long(df, "CD_SETOR", "4106902").collect())) == [("4106902001", "AREA_KM2", 1.5), ("4106902001", "V0002", 7.0)]


def test_privacy(spark, tmp_path):
    good = spark.createDataFrame([("a", 1)], "x string, n int")
    bad = spark.createDataFrame([("id 123.456.789-01",)], "x string")
    with pytest.raises(sinks.PrivacyError):
        sinks.check_private(bad)
    with pytest.raises(sinks.PrivacyError):
        sinks.check_private(good.withColumnRenamed("x", "nome_fantasia"))
    out = str(tmp_path / "pub")
    sinks.publish(spark, {"old": good}, out)
    m = sinks.publish(spark, {"new": good, "gone": "no table"}, out)
    assert m["layers"]["new"]["rows"] == 1 and len(m["layers"]["new"]["sha256"]) == 64 and not (tmp_path / "pub" / "old").exists()


def test_slices(spark, tmp_path):
    p = str(tmp_path / "s")
    sinks.replace_slice(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), p, ["k"])
    sinks.replace_slice(spark.createDataFrame([(2, "c")], "k int, v string"), p, ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(p).collect()) == [(1, "a"), (2, "c")]


def test_stages(spark, tmp_path):
    seen = []
    ok = lambda n: stages.Stage(n, lambda s: seen.append(n))
    bad = lambda n, o: stages.Stage(n, lambda s: 1 / 0, o)
    log = stages.RunLog(spark, str(tmp_path / "log"))
    run, good = stages.run_stages(spark, [ok("a"), bad("b", True), ok("c"), bad("d", False), ok("e")], log)
    assert not good and seen == ["a", "c"]
    _, good = stages.run_stages(spark, [ok("a"), ok("d"), ok("e")], log, resume=run)
    assert good and seen == ["a", "c", "d", "e"]


def test_streams(spark, sf, tmp_path):
    import shutil

    shutil.copy(f"{sf}/events.parquet", tmp_path / "events.parquet")
    q = streams.windowed_counts(streams.read_events(spark, str(tmp_path))).writeStream.outputMode("append").format("memory").queryName("w").start()
    q.processAllAvailable()
    q.stop()
    batch = spark.read.parquet(f"{sf}/events.parquet")
    closed = spark.table("w").agg(F.sum("n")).first()[0]
    assert 0 < closed <= batch.count()


def test_supply_and_roll(spark):
    r = spark.createDataFrame([("A", 100), ("B", 300)], "place string, residents long")
    s = spark.createDataFrame([("A", "47", 8)], "place string, class string, n long")
    got = {x.place: (x.n, x.expected, x["index"]) for x in indicators.supply_gap(s, r, ["47"]).collect()}
    assert got == {"A": (8, 2.0, 400.0), "B": (0, 6.0, 0.0)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "u long, v long, w double")
    assert graph.connected(empty).count() == 0
    assert relational.places(empty, [F.col("u")])[1] == 0


def test_lead_score_clamps(spark):
    df = spark.createDataFrame([("a",)], "key string")
    assert risk.lead_score(df, {"sancao": F.lit(True), "rede": F.lit(None).cast("boolean")}).first()[1:] == (0, "sancao")


def test_distance_join_everywhere(spark):
    """Near the poles and across 180 degrees."""
    import math
    import random

    rnd = random.Random(5)
    places = [(k, lat + rnd.uniform(-0.02, 0.02), lon + rnd.uniform(-0.05, 0.05)) for k, (lat, lon) in enumerate([(75, 20), (-84, -60), (0, 180), (-45, -180), (89.99, 0)] * 40)]
    places = [(k, min(lat, 90.0), (lon + 180) % 360 - 180) for k, lat, lon in places] + [(900, 90.0, 10.0), (901, 89.9999, -170.0), (902, -90.0, 0.0)]
    df = spark.createDataFrame(places, "a_id int, lat double, lon double")

    def metres(a, b):
        h = math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * geo.RADIUS * math.asin(min(1, math.sqrt(h)))

    for r in (300.0, 1500.0):
        want = {(a[0], b[0]) for a in places for b in places if metres(a, b) <= r}
        got = [(x.a_id, x.b_id) for x in geo.distance_join(df, df.withColumnRenamed("a_id", "b_id"), r).collect()]
        assert set(got) == want and len(got) == len(want)


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def test_areas(spark):
    """Holes, islands, interior points, overlaps of general polygons, planarised streets."""
    import numpy as np

    outer, hole = ring((0, 0), (10, 0), (10, 10), (0, 10)), ring((2, 2), (2, 8), (8, 8), (8, 2))
    island = ring((20, 0), (24, 0), (22, 4))
    df = spark.createDataFrame([("A", "ring", [outer, hole, island])], "code string, name string, rings array<array<struct<x: double, y: double>>>")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 2.0, 5.0), (4, 22.0, 1.0), (5, 15.0, 1.0)], "id int, x double, y double")
    assert {r.id: r.code for r in geo.polygon_join(points, df, 3.0).collect()} == {1: "A", 2: None, 3: "A", 4: "A", 5: None}
    row = df.select(geo.signed_area(F.col("rings")).alias("a"), geo.interior_point(F.col("rings")).alias("p")).first()
    assert row.a == 100 - 36 + 8 and row.p.y == 5.0 and row.p.x in (1.0, 9.0)
    arr = lambda r: np.array([(p["x"], p["y"]) for p in r])
    assert geo.overlap_area([arr(outer), arr(hole)], [arr(ring((5, 5), (15, 5), (15, 15), (5, 15)))]) == pytest.approx(25 - 9)
    assert geo.overlap_area([arr(ring((0, 0), (4, 0), (0, 4)))], [arr(ring((0, 0), (4, 0), (4, 4)))]) == pytest.approx(4)
    assert geo.overlap_area([np.array(geo.circle(0, 0, 10))], [arr(ring((0, -20), (20, -20), (20, 20), (0, 20)))]) == pytest.approx(np.pi * 50, rel=1e-6)
    seg = [(k, 0.0, float(k), 4.0, float(k)) for k in range(3)] + [(10 + k, 1.0 + k, -1.0, 1.0 + k, 3.0) for k in range(2)] + [(20, 4.0, 0.0, 6.0, 0.0)]
    cut = geo.planarised(spark.createDataFrame(seg, "id int, x1 double, y1 double, x2 double, y2 double"), 2.0).collect()
    assert len(cut) == 3 * 3 + 2 * 4 + 1 and all((r.x1, r.y1) != (r.x2, r.y2) for r in cut)
    assert sorted((r.x1, r.x2) for r in cut if r.id == 1) == [(0.0, 1.0), (1.0, 2.0), (2.0, 4.0)]


def test_bus_reach(spark, sf):
    """The composition of walk, ride and walk against the same by hand on Dijkstra and a plain scan."""
    import heapq
    import math

    n, walk = 12, graph.WALK
    got = {r.node: r.cost for r in city.bus_reach(spark, sf).collect()}
    place = {(i, j): (round(-25.5 + j * 0.002, 7), round(-49.3 + i * 0.002, 7)) for i in range(n) for j in range(n)}
    ids = spark.createDataFrame([(i, j, lon, lat) for (i, j), (lat, lon) in place.items()], "i int, j int, lon double, lat double")
    name = {(r.i, r.j): r.id for r in ids.select("i", "j", F.xxhash64("lon", "lat").alias("id")).collect()}

    def dijkstra(start, limit):
        best, heap = {}, [(c, p) for p, c in start.items() if c <= limit]
        heapq.heapify(heap)
        while heap:
            c, (i, j) = heapq.heappop(heap)
            if (i, j) in best:
                continue
            best[i, j] = c
            for q in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
                if q in place and q not in best and c + 210 <= limit:
                    heapq.heappush(heap, (c + 210, q))
        return best

    def metres(a, b):
        h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * geo.RADIUS * math.asin(math.sqrt(h))

    limit = 25 * walk
    on_foot = dijkstra({(0, 0): 0.0}, limit)
    stops = {str(s): (-25.5 + s * 0.004, -49.3 + s * 0.004) for s in range(6)}
    near = {s: min((metres(p, q), k) for k, q in place.items()) for s, p in stops.items()}
    rides = []
    trips = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").where("turn < 6").collect():
        trips.setdefault(r.conv_id, []).append((r.turn, 28800 + r.conv_id % 40 * 60 + r.turn * 90))
    for c, turns in trips.items():
        turns.sort()
        rides += [(x[1] + 10, y[1], str(x[0]), str(y[0]), c) for x, y in zip(turns, turns[1:])]
    rides = sorted(x for x in rides if 28800 <= x[0] <= 28800 + 25 * 60)
    used = {s for x in rides for s in x[2:4]}
    start = {s: 28800 + (on_foot[k] + d) / walk * 60 for s, (d, k) in near.items() if s in used and k in on_foot and on_foot[k] + d <= limit}
    found = graph.scan(rides, {}, dict(start))
    begin = {(0, 0): 0.0}
    for s, t in found.items():
        d, k = near[s]
        begin[k] = min(begin.get(k, 1e9), (t - 28800) / 60 * walk + d)
    want = {name[k]: c for k, c in dijkstra(begin, limit).items()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=0.01) for k in want)
    assert len(want) > len(on_foot)


def test_files(spark, tmp_path):
    """Quoted line ends, zip members by name, a GeoJSON with every kind of geometry, ways, footprints, registry."""
    import json

    (tmp_path / "q.csv").write_text('A;B\n1;"two\nlines"\n2;x\n')
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "q.csv")).collect()] == [("1", "two\nlines"), ("2", "x")]
    with zipfile.ZipFile(tmp_path / "gtfs.zip", "w") as z:
        z.writestr("trips.txt", "trip_id,route_id\nt,r\n")
        z.writestr("sub/stops.txt", "\ufeffstop_id,stop_name\ns,Name\n")
        z.writestr("stop_times.txt", "trip_id\nt\n")
    assert files.read_csv(spark, str(tmp_path / "gtfs.zip"), ["STOP_ID"], member="stops.txt").first().asDict() == {"STOP_ID": "s", "STOP_NAME": "Name"}
    square = [[0, 0], [0, 4], [4, 4], [4, 0], [0, 0]]
    hole = [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]
    feature = lambda kind, c, **p: {"type": "Feature", "properties": p, "geometry": c and {"type": kind, "coordinates": c}}
    shapes = [
        feature("Polygon", [square, hole], NOME="Centro", CODIGO=7.0), feature("MultiPolygon", [[square], [[[9, 9], [10, 9], [10, 10], [9, 9]]]], NOME="Z", CODIGO="Z"), feature("Point", [1, 2]), feature("Polygon", None),
        feature("LineString", [[0, 0], [1, 0], [1, 1]], highway="residential"), feature("MultiLineString", [[[5, 5], [6, 6]], [[50, 50], [60, 60]]], highway="footway"),
        feature("LineString", [[0, 0], [9, 9]], highway="motorway"), feature("LineString", [[0, 0], [9, 9]], highway="path", foot="no"), feature("Polygon", [square], CD_SETOR="410690205010001P"), feature("Polygon", [square], CD_SETOR="9990000"),
    ]
    (tmp_path / "x.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": shapes}))
    g = files.read_geojson(spark, str(tmp_path / "x.geojson"))
    assert g.count() == 9
    areas = [r.a for r in g.where("rings is not null").select(geo.signed_area(F.col("rings")).alias("a")).collect()]
    assert areas[:2] == [15.0, 16.5]
    assert [(r.code, r.name) for r in files.layer(g, ["NOME"], ["CODIGO"]).collect()] == [("7", "Centro"), (None, "Z")]
    assert [r.code for r in files.sector_mesh(g, "4106902").collect()] == ["410690205010001"]
    assert sorted(map(tuple, files.road_lines(g, (0, 0, 20, 20)).collect())) == [(0, 0, 1, 0), (1, 0, 1, 1), (5, 5, 6, 6)]
    spark.createDataFrame([(1, (0.0, 1.0, 0.0, 1.0)), (2, (5.0, 6.0, 5.0, 6.0))], "id int, bbox struct<xmin: double, xmax: double, ymin: double, ymax: double>").write.parquet(f"{tmp_path}/b")
    assert [r.id for r in files.footprints(spark, f"{tmp_path}/b", (0.5, 0.5, 2, 2)).collect()] == [1]
    spark.createDataFrame([("PR", "10", "X", "a"), ("PR", "11", "Town", "b"), ("SP", "10", "X", "c")], "uf string, municipio string, nome_municipio string, cnpj string").write.parquet(f"{tmp_path}/db/firms")
    assert sorted(r.cnpj for r in files.read_registry(spark, f"{tmp_path}/db", "firms", "PR", "10", "town", ["cnpj"]).collect()) == ["a", "b"]
    nested = [{"id": "0111-3/01", "descricao": "rice", "classe": {"id": "01113", "descricao": "c", "grupo": {"id": "011", "descricao": "g", "divisao": {"id": "01", "descricao": "d", "secao": {"id": "A", "descricao": "s"}}}}}, {"id": "9", "descricao": None}]
    (tmp_path / "h.json").write_text(json.dumps(nested))
    got = sorted(map(tuple, files.activity_hierarchy(spark, str(tmp_path / "h.json")).collect()))
    assert got[0] == ("0111301", "rice", "01113", "c", "011", "g", "01", "d", "A", "s") and got[1][0] == "9" and got[1][2:] == (None,) * 8
    assert files.derived_hierarchy(spark.createDataFrame([("0111301", "rice"), ("1", "x")], "codigo string, descricao string")).first().divisao == "01"
    found = {r["column"]: (r.percent, r.interest, r.encoding, r.delimiter) for r in files.inventory(spark, str(tmp_path / "q.csv"), 1).collect()}
    assert found == {"A": (100.0, "", "UTF-8", ";"), "B": (100.0, "", "UTF-8", ";")}


def test_weather(spark, tmp_path):
    head = "REGIAO:;S\nUF:;PR\nCODIGO (WMO):;A807\nDATA DE FUNDACAO\nData;Hora UTC;PRECIPITAÇÃO TOTAL, HORÁRIO (mm);TEMPERATURA DO AR - BULBO SECO, HORARIA (°C);TEMPERATURA MÁXIMA (°C);TEMPERATURA MÍNIMA (°C);\n"
    rows = ["2024/01/02;0200 UTC;1,5;20;21;19;", "2024/01/02;0300 UTC;,5;22,5;;;", "2024/01/02;0400 UTC;-9999;;30;-9999;", "2024/01/02;0500 UTC;0;24;24,5;23;", "x;0500 UTC;0;24;24;23;"]
    (tmp_path / "a.csv").write_bytes((head + "\n".join(rows)).encode("cp1252"))
    (tmp_path / "b.csv").write_bytes((head + rows[1]).encode("cp1252"))
    x = files.read_weather(spark, f"{tmp_path}/*.csv")
    got = {str(r.day): r for r in indicators.daily_climate(x).collect()}
    assert (got["2024-01-01"].station, got["2024-01-01"].rain, got["2024-01-01"].n) == ("A807", 1.5, 1)
    d = got["2024-01-02"]
    assert (d.rain, d.rain_hours, d["mean"], d["min"], d["max"], d.n) == (0.5, 1, 23.2, 22.5, 30.0, 2)


def test_rule_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text("zona;cnae_prefixo;permitido;fonte;observacao\nZR1;47;S;art. 1;\nZR1;4711-3;não;art. 2;x\n;;;;blank\n")
    zones = spark.createDataFrame([("ZR1",)], "zone string")
    good = rules.zoning_rules(files.read_csv(spark, str(tmp_path / "r.csv"), ["ZONA"]), zones)
    assert sorted(map(tuple, good.collect())) == [("ZR1", "47", True, "art. 1"), ("ZR1", "47113", False, "art. 2")]
    (tmp_path / "bad.csv").write_text("zona;cnae_prefixo;permitido;fonte;observacao\nZR1;47;S;a;\nZR9;4;talvez;;\nZR1;47;N;b;\n")
    with pytest.raises(ValueError) as e:
        rules.zoning_rules(files.read_csv(spark, str(tmp_path / "bad.csv")), zones)
    assert [x.split(":")[0] for x in str(e.value).splitlines()] == ["line 3"] * 4 + ["line 4"] and "'talvez'" in str(e.value) and "repeated" in str(e.value)
    firms = spark.createDataFrame([("ZR1", "47", True), ("ZR1", "47", True), ("ZR1", "56", True), ("ZR1", "10", False), (None, "47", True)], "zone string, division string, active boolean")
    sheet = rules.rule_template(firms, zones.withColumn("name", F.lit("Zone 1")), spark.createDataFrame([("47", "Retail")], "division string, name string"), good)
    assert [tuple(r) for r in sheet.collect()] == [("ZR1", "47", "S", "art. 1", "Zone 1 | Retail | 2 active"), ("ZR1", "56", "", "", "Zone 1 |  | 1 active")]
    uses = spark.createDataFrame([(f"k{i}", i % 2 == 0, i % 3 == 0) for i in range(30)], "key string, active boolean, allowed boolean")
    first = [r.key for r in rules.review_sample(uses, 4).collect()]
    assert len(first) == 4 and first == [r.key for r in rules.review_sample(uses.repartition(3), 4).collect()] and all(int(k[1:]) % 2 == 0 and int(k[1:]) % 3 for k in first)


def test_lists_from_files(spark, tmp_path):
    """From files with other columns to the rollup: roots, personal columns, natural persons."""
    (tmp_path / "l.csv").write_text("Cliente;CPF/CNPJ;UF;Produto;Data da Contratação;Valor Contratado R$\nAna;11222333000181;PR;Finame;02/03/2021;1.000,50\nB;11.222.333/0002-62;PR;BNDES 123.456.789-01;2021-05;10\nC;191;;;;\n")
    firms = spark.createDataFrame([("11222333000181", "11222333", False), ("11222333000262", "11222333", False), ("11444777000161", "11444777", True)], "key string, root string, person boolean")
    got = public_lists.entries(files.read_csv(spark, str(tmp_path / "l.csv")), "bndes_operacoes", firms)
    rows = sorted((r.cnpj, str(r.date), r.value, r.label, r.attributes) for r in got.collect())
    assert [r[:4] for r in rows] == [("11222333000181", "2021-03-02", 1000.5, "Finame"), ("11222333000262", "2021-05-01", 10.0, "BNDES 123.456.789-01")]
    assert '"PRODUTO":"BNDES ***"' in rows[1][4] and "Ana" not in rows[0][4]
    e = got.select("list", "cnpj", "root", "date", "value", "label")
    rolled = {r.key: (r.via, r.n, r.value) for r in lists.list_rollup(e, firms.select("key", "root"), public_lists.specs(spark)).collect()}
    assert rolled == {"11222333000181": ("cnpj", 2, 1010.5), "11222333000262": ("cnpj", 2, 1010.5)}
    with pytest.raises(ValueError):
        public_lists.entries(firms.select(F.col("root").alias("X")), "cnes", firms)


def test_security_without_codes(spark):
    raw = [(None, "01/01/2024", "99", "x", None, None, None, None, "Furto", "N"), (None, "01/01/2024", "99", "x", None, None, None, None, "Furto", "N"), (" ", "x", "7", None, None, None, None, "Sim", "", None), ("a", None, "1:30", None, None, None, None, None, None, None)]
    df = spark.createDataFrame(raw, "code string, date string, hour string, district string, region string, street string, equipment string, flagrant string, n1 string, d1 string")
    got = security.facts(df, spark.createDataFrame([("X",)], "name string"), natures=1).collect()
    assert len(got) == 3 and {r.hour for r in got} == {None, 7, 1}
    theft = next(r for r in got if r.natures)
    assert theft.categories == ["patrimonial"] and theft.district == "X" and str(theft.date) == "2024-01-01"


def test_validation(spark, sf):
    rates, table = risk.validation(catalog.hazard_firms(spark, sf), 2001)
    by = {r.year: r for r in rates.collect()}
    cells = table.collect()
    assert sorted(by) == [1998, 1999, 2000] and len(cells) == 30
    for year, r in by.items():
        part = [c for c in cells if c.year == year]
        assert sum(c.n for c in part) == r.n and r.auc is not None
        assert sum(c.n * c.observed for c in part) == pytest.approx(r.events, abs=0.01 * r.n)


def test_privacy_names_and_nested(spark):
    """Address columns, company names and nested person numbers don't get out."""
    for name in ("logradouro", "endereco_completo", "complemento", "numero", "razao", "fantasia", "email2", "titular"):
        with pytest.raises(sinks.PrivacyError):
            sinks.check_private(spark.createDataFrame([("x",)], f"{name} string"))
    nested = spark.createDataFrame([(1, [("a", "tel 123.456.789-01")])], "id int, notes array<struct<k: string, v: string>>")
    with pytest.raises(sinks.PrivacyError):
        sinks.check_private(nested)
    with pytest.raises(sinks.PrivacyError):
        sinks.check_private(spark.createDataFrame([(1, ("x",))], "id int, owner struct<cpf: string>"))
    fine = spark.createDataFrame([(1, "numero_de_lotes", "12345678901234")], "id int, n_numero string, h3_9 string")
    assert sinks.check_private(fine).count() == 1


def test_gazette(spark, tmp_path):
    xml = """<?xml version="1.0"?><revista numero="1"><processo numero="9" data-deposito="01/02/2020"><titulares><titular nome-razao-social="A LTDA" uf="PR"/><titular nome-razao-social="B" uf="SP"/></titulares><marca><nome>M</nome></marca></processo>
    <processo numero="10"><titulares><titular nome-razao-social="C" uf="PR"/></titulares></processo></revista>"""
    (tmp_path / "g.xml").write_text(xml)
    got = files.read_gazette(spark, str(tmp_path / "g.xml")).select("_numero", "owner._uf").collect()
    assert sorted(tuple(r) for r in got) == [(9, "PR"), (9, "SP"), (10, "PR")]


def test_address_census(spark):
    rows = [("1", "4106902", "-25,4", "-49,2", "x"), ("1", "4106902", "-25,4", "-49,3", "y"), ("2", "4106902", None, "-49,2", "z"), ("3", "999", "1", "1", "z")]
    df = spark.createDataFrame(rows, "COD_UNICO_ENDERECO string, COD_MUNICIPIO string, LATITUDE string, LONGITUDE string, V string")
    got = files.address_census(df, "4106902").collect()
    assert [(r.COD_UNICO_ENDERECO, r.lat) for r in got] == [("1", -25.4)]


def test_registry(spark):
    cols = "razao_social string, nome_fantasia string, opcao_mei string, natureza_juridica string, data_inicio_atividade string, data_situacao_cadastral string"
    rows = [("JOSE 12345678901", None, "S", "2135", "20200101", "0"), ("ACME LTDA", "ACME 123.456.789-01", "N", "2062", "20200230", "20210101")]
    a, b = files.registry(spark.createDataFrame(rows, cols)).collect()
    assert a.razao_social is None and a.cpf_mascarado == "***.456.789-**" and b.nome_fantasia is None and b.razao_social == "ACME LTDA" and b.data_inicio_atividade is None


def test_leads_without_tables(spark):
    """Steps that didn't run count as empty."""
    df = spark.createDataFrame([("a", "03", None, datetime.date(2020, 1, 1), "47", "c", True), ("b", "01", "S", datetime.date(2024, 1, 1), "47", "c", True), ("c", "05", "N", None, "47", "c", False)], "key string, size string, mei string, start date, division string, cell string, active boolean")
    assert {r.key: (r.score, r.criteria) for r in leads.leads(df, "2024-06-01").collect()} == {"a": (25, "idade_2a,porte_epp,nao_mei"), "b": (0, "")}
