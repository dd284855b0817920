"""Every query of the catalogue against its SQL."""

import pytest

import compare
from cadastra.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    if name in catalog.ORACLES:
        compare.same(df, catalog.ORACLES[name], sf)
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_whole_tables(spark, tmp_path):
    """Queries over all rows: components and earliest arrivals by brute force, and every customer."""
    items = [(1, 10, 1), (1, 11, 2), (2, 11, 3), (97, 500, 60), (98, 1000, 60), (99, 1500, 560), (100, 7, 7)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    root = {x: x for _, p, s in items for x in (2 * p, 2 * s + 1)}
    for _ in root:
        for _, p, s in items:
            root[2 * p] = root[2 * s + 1] = min(root[2 * p], root[2 * s + 1])
    assert {r.node: r.root for r in catalog.connected_components(spark, str(tmp_path)).collect()} == root
    turns = [(c, k) for c in (0, 1, 3, 4, 49, 50, 51, 53, 60, 120, 300) for k in range(c % 4 + 5)]
    spark.createDataFrame(turns, "conv_id long, turn int").write.parquet(f"{tmp_path}/conversations.parquet")
    at = {(c, k): 28800 + 120 * k + 30 * c % 3600 for c, k in turns}
    rides = sorted((at[c, k] + 20, at[c, k + 1], 3 * c + 5 * k, 3 * c + 5 * k + 5, c) for c, k in turns if (c, k + 1) in at)
    last, want = max(3 * c + 5 * k for c, k in turns), {}
    for q in range(3):
        ridden, best, aboard = {}, {7 * q: 28800}, set()
        best[7 * q + 1] = 28980
        for dep, arr, a, b, trip in rides:
            if trip in aboard or best.get(a, 1e9) <= dep:
                aboard.add(trip)
                ridden[b] = min(ridden.get(b, 1e9), arr)
                best[b] = min(best.get(b, 1e9), arr)
                if b <= last:
                    best[b + 1] = min(best.get(b + 1, 1e9), ridden[b] + 180)
        want |= {(f"q{q}", str(k)): float(v) for k, v in best.items()}
    assert {(r["query"], r.stop): r.arrival for r in catalog.earliest_arrival(spark, str(tmp_path)).collect()} == want
    spark.createDataFrame([(i, float(i)) for i in range(12)], "c_custkey long, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    got = {r.c_custkey: r.c_acctbal for r in catalog.insert_ignore(spark, str(tmp_path)).collect()}
    assert got == {i: -1.0 if i % 2 else float(i) for i in range(12)}
