import random

import numpy as np
import pytest
from llm.test_common import union_find
from pyspark.sql import functions as F

from shelfwise.llm import nn_descent as N


def plain(rows, threshold=0.9):
    ok = []
    for i, v in rows:
        good = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        ok.append(np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64)) if good else None)
    links = [0] * len(rows)
    edges = []
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if ok[a] is not None and ok[b] is not None and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= threshold:
                links[a] += 1
                links[b] += 1
                edges.append((a, b))
    uf = union_find(edges)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[uf.get(k, k)] = min(i, least.get(uf.get(k, k), i))
    out = []
    for k, (i, _) in enumerate(rows):
        c = least.get(uf.get(k, k)) if ok[k] is not None else i
        out.append((i, links[k], c, i is not None and i == c))
    return out


def vectors():
    rng = np.random.default_rng(4)
    rows = [(i, list(map(float, rng.standard_normal(24).astype(np.float32)))) for i in range(150)]
    for c in range(12):  # crowds of near copies of several sizes
        base = rng.standard_normal(24)
        for _ in range([2, 3, 5, 30, 60][c % 5]):
            rows.append((len(rows), list(map(float, (base + 0.08 * rng.standard_normal(24)).astype(np.float32)))))
    rows += [(len(rows) + i, rows[7][1]) for i in range(40)]  # equal vectors
    rows += [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [float("nan")] + [1.0] * 23), (2004, [float("inf")] + [1.0] * 23),
             (2005, [None] + [1.0] * 23), (2006, [1.0, 0.0]), (2007, [2.0, 0.1]), (2008, [-0.0, 1.0]), (2009, [0.0, 5.0]),
             (None, rows[3][1]), (7, rows[7][1])]
    random.Random(2).shuffle(rows)
    return rows


def test_links_and_components_match_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("node", F.lit("n")).withColumn("v", F.lit(0))
    rows = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]
    got = [tuple(r) for r in N.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


def test_dense_region_in_several_blocks(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal(16)
    m = base + 0.12 * rng.standard_normal((90, 16))
    nodes = N.nodes_of(spark.createDataFrame([(i, [float(x) for x in v], True, i, -i) for i, v in enumerate(m)],
                                             "id long, v array<double>, ok boolean, k1 long, k2 long"))
    regions = nodes.select("node", F.lit(0).cast("long").alias("root"))
    got = {r["node"]: r["n"] for r in N.dense_links(nodes, regions, 0.9, block=20).groupBy("node").agg(F.sum("links").alias("n")).collect()}
    ids = {r["node"]: r["least"] for r in nodes.collect()}
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    true = (u @ u.T >= 0.9).sum(1) - 1
    assert {ids[k]: n for k, n in got.items()} == dict(enumerate(true.tolist()))


def test_full_lists_hide_no_links_between_groups(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(32)
    base /= np.linalg.norm(base)
    rows = []
    for _ in range(3):  # edited versions of one base, each copied with little noise
        edit = base + 0.28 * (lambda g: g / np.linalg.norm(g))(rng.standard_normal(32))
        rows += [(len(rows) + i, [float(x) for x in edit + 0.008 * rng.standard_normal(32)]) for i in range(40)]
    rows += [(500 + i, [float(x) for x in rng.standard_normal(32)]) for i in range(60)]
    expect = plain(rows)
    assert min(e[1] for e in expect if e[0] < 120) > 39  # every copy has links with another group
    got = [tuple(r) for r in N.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).select("vec_id", "n_links", "component_id", "kept").collect()]
    assert sorted(got) == sorted(expect)


def test_links_between_regions_in_several_blocks(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal(16)
    m = np.vstack([base + 0.3 * rng.standard_normal((60, 16)), base + 0.3 * rng.standard_normal((45, 16)), -base + 0.1 * rng.standard_normal((30, 16))])
    nodes = N.nodes_of(spark.createDataFrame([(i, [float(x) for x in v], True, i, -i) for i, v in enumerate(m)],
                                             "id long, v array<double>, ok boolean, k1 long, k2 long"))
    group = np.repeat([0, 1, 2], [60, 45, 30])
    regions = nodes.select("node", F.when(F.col("least") < 60, 0).when(F.col("least") < 105, 1).otherwise(2).cast("long").alias("root"))
    pairs = N.region_pairs(N.region_pivots(regions.join(nodes, "node")), 0.9).collect()
    assert [tuple(r) for r in pairs] == [(0, 1)]
    got = {r["least"]: r["n"] for r in N.cross_links(nodes, regions, 0.9, block=20).groupBy("node").agg(F.sum("links").alias("n")).join(nodes, "node").collect()}
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    true = ((u @ u.T >= 0.9) & (group[:, None] != group[None, :])).sum(1)
    assert true.sum() and all(got.get(i, 0) == n for i, n in enumerate(true.tolist()))


def test_short_recall_raises(spark, monkeypatch):
    monkeypatch.setattr(N, "audit", lambda *a, **k: (1, 2))
    with pytest.raises(RuntimeError, match="1 of 2"):
        N.near_duplicates(spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "vec_id long, embedding array<double>"), codes=2)


def test_audit_sees_planted_links(spark, monkeypatch):
    """Without a link among the rows, a search that finds nothing is noticed."""
    assert N.codes_for(500) == N.CODES < N.codes_for(10**6) < N.codes_for(10**8)
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(48)]) for i in range(700)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(N, "TRIES", 1)
    assert N.near_duplicates(df).where("n_links > 0 or not kept").count() == 0
    monkeypatch.setattr(N, "neighbour_graph", lambda nodes, *a, **k: spark.createDataFrame([], "u long, v long, sim double"))
    with pytest.raises(RuntimeError, match="0 of 512 planted"):
        N.near_duplicates(df)


def test_empty_table(spark):
    assert N.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    one = N.near_duplicates(spark.createDataFrame([(4, [1.0, 2.0])], "vec_id long, embedding array<float>")).collect()
    assert [tuple(r) for r in one] == [(4, 0, 4, True)]


def test_any_magnitude_links(spark):
    """Finite vectors of extreme scale link as their directions do."""
    x = [0.6, -0.8, 0.1]
    rows = [(1, x), (2, [c * 1e200 for c in x]), (3, [c * 1e-200 for c in x]), (4, x), (5, [c * 1e300 for c in x]), (6, [5e-324, 0.0, 0.0]), (7, [1e308, 0.0, 1e-308]),
            (8, [0.0, 0.0, 0.0]), (9, [float("inf"), 0.0, 0.0]), (10, [float("nan"), 1.0, 0.0]), (11, [None, 1.0, 0.0]), (12, None), (13, [])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in N.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {**{i: (4, 1) for i in range(1, 6)}, 6: (1, 6), 7: (1, 6), **{i: (0, i) for i in range(8, 14)}}
