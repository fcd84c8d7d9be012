import random

from shelfwise.llm.common import connected_components


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def test_components_of_paths_stars_and_random_edges(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(-7, 5000)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    edges += edges[:10] + [(b, a) for a, b in edges[:10]]
    df = spark.createDataFrame([*edges, (1, 1), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert got == {k: v for k, v in union_find([e for e in edges if e[0] != e[1]]).items()}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
