import random

from ragloom.llm.components import components


def test_components_of_chains_stars_and_random_edges(spark):
    rng = random.Random(3)
    order = list(range(200))
    rng.shuffle(order)
    edges = list(zip(order, order[1:], strict=False)) + [(1000, 1000 + i) for i in range(1, 300)] + \
        [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)] + [(5, 5), (7000, 7000)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([*edges, *edges[:50], (None, 3), (4, None)], "u bigint, v bigint")
    got = {r.node: r.component for r in components(df).collect()}
    lone = {x for x in parent if root(x) == x and sum(root(y) == x for y in parent) == 1}
    assert got == {x: root(x) for x in parent if x not in lone}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []
