import random

from marketlake.llm.components import components


def test_random_graph(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    links += [(i, i + 1) for i in range(1000, 1100)]  # a long chain
    links += [(2000, 2000 + i) for i in range(1, 200)] + [(5, 5)]  # a hub, a link to itself
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
