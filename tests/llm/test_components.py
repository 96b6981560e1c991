import random

from quartermaster.llm.components import connected_components


def test_random_graphs(spark):
    rng = random.Random(21)
    for n, m in ((30, 20), (60, 50), (40, 200)):
        links = [(rng.randint(0, n), rng.randint(0, n)) for _ in range(m)] + [(100 + i, 101 + i) for i in range(40)] + [(None, 1), (2, None)]
        rng.shuffle(links)
        root = {}

        def find(x):
            root.setdefault(x, x)
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            if a is not None and b is not None and a != b:
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
        assert got == {x: find(x) for x in root}


def test_star_and_nothing(spark):
    star = spark.range(1, 2000).selectExpr("0L as a", "id as b")
    got = connected_components(star, "a", "b")
    assert got.count() == 2000 and got.filter("component <> 0").count() == 0
    assert connected_components(star.filter("false"), "a", "b").count() == 0
