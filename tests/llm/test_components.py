"""Components against union-find on random links, chains and stars."""

import random

from kiln.llm.common import shared_dir
from kiln.llm.components import components


def plain(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(130)]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(1, 50)] + [(1000, 1001)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df, shared_dir(spark), "c").collect()}
    assert got == {x: y for x, y in plain([x for x in links if x[0] != x[1]]).items()}
    assert components(df.limit(0), shared_dir(spark), "c").count() == 0
