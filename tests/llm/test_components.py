import random
from collections import defaultdict

import pytest

from weekshare.llm.components import components


@pytest.mark.parametrize("kind", ["random", "chain", "star", "none"])
def test_against_union_find(spark, kind):
    rng = random.Random(6)
    names = rng.sample(range(10**12), 400)
    edges = {"random": [(rng.choice(names), rng.choice(names)) for _ in range(250)],
             "chain": list(zip(names[:120], names[1:121])),
             "star": [(names[0], n) for n in names[:90]] * 2, "none": []}[kind]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[find(a)] = find(b)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == set(parent)
    groups, want = defaultdict(set), defaultdict(set)
    for n in got:
        groups[got[n]].add(n)
        want[find(n)].add(n)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
