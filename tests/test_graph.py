"""Connected components against union-find."""

import random

from tidemark.operators import graph
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def test_components_against_union_find(spark):
    r = random.Random(5)
    chain = [(1000 + i, 1001 + i) for i in range(40)]
    edges = [*chain, *[(r.randrange(60), r.randrange(60)) for _ in range(35)], (900, 900), (700, 650), (700, 650)]
    r.shuffle(edges)
    got = {x.node: x.comp for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find(edges)
    assert got == want and len(set(want.values())) > 5


def test_components_of_the_whole_table(spark):
    edges = {(x.l_suppkey, 1000000 + x.l_partkey) for x in spark.read.parquet(f"{SF}/lineitem.parquet").select("l_suppkey", "l_partkey").collect()}
    rows = registry.queries()["R7_components_all"](spark, SF).collect()
    assert {x.node: x.comp for x in rows} == union_find(edges) and len(rows) == len({x for e in edges for x in e})
