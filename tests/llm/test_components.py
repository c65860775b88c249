import random

from tidemark.llm.components import connected_components


def test_against_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5001 + k) for k in range(200)] + [(7, 7), (None, 3), (3, None)] + edges[:20]
    label = {}

    def root(k):
        while label.setdefault(k, k) != k:
            k = label[k]
        return k
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            label[y] = x
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert out == {k: root(k) for k in label}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
