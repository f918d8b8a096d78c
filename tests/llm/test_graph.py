import random

from tickforge.llm.graph import connected_components


def test_components_of_random_graphs_chains_and_stars(spark, tmp_dir):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(2000 + rng.randrange(60), 2000 + rng.randrange(60)) for _ in range(50)]
    edges += [(5, 5), (3, 4), (3, 4)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), f"{tmp_dir}/g").collect()
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in got} == {x: root(x) for x in up if x not in loops}
    assert len(got) == len({r["node"] for r in got})
    assert connected_components(spark.createDataFrame([], "a long, b long"), f"{tmp_dir}/e").count() == 0
