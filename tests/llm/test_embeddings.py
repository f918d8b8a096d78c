import numpy as np

from tickforge.llm import embeddings as E

DDL = "vec_id long, embedding array<float>, label int, class string, n string"


def brute(rows, threshold):
    def ok(v):
        return v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))

    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if l is not None and ok(v) else None for _, v, l in rows]
    n, up = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                n[i] += 1
                n[j] += 1
                up[root(i)] = root(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((r[0], n[i], min(ids) if ids else None))
    return sorted(out, key=str)


def cluster(rng, n, dim, spread, label, start):
    c = rng.normal(size=dim)
    c /= np.linalg.norm(c)
    return [(start + i, [float(np.float32(x)) for x in c + spread * rng.normal(size=dim)], label) for i in range(n)]


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "own", "own") for r in rows], DDL)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in E.near_duplicates(spark, df, **options).collect()), key=str)


def test_links_match_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=32)], int(rng.integers(3))) for i in range(200)]
    for k in range(12):
        rows += cluster(rng, 10, 32, 0.02, k % 3, 1000 + 100 * k)
    rows += [(5000, rows[0][1], rows[0][2]), (5001, [2 * x for x in rows[0][1]], rows[0][2]), rows[0]]
    got, want = run(spark, rows), brute(rows, 0.98)
    links = sum(n for _, n, _ in want)
    assert sum(n for _, n, _ in got) >= 0.99 * links and all(g[1] <= w[1] for g, w in zip(sorted(got, key=lambda x: x[0]), sorted(want, key=lambda x: x[0])))
    assert got == want


def test_hot_list_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 16)
    rng = np.random.default_rng(5)
    rows = cluster(rng, 120, 24, 0.01, 1, 0) + cluster(rng, 40, 24, 0.03, 1, 500)
    assert run(spark, rows, pivots=16) == brute(rows, 0.98)


def test_blocks_of_single_vectors(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 1)
    rows = cluster(np.random.default_rng(7), 12, 16, 0.01, 1, 0)
    assert run(spark, rows) == brute(rows, 0.98)


def test_vectors_that_link_with_nothing(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, None), (2, v, None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 3.0], 1), (7, [1.0, float("nan"), 3.0], 1),
            (8, [1.0, float("inf"), 3.0], 1), (9, v, 1), (10, v, 2), (11, [1.0, 2.0], 1), (None, v, 3), (None, v, 3), (12, [1e-30, 2e-30, 3e-30], 1), (9, v, 1)]
    assert run(spark, rows) == brute(rows, 0.98)
    assert run(spark, []) == []
