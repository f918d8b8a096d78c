import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import hard_negatives as H

DDL = "vec_id long, embedding array<float>, label int, score string, low string"


def brute(rows, every=5, positives=5, negatives=3):
    """The definition, row by row, in Python integers."""
    part = []
    for i, vec, label in rows:
        if i is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        part.append((i, label, [int(np.floor(256 * float(np.float32(x)))) for x in vec]))
    out = []
    seen = set()
    for i, label, v in sorted(part, key=lambda r: (r[0], str(r[1]), r[2])):
        if i % every or i in seen:
            continue
        seen.add(i)
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, m) for j, m, w in part if j != i and len(w) == len(v)]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            ok = sorted((t, k) for t, k, m in scored if m != label and 50 * -s <= 100 * -t <= 95 * -s)
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(ok[:negatives])]
    return sorted(out)


def mined(spark, rows, every=5):
    df = spark.createDataFrame([(*r, "own", "own") for r in rows], DDL)
    return sorted(map(tuple, H.hard_negatives(spark, df, F.col("label"), F.col("vec_id") % every == 0).collect()))


def vectors(n, dim, labels, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dim)
    return [(i, [float(x) for x in np.float32(centre + spread * rng.normal(size=dim))], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("blocks", [(8192, 1 << 16, 1 << 21), (4, 16, 64)])
def test_against_the_definition(spark, monkeypatch, blocks):
    for name, value in zip(("ANCHORS", "ROWS", "SCORES"), blocks, strict=True):
        monkeypatch.setattr(H, name, value)
    rows = vectors(150, 16, 3, 1)
    rows += [(1000 + i, [1.0] * 16, i % 4) for i in range(30)]  # ties: one vector for many
    assert mined(spark, rows) == brute(rows) != []


def test_odd_rows(spark):
    rows = vectors(60, 8, 2, 2, 0.4)
    rows += [(None, rows[0][1], 1), (200, None, 1), (205, [float("nan")] * 8, 1), (210, [float("inf")] + [0.0] * 7, 0), (215, [None] * 8, 0), (220, rows[1][1], None)]
    rows += [(225, [0.0] * 8, 0), (230, [], 1), (235, [], 0), (240, [], 1), (245, rows[3][1][:5], 0), (250, rows[3][1][:5], 1), (255, rows[4][1][:5], 0)]
    rows += [rows[3], rows[5], rows[5], (10, rows[7][1], 1), (11, rows[8][1], 0)]  # rows and ids that repeat
    assert mined(spark, rows) == brute(rows) != []
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 0)]) == []


def test_large_components_are_exact(spark):
    """Scores beyond 2**53; a row too long for a long takes no part."""
    rng = random.Random(3)
    rows = [(i, [float(np.float32(rng.uniform(1, 2) * 2**20)) for _ in range(4)], i % 2) for i in range(40)]
    want = brute(rows)
    assert max(r[4] for r in want) > 2**53
    assert mined(spark, [*rows, (300, [1e30] * 4, 0)]) == want


def test_residue_product_is_exact():
    rng = np.random.default_rng(4)
    for dim, size in ((1, 3), (64, 300), (64, 2**24), (1000, 5000), (0, 1), (257, 2**25)):
        a, b = (rng.integers(-size, size + 1, (n, dim)) for n in (7, 9))
        assert (H.residue_product(a, b) == a @ b.T).all()
    a = np.array([[2**30, -(2**30)], [2**30, 2**30]])
    assert (H.residue_product(a, a) == [[2**61, 0], [0, 2**61]]).all()
    assert H.residue_product(np.zeros((0, 4), np.int64), np.ones((2, 4), np.int64)).shape == (0, 2)


def test_no_number_of_rows_per_unit_grows_with_a_label(spark):
    """One label and one vector for all rows: groups stay even."""
    rows = [(i, [1.0, 2.0], 1) for i in range(400)]
    path = H.work_dir(spark, "even")
    df = H.stored(H.prepare(spark.createDataFrame([(*r, "", "") for r in rows], DDL), F.col("label"), F.col("vec_id") < 0), path)
    df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    none = df.where("anchor").select("id", "label", "dim", "vec", F.array(F.lit(0)).cast("array<long>").alias("low"), F.array(F.lit(0)).cast("array<long>").alias("high"))
    sizes = [r["count"] for r in H._blocks(df, none, 400, 0, True).groupBy("group").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 400 / 8
