import re
from collections import Counter, defaultdict

import odd
from pyspark.sql import functions as F

from tickforge.llm import mixing as X


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water_fill(sizes, cap=3, weights=(1, 2, 3)):
    """Targets by the definition: share by weight, cap, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped = {}, {}
    while True:
        free = [s for s in order if s not in capped]
        rest = sum(sizes.values()) - sum(capped.values())
        total = sum(weight[s] for s in free)
        target = {s: rest * weight[s] / total for s in free} | capped
        over = [s for s in free if target[s] > cap * sizes[s] * (1 + 1e-12)]
        if not over:
            return target
        capped |= {s: cap * sizes[s] for s in over}
        if len(capped) == len(order):
            return capped


def corpus(n=600):
    out = []
    for i in range(n):
        source = ["a", "b", "c", "Z", "é", None, "tiny"][i % 6 if i > 5 else 6]
        out.append((i, " ".join(["w"] * (1 + (i * 7919) % (40 if i % 50 else 900))), None, source, 0))
    return out


def test_targets_caps_and_taken_words(spark):
    rows = corpus()
    got = X.mix(spark, odd.frame(spark, rows)).collect()
    size = {r[0]: n_words(r[1]) for r in rows}
    per = defaultdict(int)
    for r in rows:
        per[r[3]] += size[r[0]]
    want = water_fill(per)
    taken, goal = defaultdict(int), {}
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == per[r["source"]] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        goal[r["source"]] = r["target"]
    for s, t in want.items():
        assert abs(goal[s] - t) < 1e-6 * max(1, t)
        assert abs(taken[s] - t) <= max(2, 0.01 * t), (s, taken[s], t)
    assert goal["tiny"] == 3 * per["tiny"]  # stopped at its ceiling


def test_rates_solve_the_dual(spark):
    """Within a source the odds of the rates are an exponential in the size, and the rates meet the target."""
    rows = [r for r in corpus() if r[3] in ("a", "b")]
    got = X.mix(spark, odd.frame(spark, rows, clash=False)).collect()
    import math

    for s in ("a", "b"):
        mine = [r for r in got if r["source"] == s and r["size"]]
        slopes = [math.log(2 * r["rate"] / (3 - r["rate"])) / r["size"] for r in mine if 0.05 < r["rate"] < 2.95 and abs(r["rate"] - 1) > 0.05]
        assert slopes and max(slopes) - min(slopes) < 2e-3 * abs(sum(slopes) / len(slopes)) + 1e-6
        assert abs(sum(r["rate"] * r["size"] for r in mine) / mine[0]["target"] - 1) < 1e-5


def test_reruns_agree(spark):
    rows = corpus(300)
    a = X.mix(spark, odd.frame(spark, rows, clash=False).repartition(5)).collect()
    b = X.mix(spark, odd.frame(spark, rows[::-1], clash=False).repartition(2)).collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_odd_rows(spark):
    df = odd.frame(spark)
    got = X.mix(spark, df).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r[0]), n_words(r[1])) for r in odd.rows())
    assert all(0 <= r["copies"] <= 3 for r in got)
    assert X.mix(spark, odd.empty(spark)).count() == 0
    blank = odd.frame(spark, [(1, None, None, "s", 0), (2, " ", None, None, 0)], clash=False)
    assert [(r["size"], r["copies"]) for r in X.mix(spark, blank).collect()] == [(0, 1), (0, 1)]


def test_rows_are_repeated_as_often_as_they_have_copies(spark):
    df = odd.frame(spark, corpus(200) + odd.rows())
    out = X.repeat(spark, df)
    assert out.columns == df.columns
    want = Counter()
    for r in X.mix(spark, df).collect():
        want[(r["doc_id"], r["size"], r["source"])] += r["copies"]
    got = Counter((r["doc_id"], n_words(r["text"]), r["source"]) for r in out.collect())
    assert got == Counter({k: v for k, v in want.items() if v})
    assert X.repeat(spark, odd.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = X.mix(spark, odd.frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_words(spark):
    df = odd.frame(spark)
    for r in df.select("text", X.n_words(X.whole_text()).alias("n")).where(F.col("doc_id").isNotNull()).collect():
        assert r["n"] == n_words(r["text"])
