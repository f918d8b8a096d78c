import random
import re

import numpy as np
import odd

from tickforge.llm import minhash as M


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def brute(rows, percent):
    """(n_shingles, component) per row by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), (min(ids) if ids else None)))
    return sorted(out, key=str)


def near_copies(n_groups, size, words, edits, seed=1):
    rng, rows = random.Random(seed), []
    for g in range(n_groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(edits)):
                text[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text), None, None, 0))
    rng.shuffle(rows)
    return rows


def check(spark, rows, threshold):
    got = M.near_duplicates(spark, odd.frame(spark, rows, clash=False), threshold=threshold)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == brute(rows, round(100 * threshold))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())


def test_components_match_all_pairs(spark):
    check(spark, near_copies(25, 8, 120, 9), 0.85)


def test_hot_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)
    check(spark, near_copies(2, 90, 100, 7), 0.8)


def test_blocks_with_single_classes(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 1)
    check(spark, near_copies(3, 5, 60, 3, seed=5), 0.8)


def test_sets_too_large_to_travel(spark, monkeypatch):
    monkeypatch.setattr(M, "AT_HAND", 20)
    check(spark, near_copies(10, 8, 80, 6, seed=3), 0.85)


def test_odd_rows(spark):
    df = odd.frame(spark)
    got = M.near_duplicates(spark, df, threshold=0.85)
    rows = odd.rows()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == brute(rows, 85)
    assert M.near_duplicates(spark, odd.empty(spark)).count() == 0


def test_keep_one_keeps_all_columns(spark):
    rows = near_copies(6, 4, 100, 3, seed=9)
    df = odd.frame(spark, rows)
    kept = M.keep_one(spark, df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(rows, 80)})


def test_keep_one_without_ids_and_with_repeated_ids(spark):
    rng = random.Random(12)
    base = {g: [f"{g}{rng.randrange(5000)}" for _ in range(80)] for g in "abcdef"}

    def text(group, tail=""):
        return " ".join([*base[group], *tail.split()])

    rows = [(1, text("a")), (None, text("a", "x")), (2, text("a", "y"))]  # mixed ids: 1 stays
    rows += [(None, text("b")), (None, text("b", "x")), (None, text("b", "y"))]  # no ids: any one
    rows += [(None, text("c")), (None, "alone without an id")]  # both stay
    rows += [(3, text("d")), (4, text("d", "x")), (3, text("a", "z")), (4, text("e"))]  # ids with two texts
    rows += [(5, text("f")), (5, text("f")), (5, text("f", "x"))]  # repeated rows: any one
    rows += [(6, ""), (6, None), (None, " "), (None, " ")]  # without words: all stay
    df = odd.frame(spark, [(*r, "en", "s", i) for i, r in enumerate(rows)])
    for part in (df, df.repartition(5)):
        kept = M.keep_one(spark, part)
        assert kept.columns == df.columns
        got = sorted(r["n_chars"] for r in kept.collect())
        assert len([i for i in got if 3 <= i <= 5]) == 1 and len([i for i in got if 12 <= i <= 14]) == 1
        assert [i for i in got if not (3 <= i <= 5 or 12 <= i <= 14)] == [0, 6, 7, 8, 11, 15, 16, 17, 18]


def test_words_and_groups():
    assert M.rows_for(0.85) == 6 and M.miss_probability(0.85, 6, 20) < 0.002
    s = M.Shingler(5)
    raw = "A b\tc d e f é".encode()
    one = s.sets(np.frombuffer(raw * 2, np.uint8), np.array([0, len(raw), 2 * len(raw)]))
    assert len(one[0]) == 3 and (one[0] == one[1]).all()
    short = s.sets(np.frombuffer(b"a b", np.uint8), np.array([0, 3]))[0]
    assert len(short) == 1


def test_words_cut_into_pieces_hash_alike(monkeypatch):
    from tickforge.llm import bytescan

    text = " ".join(random.Random(4).choices(["a", "bb", "ccc é", "x" * 50], k=3000)).encode()
    data, off = np.frombuffer(text, np.uint8), np.array([0, 1001, 1001, len(text)])
    whole = bytescan.WordHasher(bytescan.NON_SPACE)(data, off)
    monkeypatch.setattr(bytescan, "PIECE", 37)
    cut = bytescan.WordHasher(bytescan.NON_SPACE)(data, off)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
